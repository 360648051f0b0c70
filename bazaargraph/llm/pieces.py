"""SentencePiece encoding and decoding: unigram Viterbi over a double-array trie.

Text is escaped as SentencePiece does without normalisation: a blank is put in
front and blanks become U+2581. The pieces lie in a double-array trie over UTF-8
bytes; of all segmentations the one with the largest sum of piece scores wins, the
piece that starts first on ties, the longest of those. A character in no piece costs
the lowest score less ten and becomes byte pieces. Decoding joins pieces and bytes,
turns U+2581 into blanks and drops the first.

No piece has U+2581 behind another character, so texts fall into units, blanks and
what follows up to the next blank, that are segmented by themselves. The units of a
batch that have not been met lately are segmented together, step by step.

Null texts have null ids; empty ones have none. Every row is answered by itself.
``decode(encode(text))`` is the text unless that contains U+2581.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MODEL = "/opt/tokenizers/piece_bpe_32k.model"  # read on the driver
MARK = "▁"
UNKNOWN_PENALTY = 10.0
POINT = 1 << 16  # scores are counted in 1 / POINT
UNIT = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")
TOGETHER = 96  # units of up to so many bytes are segmented together
CACHED = 300_000  # units that a task remembers
SLICE = 250
WAITING = 20_000  # units segmented together at most


class DoubleArray:
    """A trie in two arrays: from state s, byte b leads to base[s] + b if check there is s.

    A base of 0 marks a leaf. ``value`` holds the id of the piece that ends in a state,
    or -1.
    """

    def __init__(self, keys: list[bytes], values: list[int]) -> None:
        children: dict[bytes, set[int]] = {b"": set()}
        for key in keys:
            for i in range(len(key)):
                children.setdefault(key[:i], set()).add(key[i])
        # The widest nodes are placed first; those with one child fill the gaps.
        size = 2 * len(children) + 4 * 256
        free = np.ones(size, dtype=bool)
        free[0] = False
        place: dict[bytes, int] = {}
        low, last = 1, 0  # where the search for the next place starts
        for prefix in sorted(children, key=lambda p: (-len(children[p]), p)):
            labels = np.array(sorted(children[prefix]), np.int64)
            if not len(labels):
                continue
            while prefix not in place:
                spots = np.flatnonzero(free[low : low + 4096]) + low - labels[0]
                spots = spots[(spots > 0) & (spots + labels[-1] < size)]
                fits = free[spots[:, None] + labels].all(axis=1)
                if fits.any():
                    place[prefix] = int(spots[np.argmax(fits)])
                elif len(labels) == 1 and low + 4096 >= size:
                    low = 1
                else:
                    low += 2048
            if len(labels) == 1 and low > 1 and last > 1:
                low = 1
            last = len(labels)
            free[place[prefix] + labels] = False
        self.base = np.zeros(size, np.int32)
        self.check = np.full(size, -1, np.int32)
        state = {b"": 0}
        for prefix in sorted(place, key=len):
            at = place[prefix]
            self.base[state[prefix]] = at
            for label in children[prefix]:
                self.check[at + label] = state[prefix]
                state[prefix + bytes([label])] = at + label
        self.value = np.full(len(self.check), -1, np.int32)
        for key, value in zip(keys, values, strict=True):
            self.value[state[key]] = value


def log_scores(scores: np.ndarray) -> np.ndarray:
    """Log scores of all pieces.

    A model trained by merging holds minus the rank of each merge (whole numbers);
    frequencies fall about as one over the rank, so that its log score is
    ``-log(rank + 2)``. Other scores are log scores already.
    """
    if (scores == np.rint(scores)).all():
        return -np.log(np.minimum(-scores, len(scores)) + 2)
    return scores


@dataclass
class Pieces:
    texts: list[str]  # of every id; None for control pieces
    trie: DoubleArray
    scores: np.ndarray
    byte_ids: np.ndarray
    unknown: float

    @classmethod
    def load(cls, path: str) -> Pieces:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(model.get_piece_size())
        byte_ids = np.array([model.piece_to_id(f"<0x{b:02X}>") for b in range(256)], np.int32)
        plain = [
            i for i in ids
            if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))
        ]
        texts = [model.id_to_piece(i) for i in ids]
        if any(MARK in texts[i].lstrip(MARK) for i in plain):
            raise ValueError("a piece has a blank behind another character")
        # Whole numbers, so that ties are ties in any order of summation.
        scores = np.rint(log_scores(np.array([model.get_score(i) for i in ids])) * POINT)
        trie = DoubleArray([texts[i].encode() for i in plain], plain)
        kept = set(plain)
        shown = [t if i in kept else "" for i, t in enumerate(texts)]
        return cls(shown, trie, scores, byte_ids, scores[plain].min() - UNKNOWN_PENALTY * POINT)

    def segment(self, units: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all units, number of ids of each)."""
        counts = np.zeros(len(units), np.int64)
        order = sorted(range(len(units)), key=lambda i: len(units[i]))
        short = [i for i in order if len(units[i]) <= TOGETHER]
        parts = []
        for at in range(0, len(short), WAITING):
            some = short[at : at + WAITING]
            ids, counts[some] = self._together([units[i] for i in some])
            parts.append(ids)
        for i in order[len(short) :]:
            parts.append(self._alone(units[i]))
            counts[i] = len(parts[-1])
        ids = np.concatenate([*parts, np.zeros(0, np.int32)])
        return ids[spread(_starts(counts[order])[np.argsort(order)], counts)], counts

    def _together(self, units: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        trie = self.trie
        sizes = np.array([len(u) for u in units])
        longest = int(sizes.max())
        flat = np.frombuffer(b"".join(u.ljust(longest + 1, b"\xff") for u in units), np.uint8)
        text = flat.reshape(len(units), longest + 1)
        head = (text & 0xC0) != 0x80  # first bytes of characters, and the end
        best = np.full((len(units), longest + 1), -np.inf)
        best[:, 0] = 0
        origin = np.zeros((len(units), longest + 1), np.int32)
        piece = np.full((len(units), longest + 1), -1, np.int32)
        for start in range(longest):
            rows = np.flatnonzero((sizes > start) & (best[:, start] > -np.inf))
            if not len(rows):
                continue
            began, single = rows, np.zeros(len(units), dtype=bool)
            state = np.zeros(len(rows), np.int32)
            for end in range(start + 1, longest + 1):
                step = trie.base[state] + text[rows, end - 1]
                good = (trie.check[step] == state) & (trie.base[state] > 0) & (sizes[rows] >= end)
                rows, state = rows[good], step[good]
                if not len(rows):
                    break
                ids = trie.value[state]
                hit = np.flatnonzero(ids >= 0)
                if len(hit):
                    at, found = rows[hit], ids[hit]
                    score = best[at, start] + self.scores[found]
                    # The first character ends here if no further one has begun.
                    single[at[~head[at, start + 1 : end].any(axis=1)]] = True
                    better = score > best[at, end]
                    at = at[better]
                    best[at, end], origin[at, end] = score[better], start
                    piece[at, end] = found[better]
            lone = began[~single[began]]
            if len(lone):
                ends = start + 1 + np.argmax(head[lone, start + 1 :], axis=1)
                score = best[lone, start] + self.unknown
                better = score > best[lone, ends]
                lone, ends = lone[better], ends[better]
                best[lone, ends], origin[lone, ends] = score[better], start
                piece[lone, ends] = -1
        # Walk all units back from their ends at once.
        at, rows, steps = sizes.copy(), np.arange(len(units)), []
        while len(rows):
            ids, came = piece[rows, at[rows]], origin[rows, at[rows]]
            steps.append((rows, ids, came, at[rows]))
            at[rows] = came
            rows = rows[came > 0]
        row, ids, came, end = (np.concatenate(x) for x in zip(*steps, strict=True))
        turn = np.lexsort((came, row))
        row, ids, came, end = row[turn], ids[turn], came[turn], end[turn]
        width = np.where(ids < 0, end - came, 1)
        counts = np.bincount(row, weights=width, minlength=len(units)).astype(np.int64)
        if (ids < 0).any():
            place = np.repeat(row * (longest + 1) + came, width)
            inside = np.arange(len(place)) - np.repeat(_starts(width), width)
            ids = np.repeat(ids, width)
            raw = self.byte_ids[text.ravel()[place + inside]]
            ids = np.where(ids < 0, raw, ids)
        return ids, counts

    def _path(self, unit: bytes, origin: list[int], piece: list[int]) -> np.ndarray:
        ids: list[int] = []
        at = len(unit)
        while at:
            if piece[at] >= 0:
                ids.append(piece[at])
            else:
                ids.extend(self.byte_ids[b] for b in reversed(unit[origin[at] : at]))
            at = origin[at]
        return np.array(ids[::-1], np.int32)

    def _alone(self, unit: bytes) -> np.ndarray:
        """The same for one long unit, byte by byte."""
        trie, scores = self.trie, self.scores
        size = len(unit)
        best = [float("-inf")] * (size + 1)
        best[0] = 0.0
        origin, piece = [0] * (size + 1), [-1] * (size + 1)
        for start in range(size):
            here = best[start]
            if here == float("-inf"):
                continue
            first = start + 1
            while first < size and unit[first] & 0xC0 == 0x80:
                first += 1
            state, end, single = 0, start, False
            while end < size:
                base = int(trie.base[state])
                step = base + unit[end]
                if not base or trie.check[step] != state:
                    break
                state, end = step, end + 1
                found = int(trie.value[state])
                if found >= 0:
                    single |= end == first
                    score = here + scores[found]
                    if score > best[end]:
                        best[end], origin[end], piece[end] = score, start, found
            if not single and here + self.unknown > best[first]:
                best[first], origin[first], piece[first] = here + self.unknown, start, -1
        return self._path(unit, origin, piece)

    def spellings(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(bytes of all pieces, start and length of each); control pieces have none."""
        spelled = [t.replace(MARK, " ").encode() for t in self.texts]
        for byte, i in enumerate(self.byte_ids):
            spelled[i] = bytes([byte])
        lengths = np.array([len(x) for x in spelled])
        return np.frombuffer(b"".join(spelled), np.uint8), _starts(lengths), lengths


def _starts(counts: np.ndarray) -> np.ndarray:
    return np.cumsum(counts) - counts


def spread(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The positions of many runs, one after the other."""
    return np.repeat(starts - _starts(counts), counts) + np.arange(counts.sum())


class Encoder:
    """Encodes texts in a task, remembering units."""

    def __init__(self, pieces: Pieces) -> None:
        self.pieces = pieces
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.ids = np.zeros(0, np.int32)
        self.counts = np.zeros(0, np.int64)

    def __call__(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, number of ids of each)."""
        own = [UNIT.findall(MARK + t.replace(" ", MARK)) if t else [] for t in texts]
        units = list(chain.from_iterable(own))
        if len(self.known) > CACHED:
            self._forget()
        known = self.known
        new = list(set(units).difference(known))
        if new:
            ids, counts = self.pieces.segment([u.encode() for u in new])
            known.update(zip(new, range(len(known), len(known) + len(new)), strict=True))
            self.ids = np.concatenate([self.ids, ids])
            self.counts = np.concatenate([self.counts, counts])
            self.starts = _starts(self.counts)
        if not units:
            return np.zeros(0, np.int32), np.zeros(len(texts), np.int64)
        at = np.fromiter(map(known.__getitem__, units), np.int64, len(units))
        counts = self.counts[at]
        totals = np.concatenate([[0], np.cumsum(counts)])
        bounds = np.cumsum([0] + [len(x) for x in own])
        return (
            self.ids[spread(self.starts[at], counts)],
            totals[bounds[1:]] - totals[bounds[:-1]],
        )


class Decoder:
    def __init__(self, pieces: Pieces) -> None:
        self.bytes, self.starts, self.lengths = pieces.spellings()

    def __call__(self, ids: np.ndarray, sizes: np.ndarray) -> list[str]:
        """The texts of runs of ``sizes`` ids."""
        lengths = self.lengths[ids]
        joined = self.bytes[spread(self.starts[ids], lengths)].tobytes()
        ends = np.concatenate([[0], np.cumsum(lengths)])[np.cumsum(sizes)]
        begins = np.concatenate([[0], ends[:-1]])
        return [
            joined[a + 1 : b].decode("utf-8", "replace")
            for a, b in zip(begins.tolist(), ends.tolist(), strict=True)
        ]


def _encoded(shared):
    def run(batches):
        encoder, decoder = Encoder(shared.value), Decoder(shared.value)
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                texts = part.column(1).to_pylist()
                ids, sizes = encoder(texts)
                offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
                lists = pa.ListArray.from_arrays(
                    offsets, pa.array(ids), mask=pa.array([t is None for t in texts])
                )
                restored = [
                    None if text is None else back == text
                    for text, back in zip(texts, decoder(ids, sizes), strict=True)
                ]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), lists, pa.array(restored, pa.bool_())],
                    names=["doc_id", "ids", "restored"],
                )

    return run


def _decoded(shared):
    def run(batches):
        decoder = Decoder(shared.value)
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                lists = part.column(1)
                sizes = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
                texts = decoder(lists.flatten().to_numpy(zero_copy_only=False), sizes)
                known = lists.is_valid().to_pylist()
                shown = [t if ok else None for t, ok in zip(texts, known, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(shown, pa.string())], names=["doc_id", "text"]
                )

    return run


def encode_texts(docs: DataFrame, model: str = MODEL) -> DataFrame:
    """(doc_id, ids, restored) of every row of ``docs`` (doc_id, text, ...).

    ``restored`` tells whether the ids decode to the text.
    """
    # The vocabulary of one model: some tens of thousands of pieces.
    shared = docs.sparkSession.sparkContext.broadcast(Pieces.load(model))
    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", "text").mapInArrow(
        _encoded(shared), f"doc_id {kind}, ids array<int>, restored boolean"
    )


def decode_ids(rows: DataFrame, model: str = MODEL) -> DataFrame:
    """(doc_id, text) of every row of (doc_id, ids, ...); unknown ids are an error."""
    shared = rows.sparkSession.sparkContext.broadcast(Pieces.load(model))
    kind = dict(rows.dtypes)["doc_id"]
    return rows.select("doc_id", F.col("ids").cast("array<int>").alias("ids")).mapInArrow(
        _decoded(shared), f"doc_id {kind}, text string"
    )
