"""Quality of documents by a byte-level convolutional network in numpy.

A byte's input is its kind (letter case, digit, blank, sorts of punctuation, part of
a longer character) and whether the eight bytes up to it repeat those some bytes
before. Learned filters of ``WIDTH`` bytes move over the whole text in half steps;
chunks of ``CHUNK`` filter positions, sharing half a filter with the next, are
max-pooled, and a logistic layer on the largest and the mean chunk values of each
filter gives the probability.

Null and empty texts are a single chunk of padding and get its score. Without
labelled documents of both classes all scores are 1. Every row is answered by itself.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaargraph.llm.training import labelled_sample, remainder

PER_CLASS = 600  # documents of each class that are learnt from, at most
THRESHOLD = 0.3
FOLDS, HELD_OUT = 5, 0
WIDTH, STEP, CHUNK, FILTERS = 8, 4, 64, 16
LAGS = range(2, 28)
EPOCHS = 8
BATCH = 24
RATE = 0.01
BLOCK = 1 << 18
SEED = 11

KINDS = [" ", "\n\r\t", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789",
         ".,;:?'\"()-", "!", "|", "*#$%&@^~_=+<>/\\{}[]`"]
CHANNELS = len(KINDS) + 3  # besides: other bytes, bytes of longer characters, repeats


def _kinds() -> np.ndarray:
    table = np.zeros((256, CHANNELS), dtype=np.float32)
    for k, members in enumerate(KINDS):
        table[[ord(c) for c in members], k] = 1
    table[128:, len(KINDS)] = 1
    table[table.sum(axis=1) == 0, len(KINDS) + 1] = 1
    table[0] = 0  # padding
    return table


TABLE = _kinds()


def padded(texts: list[bytes | None]) -> tuple[bytes, np.ndarray]:
    """All texts, each filled with zeros to whole chunks, and their numbers of chunks."""
    span = STEP * CHUNK
    chunks = np.array([(len(t or b"") + STEP) // span + 1 for t in texts], dtype=np.int64)
    return b"".join((t or b"").ljust(n * span, b"\0") for t, n in zip(texts, chunks, strict=True)), chunks


def windows(raw: bytes) -> np.ndarray:
    """Inputs of every filter position, a row of WIDTH * CHANNELS values each."""
    x = np.frombuffer(raw, np.uint8)
    data = np.zeros((len(x) + WIDTH - STEP, CHANNELS), dtype=np.float32)
    data[: len(x)] = TABLE[x]
    repeats = np.zeros(len(x), dtype=bool)
    for lag in LAGS:
        same = x[lag:] == x[:-lag]
        for reach in (1, 2, 4):
            same = same[reach:] & same[:-reach]
        if len(same):
            repeats[-len(same) :] |= same
    data[: len(x), -1] = repeats & (x != 0)
    positions = len(x) // STEP
    flat = np.ascontiguousarray(data).ravel()
    size, move = flat.itemsize, STEP * CHANNELS
    return np.lib.stride_tricks.as_strided(
        flat, (positions, WIDTH * CHANNELS), (move * size, size), writeable=False
    )


@dataclass
class Network:
    filters: np.ndarray  # [WIDTH * CHANNELS, FILTERS]
    bias: np.ndarray
    head: np.ndarray  # weights of largest and mean values
    shift: float

    def chunks(self, raw: bytes) -> np.ndarray:
        values = np.maximum(windows(raw) @ self.filters + self.bias, 0)
        return values.reshape(-1, CHUNK, values.shape[1]).max(axis=1)

    def scores(self, texts: list[bytes | None]) -> np.ndarray:
        raw, chunks = padded(texts)
        pieces = BLOCK // (STEP * CHUNK) * STEP * CHUNK
        # A block carries the bytes before it for repeats, and half a filter after it.
        lead = STEP * CHUNK
        parts = []
        for at in range(0, len(raw), pieces):
            low = max(0, at - lead)
            high = min(len(raw), at + pieces + lead)
            found = self.chunks(raw[low:high])
            drop = (at - low) // lead
            parts.append(found[drop : drop + min(pieces, len(raw) - at) // lead])
        return self.combine(np.concatenate(parts), chunks)[1]

    def combine(self, values: np.ndarray, chunks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        starts = np.cumsum(chunks) - chunks
        largest = np.maximum.reduceat(values, starts, axis=0)
        mean = np.add.reduceat(values, starts, axis=0) / chunks[:, None]
        features = np.concatenate([largest, mean], axis=1).astype(np.float64)
        logits = features @ self.head + self.shift
        return features, 1 / (1 + np.exp(-np.clip(logits, -40, 40)))


def fit(texts: list[bytes], labels: np.ndarray) -> Network | None:
    """Adam on the cross entropy; only the winning positions carry gradients."""
    if len(set(labels.tolist())) < 2:
        return None
    random = np.random.default_rng(SEED)
    inputs = WIDTH * CHANNELS
    net = Network(
        (random.standard_normal((inputs, FILTERS)) * 0.3).astype(np.float32),
        np.zeros(FILTERS, np.float32), random.standard_normal(2 * FILTERS) * 0.1, np.float64(0),
    )
    share = {v: 0.5 / (labels == v).mean() for v in (0, 1)}
    moments: dict[str, tuple] = {}
    turn = 0
    for epoch in range(EPOCHS):
        order = random.permutation(len(texts))
        rate = RATE * (1 - epoch / EPOCHS)
        for at in range(0, len(order), BATCH):
            some = order[at : at + BATCH]
            truth = labels[some]
            raw, chunks = padded([texts[i] for i in some])
            x = windows(raw)
            values = x @ net.filters + net.bias
            values = values.reshape(-1, CHUNK, FILTERS)
            winner = values.argmax(axis=1)
            best = np.take_along_axis(values, winner[:, None, :], axis=1)[:, 0]
            active = np.maximum(best, 0)
            features, p = net.combine(active, chunks)
            error = (p - truth) * np.where(truth == 1, share[1], share[0]) / len(some)
            owner = np.repeat(np.arange(len(some)), chunks)
            back = error[:, None] * net.head
            grad = back[owner, FILTERS:] / chunks[owner, None]
            top = active == features[owner, :FILTERS].astype(np.float32)
            grad = (grad + np.where(top, back[owner, :FILTERS], 0)) * (best > 0)
            rows = np.arange(len(winner))[:, None] * CHUNK + winner
            kernel = np.stack(
                [x[rows[:, f]].T @ grad[:, f].astype(np.float32) for f in range(FILTERS)], axis=1
            )
            turn += 1
            steps = (
                ("filters", kernel), ("bias", grad.sum(axis=0)),
                ("head", features.T @ error + 1e-4 * net.head), ("shift", error.sum()),
            )
            for name, g in steps:
                first, second = moments.get(name, (0.0, 0.0))
                first, second = 0.9 * first + 0.1 * g, 0.99 * second + 0.01 * g * g
                moments[name] = first, second
                slope = np.sqrt(second / (1 - 0.99**turn)) + 1e-8
                move = rate * (first / (1 - 0.9**turn)) / slope
                kind = np.float32 if name in ("filters", "bias") else np.float64
                setattr(net, name, (getattr(net, name) - move).astype(kind))
    net.shift = float(net.shift)
    return net


def train(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> Network | None:
    sample = labelled_sample(docs, labels, "quality", remainder(FOLDS) != HELD_OUT, per_class)
    return fit([t.encode() for t in sample["text"]], sample["label"].to_numpy())


def _batch_scores(net: Network | None, texts: pa.Array) -> np.ndarray:
    scores = np.ones(len(texts))
    if net is not None:
        texts = texts.cast(pa.binary())
        sizes = np.array([len(t) if t else 0 for t in texts.to_pylist()])
        cuts = np.flatnonzero(np.diff(np.cumsum(sizes) // BLOCK)) + 1
        for part in np.split(np.arange(len(sizes)), cuts):
            if len(part):
                scores[part] = net.scores(texts.slice(part[0], len(part)).to_pylist())
    return scores


def _scores(net: Network | None):
    def run(batches):
        for batch in batches:
            scores = _batch_scores(net, batch.column(1))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(scores)],
                names=["doc_id", "held_out", "score"],
            )

    return run


def good_documents(docs: DataFrame, net: Network | None) -> DataFrame:
    """The rows of ``docs``, all columns, whose score reaches ``THRESHOLD``."""

    def run(batches):
        for batch in batches:
            yield batch.filter(pa.array(_batch_scores(net, batch.column("text")) >= THRESHOLD))

    return docs.mapInArrow(run, docs.schema)


def score_quality(docs: DataFrame, net: Network | None) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of ``docs`` (doc_id, text, ...)."""
    held_out = F.coalesce(remainder(FOLDS) == HELD_OUT, F.lit(False))
    kind = dict(docs.dtypes)["doc_id"]
    return (
        docs.select("doc_id", "text", held_out.alias("held_out"))
        .mapInArrow(_scores(net), f"doc_id {kind}, held_out boolean, score double")
        .withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
    )
