"""Language of a document by prediction by partial matching over bytes.

Each language has context trees up to order 3, frozen after counting a bounded
sample. A byte costs -log2 of its probability: with ``n`` bytes seen after a context,
``d`` of them distinct, a byte seen ``c`` times has ``c / (n + d)``, and any other
escapes with ``d / (n + d)`` to the context shortened by one, at last to all symbols
alike. The language with the shortest code wins, and its score is its posterior
probability if all languages are as likely beforehand.

As the statistics don't change, the escapes are worked out once: a table holds for
each known context and next symbol the final cost in every language, in fixed point,
so that sums are exact. Bytes not in the sample are one symbol.

Null texts and texts without a letter are ``und`` with score 0, and so is everything
if there is nothing to learn from. Every row is answered by itself.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaargraph.llm.training import TEXT_BYTES, remainder

PER_LANGUAGE = 150  # documents learnt from, about, for each language
FOLDS, HELD_OUT = 3, 1
SYMBOLS = 128
TABLE_BYTES = 1 << 26  # of the costs; the rarest contexts of order 3 go beyond it
POINT = 1 << 12  # costs are counted in 1 / POINT bits
BLOCK = 1 << 19
SLICE = 500
PAD = b"   "  # stands before every text


@dataclass
class Languages:
    names: list[str]
    symbol: np.ndarray  # of each byte
    row: np.ndarray  # of each context of three symbols
    costs: np.ndarray  # [row * SYMBOLS + symbol, language]

    def code_lengths(self, texts: list[bytes | None]) -> np.ndarray:
        """Bits of each text in each language."""
        total = np.zeros((len(texts), len(self.names)), dtype=np.int64)
        pieces: list[bytes] = []
        owners: list[int] = []
        size = 0
        for i, text in enumerate(texts):
            for at in range(0, len(text or b""), BLOCK):
                before = (PAD + text[max(0, at - 3) : at])[-3:]
                pieces.append(before + text[at : at + BLOCK])
                owners.append(i)
                size += len(pieces[-1])
                if size >= BLOCK:
                    self._add(total, pieces, owners)
                    pieces, owners, size = [], [], 0
        if pieces:
            self._add(total, pieces, owners)
        return total / POINT

    def _add(self, total: np.ndarray, pieces: list[bytes], owners: list[int]) -> None:
        s = self.symbol[np.frombuffer(b"".join(pieces), np.uint8)]
        context = (s[:-3] << 14) | (s[1:-2] << 7) | s[2:-1]
        costs = self.costs[self.row[context] * SYMBOLS + s[3:]]
        sizes = np.array([len(p) for p in pieces])
        starts = np.cumsum(sizes) - sizes
        # The costs of the pads before all pieces but the first are left out.
        bounds = np.stack([starts, starts + sizes - 3], axis=1).ravel()[:-1]
        sums = np.add.reduceat(costs, bounds, axis=0, dtype=np.int64)[::2]
        np.add.at(total, owners, sums)


def _costs(counts: np.ndarray, shorter: np.ndarray) -> np.ndarray:
    """Costs [context, symbol, language] from counts, given those one order below."""
    n = counts.sum(axis=1, keepdims=True).astype(np.float64)
    d = (counts > 0).sum(axis=1, keepdims=True)
    base = np.maximum(n + d, 1)
    escape = np.where(n > 0, -np.log2(np.maximum(d, 1) / base), 0.0)
    known = -np.log2(np.maximum(counts, 1) / base)
    return np.where(counts > 0, known, escape + shorter)


def fit(texts: dict[str, list[bytes]]) -> Languages | None:
    """Freeze the context trees of each language's texts."""
    names = sorted(k for k, v in texts.items() if any(v))
    if not names:
        return None
    joined = [
        np.frombuffer(b"".join(PAD + t for t in texts[name]), np.uint8) for name in names
    ]
    seen = np.bincount(np.concatenate(joined), minlength=256)
    common = np.argsort(-seen, kind="stable")[: SYMBOLS - 1]
    common = np.sort(common[seen[common] > 0])
    symbol = np.zeros(256, np.int32)
    symbol[common] = np.arange(1, len(common) + 1)
    coded = [symbol[x].astype(np.int64) for x in joined]
    # After the pad of the next text nothing is counted, so that texts don't run together.
    grams = [x[:-3] << 21 | x[1:-2] << 14 | x[2:-1] << 7 | x[3:] for x in coded]
    for k, name in enumerate(names):
        ends = np.cumsum([len(t) + 3 for t in texts[name]])[:-1]
        inside = np.ones(len(grams[k]), dtype=bool)
        for back in (1, 2, 3):
            inside[ends - back] = False
        grams[k] = grams[k][inside]
    size = SYMBOLS * len(names) * 4
    costs = np.full((1, SYMBOLS, len(names)), np.log2(SYMBOLS))
    row = np.zeros(1, np.int64)  # of each context of the order before, in all orders' rows
    tables = [costs]
    used = 1
    for order in range(4):
        keys = [g & ((1 << 7 * (order + 1)) - 1) for g in grams]
        present = [np.unique(k, return_counts=True) for k in keys]
        contexts, frequency = np.unique(np.concatenate(keys) >> 7, return_counts=True)
        room = max(1, TABLE_BYTES // size - used)
        if len(contexts) > room:
            best = np.argsort(-frequency, kind="stable")[:room]
            contexts = np.sort(contexts[best])
        counts = np.zeros((len(contexts), SYMBOLS, len(names)), np.int32)
        for k, (key, number) in enumerate(present):
            at = np.searchsorted(contexts, key >> 7)
            at[at == len(contexts)] = 0
            kept = contexts[at] == key >> 7
            counts[at[kept], key[kept] & (SYMBOLS - 1), k] = number[kept]
        everything = np.concatenate(tables)
        parent = row[contexts & (len(row) - 1)]
        tables.append(_costs(counts, everything[parent]).astype(np.float32))
        wider = np.tile(row, SYMBOLS if order else 1)
        wider[contexts] = used + np.arange(len(contexts))
        row = wider
        used += len(contexts)
    costs = np.rint(np.concatenate(tables) * POINT).astype(np.int32)
    return Languages(names, symbol, row.astype(np.int32), costs.reshape(-1, len(names)))


def train(docs: DataFrame, per_language: int = PER_LANGUAGE) -> Languages | None:
    """Learns from about ``per_language`` documents a language, chosen by a hash."""
    usable = docs.where(
        F.col("lang").isNotNull()
        & (remainder(FOLDS) != HELD_OUT)
        & F.octet_length("text").between(1, TEXT_BYTES)
    )
    counts = usable.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    part = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / float(1 << 30)
    sample: pd.DataFrame = (
        usable.join(counts, "lang")
        .where(part * F.col("n") < per_language)
        .select("lang", "text", "doc_id")
        .toPandas()
        .sort_values(["lang", "doc_id", "text"])
    )
    return fit({k: [t.encode() for t in v] for k, v in sample.groupby("lang")["text"]})


def _best(model: Languages | None, texts: pa.Array) -> tuple[list[str | None], np.ndarray]:
    """(language, posterior) of each text."""
    if model is None:
        return [None] * len(texts), np.zeros(len(texts))
    bits = model.code_lengths(texts.cast(pa.binary()).to_pylist())
    odds = np.exp2(np.maximum(bits.min(axis=1, keepdims=True) - bits, -1000))
    return [model.names[i] for i in bits.argmin(axis=1)], 1 / odds.sum(axis=1)


def _slices(batches):
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE):
            yield batch.slice(at, SLICE)


def _predictions(model: Languages | None):
    def run(batches):
        for part in _slices(batches):
            names, score = _best(model, part.column(1))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(2), part.column(3),
                 pa.array(names, pa.string()), pa.array(score)],
                names=["doc_id", "held_out", "lettered", "lang_pred", "score"],
            )

    return run


def identified_documents(docs: DataFrame, model: Languages | None) -> DataFrame:
    """The rows of ``docs``, all columns, with a letter and a language likelier than not."""

    def run(batches):
        for part in _slices(batches):
            yield part.filter(pa.array(_best(model, part.column("text"))[1] >= 0.5))

    return docs.where(F.col("text").rlike(r"\p{L}")).mapInArrow(run, docs.schema)


def predict_languages(docs: DataFrame, model: Languages | None) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every row of ``docs`` (doc_id, text, ...)."""
    held_out = F.coalesce(remainder(FOLDS) == HELD_OUT, F.lit(False))
    lettered = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    kind = dict(docs.dtypes)["doc_id"]
    named = F.col("lettered") & F.col("lang_pred").isNotNull()
    return (
        docs.select("doc_id", "text", held_out.alias("held_out"), lettered.alias("lettered"))
        .mapInArrow(
            _predictions(model),
            f"doc_id {kind}, held_out boolean, lettered boolean, lang_pred string, score double",
        )
        .select(
            "doc_id", "held_out",
            F.when(named, F.col("lang_pred")).otherwise("und").alias("lang_pred"),
            F.when(named, F.col("score")).otherwise(0.0).alias("score"),
        )
    )
