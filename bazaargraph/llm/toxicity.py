"""Toxic spans and document scores by a linear-chain conditional random field.

The field has two states, plain and toxic, and emission weights for words and for
their first bytes, which catch inflected forms. Labels are known for documents only,
so the tokens it learns from are labelled first: in a toxic document, words are toxic
if they, or their beginnings, are far more common in toxic documents. Maximum
likelihood by gradient steps uses forward-backward marginals.

For scoring, the recursions of all documents of a batch run together: a step maps
the ratio of the two states' weights by a 2x2 matrix, so blocks of steps are
composed first and then filled in, and a document of any length costs no more per
word. A document's score is a logistic function of its largest marginal and of its
expected number of toxic words; spans of words with a marginal of at least one half
are returned as byte offsets of the UTF-8 text.

Null and empty texts and texts without words have no spans and get the score of a
document without toxic words. Without labelled documents of both classes all scores
are 0. Every row is answered by itself.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaargraph.llm.shingles import WordHasher, words_of
from bazaargraph.llm.training import labelled_sample, remainder

PER_CLASS = 1_000  # documents of each class that are learnt from, at most
THRESHOLD = 0.7
FOLDS, HELD_OUT = 3, 1
RATIO = 8.0  # a toxic word's share of toxic documents against that of others
SEEN = 3  # documents that a feature stands in
SURPRISE = 3.5  # standard deviations that its toxic documents exceed chance by
PREFIXES = (4, 5)  # leading bytes of a word that are features, too
STEPS = 40
RATE = 0.3
DECAY = 1e-4
SLICE = 500
SPANS = "array<struct<start:long,end:long>>"

# Bytes between words: ASCII other than letters and digits.
SEPARATORS = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])


def ratios(a: np.ndarray, b: np.ndarray, c: np.ndarray, d: np.ndarray) -> np.ndarray:
    """All r[t] = (a[t] r[t-1] + b[t]) / (c[t] r[t-1] + d[t]), from r[-1] = 0."""
    steps, width = len(a), 64
    if steps <= 4 * width:
        r, out = 0.0, np.empty(steps)
        for t, (p, q, u, v) in enumerate(zip(*(x.tolist() for x in (a, b, c, d)), strict=True)):
            r = (p * r + q) / (u * r + v)
            out[t] = r
        return out
    rows = -(-steps // width)
    a, b, c, d = (
        np.append(x, np.full(rows * width - steps, fill)).reshape(rows, width).T.copy()
        for x, fill in ((a, 1.0), (b, 0.0), (c, 0.0), (d, 1.0))
    )
    p, q, u, v = a[0], b[0], c[0], d[0]
    for k in range(1, width):
        p, q, u, v = (
            a[k] * p + b[k] * u, a[k] * q + b[k] * v, c[k] * p + d[k] * u, c[k] * q + d[k] * v
        )
        scale = 1 / (p + q + u + v)
        p, q, u, v = p * scale, q * scale, u * scale, v * scale
    r = np.append(0.0, ratios(p, q, u, v)[:-1])
    out = np.empty((width, rows))
    for k in range(width):
        r = (a[k] * r + b[k]) / (c[k] * r + d[k])
        out[k] = r
    return out.T.ravel()[:steps]


@dataclass
class Field:
    words: np.ndarray  # sorted hashes of the features
    emission: np.ndarray  # a weight for each feature, then 0 for all others
    bias: float
    transition: np.ndarray  # [from, to]
    start: float
    combine: np.ndarray  # bias, weight of the largest marginal's logit, of the expected number

    def index(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.words):
            return np.zeros(hashes.shape, np.int64)
        at = np.searchsorted(self.words, hashes)
        at[at == len(self.words)] = 0
        return np.where(self.words[at] == hashes, at, len(self.words))

    def chains(self, index: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, ...]:
        """(forward ratio, backward ratio, emission ratio) of each word."""
        e = np.exp(np.clip(self.emission[index].sum(axis=1) + self.bias, -30, 30))
        t = np.exp(self.transition)
        s = np.exp(self.start)
        one = np.ones(len(e))
        r = ratios(
            np.where(first, e * s, e * t[1, 1]), np.where(first, e * s, e * t[0, 1]),
            np.where(first, one, t[1, 0]), np.where(first, one, t[0, 0]),
        )
        last = np.append(first[1:], True)[::-1]
        after = np.append(e[1:], 1.0)[::-1]
        b = ratios(
            np.where(last, one, t[1, 1] * after), np.where(last, one, t[1, 0]),
            np.where(last, one, t[0, 1] * after), np.where(last, one, t[0, 0]),
        )[::-1]
        return r, b, e

    def marginals(self, index: np.ndarray, first: np.ndarray) -> np.ndarray:
        r, b, _ = self.chains(index, first)
        return r * b / (1 + r * b)

    def features(self, marginals: np.ndarray, owner: np.ndarray, docs: int) -> np.ndarray:
        largest = np.full(docs, 1e-9)
        np.maximum.at(largest, owner, marginals)
        largest = np.minimum(largest, 1 - 1e-9)
        expected = np.bincount(owner, weights=marginals * (marginals > 0.01), minlength=docs)
        return np.stack(
            [np.ones(docs), np.log(largest / (1 - largest)) / 10, np.log1p(expected)], axis=1
        )


def _joined(found: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hashes, whether a word is its document's first, document number) of all words."""
    sizes = np.array([len(w[0]) for w in found], dtype=np.int64)
    hashes = np.concatenate([w[0] for w in found])
    first = np.zeros(len(hashes), dtype=bool)
    first[(np.cumsum(sizes) - sizes)[sizes > 0]] = True
    return hashes, first, np.repeat(np.arange(len(found)), sizes)


def logistic(features: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Weights of a lightly penalised logistic regression, by Newton steps."""
    weights = np.zeros(features.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(features @ weights, -30, 30)))
        gradient = features.T @ (p - labels) + 0.1 * weights
        curve = (features * (p * (1 - p))[:, None]).T @ features + 0.1 * np.eye(len(weights))
        weights -= np.linalg.solve(curve, gradient)
    return weights


def fit(texts: list[bytes], labels: np.ndarray) -> Field | None:
    if len(set(labels.tolist())) < 2:
        return None
    hashes, first, owner = _joined(words_of(texts, WordHasher(SEPARATORS, PREFIXES)))
    words, index = np.unique(hashes, return_inverse=True)
    index = index.reshape(hashes.shape)
    pairs = np.unique(owner[:, None] * len(words) + index)
    toxic_doc = labels[pairs // len(words)] == 1
    in_toxic = np.bincount(pairs[toxic_doc] % len(words), minlength=len(words))
    in_plain = np.bincount(pairs[~toxic_doc] % len(words), minlength=len(words))
    toxic = labels == 1
    share, other = (in_toxic + 0.1) / toxic.sum(), (in_plain + 0.1) / (~toxic).sum()
    chance = (in_toxic + in_plain) * toxic.mean()
    # No least share of all toxic documents: a small language's words stand in few of them.
    telling = (in_toxic >= SEEN) & (share >= RATIO * other) & (words > 0)
    telling &= in_toxic - chance >= SURPRISE * np.sqrt(chance + 1)
    truth = (telling[index].any(axis=1) & toxic[owner]).astype(float)
    known = (in_toxic + in_plain >= SEEN) & (words > 0)
    size = known.sum() + 1
    place = np.full(len(words), size - 1)
    place[known] = np.arange(size - 1)
    index = place[index]
    flat, repeat = index.ravel(), index.shape[1]
    total = np.bincount(flat, minlength=size).astype(float)
    target = np.bincount(flat, weights=np.repeat(truth, repeat), minlength=size)
    odds = np.log((truth.sum() + 0.1) / (len(truth) - truth.sum() + 1))
    field = Field(words[known], np.zeros(size), odds, np.zeros((2, 2)), 0.0, np.zeros(3))
    field.emission = (np.log((target + 0.1) / (total - target + 1)) - odds) / repeat
    field.emission[-1] = 0
    inner = np.flatnonzero(~first)
    for step in range(STEPS):
        r, b, e = field.chains(index, first)
        p = r * b / (1 + r * b)
        expected = np.bincount(flat, weights=np.repeat(p, repeat), minlength=size)
        rate = RATE * (1 - step / STEPS)
        field.emission += rate * ((target - expected) / np.sqrt(total + 1) - DECAY * field.emission)
        field.emission[-1] = 0
        field.bias += rate * (truth.sum() - p.sum()) / (truth.sum() + 1)
        field.start += rate * (truth[first] - p[first]).mean()
        before, weight = r[inner - 1], e[inner] * b[inner]
        t = np.exp(field.transition)
        mass = np.array([[t[0, 0] * np.ones(len(inner)), t[0, 1] * weight],
                         [t[1, 0] * before, t[1, 1] * before * weight]])
        mass = (mass / mass.sum(axis=(0, 1))).sum(axis=2)
        was, now = truth[inner - 1], truth[inner]
        seen = np.array([[((1 - was) * (1 - now)).sum(), ((1 - was) * now).sum()],
                         [(was * (1 - now)).sum(), (was * now).sum()]])
        field.transition += rate * (seen - mass) / np.sqrt(seen + mass + 1) / 10
        field.transition = np.clip(field.transition, -10, 10)
    features = field.features(field.marginals(index, first), owner, len(texts))
    field.combine = logistic(features, labels.astype(float))
    return field


def _spans(marginals: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[dict]:
    edges = np.flatnonzero(np.diff(marginals >= 0.5, prepend=False, append=False))
    return [
        {"start": int(starts[i]), "end": int(ends[j - 1])}
        for i, j in zip(edges[::2], edges[1::2], strict=True)
    ]


def score_texts(field: Field | None, texts: list[bytes | None], hasher: WordHasher):
    """(score, spans) of each text."""
    if field is None:
        return np.zeros(len(texts)), [[] for _ in texts]
    found = words_of(texts, hasher)
    hashes, first, owner = _joined(found)
    marginals = field.marginals(field.index(hashes), first)
    logits = field.features(marginals, owner, len(texts)) @ field.combine
    cuts = np.cumsum([len(w[0]) for w in found])[:-1]
    spans = [
        _spans(m, w[1], w[2]) if len(m) and m.max() >= 0.5 else []
        for m, w in zip(np.split(marginals, cuts), found, strict=True)
    ]
    return 1 / (1 + np.exp(-np.clip(logits, -40, 40))), spans


def _scores(field: Field | None):
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(batches):
        hasher = WordHasher(SEPARATORS, PREFIXES)
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                texts = part.column(1).cast(pa.binary()).to_pylist()
                score, spans = score_texts(field, texts, hasher)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(2), pa.array(score), pa.array(spans, kind)],
                    names=["doc_id", "held_out", "score", "spans"],
                )

    return run


def train(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> Field | None:
    sample = labelled_sample(docs, labels, "toxic", remainder(FOLDS) != HELD_OUT, per_class)
    return fit([t.encode() for t in sample["text"]], sample["label"].to_numpy())


def score_toxicity(docs: DataFrame, field: Field | None) -> DataFrame:
    """(doc_id, held_out, score, predicted, spans) of every row of ``docs``."""
    held_out = F.coalesce(remainder(FOLDS) == HELD_OUT, F.lit(False))
    kinds = f"doc_id {dict(docs.dtypes)['doc_id']}, held_out boolean, score double, spans {SPANS}"
    return (
        docs.select("doc_id", "text", held_out.alias("held_out"))
        .mapInArrow(_scores(field), kinds)
        .select(
            "doc_id", "held_out", "score",
            (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "spans",
        )
    )
