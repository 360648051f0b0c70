"""Small tables with the awkward rows that every operator has to answer."""

from __future__ import annotations

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, token string"


def words(seed: int, count: int) -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choices("abcdefgh", k=rng.randint(2, 7))) for _ in range(count))


def awkward() -> list[tuple]:
    """Nulls in any column, empty and long texts, ties and repeated rows; clashing columns."""
    long = words(5, 4000)
    near = long.split()
    near[10] = "other"
    texts = [
        (0, words(1, 60)), (1, words(1, 60)), (1, words(1, 60)), (2, None), (3, ""), (4, " \t\n "),
        (5, "one two"), (6, "ONE two"), (7, long), (8, " ".join(near)), (9, words(2, 30) + " scum"),
        (10, "x" * 300_000), (11, "CC BY all rights reserved général 日本 🎉"), (12, "!!! ???"),
        (None, words(1, 60)), (None, None),
    ]
    return [
        (i, t, None if k % 3 else "en", None if k % 4 == 0 else f"s{k % 3}", None, 0.5, "t")
        for k, (i, t) in enumerate(texts)
    ]


def frame(spark, rows=None):
    return spark.createDataFrame(awkward() if rows is None else rows, DOCS)
