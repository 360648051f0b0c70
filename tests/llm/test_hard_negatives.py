"""op12: positives and negatives against brute force, and the certified end of a walk."""

from __future__ import annotations

import numpy as np
import pytest

from bazaargraph.llm import hard_negatives

ROWS = "vec_id long, embedding array<float>, label int, score double, id long, raw string"


def clustered(n: int, seed: int, dims: int = 16) -> list[tuple]:
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, dims))
    out = []
    for k in range(n):
        v = centres[k % 6] * rng.uniform(0.5, 1.5) + rng.normal(scale=0.4, size=dims)
        out.append((k * 10, [float(x) for x in v / 4], k % 6 if k % 5 else k % 3, 0.5, 1, "r"))
    return out


def brute(rows: list[tuple]) -> list[tuple]:
    vectors = set()
    for vec_id, vector, label, *_ in rows:
        if vec_id is None or label is None or not vector:
            continue
        if any(x is None or not np.isfinite(x) for x in vector):
            continue
        moved = (label + 1) % 10 if vec_id % 7 == 0 else label
        ints = tuple(int(np.floor(256.0 * float(np.float32(x)))) for x in vector)
        vectors.add((vec_id, moved, ints))
    out = []
    for anchor, label, a in vectors:
        if anchor % 100:
            continue
        scored = [
            (-sum(x * y for x, y in zip(a, b, strict=True)), other, own == label)
            for other, own, b in vectors if other != anchor and len(b) == len(a)
        ]
        scored.sort()
        for p, positive, _ in [s for s in scored if s[2]][:5]:
            fits = [s for s in scored if not s[2] and 80 * -p <= 100 * -s[0] <= 100 * -p][:5]
            out += [(anchor, positive, k, s[1], -p, -s[0]) for k, s in enumerate(fits, 1)]
    return sorted(out)


def mined(df, **sizes) -> list[tuple]:
    columns = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    return sorted(map(tuple, hard_negatives.mine_negatives(df, **sizes).select(*columns).collect()))


@pytest.mark.parametrize("sizes", [{}, {"members": 7, "candidates": 100}])
def test_negatives_equal_brute_force(spark, monkeypatch, sizes):
    monkeypatch.setattr(hard_negatives, "LEAST_MEMBERS", 8)
    rows = clustered(600, 1) + clustered(60, 1)  # the last ones are repeated rows
    found = mined(spark.createDataFrame(rows, ROWS).repartition(3), **sizes)
    assert found == brute(rows) and len(found) > 500


def test_awkward_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = clustered(200, 2)
    rows += [
        (None, [0.5] * 16, 1, 0.5, 1, "r"), (300, None, 1, 0.5, 1, "r"), (400, [], 1, 0.5, 1, "r"),
        (500, [0.5] * 16, None, 0.5, 1, "r"), (700, [nan] + [0.1] * 15, 1, 0.5, 1, "r"),
        (800, [inf] + [0.1] * 15, 1, 0.5, 1, "r"), (801, [None] + [0.1] * 15, 1, 0.5, 1, "r"),
        (900, [0.0] * 16, 1, 0.5, 1, "r"), (901, [0.0] * 16, 2, 0.5, 1, "r"),
        (1000, [0.25, 0.5], 3, 0.5, 1, "r"), (1001, [0.25, 0.5], 3, 0.5, 1, "r"),
        (1002, [0.25, 0.5], 4, 0.5, 1, "r"), (1003, [200.0, 0.0], 3, 0.5, 1, "r"),
        (1004, [1e9, -1.0], 4, 0.5, 1, "r"),
    ]
    assert mined(spark.createDataFrame(rows, ROWS)) == brute(rows)
    assert mined(spark.createDataFrame([], ROWS)) == []
    assert mined(spark.createDataFrame([(1, [0.5], 1, 0.5, 1, "r")], ROWS)) == []


def test_ties_go_to_smaller_ids(spark):
    rows = [(k, [0.5, 0.5], int(k % 3 == 1), 0.5, 1, "r") for k in range(0, 300, 4)]
    assert mined(spark.createDataFrame(rows, ROWS)) == brute(rows)


def test_a_walk_ends_before_its_list():
    rng = np.random.default_rng(3)
    rows = rng.integers(-200, 200, size=(4000, 8))
    rows[:200] = np.abs(rows[:200])
    asked = np.full((1, 8), 100) + rng.integers(-5, 5, size=(20, 8))

    def sided(vectors, label, first):
        return {
            "vector": vectors, "norm": np.linalg.norm(vectors, axis=1),
            "id": np.arange(len(vectors)) + first, "label": np.full(len(vectors), label),
            "low": np.full(len(vectors), hard_negatives.LOWEST),
            "high": np.full(len(vectors), hard_negatives.HIGHEST),
        }

    centroid = hard_negatives.fit_centroids(asked, 1)[0]
    best, scored = hard_negatives.walk(
        sided(asked, 1, 9000), sided(rows, 1, 0), centroid, True, 5, step=2000
    )
    assert 0 < scored < 1500
    exact = asked @ rows.T
    for member in range(len(asked)):
        order = np.lexsort((np.arange(4000), -exact[member]))[:5]
        assert best.id[best.member == member].tolist() == order.tolist()


def test_scores_are_exact_or_clipped():
    a = np.array([[2**40, 1], [3, 4]])
    assert hard_negatives.scores(a, np.array([[2**20, 5]])).ravel().tolist() == [2**60 + 5, 3 * 2**20 + 20]
    assert hard_negatives.scores(a, a)[0, 0] == hard_negatives.HIGHEST
