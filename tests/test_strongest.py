"""The strongest edges of many ego graphs."""

import pytest
from pyspark.sql import functions as F

from bazaargraph.functions.columns import strongest_first
from bazaargraph.operators import lookup, many, rank, strongest, traverse
from fixtures import at, rows

EDGE = "src string, dst string, score double, last_interaction timestamp, AIME long"


@pytest.fixture(scope="module")
def edges(spark):
    """A hub, a chain, a loop, ties, repeated rows and missing ends and times."""
    made = [(f"u{i}", "p0", float(i % 3), at(i) if i % 4 else None, i) for i in range(12)]
    made += [(f"u{i}", f"p{i % 5 + 1}", float(i % 4), at(i % 2), 1) for i in range(12)]
    made += [(f"c{i}", f"c{i + 1}", float(9 - i), None, 1) for i in range(6)]
    made += [("x", "x", 7.0, at(1), 1), ("x", "u1", 2.0, at(1), 1)]
    made += [(None, "p0", 8.0, at(1), 1), ("u3", None, 9.0, at(1), 1), (None, None, 9.0, None, 1)]
    made += [("u1", "p0", 1.0, at(1), 1), ("u2", "p0", 2.0, at(2), 2), ("x", "x", 7.0, at(1), 1)]
    return spark.createDataFrame(made, EDGE).cache()


def by_walk(seeds, edges, hops, k, direction):
    numbered = many.number_seeds(seeds)
    seen = many.reach(numbered, edges.select("src", "dst"), hops - 1, direction)
    found = many.per_seed(many.masked_edges(seen, edges, direction), numbered)
    return rank.top_per_group(found, ["seed_id"], strongest_first(), k, spread=["src", "dst"])


@pytest.mark.parametrize("direction", ["both", "out", "in"])
@pytest.mark.parametrize(("hops", "k"), [(2, 1), (3, 1), (2, 3), (5, 4), (2, 100), (2, 0)])
def test_same_as_cutting_each_neighbourhood(spark, edges, direction, hops, k):
    seeds = lookup.endpoint_ids(edges)
    found = strongest.strongest_within(seeds, edges, hops, k, direction)
    assert found.columns == ["seed_id", *edges.columns]
    assert rows(found) == rows(by_walk(seeds, edges, hops, k, direction))


@pytest.mark.parametrize("join", ["broadcast", "shuffle"])
def test_only_given_seeds_and_any_join(spark, edges, join, monkeypatch):
    if join == "shuffle":
        monkeypatch.setattr(strongest, "fits_broadcast", lambda size: False)
    seeds = spark.createDataFrame([("u1",), ("c0",), ("nobody",), (None,), ("u1",)], "id string")
    found = strongest.strongest_within(seeds, edges, 3, 2, "both")
    assert {r[0] for r in rows(found)} == {"u1", "c0"}
    assert rows(found) == rows(by_walk(seeds, edges, 3, 2, "both"))


def test_negative_cap_is_an_error(spark, edges):
    vertices = lookup.endpoint_ids(edges).withColumn("type", F.lit("t"))
    with pytest.raises(ValueError, match="negative"):
        traverse.ego_per_seed(vertices, edges, vertices, hops=2, max_edges=-1)


def test_best_of_many_seeds_makes_no_pairs(spark, monkeypatch):
    """A dense graph, in which each seed sees all edges: no walk, one row a node in storage."""
    edges = spark.range(40 * 30).selectExpr(
        "concat('u', id div 30) AS src", "concat('p', id % 30) AS dst",
        "cast(hash(id) % 7 AS double) AS score", "timestamp_seconds(id) AS last_interaction",
    )
    vertices = lookup.endpoint_ids(edges).withColumn("type", F.lit("t"))
    stored = []

    def counted(df, label):
        table = cut(df, label)
        stored.append(table.count())
        return table

    cut = strongest.cut
    monkeypatch.setattr(strongest, "cut", counted)
    monkeypatch.setattr(many, "cut", counted)
    found, reached = traverse.ego_per_seed(
        vertices, edges, vertices, hops=2, max_edges=1, with_vertices=False
    )
    assert reached is None
    assert rows(found) == rows(by_walk(vertices, edges, 2, 1, "both")) and found.count() == 70
    assert stored[:2] == [70, 70]
    both = traverse.ego_per_seed(vertices, edges, vertices, hops=2, max_edges=1)
    assert rows(both[0]) == rows(found) and both[1].count() == 70 * 70
