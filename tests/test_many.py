"""Walks from many seeds as bits."""

import pytest
from pyspark.sql import functions as F

from bazaargraph.operators import build, fold, lookup, many, traverse
from bazaargraph.sources import warehouse
from fixtures import rows

EDGE = "src string, dst string, score double, last_interaction timestamp, AIME long"


def random_edges(spark, n=400):
    number = F.col("id")
    return spark.range(n).select(
        F.concat(F.lit("u"), F.pmod(F.hash(number), F.lit(60)).cast("string")).alias("src"),
        F.when(number % 3 == 0, "p0")
        .otherwise(F.concat(F.lit("p"), F.pmod(F.hash(number, number), F.lit(90)).cast("string")))
        .alias("dst"),
    ).distinct().select(
        "src", "dst", F.length("dst").cast("double").alias("score"),
        F.lit(None).cast("timestamp").alias("last_interaction"), F.lit(1).cast("long").alias("AIME"),
    )


@pytest.mark.parametrize("direction", ["both", "out", "in"])
@pytest.mark.parametrize("hops", [2, 3])
def test_each_seed_has_its_own_walk(spark, direction, hops):
    edges = random_edges(spark).cache()
    extra = [("x", "x", 1.0, None, 1), ("x", "p0", 2.0, None, 1), (None, "p0", 1.0, None, 1)]
    edges = edges.unionByName(spark.createDataFrame(extra, EDGE))
    vertices = lookup.endpoint_ids(edges).where("id is not null").withColumn("type", F.lit("t"))
    found, reached = traverse.ego_per_seed(vertices, edges, vertices, hops, 2.0, direction)
    found, reached = rows(found), rows(reached)
    for seed in ("u1", "p0", "p7", "x"):
        one, nodes = traverse.node_neighbors(seed, edges, vertices, hops, 2.0, direction)
        assert [r[1:] for r in found if r[0] == seed] == rows(one)
        assert [r[1:] for r in reached if r[0] == seed] == rows(nodes)


def test_numbers_are_distinct_and_few_blocks(spark):
    seeds = spark.range(3000).select(F.concat(F.lit("n"), "id").alias("id"))
    numbered = many.number_seeds(seeds.unionByName(seeds))
    assert numbered.count() == 3000 == numbered.select("_block", "_bit").distinct().count()
    assert numbered.agg(F.max("_bit")).first()[0] < many.BITS
    assert numbered.select("_block").distinct().count() <= 24
    assert many.number_seeds(seeds.limit(0)).isEmpty()


def test_rows_stand_for_a_hundred_pairs(spark):
    vertices, edges = build.build_graph(warehouse.graph_events(spark, "/root/testdata/sf0.01"))
    numbered = many.number_seeds(vertices)
    pairs = fold.edge_state(edges).select("src", "dst")
    seen = many.reach(numbered, pairs, 3, "both")
    assert seen.count() * 100 < many.per_seed(seen, numbered).count()
