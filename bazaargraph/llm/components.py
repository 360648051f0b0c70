"""Connected components of a stored edge table, by alternating stars.

Each round makes every node's neighbours point at the smallest of them (large
star), then at the smallest node they point at themselves (small star), until all
components are stars around their smallest node. Minima are taken before the
shuffle, joins with a hub are split by the adaptive skew join, and every round
ends in a table in the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaargraph.workspace import cut

ROUNDS = 60  # far above the logarithm of any node count; reaching it is an error


def _state(edges: DataFrame) -> tuple:
    total = F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))
    return tuple(edges.agg(F.count(F.lit(1)), total).first())


def connected_components(edges: DataFrame, label: str = "components") -> DataFrame:
    """(node, component) of every node that has an edge in ``edges`` (a, b).

    The component is its smallest node. Loops, repeated edges and edges with a
    null end are ignored.
    """
    current = cut(
        edges.where("a is not null and b is not null and a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        label,
    )
    before = _state(current)
    for _ in range(ROUNDS):
        if not before[0]:
            break
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("low"))
        low = low.select("a", F.least("a", "low").alias("low"))
        large = (
            both.join(low, "a")
            .where("b > a")
            .select(F.col("b").alias("a"), F.col("low").alias("b"))
            .where("a <> b")
            .distinct()
        )
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        moved = large.join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        small = low.select("a", F.col("low").alias("b")).unionByName(moved)
        current = cut(small.where("a <> b").distinct(), label)
        after = _state(current)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError("the components did not settle")
    roots = current.select(F.col("b").alias("node")).distinct().select(
        "node", F.col("node").alias("component")
    )
    return current.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        roots
    )
