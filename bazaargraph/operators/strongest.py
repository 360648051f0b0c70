"""The strongest edges around many seeds, without their neighbourhoods.

The edges within h hops of a node are those at the node and those within h - 1 hops of its
neighbours, and the k strongest of a union are among the k strongest of its parts. So each
node holds k edges, and a hop hands them to its neighbours: rows grow with the edges, not
with the pairs of a seed and an edge. Edges travel as numbers, lower ones for stronger edges.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bazaargraph.functions.columns import named, strongest_first
from bazaargraph.operators.many import ways
from bazaargraph.operators.rank import top_per_group
from bazaargraph.workspace import cut, fits_broadcast, measure


def _numbered(edges: DataFrame, k: int, direction: str) -> DataFrame:
    """(id, _edge, _number): the k strongest edges at each node, stored."""
    row = F.struct(*(named(c) for c in edges.columns)).alias("_edge")
    if direction == "both" and k > 1:
        edges = edges.distinct()
    at = [
        edges.where(F.col(near).isNotNull()).select(F.col(near).alias("id"), row)
        for near, _ in ways(direction)
    ]
    if len(at) == 2:
        # Only a loop is met twice.
        at[1] = at[1].where(~F.col("_edge.src").eqNullSafe(F.col("_edge.dst")))
    order = strongest_first("_edge.")
    best = top_per_group(
        reduce(DataFrame.unionByName, at), ["id"], order, k, spread=["_edge.src", "_edge.dst"]
    )
    in_order = best.repartitionByRange(*order).sortWithinPartitions(*order)
    numbered = in_order.withColumn("_number", F.monotonically_increasing_id())
    if direction == "both" and k > 1:
        # An edge has one number at both its ends.
        same = Window.partitionBy("_edge")
        numbered = numbered.withColumn("_number", F.min("_number").over(same))
    return cut(numbered, "numbered")


def _lowest(rows: DataFrame, k: int) -> DataFrame:
    """The k lowest numbers at each node, each once."""
    if k == 1:
        return rows.groupBy("id").agg(F.min("_number").alias("_number"))
    return top_per_group(rows.distinct(), ["id"], [F.col("_number")], k, spread=["_number"])


def strongest_within(
    seeds: DataFrame, edges: DataFrame, hops: int, k: int, direction: str
) -> DataFrame:
    """``seed_id`` with the k strongest edges within ``hops``, at least one, of each seed."""
    numbered = _numbered(edges, k, direction)
    pairs = edges.select("src", "dst")
    best = numbered.select("id", "_number")
    before = None
    for _ in range(hops - 1):
        rows, size = measure(best, "id")
        held = (rows, best.agg(F.sum(F.col("_number").cast("decimal(20, 0)"))).first()[0])
        if held == before:  # numbers only fall and rows only become more
            break
        before = held
        far_best = F.broadcast(best) if fits_broadcast(size) else best
        handed = [
            pairs.where(F.col(near).isNotNull())
            .join(far_best, F.col(far) == F.col("id"))
            .select(F.col(near).alias("id"), "_number")
            for near, far in ways(direction)
        ]
        best = cut(_lowest(reduce(DataFrame.unionByName, [best, *handed]), k), "best")
    wanted = seeds.select(F.col("id").alias("_seed"))
    return (
        best.join(wanted, F.col("id") == F.col("_seed"), "left_semi")
        .join(numbered.select("_number", "_edge").dropDuplicates(["_number"]), "_number")
        .select(F.col("id").alias("seed_id"), "_edge.*")
    )
