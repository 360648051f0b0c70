"""Ids, search and counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def endpoint_ids(edges: DataFrame) -> DataFrame:
    """Distinct ids at either end of the edges, from one scan."""
    ends = F.explode(F.array("src", "dst")).alias("id")
    return edges.select(ends).distinct()


def vertices_of(vertices: DataFrame, ids: DataFrame) -> DataFrame:
    """The vertices among ``ids``; ids without a vertex row fall away."""
    wanted = ids.select(F.col("id").alias("_id"))
    return vertices.join(wanted, F.col("id") == F.col("_id"), "left_semi")


def search_ids(vertices: DataFrame, query: str, limit: int = 20) -> DataFrame:
    """The first vertices, by id, whose id starts with the query in any case."""
    prefix = query.strip().lower()
    hits = vertices.select("id", "type")
    if not prefix:
        return hits.limit(0)
    return hits.filter(F.lower("id").startswith(prefix)).orderBy("id").limit(limit)


def graph_stats(
    edges: DataFrame, vertices: DataFrame, batch_count: int, last_epoch_id: int
) -> DataFrame:
    """One row: number of vertices and edges, batches applied, last epoch."""
    one, none = F.lit(1), F.lit(0)
    marks = vertices.select(one.alias("v"), none.alias("e")).union(
        edges.select(none.alias("v"), one.alias("e"))
    )
    return marks.agg(
        F.coalesce(F.sum("v"), F.lit(0)).alias("vertices"),
        F.coalesce(F.sum("e"), F.lit(0)).alias("edges"),
    ).select(
        "vertices",
        "edges",
        F.lit(batch_count).cast("long").alias("batch_count"),
        F.lit(last_epoch_id).cast("long").alias("last_epoch_id"),
    )
