"""Folding edges and vertices into graph state.

All merges are sums, maxima and a max-by on the epoch. They may be regrouped and
reordered freely, so splitting events into batches never changes the state.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaargraph.functions.columns import named, role_rank, score
from bazaargraph.schemas import WEIGHTS

RAW_EDGE_KEY = ("src", "dst", "relationship", "timestamp", "epoch_id")
RAW_VERTEX_KEY = ("id", "type", "epoch_id")


def edge_partials(
    edges: DataFrame,
    weights: Mapping[str, float] = WEIGHTS,
    by: Sequence[str] = (),
) -> DataFrame:
    """Counts per action and last interaction per edge (and per ``by``).

    Every row counts, equal rows too. Rows of an action without weight are left out.
    """
    return (
        edges.filter(F.col("relationship").isin(*weights))
        .groupBy(*by, "src", "dst")
        .agg(
            F.max("timestamp").alias("last_interaction"),
            *(F.count_if(F.col("relationship") == a).alias(a) for a in weights),
        )
    )


def merge_edge_partials(
    partials: DataFrame, weights: Mapping[str, float] = WEIGHTS
) -> DataFrame:
    """One row per edge from any number of partial rows."""
    return partials.groupBy("src", "dst").agg(
        F.max("last_interaction").alias("last_interaction"),
        *(F.sum(F.coalesce(named(a), F.lit(0))).alias(a) for a in weights),
    )


def with_score(partials: DataFrame, weights: Mapping[str, float] = WEIGHTS) -> DataFrame:
    """Edge state columns; the score always follows from the counts."""
    return partials.select(
        "src",
        "dst",
        score(weights).alias("score"),
        "last_interaction",
        *(named(a) for a in weights),
    )


def edge_state(edges: DataFrame, weights: Mapping[str, float] = WEIGHTS) -> DataFrame:
    """Edge state of one set of edges."""
    return with_score(edge_partials(edges, weights), weights)


def merged_edge_state(
    partials: DataFrame, weights: Mapping[str, float] = WEIGHTS
) -> DataFrame:
    """Edge state of partials from several epochs."""
    return with_score(merge_edge_partials(partials, weights), weights)


def latest_vertices(vertices: DataFrame) -> DataFrame:
    """``id, type, epoch_id`` of the last epoch that mentions each id.

    Two types in one epoch are settled by the order of ``ROLES``.
    """
    order = F.struct(F.col("epoch_id"), -role_rank())
    return vertices.groupBy("id").agg(
        F.max_by("type", order).alias("type"), F.max("epoch_id").alias("epoch_id")
    )


def vertex_state(vertices: DataFrame) -> DataFrame:
    """Vertex state: the type of the last epoch wins."""
    return latest_vertices(vertices).select("id", "type")


def distinct_raw_edges(raw: DataFrame) -> DataFrame:
    """One row per raw edge key; among different prices the lowest stays."""
    return (
        raw.groupBy(*RAW_EDGE_KEY)
        .agg(F.min("price").alias("price"))
        .select("src", "dst", "relationship", "timestamp", "price", "epoch_id")
    )


def distinct_raw_vertices(raw: DataFrame) -> DataFrame:
    return raw.select(*RAW_VERTEX_KEY).distinct()


def since_epoch(raw: DataFrame, last_epoch_id: int) -> DataFrame:
    """Raw rows after a snapshot; everything when there is none (negative epoch)."""
    if last_epoch_id < 0:
        return raw
    return raw.filter(F.col("epoch_id") > F.lit(last_epoch_id))


def replay_raw(
    raw_edges: DataFrame,
    raw_vertices: DataFrame,
    last_epoch_id: int = -1,
    weights: Mapping[str, float] = WEIGHTS,
) -> tuple[DataFrame, DataFrame]:
    """(edge partials, vertices) of the deduplicated raw log after an epoch.

    The epoch filter comes first, so it prunes the log's partitions.
    """
    edges = distinct_raw_edges(since_epoch(raw_edges, last_epoch_id))
    vertices = distinct_raw_vertices(since_epoch(raw_vertices, last_epoch_id))
    return edge_partials(edges, weights), latest_vertices(vertices)
