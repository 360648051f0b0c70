"""Ranked reports over edges."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bazaargraph.functions.columns import named, strongest_first
from bazaargraph.operators.lookup import endpoint_ids, vertices_of
from bazaargraph.schemas import WEIGHTS


def _check(k: int) -> int:
    if k < 0:
        raise ValueError(f"the number of rows must not be negative: {k}")
    return k


def top_edges(
    edges: DataFrame, k: int, pinned: tuple[str, str] | None = None
) -> DataFrame:
    """The k strongest edges; a ``pinned`` (src, dst) comes before all others.

    Each partition keeps its own k rows, so nothing is sorted as a whole.
    """
    order = strongest_first()
    if pinned is not None:
        chosen = (F.col("src") == pinned[0]) & (F.col("dst") == pinned[1])
        order = [F.when(chosen, 0).otherwise(1), *order]
    return edges.orderBy(*order).limit(_check(k))


def top_per_group(
    df: DataFrame, group: Sequence[str], order: Sequence[Column], k: int, spread: Sequence[str]
) -> DataFrame:
    """The first k rows of every group, also when one group holds most rows.

    Up to a limit on k, Spark keeps only k rows of a group in each task before it
    shuffles. Beyond it, groups are first cut into slices by a hash of the
    ``spread`` columns: the best k of each slice contain the best k of the group.
    Either way no task has to sort a whole group.
    """
    _check(k)
    conf = df.sparkSession.conf
    columns = df.columns
    if k > int(conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000")):
        slices = int(conf.get("spark.sql.shuffle.partitions"))
        piece = F.pmod(F.xxhash64(*spread), F.lit(slices))
        df = _first_rows(df.withColumn("_slice", piece), [*group, "_slice"], order, k)
    return _first_rows(df, group, order, k).select(columns)


def _first_rows(
    df: DataFrame, group: Sequence[str], order: Sequence[Column], k: int
) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
    return df.withColumn("_rank", rank).filter(F.col("_rank") <= k).drop("_rank")


def best_edges(
    edges: DataFrame,
    vertices: DataFrame,
    limit: int = 100,
    weights: Mapping[str, float] = WEIGHTS,
) -> tuple[DataFrame, DataFrame]:
    """The strongest edges of the graph and the vertices they touch."""
    narrow = edges.select(
        "src", "dst", "score", *(named(a) for a in weights), "last_interaction"
    )
    best = top_edges(narrow, limit)
    return best, vertices_of(vertices, endpoint_ids(best))


def in_degrees(edges: DataFrame) -> DataFrame:
    """Incoming edges per node. Parallel edges and all actions count."""
    return edges.groupBy(F.col("dst").alias("id")).agg(
        F.count(F.lit(1)).alias("inDegree")
    )


def popular_products(edges: DataFrame, k: int = 5) -> DataFrame:
    """The k nodes with most incoming edges."""
    return in_degrees(edges).orderBy(F.col("inDegree").desc(), "id").limit(_check(k))
