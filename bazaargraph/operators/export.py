"""Graph records for consumers outside Spark."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaargraph.functions.columns import edge_key, named, node_label
from bazaargraph.schemas import WEIGHTS

# Microseconds are kept; the writer's default stops at milliseconds.
JSON_OPTIONS = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def node_records(vertices: DataFrame) -> DataFrame:
    """Nodes with ``id``, ``label`` and every vertex column."""
    rest = [named(c) for c in vertices.columns if c not in ("id", "label")]
    label = F.col("label") if "label" in vertices.columns else node_label().alias("label")
    return vertices.select("id", label, *rest)


def link_records(
    edges: DataFrame, weights: Mapping[str, float] = WEIGHTS
) -> DataFrame:
    """Links with ``id, source, target, score``, the whole row as ``data``, and counts."""
    value = F.col("score").cast("double") if "score" in edges.columns else F.lit(None)
    return edges.select(
        edge_key(edges.columns).alias("id"),
        F.col("src").alias("source"),
        F.col("dst").alias("target"),
        F.coalesce(value, F.lit(0.0)).alias("score"),
        F.struct(*(named(c) for c in edges.columns)).alias("data"),
        *(named(a) for a in weights if a in edges.columns),
    )


def write_node_link(
    edges: DataFrame,
    vertices: DataFrame,
    path: str,
    weights: Mapping[str, float] = WEIGHTS,
) -> None:
    """Write ``nodes`` and ``links`` as JSON lines, each task its own rows."""
    for name, records in (
        ("nodes", node_records(vertices)),
        ("links", link_records(edges, weights)),
    ):
        records.write.mode("overwrite").options(**JSON_OPTIONS).json(f"{path}/{name}")


def keyed_records(df: DataFrame, key: str) -> DataFrame:
    """``key`` and ``value`` text columns: one JSON message per row."""
    body = F.struct(*(named(c) for c in df.columns))
    return df.select(
        named(key).cast("string").alias("key"),
        F.to_json(body, JSON_OPTIONS).alias("value"),
    )
