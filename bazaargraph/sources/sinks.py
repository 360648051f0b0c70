"""Raw log and message sinks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

from bazaargraph.operators.build import raw_edges, raw_vertices
from bazaargraph.operators.export import keyed_records


def _replace_epochs(df: DataFrame, path: str, epoch_id: int | Column) -> None:
    if isinstance(epoch_id, Column):
        # Any task may hold rows of many epochs. Bringing an epoch's rows together
        # keeps it to few files; the rebalance splits an epoch that is large.
        df = df.hint("rebalance", "epoch_id")
    # Only the epochs in ``df`` are replaced, so a repeated write changes nothing.
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("epoch_id")
        .parquet(path)
    )


def append_raw_edges(edges: DataFrame, path: str, epoch_id: int | Column) -> None:
    _replace_epochs(raw_edges(edges, epoch_id), path, epoch_id)


def append_raw_vertices(vertices: DataFrame, path: str, epoch_id: int | Column) -> None:
    _replace_epochs(raw_vertices(vertices, epoch_id), path, epoch_id)


def publish(df: DataFrame, key: str, bootstrap: str, topic: str) -> None:
    """Send rows as keyed JSON messages. Needs Spark's Kafka connector."""
    (
        keyed_records(df, key)
        .write.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap)
        .option("topic", topic)
        .save()
    )
