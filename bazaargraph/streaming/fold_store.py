"""The graph fold as a streaming aggregation, kept in Spark's own state store.

A second way to run the fold: Spark holds counts and the last interaction of each edge in
its RocksDB store under the checkpoint and brings them forward batch by batch, exactly once,
restarts included. The state is read as a table through the state data source, without
stopping the stream; nothing else is written. The number of state partitions is that of
``spark.sql.shuffle.partitions`` at the first start.

Against ``GraphState`` it has no snapshots to schedule, but no vertices, raw log or sorted
files either: every read scans all of the state of the last committed batch.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from bazaargraph.operators.build import batch_edges
from bazaargraph.operators.fold import edge_partials, with_score
from bazaargraph.schemas import WEIGHTS
from bazaargraph.streaming.streams import Triggers

PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def start_fold_stream(
    events: DataFrame,
    checkpoint: str,
    weights: Mapping[str, float] = WEIGHTS,
    triggers: Triggers = Triggers(),
) -> StreamingQuery:
    """Fold parsed events into the state under ``checkpoint``.

    The actions of ``weights`` are those counted; a restart must name the same ones, in the
    same order. Events without product or user form edges of a NULL end, as in a batch.
    """
    conf = events.sparkSession.conf
    name = "spark.sql.streaming.stateStore.providerClass"
    before = conf.get(name, None)
    conf.set(name, PROVIDER)
    try:
        # The query keeps the settings it was started with.
        return (
            edge_partials(batch_edges(events), weights)
            .writeStream.outputMode("update")
            .format("noop")
            .option("checkpointLocation", checkpoint)
            .trigger(**triggers.options(triggers.graph))
            .start()
        )
    finally:
        conf.unset(name) if before is None else conf.set(name, before)


def read_fold(
    spark: SparkSession, checkpoint: str, weights: Mapping[str, float] = WEIGHTS
) -> DataFrame:
    """Edge state as of the last committed batch; ``weights`` has the actions of the stream."""
    counts = ", ".join(f"`{action}`: bigint" for action in weights)
    # The store names buffers by their functions, so they are taken by position.
    kept = F.col("value").cast(f"struct<last_interaction: timestamp, {counts}>").alias("kept")
    stored = spark.read.format("statestore").load(checkpoint).select("key.src", "key.dst", kept)
    return with_score(stored.select("src", "dst", "kept.*"), weights)
