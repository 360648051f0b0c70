"""The two streaming queries over one event source."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from bazaargraph.operators.build import build_graph
from bazaargraph.operators.export import keyed_records
from bazaargraph.operators.rank import popular_products
from bazaargraph.operators.windows import latest_windows, window_revenue
from bazaargraph.schemas import windows_schema
from bazaargraph.sources.events import accepted, decode, kafka_stream, parse_events, quarantined
from bazaargraph.streaming.window_table import WindowTable
from bazaargraph.workspace import read_table

OnGraph = Callable[[DataFrame, DataFrame, int], None]


def show_popular_products(vertices: DataFrame, edges: DataFrame, epoch_id: int) -> None:
    """Default handler: print the batch's five products with most events."""
    print(f"batch {epoch_id}: most popular products")
    popular_products(edges).show(truncate=False)


def make_batch_processor(
    on_graph: OnGraph | None = None, quarantine_path: str | None = None
) -> Callable[[DataFrame, int], None]:
    """A foreachBatch function for decoded messages.

    An empty batch is skipped. The batch is kept while it is used more than once.
    """
    handler = on_graph or show_popular_products

    def process(decoded: DataFrame, epoch_id: int) -> None:
        batch = decoded if quarantine_path is not None else decoded.drop("raw")
        batch.persist()
        try:
            if quarantine_path is not None:
                rejected = quarantined(batch).write.mode("overwrite")
                rejected.parquet(f"{quarantine_path}/epoch_id={epoch_id}")
            events = accepted(batch)
            if not events.isEmpty():
                vertices, edges = build_graph(events)
                handler(vertices, edges, epoch_id)
        finally:
            batch.unpersist()

    return process


def kafka_writer(bootstrap: str) -> Callable[[DataFrame, str], None]:
    """Sends rows of key and value to a topic. Needs Spark's Kafka connector."""

    def write(messages: DataFrame, topic: str) -> None:
        writer = messages.write.format("kafka").option("kafka.bootstrap.servers", bootstrap)
        writer.option("topic", topic).save()

    return write


def publish_graph(
    write: Callable[[DataFrame, str], None],
    vertices_topic: str = "graph-vertices",
    edges_topic: str = "graph-edges",
) -> OnGraph:
    """A handler that sends each batch's vertices, keyed by id, and edges, keyed by source.

    Delivery is at least once: a repeated epoch is sent again.
    """

    def publish(vertices: DataFrame, edges: DataFrame, epoch_id: int) -> None:
        write(keyed_records(vertices, "id"), vertices_topic)
        write(keyed_records(edges, "src"), edges_topic)

    return publish


def in_turn(*handlers: OnGraph) -> OnGraph:
    """A handler that calls several, in order; the batch is kept while they run."""

    def handle(vertices: DataFrame, edges: DataFrame, epoch_id: int) -> None:
        for handler in handlers:
            handler(vertices, edges, epoch_id)

    return handle


def write_windows(path: str) -> Callable[[DataFrame, int], None]:
    """A foreachBatch function that keeps the windows changed by each epoch.

    It writes even when nothing changed: a stateful query must read its batch.
    """

    def write(changed: DataFrame, epoch_id: int) -> None:
        changed.write.mode("overwrite").parquet(f"{path}/epoch_id={epoch_id}")

    return write


def read_windows(spark: SparkSession, path: str) -> DataFrame:
    """Current value of every window written by ``write_windows``; none before the first."""
    return latest_windows(read_table(spark, path, windows_schema()))


@dataclass(frozen=True)
class Triggers:
    """Processing-time intervals; ``available_now`` works off what is there and ends."""

    graph: str = "10 seconds"
    windows: str = "30 seconds"
    available_now: bool = False

    def options(self, interval: str) -> dict:
        return {"availableNow": True} if self.available_now else {"processingTime": interval}


def start_graph_stream(
    messages: DataFrame,
    checkpoint: str,
    on_graph: OnGraph | None = None,
    triggers: Triggers = Triggers(),
    quarantine_path: str | None = None,
) -> StreamingQuery:
    """Build each micro-batch's graph and hand it to ``on_graph``."""
    return (
        decode(messages)
        .writeStream.foreachBatch(make_batch_processor(on_graph, quarantine_path))
        .option("checkpointLocation", checkpoint)
        .trigger(**triggers.options(triggers.graph))
        .start()
    )


def start_window_stream(
    events: DataFrame,
    checkpoint: str,
    path: str | WindowTable | None = None,
    triggers: Triggers = Triggers(),
    watermark: str = "1 minute",
    width: str = "1 minute",
    price_scale: int | None = None,
) -> StreamingQuery:
    """Revenue per window and action in update mode, to the console, a folder that keeps
    every epoch's changes, or a table that keeps the current values."""
    if isinstance(path, WindowTable) and path.watermark != watermark:
        raise ValueError(f"the table closes windows by {path.watermark}, the stream by {watermark}")
    windows = window_revenue(events, width, watermark, price_scale)
    writer = windows.writeStream.outputMode("update").option("checkpointLocation", checkpoint)
    if isinstance(path, WindowTable):
        writer = writer.foreachBatch(path.apply)
    elif path is None:
        writer = writer.format("console").option("truncate", "false")
    else:
        writer = writer.foreachBatch(write_windows(path))
    return writer.trigger(**triggers.options(triggers.windows)).start()


def start_streams(
    spark: SparkSession,
    checkpoint_root: str,
    messages: DataFrame | None = None,
    kafka_bootstrap: str = "localhost:9092",
    kafka_topic: str = "marketplace-events",
    on_graph: OnGraph | None = None,
    await_termination: bool = True,
    enable_console: bool = False,
    windows_path: str | WindowTable | None = None,
    quarantine_path: str | None = None,
    triggers: Triggers = Triggers(),
    kafka_options: Mapping[str, str] | None = None,
) -> tuple[StreamingQuery | None, StreamingQuery]:
    """Start (window query or None, graph query), each reading the source itself.

    ``messages`` defaults to the Kafka topic. The checkpoint folder is required:
    with it epoch numbers go on after a restart, which the graph state relies on.
    ``kafka_options`` are further options of that source. The window query runs when
    it has somewhere to go.
    """
    if messages is None:
        messages = kafka_stream(spark, kafka_bootstrap, kafka_topic, **(kafka_options or {}))
    graph = start_graph_stream(
        messages, f"{checkpoint_root}/graph", on_graph, triggers, quarantine_path
    )
    windows = None
    if enable_console or windows_path is not None:
        windows = start_window_stream(
            parse_events(messages), f"{checkpoint_root}/windows", windows_path, triggers
        )
    if await_termination:
        spark.streams.awaitAnyTermination()
    return windows, graph


class LateRows(StreamingQueryListener):
    """Counts the rows that watermarks drop, over all triggers of all queries.

    A query's own progress keeps the last triggers only. Each trigger counts once,
    when its progress is reported, which is shortly after its end.
    """

    def __init__(self) -> None:
        self.dropped: Counter[str] = Counter()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        self.dropped[str(progress.id)] += sum(
            operator.numRowsDroppedByWatermark for operator in progress.stateOperators
        )

    def onQueryTerminated(self, event) -> None:
        pass


def watch_late_rows(spark: SparkSession) -> LateRows:
    """Start counting; to be called before the queries are started."""
    listener = LateRows()
    spark.streams.addListener(listener)
    return listener


def dropped_late_rows(query: StreamingQuery, late: LateRows) -> int:
    """Rows the watermark has dropped since counting began, restarts included."""
    return late.dropped[str(query.id)]
