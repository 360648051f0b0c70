"""Streams give what the same events give as a table."""

import os
import time

import pytest
from pyspark.errors import AnalysisException

from bazaargraph.operators import build, fold
from bazaargraph.operators.windows import window_revenue
from bazaargraph.sources import events as sources
from bazaargraph.streaming import streams
from bazaargraph.streaming.state import GraphState
from fixtures import FOLD, FOLD_EDGES, FOLD_VERTICES, at, message, messages, rows

NOW = streams.Triggers(available_now=True)


class Inbox:
    """A folder that receives files of messages, and a stream's folders beside it."""

    def __init__(self, spark, tmp_path):
        self.spark = spark
        self.root = str(tmp_path)
        (tmp_path / "in").mkdir()
        self.folder = tmp_path / "in"
        self.count = 0

    def put(self, texts):
        file = self.folder / f"{self.count:03}.json"
        file.write_text("\n".join(texts) + "\n")
        # Files are taken in the order of their times; these are a second apart.
        os.utime(file, (1_700_000_000 + self.count,) * 2)
        self.count += 1

    def messages(self):
        return sources.ndjson_stream(self.spark, str(self.folder), max_files_per_trigger=1)

    def windows(self):
        query = streams.start_window_stream(
            sources.parse_events(self.messages()),
            f"{self.root}/checkpoint/windows",
            f"{self.root}/windows",
            NOW,
        )
        query.awaitTermination()
        return query


@pytest.fixture
def inbox(spark, tmp_path):
    return Inbox(spark, tmp_path)


def test_both_queries(spark, inbox):
    for text in FOLD:
        inbox.put([text])
    state = GraphState(spark, f"{inbox.root}/state", snapshot_every=2).open()
    windows, graph = streams.start_streams(
        spark,
        f"{inbox.root}/checkpoint",
        messages=inbox.messages(),
        on_graph=state.apply_batch,
        await_termination=False,
        windows_path=f"{inbox.root}/windows",
        quarantine_path=f"{inbox.root}/quarantine",
        triggers=NOW,
    )
    graph.awaitTermination()
    windows.awaitTermination()

    edges, vertices = state.load()
    assert rows(edges) == FOLD_EDGES
    assert rows(vertices) == FOLD_VERTICES
    # The batch without a usable message is not counted.
    assert state.manifest().batch_count == 6
    rejected = spark.read.parquet(f"{inbox.root}/quarantine")
    assert rows(rejected, "raw", "defect") == [("not json", "bad_json")]
    events = sources.parse_events(messages(spark, FOLD))
    current = streams.read_windows(spark, f"{inbox.root}/windows")
    assert rows(current) == rows(window_revenue(events))


def test_restart_goes_on_with_the_next_epoch(spark, inbox):
    state = GraphState(spark, f"{inbox.root}/state").open()

    def run():
        streams.start_graph_stream(
            inbox.messages(), f"{inbox.root}/checkpoint", state.apply_batch, NOW
        ).awaitTermination()

    inbox.put(FOLD[:3])
    run()
    inbox.put(FOLD[3:])
    run()
    run()
    assert rows(state.load()[0]) == FOLD_EDGES
    assert (state.manifest().batch_count, state.manifest().last_epoch_id) == (2, 1)


def test_batch_that_fails_is_repeated_once(spark, inbox):
    state = GraphState(spark, f"{inbox.root}/state").open()
    inbox.put(FOLD)
    applied = []

    def stored_but_not_acknowledged(vertices, edges, epoch_id):
        state.apply_batch(vertices, edges, epoch_id)
        applied.append(epoch_id)
        if len(applied) == 1:
            raise OSError("lost after the state was written")

    def run():
        query = streams.start_graph_stream(
            inbox.messages(), f"{inbox.root}/checkpoint", stored_but_not_acknowledged, NOW
        )
        query.awaitTermination()

    with pytest.raises(Exception, match="lost after"):
        run()
    run()
    assert applied == [0, 0]
    assert rows(state.load()[0]) == FOLD_EDGES
    assert state.manifest().batch_count == 1


def test_late_rows(spark, inbox):
    def event(action, seconds):
        return message("u", "p", "s", action, seconds, 2.0)

    # One file per micro-batch. Lateness is judged by the watermark that the
    # batch before has left.
    inbox.put([event("VOUT", 300)])
    inbox.put([event("VOUT", 360)])
    inbox.put([event("AIME", 30), event("VOUT", 370)])
    inbox.put([event("AIME", 20), event("VOUT", 380)])
    late = streams.watch_late_rows(spark)
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", 1)
    try:
        query = inbox.windows()
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
    assert rows(streams.read_windows(spark, f"{inbox.root}/windows")) == [
        (at(300), at(360), "VOUT", 1, 2.0),
        (at(360), at(420), "VOUT", 3, 6.0),
    ]
    # Reports arrive shortly after the triggers; the query itself keeps the last one.
    deadline = time.monotonic() + 20
    while streams.dropped_late_rows(query, late) < 2 and time.monotonic() < deadline:
        time.sleep(0.2)
    assert streams.dropped_late_rows(query, late) == 2
    spark.streams.removeListener(late)


def test_no_windows_before_the_first_batch(spark, inbox):
    assert streams.read_windows(spark, f"{inbox.root}/none").count() == 0


def test_no_price_stops_a_stream(spark, inbox):
    inbox.put([message("u", "p", "s", "VOUT", 10, 1e17), message("u", "p", "s", "VOUT", 11, 2.5)])
    decoded = sources.decode(sources.ndjson_table(spark, str(inbox.folder)))
    assert [r.defect for r in sources.quarantined(decoded).collect()] == ["bad_price"]
    assert sorted(r.price or 0 for r in sources.accepted(decoded).collect()) == [0, 2.5]
    events = spark.createDataFrame([(at(10), "VOUT", 1e17), (at(11), "VOUT", 2.5)], "timestamp timestamp, action_type string, price double")
    assert rows(window_revenue(events, price_scale=2)) == [(at(0), at(60), "VOUT", 2, 2.5)]


def test_windows_go_on_after_a_restart(spark, inbox):
    inbox.put([message("u", "p", "s", "VOUT", 10, 2.0)])
    inbox.windows()
    inbox.put([message("u", "p", "s", "VOUT", 20, 3.0), message("u", "p", "s", "AIME", None, 1.0)])
    inbox.windows()
    current = streams.read_windows(spark, f"{inbox.root}/windows")
    assert rows(current) == [(at(0), at(60), "VOUT", 2, 5.0)]


def test_console(spark, inbox):
    inbox.put(FOLD)
    seen = []
    windows, graph = streams.start_streams(
        spark,
        f"{inbox.root}/checkpoint",
        messages=inbox.messages(),
        on_graph=lambda vertices, edges, epoch: seen.append((epoch, edges.count())),
        await_termination=False,
        enable_console=True,
        triggers=NOW,
    )
    graph.awaitTermination()
    windows.awaitTermination()
    assert seen == [(0, 6)]
    assert windows.exception() is None


def test_default_handler_prints_popular_products(spark, inbox, capsys):
    vertices, edges = build.build_graph(sources.parse_events(messages(spark, FOLD[:4])))
    streams.make_batch_processor()(sources.decode(messages(spark, FOLD)), 7)
    assert "batch 7" in capsys.readouterr().out


def test_empty_batch_is_skipped(spark):
    calls = []
    process = streams.make_batch_processor(lambda *arguments: calls.append(arguments))
    process(sources.decode(messages(spark, FOLD).limit(0)), 0)
    assert calls == []


def test_default_triggers():
    triggers = streams.Triggers()
    assert triggers.options(triggers.graph) == {"processingTime": "10 seconds"}
    assert triggers.options(triggers.windows) == {"processingTime": "30 seconds"}


def test_kafka_source_needs_its_connector(spark):
    with pytest.raises(AnalysisException, match="(?i)kafka"):
        sources.kafka_stream(spark, "localhost:9092", "marketplace-events")


def test_stream_and_table_of_files_agree(spark, inbox):
    inbox.put(FOLD[:4])
    inbox.put(FOLD[4:])
    table = sources.ndjson_table(spark, str(inbox.folder))
    edges = build.batch_edges(sources.accepted(sources.decode(table)))
    assert rows(fold.edge_state(edges)) == FOLD_EDGES
