"""Windows closed by the watermark: right values, bounded folders, repeated epochs."""

import os
from datetime import timedelta

import pytest

from bazaargraph import workspace
from bazaargraph.operators.windows import window_revenue
from bazaargraph.schemas import windows_schema
from bazaargraph.sources import events as sources
from bazaargraph.streaming import streams, window_table
from bazaargraph.streaming.window_table import WindowTable
from fixtures import START, message, rows
from test_streams import NOW, Inbox

CHANGES = windows_schema().fields[:-1]


def changed(spark, values):
    """(minute, action, events) as update rows."""
    schema = type(windows_schema())(CHANGES)
    data = [
        (START + timedelta(minutes=m), START + timedelta(minutes=m + 1), a, n, float(n))
        for m, a, n in values
    ]
    return spark.createDataFrame(data, schema)


def minutes(df):
    found = (
        (int((r.window_start - START).total_seconds() // 60), r.action_type, r.nb_events)
        for r in df.collect()
    )
    return sorted(found, key=repr)


def test_windows_close_once_nothing_can_change_them(spark, tmp_path):
    table = WindowTable(spark, str(tmp_path / "w"))
    assert table.load().isEmpty()
    table.apply(changed(spark, [(0, "a", 1)]), 0)
    table.apply(changed(spark, [(5, "a", 1)]), 1)
    # Spark would still take rows of minute 0: the batch before last left no watermark.
    assert not table._versions()[0].closed
    table.apply(changed(spark, [(0, "a", 2), (5, None, 3)]), 2)
    assert list(table._versions()[0].closed) == ["2026-01-01"]
    assert minutes(table.load("2026-01-01")) == [(0, "a", 2)]
    assert minutes(table.load()) == [(0, "a", 2), (5, "a", 1), (5, None, 3)]
    table.apply(changed(spark, []), 3)
    assert table.load().count() == 3 and table.load("2026-01-02").isEmpty()
    assert "Exchange" not in table.load()._jdf.queryExecution().executedPlan().toString()


def test_a_repeated_epoch_takes_the_place_of_its_first_version(spark, tmp_path):
    table = WindowTable(spark, str(tmp_path / "w"))
    for epoch in range(3):
        table.apply(changed(spark, [(epoch * 5, "a", 1)]), epoch)
    for n in (7, 2, 2):
        table.apply(changed(spark, [(15, "a", n), (10, "a", n)]), 3)
    assert minutes(table.load()) == [(0, "a", 1), (10, "a", 2), (15, "a", 2), (5, "a", 1)]
    assert len(table._versions()[0].closed["2026-01-01"]) == 2
    with pytest.raises(ValueError, match="checkpoint"):
        table.apply(changed(spark, []), 1)
    workspace.replace_text(spark, f"{table.path}/manifest.json", "{}")
    with pytest.raises(KeyError):
        table.load()


def test_folders_stay_few(spark, tmp_path, monkeypatch):
    """40 epochs with small limits; 200 with the usual ones behave alike, but take minutes."""
    monkeypatch.setattr(window_table, "PARTS_OF_DAY", 2)
    monkeypatch.setattr(window_table, "KEEP_EPOCHS", 2)
    path = str(tmp_path / "w")
    table = WindowTable(spark, path)
    most = 0
    for epoch in range(40):
        table.apply(changed(spark, [(epoch * 50, "a", 1), (epoch * 50 + 1, "b", 1)]), epoch)
        most = max(most, sum(name.startswith("day=") for _, d, _ in os.walk(path) for name in d))
    # The epochs cover 33 hours: two days of closed windows.
    assert most <= 2 * (window_table.PARTS_OF_DAY + 1) + 3 * window_table.KEEP_EPOCHS
    assert table.load().count() == 80
    assert {d for d in table._versions()[0].closed} == {"2026-01-01", "2026-01-02"}


def test_stream_gives_the_windows_of_the_batch(spark, tmp_path):
    inbox = Inbox(spark, tmp_path)
    table = WindowTable(spark, f"{inbox.root}/table")
    sent = []

    def run():
        query = streams.start_window_stream(
            sources.parse_events(inbox.messages()), f"{inbox.root}/checkpoint", table, NOW
        )
        query.awaitTermination()

    # Each file is a batch; the second run goes on from the checkpoint.
    for start in (0, 6):
        for k in range(start, start + 6):
            texts = [
                message("u1", "p1", "s1", ("AIME", "VOUT")[j % 2], 90 * k + 7 * j, 2.5) for j in range(4)
            ]
            texts.append(message("u1", "p1", "s1", "AIME", None, 1.0))
            inbox.put(texts)
            sent += texts
        run()
    everything = spark.createDataFrame([(t.encode(),) for t in sent], "value binary")
    expected = window_revenue(sources.parse_events(everything))
    assert rows(table.load()) == rows(expected)
    closed = table.load("2000-01-01")
    assert 0 < closed.count() < expected.count()
    with pytest.raises(ValueError, match="closes"):
        streams.start_window_stream(
            sources.parse_events(inbox.messages()), f"{inbox.root}/c2", table, NOW, watermark="2 minutes"
        )


def test_a_late_row_changes_no_closed_window(spark, tmp_path):
    inbox = Inbox(spark, tmp_path)
    table = WindowTable(spark, f"{inbox.root}/table")
    late = streams.watch_late_rows(spark)
    for seconds in (300, 360, 420, 30, 480):
        inbox.put([message("u1", "p1", "s1", "VOUT", seconds, 1.0)])
    query = streams.start_window_stream(
        sources.parse_events(inbox.messages()), f"{inbox.root}/checkpoint", table, NOW
    )
    query.awaitTermination()
    spark.streams.removeListener(late)
    assert minutes(table.load()) == [(5, "VOUT", 1), (6, "VOUT", 1), (7, "VOUT", 1), (8, "VOUT", 1)]


def test_each_batch_is_published(spark, tmp_path):
    sent = []
    handler = streams.publish_graph(lambda df, topic: sent.append((topic, rows(df))))
    vertices = spark.createDataFrame([("u1", "USER")], "id string, type string")
    edges = spark.createDataFrame([("u1", "p1", "AIME")], "src string, dst string, relationship string")
    handler(vertices, edges, 4)
    assert sent == [
        ("graph-vertices", [("u1", '{"id":"u1","type":"USER"}')]),
        ("graph-edges", [("u1", '{"src":"u1","dst":"p1","relationship":"AIME"}')]),
    ]
    with pytest.raises(Exception, match="kafka|DATA_SOURCE"):
        streams.publish_graph(streams.kafka_writer("localhost:1"))(vertices, edges, 0)
