"""The raw log in ranges of epochs."""

import os
import re

import pytest

from bazaargraph import workspace
from bazaargraph.operators import fold
from bazaargraph.schemas import raw_edges_schema
from bazaargraph.sources import rawlog
from bazaargraph.sources.rawlog import RawLog
from bazaargraph.streaming.bucketed import BucketedGraphState
from fixtures import FOLD, FOLD_EDGES, rows
from test_plans import plan
from test_state import batch


@pytest.fixture
def log(spark, tmp_path):
    return RawLog(spark, str(tmp_path / "log"), raw_edges_schema())


def epoch(spark, number, n=2):
    values = [(f"u{k}", f"p{number}", "AIME", None, 1.0, number) for k in range(n)]
    return spark.createDataFrame(values, raw_edges_schema())


def counts(df):
    return dict(df.groupBy("epoch_id").count().collect())


def test_epochs_gather_in_few_folders(spark, log, monkeypatch):
    monkeypatch.setattr(rawlog, "FANOUT", 3)
    assert log.read().isEmpty()
    for number in range(30):
        log.append(epoch(spark, number), number)
        log.append(epoch(spark, number, 1), number)  # the repeated epoch takes its place
        assert len(log.runs()) <= 3 * 4
    assert counts(log.read()) == dict.fromkeys(range(30), 1)
    assert max(r.tier for r in log.runs()) >= 3 and log.runs()[-1] .tier == 0
    assert counts(log.read(after=24)) == dict.fromkeys(range(25, 30), 1)
    with pytest.raises(ValueError, match="merged"):
        log.append(epoch(spark, 3), 3)
    assert log.vacuum(keep_hours=1.0) == []
    assert log.vacuum(keep_hours=-1.0)
    assert {n for n in os.listdir(log.path) if n.startswith("run-")} == {r.name for r in log.runs()}
    assert counts(log.read()) == dict.fromkeys(range(30), 1)


def test_readers_prune_by_bounds(spark, log):
    for low in (0, 10, 20):
        log.append(epoch(spark, low).unionByName(epoch(spark, low + 5)))
    assert [(r.low, r.high) for r in log.runs()] == [(0, 5), (10, 15), (20, 25)]
    text = plan(log.read(after=12))
    assert re.search(r"PushedFilters: \[IsNotNull\(epoch_id\), GreaterThan\(epoch_id,12\)", text)
    assert "InMemoryFileIndex(2 paths)" in text
    assert counts(log.read(after=12)) == {15: 2, 20: 2, 25: 2}
    with pytest.raises(ValueError, match="overlap"):
        log.append(epoch(spark, 12))
    log.append(epoch(spark, 1).limit(0))
    assert len(log.runs()) == 3


def test_a_write_that_dies_leaves_the_log(spark, log, monkeypatch):
    log.append(epoch(spark, 1), 1)

    def fail(runs):
        raise OSError("lost")

    monkeypatch.setattr(log, "_commit", fail)
    with pytest.raises(OSError):
        log.append(epoch(spark, 2), 2)
    monkeypatch.undo()
    assert counts(log.read()) == {1: 2}


@pytest.mark.parametrize("damaged", [False, True])
def test_state_in_buckets_keeps_its_log_in_ranges(spark, tmp_path, monkeypatch, damaged):
    monkeypatch.setattr(rawlog, "FANOUT", 2)
    state = BucketedGraphState(spark, str(tmp_path / "s"), buckets=2, keep_raw=True).open()
    assert [df.isEmpty() for df in state.raw_log()] == [True, True]
    for number, text in enumerate(FOLD[:5] + FOLD[6:]):
        state.apply_batch(*batch(spark, [text]), number)
    state.apply_batch(*batch(spark, FOLD[6:]), 5)
    edges, vertices = state.raw_log()
    assert edges.count() == 6 and vertices.agg({"epoch_id": "max"}).first()[0] == 5
    partials, _ = fold.replay_raw(*state.raw_log(), 2)
    assert rows(fold.with_score(partials), "src", "score") == [("u1", 1.0)] or partials.count() >= 1
    if damaged:
        workspace.replace_text(spark, f"{state.path}/manifest.json", "{")
    state.rebuild()
    assert rows(state.load()[0]) == FOLD_EDGES
