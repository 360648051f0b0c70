import dataclasses
import random

import pytest
from pyspark.sql import functions as F

from bazaargraph import workspace
from bazaargraph.operators import build, fold
from bazaargraph.plans import queries
from bazaargraph.sources import events as sources
from bazaargraph.sources import warehouse
from bazaargraph.streaming.state import GraphState, Manifest
from fixtures import FOLD, FOLD_EDGES, FOLD_VERTICES, messages, rows


def batch(spark, texts):
    return build.build_graph(sources.accepted(sources.decode(messages(spark, texts))))


@pytest.fixture
def path(tmp_path):
    return str(tmp_path / "state")


@pytest.mark.parametrize("settings", [{}, {"snapshot_every": 2}, {"snapshot_every": 0, "merge_every": 2}])
def test_any_split_gives_the_state_of_one_batch(spark, path, settings):
    texts = random.Random(5).sample(FOLD, len(FOLD))
    state = GraphState(spark, path, **settings).open()
    for epoch, cut in enumerate(texts[i : i + 2] for i in range(0, len(texts), 2)):
        state.apply_batch(*batch(spark, cut), epoch)
    edges, vertices = state.load()
    assert rows(edges) == FOLD_EDGES
    assert rows(vertices) == FOLD_VERTICES
    assert rows(state.stats()) == [(7, 2, 4, 3)]


@pytest.mark.parametrize(
    "settings", [{}, {"snapshot_every": 1}, {"snapshot_every": 2}, {"merge_every": 2}]
)
def test_repeated_epoch_changes_nothing(spark, path, settings):
    state = GraphState(spark, path, **settings).open()
    for epoch, texts in ((0, FOLD[:3]), (1, FOLD[3:]), (1, FOLD[3:])):
        state.apply_batch(*batch(spark, texts), epoch)
    assert rows(state.load()[0]) == FOLD_EDGES
    assert rows(state.stats()) == [(7, 2, 2, 1)]


def test_older_epoch_is_refused(spark, path):
    state = GraphState(spark, path).open()
    state.apply_batch(*batch(spark, FOLD), 4)
    with pytest.raises(ValueError, match="checkpoint"):
        state.apply_batch(*batch(spark, FOLD), 0)
    assert rows(state.load()[0]) == FOLD_EDGES


def test_later_epoch_decides_the_type(spark, path):
    state = GraphState(spark, path, snapshot_every=2).open()
    _, edges = batch(spark, FOLD)
    for epoch, role in enumerate(["USER", "PROD", "SEL"]):
        vertex = spark.createDataFrame([("x", role)], "id string, type string")
        state.apply_batch(vertex, edges, epoch)
        assert rows(state.load()[1]) == [("x", role)]


def test_snapshot_every_n_batches(spark, path):
    state = GraphState(spark, path, snapshot_every=2).open()
    seen = []
    for epoch in range(4):
        state.apply_batch(*batch(spark, FOLD), epoch)
        manifest = state.manifest()
        seen.append((manifest.snapshot and manifest.snapshot.epoch_id, len(manifest.parts)))
    assert seen == [(None, 1), (1, 0), (1, 1), (3, 0)]


def test_write_that_dies_leaves_the_state(spark, path, monkeypatch):
    state = GraphState(spark, path).open()
    state.apply_batch(*batch(spark, FOLD[:3]), 0)
    before = rows(state.load()[0])

    def fail(manifest):
        raise OSError("lost")

    monkeypatch.setattr(state, "_commit", fail)
    with pytest.raises(OSError):
        state.apply_batch(*batch(spark, FOLD[3:]), 1)
    monkeypatch.undo()
    assert rows(state.load()[0]) == before
    state.apply_batch(*batch(spark, FOLD[3:]), 1)
    assert rows(state.load()[0]) == FOLD_EDGES


def test_state_survives_reopening(spark, path):
    GraphState(spark, path).open().apply_batch(*batch(spark, FOLD[:3]), 0)
    again = GraphState(spark, path).open()
    again.apply_batch(*batch(spark, FOLD[3:]), 1)
    assert rows(GraphState(spark, path).load()[0]) == FOLD_EDGES
    fresh = GraphState(spark, path).open(load=False)
    assert fresh.load()[0].isEmpty() and fresh.manifest() == Manifest()


def test_new_state_is_empty_with_the_right_columns(spark, path):
    edges, vertices = GraphState(spark, path).load()
    assert edges.columns == ["src", "dst", "score", "last_interaction", "AIME", "VOUT", "ACHAT"]
    assert vertices.columns == ["id", "type"]
    assert edges.isEmpty() and vertices.isEmpty()
    assert rows(GraphState(spark, path).open().stats()) == [(0, 0, 0, -1)]


@pytest.mark.parametrize("text", ["", "{", '{"batch_count": 3}', "[]"])
def test_damaged_manifest_is_an_error(spark, path, text):
    state = GraphState(spark, path).open()
    workspace.replace_text(spark, f"{path}/manifest.json", text)
    with pytest.raises(Exception):
        state.load()


def test_new_weights_apply_to_stored_counts(spark, path):
    GraphState(spark, path).open().apply_batch(*batch(spark, FOLD), 0)
    other = GraphState(spark, path, weights={"ACHAT": 7, "RENDU": -1})
    edges, _ = other.load()
    assert rows(edges, "src", "score", "ACHAT", "RENDU") == [("u1", 7.0, 1, 0), ("u2", 0.0, 0, 0)]


def test_raw_log_replaces_a_repeated_epoch(spark, path):
    state = GraphState(spark, path, keep_raw=True, snapshot_every=0).open()
    assert [t.isEmpty() for t in state.raw_log()] == [True, True]
    for epoch, texts in ((0, FOLD[:3]), (1, FOLD[3:]), (1, FOLD[3:])):
        state.apply_batch(*batch(spark, texts), epoch)
    raw_edges, raw_vertices = state.raw_log()
    assert raw_edges.groupBy("epoch_id").count().orderBy("epoch_id").collect() == [(0, 3), (1, 3)]
    assert raw_edges.columns == ["src", "dst", "relationship", "timestamp", "price", "epoch_id"]
    partials, vertices = fold.replay_raw(raw_edges, raw_vertices)
    assert rows(fold.with_score(partials), "src", "score") == [("u1", 22.0), ("u2", 5.0)]
    assert rows(vertices, "id", "type") == FOLD_VERTICES


def test_merged_days_equal_one_fold(spark, path):
    sf_dir = "/root/testdata/sf0.01"
    vertices, edges = build.build_graph(warehouse.graph_events(spark, sf_dir))
    state = GraphState(spark, path, snapshot_every=3, merge_every=2).open()
    for epoch in range(5):
        part = edges.filter(F.pmod(F.hash("timestamp"), F.lit(5)) == epoch)
        state.apply_batch(vertices, part, epoch)
    stored, _ = state.load()
    totals = stored.agg(F.count("*"), F.sum("score"), F.sum("AIME"), F.sum("VOUT"), F.sum("ACHAT"))
    assert rows(totals) == [(4931, 51632.0, 1982, 2006, 1981)]
    once = queries.QUERIES["edge_state"](spark, sf_dir)
    assert queries._zoneless(stored).exceptAll(once).isEmpty()
    assert once.exceptAll(queries._zoneless(stored)).isEmpty()


def test_tables_are_made_once(spark, tmp_path):
    table = str(tmp_path / "t")
    schema = "id string, n long"
    absent = workspace.read_table(spark, table, spark.range(0).schema)
    assert absent.isEmpty()
    workspace.ensure_table(spark, table, spark.createDataFrame([], schema).schema)
    spark.createDataFrame([("a", 1)], schema).write.mode("append").parquet(table)
    workspace.ensure_table(spark, table, spark.createDataFrame([], schema).schema)
    assert spark.read.parquet(table).count() == 1


def test_counts_outlive_other_weights(spark, path):
    GraphState(spark, path).open().apply_batch(*batch(spark, FOLD[:3]), 0)
    narrow = GraphState(spark, path, weights={"ACHAT": 20.0}).open()
    narrow.apply_batch(*batch(spark, FOLD[3:]), 1)
    narrow.snapshot()
    assert set(narrow.load()[0].columns) == {"src", "dst", "score", "last_interaction", "ACHAT"}
    assert rows(GraphState(spark, path).open().load()[0]) == FOLD_EDGES


def test_actions_of_an_old_manifest_are_read_from_the_files(spark, path):
    state = GraphState(spark, path).open()
    state.apply_batch(*batch(spark, FOLD), 0)
    old = dataclasses.replace(state.manifest(), actions=())
    workspace.replace_text(spark, f"{path}/manifest.json", old.to_json())
    GraphState(spark, path, weights={"ACHAT": 20.0}).open().snapshot()
    assert rows(GraphState(spark, path).open().load()[0]) == FOLD_EDGES


def test_null_keys_merge_alike_on_both_ways(spark, path, monkeypatch):
    edge = "src string, dst string, relationship string, timestamp timestamp, price double"
    found = []
    for limit in (workspace.BROADCAST_BYTES, 0):
        monkeypatch.setattr(workspace, "BROADCAST_BYTES", limit)
        state = GraphState(spark, f"{path}-{limit}").open()
        for epoch in (0, 1):
            edges = spark.createDataFrame(
                [("u", None, "AIME", None, 1.0), ("u", "p", "AIME", None, 1.0)], edge
            )
            vertices = spark.createDataFrame([("u", "USER"), (None, "PROD")], "id string, type string")
            state.apply_batch(vertices, edges, epoch)
            if epoch == 0:
                state.snapshot()
        edges, vertices = state.load()
        found.append((sorted(map(repr, edges.collect())), sorted(map(repr, vertices.collect()))))
    assert found[0] == found[1]
    assert [len(part) for part in found[0]] == [2, 2]


def test_rebuilding_from_the_log(spark, path):
    state = GraphState(spark, path, keep_raw=True).open()
    for epoch, texts in ((0, FOLD[:3]), (1, FOLD[3:])):
        state.apply_batch(*batch(spark, texts), epoch)
    workspace.replace_text(spark, f"{path}/manifest.json", "{")
    state.rebuild()
    assert rows(state.load()[0]) == FOLD_EDGES
    assert rows(state.load()[1]) == FOLD_VERTICES
    assert (state.manifest().batch_count, state.manifest().last_epoch_id) == (2, 1)


@pytest.mark.parametrize("manifest", ["kept", "damaged"])
def test_rebuilding_with_few_weights_keeps_all_counts(spark, path, manifest):
    state = GraphState(spark, path, keep_raw=True).open()
    for epoch, texts in ((0, FOLD[:3]), (1, FOLD[3:])):
        state.apply_batch(*batch(spark, texts), epoch)
    actions = set(state.manifest().actions)
    if manifest == "damaged":
        workspace.replace_text(spark, f"{path}/manifest.json", "{")
    GraphState(spark, path, weights={"ACHAT": 20}, keep_raw=True).rebuild()
    assert set(state.manifest().actions) == actions
    assert rows(state.load()[0]) == FOLD_EDGES
