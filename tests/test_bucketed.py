"""State in buckets: the rules of the plain state, no shuffle to read it, few buckets rewritten."""

import os
import random
import re

import pytest
from pyspark.sql import functions as F

from bazaargraph import workspace
from bazaargraph.operators import build, lookup, rank, traverse
from bazaargraph.plans import queries
from bazaargraph.sources import warehouse
from bazaargraph.streaming.bucketed import BucketedGraphState, Layout, touched
from fixtures import FOLD, FOLD_EDGES, FOLD_VERTICES, message, rows
from test_plans import plan
from test_state import batch

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture
def path(tmp_path):
    return str(tmp_path / "state")


def files(path, kind):
    """The bucket files of each part, by their names."""
    found = {}
    for folder, _, names in os.walk(f"{path}/{kind}"):
        match = re.search(r"part=([^/]+)/slot=(\d+)$", folder)
        if match:
            found[match[1], int(match[2])] = sorted(n for n in names if n.endswith(".parquet"))
    return found


@pytest.mark.parametrize(
    "settings",
    [{}, {"snapshot_every": 2}, {"snapshot_every": 0, "merge_every": 2}, {"buckets": 1}, {"reverse": True}],
)
def test_any_split_gives_the_state_of_one_batch(spark, path, settings):
    texts = random.Random(5).sample(FOLD, len(FOLD))
    state = BucketedGraphState(spark, path, **{"buckets": 4, **settings}).open()
    for epoch, cut in enumerate(texts[i : i + 2] for i in range(0, len(texts), 2)):
        state.apply_batch(*batch(spark, cut), epoch)
    edges, vertices = state.load()
    assert rows(edges) == FOLD_EDGES
    assert rows(vertices) == FOLD_VERTICES
    assert rows(state.stats()) == [(7, 2, 4, 3)]
    if settings.get("reverse"):
        assert rows(state.reverse_edges()) == FOLD_EDGES


@pytest.mark.parametrize("settings", [{}, {"snapshot_every": 1}, {"merge_every": 2}])
def test_repeated_and_older_epochs(spark, path, settings):
    state = BucketedGraphState(spark, path, buckets=4, **settings).open()
    for epoch, texts in ((0, FOLD[:3]), (1, FOLD[3:]), (1, FOLD[3:])):
        state.apply_batch(*batch(spark, texts), epoch)
    assert rows(state.load()[0]) == FOLD_EDGES
    with pytest.raises(ValueError, match="checkpoint"):
        state.apply_batch(*batch(spark, FOLD), 0)
    assert rows(BucketedGraphState(spark, path).load()[0]) == FOLD_EDGES


def test_new_and_damaged_states(spark, path):
    state = BucketedGraphState(spark, path, buckets=3, reverse=True)
    edges, vertices = state.load()
    assert edges.columns == ["src", "dst", "score", "last_interaction", "AIME", "VOUT", "ACHAT"]
    assert edges.isEmpty() and vertices.isEmpty() and state.reverse_edges().isEmpty()
    state.open().apply_batch(*batch(spark, FOLD), 0)
    assert BucketedGraphState(spark, path, buckets=9).manifest().buckets == 3
    with pytest.raises(ValueError, match="reverse"):
        BucketedGraphState(spark, f"{path}-2").open().reverse_edges()
    workspace.replace_text(spark, f"{path}/manifest.json", '{"buckets": 3}')
    with pytest.raises(KeyError):
        state.load()
    assert BucketedGraphState(spark, path).open(load=False).load()[0].isEmpty()


def test_counts_outlive_other_weights_and_a_rebuild(spark, path):
    first = BucketedGraphState(spark, path, buckets=4, keep_raw=True).open()
    first.apply_batch(*batch(spark, FOLD[:3]), 0)
    narrow = BucketedGraphState(spark, path, weights={"ACHAT": 20.0}, keep_raw=True).open()
    narrow.apply_batch(*batch(spark, FOLD[3:]), 1)
    narrow.snapshot()
    assert set(narrow.load()[0].columns) == {"src", "dst", "score", "last_interaction", "ACHAT"}
    other = BucketedGraphState(spark, path, weights={"ACHAT": 7, "RENDU": -1})
    assert rows(other.load()[0], "src", "score", "RENDU") == [("u1", 7.0, 0), ("u2", 0.0, 0)]
    assert rows(BucketedGraphState(spark, path).load()[0]) == FOLD_EDGES
    for text in (None, "{"):
        if text:
            workspace.replace_text(spark, f"{path}/manifest.json", text)
        BucketedGraphState(spark, path, weights={"ACHAT": 20}, buckets=4, keep_raw=True).rebuild()
        again = BucketedGraphState(spark, path)
        assert rows(again.load()[0]) == FOLD_EDGES and rows(again.load()[1]) == FOLD_VERTICES
        assert (again.manifest().batch_count, again.manifest().last_epoch_id) == (2, 1)


def test_null_keys_are_one_key(spark, path):
    edge = "src string, dst string, relationship string, timestamp timestamp, price double"
    state = BucketedGraphState(spark, path, buckets=4, reverse=True).open()
    for epoch in (0, 1, 2):
        values = [("u", None, "AIME", None, 1.0), (None, "p", "AIME", None, 1.0), (None, None, "AIME", None, 1.0)]
        vertices = spark.createDataFrame([("u", "USER"), (None, "PROD")], "id string, type string")
        state.apply_batch(vertices, spark.createDataFrame(values, edge), epoch)
        if epoch == 1:
            state.snapshot()
    edges, vertices = state.load()
    assert sorted(map(repr, edges.select("src", "dst", "AIME").collect())) == sorted(
        f"Row(src={s!r}, dst={d!r}, AIME=3)" for s, d in (("u", None), (None, "p"), (None, None))
    )
    assert rows(edges) == rows(state.reverse_edges()) and vertices.count() == 2


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """Base and two recent parts of real events."""
    state = BucketedGraphState(
        spark, str(tmp_path_factory.mktemp("bucketed")), buckets=8, reverse=True
    ).open()
    events = warehouse.graph_events(spark, SF_DIR)
    for epoch in range(4):
        part = events.where(F.pmod(F.hash("timestamp"), F.lit(4)) == epoch)
        state.apply_batch(*build.build_graph(part), epoch)
        if epoch == 1:
            state.snapshot()
    return state


def test_reading_needs_no_exchange_at_any_number_of_parts(stored):
    assert len(stored.manifest().parts) == 2 and len(stored.manifest().base) == 1
    for df in stored.load():
        text = plan(df)
        assert "Exchange" not in text and "Aggregate" in text and "SelectedBucketsCount" in text
    # A look-up by source opens that source's bucket alone, below the merge.
    found = plan(stored.load()[0].filter("src = 'usr_7'"))
    assert "SelectedBucketsCount: 1 out of 8" in found and "EqualTo(src,usr_7)" in found


def test_state_equals_one_fold(spark, stored):
    once = queries.QUERIES["edge_state"](spark, SF_DIR)
    for df in (stored.load()[0], stored.reverse_edges()):
        loaded = queries._zoneless(df)
        assert loaded.count() == once.count() and loaded.exceptAll(once).isEmpty()


def test_one_user_rewrites_one_bucket(spark, path):
    state = BucketedGraphState(spark, path, buckets=8, reverse=True).open()
    events = warehouse.graph_events(spark, SF_DIR)
    state.apply_batch(*build.build_graph(events), 0)
    state.snapshot()
    before, whole = files(path, "edges"), state.load()[0].count()
    assert {s for _, s in before} == set(range(8)) and all(len(f) == 1 for f in before.values())
    texts = [message("usr_7", f"prod_{k}", "sel_1", "ACHAT", k, 1.0) for k in range(5)]
    state.apply_batch(*batch(spark, texts), 1)
    (slot,) = state.manifest().parts[0].edges
    assert len(touched(state.manifest().parts, "vertices")) <= 7
    state.snapshot()
    written = set(files(path, "edges")) - set(before)
    # The epoch's part and the rewritten bucket, each a single file.
    assert {s for _, s in written} == {slot} and len(written) == 2
    layout = state.manifest()
    assert len(layout.base) == 2 and not layout.parts
    assert layout.base[1].edges == (slot,) and slot not in layout.base[0].edges
    edges, vertices = state.load()
    assert "HashAggregate" not in plan(edges) and "Exchange" not in plan(vertices)
    assert whole <= edges.count() <= whole + 5
    assert rows(edges) == rows(state.reverse_edges())
    assert Layout.from_json(layout.to_json()) == layout


def test_another_session_reads_what_was_added(spark, path):
    state = BucketedGraphState(spark, path, buckets=4).open()
    state.apply_batch(*batch(spark, FOLD[:3]), 0)
    other = BucketedGraphState(spark.newSession(), path)
    other.load()[0].count()
    state.apply_batch(*batch(spark, FOLD[3:]), 1)
    spark.sql(f"DROP TABLE {state._table('edges', state.manifest()).name}")
    assert rows(other.load()[0]) == FOLD_EDGES
    assert rows(BucketedGraphState(spark, path).load()[0]) == FOLD_EDGES


def test_vacuum_keeps_what_the_manifest_names(spark, path):
    state = BucketedGraphState(spark, path, buckets=4, reverse=True).open()
    for epoch in range(3):
        state.apply_batch(*batch(spark, FOLD), epoch)
        if epoch == 1:
            state.snapshot()
    before = rows(state.load()[0])
    assert state.vacuum(keep_hours=1.0) == []
    gone = state.vacuum(keep_hours=-1.0)
    assert {name.split("/")[0] for name in gone} == {"edges", "vertices", "reverse", "names"}
    assert {p for p, _ in files(path, "edges")} == {p.name for p in state.manifest().pieces}
    assert rows(state.load()[0]) == before == rows(state.reverse_edges())
    assert rows(BucketedGraphState(spark, path).load()[1]) == FOLD_VERTICES
    assert state.vacuum(keep_hours=-1.0) == []


@pytest.mark.parametrize("direction", ["both", "in", "out"])
@pytest.mark.parametrize("hops", [1, 2, 3])
@pytest.mark.parametrize("limit", [workspace.BROADCAST_BYTES, -1])
def test_walks_over_both_layouts_are_the_same(stored, monkeypatch, direction, hops, limit):
    monkeypatch.setattr(workspace, "BROADCAST_BYTES", limit)
    edges, vertices = stored.load()
    for node in ("usr_7", "prod_7"):
        plain = traverse.node_neighbors(node, edges, vertices, hops, 10, direction)
        both = traverse.node_neighbors(
            node, edges, vertices, hops, 10, direction, reverse=stored.reverse_edges()
        )
        assert [rows(df) for df in plain] == [rows(df) for df in both]


def test_look_ups_reach_the_scans_of_both_layouts(spark, stored):
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    edges, vertices = stored.load()
    found, _ = traverse.node_neighbors(
        "usr_7", edges, vertices, hops=1, reverse=stored.reverse_edges()
    )
    text = plan(found)
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "Or(" not in text and "SelectedBucketsCount: 1 out of 8" in text
    assert re.search(r"PushedFilters: \[IsNotNull\(dst\), In\(slot, [^]]*\]\), EqualTo\(dst,usr_7\)", text)
    product = edges.groupBy("dst").count().orderBy("count").first().dst
    selected = traverse.edge_context(
        rows(edges.filter(F.col("dst") == product), "src")[0][0], product, edges, vertices,
        reverse=stored.reverse_edges(),
    )
    plain = traverse.edge_context(
        rows(edges.filter(F.col("dst") == product), "src")[0][0], product, edges, vertices
    )
    assert [rows(df) for df in selected] == [rows(df) for df in plain]


def test_destinations_lie_in_ranges(spark, path):
    """Files of the reverse copy overlap in no destination but at their borders."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        state = BucketedGraphState(spark, path, buckets=4, reverse=True).open()
        state.apply_batch(*build.build_graph(warehouse.graph_events(spark, SF_DIR)), 0)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    name = state.manifest().parts[0].name
    stored = spark.read.parquet(f"{path}/reverse/{name}")
    ranges = rows(
        stored.groupBy(F.input_file_name().alias("file")).agg(
            F.min("dst").alias("low"), F.max("dst").alias("high")
        ), "low", "high",
    )
    assert len(ranges) > 1
    assert all(a[1] <= b[0] for a, b in zip(ranges, ranges[1:], strict=False))


def test_best_edges_of_the_stored_state(spark, stored):
    found, _ = rank.best_edges(*stored.load())
    once = queries.QUERIES["best_edges"](spark, SF_DIR)
    assert rows(queries._zoneless(found), "src", "dst", "score") == rows(once, "src", "dst", "score")


@pytest.fixture(scope="module")
def skewed(spark, tmp_path_factory):
    """Few users with high counts, so most buckets are cold; a recent part beside the base."""
    path = str(tmp_path_factory.mktemp("skewed"))
    state = BucketedGraphState(spark, path, buckets=16, reverse=True, snapshot_every=2).open()
    edge = "src string, dst string, relationship string, timestamp timestamp, price double"
    for epoch in range(3):
        values = [(f"u{k}", f"p{k % 9}", "AIME", None, 1.0) for k in range(120)]
        values += [(f"u{k}", f"p{j}", "ACHAT", None, 1.0) for k in (3, 5) for j in range(20)]
        vertices = spark.createDataFrame(
            [(f"{'U' if k % 2 else 'u'}{k}", "USER") for k in range(120)], "id string, type string"
        )
        state.apply_batch(vertices, spark.createDataFrame(values, edge), epoch)
    return state


@pytest.mark.parametrize("limit", [0, 1, 10, 39, 60, 500])
def test_best_edges_leave_cold_buckets_alone(skewed, limit):
    found, ends = skewed.best_edges(limit)
    plain, all_ends = rank.best_edges(*skewed.load(), limit)
    assert rows(found) == rows(plain) and rows(ends) == rows(all_ends)
    if 0 < limit < 40:
        hot = skewed.best_buckets(limit)
        assert 1 <= len(hot) <= 3
        slots = {int(s) for f in found.inputFiles() if "/edges/" in f for s in re.findall(r"slot=(\d+)", f)}
        assert slots == set(hot)


@pytest.mark.parametrize("query", ["u1", " U11 ", "x", "", "U"])
def test_prefixes_are_looked_up_in_ranges(spark, skewed, query):
    found, plain = skewed.search_ids(query), lookup.search_ids(skewed.load()[1], query)
    assert rows(found) == rows(plain)
    if query.strip() == "u1":
        spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
        text = plan(found)
        spark.conf.unset("spark.sql.maxMetadataStringLength")
        assert "StringStartsWith(folded,u1)" in text


def test_weights_below_zero_keep_bounds_valid(spark, skewed):
    other = BucketedGraphState(spark, skewed.path, weights={"ACHAT": -2.0, "AIME": 1.0, "NEW": 3.0})
    assert rows(other.best_edges(7)[0]) == rows(rank.best_edges(*other.load(), 7, other.weights)[0])


def test_counts_come_from_the_manifest(skewed):
    vertices, edges = (skewed.load()[k].count() for k in (1, 0))
    assert rows(skewed.stats()) == [(vertices, edges, 3, 2)]
    skewed.snapshot()
    assert rows(skewed.stats()) == [(vertices, edges, 3, 2)]
    assert "FileScan" not in plan(skewed.stats())
