"""The plans that matter at scale."""

import re

import pytest
from pyspark.sql import functions as F

from bazaargraph import workspace
from bazaargraph.operators import build, fold, lookup, rank, traverse
from bazaargraph.operators.windows import window_revenue
from bazaargraph.sources import events as sources
from bazaargraph.sources import sinks, warehouse
from bazaargraph.streaming.state import GraphState
from fixtures import rows

SF_DIR = "/root/testdata/sf0.01"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def events(spark):
    return warehouse.graph_events(spark, SF_DIR)


@pytest.fixture(scope="module")
def state(spark, events, tmp_path_factory):
    """A snapshot with one partial after it."""
    state = GraphState(spark, str(tmp_path_factory.mktemp("plans"))).open()
    vertices, edges = build.build_graph(events)
    state.apply_batch(vertices, edges, 0)
    state.snapshot()
    state.apply_batch(vertices, edges, 1)
    return state


@pytest.fixture
def settings(spark):
    """Set session options for one test."""
    changed = []

    def change(options):
        for key, value in options.items():
            spark.conf.set(key, value)
            changed.append(key)

    yield change
    for key in changed:
        spark.conf.unset(key)


def test_vertices_take_one_scan_and_hash_aggregation(events):
    text = plan(build.batch_vertices(events))
    assert text.count("FileScan") == 1
    assert "partial_min" in text and "SortAggregate" not in text
    assert "ReadSchema: struct<user_id:bigint,props:string>" in text


def test_edge_state_aggregates_before_its_only_shuffle(events):
    text = plan(fold.edge_state(build.batch_edges(events)))
    assert text.count("FileScan") == 1 and text.count("Exchange") == 1
    assert "partial_count" in text and "SortAggregate" not in text
    assert "value:double" not in text


def test_windows_aggregate_before_their_only_shuffle(events):
    text = plan(window_revenue(events, price_scale=2))
    assert text.count("Exchange") == 1 and "partial_sum" in text
    assert "SortAggregate" not in text


def test_rankings_keep_k_rows_per_task(events):
    for df in (
        rank.top_edges(fold.edge_state(build.batch_edges(events)), 100),
        rank.popular_products(build.batch_edges(events)),
        lookup.search_ids(build.batch_vertices(events), "prod_1"),
    ):
        assert "TakeOrderedAndProject" in plan(df)


def test_known_actions_reach_the_scan_of_a_raw_log(spark, events, tmp_path):
    path = str(tmp_path / "raw")
    sinks.append_raw_edges(build.batch_edges(events), path, F.lit(5))
    raw = spark.read.parquet(path)
    text = plan(fold.edge_partials(fold.since_epoch(raw, 3)))
    assert "In(relationship, [ACHAT,AIME,VOUT])" in text
    assert re.search(r"PartitionFilters: \[[^]]*epoch_id", text)


def test_replay_prunes_old_epochs(spark, events, tmp_path):
    path = str(tmp_path / "raw")
    sinks.append_raw_edges(build.batch_edges(events), path, 5)
    raw = spark.read.parquet(path)
    partials, _ = fold.replay_raw(raw, build.raw_vertices(build.batch_vertices(events), 5), 3)
    assert re.search(r"PartitionFilters: \[[^]]*epoch_id", plan(partials))


def test_messages_are_parsed_once(spark):
    table = spark.createDataFrame([("{}",)], "value string")
    for df in (sources.accepted(sources.decode(table)), sources.quarantined(sources.decode(table))):
        assert plan(df).count("from_json") == 1


def test_fresh_snapshot_is_read_without_a_shuffle(spark, events, tmp_path):
    state = GraphState(spark, str(tmp_path)).open()
    state.apply_batch(*build.build_graph(events), 0)
    state.snapshot()
    edges, vertices = state.load()
    assert "Exchange" not in plan(edges) and "Exchange" not in plan(vertices)


def test_one_node_is_looked_up_by_a_pushed_filter(state):
    edges, vertices = state.load()
    found, _ = traverse.node_neighbors("usr_7", edges, vertices, hops=1)
    text = plan(found)
    assert "ExistenceJoin" not in text and "SortMergeJoin" not in text
    assert "PushedFilters: [Or(EqualTo(src,usr_7),EqualTo(dst,usr_7))]" in text
    selected, _ = traverse.edge_context("usr_7", _any_product(edges), edges, vertices, hops=0)
    assert "EqualTo(src,usr_7)" in plan(selected)


def _any_product(edges):
    return edges.filter("src = 'usr_7'").orderBy("dst").first().dst


def test_small_frontier_is_broadcast_below_the_merge(state):
    edges, vertices = state.load()
    found, _ = traverse.node_neighbors("usr_7", edges, vertices, hops=2)
    text = plan(found)
    assert text.count("ExistenceJoin") > 0 and "SortMergeJoin" not in text
    # The merge comes after the look-up: it sees only edges near the node.
    assert text.index("HashAggregate") < text.rindex("ExistenceJoin")


def test_few_recent_edges_leave_the_snapshot_in_place(state):
    edges, _ = state.load()
    text = plan(rank.top_edges(edges, 10))
    anti = text[text.index("LeftAnti") :]
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text
    # The untouched part of the snapshot is scanned where it lies.
    first_scan = anti[: anti.index("BroadcastExchange")]
    assert "FileScan" in first_scan and "hashpartitioning" not in first_scan


def test_many_recent_edges_are_merged_by_key(state, monkeypatch):
    few = rows(state.load()[0])
    monkeypatch.setattr(workspace, "BROADCAST_BYTES", -1)
    edges, vertices = state.load()
    assert "Join" not in plan(edges) and "Join" not in plan(vertices)
    assert rows(edges) == few


def hub_edges(spark, n=60_000):
    """A third of the edges end at one product."""
    number = F.col("id")
    hub = F.lit("p0")
    other = F.concat(F.lit("p"), (number % 9_000 + 1).cast("string"))
    return spark.range(0, n, 1, 8).select(
        F.concat(F.lit("u"), number.cast("string")).alias("src"),
        F.when(number % 3 == 0, hub).otherwise(other).alias("dst"),
        (number % 7).cast("double").alias("score"),
        F.lit(None).cast("timestamp").alias("last_interaction"),
    )


SPLIT_EARLY = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128KB",
}


@pytest.mark.parametrize("direction", ["in", "both"])
def test_hub_is_split_in_a_shuffle_join(spark, settings, monkeypatch, direction):
    settings(SPLIT_EARLY)
    monkeypatch.setattr(workspace, "BROADCAST_BYTES", -1)
    edges = hub_edges(spark)
    products = edges.select(F.col("dst").alias("id"))
    found = traverse.incident_edges(edges, products, direction)
    assert len(found.collect()) == 60_000
    assert "skew=true" in plan(found)


def test_walk_through_a_hub_is_whole(spark, settings):
    edges = hub_edges(spark)
    vertices = lookup.endpoint_ids(edges).withColumn("type", F.lit(None).cast("string"))
    found, reached = traverse.node_neighbors("u0", edges, vertices, hops=2)
    assert found.count() == 20_000 and reached.count() == 20_001


@pytest.mark.parametrize("limit", [1000, 0])
def test_top_per_group_with_a_hub(spark, settings, limit):
    """Cut early by Spark itself, or in slices where k is beyond its limit."""
    settings({"spark.sql.optimizer.windowGroupLimitThreshold": str(limit)})
    edges = hub_edges(spark)
    order = [F.col("score").desc(), F.col("src")]
    top = rank.top_per_group(edges, ["dst"], order, 2, spread=["src"])
    text = plan(top)
    if limit:
        assert text.count("Exchange") == 1 and text.count("WindowGroupLimit") == 2
    else:
        assert text.count("Exchange") == 2 and "_slice" in text
    assert top.columns == edges.columns
    best = rows(top.filter("dst = 'p0'"), "src", "score")
    sixes = sorted(f"u{i}" for i in range(0, 60_000, 3) if i % 7 == 6)[:2]
    assert best == [(u, 6.0) for u in sixes]
    assert top.count() == edges.groupBy("dst").count().select(
        F.sum(F.least("count", F.lit(2)))
    ).first()[0]
