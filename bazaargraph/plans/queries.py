"""The registered queries: each operator over the whole given tables.

A query takes (spark, sf_dir). Queries that read the edges more than once store
the graph first, as a running system would, and read the stored state.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import add

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaargraph.operators import build, export, fold, lookup, rank, reports, traverse
from bazaargraph.operators.windows import window_revenue as revenue_per_window
from bazaargraph.session import apply_conf
from bazaargraph.sources import events as messages
from bazaargraph.schemas import raw_edges_schema
from bazaargraph.sources import sinks, warehouse
from bazaargraph.sources.rawlog import RawLog
from bazaargraph.streaming import fold_store, streams
from bazaargraph.streaming.bucketed import BucketedGraphState
from bazaargraph.streaming.state import GraphState
from bazaargraph.streaming.window_table import WindowTable
from bazaargraph.workspace import read_table, scratch_path

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

# Arguments of the point queries.
NODE = "usr_7"
PRODUCT = "prod_7"
PREFIX = " PROD_1"
# Epochs are day numbers here; the replay starts after 2024-01-15.
REPLAY_AFTER = 19737
# Single steps of a walk start at the ends of this many best edges.
START_EDGES = 10
# Files for a stream hold about this much text each; a task writes one.
FILE_BYTES = 64 * 1024 * 1024


def query(run: Query) -> Query:
    def configured(spark: SparkSession, sf_dir: str) -> DataFrame:
        apply_conf(spark)
        return run(spark, sf_dir)

    QUERIES[run.__name__] = configured
    return run


def _zoneless(df: DataFrame) -> DataFrame:
    """Timestamps as they stand in UTC, for comparison with other engines."""
    return df.select(
        *(
            F.col(name).cast("timestamp_ntz").alias(name) if kind == "timestamp" else name
            for name, kind in df.dtypes
        )
    )


def _day() -> F.Column:
    return F.datediff("timestamp", F.lit("1970-01-01")).cast("long")


def _graph(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(edges, vertices) of all events, evaluated where they are used."""
    vertices, edges = build.build_graph(warehouse.graph_events(spark, sf_dir))
    return fold.edge_state(edges), vertices


def _state(spark: SparkSession, sf_dir: str) -> GraphState:
    """All events applied as one epoch to a new stored state."""
    vertices, edges = build.build_graph(warehouse.graph_events(spark, sf_dir))
    state = GraphState(spark, scratch_path(spark, "state")).open()
    state.apply_batch(vertices, edges, epoch_id=0)
    return state


def _stored(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return _state(spark, sf_dir).load()


def _json_messages(events: DataFrame) -> DataFrame:
    """Events as JSON text with ISO times, the form a producer sends."""
    time = F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    body = events.withColumn("timestamp", time)
    return body.select(F.to_json(F.struct("*")).alias("value"))


def _files(rows: DataFrame, least: int) -> int:
    """Number of files of ``FILE_BYTES`` that the rows fill as text, but no fewer than ``least``."""
    lengths = (F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in rows.columns)
    size = rows.agg(F.sum(reduce(add, lengths).cast("long"))).first()[0] or 0
    return max(least, -(-size // FILE_BYTES))


# -- sources and decoding -------------------------------------------------


@query
def events_decoded(spark, sf_dir):
    sent = _json_messages(warehouse.full_events(spark, sf_dir))
    received = sent.select(F.col("value").cast("binary").alias("value"))
    return _zoneless(messages.accepted(messages.decode(received)))


def _mixed_messages(spark, sf_dir):
    """Event messages, some without seller or with a wrong time, among free text."""
    action = F.col("action_type")
    events = (
        warehouse.graph_events(spark, sf_dir)
        .withColumn("timestamp", F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"))
        .withColumn("timestamp", F.when(action == "signup", "soon").otherwise(F.col("timestamp")))
        .withColumn("seller_id", F.when(action != "error", F.col("seller_id")))
        .select(F.to_json(F.struct("*")).alias("value"))
    )
    texts = warehouse.table(spark, sf_dir, "documents").select(F.col("text").alias("value"))
    return events.unionByName(texts)


@query
def quarantined_messages(spark, sf_dir):
    return messages.quarantined(messages.decode(_mixed_messages(spark, sf_dir)))


@query
def accepted_messages(spark, sf_dir):
    return _zoneless(messages.accepted(messages.decode(_mixed_messages(spark, sf_dir))))


# -- graph of a batch -------------------------------------------------------


@query
def graph_vertices(spark, sf_dir):
    return build.batch_vertices(warehouse.graph_events(spark, sf_dir))


@query
def graph_edges(spark, sf_dir):
    return build.batch_edges(warehouse.graph_events(spark, sf_dir))


@query
def graph_edges_free_purchases(spark, sf_dir):
    events = warehouse.graph_events(spark, sf_dir)
    return build.batch_edges(events, zero_price_actions=["ACHAT"])


@query
def edge_state(spark, sf_dir):
    return _graph(spark, sf_dir)[0]


@query
def vertex_state(spark, sf_dir):
    events = warehouse.graph_events(spark, sf_dir).withColumn("epoch_id", _day())
    return fold.vertex_state(build.batch_vertices(events, by=["epoch_id"]))


@query
def vertex_state_mixed_roles(spark, sf_dir):
    """Ids that occur in several roles: cities and categories stand in for the ids."""
    events = warehouse.full_events(spark, sf_dir).select(
        _day().alias("epoch_id"),
        F.col("user_city").alias("user_id"),
        F.when(F.col("action_type") == "ACHAT", F.col("product_cat"))
        .otherwise(F.col("user_city"))
        .alias("product_id"),
        F.col("product_cat").alias("seller_id"),
    )
    return fold.vertex_state(build.batch_vertices(events, by=["epoch_id"]))


@query
def strong_edges(spark, sf_dir):
    return traverse.strong_enough(_graph(spark, sf_dir)[0], 20)


@query
def best_edges(spark, sf_dir):
    edges, vertices = _graph(spark, sf_dir)
    return rank.best_edges(edges, vertices)[0]


@query
def best_edge_vertices(spark, sf_dir):
    edges, vertices = _graph(spark, sf_dir)
    return rank.best_edges(edges, vertices)[1]


@query
def edge_endpoints(spark, sf_dir):
    return lookup.endpoint_ids(_graph(spark, sf_dir)[0])


# -- steps of a walk ----------------------------------------------------------


def _from_best(spark, sf_dir):
    """Stored edges and the endpoints of the best ones, as a frontier."""
    edges, vertices = _stored(spark, sf_dir)
    best, _ = rank.best_edges(edges, vertices, START_EDGES)
    return edges, lookup.endpoint_ids(best)


def _incident(direction):
    def run(spark, sf_dir):
        edges, frontier = _from_best(spark, sf_dir)
        return _zoneless(traverse.incident_edges(edges, frontier, direction))

    run.__name__ = f"incident_{direction}"
    return query(run)


incident_out = _incident("out")
incident_in = _incident("in")
incident_both = _incident("both")


def _frontier(direction):
    def run(spark, sf_dir):
        edges, seen = _from_best(spark, sf_dir)
        incident = traverse.incident_edges(edges, seen, direction)
        return traverse.next_frontier(incident, seen, direction)

    run.__name__ = f"next_frontier_{direction}"
    return query(run)


next_frontier_out = _frontier("out")
next_frontier_in = _frontier("in")
next_frontier_both = _frontier("both")


# -- neighbourhoods -----------------------------------------------------------


def _node_ego(name, what, node=NODE, **arguments):
    def run(spark, sf_dir):
        edges, vertices = _stored(spark, sf_dir)
        found = traverse.node_neighbors(node, edges, vertices, **arguments)
        return _zoneless(found[("edges", "vertices").index(what)])

    run.__name__ = name
    return query(run)


_node_ego("node_ego_edges_h1", "edges", hops=1)
_node_ego("node_ego_vertices_h1", "vertices", hops=1)
_node_ego("node_ego_edges_h2", "edges", hops=2)
_node_ego("node_ego_vertices_h2", "vertices", hops=2)
_node_ego("node_ego_edges_h3", "edges", hops=3)
_node_ego("node_ego_vertices_h0", "vertices", hops=0)
_node_ego("node_ego_out", "edges", hops=2, direction="out")
_node_ego("node_ego_in", "edges", node=PRODUCT, hops=2, direction="in")
_node_ego("node_ego_min_score", "edges", hops=2, min_score=20)
_node_ego("node_ego_capped", "edges", hops=2, max_edges=25)
_node_ego("node_ego_capped_vertices", "vertices", hops=2, max_edges=25)


@query
def popular_products_ego(spark, sf_dir):
    """One ego graph around a table of seeds."""
    edges, vertices = _stored(spark, sf_dir)
    seeds = rank.popular_products(edges)
    return _zoneless(traverse.ego_subgraph(spark, seeds, edges, vertices, hops=1)[0])


def _each_node(name, what, **arguments):
    def run(spark, sf_dir):
        edges, vertices = _stored(spark, sf_dir)
        found = traverse.ego_per_seed(vertices, edges, vertices, **arguments)
        return _zoneless(found[("edges", "vertices").index(what)])

    run.__name__ = name
    return query(run)


_each_node("multi_seed_ego", "edges", hops=1)
_each_node("multi_seed_ego_vertices", "vertices", hops=1)
_each_node("multi_seed_ego_top3", "edges", hops=1, max_edges=3)


@query
def multi_seed_ego_h2(spark, sf_dir):
    """Two hops around each of the popular products."""
    edges, vertices = _stored(spark, sf_dir)
    seeds = rank.popular_products(edges)
    return _zoneless(traverse.ego_per_seed(seeds, edges, vertices, hops=2)[0])


@query
def multi_seed_ego_h2_best(spark, sf_dir):
    """Two hops around every vertex, the strongest edge of each."""
    edges, vertices = _stored(spark, sf_dir)
    found, _ = traverse.ego_per_seed(
        vertices, edges, vertices, hops=2, max_edges=1, with_vertices=False
    )
    return _zoneless(found)


def _context(name, what, strongest=True, **arguments):
    """Context of the strongest edge, or of the weakest, which only a cap's pin keeps."""

    def run(spark, sf_dir):
        edges, vertices = _stored(spark, sf_dir)
        if strongest:
            ranked = rank.top_edges(edges, 1)
        else:
            ranked = edges.orderBy("score", "src", "dst").limit(1)
        edge = ranked.select("src", "dst").first()
        if edge is None:
            return _zoneless((edges, vertices)[("edges", "vertices").index(what)].limit(0))
        found = traverse.edge_context(edge.src, edge.dst, edges, vertices, **arguments)
        return _zoneless(found[("edges", "vertices").index(what)])

    run.__name__ = name
    return query(run)


_context("edge_context_edges", "edges", hops=1)
_context("edge_context_vertices", "vertices", hops=1)
_context("edge_context_h2", "edges", hops=2, min_score=20)
_context("edge_context_capped", "edges", hops=1, max_edges=10)
_context("edge_context_capped_vertices", "vertices", hops=1, max_edges=10)
_context("edge_context_weakest", "edges", strongest=False, hops=1, max_edges=10)
_context("edge_context_weakest_vertices", "vertices", strongest=False, hops=1, max_edges=10)
_context("edge_context_below_min_score", "edges", strongest=False, hops=2, min_score=40)


# -- look-ups and reports ---------------------------------------------------


@query
def id_search(spark, sf_dir):
    return lookup.search_ids(build.batch_vertices(warehouse.graph_events(spark, sf_dir)), PREFIX)


@query
def graph_stats(spark, sf_dir):
    return _state(spark, sf_dir).stats()


@query
def in_degrees(spark, sf_dir):
    return rank.in_degrees(build.batch_edges(warehouse.graph_events(spark, sf_dir)))


@query
def popular_products(spark, sf_dir):
    return rank.popular_products(build.batch_edges(warehouse.graph_events(spark, sf_dir)))


@query
def window_revenue(spark, sf_dir):
    return revenue_per_window(warehouse.graph_events(spark, sf_dir), price_scale=2)


@query
def window_revenue_hourly(spark, sf_dir):
    events = warehouse.graph_events(spark, sf_dir)
    return revenue_per_window(events, width="1 hour", price_scale=2)


@query
def action_mix(spark, sf_dir):
    return reports.action_mix(warehouse.graph_events(spark, sf_dir))


@query
def action_mix_by_city(spark, sf_dir):
    return reports.action_mix(warehouse.full_events(spark, sf_dir), by=["user_city"])


@query
def action_mix_by_category(spark, sf_dir):
    return reports.action_mix(warehouse.full_events(spark, sf_dir), by=["product_cat"])


@query
def catalogue_conflicts(spark, sf_dir):
    return reports.catalogue_conflicts(warehouse.full_events(spark, sf_dir))


@query
def unknown_actions(spark, sf_dir):
    return reports.unknown_actions(warehouse.graph_events(spark, sf_dir))


# -- stored state -------------------------------------------------------------


@query
def raw_edges_aligned(spark, sf_dir):
    """Raw log written by day and read back."""
    edges = build.batch_edges(warehouse.graph_events(spark, sf_dir)).drop("price")
    path = scratch_path(spark, "edges_raw")
    sinks.append_raw_edges(edges, path, _day())
    schema = build.raw_edges(edges, _day()).schema
    return read_table(spark, path, schema)


@query
def raw_replay_edges(spark, sf_dir):
    edges, vertices = _raw_log(spark, sf_dir)
    partials, _ = fold.replay_raw(edges, vertices, REPLAY_AFTER)
    return fold.with_score(partials)


@query
def raw_replay_vertices(spark, sf_dir):
    edges, vertices = _raw_log(spark, sf_dir)
    return fold.replay_raw(edges, vertices, REPLAY_AFTER)[1]


def _raw_log(spark, sf_dir):
    """Raw edges, their times cut to the day so that equal rows occur, and raw vertices."""
    events = warehouse.graph_events(spark, sf_dir).withColumn(
        "timestamp", F.date_trunc("day", "timestamp").cast("timestamp_ntz")
    )
    by_day = events.withColumn("epoch_id", _day())
    return (
        build.raw_edges(build.batch_edges(events), _day()),
        build.batch_vertices(by_day, by=["epoch_id"]),
    )


@query
def raw_ranges_replay_edges(spark, sf_dir):
    """The same replay from a log in ranges of epochs, of which only the later ones are read."""
    edges, _ = _raw_log(spark, sf_dir)
    log = RawLog(spark, scratch_path(spark, "raw"), raw_edges_schema())
    epochs = edges.agg(F.min("epoch_id"), F.max("epoch_id")).first()
    bounds = [epochs[0], REPLAY_AFTER - 3, REPLAY_AFTER + 4, epochs[1] + 1]
    for low, high in zip(bounds, bounds[1:], strict=False):
        log.append(edges.where((F.col("epoch_id") >= low) & (F.col("epoch_id") < high)))
    replayed = fold.distinct_raw_edges(log.read(REPLAY_AFTER))
    return _zoneless(fold.with_score(fold.edge_partials(replayed)))


@query
def raw_edges_distinct(spark, sf_dir):
    return fold.distinct_raw_edges(_raw_log(spark, sf_dir)[0])


@query
def merged_state(spark, sf_dir):
    """Partials per day, merged."""
    edges = build.batch_edges(warehouse.graph_events(spark, sf_dir))
    daily = edges.withColumn("epoch_id", _day())
    return fold.merged_edge_state(fold.edge_partials(daily, by=["epoch_id"]))


@query
def snapshot_edges(spark, sf_dir):
    state = _state(spark, sf_dir)
    state.snapshot()
    return _zoneless(state.load()[0])


@query
def snapshot_vertices(spark, sf_dir):
    state = _state(spark, sf_dir)
    state.snapshot()
    return state.load()[1]


# -- export ---------------------------------------------------------------------


@query
def node_link_nodes(spark, sf_dir):
    return export.node_records(build.batch_vertices(warehouse.graph_events(spark, sf_dir)))


@query
def node_link_links(spark, sf_dir):
    links = export.link_records(_graph(spark, sf_dir)[0])
    return links.withColumn("data", F.to_json("data", export.JSON_OPTIONS))


@query
def node_link_files(spark, sf_dir):
    """Links as written to JSON lines and read back."""
    edges, vertices = _graph(spark, sf_dir)
    path = scratch_path(spark, "node_link")
    export.write_node_link(edges, vertices, path)
    return spark.read.schema("id string, source string, target string, score double").json(
        f"{path}/links"
    )


@query
def keyed_records(spark, sf_dir):
    return export.keyed_records(warehouse.graph_events(spark, sf_dir), "action_type")


@query
def keyed_vertices(spark, sf_dir):
    vertices = build.batch_vertices(warehouse.graph_events(spark, sf_dir))
    return export.keyed_records(vertices, "id")


@query
def keyed_edges(spark, sf_dir):
    return export.keyed_records(build.batch_edges(warehouse.graph_events(spark, sf_dir)), "src")


# -- streams ----------------------------------------------------------------------

NOW = streams.Triggers(available_now=True)


def _halves(spark: SparkSession, sf_dir: str, state: GraphState, between) -> DataFrame:
    """Events of even days, ``between``, then those of odd days; the edges as loaded."""
    events = warehouse.graph_events(spark, sf_dir)
    for epoch in (0, 1):
        half = events.where(F.pmod(_day(), F.lit(2)) == epoch)
        state.apply_batch(*build.build_graph(half), epoch)
        if epoch == 0:
            between(state)
    return state.load()[0]


@query
def state_after_snapshot(spark, sf_dir):
    """A snapshot merged with later partials when read."""
    state = GraphState(spark, scratch_path(spark, "state")).open()
    return _zoneless(_halves(spark, sf_dir, state, GraphState.snapshot))


@query
def snapshot_other_weights(spark, sf_dir):
    """A snapshot taken with a single weight keeps the counts of all actions."""

    def narrow(state: GraphState) -> None:
        GraphState(spark, state.path, weights={"ACHAT": 20.0}).open().snapshot()

    state = GraphState(spark, scratch_path(spark, "state")).open()
    return _zoneless(_halves(spark, sf_dir, state, narrow))


def _bucketed(spark: SparkSession, sf_dir: str, **settings) -> BucketedGraphState:
    """Days in three epochs, with a snapshot of the buckets touched after the second."""
    state = BucketedGraphState(spark, scratch_path(spark, "state"), reverse=True, **settings).open()
    events = warehouse.graph_events(spark, sf_dir)
    for epoch in range(3):
        third = events.where(F.pmod(_day(), F.lit(3)) == epoch)
        state.apply_batch(*build.build_graph(third), epoch)
        if epoch == 1:
            state.snapshot()
    return state


@query
def bucketed_edges(spark, sf_dir):
    """State in buckets, recent parts merged in place when read."""
    return _zoneless(_bucketed(spark, sf_dir).load()[0])


@query
def bucketed_vertices(spark, sf_dir):
    return _bucketed(spark, sf_dir).load()[1]


@query
def bucketed_snapshot(spark, sf_dir):
    """Compacted twice, each time only where something was added."""
    state = _bucketed(spark, sf_dir)
    state.snapshot()
    return _zoneless(state.load()[0])


@query
def bucketed_reverse_edges(spark, sf_dir):
    """The same edges from the copy laid out by destination."""
    return _zoneless(_bucketed(spark, sf_dir).reverse_edges())


@query
def bucketed_stats(spark, sf_dir):
    state = _bucketed(spark, sf_dir)
    state.merge_parts()
    return state.stats()


@query
def bucketed_best_edges(spark, sf_dir):
    """The best edges, without buckets whose bound is below the last of them."""
    return _zoneless(_bucketed(spark, sf_dir).best_edges()[0])


@query
def bucketed_search(spark, sf_dir):
    """An id prefix looked up in ranges of folded ids."""
    return _bucketed(spark, sf_dir).search_ids(PREFIX)


def _bucketed_walk(name, node, **arguments):
    def run(spark, sf_dir):
        state = _bucketed(spark, sf_dir)
        found = traverse.node_neighbors(
            node, *state.load(), reverse=state.reverse_edges(), **arguments
        )
        return _zoneless(found[0])

    run.__name__ = name
    return query(run)


_bucketed_walk("bucketed_ego_h2", NODE, hops=2)
_bucketed_walk("bucketed_ego_in", PRODUCT, hops=2, direction="in")


@query
def rebuilt_state(spark, sf_dir):
    """The state made anew from its raw log, by a reader with fewer weights."""
    state = GraphState(spark, scratch_path(spark, "state"), keep_raw=True).open()
    _halves(spark, sf_dir, state, lambda _: None)
    GraphState(spark, state.path, weights={"ACHAT": 20}, keep_raw=True).rebuild()
    return _zoneless(state.load()[0])


@query
def stream_graph_state(spark, sf_dir):
    """JSON files streamed in several epochs into stored state, with snapshots."""
    sent = scratch_path(spark, "messages")
    events = warehouse.graph_events(spark, sf_dir)
    files = _files(_json_messages(events), max(8, spark.sparkContext.defaultParallelism))
    _json_messages(events.repartition(files)).write.text(sent)

    state = GraphState(spark, scratch_path(spark, "state"), snapshot_every=2).open()
    stream = streams.start_graph_stream(
        messages.ndjson_stream(spark, sent, max_files_per_trigger=-(-files // 5)),
        scratch_path(spark, "checkpoint"),
        on_graph=state.apply_batch,
        triggers=NOW,
    )
    stream.awaitTermination()
    return _zoneless(state.load()[0])


@query
def stream_window_revenue(spark, sf_dir):
    """The events table as a stream, its windows kept in a table."""
    log = warehouse.table(spark, sf_dir, "events")
    arriving = spark.readStream.schema(log.schema).parquet(f"{sf_dir}/events.parquet*")
    events = warehouse.from_log(arriving).withColumn(
        "timestamp", F.col("timestamp").cast("timestamp")
    )
    path = scratch_path(spark, "windows")
    stream = streams.start_window_stream(
        events, scratch_path(spark, "checkpoint"), path, triggers=NOW, price_scale=2
    )
    stream.awaitTermination()
    return _zoneless(streams.read_windows(spark, path))


@query
def stream_fold_store(spark, sf_dir):
    """The events as a stream folded in Spark's state store, started twice."""
    log = warehouse.table(spark, sf_dir, "events")
    sent, checkpoint = scratch_path(spark, "events"), scratch_path(spark, "checkpoint")
    for half in (0, 1):
        part = log.where(F.pmod(F.col("event_id"), F.lit(2)) == half)
        files = _files(part, 3)
        part.repartition(files).write.mode("append").parquet(sent)
        arriving = spark.readStream.schema(log.schema)
        arriving = arriving.option("maxFilesPerTrigger", -(-2 * files // 3))
        events = warehouse.from_log(arriving.parquet(sent)).withColumn(
            "timestamp", F.col("timestamp").cast("timestamp")
        )
        fold_store.start_fold_stream(events, checkpoint, triggers=NOW).awaitTermination()
    return _zoneless(fold_store.read_fold(spark, checkpoint))


@query
def stream_window_table(spark, sf_dir):
    """The events in order of time, an empty file and rows without time among them, as a
    stream of several batches; closed windows and open ones together."""
    log = warehouse.table(spark, sf_dir, "events")
    sent = scratch_path(spark, "events")
    files = _files(log, 6)
    log.repartitionByRange(files, "ts").sortWithinPartitions("ts").write.parquet(sent)
    untimed = log.withColumn("ts", F.lit(None).cast("timestamp_ntz"))
    untimed.unionByName(log.limit(0)).write.mode("append").parquet(sent)
    arriving = spark.readStream.schema(log.schema).option("maxFilesPerTrigger", -(-files // 3))
    arriving = arriving.parquet(sent)
    events = warehouse.from_log(arriving).withColumn(
        "timestamp", F.col("timestamp").cast("timestamp")
    )
    # Files of one folder are taken in no set order, so nothing may be too late here.
    table = WindowTable(spark, scratch_path(spark, "windows"), watermark="3650 days")
    stream = streams.start_window_stream(
        events, scratch_path(spark, "checkpoint"), table, NOW, "3650 days", price_scale=2
    )
    stream.awaitTermination()
    return _zoneless(table.load())


@query
def stream_both(spark, sf_dir):
    """Both streams from one folder of messages, malformed ones among them, run twice: the
    second start goes on from the checkpoints and reopens the stored state. Each run takes
    its half in two batches, of as many files as it fills."""
    events = warehouse.graph_events(spark, sf_dir)
    sent, root = scratch_path(spark, "messages"), scratch_path(spark, "streams")
    texts = warehouse.table(spark, sf_dir, "documents").selectExpr("text AS value")
    for half in (0, 1):
        part = events.where(F.pmod(_day(), F.lit(2)) == half)
        messages_of_half = _json_messages(part).unionByName(texts)
        files = _files(messages_of_half, 2)
        messages_of_half.repartition(files).write.mode("append").text(sent)
        state = BucketedGraphState(spark, f"{root}/state", snapshot_every=2).open()
        table = WindowTable(spark, f"{root}/windows")
        for stream in streams.start_streams(
            spark, f"{root}/checkpoints", messages.ndjson_stream(spark, sent, -(-files // 2)),
            on_graph=state.apply_batch, await_termination=False, windows_path=table,
            quarantine_path=f"{root}/quarantine", triggers=NOW,
        ):
            stream.awaitTermination()
    return _zoneless(BucketedGraphState(spark, f"{root}/state").load()[0])
