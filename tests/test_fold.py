import random

import pytest
from pyspark.sql import functions as F

from bazaargraph.operators import build, fold, rank, reports
from bazaargraph.operators.windows import window_revenue
from bazaargraph.sources import events as sources
from fixtures import FOLD, FOLD_EDGES, FOLD_VERTICES, at, messages, rows


@pytest.fixture(scope="module")
def decoded(spark):
    return sources.decode(messages(spark, FOLD)).persist()


@pytest.fixture(scope="module")
def graph(decoded):
    return build.build_graph(sources.accepted(decoded))


def test_edge_state(graph):
    assert rows(fold.edge_state(graph[1])) == FOLD_EDGES


def test_vertices_of_unknown_actions_stay(graph):
    assert rows(graph[0]) == FOLD_VERTICES


def test_every_order_gives_the_same_state(spark):
    for seed in range(3):
        texts = random.Random(seed).sample(FOLD, len(FOLD))
        events = sources.accepted(sources.decode(messages(spark, texts)))
        vertices, edges = build.build_graph(events)
        assert rows(fold.edge_state(edges)) == FOLD_EDGES
        assert rows(vertices) == FOLD_VERTICES


def test_other_weights_make_other_columns(graph):
    state = fold.edge_state(graph[1], {"SHARE": 2.5, "VOUT": 1})
    assert state.columns == ["src", "dst", "score", "last_interaction", "SHARE", "VOUT"]
    assert rows(state, "src", "score") == [("u2", 2.0), ("u3", 2.5)]


def test_last_epoch_decides_the_type(spark):
    seen = spark.createDataFrame(
        [("x", "USER", 1), ("x", "PROD", 2), ("y", "SEL", 3), ("y", None, 4), ("z", "PROD", 1)],
        "id string, type string, epoch_id long",
    )
    assert rows(fold.vertex_state(seen)) == [("x", "PROD"), ("y", None), ("z", "PROD")]


def test_first_role_wins_inside_a_batch(spark):
    events = spark.createDataFrame(
        [("a", "b", "c"), ("b", "c", "d")], "user_id string, product_id string, seller_id string"
    )
    assert rows(build.batch_vertices(events)) == [
        ("a", "USER"),
        ("b", "USER"),
        ("c", "PROD"),
        ("d", "SEL"),
    ]


def test_replay_counts_equal_rows_of_an_epoch_once(graph):
    raw = build.raw_edges(graph[1], 3)
    partials, vertices = fold.replay_raw(raw, build.raw_vertices(graph[0], 3))
    state = fold.with_score(partials)
    assert ("u2", "p1", 5.0, at(7), 0, 1, 0) in rows(state)
    assert rows(vertices, "id", "type") == FOLD_VERTICES


def test_replay_starts_after_the_epoch(graph):
    raw = build.raw_edges(graph[1], 3).union(build.raw_edges(graph[1], 4))
    vertices = build.raw_vertices(graph[0], 4)
    later, _ = fold.replay_raw(raw, vertices, 3)
    assert rows(later, "src", "VOUT") == [("u1", 0), ("u2", 1)]
    nothing, none = fold.replay_raw(raw, vertices, 4)
    assert nothing.isEmpty() and none.isEmpty()


def test_raw_rows_have_a_fixed_shape(graph):
    raw = build.raw_edges(graph[1].drop("price"), 7)
    assert raw.columns == ["src", "dst", "relationship", "timestamp", "price", "epoch_id"]
    assert rows(raw, "price", "epoch_id")[0] == (None, 7)


def test_price_of_free_actions(spark):
    events = spark.createDataFrame(
        [("like", 3.0), ("AIME", 4.0), (None, 5.0)], "action_type string, price double"
    ).select(
        "*",
        *(F.lit("x").alias(c) for c in ("user_id", "product_id", "timestamp")),
    )
    assert rows(build.batch_edges(events), "price") == [(0.0,), (4.0,), (5.0,)]
    free = build.batch_edges(events, ["AIME"])
    assert rows(free, "price") == [(0.0,), (3.0,), (5.0,)]


def test_in_degree_counts_parallel_edges(graph):
    assert rows(rank.in_degrees(graph[1])) == [("p1", 5), ("p2", 1)]
    assert rows(rank.popular_products(graph[1], 1)) == [("p1", 5)]


def test_windows_leave_out_events_without_time(decoded):
    windows = window_revenue(sources.accepted(decoded))
    assert rows(windows) == [
        (at(0), at(60), "ACHAT", 1, 9.5),
        (at(0), at(60), "AIME", 1, 9.5),
        (at(0), at(60), "SHARE", 1, 3.0),
        (at(0), at(60), "VOUT", 2, 19.0),
    ]


def test_quarantine(decoded):
    assert rows(sources.quarantined(decoded)) == [("not json", "bad_json")]


def test_defects(spark):
    texts = [
        "{}",
        "",
        "[1]",
        '{"user_id": "u", "product_id": "p", "price": 1}',
        '{"user_id": "u", "product_id": "p", "seller_id": "s", "timestamp": "yesterday"}',
        '{"user_id": "u", "product_id": "p", "seller_id": "s", "price": "cheap"}',
    ]
    decoded = sources.decode(messages(spark, texts))
    assert dict(rows(decoded, "raw", "defect")) == {
        texts[0]: "bad_json",
        texts[1]: "bad_json",
        texts[2]: "bad_json",
        texts[3]: "missing_id",
        texts[4]: "bad_timestamp",
        texts[5]: None,
    }
    # A wrong time keeps the event, as an event without time.
    assert rows(sources.accepted(decoded), "user_id", "timestamp") == [("u", None), ("u", None)]


def test_unknown_actions(spark, decoded):
    events = sources.accepted(decoded)
    assert rows(reports.unknown_actions(events)) == [("SHARE", 1)]
    nameless = events.limit(1).withColumn("action_type", F.lit(None).cast("string"))
    assert rows(reports.unknown_actions(nameless)) == [(None, 1)]


def test_action_mix(decoded):
    row = reports.action_mix(sources.accepted(decoded)).first()
    assert (row.nb_events, row.nb_AIME, row.nb_VOUT, row.nb_ACHAT) == (6, 2, 2, 1)
    assert row.share_AIME == pytest.approx(1 / 3)
    assert row.conversion_rate == pytest.approx(100 / 6)
    empty = reports.action_mix(sources.accepted(decoded).limit(0)).first()
    assert (empty.nb_events, empty.share_AIME, empty.conversion_rate) == (0, 0.0, 0.0)


def test_catalogue_conflicts(spark):
    events = spark.createDataFrame(
        [
            ("p1", "a", "s1", 1.0),
            ("p1", "a", "s1", 1.0),
            ("p2", "a", "s1", 1.0),
            ("p2", "b", "s1", 1.0),
            ("p3", None, "s1", 1.0),
            ("p3", "a", "s1", None),
            ("p4", "a", "s1", 1.0),
            ("p4", "a", "s2", 2.0),
        ],
        "product_id string, product_cat string, seller_id string, price double",
    )
    assert rows(reports.catalogue_conflicts(events)) == [("p2", 2, 1, 1), ("p4", 1, 2, 2)]
