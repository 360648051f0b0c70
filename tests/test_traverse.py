"""Walks on a hand-made graph, and against a plain walk on random graphs."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from bazaargraph import workspace
from bazaargraph.operators import lookup, rank, traverse
from fixtures import at, rows

SCORES = {("u1", "p1"): 22.0, ("u2", "p1"): 10.0, ("u2", "p2"): 1.0, ("u3", "p2"): 5.0}
TYPES = {"u1": "USER", "u2": "USER", "u3": "USER", "p1": "PROD", "p2": "PROD", "s1": "SEL"}
EDGE_COLUMNS = "src string, dst string, score double, last_interaction timestamp, " + (
    "AIME long, VOUT long, ACHAT long"
)


def edge_table(spark, scores):
    table = [(s, d, score, at(0), 0, 0, 0) for (s, d), score in scores.items()]
    return spark.createDataFrame(table, EDGE_COLUMNS)


@pytest.fixture(scope="module")
def edges(spark):
    return edge_table(spark, SCORES).persist()


@pytest.fixture(scope="module")
def vertices(spark):
    return spark.createDataFrame(list(TYPES.items()), "id string, type string").persist()


@pytest.fixture(params=["broadcast", "shuffle"])
def join(request, monkeypatch, spark):
    """Both ways of looking up incident edges."""
    if request.param == "shuffle":
        monkeypatch.setattr(workspace, "BROADCAST_BYTES", -1)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        yield request.param
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    else:
        yield request.param


def names(result):
    found, nodes = result
    return (
        {s + d for s, d in rows(found, "src", "dst")},
        {i for (i,) in rows(nodes, "id")},
    )


def words(text):
    return set(text.split())


@pytest.mark.parametrize(
    "node, arguments, expected_edges, expected_vertices",
    [
        ("u1", dict(hops=0), "", "u1"),
        ("u1", dict(hops=1), "u1p1", "u1 p1"),
        ("u1", dict(hops=2), "u1p1 u2p1", "u1 p1 u2"),
        ("u1", dict(hops=3), "u1p1 u2p1 u2p2", "u1 p1 u2 p2"),
        ("u1", dict(hops=9), "u1p1 u2p1 u2p2 u3p2", "u1 p1 u2 p2 u3"),
        ("u1", dict(hops=2, max_edges=1), "u1p1", "u1 p1 u2"),
        ("u1", dict(hops=2, max_edges=0), "", "u1 p1 u2"),
        ("u1", dict(hops=2, direction="out"), "u1p1", "u1 p1"),
        ("u1", dict(hops=2, direction="in"), "", "u1"),
        ("p1", dict(hops=1, direction="in"), "u1p1 u2p1", "p1 u1 u2"),
        ("u1", dict(hops=3, min_score=15), "u1p1", "u1 p1"),
        ("s1", dict(hops=2), "", "s1"),
        ("unknown", dict(hops=2), "", ""),
    ],
)
def test_node(join, edges, vertices, node, arguments, expected_edges, expected_vertices):
    found = names(traverse.node_neighbors(node, edges, vertices, **arguments))
    assert found == (words(expected_edges), words(expected_vertices))


@pytest.mark.parametrize(
    "arguments, expected_edges, expected_vertices",
    [
        (dict(hops=0), "u2p2", "u2 p2"),
        (dict(hops=1, min_score=5), "u2p1 u3p2 u2p2", "u2 u3 p1 p2"),
        (dict(hops=1, max_edges=2), "u2p2 u2p1", "u2 p1 p2"),
        (dict(hops=2), "u1p1 u2p1 u2p2 u3p2", "u1 u2 u3 p1 p2"),
    ],
)
def test_edge_context(join, edges, vertices, arguments, expected_edges, expected_vertices):
    found = names(traverse.edge_context("u2", "p2", edges, vertices, **arguments))
    assert found == (words(expected_edges), words(expected_vertices))


def test_missing_edge_is_an_error(edges, vertices):
    with pytest.raises(ValueError, match="u1.*p2"):
        traverse.edge_context("u1", "p2", edges, vertices)


def test_unknown_direction_is_an_error(edges, vertices):
    with pytest.raises(ValueError, match="direction"):
        traverse.node_neighbors("u1", edges, vertices, direction="up")


@pytest.mark.parametrize(
    "direction, incident, frontier",
    [("out", "u1p1", "p1"), ("in", "u2p2 u3p2", "u2 u3"), ("both", "u1p1 u2p2 u3p2", "p1 u2 u3")],
)
def test_steps(spark, join, edges, direction, incident, frontier):
    start = spark.createDataFrame([("u1",), ("p2",), ("u1",)], "id string")
    found = traverse.incident_edges(edges, start, direction)
    assert found.columns == edges.columns
    assert names((found, start))[0] == words(incident)
    ahead = traverse.next_frontier(found, start, direction)
    assert rows(ahead) == [(i,) for i in sorted(words(frontier))]


def test_several_seeds_make_one_graph(spark, edges, vertices):
    found = traverse.ego_subgraph(spark, ["u1", "u3"], edges, vertices, hops=1)
    assert names(found) == (words("u1p1 u3p2"), words("u1 p1 u3 p2"))
    table = spark.createDataFrame([("u1",), ("u3",), ("u3",)], "id string")
    assert names(traverse.ego_subgraph(spark, table, edges, vertices, hops=1)) == names(found)


def test_no_seeds(spark, edges, vertices):
    found = traverse.ego_subgraph(spark, [], edges, vertices, hops=2)
    assert names(found) == (set(), set())


def test_best_edges(edges, vertices):
    best = rank.best_edges(edges, vertices, 2)
    assert names(best) == (words("u1p1 u2p1"), words("u1 u2 p1"))
    assert rank.best_edges(edges, vertices, 0)[0].isEmpty()
    with pytest.raises(ValueError):
        rank.best_edges(edges, vertices, -1)


def test_ties_go_by_time_then_ids(spark):
    tied = spark.createDataFrame(
        [("b", "p", 1.0, at(0)), ("a", "q", 1.0, at(0)), ("a", "p", 1.0, None), ("c", "p", 1.0, at(9))],
        "src string, dst string, score double, last_interaction timestamp",
    )
    top = rank.top_edges(tied, 4).select("src", "dst").collect()
    assert [tuple(r) for r in top] == [("c", "p"), ("a", "q"), ("b", "p"), ("a", "p")]


def test_search(vertices):
    assert rows(lookup.search_ids(vertices, " U"), "id") == [("u1",), ("u2",), ("u3",)]
    assert rows(lookup.search_ids(vertices, "U", limit=2), "id") == [("u1",), ("u2",)]
    assert lookup.search_ids(vertices, "  ").isEmpty()


def test_stats(edges, vertices):
    assert rows(lookup.graph_stats(edges, vertices, 3, 7)) == [(6, 4, 3, 7)]
    empty = lookup.graph_stats(edges.limit(0), vertices.limit(0), 0, -1)
    assert rows(empty) == [(0, 0, 0, -1)]


def plain_walk(scores, seeds, hops, direction, min_score):
    pool = [e for e, score in scores.items() if score >= min_score]
    got, seen, front = set(), set(seeds), set(seeds)
    for _ in range(hops):
        incident = [
            (s, d)
            for s, d in pool
            if (direction != "in" and s in front) or (direction != "out" and d in front)
        ]
        got.update(incident)
        ends = {d for _, d in incident} if direction != "in" else set()
        if direction != "out":
            ends |= {s for s, _ in incident}
        front = ends - seen
        seen |= front
    return got, seen


# Ids are on both sides here, so loops and two-way edges occur as well.
nodes = st.sampled_from([f"n{i}" for i in range(8)])
graphs = st.dictionaries(st.tuples(nodes, nodes), st.integers(0, 9).map(float), min_size=1, max_size=20)


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    scores=graphs,
    hops=st.integers(1, 3),
    direction=st.sampled_from(traverse.DIRECTIONS),
    min_score=st.integers(0, 5),
)
def test_random_graphs(join, spark, scores, hops, direction, min_score):
    edges = edge_table(spark, scores)
    everyone = spark.createDataFrame([(f"n{i}", "USER") for i in range(8)], "id string, type string")
    walk = dict(hops=hops, direction=direction, min_score=min_score)
    got, seen = plain_walk(scores, ["n0"], **walk)
    found, reached = traverse.node_neighbors("n0", edges, everyone, **walk)
    assert rows(found, "src", "dst") == sorted(got)
    assert rows(reached, "id") == sorted((i,) for i in seen)

    per_seed, met = traverse.ego_per_seed(everyone, edges, everyone, **walk)
    expected_edges, expected_nodes = [], []
    for i in range(8):
        got, seen = plain_walk(scores, [f"n{i}"], **walk)
        expected_edges += [(f"n{i}", *edge) for edge in got]
        expected_nodes += [(f"n{i}", node) for node in seen]
    assert rows(per_seed, "seed_id", "src", "dst") == sorted(expected_edges)
    assert rows(met, "seed_id", "id") == sorted(expected_nodes)


def test_cap_per_seed(edges, vertices):
    found, met = traverse.ego_per_seed(vertices, edges, vertices, hops=1, max_edges=1)
    assert rows(found, "seed_id", "src", "dst") == [
        ("p1", "u1", "p1"),
        ("p2", "u3", "p2"),
        ("u1", "u1", "p1"),
        ("u2", "u2", "p1"),
        ("u3", "u3", "p2"),
    ]
    assert ("u2", "p2") in rows(met, "seed_id", "id")


def test_no_hops_per_seed(spark, edges, vertices):
    seeds = spark.createDataFrame([("u1",), ("nobody",)], "id string")
    found, met = traverse.ego_per_seed(seeds, edges, vertices, hops=0)
    assert found.isEmpty()
    assert rows(met) == [("u1", "u1", "USER")]
