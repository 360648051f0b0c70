import json

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from bazaargraph.operators import build, export, fold
from bazaargraph.sources import events as sources
from bazaargraph.sources import sinks
from fixtures import FOLD, messages, rows


@pytest.fixture(scope="module")
def graph(spark):
    vertices, edges = build.build_graph(
        sources.accepted(sources.decode(messages(spark, FOLD)))
    )
    return fold.edge_state(edges).persist(), vertices.persist()


def test_nodes(spark, graph):
    assert ("u1", "USER", "USER") in rows(export.node_records(graph[1]))
    odd = spark.createDataFrame(
        [("a", None, 1), ("b", "", 2)], "id string, type string, rank int"
    )
    assert rows(export.node_records(odd)) == [("a", "a", None, 1), ("b", "b", "", 2)]


def test_links(graph):
    links = export.link_records(graph[0])
    assert links.columns == ["id", "source", "target", "score", "data", "AIME", "VOUT", "ACHAT"]
    link = links.filter("source = 'u1'").first()
    assert (link.id, link.target, link.score, link.AIME, link.ACHAT) == ("u1__p1", "p1", 22.0, 2, 1)
    assert link.data.score == 22.0 and link.data.src == "u1"


def test_link_ids_and_missing_columns(spark):
    own = spark.createDataFrame(
        [("a", "b", "x"), ("a", "c", ""), ("a", "d", None)], "src string, dst string, id string"
    )
    links = export.link_records(own)
    assert links.columns == ["id", "source", "target", "score", "data"]
    assert rows(links, "id", "score") == [("a__c", 0.0), ("a__d", 0.0), ("x", 0.0)]


def test_files(graph, tmp_path, spark):
    export.write_node_link(*graph, str(tmp_path))
    links = [
        json.loads(line)
        for file in (tmp_path / "links").glob("*.json")
        for line in file.read_text().splitlines()
    ]
    assert {link["id"] for link in links} == {"u1__p1", "u2__p1"}
    assert {link["data"]["last_interaction"] for link in links} == {
        "2026-01-01T00:00:10.000000Z",
        "2026-01-01T00:00:07.000000Z",
    }
    nodes = spark.read.json(str(tmp_path / "nodes"))
    assert nodes.count() == 7


def test_keyed_records(spark):
    df = spark.createDataFrame([("a", 1.5, None), (None, 2.0, "z")], "k string, n double, t string")
    assert rows(export.keyed_records(df, "k")) == [
        ("a", '{"k":"a","n":1.5}'),
        (None, '{"n":2.0,"t":"z"}'),
    ]


def test_publishing_needs_the_connector(graph):
    with pytest.raises(AnalysisException, match="(?i)kafka"):
        sinks.publish(graph[1], "id", "localhost:9092", "graph-vertices")


def test_raw_log_replaces_only_its_epochs(spark, tmp_path):
    path = str(tmp_path / "raw")
    for epoch, role in ((1, "USER"), (2, "PROD"), (1, "SEL")):
        vertex = spark.createDataFrame([("x", role)], "id string, type string")
        sinks.append_raw_vertices(vertex, path, epoch)
    assert rows(spark.read.parquet(path), "type", "epoch_id") == [("PROD", 2), ("SEL", 1)]
    by_length = spark.createDataFrame([("xx", "A"), ("y", "B")], "id string, type string")
    sinks.append_raw_vertices(by_length, path, F.length("id"))
    assert rows(spark.read.parquet(path), "type", "epoch_id") == [("A", 2), ("B", 1)]
