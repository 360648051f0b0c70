"""Files that the stream queries send grow in number with the rows, batches don't."""

import glob

import pytest

from bazaargraph.plans import queries
from bazaargraph.streaming.bucketed import BucketedGraphState
from fixtures import rows

ROWS = 400


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("tables"))
    spark.range(ROWS).selectExpr(
        "id AS event_id",
        "cast(timestamp_seconds(1700000000 + id * 3600) AS timestamp_ntz) AS ts",
        "if(id % 50 = 0, NULL, id % 20) AS user_id",
        "element_at(array('view', 'click', 'purchase', 'error'), cast(id % 4 AS int) + 1) AS event_type",
        "cast(id % 9 AS double) AS value",
        """format_string('{"k": %d}', id % 7) AS props""",
    ).write.parquet(f"{folder}/events.parquet")
    spark.range(40).selectExpr("if(id = 0, NULL, concat('text ', id)) AS text").write.parquet(
        f"{folder}/documents.parquet"
    )
    return folder


@pytest.fixture
def paths(monkeypatch):
    """Folders that the query makes, by label; files are small."""
    made = {}
    scratch = queries.scratch_path

    def noted(spark, label):
        made[label] = scratch(spark, label)
        return made[label]

    monkeypatch.setattr(queries, "scratch_path", noted)
    monkeypatch.setattr(queries, "FILE_BYTES", 1500)
    return made


def largest(spark, path, kind):
    found = glob.glob(f"{path.removeprefix('file:')}/part-*")
    return len(found), max(getattr(spark.read, kind)(n).count() for n in found)


def test_both_streams(spark, tables, paths):
    found = rows(queries.QUERIES["stream_both"](spark, tables))
    files, most = largest(spark, paths["messages"], "text")
    assert files > 8 and most < ROWS / 8
    state = BucketedGraphState(spark, f"{paths['streams']}/state")
    assert state.manifest().batch_count == 4
    known = [r for r in rows(queries._zoneless(queries.QUERIES["edge_state"](spark, tables))) if r[0]]
    assert found == known


@pytest.mark.parametrize(
    ("name", "label", "kind", "same"),
    [
        ("stream_graph_state", "messages", "text", "edge_state"),
        ("stream_fold_store", "events", "parquet", "edge_state"),
        ("stream_window_table", "events", "parquet", "window_revenue"),
    ],
)
def test_other_streams(spark, tables, paths, name, label, kind, same):
    found = rows(queries.QUERIES[name](spark, tables))
    files, _ = largest(spark, paths[label], kind)
    assert files > 8
    assert [r for r in found if r[0]] == [
        r for r in rows(queries._zoneless(queries.QUERIES[same](spark, tables))) if r[0]
    ]
