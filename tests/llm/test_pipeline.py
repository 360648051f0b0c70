"""The registered queries of the subpackage, and the pipeline against plain steps."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as registry
import corpus_pipeline
from bazaargraph.llm import queries
from bazaargraph.llm.queries import ORACLE
from tests.llm.test_documents import plain_components

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, name):
    connection = duckdb.connect()
    for table in ("documents", "pages", "embeddings"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    expected = connection.execute(ORACLE[name])
    columns = [c[0] for c in expected.description]
    found = registry.queries()[name](spark, SF_DIR)
    assert sorted(found.columns) == sorted(columns)
    assert sorted(map(tuple, found.select(columns).collect()), key=repr) == sorted(
        expected.fetchall(), key=repr
    )


def test_all_queries_are_registered():
    assert set(queries.QUERIES) | {"pipeline"} <= set(registry.queries())
    numbers = sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES)
    assert numbers == sorted(set(numbers)) and set(range(1, 11)) <= set(numbers) <= set(range(1, 14))


def test_pipeline_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF_DIR)
        before, after = docs.collect(), out.collect()
        if number < 4:
            assert out.columns == docs.columns
            assert {r.doc_id for r in after} <= {r.doc_id for r in before}
        if name == "quality":
            labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
            kept = {r.doc_id for r in after}
            rated = [r.doc_id for r in before if r.doc_id in labels]
            assert sum((i in kept) == bool(labels[i]) for i in rated) >= 0.9 * len(rated)
        if name == "near_copies":
            groups = plain_components([(r.doc_id, r.text) for r in before])
            assert {r.doc_id for r in after} == {i for i, (_, c) in groups.items() if i == c}
        if name == "tokens":
            assert len(after) == len(before) and all(r.restored for r in after)
        path = str(tmp_path / name)
        out.write.parquet(path)
        docs = spark.read.parquet(path)
    assert corpus_pipeline.run(spark, SF_DIR).count() == docs.count()
