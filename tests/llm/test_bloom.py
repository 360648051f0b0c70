"""Bloom filters lose no id and let few others pass."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from bazaargraph.llm import bloom


@pytest.mark.parametrize(("most", "passing"), [(bloom.MOST_WORDS, 0.08), (10, 1.0)])
def test_no_id_is_lost(spark, monkeypatch, most, passing):
    monkeypatch.setattr(bloom, "MOST_WORDS", most)
    ids = spark.range(0, 300_000, 3).withColumnRenamed("id", "doc")
    found = bloom.Bloom(ids, "doc")
    tested = found.only(spark.range(300_000), "id")
    assert found.table.count() <= most and tested.columns == ["id"]
    own, others = tested.agg(
        F.count_if(F.col("id") % 3 == 0), F.count_if(F.col("id") % 3 != 0)
    ).first()
    assert own == 100_000 and others <= passing * 200_000


def test_empty_filters_and_nulls(spark):
    none = bloom.Bloom(spark.range(0), "id")
    assert none.only(spark.range(1000), "id").isEmpty()
    nulls = spark.createDataFrame([(None,), (1,)], "doc long")
    assert bloom.Bloom(nulls, "doc").only(spark.range(5), "id").count() >= 1
