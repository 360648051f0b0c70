"""Pipeline stages on awkward rows: whole rows come through, columns keep names and values."""

from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from bazaargraph.llm import mixing
from tests.llm.data import awkward, frame, words
from tests.llm.test_documents import plain_components

CLASHES = ["digest", "_copies", "_copy", "_k1", "key1", "row", "node", "number", "hash1", "order",
           "copies", "mine", "n", "component_id", "n_shingles", "first", "size", "target", "taken"]


def clashing(df):
    """Extra columns named like those that the stages use, and one of maps."""
    extra = {name: F.concat(F.lit(f"{name}-"), F.col("text").substr(1, 5)) for name in CLASHES}
    return df.withColumns(extra | {"tags": F.create_map(F.lit("a"), F.col("lang"))})


def values(df):
    return Counter(map(repr, df.collect()))


def plain_mix(docs):
    """How often each row may come out: the copies of its key, and its share of them."""
    out = {}
    for r in mixing.mix_sources(docs).collect():
        key = (r.doc_id, r.source, r.digest)
        out[key] = out.get(key, 0) + r.copies
    return out


@pytest.mark.parametrize("repeat", [1, 3])
def test_mix_takes_whole_rows(spark, repeat):
    rows = awkward() * repeat
    # Rows that differ in the language alone.
    rows += [(50, words(3, 40), lang, "s1", k, 0.5, "t") for k, lang in enumerate(["en", "de", None])]
    docs = clashing(frame(spark, rows)).cache()
    out = corpus_pipeline.mix(spark, docs, "")
    assert out.columns == docs.columns
    found, before = values(out), values(docs)
    assert set(found) <= set(before)
    per_key = Counter()
    for r in out.withColumn("d", F.xxhash64("text")).collect():
        per_key[r.doc_id, r.source, r.d] += 1
    assert per_key == Counter({k: n for k, n in plain_mix(docs).items() if n})
    languages = Counter(r.lang for r in out.where("doc_id = 50").collect())
    assert not languages or max(languages.values()) - min(
        languages.get(x, 0) for x in ("en", "de", None)
    ) <= 1


def test_near_copies_keep_other_texts_of_an_id(spark):
    base = words(8, 80)
    near = base.replace(base.split()[40], "other")
    rows = awkward() + [
        (60, base, "en", "s", 1, 0.5, "t"), (60, words(9, 70), "en", "s", 1, 0.5, "t"),
        (60, base, "en", "s", 1, 0.5, "t"), (61, near, "de", "s", 1, 0.5, "t"),
        (62, words(9, 70), "fr", "s", 1, 0.5, "t"),
    ]
    docs = clashing(frame(spark, rows)).cache()
    out = corpus_pipeline.drop_near_copies(spark, docs, "")
    assert out.columns == docs.columns and set(values(out)) <= set(values(docs))
    found = Counter((r.doc_id, r.text) for r in out.collect())
    nulls = Counter((r[0], r[1]) for r in rows if r[0] is None)
    assert Counter({k: n for k, n in found.items() if k[0] is None}) == nulls
    assert all(n == 1 for k, n in found.items() if k[0] is not None)
    # Both texts of id 60 are documents; each group keeps one of its texts.
    texts = {(i, t) for i, t, *_ in rows if i is not None}
    numbered = dict(enumerate(sorted(texts, key=repr)))
    groups = plain_components([(k, t) for k, (_, t) in numbered.items()])
    kept = Counter(groups[k][1] for k, doc in numbered.items() if doc in found)
    assert set(kept) == {c for _, c in groups.values()} and set(kept.values()) == {1}
    assert (61, near) not in found and len([k for k in found if k[0] in (60, 62)]) == 2


def test_empty_tables(spark):
    docs = clashing(frame(spark, []))
    for stage in (corpus_pipeline.drop_near_copies, corpus_pipeline.mix):
        out = stage(spark, docs, "")
        assert out.columns == docs.columns and out.isEmpty()
