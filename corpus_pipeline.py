"""A training corpus from ``documents``: quality, language, near duplicates, mix, tokens.

Every stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept.
All but the last return the columns of ``documents``; a document that the mix takes
twice then stands there twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bazaargraph.llm import language, mixing, ngram_join, pieces, quality
from bazaargraph.session import apply_conf
from bazaargraph.workspace import cut


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.good_documents(docs, quality.train(docs, labels))


def keep_identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language.identified_documents(docs, language.train(docs))


def _bundled(docs: DataFrame) -> DataFrame:
    """Each row whole as ``row``, beside the columns that stages look at and two hashes of
    all its columns. Maps are hashed as JSON."""
    whole = [
        F.to_json(F.struct(f"`{name}`")) if "map<" in kind else F.col(f"`{name}`")
        for name, kind in docs.dtypes
    ]
    return docs.select(
        F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), "doc_id", "source",
        "text", F.xxhash64("text").alias("digest"),
        F.xxhash64(*whole).alias("hash1"), F.xxhash64(F.lit(1), *whole).alias("hash2"),
    )


def _by_text(rows: DataFrame) -> DataFrame:
    """Adds ``node``: the doc_id or, where that has several texts, for all texts but one a
    number above all ids."""
    texts = rows.select("doc_id", "digest").distinct()
    others = cut(
        texts.groupBy("doc_id")
        .agg(F.count(F.lit(1)).alias("texts"), F.min("digest").alias("first"))
        .where("texts > 1")
        .select("doc_id", "first")
        .join(texts, "doc_id")
        .where("digest <> first")
        .select("doc_id", "digest", F.monotonically_increasing_id().alias("number")),
        "pipeline-other-texts",
    )
    top = rows.agg(F.max("doc_id")).first()[0] or 0
    # Few texts, as a rule; the table is stored, so the planner knows whether to broadcast it.
    return rows.join(others, ["doc_id", "digest"], "left").withColumn(
        "node", F.coalesce(F.col("number") + F.lit(top + 1), "doc_id")
    )


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the text with the smallest doc_id stays, once.

    Documents without a doc_id, which link with nothing, all stay. Rows of one doc_id with
    different texts are different documents; of rows that have a text and doc_id in common
    the one with the smallest hash stays.
    """
    placed = _by_text(_bundled(docs).where("doc_id is not null"))
    groups = ngram_join.jaccard_components(placed.select(F.col("node").alias("doc_id"), "text"))
    first = groups.where("doc_id = component_id").select(F.col("doc_id").alias("node")).distinct()
    kept = (
        placed.select("node", "row", F.struct("hash1", "hash2").alias("order"))
        .join(first, "node", "left_semi")
        .groupBy("node")
        .agg(F.min_by("row", "order").alias("row"))
        .select("row.*")
    )
    return kept.unionByName(docs.where("doc_id is null"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row as often as the mix takes it.

    Rows of equal doc_id, source and text share their copies by the number of rows, as
    evenly as whole copies go, whatever their other columns hold.
    """
    keys, whole = ["key1", "key2"], ["hash1", "hash2"]
    parts = ("doc_id", "source", "digest")

    def keyed(df: DataFrame) -> DataFrame:
        return df.withColumns({"key1": F.xxhash64(*parts), "key2": F.xxhash64(F.lit(1), *parts)})

    copies = (
        keyed(mixing.mix_sources(docs)).groupBy(*keys).agg(F.sum("copies").alias("copies"))
    )
    rows = keyed(_bundled(docs)).select("row", *keys, *whole)
    alike = Window.partitionBy(*keys)
    upto = alike.orderBy(*whole).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # Rows equal in every column are counted before they meet; texts take no part in this.
    shares = (
        rows.groupBy(*keys, *whole).agg(F.count(F.lit(1)).alias("n"))
        .join(copies.where("copies > 0"), keys)
        .withColumns({"upto": F.sum("n").over(upto), "rows": F.sum("n").over(alike)})
        .withColumn("mine", F.expr("copies * upto div rows - copies * (upto - n) div rows"))
        .where("mine > 0")
        .select(*keys, *whole, "mine")
    )
    taken = rows.dropDuplicates([*keys, *whole]).join(shares, [*keys, *whole])
    each = F.explode(F.sequence(F.lit(1), F.col("mine").cast("int"))).alias("copy")
    return taken.select("row", each).select("row.*")


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pieces.encode_texts(docs).withColumn("n_ids", F.coalesce(F.size("ids"), F.lit(0)))


STAGES = [
    ("quality", keep_good),
    ("language", keep_identified),
    ("near_copies", drop_near_copies),
    ("mix", mix),
    ("tokens", tokenize),
]

# SQL cannot express the models; the stages are tested against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    apply_conf(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
