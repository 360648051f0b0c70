"""License notices in documents, by diagonal voting on word pairs.

Every rolling pair of words of every text is hashed and joined with the positions
of that pair in the templates. A hit votes for its diagonal, the document position
minus the template position: an exact copy puts all its votes on one diagonal,
words left out or put in shift the rest to a neighbour. Votes are sets of template
positions, kept as bits, so that repeats don't count twice.

Base phrases are found where a diagonal has all their pairs. Notices of the method
are found where neighbouring diagonals, merged, cover at least ``COVERED`` of a
template's pairs within a span not much longer than the template. All hits are
checked by their words, not the hash alone.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z. Null and
empty texts have no words, no labels and score 0. Every row is answered, rows with a
null doc_id too; equal rows alike.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bazaargraph.llm.url_filter import LOWER, UPPER
from bazaargraph.workspace import cut

# Fixed values of the task: (phrase, label).
BASE = [
    ("cc by", "cc-by"),
    ("general public license", "gpl"),
    ("all rights reserved", "reserved"),
]
# Notices that the method adds, at most 64 words each.
NOTICES = [
    ("licensed under cc by nc 4 0", "cc-by-nc-notice"),
    ("this work is licensed under the gnu general public license version 3", "gpl-notice"),
    ("licensed under the apache license version 2 0", "apache-notice"),
    ("released under the mit license", "mit-notice"),
    (
        "permission is hereby granted free of charge to any person obtaining a copy of this "
        "software and associated documentation files",
        "mit-notice",
    ),
    (
        "redistribution and use in source and binary forms with or without modification are "
        "permitted provided that the following conditions are met",
        "bsd-notice",
    ),
]
COVERED = 0.7  # share of a notice's word pairs that must be there
NEIGHBOURS = 3  # diagonals at most so far apart are merged
STRETCH = 1.5  # longest span, in template lengths

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"  # what words are split at, after lower-casing


def _templates(spark: SparkSession) -> DataFrame:
    """(first, second, pair, hits): each pair of words once, with its places in the templates."""
    hits: dict[tuple[str, str], list[tuple]] = {}
    for number, (phrase, label) in enumerate(BASE + NOTICES):
        words = phrase.split()
        for at, two in enumerate(zip(words, words[1:], strict=False)):
            place = (number, label, number < len(BASE), len(words) - 1, at, 1 << at)
            hits.setdefault(two, []).append(place)
    kind = "template int, label string, base boolean, pairs int, at int, bit long"
    table = spark.createDataFrame(
        [(*two, places) for two, places in hits.items()],
        f"first string, second string, hits array<struct<{kind.replace(' ', ':').replace(',:', ',')}>>",
    )
    return table.withColumn("pair", F.xxhash64("first", "second"))


def scan_licenses(docs: DataFrame) -> DataFrame:
    """Per row of ``docs`` (doc_id, text, ...): counts, places, labels and a score."""
    key = ["doc_id", "digest"]
    split = F.split(F.translate("text", UPPER, LOWER), BETWEEN)
    words = docs.select(
        "doc_id", F.xxhash64("text").alias("digest"), F.array_remove(split, "").alias("words")
    )
    # A pair travels with its own two words, not with all words of its text. The outer form
    # keeps texts without words, whose place is null.
    following = F.slice("words", F.lit(2), F.size("words"))
    two = F.arrays_zip(F.col("words").alias("first"), following.alias("second"))
    pairs = words.select(
        *key,
        F.greatest(F.size("words"), F.lit(0)).cast("long").alias("n_words"),
        F.posexplode_outer(two).alias("place", "two"),
    ).select(*key, "n_words", "place", "two.first", "two.second")
    # The templates are the fixed list above, so broadcasting them is bounded. Each row of
    # docs keeps its first place, whether that is a hit or not, so one pass answers all.
    begins = F.coalesce("place", F.lit(0)) == 0
    met = cut(
        pairs.withColumn("pair", F.xxhash64("first", "second"))
        .join(F.broadcast(_templates(docs.sparkSession)), ["pair", "first", "second"], "left")
        .where(F.col("hits").isNotNull() | begins)
        .select(*key, "n_words", "place", "hits"),
        "license-hits",
    )
    votes = (
        met.where("hits is not null")
        .select(*key, "place", F.explode("hits").alias("hit"))
        .select(*key, "place", "hit.*")
        .groupBy(
            *key, "template", "label", "base", "pairs", (F.col("place") - F.col("at")).alias("diagonal")
        )
        .agg(
            F.bit_or("bit").alias("votes"),
            F.min("place").alias("low"),
            F.max("place").alias("high"),
        )
    )
    ordered = Window.partitionBy(*key, "template").orderBy("diagonal")
    gap = F.col("diagonal") - F.lag("diagonal").over(ordered) > NEIGHBOURS
    merged = (
        votes.withColumn("opens", F.coalesce(gap, F.lit(True)).cast("int"))
        .withColumn("cluster", F.sum("opens").over(ordered))
        .groupBy(*key, "template", "label", "base", "pairs", "cluster")
        .agg(
            F.bit_count(F.bit_or("votes")).alias("covered"),
            F.count(F.when(F.bit_count("votes") == F.col("pairs"), 1)).alias("exact"),
            F.min(F.when(F.bit_count("votes") == F.col("pairs"), F.col("diagonal"))).alias("first"),
            F.max(F.when(F.bit_count("votes") == F.col("pairs"), F.col("diagonal"))).alias("last"),
            (F.max("high") - F.min("low") + 1).alias("span"),
        )
    )
    share = F.col("covered") / F.col("pairs")
    fits = F.when(F.col("base"), F.col("exact") > 0).otherwise(
        (F.col("exact") > 0) | (share >= COVERED) & (F.col("span") <= STRETCH * F.col("pairs"))
    )
    found = merged.groupBy(*key).agg(
        F.sum(F.when(F.col("base"), F.col("exact"))).alias("n_base"),
        F.min(F.when(F.col("base"), F.col("first"))).alias("first_word"),
        F.max(F.when(F.col("base"), F.col("last"))).alias("last_word"),
        F.collect_set(F.when(F.col("base") & fits, F.col("label"))).alias("base_labels"),
        F.collect_set(F.when(fits, F.col("label"))).alias("labels"),
        F.max(F.when(fits, F.lit(1.0)).otherwise(share / 2)).alias("score"),
    )
    rows = met.where(begins).select(*key, "n_words")

    def joined(labels: str) -> F.Column:
        return F.array_join(F.array_sort(F.coalesce(labels, F.array())), ",").alias(labels)

    same = rows["doc_id"].eqNullSafe(found["doc_id"]) & (rows["digest"] == found["digest"])
    return rows.join(found, same, "left").select(
        rows["doc_id"], "n_words",
        F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"),
        F.col("first_word").cast("long").alias("first_word"),
        F.col("last_word").cast("long").alias("last_word"),
        joined("base_labels"), joined("labels"),
        F.round(F.coalesce("score", F.lit(0.0)), 6).alias("score"),
    )
