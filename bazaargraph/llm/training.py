"""Folds of documents, and bounded samples of labelled ones to fit models on."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TEXT_BYTES = 20_000  # longer texts are not sampled (but scored like all others)


def remainder(folds: int) -> Column:
    """crc32 of doc_id as text, modulo ``folds``; null for a null doc_id."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, fold: Column, per_class: int
) -> pd.DataFrame:
    """(text, label) of at most ``2 * per_class`` documents of the training fold.

    They are the first of each class by a hash of doc_id. At most
    ``2 * per_class * TEXT_BYTES`` bytes reach the driver.
    """
    rated = (
        labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1) & fold)
        .groupBy("doc_id")
        .agg(F.max(label).cast("int").alias("label"))
    )
    rated = rated.join(
        docs.where(F.octet_length("text") <= TEXT_BYTES).select("doc_id"), "doc_id", "left_semi"
    )
    first = [
        rated.where(F.col("label") == value).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)
        for value in (0, 1)
    ]
    chosen = F.broadcast(first[0].unionByName(first[1]))  # 2 * per_class rows at most
    sample = (
        docs.where(F.octet_length("text") <= TEXT_BYTES)
        .join(chosen, "doc_id")
        .groupBy("doc_id", "label")
        .agg(F.min("text").alias("text"))
    )
    return sample.toPandas().sort_values("doc_id", ignore_index=True)[["text", "label"]]
