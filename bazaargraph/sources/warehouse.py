"""Marketplace events from the star-schema test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _action() -> F.Column:
    kind = F.col("event_type")
    return (
        F.when(kind == "view", "AIME")
        .when(kind == "click", "VOUT")
        .when(kind == "purchase", "ACHAT")
        .otherwise(kind)
    )


def _mapped(log: DataFrame) -> DataFrame:
    # ``props`` is flat, {"k": number}. A pattern reads it several times faster
    # than a JSON parser, which would take most of the time of every query.
    product = F.regexp_extract("props", r'"k"\s*:\s*(\d+)', 1).try_cast("long")
    return log.select(
        F.col("ts").alias("timestamp"),
        F.col("user_id").alias("_user"),
        product.alias("_product"),
        F.concat(F.lit("usr_"), F.col("user_id").cast("string")).alias("user_id"),
        F.concat(F.lit("prod_"), product.cast("string")).alias("product_id"),
        F.concat(F.lit("sel_"), (product % 7).cast("string")).alias("seller_id"),
        _action().alias("action_type"),
        F.col("value").alias("price"),
    )


def from_log(log: DataFrame) -> DataFrame:
    """Event columns the graph needs, from rows of ``events``."""
    return _mapped(log).drop("_user", "_product")


def graph_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event columns the graph needs. They all come from ``events``: no join."""
    return from_log(table(spark, sf_dir, "events"))


def full_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with the user's city and the product's category.

    The tables joined on are keyed by the join column. Whether one is broadcast
    is left to the planner, which knows its size; otherwise the log is the side
    that the adaptive skew join splits.
    """
    cities = table(spark, sf_dir, "customer").join(
        table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    ).select("c_custkey", F.col("n_name").alias("user_city"))
    categories = table(spark, sf_dir, "part").select(
        "p_partkey", F.col("p_type").alias("product_cat")
    )
    return (
        _mapped(table(spark, sf_dir, "events"))
        .join(cities, F.col("_user") == F.col("c_custkey"), "left")
        .join(categories, F.col("_product") == F.col("p_partkey"), "left")
        .select(
            "timestamp",
            "user_id",
            "user_city",
            "product_id",
            "product_cat",
            "seller_id",
            "action_type",
            "price",
        )
    )
