"""Fixed schemas and the default action weights."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql.types import (
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# The points one event of each action adds to its edge's score.
WEIGHTS: dict[str, float] = {"AIME": 1.0, "VOUT": 5.0, "ACHAT": 20.0}

# Vertex types, in the order that decides between two roles of
# one id inside a batch (the first wins).
ROLES: tuple[str, ...] = ("USER", "PROD", "SEL")

# Actions whose events carry no price.
ZERO_PRICE_ACTIONS: tuple[str, ...] = ("like",)

ID_COLUMNS: tuple[str, ...] = ("user_id", "product_id", "seller_id")


# The column names, types and nullability of the tables below.


def event_schema() -> StructType:
    """One JSON event; ``timestamp`` is still text here."""
    return StructType(
        [
            StructField("timestamp", StringType()),
            StructField("user_id", StringType()),
            StructField("user_city", StringType()),
            StructField("product_id", StringType()),
            StructField("product_cat", StringType()),
            StructField("seller_id", StringType()),
            StructField("action_type", StringType()),
            StructField("price", DoubleType()),
        ]
    )


def raw_edges_schema() -> StructType:
    return StructType(
        [
            StructField("src", StringType(), False),
            StructField("dst", StringType(), False),
            StructField("relationship", StringType(), False),
            StructField("timestamp", TimestampType()),
            StructField("price", DoubleType()),
            StructField("epoch_id", LongType(), False),
        ]
    )


def raw_vertices_schema() -> StructType:
    return StructType(
        [
            StructField("id", StringType(), False),
            StructField("type", StringType()),
            StructField("epoch_id", LongType(), False),
        ]
    )


def edges_schema(weights: Mapping[str, float] = WEIGHTS) -> StructType:
    """Edge state: one count column per weighted action."""
    return StructType(
        [
            StructField("src", StringType(), False),
            StructField("dst", StringType(), False),
            StructField("score", DoubleType(), False),
            StructField("last_interaction", TimestampType()),
            *(StructField(action, LongType(), False) for action in weights),
        ]
    )


def vertices_schema() -> StructType:
    return StructType(
        [StructField("id", StringType(), False), StructField("type", StringType())]
    )


def windows_schema() -> StructType:
    """Window updates as stored: one folder for each epoch."""
    return StructType(
        [
            StructField("window_start", TimestampType()),
            StructField("window_end", TimestampType()),
            StructField("action_type", StringType()),
            StructField("nb_events", LongType()),
            StructField("chiffre_affaires", DoubleType()),
            StructField("epoch_id", LongType()),
        ]
    )
