"""Reports on the events themselves."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaargraph.functions.columns import known_action, named
from bazaargraph.schemas import WEIGHTS


def action_mix(
    events: DataFrame,
    by: Sequence[str] = (),
    weights: Mapping[str, float] = WEIGHTS,
    purchase: str = "ACHAT",
) -> DataFrame:
    """Events, count and share per action, and the purchase rate in percent.

    One row in all, or one per value of the ``by`` columns.
    """
    action = F.col("action_type")
    counts = events.groupBy(*by).agg(
        F.count(F.lit(1)).alias("nb_events"),
        *(F.count_if(action == a).alias(f"nb_{a}") for a in weights),
    )
    # An empty input still has a row when there is no grouping; its rates are 0.
    total = F.greatest(F.col("nb_events"), F.lit(1))
    return counts.select(
        *by,
        "nb_events",
        *(named(f"nb_{a}") for a in weights),
        *((named(f"nb_{a}") / total).alias(f"share_{a}") for a in weights),
        (named(f"nb_{purchase}") * 100 / total).alias("conversion_rate"),
    )


def catalogue_conflicts(events: DataFrame) -> DataFrame:
    """Products with more than one category, seller or price.

    Spark sees each value of a column apart and drops repeated ones in a partial step, so
    a busy product shrinks to its few different values before they are shuffled.
    """
    return (
        events.groupBy("product_id")
        .agg(
            F.count_distinct("product_cat").alias("nb_categories"),
            F.count_distinct("seller_id").alias("nb_sellers"),
            F.count_distinct("price").alias("nb_prices"),
        )
        .filter("nb_categories > 1 OR nb_sellers > 1 OR nb_prices > 1")
    )


def unknown_actions(
    events: DataFrame, weights: Mapping[str, float] = WEIGHTS
) -> DataFrame:
    """Events per action that has no weight and so makes no edge."""
    return (
        events.filter(~known_action("action_type", weights))
        .groupBy("action_type")
        .agg(F.count(F.lit(1)).alias("nb_events"))
    )
