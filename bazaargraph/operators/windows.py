"""Events and revenue per time window and action, for tables and streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def window_revenue(
    events: DataFrame,
    width: str = "1 minute",
    watermark: str | None = None,
    price_scale: int | None = None,
) -> DataFrame:
    """Count and price sum per tumbling window and action.

    Events without time belong to no window. ``watermark`` matters for streams
    only. ``price_scale`` sums prices as decimals with that many places, which
    gives the same sum for every order of the rows; a price too large for that counts
    as missing. Without it doubles are summed.
    """
    if watermark is not None:
        events = events.withWatermark("timestamp", watermark)
    if price_scale is None:
        revenue = F.sum("price")
    else:
        exact = F.col("price").try_cast(f"decimal(18,{price_scale})")
        revenue = F.sum(exact).cast("double")
    return (
        events.groupBy(F.window("timestamp", width), "action_type")
        .agg(F.count(F.lit(1)).alias("nb_events"), revenue.alias("chiffre_affaires"))
        .select(
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            "action_type",
            "nb_events",
            "chiffre_affaires",
        )
    )


def latest_windows(updates: DataFrame) -> DataFrame:
    """Current value per window and action from update rows marked with their epoch."""
    value = F.struct("nb_events", "chiffre_affaires")
    return (
        updates.groupBy("window_start", "window_end", "action_type")
        .agg(F.max_by(value, "epoch_id").alias("value"))
        .select("window_start", "window_end", "action_type", "value.*")
    )
