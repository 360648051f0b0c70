"""Session settings the library relies on; nothing here starts a session."""

from __future__ import annotations

# Skewed keys (one product or user holding a large share of the edges) are split
# at run time by the adaptive skew join, so it must stay on. Times are UTC.
SPARK_CONF: dict[str, str] = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def apply_conf(spark) -> None:
    """Set ``SPARK_CONF`` on a running session (all entries are runtime settings)."""
    for key, value in SPARK_CONF.items():
        spark.conf.set(key, value)
