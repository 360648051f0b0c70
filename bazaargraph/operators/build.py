"""The graph of one batch of events."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaargraph.functions.columns import event_price, role_name
from bazaargraph.schemas import ID_COLUMNS, ZERO_PRICE_ACTIONS


def vertex_roles(events: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Three rows per event, ``id`` and ``role`` (position in ``ROLES``), in one scan."""
    roles = F.array(
        *(
            F.struct(F.col(column).alias("id"), F.lit(position).alias("role"))
            for position, column in enumerate(ID_COLUMNS)
        )
    )
    return events.select(*by, F.inline(roles))


def batch_vertices(events: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One row per id (and ``by``). An id in several roles keeps the first of ``ROLES``.

    The role stays a number through the aggregation, which keeps it a hash
    aggregation with a partial step before the shuffle.
    """
    return (
        vertex_roles(events, by)
        .groupBy(*by, "id")
        .agg(F.min("role").alias("role"))
        .select(*by, "id", role_name(F.col("role")).alias("type"))
    )


def batch_edges(
    events: DataFrame, zero_price_actions: Iterable[str] = ZERO_PRICE_ACTIONS
) -> DataFrame:
    """One user-to-product edge per event, unknown actions included."""
    return events.select(
        F.col("user_id").alias("src"),
        F.col("product_id").alias("dst"),
        F.col("action_type").alias("relationship"),
        F.col("timestamp"),
        event_price(zero_price_actions).alias("price"),
    )


def build_graph(
    events: DataFrame, zero_price_actions: Iterable[str] = ZERO_PRICE_ACTIONS
) -> tuple[DataFrame, DataFrame]:
    """(vertices, edges) of a batch."""
    return batch_vertices(events), batch_edges(events, zero_price_actions)


def _epoch(epoch_id: int | Column) -> Column:
    column = epoch_id if isinstance(epoch_id, Column) else F.lit(epoch_id)
    return column.cast("long").alias("epoch_id")


def raw_edges(edges: DataFrame, epoch_id: int | Column) -> DataFrame:
    """Edges in the raw log's column order; a missing price becomes NULL."""
    price = F.col("price") if "price" in edges.columns else F.lit(None).cast("double")
    return edges.select(
        "src", "dst", "relationship", "timestamp", price.alias("price"), _epoch(epoch_id)
    )


def raw_vertices(vertices: DataFrame, epoch_id: int | Column) -> DataFrame:
    """Vertices in the raw log's column order."""
    return vertices.select("id", "type", _epoch(epoch_id))
