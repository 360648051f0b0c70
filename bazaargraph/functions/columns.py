"""Column expressions shared by the operators."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

from bazaargraph.schemas import ROLES, WEIGHTS, ZERO_PRICE_ACTIONS


def named(column: str) -> Column:
    """A column by its exact name, dots and spaces included."""
    return F.col(f"`{column}`")


def known_action(column: str, weights: Mapping[str, float] = WEIGHTS) -> Column:
    """True when the action has a weight; a NULL action has none."""
    return F.coalesce(F.col(column).isin(*weights), F.lit(False))


def score(weights: Mapping[str, float] = WEIGHTS) -> Column:
    """Weighted sum of the action counts."""
    terms = (named(a).cast("double") * F.lit(float(w)) for a, w in weights.items())
    return reduce(add, terms, F.lit(0.0))


def event_price(zero_price_actions: Iterable[str] = ZERO_PRICE_ACTIONS) -> Column:
    """0.0 for the given actions, else the event's price (also for a NULL action)."""
    free = F.col("action_type").isin(*zero_price_actions)
    return F.when(free, F.lit(0.0)).otherwise(F.col("price"))


def role_rank(column: str = "type") -> Column:
    """Position of a vertex type in ``ROLES``; other types come after them."""
    rank = F.lit(len(ROLES))
    for position, role in enumerate(ROLES):
        rank = F.when(F.col(column) == role, F.lit(position)).otherwise(rank)
    return rank


def role_name(rank: Column) -> Column:
    """Inverse of ``role_rank`` for the known roles."""
    return F.element_at(F.array(*(F.lit(role) for role in ROLES)), rank + 1)


def strongest_first(of: str = "") -> list[Column]:
    """Order of every edge ranking; source and target settle ties. ``of`` is a prefix."""
    return [
        F.col(f"{of}score").desc(),
        F.col(f"{of}last_interaction").desc_nulls_last(),
        F.col(f"{of}src"),
        F.col(f"{of}dst"),
    ]


def edge_key(columns: Iterable[str]) -> Column:
    """``src__dst``, unless the row brings a non-empty ``id`` of its own."""
    pair = F.concat_ws("__", "src", "dst")
    if "id" in columns:
        return F.coalesce(F.nullif(F.col("id"), F.lit("")), pair)
    return pair


def node_label() -> Column:
    """The vertex type, or the id where the type is missing or empty."""
    return F.coalesce(F.nullif(F.col("type"), F.lit("")), F.col("id"))
