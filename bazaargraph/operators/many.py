"""Walks from many seeds at once, as bits.

Seeds are dealt into blocks of up to ``BITS``; a seed is one bit of its block. A row of a
walk is a node, a block and a mask of those seeds of the block that have reached the node,
so one row stands for up to ``BITS`` pairs of a seed and a node, and merging is a bitwise
or, which Spark does before each shuffle, too. Pairs appear only in the result, which
consists of them.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bazaargraph.workspace import cut

WORDS = 4  # of 64 bits, for each row
BITS = 64 * WORDS
MASKS = [f"_m{k}" for k in range(WORDS)]


def number_seeds(seeds: DataFrame) -> DataFrame:
    """(seed_id, _block, _bit) of distinct ids, stored. No block is ordered as a whole table:
    ids are dealt by hash, three quarters of ``BITS`` together, and an overflow opens a block.
    """
    stored = cut(seeds.select("id").distinct(), "seeds")
    blocks = max(1, -(-4 * stored.count() // (3 * BITS)))
    dealt = F.pmod(F.xxhash64("id"), F.lit(blocks))
    place = F.row_number().over(Window.partitionBy("_dealt").orderBy("id")) - 1
    return cut(
        stored.withColumn("_dealt", dealt)
        .withColumn("_place", place)
        .selectExpr(
            "id AS seed_id",
            f"_dealt + {blocks}L * (_place div {BITS}) AS _block",
            f"cast(_place % {BITS} AS int) AS _bit",
        ),
        "numbered",
    )


def _own_masks(numbered: DataFrame) -> DataFrame:
    """Each seed at its own node."""
    bits = (
        f"if(_bit div 64 = {k}, shiftleft(1L, _bit % 64), 0L) AS {m}" for k, m in enumerate(MASKS)
    )
    return numbered.selectExpr("seed_id AS id", "_block", *bits)


def merged(rows: DataFrame, *keys: str) -> DataFrame:
    """Masks of equal keys joined."""
    return rows.groupBy(*keys).agg(*(F.bit_or(m).alias(m) for m in MASKS))


def _any(masks: list[Column]) -> Column:
    return reduce(or_, (m != 0 for m in masks))


def ways(direction: str) -> list[tuple[str, str]]:
    """(near end, far end) of an edge, for each way it may be walked."""
    known = {"out": [("src", "dst")], "in": [("dst", "src")]}
    return known["out"] + known["in"] if direction == "both" else known[direction]


def _arrived(near: DataFrame, pairs: DataFrame, direction: str) -> DataFrame:
    """Masks at the far ends of all edges at the near nodes."""
    steps = [
        pairs.join(near, F.col(close) == F.col("id")).select(F.col(far).alias("id"), "_block", *MASKS)
        for close, far in ways(direction)
    ]
    return merged(reduce(DataFrame.unionByName, steps), "id", "_block")


def reach(numbered: DataFrame, pairs: DataFrame, steps: int, direction: str) -> DataFrame:
    """(id, _block, masks): the seeds that reach each node within so many steps, stored."""
    seen = cut(_own_masks(numbered), "seen")
    frontier = seen
    for _ in range(steps):
        known = seen.select("id", "_block", *(F.col(m).alias(f"{m}k") for m in MASKS))
        fresh = [F.col(m).bitwiseAND(F.bitwise_not(F.coalesce(f"{m}k", F.lit(0)))) for m in MASKS]
        arrived = _arrived(frontier, pairs, direction)
        frontier = cut(
            arrived.join(known, ["id", "_block"], "left")
            .select("id", "_block", *(f.alias(m) for f, m in zip(fresh, MASKS, strict=True)))
            .where(_any([F.col(m) for m in MASKS])),
            "frontier",
        )
        if frontier.isEmpty():
            break
        seen = cut(merged(seen.unionByName(frontier), "id", "_block"), "seen")
    return seen


def masked_edges(seen: DataFrame, edges: DataFrame, direction: str) -> DataFrame:
    """The edges at the nodes seen, each once for every block, with the seeds that see it."""
    columns = [f"`{c}`" for c in edges.columns]
    at = [
        edges.join(seen, F.col(close) == F.col("id")).select(*columns, "_block", *MASKS)
        for close, _ in ways(direction)
    ]
    if len(at) == 1:
        return at[0]
    return merged(reduce(DataFrame.unionByName, at), *columns, "_block")


def per_seed(rows: DataFrame, numbered: DataFrame) -> DataFrame:
    """One row for each bit that is set, with its ``seed_id``, in place of block and masks."""
    members = numbered.groupBy("_block").agg(
        F.collect_list(F.struct("_bit", "seed_id")).alias("_members")
    )
    word = F.expr(" ".join(
        ["CASE _member._bit div 64"]
        + [f"WHEN {k} THEN {m}" for k, m in enumerate(MASKS)] + ["END"]
    ))
    others = [f"`{c}`" for c in rows.columns if c not in ("_block", *MASKS)]
    return (
        rows.join(members, "_block")
        .select(*others, *MASKS, F.explode("_members").alias("_member"))
        .where(F.getbit(word, F.expr("_member._bit % 64")) == 1)
        .select(F.col("_member.seed_id").alias("seed_id"), *others)
    )
