"""Neighbourhoods over several hops.

A walk keeps only node ids. Every edge of an ego graph touches a node nearer
than ``hops``, so the edges are fetched once, at the end, and each hop carries
nothing but a table of new ids. That table is written to the shared folder: the
plan stays short, and the table can be measured.

A table of measured, small size is broadcast, which moves no edge and lets the
look-up run below the merge of a stored state. Beyond that size the join
shuffles. The edges are then the side that the adaptive skew join may split, so
a hub node is spread over many tasks.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from typing import Literal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaargraph.functions.columns import strongest_first
from bazaargraph.operators import many
from bazaargraph.operators.lookup import endpoint_ids, vertices_of
from bazaargraph.operators.rank import top_edges, top_per_group
from bazaargraph.operators.strongest import strongest_within
from bazaargraph.workspace import ROW_OVERHEAD, cut, fits_broadcast, measure

Direction = Literal["both", "out", "in"]
DIRECTIONS = ("both", "out", "in")


def _check(direction: str) -> None:
    if direction not in DIRECTIONS:
        raise ValueError(f"direction must be one of {DIRECTIONS}: {direction!r}")


def seed_table(spark: SparkSession, ids: Sequence[str]) -> DataFrame:
    """One ``id`` column of given values, each once."""
    values = F.array(*(F.lit(i) for i in dict.fromkeys(ids))).cast("array<string>")
    return spark.range(1).select(F.explode(values).alias("id"))


def strong_enough(edges: DataFrame, min_score: float | None) -> DataFrame:
    """Edges of at least the given score; all of them without one."""
    if min_score is None:
        return edges
    return edges.filter(F.col("score") >= F.lit(float(min_score)))


def _touches(ids: Sequence[str] | DataFrame, direction: Direction) -> Column:
    """Edge condition for literal ids or, as a subquery, for a table of ids."""
    among = ids if isinstance(ids, DataFrame) else list(ids)
    leaving, arriving = F.col("src").isin(among), F.col("dst").isin(among)
    return {"out": leaving, "in": arriving, "both": leaving | arriving}[direction]


@dataclass(frozen=True)
class _Ids:
    """Distinct ids in a stored table, and the memory a broadcast of them takes."""

    table: DataFrame
    rows: int
    size: int

    @staticmethod
    def stored(ids: DataFrame) -> _Ids:
        table = cut(ids, "ids")
        return _Ids(table, *measure(table, "id"))

    @staticmethod
    def given(spark: SparkSession, ids: Sequence[str]) -> _Ids:
        size = sum(len(i.encode()) + ROW_OVERHEAD for i in ids)
        return _Ids(seed_table(spark, ids), len(ids), size)

    def with_new(self, others: _Ids) -> _Ids:
        """Union with ids known to be different ones."""
        return _Ids(
            self.table.unionByName(others.table),
            self.rows + others.rows,
            self.size + others.size,
        )


def _incident(
    edges: DataFrame, ids: _Ids, direction: Direction, reverse: DataFrame | None = None
) -> DataFrame:
    """Incident edges, without deduplication.

    One scan of the edges, or with ``reverse``, the same edges laid out by destination, a
    scan of each for what it is laid out by.
    """
    if reverse is not None and direction != "out":
        arriving = _incident(reverse, ids, "in")
        if direction == "in":
            return arriving
        known = ids.table.select(F.col("id").alias("_src"))
        known = F.broadcast(known) if fits_broadcast(ids.size) else known
        # Those that leave the ids, too, are in the other scan.
        arriving = arriving.join(known, F.col("src") == F.col("_src"), "left_anti")
        return _incident(edges, ids, "out").unionByName(arriving)
    if fits_broadcast(ids.size):
        return edges.filter(_touches(F.broadcast(ids.table), direction))
    near_src = ids.table.select(F.col("id").alias("_src"))
    near_dst = ids.table.select(F.col("id").alias("_dst"))
    at_src = F.col("src") == F.col("_src")
    at_dst = F.col("dst") == F.col("_dst")
    if direction == "out":
        return edges.join(near_src, at_src, "left_semi")
    if direction == "in":
        return edges.join(near_dst, at_dst, "left_semi")
    arriving = edges.join(near_dst, at_dst, "left_semi").join(near_src, at_src, "left_anti")
    return edges.join(near_src, at_src, "left_semi").unionByName(arriving)


def _given(
    edges: DataFrame, ids: Sequence[str], direction: Direction, reverse: DataFrame | None
) -> DataFrame:
    """Edges incident to literal ids, which become filters that reach the scans."""
    if reverse is None or direction == "out":
        return edges.filter(_touches(ids, direction))
    arriving = reverse.filter(_touches(ids, "in"))
    if direction == "in":
        return arriving
    left = F.coalesce(_touches(ids, "out"), F.lit(False))
    return edges.filter(_touches(ids, "out")).unionByName(arriving.filter(~left))


def incident_edges(
    edges: DataFrame, frontier: DataFrame, direction: Direction = "both"
) -> DataFrame:
    """Edges leaving, entering or touching the frontier's ids."""
    _check(direction)
    return _incident(edges, _Ids.stored(frontier.select("id").distinct()), direction)


def _far_ends(direction: Direction) -> Column:
    return {
        "out": F.col("dst"),
        "in": F.col("src"),
        "both": F.explode(F.array("src", "dst")),
    }[direction]


def next_frontier(
    incident: DataFrame, seen: DataFrame, direction: Direction = "both"
) -> DataFrame:
    """Distinct far ends of incident edges that were not seen before."""
    _check(direction)
    known = seen.select(F.col("id").alias("_id"))
    return (
        incident.select(_far_ends(direction).alias("id"))
        .distinct()
        .join(known, F.col("id") == F.col("_id"), "left_anti")
    )


def _ego(
    spark: SparkSession,
    seeds: DataFrame | Sequence[str],
    edges: DataFrame,
    hops: int,
    min_score: float | None,
    direction: Direction,
    reverse: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(edges of the ego graph, ids of all nodes it reaches)."""
    _check(direction)
    literal = not isinstance(seeds, DataFrame)
    if hops <= 0:
        start = seed_table(spark, seeds) if literal else seeds.select("id").distinct()
        return edges.limit(0), start

    pool = strong_enough(edges, min_score)
    pairs = pool.select("src", "dst")
    back = None if reverse is None else strong_enough(reverse, min_score)
    back_pairs = None if back is None else back.select("src", "dst")
    if literal:
        seen = _Ids.given(spark, seeds)
    else:
        seen = _Ids.stored(seeds.select("id").distinct())
    frontier = seen
    for hop in range(1, hops):
        if literal and hop == 1:
            incident = _given(pairs, seeds, direction, back_pairs)
        else:
            incident = _incident(pairs, frontier, direction, back_pairs)
        frontier = _Ids.stored(next_frontier(incident, seen.table, direction))
        if frontier.rows == 0:
            break
        seen = seen.with_new(frontier)

    # Literal seeds of a single hop become a filter that reaches the scan.
    if literal and hops == 1:
        found = _given(pool, seeds, direction, back)
    else:
        found = _incident(pool, seen, direction, back)
    ends = found.select(F.explode(F.array("src", "dst")).alias("id"))
    return found, ends.unionByName(seen.table).distinct()


def ego_subgraph(
    spark: SparkSession,
    seeds: DataFrame | Sequence[str],
    edges: DataFrame,
    vertices: DataFrame,
    hops: int = 1,
    min_score: float | None = None,
    direction: Direction = "both",
    max_edges: int | None = None,
    reverse: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(edges, vertices) within ``hops`` of any seed.

    ``seeds`` is a DataFrame with ``id`` or a few literal ids. Edges between two
    nodes first reached at the last hop are not part of it. ``max_edges`` keeps
    the strongest edges; the vertices stay all those reached. ``reverse`` may give
    the same edges in a layout by destination, which look-ups by ``dst`` then use.
    """
    found, reached = _ego(spark, seeds, edges, hops, min_score, direction, reverse)
    if max_edges is not None:
        found = top_edges(found, max_edges)
    return found, vertices_of(vertices, reached)


def node_neighbors(
    node_id: str,
    edges: DataFrame,
    vertices: DataFrame,
    hops: int = 1,
    min_score: float | None = None,
    direction: Direction = "both",
    max_edges: int | None = None,
    reverse: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Ego graph of one node; both results are empty for an unknown node."""
    if vertices.filter(F.col("id") == node_id).isEmpty():
        return edges.limit(0), vertices.limit(0)
    return ego_subgraph(
        edges.sparkSession, [node_id], edges, vertices, hops, min_score, direction, max_edges,
        reverse,
    )


def edge_context(
    src: str,
    dst: str,
    edges: DataFrame,
    vertices: DataFrame,
    hops: int = 1,
    min_score: float | None = None,
    max_edges: int | None = None,
    reverse: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Surroundings of one edge, always with the edge itself.

    The vertices are the endpoints of the kept edges. A missing edge is an error.
    """
    is_edge = (F.col("src") == src) & (F.col("dst") == dst)
    selected = edges.filter(is_edge)
    if selected.isEmpty():
        raise ValueError(f"no edge from {src} to {dst}")
    found, _ = _ego(edges.sparkSession, [src, dst], edges, hops, min_score, "both", reverse)
    # State has one row per pair, so leaving the edge out and adding it back
    # makes a set union without a shuffle.
    found = found.filter(~is_edge).unionByName(selected)
    if max_edges is not None:
        found = top_edges(found, max_edges, pinned=(src, dst))
    return found, vertices_of(vertices, endpoint_ids(found))


def _incident_per_seed(near: DataFrame, edges: DataFrame, direction: Direction) -> DataFrame:
    """``seed_id`` with every edge at its seed, each pair once."""
    at_src = edges.join(near, F.col("src") == F.col("id"))
    at_dst = edges.join(near, F.col("dst") == F.col("id"))
    columns = ["seed_id", *edges.columns]
    if direction == "out":
        return at_src.select(columns)
    if direction == "in":
        return at_dst.select(columns)
    # The only near node is the seed, so only a loop can be met twice.
    at_dst = at_dst.filter(F.col("src") != F.col("dst"))
    return at_src.select(columns).unionByName(at_dst.select(columns))


def _more_than(n: int, ids: DataFrame) -> bool:
    return ids.distinct().limit(max(n, 0) + 1).count() > n


def ego_per_seed(
    seeds: DataFrame,
    edges: DataFrame,
    vertices: DataFrame,
    hops: int = 1,
    min_score: float | None = None,
    direction: Direction = "both",
    max_edges: int | None = None,
    with_vertices: bool = True,
) -> tuple[DataFrame, DataFrame | None]:
    """The ego graph of every seed in one job, marked by ``seed_id``.

    Seeds without a vertex row give nothing, as for a single node. The result is
    as large as all the single ego graphs together; over several hops the walk itself
    carries a bit for each seed and node. ``max_edges`` applies to each seed; for many
    seeds its edges are found without the walk, at a cost of ``max_edges`` rows for each
    edge and hop. Then only the vertices need the walk, and are None if not wanted.
    """
    _check(direction)
    start = vertices_of(vertices, seeds.select("id").distinct()).select("id")
    pool = strong_enough(edges, min_score)
    capped = False
    if hops <= 0:
        found = edges.limit(0).select(F.lit("").alias("seed_id"), "*")
        reached = start.select(F.col("id").alias("seed_id"), "id")
    elif hops == 1:
        near = cut(start, "seeds").select(F.col("id").alias("seed_id"), "id")
        found = _incident_per_seed(near, pool, direction)
        ends = found.select("seed_id", F.explode(F.array("src", "dst")).alias("id"))
        reached = ends.union(near).distinct()
    else:
        capped = max_edges is not None and _more_than(2 * hops * max_edges, start)
        if capped:
            found = strongest_within(start, pool, hops, max_edges, direction)
            if not with_vertices:
                return found, None
        numbered = many.number_seeds(start)
        seen = many.reach(numbered, pool.select("src", "dst"), hops - 1, direction)
        masked = many.masked_edges(seen, pool, direction)
        ends = masked.select(F.explode(F.array("src", "dst")).alias("id"), "_block", *many.MASKS)
        nodes = many.merged(ends.unionByName(seen), "id", "_block")
        reached = many.per_seed(nodes, numbered)
        if not capped:
            found = many.per_seed(masked, numbered)
    if max_edges is not None and not capped:
        found = top_per_group(
            found, ["seed_id"], strongest_first(), max_edges, spread=["src", "dst"]
        )
    if not with_vertices:
        return found, None
    return found, reached.join(vertices, "id").select("seed_id", *vertices.columns)
