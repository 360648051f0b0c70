"""Graph state in buckets: read without a shuffle, rewritten only where it changed.

Edges lie in buckets by source, vertices by id, in parts as of ``sources.buckets``. An
epoch's aggregates are a part with those buckets that the epoch touches. The manifest names
for each part the buckets that are valid, which is all that reading and compacting need:

* ``load`` scans buckets with a single valid part as they lie, and merges the others bucket
  by bucket, without an exchange at any number of parts.
* ``snapshot`` merges only the buckets touched since the last one and leaves the others to
  the older parts; a batch of one user rewrites that user's bucket of edges.
* ``reverse_edges`` reads a second copy of the edges, in ranges of their destination, so that
  look-ups by destination open few row groups, and an often bought product spreads over many
  files. A bucket that a later part replaced is left out by its number, kept in each row.

* ``stats`` counts rows of untouched buckets from the manifest, which has their numbers.
* ``best_edges`` knows for each bucket the highest count of each action in each part, hence a
  bound of its scores, and reads only buckets whose bound reaches the last of the best.
* ``search_ids`` looks a prefix up in a copy of the vertices in ranges of the folded id.

A bucket is the unit of work: choose ``buckets`` so that one fits a task (their number is
fixed by the first write). All edges of one source share a bucket, one row per destination.
"""

from __future__ import annotations

import json
import time
from collections import Counter
from collections.abc import Iterable, Mapping
from dataclasses import asdict, dataclass, replace
from functools import reduce
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from bazaargraph.operators.build import raw_edges, raw_vertices
from bazaargraph.operators.fold import (
    edge_partials,
    latest_vertices,
    merge_edge_partials,
    with_score,
)
from bazaargraph.operators.lookup import search_ids
from bazaargraph.operators.rank import best_edges, top_edges
from bazaargraph.schemas import WEIGHTS, raw_edges_schema, raw_vertices_schema
from bazaargraph.sources.buckets import BucketedTable
from bazaargraph.sources.rawlog import RawLog
from bazaargraph.streaming.state import DEFAULT_SNAPSHOT_EVERY, GraphState
from bazaargraph.workspace import exists, folders_of, read_text, remove

BUCKETS = 16


@dataclass(frozen=True)
class Piece:
    """A stored part and its valid buckets of edges and vertices."""

    epoch_id: int
    name: str
    merged: bool
    edges: tuple[int, ...]
    vertices: tuple[int, ...]
    # (bucket, rows, highest count of each action of the manifest) and (bucket, rows).
    edge_stats: tuple[tuple[int, ...], ...] = ()
    vertex_stats: tuple[tuple[int, ...], ...] = ()

    def without(self, edges: Iterable[int], vertices: Iterable[int]) -> Piece:
        return replace(
            self,
            edges=tuple(s for s in self.edges if s not in set(edges)),
            vertices=tuple(s for s in self.vertices if s not in set(vertices)),
        )


@dataclass(frozen=True)
class Layout:
    """The manifest: no bucket is valid in two pieces of ``base``."""

    buckets: int
    reverse: bool = False
    batch_count: int = 0
    last_epoch_id: int = -1
    base: tuple[Piece, ...] = ()
    parts: tuple[Piece, ...] = ()
    actions: tuple[str, ...] = ()

    @property
    def pieces(self) -> tuple[Piece, ...]:
        return (*self.base, *self.parts)

    def to_json(self) -> str:
        return json.dumps(asdict(self))

    @staticmethod
    def from_json(text: str) -> Layout:
        """Anything but a complete manifest raises."""
        fields = json.loads(text)

        def pieces(key: str) -> tuple[Piece, ...]:
            return tuple(
                Piece(
                    p["epoch_id"], p["name"], p["merged"], tuple(p["edges"]), tuple(p["vertices"]),
                    *(tuple(map(tuple, p[k])) for k in ("edge_stats", "vertex_stats")),
                )
                for p in fields[key]
            )

        return Layout(
            int(fields["buckets"]), bool(fields["reverse"]), int(fields["batch_count"]),
            int(fields["last_epoch_id"]), pieces("base"), pieces("parts"), tuple(fields["actions"]),
        )


def touched(pieces: Iterable[Piece], kind: str) -> tuple[int, ...]:
    """The buckets that any of the pieces has."""
    return tuple(sorted({s for piece in pieces for s in getattr(piece, kind)}))


class BucketedGraphState(GraphState):
    """``GraphState`` with its rules for epochs, weights and commits, stored in buckets."""

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        weights: Mapping[str, float] = WEIGHTS,
        snapshot_every: int = DEFAULT_SNAPSHOT_EVERY,
        merge_every: int = 0,
        keep_raw: bool = False,
        buckets: int = BUCKETS,
        reverse: bool = False,
    ) -> None:
        """``buckets`` and ``reverse`` count for a new state; a stored one keeps its own."""
        super().__init__(spark, path, weights, snapshot_every, merge_every, keep_raw)
        self._new = Layout(buckets, reverse)
        self._tables: dict[tuple, BucketedTable] = {}

    def _blank(self) -> Layout:
        return self._new

    def manifest(self) -> Layout:
        if not exists(self.spark, self._manifest_path):
            return self._new
        return Layout.from_json(read_text(self.spark, self._manifest_path))

    def _table(self, kind: str, layout: Layout) -> BucketedTable:
        if kind == "edges":
            schema, key, order = self._edge_schema(layout), "src", ("src", "dst")
        else:
            schema, key, order = raw_vertices_schema(), "id", ("id",)
        what = (kind, layout.buckets, tuple(schema.names))
        if what not in self._tables:
            self._tables[what] = BucketedTable(
                self.spark, f"{self.path}/{kind}", schema, key, order, layout.buckets
            )
        return self._tables[what]

    # -- the raw log, in ranges of epochs ------------------------------------

    def _logs(self) -> tuple[RawLog, RawLog]:
        return (
            RawLog(self.spark, self.raw_edges_path, raw_edges_schema()),
            RawLog(self.spark, self.raw_vertices_path, raw_vertices_schema()),
        )

    def _open_raw(self) -> None:
        """Nothing to create: an absent log reads as an empty one."""

    def _append_raw(self, edges: DataFrame, vertices: DataFrame, epoch_id: int) -> None:
        of_edges, of_vertices = self._logs()
        of_edges.append(raw_edges(edges, epoch_id), epoch_id)
        of_vertices.append(raw_vertices(vertices, epoch_id), epoch_id)

    def raw_log(self, after: int | None = None) -> tuple[DataFrame, DataFrame]:
        """(raw edges, raw vertices), all or those of the epochs after one."""
        of_edges, of_vertices = self._logs()
        return of_edges.read(after), of_vertices.read(after)

    # -- reading ----------------------------------------------------------

    def _merged_rows(self, kind: str, rows: DataFrame, layout: Layout) -> DataFrame:
        if kind == "edges":
            return merge_edge_partials(rows, self._counted(layout))
        return latest_vertices(rows)

    def _state_rows(
        self, kind: str, layout: Layout, among: Iterable[int] | None = None
    ) -> DataFrame:
        """One row per key: buckets of one part as they are, the others merged in place."""
        times = Counter(s for piece in layout.pieces for s in getattr(piece, kind))
        if among is not None:
            times = Counter({s: times[s] for s in among})
        single = {p.name: [s for s in getattr(p, kind) if times[s] == 1] for p in layout.pieces}
        shared = {p.name: [s for s in getattr(p, kind) if times[s] > 1] for p in layout.pieces}
        table = self._table(kind, layout)
        rows = table.read(single)
        if any(shared.values()):
            merged = self._merged_rows(kind, table.read(shared), layout)
            rows = rows.unionByName(merged) if any(single.values()) else merged
        return rows

    def _counts(self, layout: Layout, among: Iterable[int] | None = None) -> DataFrame:
        rows = self._state_rows("edges", layout, among)
        return rows.fillna(0, subset=list(self._counted(layout)))

    def _latest(self, layout: Layout) -> DataFrame:
        return self._state_rows("vertices", layout)

    def reverse_edges(self) -> DataFrame:
        """The edges of ``load`` from the copy that is laid out by destination.

        For look-ups: a condition on ``dst`` reaches the scans, and only what it leaves of
        recent parts is merged by key.
        """
        layout = self.manifest()
        if not layout.reverse:
            raise ValueError("the state was made without its reverse copy")
        schema = self._edge_schema(layout).add("slot", IntegerType())
        pieces = []
        for piece in layout.pieces:
            if piece.edges:
                rows = self.spark.read.schema(schema).parquet(f"{self.path}/reverse/{piece.name}")
                pieces.append(rows.where(F.col("slot").isin(*piece.edges)).drop("slot"))
        if not pieces:
            return self.load()[0]
        rows = reduce(DataFrame.unionByName, pieces)
        if layout.parts:
            rows = merge_edge_partials(rows, self._counted(layout))
        rows = rows.fillna(0, subset=list(self._counted(layout)))
        return with_score(rows, self.weights)

    def stats(self) -> DataFrame:
        """``graph_stats``; rows are read only of buckets that several parts have."""
        layout = self.manifest()
        columns = []
        for kind, of in (("vertices", "vertex_stats"), ("edges", "edge_stats")):
            times = Counter(s for piece in layout.pieces for s in getattr(piece, kind))
            known = sum(
                stat[1]
                for piece in layout.pieces for stat in getattr(piece, of)
                if stat[0] in getattr(piece, kind) and times[stat[0]] == 1
            )
            shared = [s for s, n in times.items() if n > 1]
            merged = self._state_rows(kind, layout, shared).count() if shared else 0
            columns.append(F.lit(known + merged).cast("long").alias(kind))
        return self.spark.range(1).select(
            *columns,
            F.lit(layout.batch_count).cast("long").alias("batch_count"),
            F.lit(layout.last_epoch_id).cast("long").alias("last_epoch_id"),
        )

    def _bounds(self, layout: Layout) -> dict[int, tuple[float, int]]:
        """(no score is above this, at least so many edges) of each bucket of edges."""
        weights = [max(0.0, float(self.weights.get(a, 0.0))) for a in layout.actions]
        bounds: dict[int, tuple[float, int]] = {}
        for piece in layout.pieces:
            for slot, rows, *tops in piece.edge_stats:
                if slot in piece.edges:
                    # Counts of an edge add up over parts, so their bounds do.
                    most = sum(w * (t or 0) for w, t in zip(weights, tops, strict=False))
                    bound, least = bounds.get(slot, (0.0, 0))
                    bounds[slot] = (bound + most, max(least, rows))
        return bounds

    def best_buckets(self, limit: int) -> list[int]:
        """The buckets of edges that can hold one of the best, found by a walk along bounds."""
        layout = self.manifest()
        bounds = self._bounds(layout)
        order = sorted(bounds, key=lambda slot: (-bounds[slot][0], slot))
        first, rows = [], 0
        for slot in order:
            if rows >= limit:
                break
            first.append(slot)
            rows += bounds[slot][1]
        if len(first) == len(order) or limit <= 0:
            return first
        some = with_score(self._counts(layout, first), self.weights)
        last = top_edges(some, limit).agg(F.min("score")).first()[0]
        return [slot for slot in order if bounds[slot][0] >= last or slot in first]

    def best_edges(self, limit: int = 100) -> tuple[DataFrame, DataFrame]:
        """The strongest edges and the vertices they touch, as of ``rank.best_edges``."""
        layout = self.manifest()
        edges = with_score(self._counts(layout, self.best_buckets(limit)), self.weights)
        return best_edges(edges, self.load()[1], limit, self.weights)

    def search_ids(self, query: str, limit: int = 20) -> DataFrame:
        """``lookup.search_ids``, by a range of folded ids where the state has that copy."""
        layout, prefix = self.manifest(), query.strip().lower()
        if not layout.reverse or not prefix:
            return search_ids(self.load()[1], query, limit)
        schema = raw_vertices_schema().add("folded", "string").add("slot", IntegerType())
        hits = [
            self.spark.read.schema(schema).parquet(f"{self.path}/names/{piece.name}")
            .where(F.col("folded").startswith(prefix) & F.col("slot").isin(*piece.vertices))
            .select("id", "type", "epoch_id")
            for piece in layout.pieces if piece.vertices
        ]
        if not hits:
            return search_ids(self.load()[1], query, limit)
        found = latest_vertices(reduce(DataFrame.unionByName, hits))
        return found.select("id", "type").orderBy("id").limit(limit)

    # -- writing ----------------------------------------------------------

    def _write(
        self, layout: Layout, edges: DataFrame, vertices: DataFrame, epoch_id: int,
        merged: bool = False, clustered: bool = False,
    ) -> Piece:
        name = f"{'merged' if merged else 'epoch'}-{epoch_id}-{uuid4().hex}"
        table = self._table("edges", layout)
        slots = table.write(edges, name, clustered)
        if layout.reverse and slots:
            (
                table.read({name: slots})
                .withColumn("slot", table.slot())
                .repartitionByRange("dst", "src")
                .sortWithinPartitions("dst", "src")
                .write.parquet(f"{self.path}/reverse/{name}")
            )
        tops = (F.max(f"`{action}`") for action in layout.actions)
        edge_stats = tuple(map(tuple, table.per_slot(name, slots, *tops)))
        table = self._table("vertices", layout)
        of_vertices = table.write(vertices, name, clustered)
        if layout.reverse and of_vertices:
            (
                table.read({name: of_vertices})
                .withColumns({"folded": F.lower("id"), "slot": table.slot()})
                .repartitionByRange("folded")
                .sortWithinPartitions("folded")
                .write.parquet(f"{self.path}/names/{name}")
            )
        vertex_stats = tuple(map(tuple, table.per_slot(name, of_vertices)))
        return Piece(epoch_id, name, merged, slots, of_vertices, edge_stats, vertex_stats)

    def _store_epoch(self, before: Layout, edges: DataFrame, vertices: DataFrame, epoch_id: int):
        counted = replace(before, actions=tuple(self._counted(before)))
        return self._write(counted, edges, vertices, epoch_id)

    def _compacted(self, layout: Layout, pieces: Iterable[Piece]) -> Piece:
        """The given pieces' buckets, merged in place into a new piece."""
        pieces = list(pieces)

        def rows(kind: str) -> DataFrame:
            wanted = {p.name: getattr(p, kind) for p in pieces}
            return self._merged_rows(kind, self._table(kind, layout).read(wanted), layout)

        return self._write(
            layout, rows("edges"), rows("vertices"), layout.last_epoch_id, True, clustered=True
        )

    def snapshot(self) -> None:
        """Merge the buckets touched by recent parts; the others stay where they are."""
        layout = self.manifest()
        if not layout.parts:
            return
        edges, vertices = touched(layout.parts, "edges"), touched(layout.parts, "vertices")
        stale = [
            replace(
                p,
                edges=tuple(s for s in p.edges if s in set(edges)),
                vertices=tuple(s for s in p.vertices if s in set(vertices)),
            )
            for p in layout.base
        ]
        new = self._compacted(layout, [*stale, *layout.parts])
        kept = (p.without(edges, vertices) for p in layout.base)
        base = (*(p for p in kept if p.edges or p.vertices), new)
        self._commit(replace(layout, base=base, parts=()))

    def merge_parts(self) -> None:
        """Merge the parts since the snapshot into one and leave the base alone."""
        layout = self.manifest()
        if len(layout.parts) > 1:
            self._commit(replace(layout, parts=(self._compacted(layout, layout.parts),)))

    def _known_actions(self) -> tuple[str, ...]:
        try:
            return self.manifest().actions
        except (ValueError, KeyError, TypeError):
            pass
        if not exists(self.spark, f"{self.path}/edges"):
            return ()
        files = self.spark.read.option("mergeSchema", True).parquet(f"{self.path}/edges")
        others = ("src", "dst", "score", "last_interaction", "part", "slot")
        return tuple(c for c in files.columns if c not in others)

    def rebuild(self) -> None:
        """Make the state anew from the raw log, with this object's buckets if the manifest
        can't be read."""
        edges, vertices = self.raw_log()
        epochs, last = vertices.agg(F.count_distinct("epoch_id"), F.max("epoch_id")).first()
        try:
            layout = self.manifest()
        except (ValueError, KeyError, TypeError):
            layout = self._new
        actions = dict.fromkeys((*self._known_actions(), *self.weights), 0.0)
        layout = Layout(layout.buckets, layout.reverse, epochs, -1, actions=tuple(actions))
        if not epochs:
            self._commit(layout)
            return
        piece = self._write(
            layout, edge_partials(edges, actions), latest_vertices(vertices), last, merged=True
        )
        self._commit(replace(layout, last_epoch_id=last, base=(piece,)))

    def vacuum(self, keep_hours: float = 24.0) -> list[str]:
        """Remove what the manifest doesn't name and nothing changed for ``keep_hours``.

        Readers that loaded the state before that may still need it, as may a writer whose
        commit is to come, so keep more hours than any of them takes.
        """
        layout = self.manifest()
        before = int((time.time() - 3600 * keep_hours) * 1000)
        gone = []
        for kind in ("edges", "vertices"):
            named = {p.name: getattr(p, kind) for p in layout.pieces}
            removed = self._table(kind, layout).vacuum(named, before)
            gone += [f"{kind}/{name}" for name in removed]
        names = {p.name for p in layout.pieces}
        for copy in ("reverse", "names"):
            for name in folders_of(self.spark, f"{self.path}/{copy}", before):
                if name not in names and remove(self.spark, f"{self.path}/{copy}/{name}"):
                    gone.append(f"{copy}/{name}")
        if self.keep_raw:
            for log, kind in zip(self._logs(), ("edges_raw", "vertices_raw"), strict=True):
                gone += [f"{kind}/{name}" for name in log.vacuum(keep_hours)]
        return gone
