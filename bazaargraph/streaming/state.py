"""Graph state as tables: a snapshot, the partials of later epochs, a manifest.

Layout under the state's path::

    manifest.json        what the state consists of, replaced in one step
    edges/<name>         edge partials of one epoch, or a snapshot
    vertices/<name>      vertices of one epoch, or a snapshot
    edges_raw, vertices_raw    optional raw log, partitioned by epoch_id

Applying a batch costs work in proportion to the batch: its aggregates go to a
new folder and the manifest, written last, takes them in. Readers only see
folders named by a manifest, all complete, so a write that dies leaves the state
as it was and its repetition replaces it. Folders no longer named stay for
readers that may still use them; removing them is up to the owner.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence
from dataclasses import asdict, dataclass, field, replace
from functools import reduce
from operator import and_
from uuid import uuid4

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType, TimestampType

from bazaargraph.operators.build import raw_vertices
from bazaargraph.operators.fold import (
    edge_partials,
    latest_vertices,
    merge_edge_partials,
    with_score,
)
from bazaargraph.operators.lookup import graph_stats
from bazaargraph.schemas import (
    WEIGHTS,
    raw_edges_schema,
    raw_vertices_schema,
)
from bazaargraph.sources.sinks import append_raw_edges, append_raw_vertices
from bazaargraph.workspace import (
    ensure_table,
    exists,
    fits_broadcast,
    measure,
    read_table,
    read_text,
    replace_text,
)

DEFAULT_SNAPSHOT_EVERY = 20

Merge = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class Part:
    """Aggregates of one epoch, or of all up to it if ``merged``.

    The sizes say what a broadcast of the folder's keys would take. A snapshot
    has none: its keys are never broadcast.
    """

    epoch_id: int
    name: str
    merged: bool = False
    edge_key_size: int | None = None
    vertex_key_size: int | None = None


@dataclass(frozen=True)
class Manifest:
    batch_count: int = 0
    last_epoch_id: int = -1
    snapshot: Part | None = None
    parts: tuple[Part, ...] = field(default_factory=tuple)
    # Every action ever counted; its column is carried on whatever the weights are.
    actions: tuple[str, ...] = field(default_factory=tuple)

    def to_json(self) -> str:
        return json.dumps(asdict(self), indent=1)

    @staticmethod
    def from_json(text: str) -> Manifest:
        """Anything but a complete manifest raises; state is never reset by accident."""
        fields = json.loads(text)
        snapshot = fields["snapshot"]
        return Manifest(
            batch_count=int(fields["batch_count"]),
            last_epoch_id=int(fields["last_epoch_id"]),
            snapshot=None if snapshot is None else Part(**snapshot),
            parts=tuple(Part(**part) for part in fields["parts"]),
            actions=tuple(fields.get("actions", ())),
        )


class GraphState:
    """Stored graph state. Epochs must come in increasing order.

    The last epoch may come again, as a stream repeats it after a failure; it
    then takes the place of its first version. An older epoch is refused: it
    means that the stream was restarted without its checkpoint.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        weights: Mapping[str, float] = WEIGHTS,
        snapshot_every: int = DEFAULT_SNAPSHOT_EVERY,
        merge_every: int = 0,
        keep_raw: bool = False,
    ) -> None:
        """A snapshot follows every ``snapshot_every``-th batch; 0 turns that off.

        A snapshot rewrites the whole state. Where that is large, let
        ``merge_every`` join the recent partials into one more often, which
        rewrites only those, and take snapshots seldom.
        """
        self.spark = spark
        self.path = path.rstrip("/")
        self.weights = dict(weights)
        self.snapshot_every = snapshot_every
        self.merge_every = merge_every
        self.keep_raw = keep_raw

    # -- where things are -------------------------------------------------

    @property
    def raw_edges_path(self) -> str:
        return f"{self.path}/edges_raw"

    @property
    def raw_vertices_path(self) -> str:
        return f"{self.path}/vertices_raw"

    @property
    def _manifest_path(self) -> str:
        return f"{self.path}/manifest.json"

    def _blank(self) -> Manifest:
        """The manifest of a state without batches."""
        return Manifest()

    def manifest(self) -> Manifest:
        if not exists(self.spark, self._manifest_path):
            return Manifest()
        found = Manifest.from_json(read_text(self.spark, self._manifest_path))
        folders = [p.name for p in (found.snapshot, *found.parts) if p is not None]
        if folders and not found.actions:  # written before actions were recorded
            found = replace(found, actions=self._stored_actions(folders))
        return found

    def _stored_actions(self, folders: Sequence[str]) -> tuple[str, ...]:
        files = self.spark.read.option("mergeSchema", True).parquet(
            *(f"{self.path}/edges/{name}" for name in folders)
        )
        others = ("src", "dst", "score", "last_interaction")
        return tuple(c for c in files.columns if c not in others)

    def _known_actions(self) -> tuple[str, ...]:
        """The actions of the manifest or, if it can't be read, of all stored folders."""
        try:
            if actions := self.manifest().actions:
                return actions
        except (ValueError, KeyError, TypeError, AnalysisException):
            pass
        return self._stored_actions(["*"]) if exists(self.spark, f"{self.path}/edges") else ()

    def open(self, load: bool = True) -> GraphState:
        """Create what is missing. With ``load=False`` the state starts empty."""
        if not load or not exists(self.spark, self._manifest_path):
            self._commit(self._blank())
        if self.keep_raw:
            self._open_raw()
        return self

    def _open_raw(self) -> None:
        ensure_table(self.spark, self.raw_edges_path, raw_edges_schema())
        ensure_table(self.spark, self.raw_vertices_path, raw_vertices_schema())

    def _commit(self, manifest: Manifest) -> None:
        replace_text(self.spark, self._manifest_path, manifest.to_json())

    # -- reading ----------------------------------------------------------

    def _counted(self, manifest: Manifest) -> dict[str, float]:
        """All actions with a count column, weighted now or before; the values don't matter."""
        return dict.fromkeys((*manifest.actions, *self.weights), 0.0)

    def _edge_schema(self, manifest: Manifest) -> StructType:
        base = StructType().add("src", "string").add("dst", "string")
        base.add(StructField("last_interaction", TimestampType()))
        for action in self._counted(manifest):
            base.add(StructField(action, LongType()))
        return base

    def _read(self, kind: str, parts: Sequence[Part], manifest: Manifest) -> DataFrame:
        schema = self._edge_schema(manifest) if kind == "edges" else raw_vertices_schema()
        if not parts:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(
            *(f"{self.path}/{kind}/{part.name}" for part in parts)
        )

    def _combined(
        self, kind: str, manifest: Manifest, keys: list[str], merge: Merge
    ) -> DataFrame:
        """One row per key from the snapshot and the partials after it.

        A single folder has one row per key: a plain scan, no shuffle. Few recent
        keys are broadcast, and only their rows are merged; the rest of the
        snapshot passes through. Otherwise everything is merged by its key.
        """
        parts = manifest.parts
        base = [manifest.snapshot] if manifest.snapshot else []
        if len(base) + len(parts) <= 1:
            return self._read(kind, [*base, *parts], manifest)
        recent = self._read(kind, parts, manifest)
        size = sum(
            part.edge_key_size if kind == "edges" else part.vertex_key_size for part in parts
        )
        if not base or not fits_broadcast(size):
            return merge(self._read(kind, [*base, *parts], manifest))
        snapshot = self._read(kind, base, manifest)
        touched = recent.select(*(F.col(k).alias(f"_{k}") for k in keys)).distinct()
        # Null-safe, as grouping is: a NULL key is one key.
        same = reduce(and_, (F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys))
        touched = F.broadcast(touched)
        return snapshot.join(touched, same, "left_anti").unionByName(
            merge(snapshot.join(touched, same, "left_semi").unionByName(recent))
        )

    def _counts(self, manifest: Manifest) -> DataFrame:
        actions = self._counted(manifest)

        def merge(partials: DataFrame) -> DataFrame:
            return merge_edge_partials(partials, actions)

        combined = self._combined("edges", manifest, ["src", "dst"], merge)
        # An action without a column in an old folder was never counted.
        return combined.fillna(0, subset=list(actions))

    def _latest(self, manifest: Manifest) -> DataFrame:
        return self._combined("vertices", manifest, ["id"], latest_vertices)

    def load(self, persist: bool = False) -> tuple[DataFrame, DataFrame]:
        """(edges, vertices) as of the last committed epoch."""
        manifest = self.manifest()
        edges = with_score(self._counts(manifest), self.weights)
        vertices = self._latest(manifest).select("id", "type")
        if persist:
            return edges.persist(), vertices.persist()
        return edges, vertices

    def raw_log(self) -> tuple[DataFrame, DataFrame]:
        """(raw edges, raw vertices); empty tables when nothing was logged."""
        return (
            read_table(self.spark, self.raw_edges_path, raw_edges_schema()),
            read_table(self.spark, self.raw_vertices_path, raw_vertices_schema()),
        )

    def stats(self) -> DataFrame:
        manifest = self.manifest()
        edges, vertices = self.load()
        return graph_stats(edges, vertices, manifest.batch_count, manifest.last_epoch_id)

    # -- writing ----------------------------------------------------------

    def _store(
        self, edges: DataFrame, vertices: DataFrame, epoch_id: int, merged: bool = False
    ) -> Part:
        name = f"{'merged' if merged else 'epoch'}-{epoch_id}-{uuid4().hex}"
        moment = F.col("last_interaction").cast("timestamp")
        edges = edges.withColumn("last_interaction", moment)
        edges.write.parquet(f"{self.path}/edges/{name}")
        vertices.write.parquet(f"{self.path}/vertices/{name}")
        return Part(epoch_id, name, merged)

    def _measured(self, part: Part) -> Part:
        return replace(
            part,
            edge_key_size=measure(self._read("edges", [part], Manifest()), "src", "dst")[1],
            vertex_key_size=measure(self._read("vertices", [part], Manifest()), "id")[1],
        )

    def _store_epoch(
        self, before: Manifest, edges: DataFrame, vertices: DataFrame, epoch_id: int
    ) -> Part:
        """Store the aggregates of one epoch, to come after what ``before`` names."""
        return self._measured(self._store(edges, vertices, epoch_id))

    def _append_raw(self, edges: DataFrame, vertices: DataFrame, epoch_id: int) -> None:
        append_raw_edges(edges, self.raw_edges_path, epoch_id)
        append_raw_vertices(vertices, self.raw_vertices_path, epoch_id)

    def apply_batch(self, vertices: DataFrame, edges: DataFrame, epoch_id: int) -> None:
        """Add one non-empty batch graph; every n-th batch also writes a snapshot."""
        before = self.manifest()
        if epoch_id < before.last_epoch_id:
            raise ValueError(
                f"epoch {epoch_id} is older than the last one, {before.last_epoch_id}; "
                "was the stream started without its checkpoint?"
            )
        repeated = before.batch_count > 0 and epoch_id == before.last_epoch_id
        if repeated and epoch_id not in {p.epoch_id for p in before.parts if not p.merged}:
            # Already part of a snapshot or merge: nothing is left to replace.
            return

        if self.keep_raw:
            self._append_raw(edges, vertices, epoch_id)

        marked = vertices
        if "epoch_id" not in vertices.columns:
            marked = raw_vertices(vertices, epoch_id)
        counted = self._counted(before)
        part = self._store_epoch(
            before, edge_partials(edges, counted), latest_vertices(marked), epoch_id
        )
        kept = tuple(p for p in before.parts if p.epoch_id != epoch_id)
        after = replace(
            before,
            batch_count=before.batch_count + (0 if repeated else 1),
            last_epoch_id=epoch_id,
            parts=(*kept, part),
            actions=tuple(counted),
        )
        self._commit(after)
        if self.snapshot_every > 0 and after.batch_count % self.snapshot_every == 0:
            self.snapshot()
        elif self.merge_every > 0 and after.batch_count % self.merge_every == 0:
            self.merge_parts()

    def _merged(self, manifest: Manifest) -> Part:
        """One folder each for the edges and vertices of what a manifest names.

        Edges are sorted by source inside each file, so a look-up by source reads
        few row groups.
        """
        return self._store(
            self._counts(manifest).sortWithinPartitions("src", "dst"),
            self._latest(manifest).sortWithinPartitions("id"),
            manifest.last_epoch_id,
            merged=True,
        )

    def snapshot(self) -> None:
        """Merge the whole state into a new snapshot."""
        manifest = self.manifest()
        if manifest.parts:
            self._commit(replace(manifest, snapshot=self._merged(manifest), parts=()))

    def rebuild(self) -> None:
        """Make the state anew from the raw log, counting every row as live batches do.

        Needs ``keep_raw`` from the first epoch on. It replaces whatever the state was,
        a damaged manifest, too. Every action counted before is counted again, whatever the
        weights are now.
        """
        edges, vertices = self.raw_log()
        epochs, last = vertices.agg(F.count_distinct("epoch_id"), F.max("epoch_id")).first()
        if not epochs:
            self._commit(Manifest())
            return
        counted = dict.fromkeys((*self._known_actions(), *self.weights), 0.0)
        part = self._store(
            edge_partials(edges, counted).sortWithinPartitions("src", "dst"),
            latest_vertices(vertices).sortWithinPartitions("id"),
            last,
            merged=True,
        )
        self._commit(Manifest(epochs, last, snapshot=part, actions=tuple(counted)))

    def merge_parts(self) -> None:
        """Merge the partials since the snapshot into one and leave the snapshot alone."""
        manifest = self.manifest()
        if len(manifest.parts) > 1:
            recent = self._merged(replace(manifest, snapshot=None))
            self._commit(replace(manifest, parts=(self._measured(recent),)))
