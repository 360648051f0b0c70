"""A log of rows by epoch in few folders: recent epochs alone, older ones in ranges.

Appending an epoch writes one folder, and a repeated epoch takes the place of its first
version. When ``FANOUT`` folders of a tier have gathered, they become one of the next tier,
so n epochs lie in about ``FANOUT * log(n)`` folders and a row is rewritten ``log(n)`` times.
Rows keep their ``epoch_id`` and are sorted by it inside each file. A reader of the epochs
after some epoch opens only the folders whose bounds reach beyond it, and of these the row
groups that do. The newest epoch stays alone, since it's the one that may come again.

The manifest names the folders and is replaced in one step, last; what it doesn't name is
never read and goes by ``vacuum``.
"""

from __future__ import annotations

import json
import time
from dataclasses import asdict, dataclass
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from bazaargraph.workspace import exists, folders_of, read_text, remove, replace_text

FANOUT = 8


@dataclass(frozen=True)
class Run:
    """A folder with the epochs from ``low`` to ``high``, all of them or some."""

    name: str
    low: int
    high: int
    tier: int = 0


class RawLog:
    def __init__(self, spark: SparkSession, path: str, schema: StructType) -> None:
        """``schema`` has a column ``epoch_id``."""
        self.spark = spark
        self.path = path.rstrip("/")
        self.schema = schema

    @property
    def _manifest_path(self) -> str:
        return f"{self.path}/manifest.json"

    def runs(self) -> list[Run]:
        if not exists(self.spark, self._manifest_path):
            return []
        return [Run(**run) for run in json.loads(read_text(self.spark, self._manifest_path))]

    def _commit(self, runs: list[Run]) -> None:
        runs = sorted(runs, key=lambda r: (r.low, r.high, r.name))
        replace_text(self.spark, self._manifest_path, json.dumps([asdict(r) for r in runs]))

    def _scan(self, runs: list[Run]) -> DataFrame:
        if not runs:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*(f"{self.path}/{r.name}" for r in runs))

    def read(self, after: int | None = None) -> DataFrame:
        """All rows, or those of later epochs than ``after``."""
        runs = self.runs()
        if after is None:
            return self._scan(runs)
        return self._scan([r for r in runs if r.high > after]).where(F.col("epoch_id") > after)

    def append(self, rows: DataFrame, epoch_id: int | None = None) -> None:
        """Add one epoch, or with None the epochs that ``rows`` has, none of them known yet.

        An epoch that is the newest takes the place of what the log has of it. An older one
        that lies in a range already is an error.
        """
        runs = self.runs()
        if epoch_id is not None:
            if any(r.tier and r.low <= epoch_id <= r.high for r in runs):
                raise ValueError(f"epoch {epoch_id} has been merged into a range")
            runs = [r for r in runs if r.low != epoch_id or r.high != epoch_id]
        name = f"run-{uuid4().hex}"
        typed = rows.select(*(F.col(f.name).cast(f.dataType) for f in self.schema))
        ordered = typed.sortWithinPartitions("epoch_id")
        ordered.write.parquet(f"{self.path}/{name}")
        low = high = epoch_id
        if epoch_id is None:
            low, high = self._scan([Run(name, 0, 0)]).agg(F.min("epoch_id"), F.max("epoch_id")).first()
            if low is None:
                return
            if any(r.low <= high and low <= r.high for r in runs):
                raise ValueError(f"epochs {low} to {high} overlap those of the log")
        self._commit([*runs, Run(name, low, high, tier=int(epoch_id is None))])
        self.compact()

    def compact(self) -> None:
        """Merge each tier that has ``FANOUT`` folders, the newest epoch aside."""
        tier = 0
        while True:
            runs = self.runs()
            if tier > max((r.tier for r in runs), default=-1):
                return
            newest = max(r.high for r in runs)
            full = [r for r in runs if r.tier == tier and not (tier == 0 and r.high == newest)]
            if len(full) >= FANOUT:
                name = f"run-{uuid4().hex}"
                # Ranges of epochs, so that the files of a large range have bounds of their own.
                merged = self._scan(full).repartitionByRange("epoch_id")
                merged.sortWithinPartitions("epoch_id").write.parquet(f"{self.path}/{name}")
                low, high = min(r.low for r in full), max(r.high for r in full)
                kept = [r for r in runs if r not in full]
                self._commit([*kept, Run(name, low, high, tier + 1)])
            tier += 1

    def vacuum(self, keep_hours: float = 24.0) -> list[str]:
        """Remove folders that the log doesn't name and nothing changed for ``keep_hours``."""
        named = {r.name for r in self.runs()}
        before = int((time.time() - 3600 * keep_hours) * 1000)
        unused = [n for n in folders_of(self.spark, self.path, before) if n not in named]
        return [name for name in unused if remove(self.spark, f"{self.path}/{name}")]
