"""Windows of a stream as a table: open ones rewritten by each epoch, closed ones kept by day.

A window is closed when no batch can change it any more. Spark judges a row late by the
watermark that the batch before last left, so after batch N all windows that end before the
highest event time up to batch N - 1, less the watermark's delay, are final; the start of
the latest window stands for that time, which errs towards keeping windows open. Closed
windows go once to their day, open ones are merged with each epoch's changes: an epoch costs
as much as there are open windows, however long the stream runs.

The manifest names the valid folders and is replaced in one step, last. It holds the version
before, too: a repeated epoch starts from that one and takes the place of its first version.
Folders that neither version names are removed once they are ``KEEP_EPOCHS`` epochs old, so
a reader may take that long.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from bazaargraph.operators.windows import latest_windows
from bazaargraph.schemas import windows_schema
from bazaargraph.workspace import exists, folders_of, read_text, remove, replace_text

PARTS_OF_DAY = 8  # a day with more is rewritten as one
KEEP_EPOCHS = 10
OPEN = "open"


@dataclass(frozen=True)
class Version:
    """What the table consists of: folders are named <epoch>-<id>/day=<day>."""

    epoch_id: int = -1
    highest: int | None = None  # start of the latest window, in microseconds
    open: str | None = None
    closed: dict[str, list[str]] = field(default_factory=dict)

    def folders(self) -> set[tuple[str, str]]:
        named = {(name, day) for day, names in self.closed.items() for name in names}
        return named | ({(self.open, OPEN)} if self.open else set())


class WindowTable:
    def __init__(self, spark: SparkSession, path: str, watermark: str = "1 minute") -> None:
        """``watermark`` is the delay of the stream that writes the table."""
        self.spark = spark
        self.path = path.rstrip("/")
        self.watermark = watermark

    @property
    def _manifest_path(self) -> str:
        return f"{self.path}/manifest.json"

    def _versions(self) -> tuple[Version, Version]:
        """(current, the one before); anything but a complete manifest raises."""
        if not exists(self.spark, self._manifest_path):
            return Version(), Version()
        stored = json.loads(read_text(self.spark, self._manifest_path))
        return Version(**stored["now"]), Version(**stored["before"])

    def _schema(self) -> StructType:
        return StructType(windows_schema().fields[:-1])

    def _read(self, folders: set[tuple[str, str]]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], self._schema())
        paths = sorted(f"{self.path}/{name}/day={day}" for name, day in folders)
        return self.spark.read.schema(self._schema()).parquet(*paths)

    def load(self, first_day: str | None = None, last_day: str | None = None) -> DataFrame:
        """The current value of each window, a plain scan.

        With days (as ``2026-01-31``) only closed windows of those days, bounds included.
        """
        now, _ = self._versions()
        if first_day is None and last_day is None:
            return self._read(now.folders())
        low, high = first_day or "", last_day or "9999-99-99"
        return self._read({(n, d) for n, d in now.folders() if d != OPEN and low <= d <= high})

    def apply(self, changed: DataFrame, epoch_id: int) -> None:
        """A foreachBatch function for the windows that an epoch changed."""
        now, before = self._versions()
        if epoch_id < now.epoch_id:
            raise ValueError(
                f"epoch {epoch_id} is older than the last one, {now.epoch_id}; "
                "was the stream started without its checkpoint?"
            )
        base = before if epoch_id == now.epoch_id else now
        name = f"{epoch_id}-{uuid4().hex}"
        known = self._read({(base.open, OPEN)} if base.open else set())
        rows = latest_windows(
            known.withColumn("epoch_id", F.lit(0)).unionByName(
                changed.withColumn("epoch_id", F.lit(1))
            )
        )
        # Without an earlier batch nothing can be final.
        final = F.lit(False)
        if base.highest is not None:
            limit = F.expr(f"timestamp_micros({base.highest}) - interval {self.watermark}")
            final = F.col("window_end") <= limit
        day = F.when(final, F.date_format("window_start", "yyyy-MM-dd")).otherwise(OPEN)
        rows.withColumn("day", day).write.partitionBy("day").parquet(f"{self.path}/{name}")

        days = [d.removeprefix("day=") for d in folders_of(self.spark, f"{self.path}/{name}")]
        written = self._read({(name, day) for day in days})
        latest = written.agg(F.max(F.unix_micros("window_start"))).first()[0]
        closed = {day: list(names) for day, names in base.closed.items()}
        for day in days:
            if day != OPEN:
                closed.setdefault(day, []).append(name)
                closed[day] = self._compacted(day, closed[day], epoch_id)
        after = Version(
            epoch_id,
            max((t for t in (base.highest, latest) if t is not None), default=None),
            name if OPEN in days else None,
            closed,
        )
        text = json.dumps({"now": asdict(after), "before": asdict(base)})
        replace_text(self.spark, self._manifest_path, text)
        self._clean(after.folders() | base.folders(), epoch_id)

    def _compacted(self, day: str, names: list[str], epoch_id: int) -> list[str]:
        if len(names) <= PARTS_OF_DAY:
            return names
        name = f"{epoch_id}-{uuid4().hex}"
        rows = self._read({(n, day) for n in names})
        rows.coalesce(1).write.parquet(f"{self.path}/{name}/day={day}")
        return [name]

    def _clean(self, named: set[tuple[str, str]], epoch_id: int) -> None:
        for name in folders_of(self.spark, self.path):
            if int(name.split("-")[0]) > epoch_id - KEEP_EPOCHS:
                continue
            days = folders_of(self.spark, f"{self.path}/{name}")
            unused = [d for d in days if (name, d.removeprefix("day=")) not in named]
            for day in unused:
                remove(self.spark, f"{self.path}/{name}/{day}")
            if len(unused) == len(days):
                remove(self.spark, f"{self.path}/{name}")
