"""Tables of parts, bucketed by a key, as Spark reads them: without a shuffle per key.

A table is a folder ``<path>`` of files ``part=<name>/slot=<bucket>/...``, registered in the
session's catalog as partitioned by both and bucketed by the key. ``slot`` is the number of
the bucket, so a reader can name the parts it wants and the buckets of each, and files of
other parts or buckets are never opened. Grouping by the key, or by more columns, then runs
where the buckets lie, however many parts there are; a look-up by literal keys opens the
key's bucket alone.

The catalog entry is only a view of the folder, made anew by any session that needs it: what
a table consists of is up to the caller, who keeps names of parts and their slots.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce
from hashlib import sha256
from operator import or_

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from bazaargraph.workspace import folders_of, remove

Slots = Mapping[str, Iterable[int]]


class BucketedTable:
    def __init__(
        self,
        spark: SparkSession,
        path: str,
        schema: StructType,
        key: str,
        order: Sequence[str],
        buckets: int,
    ) -> None:
        """A view of the folder at ``path``; ``buckets`` must be those it was written with."""
        self.spark = spark
        self.path = path
        self.schema = schema
        self.key = key
        self.order = tuple(order)
        self.buckets = buckets
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        # Another schema of the same folder is another entry: files without a column read as NULL.
        what = f"{path}|{columns}|{key}|{self.order}|{buckets}"
        self.name = f"bazaargraph_{sha256(what.encode()).hexdigest()[:24]}"
        self._definition = (
            f"CREATE TABLE IF NOT EXISTS {self.name} ({columns}, part STRING, slot INT) "
            f"USING parquet PARTITIONED BY (part, slot) CLUSTERED BY (`{key}`) "
            f"SORTED BY ({', '.join(f'`{c}`' for c in self.order)}) INTO {buckets} BUCKETS "
            f"LOCATION '{path}'"
        )

    def slot(self) -> F.Column:
        """The bucket that Spark puts a row in."""
        return F.pmod(F.hash(self.key), F.lit(self.buckets))

    def write(self, df: DataFrame, part: str, clustered: bool = False) -> tuple[int, ...]:
        """Add a part, one file for each bucket that has rows; the buckets are returned.

        ``clustered`` says that ``df`` comes from ``read`` and still has its buckets, as
        after grouping by the key; other rows are brought to their bucket first.
        """
        self.spark.sql(self._definition)
        if not clustered:
            df = df.repartition(self.buckets, self.key)
        rows = df.select(
            *(F.col(f.name).cast(f.dataType) for f in self.schema),
            F.lit(part).alias("part"), self.slot().alias("slot"),
        )
        rows.write.insertInto(self.name)
        names = folders_of(self.spark, f"{self.path}/part={part}")
        return tuple(sorted(int(n.removeprefix("slot=")) for n in names if n.startswith("slot=")))

    def _register(self, parts: Slots) -> None:
        """Make parts that another application wrote known to the catalog."""
        self.spark.sql(self._definition)
        known = {row.partition for row in self.spark.sql(f"SHOW PARTITIONS {self.name}").collect()}
        new = [
            (part, slot)
            for part, slots in parts.items() for slot in slots
            if f"part={part}/slot={slot}" not in known
        ]
        for at in range(0, len(new), 1000):
            specs = " ".join(
                f"PARTITION (part = '{part}', slot = {slot})" for part, slot in new[at : at + 1000]
            )
            self.spark.sql(f"ALTER TABLE {self.name} ADD IF NOT EXISTS {specs}")

    def read(self, parts: Slots) -> DataFrame:
        """The rows of the given buckets of each part."""
        wanted = {part: sorted(slots) for part, slots in parts.items() if slots}
        if not wanted:
            return self.spark.createDataFrame([], self.schema)
        self._register(wanted)
        among = (
            (F.col("part") == part) & F.col("slot").isin(slots) for part, slots in wanted.items()
        )
        return self.spark.table(self.name).where(reduce(or_, among)).drop("part", "slot")

    def per_slot(self, part: str, slots: Iterable[int], *aggregates: F.Column) -> list[Row]:
        """(slot, rows, aggregates) of a part's buckets; at most as many rows as buckets."""
        slots = list(slots)
        if not slots:
            return []
        self._register({part: slots})
        rows = self.spark.table(self.name).where((F.col("part") == part) & F.col("slot").isin(slots))
        return rows.groupBy("slot").agg(F.count(F.lit(1)), *aggregates).orderBy("slot").collect()

    def vacuum(self, parts: Slots, older_than_ms: int) -> list[str]:
        """Remove buckets that ``parts`` does not name, if last changed before that moment.

        Returns the folders removed, relative to the table. A reader that still uses an
        older list of parts loses them, so the moment must lie before all such reads.
        """
        named = {f"part={p}/slot={s}" for p, slots in parts.items() for s in slots}
        gone = []
        for part in folders_of(self.spark, self.path):
            if not part.startswith("part="):
                continue
            slots = folders_of(self.spark, f"{self.path}/{part}", older_than_ms)
            unused = [f"{part}/{s}" for s in slots if f"{part}/{s}" not in named]
            gone += [name for name in unused if remove(self.spark, f"{self.path}/{name}")]
        for name in gone:
            part, slot = (piece.split("=")[1] for piece in name.split("/"))
            self.spark.sql(self._definition)
            self.spark.sql(
                f"ALTER TABLE {self.name} DROP IF EXISTS PARTITION (part = '{part}', slot = {slot})"
            )
        return gone
