"""Intermediate tables and small files in the cluster's shared folder."""

from __future__ import annotations

import tempfile
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Keys are broadcast up to this size in memory, counting a fixed overhead for
# each row of the hash table.
BROADCAST_BYTES = 32 * 1024 * 1024
ROW_OVERHEAD = 64


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Only a local session may go without the setting: it gets a temporary folder.
    On a cluster a machine-local folder would be lost with its executor, so a
    missing setting is an error there.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise RuntimeError(
                "set spark.checkpoint.dir to a folder that all executors share"
            )
        context.setCheckpointDir(tempfile.mkdtemp(prefix="bazaargraph-"))
    return context.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path under the shared folder."""
    return f"{shared_dir(spark)}/bazaargraph/{label}-{uuid4().hex}"


def cut(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back.

    This ends the lineage, survives lost executors, and, unlike an estimate,
    gives the planner the true size, so that a later join broadcasts the table
    only when it is below ``spark.sql.autoBroadcastJoinThreshold``.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def measure(stored: DataFrame, *keys: str) -> tuple[int, int]:
    """(rows, bytes a broadcast of the key columns takes) of a stored table."""
    length = sum((F.octet_length(key) for key in keys), F.lit(0))
    rows, text = stored.agg(
        F.count(F.lit(1)), F.coalesce(F.sum(F.coalesce(length, F.lit(0))), F.lit(0))
    ).first()
    return rows, text + rows * ROW_OVERHEAD


def fits_broadcast(size: int) -> bool:
    return size <= BROADCAST_BYTES


def _filesystem(spark: SparkSession, path: str):
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()), jvm_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, jvm_path = _filesystem(spark, path)
    return fs.exists(jvm_path)


def read_text(spark: SparkSession, path: str) -> str:
    fs, jvm_path = _filesystem(spark, path)
    stream = fs.open(jvm_path)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def replace_text(spark: SparkSession, path: str, text: str) -> None:
    """Put a small file in place in one step, so that readers see old or new."""
    jvm = spark._jvm
    fs, target = _filesystem(spark, path)
    parent = target.getParent()
    draft = jvm.org.apache.hadoop.fs.Path(parent, f"_{target.getName()}-{uuid4().hex}")
    stream = fs.create(draft, True)
    try:
        stream.write(bytearray(text, "utf-8"))
    finally:
        stream.close()
    option = jvm.org.apache.hadoop.fs.Options.Rename
    options = spark.sparkContext._gateway.new_array(option, 1)
    options[0] = option.OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        fs.getUri(), spark._jsc.hadoopConfiguration()
    )
    context.rename(fs.makeQualified(draft), fs.makeQualified(target), options)


def ensure_table(spark: SparkSession, path: str, schema: StructType) -> None:
    """Create an empty table of the given schema unless the path exists."""
    if not exists(spark, path):
        spark.createDataFrame([], schema).write.parquet(path)


def read_table(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Scan a Parquet table; an absent one reads as an empty table of the schema."""
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def folders_of(spark: SparkSession, path: str, older_than_ms: int | None = None) -> list[str]:
    """Names of the folders directly under a path, all or those last changed before a moment."""
    fs, jvm_path = _filesystem(spark, path)
    if not fs.exists(jvm_path):
        return []
    return [
        status.getPath().getName()
        for status in fs.listStatus(jvm_path)
        if status.isDirectory()
        and (older_than_ms is None or status.getModificationTime() < older_than_ms)
    ]


def remove(spark: SparkSession, path: str) -> bool:
    """Delete a folder with all it holds."""
    fs, jvm_path = _filesystem(spark, path)
    return fs.delete(jvm_path, True)
