"""Event sources, decoding and the check for malformed events."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaargraph.schemas import ID_COLUMNS, event_schema

# Prices from here on are taken for errors; sums of smaller ones fit all aggregates.
PRICE_LIMIT = 1e15


def kafka_stream(
    spark: SparkSession,
    bootstrap: str,
    topic: str,
    starting_offsets: str = "latest",
    **options: str,
) -> DataFrame:
    """Kafka messages with their JSON in ``value``. Needs Spark's Kafka connector.

    ``options`` go to the source, for instance ``maxOffsetsPerTrigger``.
    """
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap)
        .option("subscribe", topic)
        .option("startingOffsets", starting_offsets)
        .options(**options)
        .load()
    )


def ndjson_stream(
    spark: SparkSession, path: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """A folder of JSON-lines files as messages, one line per ``value``."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)


def ndjson_table(spark: SparkSession, path: str) -> DataFrame:
    """The same folder read once as a table of messages."""
    return spark.read.text(path)


def decode(messages: DataFrame) -> DataFrame:
    """Event columns, ``raw`` text and ``defect`` from JSON in ``value``.

    ``defect`` is NULL for a good message, else ``bad_json`` (no field could be
    read), ``missing_id``, ``bad_timestamp`` (text that is not a time) or ``bad_price``
    (not a finite number below ``PRICE_LIMIT``; the price is then NULL).
    """
    text = messages.select(F.col("value").cast("string").alias("raw"))
    # A generator hands out the fields. As a plain projection the parser would be
    # repeated for every field that a later filter on ``defect`` looks at.
    parsed = F.array(F.from_json("raw", event_schema()))
    fields = text.select("raw", F.inline(parsed))
    names = event_schema().fieldNames()
    nothing_read = F.coalesce(*(F.col(c).cast("string") for c in names)).isNull()
    id_missing = reduce(or_, (F.col(c).isNull() for c in ID_COLUMNS))
    time = F.col("timestamp").try_cast("timestamp")
    usable = F.abs("price") < PRICE_LIMIT  # false for NaN, which is above all numbers
    defect = (
        F.when(nothing_read, "bad_json")
        .when(id_missing, "missing_id")
        .when(F.col("timestamp").isNotNull() & time.isNull(), "bad_timestamp")
        .when(F.col("price").isNotNull() & ~usable, "bad_price")
    )
    others = [c for c in names if c not in ("timestamp", "price")]
    price = F.when(usable, F.col("price")).alias("price")
    return fields.select(time.alias("timestamp"), *others, price, "raw", defect.alias("defect"))


def accepted(decoded: DataFrame) -> DataFrame:
    """Events fit for the graph.

    A bad time or price does not exclude an event: it counts with a NULL there. A
    missing id does, as no vertex could be made of it.
    """
    fit = F.col("defect").isNull() | F.col("defect").isin("bad_timestamp", "bad_price")
    return decoded.filter(fit).select(event_schema().fieldNames())


def quarantined(decoded: DataFrame) -> DataFrame:
    """Messages with a defect, as text with the reason."""
    return decoded.filter(F.col("defect").isNotNull()).select("raw", "defect")


def parse_events(messages: DataFrame) -> DataFrame:
    """Decoded events as they come, without the check."""
    return decode(messages).select(event_schema().fieldNames())
