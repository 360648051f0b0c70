"""Mixing sources to target weights by entropy balancing.

A source is to give ``target`` words. Of all rates with that many words and at most
``CAP`` copies a document, those closest in entropy to one copy each are
exponentially tilted: ``min(CAP, exp(dual * size))``, one dual variable per source.
Its convex dual is solved for all sources at once by Newton steps on the logarithm of
the words, kept inside a bracket; each step is one aggregation over the table of
(source, size, documents), whose length follows the distinct sizes.

Rates become whole copies by rounding the running total of copies over a source's
sizes, then correcting its words by single copies, largest first; what is missing at the
end is less than the smallest document that could still be added or taken. The copies of a size are given to
documents by the order of a hash, counted in slices so that no slice is large.

Targets: sources in code point order, null last, weigh 3, 1, 2, repeating, and share
``SHARE`` of all words; a target stops at ``CAP`` times its source's size, and the rest
is shared again. A source is given by ``source``; null is a source of its own. Null
and empty texts have size 0 and take nothing. Every row is answered, equal rows
together. Sums are exact decimals, so that reruns agree.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bazaargraph.workspace import cut

WEIGHTS = (3, 1, 2)
SHARE = 1.5
CAP = 2
WORD = r"[^\x20\x09-\x0D]+"
STEPS = 200  # Newton steps at most; the bracket alone needs fewer
CLOSE = 1e-9  # relative error of a source's words at which its dual is solved
SLICE = 1000  # documents of a slice, about
CORRECTIONS = 4

EXACT = "decimal(38,6)"


def _ranked(sources: DataFrame) -> DataFrame:
    """Each source's place in code point order, null last, without one sorted task."""
    placed = cut(
        sources.repartitionByRange(F.col("source").isNull(), F.col("source")).withColumn(
            "slice", F.spark_partition_id()
        ),
        "mixing-sources",
    )
    inside = Window.partitionBy("slice").orderBy(F.col("source").isNull(), "source")
    slices = placed.groupBy("slice").agg(F.count(F.lit(1)).alias("n"))
    # One row for each partition of the range sort.
    before = Window.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = slices.select("slice", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    return (
        placed.join(offsets, "slice")
        .withColumn("place", F.row_number().over(inside) - 1 + F.col("offset"))
        .drop("slice", "offset")
    )


def _targets(sources: DataFrame) -> DataFrame:
    """Adds ``target``: weighted shares, each at most ``CAP`` times its source."""
    weights = F.array(*(F.lit(float(w)) for w in WEIGHTS))
    weighed = cut(
        _ranked(sources).withColumn("weight", weights[F.pmod("place", F.lit(len(WEIGHTS))).cast("int")]),
        "mixing-weighed",
    )
    limit = F.col("source_size") * float(CAP)
    total = weighed.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0] * SHARE
    full = F.col("source_size") < 0  # none
    level = 0.0
    while True:
        # Sources that are full at the present level; the others share the rest.
        filled, open_weight = weighed.agg(
            F.sum(F.when(full, limit.cast(EXACT))), F.sum(F.when(~full, F.col("weight")))
        ).first()
        if not open_weight:
            break
        level = (total - float(filled or 0)) / open_weight
        now = F.col("weight") * F.lit(level) >= limit
        if not weighed.where(now & ~full).limit(1).count():
            break
        full = now
    return weighed.withColumn("target", F.when(full, limit).otherwise(F.col("weight") * F.lit(level)))


def _solve(cells: DataFrame, sources: DataFrame) -> DataFrame:
    """(place, dual, scale) of every source; a null dual stands for a full source."""
    moments = cells.groupBy("place").agg(
        F.sum((F.col("n") * F.col("size")).cast(EXACT) * F.col("size")).cast("double").alias("square")
    )
    wanted = F.col("target").cast("double")
    state = cut(
        sources.join(moments, "place").select(
            "place", wanted.alias("target"),
            F.try_divide("square", "source_size").alias("scale"),
            (wanted < F.col("source_size") * float(CAP)).alias("open"),
            F.when(F.col("source_size") > 0, F.log(wanted / F.col("source_size"))).alias("dual"),
            F.lit(-1e6).alias("low"), F.lit(1e6).alias("high"), F.lit(False).alias("done"),
        ),
        "mixing-dual",
    )
    for _ in range(STEPS):
        if not state.where("open and not done").limit(1).count():
            break
        tilt = F.col("dual") * F.col("size") / F.col("scale")
        rate = F.least(F.lit(float(CAP)), F.exp(tilt))
        words = F.col("n") * F.col("size") * rate
        slope = F.when(rate < CAP, words * F.col("size") / F.col("scale")).otherwise(0.0)
        sums = (
            cells.where("size > 0")
            .join(state.where("open and not done").select("place", "dual", "scale"), "place")
            .groupBy("place")
            .agg(
                F.sum(words.cast(EXACT)).cast("double").alias("words"),
                F.sum(slope.cast(EXACT)).cast("double").alias("slope"),
            )
        )
        over = F.col("words") > F.col("target")
        low = F.when(over, F.col("low")).otherwise(F.col("dual"))
        high = F.when(over, F.col("dual")).otherwise(F.col("high"))
        # A slope of 0, with all documents at the cap, makes a null: the bracket is halved.
        step = F.try_divide(F.log(F.col("words") / F.col("target")) * F.col("words"), F.col("slope"))
        newton = F.col("dual") - step
        inside = F.coalesce((newton > low) & (newton < high), F.lit(False))
        close = F.abs(F.col("words") - F.col("target")) <= CLOSE * F.col("target")
        still = F.col("words").isNotNull()
        state = cut(
            state.join(sums, "place", "left").select(
                "place", "target", "scale", "open",
                F.when(still & ~close, F.when(inside, newton).otherwise((low + high) / 2))
                .otherwise(F.col("dual")).alias("dual"),
                F.when(still, low).otherwise(F.col("low")).alias("low"),
                F.when(still, high).otherwise(F.col("high")).alias("high"),
                (F.col("done") | ~F.col("open") | F.coalesce(close, F.lit(True))
                 | (high - low < 1e-12)).alias("done"),
            ),
            "mixing-dual",
        )
    return state.select("place", "scale", F.when(F.col("open"), F.col("dual")).alias("dual"))


def _corrected(cells: DataFrame) -> DataFrame:
    """Moves copies so that each source's words come as near its target as they can.

    What a source lacks is added, and what it has too much is taken, one copy a
    document, from the largest size that is not more than that downwards.
    """
    source = Window.partitionBy("place")
    downwards = source.orderBy(F.desc("size")).rowsBetween(Window.unboundedPreceding, -1)
    off = F.col("target") - F.sum(F.col("copies") * F.col("size")).over(source)
    room = F.when(F.col("off") > 0, F.col("n") * CAP - F.col("copies")).otherwise(F.col("copies"))
    before = F.coalesce(F.sum(F.col("room") * F.col("size")).over(downwards), F.lit(0))
    move = F.least(
        F.col("room"),
        F.greatest(F.lit(0), F.floor((F.abs("off") - before) / F.col("size"))),
    )
    return (
        cells.withColumn("off", off)
        .withColumn(
            "room", F.when((F.col("size") > 0) & (F.col("size") <= F.abs("off")), room).otherwise(0)
        )
        .withColumn("move", F.when(F.col("size") > 0, move).otherwise(0))
        .withColumn("copies", F.col("copies") + F.signum("off").cast("long") * F.col("move"))
        .drop("off", "room", "move")
    )


def _copies(cells: DataFrame, sources: DataFrame) -> DataFrame:
    """Adds ``copies``, the whole number for all documents of a (source, size)."""
    duals = _solve(cells, sources)
    rate = F.when(F.col("dual").isNull(), F.lit(float(CAP))).otherwise(
        F.least(F.lit(float(CAP)), F.exp(F.col("dual") * F.col("size") / F.col("scale")))
    )
    upwards = Window.partitionBy("place").orderBy("size")
    total = F.sum((F.col("n") * rate).cast(EXACT)).over(
        upwards.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    rounded = F.floor(total + F.lit(0.5).cast(EXACT))
    cells = cells.join(duals, "place", "left").withColumn("upto", rounded)
    copies = F.col("upto") - F.coalesce(F.lag("upto").over(upwards), F.lit(0))
    cells = cells.withColumn(
        "copies", F.least(F.col("n") * CAP, F.greatest(F.lit(0), copies)).cast("long")
    ).drop("upto", "dual", "scale")
    cells = cut(cells.join(sources.select("place", "target"), "place"), "mixing-copies")
    for _ in range(CORRECTIONS):
        cells = _corrected(cells)
    return cells.select("place", "size", "n", "copies")


def mix_sources(docs: DataFrame) -> DataFrame:
    """Per row of ``docs`` (doc_id, text, source, ...): size, target and copies taken.

    Columns: doc_id, digest (of the text), source, size, source_size, target, copies,
    taken. Rows of equal doc_id, source and text are one row each and may differ in
    copies.
    """
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    sized = cut(
        docs.select("doc_id", "source", size.alias("size"), F.xxhash64("text").alias("digest")),
        "mixing-sized",
    )
    counts = cut(
        sized.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")), "mixing-sizes"
    )
    sources = cut(
        _targets(counts.groupBy("source").agg(F.sum(F.expr("n * size")).alias("source_size"))),
        "mixing-targets",
    )
    same_source = counts["source"].eqNullSafe(sources["source"])
    cells = cut(
        counts.join(sources, same_source).select(counts["source"], "place", "size", "n"),
        "mixing-cells",
    )
    copies = _copies(cells.drop("source"), sources)
    planned = cut(
        cells.select("source", "place", "size").join(copies, ["place", "size"]), "mixing-planned"
    )
    # The documents of a size, in slices by hash; each slice gets its share of the
    # copies beyond those that all documents get, and gives them in hash order.
    slot = F.pmod(F.xxhash64("doc_id", "digest"), F.ceil(F.col("n") / SLICE))
    placed = cut(
        sized.join(
            planned, sized["source"].eqNullSafe(planned["source"]) & (sized["size"] == planned["size"])
        ).select(
            "doc_id", "digest", sized["source"], sized["size"], "place", "n", "copies",
            slot.alias("slot"),
        ),
        "mixing-placed",
    )
    in_order = Window.partitionBy("place", "size").orderBy("slot").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    slots = (
        placed.groupBy("place", "size", "slot", "n", "copies")
        .agg(F.count(F.lit(1)).alias("here"))
        .withColumn("upto", F.sum("here").over(in_order))
        .withColumn("extra", F.expr("copies % n"))
        .select(
            "place", "size", "slot",
            F.expr("extra * upto div n - extra * (upto - here) div n").alias("extra"),
        )
    )
    by_hash = Window.partitionBy("place", "size", "slot").orderBy(
        F.xxhash64("digest", "doc_id"), "doc_id", "digest"
    )
    own = F.expr("copies div n") + (F.col("nth") <= F.col("extra")).cast("long")
    return (
        placed.withColumn("nth", F.row_number().over(by_hash))
        .join(slots, ["place", "size", "slot"])
        .join(sources.select("place", "source_size", "target"), "place")
        .select(
            "doc_id", "digest", "source", "size", "source_size", "target", own.alias("copies"),
            (own * F.col("size")).alias("taken"),
        )
    )
