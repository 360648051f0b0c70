"""How far the words of each source are from those of the other sources of its language.

Texts are tokenised as bytes: one ``translate`` lowers A-Z and blanks all other ASCII
bytes, ``split`` gives the terms, and a ``Counter`` per document their frequencies.
Batches send each of their (lang, source, term) once, with its frequency and its number
of documents, and Spark adds these up; a hot source or language sends a few rows per
task like any other.

A term is kept for a language if at least ``LEAST_DOCS`` of its documents have it. A
group's share of a term is an integer, ``1 + floor(SCALE * (count + 1) / (N + V))``, and
so is a term's divergence, ``floor((p - q)**2 / q)``. The divergence of two sources is
its sum over all kept terms of the language. Most counts are zero, so it's added up from
three sparse parts: all terms as if both counts were zero, for each source the terms it
has as if the other had none, and a correction where both have the term. The second part
needs only how many terms of a source have each share; the third is done on blocks of
terms, each with all sources that have them.

Null texts, langs and sources count as ''. Texts of any length are split in pieces of
``PIECE`` bytes between terms, and count as one document. A group without terms has
count 0 everywhere. Repeated rows and rows that share a doc_id are documents of their
own; ties in rank go to the smaller item. An empty table gives no rows. Shares are
exact for counts below 9e9 in all (Spark's decimals carry them beyond that).
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bazaargraph.workspace import cut

LEAST_DOCS = 3  # fixed values of the task
SCALE = 1_000_000_000
RANKS = 200

PIECE = 1 << 20  # bytes of a text split at a time
ROWS = 1 << 17  # document terms collected before they are merged and sent
CELLS = 1 << 13  # (source, term) counts of a block, on average
TILE = 1 << 21  # sources times terms held as a matrix at a time

_TABLE = bytes(
    b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
COUNTED = "lang string, source string, term binary, n long, docs long"


def term_counts(text: bytes) -> Counter:
    """Frequencies of the terms of one document."""
    text = text.translate(_TABLE)
    counts: Counter = Counter()
    at = 0
    while at < len(text):
        end = text.find(b" ", at + PIECE)
        end = len(text) if end < 0 else end
        counts.update(text[at:end].split())
        at = end
    return counts


class Sparse:
    """Frequencies of many documents, merged by group and term when there are enough."""

    def __init__(self) -> None:
        self.groups: dict[tuple[str, str], int] = {}
        self.clear()

    def clear(self) -> None:
        self.seen: set[int] = set()
        self.owners: list[int] = []
        self.lengths: list[int] = []
        self.terms: list[bytes] = []
        self.counts: list[int] = []

    def add(self, group: tuple[str, str], counts: Counter) -> None:
        number = self.groups.setdefault(group, len(self.groups))
        self.seen.add(number)
        self.owners.append(number)
        self.lengths.append(len(counts))
        self.terms.extend(counts.keys())
        self.counts.extend(counts.values())

    def merged(self) -> pa.RecordBatch:
        """A row for each group and term, and one without term for each group."""
        owner = np.repeat(np.array(self.owners, np.int64), self.lengths)
        flat = pa.table(
            {"group": owner, "term": pa.array(self.terms, pa.binary()),
             "n": np.array(self.counts, np.int64)}
        )
        summed = flat.group_by(["group", "term"]).aggregate([("n", "sum"), ("n", "count")])
        alone = np.array(sorted(self.seen), np.int64)
        zeros = pa.array(np.zeros(len(alone), np.int64))
        number = np.concatenate([summed["group"].to_numpy(), alone])
        names = list(self.groups)
        columns = [
            pa.array([name[k] for name in names], pa.string()).take(pa.array(number)) for k in (0, 1)
        ]
        for name, tail in (
            ("term", pa.nulls(len(alone), pa.binary())), ("n_sum", zeros), ("n_count", zeros),
        ):
            columns.append(pa.concat_arrays([*summed[name].chunks, tail]))
        self.clear()
        return pa.RecordBatch.from_arrays(columns, names=["lang", "source", "term", "n", "docs"])


def _count_batches(batches):
    waiting = Sparse()
    for batch in batches:
        texts = batch.column("text")
        langs, sources = batch.column("lang").to_pylist(), batch.column("source").to_pylist()
        for k in range(len(texts)):
            waiting.add((langs[k], sources[k]), term_counts(texts[k].as_py()))
            if len(waiting.terms) >= ROWS:
                yield waiting.merged()
    if waiting.owners:
        yield waiting.merged()


def _share(count: str, total: str) -> Column:
    """1 + floor(SCALE * (count + 1) / total); the decimals hold any count."""
    return F.expr(
        f"1L + (cast({count} as decimal(20,0)) + 1) * {SCALE} div cast({total} as decimal(20,0))"
    )


def _apart(p: str, q: str) -> str:
    return f"((({p}) - ({q})) * (({p}) - ({q})) div ({q}))"


def apart(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


def _correct_block(rows: pd.DataFrame) -> pd.DataFrame:
    """For each two sources, what the terms that both have add to the sparse sums."""
    owner, names = pd.factorize(rows["source"])
    term, _ = pd.factorize(rows["term"])
    p, empty = rows["p"].to_numpy(), np.zeros(len(names), np.int64)
    empty[owner] = rows["p0"].to_numpy()
    turn = np.argsort(term, kind="stable")
    owner, term, p = owner[turn], term[turn], p[turn]
    total = np.zeros((len(names), len(names)), np.int64)
    step = max(1, TILE // max(1, len(names)))
    for low in range(0, int(term[-1]) + 1, step):
        part = slice(*np.searchsorted(term, [low, low + step]))
        shares = np.zeros((len(names), step), np.int64)
        shares[owner[part], term[part] - low] = p[part]
        for i in range(len(names)):
            own = np.flatnonzero(shares[i])
            j, k = np.nonzero(shares[:, own])
            mine, other = shares[i, own][k], shares[j, own[k]]
            none, theirs = empty[i], empty[j]
            extra = (
                apart(mine, other) - apart(mine, theirs) - apart(none, other) + apart(none, theirs)
            )
            np.add.at(total[i], j, extra)
    i, j = np.nonzero(total)
    return pd.DataFrame(
        {"lang": rows["lang"].iloc[0], "source": names[i], "item": names[j], "value": total[i, j]}
    )


def _blanks(docs: DataFrame) -> DataFrame:
    def filled(column: str) -> Column:
        return F.coalesce(F.col(column).cast("string"), F.lit("")).alias(column)

    text = F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("text")
    return docs.select(filled("lang"), filled("source"), text)


def audit_sources(docs: DataFrame, ranks: int = RANKS) -> DataFrame:
    """(lang, source, part, item, value, rank) over all of ``docs`` (text, lang, source, ...)."""
    cells = cut(
        _blanks(docs)
        .mapInArrow(_count_batches, COUNTED)
        .withColumn("term", F.col("term").cast("string"))
        .groupBy("lang", "source", "term")
        .agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")),
        "divergence-cells",
    )
    terms = cut(
        cells.where("term is not null")
        .groupBy("lang", "term")
        .agg(F.sum("n").alias("total"), F.sum("docs").alias("docs"))
        .where(F.col("docs") >= LEAST_DOCS)
        .select("lang", "term", "total"),
        "divergence-terms",
    )
    langs = terms.groupBy("lang").agg(F.count("term").alias("v"), F.sum("total").alias("of_lang"))
    kept = cut(
        cells.where("term is not null").drop("docs").join(terms, ["lang", "term"]),
        "divergence-kept",
    )
    # A row for each source of a language. Written first, so that a later join broadcasts it
    # only if its true size is small.
    groups = cut(
        cells.where("term is null").select("lang", "source")
        .join(kept.groupBy("lang", "source").agg(F.sum("n").alias("of_group")), ["lang", "source"], "left")
        .join(langs, "lang", "left")
        .fillna(0, ["of_group", "v", "of_lang"])
        .select(
            "*",
            F.when(F.col("v") > 0, _share("0", "greatest(of_group + v, 1)")).otherwise(1).alias("p0"),
        ),
        "divergence-groups",
    )
    rated = kept.join(groups, ["lang", "source"]).select(
        "lang", "source", "term", "p0",
        _share("n", "of_group + v").alias("p"), _share("total", "of_lang + v").alias("q"),
    )

    others = groups.select("lang", F.col("source").alias("item"), F.col("p0").alias("q0"))
    neither = (
        groups.join(others, "lang").where("source <> item")
        .select("lang", "source", "item", F.expr(f"v * {_apart('p0', 'q0')}").alias("value"))
    )
    alike = rated.groupBy("lang", "source", "p", "p0").agg(F.count(F.lit(1)).alias("m"))
    both_ways = F.expr(
        "inline(array("
        f"struct(source, item, m * ({_apart('p', 'q0')} - {_apart('p0', 'q0')}) as value), "
        f"struct(item as source, source as item, m * ({_apart('q0', 'p')} - {_apart('q0', 'p0')}) as value)"
        "))"
    )
    one = alike.join(others, "lang").where("source <> item").select("lang", both_ways)
    blocks = max(1, -(-kept.count() // CELLS))
    both = (
        rated.select("lang", "source", "term", "p", "p0")
        .withColumn("block", F.pmod(F.xxhash64("term"), F.lit(blocks)))
        .groupBy("lang", "block")
        .applyInPandas(_correct_block, "lang string, source string, item string, value long")
        .where("source <> item")
    )
    pairs = (
        neither.unionByName(one).unionByName(both)
        .groupBy("lang", "source", "item")
        .agg(F.sum("value").alias("value"))
    )
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    top = (
        rated.where("p > q")
        .select("lang", "source", F.col("term").alias("item"), F.expr(_apart("p", "q")).alias("value"))
        .withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= ranks)
    )
    ranked = pairs.withColumn("rank", F.row_number().over(order))
    return (
        ranked.withColumn("part", F.lit("pair"))
        .unionByName(top.withColumn("part", F.lit("term")))
        .select("lang", "source", "part", "item", "value", "rank")
    )
