"""Exact k nearest binary codes by incremental multi-index hashing.

A code holds the sign of each component of a vector (0 and above: 1). It is cut
into segments of 16 bits. A code within distance r of a query agrees with it up to
``r // segments`` bits in some segment, so after looking up all segment values
within radius s everything up to distance ``segments * (s + 1) - 1`` has been
seen. The radius grows per query until its k-th verified distance is covered.
Where the values to look up outnumber the stored codes, these are all verified
instead, which covers every distance.

Stored codes are dealt into blocks by hash and queries into blocks, and each pair
of blocks is searched on its own; a query then keeps the best of all blocks.
Equal codes answer alike: of each code only the ``k + 1`` smallest ids can be among
the nearest, and a code is searched once however many queries share it.

Rows with a null id or vector, an empty vector or a null or NaN component have no
code. Ties go to the smaller id; repeated rows count once. A query doesn't find
itself, and finds fewer than k rows only if there are no more.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bazaargraph.workspace import cut

NEAREST = 10
QUERY_STEP = 20  # rows whose id is divisible by this are queries
CODES = 1 << 16  # stored rows of a block
QUERIES = 1 << 11  # queries of a block
PROBES = 1 << 20  # values looked up at a time


def _coded(frames):
    for rows in frames:
        for length, part in rows.groupby(rows["vector"].str.len()):
            bits = np.stack(part["vector"].to_numpy()) >= 0
            bits = np.pad(bits, ((0, 0), (0, -length % 16)))
            yield pd.DataFrame(
                {
                    "id": part["id"].to_numpy(), "bits": np.int32(length),
                    "code": [x.tobytes() for x in np.packbits(bits, axis=1)],
                }
            )


def masks(radius: int) -> np.ndarray:
    """All 16-bit words with ``radius`` ones."""
    return np.array(
        [sum(1 << i for i in ones) for ones in combinations(range(16), radius)], dtype=np.uint16
    )


class Nearest:
    """The best ``k`` stored rows of each query so far, without repeats."""

    def __init__(self, queries: int, k: int, ids: np.ndarray) -> None:
        self.k, self.ids = k, ids
        self.query = np.zeros(0, np.int64)
        self.row = np.zeros(0, np.int64)
        self.distance = np.zeros(0, np.int64)
        self.limit = np.full(queries, np.iinfo(np.int64).max)

    def add(self, query: np.ndarray, row: np.ndarray, distance: np.ndarray) -> None:
        keep = distance <= self.limit[query]
        query, row, distance = (
            np.concatenate([old, new[keep]])
            for old, new in (
                (self.query, query), (self.row, row), (self.distance, distance)
            )
        )
        _, first = np.unique(query * (len(self.ids) + 1) + row, return_index=True)
        query, row, distance = query[first], row[first], distance[first]
        turn = np.lexsort((self.ids[row], distance, query))
        query, row, distance = query[turn], row[turn], distance[turn]
        starts = np.searchsorted(query, query)
        rank = np.arange(len(query)) - starts
        best = rank < self.k
        self.query, self.row, self.distance = query[best], row[best], distance[best]
        full = rank == self.k - 1
        self.limit[query[full]] = distance[full]


def search(queries: np.ndarray, codes: np.ndarray, ids: np.ndarray, k: int) -> Nearest:
    """``queries`` and ``codes`` are arrays of 16-bit segments, a row for each code."""
    found = Nearest(len(queries), k, ids)
    segments = codes.shape[1]
    tables = []
    for j in range(segments):
        turn = np.argsort(codes[:, j], kind="stable")
        tables.append((turn, np.searchsorted(codes[turn, j], np.arange((1 << 16) + 1))))

    def verify(query: np.ndarray, row: np.ndarray) -> None:
        if len(query):
            apart = np.bitwise_count(queries[query] ^ codes[row]).sum(axis=1, dtype=np.int64)
            found.add(query, row, apart)

    active = np.arange(len(queries))
    for radius in range(17):
        flips = masks(radius)
        if len(flips) * segments > len(codes):
            per = max(1, PROBES // len(codes))
            for at in range(0, len(active), per):
                some = active[at : at + per]
                verify(np.repeat(some, len(codes)), np.tile(np.arange(len(codes)), len(some)))
            return found
        per = max(1, PROBES // len(flips))
        for j, (turn, starts) in enumerate(tables):
            for at in range(0, len(active), per):
                some = active[at : at + per]
                values = (queries[some, j][:, None] ^ flips[None, :]).ravel().astype(np.int64)
                low, size = starts[values], starts[values + 1] - starts[values]
                spots = np.repeat(low - np.cumsum(size) + size, size) + np.arange(size.sum())
                verify(np.repeat(np.repeat(some, len(flips)), size), turn[spots])
        covered = segments * (radius + 1) - 1
        active = active[found.limit[active] > covered]
        if not len(active):
            break
    return found


def _segments(codes: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(codes), dtype=">u2").reshape(len(codes), -1).astype(np.uint16)


def _search_cell(k: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        out = {"code": [], "id": [], "distance": []}
        asked, stored = rows[rows["id"].isna()], rows[rows["id"].notna()]
        if len(asked) and len(stored):
            ids = stored["id"].to_numpy(dtype=np.int64)
            found = search(_segments(asked["code"]), _segments(stored["code"]), ids, k)
            out = {
                "code": asked["code"].to_numpy()[found.query],
                "id": ids[found.row],
                "distance": found.distance,
            }
        return pd.DataFrame(out)

    return run


def _dealt(rows: DataFrame, name: str, blocks: int, other: str, others: int) -> DataFrame:
    """Each row in one of ``blocks`` blocks, for every block of the other side."""
    return rows.withColumn(name, F.pmod(F.xxhash64("code"), F.lit(blocks))).withColumn(
        other, F.explode(F.sequence(F.lit(0), F.lit(others - 1)).cast("array<long>"))
    )


def nearest_codes(vectors: DataFrame, k: int = NEAREST, step: int = QUERY_STEP) -> DataFrame:
    """(query_id, rank, vec_id, distance) over the codes of (vec_id, embedding, ...)."""
    wide = F.transform("embedding", lambda x: x.cast("double"))
    coded = cut(
        vectors.select(F.col("vec_id").cast("long").alias("id"), wide.alias("vector"))
        .where("id is not null and size(vector) > 0")
        .where(F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x)))
        .mapInPandas(_coded, "id long, bits int, code binary"),
        "hamming-codes",
    )
    by_id = Window.partitionBy("bits", "code").orderBy("id")
    stored = (
        coded.distinct()
        .withColumn("nth", F.row_number().over(by_id))
        .where(F.col("nth") <= k + 1)
        .select("bits", "code", "id")
    )
    stored = cut(stored, "hamming-stored")
    asking = coded.where(F.pmod("id", F.lit(step)) == 0).distinct()
    asked = cut(asking.select("bits", "code").distinct(), "hamming-asked")
    blocks = max(1, -(-stored.count() // CODES))
    rounds = max(1, -(-asked.count() // QUERIES))
    cells = _dealt(stored, "i", blocks, "q", rounds).unionByName(
        _dealt(asked.withColumn("id", F.lit(None).cast("long")), "q", rounds, "i", blocks)
    )
    best = (
        cells.groupBy("bits", "i", "q")
        .applyInPandas(_search_cell(k + 1), "code binary, id long, distance long")
        .withColumnRenamed("id", "vec_id")
    )
    by_distance = Window.partitionBy("query_id").orderBy("distance", "vec_id")
    return (
        asking.select("code", F.col("id").alias("query_id"), "bits")
        .join(best, "code")
        .where("vec_id <> query_id")
        .withColumn("rank", F.row_number().over(by_distance))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "distance")
    )
