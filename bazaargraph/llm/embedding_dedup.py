"""Near-duplicate embeddings by Euclidean p-stable hashing, with exact checks.

Normalised vectors are projected on random Gaussian directions and quantised;
``HASHES`` quantised projections make the key of one of ``TABLES`` tables. Vectors
with a common key are compared by cosine in double precision. At cosine 0.95 (a
distance of 0.316) a table finds a pair with probability 0.874 ** 16, so that all
tables together find 98% there and over 99.9% from 0.97 on.

Equal vectors form one class with a count. A bucket is cut into blocks of at most
about ``BLOCK`` classes and its pairs of blocks are compared independently, so no
task holds a large bucket. A pair that meets in several tables counts in the first.

Vectors that are null, empty, all zero, or hold a null or non-finite component
link with nothing, nor do vectors of different lengths or rows with a null vec_id
(which have no component). Repeated rows count as vectors of their own.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaargraph.llm.components import connected_components
from bazaargraph.workspace import cut

COSINE = 0.95
TABLES = 32
HASHES = 16
WIDTH = 2.0
SEED = 20240229
BLOCK = 512
SMALL = 32  # cells up to this size are compared pair by pair, many at once
CELL_ROWS = 8_000  # rows that a task compares at a time


def projections(length: int) -> tuple[np.ndarray, np.ndarray]:
    random = np.random.default_rng([SEED, length])
    return (
        random.standard_normal((length, TABLES * HASHES)),
        random.uniform(0, WIDTH, TABLES * HASHES),
    )


def table_keys(unit: np.ndarray, directions: np.ndarray, shifts: np.ndarray) -> np.ndarray:
    """A 64-bit key for each vector and table."""
    cells = np.floor((unit @ directions + shifts) / WIDTH).astype(np.int64)
    cells = cells.reshape(len(unit), TABLES, HASHES)
    keys = np.zeros(cells.shape[:2], dtype=np.int64)
    for j in range(HASHES):
        keys = keys * 1_000_003 + cells[:, :, j]
    return keys


def _normalised(vectors: pd.Series) -> np.ndarray:
    matrix = np.stack(vectors.to_numpy()).astype(np.float64)
    return matrix / np.linalg.norm(matrix, axis=1, keepdims=True)


def _hashed(frames):
    for rows in frames:
        for length, part in rows.groupby(rows["vector"].str.len()):
            unit = _normalised(part["vector"])
            keys = table_keys(unit, *projections(length))
            yield pd.DataFrame(
                {
                    "rep": part["rep"].to_numpy(), "copies": part["copies"].to_numpy(),
                    "length": np.int32(length),
                    "unit": [x.tobytes() for x in unit],
                    "keys": list(keys),
                }
            )


class Cells:
    """The rows of many cells, as arrays; finds links and their connecting edges."""

    def __init__(self, rows: pd.DataFrame) -> None:
        self.rep = rows["rep"].to_numpy()
        self.copies = rows["copies"].to_numpy()
        self.table = rows["table"].to_numpy()
        self.block = rows["block"].to_numpy()
        self.unit = np.frombuffer(b"".join(rows["unit"])).reshape(len(rows), -1)
        self.keys = np.stack(rows["keys"].to_numpy())
        self.counts: list[pd.DataFrame] = []
        self.edges: list[pd.DataFrame] = []

    def _linked(self, left: np.ndarray, right: np.ndarray) -> None:
        for one, two in ((left, right), (right, left)):
            self.counts.append(pd.DataFrame({"a": self.rep[one], "n": self.copies[two]}))
        self.edges.append(pd.DataFrame({"a": self.rep[left], "b": self.rep[right]}))

    def pairs(self, left: np.ndarray, right: np.ndarray) -> None:
        """Compare given pairs of rows."""
        new = ~(
            (self.keys[left] == self.keys[right])
            & (np.arange(TABLES) < self.table[left][:, None])
        ).any(axis=1)
        left, right = left[new], right[new]
        close = np.einsum("ij,ij->i", self.unit[left], self.unit[right]) >= COSINE
        self._linked(left[close], right[close])

    def blocks(self, left: np.ndarray, right: np.ndarray, same: bool) -> None:
        """Compare all rows of one block with all of another, or with each other."""
        hits = self.unit[left] @ self.unit[right].T >= COSINE
        for t in range(self.table[left[0]]):
            hits &= self.keys[left, t][:, None] != self.keys[right, t][None, :]
        if same:
            hits = np.triu(hits, 1)
        weights = ((left, hits @ self.copies[right]), (right, hits.T @ self.copies[left]))
        for rows, n in weights:
            self.counts.append(pd.DataFrame({"a": self.rep[rows], "n": n}))
        i, j = np.nonzero(hits)
        self.edges.append(_forest(self.rep[left[i]], self.rep[right[j]]))

    def found(self) -> pd.DataFrame:
        counts = pd.concat(self.counts).groupby("a", as_index=False)["n"].sum()
        edges = pd.concat(self.edges)
        edges = _forest(edges["a"].to_numpy(), edges["b"].to_numpy()).assign(n=0)
        out = pd.concat([counts[counts["n"] > 0].assign(b=None), edges])
        return out.astype({"a": "Int64", "b": "Int64", "n": "Int64"})[["a", "b", "n"]]


def _forest(left: np.ndarray, right: np.ndarray) -> pd.DataFrame:
    """Only those edges that join two components."""
    parent: dict[int, int] = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            parent[x] = x = parent[parent[x]]
        return x

    keep = []
    for a, b in zip(left.tolist(), right.tolist(), strict=True):
        a, b = root(a), root(b)
        keep.append(a != b)
        parent[max(a, b)] = min(a, b)
    keep = np.array(keep, dtype=bool)
    return pd.DataFrame({"a": left[keep], "b": right[keep]})


def compare_cells(rows: pd.DataFrame) -> pd.DataFrame:
    """(a, null, links) and edges (a, b, 0) of all cells of a task's share."""
    empty = pd.DataFrame({"a": [], "b": [], "n": []}).astype("Int64")
    out = [empty]
    for _, part in rows.groupby(rows["unit"].str.len()):
        part = part.sort_values(["table", "key", "i", "j", "block"], ignore_index=True)
        cells = Cells(part)
        names = part[["table", "key", "i", "j"]].to_numpy()
        starts = np.flatnonzero(np.append(True, (names[1:] != names[:-1]).any(axis=1)))
        sizes = np.diff(np.append(starts, len(part)))
        large = (sizes > SMALL) | (part["i"] != part["j"]).to_numpy()[starts]
        cell = np.repeat(np.arange(len(starts)), sizes)
        cell[np.repeat(large, sizes)] = -1
        for apart in range(1, SMALL):
            left = np.flatnonzero((cell[:-apart] == cell[apart:]) & (cell[:-apart] >= 0))
            cells.pairs(left, left + apart)
        for start, size in zip(starts[large], sizes[large], strict=True):
            at = np.arange(start, start + size)
            i, j = part["i"][start], part["j"][start]
            one, two = at[cells.block[at] == i], at[cells.block[at] == j]
            if len(one) and len(two):
                cells.blocks(one, two, i == j)
        out.append(cells.found())
    return pd.concat(out)


def near_duplicates(vectors: DataFrame) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row of (vec_id, embedding, ...)."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    wide = F.transform("embedding", lambda x: x.cast("double"))
    finite = F.forall(wide, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = (
        F.col("vec_id").isNotNull()
        & F.coalesce(finite & F.exists(wide, lambda x: x != 0), F.lit(False))
    )
    keyed = rows.select(
        "vec_id",
        F.when(usable, wide).alias("vector"),
        F.when(usable, F.xxhash64("embedding")).alias("h1"),
        F.when(usable, F.xxhash64(F.lit(1), "embedding")).alias("h2"),
    )
    classes = cut(
        keyed.where("h1 is not null")
        .groupBy("h1", "h2")
        .agg(
            F.min("vec_id").alias("rep"),
            F.count(F.lit(1)).alias("copies"),
            F.first("vector").alias("vector"),
        ),
        "embedding-classes",
    )
    hashed = cut(
        classes.select("rep", "copies", "vector").mapInPandas(
            _hashed, "rep long, copies long, length int, unit binary, keys array<long>"
        ),
        "embedding-hashed",
    )
    keys = hashed.select("rep", "length", F.posexplode("keys").alias("table", "key"))
    blocks = (
        keys.groupBy("length", "table", "key")
        .agg(F.count(F.lit(1)).alias("size"))
        .where("size > 1")
        .withColumn("blocks", F.ceil(F.col("size") / BLOCK).cast("int"))
    )
    placed = keys.join(blocks, ["length", "table", "key"]).withColumn(
        "block", F.pmod(F.xxhash64("rep"), "blocks").cast("int")
    )
    cells = placed.select(
        "rep", "table", F.xxhash64("length", "key").alias("key"), "block",
        F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"),
    ).select(
        "rep", "table", "key", "block",
        F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
    )
    cells = cut(cells, "embedding-cells")
    parts = max(1, -(-cells.count() // CELL_ROWS))
    compared = cut(
        cells.join(hashed.select("rep", "copies", "unit", "keys"), "rep")
        .withColumn("part", F.pmod(F.xxhash64("table", "key", "i", "j"), F.lit(parts)))
        .groupBy("part")
        .applyInPandas(compare_cells, "a long, b long, n long"),
        "embedding-compared",
    )
    linked = compared.groupBy(F.col("a").alias("rep")).agg(F.sum("n").alias("linked"))
    found = connected_components(compared.where("b is not null").select("a", "b"), "embedding-links")
    named = (
        classes.select("h1", "h2", "rep", "copies")
        .join(linked, "rep", "left")
        .join(found, F.col("rep") == F.col("node"), "left")
        .select(
            "h1", "h2",
            (F.col("copies") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links"),
            F.coalesce("component", "rep").alias("component_id"),
        )
    )
    component = F.coalesce("component_id", "vec_id")
    return keyed.join(named, ["h1", "h2"], "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.when(F.col("vec_id").isNotNull(), component).alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )
