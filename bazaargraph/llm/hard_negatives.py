"""Hard negatives by exact inner product search over clusters of anchors.

Anchors are clustered around a few centroids. For a cluster with angle ``a`` around its
centroid, no member's inner product with a row of norm ``n`` at angle ``t`` from the
centroid is above ``|member| * n * cos(max(0, t - a))``. The rows are sorted by this
bound once for the whole cluster, and every member walks the list from its start until
the bound of the rest is below what it still needs: its k-th best so far, or a floor
known beforehand. A walk that ends this way has proven its result, so it's exact.

One search finds the positives of all anchors, a second one, with the window of scores
that each positive allows, their negatives. Both ask in blocks of ``MEMBERS`` anchors,
cluster after cluster: a row is sent to a block, once, if its bound for one of the
clusters there reaches the lowest floor of that cluster's members, and a block's rows are
dealt into parts of ``CANDIDATES`` by hash, so that a hot label, cluster or group of
copies is split. Floors come from the window and from the scores of ``SAMPLE`` rows (a
k-th best of some rows is no better than that of all); centroids are fitted on as many
anchors. Both samples only save work, they change no result. What tasks get of all blocks
is six numbers for each cluster in each, about one such row for ``MEMBERS`` anchors.

Components become ``floor(256 * x)`` in double precision and scores are exact integers;
components beyond 2**62 and scores beyond 64 bits are clipped to these. Rows with a null
id, label or vector, an empty vector, or a null or non-finite component take no part.
Equal rows count once. Rows that share an id but differ are rows of their own, never
partners of each other. Vectors of different lengths are not compared. Ties go to the
smaller id. A negative positive_score allows no negatives.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bazaargraph.workspace import cut

ANCHOR_STEP, MOVED_STEP, LABELS = 100, 7, 10  # fixed values of the task
NEAREST = 5  # positives of an anchor, negatives of a positive
CLUSTERS = 32
SAMPLE = 2048  # rows for floors, anchors for centroids, both brought to the driver
MEMBERS = 8192  # anchors of a block, on average
LEAST_MEMBERS = 64  # of a cluster, on average
CANDIDATES = 1 << 16  # rows of a part, on average
STEP = 1 << 20  # scores taken at a time
EXACT = 2.0**53  # doubles hold integers up to this
SLACK = 1e-6  # radians, above all rounding of angles
LOWEST, HIGHEST = -(2**63), 2**63 - 1

VECTOR = "id long, label long, dim int, width int, raw binary, norm double"


def _pack(frames):
    """Integer components as bytes, in the least width that holds them."""
    for rows in frames:
        out = {"width": [], "raw": [], "norm": []}
        for vector in rows["vector"]:
            values = np.clip(np.floor(256.0 * np.asarray(vector, np.float64)), -(2.0**62), 2.0**62)
            top = np.abs(values).max()
            width = 2 if top < 2**15 else 4 if top < 2**31 else 8
            out["width"].append(width)
            out["raw"].append(values.astype(f"<i{width}").tobytes())
            out["norm"].append(float(np.linalg.norm(values)))
        yield rows[["id", "label", "dim"]].assign(**out)


def _matrix(rows: pd.DataFrame, dim: int) -> np.ndarray:
    out = np.zeros((len(rows), dim), np.int64)
    width, raw = rows["width"].to_numpy(), rows["raw"].to_numpy()
    for size in np.unique(width):
        at = np.flatnonzero(width == size)
        out[at] = np.frombuffer(b"".join(raw[at]), f"<i{size}").reshape(len(at), dim)
    return out


def scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All inner products of the rows of two integer matrices, exact or clipped to 64 bits."""
    if not len(a) or not len(b):
        return np.zeros((len(a), len(b)), np.int64)
    tops = [float(np.abs(x.astype(np.float64)).max()) for x in (a, b)]
    if a.shape[1] * tops[0] * tops[1] < EXACT:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    exact = a.astype(object) @ b.astype(object).T
    clipped = [[max(LOWEST, min(HIGHEST, x)) for x in row] for row in exact]
    return np.array(clipped, np.int64)


def _units(vectors: np.ndarray) -> np.ndarray:
    wide = vectors.astype(np.float64)
    norms = np.linalg.norm(wide, axis=1, keepdims=True)
    return np.divide(wide, norms, out=np.zeros_like(wide), where=norms > 0)


def _angles(vectors: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Of each vector to each centroid; a zero vector has a right angle to all."""
    return np.arccos(np.clip(_units(vectors) @ centroids.T, -1.0, 1.0))


def fit_centroids(vectors: np.ndarray, clusters: int, rounds: int = 6) -> np.ndarray:
    """Unit centroids by spherical k-means, begun at vectors far from each other."""
    units = _units(vectors)
    chosen = [0]
    near = units @ units[0]
    while len(chosen) < min(clusters, len(units)):
        chosen.append(int(np.argmin(near)))
        near = np.maximum(near, units @ units[chosen[-1]])
    centroids = units[chosen]
    for _ in range(rounds):
        own = np.argmax(units @ centroids.T, axis=1)
        sums = np.zeros_like(centroids)
        np.add.at(sums, own, units)
        moved = _units(sums)
        centroids = np.where(np.any(moved, axis=1, keepdims=True), moved, centroids)
    return centroids


def _reach(norms: np.ndarray, angles: np.ndarray, around: float) -> np.ndarray:
    """Most that a vector of norm 1 within ``around`` of the centroid can score with each row."""
    cosine = np.cos(np.maximum(0.0, angles - around - SLACK))
    return norms * np.maximum(cosine, 0.0)


def _with_slack(bound: np.ndarray) -> np.ndarray:
    return bound * (1.0 + 1e-9) + 1e-6


class Best:
    """The first ``k`` rows of each member so far: higher scores, then smaller ids."""

    def __init__(self, members: int, k: int) -> None:
        self.k = k
        self.member, self.id, self.score = (np.zeros(0, np.int64) for _ in range(3))
        self.last = np.full(members, LOWEST, np.int64)

    def add(self, member: np.ndarray, ids: np.ndarray, score: np.ndarray) -> None:
        member = np.concatenate([self.member, member])
        ids = np.concatenate([self.id, ids])
        score = np.concatenate([self.score, score])
        turn = np.lexsort((ids, ~score, member))  # ~ turns the order of integers, without overflow
        member, ids, score = member[turn], ids[turn], score[turn]
        rank = np.arange(len(member)) - np.searchsorted(member, member)
        keep = rank < self.k
        self.member, self.id, self.score = member[keep], ids[keep], score[keep]
        full = rank == self.k - 1
        self.last[member[full]] = score[full]


def walk(asked: dict, rows: dict, centroid: np.ndarray, same: bool, k: int, step: int = STEP):
    """The first k rows of each member within its window, and how many of the list were scored.

    ``asked`` has arrays vector, norm, id, label, low, high; ``rows`` vector, norm, id, label.
    A row must have the member's label (``same``) or another one, and not its id. ``step``
    bounds the scores held at a time.
    """
    step = max(1, step // len(asked["id"]))
    around = float(_angles(asked["vector"], centroid[None, :]).max())
    reach = _reach(rows["norm"], _angles(rows["vector"], centroid[None, :])[:, 0], around)
    turn = np.argsort(-reach, kind="stable")
    best = Best(len(asked["id"]), k)
    unique, inverse = np.unique(asked["vector"], axis=0, return_inverse=True)
    inverse = inverse.ravel()
    active = np.arange(len(asked["id"]))
    scored = 0
    for at in range(0, len(turn), step):
        rest = _with_slack(asked["norm"][active] * reach[turn[at]])
        need = np.maximum(asked["low"][active], best.last[active])
        active = active[rest >= need]
        if not len(active):
            break
        part = turn[at : at + step]
        scored += len(part)
        found = scores(unique, rows["vector"][part])[inverse[active]]
        fits = (
            ((asked["label"][active][:, None] == rows["label"][part]) == same)
            & (asked["id"][active][:, None] != rows["id"][part])
            & (found >= np.maximum(asked["low"][active], best.last[active])[:, None])
            & (found <= asked["high"][active][:, None])
        )
        i, j = np.nonzero(fits)
        if len(i):
            best.add(active[i], rows["id"][part][j], found[i, j])
    return best, scored


def _arrays(rows: pd.DataFrame, dim: int, *columns: str) -> dict:
    out = {c: rows[c].to_numpy(dtype=np.int64) for c in ("id", "label", *columns)}
    return out | {"norm": rows["norm"].to_numpy(np.float64), "vector": _matrix(rows, dim)}


def _place(centroids: dict, sample: dict, same: bool, k: int):
    """Gives each member its cluster, and a floor from the sample."""

    def run(frames):
        for rows in frames:
            for dim, part in rows.groupby("dim"):
                asked = _arrays(part, dim, "low", "high")
                cluster = np.full(len(part), -1)
                angle = np.full(len(part), np.pi)
                if dim in centroids:
                    angles = _angles(asked["vector"], centroids[dim])
                    cluster = angles.argmin(axis=1)
                    angle = angles.min(axis=1)
                low = asked["low"]
                if dim in sample:
                    known = sample[dim]
                    found = scores(asked["vector"], known["vector"])
                    fits = (
                        ((asked["label"][:, None] == known["label"]) == same)
                        & (asked["id"][:, None] != known["id"])
                        & (found <= asked["high"][:, None])
                    )
                    if found.shape[1] >= k:
                        some = np.where(fits, found, LOWEST)
                        kth = np.partition(some, found.shape[1] - k, axis=1)[:, -k]
                        low = np.maximum(low, kth)
                yield part.assign(cluster=cluster.astype(np.int32), angle=angle, low=low)

    return run


def _route(centroids: dict, clusters: pd.DataFrame):
    """Sends a row to each block with a cluster whose lowest floor it can reach."""
    by_dim = {dim: list(part.groupby("block")) for dim, part in clusters.groupby("dim")}

    def run(frames):
        for rows in frames:
            for dim, part in rows.groupby("dim"):
                angles = None
                if dim in centroids:
                    angles = _angles(_matrix(part, dim), centroids[dim])
                norms = part["norm"].to_numpy(np.float64)
                for block, members in by_dim.get(dim, ()):
                    wanted = np.zeros(len(part), bool)
                    for own in members.itertuples():
                        reach = norms
                        if own.cluster >= 0:
                            reach = _reach(norms, angles[:, own.cluster], own.angle)
                        wanted |= _with_slack(own.norm * reach) >= own.low
                    if wanted.any():
                        yield part[wanted].assign(block=np.int64(block))

    return run


def _search_part(centroids: dict, same: bool, k: int):
    """Every cluster of a block walks its own list of the part's rows."""

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        dim = int(key[0])
        is_asked = rows["rid"] >= 0
        out = [pd.DataFrame({"rid": [], "id": [], "score": []}, dtype=np.int64)]
        if is_asked.any() and not is_asked.all():
            stored = _arrays(rows[~is_asked], dim)
            for cluster, members in rows[is_asked].groupby("cluster"):
                asked = _arrays(members, dim, "low", "high")
                centroid = centroids[dim][cluster] if cluster >= 0 else np.zeros(dim)
                best, _ = walk(asked, stored, centroid, same, k)
                rid = members["rid"].to_numpy(dtype=np.int64)
                out.append(
                    pd.DataFrame({"rid": rid[best.member], "id": best.id, "score": best.score})
                )
        return pd.concat(out)

    return run


def _sampled(rows: DataFrame) -> dict[int, pd.DataFrame]:
    chosen = rows.orderBy(F.xxhash64("id"), "id", "label", "raw").limit(SAMPLE).toPandas()
    return dict(list(chosen.groupby("dim")))


def first_rows(
    asked: DataFrame, rows: DataFrame, same: bool, k: int = NEAREST, members: int = MEMBERS,
    candidates: int = CANDIDATES,
) -> DataFrame:
    """(rid, id, score): the first k rows of each member of ``asked`` within its window.

    ``rows`` is stored and has the columns of ``VECTOR``; ``asked`` is stored and has
    besides rid, low and high.
    """
    vector = [c.split()[0] for c in VECTOR.split(", ")]
    total = asked.count()
    clusters = max(1, min(CLUSTERS, total // LEAST_MEMBERS))
    centroids = {
        dim: fit_centroids(_matrix(part, dim), clusters)
        for dim, part in _sampled(asked.select(vector)).items()
    }
    sample = {dim: _arrays(part, dim) for dim, part in _sampled(rows.select(vector)).items()}
    placed = cut(
        asked.select(*vector, "rid", "low", "high").mapInPandas(
            _place(centroids, sample, same, k),
            f"{VECTOR}, rid long, low long, high long, cluster int, angle double",
        ),
        "negatives-placed",
    )
    sizes = placed.groupBy("dim", "cluster").agg(F.count(F.lit(1)).alias("size"))
    before = Window.partitionBy("dim").orderBy("cluster")  # a row for each cluster
    sizes = sizes.withColumn("before", F.sum("size").over(before) - F.col("size"))
    place = F.col("before") + F.pmod(F.xxhash64("id"), F.col("size"))
    placed = placed.join(sizes, ["dim", "cluster"]).withColumn(
        "block", F.floor(place / members).cast("long")
    )
    clusters = (
        placed.groupBy("dim", "block", "cluster")
        .agg(F.max("angle").alias("angle"), F.max("norm").alias("norm"), F.min("low").alias("low"))
        .toPandas()
    )
    parts = max(1, -(-rows.count() // candidates))
    # Rows have no number of a member; zeros and not nulls, which pandas would make floats.
    empty = {"rid": F.lit(-1).cast("long"), "cluster": F.lit(-1)}
    empty |= {name: F.lit(0).cast("long") for name in ("low", "high")}
    sent = (
        rows.select(vector)
        .mapInPandas(_route(centroids, clusters), f"{VECTOR}, block long")
        .withColumns(empty | {"part": F.pmod(F.xxhash64("id", "raw"), F.lit(parts))})
    )
    everywhere = F.explode(F.sequence(F.lit(0), F.lit(parts - 1)).cast("array<long>"))
    cells = sent.unionByName(placed.withColumn("part", everywhere).select(sent.columns))
    found = cells.groupBy("dim", "block", "part").applyInPandas(
        _search_part(centroids, same, k), "rid long, id long, score long"
    )
    return _first(found, k).select("rid", "id", "score", "rank")


def _first(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("rid").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _vectors(vectors: DataFrame) -> DataFrame:
    wide = F.transform("embedding", lambda x: x.cast("double"))
    usual = F.forall("vector", lambda x: x.isNotNull() & (F.abs(x) < float("inf")))
    moved = F.when(F.col("id") % MOVED_STEP == 0, (F.col("label") + 1) % LABELS)
    return (
        vectors.select(
            F.col("vec_id").cast("long").alias("id"), F.col("label").cast("long").alias("label"),
            wide.alias("vector"),
        )
        .where("id is not null and label is not null and size(vector) > 0")
        .where(usual)
        .select("id", F.coalesce(moved, "label").alias("label"), F.size("vector").alias("dim"), "vector")
        .mapInPandas(_pack, VECTOR)
        .distinct()
    )


def _asked(df: DataFrame, low: Column, high: Column, label: str) -> DataFrame:
    """Members with a number of their own, written so that the number stays."""
    numbered = df.withColumns(
        {"rid": F.monotonically_increasing_id(), "low": low.cast("long"), "high": high.cast("long")}
    )
    return cut(numbered, label)


def mine_negatives(vectors: DataFrame, k: int = NEAREST, **sizes: int) -> DataFrame:
    """The negatives of each anchor and positive, over all of (vec_id, embedding, label, ...)."""
    rows = cut(_vectors(vectors), "negatives-rows")
    anchors = _asked(
        rows.where(F.col("id") % ANCHOR_STEP == 0), F.lit(LOWEST), F.lit(HIGHEST), "negatives-anchors"
    )
    positives = first_rows(anchors, rows, True, k, **sizes).select(
        "rid", F.col("id").alias("positive_id"), F.col("score").alias("positive_score")
    )
    # 80 * positive <= 100 * negative, in whole numbers.
    floor = F.expr("(cast(positive_score as decimal(20,0)) * 4 + 4) div 5")
    wanted = _asked(
        anchors.drop("low", "high").join(positives, "rid").where("positive_score >= 0").drop("rid"),
        floor, F.col("positive_score"), "negatives-positives",
    )
    # A block of these has the positives of as many anchors.
    per_block = sizes.get("members", MEMBERS) * k
    negatives = first_rows(wanted, rows, False, k, **(sizes | {"members": per_block})).select(
        "rid", "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score")
    )
    pairs = wanted.select("rid", F.col("id").alias("anchor_id"), "positive_id", "positive_score")
    return pairs.join(negatives, "rid").select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )
