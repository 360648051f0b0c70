"""Exact Jaccard self-join of documents on word 5-grams, by a token-group matrix.

Similar documents are put into groups of bounded size; the matrix holds the union
of each group's tokens. A query document can only reach similarity 0.8 with a
member of a group if at least 80% of its tokens lie in that union, so a group is
opened, and pairs compared, only for queries that pass this bound.

Which groups meet at all is found from prefixes: in any fixed order of all
tokens, two linked documents share a token among the first ``n - ceil(0.8 n) + 1``
of each. The order is by hash, with frequent tokens last: those found often in a
bounded sample, and those counted often at the front of all documents' sets (by a short
code of a token, as now and then a wrong one among them does no harm). So a
passage that many documents share brings no two of them together unless it makes up
most of both. The order decides only how much work there is: any order gives the
same links. Copies of a set are left out before prefixes are sent, and documents that
no group needs before texts are, both by a Bloom filter of the ids that matter.

Steps: (1) frequent tokens are found; (2) documents with equal sets fall into one
class; (3) prefix tokens of a single row are dropped; (4) a document's group is
its most shared prefix token, large groups being split by hash; (5) groups that share
prefix tokens meet, and those members that hold such a token, and whose prefixes leave
room for a partner, stay;
(6) meeting groups are opened, under the bound; (7) links become connected components.

Null texts, empty texts and texts without words have an empty set and link with
nothing. Rows with a null doc_id link with nothing and have no component. Rows
that repeat fall into one class; rows that share a doc_id are one node.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaargraph.llm.bloom import Bloom
from bazaargraph.llm.components import connected_components
from bazaargraph.llm.shingles import WordHasher, mix, overlap, shingle_sets
from bazaargraph.workspace import cut

SAMPLE = 4096  # documents whose token counts set the order
HEAVY_AT = 3  # a token of so many sampled documents is frequent
COMMON_AT = 8  # and so is one at the front of so many of all documents
FRONT = 0.3  # share of a set, in order, whose tokens are counted
HEAVY_MAX = 1 << 19  # frequent tokens of either kind at most (4 MB); others stay in hash order
GROUP = 2048  # documents of a group
BUCKET = 100_000  # prefix tokens of a bucket
BYTES = 6  # of a word and a blank, about
OPENED = 1_000  # documents that a task opens at a time
SLICE = 1_000  # documents hashed at a time

_PACKED = "bucket int, tokens binary, docs binary, places binary"


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def prefix_length(n: int) -> int:
    return n - (80 * n + 99) // 100 + 1


def linked(inter: int, a: int, b: int) -> bool:
    return 100 * inter >= 80 * (a + b - inter)


def _texts(batch: pa.RecordBatch):
    ids, texts = batch.column(0), batch.column(1)
    for at in range(0, len(ids), SLICE):
        part = texts.slice(at, SLICE).cast(pa.binary()).to_pylist()
        yield ids.slice(at, SLICE), part


def _sampled_tokens(batches):
    hasher = WordHasher()
    for batch in batches:
        for _, texts in _texts(batch):
            sets = shingle_sets(texts, hasher)
            tokens = np.concatenate([*sets, np.zeros(0, np.uint64)])
            yield pa.record_batch([pa.array(_signed(tokens))], names=["token"])


def _top(counts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent of (token, n), at most ``HEAVY_MAX``, and their n."""
    top = counts.orderBy(F.desc("n"), "token").limit(HEAVY_MAX).toPandas()
    return top["token"].to_numpy(np.int64).view(np.uint64), top["n"].to_numpy(np.float64)


def _bucket(tokens: np.ndarray, buckets: int) -> np.ndarray:
    return (tokens >> np.uint64(32)).astype(np.int64) * buckets >> 32


def _codes(tokens: np.ndarray, buckets: int) -> np.ndarray:
    """A token's bucket and its last three bytes: nearly unique, and short inside a bucket."""
    high = _bucket(tokens, buckets).astype(np.uint64) << np.uint64(24)
    return high | (tokens & np.uint64(0xFFFFFF))


def _planes(values: np.ndarray, size: int = 8) -> bytes:
    """The first bytes of all values, then the second ones, and so on; these compress well."""
    raw = values.view(np.uint8).reshape(len(values), values.itemsize)
    return np.ascontiguousarray(raw[:, :size].T).tobytes()


def _from_planes(parts, dtype, size: int) -> np.ndarray:
    found = [np.zeros(0, dtype)]
    for part in parts:
        planes = np.frombuffer(part, np.uint8).reshape(size, -1)
        raw = np.zeros((planes.shape[1], np.dtype(dtype).itemsize), np.uint8)
        raw[:, :size] = planes.T
        found.append(raw.view(dtype).ravel())
    return np.concatenate(found)


def _fronts(heavy, buckets: int):
    """Counts of the tokens at the front of the sets of a batch, packed by bucket."""

    def run(batches):
        hasher = WordHasher()
        for batch in batches:
            found = [np.zeros(0, np.uint64)]
            for _, texts in _texts(batch):
                for tokens in shingle_sets(texts, hasher):
                    found.append(ordered_prefix(tokens, heavy.value, buckets, FRONT)[0])
            codes = _codes(np.concatenate(found), buckets)
            codes, counts = np.unique(codes, return_counts=True)
            where = (codes >> np.uint64(24)).astype(np.int64)
            cuts = np.flatnonzero(np.diff(where)) + 1
            counts = np.minimum(counts, np.iinfo(np.uint16).max).astype(np.uint16)
            columns = [
                pa.array([_planes(x, size) for x in np.split(values, cuts)], pa.binary())
                for values, size in ((codes, 3), (counts, 2))
            ]
            numbers = pa.array([int(x[0]) for x in np.split(where, cuts) if len(x)], pa.int32())
            if len(codes):
                yield pa.RecordBatch.from_arrays(
                    [numbers, *columns], names=["bucket", "tokens", "counts"]
                )

    return run


def _common_in_bucket(rows: pd.DataFrame) -> pd.DataFrame:
    codes = _from_planes(rows["tokens"], np.int64, 3) | (int(rows["bucket"].iloc[0]) << 24)
    counts = _from_planes(rows["counts"], np.uint16, 2)
    turn = np.argsort(codes, kind="stable")
    codes, starts = np.unique(codes[turn], return_index=True)
    n = np.add.reduceat(counts[turn].astype(np.int64), starts)
    return pd.DataFrame({"token": codes[n >= COMMON_AT], "n": n[n >= COMMON_AT]})


def _frequent_tokens(docs: DataFrame) -> tuple[np.ndarray, np.ndarray, int]:
    """(codes of frequent tokens, sorted; about how frequent; buckets for prefix tokens)."""
    rows, size = docs.agg(F.count(F.lit(1)), F.sum(F.octet_length("text"))).first()
    buckets = max(16, int((size or 0) / BYTES / 5) // BUCKET)
    share = min(1.0, SAMPLE / max(rows, 1))
    sampled = docs.where(
        F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < F.lit(int(share * (1 << 20)) + 1)
    )
    tokens, weights = _top(
        sampled.mapInArrow(_sampled_tokens, "token long")
        .groupBy("token")
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") >= HEAVY_AT)
    )
    tokens, first = np.unique(_codes(tokens, buckets), return_index=True)
    weights = weights[first] / share
    if share == 1.0:
        return tokens, weights, buckets
    known = docs.sparkSession.sparkContext.broadcast(tokens)
    common, counts = _top(
        docs.mapInArrow(_fronts(known, buckets), "bucket int, tokens binary, counts binary")
        .groupBy("bucket")
        .applyInPandas(_common_in_bucket, "token long, n long")
    )
    both, numbers = np.append(tokens, common), np.append(weights, counts)
    turn = np.lexsort((-numbers, both))
    tokens, first = np.unique(both[turn], return_index=True)
    return tokens, numbers[turn][first], buckets


def ordered_prefix(
    tokens: np.ndarray, heavy: np.ndarray, buckets: int, share: float = 0.0
) -> tuple[np.ndarray, int]:
    """(the prefix of a sorted set, or ``share`` of it, how many of it are not frequent).

    ``heavy`` has the codes of frequent tokens, in order.
    """
    length = max(prefix_length(len(tokens)), int(share * len(tokens)))
    if not len(heavy):
        return tokens[:length], length
    codes = _codes(tokens, buckets)
    at = np.searchsorted(heavy, codes)
    at[at == len(heavy)] = 0
    late = heavy[at] == codes
    rare = tokens[~late][:length]
    return np.concatenate([rare, tokens[late][: length - len(rare)]]), len(rare)


def _digests(batches):
    """Size and 128-bit digest of each document's set."""
    hasher = WordHasher()
    for batch in batches:
        for ids, texts in _texts(batch):
            sets = shingle_sets(texts, hasher)
            h1 = np.array([np.add.reduce(s, dtype=np.uint64) for s in sets], np.uint64)
            h2 = np.array(
                [np.add.reduce(mix(s + np.uint64(77)), dtype=np.uint64) for s in sets], np.uint64
            )
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array([len(s) for s in sets], pa.int32()),
                 pa.array(_signed(h1)), pa.array(_signed(h2))],
                names=["doc_id", "n", "h1", "h2"],
            )


def _prefixes(heavy, buckets: int):
    """Prefix tokens of all documents, packed by bucket.

    Frequent tokens, of which nothing can be dropped, are dealt to buckets below 0 by
    document.
    """

    def run(batches):
        hasher = WordHasher()
        for batch in batches:
            found: list[tuple[np.ndarray, ...]] = []
            for ids, texts in _texts(batch):
                sets = shingle_sets(texts, hasher)
                for doc_id, tokens in zip(ids.to_pylist(), sets, strict=True):
                    if doc_id is not None and len(tokens):
                        prefix, rare = ordered_prefix(tokens, heavy.value[0], buckets)
                        places = np.arange(1, len(prefix) + 1, dtype=np.int32)
                        docs = np.full(len(prefix), doc_id, np.int64)
                        found.append((prefix, docs, places, places > rare))
            if not found:
                continue
            tokens, docs, places, late = map(np.concatenate, zip(*found, strict=True))
            where = _bucket(tokens, buckets)
            where[late] = -1 - np.abs(docs[late]) % buckets
            turn = np.argsort(where, kind="stable")
            where = where[turn]
            cuts = np.flatnonzero(np.diff(where)) + 1
            columns = [
                pa.array([_planes(x, size) for x in np.split(values[turn], cuts)], pa.binary())
                for values, size in ((tokens, 8), (docs, 8), (places, 4))
            ]
            numbers = pa.array([int(x[0]) for x in np.split(where, cuts)], pa.int32())
            yield pa.RecordBatch.from_arrays(
                [numbers, *columns], names=["bucket", "tokens", "docs", "places"]
            )

    return run


def _entries(tokens, docs, places) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return (
        _from_planes(tokens, np.int64, 8),
        _from_planes(docs, np.int64, 8),
        _from_planes(places, np.int32, 4),
    )


def _shared_in_bucket(heavy, buckets: int):
    """The entries of a bucket whose token may stand in several documents, and in how many.

    Frequent tokens have the number they were found with; it only guides the grouping.
    """

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        tokens, docs, places = _entries(rows["tokens"], rows["docs"], rows["places"])
        if rows["bucket"].iloc[0] < 0:
            frequent, weights = heavy.value
            codes = _codes(tokens.view(np.uint64), buckets)
            numbers = weights[np.searchsorted(frequent, codes)].astype(np.int64)
        else:
            turn = np.argsort(tokens, kind="stable")
            tokens, docs, places = tokens[turn], docs[turn], places[turn]
            starts = np.flatnonzero(np.append(True, tokens[1:] != tokens[:-1]))
            counts = np.diff(np.append(starts, len(tokens)))
            numbers = np.repeat(counts, counts)
        keep = numbers > 1
        return pd.DataFrame(
            {"token": tokens[keep], "doc": docs[keep], "place": places[keep], "df": numbers[keep]}
        )

    return run


class _Forest:
    """Union-find over the positions of one opened pair of groups."""

    def __init__(self, size: int) -> None:
        self.parent = list(range(size))

    def root(self, x: int) -> int:
        while self.parent[x] != x:
            self.parent[x] = x = self.parent[self.parent[x]]
        return x

    def join(self, a: int, b: int) -> bool:
        a, b = self.root(a), self.root(b)
        self.parent[max(a, b)] = min(a, b)
        return a != b


def _by_pair(rows: pd.DataFrame):
    """(u, v, the two sides) of each pair of groups; a side is the positions of its rows."""
    rows = rows.sort_values(["u", "v", "side", "doc"], ignore_index=True)
    u, v, side = (rows[c].to_numpy() for c in ("u", "v", "side"))
    cuts = np.flatnonzero((u[1:] != u[:-1]) | (v[1:] != v[:-1])) + 1
    middles = np.add.reduceat(side == 0, np.append(0, cuts)) if len(rows) else []

    def pairs():
        for low, high, first in zip(
            np.append(0, cuts), np.append(cuts, len(rows)), middles, strict=False
        ):
            yield u[low], v[low], (range(low, low + first), range(low + first, high))

    return rows, pairs()


def possible_docs(sides: list[tuple], same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Which documents of two groups, or of one, can have a partner there.

    A side holds the sizes, prefix tokens and places of its documents. Two documents
    share no more than their common prefix tokens and what stands behind the last of
    these in either; that must reach the overlap their sizes ask.
    """
    queries, (sizes, member_tokens, member_places) = sides
    owner = np.repeat(np.arange(len(sizes)), [len(t) for t in member_tokens])
    tokens, places = np.concatenate(member_tokens), np.concatenate(member_places)
    turn = np.argsort(tokens, kind="stable")
    tokens, owner, places = tokens[turn], owner[turn], places[turn]
    live = np.zeros(len(queries[0]), dtype=bool), np.zeros(len(sizes), dtype=bool)
    for i, (n, own, where) in enumerate(zip(*queries, strict=True)):
        if same and live[1][i]:
            continue  # its partner found it, and the bound is the same from either side
        low = np.searchsorted(tokens, own, "left")
        counts = np.searchsorted(tokens, own, "right") - low
        spots = np.repeat(low - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())
        hit = owner[spots]
        common = np.bincount(hit, minlength=len(sizes))
        last, here = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
        np.maximum.at(last, hit, places[spots])
        np.maximum.at(here, hit, np.repeat(where, counts))
        most = common + np.minimum(n - here, sizes - last)
        good = (common > 0) & (180 * most >= 80 * (n + sizes))
        if same:
            good[i] = False
        live[0][i] = good.any()
        live[1][good] = True
    if same:
        live[0][live[1]] = True
    return live


def _live_rows(rows: pd.DataFrame) -> pd.DataFrame:
    rows, pairs = _by_pair(rows)
    sizes = rows["n"].to_numpy(np.int64)
    tokens, places = rows["tokens"].to_numpy(), rows["places"].to_numpy()
    keep = np.zeros(len(rows), dtype=bool)
    for u, v, ends in pairs:
        sides = [(sizes[e.start : e.stop], tokens[e.start : e.stop], places[e.start : e.stop])
                 for e in ends]
        if u == v:
            keep[ends[0].start : ends[0].stop] = possible_docs([sides[0]] * 2, True)[0]
        elif ends[0] and ends[1]:
            for end, live in zip(ends, possible_docs(sides, False), strict=True):
                keep[end.start : end.stop] = live
    return rows.loc[keep, ["u", "v", "side", "doc"]]


def open_groups(queries: list, members: list, same: bool) -> list[tuple[int, int]]:
    """Links between (doc, sorted set) of two groups, or inside one.

    Only links that join two components found so far are returned, which leaves
    the components as they are.
    """
    owners = np.repeat(np.arange(len(members)), [len(s) for _, s in members])
    tokens = np.concatenate([s for _, s in members])
    turn = np.argsort(tokens, kind="stable")
    tokens, owners = tokens[turn], owners[turn]
    union = np.unique(tokens)
    sizes = np.array([len(s) for _, s in members])
    apart = len(members) + (0 if same else len(queries))
    forest = _Forest(apart)
    links = []
    for i, (doc, own) in enumerate(queries):
        if not same and 100 * overlap(own, union) < 80 * len(own):
            continue  # the bound of the token-group matrix
        low = np.searchsorted(tokens, own, "left")
        counts = np.searchsorted(tokens, own, "right") - low
        spots = np.repeat(low - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())
        inter = np.bincount(owners[spots], minlength=len(members))
        hits = np.flatnonzero(100 * inter >= 80 * (sizes + len(own) - inter))
        me = i if same else len(members) + i
        for j in hits:
            if forest.join(me, int(j)):
                links.append((doc, members[j][0]))
                apart -= 1
        if apart == 1:
            break  # all are one component
    return links


def _open_bucket(rows: pd.DataFrame) -> pd.DataFrame:
    """Links of the pairs of groups of a part. Texts travel, as they are smaller than sets."""
    rows, pairs = _by_pair(rows.drop_duplicates(["u", "v", "side", "doc"]))
    docs, texts = rows["doc"].to_numpy(), rows["text"].to_numpy()
    first = ~rows["doc"].duplicated().to_numpy()
    sets = dict(
        zip(docs[first],
            shingle_sets(list(texts[first]), WordHasher()), strict=True)
    )
    links: list[tuple[int, int]] = []
    for u, v, ends in pairs:
        sides = [[(docs[i], sets[docs[i]]) for i in end if len(sets[docs[i]])] for end in ends]
        if u == v and sides[0]:
            links += open_groups(sides[0], sides[0], same=True)
        elif sides[0] and sides[1]:
            links += open_groups(sides[0], sides[1], same=False)
    return pd.DataFrame(links, columns=["a", "b"]).astype("int64")


def _meeting_docs(shared: DataFrame, sizes: DataFrame) -> DataFrame:
    """(u, v, side, doc): pairs of groups to open, with those members that can matter."""
    keys = (
        shared.groupBy("doc")
        .agg(F.max(F.struct("df", "token"))["token"].alias("key"))
        .join(sizes, "doc")
    )
    counts = keys.groupBy("key").agg(F.count(F.lit(1)).alias("members"))
    slot = F.pmod(F.xxhash64("doc"), F.ceil(F.col("members") / GROUP))
    members = cut(
        keys.join(counts, "key").select("doc", "n", F.xxhash64("key", slot).alias("unit")),
        "ngram-members",
    )
    placed = cut(shared.drop("df").join(members, "doc"), "ngram-placed")
    matrix = cut(
        placed.groupBy("token", "unit").agg(
            F.count(F.lit(1)).alias("docs"), F.min("place").alias("place"),
            F.min("n").alias("n"),
        ),
        "ngram-matrix",
    )
    alone = members.groupBy("unit").agg((F.count(F.lit(1)) == 1).alias("alone"))
    left, right = (
        matrix.select(
            "token", F.col("unit").alias(u), F.col("place").alias(f"{u}_place"),
            F.col("n").alias(f"{u}_n"),
        )
        for u in ("u", "v")
    )
    met = cut(left.join(right, "token").where("u < v"), "ngram-met")
    pairs = (
        met.groupBy("u", "v")
        .agg(
            F.count(F.lit(1)).alias("common"),
            *(F.max(c).alias(c) for c in ("u_place", "v_place", "u_n", "v_n")),
        )
        .join(alone.toDF("u", "u_alone"), "u")
        .join(alone.toDF("v", "v_alone"), "v")
    )
    # Two single documents: what stands behind the last common prefix token is
    # all they can share besides the common prefix tokens.
    most = F.col("common") + F.least(F.expr("u_n - u_place"), F.expr("v_n - v_place"))
    possible = ~(F.col("u_alone") & F.col("v_alone")) | (most * 180 >= F.expr("80 * (u_n + v_n)"))
    # Of a group only those members come that hold a token which makes it meet the other.
    ends = [F.struct(F.lit(k).alias("side"), F.col(u).alias("unit")) for k, u in enumerate("uv")]
    meeting = (
        met.join(pairs.where(possible), ["u", "v"], "left_semi")
        .select("u", "v", "token", F.explode(F.array(*ends)).alias("end"))
        .select("u", "v", "end.side", "end.unit", "token")
    )
    inside = matrix.where("docs > 1").select(
        F.col("unit").alias("u"), F.col("unit").alias("v"), F.lit(0).alias("side"), "unit", "token"
    )
    opened = cut(
        meeting.unionByName(inside)
        .join(placed.select("token", "unit", "doc"), ["token", "unit"])
        .select("u", "v", "side", "doc")
        .distinct(),
        "ngram-opened",
    )
    parts = max(1, -(-opened.count() // (8 * OPENED)))
    entries = (
        placed.groupBy("doc", "n")
        .agg(F.sort_array(F.collect_list(F.struct("place", "token"))).alias("entries"))
        .select("doc", "n", F.col("entries.token").alias("tokens"), F.col("entries.place").alias("places"))
    )
    return (
        opened.join(entries, "doc")
        .withColumn("part", F.pmod(F.xxhash64("u", "v"), F.lit(parts)))
        .groupBy("part")
        .applyInPandas(_live_rows, "u long, v long, side int, doc long")
    )


def jaccard_components(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of ``docs`` (doc_id, text, ...)."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    *heavy, buckets = _frequent_tokens(docs)
    rows = cut(docs.mapInArrow(_digests, "doc_id long, n int, h1 long, h2 long"), "ngram-rows")
    classes = cut(
        rows.where("n > 0 and doc_id is not null")
        .groupBy("n", "h1", "h2")
        .agg(F.min("doc_id").alias("rep")),
        "ngram-classes",
    )
    sizes = classes.groupBy(F.col("rep").alias("doc")).agg(F.max("n").alias("n"))
    heavy = docs.sparkSession.sparkContext.broadcast(tuple(heavy))  # 2 * HEAVY_MAX at most
    entry = "token long, doc long, place int, df long"
    shared = (
        Bloom(classes, "rep").only(docs, "doc_id")
        .mapInArrow(_prefixes(heavy, buckets), _PACKED)
        .groupBy("bucket")
        .applyInPandas(_shared_in_bucket(heavy, buckets), entry)
        .join(sizes.select("doc"), "doc", "left_semi")
        .groupBy("token", "doc")
        .agg(F.min("place").alias("place"), F.max("df").alias("df"))
    )
    opened = cut(_meeting_docs(cut(shared, "ngram-shared"), sizes), "ngram-live")
    wanted = cut(opened.select("doc").distinct(), "ngram-wanted")
    near = Bloom(wanted, "doc").only(docs, "doc_id")
    texts = near.join(wanted, near["doc_id"] == wanted["doc"], "left_semi").select(
        F.col("doc_id").alias("doc"), F.col("text").cast("binary").alias("text")
    )
    parts = max(1, -(-opened.count() // OPENED))
    links = (
        opened.join(texts, "doc")
        .withColumn("part", F.pmod(F.xxhash64("u", "v"), F.lit(parts)))
        .groupBy("part")
        .applyInPandas(_open_bucket, "a long, b long")
    )
    found = connected_components(links, "ngram-links")
    named = classes.join(found, classes["rep"] == found["node"], "left").select(
        "n", "h1", "h2", F.coalesce("component", "rep").alias("component")
    )
    return (
        rows.join(named, ["n", "h1", "h2"], "left")
        .select(
            "doc_id",
            F.col("n").cast("long").alias("n_shingles"),
            F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias(
                "component_id"
            ),
        )
    )
