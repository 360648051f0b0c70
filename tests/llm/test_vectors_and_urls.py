"""Operators on embeddings and URLs against plain versions."""

from __future__ import annotations

import re

import numpy as np

from bazaargraph.llm import embedding_dedup, hamming_search, url_filter
from bazaargraph.llm.components import connected_components

VECTORS = "vec_id long, embedding array<float>, label int, rank int"


def vectors():
    rng = np.random.default_rng(3)
    base = rng.standard_normal((40, 32))
    rows = [base[i % 40] + 0.02 * (i // 40) * rng.standard_normal(32) for i in range(200)]
    data = [(i, [float(np.float32(x)) for x in row], None, 1) for i, row in enumerate(rows)]
    data += [(300 + i, data[0][1], 0, 1) for i in range(3)] + [(300, data[0][1], 0, 1)]
    return data + [
        (400, None, 1, 1), (401, [], 1, 1), (402, [0.0] * 32, 1, 1), (403, [None] + [1.0] * 31, 1, 1),
        (404, [float("nan")] + [1.0] * 31, 1, 1), (405, [float("inf")] + [1.0] * 31, 1, 1),
        (406, [1.0, 0.0], 1, 1), (407, [2.0, 0.0], 1, 1), (None, data[0][1], 1, 1),
    ]


def usable(row):
    v = row[1]
    return (
        row[0] is not None and bool(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)
    )


def test_links_equal_brute_force(spark, monkeypatch):
    rows = vectors()
    good = [(i, np.array(r[1], float)) for i, r in enumerate(rows) if usable(r)]
    links = {i: 0 for i in range(len(rows))}
    label = {i: r[0] for i, r in enumerate(rows)}
    pairs = [
        (i, j) for i, a in good for j, b in good
        if i != j and len(a) == len(b) and a @ b / np.sqrt((a @ a) * (b @ b)) >= 0.95
    ]
    for i, _ in pairs:
        links[i] += 1
    for _ in rows:
        for i, j in pairs:
            label[i] = label[j] = min(label[i], label[j])
    expected = sorted(((rows[i][0], links[i], label[i]) for i in links), key=repr)
    for block, small in ((512, 32), (4, 2)):
        monkeypatch.setattr(embedding_dedup, "BLOCK", block)
        monkeypatch.setattr(embedding_dedup, "SMALL", small)
        found = embedding_dedup.near_duplicates(spark.createDataFrame(rows, VECTORS)).collect()
        assert sorted(((r.vec_id, r.n_links, r.component_id) for r in found), key=repr) == expected
        assert all(r.kept == (r.vec_id is not None and r.vec_id == r.component_id) for r in found)


def test_no_vectors(spark):
    none = spark.createDataFrame([], VECTORS)
    assert embedding_dedup.near_duplicates(none).count() == 0
    assert hamming_search.nearest_codes(none).count() == 0


def test_nearest_codes_equal_brute_force(spark, monkeypatch):
    rows = vectors()
    coded = {
        r[0]: [x >= 0 for x in r[1]]
        for r in rows if r[0] is not None and r[1] and not any(x is None or x != x for x in r[1])
    }
    expected = {}
    for q in (i for i in coded if i % 20 == 0):
        near = sorted(
            (sum(a != b for a, b in zip(coded[q], coded[v])), v)
            for v in coded if v != q and len(coded[v]) == len(coded[q])
        )[:5]
        expected |= {(q, k + 1): (v, d) for k, (d, v) in enumerate(near)}
    for codes, queries in ((1 << 16, 1 << 11), (30, 3)):
        monkeypatch.setattr(hamming_search, "CODES", codes)
        monkeypatch.setattr(hamming_search, "QUERIES", queries)
        found = hamming_search.nearest_codes(spark.createDataFrame(rows, VECTORS), k=5).collect()
        assert {(r.query_id, r["rank"]): (r.vec_id, r.distance) for r in found} == expected


def test_search_radii_cover(monkeypatch):
    rng = np.random.default_rng(5)
    codes = rng.integers(0, 1 << 16, (20_000, 2)).astype(np.uint16)
    queries = codes[:50] ^ np.uint16(5)
    found = hamming_search.search(queries, codes, np.arange(20_000), 4)
    for q in range(50):
        apart = np.bitwise_count(codes ^ queries[q]).sum(axis=1)
        best = np.lexsort((np.arange(20_000), apart))[:4]
        assert found.row[found.query == q].tolist() == best.tolist()


def as_regex(glob):
    parts = {"**": "(?s:.)*", "*": "[^/]*"}
    return re.compile("".join(parts.get(p, re.escape(p)) for p in re.split(r"(\*\*|\*)", glob)))


def test_automaton_equals_regular_expressions():
    globs = ["org/**", "*.org/**", "**pills**", "a*b", "**", "*", "x" * 70 + "*y", "", "a**c*d"]
    texts = ["a.org/x", "org/", "b/a.org/", "cheap-pills.com/", "ab", "a/b", "axxb", "", "x" * 70 + "zzy",
             "a/b/cd", "a/b/c/d", "é.org/ü"]
    found = url_filter.GlobAutomaton(globs).match([t.encode() for t in texts])
    for i, text in enumerate(texts):
        assert found[i].tolist() == [bool(as_regex(g).fullmatch(text)) for g in globs], text


def test_urls_with_awkward_rows(spark):
    rows = [
        (1, "HTTP://WWW.Example.ORG/es/1?x"), (2, None), (3, ""), (4, "no scheme/"), (5, "a://org"),
        (6, "a://org/"), (7, "a://xorg/"), (8, "a://b.com/fr/x#y"), (9, "a://b.com/de/x"),
        (10, "a://x.example.org/en/12"), (11, "a://casino.net/"), (12, "a://b.com/" + "p" * 50_000),
        (None, "a://casino.org/"), (13, "x://y://org/"), (13, "x://y://org/"), (14, "a://b\n.org/\n"),
    ]
    pages = spark.createDataFrame([(*r, "h", "r") for r in rows], "page_id long, url string, host string, rule string")
    found = {r.page_id: tuple(r)[1:] for r in url_filter.filter_urls(pages).collect()}
    assert found[1] == ("www.example.org", "/es/1", "example.org/es/", "block")
    assert found[2] == found[3] == found[4] == ("", "", None, "allow")
    assert found[5] == ("org", "", None, "allow") and found[6][2:] == ("org/", "allow")
    assert found[7][2:] == (None, "allow") and found[8][2:] == ("com/fr/", "allow")
    assert found[9][2:] == ("com/de/", "block") and found[10][2:] == ("example.org/en/1", "block")
    assert found[11][2:] == (None, "block") and found[None][2:] == ("org/", "allow")
    assert found[13][:2] == ("y:", "//org/") and found[14][2:] == ("org/", "allow")
    assert url_filter.filter_urls(pages.limit(0)).count() == 0


def test_components(spark):
    edges = [(5, 4), (4, 3), (9, 8), (8, 9), (7, 7), (None, 1), (3, 20), (20, 21), (30, 9)]
    found = connected_components(spark.createDataFrame(edges, "a long, b long")).collect()
    groups = {3: 3, 4: 3, 5: 3, 20: 3, 21: 3, 8: 8, 9: 8, 30: 8}
    assert {r.node: r.component for r in found} == groups
