"""op11: tokens, counts and divergences against a plain version."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import pytest

from bazaargraph.llm import source_divergence
from tests.llm.data import awkward, frame, words

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_audit(rows: list[tuple], ranks: int) -> list[tuple]:
    found, having, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for row in rows:
        lang, source = row[2] or "", row[3] or ""
        terms = TERM.findall((row[1] or "").translate(LOWER))
        groups[lang].add(source)
        found[lang, source].update(terms)
        having[lang].update(set(terms))
    out = []
    for lang, sources in groups.items():
        kept = [t for t, n in having[lang].items() if n >= 3]

        def shares(counts, kept=kept):
            total = sum(counts[t] for t in kept)
            return {t: 1 + 10**9 * (counts[t] + 1) // (total + len(kept)) for t in kept}

        rates = {s: shares(found[lang, s]) for s in sources}
        whole = shares(sum((found[lang, s] for s in sources), Counter()))
        for s, p in rates.items():
            pairs = [
                (sum((p[t] - q[t]) ** 2 // q[t] for t in kept), o) for o, q in rates.items() if o != s
            ]
            tops = [
                ((p[t] - whole[t]) ** 2 // whole[t], t)
                for t in kept if found[lang, s][t] and p[t] > whole[t]
            ]
            for part, items in (("pair", pairs), ("term", tops)):
                items.sort(key=lambda x: (-x[0], x[1].encode()))
                for k, (value, item) in enumerate(items, 1):
                    if part == "pair" or k <= ranks:
                        out.append((lang, s, part, item, value, k))
    return sorted(out)


def many() -> list[tuple]:
    """Sources of different words, a hot one with a third of the rows, and one with few."""
    rows = list(awkward())
    for k in range(240):
        source = "hot" if k % 3 == 0 else f"s{k % 7}" if k % 50 else None
        text = f"{words(k % 40, 5 + k % 30)} ÉTÉ été Zoo-zoo x{k % 5}y 東京 {'lone' if k == 7 else ''}"
        rows.append((100 + k, text, ("en", "fr", None)[k % 5 % 3], source, 1, 0.5, "t"))
    rows += [(900 + k, None, "none", f"n{k}", 1, 0.5, "t") for k in range(3)]
    return rows


@pytest.mark.parametrize("cells", [1 << 16, 50])
def test_audit_equals_a_plain_version(spark, monkeypatch, cells):
    monkeypatch.setattr(source_divergence, "CELLS", cells)
    rows = many()
    found = source_divergence.audit_sources(frame(spark, rows).repartition(3), ranks=20).collect()
    assert sorted(map(tuple, found)) == plain_audit(rows, 20)


def test_terms_of_long_texts():
    text = ("AB-cd é" + "x" * 100 + " \x00 Zz ") * 30_000
    expected = Counter(t.encode() for t in TERM.findall(text.translate(LOWER)))
    assert source_divergence.term_counts(text.encode()) == expected
    assert not source_divergence.term_counts(b"") and not source_divergence.term_counts(b"12 !\n")


def test_batches_are_merged_sparsely():
    waiting = source_divergence.Sparse()
    for text in (b"a b a", b"a", b""):
        waiting.add(("en", "s"), source_divergence.term_counts(text))
    waiting.add(("fr", "s"), source_divergence.term_counts(b"a"))
    rows = {tuple(r.values()) for r in waiting.merged().to_pylist()}
    assert rows == {
        ("en", "s", b"a", 3, 2), ("en", "s", b"b", 1, 1), ("fr", "s", b"a", 1, 1),
        ("en", "s", None, 0, 0), ("fr", "s", None, 0, 0),
    }
    assert not waiting.terms


def test_empty_and_clashing_columns(spark):
    assert source_divergence.audit_sources(frame(spark, [])).count() == 0
    clash = frame(spark, many()).selectExpr(
        "*", "1 AS n", "2 AS docs", "'x' AS term", "3 AS p", "4 AS rank", "'y' AS item", "5 AS v"
    )
    found = source_divergence.audit_sources(clash, ranks=5).collect()
    assert sorted(map(tuple, found)) == plain_audit(many(), 5)
