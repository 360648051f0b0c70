"""op13: line rules and counts against a plain version."""

from __future__ import annotations

import re
from collections import Counter

from bazaargraph.llm import quality_rules
from tests.llm.data import awkward, frame, words

WORD = re.compile(r"[^\x20\x09-\x0D]+")
PROSE = " ".join(f"{words(k, 9)}." for k in range(12))


def plain_counts(text: str | None) -> tuple:
    text = text or ""
    w = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    times = Counter(windows)
    covered = {i + d for i, x in enumerate(windows) if times[x] > 1 for d in range(3)}
    failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
    return (
        len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)), len(covered), failed,
    )


def test_counts_equal_a_plain_version(spark):
    texts = [
        PROSE, f"{PROSE} {PROSE}", f"{PROSE}\n{PROSE}\nx", "a b c a b c a", "a a a a", "a a", "a",
        "a b c d e\na b c", "é　日本 🎉 #*$ %&| <>\n\n é x\r\n", "\n\n", "a\nb\na\n a\na ",
        "w " * 60 + words(3, 70), words(4, 20_000),
    ]
    rows = awkward() + [(100 + k, t, "en", "s", 1, 0.5, "t") for k, t in enumerate(texts)]
    found = quality_rules.check_quality(frame(spark, rows)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept",
    ).collect()
    expected = Counter((r[0], *plain_counts(r[1])) for r in rows)
    assert Counter(tuple(r)[:-1] for r in found) == expected
    assert not any(r.kept and r.base_failed for r in found)
    assert quality_rules.check_quality(frame(spark, [])).count() == 0


def test_line_rules(spark):
    bad = {
        "no mark": words(1, 8), "table": "aa | bb | cc. | dd | ee", "symbols": "aa### bb&&& cc%%% dd.",
        "shout": "AA!! BB!! CC!! DD.", "menu": "Home About Contact.", "notice": "All Rights Reserved.",
        "code": "if (a) { b; }.", "links": "more » next » back.",
    }
    good = {"one": "A short line.", "question": f"{words(2, 12)}?", "dash": "He paid $5 for tea, no more."}
    text = "\n".join([PROSE, *bad.values(), *good.values(), good["one"]])
    row = quality_rules.judge_lines(frame(spark, [(1, text, None, None, 1, 0.5, "t")])).first()
    assert row.cleaned.split("\n") == [PROSE, *good.values()]
    assert row.kept and row.n_lines_left == 4 and row.n_dup_lines == 1


def test_documents_that_lose_too_much_go(spark):
    table = "\n".join(f"{words(k, 3)} | {words(90 + k, 3)} | x." for k in range(40))
    rows = [(1, PROSE), (2, table), (3, f"{PROSE}\n{table}"), (None, PROSE), (4, None), (5, "")]
    docs = frame(spark, [(i, t, "en", "s", 7, 0.5, "t") for i, t in rows])
    kept = quality_rules.cleaned_documents(docs)
    assert kept.columns == docs.columns
    assert sorted(map(tuple, kept.collect()), key=repr) == sorted(
        [(i, PROSE, "en", "s", 7, 0.5, "t") for i in (1, None)], key=repr
    )


def test_clashing_columns_and_one_evaluation(spark):
    clash = frame(spark).selectExpr("*", "1 AS kept", "'x' AS words", "2 AS lines", "3 AS cleaned")
    assert quality_rules.cleaned_documents(clash).columns == clash.columns
    assert quality_rules.check_quality(clash).where("not base_failed").count() == 6
    plan = quality_rules.check_quality(clash).where("kept")._jdf.queryExecution().toString()
    physical = plan[plan.index("== Physical Plan ==") :]
    assert "Exchange" not in physical and "Python" not in physical
    # A filter on the result does not repeat the work on the windows.
    assert physical.count("sort_array(transform") == 1
