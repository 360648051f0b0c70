"""URL rules by a bit-parallel wildcard automaton.

All globs are packed into one Shift-And automaton: every glob symbol is a bit of a
row of 64-bit words, ``*`` being a loop on the bit before it. A step takes one byte
of the canonical URL (host and path) and moves all globs at once, for all URLs of a
batch together; patterns may cross word borders. ``**`` matches any bytes, ``*``
any but ``/``.

Each rule (host, path) gives two globs, ``host/path**`` and ``*.host/path**``, so it
fits its host and all subdomains; of the rules that fit the longest wins. URLs that
no rule fits are judged by the method's own globs, and allowed if none matches.

Null URLs and those without ``://`` have an empty host and path, fit nothing and are
allowed. Repeated rows are judged alike.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values of the task: (verdict, host, path).
RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]
# Where no rule fits, URLs matching one of these are blocked.
BLOCKED = ["**pills**", "**casino**", "**poker**", "**porn**", "**/wp-admin/**", "**/cgi-bin/**"]

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


class GlobAutomaton:
    """Shift-And over all globs; ``match`` tells for each text which globs fit it."""

    def __init__(self, globs: Iterable[str]) -> None:
        symbols: list[int] = []  # the byte that moves into each bit; -1: start of a glob
        loops: dict[int, str] = {}
        ends: list[int] = []
        for glob in globs:
            loops.setdefault(len(symbols), "")
            symbols.append(-1)
            for k, literal in enumerate(glob.replace("**", "\0").replace("*", "\1").encode()):
                if literal in (0, 1):
                    kind = "**" if literal == 0 else "*"
                    at = len(symbols) - 1
                    loops[at] = "**" if loops.get(at) == "**" else kind
                else:
                    symbols.append(literal)
            ends.append(len(symbols) - 1)
        self.words = -(-len(symbols) // 64)
        self.ends = np.array(ends)
        self.starts = self._bits(i for i, s in enumerate(symbols) if s < 0)
        self.masks = np.zeros((256, self.words), np.uint64)
        self.loops = np.zeros((256, self.words), np.uint64)
        any_byte = self._bits(i for i, kind in loops.items() if kind == "**")
        inside = self._bits(i for i, kind in loops.items() if kind in ("*", "**"))
        for byte in range(256):
            self.masks[byte] = self._bits(i for i, s in enumerate(symbols) if s == byte)
            self.loops[byte] = any_byte if byte == ord("/") else inside

    def _bits(self, positions: Iterable[int]) -> np.ndarray:
        row = np.zeros(self.words, np.uint64)
        for i in positions:
            row[i // 64] |= np.uint64(1 << (i % 64))
        return row

    def match(self, texts: list[bytes]) -> np.ndarray:
        """A row of booleans, one for each glob, for each text."""
        sizes = np.array([len(t) for t in texts], dtype=np.int64)
        turn = np.argsort(-sizes, kind="stable")
        offsets = np.concatenate([[0], np.cumsum(sizes)])[:-1]
        joined = np.frombuffer(b"".join(texts), np.uint8)
        state = np.tile(self.starts, (len(texts), 1))
        reach = np.searchsorted(-sizes[turn], -np.arange(sizes.max(initial=0)), side="left")
        for at, live in enumerate(reach):
            byte = joined[offsets[turn[:live]] + at]
            now = state[:live]
            moved = now << np.uint64(1)
            moved[:, 1:] |= now[:, :-1] >> np.uint64(63)
            state[:live] = (moved & self.masks[byte]) | (now & self.loops[byte])
        hit = state[:, self.ends // 64] >> (self.ends % 64).astype(np.uint64) & np.uint64(1)
        out = np.empty(hit.shape, dtype=bool)
        out[turn] = hit.astype(bool)
        return out


def rule_globs(rules: list[tuple[str, str, str]]) -> list[str]:
    return [g for _, host, path in rules for g in (f"{host}{path}**", f"*.{host}{path}**")]


def judge(
    texts: list[bytes], automaton: GlobAutomaton, rules: list[tuple[str, str, str]]
) -> tuple[np.ndarray, np.ndarray]:
    """(rule or None, verdict) of each canonical URL."""
    hits = automaton.match(texts)
    fits = hits[:, : 2 * len(rules)].reshape(len(texts), len(rules), 2).any(axis=2)
    lengths = np.array([len(host + path) for _, host, path in rules])
    names = np.array([host + path for _, host, path in rules] + [None], dtype=object)
    verdicts = np.array([v for v, _, _ in rules] + ["allow"], dtype=object)
    best = np.where(fits.any(axis=1), np.where(fits, lengths, -1).argmax(axis=1), len(rules))
    bad = (best == len(rules)) & hits[:, 2 * len(rules) :].any(axis=1)
    return names[best], np.where(bad, "block", verdicts[best])


def host_and_path() -> tuple[F.Column, F.Column]:
    """Host and path of ``url``, empty for null and for text without ``://``."""
    host = F.regexp_extract("url", r"(?s)^.*?://([^/?#]*)", 1)
    path = F.regexp_extract("url", r"(?s)^.*?://[^/?#]*([^?#]*)", 1)
    return (
        F.coalesce(F.translate(host, UPPER, LOWER), F.lit("")),
        F.coalesce(path, F.lit("")),
    )


def filter_urls(
    pages: DataFrame,
    rules: list[tuple[str, str, str]] = RULES,
    blocked: list[str] = BLOCKED,
) -> DataFrame:
    """(page_id, host, path, rule, verdict) of every row of ``pages`` (page_id, url, ...)."""
    automaton = GlobAutomaton(rule_globs(rules) + blocked)

    @F.pandas_udf("rule string, verdict string")
    def judged(urls: pd.Series) -> pd.DataFrame:
        rule, verdict = judge([u.encode("utf-8", "replace") for u in urls], automaton, rules)
        return pd.DataFrame({"rule": rule, "verdict": verdict})

    host, path = host_and_path()
    return (
        pages.select("page_id", host.alias("host"), path.alias("path"))
        .withColumn("judged", judged(F.concat("host", "path")))
        .select("page_id", "host", "path", "judged.rule", "judged.verdict")
    )
