"""Word and word 5-gram hashes for a batch of texts, computed in numpy.

Words are ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z, unless other separators
are given; since all separators are ASCII, the work is done on UTF-8 bytes. A shingle is a 64-bit hash of five
consecutive words. A text with one to four words has a single shingle, its whole
word sequence; one without words, or null, has the empty set.
"""

from __future__ import annotations

import numpy as np

WORDS = 5
BLOCK = 1 << 18  # bytes hashed at a time

_ODD = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_ODD), -1, 1 << 64))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_CODES = mix(np.arange(1, 257, dtype=np.uint64))


class WordHasher:
    """Hashes all words of a byte block at once by a polynomial over its bytes.

    ``separators`` marks the bytes between words; a blank must be one of them. With
    ``prefixes``, hashes have a column for the word and one for each such number of
    leading bytes (0 where the word is no longer than that).
    """

    def __init__(self, separators: np.ndarray = _SPACE, prefixes: tuple[int, ...] = ()) -> None:
        self.separators = separators
        self.prefixes = prefixes
        self._up = self._down = np.ones(1, dtype=np.uint64)

    def _powers(self, size: int) -> None:
        if len(self._up) < size + 1:
            for name, base in (("_up", _ODD), ("_down", _INVERSE)):
                powers = np.full(size + 1, base, dtype=np.uint64)
                powers[0] = 1
                setattr(self, name, np.cumprod(powers, dtype=np.uint64))

    def __call__(self, block: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(hash, start, end) of each word of ``block``."""
        self._powers(len(block))
        raw = np.frombuffer(block, dtype=np.uint8)
        edges = np.flatnonzero(np.diff(~self.separators[raw], prepend=False, append=False))
        starts, ends = edges[::2], edges[1::2]
        sums = np.zeros(len(raw) + 1, dtype=np.uint64)
        np.cumsum(_CODES[_LOWER[raw]] * self._up[: len(raw)], out=sums[1:])
        down = self._down[starts]
        sizes = ends - starts
        hashes = mix((sums[ends] - sums[starts]) * down + sizes.astype(np.uint64))
        if self.prefixes:
            columns = [hashes]
            for size in self.prefixes:
                part = (sums[np.minimum(starts + size, ends)] - sums[starts]) * down
                columns.append(np.where(sizes > size, mix(part + np.uint64(size << 32)), 0))
            hashes = np.stack(columns, axis=1)
        return hashes, starts, ends

    def long_text(self, text: bytes) -> list[np.ndarray]:
        """The same for one long text, cut into pieces between words."""
        found = []
        at = 0
        while at < len(text):
            end = at + BLOCK
            while end < len(text) and not self.separators[text[end]]:
                end += 1
            hashes, starts, ends = self(text[at:end])
            found.append((hashes, starts + at, ends + at))
            at = end
        return [np.concatenate(parts) for parts in zip(*found, strict=True)]


def words_of(texts: list[bytes | None], hasher: WordHasher) -> list[list[np.ndarray]]:
    """(hashes, starts, ends) of the words of each text; texts are hashed together."""
    none = list(hasher(b""))
    out: list[list[np.ndarray]] = [none] * len(texts)
    waiting: list[int] = []
    size = 0

    def flush() -> None:
        nonlocal size
        if waiting:
            hashes, starts, ends = hasher(b" ".join(texts[i] for i in waiting))
            bounds = np.cumsum([0] + [len(texts[i]) + 1 for i in waiting])
            cuts = np.searchsorted(starts, bounds)
            for k, i in enumerate(waiting):
                part = slice(cuts[k], cuts[k + 1])
                out[i] = [hashes[part], starts[part] - bounds[k], ends[part] - bounds[k]]
        waiting.clear()
        size = 0

    for i, text in enumerate(texts):
        if not text:
            continue
        if len(text) > BLOCK:
            out[i] = hasher.long_text(text)
            continue
        if size + len(text) > BLOCK:
            flush()
        waiting.append(i)
        size += len(text) + 1
    flush()
    return out


def shingle_set(words: np.ndarray) -> np.ndarray:
    """The sorted distinct shingles of one text's word hashes."""
    n = min(len(words), WORDS)
    if n == 0:
        return words
    steps = len(words) - n + 1
    total = np.full(steps, n, dtype=np.uint64)
    for j in range(n):
        total = total * _ODD + words[j : j + steps]
    return np.unique(mix(total))


def shingle_sets(texts: list[bytes | None], hasher: WordHasher) -> list[np.ndarray]:
    return [shingle_set(words) for words, _, _ in words_of(texts, hasher)]


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted sets."""
    if len(a) > len(b):
        a, b = b, a
    if not len(a):
        return 0
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int(np.count_nonzero(b[at] == a))
