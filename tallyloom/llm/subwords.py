"""Hashed features of texts: words, pairs of words, and n-grams of characters, all numbers of a table of vectors."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: Lengths of character n-grams, the blank on either side of a word included.
LENGTHS = (3, 4, 5)
BITS = 17
#: Characters of texts that are hashed together.
CHUNK_CHARS = 1 << 20

_STEP = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)
_SAME = np.uint64(0x94D049BB133111EB)
_ALL = (1 << 64) - 1


def _number(h: np.ndarray, kind: int, bits: int) -> np.ndarray:
    """Hashes to numbers of table rows; kinds of features do not share hashes."""
    h = (h + np.uint64(kind * int(_SAME) & _ALL)) * _MIX
    h ^= h >> np.uint64(29)
    return ((h * _STEP) >> np.uint64(64 - bits)).astype(np.int32)


def _powers(n: int) -> np.ndarray:
    return np.multiply.accumulate(np.full(n, _STEP)) if n else np.zeros(0, np.uint64)


def features(texts: list[str], bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """(numbers, owners): every feature of every text with the place of its text; repeats are kept.

    Lower case; a word ends at a blank or control character.  A pair of equal words is one and the same feature
    whatever the word, so that texts which repeat themselves are seen as such.
    """
    pieces = [np.frombuffer(f" {t.lower()} ".encode("utf-32-le", "replace"), np.uint32) for t in texts]
    bounds = np.cumsum([0, *map(len, pieces)])
    codes = np.concatenate(pieces) if pieces else np.zeros(0, np.uint32)
    blank = codes <= 32
    kept = ~blank
    kept[1:] |= ~blank[:-1]
    kept[bounds[:-1]] = True
    owners = np.repeat(np.arange(len(texts), dtype=np.int32), np.diff(bounds))[kept]
    codes, blank = np.where(blank, 32, codes)[kept].astype(np.uint64), blank[kept]
    n = len(codes)
    numbers, whose = [], []
    blanks = np.concatenate([[0], np.cumsum(blank)])
    h = codes.copy()
    for length in range(2, max(LENGTHS) + 1):
        if n < length:
            break
        h = h[: n - length + 1] * _STEP + codes[length - 1 :]
        if length in LENGTHS:
            inner = blanks[length - 1 : n] - blanks[1 : n - length + 2]
            at = np.flatnonzero((inner == 0) & (owners[: n - length + 1] == owners[length - 1 :]))
            numbers.append(_number(h[at], length, bits))
            whose.append(owners[at])
    begins = np.flatnonzero(~blank[1:] & blank[:-1]) + 1
    if len(begins):
        ends = np.flatnonzero(blank[1:] & ~blank[:-1]) + 1
        inside = np.flatnonzero(~blank)
        place = inside - np.repeat(begins, ends - begins)
        words = np.add.reduceat(codes[inside] * _powers(int((ends - begins).max()))[place], np.cumsum(ends - begins) - (ends - begins))
        numbers.append(_number(words, 1, bits))
        whose.append(owners[begins])
        pair = owners[begins[1:]] == owners[begins[:-1]]
        one, two = words[:-1][pair], words[1:][pair]
        numbers.append(_number(np.where(one == two, _SAME, one * _MIX + two), 2, bits))
        whose.append(owners[begins[1:]][pair])
    return (np.concatenate(numbers), np.concatenate(whose)) if numbers else (np.zeros(0, np.int32), np.zeros(0, np.int32))


def grouped(texts: list[str]) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``CHUNK_CHARS`` characters, or of one text."""
    a, size = 0, 0
    for b, text in enumerate(texts):
        if b > a and size + len(text) > CHUNK_CHARS:
            yield a, b
            a, size = b, 0
        size += len(text)
    if a < len(texts):
        yield a, len(texts)
