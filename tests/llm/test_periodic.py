"""Runs against every period and every start, and reports against plain loops."""

import hashlib
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest

from tallyloom.llm import periodic


def all_runs(words, min_length=24, min_periods=3):
    n, found = len(words), []
    for q in range(1, n // min_periods + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            a = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            length, s = i + q - a, words[a : i + q]
            if length >= max(min_length, min_periods * q) and not any(s[r:] == s[:-r] for r in range(1, q)):
                found.append((a, length, q))
    return sorted(found, key=lambda r: (r[0], r[2]))


@pytest.mark.parametrize("seed", range(6))
def test_runs_of_random_words(seed):
    rng = np.random.default_rng(seed)
    for turn in range(150):
        few = int(rng.integers(1, 5))
        if turn % 2:
            words = rng.integers(0, few, int(rng.integers(0, 110)))
        else:
            parts = [np.tile(rng.integers(0, few, int(rng.integers(1, 14))), int(rng.integers(1, 9))) for _ in range(int(rng.integers(1, 5)))]
            words = np.concatenate(parts)
        least = int(rng.choice([3, 9, 24]))
        got = list(zip(*(x.tolist() for x in periodic.runs_of(words.astype(np.int64), least)), strict=True))
        assert got == all_runs(words.tolist(), least)


@pytest.mark.parametrize("words", [[0] * 5000, [0, 1] * 3000 + [2], list(range(700)) * 4, [0, 0, 1, 0, 0, 2] * 40 + [0, 0, 1] * 40])
def test_long_runs(words):
    got = list(zip(*(x.tolist() for x in periodic.runs_of(np.array(words))), strict=True))
    assert (0, 5000, 1) in got if words[:3] == [0, 0, 0] else got
    for start, length, q in got:
        assert words[start : start + length - q] == words[start + q : start + length]
        assert start == 0 or words[start - 1] != words[start - 1 + q]
        assert start + length == len(words) or words[start + length] != words[start + length - q]


def report(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = all_runs(words)
    best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    gone = {i for a, length, q in found for i in range(a + q, a + length)}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (
        doc_id, len(found), *((*best, 1000 * best[1] // best[2]) if best else (None,) * 4),
        sha("".join(f"{a},{length},{q}\n" for a, length, q in found)), sha(" ".join(w for i, w in enumerate(words) if i not in gone)),
    )


def texts():
    rng = np.random.default_rng(3)
    out = [None, "", " \t\n", "one", "a " * 24, "a " * 23, "no break space here " * 30, "é\x0bb\x0cc " * 40, "a b a b " * 10 + "c " * 30 + "a b c d e f g h " * 4]
    for _ in range(190):
        words = [f"w{x}" for x in rng.integers(0, 30, int(rng.integers(1, 150)))]
        if rng.random() < 0.4:
            a, q = int(rng.integers(0, len(words))), int(rng.integers(1, 12))
            words[a:a] = words[a : a + q] * int(rng.integers(3, 14))
        out.append(" ".join(words))
    return out


def test_reports(spark, rows):
    given = [(i, t) for i, t in enumerate(texts())] + [(None, "a " * 30), (5, "x y " * 20), (5, "x y " * 20)]
    docs = spark.createDataFrame([(*r, 9, "x") for r in given], "doc_id long, text string, start long, period string").repartition(3)
    found = periodic.periodic_runs(docs, periodic.planted_period)
    assert rows(found) == sorted((report(*r) for r in given), key=repr)
    assert sum(r[1] > 0 for r in rows(found)) > 40
    assert periodic.periodic_runs(docs.where("false")).count() == 0


def test_texts_of_a_group_do_not_meet(monkeypatch):
    given = ["a b " * 8, "a b " * 8, "a b " * 20, "c", "b a " * 5]
    together = periodic._reports([1, 2, 3, 4, 5], given, None)
    monkeypatch.setattr(periodic, "CHUNK_BYTES", 1)
    alone = [r for a, b in periodic._grouped(given) for r in periodic._reports([1, 2, 3, 4, 5][a:b], given[a:b], None)]
    assert together == alone and [r[0] for r in alone] == [0, 0, 1, 0, 0]
