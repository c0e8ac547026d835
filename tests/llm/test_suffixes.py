"""Repeated passages against a brute-force dictionary of all windows."""

import hashlib
import random

import numpy as np
import pytest

from tallyloom.llm import runindex, suffixes


def brute(rows):
    big = 2**63 - 1
    first = {}
    for doc, text in rows:
        data, key = (text or "").encode(), big if doc is None else doc
        for i in range(len(data) - 49):
            w = data[i : i + 50]
            first[w] = min(first.get(w, big), key)
    out = []
    for doc, text in rows:
        data, key = (text or "").encode(), big if doc is None else doc
        gone = bytearray(len(data))
        for i in range(len(data) - 49):
            if first[data[i : i + 50]] < key:
                gone[i : i + 50] = b"\1" * 50
        kept = bytes(b for b, g in zip(data, gone, strict=True) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((doc, len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def corpus(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randrange(2, 8)))
    text = lambda n: " ".join(word() for _ in range(n))
    passages = [text(rng.randrange(8, 40)) for _ in range(6)]
    rows = []
    for i in range(120):
        parts = []
        for _ in range(rng.randrange(1, 5)):
            p = rng.choice(passages)
            a, b = sorted(rng.sample(range(len(p) + 1), 2))
            parts += [text(rng.randrange(0, 12)), p[a:b] if rng.random() < 0.5 else p]
        rows.append((i, " ".join(parts)))
    base = rows[5][1]
    for i in range(40):
        words = base.split()
        words[rng.randrange(len(words))] = word()
        rows.append((200 + i, " ".join(words)))
    rows += [(-3, passages[0]), (7, rows[7][1]), (None, passages[1]), (400, None), (401, ""), (402, "x" * 49), (403, "x" * 200), (404, "x" * 50)]
    rows += [(405, "ab" * 300), (406, "ab" * 26), (407, "日本" * 20), (408, "本" + "日本" * 20), (500, rows[3][1]), (501, rows[3][1])]
    return rows


@pytest.mark.parametrize("sizes", [(4_000_000, 1_000_000, 2_000_000), (3_000, 700, 500)])
def test_against_brute_force(spark, monkeypatch, sizes):
    for name, value in zip(("BATCH_BYTES", "PIECE_BYTES", "INDEX_BYTES"), sizes, strict=True):
        monkeypatch.setattr(suffixes, name, value)
    rows = corpus(1)
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, batch string")
    got = suffixes.repeated_spans(docs).collect()
    assert sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got), key=repr) == brute(rows)


def test_cut_documents(spark):
    rows = corpus(2)
    docs = spark.createDataFrame([(d, t, "x", len(t or "")) for d, t in rows], "doc_id long, text string, source string, n_chars long")
    got = suffixes.cut_repeats(docs)
    assert got.columns == docs.columns
    out = got.collect()
    assert len(out) == len(rows)
    assert all(r.text is None and r.n_chars is None or r.n_chars == len(r.text) for r in out)
    want = {h for *_, h in brute(rows)}
    assert all(hashlib.sha256((r.text or "").encode()).hexdigest() in want for r in out if (r.text or "").isascii())
    assert suffixes.cut_repeats(docs.limit(0)).count() == 0


def test_documents_are_dealt_once(spark, plan):
    text = plan(suffixes.repeated_spans(spark.createDataFrame([(1, "a")], "doc_id long, text string")))
    assert text.count("xxhash64(doc_id") >= 1


def test_rows_in_a_run_of_the_byte_need_no_search(monkeypatch):
    rng = random.Random(4)
    base = bytes(rng.choice(b"abcdefgh") for _ in range(76))
    strings = [base[:i] + bytes([rng.choice(b"xyz")]) + base[i + 1 :] for i in range(0, 76, 2) for _ in range(8)]
    length = np.array([len(s) for s in strings])
    start = np.r_[0, np.cumsum(length + 1)[:-1]]
    text = np.frombuffer(b"".join(s + b"\xff" for s in strings), np.uint8)
    index = runindex.RunIndex(text, np.repeat(np.arange(len(strings)), length + 1))
    searched, stepped = [], []
    search, step = np.searchsorted, index._step
    monkeypatch.setattr(runindex.np, "searchsorted", lambda a, v, *rest: searched.append(np.size(v)) or search(a, v, *rest))
    monkeypatch.setattr(index, "_step", lambda byte, row: stepped.append(len(row)) or step(byte, row))
    values, offset = index.smallest_owners(text, start, length)
    least = {}
    for i, s in enumerate(strings):
        for j in range(len(s) - 49):
            least.setdefault(s[j : j + 50], i)
    assert [least[s[j : j + 50]] for s in strings for j in range(len(s) - 49)] == values.tolist()
    assert sum(searched) < 0.5 * sum(stepped)
