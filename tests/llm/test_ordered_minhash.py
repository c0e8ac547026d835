"""Near-duplicates against all pairs on small corpora."""

import random

import numpy as np

from tallyloom.llm import ordered_minhash as om
from tallyloom.llm.components import components


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    return row[-1]


def test_alignment_against_the_table():
    rng = random.Random(1)
    for _ in range(300):
        a = [rng.randrange(6) for _ in range(rng.randrange(0, 40))]
        b = [x for x in a if rng.random() < 0.8] + [rng.randrange(6) for _ in range(rng.randrange(3))]
        x, y = np.array(a, np.uint64), np.array(b, np.uint64)
        assert om.aligned_words(x, y, 100) == lcs(a, b)
        assert om.aligned_words(x, y, 2) <= lcs(a, b)


def test_order_matters():
    words = om.words_of(" ".join(f"w{i}" for i in range(200)))
    moved = np.r_[words[100:], words[:100]]
    assert om.alike(words, words) and not om.alike(words, moved)
    same = np.mean(om.sketch(words, 3, 64, 1) == om.sketch(moved, 3, 64, 1))
    assert same < 0.6


def corpus():
    rng = random.Random(2)
    text = lambda n: [f"v{rng.randrange(5000)}" for _ in range(n)]
    rows = [(i, " ".join(text(rng.randrange(20, 200)))) for i in range(150)]
    for i in range(120):
        words = rows[i % 12][1].split()
        for _ in range(rng.randrange(0, 1 + len(words) // 25)):
            words[rng.randrange(len(words))] = f"n{rng.randrange(9)}"
        rows.append((1000 + i, " ".join(words)))
    passage = " ".join(text(60))
    rows += [(2000 + i, " ".join(text(80)) + " " + passage) for i in range(40)]
    rows += [(3000, None), (3001, ""), (3002, "!!"), (3007, "★"), (3008, "!!"), (3009, "? ?"), (3003, "one two"), (3004, "One, two!"), (None, rows[0][1]), (5, rows[5][1]), (3005, "w " * 30_000), (3006, "w " * 30_000 + "end")]
    return rows


def brute(rows):
    words = [om.words_of(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            wordless = not len(words[i]) and not len(words[j])
            if (wordless and (rows[i][1] or "") == (rows[j][1] or "")) or (len(words[i]) and len(words[j]) and om.alike(words[i], words[j])):
                root[find(i)] = find(j)
    groups = {}
    for i, (doc, _) in enumerate(rows):
        groups.setdefault(find(i), []).append((doc is None, doc or 0, doc))
    return sorted(((m[2], min(g)[2], len(g)) for g in groups.values() for m in g), key=repr)


def test_classes(spark):
    rows = corpus()
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, entries string").repartition(5)
    out = om.near_duplicates(docs).collect()
    assert sorted(((r.doc_id, r.class_id, r.class_size) for r in out), key=repr) == brute(rows)
    assert sum(r.kept for r in out) == len({r.class_id for r in out})
    kept = om.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted({r.class_id for r in out})


def test_nothing_alike(spark):
    docs = spark.createDataFrame([(1, "a b c d e f"), (2, "u v w x y z")], "doc_id long, text string")
    assert [r.class_size for r in om.near_duplicates(docs).collect()] == [1, 1]
    assert om.near_duplicates(docs.limit(0)).count() == 0 and om.drop_near_duplicates(docs.limit(0)).count() == 0


def test_components(spark):
    links = [(i, i + 1) for i in range(30)] + [(100, 99), (99, 101), (7, 7)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(31)}, 99: 99, 100: 99, 101: 99}


def large_family():
    """A family of 500, of which y-texts are alike to one member only, that is alike to all the others."""
    rng = random.Random(4)
    x = [f"x{i}" for i in range(274)]
    rows = [(1, " ".join(x))]
    for i in range(500):
        words = [*x, "tail"]
        words[rng.randrange(274)] = f"m{i}"
        rows.append((100 + i, " ".join(words)))
    for i in range(8):
        words = list(x)
        for place in range(10 + i, 270, 44):
            words[place] = f"y{i}x{place}"
        rows.append((1000 + i, " ".join(words)))
    return rows


def test_members_of_a_large_class_meet_texts_of_small_ones(spark):
    rows = large_family()
    words = {i: om.words_of(t) for i, t in rows}
    for y in range(1000, 1008):
        assert [i for i in words if i != y and om.alike(words[i], words[y])] == [1]
    assert all(om.alike(words[1], words[i]) for i in range(100, 600))
    out = om.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()
    assert [r.doc_id for r in out if r.class_id != 1] == []


def test_outlines_are_bounds():
    rng = random.Random(5)
    for _ in range(300):
        a = [f"v{rng.randrange(400)}" for _ in range(rng.randrange(1, 300))]
        b = [w if rng.random() < 0.97 else "other" for w in a]
        (m, p), (n, q) = om.outline(x := om.words_of(" ".join(a))), om.outline(y := om.words_of(" ".join(b)))
        apart = sum(((i ^ j) & (1 << 64) - 1).bit_count() for i, j in zip(p, q, strict=True))
        assert apart <= len(np.setxor1d(om.shingles_of(x), om.shingles_of(y)))
        assert 9 * apart <= m + n or not om.alike(x, y)


def short_pairs():
    """Pairs of 5 to 40 words near the threshold, in three groups of a common template each."""
    rng = random.Random(6)
    rows = []
    for i in range(400):
        n = rng.randrange(5, 41)
        words = [f"t{i % 3}w{j}" if j % 3 else f"p{i}w{j}" for j in range(n)]
        other = list(words)
        for _ in range(rng.randrange(1, 3)):
            at = rng.choice([0, len(other)])
            other.insert(at, f"q{i}")
            if rng.random() < 0.3:
                other.pop(0 if at else -1)
        rows += [(2 * i, " ".join(words)), (2 * i + 1, " ".join(other))]
    return rows


def test_short_texts_meet_in_long_entries():
    rows = short_pairs()
    words = [om.words_of(t) for _, t in rows]
    alike = [(a, b) for a, b in zip(words[::2], words[1::2], strict=True) if om.alike(a, b)]
    assert len(alike) > 150 and min(len(a) for a, _ in alike) < 10
    for entries in (om.short_entries, om.long_entries):
        assert [(len(a), len(b)) for a, b in alike if not set(entries(a)) & set(entries(b))] == []


def test_miss_rates_of_entries():
    """At the threshold: of m and n shingles c are common, and an entry is equal if its shingles all are."""
    from math import ceil, comb

    for m in range(1, 400):
        for n in range(m, int(m / 0.8) + 1):
            c = ceil(round(0.8 / 1.8 * (m + n), 9))
            if c > m:
                continue
            union = m + n - c
            equal = lambda k: comb(c, k) / comb(union, k) if m > k else float(c == union) if n <= k else 0  # noqa: E731, B023
            _, length, entries = [tier for tier in om.LONG if tier[0] <= m][-1]
            assert c == union or (1 - equal(length)) ** entries < 1e-4
            assert c == union or (1 - equal(3)) ** (32 if n < om.FEW else 16) < 3e-5


def test_short_classes(spark):
    rows = short_pairs()[:300]
    out = om.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()
    assert sorted(((r.doc_id, r.class_id, r.class_size) for r in out), key=repr) == brute(rows)
