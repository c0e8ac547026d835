"""The stages one after the other against plain loops on a small corpus."""

import random
import re

import pytest

import corpus_pipeline
from tallyloom.llm import ordered_minhash as om
from tallyloom.llm import packing

rng = random.Random(11)
VOCABULARY = ["".join(rng.choices("abcdefghijklmnop", k=rng.randint(3, 8))) for _ in range(600)]


def prose(n):
    return [rng.choice(VOCABULARY) for _ in range(n)]


def corpus():
    rows, labels = [], []

    def add(text, toxic=0):
        rows.append((len(rows), text, "en", "s", None if text is None else len(text)))
        labels.append((len(rows) - 1, 1, toxic))

    for i in range(120):
        words = prose(rng.randint(20, 90))
        if i % 5 == 0:
            words[rng.randrange(len(words))] = rng.choice(["scum", "moron"])
        add(" ".join(words), int(i % 5 == 0))
    originals = [rows[i][1] for i in range(1, 60) if i % 5]
    for text in originals[:12]:
        add(text.replace(" ", "  ", 2) + "\n")  # equal but for white space, and longer
    for text in originals[12:24]:
        words = text.split()
        words[len(words) // 2] = "edited"
        add(" ".join(words))
    passage = " ".join(prose(25))
    for _ in range(8):
        add(" ".join(prose(30)) + " " + passage + " " + " ".join(prose(30)))
    for text in (None, "", "★", "!!! ???", "★", " ".join(prose(3000))):
        add(text)
    return rows, labels


def after_toxicity(rows):
    return [r for r in rows if not {"scum", "moron"} & set((r[1] or "").split())]


def after_exact(rows):
    best = {}
    for r in rows:
        key = re.sub(r"[\x20\x09-\x0d]", "", r[1] or "")
        order = (-len(r[1] or ""), r[0])
        if key not in best or order < best[key][0]:
            best[key] = order, r
    return sorted(r for _, r in best.values())


def after_near(rows):
    words = [om.words_of(r[1]) for r in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            wordless = not len(words[i]) and not len(words[j])
            if (wordless and (rows[i][1] or "") == (rows[j][1] or "")) or (len(words[i]) and len(words[j]) and om.alike(words[i], words[j])):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [r for i, r in enumerate(rows) if find(i) == i]


def after_repeats(rows, least=50):
    owner = {}
    for r in rows:
        data = (r[1] or "").encode()
        for i in range(len(data) - least + 1):
            owner.setdefault(data[i : i + least], r[0])
    out = []
    for r in rows:
        data = (r[1] or "").encode()
        gone = set()
        for i in range(len(data) - least + 1):
            if owner[data[i : i + least]] < r[0]:
                gone |= set(range(i, i + least))
        text = bytes(b for i, b in enumerate(data) if i not in gone).decode("utf-8", "ignore")
        out.append((*r[:1], None if r[1] is None else text, *r[2:4], None if r[1] is None else len(text)))
    return out


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("tables")
    rows, labels = corpus()
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(4).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return str(folder), rows


def test_stages(spark, tables, tmp_path):
    folder, expected = tables
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    for i, brute in enumerate((after_toxicity, after_exact, after_near, after_repeats)):
        expected = brute(expected)
        out = corpus_pipeline.STAGES[i][1](spark, docs, folder)
        assert out.columns == columns
        out.write.parquet(str(tmp_path / f"stage-{i}"))
        docs = spark.read.parquet(str(tmp_path / f"stage-{i}"))
        assert sorted((tuple(r) for r in docs.collect()), key=repr) == sorted(expected, key=repr), corpus_pipeline.STAGES[i][0]
    assert 0 < len(expected) < 140
    packed = corpus_pipeline.STAGES[4][1](spark, docs, folder).collect()
    assert sequences_of(packed, {r[0] for r in expected}) == sequences_of(corpus_pipeline.run(spark, folder).collect(), {r[0] for r in expected})


def sequences_of(pieces, doc_ids):
    """What must hold of a packing; the pieces with their tokens, whatever sequences they are in."""
    assert {p.doc_id for p in pieces} == doc_ids
    rooms = {}
    for p in pieces:
        rooms.setdefault(p.sequence_id, []).append((p.offset, p.length))
    for own in rooms.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= packing.CAPACITY
    total = sum(p.length for p in pieces)
    assert len(rooms) <= 1 + 1.25 * total / packing.CAPACITY
    return sorted((p.doc_id, p.piece, p.start, p.length, p.ids_crc32) for p in pieces)


def test_a_stage_deletes_what_the_one_before_left_unless_it_reads_it(spark, tables, tmp_path):
    import os

    folder, _ = tables
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    first = corpus_pipeline.exact_dedup(spark, docs, folder)
    left = list(corpus_pipeline._LEFT[spark.sparkContext.applicationId])
    there = lambda: [p for p in left if os.path.exists(p.removeprefix("file:"))]
    assert there()
    n = first.count()
    second = corpus_pipeline.near_dedup(spark, first, folder)  # first was not written: its files are read still
    assert 0 < second.count() <= n
    left = list(corpus_pipeline._LEFT[spark.sparkContext.applicationId])
    second.write.parquet(str(tmp_path / "second"))
    corpus_pipeline.exact_dedup(spark, spark.read.parquet(str(tmp_path / "second")), folder)
    assert not there()
