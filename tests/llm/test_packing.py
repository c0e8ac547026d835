"""Packing: whole, gapless, within capacity, and close to the least possible number."""

import math
import random
import zlib

import numpy as np
from tokenizers import Tokenizer

from tallyloom.llm import bpe, packing


def checked(rows, total, capacity):
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    assert sum(n for parts in by.values() for _, n in parts) == total
    return len(by)


def test_pack_over_several_shards(spark, monkeypatch):
    monkeypatch.setattr(packing, "SHARD_PIECES", 300)
    rng = random.Random(1)
    lengths = [rng.choice([rng.randrange(1, 100), rng.randrange(1, 64), 64]) for _ in range(2500)]
    df = spark.createDataFrame([(n, "same") for n in lengths], "length long, offset string").withColumnRenamed("offset", "note")
    rows = packing.pack(df, 100).collect()
    assert sorted(r.length for r in rows) == sorted(lengths)
    order = sorted(range(len(lengths)), key=lambda i: -lengths[i])
    whole = packing.Packing.fit([], [], order, lengths, 100)
    assert checked(rows, sum(lengths), 100) <= len(whole.groups) * 1.01


def test_crossover_keeps_every_piece_once():
    rng = random.Random(2)
    sizes = [rng.randrange(1, 60) for _ in range(200)]
    orders = [rng.sample(range(200), 200) for _ in range(2)]
    a, b = (packing.Packing.fit([], [], o, sizes, 100) for o in orders)
    child = packing.crossover(a, b, sizes, 100, rng)
    assert sorted(s for g in child.groups for s in g) == list(range(200))
    assert max(child.fills) <= 100


def test_documents(spark):
    library = Tokenizer.from_file(bpe.vocabulary_path())
    rows = [(1, None), (2, ""), (3, "hello " * 5000), (3, "hello " * 5000), (None, "a b c")] + [(i, f"text number {i}") for i in range(10, 60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    pieces = packing.token_pieces(docs, with_ids=True)
    packed = packing.pack(pieces).collect()
    texts = {d: [*library.encode(t or "", add_special_tokens=False).ids, 0] for d, t in rows}
    for r in packed:
        want = texts[r.doc_id][r.start : r.start + 2048]
        assert (list(r.ids), r.length, r.start) == (want, len(want), r.piece * 2048)
        assert r.ids_crc32 == zlib.crc32(np.array(want, "<u4").tobytes())
    total = sum(len(texts[d]) for d, _ in rows)
    assert checked(packed, total, 2048) == math.ceil(total / 2048)
    whole = packing.sequences(packing.pack(pieces)).collect()
    assert sum(len(r.ids) for r in whole) == total
    assert packing.pack(packing.token_pieces(docs.limit(0))).count() == 0


def test_library_words_equal_the_pair_index():
    own, library = bpe.Encoder(bpe.vocabulary_path()), packing.LibraryEncoder(bpe.vocabulary_path())
    text = "Don't you'll ''s '' ' 'sx ab12 <|endoftext|> é日本🎉 ... -- a\0b \x1c ẞ ΣΑΣ " + " ".join(f"w{i}ord" for i in range(1500))
    assert own.encode(text) == library.encode(text) == library.library.encode(text, add_special_tokens=False).ids


class Unlisted(dict):
    def keys(self):
        raise AssertionError("all kept words were looked at")


def test_new_words_cost_no_look_at_all_kept_ones(monkeypatch):
    coder = packing.LibraryEncoder(bpe.vocabulary_path())
    coder.kept, coder.older = Unlisted(), Unlisted()
    texts = ["one two three <|endoftext|> four", "", "five one \u00e9 six", "two"]
    want = [np.array(coder.library.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert coder.packed(texts) == want
    assert all(type(ids) is bytes for ids in coder.kept.values())  # once for all tasks, without an object an id
    monkeypatch.setattr(bpe, "KEPT_WORDS", 3)
    assert [coder.packed([t])[0] for t in texts * 2] == want * 2 == coder.packed(texts * 2)
