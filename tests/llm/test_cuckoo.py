"""The cuckoo index and exact deduplication against plain dictionaries."""

import hashlib
import random
import re

from tallyloom.llm import cuckoo


def test_index_against_a_dictionary():
    rng = random.Random(3)
    keys = [hashlib.sha256(str(i).encode()).digest() for i in range(3000)]
    index, live = cuckoo.CuckooIndex(4), {}
    for _ in range(20_000):
        key = rng.choice(keys)
        if rng.random() < 0.6:
            index.insert(key, 1, (0,), None)
            live[key] = live.get(key, 0) + 1
        else:
            assert index.delete(key) == (key in live)
            if key in live and live[key] == 1:
                del live[key]
            elif key in live:
                live[key] -= 1
    assert index.resizes > 3 and index.size == len(live)
    assert {k: v[0] for k, v in index.items()} == live


def test_equal_fingerprints_are_told_apart_by_the_stored_key():
    a, b = b"\1" * 18 + b"a" * 14, b"\1" * 18 + b"b" * 14
    index = cuckoo.CuckooIndex()
    index.insert(a, 1, (0,), 1)
    assert index.get(b) is None
    index.insert(b, 1, (0,), 2)
    assert index.delete(a) and index.get(a) is None and index.get(b)[2] == 2


ROWS = [
    (1, "a b", "x"), (2, "ab", "y"), (3, "a\tb ", "z"), (4, None, None), (5, "", "q"), (6, "  ", "q"), (7, "long " * 40_000, "q"),
    (8, "ab", "q"), (8, "ab", "q"), (None, "c", "q"), (9, "c", "q"), (10, "ñandú", "q"), (11, "c ", "q"),
]


def test_duplicates(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string, digest string")
    groups = {}
    for i, (doc_id, text, _) in enumerate(ROWS):
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", text or ""), []).append((-len(text or ""), doc_id is None, doc_id or 0, i, doc_id))
    want = sorted(
        ((doc_id, min(g)[4], len(g), min(g)[3] == i, hashlib.sha256(k.encode()).hexdigest()) for k, g in groups.items() for _, _, _, i, doc_id in g),
        key=repr,
    )
    got = cuckoo.exact_duplicates(docs).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.kept, bytes(r.digest).hex()) for r in got), key=repr) == want
    assert cuckoo.drop_exact_duplicates(docs).columns == docs.columns
    assert cuckoo.drop_exact_duplicates(docs).count() == len(groups)
    assert cuckoo.exact_duplicates(docs.limit(0)).count() == 0
    assert cuckoo.drop_exact_duplicates(docs.limit(0)).count() == 0


def test_rows_come_and_go(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string, digest string").drop("digest")
    digests = cuckoo.content_digests(docs)
    index = cuckoo.build_index(digests, 3)
    fewer = cuckoo.update_index(index, digests.limit(0), cuckoo.content_digests(docs.where("doc_id in (1, 10)")), 3)
    more = cuckoo.update_index(fewer, cuckoo.content_digests(docs.where("doc_id = 10")), digests.limit(0), 3)
    sizes = lambda df: {bytes(r.digest): r.group_size for r in df.collect()}
    key = lambda s: hashlib.sha256(s.encode()).digest()
    assert key("ñandú") not in sizes(fewer) and sizes(fewer)[key("ab")] == 4
    assert sizes(more)[key("ñandú")] == 1
