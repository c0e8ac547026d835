"""Encoding and decoding against the public library."""

import hashlib
import random

import pytest
from tokenizers import Tokenizer

from tallyloom.llm import bpe


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(bpe.vocabulary_path())


ODD = [
    "", " ", "a", "aaaa aaaaa", "Don't you'll I'M we'd", "ΣΑΣ ΟΔΟΣ ς σ", "İstanbul Iı", "é é ﬁ Å", "\u0085x y z\x1cq",
    "<|endoftext|>", "a<|endoftext|>B <|startoftext|><|ENDOFTEXT|>", "日本語 テキスト", "🎉🎉 a🎉b", "123 45ⅷ ½", "x\0y \0", "ǅ ß ẞ", "한국어",
    "tab\tnew\r\nline", "_under_score__ --- ...", "\0<|endoftext|>",
]


def test_equals_the_library_on_odd_texts(library):
    coder = bpe.Encoder(bpe.vocabulary_path())
    rng = random.Random(5)
    alphabet = "abcdeE'sS 12.,!éßΣσ\n\t日🎉-<|>_"
    texts = ODD + ["".join(rng.choice(alphabet) for _ in range(rng.randrange(1, 200))) for _ in range(300)]
    for text in texts:
        want = library.encode(text, add_special_tokens=False).ids
        assert coder.encode(text) == want, repr(text)
        assert coder.decode(want) == library.decode(want, skip_special_tokens=False)


def test_forgetting_words_changes_nothing(library, monkeypatch):
    monkeypatch.setattr(bpe, "KEPT_WORDS", 3)
    coder = bpe.Encoder(bpe.vocabulary_path())
    for text in ["one two three four five", "six one seven two", "one"]:
        assert coder.encode(text) == library.encode(text, add_special_tokens=False).ids


def test_documents(spark, library):
    rows = [(1, None, "x"), (2, "", "x"), (3, "Hello, World <|endoftext|>", None), (3, "Hello, World <|endoftext|>", None), (None, "word " * 50_000, "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    got = sorted((tuple(r) for r in bpe.round_trip(docs).collect()), key=repr)
    want = []
    for doc_id, text, _ in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
        want.append((doc_id, len(ids), digest(" ".join(map(str, ids))), digest(library.decode(ids, skip_special_tokens=False))))
    assert got == sorted(want, key=repr)
    encoded = bpe.encode_documents(docs)
    assert {r.doc_id: len(r.ids) for r in encoded.collect()} == {r[0]: r[1] for r in got}
    assert {r.text for r in bpe.decode_documents(encoded).where("doc_id = 3").collect()} == {library.decode(library.encode(rows[2][1], add_special_tokens=False).ids, skip_special_tokens=False)}
    assert bpe.round_trip(docs.limit(0)).collect() == []
