"""Byte-pair encoding and decoding with a pair occurrence index.

A partition's texts are split into words.  The words that this worker has not met yet are laid out one after the
other as symbols, and an index maps every pair of neighbouring symbols to all its positions.  The active ranks are
applied in ascending order: a rank is merged at all its positions at once, and the lists of the pairs that the
merge destroyed or created are brought up to date.  Each distinct word is so encoded once for a partition and not
once for each time it occurs.  The words met are kept for later partitions of the worker, up to twice
``KEPT_WORDS``; that is a store of results, and forgetting them costs time only.

Encoding follows a vocabulary file of the public ``tokenizers`` format: added tokens are cut out of the raw text,
the rest is normalised (NFC, white space, lower case character by character), split by the file's pattern and
turned into bytes.  Other kinds of normaliser or model are refused.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import json
import re
import unicodedata
from collections.abc import Iterable, Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

VOCABULARY = "word_bpe_49k.json"
KEPT_WORDS = 500_000
#: Characters of text that are split into words before the words are encoded; a longer text is taken whole.
CHUNK_CHARS = 1_000_000
#: Texts of characters up to this one are split by the quicker of two equal patterns.
LATIN = "\u024f"
_BEYOND = re.compile(f"[^\0-{LATIN}]")


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _byte_characters() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    shifted = iter(range(256, 512))
    return [chr(b) if b in set(plain) else chr(next(shifted)) for b in range(256)]


def _lower(text: str) -> str:
    """Lower case of every character by itself; ``str.lower`` looks at neighbours of a sigma."""
    low = text.lower()
    return "".join(c.lower() for c in text) if "ς" in low and "Σ" in text else low


class Encoder:
    """Encoding by one vocabulary file."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        kinds = [n["type"] for n in spec["normalizer"]["normalizers"]]
        if model["type"] != "BPE" or kinds != ["NFC", "Replace", "Lowercase"] or model["continuing_subword_prefix"]:
            raise ValueError(f"{path} is not a vocabulary of the kind that this encoder reads")
        vocabulary = model["vocab"]
        self.strings = {i: s for s, i in vocabulary.items()}
        added = {a["content"]: a["id"] for a in spec["added_tokens"]}
        self.strings.update({i: s for s, i in added.items()})
        self.added = added
        self.cut = regex.compile("(" + "|".join(map(regex.escape, sorted(added, key=len, reverse=True))) + ")") if added else None
        self.words = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        self.quick = self._quick(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        end = model["end_of_word_suffix"] or ""
        characters = _byte_characters()
        self.ends = {i for s, i in vocabulary.items() if end and s.endswith(end)}
        self.inner = [vocabulary[c] for c in characters]
        self.last = [vocabulary[c + end] for c in characters]
        pairs = (m.split(" ") if isinstance(m, str) else m for m in model["merges"])
        self.ranks = {(vocabulary[a], vocabulary[b]): (r, vocabulary[a + b]) for r, (a, b) in enumerate(pairs)}
        self.pairs = {r: (pair, new) for pair, (r, new) in self.ranks.items()}
        self.kept: dict[str, tuple[int, ...]] = {}
        self.older: dict[str, tuple[int, ...]] = {}

    @staticmethod
    def _quick(pattern: str) -> re.Pattern:
        """The pattern for texts without characters beyond ``LATIN``, with its classes written out."""
        for name in (r"\p{L}", r"\p{N}", r"\s"):
            members = "".join(re.escape(chr(i)) for i in range(ord(LATIN) + 1) if regex.match(name, chr(i)))
            pattern = pattern.replace(name, members)  # all of them stand within brackets
        return re.compile(pattern)

    def split(self, text: str) -> list[str]:
        """The words of a text; an added token is a word of its own."""
        if self.cut is None or not self.cut.search(text):
            return self._plain(text)
        words: list[str] = []
        for i, piece in enumerate(self.cut.split(text)):
            words += [f"\0{piece}"] if i % 2 else self._plain(piece)
        return words

    def _plain(self, text: str) -> list[str]:
        # The file turns white space to blanks first; as no word holds any, that changes no word.
        if text.isascii():
            return self.quick.findall(text.lower())
        low = _lower(text if unicodedata.is_normalized("NFC", text) else unicodedata.normalize("NFC", text))
        return (self.words if _BEYOND.search(low) else self.quick).findall(low)

    def learn(self, words: Iterable[str]) -> None:
        """Encode the words that are not kept yet.

        When the store is full it becomes the older one: words that are met again come back from there, the others
        are forgotten with the next turn.
        """
        wanted = set(words)
        if len(self.kept) + len(wanted) > KEPT_WORDS:
            self.older, self.kept = self.kept, {}
        # In time of the words asked for, not of those kept.
        fresh = wanted.difference(self.kept)
        again = {w for w in fresh if w in self.older}
        self.kept.update((w, self.older[w]) for w in again)
        fresh -= again
        tokens = {w for w in fresh if w[0] == "\0" and w[1:] in self.added}
        self.kept.update((w, self._token(w[1:])) for w in tokens)
        plain = sorted(fresh - tokens)
        self.kept.update(zip(plain, self._merged(plain), strict=True))

    def _token(self, word: str) -> tuple[int, ...]:
        return (self.added[word],)

    def _merged(self, words: list[str]) -> list[tuple[int, ...]]:
        symbols: list[int] = []
        starts = []
        for word in words:
            data = word.encode("utf-8", "replace")
            starts.append(len(symbols))
            symbols += [self.inner[b] for b in data[:-1]]
            symbols += (self.last[data[-1]], -1)
        n = len(symbols)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        index: dict[int, list[int]] = {}
        ranks = self.ranks
        for at in range(n - 1):
            found = ranks.get((symbols[at], symbols[at + 1]))
            if found:
                index.setdefault(found[0], []).append(at)
        active = list(index)
        heapq.heapify(active)
        while active:
            rank = heapq.heappop(active)
            (left, right), new = self.pairs[rank]
            for at in sorted(index.pop(rank)):
                other = after[at]
                if symbols[at] != left or other >= n or symbols[other] != right:
                    continue  # an earlier merge took one of the two
                symbols[at], symbols[other] = new, -2
                following, previous = after[other], before[at]
                after[at] = following
                if following < n:
                    before[following] = at
                    found = ranks.get((new, symbols[following]))
                    if found:
                        if found[0] not in index:
                            index[found[0]] = []
                            heapq.heappush(active, found[0])
                        index[found[0]].append(at)
                if previous >= 0:
                    found = ranks.get((symbols[previous], new))
                    if found:
                        if found[0] not in index:
                            index[found[0]] = []
                            heapq.heappush(active, found[0])
                        index[found[0]].append(previous)
        ends = [*starts[1:], n][: len(starts)]
        return [tuple(s for s in symbols[a:b] if s >= 0) for a, b in zip(starts, ends, strict=True)]

    def encode(self, text: str) -> list[int]:
        words = self.split(text)
        self.learn(words)
        return [i for w in words for i in self.kept[w]]

    def decode(self, ids: Iterable[int]) -> str:
        """The token strings with a blank between them: the file names no decoder.  Unknown ids are left out."""
        return " ".join(self.strings[i] for i in ids if i in self.strings)


@functools.lru_cache(maxsize=2)
def encoder(path: str | None) -> Encoder:
    """One encoder for each worker process."""
    return Encoder(path or vocabulary_path())


def chunks(texts: list[str | None], limit: int = CHUNK_CHARS) -> Iterator[tuple[int, int]]:
    """Ranges of texts with at most ``limit`` characters together, or one longer text."""
    start, size = 0, 0
    for i, text in enumerate(texts):
        length = len(text or "")
        if i > start and size + length > limit:
            yield start, i
            start, size = i, 0
        size += length
    if start < len(texts):
        yield start, len(texts)


def split_batches(texts: list[str | None], coder: Encoder) -> Iterator[tuple[int, list[list[str]]]]:
    """(position of the first text, words of each text) chunk by chunk; all words are known to the encoder."""
    for a, b in chunks(texts):
        words = [coder.split(t or "") for t in texts[a:b]]
        coder.learn(w for ws in words for w in ws)
        yield a, words


def encode_documents(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id and the token ids of every whole text.  A null text is empty and has no ids; rows are kept as they come."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(path)
        for batch in batches:
            for a, words in split_batches(batch.column(1).to_pylist(), coder):
                kept = coder.kept
                ids = [[i for w in ws for i in kept[w]] for ws in words]
                yield pa.RecordBatch.from_arrays([batch.column(0)[a : a + len(ids)], pa.array(ids, pa.list_(pa.int32()))], names=["doc_id", "ids"])

    return docs.select("doc_id", "text").mapInArrow(run, _with_id(docs, "ids array<int>"))


def decode_documents(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id and the decoded text of rows with ``ids``; null ids decode to an empty text."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(path)
        for batch in batches:
            text = [coder.decode(ids or []) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(text, pa.string())], names=["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, _with_id(encoded, "text string"))


def round_trip(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, number of ids, SHA-256 of the ids as decimal text, and SHA-256 of the text they decode to.

    Ids and decoded text of a document exist only while its digests are made, so nothing long leaves the task.
    Null and empty texts have no ids and decode to the empty text.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(path)
        printed: dict[str, tuple[str, str]] = {}
        for batch in batches:
            for a, words in split_batches(batch.column(1).to_pylist(), coder):
                if len(printed) > KEPT_WORDS:
                    printed.clear()
                for w in {w for ws in words for w in ws if w not in printed}:
                    ids = coder.kept[w]
                    printed[w] = " ".join(map(str, ids)), coder.decode(ids)
                counts, ids_sha, text_sha = [], [], []
                for ws in words:
                    both = [printed[w] for w in ws]
                    ids = " ".join([x[0] for x in both])
                    counts.append(ids.count(" ") + 1 if ids else 0)
                    ids_sha.append(hashlib.sha256(ids.encode()).hexdigest())
                    text_sha.append(hashlib.sha256(" ".join([x[1] for x in both]).encode()).hexdigest())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[a : a + len(words)], pa.array(counts, pa.int64()), pa.array(ids_sha), pa.array(text_sha)],
                    names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    return docs.select("doc_id", "text").mapInArrow(run, _with_id(docs, "n_tokens long, ids_sha256 string, decoded_sha256 string"))


def _with_id(df: DataFrame, rest: str) -> str:
    return f"doc_id {df.schema['doc_id'].dataType.simpleString()}, {rest}"
