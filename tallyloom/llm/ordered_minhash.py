"""Near-duplicates by Order MinHash, verified by banded alignment.

A shingle is five words; its second, third ... occurrence in a text is a shingle of its own.  A sketch entry is made
of the few shingles with the smallest hashes, joined *in the order of the text*, so equal entries speak for a small
edit distance and not only for a common vocabulary.  Texts with an equal entry are candidates.

Candidates are compared in two passes, and never all with all.  First every text of a bucket is compared with the
bucket's most central text (the one that shares most buckets), which settles large groups of copies of one text with
a comparison a member.  Texts that still meet a text of another class in a bucket get longer sketch entries, with
which texts meet only if they are really alike.  There, texts are compared with one text of the largest class of
their bucket, which joins most of what belongs together; then *every* pair of a bucket whose texts are still in
different classes is compared, but for pairs that cannot be alike by their number of shingles and by the parities of
their shingles (both are bounds, so no pair that is alike is left out).  Two texts are linked if the Jaccard
similarity of their shingles is 0.8 or more and a banded alignment of their words keeps 0.8 of the longer one in
order.  Classes are the connected components of the links.

Texts that are equal word for word are folded before all this; those without a word, if they are equal.

Texts travel only for pairs that the bounds leave over: a filter of their numbers, of a fixed size, is sent to where the
texts are, and what it lets through is dealt by number.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.batches import sliced
from tallyloom.llm.components import components
from tallyloom.llm.workers import kept_by, task_of
from tallyloom.operators.membership import may_be_listed, membership_anti_join, membership_bits
from tallyloom.shared_folder import staged

WORDS = 5
SIMILARITY = 0.8
#: (shingles in an entry, entries): a pair at the threshold is missed 3 times in 100,000 at most.
SHORT = (3, 16)
#: Texts below so many shingles have twice as many short entries; a pair of 4 and 5 would be missed once in 3,500 times.
FEW = 24
#: From so many shingles on (shingles in an entry, entries); a pair at the threshold, of any length, is missed once in
#: 10,000 times at most.  A pair of texts meets in the tier of the shorter one.
LONG = [(0, 3, 32), (FEW, 6, 64), (96, 12, 160)]
#: Entries that are computed at a time; bounds memory for long texts.
LANES = 16
#: Longs of parities of shingles.
PARITIES = 8
KEPT_WORDS = 200_000

_WORD = re.compile(r"\w+")


class _Hashes(dict):
    def __missing__(self, word: str) -> int:
        if len(self) > KEPT_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


_hashes = _Hashes()
kept_by("near-duplicates", _hashes.clear)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def words_of(text: str | None) -> np.ndarray:
    found = _WORD.findall((text or "").lower())
    return np.array([_hashes[w] for w in found], np.uint64)


def shingles_of(words: np.ndarray) -> np.ndarray:
    """Hashes of the shingles in text order; a shorter text is one shingle, an empty text none."""
    if not len(words):
        return words
    n = max(1, len(words) - WORDS + 1)
    out = np.zeros(n, np.uint64)
    for i in range(min(WORDS, len(words))):
        out = _mixed(out + words[i : i + n] * np.uint64(2 * i + 3))
    return out


def labelled(shingles: np.ndarray) -> np.ndarray:
    """The shingles with their occurrence numbers mixed in."""
    order = np.argsort(shingles, kind="stable")
    same = shingles[order]
    head = np.r_[True, same[1:] != same[:-1]]
    at = np.arange(len(same))
    number = at - np.maximum.accumulate(np.where(head, at, 0))
    out = np.empty_like(shingles)
    out[order] = _mixed(same + number.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return out


def sketch(words: np.ndarray, length: int, entries: int, seed: int) -> np.ndarray:
    """Order MinHash entries of a text; an empty text has none."""
    shingles = labelled(shingles_of(words))
    n = len(shingles)
    if not n:
        return np.zeros(0, np.int64)
    out = np.empty(entries, np.uint64)
    for first in range(0, entries, LANES):
        lane = np.arange(first, min(entries, first + LANES), dtype=np.uint64)
        if n <= length:
            chosen = np.tile(shingles, (len(lane), 1))
        else:
            keys = _mixed(shingles[None, :] ^ _mixed(lane + np.uint64(seed * 1000 + 1))[:, None])
            places = np.sort(np.argpartition(keys, length - 1, axis=1)[:, :length], axis=1)
            chosen = shingles[places]
        key = _mixed(lane + np.uint64(seed))
        for i in range(chosen.shape[1]):
            key = _mixed(key * np.uint64(3) + chosen[:, i])
        out[first : first + len(lane)] = key
    return out.view(np.int64)


def short_entries(words: np.ndarray) -> np.ndarray:
    length, entries = SHORT
    return sketch(words, length, entries if len(words) - WORDS + 1 >= FEW else 2 * entries, 1)


def long_entries(words: np.ndarray) -> np.ndarray:
    """Entries of the tiers of all texts that are not longer and may be alike, these having 0.8 of the words at least."""
    n = max(1, len(words) - WORDS + 1)
    ends = [first for first, _, _ in LONG[1:]] + [np.inf]
    tiers = [tier for tier, end in zip(LONG, ends, strict=True) if tier[0] <= n and SIMILARITY * n - 1 < end]
    return np.concatenate([sketch(words, length, entries, 2 + length) for _, length, entries in tiers])


def outline(words: np.ndarray) -> tuple[int, list[int]]:
    """Number of the distinct shingles of a text, and the parities of how many of them fall on each bit.

    The bits in which two texts differ are never more than the shingles that only one of them has.
    """
    shingles = np.unique(shingles_of(words))
    bits = _mixed(shingles) & np.uint64(64 * PARITIES - 1)
    odd = np.bincount(bits.astype(np.int64), minlength=64 * PARITIES) & 1
    return len(shingles), np.packbits(odd.astype(np.uint8)).view(np.int64).tolist()


def aligned_words(a: np.ndarray, b: np.ndarray, band: int) -> int:
    """Length of the longest common subsequence of words whose matches lie within ``band`` of the diagonal.

    A row of the table is one long integer; a bit is unset where the length grows.
    """
    n = min(len(a), len(b))
    head = int(np.argmin(np.r_[a[:n] == b[:n], False]))
    a, b = a[head:], b[head:]
    n = min(len(a), len(b))
    tail = int(np.argmin(np.r_[a[::-1][:n] == b[::-1][:n], False])) if n else 0
    left, right = a[: len(a) - tail].tolist(), b[: len(b) - tail].tolist()
    where: dict[int, int] = {}
    for i, word in enumerate(left):
        where[word] = where.get(word, 0) | 1 << i
    row = (1 << len(left)) - 1
    for j, word in enumerate(right):
        places = where.get(word)
        if places is None:
            continue
        low, high = max(0, j - band), min(len(left), j + band + 1)
        if low >= high:
            break
        mask = (1 << (high - low)) - 1
        match = (places >> low) & mask
        if match:
            window = (row >> low) & mask
            both = window & match
            row ^= (window ^ (((window + both) | (window - both)) & mask)) << low
    return head + tail + len(left) - row.bit_count()


def alike(a: np.ndarray, b: np.ndarray, threshold: float = SIMILARITY) -> bool:
    """Whether two texts (as word hashes) are near-duplicates."""
    x, y = np.unique(shingles_of(a)), np.unique(shingles_of(b))
    if min(len(x), len(y)) < threshold * max(len(x), len(y)):
        return False
    common = len(np.intersect1d(x, y, assume_unique=True))
    if common < threshold * (len(x) + len(y) - common):
        return False
    longer = max(len(a), len(b))
    band = int(len(a) + len(b) - 2 * threshold * longer) + 1
    return aligned_words(a, b, band) >= threshold * longer


SKETCH = "row_id long, doc_id long, text string, digest binary, entries array<long>, shingles int, parities array<long>"


def _digest(text: str, words: np.ndarray) -> bytes:
    return xxhash.xxh128_digest(words.tobytes()) if len(words) else xxhash.xxh128_digest(b"\0" + text.encode())


@task_of("near-duplicates")
def _sketched(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in sliced(batches):
        digests, entries, shingles, parities = [], [], [], []
        for text in batch.column(2).to_pylist():
            words = words_of(text)
            n, bits = outline(words)
            digests.append(_digest(text, words))
            entries.append(short_entries(words))
            shingles.append(n)
            parities.append(bits)
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(digests, pa.binary()), pa.array(entries, pa.list_(pa.int64())), pa.array(shingles, pa.int32()), pa.array(parities, pa.list_(pa.int64()))],
            names=["row_id", "doc_id", "text", "digest", "entries", "shingles", "parities"],
        )


@task_of("near-duplicates")
def _longer(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in sliced(batches):
        entries = [long_entries(words_of(t)) for t in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(entries, pa.list_(pa.int64()))], names=["node", "entries"])


@task_of("near-duplicates")
def _verified(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    said, known = None, None
    for batch in batches:
        keep = []
        for left, right in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
            if right != said:
                said, known = right, words_of(right)
            keep.append(alike(words_of(left), known))
        yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))


def _flat(outlines: DataFrame, name: str, prefix: str) -> DataFrame:
    parities = [F.col("parities")[i].alias(f"{prefix}{i}") for i in range(PARITIES)]
    return outlines.select(F.col("node").alias(name), F.col("shingles").alias(f"{prefix}s"), *parities)


def _may_be_alike(x: str, y: str) -> F.Column:
    """What two texts that are alike never miss, in columns ``{x}s, {x}0, …`` and ``{y}s, {y}0, …``."""
    differ = " + ".join(f"bit_count({x}{i} ^ {y}{i})" for i in range(PARITIES))
    # Of two texts with m and n shingles and a similarity of 0.8, (m + n) / 9 shingles are not in both.
    within = f"9 * ({differ}) <= {x}s + {y}s"
    return F.expr(f"{within} AND 5 * least({x}s, {y}s) >= 4 * greatest({x}s, {y}s)")


def _texts_of(nodes: DataFrame, table: DataFrame) -> DataFrame:
    """(node, text) of texts that may be among ``nodes``; the others do not leave their place."""
    bits = staged(membership_bits(nodes, "node"), "node-bits")
    asked = may_be_listed(table.select(F.col("row_id").alias("node"), "text"), "node", bits, "_maybe")
    return asked.where("_maybe").drop("_maybe")


def _links(pairs: DataFrame, outlines: DataFrame, table: DataFrame) -> DataFrame:
    """The pairs (a, b) that the bounds leave over and the alignment confirms."""
    both = pairs.join(_flat(outlines, "a", "l"), "a").join(_flat(outlines, "b", "r"), "b")
    likely = staged(both.where(_may_be_alike("l", "r")).select("a", "b"), "likely")
    texts = _texts_of(likely.select(F.explode(F.array("a", "b")).alias("node")), table)
    left = likely.join(texts.select(F.col("node").alias("a"), F.col("text").alias("left")), "a")
    full = left.join(texts.select(F.col("node").alias("b"), F.col("text").alias("right")), "b").select("a", "b", "left", "right")
    return full.mapInArrow(_verified, "a long, b long")


def _with_roots(nodes: DataFrame, roots: DataFrame) -> DataFrame:
    return nodes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(row_id, doc_id, class_id, class_size, kept) of every row.

    ``class_id`` is the smallest doc_id of the class (a null comes last), and the first row with it is kept.  Null
    and empty texts are one class; a text without a word is alike to equal texts only.  ``row_id`` tells repeated rows
    apart.
    """
    rows = docs.select(F.monotonically_increasing_id().alias("row_id"), F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    table = staged(rows.mapInArrow(_sketched, SKETCH), "sketches")
    firsts = [F.first(c).alias(c) for c in ("entries", "shingles", "parities")]
    folded = staged(table.groupBy("digest").agg(F.min("row_id").alias("node"), *firsts), "folded")
    entries = folded.select("node", F.explode("entries").alias("entry"))
    sizes = entries.groupBy("entry").agg(F.count("*").alias("n")).where("n > 1")
    members = staged(entries.join(sizes, "entry"), "members")
    if not members.limit(1).count():
        return _classes(table, folded, None)
    weight = members.groupBy("node").agg(F.sum("n").alias("weight"))
    heavy = members.join(weight, "node").groupBy("entry").agg(F.max_by("node", F.struct("weight", -F.col("node"))).alias("b"))
    pairs = members.join(heavy, "entry").where("node <> b").select(F.col("node").alias("a"), "b").distinct()
    links = staged(_links(pairs, folded, table), "links")
    roots = components(links)
    placed = _with_roots(members.select("node", "entry"), roots)
    mixed = placed.groupBy("entry").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high")
    unsettled = staged(placed.join(mixed.select("entry"), "entry", "left_semi").select("node").distinct(), "unsettled")
    texts = _texts_of(unsettled, table).join(unsettled, "node", "left_semi").select("node", "text")
    longer = staged(texts.mapInArrow(_longer, "node long, entries array<long>"), "longer")
    entries = longer.select("node", F.explode("entries").alias("entry"))
    met = entries.groupBy("entry").agg(F.count("*").alias("n")).where("n > 1").select("entry")
    again = staged(entries.join(met, "entry", "left_semi"), "members")
    placed = staged(_in_mixed_buckets(_with_roots(again, roots)), "mixed")
    towards = placed.where("root <> top").select(F.least("node", "head").alias("a"), F.greatest("node", "head").alias("b")).distinct()
    links = staged(links.union(_links(towards, folded, table)), "links")
    rest = staged(_pairs_between_classes(_with_roots(again, components(links)), folded), "pairs")
    links = staged(links.union(_links(rest, folded, table)), "links")
    return _classes(table, folded, components(links))


def _in_mixed_buckets(placed: DataFrame) -> DataFrame:
    """The rows (entry, node, root) of buckets with several classes; ``top`` has most texts there, ``head`` is one of them."""
    one = F.min(F.struct(F.xxhash64("node", "entry"), "node")).alias("one")
    classes = placed.groupBy("entry", "root").agg(F.count("*").alias("n"), one)
    top = F.max_by(F.struct("root", "one.node"), F.struct("n", -F.col("root"))).alias("top")
    buckets = classes.groupBy("entry").agg(F.count("*").alias("classes"), top).where("classes > 1")
    return placed.join(buckets.select("entry", F.col("top.root").alias("top"), F.col("top.node").alias("head")), "entry")


def _pairs_between_classes(placed: DataFrame, outlines: DataFrame) -> DataFrame:
    """All pairs (a, b) that share a bucket but no class and may be alike by their outlines.

    Texts of a bucket's largest class are not paired with each other, so one large class costs nothing by itself.
    """
    rooted = _in_mixed_buckets(placed).drop("head")
    mixed = staged(rooted.join(outlines.select("node", "shingles", "parities"), "node"), "mixed")
    x, y = _sided(mixed, "x").where("x_root <> x_top"), _sided(mixed, "y")
    once = F.expr("x_root <> y_root AND (y_root = y_top OR x_node < y_node)")
    met = x.join(y, (F.col("x_entry") == F.col("y_entry")) & once & _may_be_alike("x", "y"))
    return met.select(F.least("x_node", "y_node").alias("a"), F.greatest("x_node", "y_node").alias("b")).distinct()


def _sided(mixed: DataFrame, p: str) -> DataFrame:
    parities = [F.col("parities")[i].alias(f"{p}{i}") for i in range(PARITIES)]
    return mixed.select(*(F.col(c).alias(f"{p}_{c}") for c in ("entry", "root", "top", "node")), F.col("shingles").alias(f"{p}s"), *parities)


def _classes(table: DataFrame, folded: DataFrame, roots: DataFrame | None) -> DataFrame:
    nodes = folded.select("digest", "node")
    nodes = _with_roots(nodes, roots) if roots is not None else nodes.withColumn("root", F.col("node"))
    rows = staged(table.select("row_id", "doc_id", "digest").join(nodes.select("digest", "root"), "digest").drop("digest"), "classes")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row_id")).alias("first")
    heads = rows.groupBy("root").agg(first, F.count("*").alias("class_size"))
    return rows.join(heads, "root").select(
        "row_id", "doc_id", F.col("first.doc_id").alias("class_id"), "class_size", (F.col("row_id") == F.col("first.row_id")).alias("kept")
    )


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """One document of every class, with the columns it came with: that with the smallest doc_id.

    The rows to drop are few; a filter of their numbers is sent to the documents, most of which then stay where they are.
    """
    source = staged(docs.withColumn("_row", F.monotonically_increasing_id()), "documents")
    tagged = source.select(F.col("_row").alias("doc_id"), "text")
    order = source.select(F.col("_row").alias("doc_id"), F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_row").alias("place"))
    found = near_duplicates(tagged).where("class_size > 1").select("doc_id", "class_id").join(order, "doc_id")
    first = found.groupBy("class_id").agg(F.min("place").alias("place"))
    dropped = found.join(first.select("class_id", F.col("place._row").alias("first")), "class_id").where("doc_id <> first")
    dropped = staged(dropped.select(F.col("doc_id").alias("_row")), "dropped")
    return membership_anti_join(source, dropped, "_row", staged(membership_bits(dropped, "_row"), "dropped-bits")).drop("_row")
