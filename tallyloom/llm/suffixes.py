"""Removal of long repeated passages, exact to the byte, with run-length indexes over a partitioned corpus.

A byte goes if it is covered by a string of 50 bytes that also starts in a document with a smaller id.

How the corpus is partitioned.  Every window of 50 bytes picks an anchor, the smallest (by hash, then leftmost) of
its 24-byte grams; equal windows pick equal anchors wherever they are.  Neighbouring windows with one anchor form a
strand of at most 76 bytes.  Anchors are dealt to shards by hash, so all occurrences of a window meet in one shard.

1. Batches of documents send each shard their distinct anchors (32 bits each); the shard answers which occur in
   more than one document.
2. For those only, batches send their distinct strands, with the smallest and largest document that has them.  A
   strand that is the only one of its anchor is settled; all others go into run-length indexes (`runindex`), through
   which matching statistics are streamed, and every window gets the smallest document that has it.
3. Batches mark and cut.

Anchors and strands are folded within a batch before they are sent: a passage in a third of all documents sends a
strand per batch.  The documents are dealt to batches once; the three passes read that same exchange.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.runindex import DEPTH, SEPARATOR, RunIndex
from tallyloom.llm.workers import in_turn

GRAM = 24
#: Bytes of the documents of one batch, on average; a longer document is a batch of its own.
BATCH_BYTES = 4_000_000
#: Bytes that are worked on at a time; positions must fit 24 bits.
PIECE_BYTES = 250_000
#: Strand bytes of one run-length index.
INDEX_BYTES = 500_000
NO_ID = np.iinfo(np.int64).max


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def _grams(data: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the gram at every position (of what is left, at the end)."""
    x = np.r_[data, np.zeros(2 * GRAM, np.uint8)].astype(np.uint64)
    for step in (1, 2, 4):
        x = x[:-step] | (x[step:] << np.uint64(8 * step))
    n = len(data)
    return _mixed(x[:n] * np.uint64(0x9E3779B97F4A7C15) + _mixed(x[8 : n + 8] + np.uint64(0xD6E8FEB86659FD93) * x[16 : n + 16]))


def _smallest(keys: np.ndarray, width: int) -> np.ndarray:
    """Minimum of ``width`` keys from every position that has so many."""
    step, best = 1, keys
    while 2 * step <= width:
        best = np.minimum(best[:-step], best[step:])
        step *= 2
    rest = width - step
    return np.minimum(best[: len(best) - rest], best[rest:]) if rest else best


def strands(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, number of windows, anchor hash) of the strands of texts laid end to end; ``ends`` are theirs."""
    if len(data) < DEPTH:
        empty = np.zeros(0, np.int64)
        return empty, empty, np.zeros(0, np.uint64)
    hashes = _grams(data)
    low = np.uint64(0xFFFFFF)
    keys = (hashes & ~low) | np.arange(len(data), dtype=np.uint64)
    smallest = _smallest(keys[: len(data) - GRAM + 1], DEPTH - GRAM + 1)
    begins = np.r_[0, ends[:-1]]
    last = np.maximum(begins, ends - DEPTH + 1)  # behind the last window of each text
    edge = np.r_[True, smallest[1:] != smallest[:-1], True]
    edge[begins[begins < len(smallest)]] = True
    edge[last[last < len(smallest)]] = True
    heads = np.flatnonzero(edge)
    windows, heads = np.diff(heads), heads[:-1]
    whole = heads < last[np.searchsorted(ends, heads, "right")]
    heads = heads[whole]
    return heads, windows[whole], _mixed(hashes[(smallest[heads] & low).astype(np.int64)])


class Batch:
    """The texts of a batch and its strands; the same rows always give the same strands in the same order."""

    def __init__(self, rows: pd.DataFrame, shards: int) -> None:
        rows = rows.sort_values(["row_key"], kind="stable")
        self.rows = rows
        ids = rows["order_id"].to_numpy(dtype=np.int64)
        self.texts = [t.encode("utf-8", "surrogatepass") for t in rows["text"]]
        owner, start, windows, anchors = [], [], [], []
        group: list[tuple[int, int, bytes]] = []
        size = 0

        def flush() -> None:
            nonlocal group, size
            if not group:
                return
            ends = np.cumsum([len(b) for _, _, b in group])
            s, w, h = strands(np.frombuffer(b"".join(b for _, _, b in group), np.uint8), ends)
            which = np.searchsorted(ends, s, "right")
            begin = np.r_[0, ends[:-1]]
            row, base = np.array([g[0] for g in group]), np.array([g[1] for g in group])
            owner.append(row[which])
            start.append(s - begin[which] + base[which])
            windows.append(w)
            anchors.append(h)
            group, size = [], 0

        for i, text in enumerate(self.texts):
            for base in range(0, max(1, len(text) - DEPTH + 1), PIECE_BYTES):
                part = text[base : base + PIECE_BYTES + DEPTH - 1]
                if len(part) >= DEPTH:
                    group.append((i, base, part))
                    size += len(part)
                    if size >= PIECE_BYTES:
                        flush()
        flush()
        join = lambda parts, kind: np.concatenate(parts) if parts else np.zeros(0, kind)
        self.owner, self.start, self.windows = join(owner, np.int64), join(start, np.int64), join(windows, np.int64)
        anchors = join(anchors, np.uint64)
        self.ids = ids
        shard = (anchors % np.uint64(shards)).astype(np.int64)
        self.key = (shard << 32) | (anchors >> np.uint64(32)).astype(np.int64)

    def anchors(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct keys (shard and anchor), and whether more than one document of the batch has them."""
        order = np.argsort(self.key, kind="stable")
        key, ids = self.key[order], self.ids[self.owner[order]]
        heads = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
        if not len(heads):
            return key, np.zeros(0, bool)
        return key[heads], np.minimum.reduceat(ids, heads) < np.maximum.reduceat(ids, heads)

    def shared_strands(self, bits: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, list[bytes], np.ndarray]:
        """(occurrence, its strand, strands, key of each strand) for anchors that the shards call shared."""
        keys, _ = self.anchors()
        shared = np.zeros(len(keys), bool)
        shard_of = keys >> 32
        for shard, packed in zip(bits["shard"], bits["bits"], strict=True):
            a, b = np.searchsorted(shard_of, [shard, shard + 1])
            shared[a:b] = np.unpackbits(np.frombuffer(packed, np.uint8), count=b - a).astype(bool)
        occurrences = np.flatnonzero(np.isin(self.key, keys[shared])) if shared.any() else np.zeros(0, np.int64)
        found: dict[bytes, int] = {}
        strand = np.empty(len(occurrences), np.int64)
        for j, (o, s, w) in enumerate(zip(self.owner[occurrences].tolist(), self.start[occurrences].tolist(), self.windows[occurrences].tolist(), strict=True)):
            strand[j] = found.setdefault(self.texts[o][s : s + w + DEPTH - 1], len(found))
        key = np.empty(len(found), np.int64)
        key[strand] = self.key[occurrences]
        return occurrences, strand, list(found), key


ANCHORS = "shard long, batch long, ids binary, several binary"
BITS = "batch long, shard long, bits binary, strand binary, low binary, high binary, smallest binary"
STRANDS = "shard long, batch long, anchor binary, length binary, bytes binary, least binary, most binary, number binary"


def _send_anchors(shards: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        keys, several = Batch(rows, shards).anchors()
        shard_of = keys >> 32
        used = np.unique(shard_of)
        cuts = [(int(s), *np.searchsorted(shard_of, [s, s + 1])) for s in used]
        return pd.DataFrame(
            {
                "shard": pd.array([s for s, _, _ in cuts], "int64"),
                "batch": int(rows["batch"].iloc[0]),
                "ids": [keys[a:b].astype(np.uint32).tobytes() for _, a, b in cuts],
                "several": [np.packbits(several[a:b]).tobytes() for _, a, b in cuts],
            }
        )

    return run


def _answer_anchors(rows: pd.DataFrame) -> pd.DataFrame:
    ids = [np.frombuffer(b, np.uint32) for b in rows["ids"]]
    several = [np.unpackbits(np.frombuffer(b, np.uint8), count=len(i)).astype(bool) for b, i in zip(rows["several"], ids, strict=True)]
    values, counts = np.unique(np.concatenate(ids), return_counts=True)
    shared = np.union1d(values[counts > 1], np.concatenate([i[s] for i, s in zip(ids, several, strict=True)]))
    return pd.DataFrame(
        {
            "batch": rows["batch"], "shard": rows["shard"], "bits": [np.packbits(np.isin(i, shared, assume_unique=True)).tobytes() for i in ids],
            "strand": None, "low": None, "high": None, "smallest": None,
        }
    )


def _send_strands(shards: int):
    def run(rows: pd.DataFrame, bits: pd.DataFrame) -> pd.DataFrame:
        if not len(rows):
            return pd.DataFrame(columns=[c.split()[0] for c in STRANDS.split(", ")])
        built = Batch(rows, shards)
        occurrences, strand, strings, key = built.shared_strands(bits)
        ids = built.ids[built.owner[occurrences]]
        least, most = np.full(len(strings), NO_ID), np.full(len(strings), -NO_ID - 1)
        np.minimum.at(least, strand, ids)
        np.maximum.at(most, strand, ids)
        order = np.argsort(key, kind="stable")
        shard_of = key[order] >> 32
        out = []
        for s in np.unique(shard_of):
            a, b = np.searchsorted(shard_of, [s, s + 1])
            mine = order[a:b]
            parts = [strings[i] for i in mine]
            out.append(
                (
                    int(s), int(rows["batch"].iloc[0]), key[mine].astype(np.uint32).tobytes(), np.array([len(p) for p in parts], np.uint8).tobytes(),
                    b"".join(parts), least[mine].tobytes(), most[mine].tobytes(), mine.astype(np.uint32).tobytes(),
                )
            )
        return pd.DataFrame(out, columns=[c.split()[0] for c in STRANDS.split(", ")])

    return run


def _indexed(strings: list[bytes], owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Smallest owner of every window of the strings, and where each string's windows begin."""
    length = np.array([len(s) for s in strings], np.int64)
    text = np.frombuffer(b"".join(s + bytes([SEPARATOR]) for s in strings), np.uint8)
    start = np.r_[0, np.cumsum(length + 1)[:-1]]
    return RunIndex(text, np.repeat(owner, length + 1)).smallest_owners(text, start, length)


def _answer_strands(rows: pd.DataFrame) -> pd.DataFrame:
    found: dict[bytes, int] = {}
    places = []
    for lengths, blob in zip(rows["length"], rows["bytes"], strict=True):
        ends = np.cumsum(np.frombuffer(lengths, np.uint8).astype(np.int64)).tolist()
        begin = 0
        mine = np.empty(len(ends), np.int64)
        for j, end in enumerate(ends):
            mine[j] = found.setdefault(bytes(blob[begin:end]), len(found))
            begin = end
        places.append(mine)
    strings = list(found)
    del found
    place = np.concatenate(places)
    least = np.full(len(strings), NO_ID)
    np.minimum.at(least, place, np.concatenate([np.frombuffer(b, np.int64) for b in rows["least"]]))
    anchor = np.empty(len(strings), np.uint32)
    anchor[place] = np.concatenate([np.frombuffer(b, np.uint32) for b in rows["anchor"]])
    # Runs of windows with one smallest document, string after string.
    windows = np.array([len(s) - DEPTH + 1 for s in strings], np.int64)
    offset = np.r_[0, np.cumsum(windows)]
    values = np.repeat(least, windows)
    order = np.argsort(anchor, kind="stable")
    heads = np.flatnonzero(np.r_[True, anchor[order][1:] != anchor[order][:-1]])
    block: list[int] = []
    size = 0

    def settle() -> None:
        nonlocal block, size
        if block:
            got, at = _indexed([strings[i] for i in block], least[block])
            for j, i in enumerate(block):
                values[offset[i] : offset[i + 1]] = got[at[j] : at[j + 1]]
        block, size = [], 0

    for a, b in zip(heads.tolist(), np.r_[heads[1:], len(order)].tolist(), strict=True):
        if b - a > 1:
            block += order[a:b].tolist()
            size += sum(len(strings[i]) for i in order[a:b])
            if size >= INDEX_BYTES:
                settle()
    settle()
    string_of = np.repeat(np.arange(len(strings)), windows)
    cut = np.flatnonzero(np.r_[True, (values[1:] != values[:-1]) | (string_of[1:] != string_of[:-1])])
    run_string, run_low = string_of[cut], cut - offset[string_of[cut]]
    run_high = np.r_[cut[1:], len(values)] - 1 - offset[run_string]
    run_value = values[cut]
    first_run = np.searchsorted(run_string, np.arange(len(strings) + 1))
    out = []
    for batch, mine, numbers, most in zip(rows["batch"], places, rows["number"], rows["most"], strict=True):
        counts = first_run[mine + 1] - first_run[mine]
        which = np.repeat(np.arange(len(mine)), counts)
        runs = first_run[mine][which] + np.arange(len(which)) - np.repeat(np.cumsum(counts) - counts, counts)
        keep = run_value[runs] < np.frombuffer(most, np.int64)[which]
        which, runs = which[keep], runs[keep]
        if len(runs):
            number = np.frombuffer(numbers, np.uint32)[which]
            out.append((batch, -1, None, number.tobytes(), run_low[runs].astype(np.uint8).tobytes(), run_high[runs].astype(np.uint8).tobytes(), run_value[runs].tobytes()))
    return pd.DataFrame(out, columns=[c.split()[0] for c in BITS.split(", ")])


def _spans(built: Batch, replies: pd.DataFrame) -> dict[int, np.ndarray]:
    """Maximal runs of bytes to remove, for each document that has some: rows of (start, end)."""
    occurrences, strand, strings, _ = built.shared_strands(replies[replies["shard"] >= 0])
    found = replies[replies["shard"] < 0]
    if not len(found):
        return {}
    glue = lambda c, kind: np.concatenate([np.frombuffer(b, kind) for b in found[c]])
    number, low, high, least = glue("strand", np.uint32).astype(np.int64), glue("low", np.uint8).astype(np.int64), glue("high", np.uint8).astype(np.int64), glue("smallest", np.int64)
    order = np.argsort(number, kind="stable")
    number, low, high, least = number[order], low[order], high[order], least[order]
    first = np.searchsorted(number, np.arange(len(strings) + 1))
    counts = (first[1:] - first[:-1])[strand]
    which = np.repeat(np.arange(len(strand)), counts)
    runs = first[:-1][strand][which] + np.arange(len(which)) - np.repeat(np.cumsum(counts) - counts, counts)
    owner = built.owner[occurrences][which]
    keep = least[runs] < built.ids[owner]
    owner, runs, which = owner[keep], runs[keep], which[keep]
    begin = built.start[occurrences][which] + low[runs]
    end = built.start[occurrences][which] + high[runs] + DEPTH
    order = np.lexsort((begin, owner))
    out: dict[int, np.ndarray] = {}
    owner, begin, end = owner[order], begin[order], end[order]
    for i in np.unique(owner):
        a, b = np.searchsorted(owner, [i, i + 1])
        reach = np.maximum.accumulate(end[a:b])
        heads = np.flatnonzero(np.r_[True, begin[a + 1 : b] > reach[:-1]])
        out[int(i)] = np.stack([begin[a:b][heads], reach[np.r_[heads[1:], b - a] - 1]], axis=1)
    return out


def _cut(shards: int, columns: list[str], finish):
    def run(rows: pd.DataFrame, replies: pd.DataFrame) -> pd.DataFrame:
        if not len(rows):
            return pd.DataFrame(columns=columns)
        built = Batch(rows, shards)
        spans = _spans(built, replies)
        none = np.zeros((0, 2), np.int64)
        kept, cuts = [], []
        for i, text in enumerate(built.texts):
            own = spans.get(i, none)
            cuts.append(own)
            edges = [0, *own.ravel().tolist(), len(text)]
            kept.append(b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)) if len(own) else text)
        return finish(built.rows, built.texts, kept, cuts)

    return run


def _exchanged(docs: DataFrame, extra: list[str]) -> tuple[DataFrame, int]:
    """Documents dealt to batches; ``order_id`` compares them, a null id being larger than all others."""
    text = F.coalesce(F.col("text"), F.lit(""))
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    batches = max(1, math.ceil(size / BATCH_BYTES))
    dealt = docs.select(
        F.pmod(F.xxhash64("doc_id", "text"), F.lit(batches)).alias("batch"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("order_id"),
        F.xxhash64("doc_id", "text", F.lit(7)).alias("row_key"),
        text.alias("text"),
        *(F.col(c).alias(f"x_{c}") for c in extra),
    )
    return dealt.repartition(batches, "batch"), batches


def _run(docs: DataFrame, extra: list[str], schema: str, finish) -> DataFrame:
    dealt, shards = _exchanged(docs, extra)
    names = [c.split()[0] for c in schema.split(", ")]
    one = lambda f: lambda rows: in_turn("repeats", f, rows)
    two = lambda f: lambda rows, replies: in_turn("repeats", f, rows, replies)
    by_batch = dealt.groupBy("batch")
    bits = by_batch.applyInPandas(one(_send_anchors(shards)), ANCHORS).groupBy("shard").applyInPandas(one(_answer_anchors), BITS)
    strands_sent = by_batch.cogroup(bits.groupBy("batch")).applyInPandas(two(_send_strands(shards)), STRANDS)
    replies = bits.unionByName(strands_sent.groupBy("shard").applyInPandas(one(_answer_strands), BITS))
    return by_batch.cogroup(replies.groupBy("batch")).applyInPandas(two(_cut(shards, names, finish)), schema)


def repeated_spans(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans of every row.

    A null text is empty.  A null doc_id is larger than every other id.  Rows with one doc_id do not remove anything
    from one another.  Strings are judged on the texts as they came, and matches never cross documents.
    """
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<array<long>>"

    def finish(rows: pd.DataFrame, texts: list[bytes], kept: list[bytes], cuts: list[np.ndarray]) -> pd.DataFrame:
        return pd.DataFrame(
            {
                "doc_id": pd.array([None if i == NO_ID else int(i) for i in rows["order_id"]], "Int64"),
                "n_bytes": [len(t) for t in texts],
                "n_removed": [len(t) - len(k) for t, k in zip(texts, kept, strict=True)],
                "n_spans": [len(c) for c in cuts],
                "kept_sha256": [hashlib.sha256(k).hexdigest() for k in kept],
                "spans": [c.tolist() for c in cuts],
            }
        )

    return _run(docs, [], schema, finish)


def cut_repeats(docs: DataFrame) -> DataFrame:
    """The documents with repeated passages removed from ``text``; ``n_chars``, if there, is counted anew.

    A character that lost some of its bytes is lost whole.  A document of which nothing is left stays, with an
    empty text; null texts stay null.
    """
    others = [f for f in docs.schema.fields if f.name not in ("text", "n_chars")]
    counted = "n_chars" in docs.columns
    schema = ", ".join([*(f"x_{f.name} {f.dataType.simpleString()}" for f in others), "text string", "was_null boolean"])
    marked = docs.withColumn("_was_null", F.col("text").isNull())

    def finish(rows: pd.DataFrame, texts: list[bytes], kept: list[bytes], cuts: list[np.ndarray]) -> pd.DataFrame:
        out = rows[[f"x_{f.name}" for f in others]].copy()
        out["text"] = [k.decode("utf-8", "ignore") for k in kept]
        out["was_null"] = rows["x__was_null"].to_numpy()
        return out

    done = _run(marked, [*(f.name for f in others), "_was_null"], schema, finish)
    text = F.when(~F.col("was_null"), F.col("text"))
    columns = {f.name: F.col(f"x_{f.name}") for f in others} | {"text": text} | ({"n_chars": F.length(text).cast(docs.schema["n_chars"].dataType)} if counted else {})
    return done.select(*(columns[c].alias(c) for c in docs.columns))
