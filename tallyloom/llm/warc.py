r"""WARC archives: written by Spark's text sink, read back by boundary-chain verification.

Writing: a record is a text value and ``\r\n\r\n`` the separator, so archives are plain Spark output and land
wherever Spark can write.  Equal payloads are stored once; the others become revisit records.

Reading: the text source cuts files at the record magic, so a split starts at any magic, also at one inside a
payload.  Every task emits its candidates with the offset of the record that would follow.  Within a split the
candidates are contracted to the first offset behind the split, and pointer jumping from the start of each file
(every round doubles the length of the jumps) finds the offsets at which splits are really entered.  Only candidates
on that chain are records; a magic within a payload is not reachable.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyloom.shared_folder import new_path, staged

MAGIC = "WARC/1.0\r\n"
GAP = "\r\n\r\n"
#: Bytes of one piece of a file when payloads with a magic inside are put together again.
SPAN_BLOCK = 1 << 20
RECORDS_PER_FILE = 5_000


def base32_sha1(data: Column) -> Column:
    """Bare upper-case base32 SHA-1 of a string or binary column: forty bits, eight digits, at a time."""
    digest = F.sha1(data)
    parts = [F.lpad(F.conv(F.substring(digest, 10 * i + 1, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.upper(F.concat(*parts)), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def write_archives(pages: DataFrame, path: str, min_bytes: int = 0, compression: str = "gzip") -> None:
    """A record per row of (page_id, url, html).

    Of equal payloads of at least ``min_bytes`` bytes the row with the smallest page_id (nulls last) is the response
    and the others revisit it.  A null html is an empty payload, a null url has no target line.  ``compression``
    ``none`` gives files that can be split; with ``gzip`` a file is one task when it is read.
    """
    html = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", html.alias("html"), base32_sha1(html).alias("digest"), F.octet_length(html).cast("long").alias("size"))
    same = rows.where(F.col("size") >= min_bytes).groupBy("digest", "size").agg(F.min(F.struct(F.col("page_id").isNull().alias("none"), "page_id")).alias("first"), F.count("*").alias("n"))
    heads = staged(same.where("n > 1").select("digest", "size", F.col("first.page_id").alias("head"), F.lit(True).alias("repeated")), "payloads")
    # Few columns are joined by payload; the payloads themselves are only dealt by page, so that no copy is hot.
    keys = rows.select("page_id", "digest", "size").distinct()
    fate = keys.join(heads, ["digest", "size"])
    k, d = F.coalesce(F.col("page_id"), F.lit(-1)), F.col("page_id").isNull()
    marked = rows.withColumns({"k": k, "none": d})
    fate = fate.select(k.alias("k"), d.alias("none"), "digest", "size", "head", "repeated")
    again = F.row_number().over(Window.partitionBy("k", "none", "digest", "size").orderBy("url")) > 1
    joined = marked.join(fate, ["k", "none", "digest", "size"], "left").withColumn("again", again)
    revisit = F.coalesce(F.col("repeated"), F.lit(False)) & (~F.col("page_id").eqNullSafe(F.col("head")) | F.col("again"))
    name = F.coalesce(F.col("page_id").cast("string"), F.lit(""))
    target = F.when(F.col("url").isNotNull(), F.concat(F.lit("WARC-Target-URI: "), F.regexp_replace("url", "[\r\n]", "%0A"), F.lit("\r\n"))).otherwise("")
    body = F.when(revisit, F.lit("")).otherwise(F.col("html"))
    record = F.concat(
        F.lit(f"{MAGIC}WARC-Type: "), F.when(revisit, F.lit("revisit")).otherwise("response"),
        F.lit("\r\nWARC-Record-ID: <urn:page:"), name, F.lit(">\r\nWARC-Date: 2020-01-01T00:00:00Z\r\n"), target,
        F.lit("WARC-Payload-Digest: sha1:"), F.col("digest"),
        F.when(revisit, F.concat(F.lit("\r\nWARC-Refers-To: <urn:page:"), F.coalesce(F.col("head").cast("string"), F.lit("")), F.lit(">"))).otherwise(""),
        F.lit("\r\nContent-Type: text/html\r\nContent-Length: "), F.octet_length(body).cast("string"), F.lit(GAP), body,
    )
    joined.select(record).write.option("lineSep", GAP).option("maxRecordsPerFile", RECORDS_PER_FILE).option("compression", compression).text(path)


_LINE = re.compile(rb"(?m)^([A-Za-z-]+): (.*?)\r?$")


def _pieces(spark: SparkSession, path: str, files: str) -> DataFrame:
    """What lies between two magics, with the split it was read in."""
    lines = spark.read.option("lineSep", MAGIC).option("pathGlobFilter", files).text(path)
    return lines.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.col("value").cast("binary").alias("raw"))


def _started(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[str, int, int, bytes]]:
    """(file, block, offset within the split, bytes) of the pieces in the order they were read."""
    at, where = 0, None
    for batch in batches:
        for file, block, raw in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if (file, block) != where:
                at, where = 0, (file, block)
            yield file, block, at, raw
            at += len(raw) + len(MAGIC)


CANDIDATE = "file string, block long, start long, size long, step long, kind string, page string, refers string, digest string, bytes long, whole boolean"


def _candidates(batches: Iterable[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
    names = [c.split()[0] for c in CANDIDATE.split(", ")]
    rows = []
    for file, block, at, raw in _started(batches):
        size = len(raw) + len(MAGIC)
        end = raw.find(b"\r\n\r\n")
        fields = dict(_LINE.findall(raw[: end + 2])) if end >= 0 else {}
        length = fields.get(b"Content-Length", b"")
        step = kind = page = refers = digest = count = None
        whole = False
        if length.isdigit():
            count = int(length)
            body = end + 4
            step = len(MAGIC) + body + count + 4
            kind = fields.get(b"WARC-Type", b"").decode("utf-8", "replace")
            page, refers = (fields.get(k, b"<urn:page:>").decode("utf-8", "replace")[10:-1] for k in (b"WARC-Record-ID", b"WARC-Refers-To"))
            whole = len(raw) == body + count + 4
            if kind == "revisit":
                digest = fields.get(b"WARC-Payload-Digest", b"").decode("utf-8", "replace")[5:]
            elif whole:
                digest = base64.b32encode(hashlib.sha1(raw[body : body + count]).digest()).decode()
        rows.append((file, block, at, size, step, kind, page, refers, digest, count, whole))
        if len(rows) == 4096:
            yield pd.DataFrame(rows, columns=names)
            rows = []
    if rows:
        yield pd.DataFrame(rows, columns=names)


def _as_arrow(make, schema: pa.Schema):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in make(batches):
            yield pa.RecordBatch.from_pandas(frame, schema=schema, preserve_index=False)

    return run


def _arrow_schema(ddl: str) -> pa.Schema:
    kinds = {"string": pa.string(), "long": pa.int64(), "boolean": pa.bool_(), "binary": pa.binary()}
    return pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in ddl.split(", ")])


def _placed(found: DataFrame) -> DataFrame:
    """``offset``: where the magic of a piece lies in its file.  Splits are laid end to end; one row each is summed."""
    sizes = found.groupBy("file", "block").agg(F.sum("size").alias("length"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select("file", "block", F.coalesce(F.sum("length").over(before), F.lit(0)).alias("base"), "length")
    joined = found.join(bases, ["file", "block"])
    offset = F.col("base") + F.col("start") - len(MAGIC)
    return joined.withColumns({"offset": offset, "next": offset + F.col("step"), "limit": F.col("base") + F.col("length") - len(MAGIC)})


def _contracted(rows: pd.DataFrame) -> pd.DataFrame:
    """For every candidate of a split, the first offset of its chain that lies behind the split; none if it breaks."""
    rows = rows.sort_values("offset", ascending=False)
    leaves: dict[int, int] = {}
    for at, following, limit in zip(rows["offset"], rows["next"], rows["limit"], strict=True):
        if following >= limit:
            leaves[at] = following
        elif following in leaves:
            leaves[at] = leaves[following]
    kept = rows[rows["offset"].isin(list(leaves))]
    return pd.DataFrame({"file": kept["file"], "offset": kept["offset"], "jump": [leaves[o] for o in kept["offset"]]})


def _chain(rows: pd.DataFrame, entries: pd.DataFrame) -> pd.DataFrame:
    """The candidates of a split on the chain that enters it."""
    follow = dict(zip(rows["offset"], rows["next"], strict=True))
    live = set()
    for at in entries["offset"]:
        while at in follow and at not in live:
            live.add(at)
            at = follow[at]
    return rows[rows["offset"].isin(list(live))][RECORD_COLUMNS]


RECORD = "file string, block long, offset long, next long, kind string, page string, refers string, digest string, bytes long, whole boolean"
RECORD_COLUMNS = [c.split()[0] for c in RECORD.split(", ")]


def reachable(candidates: DataFrame) -> DataFrame:
    """The candidates that the chain from the start of their file reaches.

    A chain that breaks (a truncated or damaged record) ends there; nothing behind it counts as a record.
    """
    known = candidates.where("step is not null")
    jumps = staged(known.groupBy("file", "block").applyInPandas(_contracted, "file string, offset long, jump long"), "jumps")
    entered = staged(known.where("offset = 0").select("file", "offset"), "entries")
    count = entered.count()
    while True:
        further = entered.join(jumps, ["file", "offset"]).select("file", F.col("jump").alias("offset"))
        entered = staged(entered.union(further).distinct(), "entries")
        if entered.count() == count:
            break
        count = entered.count()
        second = jumps.select("file", F.col("offset").alias("jump"), F.col("jump").alias("farther"))
        jumps = staged(jumps.join(second, ["file", "jump"], "left").select("file", "offset", F.coalesce("farther", "jump").alias("jump")), "jumps")
    starts = staged(known.select("file", "offset", "block").join(entered, ["file", "offset"]), "entries")
    return known.groupBy("file", "block").cogroup(starts.groupBy("file", "block")).applyInPandas(_chain, RECORD)


def _rejoined(spark: SparkSession, path: str, files: str, broken: DataFrame) -> DataFrame:
    """Digests of payloads with a magic inside: (file, offset, digest)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
        for file, block, at, raw in _started(batches):
            yield pd.DataFrame({"file": [file], "block": [block], "start": [at], "size": [len(raw) + len(MAGIC)], "step": [None], "raw": [raw]})

    ddl = "file string, block long, start long, size long, step long, raw binary"
    parts = _placed(_pieces(spark, path, files).mapInArrow(_as_arrow(run, _arrow_schema(ddl)), ddl))
    spans = broken.select("file", F.col("offset").alias("first"), F.col("next").alias("behind"), "bytes", F.explode(F.sequence(F.expr(f"offset div {SPAN_BLOCK}"), F.expr(f"next div {SPAN_BLOCK}"))).alias("b"))
    inside = parts.withColumn("b", F.expr(f"offset div {SPAN_BLOCK}")).join(spans, ["file", "b"]).where("offset >= first and offset < behind")

    def digest(rows: pd.DataFrame) -> pd.DataFrame:
        whole = MAGIC.encode().join(bytes(r) for r in rows.sort_values("offset")["raw"])
        body = whole.index(b"\r\n\r\n") + 4
        payload = whole[body : body + int(rows["bytes"].iloc[0])]
        return pd.DataFrame({"file": rows["file"].iloc[:1], "offset": rows["first"].iloc[:1], "found": [base64.b32encode(hashlib.sha1(payload).digest()).decode()]})

    return inside.groupBy("file", "first").applyInPandas(digest, "file string, offset long, found string")


#: Names of archives: those that Spark wrote, and those of others.
FILES = "*.{txt,warc}*"


def read_archives(spark: SparkSession, path: str, files: str = FILES) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of every record of the archives in a folder.

    The digest of a response is that of the bytes read; a revisit has those of the response that it names.  Archives of
    others may be read too: records of version 1.0, responses and revisits (other types are passed over), in files whose
    names fit ``files``, gzip or not.  A record whose id is no page number has no page_id.
    """
    pieces = _pieces(spark, path, files)
    found = staged(_placed(pieces.mapInArrow(_as_arrow(_candidates, _arrow_schema(CANDIDATE)), CANDIDATE)), "candidates")
    records = staged(reachable(found), "records")
    broken = records.where("kind = 'response' and not whole")
    if broken.limit(1).count():
        records = records.join(_rejoined(spark, path, files, broken), ["file", "offset"], "left").withColumn("digest", F.coalesce("found", "digest"))
    number = lambda c: F.when(F.col(c) != "", F.col(c).try_cast("long"))
    full = records.where("kind = 'response'")
    targets = full.select(F.col("page").alias("refers"), "digest", F.col("bytes").alias("size")).distinct()
    revisits = records.where("kind = 'revisit'").join(targets, ["refers", "digest"], "left")
    return full.select(
        number("page").alias("page_id"), F.col("bytes").alias("payload_bytes"), F.col("digest").alias("payload_digest"), F.col("kind").alias("record_type"), F.lit(None).cast("long").alias("refers_to"),
    ).unionByName(
        revisits.select(number("page").alias("page_id"), F.col("size").alias("payload_bytes"), F.col("digest").alias("payload_digest"), F.col("kind").alias("record_type"), number("refers").alias("refers_to"))
    )


def round_trip(pages: DataFrame, min_bytes: int = 0, compression: str = "gzip") -> DataFrame:
    """Write archives below the shared folder and read them back."""
    path = new_path(pages.sparkSession, "warc")
    write_archives(pages, path, min_bytes, compression)
    return read_archives(pages.sparkSession, path)
