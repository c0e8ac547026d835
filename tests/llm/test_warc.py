"""Archives against the pages they were made of."""

import base64
import hashlib

import pytest

from tallyloom.llm import warc

FAKE = "WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:77>\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
ROWS = [
    (1, "http://a/\r\nX: y", "<p>one</p>"), (2, None, None), (3, "u", ""), (4, "u", "<p>one</p>"), (0, "u", "<p>one</p>"), (5, "u", "é日"),
    (6, "u", FAKE), (7, "u", f"before {FAKE} after WARC/1.0\r\n"), (8, "u", f"before {FAKE} after WARC/1.0\r\n"), (9, "u", "x" * 300_000),
    (9, "u", "x" * 300_000), (None, "u", "lone"), (10, "u", "WARC/1.0\r\n"), (11, "u", "\r\n\r\n"),
]


def expected(rows, least=0):
    groups = {}
    for i, (page, _, html) in enumerate(rows):
        groups.setdefault((html or "").encode(), []).append((page is None, page or 0, i, page))
    out = []
    for payload, members in groups.items():
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        for m in members:
            first = m == min(members) or len(payload) < least
            out.append((m[3], len(payload), digest, "response" if first else "revisit", None if first else min(members)[3]))
    return sorted(out, key=repr)


@pytest.mark.parametrize("compression", ["gzip", "none"])
def test_round_trip(spark, compression):
    pages = spark.createDataFrame([(*r, "x") for r in ROWS], "page_id long, url string, html string, digest string")
    got = warc.round_trip(pages, compression=compression)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == expected(ROWS)
    short = warc.round_trip(pages, min_bytes=10, compression=compression)
    assert sorted((tuple(r) for r in short.collect()), key=repr) == expected(ROWS, 10)
    assert warc.round_trip(pages.limit(0), compression=compression).count() == 0


def test_files_cut_into_many_splits(spark):
    rows = [(i, "u", f"page {i} " * (i % 50) + (FAKE if i % 3 == 0 else "")) for i in range(400)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        got = warc.round_trip(pages, compression="none").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert sorted((tuple(r) for r in got), key=repr) == expected(rows)


def test_base32(spark):
    assert spark.range(1).select(warc.base32_sha1(warc.F.lit("abc"))).first()[0] == base64.b32encode(hashlib.sha1(b"abc").digest()).decode()


def test_archives_of_others(spark, tmp_path):
    record = lambda kind, name, body, more="": (
        f"WARC/1.0\r\nWARC-Type: {kind}\r\nWARC-Record-ID: <urn:uuid:{name}>\r\n{more}Content-Length: {len(body)}\r\n\r\n{body}\r\n\r\n"
    )
    text = record("warcinfo", "0-0", "software: x") + record("response", "1-1", "payload one") + record("request", "2-2", "GET /") + record("response", "3-3", "two")
    (tmp_path / "x.warc").write_bytes(text.encode())
    (tmp_path / "notes.md").write_bytes(b"WARC/1.0\r\nno archive")
    got = sorted((r.payload_bytes, r.payload_digest, r.record_type, r.page_id) for r in warc.read_archives(spark, str(tmp_path)).collect())
    digest = lambda s: base64.b32encode(hashlib.sha1(s).digest()).decode()
    assert got == [(3, digest(b"two"), "response", None), (11, digest(b"payload one"), "response", None)]
    assert warc.read_archives(spark, str(tmp_path), "*.gz").count() == 0
