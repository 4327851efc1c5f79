"""WARC archives: round trip, records by the standard, resolution of a second pass, odd rows."""

from __future__ import annotations

import gzip
import hashlib
import re
from pathlib import Path

import pytest
from conftest_llm import SF
from pyspark.sql import functions as F

from textpipe.llm import warc
from textpipe.llm.queries import QUERIES

LONG = "<p>é</p>" * 200


def plain(rows: list[tuple[int | None, str | None]]) -> list[tuple]:
    held: dict[str, list] = {}
    for i, html in rows:
        held.setdefault(html or "", []).append(i)
    out = []
    for i, html in rows:
        data = (html or "").encode()
        ids = [x for x in held[html or ""] if x is not None]
        original = max(ids, default=None)
        revisit = len(data) >= 1000 and original is not None and i != original
        out.append((i, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response", original if revisit else None))
    return sorted(out, key=repr)


def rows_of(df) -> list[tuple]:
    return sorted(((r.page_id, r.bytes, r.digest, r.record_type, r.refers_to) for r in df.collect()), key=repr)


ROWS = [
    (1, LONG), (2, LONG), (9, LONG), (3, "short"), (4, "short"), (5, None), (6, ""), (7, "WARC/1.1\r\n\r\n\r\n" * 90),
    (8, "WARC/1.1\r\n\r\n\r\n" * 90), (None, LONG), (None, "x" * 1000), (None, "x" * 1000), (10, "y" * 999 + "é"),
    (11, "y" * 999 + "é"), (12, "z" * 999), (13, "z" * 999), (14, "\0\x01" * 600), (15, "q" * 300_000),
]


def test_round_trip(spark, tmp_path):
    pages = spark.createDataFrame([(i, f"http://h/{i}", h) for i, h in ROWS], "page_id bigint, url string, html string")
    got = warc.deduplicate(pages, str(tmp_path / "a"))
    assert rows_of(got) == plain(ROWS)
    full = warc.read_archives(spark, str(tmp_path / "a"), with_payload=True)
    assert sorted((r.page_id or 0, r.payload) for r in full.collect()) == sorted((i or 0, h or "") for i, h in ROWS)
    # An archive that is read and written again gives the same records.
    again = full.select("page_id", "url", F.col("payload").alias("html"))
    assert rows_of(warc.deduplicate(again, str(tmp_path / "b"))) == plain(ROWS)


def test_records(spark, tmp_path):
    pages = spark.createDataFrame([(i, f"http://h/{i}\r\nX: y", h) for i, h in ROWS[:3]], "page_id bigint, url string, html string")
    warc.write_archives(warc.resolved(warc.records_of(pages)), str(tmp_path / "a"), "2026-01-02T03:04:05Z")
    data = b"".join(gzip.decompress(p.read_bytes()) for p in Path(tmp_path / "a").glob("*.gz"))
    seen = {}
    while data:
        head, data = data.split(b"\r\n\r\n", 1)
        lines = head.decode().split("\r\n")
        assert lines[0] == "WARC/1.1"
        fields = dict(x.split(": ", 1) for x in lines[1:])
        size = int(fields["Content-Length"])
        block, data = data[:size], data[size:]
        assert data.startswith(b"\r\n\r\n")
        data = data[4:]
        seen[fields["X-Page-ID"]] = fields, block
    assert set(seen) == {"1", "2", "9"}
    response = seen["9"][0]
    assert response["WARC-Type"] == "response" and seen["9"][1].endswith(LONG.encode())
    assert response["WARC-Target-URI"] == "http://h/9X: y"
    assert re.fullmatch(r"<urn:uuid:[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}>", response["WARC-Record-ID"])
    for k in ("1", "2"):
        fields, block = seen[k]
        assert fields["WARC-Type"] == "revisit" and fields["WARC-Refers-To"] == response["WARC-Record-ID"]
        assert block.startswith(b"HTTP/1.1 200 OK\r\n") and block.endswith(b"\r\n\r\n")
        assert fields["WARC-Date"] == "2026-01-02T03:04:05Z" and "identical-payload-digest" in fields["WARC-Profile"]


def test_hot_payload(spark, tmp_path):
    pages = spark.range(3000).select(
        F.col("id").alias("page_id"),
        F.lit("http://h/").alias("url"),
        F.when(F.col("id") % 3 == 0, F.lit(LONG)).otherwise(F.repeat(F.col("id").cast("string"), 400)).alias("html"),
    )
    rows = [(r.page_id, r.html) for r in pages.collect()]
    assert rows_of(warc.deduplicate(pages, str(tmp_path / "a"))) == plain(rows)


def test_filter_of_repeated_digests(spark, tmp_path):
    """More repeated digests than may be broadcast: the same records, and only payloads that repeat
    are shuffled."""
    rows = [*ROWS, *[(100 + k, f"own page {k} " * 100) for k in range(200)], *[(400 + k, LONG + str(k // 3)) for k in range(90)]]
    pages = spark.createDataFrame([(i, f"http://h/{i}", h) for i, h in rows], "page_id bigint, url string, html string")
    records = warc.records_of(pages)
    found = warc.resolved(records, broadcast_bytes=0)
    warc.write_archives(found, str(tmp_path / "a"))
    assert rows_of(warc.read_archives(spark, str(tmp_path / "a"))) == plain(rows)
    full = warc.read_archives(spark, str(tmp_path / "a"), with_payload=True)
    assert sorted((r.page_id or 0, r.payload) for r in full.collect()) == sorted((i or 0, h or "") for i, h in rows)
    first = found._jdf.queryExecution().optimizedPlan().toString()
    assert first.count("Join LeftSemi") == 1 and "Join Inner" not in first


def test_text_ids(spark, tmp_path):
    rows = [("a b", LONG), ("é:\r\nx", LONG), ("b", "short"), (None, None)]
    pages = spark.createDataFrame([(i, "u", h) for i, h in rows], "page_id string, url string, html string")
    assert rows_of(warc.deduplicate(pages, str(tmp_path / "a"))) == plain(rows)


def test_stream_of_parts():
    """Blocks with record ends inside and at their ends, and no line break too many or few."""
    blocks = [b"", b"a", b"x\r\n", b"\r\n\r\n", b"\r\n\r\n\r\n\r", b"WARC/1.1\r\n\r\n", b"\r\n\r\nb" * 50]
    whole = b"".join(b"WARC/1.1\r\nContent-Length: %d\r\n\r\n" % len(b) + b + b"\r\n\r\n" for b in blocks)
    parts = whole.split(b"\r\n\r\n")
    assert [b for _, b in warc._parsed(iter(parts[:-1] if not parts[-1] else parts))] == blocks
    with pytest.raises(ValueError, match="ends within"):
        list(warc._parsed(iter([b"WARC/1.1\r\nContent-Length: 50", b"short"])))
    with pytest.raises(ValueError, match="Not the start"):
        list(warc._parsed(iter([b"HTTP/1.1"])))


def test_odd_rows(spark, tmp_path):
    pages = spark.createDataFrame(
        [(1, None, LONG, "a", 1), (1, None, LONG, "a", 1), (2, "u", None, None, 2)],
        "page_id bigint, url string, html string, digest string, bytes int",
    )
    got = warc.deduplicate(pages, str(tmp_path / "a"))
    assert rows_of(got) == plain([(1, LONG), (1, LONG), (2, None)])
    assert warc.deduplicate(pages.limit(0), str(tmp_path / "b")).count() == 0


def test_query(spark):
    pages = [(r.page_id, r.html) for r in spark.read.parquet(f"{SF}/pages.parquet").collect()]
    got = QUERIES["op7_warc"](spark, SF)
    rows = sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got.collect()), key=repr)
    assert rows == plain(pages)
