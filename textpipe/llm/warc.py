"""WARC archives in which a payload is stored once and later captures refer to it.

Only headers (id, digest, length) are grouped by payload digest. The largest id of a digest is its
response, the other captures become revisit records without a payload. Where the table of repeated
digests is too large for every task to have, the tasks have a Bloom filter of it: what it does not
hold is written as it is, of what it holds the headers alone meet their responses, and only payloads
that several captures have are shuffled, once each.

Archives are written by Spark's text sink, a file for each task: a record is one value, and the two
line breaks that end a record are the line separator. They are read back with the same separator, as
a stream of parts, which are put together by content length: payloads may hold anything, and no more
than a record is in memory at once, however long a file is. Payloads are digested again, and
revisits get length and digest by a join with the responses they refer to.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from datetime import UTC, datetime

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textpipe.llm.bloom import Filter, filter_of
from textpipe.llm.common import BROADCAST_BYTES, materialize

LEAST_BYTES = 1000
RECORDS_PER_FILE = 50_000
END = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_ROWS_AT_ONCE, _BYTES_AT_ONCE = 1000, 16 << 20


def records_of(pages: DataFrame) -> DataFrame:
    """``page_id, url, payload`` (null: empty) with its ``digest`` and ``bytes``."""
    payload = F.coalesce("html", F.lit(""))
    return pages.select("page_id", "url", payload.alias("payload")).select(
        "*", F.sha1(F.col("payload").cast("binary")).alias("digest"), F.octet_length("payload").alias("bytes")
    )


def originals(records: DataFrame, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """``digest`` and ``original`` of the payloads that several captures have."""
    return (
        records.filter(F.col("bytes") >= least_bytes)
        .groupBy("digest")
        .agg(F.max("page_id").alias("original"), F.count("*").alias("n"))
        .filter("n > 1 and original is not null")
        .select("digest", "original")
    )


def resolved(records: DataFrame, least_bytes: int = LEAST_BYTES, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``records`` with ``refers_to``: the id of the response of a revisit, else null.

    Records that refer to another may come without their payload, which is not written.
    """
    known = materialize(originals(records, least_bytes), "originals")
    repeats = ~F.col("page_id").eqNullSafe(F.col("original"))
    refers = F.when(repeats, F.col("original")).alias("refers_to")
    large = F.col("bytes") >= least_bytes
    if known.count() * 64 <= broadcast_bytes:
        found = records.join(F.broadcast(known), "digest", "left")
        return found.select(*records.columns, F.when(large, refers).alias("refers_to"))
    # Rows are told apart by id and digest; rows that agree in both are written alike.
    row = F.xxhash64(F.col("page_id").isNull(), "page_id", "digest")
    digest = F.xxhash64("digest")
    held = large & _holds(filter_of(known.select(digest.alias("key"))))(digest)
    nothing = F.lit(None).cast(records.schema["page_id"].dataType)
    once = records.filter(~held).withColumn("refers_to", nothing)
    headers = records.filter(held).drop("payload").join(known, "digest", "left")
    headers = materialize(headers.select("page_id", "url", "digest", "bytes", refers), "headers")
    empty = F.lit(None).cast("string").alias("payload")
    revisits = headers.filter("refers_to is not null").select(
        *[empty if c == "payload" else c for c in records.columns], "refers_to"
    )
    responses = headers.filter("refers_to is null").select("page_id", "digest").distinct()
    kept = _holds(filter_of(responses.select(row.alias("key"))))(row)
    same = [records["digest"] == responses["digest"], records["page_id"].eqNullSafe(responses["page_id"])]
    whole = records.filter(held & kept).join(responses, same, "left_semi").withColumn("refers_to", nothing)
    return once.unionByName(revisits).unionByName(whole)


def _holds(found: Filter):
    """Whether a filter holds a hash."""

    @F.arrow_udf("boolean")
    def holds(keys: pa.Array) -> pa.Array:
        return pa.array(found(keys.to_numpy(zero_copy_only=False).view(np.uint64)))

    return holds


def record_id(page_id: Column, digest: Column) -> Column:
    """A UUID that follows from the capture, so that a revisit can name its response."""
    parts = r"^(.{8})(.{4})(.{4})(.{4})(.{12})$"
    name = F.md5(F.concat_ws("|", page_id.cast("string"), digest).cast("binary"))
    return F.concat(F.lit("<urn:uuid:"), F.regexp_replace(name, parts, "$1-$2-$3-$4-$5"), F.lit(">"))


def _record(date: str) -> Column:
    revisit = F.col("refers_to").isNotNull()
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nContent-Length: "),
        F.col("bytes").cast("string"),
        F.lit(END),
    )
    block = F.when(revisit, http).otherwise(F.concat(http, "payload"))
    # Line breaks would end a header; in a URI they have no place.
    uri = F.regexp_replace(F.coalesce("url", F.lit("urn:unknown")), r"[\r\n]", "")
    fields = [
        F.concat(F.lit("WARC-Type: "), F.when(revisit, "revisit").otherwise("response")),
        F.concat(F.lit("WARC-Record-ID: "), record_id(F.col("page_id"), F.col("digest"))),
        F.lit(f"WARC-Date: {date}"),
        F.concat(F.lit("WARC-Target-URI: "), uri),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), "digest"),
        F.when(revisit, F.concat(F.lit("WARC-Refers-To: "), record_id(F.col("refers_to"), F.col("digest")))),
        F.when(revisit, F.lit(f"WARC-Profile: {PROFILE}")),
        F.lit("Content-Type: application/http; msgtype=response"),
        F.concat(F.lit("X-Page-ID: "), F.url_encode(F.col("page_id").cast("string"))),
        F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string")),
    ]
    # Fields that are null are left out.
    return F.concat(F.lit("WARC/1.1\r\n"), F.concat_ws("\r\n", *fields), F.lit(END), block)


def write_archives(records: DataFrame, path: str, date: str | None = None) -> None:
    """Write resolved records as gzip files below ``path``."""
    date = date or datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ")
    (
        records.select(_record(date).alias("value"))
        .write.option("lineSep", END)
        .option("compression", "gzip")
        .option("maxRecordsPerFile", RECORDS_PER_FILE)
        .text(path)
    )


def _parsed(parts: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record of files that were cut at ``END``."""
    end, held = END.encode(), b""

    def more() -> bool:
        nonlocal held
        part = next(parts, None)
        if part is None:
            return False
        held += part + end
        return True

    while True:
        held = held.lstrip(b"\r\n")
        if not held:
            if not more():
                return
            continue
        if not held.startswith(b"WARC/"):
            raise ValueError(f"Not the start of a record: {held[:40]!r}")
        head, _, held = held.partition(end)
        headers = {}
        for line in head.split(b"\r\n")[1:]:
            name, _, value = line.decode().partition(":")
            headers[name.lower()] = value.strip()
        size = int(headers["content-length"])
        pieces, n = [held], len(held)
        while n < size:
            part = next(parts, None)
            if part is None:
                raise ValueError(f"File ends within record {headers.get('warc-record-id')}")
            pieces += [part, end]
            n += len(part) + len(end)
        held = b"".join(pieces)
        yield headers, held[:size]
        held = held[size:]


_FIELDS = pa.schema(
    [
        ("record_type", pa.string()),
        ("record_id", pa.string()),
        ("target", pa.string()),
        ("page_id", pa.string()),
        ("url", pa.string()),
        ("digest", pa.string()),
        ("bytes", pa.int64()),
        ("payload", pa.string()),
    ]
)


def _row(headers: dict[str, str], block: bytes, with_payload: bool) -> tuple:
    kind, digest = headers["warc-type"], headers["warc-payload-digest"].partition(":")[2]
    payload = block.partition(END.encode())[2]
    if kind == "response" and hashlib.sha1(payload).hexdigest() != digest:
        raise ValueError(f"Payload of {headers['warc-record-id']} does not have its digest")
    page = headers.get("x-page-id")
    return (
        kind,
        headers["warc-record-id"],
        headers.get("warc-refers-to"),
        page,
        headers["warc-target-uri"],
        digest,
        len(payload) if kind == "response" else None,
        payload.decode("utf-8", "replace") if with_payload and kind == "response" else None,
    )


def read_records(spark: SparkSession, path: str, with_payload: bool = False, id_type: str = "bigint") -> DataFrame:
    """Every record of the archives below ``path`` as it stands there."""

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*rows), _FIELDS.types)], schema=_FIELDS
        )

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        for headers, block in _parsed(value.as_py() for batch in parts for value in batch.column(0)):
            rows.append(_row(headers, block, with_payload))
            size += len(block) if with_payload else 0
            if len(rows) == _ROWS_AT_ONCE or size > _BYTES_AT_ONCE:
                yield batch_of(rows)
                rows, size = [], 0
        if rows:
            yield batch_of(rows)

    # A gzip file is read by one task, in its order.
    files = spark.read.option("pathGlobFilter", "*.gz").option("lineSep", END).text(path)
    schema = (
        "record_type string, record_id string, target string, page_id string, url string,"
        " digest string, bytes bigint, payload string"
    )
    found = files.select(F.col("value").cast("binary").alias("value")).mapInArrow(batches, schema)
    return found.withColumn("page_id", F.url_decode("page_id").cast(id_type))


def read_archives(spark: SparkSession, path: str, with_payload: bool = False, id_type: str = "bigint") -> DataFrame:
    """``page_id, url, record_type, digest, bytes, refers_to`` (and ``payload``) of each record.

    A revisit has length, digest and payload of the response that it names.
    """
    found = read_records(spark, path, with_payload, id_type)
    if not with_payload:
        found = materialize(found.drop("payload"), "headers")
    payload = ["payload"] * with_payload
    response = found.filter("record_type = 'response'")
    # Repeated rows write equal records: one of them is what a revisit names.
    named = response.select(
        F.col("record_id").alias("target"),
        F.col("page_id").alias("refers_to"),
        F.col("bytes").alias("held_bytes"),
        *[F.col(c).alias("held_payload") for c in payload],
    ).dropDuplicates(["target"])
    columns = ["page_id", "url", "record_type", "digest"]
    revisit = found.filter("record_type = 'revisit'").join(named, "target").select(
        *columns,
        F.col("held_bytes").alias("bytes"),
        "refers_to",
        *[F.col("held_payload").alias(c) for c in payload],
    )
    alone = response.select(*columns, "bytes", F.lit(None).cast(id_type).alias("refers_to"), *payload)
    return alone.unionByName(revisit)


def deduplicate(pages: DataFrame, path: str, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """Write ``pages`` as deduplicated archives below ``path`` and read these back.

    One record for each row; ids may be numbers or texts. Of rows with equal payloads of at least ``least_bytes`` bytes the one
    with the largest id is the response; rows that repeat its id are responses too, and a group
    without any id stays as it is. A null ``html`` is an empty payload, a null ``url`` becomes
    ``urn:unknown``. An empty table gives no rows; other columns are not read.
    """
    write_archives(resolved(records_of(pages), least_bytes), path)
    return read_archives(pages.sparkSession, path, id_type=pages.schema["page_id"].dataType.simpleString())
