"""Content-addressed WARC archive.

Payload bytes are stored once per SHA-256 digest; the exact header block of every record is
stored on its own with the digest it refers to. A record is reconstructed by joining the two:
header block, payload for a response, and the closing blank lines.
"""

from __future__ import annotations

import base64
import hashlib
import zlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from kerbside.llm.common import Rows, slices
from kerbside.sources.scratch import scratch_path, written

# Fixed values of the archive format.
BASE32_DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
BASE32_ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CRLF = "\r\n"

#: Date of all records unless the caller names another.
CAPTURED = "2024-01-01T00:00:00Z"


def base32(hexadecimal: Column) -> Column:
    """Base32 of a 160-bit hexadecimal digest: five hex digits become four characters."""
    groups = [F.lpad(F.conv(F.substring(hexadecimal, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.upper(F.concat(*groups)), BASE32_DIGITS, BASE32_ALPHABET)


def _field(name: str, value: Column) -> Column:
    return F.concat(F.lit(f"{name}: "), value, F.lit(CRLF))


def _record_id(page: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page.cast("string"), F.lit("none")), F.lit(">"))


def headers(facts: DataFrame, captured: str) -> Column:
    """Header block of a record, up to where the payload begins."""
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
                    F.col("payload_bytes").cast("string"), F.lit(CRLF + CRLF))
    response = F.col("refers_to").isNull()
    target = F.regexp_replace(F.coalesce("url", F.lit("urn:none")), r"[\x00-\x20\x7f]", "%20")
    block = F.length(http) + F.when(response, F.col("payload_bytes")).otherwise(0)
    return F.concat(
        F.lit("WARC/1.1" + CRLF),
        _field("WARC-Type", F.when(response, "response").otherwise("revisit")),
        _field("WARC-Record-ID", _record_id(F.col("page_id"))),
        _field("WARC-Date", F.lit(captured)), _field("WARC-Target-URI", target),
        _field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "payload_digest")),
        F.when(response, F.lit("")).otherwise(F.concat(
            _field("WARC-Refers-To", _record_id(F.col("refers_to"))),
            _field("WARC-Profile", F.lit(REVISIT_PROFILE)))),
        _field("Content-Type", F.lit("application/http; msgtype=response")),
        _field("Content-Length", block.cast("string")), F.lit(CRLF), http)


def write_archive(pages: DataFrame, min_bytes: int = 0, captured: str = CAPTURED,
                  target: str | None = None) -> str:
    """Write ``(page_id, url, html)`` as an archive; return its folder.

    Of records with equal payloads of at least ``min_bytes`` bytes, the one with the largest
    page_id is a response and the others revisit it; smaller ones are all responses. A null html
    is an empty payload. Rows that share the largest page_id of a payload are all responses. A
    null page_id is written as "none" and becomes a response only where no id has the payload.
    White space and control characters in a url are written as %20.
    """
    spark = pages.sparkSession
    base = target or scratch_path(spark, "archive")
    payload = F.coalesce(F.col("html").cast("binary"), F.lit(b""))
    facts = written(pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        F.length(payload).cast("long").alias("payload_bytes"), base32(F.sha1(payload)).alias("payload_digest"),
        F.unhex(F.sha2(payload, 256)).alias("digest")), "facts")
    # One row per payload: who carries it. Copies are counted before the shuffle; the table is
    # written so that the join with it is planned on its own and can split a hot payload.
    owners = written(facts.groupBy("digest").agg(F.max("page_id").alias("owner")), "owners")
    named = facts.join(owners, "digest").withColumn(
        "refers_to", F.when((F.col("payload_bytes") >= min_bytes)
                            & ~F.col("page_id").eqNullSafe(F.col("owner")), F.col("owner")))
    named.select("page_id", "digest", headers(named, captured).cast("binary").alias("header")).write.parquet(
        f"{base}/headers")

    def shrink(batches: Rows) -> Rows:
        for batch in slices(batches, 256):
            bodies = [b or b"" for b in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), pa.array([hashlib.sha256(b).digest() for b in bodies], pa.binary()),
                 pa.array([zlib.compress(b, 3) for b in bodies], pa.binary())],
                names=["page_id", "digest", "body"])

    bodies = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("html").cast("binary").alias("html")
                          ).mapInArrow(shrink, "page_id long, digest binary, body binary")
    carriers = bodies.join(owners.select(F.col("digest"), F.col("owner")),
                           (bodies["digest"] == owners["digest"]) & F.col("page_id").eqNullSafe(F.col("owner")),
                           "left_semi")
    (carriers.groupBy("digest").agg(F.first("body").alias("body"))
     .write.option("compression", "uncompressed").parquet(f"{base}/payloads"))
    return base


def read_records(spark, archive: str) -> DataFrame:
    """``(header, digest, body)`` of every record, joined from the two stores; ``body`` is the
    payload its digest names, packed, for revisits too."""
    return (spark.read.parquet(f"{archive}/headers").drop("page_id")
            .join(spark.read.parquet(f"{archive}/payloads"), "digest", "left"))


def record_bytes(header: bytes, payload: bytes) -> bytes:
    """The record as it stands in a WARC file."""
    body = payload if b"WARC-Type: response\r\n" in header else b""
    return header + body + b"\r\n\r\n"


def parse_record(record: bytes) -> tuple[dict[str, str], bytes]:
    """Named fields and content block of one record."""
    head, _, rest = record.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    size = int(fields["Content-Length"])
    if lines[0] != "WARC/1.1" or rest[size:] != b"\r\n\r\n":
        raise ValueError(f"bad record {fields.get('WARC-Record-ID')}")
    return fields, rest[:size]


def _page(record_id: str | None) -> int | None:
    number = (record_id or "<urn:page:none>")[len("<urn:page:"):-1]
    return None if number == "none" else int(number)


def archived(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Write the archive, read it back and return what its records say of each page.

    Each record is put together, parsed, and its payload checked against the strong digest it
    is stored under; length and SHA-1 are those of the bytes read back. See ``write_archive``
    for null, empty and repeated rows.
    """
    archive = write_archive(pages, min_bytes)

    def read(batches: Rows) -> Rows:
        for batch in slices(batches, 256):
            rows, checked = [], {}
            for header, digest, body in zip(*(batch.column(c).to_pylist() for c in ("header", "digest", "body"))):
                if digest not in checked:
                    payload = zlib.decompress(body)
                    if hashlib.sha256(payload).digest() != digest:
                        raise ValueError(f"payload of {digest.hex()} is damaged")
                    checked[digest] = payload, base64.b32encode(hashlib.sha1(payload).digest()).decode()
                payload, sha1 = checked[digest]
                fields, block = parse_record(record_bytes(header, payload))
                kind = fields["WARC-Type"]
                if fields["WARC-Payload-Digest"] != f"sha1:{sha1}" or (
                        kind == "response" and block.partition(b"\r\n\r\n")[2] != payload):
                    raise ValueError(f"record {fields['WARC-Record-ID']} doesn't fit its payload")
                rows.append((_page(fields["WARC-Record-ID"]), len(payload), sha1, kind,
                             _page(fields.get("WARC-Refers-To"))))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*rows) if rows else [[]] * 5, (
                    pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()))],
                names=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])

    return read_records(pages.sparkSession, archive).select("header", "digest", "body").mapInArrow(
        read, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")


def read_payloads(spark, archive: str) -> DataFrame:
    """``(digest, payload)`` of the payload store, unpacked."""
    def grow(batches: Rows) -> Rows:
        for batch in slices(batches, 256):
            yield pa.RecordBatch.from_arrays(
                [batch.column("digest"), pa.array([zlib.decompress(b) for b in batch.column("body").to_pylist()],
                                                  pa.binary())], names=["digest", "payload"])

    return spark.read.parquet(f"{archive}/payloads").mapInArrow(grow, "digest binary, payload binary")
