"""Operator 2: WARC archives and transaction assembly.

Writing: every capture (a ``pages`` row) becomes three records -- a request, a
response or revisit, and a metadata record -- where request and metadata name
the main record in ``WARC-Concurrent-To``.  Of the captures with equal payloads
of at least ``min_bytes`` bytes, that with the largest id is the response; the
others are revisits without payload that refer to it.  Archives are gzipped
WARC 1.1 files in a folder, written by Spark's text writer whose line separator is
the record terminator (two line ends), at most ``CAPTURES_PER_FILE`` captures each.

Reading: files are read as binary, records are cut by ``Content-Length`` (a
payload may hold anything) and *assembled*: request and metadata records are
joined to their main record through the concurrent-to identifier, whatever file
they are in, and one nested row per capture comes out.

Defined cases: a null payload is empty; a null id is written as an empty field
and read back as null (it is larger than no other id); a null url leaves its
field out; line ends inside a url are percent-encoded; rows equal in id and
payload share their record identifiers, come back once each and show the smallest
request; an empty table writes no record.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import uuid
from collections.abc import Iterable, Iterator
from typing import BinaryIO

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm.common import table, written
from tillroll.plans.session import shared_dir

# Production parameters.
MIN_REVISIT_BYTES = 0
CAPTURES_PER_FILE = 2048
# Names and formats of the archive format.
VERSION = "WARC/1.1"
NL = "\r\n"
END = NL + NL
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def base32_sha1(payload: Column) -> Column:
    """Bare upper-case base32 of the SHA-1 of a string's UTF-8 bytes: 20 bits
    (five hex digits) at a time give four base-32 digits."""
    hexed = F.sha1(payload.cast("binary"))
    digits = [F.lpad(F.conv(F.substring(hexed, 5 * k + 1, 5), 16, 32), 4, "0") for k in range(8)]
    return F.translate(F.concat(*digits), "0123456789ABCDEFGHIJKLMNOPQRSTUV", BASE32)


def _record_id(kind: str, capture: Column, digest: Column) -> Column:
    h = F.md5(F.concat_ws("|", F.lit(kind), F.coalesce(capture.cast("string"), F.lit("")), digest))
    cuts = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *[F.substring(h, a, n) for a, n in cuts]), F.lit(">"))


def _record(fields: list[tuple[str, Column]], block: Column) -> Column:
    """One record without its terminator; a null field is left out."""
    lines = [F.lit(VERSION)]
    lines += [F.concat(F.lit(f"{name}: "), value) for name, value in fields]
    lines.append(F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string")))
    return F.concat(F.concat_ws(NL, *lines), F.lit(END), block)


def archive_rows(pages: DataFrame, capture_id: str, url: str, payload: str, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """One string per capture: its three records."""
    body = F.coalesce(F.col(payload), F.lit(""))
    rows = pages.select(
        F.col(capture_id).alias("id"),
        F.regexp_replace(F.regexp_replace(F.col(url), "\r", "%0D"), "\n", "%0A").alias("url"),
        body.alias("body"),
        base32_sha1(body).alias("digest"),
        F.octet_length(body).cast("long").alias("n"),
    )
    # Only (digest, id) is shuffled for the choice of the response; the maximum
    # is combined before the shuffle, so a frequent payload is no hot group.
    largest = rows.filter(F.col("n") >= min_bytes).groupBy("digest").agg(F.max("id").alias("top"))
    chosen = rows.join(largest, "digest", "left")
    revisit = (F.col("n") >= min_bytes) & F.col("top").isNotNull() & ~F.col("id").eqNullSafe(F.col("top"))
    chosen = chosen.withColumn("revisit", F.coalesce(revisit, F.lit(False)))
    main = _record_id("main", F.col("id"), F.col("digest"))
    uri = ("WARC-Target-URI", F.col("url"))
    date = ("WARC-Date", F.lit(DATE))
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{NL}Content-Type: text/html; charset=utf-8{NL}Content-Length: "), F.col("n").cast("string"), F.lit(END)
    )
    request = _record(
        [
            ("WARC-Type", F.lit("request")),
            ("WARC-Record-ID", _record_id("request", F.col("id"), F.col("digest"))),
            ("WARC-Concurrent-To", main),
            uri,
            date,
            ("Content-Type", F.lit("application/http; msgtype=request")),
        ],
        F.concat(F.lit("GET "), F.coalesce(F.col("url"), F.lit("/")), F.lit(f" HTTP/1.1{NL}{NL}")),
    )
    kind = F.when(F.col("revisit"), "revisit").otherwise("response")
    capture = _record(
        [
            ("WARC-Type", kind),
            ("WARC-Record-ID", main),
            uri,
            date,
            ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
            ("WARC-Profile", F.when(F.col("revisit"), PROFILE)),
            ("WARC-Refers-To", F.when(F.col("revisit"), _record_id("main", F.col("top"), F.col("digest")))),
            ("Content-Type", F.lit("application/http; msgtype=response")),
        ],
        F.concat(http, F.when(F.col("revisit"), "").otherwise(F.col("body"))),
    )
    notes = _record(
        [
            ("WARC-Type", F.lit("metadata")),
            ("WARC-Record-ID", _record_id("metadata", F.col("id"), F.col("digest"))),
            ("WARC-Concurrent-To", main),
            uri,
            date,
            ("Content-Type", F.lit("application/warc-fields")),
        ],
        F.concat(
            F.concat(F.lit("capture: "), F.coalesce(F.col("id").cast("string"), F.lit(""))),
            F.concat(F.lit(f"{NL}payload-bytes: "), F.col("n").cast("string")),
            F.concat(F.lit(f"{NL}refers-to: "), F.when(F.col("revisit"), F.col("top").cast("string")).otherwise("")),
            F.lit(NL),
        ),
    )
    return chosen.select(F.concat_ws(END, request, capture, notes).alias("value"))


def write_archives(
    pages: DataFrame,
    path: str,
    capture_id: str = "page_id",
    url: str = "url",
    payload: str = "html",
    min_bytes: int = MIN_REVISIT_BYTES,
) -> None:
    rows = archive_rows(pages, capture_id, url, payload, min_bytes)
    rows.write.option("lineSep", END).option("maxRecordsPerFile", CAPTURES_PER_FILE).option("compression", "gzip").text(path)


_HEADERS = {
    "type": b"WARC-Type",
    "record_id": b"WARC-Record-ID",
    "concurrent_to": b"WARC-Concurrent-To",
    "uri": b"WARC-Target-URI",
    "digest": b"WARC-Payload-Digest",
    "refers_to": b"WARC-Refers-To",
}
_PARSED = pa.schema([*[(k, pa.string()) for k in _HEADERS], ("payload_digest", pa.string()), ("payload_bytes", pa.int64()), ("block", pa.binary())])


def parse_records(stream: BinaryIO) -> Iterator[tuple[dict[bytes, bytes], bytes]]:
    """(fields, block) of each record of an archive, cut by length."""
    nl, gap = NL.encode(), END.encode()
    while line := stream.readline():
        if line != VERSION.encode() + nl:
            raise ValueError(f"no WARC record: {line[:40]!r}")
        fields: dict[bytes, bytes] = {}
        while (line := stream.readline()) != nl:
            name, sep, value = line.partition(b": ")
            if not sep:
                raise ValueError(f"no header field: {line[:40]!r}")
            fields[name] = value.removesuffix(nl)
        length = int(fields[b"Content-Length"])
        block = stream.read(length)
        if len(block) != length or stream.read(len(gap)) != gap:
            raise ValueError(f"record {fields.get(b'WARC-Record-ID')!r} is cut")
        yield fields, block


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """One row per record: header fields, the block (HTTP head removed) and, for
    responses, digest and length of the payload itself."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                rows: dict[str, list] = {n: [] for n in _PARSED.names}
                held = 0
                for fields, block in parse_records(gzip.GzipFile(fileobj=io.BytesIO(content.as_buffer()))):
                    kind = fields[b"WARC-Type"]
                    if kind in (b"response", b"revisit"):
                        block = block.split(END.encode(), 1)[1]
                    for name, header in _HEADERS.items():
                        value = fields.get(header)
                        rows[name].append(None if value is None else value.decode())
                    own = base64.b32encode(hashlib.sha1(block).digest()).decode() if kind == b"response" else None
                    rows["payload_digest"].append(own)
                    rows["payload_bytes"].append(len(block) if kind == b"response" else None)
                    rows["block"].append(block)
                    held += len(block)
                    if held > 8 << 20:
                        yield pa.RecordBatch.from_pydict(rows, _PARSED)
                        rows, held = {n: [] for n in _PARSED.names}, 0
                if rows["type"]:
                    yield pa.RecordBatch.from_pydict(rows, _PARSED)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
    names = {pa.binary(): "binary", pa.int64(): "long"}
    kinds = ", ".join(f"{f.name} {names.get(f.type, 'string')}" for f in _PARSED)
    return files.mapInArrow(run, kinds)


def _note(block: Column, name: str) -> Column:
    value = F.regexp_extract(block, rf"(?m)^{name}: (.*?)\r?$", 1)
    return F.when(value != "", value)


def captures(records: DataFrame) -> DataFrame:
    """Transactions: the main record with the request and metadata records that
    are concurrent to it, as one nested row per capture."""
    own = F.struct(
        "record_id", "type", "uri", F.regexp_replace("digest", "^sha1:", "").alias("digest"), "payload_digest", "payload_bytes", "refers_to", "block"
    )
    is_main = F.col("type").isin("response", "revisit")
    main = records.filter(is_main).select(F.col("record_id").alias("target"), own.alias("main"))
    beside = records.filter(F.col("concurrent_to").isNotNull()).withColumnRenamed("concurrent_to", "target")
    side = F.struct("record_id", "uri", F.col("block").cast("string").alias("text"))
    # Records of repeated rows are equal; one of them stands for all.
    requests = beside.filter("type = 'request'").groupBy("target").agg(F.min(side).alias("request"))
    notes = beside.filter("type = 'metadata'").groupBy("target").agg(F.min(side).alias("metadata"))
    return (
        main.join(requests, "target", "left")
        .join(notes, "target", "left")
        .select(F.col("target").alias("capture"), "main", "request", "metadata")
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared_dir(spark)}/llm/warc-{uuid.uuid4().hex[:12]}"
    write_archives(table(spark, sf_dir, "pages"), path)
    text = F.col("metadata.text")
    # The archives are read once; the assembly needs the texts of requests and notes only.
    beside = F.when(F.col("type").isin("request", "metadata"), F.col("block"))
    back = captures(written(read_records(spark, path).withColumn("block", beside), "warc-records"))
    return back.select(
        _note(text, "capture").cast("long").alias("page_id"),
        F.coalesce("main.payload_bytes", _note(text, "payload-bytes").cast("long")).alias("payload_bytes"),
        F.coalesce("main.payload_digest", "main.digest").alias("payload_digest"),
        F.col("main.type").alias("record_type"),
        _note(text, "refers-to").cast("long").alias("refers_to"),
        F.col("request.uri").alias("request_uri"),
    )


# DuckDB has no SHA-1 base32, so the digest is built from its bits: the hex digits
# become 160 bits and every five of them a letter.
_BITS = "list_aggregate(list_transform(range(1, 41), lambda i: lpad(bin(('0x' || h[i])::INT), 4, '0')), 'string_agg', '')"
SQL = f"""
WITH p AS (SELECT page_id, replace(replace(url, chr(13), '%0D'), chr(10), '%0A') AS uri, coalesce(html, '') AS t, sha1(coalesce(html, '')) AS h FROM pages),
b AS (SELECT page_id, uri, strlen(t)::BIGINT AS n, h, {_BITS} AS bits FROM p),
d AS (SELECT page_id, uri, n, list_aggregate(list_transform(range(0, 32), lambda i:
    '{BASE32}'[1 + 16 * bits[5*i+1]::INT + 8 * bits[5*i+2]::INT + 4 * bits[5*i+3]::INT + 2 * bits[5*i+4]::INT + bits[5*i+5]::INT]),
    'string_agg', '') AS digest, max(page_id) OVER (PARTITION BY h) AS top FROM b)
SELECT page_id, n AS payload_bytes, digest AS payload_digest,
  CASE WHEN n >= {MIN_REVISIT_BYTES} AND top IS NOT NULL AND page_id IS DISTINCT FROM top THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN n >= {MIN_REVISIT_BYTES} AND page_id IS DISTINCT FROM top THEN top END AS refers_to, uri AS request_uri
FROM d
"""
