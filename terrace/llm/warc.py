"""WARC archives: writing with segments and chunked framing, reading, reassembly.

Writing is one Spark job over built-in expressions. A page whose payload occurs under a
smaller page id becomes a revisit record without body, any other a response whose body is
sent in chunked transfer framing. Blocks longer than ``segment_bytes`` are cut into a first
record and continuation records. No archive exceeds ``archive_records`` records, so a reader
task holds a bounded amount. Archives are gzip files as a whole, or plain.

Reading cuts archives into records by their declared lengths. Records of one origin are
grouped by origin identifier, ordered by segment number, checked against the declared total
length and joined; then HTTP header and chunked framing are taken off. Only segmented
records are shuffled, and a group is the segments of one record.

Defined results: null payloads count as empty; a null page id loses every tie and gives a
record without page id; rows that repeat both page id and payload share a type, so that all
rows of the smallest page id are responses; null urls are left out, and control characters
and spaces in urls become %20; an empty table gives an empty archive and result; other
columns are not looked at. A record that breaks the format fails the job; segments that are
missing, contradict each other or miss the total length give ``complete`` false and no payload.
"""

from __future__ import annotations

import base64
import gzip
import io
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.llm.scratch import BATCH_BYTES, Scratch

CRLF = "\r\n"
RECORD_END = "\r\n\r\n"
HTTP_HEAD = CRLF.join(
    ["HTTP/1.1 200 OK", "Content-Type: text/html; charset=utf-8", "Transfer-Encoding: chunked", "", ""]
)
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
# Fixed value: the base-32 alphabet, in the order of the digits that conv() writes.
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
CONV32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV"

RECORD_SCHEMA = (
    "record_id string, type string, page_id long, refers_to long, url string, digest string, "
    "origin string, segment int, total long, block binary"
)


def sha1_base32(data: Column) -> Column:
    """The bare upper-case base-32 SHA-1; 40 bits make 8 digits."""
    digest = F.sha1(data)
    parts = [F.lpad(F.conv(F.substring(digest, at, 10), 16, 32), 8, "0") for at in (1, 11, 21, 31)]
    return F.translate(F.concat(*parts), CONV32, BASE32)


def _as_text(data: Column) -> Column:
    """Bytes as they are; the text writer puts them out unchanged."""
    return data.cast("string")


def _pieces(data: Column, size: int) -> Column:
    """Start offsets of pieces of ``size`` bytes; one piece of nothing for no bytes."""
    last = F.greatest(F.octet_length(data) - 1, F.lit(0))
    return F.sequence(F.lit(0), F.floor(last / size).cast("int") * size, F.lit(size))


def chunked(body: Column, chunk_bytes: int) -> Column:
    """The body in chunked transfer framing."""

    def chunk(at: Column) -> Column:
        piece = F.substring(body, at + 1, F.lit(chunk_bytes))
        return F.concat(F.hex(F.octet_length(piece)), F.lit(CRLF), _as_text(piece), F.lit(CRLF))

    framed = F.array_join(F.transform(_pieces(body, chunk_bytes), chunk), "")
    end = F.lit("0" + RECORD_END)
    return F.when(F.octet_length(body) == 0, end).otherwise(F.concat(framed, end)).cast("binary")


def _header(name: str, value: Column) -> Column:
    """One header line, nothing for a null value."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit(CRLF)), F.lit(""))


def write_archives(
    pages: DataFrame,
    folder: str,
    scratch: Scratch,
    segment_bytes: int = 32 * 1024,
    chunk_bytes: int = 8 * 1024,
    archive_records: int = 512,
    compression: str = "gzip",
    captured: str = "1970-01-01T00:00:00Z",
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
) -> None:
    body = F.coalesce(F.encode(pages[payload_col], "UTF-8"), F.lit(b""))
    rows = pages.select(
        pages[id_col].cast("long").alias("page_id"),
        F.regexp_replace(pages[url_col], r"[\x00-\x20\x7F]", "%20").alias("url"),
        body.alias("body"),
        sha1_base32(body).alias("digest"),
    )
    known = F.struct(F.col("page_id").isNull().alias("none"), "page_id", "url")
    first = rows.groupBy("digest").agg(F.min(known).alias("first"), F.count(F.lit(1)).alias("n"))
    # Written, so that its size is known: payloads are shuffled only where it is large.
    repeated = scratch.keep(first.where("n > 1").drop("n"), "repeated")
    met = rows.join(repeated, "digest", "left")
    again = F.col("first").isNotNull() & ~F.col("first.page_id").eqNullSafe(F.col("page_id"))
    head = F.lit(HTTP_HEAD).cast("binary")
    records = met.select(
        "page_id", "url", "digest", "first", again.alias("again"),
        F.expr("concat('<urn:uuid:', uuid(), '>')").alias("record_id"),
        F.when(again, head).otherwise(F.concat(head, chunked(F.col("body"), chunk_bytes))).alias("block"),
    )
    parts = records.select(
        "*",
        F.octet_length("block").alias("total"),
        F.explode(_pieces(F.col("block"), segment_bytes)).alias("at"),
    )
    opens, closes = F.col("at") == 0, F.col("at") + segment_bytes >= F.col("total")
    many, number = ~(opens & closes), F.floor(F.col("at") / segment_bytes) + 1
    piece = F.substring(F.col("block"), F.col("at") + 1, F.lit(segment_bytes))
    kind = F.when(~opens, "continuation").when(F.col("again"), "revisit").otherwise("response")
    lines = [
        F.lit(VERSION + CRLF),
        _header("WARC-Type", kind),
        _header("WARC-Record-ID", F.when(opens, F.col("record_id")).otherwise(F.expr("concat('<urn:uuid:', uuid(), '>')"))),
        _header("WARC-Date", F.lit(captured)),
        _header("WARC-Target-URI", F.col("url")),
        _header("Content-Type", F.when(opens, "application/http;msgtype=response")),
        _header("WARC-Payload-Digest", F.when(opens, F.concat(F.lit("sha1:"), F.col("digest")))),
        _header("WARC-Profile", F.when(F.col("again"), REVISIT_PROFILE)),
        _header("WARC-Refers-To-Target-URI", F.when(F.col("again"), F.col("first.url"))),
        _header("Page-ID", F.col("page_id")),
        _header("Refers-To-Page-ID", F.when(F.col("again"), F.col("first.page_id"))),
        _header("WARC-Segment-Number", F.when(many, number)),
        _header("WARC-Segment-Origin-ID", F.when(~opens, F.col("record_id"))),
        _header("WARC-Segment-Total-Length", F.when(many & closes, F.col("total"))),
        _header("Content-Length", F.octet_length(piece)),
        F.lit(CRLF),
    ]
    text = parts.select(F.concat(*lines, _as_text(piece)).alias("value"))
    writer = text.write.option("lineSep", RECORD_END).option("maxRecordsPerFile", archive_records)
    writer.mode("errorifexists").option("compression", compression).text(folder)


def parse(data: bytes, path: str) -> Iterator[dict]:
    """The records of one archive, by their declared lengths. A zipped one, of one member or of
    many, is unzipped as records are taken, so one record is held at a time."""
    raw = io.BytesIO(data)
    stream = io.BufferedReader(gzip.GzipFile(fileobj=raw)) if data[:2] == b"\x1f\x8b" else raw
    at = 0
    while first := stream.readline():
        lines = [first]
        while (line := stream.readline()) and line != b"\r\n":
            lines.append(line)
        if not first.startswith(b"WARC/1.") or not line:
            raise ValueError(f"{path}: no record at byte {at}")
        named = (x.decode("utf-8", "replace").partition(":") for x in lines[1:])
        headers = {name.strip().lower(): value.strip() for name, _, value in named}
        length = int(headers["content-length"])
        block = stream.read(length)
        if len(block) < length or stream.read(4) != b"\r\n\r\n":
            raise ValueError(f"{path}: the record at byte {at} doesn't end where it says")
        at += sum(map(len, lines)) + 2 + length + 4
        yield {
            "record_id": headers.get("warc-record-id"),
            "type": headers.get("warc-type"),
            "page_id": _number(headers.get("page-id")),
            "refers_to": _number(headers.get("refers-to-page-id")),
            "url": headers.get("warc-target-uri"),
            "digest": headers.get("warc-payload-digest", "").removeprefix("sha1:") or None,
            "origin": headers.get("warc-segment-origin-id"),
            "segment": _number(headers.get("warc-segment-number")),
            "total": _number(headers.get("warc-segment-total-length")),
            "block": block,
        }


def _number(value: str | None) -> int | None:
    return None if value is None else int(value)


def read_records(spark: SparkSession, folder: str) -> DataFrame:
    """Every record of the archives below ``folder``, as RECORD_SCHEMA says."""
    fields = pa.schema(
        [("record_id", pa.string()), ("type", pa.string()), ("page_id", pa.int64()),
         ("refers_to", pa.int64()), ("url", pa.string()), ("digest", pa.string()),
         ("origin", pa.string()), ("segment", pa.int32()), ("total", pa.int64()), ("block", pa.binary())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                path, data = (batch.column(n)[at].as_py() for n in ("path", "content"))
                held, size = [], 0
                for record in parse(data, path):
                    held.append(record)
                    size += len(record["block"])
                    if size > BATCH_BYTES:
                        yield pa.RecordBatch.from_pylist(held, fields)
                        held, size = [], 0
                yield pa.RecordBatch.from_pylist(held, fields)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder)
    return files.select("path", "content").mapInArrow(run, RECORD_SCHEMA)


def reassemble(records: DataFrame) -> DataFrame:
    """One row per origin: its first record's fields, the whole block, and ``complete``."""
    keys = ["record_id", "type", "page_id", "refers_to", "url", "digest"]
    whole = records.where("segment IS NULL").select(*keys, "block", F.lit(True).alias("complete"))
    parts = records.where("segment IS NOT NULL")
    opening = F.col("segment") == 1
    piece = F.struct("segment", "block")
    grouped = parts.groupBy(F.coalesce("origin", "record_id").alias("record_id")).agg(
        *[F.max(F.when(opening, F.col(k))).alias(k) for k in keys[1:]],
        F.max("total").alias("total"),
        F.array_sort(F.collect_set(piece)).alias("pieces"),
    )
    joined = F.array_join(F.transform("pieces", lambda p: _as_text(p["block"])), "").cast("binary")
    in_order = F.transform("pieces", lambda p: p["segment"]) == F.sequence(
        F.lit(1), F.greatest(F.size("pieces"), F.lit(1))
    )
    fits = in_order & (F.octet_length(joined) == F.coalesce("total", F.lit(-1)))
    segmented = grouped.select(*keys, F.when(fits, joined).alias("block"), fits.alias("complete"))
    return whole.unionByName(segmented)


def unframe(block: bytes) -> bytes:
    """The body of an HTTP message, without chunked framing."""
    head, _, body = block.partition(b"\r\n\r\n")
    if b"transfer-encoding: chunked" not in head.lower():
        return body
    out, at = [], 0
    while True:
        end = body.index(b"\r\n", at)
        size = int(body[at:end].split(b";")[0], 16)
        if size == 0:
            return b"".join(out)
        piece = body[end + 2 : end + 2 + size]
        if len(piece) != size or body[end + 2 + size : end + 4 + size] != b"\r\n":
            raise ValueError("a chunk doesn't have its length")
        out.append(piece)
        at = end + 4 + size


def decode(whole: DataFrame) -> DataFrame:
    """Adds payload, its length and its digest to responses; revisits and incomplete records
    have none."""
    names = ["record_id", "type", "page_id", "refers_to", "url", "digest", "complete"]
    schema = (
        "record_id string, type string, page_id long, refers_to long, url string, digest string, "
        "complete boolean, payload binary, payload_bytes long, payload_digest string"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kinds, blocks = batch.column("type").to_pylist(), batch.column("block").to_pylist()
            bodies = [
                unframe(b) if k == "response" and b is not None else None
                for k, b in zip(kinds, blocks, strict=True)
            ]
            digests = [
                b if b is None else base64.b32encode(hashlib.sha1(b).digest()).decode() for b in bodies
            ]
            sizes = [None if b is None else len(b) for b in bodies]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in names), pa.array(bodies, pa.binary()),
                 pa.array(sizes, pa.int64()), pa.array(digests, pa.string())],
                names=[*names, "payload", "payload_bytes", "payload_digest"],
            )

    return whole.select(*names, "block").mapInArrow(run, schema)


def round_trip(pages: DataFrame, **options) -> DataFrame:
    """Write the pages as archives, read them back, and return per page: page_id,
    payload_bytes, payload_digest, record_type, refers_to, complete."""
    spark = pages.sparkSession
    with Scratch(spark) as scratch:
        folder = scratch.folder("archives")
        write_archives(pages, folder, scratch, **options)
        records = scratch.keep(read_records(spark, folder), "records")
        decoded = decode(reassemble(records)).drop("payload")
        sound = F.col("payload_digest").isNull() | F.col("payload_digest").eqNullSafe(F.col("digest"))
        read = scratch.keep(decoded.withColumn("complete", F.col("complete") & sound), "payloads")
        columns = ["page_id", "payload_bytes", "payload_digest", F.col("type").alias("record_type"),
                   "refers_to", "complete"]
        # A revisit's payload is that of the response with its digest.
        sizes = read.where("type = 'response'").groupBy("payload_digest").agg(
            F.max("payload_bytes").alias("payload_bytes")
        )
        again = read.where("type = 'revisit'").drop("payload_bytes", "payload_digest")
        resolved = again.withColumnRenamed("digest", "payload_digest").join(sizes, "payload_digest", "left")
        out = read.where("type = 'response'").select(*columns).unionByName(resolved.select(*columns))
        return scratch.result(out, "pages-read")
