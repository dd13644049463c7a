"""WARC archives: writing records from a table, and reading them back whole.

Writing: payloads are framed as chunked HTTP responses; of rows with equal
payloads one is a ``response`` record and the others are ``revisit`` records
that refer to it. A record longer than ``segment_bytes`` is cut into a first
segment and ``continuation`` records. Spark's own file writer stores the
archives, so they are committed atomically wherever Spark can write.

Reading: records are parsed by their content length; continuation records are
grouped by origin identifier, ordered by segment number, checked against the
total length, joined, and the chunked framing is decoded. Records that stand
whole in one archive are put together there; segments of the others, which an
archive's end has cut off, are shuffled by origin. A group is the segments of
one record: record ids of repeated rows carry a copy number.

Only rows whose payload occurs more than once need a decision between response
and revisit, so only their digests are joined, and payloads stay where they
are. Archives are bounded in size (``archive_bytes`` before compression plus
one record), so a task holds a few of them at a time, never a table; for a
large crawl it is set to about 1 GB, which keeps the number of files small.

Payloads of any length are cut, joined and digested whole.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, LongType, StringType, StructField, StructType

from .components import dropped, saved

VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
SEGMENT_BYTES = 2 << 10
ARCHIVE_BYTES = 8 << 20
CHUNK_BYTES = 8 << 10
#: Digests of repeated payloads that are broadcast (about 60 bytes each).
BROADCAST_DIGESTS = 400_000

PARSED = StructType([
    StructField("record_type", StringType()), StructField("row_id", StringType()), StructField("refers_to", StringType()),
    StructField("payload_digest", StringType()), StructField("payload_bytes", LongType()), StructField("payload", BinaryType()),
    StructField("origin", StringType()), StructField("segment", IntegerType()), StructField("total", LongType()),
])
RECORD = StructType([*PARSED.fields[:6], StructField("error", StringType())])


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def chunked(payload: bytes, size: int = CHUNK_BYTES) -> bytes:
    """Chunked transfer framing of a payload."""
    parts = []
    for i in range(0, len(payload), size):
        piece = payload[i:i + size]
        parts.append(b"%x\r\n%b\r\n" % (len(piece), piece))
    return b"".join([*parts, b"0\r\n\r\n"])


def dechunked(body: bytes) -> bytes:
    """The payload behind chunked framing; ValueError if the framing is broken."""
    parts, at = [], 0
    while True:
        eol = body.find(b"\r\n", at)
        if eol < 0:
            raise ValueError("chunk size line is missing")
        size = int(body[at:eol].split(b";", 1)[0].strip(), 16)
        at = eol + 2
        if size == 0:
            return b"".join(parts)
        if body[at + size:at + size + 2] != b"\r\n":
            raise ValueError("chunk is shorter than its size")
        parts.append(body[at:at + size])
        at += size + 2


def _record(fields: list[tuple[str, object]], block: bytes) -> bytes:
    head = [VERSION, *[f"{k}: {v}".encode() for k, v in fields], b"Content-Length: %d" % len(block)]
    return b"\r\n".join(head) + b"\r\n\r\n" + block


def _clean(value: str) -> str:
    """A header value: control characters percent-encoded."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: quote(m[0]), value)


def record_id(row_id, digest: str, copy: int | None = None) -> str:
    """The id of a row's record; ``copy`` tells rows with equal id and payload apart."""
    return f"<urn:row:{'' if row_id is None else quote(str(row_id), safe='')}:{digest}{'' if copy is None else f':c{copy}'}>"


def build_records(row_id, url, payload: bytes | None, digest: str, length: int, response_id, date: str,
                  segment_bytes: int = SEGMENT_BYTES, copy: int | None = None) -> list[bytes]:
    """The records of one row; ``payload`` is None for a revisit."""
    own = record_id(row_id, digest, copy)
    common = [("WARC-Date", date), *([("WARC-Target-URI", _clean(url))] if url is not None else []),
              ("WARC-Payload-Digest", f"sha1:{digest}")]
    if payload is None:
        return [_record([("WARC-Type", "revisit"), ("WARC-Record-ID", own), *common, ("WARC-Profile", REVISIT_PROFILE),
                         ("WARC-Refers-To", record_id(response_id, digest)), ("WARC-X-Payload-Length", length),
                         ("Content-Type", "application/http; msgtype=response")], HTTP_HEAD)]
    block = HTTP_HEAD + chunked(payload)
    cut = [block[i:i + segment_bytes] for i in range(0, len(block), segment_bytes)]
    first = [("WARC-Type", "response"), ("WARC-Record-ID", own), *common,
             *([("WARC-Segment-Number", 1)] if len(cut) > 1 else []),
             ("Content-Type", "application/http; msgtype=response")]
    out = [_record(first, cut[0])]
    for n, piece in enumerate(cut[1:], 2):
        last = [("WARC-Segment-Total-Length", len(block))] if n == len(cut) else []
        out.append(_record([("WARC-Type", "continuation"), ("WARC-Record-ID", f"{own[:-1]}:{n}>"), ("WARC-Date", date),
                            ("WARC-Segment-Origin-ID", own), ("WARC-Segment-Number", n), *last], piece))
    return out


def write_archives(df: DataFrame, path: str, id_col: str, url_col: str, payload_col: str, revisit_bytes: int = 0,
                   segment_bytes: int = SEGMENT_BYTES, archive_bytes: int = ARCHIVE_BYTES,
                   date: str = "1970-01-01T00:00:00Z") -> None:
    """Write one record (or its segments) per row of ``df`` under ``path``.

    Payloads of at least ``revisit_bytes`` bytes that equal that of a row with
    a smaller id become revisits. A string payload is stored in UTF-8; null is
    an empty payload. Rows that share the smallest id are all responses; null
    ids count as the largest, and a payload that only rows without an id have
    makes each of them a response. An empty input writes no record.
    """
    rows = df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{url_col}`").cast("string").alias("url"),
                     F.coalesce(F.col(f"`{payload_col}`").cast("binary"), F.lit(b"")).alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload"))
    # Of each payload: its smallest id, and whether rows share it. Few payloads repeat.
    counted = rows.groupBy("digest", "id").agg(F.count("*").alias("n"))
    order = F.struct(F.col("id").isNull(), F.col("id"))
    first = (counted.groupBy("digest").agg(F.min("id").alias("first_id"), F.sum("n").alias("rows"), F.min_by("n", order).alias("same"))
             .where("rows > 1").select("digest", "first_id", (F.col("same") > 1).alias("repeated")))
    first = saved(df.sparkSession, first, "repeated")
    small = first.count() <= BROADCAST_DIGESTS
    joined = rows.join(F.broadcast(first) if small else first, "digest", "left")
    known = F.col("repeated").isNotNull()
    revisit = known & (F.octet_length("payload") >= revisit_bytes) & ~F.col("id").eqNullSafe(F.col("first_id"))
    copy = F.when(known & (F.col("repeated") | ~F.col("id").eqNullSafe(F.col("first_id"))), F.monotonically_increasing_id())
    ready = joined.select(F.col("id").cast("string").alias("id"), "url", "digest", F.octet_length("payload").cast("long").alias("n"),
                          F.when(~revisit, F.col("payload")).alias("payload"), F.col("first_id").cast("string").alias("first_id"), copy.alias("copy"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for b in batches:
            for row_id, url, digest, n, payload, first_id, copy in zip(*[c for c in b.columns]):
                base32 = base64.b32encode(bytes.fromhex(digest.as_py())).decode()
                for r in build_records(row_id.as_py(), url.as_py(), payload.as_py(), base32, n.as_py(), first_id.as_py(),
                                       date, segment_bytes, copy.as_py()):
                    held.append(r)
                    size += len(r)
                    if size >= archive_bytes:
                        yield pa.RecordBatch.from_pydict({"a": pa.array([b"\r\n\r\n".join(held)], pa.binary())})
                        held, size = [], 0
        if held:
            yield pa.RecordBatch.from_pydict({"a": pa.array([b"\r\n\r\n".join(held)], pa.binary())})

    blobs = ready.mapInArrow(run, StructType([StructField("a", BinaryType())]))
    # One archive a file; the line separator is what ends a WARC record.
    (blobs.select(F.col("a").cast("string").alias("value")).write.option("lineSep", "\r\n\r\n")
     .option("maxRecordsPerFile", 1).option("compression", "gzip").text(path))
    dropped(df.sparkSession, first)


def parse_archive(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """``(headers, block)`` of every record; names are lower-cased."""
    if data[:2] == b"\x1f\x8b":
        data = gzip.decompress(data)
    at, n = 0, len(data)
    while True:
        while data[at:at + 2] == b"\r\n":
            at += 2
        if at >= n:
            return
        end = data.find(b"\r\n\r\n", at)
        lines = data[at:end].split(b"\r\n") if end >= 0 else [b""]
        if not lines[0].startswith(b"WARC/"):
            raise ValueError(f"no WARC record at byte {at}")
        fields = dict(x.decode("utf-8", "replace").split(":", 1) for x in lines[1:] if b":" in x)
        fields = {k.strip().lower(): v.strip() for k, v in fields.items()}
        start = end + 4
        at = start + int(fields["content-length"])
        if at > n:
            raise ValueError("record is shorter than its content length")
        yield fields, data[start:at]


def decode_block(block: bytes) -> bytes:
    """The payload of an HTTP response block, chunked or not."""
    head, _, body = block.partition(b"\r\n\r\n")
    if re.search(rb"(?im)^transfer-encoding:[^\r\n]*\bchunked\b", head):
        return dechunked(body)
    return body


def _id_of(urn: str | None) -> str | None:
    m = re.match(r"<urn:row:([^:]*):", urn or "")
    return unquote(m[1]) if m and m[1] else None


def _whole(block: bytes, digest: str | None) -> tuple[bytes | None, str, str | None]:
    """Payload, its digest, and what is wrong with it."""
    try:
        payload = decode_block(block)
    except ValueError as e:
        return None, "", str(e)
    found = sha1_base32(payload)
    return payload, found, None if digest in (None, "", found) else "digest differs"


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row per response or revisit record under ``path``.

    ``record_type``, ``row_id`` (string), ``refers_to`` (row id of the
    response, revisits only), ``payload_digest`` (base32 SHA-1), ``payload_bytes``,
    ``payload`` (null for revisits) and ``error``: null, or why the payload
    could not be had (missing or conflicting segments, a total length that
    differs, broken framing, a digest that differs). Damaged records are
    returned with their error, never dropped; copies of a segmented record
    give a row each, and of a record that stands whole in one archive a
    segment elsewhere is a damaged record of its own. A file that is no WARC
    archive raises an error.
    """
    files = spark.read.format("binaryFile").load(path).select("content")

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for content in b.column(0):
                rows, cut = [], {}
                for f, block in parse_archive(content.as_py()):
                    kind = f.get("warc-type")
                    digest = (f.get("warc-payload-digest") or "").removeprefix("sha1:") or None
                    number = int(f.get("warc-segment-number", 0))
                    if kind == "revisit":
                        rows.append((kind, _id_of(f.get("warc-record-id")), _id_of(f.get("warc-refers-to")), digest,
                                     int(f.get("warc-x-payload-length", 0)), None, None, None, None))
                    elif kind == "continuation" or kind == "response" and number:
                        origin = f.get("warc-segment-origin-id") or f.get("warc-record-id")
                        total = f.get("warc-segment-total-length")
                        cut.setdefault(origin, []).append((kind, _id_of(origin), None, digest, None, block, origin, number, int(total) if total else None))
                    elif kind == "response":
                        rows.append((kind, _id_of(f.get("warc-record-id")), None, digest, None, block, None, None, None))
                for segments in cut.values():
                    rows += _joined(segments)
                if rows:
                    cols = list(zip(*rows))
                    types = [pa.string()] * 4 + [pa.int64(), pa.binary(), pa.string(), pa.int32(), pa.int64()]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=PARSED.names)

    parsed = files.mapInArrow(parse, PARSED)

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for r in b.to_pylist():
                rows += _finish(r)
            if rows:
                cols = list(zip(*rows))
                types = [pa.string()] * 4 + [pa.int64(), pa.binary(), pa.string()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=RECORD.names)

    part = F.struct("segment", "total", F.col("payload").alias("block"))
    grouped = (parsed.where("segment IS NOT NULL").groupBy("origin")
               .agg(F.max("row_id").alias("row_id"), F.max("payload_digest").alias("payload_digest"), F.collect_list(part).alias("parts")))
    single = parsed.where("segment IS NULL")
    return _finished(single, grouped, finish)


def _finished(single: DataFrame, grouped: DataFrame, finish) -> DataFrame:
    names = ["record_type", "row_id", "refers_to", "payload_digest", "payload_bytes", "payload", "parts"]
    parts_type = grouped.schema["parts"].dataType.simpleString()
    a = single.select(*names[:-1], F.lit(None).cast(parts_type).alias("parts"))
    b = grouped.select(F.lit("response").alias("record_type"), "row_id", F.lit(None).cast("string").alias("refers_to"), "payload_digest",
                       F.lit(None).cast("long").alias("payload_bytes"), F.lit(None).cast("binary").alias("payload"), "parts")
    return a.unionByName(b).mapInArrow(finish, RECORD)


def _joined(segments: list[tuple]) -> list[tuple]:
    """The rows of one archive's segments of a record: the whole record if it
    is all there, once and undamaged, else the segments."""
    try:
        block, copies = reassemble([{"segment": r[7], "block": r[5], "total": r[8]} for r in segments])
    except ValueError:
        return segments
    digest = next((r[3] for r in segments if r[3]), None)
    return [("response", segments[0][1], None, digest, None, block, None, None, None)] if copies == 1 else segments


def reassemble(parts: list[dict]) -> tuple[bytes, int]:
    """The block of a segmented record and how many copies of it there are."""
    by_number: dict[int, list] = {}
    for p in parts:
        by_number.setdefault(p["segment"], []).append(p)
    numbers = sorted(by_number)
    if numbers != list(range(1, len(numbers) + 1)):
        raise ValueError("segments are missing")
    if any(p["block"] != by_number[n][0]["block"] for n in numbers for p in by_number[n]):
        raise ValueError("segments conflict")
    block = b"".join(by_number[n][0]["block"] for n in numbers)
    total = by_number[numbers[-1]][0]["total"]
    if total is None:
        raise ValueError("the last segment is missing")
    if total != len(block):
        raise ValueError("total length differs")
    return block, len(by_number[1])


def _finish(r: dict) -> list[tuple]:
    if r["record_type"] == "revisit":
        return [(r["record_type"], r["row_id"], r["refers_to"], r["payload_digest"], r["payload_bytes"], None, None)]
    copies, block = 1, r["payload"]
    if r["parts"] is not None:
        try:
            block, copies = reassemble(r["parts"])
        except ValueError as e:
            return [("response", r["row_id"], None, r["payload_digest"], None, None, str(e))]
    payload, digest, error = _whole(block, r["payload_digest"])
    if payload is None:
        return [("response", r["row_id"], None, r["payload_digest"], None, None, error)] * copies
    return [("response", r["row_id"], None, digest, len(payload), payload, error)] * copies
