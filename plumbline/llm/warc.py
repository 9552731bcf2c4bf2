"""WARC archives: writing with revisits, segments and chunked framing, and reading back with reassembly.

Large records are cut into segments: the first keeps its type, the others are continuation records that name it. The
reader groups continuation records by origin, orders them by segment number, checks the total length, and decodes the
chunked transfer framing.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm.common import small_batches

# Payloads below this many bytes are always written in full.
LEAST_SHARED = 100
SEGMENT = 64 << 10  # bytes of a record's block in one segment
CHUNK = 16 << 10  # bytes of a transfer chunk
FILE_RECORDS = 1000  # pages in an archive file at most, so that a file can be held in memory
DATE = "2026-01-01T00:00:00Z"

# Fixed values of the WARC 1.1 and HTTP formats.
_VERSION = b"WARC/1.1"
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_END = b"\r\n\r\n"


def record_id(page: str, segment: int = 1) -> str:
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.sha256(f'{page}/{segment}'.encode()).digest()[:16])}>"


def chunked(payload: bytes) -> bytes:
    """The payload in chunked transfer framing."""
    pieces = [payload[i : i + CHUNK] for i in range(0, len(payload), CHUNK)]
    return b"".join(b"%x\r\n%b\r\n" % (len(p), p) for p in pieces) + b"0\r\n\r\n"


def dechunked(body: bytes) -> bytes:
    """The payload behind chunked transfer framing."""
    out, at = [], 0
    while True:
        line = body.index(b"\r\n", at)
        size = int(body[at:line].partition(b";")[0], 16)
        if not size:
            return b"".join(out)
        if body[line + 2 + size : line + 4 + size] != b"\r\n":
            raise ValueError("a transfer chunk has a wrong length")
        out.append(body[line + 2 : line + 2 + size])
        at = line + 4 + size


def _record(fields: list[tuple[str, object]], block: bytes) -> bytes:
    head = b"".join(f"{k}: {v}\r\n".encode() for k, v in [*fields, ("Content-Length", len(block))])
    return _VERSION + b"\r\n" + head + b"\r\n" + block + _END


def records(page: str, url: str | None, payload: bytes, digest: str, refers_to: str | None) -> bytes:
    """All records of one page: a revisit, or a response in as many segments as it takes."""
    uri = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "about:blank")
    common = [("WARC-Record-ID", record_id(page)), ("WARC-Date", DATE), ("WARC-Target-URI", uri), ("WARC-Page-ID", page), ("WARC-Payload-Digest", f"sha256:{digest}")]
    kind = [("Content-Type", "application/http;msgtype=response")]
    if refers_to is not None:
        more = [("WARC-Profile", _PROFILE), ("WARC-Refers-To", record_id(refers_to)), ("WARC-Refers-To-Page-ID", refers_to)]
        return _record([("WARC-Type", "revisit"), *common, *more, *kind], _HTTP)
    block = _HTTP + chunked(payload)
    if len(block) <= SEGMENT:
        return _record([("WARC-Type", "response"), *common, *kind], block)
    pieces = [block[i : i + SEGMENT] for i in range(0, len(block), SEGMENT)]
    out = [_record([("WARC-Type", "response"), *common, ("WARC-Segment-Number", 1), *kind], pieces[0])]
    for number, piece in enumerate(pieces[1:], 2):
        own = [("WARC-Record-ID", record_id(page, number)), ("WARC-Date", DATE), ("WARC-Segment-Origin-ID", record_id(page)), ("WARC-Segment-Number", number)]
        last = [("WARC-Segment-Total-Length", len(block))] if number == len(pieces) else []
        out.append(_record([("WARC-Type", "continuation"), *own, *last], piece))
    return b"".join(out)


def parse(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields, names in lower case, and block of each record of an uncompressed archive."""
    at = 0
    while at < len(data):
        if not data.startswith(b"WARC/", at):
            raise ValueError(f"no record at byte {at}")
        stop = data.index(_END, at)
        fields = {}
        for line in data[at:stop].decode().split("\r\n")[1:]:
            name, _, value = line.partition(":")
            fields[name.lower()] = value.strip()
        begin = stop + 4
        end = begin + int(fields["content-length"])
        if data[end : end + 4] != _END:
            raise ValueError(f"the record at byte {at} has a wrong length")
        yield fields, data[begin:end]
        at = end + 4


def _written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, 64):
            some = batch.slice(start, 64).to_pydict()
            rows = zip(*(some[n] for n in ("page", "url", "html", "digest", "refers_to")))
            # The text writer ends each row with the line feed that ends the record.
            out = [records(page, url, (html or "").encode(), digest, refers)[:-1] for page, url, html, digest, refers in rows]
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["record"])


def classified(pages: DataFrame) -> DataFrame:
    """(page, page_id, url, html, digest, refers_to): which earlier page each page repeats, if any.

    Only digests and ids are aggregated; copies of one payload are counted per task before they meet.
    """
    payload = F.coalesce("html", F.lit("")).cast("binary")
    page_id = F.col("page_id").cast("long")
    base = pages.select(page_id.alias("page_id"), F.col("url").cast("string").alias("url"), "html", F.sha2(payload, 256).alias("digest"), F.octet_length(payload).alias("size"))
    first = base.where(F.col("size") >= LEAST_SHARED).groupBy(F.col("digest").alias("of")).agg(F.min("page_id").alias("first"))
    joined = base.join(first, F.col("digest") == F.col("of"), "left")
    again = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    name = F.coalesce(F.col("page_id").cast("string"), F.lit("null"))
    return joined.select(name.alias("page"), "page_id", "url", "html", "digest", F.when(again, F.col("first").cast("string")).alias("refers_to"))


def write_archives(pages: DataFrame, path: str) -> None:
    """Write one response or revisit record per page as gzip-compressed WARC files.

    Of pages with equal payloads of at least 100 bytes that with the smallest id is written in full and the others
    refer to it; a null id never is the smallest unless all are null, and then all are written in full, as are rows
    that repeat the smallest id. A null html is an empty payload; a null url reads about:blank.
    """
    small_batches(pages.sparkSession)
    rows = classified(pages).select("page", "url", "html", "digest", "refers_to").mapInArrow(_written, "record binary")
    text = rows.select(F.col("record").cast("string").alias("value"))
    text.write.option("lineSep", "\n").option("compression", "gzip").option("maxRecordsPerFile", FILE_RECORDS).text(path)


_SEGMENTS = pa.schema([
    ("file", pa.string()), ("record", pa.string()), ("copy", pa.int32()), ("segment", pa.int32()), ("total", pa.int64()), ("type", pa.string()), ("page", pa.string()),
    ("url", pa.string()), ("digest", pa.string()), ("refers_to", pa.string()), ("block", pa.binary()),
])


def _parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            name, packed = batch.column("path")[i].as_py(), batch.column("content")[i].as_py()
            data = zlib.decompress(packed, 31) if packed else b""
            rows, held, seen = [], 0, Counter()
            for f, block in parse(data):
                total = f.get("warc-segment-total-length")
                digest = f.get("warc-payload-digest", "").removeprefix("sha256:") or None
                record = f["warc-segment-origin-id" if f["warc-type"] == "continuation" else "warc-record-id"]
                segment = int(f.get("warc-segment-number", 0))
                # A row given twice gives two records of one name; their place in the file tells them apart.
                copy = seen[record, segment]
                seen[record, segment] += 1
                rows.append((
                    name, record, copy, segment, int(total) if total else None, f["warc-type"],
                    f.get("warc-page-id"), f.get("warc-target-uri"), digest, f.get("warc-refers-to-page-id"), block,
                ))
                held += len(block)
                if held > 4 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k.type) for c, k in zip(zip(*rows), _SEGMENTS)], schema=_SEGMENTS)
                    rows, held = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k.type) for c, k in zip(zip(*rows), _SEGMENTS)], schema=_SEGMENTS)


def _assembled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Payloads of records given as (head, segments)."""
    for batch in batches:
        for i in range(batch.num_rows):
            segments = batch.column("segments")[i].as_py()
            row = batch.slice(i, 1)
            numbers = [s["segment"] for s in segments]
            if numbers != list(range(min(numbers), min(numbers) + len(numbers))) or numbers[0] > 1:
                raise ValueError("segments are missing")
            block = b"".join(s["block"] for s in segments)
            totals = {s["total"] for s in segments} - {None}
            if numbers[0] == 1 and totals != {len(block)}:
                raise ValueError("the segments do not have the total length")
            head, _, body = block.partition(_END)
            kind = row.column("type")[0].as_py()
            payload = None if kind == "revisit" else dechunked(body) if b"chunked" in head.lower() else body
            yield pa.RecordBatch.from_arrays([*(row.column(n) for n in ("type", "page", "url", "digest", "refers_to")), pa.array([payload], pa.binary())], names=["type", "page", "url", "digest", "refers_to", "payload"])


def read_archives(spark: SparkSession, path: str, across_files: bool = False) -> DataFrame:
    """(type, page, url, digest, refers_to, payload) of every record, segments put together; a revisit has no payload.

    Records in one segment are not shuffled. Raises if segments are missing or lengths do not fit. ``across_files``
    also joins segments that lie in different files; then no record may be given twice.
    """
    small_batches(spark)
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    names = "file string, record string, copy int, segment int, total long, type string, page string, url string, digest string, refers_to string, block binary"
    found = files.mapInArrow(_parsed, names)
    part = F.struct("segment", "total", "block")
    head = ["type", "page", "url", "digest", "refers_to"]
    single = found.where("segment = 0").select(*head, F.array(part).alias("segments"))
    key = ["record"] if across_files else ["file", "record", "copy"]
    first = F.col("segment") == 1
    several = found.where("segment > 0").groupBy(*key).agg(
        *(F.max(F.when(first, F.col(c))).alias(c) for c in head), F.array_sort(F.collect_list(part)).alias("segments")
    )
    return single.unionAll(several.select(*head, "segments")).mapInArrow(_assembled, "type string, page string, url string, digest string, refers_to string, payload binary")
