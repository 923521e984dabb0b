"""WARC archives of pages, and a salvage reader for damaged ones.

Writing: every page is a `response` record, or a `revisit` of the response with the same payload
and the smallest page id. Records are gzip members; a task gathers them into archives of about
`ARCHIVE` bytes, one file each, through Spark's own writer, so any store that Spark reaches will
do. The writer ends each file with one zero byte, which gzip readers skip as padding.

Reading: each archive is one row. A record counts only if its gzip check, its lengths and its
digests hold. After a failed check the reader looks for the next valid member or, in plain
archives, the next version line, goes on from there, and logs the bytes in between as a gap.

Null html is an empty payload; null page ids are kept and never referred to by a revisit while a
page with an id has the payload. Repeated rows are revisits of the first. An empty table gives no
archive and an empty result. One page is one record in memory, however long.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordloom.llm.common import stored, table
from wordloom.session import scratch_path

ARCHIVE = 8_000_000  # bytes of an archive before the next begins
LEVEL = 1  # of the compression
BROADCAST = 500_000  # repeated payloads (about 60 bytes each) up to which their table is broadcast
MAGIC = b"\x1f\x8b\x08"
VERSION = b"WARC/1."
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
# A fixed value: records carry no clock, so that a task run again writes the same bytes.
DATE = "2000-01-01T00:00:00Z"


def sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


# ── records ──────────────────────────────────────────────────────────────────────────────


def record(page_id, url: str | None, payload: bytes, refers_to=None, revisit: bool = False) -> bytes:
    """One record, from its version line to the two line ends behind its block."""
    head = HTTP % len(payload)
    block = head if revisit else head + payload
    uri = "".join(c if c.isprintable() else "%%%02X" % ord(c) for c in url or "urn:none")
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {uri}",
        f"WARC-Payload-Digest: sha1:{sha1(payload)}",
        f"WARC-Block-Digest: sha1:{sha1(block)}",
        f"Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if revisit:
        lines.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        lines.append(f"WARC-Refers-To: <urn:page:{'' if refers_to is None else refers_to}>")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(data: bytes, level: int = LEVEL) -> bytes:
    """A gzip member without a clock in its header."""
    c = zlib.compressobj(level, zlib.DEFLATED, 31)
    return c.compress(data) + c.flush()


def parse(data: bytes, at: int = 0) -> tuple[dict, int] | None:
    """The record at `at` and the offset behind it, or None if any check fails."""
    if data[at : at + len(VERSION)] != VERSION:
        return None
    end = data.find(b"\r\n\r\n", at)  # however far: a url has no limit of length
    if end < 0 or data.find(b"\r\n" + VERSION, at, end) >= 0:
        return None
    fields = {}
    for line in data[at:end].decode("utf-8", "replace").split("\r\n")[1:]:
        name, colon, value = line.partition(":")
        if not colon:
            return None
        fields[name.strip().lower()] = value.strip()
    size = fields.get("content-length", "")
    if not size.isdigit() or "warc-type" not in fields:
        return None
    lo, hi = end + 4, end + 4 + int(size)
    if data[hi : hi + 4] != b"\r\n\r\n":
        return None
    block = data[lo:hi]
    wanted = fields.get("warc-block-digest")
    if wanted and wanted != f"sha1:{sha1(block)}":
        return None
    head = block.find(b"\r\n\r\n")
    payload = block[head + 4 :] if head >= 0 else block
    if fields["warc-type"] == "response":
        wanted = fields.get("warc-payload-digest")
        if wanted and wanted != f"sha1:{sha1(payload)}":
            return None
        fields["payload"], fields["payload-bytes"] = payload, len(payload)
    else:  # a revisit repeats the response's HTTP header, with the length of the payload
        told = [x.split(b":")[1] for x in block[: max(head, 0)].split(b"\r\n") if x.lower().startswith(b"content-length:")]
        fields["payload"], fields["payload-bytes"] = b"", int(told[0]) if told else 0
    return fields, hi + 4


def _inflate(data: bytes, at: int) -> tuple[bytes, int] | None:
    """The gzip member at `at`, if it is whole and its checksum holds."""
    d = zlib.decompressobj(31)
    try:
        out = [d.decompress(memoryview(data)[at : at + 65536])]
        if not out[0].startswith(VERSION):
            return None
        done = at + 65536
        while not d.eof and done < len(data):
            out.append(d.decompress(memoryview(data)[done : done + 1_048_576]))
            done += 1_048_576
    except zlib.error:
        return None
    return (b"".join(out), min(done, len(data)) - len(d.unused_data)) if d.eof else None


def _record_at(data: bytes, at: int) -> tuple[dict, int] | None:
    if data[at : at + 3] == MAGIC:
        found = _inflate(data, at)
        made = parse(found[0]) if found else None
        return (made[0], found[1]) if made and made[1] == len(found[0]) else None
    return parse(data, at)


def salvage(data: bytes) -> tuple[list[tuple[int, dict]], list[tuple[int, int]]]:
    """The valid records with their offsets, and the (offset, length) of every gap."""
    records, gaps, at, lost = [], [], 0, None
    while at < len(data):
        found = _record_at(data, at)
        if found is not None:
            if lost is not None:
                gaps.append((lost, at - lost))
                lost = None
            records.append((at, found[0]))
            at = found[1]
            continue
        if lost is None:
            rest = data[at:].lstrip(b"\x00") if data[at] == 0 else None
            if rest is not None and (not rest or rest[:3] == MAGIC or rest.startswith(VERSION)):
                at = len(data) - len(rest)  # padding
                continue
            lost = at
        nexts = [x for x in (data.find(MAGIC, at + 1), data.find(VERSION, at + 1)) if x >= 0]
        at = min(nexts, default=len(data))
    if lost is not None:
        gaps.append((lost, len(data) - lost))
    return records, gaps


# ── archives ─────────────────────────────────────────────────────────────────────────────


def _archives(size: int):
    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0

        def out():
            made = pa.array([b"".join(parts)], pa.binary())
            parts.clear()
            return pa.RecordBatch.from_arrays([made], ["archive"])

        for batch in batches:
            for i in range(batch.num_rows):
                page, url, html, revisit, refers = (batch.column(c)[i].as_py() for c in range(5))
                parts.append(member(record(page, url, (html or "").encode(), refers, revisit)))
                held += len(parts[-1])
                if held >= size:
                    yield out()
                    held = 0
        if parts:
            yield out()

    return gather


def write_archives(pages: DataFrame, path: str, min_bytes: int = 0, size: int = ARCHIVE) -> None:
    """Write (page_id, url, html) as archives under `path`.

    Payloads of at least `min_bytes` that occur more than once become one response, of the
    smallest page id, and revisits.
    """
    html = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select("page_id", "url", "html", F.monotonically_increasing_id().alias("r"), F.sha1(html.cast("binary")).alias("d"), F.octet_length(html).alias("n"))
    first = F.struct(F.col("page_id").isNull().alias("none"), "page_id", "r")
    repeated = rows.where(F.col("n") >= min_bytes).groupBy("d").agg(F.count(F.lit(1)).alias("c"), F.min(first).alias("f")).where("c > 1")
    repeated = stored(repeated.select("d", F.col("f.page_id").alias("to"), F.col("f.r").alias("to_r")), "repeated")
    if repeated.limit(BROADCAST + 1).count() <= BROADCAST:
        repeated = F.broadcast(repeated)
    typed = rows.join(repeated, "d", "left")
    revisit = F.coalesce(F.col("to_r") != F.col("r"), F.lit(False))
    typed.select("page_id", "url", "html", revisit.alias("revisit"), F.when(revisit, F.col("to")).alias("to")).mapInArrow(
        _archives(size), "archive binary"
    ).select(F.col("archive").cast("string")).write.option("lineSep", "\0").option("maxRecordsPerFile", 1).text(path)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def number(urn: str | None):
        digits = (urn or "").removeprefix("<urn:page:").removesuffix(">")
        return int(digits) if digits.lstrip("-").isdigit() else None

    names = ["file", "at", "gap_bytes", "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
    for batch in batches:
        for i in range(batch.num_rows):
            file = batch.column(0)[i].as_py()
            records, gaps = salvage(batch.column(1)[i].as_py())
            rows = [(file, at, n) + (None,) * 6 for at, n in gaps]
            for at, f in records:
                digest = f.get("warc-payload-digest", "").removeprefix("sha1:")
                rows.append((file, at, None, number(f.get("warc-record-id")), f["payload-bytes"], digest, f["warc-type"], number(f.get("warc-refers-to")), f["payload"]))
            for lo in range(0, len(rows), 64):
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows[lo : lo + 64]), kinds)], names)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row per record, or per quarantined gap (gap_bytes set, the rest null)."""
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(
        _read,
        "file string, at long, gap_bytes long, page_id long, payload_bytes long, payload_digest string,"
        " record_type string, refers_to long, payload binary",
    )


def op9_warc(spark, sf: str) -> DataFrame:
    """Every page written to archives and read back: one row per record; a gap stops the job."""
    path = scratch_path(spark, "warc")
    write_archives(table(spark, sf, "pages").select("page_id", "url", "html"), path)
    lost = F.concat(F.lit("unreadable bytes in a new archive: "), F.col("file"), F.lit(" at "), F.col("at"))
    whole = F.when(F.col("gap_bytes").isNull(), True).otherwise(F.raise_error(lost).cast("boolean"))
    back = read_archives(spark, path).where(whole)
    return back.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP9_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, octet_length(encode(html)) AS payload_bytes, sha1(html) AS x, min(page_id) OVER (PARTITION BY html) AS first FROM p)
SELECT page_id, payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         ((('0x' || substr(x, (i // 4) * 5 + 1, 5))::BIGINT >> (15 - 5 * (i % 4))::INT) & 31)::INT + 1, 1)), '') AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM d
"""
