"""WARC archives: a writer through Spark's text sink and a salvage reader.

Records are gzip members of their own. Spark's text sink writes a column's
bytes as they are, through any Hadoop file system and with its commit
protocol; the line separator is an empty gzip member, so a file is a plain
sequence of members that any reader of ``.warc.gz`` can open.

The reader checks every record (member checksum, framing, block digest). After
a failed check it searches for the next member or version line that passes,
goes on from there and logs the bytes between as a quarantined gap. What a
damaged member still inflates to is searched in the same way.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from traitlens.llm.common import written

VERSION = b"WARC/1.1\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
EMPTY_MEMBER = bytes.fromhex("1f8b08000000000000ff03000000000000000000")
_CANDIDATE = re.compile(rb"\x1f\x8b\x08|WARC/1\.[01]\r\n")
_VERSION_LINE = re.compile(rb"WARC/1\.[01]\r\n")
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"


def digest_of(payload: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _header(fields: list[tuple[str, object]], block: bytes) -> bytes:
    lines = [f"{k}: {v}\r\n" for k, v in fields if v is not None]
    lines.append(f"WARC-Block-Digest: sha1:{digest_of(block)}\r\nContent-Length: {len(block)}\r\n\r\n")
    return VERSION + "".join(lines).encode()


def record(page_id: object, url: str | None, payload: bytes, refers_to: object, revisit: bool, date: str) -> bytes:
    """One WARC record: the payload with HTTP headers, or a revisit without it."""
    http = _HTTP % len(payload)
    block = http if revisit else http + payload
    fields = [("WARC-Type", "revisit" if revisit else "response"),
              ("WARC-Record-ID", f"<urn:page:{'' if page_id is None else page_id}>"),
              ("WARC-Date", date),
              ("WARC-Target-URI", None if url is None else quote(url, safe="!#$%&'()*+,/:;=?@[]~")),
              ("Content-Type", "application/http;msgtype=response"),
              ("WARC-Payload-Digest", f"sha1:{digest_of(payload)}")]
    if revisit:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<urn:page:{refers_to}>")]
    return _header(fields, block) + block + b"\r\n\r\n"


def member(data: bytes) -> bytes:
    """A gzip member without time stamp, so that equal records give equal bytes."""
    deflate = zlib.compressobj(6, zlib.DEFLATED, 31)
    return deflate.compress(data) + deflate.flush()


@dataclass
class Record:
    fields: dict[str, str] = field(default_factory=dict)
    block: bytes = b""


def _plain(data: bytes, at: int) -> tuple[Record, int] | None:
    """The record at a version line and the place after it; None if any check fails."""
    if not re.match(rb"WARC/1\.[01]\r\n", data[at:at + 10]):
        return None
    head_end = data.find(b"\r\n\r\n", at)
    if head_end < 0:
        return None
    fields = {}
    for line in data[at:head_end].split(b"\r\n")[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            return None
        fields[name.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
    size = fields.get("content-length", "")
    if not size.isdecimal():
        return None
    a = head_end + 4
    b = a + int(size)
    if data[b:b + 4] != b"\r\n\r\n":
        return None
    block = data[a:b]
    algorithm, _, value = fields.get("warc-block-digest", "").partition(":")
    if algorithm.lower() == "sha1" and value != digest_of(block):
        return None
    return Record(fields, block), b + 4


def _inflated(data: bytes, at: int) -> tuple[bytes, int | None]:
    """What a gzip member inflates to, as far as it does, and its checked end (None: damaged or cut off)."""
    inflate, parts, end = zlib.decompressobj(31), [], at
    while not inflate.eof and end < len(data):  # stops at the member's checked end
        before, piece = inflate.copy(), data[end:end + 65536]
        try:
            parts.append(inflate.decompress(piece))
        except zlib.error:
            try:  # the bytes before the damage
                for k in range(len(piece)):
                    parts.append(before.decompress(piece[k:k + 1]))
            except zlib.error:
                pass
            return b"".join(parts), None
        end = min(end + 65536, len(data))
    return b"".join(parts), end - len(inflate.unused_data) if inflate.eof else None


def _at(data: bytes, at: int) -> tuple[list[Record], int | None, bool] | None:
    """Records of the member or plain record at a place, its end (None: unknown) and whether bytes in it are lost.

    Of a member with damage, records at its version lines count if they pass; where
    the member's own check fails, only with a block digest, and not a record that
    is the whole member, as it is what the check denies.
    """
    if data[at:at + 3] != b"\x1f\x8b\x08":
        found = _plain(data, at)
        return found and ([found[0]], found[1], False)
    raw, end = _inflated(data, at)
    records, inner, lost = [], 0, end is None
    while inner < len(raw):
        found = _plain(raw, inner)
        if found and (end is not None or "warc-block-digest" in found[0].fields):
            if end is None and inner == 0 and found[1] == len(raw):
                return None
            records.append(found[0])
            inner = found[1]
        else:
            lost = True
            line = _VERSION_LINE.search(raw, inner + 1)
            inner = line.start() if line else len(raw)
    return (records, end, lost) if records or not lost else None


def salvage(data: bytes) -> Iterator[tuple[str, int, int, Record | None]]:
    """('record' | 'gap', start, end, record) over all bytes of an archive, in order.

    A damaged member is a gap, followed by the records that are saved from it; these have its place.
    """
    at, good = 0, None
    while at < len(data):
        start, good = at, good or _at(data, at)
        records, end, lost = good or ([], None, True)
        good = None
        if end is None:
            for m in _CANDIDATE.finditer(data, at + 1):
                good = _at(data, m.start())
                # bytes that a member stores as they are hold its records once more
                if good and not (good[0] and all(r in records for r in good[0])):
                    end = m.start()
                    break
            else:
                end, good = len(data), None
        if lost:
            yield "gap", start, end, None
        for r in records:
            yield "record", start, end, r
        at = end


def write_warc(pages: DataFrame, path: str, key: str = "page_id", url: str = "url", html: str = "html",
               min_revisit_bytes: int = 0, date: str = "1970-01-01T00:00:00Z",
               records_per_file: int = 4096) -> None:
    """Write one record per row of ``pages`` under ``path``, payload the html in UTF-8 (null: empty).

    Of rows whose payloads are equal and of ``min_revisit_bytes`` or more, those
    with the smallest key are responses and the others revisit it. A null key is
    never the smallest; if all are null, all are responses. Other columns are
    not read.
    """
    rows = pages.select(F.col(key).alias("k"), F.col(url).cast("string").alias("u"),
                        F.coalesce(F.col(html).cast("string"), F.lit("")).alias("p"))
    rows = rows.withColumn("d", F.sha1("p"))
    first = written(rows.where(F.octet_length("p") >= min_revisit_bytes).groupBy("d")
                    .agg(F.min("k").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").select("d", "first"),
                    "payloads")

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for i in range(0, whole.num_rows, 256):
                some = whole.slice(i, 256).to_pylist()
                yield pa.RecordBatch.from_arrays([pa.array([
                    member(record(r["k"], r["u"], r["p"].encode("utf-8"), r["first"], r["revisit"], date))
                    for r in some], pa.binary())], ["member"])

    typed = rows.join(first, "d", "left").select(
        "k", "u", "p", "first", F.coalesce(F.col("first").isNotNull() & ~F.col("k").eqNullSafe(F.col("first")),
                                           F.lit(False)).alias("revisit"))
    # a cast of bytes to text keeps them as they are; the text sink writes them so
    typed.mapInArrow(build, "member binary").select(F.col("member").cast("string").alias("value")) \
        .write.option("encoding", "ISO-8859-1").option("lineSep", EMPTY_MEMBER.decode("latin-1")) \
        .option("maxRecordsPerFile", records_per_file).text(path)


_ID = re.compile(r"<urn:page:(.*)>")
_SCHEMA = ("file string, kind string, start long, end long, record_type string, page_id string, url string, "
           "payload_bytes long, payload_digest string, refers_to string, payload binary")


def _row(name: str, kind: str, a: int, b: int, r: Record | None) -> dict:
    row = {"file": name, "kind": kind, "start": a, "end": b}
    if r is None:
        return row
    f = r.fields
    http, cut, body = r.block.partition(b"\r\n\r\n")
    sent = re.search(rb"(?im)^content-length:[ \t]*([0-9]+)", http)
    is_page = f.get("content-type", "").startswith("application/http") and cut
    payload = body if is_page else r.block
    revisit = f.get("warc-type") == "revisit"
    named = f.get("warc-payload-digest", "").partition(":")[2]

    def page(field_name: str) -> str | None:
        m = _ID.fullmatch(f.get(field_name, ""))
        return m.group(1) if m and m.group(1) else None

    return row | {"record_type": f.get("warc-type"), "page_id": page("warc-record-id"),
                  "url": f.get("warc-target-uri"),
                  "payload_bytes": int(sent.group(1)) if revisit and is_page and sent else len(payload),
                  "payload_digest": named if revisit else digest_of(payload),
                  "refers_to": page("warc-refers-to"), "payload": None if revisit else payload}


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Records and gaps of all archives under ``path``, plain or in gzip members.

    ``kind`` is ``record`` or ``gap``; ``start`` and ``end`` are bytes of the
    archive. A revisit's length and digest are those of the payload it refers
    to. An archive is read whole by one task (the sink keeps them small; Spark
    reads files of up to 2 GB so). An empty archive has no rows.
    """
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("file", pa.string()), ("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()),
                            ("record_type", pa.string()), ("page_id", pa.string()), ("url", pa.string()),
                            ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                            ("refers_to", pa.string()), ("payload", pa.binary())])
        for batch in batches:
            for i in range(batch.num_rows):
                name, held = batch.column(0)[i].as_py(), []
                for found in salvage(batch.column(1)[i].as_py() or b""):
                    held.append(_row(name, *found))
                    if len(held) == 256:
                        yield pa.RecordBatch.from_pylist(held, schema)
                        held = []
                if held:
                    yield pa.RecordBatch.from_pylist(held, schema)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select("path", "content").mapInArrow(read, _SCHEMA)


def gaps(found: DataFrame) -> DataFrame:
    """The log of quarantined bytes: file, start, end."""
    return found.where("kind = 'gap'").select("file", "start", "end")


def round_trip(pages: DataFrame, path: str, key: str = "page_id", **options) -> DataFrame:
    """Write ``pages`` to archives under ``path`` and read them back: one row per record."""
    kind = dict(pages.dtypes)[key]
    write_warc(pages, path, key, **options)
    found = read_warc(pages.sparkSession, path).where("kind = 'record'")
    return found.select(F.col("page_id").cast(kind).alias(key), "payload_bytes", "payload_digest", "record_type",
                        F.col("refers_to").cast(kind).alias("refers_to"))


ORACLE = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS hex FROM pages),
f AS (SELECT hex, min(page_id) AS first FROM p GROUP BY hex)
SELECT page_id, octet_length(encode(payload)) AS payload_bytes,
  (SELECT string_agg(substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
     ((('0x' || substr(p.hex, 5 * (g // 4) + 1, 5))::BIGINT >> (15 - 5 * (g % 4))) & 31)::INT + 1, 1), '' ORDER BY g)
   FROM range(32) t(g)) AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to
FROM p JOIN f USING (hex)
"""
