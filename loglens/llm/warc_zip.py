"""WARC archives in ZIP packages: writer, directory reader and range reads.

A package is a ZIP file whose members are stored, not compressed:
``archive/data.warc.gz`` (WARC records, each its own gzip member) and
``indexes/index.cdxj`` (one line per record with its offset and length in the
archive). The reader takes a byte-range source, finds the end record, follows
the ZIP64 locator where there is one, parses the central directory and
locates the stored members' data; records are then read by range, nothing is
extracted.

Writers run in tasks and roll packages at ``PACKAGE_BYTES``. A task writes
under a name of its own and reports it only in its output rows, which Spark
commits once; the reader opens the reported packages alone, so packages of
failed or repeated attempts are never read. Reading is planned from the
indexes in ranges of about ``RANGE_BYTES``, which are dealt to all tasks.

Deduplication is by payload digest: the copy with the smallest page_id is
written as ``response``, the others as ``revisit`` records that name it.
Digests are pre-aggregated and joined back with a salt, so one payload on a
third of all pages is dealt to many tasks.

Defined results: null html is an empty payload; payloads shorter than
``min_bytes`` are all responses; repeated rows with the smallest page_id are
all responses; a row without a page_id revisits a copy that has one, copies
that all lack one are responses. Payloads over 2 GB do not fit Arrow's strings. Further columns are ignored. Empty in, empty out.
"""

from __future__ import annotations

import base64
import gzip
import io
import struct
import uuid
import zipfile
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loglens.llm.joins import salted_join
from loglens.session import scratch_path

PACKAGE_BYTES = 32 << 20
RANGE_BYTES = 1 << 20
ARCHIVE, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
Read = Callable[[int, int], bytes]  # (offset, length) -> bytes


# --- ZIP directories ------------------------------------------------------

# Signatures of the ZIP format.
LOCAL, CENTRAL, END, END64, LOCATOR64 = b"PK\x03\x04", b"PK\x01\x02", b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07"
_ALL32, _ALL16 = 0xFFFFFFFF, 0xFFFF


class ZipError(ValueError):
    pass


def _end_record(read: Read, size: int) -> tuple[int, int, int]:
    """(offset of the central directory, its length, its number of entries)."""
    tail_at = max(0, size - (22 + _ALL16 + 20))
    tail = read(tail_at, size - tail_at)
    at = tail.rfind(END)
    while at >= 0 and not (len(tail) - at >= 22 and at + 22 + struct.unpack_from("<H", tail, at + 20)[0] == len(tail)):
        at = tail.rfind(END, 0, at)
    if at < 0:
        raise ZipError("no end record")
    entries, length, offset = struct.unpack_from("<HII", tail, at + 10)
    if at >= 20 and tail[at - 20:at - 16] == LOCATOR64:
        end64 = read(struct.unpack_from("<Q", tail, at - 12)[0], 56)
        if end64[:4] != END64:
            raise ZipError("no ZIP64 end record where the locator points")
        entries, length, offset = struct.unpack_from("<QQQ", end64, 32)
    return offset, length, entries


def _zip64_fields(extra: bytes, size: int, packed: int, offset: int) -> tuple[int, int, int]:
    at = 0
    while at + 4 <= len(extra):
        kind, n = struct.unpack_from("<HH", extra, at)
        if kind == 1:
            values = iter(struct.unpack_from(f"<{n // 8}Q", extra, at + 4))
            size = next(values) if size == _ALL32 else size
            packed = next(values) if packed == _ALL32 else packed
            offset = next(values) if offset == _ALL32 else offset
            break
        at += 4 + n
    return size, packed, offset


def members(read: Read, size: int) -> dict[str, tuple[int, int]]:
    """Data offset and length of every stored member, from the central directory."""
    at, length, entries = _end_record(read, size)
    directory, found, p = read(at, length), {}, 0
    for _ in range(entries):
        if directory[p:p + 4] != CENTRAL:
            raise ZipError("broken central directory")
        method, = struct.unpack_from("<H", directory, p + 10)
        packed, full, n, m, k = struct.unpack_from("<IIHHH", directory, p + 20)
        offset, = struct.unpack_from("<I", directory, p + 42)
        name = directory[p + 46:p + 46 + n].decode()
        full, packed, offset = _zip64_fields(directory[p + 46 + n:p + 46 + n + m], full, packed, offset)
        p += 46 + n + m + k
        if method == 0:
            found[name] = (offset, packed)
    return found


def data_offset(read: Read, header: int) -> int:
    """Where a member's data begin, behind its local header."""
    local = read(header, 30)
    if local[:4] != LOCAL:
        raise ZipError("no local header")
    return header + 30 + sum(struct.unpack_from("<HH", local, 26))


# --- WARC records ---------------------------------------------------------

def payload_digest(payload: bytes) -> str:
    import hashlib
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id, url: str | None, payload: bytes, digest: str, refers_to=None, revisit: bool = False) -> bytes:
    """One WARC record as a gzip member. A revisit carries its payload's length and digest, not the payload."""
    body = b"" if revisit else payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <urn:page:{page_id}>",
            f"WARC-Target-URI: {' '.join((url or '').split())}", f"WARC-Payload-Digest: sha1:{digest}",
            f"X-Page: {'' if page_id is None else page_id}", f"X-Payload-Bytes: {len(payload)}"]
    if revisit:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 f"WARC-Refers-To: <urn:page:{refers_to}>"]
    head.append(f"Content-Length: {len(body)}")
    return gzip.compress("\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n", 1, mtime=0)


def parse_record(member: bytes) -> tuple[dict[str, str], bytes]:
    raw = zlib.decompress(member, 31)
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:])
    return fields, rest[:int(fields["Content-Length"])]


class PackageWriter:
    """Collects records and writes them as one ZIP package."""

    def __init__(self):
        self.data, self.index = io.BytesIO(), []

    def add(self, page_id, member: bytes) -> None:
        self.index.append(f"{'' if page_id is None else page_id} {self.data.tell()} {len(member)}\n")
        self.data.write(member)

    def package(self) -> bytes:
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as z:
            for name, content in ((ARCHIVE, self.data.getbuffer()), (INDEX, "".join(self.index).encode())):
                with z.open(zipfile.ZipInfo(name), "w", force_zip64=True) as f:
                    f.write(content)
        return out.getvalue()


# --- Spark ----------------------------------------------------------------

def classify(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """``pages`` (page_id, url, html) with ``first``, the smallest page_id with the
    same payload, and ``again``: whether the row is a revisit of it."""
    html = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select("page_id", "url", html.alias("html"), F.sha1(F.encode(html, "UTF-8")).alias("_sha1"),
                        F.octet_length(html).alias("_n"))
    first = rows.groupBy("_sha1").agg(F.min("page_id").alias("first"))
    again = (F.col("_n") >= min_bytes) & F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return salted_join(rows, first, "_sha1", ["page_id", "url"], "inner").select(
        "page_id", "url", "html", again.alias("again"), "first")


def write_packages(pages: DataFrame, folder: str, min_bytes: int = 0, package_bytes: int = PACKAGE_BYTES) -> DataFrame:
    """Write ``pages`` as packages below ``folder``; a row per package: path, bytes, records."""
    judged = classify(pages, min_bytes)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        target, base = pafs.FileSystem.from_uri(folder)
        target.create_dir(base, recursive=True)
        writer, done = PackageWriter(), []

        def roll() -> None:
            nonlocal writer
            if writer.index:
                path, content = f"{base}/{uuid.uuid4().hex}.wacz", writer.package()
                with target.open_output_stream(path) as f:
                    f.write(content)
                done.append((path, len(content), len(writer.index)))
            writer = PackageWriter()

        for batch in batches:
            columns = [batch.column(i) for i in range(5)]
            for i in range(batch.num_rows):
                page, url, html, again, first = (c[i].as_py() for c in columns)
                payload = html.encode()
                writer.add(page, record(page, url, payload, payload_digest(payload), first, again))
                if writer.data.tell() >= package_bytes:
                    roll()
        roll()
        yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.string()), pa.array([d[1] for d in done], pa.int64()),
                                          pa.array([d[2] for d in done], pa.int64())], names=["path", "bytes", "records"])

    return judged.mapInArrow(write, "path string, bytes long, records long")


def plan_ranges(packages: DataFrame, folder: str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Of written packages: rows (path, start, lengths) of consecutive records, about ``range_bytes`` each."""

    def plan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        source, _ = pafs.FileSystem.from_uri(folder)
        for batch in batches:
            for path, size in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                paths, starts, lengths = [], [], []
                with source.open_input_file(path) as f:
                    read: Read = lambda at, n, f=f: f.read_at(n, at)
                    found = members(read, size)
                    index_at, index_size = found[INDEX]
                    lines = read(data_offset(read, index_at), index_size).decode().splitlines()
                    base = data_offset(read, found[ARCHIVE][0])
                held, first = [], 0
                for line in lines:
                    _, offset, length = line.rsplit(" ", 2)
                    if not held:
                        first = base + int(offset)
                    held.append(int(length))
                    if sum(held) >= range_bytes:
                        paths, starts, lengths, held = [*paths, path], [*starts, first], [*lengths, held], []
                if held:
                    paths, starts, lengths = [*paths, path], [*starts, first], [*lengths, held]
                yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(starts, pa.int64()),
                                                  pa.array(lengths, pa.list_(pa.int64()))], names=["path", "start", "lengths"])

    return packages.select("path", "bytes").mapInArrow(plan, "path string, start long, lengths array<bigint>")


RECORD = ("page_id {}, url string, payload_bytes long, payload_digest string, stated_digest string, "
          "record_type string, refers_to {}, payload binary")


def read_records(ranges: DataFrame, folder: str, page_type: str = "bigint", with_payload: bool = False) -> DataFrame:
    """Range-read and parse the planned records. Length and digest of a response are those of the payload
    read back, of a revisit those it states."""
    number = page_type in ("bigint", "int", "smallint", "tinyint")
    kind = {"bigint": pa.int64(), "int": pa.int32(), "smallint": pa.int16(), "tinyint": pa.int8()}.get(page_type, pa.string())

    def of_page(text: str):
        return None if text in ("", "None") else int(text) if number else text

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        source, _ = pafs.FileSystem.from_uri(folder)
        for batch in batches:
            for path, start, lengths in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                with source.open_input_file(path) as f:
                    block = f.read_at(sum(lengths), start)
                rows, at = [], 0
                for n in lengths:
                    fields, body = parse_record(block[at:at + n])
                    at += n
                    stated = fields["WARC-Payload-Digest"].removeprefix("sha1:")
                    revisit = fields["WARC-Type"] == "revisit"
                    refers = fields["WARC-Refers-To"].removeprefix("<urn:page:").removesuffix(">") if revisit else ""
                    rows.append((of_page(fields["X-Page"]), fields["WARC-Target-URI"],
                                 int(fields["X-Payload-Bytes"]) if revisit else len(body),
                                 stated if revisit else payload_digest(body), stated, fields["WARC-Type"],
                                 of_page(refers), body if with_payload else None))
                types = (kind, pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), kind, pa.binary())
                names = [x.split()[0] for x in RECORD.split(", ")]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)

    return ranges.mapInArrow(run, RECORD.format(*[page_type if number else "string"] * 2))


def op4_warc_zip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write all pages into ZIP-packaged WARC archives, then read every record back by range."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    folder = scratch_path(spark, "warc")
    listing = scratch_path(spark, "warc-packages")
    write_packages(pages, folder).write.parquet(listing)
    ranges = plan_ranges(spark.read.parquet(listing), folder)
    dealt = ranges.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))
    return read_records(dealt, folder, pages.schema["page_id"].dataType.simpleString()).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


_B32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

ORACLE = f"""
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages),
b AS (SELECT hex, string_agg(substr('{_B32}', 1 + (v // CAST(pow(32, 7 - j) AS BIGINT)) % 32, 1), '' ORDER BY g, j) AS payload_digest
  FROM (SELECT DISTINCT hex, g, ('0x' || substr(hex, 1 + 10 * g, 10))::BIGINT AS v FROM p, range(4) t(g)), range(8) u(j) GROUP BY hex),
f AS (SELECT hex, min(page_id) AS first FROM p GROUP BY hex)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to
FROM p JOIN b USING (hex) JOIN f USING (hex)
"""

QUERIES = {"op4_warc_zip": op4_warc_zip}
ORACLES = {"op4_warc_zip": ORACLE}
