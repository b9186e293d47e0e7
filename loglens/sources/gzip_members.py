"""Large gzip logs read by many tasks, at the starts of their members.

A gzip file is a sequence of members (log rotation, ``cat a.gz b.gz`` and block-wise writers make
many), each of which can be read on its own, but Spark reads a ``.gz`` file in one
task. Here a file is cut into byte ranges; a task looks for the first member
that starts in its range, and reads on member by member.

A start is a gzip header at which a whole member can be decompressed, with the
right checksum and length at its end; bytes that look like a header inside compressed data fail
that test. The test costs one more pass over the first member of each range; the
members behind it start where the one before ends. A line may run over several members: a task
leaves what comes before its first line feed to the task before, and reads on behind its range to
the end of its last line. Lines equal those of the plain reader.

A broken file fails the job, as it fails the plain reader: a task also checks the member that it ends before. (A whole
gzip member stored uncompressed in another one would be taken for a start; text logs hold none.)

A file of one member has one start, so it is still read by one task (``log_files``'s
``min_partitions`` spreads its lines); writers can use members of some MB to avoid that.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loglens.sources.tail import BLOCK, _open_fs, text_of

SPLIT_BYTES = 32 * 1024 * 1024
READ = 1 << 16
# Fixed values of the format: the magic number with the deflate method, and the flag bits that must be 0.
MAGIC = b"\x1f\x8b\x08"
RESERVED = 0xE0


def member(file, at: int) -> Iterator[bytes | int]:
    """The decompressed blocks of the member at byte ``at``, then the place behind it. Raises ``zlib.error`` if there is none."""
    inflate = zlib.decompressobj(wbits=31)   # checks header, checksum and length
    file.seek(at)
    while not inflate.eof:
        block = file.read(READ)
        if not block:
            raise zlib.error("the file ends in a member")
        at += len(block)
        yield inflate.decompress(block)
    yield at - len(inflate.unused_data)


def is_member(file, at: int) -> bool:
    try:
        for _ in member(file, at):
            pass
        return True
    except zlib.error:
        return False


def first_member(file, begin: int, end: int) -> int | None:
    """The first place of [begin, end) where a member starts."""
    at = begin
    while at < end:
        file.seek(at)
        block = file.read(min(BLOCK, end - at) + 3)
        found = block.find(MAGIC)
        while found >= 0 and at + found < end:
            if found + 3 < len(block) and not block[found + 3] & RESERVED and is_member(file, at + found):
                return at + found
            found = block.find(MAGIC, found + 1)
        at += BLOCK
    return None


def range_lines(file, size: int, begin: int, end: int) -> Iterator[list[str]]:
    """The lines that belong to the members starting in [begin, end): all that begin behind their first line feed
    (for the file's first member: at its start), the last one to its end."""
    at = first_member(file, begin, end) if begin else 0
    if at is None or size == 0:
        return
    rest, skip = b"", begin > 0
    while at < size:
        closing = at >= end               # only the end of the last line is wanted from here on
        if closing and not is_member(file, at):
            # The next range would not find its start and leave its lines out.
            raise zlib.error(f"no member at byte {at}")
        for block in member(file, at):
            if isinstance(block, int):
                at = block
                break
            if closing and b"\n" in block:
                if not skip:
                    yield [text_of(rest + block[:block.index(b"\n")])]
                return
            pieces = (rest + block).split(b"\n")
            rest = pieces.pop()
            if skip and pieces:
                pieces, skip = pieces[1:], False
            if pieces:
                yield [text_of(p) for p in pieces]
    if rest and not skip:
        yield [text_of(rest)]             # the file ends without a line feed


def gzip_files(spark: SparkSession, path: str, glob: str) -> DataFrame:
    """(path, size) of matching files; names only, no content is read."""
    return (spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(path)
            .select("path", F.col("length").alias("size")))


def gzip_log_lines(spark: SparkSession, path: str, glob: str = "*.gz", split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """(value, file_name) of all lines of the gzip files below ``path``, each file read by as many tasks as it has ranges
    of ``split_bytes`` (of compressed data) in which members start."""
    ranges = gzip_files(spark, path, glob).select("path", "size", F.explode(F.sequence(
        F.lit(0).cast("long"), F.greatest(F.col("size") - 1, F.lit(0)), F.lit(split_bytes).cast("long"))).alias("begin"))
    # As many ranges a task as a scan's splits would give; dealt round-robin, as neighbours cost alike.
    width = max(1, ranges.count())
    dealt = ranges.repartition(min(width, 100_000))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for where, size, begin in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                store, name = _open_fs(where)
                with store.open_input_file(name) as file:
                    for lines in range_lines(file, size, begin, min(begin + split_bytes, size)):
                        yield pa.RecordBatch.from_arrays([pa.array(lines, pa.string()), pa.array([name.rsplit("/", 1)[-1]] * len(lines), pa.string())],
                                                         names=["value", "file_name"])

    return dealt.mapInArrow(run, "value string, file_name string")
