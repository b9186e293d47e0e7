"""Log files that grow: a stream source with byte offsets.

Spark's file source reads a file once, when it appears; a server appends to its log for
hours. This source (a Python stream data source, format ``growing_logs``) keeps how many
bytes of each file it has taken. A micro-batch takes what has been appended since, up to
the last line end, so a line that is being written waits for the next one. Appended parts
are cut into ranges of ``split_bytes`` for several tasks; a range yields the lines
that begin in it. Offsets are in the checkpoint: a restart neither repeats nor loses lines.

A file that became shorter was replaced and is read from its start. Files that are gone leave the offsets.
Only sizes, and the last bytes of files that grew, are looked at by the driver.
Any file system that ``pyarrow.fs`` can open will do, with the folder visible to all executors.
"""

from __future__ import annotations

import fnmatch
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

SPLIT_BYTES = 64 * 1024 * 1024
BLOCK = 1 << 20
SCHEMA = "value string, file_name string, position long"


def _open_fs(path: str):
    """The pyarrow file system of a path or URI, and the path in it."""
    from pyarrow import fs
    if "://" in path or path.startswith("file:"):
        return fs.FileSystem.from_uri("file://" + path[5:] if path.startswith("file:/") and not path.startswith("file://") else path)
    return fs.LocalFileSystem(), path


@dataclass
class Range(InputPartition):
    """Bytes ``begin`` to ``end`` of a file; ``first``: a line begins at ``begin``."""

    path: str
    begin: int
    end: int
    first: bool


def last_line_end(file, low: int, size: int) -> int:
    """The place behind the last line feed of bytes ``low`` to ``size``; ``low`` if there is none."""
    at = size
    while at > low:
        start = max(low, at - BLOCK)
        file.seek(start)
        found = file.read(at - start).rfind(b"\n")
        if found >= 0:
            return start + found + 1
        at = start
    return low


class GrowingFiles(DataSourceStreamReader):
    def __init__(self, path: str, glob: str, split_bytes: int):
        self.path, self.glob, self.split_bytes = path, glob, split_bytes
        self.last: dict[str, int] = {}

    def initialOffset(self) -> dict:
        return {"files": {}}

    def latestOffset(self, *args) -> dict:
        from pyarrow import fs as afs
        store, root = _open_fs(self.path)
        ends = {}
        for f in store.get_file_info(afs.FileSelector(root, recursive=True, allow_not_found=True)):
            if f.type != afs.FileType.File or not fnmatch.fnmatch(f.base_name, self.glob):
                continue
            known = self.last.get(f.path, 0)
            if f.size == known:
                ends[f.path] = known
                continue
            with store.open_input_file(f.path) as file:
                ends[f.path] = last_line_end(file, known if f.size > known else 0, f.size)
        self.last = ends
        return {"files": ends}

    def partitions(self, start: dict, end: dict) -> list[Range]:
        out = []
        for path, to in sorted(end["files"].items()):
            begin = start["files"].get(path, 0)
            begin = 0 if to < begin else begin
            for a in range(begin, to, self.split_bytes):
                out.append(Range(path, a, min(a + self.split_bytes, to), a == begin))
        return out or [Range("", 0, 0, True)]

    def read(self, partition: Range) -> Iterator:
        import pyarrow as pa
        if not partition.path:
            return
        store, _ = _open_fs(self.path)
        name = partition.path.rsplit("/", 1)[-1]
        with store.open_input_file(partition.path) as file:
            for lines, places in lines_of(file, partition):
                yield pa.RecordBatch.from_arrays([pa.array(lines, pa.string()), pa.array([name] * len(lines), pa.string()),
                                                  pa.array(places, pa.int64())], names=["value", "file_name", "position"])

    def commit(self, end: dict) -> None:
        pass


def text_of(raw: bytes) -> str:
    """A line's text: without the carriage return of a CR LF end; wrong UTF-8 becomes replacement characters, as in Spark's readers."""
    return raw.removesuffix(b"\r").decode("utf-8", "replace")


def lines_of(file, part: Range) -> Iterator[tuple[list[str], list[int]]]:
    """The lines that begin in a range, with their places, a block at a time. A line may end behind the range."""
    at = part.begin if part.first else part.begin - 1
    file.seek(at)
    rest, skip = b"", not part.first
    while True:
        block = file.read(BLOCK)
        if not block:
            break
        pieces = (rest + block).split(b"\n")
        rest = pieces.pop()
        lines, places = [], []
        for piece in pieces:
            if not skip and at < part.end:
                lines.append(text_of(piece))
                places.append(at)
            skip = False
            at += len(piece) + 1
        if lines:
            yield lines, places
        if at >= part.end:
            return


class GrowingLogs(DataSource):
    """Options: ``path``, ``glob`` (of file names), ``split_bytes``."""

    @classmethod
    def name(cls) -> str:
        return "growing_logs"

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> GrowingFiles:
        return GrowingFiles(self.options["path"], self.options.get("glob", "*"), int(self.options.get("split_bytes", SPLIT_BYTES)))


def growing_log_files(spark: SparkSession, path: str, glob: str = "*", split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Stream of (value, file_name, position): the complete lines of all matching files, as they are appended."""
    spark.dataSource.register(GrowingLogs)
    return (spark.readStream.format("growing_logs").option("path", path).option("glob", glob)
            .option("split_bytes", str(split_bytes)).load())
