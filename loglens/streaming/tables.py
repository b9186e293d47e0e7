"""Tables that a stream writes batch by batch, with a manifest and levelled compaction.

A table is a folder of Parquet parts and a manifest, which lists the parts that
count. A version of the manifest is one small file, ``_manifest/<n>.json``, put
there by an operation that fails if the file exists (a hard link on a local file
system, a rename without overwriting elsewhere). A writer that loses the race
reads the new version and tries again, so batches and compactions may commit at
the same time, and a reader sees one version: all of a commit or nothing of it,
whatever folders are being written. Nothing is found by listing folders.

* ``write_batch`` writes a micro-batch to its own folder and adds it at level 0. A
  replay overwrites the folder of a batch that was not committed and writes nothing otherwise.
* ``compact`` merges all level-0 parts into one level-1 part per day; as soon as a
  day has ``fanout`` parts of one level, these become one part of the next level.
  Days that get no new rows are not read. A row is rewritten once per level, of
  which there are log(parts) to the base ``fanout``: bytes rewritten follow what is
  new, not what is stored, and a day keeps fewer than ``fanout`` parts a level.
* Merged parts are written in files of about ``target_bytes``, range-partitioned
  and sorted by the day and the ``cluster`` columns, so row-group statistics
  prune searches on them and a day that holds most rows is many tasks' work.
* ``vacuum`` deletes parts that only older versions name, and those versions.

The driver handles names and sizes of parts, as Spark does; never rows.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark import SparkContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

FANOUT = 4
TARGET_BYTES = 256 * 1024 * 1024
MERGED = "merged"
MANIFEST = "_manifest"
DAY = "_day"

Merge = Callable[[DataFrame], DataFrame]


class _Store:
    """The few file-system calls that a manifest needs, on any Hadoop file system."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm = spark._jvm
        self.conf = spark._jsc.hadoopConfiguration()
        self.root = self.at(path)
        self.fs = self.root.getFileSystem(self.conf)
        self.path = path

    def at(self, path: str):
        return self.jvm.org.apache.hadoop.fs.Path(path)

    def names(self, folder: str) -> list[str]:
        p = self.at(folder)
        return [s.getPath().getName() for s in self.fs.listStatus(p)] if self.fs.exists(p) else []

    def read(self, path: str) -> str:
        stream = self.fs.open(self.at(path))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, path: str, text: str) -> bool:
        """Put a whole file at ``path``; False if there is one already."""
        folder, name = path.rsplit("/", 1)
        tmp = f"{folder}/.{name}.{uuid.uuid4().hex}"
        out = self.fs.create(self.at(tmp), True)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()
        try:
            if self.fs.getUri().getScheme() == "file":
                local = lambda p: self.jvm.java.nio.file.Path.of(self.at(p).toUri().getPath(), self._none(self.jvm.String))
                self.jvm.java.nio.file.Files.createLink(local(path), local(tmp))
            else:
                context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.root.toUri(), self.conf)
                context.rename(self.at(tmp), self.at(path), self._none(self.jvm.org.apache.hadoop.fs.Options.Rename))
            return True
        except Py4JJavaError as e:
            if "AlreadyExists" in e.java_exception.getClass().getSimpleName():
                return False
            raise
        finally:
            self.fs.delete(self.at(tmp), False)

    def _none(self, kind):
        """An empty array, for variable arguments."""
        return SparkContext._gateway.new_array(kind, 0)

    def size(self, path: str) -> tuple[int, int]:
        """Bytes and data files below a folder."""
        summary = self.fs.getContentSummary(self.at(path))
        files, it = 0, self.fs.listFiles(self.at(path), True)
        while it.hasNext():
            files += it.next().getPath().getName().endswith(".parquet")
        return summary.getLength(), files

    def delete(self, path: str) -> None:
        self.fs.delete(self.at(path), True)


def _versions(store: _Store) -> list[int]:
    return sorted(int(n[:-5]) for n in store.names(f"{store.path}/{MANIFEST}") if n.endswith(".json") and n[:-5].isdigit())


def is_managed(spark: SparkSession, path: str) -> bool:
    """Whether the folder has a manifest."""
    return bool(_versions(_Store(spark, path)))


def manifest(spark: SparkSession, path: str) -> dict:
    """The newest version: its number, its ``parts``, and ``upto``, the newest batch that a compaction holds."""
    store = _Store(spark, path)
    known = _versions(store)
    if not known:
        return {"version": -1, "parts": [], "upto": -1}
    return json.loads(store.read(f"{path}/{MANIFEST}/{known[-1]:020d}.json")) | {"version": known[-1]}


def commit(spark: SparkSession, path: str, change: Callable[[dict], dict | None]) -> dict | None:
    """Apply ``change`` to the newest version and publish the result as the next one, again and
    again until no other commit comes between. ``change`` returns None to leave everything as it is."""
    store = _Store(spark, path)
    store.fs.mkdirs(store.at(f"{path}/{MANIFEST}"))
    while True:
        now = manifest(spark, path)
        new = change(now)
        if new is None:
            return None
        text = json.dumps({k: v for k, v in new.items() if k != "version"})
        if store.create(f"{path}/{MANIFEST}/{now['version'] + 1:020d}.json", text):
            return new


def _part(store: _Store, name: str, level: int, first: int, last: int, day: str | None) -> dict:
    size, files = store.size(f"{store.path}/{name}")
    return {"name": name, "level": level, "first": first, "last": last, "day": day, "bytes": size, "files": files}


# Notes of so many batches stay in the manifest.
NOTES = 100


def note(spark: SparkSession, path: str, batch_id: int | None = None) -> int | None:
    """The note that the newest batch (up to ``batch_id``) left, if any."""
    notes = {int(k): v for k, v in manifest(spark, path).get("notes", {}).items() if batch_id is None or int(k) <= batch_id}
    return notes[max(notes)] if notes else None


def write_batch(batch: DataFrame, path: str, batch_id: int, partition: str | None = None, options: dict[str, str] | None = None,
                note: int | None = None) -> None:
    """One micro-batch as a level-0 part ``batch_id=N`` (with ``partition`` folders inside); safe to repeat.

    ``note`` is a number that a later batch wants to know, such as the largest time stamp so far.

    A part in the manifest is never written again: a replay of a batch whose commit succeeded finds
    it there, or in a compaction, and writes nothing. It runs all the same, as a stateful query's
    state comes forward by running its batches."""
    spark, name = batch.sparkSession, f"batch_id={batch_id}"
    now = manifest(spark, path)
    if batch_id <= now["upto"] or any(p["name"] == name for p in now["parts"]):
        batch.write.format("noop").mode("overwrite").save()
        return
    w = batch.write.mode("overwrite").options(**(options or {}))
    (w.partitionBy(partition) if partition else w).parquet(f"{path}/{name}")
    part = _part(_Store(spark, path), name, 0, batch_id, batch_id, None)


    def add(now: dict) -> dict:
        new = now | {"parts": [*now["parts"], part]}
        if note is not None:
            notes = now.get("notes", {}) | {str(batch_id): note}
            new["notes"] = {k: notes[k] for k in sorted(notes, key=int)[-NOTES:]}
        return new

    commit(spark, path, add)


def _read_parts(spark: SparkSession, path: str, names: list[str], add: tuple[Column, ...] = ()) -> DataFrame | None:
    """All rows below ``names`` (parts, or files of parts), with ``batch_id`` and the columns ``add`` of each scan."""
    new = [f"{path}/{n}" for n in names if not n.startswith(f"{MERGED}/")]
    old = [f"{path}/{n}" for n in names if n.startswith(f"{MERGED}/")]
    out = None
    if old:
        out = spark.read.option("basePath", f"{path}/{MERGED}").parquet(*old).select("*", *add).drop("run", DAY)
    if new:
        rows = spark.read.option("basePath", path).parquet(*new).select("*", *add).withColumn("batch_id", F.col("batch_id").cast("bigint"))
        out = rows if out is None else out.unionByName(rows)
    return out


def read(spark: SparkSession, path: str, files: list[str] | None = None, add: tuple[Column, ...] = ()) -> DataFrame:
    """All rows of the newest version, with ``batch_id``; only those of ``files`` (full names), if given.
    ``add`` are columns that only a scan knows, such as the file name."""
    names = [p["name"] for p in manifest(spark, path)["parts"]]
    if files is not None:
        plain = _Store(spark, path).root.toUri().getPath().rstrip("/")
        names = [unquote(f).split(f"{plain}/", 1)[1] for f in files]
    out = _read_parts(spark, path, names, add)
    if out is None and files is not None:
        return read(spark, path, add=add).where(F.lit(False))
    if out is None:
        raise FileNotFoundError(f"no complete batch in {path}")
    return out


def part_paths(spark: SparkSession, path: str) -> list[str]:
    """The folders that the newest version names."""
    return [f"{path}/{p['name']}" for p in manifest(spark, path)["parts"]]


def _merged(spark: SparkSession, path: str, parts: list[dict], level: int, day: Column, merge: Merge | None,
            cluster: list[str], target_bytes: int) -> list[dict]:
    """``parts`` written as one part per day, not yet in the manifest."""
    store = _Store(spark, path)
    rows = _read_parts(spark, path, [p["name"] for p in parts])
    rows = (merge(rows) if merge else rows).withColumn(DAY, day)
    total = sum(p["bytes"] for p in parts)
    days = len({p["day"] for p in parts}) if level > 1 else 1
    width = max(1, days, -(-total // target_bytes))
    order = [DAY, *cluster]
    # Rows alike in the sort columns (one endpoint on one day) are still split, by a hash of the whole row.
    tie = F.xxhash64(*[c for c in rows.columns if c != DAY])
    dealt = rows.withColumn("_tie", tie).repartitionByRange(width, *order, "_tie").drop("_tie") if width > 1 else rows.coalesce(1)
    run = f"{MERGED}/run=r{uuid.uuid4().hex[:12]}"
    dealt.sortWithinPartitions(*order).write.option("compression", "zstd").partitionBy(DAY).parquet(f"{path}/{run}")
    first, last = min(p["first"] for p in parts), max(p["last"] for p in parts)
    return [_part(store, f"{run}/{n}", level, first, last, n.split("=", 1)[1])
            for n in store.names(f"{path}/{run}") if n.startswith(f"{DAY}=")]


def _swap(spark: SparkSession, path: str, old: list[dict], new: list[dict]) -> dict | None:
    """Commit ``new`` in place of ``old``; None, and ``new`` deleted, if another compaction was faster."""
    gone = {p["name"] for p in old}

    def change(now: dict) -> dict | None:
        if not gone <= {p["name"] for p in now["parts"]}:
            return None
        return now | {"parts": [p for p in now["parts"] if p["name"] not in gone] + new,
                      "upto": max(now["upto"], *(p["last"] for p in old))}

    done = commit(spark, path, change)
    if done is None:
        store = _Store(spark, path)
        for p in new:
            store.delete(f"{path}/{p['name']}")
    return done


def compact(spark: SparkSession, path: str, day: Column, merge: Merge | None = None, cluster: tuple[str, ...] = (),
            fanout: int = FANOUT, target_bytes: int = TARGET_BYTES, max_batch_id: int | None = None) -> int | None:
    """Fold the batches up to ``max_batch_id`` (default: all) into the levels. Returns the newest
    batch folded, or None if there was nothing to do.

    ``day`` is the date of a row; ``merge`` maps rows with ``batch_id`` to fewer rows with the same columns, such
    that merging merged rows gives the same (newest version, sums); without it all rows stay."""
    parts = [p for p in manifest(spark, path)["parts"] if p["level"] == 0 and (max_batch_id is None or p["last"] <= max_batch_id)]
    if not parts:
        return None
    args = (day, merge, list(cluster), target_bytes)
    if _swap(spark, path, parts, _merged(spark, path, parts, 1, *args)) is None:
        return None
    level = 1
    while True:
        known = [p for p in manifest(spark, path)["parts"] if p["level"] >= level]
        if not known:
            break
        by_day: dict[str, list[dict]] = {}
        for p in known:
            if p["level"] == level:
                by_day.setdefault(p["day"], []).append(p)
        due = [p for group in by_day.values() if len(group) >= fanout for p in group]
        if due:
            _swap(spark, path, due, _merged(spark, path, due, level + 1, *args))
        level += 1
    return max(p["last"] for p in parts)


def vacuum(spark: SparkSession, path: str, keep: int = 1) -> int:
    """Delete the parts that none of the newest ``keep`` versions names, and the older versions; the number
    of parts deleted. Run it when no reader of those versions is left. Parts not committed yet are not touched."""
    store = _Store(spark, path)
    known = _versions(store)
    named = lambda v: {p["name"] for p in json.loads(store.read(f"{path}/{MANIFEST}/{v:020d}.json"))["parts"]}
    kept = set().union(*[named(v) for v in known[-keep:]]) if known else set()
    gone = set().union(*[named(v) for v in known[:-keep]]) - kept if known[:-keep] else set()
    for name in sorted(gone):
        store.delete(f"{path}/{name}")
    for v in known[:-keep]:
        store.delete(f"{path}/{MANIFEST}/{v:020d}.json")
    return len(gone)
