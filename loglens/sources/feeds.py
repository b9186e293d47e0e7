"""Materialised log feeds: the Kafka-topic stand-in for the registered queries.

The feed derived from ``events`` is written once per (tables, kind,
variant) as a date-partitioned envelope table in the shared folder and
read back like a topic or a raw-log lake. Downstream parsing then works on
a stored ``value`` column exactly as it would in production.
"""

from __future__ import annotations

import hashlib
import inspect
import os
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loglens.session import configure, shared_root
from loglens.sources import kafka, recipe


def _fs(spark: SparkSession, path: str):
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def _source_files(spark: SparkSession, source: str) -> list[tuple[str, int, int]]:
    """(path, bytes, time) of the files that Spark reads for ``source``, which may be whatever its
    reader takes: a file, a folder, a pattern over several."""
    # Any schema will do, and with one no file is opened.
    paths = set(spark.read.schema("event_id long").parquet(source).inputFiles())
    out = []
    for folder in sorted({path.rsplit("/", 1)[0] for path in paths}):
        p = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(folder))
        for st in p.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(p):
            name = st.getPath().toUri().toString()
            if name in paths:
                out.append((name, st.getLen(), st.getModificationTime()))
    return sorted(out)


def _fingerprint(spark: SparkSession, sf_dir: str) -> str:
    """Identity of a feed: the recipe that derives it, and the place, sizes and
    times of all files of the source table."""
    where = sf_dir if "://" in sf_dir else os.path.abspath(sf_dir)
    mark = hashlib.sha1(f"{where}|{inspect.getsource(recipe)}|{inspect.getsource(kafka)}".encode())
    files = _source_files(spark, f"{sf_dir.rstrip('/')}/events.parquet")
    mark.update("\n".join(f"{name}|{size}|{time}" for name, size, time in files).encode())
    return mark.hexdigest()[:16]


def _published(spark: SparkSession, base: str) -> str | None:
    """The first complete copy below ``base``; every reader picks the same one."""
    fs, p = _fs(spark, base)
    if not fs.exists(p):
        return None
    names = sorted(st.getPath().getName() for st in fs.listStatus(p) if st.isDirectory())
    return next((f"{base}/{n}" for n in names if path_exists(spark, f"{base}/{n}/_SUCCESS")), None)


def _once(spark: SparkSession, base: str, write: Callable[[str], None]) -> str:
    """Path of the table ``base``, written by ``write(path)`` unless it is there.

    Each writer has a folder of its own, complete when its ``_SUCCESS`` file is
    there: Spark's, or one put there after the write where the session's committer
    leaves none. Nothing is moved, so writers that run at the same
    time cannot disturb each other; readers use the first complete copy."""
    found = _published(spark, base)
    if found is None:
        path = f"{base}/{uuid.uuid4().hex[:12]}"
        write(path)
        if not path_exists(spark, f"{path}/_SUCCESS"):
            fs, done = _fs(spark, f"{path}/_SUCCESS")
            fs.create(done).close()
        found = _published(spark, base)
    if found is None:
        raise RuntimeError(f"could not write {base}")
    return found


# Target bytes of source data per write task.
WRITE_BYTES_PER_TASK = 256 * 1024 * 1024


def write_partitions(spark: SparkSession, source: str) -> int:
    """Write parallelism: the cluster's parallelism, more for a big input."""
    size = sum(length for _, length, _ in _source_files(spark, source))
    return max(spark.sparkContext.defaultParallelism, -(-size // WRITE_BYTES_PER_TASK))


def with_date(envelope: DataFrame) -> DataFrame:
    return envelope.withColumn("date", F.to_date(F.col("timestamp")))


def feed_path(spark: SparkSession, sf_dir: str, kind: str = "access", variant: str = "plain") -> str:
    """Write the feed if absent; return its path. Safe to call repeatedly."""
    configure(spark)

    def write(path: str) -> None:
        env = (recipe.access_envelope(spark, sf_dir, variant) if kind == "access"
               else recipe.json_envelope(spark, sf_dir, variant))
        # Range-partition on the record time: tasks get balanced, contiguous
        # slices (sampled bounds, so a hot day is split across tasks rather than
        # landing on one), and each task writes one or two date folders instead
        # of one small file per (task, date).
        n = write_partitions(spark, f"{sf_dir.rstrip('/')}/events.parquet")
        with_date(env).repartitionByRange(n, "timestamp", "offset") \
            .sortWithinPartitions("timestamp", "offset") \
            .write.mode("overwrite").option("compression", "zstd") \
            .partitionBy("date").parquet(path)

    return _once(spark, f"{shared_root(spark)}/feeds/{kind}-{variant}-{_fingerprint(spark, sf_dir)}", write)


def feed(spark: SparkSession, sf_dir: str, kind: str = "access", variant: str = "plain") -> DataFrame:
    """The feed as an envelope DataFrame (``date`` partition column included)."""
    return kafka.envelope_batch(spark, feed_path(spark, sf_dir, kind, variant))


SLICES = 3
SLICE_FILES = 4


def slices_path(spark: SparkSession, sf_dir: str, variant: str = "plain") -> str:
    """The access feed as a topic's backlog: ``SLICES`` slices in time order, written one after the other in
    ``SLICE_FILES`` files each. A file stream takes files by their age, so with that many files per
    trigger each slice is one micro-batch."""
    configure(spark)

    def write(path: str) -> None:
        records = feed(spark, sf_dir, "access", variant)
        seconds = F.unix_micros("timestamp").cast("double")
        cuts = records.select(seconds.alias("s")).approxQuantile("s", [i / SLICES for i in range(1, SLICES)], 0.001)
        bounds = [float("-inf"), *sorted(set(cuts)), float("inf")]
        for low, high in zip(bounds[:-1], bounds[1:], strict=True):
            records.where((seconds > low) & (seconds <= high)).drop("date").repartition(SLICE_FILES) \
                .write.mode("append").parquet(f"{path}/topic")

    return _once(spark, f"{shared_root(spark)}/feeds/slices-{variant}-{_fingerprint(spark, sf_dir)}", write) + "/topic"


def text_feed_path(spark: SparkSession, sf_dir: str, variant: str = "plain",
                   compression: str = "gzip") -> str:
    """The access feed as text log files; written once, then reused."""
    configure(spark)

    def write(path: str) -> None:
        lines = feed(spark, sf_dir, "access", variant)
        lines.select(F.col("value").cast("string").alias("value")) \
            .write.mode("overwrite").option("compression", compression).text(path)

    return _once(spark, f"{shared_root(spark)}/feeds/text-{compression}-{variant}-{_fingerprint(spark, sf_dir)}", write)


def parsed_lake_path(spark: SparkSession, sf_dir: str, variant: str = "plain") -> str:
    """The access feed parsed once and stored as a date-partitioned lake."""
    from loglens.operators import parse
    from loglens.streaming import sinks
    configure(spark)

    def write(path: str) -> None:
        src = feed_path(spark, sf_dir, "access", variant)
        sinks.write_lake(parse.decode(kafka.envelope_batch(spark, src)), path,
                         write_partitions(spark, f"{sf_dir.rstrip('/')}/events.parquet"),
                         transform=lambda raw: parse.parse_access(raw, keep=("offset", "timestamp")))

    return _once(spark, f"{shared_root(spark)}/lakes/access-{variant}-{_fingerprint(spark, sf_dir)}", write)


def search_index_path(spark: SparkSession, lake: str) -> str:
    """Where the n-gram index of a stored lake is kept."""
    return f"{shared_root(spark)}/indexes/{'-'.join(lake.rstrip('/').split('/')[-2:])}"
