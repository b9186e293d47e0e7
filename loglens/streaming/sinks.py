"""Sinks for parsed records, alerts and window metrics.

All writers work on streaming DataFrames (``writeStream``) and take an
explicit checkpoint location: a restarted query resumes from its committed
offsets instead of replaying the topic and double counting.

* ``console``        debugging output (append or update).
* ``raw_lake``       date-partitioned Parquet lake of parsed records.
* ``document_sink``  search-index sink; ``{date}`` in the resource routes each
                     record to a per-day index (or a per-day folder for the
                     Parquet fallback). Idempotent per micro-batch.
* ``upsert_metrics`` update-mode window metrics written as an append-only log
                     of changed rows, tagged with the batch id; readers take
                     the last version per window (``read_upserts``). A managed
                     table (``streaming.tables``): manifest, levelled compaction.
* ``publish_lines``  text lines -> Kafka topic (or an envelope table).
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from loglens.sources.kafka import LAKE_SCHEMA
from loglens.streaming import tables

ES_FORMAT = "org.elasticsearch.spark.sql"
# Parquet codec for stored logs: zstd compresses log text far better than the
# snappy default, so scans of a large lake read fewer bytes.
LAKE_COMPRESSION = "zstd"


def _writer(df: DataFrame, mode: str, checkpoint: str | None, trigger: dict | None,
            name: str | None):
    w = df.writeStream.outputMode(mode)
    if checkpoint:
        w = w.option("checkpointLocation", checkpoint)
    if trigger:
        w = w.trigger(**trigger)
    if name:
        w = w.queryName(name)
    return w


def console(df: DataFrame, mode: str = "append", checkpoint: str | None = None,
            trigger: dict | None = None, num_rows: int = 20) -> StreamingQuery:
    """Print each micro-batch untruncated (``update`` for aggregates). A display:
    of a larger batch only the first ``num_rows`` rows are shown."""
    return (_writer(df, mode, checkpoint, trigger, None).format("console")
            .option("truncate", "false").option("numRows", str(num_rows)).start())


def memory(df: DataFrame, name: str, mode: str = "append", trigger: dict | None = None,
           checkpoint: str | None = None) -> StreamingQuery:
    """In-memory table ``name`` (tests and small interactive checks only)."""
    return _writer(df, mode, checkpoint, trigger, name).format("memory").start()


def raw_lake(parsed: DataFrame, path: str, checkpoint: str, trigger: dict | None = None,
             time_col: str = "timestamp", files_per_batch: int | None = None) -> StreamingQuery:
    """Append parsed records to a Parquet lake partitioned by UTC ``date``.

    The file sink commits through its own metadata log, so a restarted
    query neither loses nor duplicates a batch; readers going through the
    log (``spark.read.parquet(path)``) see only committed files.

    Each input task writes its own file per date, so a batch read from many
    Kafka partitions yields many small files. ``files_per_batch`` trades
    one round-robin shuffle of the batch (balanced whatever the key
    distribution) for that many writer tasks.
    """
    out = parsed.withColumn("date", F.to_date(F.col(time_col)))
    if files_per_batch:
        out = out.repartition(files_per_batch)
    return (_writer(out, "append", checkpoint, trigger, None).format("parquet")
            .option("compression", LAKE_COMPRESSION)
            .partitionBy("date").option("path", path).start())


def read_lake(spark: SparkSession, path: str) -> DataFrame:
    """The records of a raw lake, also of one that ``start_shared_scan_job`` writes and compacts."""
    return tables.read(spark, path).drop("batch_id") if tables.is_managed(spark, path) else spark.read.parquet(path)


def compact_lake(spark: SparkSession, path: str, max_batch_id: int | None = None, target_bytes: int = tables.TARGET_BYTES) -> int | None:
    """Merge the small files of a managed raw lake, per date by levels, clustered by endpoint and time
    within a date, so that searches and endpoint reports prune row groups."""
    rows = tables.read(spark, path)
    cluster = [c for c in ("request", "timestamp") if c in rows.columns]
    return tables.compact(spark, path, F.col("date"), None, tuple(cluster), target_bytes=target_bytes, max_batch_id=max_batch_id)


def write_lake(records: DataFrame, path: str, partitions: int | None = None,
               time_col: str = "timestamp", mode: str = "overwrite", tie: str = "offset",
               transform: Callable[[DataFrame], DataFrame] | None = None) -> None:
    """Batch write of records as a date-partitioned Parquet lake.

    Range-partitioned on the record time and ``tie`` (sampled bounds): tasks
    are balanced even when one day, or one time stamp, dominates, and each
    writes one or two date folders. ``transform`` (the parse) runs behind the
    exchange, so the sampling pass reads raw records only. Rows are sorted by
    time inside each task, so row-group min/max statistics let time-range
    searches skip row groups within a day; zstd keeps log text small on disk.
    """
    n = partitions or records.sparkSession.sparkContext.defaultParallelism
    dealt = records.repartitionByRange(n, time_col, tie)
    (transform(dealt) if transform else dealt) \
        .withColumn("date", F.to_date(F.col(time_col))) \
        .sortWithinPartitions(time_col) \
        .write.mode(mode).option("compression", LAKE_COMPRESSION) \
        .partitionBy("date").parquet(path)


def parquet_append(df: DataFrame, path: str, checkpoint: str,
                   trigger: dict | None = None) -> StreamingQuery:
    """Append-mode Parquet file sink (exactly-once via the sink log)."""
    return (_writer(df, "append", checkpoint, trigger, None).format("parquet")
            .option("path", path).start())


def _batch_writer(fmt: str, target: str, options: dict[str, str], date_col: str | None,
                  mode: str) -> Callable[[DataFrame, int], None]:
    def write(batch: DataFrame, batch_id: int) -> None:
        if fmt == "parquet":
            # Overwriting this batch's own folder makes a replayed batch
            # (after a failure between write and commit) idempotent.
            w = batch.write.mode("overwrite")
            if date_col:
                w = w.partitionBy(date_col)
            w.parquet(f"{target}/batch_id={batch_id}")
        else:
            w = batch.write.format(fmt).mode(mode)
            for k, v in options.items():
                w = w.option(k, v)
            w.save(target)
    return write


def document_sink(records: DataFrame, resource: str, checkpoint: str,
                  fmt: str = "parquet", options: dict[str, str] | None = None,
                  time_col: str | list[str] | None = None, trigger: dict | None = None,
                  id_cols: tuple[str, ...] | None = None) -> StreamingQuery:
    """Append records to a document store, one micro-batch at a time.

    ``fmt="org.elasticsearch.spark.sql"`` writes to Elasticsearch with
    ``resource`` as ``es.resource`` - a ``{date}`` placeholder there is
    resolved per document by the connector from the ``date`` field.
    ``id_cols`` builds a ``doc_id`` used as ``es.mapping.id`` for idempotent
    re-delivery. With the default Parquet fallback ``resource`` is a base
    path, ``{date}`` becomes a ``date=`` folder level and each micro-batch
    overwrites its own ``batch_id=N`` folder (idempotent on replay).
    """
    opts = dict(options or {})
    routed = "{date}" in resource
    df = records
    if id_cols:
        # A stable document id (e.g. Kafka topic/partition/offset) makes a
        # re-delivered micro-batch overwrite its documents instead of
        # duplicating them.
        df = df.withColumn("doc_id", F.concat_ws("-", *[F.col(c).cast("string") for c in id_cols]))
        if fmt == ES_FORMAT:
            opts.setdefault("es.mapping.id", "doc_id")
    if routed:
        # The first of the time columns that has a value; a record never lacks a date.
        times = [time_col] if isinstance(time_col, str) else list(time_col or [])
        src = F.coalesce(*[F.col(c) for c in times], F.current_timestamp())
        df = df.withColumn("date", F.date_format(src, "yyyy.MM.dd" if fmt == ES_FORMAT
                                                  else "yyyy-MM-dd"))
    if fmt == ES_FORMAT:
        opts.setdefault("es.resource", resource)
        target = resource
    else:
        target = resource.replace("_{date}", "").replace("{date}", "")
    return (_writer(df, "append", checkpoint, trigger, None)
            .foreachBatch(_batch_writer(fmt, target, opts, "date" if routed and fmt != ES_FORMAT
                                        else None, "append"))
            .start())


def upsert_metrics(metrics: DataFrame, path: str, checkpoint: str, key: str = "window_start",
                   fmt: str = "parquet", options: dict[str, str] | None = None,
                   trigger: dict | None = None, compact_every: int | None = None) -> StreamingQuery:
    """Update-mode metrics -> last-write-wins table keyed by ``key``.

    Each micro-batch carries only the windows it changed. For Parquet the
    batch becomes a part of a managed table (``tables.write_batch``, idempotent)
    and ``read_upserts`` resolves the newest version per key at read time - no
    per-batch rewrite of the whole table. ``compact_every`` folds the batches into the
    levels after that many of them, between two batches. For a
    document store the key becomes the document id (``es.mapping.id``), so
    the store itself keeps the last write.
    """
    if fmt == "parquet":
        def write(batch: DataFrame, batch_id: int) -> None:
            tables.write_batch(batch, path, batch_id)
            if compact_every and (batch_id + 1) % compact_every == 0:
                compact_upserts(batch.sparkSession, path, key)
        return _writer(metrics, "update", checkpoint, trigger, None).foreachBatch(write).start()
    opts = dict(options or {})
    if fmt == ES_FORMAT:
        opts.setdefault("es.mapping.id", key)
        opts.setdefault("es.write.operation", "upsert")
        opts.setdefault("es.resource", path)
    return (_writer(metrics, "update", checkpoint, trigger, None)
            .foreachBatch(_batch_writer(fmt, path, opts, None, "append")).start())


def _numbered(spark: SparkSession, path: str, prefix: str) -> list[int]:
    """Numbers of the complete ``prefix=N`` folders of a table."""
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [st.getPath().getName() for st in fs.listStatus(p)]
    return sorted(int(n.split("=", 1)[1]) for n in names if n.startswith(f"{prefix}=")
                  and fs.exists(jvm.org.apache.hadoop.fs.Path(f"{path}/{n}/_SUCCESS")))


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    """All rows of a table of ``batch_id=N`` folders, with ``batch_id``: the newest
    compacted copy (``compacted=N``: batches up to N) and the batches after it.

    A batch that is being written, or one that a compaction already holds, is
    not read, so readers, writers and compactions may run at the same time.
    A managed table is read by its manifest, without listing folders."""
    if tables.is_managed(spark, path):
        return tables.read(spark, path)
    base = _numbered(spark, path, "compacted")
    upto = base[-1] if base else -1
    parts = [f"{path}/batch_id={n}" for n in _numbered(spark, path, "batch_id") if n > upto]
    out = None
    if base:
        out = spark.read.parquet(f"{path}/compacted={upto}")
    if parts:
        new = spark.read.option("basePath", path).parquet(*parts).withColumn("batch_id", F.col("batch_id").cast("bigint"))
        out = new if out is None else out.unionByName(new)
    if out is None:
        raise FileNotFoundError(f"no complete batch in {path}")
    return out


def compact_batches(spark: SparkSession, path: str, merge: Callable[[DataFrame], DataFrame],
                    max_batch_id: int | None = None, day: str = "window_start") -> int | None:
    """Merge the batches up to ``max_batch_id`` (default: the newest complete one)
    into one ``compacted=N`` copy, then drop older copies. Batches that arrive
    meanwhile stay as they are. Returns N, or None if there was nothing to do.
    ``merge`` maps rows with ``batch_id`` to fewer rows with the same columns.
    A managed table is compacted by levels and ``day`` instead."""
    if tables.is_managed(spark, path):
        return tables.compact(spark, path, F.to_date(day), merge, max_batch_id=max_batch_id)
    done = _numbered(spark, path, "compacted")
    known = [n for n in _numbered(spark, path, "batch_id") if not done or n > done[-1]]
    upto = max((n for n in known if max_batch_id is None or n <= max_batch_id), default=None)
    if upto is None:
        return None
    merge(read_batches(spark, path).where(F.col("batch_id") <= upto)) \
        .write.mode("overwrite").parquet(f"{path}/compacted={upto}")
    return upto


def drop_compacted(spark: SparkSession, path: str) -> None:
    """Delete batches and copies that the newest compacted copy holds. Run it when
    no reader of before the last compaction is left."""
    if tables.is_managed(spark, path):
        tables.vacuum(spark, path)
        return
    done = _numbered(spark, path, "compacted")
    if not done:
        return
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    old = [f"batch_id={n}" for n in _numbered(spark, path, "batch_id") if n <= done[-1]]
    for name in old + [f"compacted={n}" for n in done[:-1]]:
        fs.delete(jvm.org.apache.hadoop.fs.Path(f"{path}/{name}"), True)


def _latest(keys: list[str]) -> Callable[[DataFrame], DataFrame]:
    def merge(df: DataFrame) -> DataFrame:
        vals = [c for c in df.columns if c not in keys and c != "batch_id"]
        newest = F.max_by(F.struct(*vals), F.col("batch_id")).alias("_v")
        return df.groupBy(*keys).agg(newest, F.max("batch_id").alias("batch_id")) \
            .select(*keys, "_v.*", "batch_id")
    return merge


def read_upserts(spark: SparkSession, path: str, key: str | list[str] = "window_start") -> DataFrame:
    """Newest version of every key in an ``upsert_metrics`` Parquet table.

    ``max_by`` over ``batch_id`` is an ordinary aggregate: partial
    aggregation before the shuffle, one output row per key.
    """
    keys = [key] if isinstance(key, str) else list(key)
    return _latest(keys)(read_batches(spark, path)).drop("batch_id")


def compact_upserts(spark: SparkSession, path: str, key: str | list[str] = "window_start",
                    max_batch_id: int | None = None) -> int | None:
    """Keep the newest version of every key (see ``compact_batches``); days are those of the first key column."""
    keys = [key] if isinstance(key, str) else list(key)
    return compact_batches(spark, path, _latest(keys), max_batch_id, keys[0])


# The characters that count as white space at the ends of a line.
WHITE_SPACE = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
               "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000")


OFFSETS = "_offsets"


def claim_offsets(spark: SparkSession, target: str, size: int) -> int:
    """The first of ``size`` offsets of a table that belong to this run alone.

    Run n creates the marker ``_offsets/<n>.json`` with its block, right behind that of run n - 1; creating fails if
    another run was faster, which then is the one to follow. A run that dies leaves its offsets unused. Only the
    last marker is read; the stored offsets of a table that has no markers yet are looked at once."""
    store = tables._Store(spark, target)
    store.fs.mkdirs(store.at(f"{target}/{OFFSETS}"))
    while True:
        runs = sorted(n for n in store.names(f"{target}/{OFFSETS}") if n.endswith(".json") and not n.startswith("."))
        if runs:
            last = json.loads(store.read(f"{target}/{OFFSETS}/{runs[-1]}"))
            n, first = int(runs[-1][:-5]) + 1, last["first"] + last["size"]
        else:
            stored = any(not name.startswith(("_", ".")) for name in store.names(target))
            top = spark.read.schema(LAKE_SCHEMA).parquet(target).agg(F.max("offset")).first()[0] if stored else None
            n, first = 0, 0 if top is None else top + 1
        if store.create(f"{target}/{OFFSETS}/{n:012d}.json", json.dumps({"first": first, "size": size})):
            return first


def publish_lines(spark: SparkSession, source: str, target: str, fmt: str = "parquet",
                  topic: str | None = None, bootstrap_servers: str | None = None,
                  glob: str = "*") -> None:
    """Text log files -> one record per non-blank line, white space stripped at its ends.

    ``fmt="kafka"`` sends UTF-8 values (no key) to ``topic``. Otherwise an
    envelope table with ``date`` folders is appended at ``target``:
    ``partition`` is the writing task, ``timestamp`` the publish time, and
    ``offset`` is unique over all runs (not dense): a run first claims a block of
    offsets (``claim_offsets``), so any number of runs may publish to one table at once.
    """
    lines = spark.read.option("pathGlobFilter", glob).option("recursiveFileLookup", "true") \
        .text(source).select(F.btrim(F.col("value"), F.lit(WHITE_SPACE)).alias("line")) \
        .where(F.length("line") > 0)
    if fmt == "kafka":
        (lines.select(F.encode("line", "UTF-8").alias("value")).write.format("kafka")
         .option("kafka.bootstrap.servers", bootstrap_servers).option("topic", topic).save())
        return
    # Task p numbers its lines from p * 2^33 on (Spark's monotonically increasing ids).
    first = claim_offsets(spark, target, lines.rdd.getNumPartitions() << 33)
    env = lines.select(
        F.lit(None).cast("binary").alias("key"),
        F.encode("line", "UTF-8").alias("value"),
        F.lit(topic or "access_log").alias("topic"),
        F.spark_partition_id().alias("partition"),
        (F.lit(first).cast("bigint") + F.monotonically_increasing_id()).alias("offset"),
        F.current_timestamp().alias("timestamp"))
    # Two Spark writers in one folder would delete each other's temporary files: each run
    # writes to a hidden folder of its own, and its files, whose names are unique, then move.
    staging = f"{target}/_staging-{uuid.uuid4().hex[:12]}"
    env.withColumn("date", F.to_date("timestamp")).write.partitionBy("date").parquet(staging)
    store = tables._Store(spark, target)
    for day in store.names(staging):
        if day.startswith("date="):
            store.fs.mkdirs(store.at(f"{target}/{day}"))
            for name in store.names(f"{staging}/{day}"):
                if name.endswith(".parquet") and not store.fs.rename(store.at(f"{staging}/{day}/{name}"), store.at(f"{target}/{day}/{name}")):
                    raise OSError(f"could not move {staging}/{day}/{name}")
    store.delete(staging)
