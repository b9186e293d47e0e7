"""Long-running streaming jobs over an access-log topic.

Two layouts:

* ``start_access_jobs`` - the original design: one query appends parsed
  records (raw lake or console), a second keeps per-minute metrics in the
  state store and emits them in update mode. Both read the source, each
  with its own mandatory checkpoint.
* ``start_shared_scan_job`` - one query, one read of the source: every
  micro-batch is parsed once, persisted, written to the raw lake and
  reduced to per-batch partial window metrics (counts, sums and an HLL
  sketch of client IPs). Partials are additive, so ``merge_partials`` gives
  the final metrics with no state store at all, and a replayed batch simply
  overwrites its own partition.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from loglens.functions import parsing as fx
from loglens.functions import patterns as P
from loglens.operators import metrics, parse, top_lists
from loglens.session import shared_root
from loglens.streaming import sinks, tables


def parsed_stream(envelope: DataFrame) -> DataFrame:
    return parse.parse_access(parse.decode(envelope), keep=("key", "timestamp", "offset"))


def start_access_jobs(spark: SparkSession, envelope: DataFrame, name: str = "access",
                      raw_path: str | None = None, metrics_path: str | None = None,
                      checkpoint_root: str | None = None, trigger: dict | None = None,
                      watermark: str | None = None,
                      files_per_batch: int | None = None,
                      quarantine_path: str | None = None) -> list[StreamingQuery]:
    """Start the raw-record query and the minute-metric query.

    Without ``raw_path``/``metrics_path`` both go to the console (append and
    update). ``watermark`` bounds the metric state (the original job has
    none, so its state grows without limit). ``quarantine_path`` adds a
    third query that appends every line the extended pattern rejects, with
    its class (``null``, ``parsed_other``, ``unparsed``), to a dead-letter
    table.
    """
    root = checkpoint_root or f"{shared_root(spark)}/jobs/{name}"
    parsed = parsed_stream(envelope)
    if raw_path:
        q_raw = sinks.raw_lake(parsed, raw_path, f"{root}/raw", trigger,
                               files_per_batch=files_per_batch)
    else:
        q_raw = sinks.console(parsed, "append", f"{root}/raw", trigger)
    agg = metrics.window_metrics(parsed, "timestamp", watermark=watermark)
    if metrics_path:
        q_m = sinks.upsert_metrics(metrics.flatten_window(agg, ntz=False), metrics_path,
                                   f"{root}/metrics", trigger=trigger)
    else:
        q_m = sinks.console(agg, "update", f"{root}/metrics", trigger)
    queries = [q_raw, q_m]
    if quarantine_path:
        _, rejected = parse.quarantine_split(parse.decode(envelope))
        queries.append(sinks.parquet_append(rejected, quarantine_path, f"{root}/quarantine",
                                            trigger))
    return queries


def batch_partials(parsed: DataFrame, width: str = metrics.MINUTE) -> DataFrame:
    """Additive per-window partial metrics of one micro-batch."""
    return parsed.groupBy(F.window(F.col("timestamp"), width).alias("window")).agg(
        *metrics.counts(),
        # The sketch skips empty strings, but unparsed lines carry ip '' and
        # count as one client (as with approx_count_distinct); an injective
        # prefix keeps them. NULL stays NULL and is skipped by both.
        F.hll_sketch_agg(F.concat(F.lit("ip:"), F.col("ip"))).alias("ip_sketch"),
    ).select(F.col("window.start").alias("window_start"),
             F.col("window.end").alias("window_end"),
             "total_requests", "error_4xx_count", "error_5xx_count", "total_bytes", "ip_sketch")


def start_shared_scan_job(spark: SparkSession, envelope: DataFrame, raw_path: str,
                          partials_path: str, checkpoint: str,
                          trigger: dict | None = None,
                          files_per_batch: int | None = None,
                          quarantine_path: str | None = None,
                          compact_every: int | None = None,
                          endpoints_path: str | None = None) -> StreamingQuery:
    """One read and one parse of the source feeding the raw lake, the metrics and,
    with ``quarantine_path``, the dead-letter table of rejected lines (only those
    are matched again, for their class).

    All three are managed tables (``streaming.tables``): a batch counts once its
    manifest entry is there, and a replay changes nothing. ``compact_every``
    merges their small files after that many batches, so the number of files
    stays bounded; without it run ``compact_job`` (CLI ``compact``) beside the job.
    ``files_per_batch`` bounds the raw files a micro-batch writes (see
    ``sinks.raw_lake``); the partial metrics are tiny either way. ``endpoints_path``
    adds the endpoint sketches of live top lists (``operators.top_lists``).
    """
    parsed = fx.with_groups(parse.decode(envelope), "value", P.EXTENDED_PATTERN, P.EXTENDED_FIELDS,
                            ["key", "timestamp", "offset"], keep_source=True)

    def write(batch: DataFrame, batch_id: int) -> None:
        # Cached for the two writes below; lost blocks are recomputed from
        # the source offsets of this batch, which are fixed in the offset log.
        batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            raw = batch.drop("value").withColumn("date", F.to_date("timestamp"))
            if files_per_batch:
                raw = raw.repartition(files_per_batch)
            tables.write_batch(raw, raw_path, batch_id, "date", {"compression": sinks.LAKE_COMPRESSION})
            tables.write_batch(batch_partials(batch), partials_path, batch_id)
            if quarantine_path:
                rejected = batch.where(F.col("value").isNull() | (F.col("status") == ""))
                tables.write_batch(parse.line_class(rejected.select("key", "timestamp", "offset", "value")),
                                   quarantine_path, batch_id)
            if endpoints_path:
                tables.write_batch(top_lists.endpoint_sketches(batch), endpoints_path, batch_id)
        finally:
            batch.unpersist()
        if compact_every and (batch_id + 1) % compact_every == 0:
            compact_job(batch.sparkSession, raw_path, partials_path, quarantine_path, endpoints_path)

    w = parsed.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
    if trigger:
        w = w.trigger(**trigger)
    return w.foreachBatch(write).start()


def merge_partials(spark: SparkSession, partials_path: str) -> DataFrame:
    """Final window metrics from all partials (sums + HLL union)."""
    return _added(sinks.read_batches(spark, partials_path)) \
        .withColumn("active_ip_count", F.hll_sketch_estimate("ip_sketch")).drop("ip_sketch", "batch_id")


def _added(partials: DataFrame) -> DataFrame:
    sums = ("total_requests", "error_4xx_count", "error_5xx_count", "total_bytes")
    return partials.groupBy("window_start", "window_end").agg(
        *[F.sum(c).alias(c) for c in sums], F.hll_union_agg("ip_sketch").alias("ip_sketch"),
        F.max("batch_id").alias("batch_id"))


def compact_partials(spark: SparkSession, partials_path: str, max_batch_id: int | None = None) -> int | None:
    """Add the partials of many batches up into one copy (see ``sinks.compact_batches``)."""
    return sinks.compact_batches(spark, partials_path, _added, max_batch_id)


def compact_job(spark: SparkSession, raw_path: str | None = None, partials_path: str | None = None,
                quarantine_path: str | None = None, endpoints_path: str | None = None, vacuum: bool = False) -> dict[str, int | None]:
    """Merge the small files of the tables of a shared-scan job, which may go on meanwhile. The newest batch folded, by table.
    ``vacuum`` also deletes what is no longer in use (see ``tables.vacuum``)."""
    done: dict[str, int | None] = {}
    for name, path, run in (("raw", raw_path, sinks.compact_lake), ("partials", partials_path, compact_partials),
                            ("quarantine", quarantine_path, compact_quarantine), ("endpoints", endpoints_path, compact_sketches)):
        if path and tables.is_managed(spark, path):
            done[name] = run(spark, path)
            if vacuum:
                tables.vacuum(spark, path)
    return done


def compact_quarantine(spark: SparkSession, path: str, max_batch_id: int | None = None) -> int | None:
    """Merge the files of the dead-letter table; every line stays."""
    return tables.compact(spark, path, F.to_date("timestamp"), None, ("line_class", "timestamp"), max_batch_id=max_batch_id)


def compact_sketches(spark: SparkSession, path: str, max_batch_id: int | None = None) -> int | None:
    """Add the endpoint sketches of many batches up."""
    return tables.compact(spark, path, F.col("day"), top_lists.add_sketches, max_batch_id=max_batch_id)


def await_jobs(spark: SparkSession, queries: list[StreamingQuery],
               timeout_s: float | None = None) -> None:
    """Block until one of ``queries`` ends (or ``timeout_s`` passes).

    If any of them failed, the others are stopped and the failure is
    raised, so a dead metrics query never goes unnoticed behind a healthy
    raw query (the original job waited on its first query only).
    """
    while all(q.isActive for q in queries):
        spark.streams.resetTerminated()
        if not all(q.isActive for q in queries):
            break
        try:
            if timeout_s is None:
                spark.streams.awaitAnyTermination()
            else:
                spark.streams.awaitAnyTermination(timeout_s)
        except Exception:  # noqa: BLE001 - the failed query is reported below
            pass
        if timeout_s is not None:
            break
    failed = [q for q in queries if not q.isActive and q.exception() is not None]
    if failed:
        for q in queries:
            if q.isActive:
                q.stop()
        q = failed[0]
        raise RuntimeError(f"query {q.name or q.id} failed: {q.exception()}")


def start_event_time_job(spark: SparkSession, envelope: DataFrame, partials_path: str, late_path: str, checkpoint: str,
                         delay: str, trigger: dict | None = None, compact_every: int | None = None) -> StreamingQuery:
    """Event-time minute metrics whose late rows are kept.

    A stateful append query drops rows whose window the watermark has closed, and only counts them. Here each
    micro-batch is parsed once and split by the watermark that the batches before it have set (largest event
    time seen, less ``delay``): rows of open windows go as additive partials to ``partials_path``, rows of closed ones,
    whole, to the side output ``late_path``. ``closed_windows`` then shows what an append query would
    have emitted, and with ``late_path`` the corrected windows. The watermark is a note of the batch in the
    manifest, so a replayed batch is split as before."""
    parsed = metrics.with_event_time(parse.parse_access(parse.decode(envelope), keep=("timestamp", "offset", "partition")))
    timed = fx.keep_where(parsed, F.col("event_time").isNotNull())

    def write(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        seen = tables.note(session, partials_path, batch_id - 1)
        batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            newest = batch.agg(F.max(F.unix_micros("event_time"))).first()[0]
            end = F.unix_micros(F.window("event_time", metrics.MINUTE)["end"])
            late = F.lit(False) if seen is None else end <= F.lit(seen - _micros(delay))
            # A window in a filter would stay as a column, in all batches but the first.
            tables.write_batch(batch.where(late).select(*batch.columns).withColumn("batch_watermark", F.lit(seen).cast("long")), late_path, batch_id)
            known = [v for v in (seen, newest) if v is not None]
            tables.write_batch(event_partials(batch.where(~late)), partials_path, batch_id, note=max(known) if known else None)
        finally:
            batch.unpersist()
        if compact_every and (batch_id + 1) % compact_every == 0:
            compact_event_time(session, partials_path, late_path)

    w = timed.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
    if trigger:
        w = w.trigger(**trigger)
    return w.foreachBatch(write).start()


def _micros(interval: str) -> int:
    amount, unit = interval.split()
    return int(float(amount) * {"second": 1, "minute": 60, "hour": 3600, "day": 86400}[unit.rstrip("s")] * 1_000_000)


def event_partials(rows: DataFrame) -> DataFrame:
    """Additive metrics per event-time minute."""
    return metrics.flatten_window(metrics.window_metrics(rows, "event_time", approx_ips=False), ntz=False)


_SUMS = ("total_requests", "error_4xx_count", "error_5xx_count", "total_bytes")


def _summed(partials: DataFrame) -> DataFrame:
    return partials.groupBy("window_start", "window_end").agg(*[F.sum(c).alias(c) for c in _SUMS], F.max("batch_id").alias("batch_id"))


def compact_event_time(spark: SparkSession, partials_path: str, late_path: str | None = None) -> None:
    """Add up the partials of many batches; merge the files of the side output, whose rows all stay."""
    tables.compact(spark, partials_path, F.to_date("window_start"), _summed)
    if late_path:
        tables.compact(spark, late_path, F.to_date("event_time"), None, ("event_time",))


def closed_windows(spark: SparkSession, partials_path: str, delay: str, late_path: str | None = None) -> DataFrame:
    """The windows that the watermark has closed, and with ``late_path`` corrected by the rows that came after that.

    A window that only late rows fall into appears with the correction."""
    rows = tables.read(spark, partials_path).drop("batch_id")
    if late_path:
        rows = rows.unionByName(event_partials(tables.read(spark, late_path)).select(*rows.columns))
    newest = tables.note(spark, partials_path)
    end = F.unix_micros("window_end")
    closed = F.lit(False) if newest is None else end <= F.lit(newest - _micros(delay))
    return _summed(rows.withColumn("batch_id", F.lit(0))).drop("batch_id").where(closed)
