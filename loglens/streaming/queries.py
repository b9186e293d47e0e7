"""Streaming query keys: the same operators driven by Structured Streaming.

Each key streams the materialised envelope feed (a file-source stand-in
for the Kafka topic) through the operator with ``availableNow``, writes a
checkpointed sink in a fresh folder under the shared root, and returns the
sink read back as a batch DataFrame.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from loglens.operators import alerts, metrics, parse
from loglens.plans import oracle as O
from loglens.session import scratch_path
from loglens.sources import feeds, files, kafka, tail
from loglens.streaming import live, runner, sinks

METRIC_COLUMNS = ("window_start", "window_end", "total_requests", "error_4xx_count",
                  "error_5xx_count", "total_bytes")
APPEND_WATERMARK = "10 minutes"


def _stream_feed(spark: SparkSession, sf_dir: str, kind: str = "access", variant: str = "plain") -> DataFrame:
    """The whole feed as a file stream."""
    return kafka.envelope_file_stream(spark, feeds.feed_path(spark, sf_dir, kind, variant))


def _in_slices(spark: SparkSession, sf_dir: str, label: str, variant: str,
               start: Callable[[DataFrame, str], StreamingQuery], settings: dict[str, str] | None = None) -> str:
    """Replay a feed like a topic: in time order, a slice per micro-batch (``start(source,
    folder)`` starts the query, with ``settings``). Returns the query's folder."""
    run = scratch_path(spark, label)
    source = kafka.envelope_file_stream(spark, feeds.slices_path(spark, sf_dir, variant), feeds.SLICE_FILES, partitioned=False)
    runner.run_available(spark, label=label, start=lambda: start(source, run), settings=settings)
    return run


def q_stream_parse_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parse-only stream (append): every record exactly once."""
    src = parse.decode(_stream_feed(spark, sf_dir))
    out = parse.parse_access(src, keep=("offset", "timestamp"))
    run = scratch_path(spark, "stream_parse_append")
    runner.run_available(spark, label="stream_parse_append", start=lambda:
        sinks.parquet_append(out, f"{run}/out", f"{run}/checkpoint", runner.AVAILABLE_NOW))
    return spark.read.parquet(f"{run}/out").withColumn(
        "timestamp", F.col("timestamp").cast("timestamp_ntz"))


def q_stream_minute_metrics_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ingest-time minute metrics in update mode, no watermark (as the
    original job), upserted per micro-batch; read back last write per window."""
    src = parse.parse_access(parse.decode(_stream_feed(spark, sf_dir)))
    agg = metrics.flatten_window(metrics.window_metrics(src, "timestamp"), ntz=False)
    run = scratch_path(spark, "stream_minute_metrics_update")
    runner.run_available(spark, label="stream_minute_metrics_update", start=lambda:
        sinks.upsert_metrics(agg, f"{run}/out", f"{run}/checkpoint",
                             trigger=runner.AVAILABLE_NOW))
    latest = sinks.read_upserts(spark, f"{run}/out", "window_start")
    return latest.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"),
                         F.col("window_end").cast("timestamp_ntz").alias("window_end"),
                         *METRIC_COLUMNS[2:])


def q_stream_minute_overview_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metric-overview documents (rate, error %, mean size, HLL active IPs) upserted
    per micro-batch keyed by window_start; the approximate IP count is left out
    of the checked projection."""
    src = parse.parse_access(parse.decode(_stream_feed(spark, sf_dir)))
    docs = metrics.overview_from_metrics(
        metrics.flatten_window(metrics.window_metrics(src, "timestamp"), ntz=False))
    run = scratch_path(spark, "stream_minute_overview_update")
    runner.run_available(spark, label="stream_minute_overview_update", start=lambda:
        sinks.upsert_metrics(docs, f"{run}/out", f"{run}/checkpoint",
                             trigger=runner.AVAILABLE_NOW))
    latest = sinks.read_upserts(spark, f"{run}/out", "window_start")
    return latest.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"),
                         F.col("window_end").cast("timestamp_ntz").alias("window_end"),
                         "request_per_minute", "error_rate_percent", "average_response_size")


def _closed_windows(spark: SparkSession, run: str) -> DataFrame:
    return spark.read.parquet(f"{run}/out").select(
        F.col("window_start").cast("timestamp_ntz").alias("window_start"),
        F.col("window_end").cast("timestamp_ntz").alias("window_end"), *METRIC_COLUMNS[2:])


def q_stream_minute_metrics_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Minute metrics in append mode with a watermark: each closed window once.

    The feed arrives in three slices, so windows close as the watermark
    passes them, run by run."""
    def start(source: DataFrame, run: str) -> StreamingQuery:
        agg = metrics.window_metrics(parse.parse_access(parse.decode(source)), "timestamp",
                                     watermark=APPEND_WATERMARK)
        return sinks.parquet_append(metrics.flatten_window(agg, ntz=False), f"{run}/out",
                                    f"{run}/checkpoint", runner.AVAILABLE_NOW)
    return _closed_windows(spark, _in_slices(spark, sf_dir, "stream_minute_metrics_append", "plain", start))


def q_stream_event_time_minute_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event-time minute metrics over the late feed (lines up to 80 s late),
    watermark 10 minutes, append, three slices in ingest order."""
    def start(source: DataFrame, run: str) -> StreamingQuery:
        parsed = parse.parse_access_matched(parse.decode(source))
        return sinks.parquet_append(metrics.event_time_metrics(parsed, watermark=APPEND_WATERMARK),
                                    f"{run}/out", f"{run}/checkpoint", runner.AVAILABLE_NOW)
    return _closed_windows(spark, _in_slices(spark, sf_dir, "stream_event_time_minute_metrics", "late", start))


def q_raw_lake_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K6: the raw lake written by the stream, read back with its date folders."""
    run = scratch_path(spark, "raw_lake_records")
    parsed = parse.parse_access(parse.decode(_stream_feed(spark, sf_dir)), keep=("timestamp", "offset"))
    runner.run_available(spark, label="raw_lake_records", start=lambda: sinks.raw_lake(
        parsed, f"{run}/lake", f"{run}/checkpoint", runner.AVAILABLE_NOW))
    return spark.read.parquet(f"{run}/lake").select("offset", "ip", "request", "status", "bytes", F.col("date").cast("string").alias("date"))


def q_alert_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K3/K4: alerts in the document sink (Parquet form), routed by date; a record
    without a time stamp of its own goes to the day it came in."""
    run = scratch_path(spark, "alert_documents")
    found = alerts.json_alerts(_stream_feed(spark, sf_dir, "json", "undated"), keep=("topic", "partition", "offset"))
    runner.run_available(spark, label="alert_documents", start=lambda: sinks.document_sink(
        found, f"{run}/logs_{{date}}", f"{run}/checkpoint", time_col=["log_timestamp", "kafka_ingestion_time"],
        id_cols=("topic", "partition", "offset"), trigger=runner.AVAILABLE_NOW))
    return spark.read.parquet(f"{run}/logs").select("doc_id", "log_level", F.col("date").cast("string").alias("date"))


def q_quarantined_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L3: the lines that the shared-scan job rejects, with their class."""
    from loglens.streaming import jobs
    run = scratch_path(spark, "quarantined_lines")
    runner.run_available(spark, label="quarantined_lines", start=lambda: jobs.start_shared_scan_job(
        spark, _stream_feed(spark, sf_dir), f"{run}/raw", f"{run}/partials", f"{run}/checkpoint",
        trigger=runner.AVAILABLE_NOW, quarantine_path=f"{run}/rejected"))
    return sinks.read_batches(spark, f"{run}/rejected").select("offset", "value", "line_class")


def q_stream_json_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON app-log severity alerts as a stream (processing_time dropped)."""
    out = alerts.json_alerts(_stream_feed(spark, sf_dir, kind="json"),
                             keep=("offset",)).drop("processing_time")
    run = scratch_path(spark, "stream_json_alerts")
    runner.run_available(spark, label="stream_json_alerts", start=lambda:
        sinks.parquet_append(out, f"{run}/out", f"{run}/checkpoint", runner.AVAILABLE_NOW))
    return spark.read.parquet(f"{run}/out").select(
        "offset", F.col("kafka_ingestion_time").cast("timestamp_ntz").alias("kafka_ingestion_time"),
        F.col("log_timestamp").cast("timestamp_ntz").alias("log_timestamp"),
        "log_level", "log_message", "user_id")


def q_stream_minute_metrics_shared_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One source read -> raw lake + additive per-batch partials, merged."""
    from loglens.streaming import jobs
    run = scratch_path(spark, "stream_minute_metrics_shared_scan")
    runner.run_available(spark, label="stream_minute_metrics_shared_scan", start=lambda:
        jobs.start_shared_scan_job(
        spark, _stream_feed(spark, sf_dir), f"{run}/raw", f"{run}/partials",
        f"{run}/checkpoint", trigger=runner.AVAILABLE_NOW))
    m = jobs.merge_partials(spark, f"{run}/partials")
    return m.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"),
                    F.col("window_end").cast("timestamp_ntz").alias("window_end"),
                    *METRIC_COLUMNS[2:])


def q_stream_access_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The original two-query layout: parsed records appended to the raw lake
    and minute metrics upserted, each query reading the source on its own."""
    from loglens.streaming import jobs
    run = scratch_path(spark, "stream_access_jobs")
    runner.run_available(spark, label="stream_access_jobs", start=lambda: jobs.start_access_jobs(
        spark, _stream_feed(spark, sf_dir), raw_path=f"{run}/raw",
        metrics_path=f"{run}/metrics", checkpoint_root=f"{run}/checkpoints",
        trigger=runner.AVAILABLE_NOW))
    latest = sinks.read_upserts(spark, f"{run}/metrics", "window_start")
    return latest.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"),
                         F.col("window_end").cast("timestamp_ntz").alias("window_end"),
                         *METRIC_COLUMNS[2:])


def _live(spark: SparkSession, sf_dir: str, label: str, build: Callable[[DataFrame], DataFrame],
          settings: dict[str, str] | None = None) -> DataFrame:
    """An append-mode live table over the feed in three slices, read back."""
    def start(source: DataFrame, run: str) -> StreamingQuery:
        return sinks.parquet_append(build(parse.parse_access(parse.decode(source), keep=("timestamp",))), f"{run}/out",
                                    f"{run}/checkpoint", runner.AVAILABLE_NOW)
    return spark.read.parquet(f"{_in_slices(spark, sf_dir, label, 'plain', start, settings)}/out")


def q_stream_error_anomalies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D9 live: closed endpoint-hours against the rolling baseline of their endpoint."""
    rows = _live(spark, sf_dir, "stream_error_anomalies", lambda p: live.live_anomalies(p, APPEND_WATERMARK),
                 runner.KEYED_STATE)
    return rows.withColumn("hour_start", F.col("hour_start").cast("timestamp_ntz"))


def q_stream_error_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D8 live: closed minutes with an error rate of 50 % or more."""
    rows = _live(spark, sf_dir, "stream_error_windows", lambda p: live.live_error_windows(p, APPEND_WATERMARK))
    return rows.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


def q_stream_active_ips_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A7 live: exact distinct client IPs of closed minutes, by two chained stateful operators."""
    rows = _live(spark, sf_dir, "stream_active_ips_exact", lambda p: live.live_active_ips(p, APPEND_WATERMARK))
    return rows.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


def q_stream_client_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D7 live: client profiles over closed hours, from keyed state."""
    rows = live.latest_profiles(_live(spark, sf_dir, "stream_client_profile", lambda p: live.live_client_profile(p, APPEND_WATERMARK),
                                      runner.KEYED_STATE))
    return rows.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("first_seen", "last_seen")})


def q_stream_top_endpoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D3 live: candidates from the merged endpoint sketches of all batches, recounted on the raw lake."""
    from loglens.operators import top_lists
    from loglens.streaming import jobs

    def start(source: DataFrame, run: str) -> StreamingQuery:
        return jobs.start_shared_scan_job(spark, source, f"{run}/raw", f"{run}/partials", f"{run}/checkpoint",
                                          trigger=runner.AVAILABLE_NOW, endpoints_path=f"{run}/endpoints")
    run = _in_slices(spark, sf_dir, "stream_top_endpoints", "wide", start)
    return top_lists.live_top_endpoints(sinks.read_lake(spark, f"{run}/raw"), sinks.read_batches(spark, f"{run}/endpoints"))


TARDY_DELAY = "2 minutes"


def q_stream_late_rows_corrected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Closed event-time minutes, corrected by the rows that came behind the watermark."""
    from loglens.streaming import jobs

    def start(source: DataFrame, run: str) -> StreamingQuery:
        return jobs.start_event_time_job(spark, source, f"{run}/partials", f"{run}/late", f"{run}/checkpoint", TARDY_DELAY,
                                         trigger=runner.AVAILABLE_NOW)
    run = _in_slices(spark, sf_dir, "stream_late_rows_corrected", "tardy", start)
    rows = jobs.closed_windows(spark, f"{run}/partials", TARDY_DELAY, f"{run}/late")
    return rows.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"),
                       F.col("window_end").cast("timestamp_ntz").alias("window_end"), *METRIC_COLUMNS[2:])


def q_stream_tailed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plain text log files read as growing files, in byte ranges."""
    run = scratch_path(spark, "stream_tailed_lines")
    lines = tail.growing_log_files(spark, feeds.text_feed_path(spark, sf_dir, compression="none"), files.TEXT_GLOB, split_bytes=1 << 18)
    runner.run_available(spark, label="stream_tailed_lines", start=lambda: sinks.parquet_append(
        lines, f"{run}/out", f"{run}/checkpoint", runner.AVAILABLE_NOW))
    rows = spark.read.parquet(f"{run}/out")
    return rows.groupBy("value").agg(F.count(F.lit(1)).alias("lines"),
                                     F.bool_and(F.col("file_name").rlike(r"^part-.*\.txt$")).alias("named"))


def stream_queries():
    return {
        "stream_tailed_lines": q_stream_tailed_lines,
        "stream_client_profile": q_stream_client_profile,
        "stream_top_endpoints": q_stream_top_endpoints,
        "stream_late_rows_corrected": q_stream_late_rows_corrected,
        "stream_error_anomalies": q_stream_error_anomalies,
        "stream_error_windows": q_stream_error_windows,
        "stream_active_ips_exact": q_stream_active_ips_exact,
        "stream_access_jobs": q_stream_access_jobs,
        "stream_minute_metrics_shared_scan": q_stream_minute_metrics_shared_scan,
        "stream_parse_append": q_stream_parse_append,
        "stream_minute_metrics_update": q_stream_minute_metrics_update,
        "stream_minute_overview_update": q_stream_minute_overview_update,
        "stream_minute_metrics_append": q_stream_minute_metrics_append,
        "stream_event_time_minute_metrics": q_stream_event_time_minute_metrics,
        "stream_json_alerts": q_stream_json_alerts,
        "raw_lake_records": q_raw_lake_records,
        "alert_documents": q_alert_documents,
        "quarantined_lines": q_quarantined_lines,
    }


def _closed(sql: str, ingest_max: str, window_end: str = "window_end") -> str:
    """Only windows a 10-minute watermark has closed after the whole feed."""
    return (f"SELECT * FROM ({sql}) w WHERE {window_end} <= "
            f"({ingest_max}) - INTERVAL 10 minute")


def stream_oracles():
    b = O.batch_oracles()
    late_max = ("SELECT max(ts - to_seconds(20 * (event_id % 5))) FROM events "
                "WHERE event_id % 101 <> 0 AND event_id % 97 <> 0 AND event_id % 103 <> 0")
    minute_end = "window_start + INTERVAL 1 minute"
    all_max = "SELECT max(ts) FROM events"
    event_max = ("SELECT max(date_trunc('second', ts)) FROM events "
                 "WHERE event_id % 101 <> 0 AND event_id % 97 <> 0")
    tardy = O._minute_metrics("tardy", O.event_time_sql("datetime"), f"WHERE status <> '' AND {O.event_time_sql('datetime')} IS NOT NULL")
    tardy_max = f"SELECT max({O.event_time_sql('datetime')}) FROM ({O.parsed_cte('tardy')}) x WHERE status <> ''"
    return {
        "stream_tailed_lines": b["text_file_lines"],
        "stream_client_profile": b["client_profile"].replace("FROM e GROUP BY ip", f"""FROM e
            WHERE date_trunc('hour', event_time) + INTERVAL 1 hour <= ({event_max}) - INTERVAL 10 minute GROUP BY ip"""),
        "stream_top_endpoints": b["top_endpoints"],
        "stream_late_rows_corrected": f"SELECT * FROM ({tardy}) w WHERE window_end <= ({tardy_max}) - INTERVAL 2 minute",
        "stream_error_anomalies": _closed(b["error_anomalies"], event_max, "hour_start + INTERVAL 1 hour"),
        "stream_error_windows": _closed(b["error_windows"], all_max, minute_end),
        "stream_active_ips_exact": _closed(b["minute_active_ips_exact"], all_max, minute_end),
        "stream_parse_append": b["access_log_parse"],
        "stream_minute_metrics_update": b["minute_metrics"],
        "stream_minute_metrics_shared_scan": b["minute_metrics"],
        "stream_access_jobs": b["minute_metrics"],
        "stream_minute_overview_update": (
            O._overview_body() + "SELECT window_start, window_end, request_per_minute, "
            "error_rate_percent, average_response_size FROM o"),
        "stream_minute_metrics_append": _closed(b["minute_metrics"], "SELECT max(ts) FROM events"),
        "stream_event_time_minute_metrics": _closed(b["event_time_minute_metrics"], late_max),
        "stream_json_alerts": b["json_alerts"],
        "raw_lake_records": O._with_parsed() + 'SELECT "offset", ip, request, status, bytes, '
                            'CAST(CAST("timestamp" AS DATE) AS VARCHAR) AS date FROM p',
        "alert_documents": O.alert_documents(),
        "quarantined_lines": O.rejected_lines(),
    }
