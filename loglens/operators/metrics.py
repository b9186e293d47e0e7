"""Windowed traffic metrics (batch and streaming).

The aggregate is one ``groupBy(window)``: Spark plans partial
(map-side) aggregation before the shuffle, so a minute that holds a large
share of the traffic costs one partial row per input partition, not a hot
reducer. Exact distinct counts go through Spark's two-phase distinct
aggregation (shuffle on (window, ip) first), which also spreads hot windows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loglens.functions import parsing as fx

MINUTE = "1 minute"


def _errors(prefix: str) -> Column:
    return F.sum(F.when(F.col("status").startswith(prefix), 1).otherwise(0)).cast("bigint")


def counts(requests: Column | None = None) -> list[Column]:
    """total_requests, 4xx, 5xx, total_bytes: the aggregates of every metric table."""
    return [(F.count(F.lit(1)) if requests is None else requests).alias("total_requests"),
            _errors("4").alias("error_4xx_count"), _errors("5").alias("error_5xx_count"),
            F.sum(fx.to_long(F.col("bytes"))).alias("total_bytes")]


def window_metrics(parsed: DataFrame, time_col: str = "timestamp", width: str = MINUTE,
                   watermark: str | None = None, approx_ips: bool = True) -> DataFrame:
    """Per tumbling window: total_requests, 4xx, 5xx, total_bytes[, active_ip_count].

    Every row counts, parsed or not (as in the original job); bytes are
    summed as bigint. ``watermark`` bounds streaming state and enables
    append mode. ``active_ip_count`` is the HLL++ estimate (streaming-safe).
    """
    src = parsed.withWatermark(time_col, watermark) if watermark else parsed
    aggs = counts()
    if approx_ips:
        aggs.append(F.approx_count_distinct("ip").alias("active_ip_count"))
    return src.groupBy(F.window(F.col(time_col), width).alias("window")).agg(*aggs)


def flatten_window(metrics: DataFrame, ntz: bool = True) -> DataFrame:
    """window struct -> window_start, window_end (timestamp_ntz by default)."""
    t = "timestamp_ntz" if ntz else "timestamp"
    rest = [c for c in metrics.columns if c != "window"]
    return metrics.select(F.col("window.start").cast(t).alias("window_start"),
                          F.col("window.end").cast(t).alias("window_end"), *rest)


def minute_metrics(parsed: DataFrame) -> DataFrame:
    return flatten_window(window_metrics(parsed, approx_ips=False))


def _overview_cols(total: Column, errs: Column, total_bytes: Column) -> list[Column]:
    return [
        total.alias("request_per_minute"),
        F.round(errs.cast("double") / total * 100, 2).alias("error_rate_percent"),
        F.round(total_bytes.cast("double") / total, 2).alias("average_response_size"),
    ]


def overview(parsed: DataFrame, exact_ips: bool = True) -> DataFrame:
    """Metric-overview document per minute.

    error_rate_percent and average_response_size divide by all rows of the
    window (unparsed included). ``exact_ips`` uses count(distinct) - batch
    only; streaming callers pass False to keep the HLL++ estimate.
    """
    ip_agg = (F.count_distinct("ip") if exact_ips else F.approx_count_distinct("ip"))
    m = parsed.groupBy(F.window(F.col("timestamp"), MINUTE).alias("window")).agg(
        *counts(), ip_agg.cast("bigint").alias("active_ip_count"))
    return overview_from_metrics(m)


def overview_from_metrics(metrics: DataFrame) -> DataFrame:
    """Overview columns from an already aggregated window-metric table."""
    flat = flatten_window(metrics) if "window" in metrics.columns else metrics
    return flat.select(
        "window_start", "window_end",
        *_overview_cols(F.col("total_requests"),
                        F.col("error_4xx_count") + F.col("error_5xx_count"),
                        F.col("total_bytes")),
        "active_ip_count")


# Relative standard deviation of the HLL++ estimate (Spark's default).
IP_ERROR = 0.05


def active_ips_error(parsed: DataFrame, width: str = "1 hour", sigmas: float = 3.0) -> DataFrame:
    """Per window the exact number of client IPs, and whether the HLL++ estimate
    of the live metric is within ``sigmas`` of its stated error."""
    m = parsed.groupBy(F.window(F.col("timestamp"), width).alias("window")).agg(
        F.count_distinct("ip").alias("active_ip_count"),
        F.approx_count_distinct("ip", IP_ERROR).alias("estimate"))
    off = F.abs(F.col("estimate") - F.col("active_ip_count"))
    return m.select(F.col("window.start").cast("timestamp_ntz").alias("window_start"), "active_ip_count",
                    (off <= F.col("active_ip_count") * (sigmas * IP_ERROR)).alias("within_error"))


def active_ips(parsed: DataFrame, exact: bool = True) -> DataFrame:
    agg = F.count_distinct("ip") if exact else F.approx_count_distinct("ip")
    m = parsed.groupBy(F.window(F.col("timestamp"), MINUTE).alias("window")) \
        .agg(agg.cast("bigint").alias("active_ip_count"))
    return m.select(F.col("window.start").cast("timestamp_ntz").alias("window_start"),
                    "active_ip_count")


def mean_bytes(parsed: DataFrame) -> DataFrame:
    """avg(bytes) over rows that have bytes (differs from average_response_size)."""
    m = parsed.groupBy(F.window(F.col("timestamp"), MINUTE).alias("window")) \
        .agg(F.round(F.avg(fx.to_long(F.col("bytes"))), 2).alias("mean_bytes"))
    return m.select(F.col("window.start").cast("timestamp_ntz").alias("window_start"),
                    "mean_bytes")


def with_event_time(parsed: DataFrame) -> DataFrame:
    """Add ``event_time`` from the line's own time stamp (NULL if unparsed)."""
    return parsed.withColumn("event_time", fx.access_time(F.col("datetime")))


def event_time_metrics(parsed: DataFrame, watermark: str | None = None,
                       width_seconds: int = 60) -> DataFrame:
    """Minute metrics on event time, parsed rows only.

    Rows without an event time fall out through a generator, before the
    window: a row filter would be copied below the parse and run the line's
    regex again. With ``watermark``, late rows within it update their window
    and streaming state stays bounded.
    """
    timed = fx.keep_where(with_event_time(parsed).select("event_time", "status", "bytes"),
                          F.col("event_time").isNotNull())
    return flatten_window(window_metrics(timed, "event_time", width=f"{width_seconds} seconds",
                                         watermark=watermark, approx_ips=False),
                          ntz=not parsed.isStreaming)
