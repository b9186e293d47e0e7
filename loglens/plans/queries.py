"""The registered query set: key -> (spark, sf_dir) -> DataFrame.

Every query reads the test tables (the log feeds are derived from
``events`` by ``loglens.sources.recipe``) and runs over all of it. Output
returned as ``timestamp_ntz`` in UTC.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loglens.operators import alerts, dashboards, metrics, parse, search_index
from loglens.session import configure, scratch_path
from loglens.sources import feeds, files, gzip_members, kafka

Query = Callable[[SparkSession, str], DataFrame]

PARSED_COLUMNS = ("offset", "timestamp", "ip", "datetime", "request", "status", "bytes",
                  "referrer", "user_agent")

# Parameters of the registered log_search query.
SEARCH = {"contains": "wp-admin", "status": "404",
          "start": "2024-01-05 00:00:00", "end": "2024-01-20 00:00:00"}


# Parameters of the registered indexed_log_search query.
INDEXED_SEARCH = {"contains": "cart.jsp", "ip": "10.0.0.7"}


def _ntz(name: str) -> Column:
    return F.col(name).cast("timestamp_ntz").alias(name)


def decoded(spark: SparkSession, sf_dir: str, variant: str = "plain") -> DataFrame:
    return parse.decode(feeds.feed(spark, sf_dir, "access", variant))


def parsed(spark: SparkSession, sf_dir: str, variant: str = "plain") -> DataFrame:
    """Parsed access records keyed by offset; ``timestamp`` stays an instant."""
    return parse.parse_access(decoded(spark, sf_dir, variant), keep=("offset", "timestamp"))


def enriched(spark: SparkSession, sf_dir: str, variant: str = "plain") -> DataFrame:
    matched = parse.parse_access_matched(decoded(spark, sf_dir, variant), keep=("offset",))
    return parse.enrich(matched, keep=("offset",), drop_unparsed=False)


def q_envelope_decode(spark, sf_dir):
    """Kafka record decode."""
    d = decoded(spark, sf_dir)
    return d.select("key", "value", "topic", "partition", "offset", _ntz("timestamp"))


def q_access_log_parse(spark, sf_dir):
    """Seven-field access-log parse (all lines, '' when unmatched)."""
    return parsed(spark, sf_dir).withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))


def q_access_log_typed(spark, sf_dir):
    """Typed columns with ANSI-safe casts."""
    t = parse.typed(parsed(spark, sf_dir))
    return t.select(*[c for c in PARSED_COLUMNS if c != "timestamp"], "status_code_int",
                    "bytes_int", _ntz("timestamp"), _ntz("timestamp_ts"))


def q_access_log_parse_any(spark, sf_dir):
    """L2: common or extended format, eight fields."""
    return parse.parse_any(decoded(spark, sf_dir), keep=("offset",))


def q_access_log_enriched(spark, sf_dir):
    """Parsed rows with event time, request parts, endpoint, status class."""
    return enriched(spark, sf_dir).withColumn("event_time", F.col("event_time").cast("timestamp_ntz"))


def q_parse_quality(spark, sf_dir):
    """L3: line counts per parse class."""
    return parse.parse_quality(decoded(spark, sf_dir))


def q_text_log_quality(spark, sf_dir):
    """Gzip text log files (generator naming) -> parse classes."""
    lines = files.log_files(spark, feeds.text_feed_path(spark, sf_dir), glob=files.TEXT_GLOB)
    return parse.parse_quality(lines)


def q_minute_metrics(spark, sf_dir):
    """Per-minute metrics on ingest time."""
    return metrics.minute_metrics(parsed(spark, sf_dir))


def q_minute_overview(spark, sf_dir):
    """The overview document, exact distinct IPs."""
    return metrics.overview(parsed(spark, sf_dir), exact_ips=True)


def q_dense_minute_overview(spark, sf_dir):
    """Overview on the dense feed (40 lines per minute, the original feed rate)."""
    return metrics.overview(parsed(spark, sf_dir, "dense"), exact_ips=True)


def q_minute_active_ips_exact(spark, sf_dir):
    """Exact distinct client IPs per minute."""
    return metrics.active_ips(parsed(spark, sf_dir), exact=True)


def q_minute_active_ips_approx(spark, sf_dir):
    """HLL++ distinct client IPs per minute (rows-only check)."""
    return metrics.active_ips(parsed(spark, sf_dir), exact=False)


def q_minute_mean_bytes(spark, sf_dir):
    """avg(bytes) per minute over rows with bytes."""
    return metrics.mean_bytes(parsed(spark, sf_dir))


def q_event_time_minute_metrics(spark, sf_dir):
    """Per-minute metrics on the lines' own time, late feed."""
    return metrics.event_time_metrics(parsed(spark, sf_dir, "late"))


def q_error_windows(spark, sf_dir):
    """Minutes with error rate >= 50% and >= 2 requests."""
    return alerts.error_windows(metrics.overview(parsed(spark, sf_dir), exact_ips=False))


def q_endpoint_share(spark, sf_dir):
    """D3 without a cut: all endpoints of the weighted feed."""
    return dashboards.top_endpoints(parsed(spark, sf_dir, "weighted"), k=10)


def q_hour_active_ips_error(spark, sf_dir):
    """A6 against A7: hours with hundreds of clients (dense feed), exact count and
    whether the HLL++ estimate is within three times its stated error."""
    return metrics.active_ips_error(parsed(spark, sf_dir, "dense"))


def q_publish_lines_envelope(spark, sf_dir):
    """Text log files published as an envelope table, decoded again."""
    from loglens.streaming import sinks
    target = scratch_path(spark, "published")
    sinks.publish_lines(spark, feeds.text_feed_path(spark, sf_dir), target, glob=files.TEXT_GLOB)
    rows = parse.decode(kafka.envelope_batch(spark, target))
    return rows.groupBy("topic", "value").agg(F.count_distinct("partition", "offset").alias("records"),
                                              F.count("date").alias("dated"))


def q_text_file_lines(spark, sf_dir):
    """Plain text log files with their names; every line comes from one file."""
    lines = files.log_files(spark, feeds.text_feed_path(spark, sf_dir, compression="none"), glob=files.TEXT_GLOB)
    return lines.groupBy("value").agg(F.count(F.lit(1)).alias("lines"),
                                      F.bool_and(F.col("file_name").rlike(r"^part-.*\.txt$")).alias("named"))


def q_gzip_member_lines(spark, sf_dir):
    """Gzip text log files read by byte ranges, at the starts of their members."""
    lines = gzip_members.gzip_log_lines(spark, feeds.text_feed_path(spark, sf_dir), "part-*.gz", split_bytes=1 << 16)
    return lines.groupBy("value").agg(F.count(F.lit(1)).alias("lines"))


def q_status_class_share(spark, sf_dir):
    """Requests and share per status class."""
    return dashboards.status_class_share(parsed(spark, sf_dir))


def q_top_endpoints(spark, sf_dir):
    """D3: ten most requested of 23 endpoints, with ties at the cut (wide feed)."""
    return dashboards.top_endpoints(parsed(spark, sf_dir, "wide"), k=10)


def q_user_agent_share(spark, sf_dir):
    """Requests by browser and device."""
    return dashboards.user_agent_share(parsed(spark, sf_dir))


def q_access_heatmap(spark, sf_dir):
    """Requests by day of week and hour."""
    return dashboards.access_heatmap(parsed(spark, sf_dir))


def q_client_profile(spark, sf_dir):
    """Per-IP requests, endpoints, first/last seen, errors."""
    return dashboards.client_profile(parsed(spark, sf_dir))


def q_json_alerts(spark, sf_dir):
    """JSON app-log severity alerts."""
    app = alerts.json_alerts(feeds.feed(spark, sf_dir, "json"), keep=("offset",))
    return app.select(
        "offset", _ntz("kafka_ingestion_time"), _ntz("log_timestamp"),
        "log_level", "log_message", "user_id")


def q_error_anomalies(spark, sf_dir):
    """Endpoint-hour error z-scores >= 3 over the previous 24."""
    return alerts.error_anomalies(parsed(spark, sf_dir))


def q_log_search(spark, sf_dir):
    """Search over the raw envelope feed."""
    hits = dashboards.search_feed(decoded(spark, sf_dir), **SEARCH)
    return hits.select("offset", _ntz("timestamp"), "ip", "request", "status")


def q_lake_log_search(spark, sf_dir):
    """D10 on the parsed, date-partitioned lake: the date range prunes folders,
    the status / substring / time predicates are pushed into the Parquet scan."""
    lake = spark.read.parquet(feeds.parsed_lake_path(spark, sf_dir))
    hits = dashboards.log_search(lake, **SEARCH)
    return hits.select("offset", _ntz("timestamp"), "ip", "request", "status")


def q_indexed_log_search(spark, sf_dir):
    """D10 by the n-gram index: only files whose filter has all grams of the needle and the client's IP are read."""
    lake = feeds.parsed_lake_path(spark, sf_dir)
    index = feeds.search_index_path(spark, lake)
    search_index.index_lake(spark, lake, index)
    hits = search_index.indexed_search(spark, lake, index, **INDEXED_SEARCH)
    return hits.select("offset", _ntz("timestamp"), "ip", "request", "status")


def batch_queries() -> dict[str, Query]:
    return {
        "envelope_decode": q_envelope_decode,
        "access_log_parse": q_access_log_parse,
        "access_log_typed": q_access_log_typed,
        "access_log_parse_any": q_access_log_parse_any,
        "access_log_enriched": q_access_log_enriched,
        "parse_quality": q_parse_quality,
        "text_log_quality": q_text_log_quality,
        "minute_metrics": q_minute_metrics,
        "minute_overview": q_minute_overview,
        "dense_minute_overview": q_dense_minute_overview,
        "minute_active_ips_exact": q_minute_active_ips_exact,
        "minute_active_ips_approx": q_minute_active_ips_approx,
        "minute_mean_bytes": q_minute_mean_bytes,
        "event_time_minute_metrics": q_event_time_minute_metrics,
        "error_windows": q_error_windows,
        "status_class_share": q_status_class_share,
        "top_endpoints": q_top_endpoints,
        "endpoint_share": q_endpoint_share,
        "hour_active_ips_error": q_hour_active_ips_error,
        "publish_lines_envelope": q_publish_lines_envelope,
        "text_file_lines": q_text_file_lines,
        "gzip_member_lines": q_gzip_member_lines,
        "user_agent_share": q_user_agent_share,
        "access_heatmap": q_access_heatmap,
        "client_profile": q_client_profile,
        "json_alerts": q_json_alerts,
        "error_anomalies": q_error_anomalies,
        "log_search": q_log_search,
        "lake_log_search": q_lake_log_search,
        "indexed_log_search": q_indexed_log_search,
    }


def all_queries() -> dict[str, Query]:
    from loglens.streaming import queries as sq
    return {name: _in_utc(q) for name, q in (batch_queries() | sq.stream_queries()).items()}


def _in_utc(query: Query) -> Query:
    """The query in a session that is set up for it, whatever the caller's zone was."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return query(configure(spark), sf_dir)
    run.__doc__ = query.__doc__
    return run
