"""Alerting: JSON application logs, severity filter, error windows, anomalies."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loglens.functions import parsing as fx
from loglens.functions import patterns as P

# The fields of one JSON application-log record and their types.
APP_LOG_SCHEMA = T.StructType([
    T.StructField("timestamp", T.TimestampType(), True),
    T.StructField("level", T.StringType(), True),
    T.StructField("message", T.StringType(), True),
    T.StructField("user_id", T.IntegerType(), True),
])
# Output columns of an application-log record, by JSON field.
APP_LOG_COLUMNS = {"timestamp": "log_timestamp", "level": "log_level", "message": "log_message",
                   "user_id": "user_id"}


def parse_json_log(envelope: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Kafka record with a JSON value -> flat app-log columns.

    PERMISSIVE parsing: a field that is missing or of the wrong type is
    NULL, a non-JSON value gives a row of NULLs; no row is lost here.
    """
    doc = "__loglens_doc"
    records = envelope.select(*keep, F.col("timestamp").alias("kafka_ingestion_time"),
                              F.from_json(F.col("value").cast("string"), APP_LOG_SCHEMA).alias(doc))
    return records.select(*keep, "kafka_ingestion_time",
                          *[F.col(f"{doc}.{name}").alias(out) for name, out in APP_LOG_COLUMNS.items()],
                          F.current_timestamp().alias("processing_time"))


def severity_filter(app_log: DataFrame, levels: tuple[str, ...] = P.ALERT_LEVELS) -> DataFrame:
    """Keep records whose level is one of ``levels`` (case-sensitive; NULL dropped).

    A plain column filter, so on stored records it reaches the Parquet scan."""
    return app_log.where(F.col("log_level").isin(*levels))


def json_alerts(envelope: DataFrame, keep: tuple[str, ...] = (),
                levels: tuple[str, ...] = P.ALERT_LEVELS) -> DataFrame:
    """``severity_filter`` of freshly parsed records, with one JSON parse each.

    A row filter would be pushed below ``from_json``: every record would be
    tokenized for the level and the survivors parsed again. Rows are kept
    through a zero- or one-row generator instead (see ``keep_where``)."""
    return fx.keep_where(parse_json_log(envelope, keep), F.col("log_level").isin(*levels))


def error_windows(overview: DataFrame, min_rate: float = 50.0, min_requests: int = 2) -> DataFrame:
    """Minutes whose error rate reaches ``min_rate`` percent with enough traffic."""
    return overview.where((F.col("error_rate_percent") >= min_rate)
                          & (F.col("request_per_minute") >= min_requests)) \
        .select("window_start", F.col("request_per_minute").alias("total_requests"),
                "error_rate_percent")


def endpoint_hour_errors(parsed: DataFrame) -> DataFrame:
    """(endpoint, hour_start, errors): rows with status >= 400 per endpoint-hour.

    Every endpoint-hour with traffic is present (errors may be 0); rows
    without a valid event time (unparsed lines included) form the NULL
    hour, whose count of event times is 0, and are dropped after the
    aggregate. Partial aggregation before the shuffle keeps hot endpoints
    cheap.
    """
    et = fx.access_time(F.col("datetime"))
    prep = parsed.select(
        fx.endpoint_of(F.col("request")).alias("endpoint"),
        F.date_trunc("hour", et).alias("hour_start"),
        fx.is_error_class(fx.status_class_of(F.col("status"))).alias("err"))
    return prep.groupBy("endpoint", "hour_start").agg(
        F.count_if("err").alias("errors"), F.count("hour_start").alias("_n")
    ).where(F.col("_n") > 0).select(
        "endpoint", F.col("hour_start").cast("timestamp_ntz").alias("hour_start"), "errors")


def error_anomalies(parsed: DataFrame, history: int = 24, threshold: float = 3.0) -> DataFrame:
    """Endpoint-hours whose error count is ``threshold`` sigmas above the
    endpoint's previous ``history`` endpoint-hours.

    Runs on the aggregated endpoint-hour table, so a window partition holds
    at most one row per hour of the endpoint's history regardless of how
    much traffic the endpoint has.
    """
    eh = endpoint_hour_errors(parsed)
    w = Window.partitionBy("endpoint").orderBy("hour_start").rowsBetween(-history, -1)
    mean = F.avg("errors").over(w)
    sd = F.stddev_pop("errors").over(w)
    z = F.round((F.col("errors") - mean) / F.when(sd != 0, sd), 4)
    return eh.select("endpoint", "hour_start", "errors", z.alias("z_score")) \
        .where(F.col("z_score") >= threshold)
