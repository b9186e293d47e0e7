"""Deterministic log feeds derived from the ``events`` table.

The reference ships no data; its feed is a random access-log generator
writing to Kafka. Here every ``events`` row becomes one Kafka-shaped
record (the *envelope*) whose ``value`` is an access-log line or a JSON
application-log line. The rules are in FIXTURES.md section 2 and are
mirrored by the DuckDB oracle (``loglens.plans.oracle``).

Everything is a map-only projection over ``events``: it scales with the
table and never shuffles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# --- fixed values: generated line contents --------------------------------
RESOURCES = ("/list", "/wp-content", "/wp-admin", "/explore", "/search/tag/list",
             "/app/main/posts", "/posts/posts/explore")
CART_PREFIX = "/apps/cart.jsp?appID="
WEIGHTED_RESOURCES = ("/list", "/explore", "/wp-admin", "/wp-content")
REFERER_PREFIX = "http://ref.example.com/"
UA_FIREFOX = "Mozilla/5.0 (X11; Linux x86_64) Gecko/20100101 Firefox/120.0"
UA_CHROME = "Mozilla/5.0 (Windows NT 10.0) Chrome/120.0 Safari/537.36"
UA_SAFARI = "Mozilla/5.0 (iPhone; CPU iPhone OS 16_0) Version/16.0 Mobile Safari/604.1"
UA_MSIE = "Mozilla/5.0 (compatible; MSIE 9.0; Windows NT 6.1; Trident/5.0)"
UA_OPERA = "Opera/9.80 (X11) Presto/2.9 Version/11.00"
GARBAGE_LINE = "garbage line"
ACCESS_TOPIC = "access_log"
APP_TOPIC = "app_log"
VARIANTS = ("plain", "dense", "late", "weighted", "wide", "tardy")
# Distinct endpoints of the wide variant, more than any top-k list shows.
WIDE_ENDPOINTS = 23

ENVELOPE_COLUMNS = ("key", "value", "topic", "partition", "offset", "timestamp")


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _s(c: Column) -> Column:
    return c.cast("string")


def _uri(eid: Column, variant: str) -> Column:
    if variant == "weighted":
        m = eid % 13
        return (F.when(m <= 4, F.lit(WEIGHTED_RESOURCES[0]))
                .when(m <= 8, F.lit(WEIGHTED_RESOURCES[1]))
                .when(m <= 11, F.lit(WEIGHTED_RESOURCES[2]))
                .otherwise(F.lit(WEIGHTED_RESOURCES[3])))
    if variant == "wide":
        return F.concat(F.lit("/page/"), _s(eid % WIDE_ENDPOINTS))
    m = eid % 8
    out = F.when(m == 7, F.concat(F.lit(CART_PREFIX), _s(F.lit(1000) + eid % 9001)))
    for i, r in enumerate(RESOURCES):
        out = out.when(m == i, F.lit(r))
    return out


def _verb(eid: Column) -> Column:
    m = eid % 10
    return (F.when(m <= 5, F.lit("GET")).when(m == 6, F.lit("POST"))
            .when(m == 7, F.lit("DELETE")).otherwise(F.lit("PUT")))


def _status(eid: Column, event_type: Column) -> Column:
    return (F.when(event_type == "error", F.when(eid % 2 == 0, F.lit("404")).otherwise(F.lit("500")))
            .when(eid % 25 == 1, F.lit("301")).otherwise(F.lit("200")))


def _user_agent(eid: Column) -> Column:
    m = eid % 20
    return (F.when(m <= 9, F.lit(UA_FIREFOX)).when(m <= 15, F.lit(UA_CHROME))
            .when(m <= 17, F.lit(UA_SAFARI)).when(m == 18, F.lit(UA_MSIE))
            .otherwise(F.lit(UA_OPERA)))


def access_lines(events: DataFrame, variant: str = "plain") -> DataFrame:
    """``events`` -> (offset, ingest_ts timestamp_ntz, line string)."""
    if variant not in VARIANTS:
        raise ValueError(f"unknown variant {variant!r}; expected one of {VARIANTS}")
    eid = F.col("event_id")
    ts = F.col("ts")
    if variant == "dense":
        ingest = F.timestamp_add("MILLISECOND", eid * 1500,
                                F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))
        event = ingest
    elif variant == "tardy":
        # The dense feed, where every seventh line is a quarter of an hour late.
        ingest = F.timestamp_add("MILLISECOND", eid * 1500,
                                F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))
        event = F.timestamp_add("MINUTE", F.when(eid % 7 == 0, F.lit(-15)).otherwise(F.lit(0)), ingest)
    elif variant == "late":
        ingest = ts
        event = F.timestamp_add("SECOND", F.lit(-20) * (eid % 5), ts)
    else:
        ingest = ts
        event = ts
    ip = F.concat(F.lit("10.0."), _s(F.floor(F.col("user_id") / 256)), F.lit("."),
                  _s(F.col("user_id") % 256))
    stamp = F.concat(F.date_format(event, "dd/MMM/yyyy:HH:mm:ss"), F.lit(" +0000"))
    head = F.concat(ip, F.lit(" - - ["), stamp, F.lit('] "'), _verb(eid), F.lit(" "),
                    _uri(eid, variant), F.lit(' HTTP/1.0" '), _status(eid, F.col("event_type")))
    size = _s(F.lit(4800) + eid % 401)
    referer = F.concat(F.lit(REFERER_PREFIX), _s(F.col("user_id") % 7))
    ua = _user_agent(eid)
    line = (F.when(eid % 101 == 0, F.lit(GARBAGE_LINE))
            .when(eid % 97 == 0, F.concat(head, F.lit(" "), size))
            .when(eid % 103 == 0, F.concat(head, F.lit(' - "-" "'), ua, F.lit('"')))
            .otherwise(F.concat(head, F.lit(" "), size, F.lit(' "'), referer,
                                F.lit('" "'), ua, F.lit('"'))))
    return events.select(eid.alias("offset"), ingest.alias("ingest_ts"), line.alias("line"))


def json_lines(events: DataFrame, variant: str = "plain") -> DataFrame:
    """``events`` -> (offset, ingest_ts, line) with JSON application-log lines; in
    the ``undated`` variant every fifth one has no time stamp of its own."""
    eid = F.col("event_id")
    stamp = F.date_format(F.col("ts"), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    if variant == "undated":
        stamp = F.when(eid % 5 != 0, stamp)
    et = F.col("event_type")
    level = (F.when(et == "error", F.when(eid % 3 == 0, F.lit("CRITICAL")).otherwise(F.lit("ERROR")))
             .when(et == "purchase", F.lit("WARN")).otherwise(F.lit("INFO")))
    doc = F.to_json(F.struct(
        stamp.alias("timestamp"),
        level.alias("level"), et.alias("message"), F.col("user_id").alias("user_id")))
    line = F.when(eid % 89 == 0, F.lit("notjson")).otherwise(doc)
    return events.select(eid.alias("offset"), F.col("ts").alias("ingest_ts"), line.alias("line"))


def to_envelope(lines: DataFrame, topic: str, partitions: int = 3) -> DataFrame:
    """(offset, ingest_ts, line) -> the Kafka record schema.

    ``key`` is NULL (the producer sends none); ``timestamp`` is a
    ``timestamp`` (instant) like Kafka's, read as UTC wall-clock.
    """
    return lines.select(
        F.lit(None).cast("binary").alias("key"),
        F.encode(F.col("line"), "UTF-8").alias("value"),
        F.lit(topic).alias("topic"),
        (F.col("offset") % partitions).cast("int").alias("partition"),
        F.col("offset").cast("bigint").alias("offset"),
        F.col("ingest_ts").cast("timestamp").alias("timestamp"),
    )


def access_envelope(spark: SparkSession, sf_dir: str, variant: str = "plain") -> DataFrame:
    return to_envelope(access_lines(load_table(spark, sf_dir, "events"), variant), ACCESS_TOPIC)


def json_envelope(spark: SparkSession, sf_dir: str, variant: str = "plain") -> DataFrame:
    return to_envelope(json_lines(load_table(spark, sf_dir, "events"), variant), APP_TOPIC)
