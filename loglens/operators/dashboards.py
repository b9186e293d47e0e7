"""Dashboard queries over parsed access records.

Each is one aggregation with map-side combine. "Parsed rows only" is
applied as a conditional count plus a filter on the aggregate output,
never as a row filter on a parsed field: Catalyst would push such a
filter below the parse projection and evaluate the regex twice per line.
Only D3 sorts, and it keeps just the top ``k`` rows per partition
(``TakeOrderedAndProject``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loglens.functions import parsing as fx


def is_parsed() -> Column:
    """True for a line the extended pattern matched."""
    return F.col("status") != ""


def _parsed_count() -> Column:
    return F.count_if(is_parsed()).alias("requests")


def status_class_share(parsed: DataFrame) -> DataFrame:
    """Requests per status class and its share of all parsed requests.

    The total comes from a window over the aggregated result, which has at
    most ten rows (one per leading digit), so no join and no big group.
    """
    by_class = parsed.groupBy(fx.status_class_of(F.col("status")).alias("status_class")) \
        .agg(_parsed_count()).where(F.col("requests") > 0)
    total = F.sum("requests").over(Window.partitionBy())
    return by_class.select("status_class", "requests",
                           F.round(F.col("requests") * 100.0 / total, 2).alias("share_percent"))


def top_endpoints(parsed: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` most requested endpoints; ties broken by endpoint name."""
    return parsed.groupBy(fx.endpoint_of(F.col("request")).alias("endpoint")) \
        .agg(_parsed_count()).where(F.col("requests") > 0) \
        .orderBy(F.col("requests").desc(), F.col("endpoint").asc()).limit(k)


def user_agent_share(parsed: DataFrame) -> DataFrame:
    ua = F.col("user_agent")
    return parsed.groupBy(fx.browser_of(ua).alias("browser"), fx.device_of(ua).alias("device")) \
        .agg(_parsed_count()).where(F.col("requests") > 0)


def access_heatmap(parsed: DataFrame) -> DataFrame:
    """Requests by (day of week 1=Sunday..7, hour of day) of event time.

    Rows without a valid event time (unparsed lines included) fall in the
    NULL cell, whose count of event times is 0, and are dropped.
    """
    et = fx.access_time(F.col("datetime"))
    return parsed.select(et.alias("et")).groupBy(
        F.dayofweek("et").alias("day_of_week"), F.hour("et").alias("hour")
    ).agg(F.count("et").alias("requests")).where(F.col("requests") > 0)


def client_profile(parsed: DataFrame) -> DataFrame:
    """Per client IP: requests, distinct endpoints, first/last seen, errors.

    count(distinct endpoint) is planned by Spark as a two-phase aggregate
    keyed first by (ip, endpoint), so a single very busy IP is spread over
    many reducers before the final per-IP merge. Unparsed lines all carry
    ip '' and form one group with no parsed request, which is dropped.
    """
    prep = parsed.select(
        "ip", is_parsed().alias("ok"),
        fx.endpoint_of(F.col("request")).alias("endpoint"),
        fx.access_time(F.col("datetime")).alias("event_time"),
        fx.is_error_class(fx.status_class_of(F.col("status"))).alias("err"))
    return prep.groupBy("ip").agg(
        F.count_if("ok").alias("requests"),
        F.count_distinct("endpoint").alias("endpoints"),
        F.min("event_time").cast("timestamp_ntz").alias("first_seen"),
        F.max("event_time").cast("timestamp_ntz").alias("last_seen"),
        F.count_if("err").alias("errors"),
    ).where(F.col("requests") > 0)


def _time_range(df: DataFrame, start: str | None, end: str | None) -> Column:
    """``[start, end)`` on ``timestamp``; on a table with ``date`` folders also on
    those, where a record without a date (not from a dated folder) stays."""
    cond = F.lit(True)
    for bound, low in ((start, True), (end, False)):
        if bound is not None:
            at = F.lit(bound).cast("timestamp")
            cond = cond & ((F.col("timestamp") >= at) if low else (F.col("timestamp") < at))
            if "date" in df.columns:
                day = F.to_date(at)
                inside = F.col("date") >= day if low else F.col("date") <= day
                cond = cond & (inside | F.col("date").isNull())
    return cond


def log_search(parsed: DataFrame, contains: str | None = None, status: str | None = None,
               start: str | None = None, end: str | None = None,
               ip: str | None = None) -> DataFrame:
    """Rows matching every given predicate; ``[start, end)`` on ingest time.

    The predicates are plain column filters: on a lake with ``date`` folders
    the time range prunes partitions, and the rest is pushed to the scan.
    """
    cond = _time_range(parsed, start, end)
    if status is not None:
        cond = cond & (F.col("status") == status)
    if contains is not None:
        cond = cond & F.col("request").contains(contains)
    if ip is not None:
        cond = cond & (F.col("ip") == ip)
    return parsed.where(cond)


def search_feed(decoded: DataFrame, keep: tuple[str, ...] = ("offset", "timestamp"),
                **params) -> DataFrame:
    """``log_search`` over raw (decoded) records.

    Necessary conditions are checked on the raw line first - the time range
    on the record time stamp and a plain substring test for ``contains``
    and ``status`` - so only candidate lines pay for the regex parse, which
    runs once per candidate (``parse_access_matched``).
    """
    from loglens.operators import parse
    raw = _time_range(decoded, params.get("start"), params.get("end"))
    for k in ("contains", "status", "ip"):
        if params.get(k) is not None:
            raw = raw & F.col("value").contains(params[k])
    return log_search(parse.parse_access_matched(decoded.where(raw), keep=keep), **params)
