"""Live dashboards: the batch operators that need history, as stateful streams.

* ``live_anomalies`` (D9): endpoint-hours close with the watermark (an ordinary
  windowed aggregate with map-side combine) and then meet the endpoint's
  rolling baseline, its previous ``history`` hours, in keyed state. The state of
  an endpoint is that many numbers, whatever its traffic. With ``forget`` an
  event-time timer drops the baseline of an endpoint that had no hour for so long.
* ``live_error_windows`` (D8): closed minutes with a high error rate.
* ``live_active_ips`` (A7): the exact number of client IPs of each closed window
  by two chained stateful operators: one row per (window, IP), then a count.
* ``live_client_profile`` (D7): running totals per client IP, with its distinct endpoints
  in keyed state, dropped when the client was idle for ``ttl``.

What Spark's aggregates can't keep (the baseline, a profile with a lifetime) is in
``transformWithState`` processors. They see aggregated rows only, one per endpoint or
(IP, endpoint) and closed hour, so a hot client is combined map-side first.
"""

from __future__ import annotations

import datetime as dt
import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from loglens.functions import parsing as fx
from loglens.operators import alerts, metrics

EPOCH = dt.datetime(1970, 1, 1)


def closed_endpoint_hours(parsed: DataFrame, watermark: str) -> DataFrame:
    """(endpoint, hour, errors) of a stream, each endpoint-hour once, when the watermark has passed it.

    ``hour`` is the last instant of the hour, which carries the watermark on."""
    et = fx.access_time(F.col("datetime"))
    prep = parsed.select(et.alias("event_time"), fx.endpoint_of(F.col("request")).alias("endpoint"),
                         fx.is_error_class(fx.status_class_of(F.col("status"))).alias("err"))
    timed = fx.keep_where(prep, F.col("event_time").isNotNull()).withWatermark("event_time", watermark)
    return (timed.groupBy(F.window("event_time", "1 hour").alias("window"), "endpoint")
            .agg(F.count_if("err").alias("errors"))
            .select("endpoint", F.window_time("window").alias("hour"), F.col("window.start").alias("hour_start"), "errors"))


class Baseline(StatefulProcessor):
    """The previous ``history`` error counts of an endpoint; scores each new hour against them."""

    def __init__(self, history: int, forget_ms: int | None):
        self.history, self.forget_ms = history, forget_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.before = handle.getListState("before", T.StructType([T.StructField("errors", T.LongType())]))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        hours = pd.concat(list(rows)).sort_values("hour_start")
        past = [int(r[0]) for r in self.before.get()]
        out = []
        for start, errors in zip(hours["hour_start"], hours["errors"].astype(int), strict=True):
            n, total, squares = len(past), sum(past), sum(e * e for e in past)
            spread = n * squares - total * total   # n^2 times the variance, exact
            if spread > 0:
                out.append((key[0], start, errors, (n * errors - total) / math.sqrt(spread)))
            past = [*past, errors][-self.history:]
        self.before.put([(e,) for e in past])
        if self.forget_ms is not None:
            for t in list(self.handle.listTimers()):
                self.handle.deleteTimer(t)
            last = hours["hour_start"].max().tz_localize(None)
            self.handle.registerTimer(int((last - EPOCH).total_seconds() * 1000) + 3_600_000 + self.forget_ms)
        yield pd.DataFrame(out, columns=["endpoint", "hour_start", "errors", "z"])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.before.clear()
        yield pd.DataFrame(columns=["endpoint", "hour_start", "errors", "z"])

    def close(self) -> None:
        pass


def _ms(interval: str | None) -> int | None:
    return None if interval is None else int(pd.Timedelta(interval).total_seconds() * 1000)


def live_anomalies(parsed: DataFrame, watermark: str, history: int = 24, threshold: float = 3.0, forget: str | None = None) -> DataFrame:
    """``alerts.error_anomalies`` over a stream, append mode: each anomalous endpoint-hour once, when the watermark closes it.

    Closed hours reach the baseline in their order, so the result equals the batch one on closed hours.
    ``forget`` (e.g. '30 days'; default: never, as in batch) bounds the state by endpoints alive in that time."""
    hours = closed_endpoint_hours(parsed, watermark)
    found = hours.groupBy("endpoint").transformWithStateInPandas(
        Baseline(history, _ms(forget)), "endpoint string, hour_start timestamp, errors long, z double", "append", "EventTime")
    return (found.select("endpoint", "hour_start", "errors", F.round("z", 4).alias("z_score"))
            .where(F.col("z_score") >= threshold))


def live_error_windows(parsed: DataFrame, watermark: str, min_rate: float = 50.0, min_requests: int = 2) -> DataFrame:
    """``alerts.error_windows`` over a stream, append mode: each minute with too many errors once, when it is closed."""
    closed = metrics.flatten_window(metrics.window_metrics(parsed, "timestamp", watermark=watermark), ntz=False)
    return alerts.error_windows(metrics.overview_from_metrics(closed), min_rate, min_requests)


def live_active_ips(parsed: DataFrame, watermark: str, width: str = metrics.MINUTE) -> DataFrame:
    """Exact distinct client IPs of each closed window (append mode).

    The first operator keeps one row per (window, IP), combined map-side and spread over all tasks whatever the window's
    traffic; it passes them on when the window closes, and the second one counts them. The state holds the
    clients of the open windows only."""
    per_ip = (parsed.withWatermark("timestamp", watermark)
              .groupBy(F.window("timestamp", width).alias("window"), "ip").agg(F.count(F.lit(1)).alias("_n")))
    return (per_ip.groupBy(F.window(F.window_time("window"), width).alias("window"))
            .agg(F.count("ip").alias("active_ip_count"))
            .select(F.col("window.start").alias("window_start"), "active_ip_count"))


PROFILE = "ip string, requests long, endpoints long, first_seen timestamp, last_seen timestamp, errors long, hour timestamp"


class Profile(StatefulProcessor):
    """Totals of a client, and the endpoints it has asked for, as long as it is not idle for ``ttl_ms``."""

    def __init__(self, ttl_ms: int | None):
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.totals = handle.getValueState("totals", "requests long, errors long, endpoints long, first long, last long")
        self.known = handle.getMapState("known", "endpoint string", "hour long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        new = pd.concat(list(rows))
        hour = int(new["hour_us"].max())
        old = self.totals.get() if self.totals.exists() else None
        requests, errors, endpoints = (0, 0, 0) if old is None else old[:3]
        for endpoint in new["endpoint"].dropna().unique():
            if not self.known.containsKey((endpoint,)):
                self.known.updateValue((endpoint,), (hour,))
                endpoints += 1
        requests, errors = requests + int(new["requests"].sum()), errors + int(new["errors"].sum())
        first, last = int(new["first_us"].min()), int(new["last_us"].max())
        if old is not None:
            first, last = min(first, old[3]), max(last, old[4])
        self.totals.update((requests, errors, endpoints, first, last))
        if self.ttl_ms is not None:
            for t in list(self.handle.listTimers()):
                self.handle.deleteTimer(t)
            self.handle.registerTimer(hour // 1000 + 1 + self.ttl_ms)
        at = lambda us: pd.Timestamp(us, unit="us", tz="UTC")
        yield pd.DataFrame([(key[0], requests, endpoints, at(first), at(last), errors, at(hour))],
                           columns=["ip", "requests", "endpoints", "first_seen", "last_seen", "errors", "hour"])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.totals.clear()
        self.known.clear()
        yield pd.DataFrame(columns=["ip", "requests", "endpoints", "first_seen", "last_seen", "errors", "hour"])

    def close(self) -> None:
        pass


def live_client_profile(parsed: DataFrame, watermark: str, ttl: str | None = None) -> DataFrame:
    """``dashboards.client_profile`` over a stream, append mode: a client's profile again whenever an hour with its requests closes.

    ``latest_profiles`` picks the newest row per client. ``ttl`` (e.g. '30 days'; default: never) drops the
    state of clients that were idle so long, by an event-time timer; one that comes back starts anew."""
    status = fx.status_class_of(F.col("status"))
    prep = parsed.select("ip", F.col("status").alias("s"), fx.access_time(F.col("datetime")).alias("event_time"),
                         fx.endpoint_of(F.col("request")).alias("endpoint"), fx.is_error_class(status).alias("err"))
    timed = fx.keep_where(prep, (F.col("s") != "") & F.col("event_time").isNotNull()).withWatermark("event_time", watermark)
    hours = (timed.groupBy(F.window("event_time", "1 hour").alias("window"), "ip", "endpoint")
             .agg(F.count(F.lit(1)).alias("requests"), F.count_if("err").alias("errors"),
                  F.min(F.unix_micros("event_time")).alias("first_us"), F.max(F.unix_micros("event_time")).alias("last_us"))
             .select("ip", "endpoint", "requests", "errors", "first_us", "last_us", F.window_time("window").alias("hour"),
                     F.unix_micros(F.window_time("window")).alias("hour_us")))
    return hours.groupBy("ip").transformWithStateInPandas(Profile(_ms(ttl)), PROFILE, "append", "EventTime")


def latest_profiles(profiles: DataFrame) -> DataFrame:
    """The newest profile of every client among all rows that ``live_client_profile`` has emitted."""
    rest = [c for c in profiles.columns if c != "ip"]
    return (profiles.groupBy("ip").agg(F.max_by(F.struct(*rest), F.col("hour")).alias("p"))
            .select("ip", *[f"p.{c}" for c in rest if c != "hour"]))
