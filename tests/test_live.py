"""Live dashboards: restart, bounded state, forgetting, against the batch operators."""

import datetime as dt
import statistics

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from conftest import SF01
from loglens.operators import alerts, metrics, parse, search_index
from loglens.plans import queries as Q
from loglens.sources import feeds, kafka
from loglens.streaming import live, runner, sinks

LINE = '10.0.0.{ip} - - [{stamp} +0000] "GET {endpoint} HTTP/1.0" {status} 100 "-" "UA"'


def _drop(spark, inbox, name, hits):
    """One envelope file of (time, endpoint, status, ip) requests."""
    rows = [(None, LINE.format(ip=ip, stamp=t.strftime("%d/%b/%Y:%H:%M:%S"), endpoint=e, status=s).encode(), "access_log", 0, i, t)
            for i, (t, e, s, ip) in enumerate(hits)]
    spark.createDataFrame(rows, kafka.ENVELOPE_SCHEMA).coalesce(1).write.parquet(f"{inbox}/{name}")


def _run(spark, base, build):
    source = kafka.envelope_file_stream(spark, f"{base}/in/*", partitioned=False)
    q = runner.run_available(spark, lambda: sinks.parquet_append(
        build(parse.parse_access(parse.decode(source), keep=("timestamp",))), f"{base}/out", f"{base}/ck", runner.AVAILABLE_NOW), state_partitions=2)
    return runner.summarize(q), spark.read.parquet(f"{base}/out")


def _hours(start, counts, endpoint, first=dt.datetime(2024, 1, 1)):
    """One request and ``counts[i]`` failed ones in each hour from ``start`` on."""
    out = []
    for i, n in enumerate(counts):
        at = first + dt.timedelta(hours=start + i)
        out += [(at + dt.timedelta(minutes=1), endpoint, "200", 1)]
        out += [(at + dt.timedelta(minutes=2, seconds=j), endpoint, "500", 2) for j in range(n)]
    return out


def _brute(counts, history=24, threshold=3.0):
    out = {}
    for i, n in enumerate(counts):
        past = counts[max(0, i - history):i]
        if len(past) and statistics.pstdev(past) > 0:
            z = (n - statistics.fmean(past)) / statistics.pstdev(past)
            if z >= threshold:
                out[i] = round(z, 4)
    return out


A = [1, 0, 2, 1, 0, 1, 2, 0, 1, 9, 1, 0, 0, 1, 2, 1, 0, 1, 2, 1, 0, 1, 1, 0, 2, 1, 0, 1, 30, 1, 0, 12, 1, 0, 1, 1]
B = [0, 0, 0, 0, 1, 0, 5, 0, 0, 0, 0, 0, 0, 0, 0, 0, 0, 0, 0, 0, 0, 0, 0, 0, 0, 0, 0, 0, 0, 0, 0, 0, 3, 0, 0, 0]


def test_anomalies_over_restarts_equal_brute_force(spark, scratch):
    base = scratch("anomalies")
    build = lambda p: live.live_anomalies(p, "10 minutes")
    for i, (low, high) in enumerate([(0, 11), (11, 29), (29, 36)]):
        _drop(spark, f"{base}/in", f"f{i}", _hours(low, A[low:high], "/a") + _hours(low, B[low:high], "/b"))
        state, out = _run(spark, base, build)
        assert state["state_rows"][1] <= 2 * 2 and state["dropped_by_watermark"] == 0  # a list and its length per endpoint
    got = {(r.endpoint, int((r.hour_start - dt.datetime(2024, 1, 1)).total_seconds() // 3600)): r.z_score for r in out.collect()}
    want = {("/a", i): z for i, z in _brute(A[:35]).items()} | {("/b", i): z for i, z in _brute(B[:35]).items()}
    assert got == want and len(want) >= 4


def test_a_forgotten_endpoint_starts_anew(spark, scratch):
    base = scratch("forget")
    build = lambda p: live.live_anomalies(p, "10 minutes", forget="2 days")
    steps = [_hours(0, [0, 1, 0, 1, 0, 1], "/a") + _hours(0, [1, 0, 1], "/gone"),
             _hours(100, [0, 1], "/b"),              # the watermark passes both timers
             _hours(110, [40, 0], "/a") + _hours(110, [0, 0], "/b")]
    for i, hits in enumerate(steps):
        _drop(spark, f"{base}/in", f"f{i}", hits)
        state, out = _run(spark, base, build)
    # Without its old baseline the 40 errors of /a have nothing to be compared with.
    assert out.count() == 0 and state["state_rows"][1] <= 2 * 3  # with the timers


def test_live_active_ips_keep_only_open_windows(spark, scratch):
    base = scratch("ips")
    at = lambda m, s: dt.datetime(2024, 1, 1, 0, m, s)
    steps = [[(at(0, s), "/a", "200", s % 3) for s in range(30)] + [(at(1, 1), "/a", "200", 7)],
             [(at(5, 0), "/a", "200", 1), (at(0, 40), "/a", "200", 9)],   # 9 is late, yet within the watermark
             [(at(30, 0), "/a", "200", 1)], [(at(59, 0), "/a", "200", 1)]]
    for i, hits in enumerate(steps):
        _drop(spark, f"{base}/in", f"f{i}", hits)
        state, out = _run(spark, base, lambda p: live.live_active_ips(p, "10 minutes"))
    got = {r.window_start.minute: r.active_ip_count for r in out.collect()}
    assert {k: got[k] for k in (0, 1, 5)} == {0: 4, 1: 1, 5: 1}
    assert sum(state["state_rows"]) <= 2


def test_indexed_search_reads_fewer_files(spark):
    lake = feeds.parsed_lake_path(spark, SF01)
    hits = E.queries()["indexed_log_search"](spark, SF01)
    read, whole = len(hits.inputFiles()), len(spark.read.parquet(lake).inputFiles())
    assert hits.count() > 0 and read < whole
    some = search_index.candidate_files(spark, lake, feeds.search_index_path(spark, lake), **Q.INDEXED_SEARCH)
    assert some.count() == read


@pytest.mark.parametrize("watermark", ["10 minutes"])
def test_live_error_windows_equal_batch(spark, scratch, watermark):
    base = scratch("windows")
    hits = _hours(0, [3, 0, 5, 1], "/a")
    _drop(spark, f"{base}/in", "f", hits)
    _, out = _run(spark, base, lambda p: live.live_error_windows(p, watermark))
    batch = alerts.error_windows(metrics.overview(parse.parse_access(parse.decode(
        kafka.envelope_batch(spark, f"{base}/in/*", partitioned=False)), keep=("timestamp",)), exact_ips=False))
    got = {(r.window_start, r.total_requests, r.error_rate_percent) for r in out.collect()}
    want = {(r.window_start, r.total_requests, r.error_rate_percent) for r in batch.where(F.col("window_start") < "2024-01-01 03:00:00").collect()}
    assert got == want and len(want) == 2


def test_profiles_over_restarts_and_forgotten_clients(spark, scratch):
    base = scratch("profiles")
    at = lambda h, m: dt.datetime(2024, 1, 1) + dt.timedelta(hours=h, minutes=m)
    steps = [[(at(0, 5), "/a", "200", 1), (at(0, 6), "/a", "404", 1), (at(0, 7), "/b", "200", 1), (at(1, 0), "/a", "200", 2)],
             [(at(5, 0), "/b", "500", 1), (at(5, 1), "/c", "200", 1), (at(5, 2), "/a", "200", 3)],
             [(at(200, 0), "/x", "200", 4)],                 # all others are idle for longer than the lifetime
             [(at(210, 0), "/z", "200", 1), (at(211, 0), "/z", "200", 1)], [(at(230, 0), "/x", "200", 4)]]
    seen = []
    for i, hits in enumerate(steps):
        _drop(spark, f"{base}/in", f"f{i}", hits)
        state, out = _run(spark, base, lambda p: live.live_client_profile(p, "10 minutes", ttl="3 days"))
        seen.append({r.ip[-1]: (r.requests, r.endpoints, r.first_seen, r.last_seen, r.errors) for r in live.latest_profiles(out).collect()})
    assert seen[1] == {"1": (3, 2, at(0, 5), at(0, 7), 1), "2": (1, 1, at(1, 0), at(1, 0), 0)}
    assert seen[2]["1"] == (5, 3, at(0, 5), at(5, 1), 2) and seen[2]["3"] == (1, 1, at(5, 2), at(5, 2), 0)
    assert seen[4]["1"] == (2, 1, at(210, 0), at(211, 0), 0)
    # Two clients are left, with a total, a timer and an endpoint each.
    assert state["state_rows"][1] <= 2 * 5


def _events(spark, path, users=3, hours=40):
    """An ``events`` table of own rows: a burst of errors in one hour of every endpoint."""
    rows, first = [], dt.datetime(2024, 1, 1)
    for h in range(hours):
        for i in range(16 if h != 30 else 160):
            kind = "error" if h == 30 or i == h % 5 else "view"
            rows.append((len(rows), first + dt.timedelta(hours=h, seconds=i), len(rows) % users, kind, 0.0, "{}"))
    spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string") \
        .write.parquet(f"{path}/events.parquet")


@pytest.mark.parametrize("key", ["stream_error_anomalies", "stream_client_profile"])
def test_keyed_state_in_a_session_with_sparks_default_store(spark, scratch, key):
    base, name = scratch("default-store"), "spark.sql.streaming.stateStore.providerClass"
    _events(spark, base)
    ours = spark.conf.get(name)
    spark.conf.unset(name)
    default = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
    spark.conf.set(name, default)
    try:
        assert E.queries()[key](spark, base).count() > 0
        assert spark.conf.get(name) == default
    finally:
        spark.conf.set(name, ours)
