"""Live top lists from sketches, and corrections by late rows."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from conftest import SF01
from loglens.operators import dashboards, top_lists
from loglens.plans import queries as Q
from loglens.sources import feeds, kafka
from loglens.streaming import jobs, runner, sinks, tables


def _records(spark, counts, seed=1):
    rows = [(f"GET /{e}?q={i % 7} HTTP/1.0", "200") for e, n in counts.items() for i in range(n)]
    rows += [("", "")] * 50
    random.Random(seed).shuffle(rows)
    return spark.createDataFrame([(r, s, i) for i, (r, s) in enumerate(rows)], "request string, status string, i long").withColumn(
        "timestamp", F.lit("2024-01-01").cast("timestamp") + F.make_interval(days=F.col("i") % 3)).repartition(4)


def _sketched(records, items, batches=6):
    out = None
    for b in range(batches):
        part = top_lists.endpoint_sketches(records.where(F.col("i") % batches == b), items).withColumn("batch_id", F.lit(b).cast("long"))
        out = part if out is None else out.unionByName(part)
    return out


ZIPF = {f"p{i}": max(1, int(4000 / (i + 1) ** 1.2)) for i in range(1500)}


def test_estimates_stay_within_the_stated_error(spark):
    items = 128
    sketches = _sketched(_records(spark, ZIPF), items)
    total, bound = sum(ZIPF.values()), top_lists.error_bound(sum(ZIPF.values()), items)
    assert sketches.agg(F.sum("requests")).first()[0] == total
    for rows in (sketches, top_lists.add_sketches(sketches, items)):
        found = {r.endpoint.removeprefix("/"): r.estimate for r in top_lists.candidates(rows, items).collect()}
        assert all(abs(n - ZIPF[e]) <= bound for e, n in found.items())
        # Whatever is left out is below the bound, so the head is complete.
        assert all(n <= bound for e, n in ZIPF.items() if e not in found)
        assert len(found) <= items


@pytest.mark.parametrize("counts,items", [(ZIPF, 128), (ZIPF, 1024), ({f"e{i}": 20 for i in range(300)}, 64), ({"a": 3, "b": 3, "c": 1}, 64)])
def test_recounted_list_is_the_true_one(spark, counts, items):
    """Also where the sketch can't tell (all endpoints alike) or there are fewer than k."""
    records = _records(spark, counts)
    got = [tuple(r) for r in top_lists.live_top_endpoints(records, _sketched(records, items), 10, items).collect()]
    want = sorted(((f"/{e}", n) for e, n in counts.items()), key=lambda r: (-r[1], r[0]))[:10]
    assert got == want == [tuple(r) for r in dashboards.top_endpoints(records, 10).collect()]


@pytest.fixture()
def tardy(spark, scratch):
    """The tardy feed in twelve files in time order; a function that runs the job over it."""
    base = scratch("tardy")
    feed = feeds.feed(spark, SF01, "access", "tardy").drop("date").where("offset < 2400")
    for i in range(12):
        feed.where(F.col("offset").between(200 * i, 200 * i + 199)).coalesce(1).write.parquet(f"{base}/in/f{i:02d}")

    def run(upto, **options):
        source = kafka.envelope_file_stream(spark, f"{base}/in/f{'0' if upto < 10 else '[01]'}*", max_files_per_trigger=1, partitioned=False)
        q = jobs.start_event_time_job(spark, source, f"{base}/p", f"{base}/late", f"{base}/ck", "2 minutes", runner.AVAILABLE_NOW, **options)
        return runner.finish(q)

    return base, run


def _windows(df):
    return Counter((r.window_start, r.total_requests, r.error_4xx_count, r.error_5xx_count, r.total_bytes) for r in df.collect())


def test_late_rows_are_kept_and_correct_closed_windows(spark, tardy):
    base, run = tardy
    run(99, compact_every=5)
    from loglens.operators import metrics, parse
    feed = kafka.envelope_batch(spark, f"{base}/in/*", partitioned=False)
    parsed = parse.parse_access(parse.decode(feed), keep=("timestamp", "offset"))
    timed = metrics.with_event_time(parsed).where("event_time is not null")
    newest = timed.agg(F.max("event_time")).first()[0]
    batch = metrics.event_time_metrics(parsed).where(F.col("window_end") <= F.lit(newest) - F.expr("interval 2 minutes"))
    late = tables.read(spark, f"{base}/late")
    assert late.count() > 100 and late.where("batch_watermark is null").count() == 0
    assert late.select("offset").distinct().count() == late.count()
    emitted, corrected = (_windows(jobs.closed_windows(spark, f"{base}/p", "2 minutes", path)) for path in (None, f"{base}/late"))
    assert corrected == _windows(batch) and emitted != corrected
    # No row is in both: on time and late ones together are all rows.
    assert sum(r[1] * n for r, n in _windows(jobs.closed_windows(spark, f"{base}/p", "-1 days", f"{base}/late")).items()) == timed.count()
    assert any(p["level"] > 0 for p in tables.manifest(spark, f"{base}/late")["parts"])


def test_a_replayed_batch_is_split_as_before(spark, tardy):
    import os
    base, run = tardy
    run(99)
    want = _windows(jobs.closed_windows(spark, f"{base}/p", "2 minutes", f"{base}/late"))
    kept = tables.read(spark, f"{base}/late").count()
    last = max(int(n) for n in os.listdir(f"{base}/ck/commits") if n.isdigit())
    for name in (f"{last}", f".{last}.crc"):
        if os.path.exists(f"{base}/ck/commits/{name}"):
            os.remove(f"{base}/ck/commits/{name}")
    run(99)
    assert _windows(jobs.closed_windows(spark, f"{base}/p", "2 minutes", f"{base}/late")) == want
    assert tables.read(spark, f"{base}/late").count() == kept


def test_live_list_of_a_job_equals_batch(spark, scratch):
    base = scratch("lists")
    source = kafka.envelope_file_stream(spark, feeds.feed_path(spark, SF01, "access", "wide"), max_files_per_trigger=12)
    runner.finish(jobs.start_shared_scan_job(spark, source, f"{base}/raw", f"{base}/p", f"{base}/ck", trigger=runner.AVAILABLE_NOW,
                                             endpoints_path=f"{base}/top", compact_every=2))
    raw = sinks.read_lake(spark, f"{base}/raw")
    want = [tuple(r) for r in Q.q_top_endpoints(spark, SF01).collect()]
    assert [tuple(r) for r in top_lists.live_top_endpoints(raw, sinks.read_batches(spark, f"{base}/top")).collect()] == want
