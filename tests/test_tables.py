"""Managed tables: atomic commits, levelled compaction, concurrent writers."""

import datetime as dt
import threading

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from loglens.operators import dashboards, search_index
from loglens.plans import queries as Q
from loglens.sources import feeds, kafka
from loglens.streaming import jobs, runner, sinks, tables



def day():
    return F.to_date("at")


def _batch(spark, n, rows=40, days=(0,)):
    """``rows`` rows of batch n: key, time on one of the days, value."""
    start = dt.datetime(2024, 1, 1)
    data = [(f"k{(n * 7 + i) % 60}", start + dt.timedelta(days=days[i % len(days)], minutes=i % 1400), n * 1000 + i) for i in range(rows)]
    return spark.createDataFrame(data, "k string, at timestamp, v long").coalesce(1)


def _rows(df):
    return sorted((r.k, r.at, r.v) for r in df.collect())


def _parts(spark, path):
    return tables.manifest(spark, path)["parts"]


def test_levels_keep_all_rows_and_bound_the_files(spark, scratch):
    path, want, days = scratch("levels"), [], [(0,), (0, 1), (1,), (2,)]
    for n in range(16):
        batch = _batch(spark, n, days=days[n % 4])
        tables.write_batch(batch, path, n)
        want += _rows(batch)
        if n % 2:
            assert tables.compact(spark, path, day(), fanout=2, cluster=("k",)) == n
            per_day = {}
            for p in _parts(spark, path):
                per_day.setdefault((p["day"], p["level"]), []).append(p)
            assert all(len(group) < 2 for group in per_day.values())
            assert max(p["level"] for p in _parts(spark, path)) <= 4
    assert _rows(tables.read(spark, path)) == sorted(want)
    assert sum(p["files"] for p in _parts(spark, path)) <= 3 * 2 * 4
    before = tables.manifest(spark, path)
    assert tables.vacuum(spark, path) > 0
    assert tables.manifest(spark, path)["parts"] == before["parts"]
    assert _rows(tables.read(spark, path)) == sorted(want)


def test_bytes_rewritten_follow_what_is_new(spark, scratch):
    """Old days are not read or written again, however much they hold."""
    path = scratch("bytes")
    for n in range(8):
        tables.write_batch(_batch(spark, n, rows=20_000, days=(0, 1)), path, n)
    tables.compact(spark, path, day())
    old = {p["name"]: p["bytes"] for p in _parts(spark, path)}
    written = 0
    for n in range(8, 16):
        tables.write_batch(_batch(spark, n, rows=200, days=(5,)), path, n)
        new = _parts(spark, path)[-1]["bytes"]
        known = {p["name"] for p in _parts(spark, path)}
        tables.compact(spark, path, day(), fanout=4)
        fresh = sum(p["bytes"] for p in _parts(spark, path) if p["name"] not in known)
        assert fresh <= 12 * new
        written += fresh
    assert old.items() <= {p["name"]: p["bytes"] for p in _parts(spark, path)}.items()
    assert written < 0.3 * sum(old.values())


def test_replays_change_nothing(spark, scratch):
    path = scratch("replay")
    for n in range(4):
        tables.write_batch(_batch(spark, n), path, n)
    want = _rows(tables.read(spark, path))
    tables.write_batch(_batch(spark, 3), path, 3)
    tables.compact(spark, path, day(), max_batch_id=2)
    for n in range(4):
        tables.write_batch(_batch(spark, n), path, n)
    assert _rows(tables.read(spark, path)) == want and len([p for p in _parts(spark, path) if p["level"] == 0]) == 1
    # A batch that was written but never committed does not count, and its replay does.
    _batch(spark, 4).write.parquet(f"{path}/batch_id=4")
    assert _rows(tables.read(spark, path)) == want
    tables.write_batch(_batch(spark, 4), path, 4)
    assert len(_rows(tables.read(spark, path))) == len(want) + 40


def test_writers_and_compactions_at_the_same_time(spark, scratch):
    """Batches commit while compactions run in another thread; no row is lost or repeated."""
    path, errors, done = scratch("race"), [], threading.Event()
    tables.write_batch(_batch(spark, 0), path, 0)

    def fold():
        try:
            while not done.is_set():
                tables.compact(spark, path, day(), fanout=2)
        except Exception as e:  # noqa: BLE001 - shown below
            errors.append(e)

    threads = [threading.Thread(target=fold) for _ in range(2)]
    for t in threads:
        t.start()
    want = _rows(_batch(spark, 0))
    for n in range(1, 6):
        batch = _batch(spark, n, days=(0, 1))
        tables.write_batch(batch, path, n)
        want += _rows(batch)
        assert _rows(tables.read(spark, path)) == sorted(want)
    done.set()
    for t in threads:
        t.join()
    assert not errors
    assert _rows(tables.read(spark, path)) == sorted(want)


def test_commits_of_many_writers_are_all_kept(spark, scratch):
    path = scratch("commits")

    def add(i):
        for j in range(5):
            tables.commit(spark, path, lambda now: now | {"parts": [*now["parts"], {"name": f"{i}-{j}"}]})

    threads = [threading.Thread(target=add, args=(i,)) for i in range(6)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert {p["name"] for p in _parts(spark, path)} == {f"{i}-{j}" for i in range(6) for j in range(5)}


def test_two_compactions_of_the_same_parts(spark, scratch):
    path = scratch("twice")
    for n in range(3):
        tables.write_batch(_batch(spark, n), path, n)
    old = _parts(spark, path)
    want = _rows(tables.read(spark, path))
    late = tables._merged(spark, path, old, 1, day(), None, [], tables.TARGET_BYTES)
    tables.compact(spark, path, day())
    assert tables._swap(spark, path, old, late) is None
    assert _rows(tables.read(spark, path)) == want


def test_a_hot_day_is_written_by_many_tasks(spark, scratch):
    path = scratch("hot")
    for n in range(4):
        tables.write_batch(_batch(spark, n, rows=5000), path, n)
    want = _rows(tables.read(spark, path))
    size = sum(p["bytes"] for p in _parts(spark, path))
    tables.compact(spark, path, day(), cluster=("k",), target_bytes=size // 4)
    (part,) = _parts(spark, path)
    assert part["files"] >= 4 and _rows(tables.read(spark, path)) == want


def test_merge_by_key_reads_the_newest_version(spark, scratch):
    path, newest = scratch("upsert"), {}
    for n in range(10):
        batch = spark.createDataFrame([(dt.datetime(2024, 1, 1 + k % 3, k), n) for k in range(n, n + 5)], "window_start timestamp, v int")
        tables.write_batch(batch, path, n)
        newest |= {r.window_start: r.v for r in batch.collect()}
        if n in (3, 6, 7):
            sinks.compact_upserts(spark, path)
            assert {r.window_start: r.v for r in sinks.read_upserts(spark, path).collect()} == newest
    assert {r.window_start: r.v for r in sinks.read_upserts(spark, path).collect()} == newest


@pytest.fixture()
def many_batches(spark, scratch):
    """The feed as many small files, read one by one."""
    base = scratch("feed")
    feeds.feed(spark, SF001).drop("date").repartition(12).write.parquet(f"{base}/in")
    return base, kafka.envelope_file_stream(spark, f"{base}/in", max_files_per_trigger=1, partitioned=False)


def test_shared_scan_job_with_compaction(spark, many_batches):
    base, source = many_batches
    q = jobs.start_shared_scan_job(spark, source, f"{base}/raw", f"{base}/partials", f"{base}/ck", trigger=runner.AVAILABLE_NOW,
                                   quarantine_path=f"{base}/bad", compact_every=3)
    runner.finish(q)
    raw = sinks.read_lake(spark, f"{base}/raw")
    want = Q.parsed(spark, SF001)
    assert sorted(r.offset for r in raw.collect()) == sorted(r.offset for r in want.collect())
    assert max(p["level"] for p in _parts(spark, f"{base}/raw")) >= 2
    days = {p["day"] for p in _parts(spark, f"{base}/raw")}
    assert len(_parts(spark, f"{base}/raw")) <= 2 * 3 * len(days)
    merged = jobs.merge_partials(spark, f"{base}/partials")
    metrics = Q.q_minute_metrics(spark, SF001)
    assert merged.count() == metrics.count()
    assert merged.agg(F.sum("total_requests")).first()[0] == 1000
    bad = sinks.read_batches(spark, f"{base}/bad")
    assert bad.count() == want.where("status = ''").count()
    # The whole is searched through the index, before and after another merge.
    lake, index = f"{base}/raw", f"{base}/index"
    hits = lambda: sorted(r.offset for r in search_index.indexed_search(spark, lake, index, contains="wp-admin").collect())
    full = sorted(r.offset for r in dashboards.log_search(want, contains="wp-admin").collect())
    assert search_index.index_lake(spark, lake, index) == sum(p["files"] for p in _parts(spark, lake))
    assert hits() == full
    jobs.compact_job(spark, lake, f"{base}/partials", f"{base}/bad", vacuum=True)
    assert hits() == full
    search_index.index_lake(spark, lake, index)
    assert hits() == full


def test_cli_compacts_and_searches(spark, many_batches):
    from loglens import cli
    base, source = many_batches
    runner.finish(jobs.start_shared_scan_job(spark, source, f"{base}/raw", f"{base}/partials", f"{base}/ck", trigger=runner.AVAILABLE_NOW,
                                             quarantine_path=f"{base}/bad"))
    before = len(_parts(spark, f"{base}/raw"))
    cli.main(["compact", "--lake", f"{base}/raw", "--partials", f"{base}/partials", "--quarantine", f"{base}/bad", "--vacuum"])
    assert all(p["level"] > 0 for t in ("raw", "partials", "bad") for p in _parts(spark, f"{base}/{t}"))
    assert before == 12 and jobs.merge_partials(spark, f"{base}/partials").agg(F.sum("total_requests")).first()[0] == 1000
    cli.main(["index", "--lake", f"{base}/raw", "--search-index", f"{base}/index"])
    for extra in ([], ["--search-index", f"{base}/index"]):
        cli.main(["search", "--lake", f"{base}/raw", *extra, "--contains", "wp-admin", "--out", f"{base}/hits"])
        assert spark.read.parquet(f"{base}/hits").count() == Q.parsed(spark, SF001).where(F.col("request").contains("wp-admin")).count()


def test_a_failing_second_query_stops_the_first(spark, scratch):
    base = scratch("fail")
    source = kafka.envelope_file_stream(spark, feeds.feed_path(spark, SF001))
    import time

    def start(name, act):
        return source.writeStream.option("checkpointLocation", f"{base}/{name}").trigger(availableNow=True).foreachBatch(act).start()

    def broken(df, i):
        raise ValueError("no such table")

    small = kafka.envelope_file_stream(spark, feeds.feed_path(spark, SF001), max_files_per_trigger=1)
    first = small.writeStream.option("checkpointLocation", f"{base}/slow").trigger(availableNow=True).foreachBatch(
        lambda df, i: time.sleep(3)).start()
    began = time.monotonic()
    with pytest.raises(RuntimeError, match="no such table"):
        runner.finish_all(spark, [first, start("bad", broken)])
    assert time.monotonic() - began < 45 and not first.isActive
