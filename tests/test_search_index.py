"""The n-gram index: equal hits, skipped files, no misses."""

import random

import pytest
from pyspark.sql import functions as F

from loglens.operators import dashboards, search_index as S

SCHEMA = "offset long, timestamp timestamp, ip string, request string, status string, date date"


def _rows(rng, n, words, first=0):
    out = []
    for i in range(n):
        request = None if rng.random() < 0.02 else "GET /" + "/".join(rng.choices(words, k=2)) + " HTTP/1.0"
        out.append((first + i, f"10.{first}.{rng.randrange(9)}.{i % 5}", request, rng.choice(["200", "404"])))
    return out


def _write(spark, lake, rows, day):
    df = spark.createDataFrame(rows, "offset long, ip string, request string, status string")
    (df.select("offset", (F.lit(f"2024-01-{day:02d} 00:00:00").cast("timestamp") + F.make_interval(secs=F.col("offset") % 86400)).alias("timestamp"),
               "ip", "request", "status", F.lit(f"2024-01-{day:02d}").cast("date").alias("date"))
     .coalesce(1).write.mode("append").partitionBy("date").parquet(lake))


@pytest.fixture()
def lake(spark, scratch):
    base = scratch("lake")
    rng = random.Random(1)
    lake = f"{base}/lake of logs"
    for day in range(1, 9):
        words = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyzéß") for _ in range(6)) for _ in range(20)]
        _write(spark, lake, _rows(rng, 300, [*words, "list", f"day{day}only"], 1000 * day), day)
    assert S.index_lake(spark, lake, f"{base}/index") == 8
    return lake, f"{base}/index"


def _hits(df):
    return sorted((r.offset, r.request) for r in df.collect())


SEARCHES = [dict(contains="day3only"), dict(contains="list"), dict(contains="é"), dict(contains="nowhere to be found"), dict(contains=""),
            dict(contains="day"), dict(ip="10.3000.2.1"), dict(ip="10.9.9.9"), dict(contains="day5only", status="404", start="2024-01-05"),
            dict(start="2024-01-02 00:00:00", end="2024-01-03 00:00:00"), dict(contains="HTTP/1.0", end="2024-01-02"), {}]


@pytest.mark.parametrize("search", SEARCHES)
def test_hits_equal_a_full_search(spark, lake, search):
    assert _hits(S.indexed_search(spark, *lake, **search)) == _hits(dashboards.log_search(spark.read.parquet(lake[0]), **search))


def test_every_gram_of_every_request_is_found(spark, lake):
    """Brute force over needles: a file with the needle is always a candidate, one without it hardly ever."""
    rows = [(r.f, r.request) for r in spark.read.parquet(lake[0]).select(F.col("_metadata.file_path").alias("f"), "request").collect() if r.request]
    rng = random.Random(2)
    needles = {w[i:i + n] for _, w in rng.sample(rows, 40) for n in (3, 7) for i in [rng.randrange(len(w) - n)]}
    wrong = total = 0
    for needle in sorted(needles)[:25]:
        want = {f for f, w in rows if needle in w}
        grams = [needle[i:i + 3] for i in range(len(needle) - 2)]
        all_grams = {f for f in {f for f, _ in rows} if all(any(g in w for x, w in rows if x == f) for g in grams)}
        got = {r.path for r in S.candidate_files(spark, *lake, contains=needle).collect()}
        assert want <= all_grams <= got, needle
        wrong += len(got - all_grams)
        total += 8
    assert wrong <= 0.02 * total


def test_files_are_skipped(spark, lake):
    def read(df):
        return len({f for f in df.inputFiles()})
    assert S.candidate_files(spark, *lake, contains="day3only").count() == 1
    assert read(S.indexed_search(spark, *lake, contains="day3only")) == 1
    assert read(spark.read.parquet(lake[0])) == 8
    assert S.candidate_files(spark, *lake, ip="10.3000.2.1").count() == 1
    assert S.candidate_files(spark, *lake, start="2024-01-07").count() == 2
    assert S.indexed_search(spark, *lake, contains="nowhere to be found").count() == 0


def test_new_and_rewritten_files_are_searched_before_they_are_indexed(spark, lake):
    path, index = lake
    _write(spark, path, [(1, "1.1.1.1", "GET /day3only/new HTTP/1.0", "200")], 9)
    assert len(_hits(S.indexed_search(spark, path, index, contains="day3only/new"))) == 1
    assert S.candidate_files(spark, path, index, contains="zzz").count() == 1
    assert S.index_lake(spark, path, index) == 1 and S.index_lake(spark, path, index) == 0
    assert S.candidate_files(spark, path, index, contains="zzz").count() == 0
    assert len(_hits(S.indexed_search(spark, path, index, contains="day3only/new"))) == 1


def test_a_large_filter_of_many_buckets(spark, scratch):
    base = scratch("big")
    (spark.range(20_000).select(F.col("id").alias("offset"), F.current_timestamp().alias("timestamp"), F.lit("1.1.1.1").alias("ip"),
                               F.concat(F.lit("/"), F.sha2(F.col("id").cast("string"), 256)).alias("request"), F.lit("200").alias("status"))
     .coalesce(1).write.parquet(f"{base}/lake"))
    S.index_lake(spark, f"{base}/lake", f"{base}/index", keys=("ip", "request"))
    row = spark.read.parquet(f"{base}/index").first()
    assert row.bits > S.BUCKET and len(row.bloom) == row.bits // 8
    values = [r.request for r in spark.read.parquet(f"{base}/lake").limit(40).collect()]
    known = S._index(spark, f"{base}/index")
    assert all(known.where(S._may_hold([S._entry("key request", F.lit(v))])).count() for v in values)
    assert sum(known.where(S._may_hold([S._entry("key request", F.lit("x" + v))])).count() for v in values) <= 2
