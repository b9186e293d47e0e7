"""Source wiring and session helpers."""

import pytest
from pyspark.errors import AnalysisException

from conftest import SF001
from loglens.session import scale_conf, shared_root
from loglens.sources import feeds, kafka, recipe


def test_kafka_source_is_wired_to_the_connector(spark):
    # No connector jar in this environment: the reader must ask for "kafka".
    with pytest.raises(AnalysisException, match="(?i)kafka"):
        kafka.kafka_stream(spark, "broker:9092", "access_log", "earliest",
                           max_offsets_per_trigger=1000)
    with pytest.raises(AnalysisException, match="(?i)kafka"):
        kafka.kafka_batch(spark, "broker:9092", "access_log").schema


def test_envelope_schema_and_feed_reuse(spark):
    p1 = feeds.feed_path(spark, SF001)
    p2 = feeds.feed_path(spark, SF001)
    assert p1 == p2 and p1.startswith(shared_root(spark))
    env = kafka.envelope_batch(spark, p1)
    assert [f.name for f in env.schema.fields] == list(recipe.ENVELOPE_COLUMNS) + ["date"]
    assert env.count() == 1000
    assert env.where("key IS NOT NULL").count() == 0


def test_scale_conf_bounds():
    big = scale_conf(100 * 1024 ** 4, 8000)
    small = scale_conf(10 * 1024 ** 2, 8)
    assert int(big["spark.sql.shuffle.partitions"]) == 102_400
    assert int(small["spark.sql.shuffle.partitions"]) == 16
    assert big["spark.sql.adaptive.skewJoin.enabled"] == "true"


def test_dashboards_on_parsed_lake_equal_feed(spark):
    """Parse once into the lake, query many: same answers, no regex at query time."""
    from loglens.operators import alerts, dashboards, metrics
    from loglens.plans import queries as Q
    lake = spark.read.parquet(feeds.parsed_lake_path(spark, SF001))
    feed = Q.parsed(spark, SF001)
    for op in (dashboards.client_profile, dashboards.user_agent_share,
               dashboards.status_class_share, dashboards.access_heatmap,
               metrics.minute_metrics, alerts.error_anomalies):
        a, b = op(lake), op(feed)
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0, op.__name__
    plan = dashboards.user_agent_share(lake)._jdf.queryExecution().executedPlan().toString()
    assert "regexp_replace" not in plan


def test_shared_root_rules():
    from loglens.session import resolve_root
    assert resolve_root("hdfs:///ckpt", None, "yarn") == "hdfs:///ckpt"
    assert resolve_root(None, "s3a://b/ckpt/uuid", "k8s://x") == "s3a://b/ckpt/uuid"
    assert resolve_root(None, None, "local[8]") is None
    with pytest.raises(RuntimeError):
        resolve_root(None, None, "spark://master:7077")
    for local in ("/tmp/ckpt", "file:///tmp/ckpt"):
        with pytest.raises(RuntimeError):
            resolve_root(local, None, "spark://master:7077")
        assert resolve_root(local, None, "local[4]") == local
    # A path without a scheme is one of the default file system.
    assert resolve_root("/ckpt", None, "yarn", default_fs="hdfs://nn:8020") == "/ckpt"
    assert resolve_root("/mnt/ckpt", None, "yarn", shared_mount=True) == "/mnt/ckpt"
    with pytest.raises(RuntimeError):
        resolve_root("file:/mnt/ckpt", None, "yarn", default_fs="hdfs://nn:8020")


def test_fingerprint_follows_the_files_of_a_folder(spark, tmp_path):
    table = f"{tmp_path}/events.parquet"
    spark.range(5).write.parquet(table)
    before = feeds._fingerprint(spark, str(tmp_path))
    part = next(p for p in (tmp_path / "events.parquet").iterdir() if p.name.endswith(".parquet"))
    part.write_bytes(part.read_bytes() + b"x")
    assert feeds._fingerprint(spark, str(tmp_path)) != before


def test_concurrent_writers_of_a_feed_agree(spark, scratch):
    base, made = scratch("once"), []

    def write(path):
        if not made:  # another writer finishes while this one is at work
            made.append(feeds._once(spark, base, lambda p: (made.append(p), spark.range(3).write.parquet(p))))
        spark.range(3).write.parquet(path)

    first = feeds._once(spark, base, write)
    assert spark.read.parquet(first).count() == 3
    assert feeds._once(spark, base, lambda p: 1 / 0) == first


def test_queries_do_not_depend_on_the_session_zone(spark):
    from loglens.plans import queries as Q
    for path in (feeds.parsed_lake_path, feeds.text_feed_path):
        path(spark, SF001)
    want = sorted(Q.all_queries()["lake_log_search"](spark, SF001).collect())
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Ho_Chi_Minh")
    try:
        assert sorted(Q.all_queries()["lake_log_search"](spark, SF001).collect()) == want
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_log_files_spread_only_on_request(spark):
    from loglens.sources import files
    path = feeds.text_feed_path(spark, SF001)
    plain = files.log_files(spark, path, glob=files.TEXT_GLOB)
    assert "Exchange" not in plain._jdf.queryExecution().executedPlan().toString()
    spread = files.log_files(spark, path, glob=files.TEXT_GLOB, min_partitions=4)
    assert "RoundRobinPartitioning" in spread._jdf.queryExecution().executedPlan().toString()
    assert spread.count() == plain.count() == 1000


def test_cli_argument_checks():
    from loglens import cli
    with pytest.raises(SystemExit):
        cli._args(["publish", "--source", "/x"])
    with pytest.raises(SystemExit):
        cli._args(["metrics"])
    assert cli._args(["metrics", "--envelope-path", "/x"]).envelope_path == "/x"
    assert cli._args(["metrics", "--envelope-path", "/x"]).starting_offsets == "earliest"
    a = cli._args(["alerts", "--bootstrap", "b", "--index-option", "es.nodes=h:9200", "--index-option", "es.net.ssl=true"])
    assert a.starting_offsets == "latest" and a.index_option == ["es.nodes=h:9200", "es.net.ssl=true"]
    for bad in (["report", "--envelope-path", "/x"], ["compact"], ["alerts", "--bootstrap", "b", "--index-option", "x"]):
        with pytest.raises(SystemExit):
            cli._args(bad)


def test_cli_report(spark, scratch):
    from loglens import cli
    from loglens.plans import queries as Q
    out = scratch("report")
    cli.main(["report", "--envelope-path", feeds.feed_path(spark, SF001), "--panel", "status", "--out", out])
    assert sorted(spark.read.parquet(out).collect()) == sorted(Q.q_status_class_share(spark, SF001).collect())


def test_feed_of_a_pattern_over_folders(spark, scratch):
    """Tables in several folders, named by a pattern, as only Spark's readers resolve it."""
    base = scratch("pattern")
    for i in range(2):
        spark.read.parquet(f"{SF001}/events.parquet").where(f"event_id % 2 = {i}").write.parquet(f"{base}/{i}/events.parquet")
    found = feeds.feed(spark, f"{base}/[01]")
    assert found.select("offset").distinct().count() == 1000
    before = feeds._fingerprint(spark, f"{base}/[01]")
    spark.range(1).selectExpr("id event_id").write.mode("append").parquet(f"{base}/1/events.parquet")
    assert feeds._fingerprint(spark, f"{base}/[01]") != before


def test_tables_are_published_without_the_committers_mark(spark, scratch):
    conf, name = spark._jsc.hadoopConfiguration(), "mapreduce.fileoutputcommitter.marksuccessfuljobs"
    conf.set(name, "false")
    try:
        path = feeds._once(spark, scratch("unmarked"), lambda p: spark.range(3).write.parquet(p))
    finally:
        conf.unset(name)
    assert spark.read.parquet(path).count() == 3


def test_shared_mount_is_tried_out(spark, scratch, monkeypatch):
    from loglens import session
    root = shared_root(spark)
    assert session.seen_by_all(spark, root)
    assert not session.seen_by_all(spark, "file:///proc/none")
    key, seen = session.SHARED_MOUNT_KEY, []
    monkeypatch.setattr(spark.sparkContext, "master", "spark://m:7077")
    monkeypatch.setattr(session, "seen_by_all", lambda s, folder: seen.append(folder) or len(seen) > 1)
    try:
        with pytest.raises(RuntimeError):
            shared_root(spark)
        assert shared_root(spark) == root and shared_root(spark) == root and len(seen) == 2
        spark.conf.set(key, "false")
        with pytest.raises(RuntimeError):
            shared_root(spark)
    finally:
        spark.conf.unset(key)
