"""Plan-shape guards: the properties the design relies on at scale."""

import pytest

import __spark_entry__ as E
from conftest import SF001
from loglens.plans import queries as Q

BATCH_KEYS = sorted(Q.batch_queries())
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython",
             "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas")


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", BATCH_KEYS)
def test_no_cross_join_or_python_eval(spark, key):
    plan = _plan(E.queries()[key](spark, SF001))
    for op in FORBIDDEN:
        assert op not in plan, (key, op)


# Aggregates over parsed lines must run the line regex once per row: a row
# filter on a parsed field would be pushed below the parse and add a second.
ONE_PARSE = ["minute_metrics", "minute_overview", "minute_active_ips_exact",
             "minute_mean_bytes", "event_time_minute_metrics", "error_windows",
             "status_class_share", "top_endpoints", "user_agent_share", "access_heatmap",
             "client_profile", "error_anomalies", "access_log_parse", "access_log_typed"]


@pytest.mark.parametrize("key", ONE_PARSE)
def test_single_regex_pass(spark, key):
    plan = _plan(E.queries()[key](spark, SF001))
    assert plan.count("regexp_replace(") == 1, key
    assert "RLIKE(" not in plan, key  # user-agent rules are literal substring tests


def test_minute_metrics_one_shuffle_after_partial_agg(spark):
    plan = _plan(E.queries()["minute_metrics"](spark, SF001))
    assert plan.count("Exchange hashpartitioning") == 1
    assert "partial_count" in plan


def test_scans_prune_columns(spark):
    plan = _plan(E.queries()["client_profile"](spark, SF001))
    assert "ReadSchema: struct<value:binary>" in plan


def test_log_search_prunes_partitions_and_pushes_filters(spark):
    plan = _plan(E.queries()["log_search"](spark, SF001))
    assert "PartitionFilters: [((date" in plan
    assert "GreaterThanOrEqual(timestamp" in plan


def test_top_endpoints_is_take_ordered(spark):
    plan = _plan(E.queries()["top_endpoints"](spark, SF001))
    assert "TakeOrderedAndProject" in plan


def _formatted(df) -> str:
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def test_lake_search_pushes_every_predicate(spark):
    plan = _formatted(E.queries()["lake_log_search"](spark, SF001))
    assert "PartitionFilters: [((date" in plan
    for f in ("EqualTo(status,404)", "StringContains(request,wp-admin)",
              "LessThan(timestamp"):
        assert f in plan, f


@pytest.mark.parametrize("key", ["access_log_enriched", "log_search"])
def test_row_level_outputs_parse_once(spark, key):
    """Parsed-rows-only outputs drop unmatched lines inside the generator,
    so no row filter drags a second regex pass below the parse."""
    plan = _plan(E.queries()[key](spark, SF001))
    assert plan.count("regexp_replace(value") == 1, key  # one pass over the log line
    assert "Generate inline" in plan


def test_json_alerts_parse_each_record_once(spark):
    plan = _plan(E.queries()["json_alerts"](spark, SF001))
    assert plan.count("from_json(") == 1
    assert "Generate inline" in plan


def test_lake_search_prunes_in_the_operator(spark):
    plan = _plan(E.queries()["lake_log_search"](spark, SF001))
    assert "PartitionFilters: [((date" in plan and "GreaterThanOrEqual(timestamp" in plan


def test_severity_filter_reaches_a_stored_table(spark, scratch):
    from loglens.operators import alerts
    path = scratch("alerts")
    spark.createDataFrame([("ERROR", 1)], "log_level string, n int").write.parquet(path)
    assert "PushedFilters: [In(log_level" in _plan(alerts.severity_filter(spark.read.parquet(path)))


def test_streaming_event_time_parses_a_line_once(spark, scratch):
    from loglens.operators import metrics, parse
    from loglens.sources import feeds, kafka
    from loglens.streaming import runner, sinks
    base = scratch("once")
    # Without the closing batch that has no data, the last plan is the data's.
    spark.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", "false")
    source = kafka.envelope_file_stream(spark, feeds.feed_path(spark, SF001, variant="late"))
    for parsed in (parse.parse_access_matched(parse.decode(source)), parse.parse_access(parse.decode(source))):
        run = f"{base}/{len(parsed.columns)}-{id(parsed)}"
        q = runner.finish(sinks.parquet_append(metrics.event_time_metrics(parsed, watermark="10 minutes"),
                                               f"{run}/out", f"{run}/ck", runner.AVAILABLE_NOW))
        plan = q._jsq.explainInternal(False)
        assert plan.count("regexp_replace(") == 1
    spark.conf.unset("spark.sql.streaming.noDataMicroBatches.enabled")


def test_enrich_parses_a_line_once_by_default(spark):
    from loglens.operators import parse
    plan = _plan(parse.enrich(Q.parsed(spark, SF001)))
    assert plan.count("regexp_replace(value") == 1


def test_fixed_patterns():
    """The oracle imports these, so they are pinned here."""
    import re

    from loglens.functions import patterns as P
    assert P.ALERT_LEVELS == ("ERROR", "WARN", "CRITICAL")
    line = '1.2.3.4 - - [01/Jan/2024:00:00:01 +0000] "GET /a HTTP/1.0" 200 12 "ref" "agent"'
    assert re.match(P.EXTENDED_PATTERN, line).groups() == (
        "1.2.3.4", "01/Jan/2024:00:00:01 +0000", "GET /a HTTP/1.0", "200", "12", "ref", "agent")
    assert re.match(P.EXTENDED_PATTERN, "garbage line") is None
