"""spark-submit entry points for the long-running jobs.

    spark-submit --py-files loglens.zip loglens/cli.py metrics --bootstrap host:9092 \
        --topic access_log [--lake PATH --metrics PATH --watermark '10 minutes']
    ... cli.py parse   --bootstrap host:9092 --topic access_log
    ... cli.py alerts  --bootstrap host:9092 --topic app_log [--index 'pyspark_logs_{date}']
    ... cli.py report  --envelope-path DIR --panel overview [--out PATH]
    ... cli.py compact [--metrics PATH] [--partials PATH] [--lake PATH] [--quarantine PATH] [--vacuum]
    ... cli.py index   --lake PATH --search-index PATH
    ... cli.py search  --lake PATH [--search-index PATH] [--contains TEXT] [--ip IP] [--status S] [--start T] [--end T]
    ... cli.py live    --bootstrap host:9092 --topic access_log --panel anomalies --out PATH --watermark '10 minutes'
    ... cli.py publish --source DIR (--bootstrap host:9092 --topic access_log | --lake PATH)

Without a broker, ``--envelope-path DIR`` streams envelope Parquet files
instead; ``--available-now`` processes what is there and exits (scheduled
batch-style runs on the same checkpoints).

(``python -m loglens.cli ...`` works the same where pyspark is installed.)
Checkpoints go under ``spark.checkpoint.dir``; a job restarted with the same
``--name`` resumes where it stopped.
"""

from __future__ import annotations

import argparse

from loglens.operators import alerts, dashboards, metrics, parse, search_index
from loglens.session import build_session, shared_root
from loglens.sources import kafka
from loglens.streaming import jobs, live, runner, sinks


# Dashboard tables by name, from parsed records.
PANELS = {
    "overview": lambda p: metrics.overview(p, exact_ips=True),
    "status": dashboards.status_class_share,
    "endpoints": dashboards.top_endpoints,
    "agents": dashboards.user_agent_share,
    "heatmap": dashboards.access_heatmap,
    "clients": dashboards.client_profile,
    "error-windows": lambda p: alerts.error_windows(metrics.overview(p, exact_ips=False)),
    "anomalies": alerts.error_anomalies,
}


# Live tables by name, from a parsed stream and a watermark (append mode).
LIVE = {
    "anomalies": live.live_anomalies,
    "error-windows": live.live_error_windows,
    "active-ips": live.live_active_ips,
    "clients": live.live_client_profile,
}


def compact(spark, a) -> None:
    """Fold the batches of managed tables into their levels; beside a running job or on their own."""
    if a.metrics:
        sinks.compact_upserts(spark, a.metrics, max_batch_id=a.max_batch_id)
    if a.partials:
        jobs.compact_partials(spark, a.partials, a.max_batch_id)
    if a.lake:
        sinks.compact_lake(spark, a.lake, a.max_batch_id)
    if a.quarantine:
        jobs.compact_quarantine(spark, a.quarantine, a.max_batch_id)
    if a.vacuum:
        for path in (a.metrics, a.partials, a.lake, a.quarantine):
            if path:
                sinks.drop_compacted(spark, path)


def search(spark, a) -> None:
    """Records of a lake that match the given predicates, through the n-gram index if there is one."""
    by = dict(contains=a.contains, status=a.status, start=a.start, end=a.end, ip=a.ip)
    if a.search_index:
        hits = search_index.indexed_search(spark, a.lake, a.search_index, **by)
    else:
        hits = dashboards.log_search(sinks.read_lake(spark, a.lake), **by)
    if a.out:
        hits.write.mode("overwrite").parquet(a.out)
    else:
        hits.show(a.console_rows, truncate=False)


def report(spark, a) -> None:
    """One dashboard table over a bounded read of the topic or a stored envelope."""
    records = (kafka.envelope_batch(spark, a.envelope_path) if a.envelope_path
               else kafka.kafka_batch(spark, a.bootstrap, a.topic, a.starting_offsets))
    table = PANELS[a.panel](parse.parse_access(parse.decode(records), keep=("key", "timestamp", "offset")))
    if a.out:
        table.write.mode("overwrite").parquet(a.out)
    else:
        table.show(a.console_rows, truncate=False)


def _args(argv=None):
    ap = argparse.ArgumentParser(prog="loglens")
    ap.add_argument("command", choices=["metrics", "parse", "alerts", "publish", "report", "compact", "index", "search", "live"])
    ap.add_argument("--bootstrap", help="Kafka bootstrap servers")
    ap.add_argument("--envelope-path",
                    help="read envelope Parquet files from this folder instead of Kafka")
    ap.add_argument("--available-now", action="store_true",
                    help="process what is available, then stop (scheduled runs)")
    ap.add_argument("--topic", default="access_log")
    ap.add_argument("--starting-offsets",
                    help="where a new job starts (default: latest for alerts, earliest for the others)")
    ap.add_argument("--max-offsets-per-trigger", type=int)
    ap.add_argument("--trigger", help="processing-time trigger, e.g. '30 seconds' "
                                      "(default: next micro-batch as soon as one ends)")
    ap.add_argument("--watermark", help="bound metric state, e.g. '10 minutes'")
    ap.add_argument("--lake", help="raw-record lake path (default: console)")
    ap.add_argument("--metrics", help="metric upsert table path (default: console)")
    ap.add_argument("--quarantine", help="dead-letter table for lines that do not parse")
    ap.add_argument("--index", help="document resource, e.g. pyspark_logs_{date}")
    ap.add_argument("--index-format", default="parquet",
                    help="parquet or org.elasticsearch.spark.sql")
    ap.add_argument("--index-option", action="append", default=[], metavar="KEY=VALUE",
                    help="connector option of the index, e.g. es.nodes=host:9200 (repeatable)")
    ap.add_argument("--console-rows", type=int, default=20,
                    help="rows of each micro-batch that the console shows")
    ap.add_argument("--panel", choices=sorted({**PANELS, **LIVE}), help="dashboard table to compute (report, live)")
    ap.add_argument("--partials", help="partial-metric table of a shared-scan job (compact)")
    ap.add_argument("--vacuum", action="store_true", help="delete what a compaction has replaced")
    ap.add_argument("--search-index", help="n-gram index of the lake (index, search)")
    for name in ("contains", "status", "ip", "start", "end"):
        ap.add_argument(f"--{name}", help="search predicate")
    ap.add_argument("--out", help="Parquet folder for the report (default: print it)")
    ap.add_argument("--max-batch-id", type=int, help="newest batch to compact (default: the newest complete one)")
    ap.add_argument("--source", help="folder of text log files (publish)")
    ap.add_argument("--name", default="loglens")
    ap.add_argument("--files-per-batch", type=int,
                    help="raw-lake writer tasks per micro-batch (bounds small files)")
    ap.add_argument("--state-partitions", type=int,
                    help="state-store width of the metric query (fixed at its first start)")
    a = ap.parse_args(argv)
    if a.command == "publish" and not (a.source and (a.bootstrap or a.lake)):
        ap.error("publish needs --source and either --bootstrap (Kafka) or --lake (table)")
    if a.command == "report" and not a.panel:
        ap.error("report needs --panel")
    if a.command == "compact" and not (a.metrics or a.partials or a.lake or a.quarantine):
        ap.error("compact needs a table: --metrics, --partials, --lake or --quarantine")
    if a.command in ("index", "search") and not a.lake or a.command == "index" and not a.search_index:
        ap.error(f"{a.command} needs --lake" + (" and --search-index" if a.command == "index" else ""))
    if a.command == "live" and not (a.panel in LIVE and a.out and a.watermark):
        ap.error(f"live needs --out, --watermark and a --panel of {', '.join(sorted(LIVE))}")
    if a.command == "report" and a.panel not in PANELS:
        ap.error(f"report has the panels {', '.join(sorted(PANELS))}")
    if any("=" not in o for o in a.index_option):
        ap.error("--index-option takes KEY=VALUE")
    if a.starting_offsets is None:
        a.starting_offsets = "latest" if a.command == "alerts" else "earliest"
    if a.command not in ("publish", "compact", "index", "search") and not (a.bootstrap or a.envelope_path):
        ap.error(f"{a.command} needs --bootstrap (Kafka) or --envelope-path")
    return a


def main(argv=None) -> None:
    a = _args(argv)
    spark = build_session(app_name=f"loglens-{a.command}")
    trigger = ({"availableNow": True} if a.available_now
               else {"processingTime": a.trigger} if a.trigger else None)
    if a.state_partitions:
        spark.conf.set("spark.sql.shuffle.partitions", str(a.state_partitions))
    ckpt = f"{shared_root(spark)}/jobs/{a.name}-{a.command}"
    if a.command == "publish":
        sinks.publish_lines(spark, a.source, a.lake or "", fmt="kafka" if a.bootstrap else "parquet",
                            topic=a.topic, bootstrap_servers=a.bootstrap)
        return
    if a.command == "compact":
        compact(spark, a)
        return
    if a.command == "index":
        print(search_index.index_lake(spark, a.lake, a.search_index), "files indexed")
        return
    if a.command == "search":
        search(spark, a)
        return
    if a.command == "report":
        report(spark, a)
        return
    if a.envelope_path:
        src = kafka.envelope_file_stream(spark, a.envelope_path)
    else:
        src = kafka.kafka_stream(spark, a.bootstrap, a.topic, a.starting_offsets,
                                 a.max_offsets_per_trigger)
    if a.command == "metrics":
        qs = jobs.start_access_jobs(spark, src, a.name, a.lake, a.metrics, ckpt, trigger,
                                    a.watermark, a.files_per_batch, a.quarantine)
    elif a.command == "live":
        parsed = parse.parse_access(parse.decode(src), keep=("timestamp",))
        qs = [sinks.parquet_append(LIVE[a.panel](parsed, a.watermark), a.out, f"{ckpt}-{a.panel}", trigger)]
    elif a.command == "parse":
        qs = [sinks.console(jobs.parsed_stream(src), "append", ckpt, trigger, a.console_rows)]
    else:
        app = alerts.json_alerts(src, keep=("topic", "partition", "offset"))
        if a.index:
            qs = [sinks.document_sink(app, a.index, ckpt, fmt=a.index_format,
                                      options=dict(o.split("=", 1) for o in a.index_option),
                                      time_col=["log_timestamp", "kafka_ingestion_time"], trigger=trigger,
                                      id_cols=("topic", "partition", "offset"))]
        else:
            qs = [sinks.console(app, "append", ckpt, trigger, a.console_rows)]
    if a.available_now:
        runner.finish_all(spark, qs)
    else:
        jobs.await_jobs(spark, qs)


if __name__ == "__main__":
    main()
