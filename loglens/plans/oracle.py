"""DuckDB twins of the registered queries (the correctness oracle).

Each string runs on DuckDB with the test tables registered as views. The
log feed is rebuilt from ``events`` with the same rules as
``loglens.sources.recipe``; parsing uses DuckDB's own ``regexp_extract``.
"""

from __future__ import annotations

from loglens.functions import patterns as P
from loglens.sources import recipe as R


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _uri(variant: str) -> str:
    if variant == "weighted":
        w = R.WEIGHTED_RESOURCES
        return (f"CASE WHEN event_id % 13 <= 4 THEN {_q(w[0])} WHEN event_id % 13 <= 8 THEN {_q(w[1])} "
                f"WHEN event_id % 13 <= 11 THEN {_q(w[2])} ELSE {_q(w[3])} END")
    if variant == "wide":
        return f"concat('/page/', CAST(event_id % {R.WIDE_ENDPOINTS} AS VARCHAR))"
    arms = " ".join(f"WHEN {i} THEN {_q(r)}" for i, r in enumerate(R.RESOURCES))
    return (f"CASE event_id % 8 {arms} "
            f"ELSE concat({_q(R.CART_PREFIX)}, CAST(1000 + event_id % 9001 AS VARCHAR)) END")


def lines_cte(variant: str = "plain") -> str:
    """SQL producing (event_id, ingest_ts, line) from ``events``."""
    if variant == "dense":
        ingest = "TIMESTAMP '2024-01-01 00:00:00' + to_milliseconds(event_id * 1500)"
        event = ingest
    elif variant == "tardy":
        ingest = "TIMESTAMP '2024-01-01 00:00:00' + to_milliseconds(event_id * 1500)"
        event = f"{ingest} - to_minutes(CASE WHEN event_id % 7 = 0 THEN 15 ELSE 0 END)"
    elif variant == "late":
        ingest = "ts"
        event = "ts - to_seconds(20 * (event_id % 5))"
    else:
        ingest = event = "ts"
    ip = "concat('10.0.', CAST(CAST(floor(user_id / 256) AS BIGINT) AS VARCHAR), '.', CAST(user_id % 256 AS VARCHAR))"
    stamp = f"concat(strftime({event}, '%d/%b/%Y:%H:%M:%S'), ' +0000')"
    verb = ("CASE WHEN event_id % 10 <= 5 THEN 'GET' WHEN event_id % 10 = 6 THEN 'POST' "
            "WHEN event_id % 10 = 7 THEN 'DELETE' ELSE 'PUT' END")
    status = ("CASE WHEN event_type = 'error' THEN CASE WHEN event_id % 2 = 0 THEN '404' ELSE '500' END "
              "WHEN event_id % 25 = 1 THEN '301' ELSE '200' END")
    head = f"""concat({ip}, ' - - [', {stamp}, '] "', {verb}, ' ', {_uri(variant)}, ' HTTP/1.0" ', {status})"""
    size = "CAST(4800 + event_id % 401 AS VARCHAR)"
    referer = f"concat({_q(R.REFERER_PREFIX)}, CAST(user_id % 7 AS VARCHAR))"
    ua = (f"CASE WHEN event_id % 20 <= 9 THEN {_q(R.UA_FIREFOX)} WHEN event_id % 20 <= 15 THEN {_q(R.UA_CHROME)} "
          f"WHEN event_id % 20 <= 17 THEN {_q(R.UA_SAFARI)} WHEN event_id % 20 = 18 THEN {_q(R.UA_MSIE)} "
          f"ELSE {_q(R.UA_OPERA)} END")
    line = (f"CASE WHEN event_id % 101 = 0 THEN {_q(R.GARBAGE_LINE)} "
            f"WHEN event_id % 97 = 0 THEN concat({head}, ' ', {size}) "
            f"""WHEN event_id % 103 = 0 THEN concat({head}, ' - "-" "', {ua}, '"') """
            f"""ELSE concat({head}, ' ', {size}, ' "', {referer}, '" "', {ua}, '"') END""")
    return f"SELECT event_id, {ingest} AS ingest_ts, {line} AS line FROM events"


def parsed_cte(variant: str = "plain") -> str:
    """SQL producing the parsed access record keyed by ``offset``."""
    pat = _q(P.EXTENDED_PATTERN)
    fields = ", ".join(f"regexp_extract(line, {pat}, {i + 1}) AS {n}"
                       for i, n in enumerate(P.EXTENDED_FIELDS))
    return (f"SELECT event_id AS \"offset\", ingest_ts AS \"timestamp\", line AS value, {fields} "
            f"FROM ({lines_cte(variant)}) l")


def event_time_sql(col: str) -> str:
    """DuckDB twin of ``try_to_timestamp(col, 'dd/MMM/yyyy:HH:mm:ss Z')`` as UTC."""
    return (f"(try_strptime(substr({col}, 1, 20), '%d/%b/%Y:%H:%M:%S') "
            f"- (CASE WHEN substr({col}, 22, 1) = '-' THEN -1 ELSE 1 END) * "
            f"(to_hours(CAST(substr({col}, 23, 2) AS INTEGER)) + to_minutes(CAST(substr({col}, 25, 2) AS INTEGER))))")


def _round(expr: str, digits: int) -> str:
    # Spark rounds a double HALF_UP on its shortest decimal form; going
    # through DECIMAL reproduces that instead of binary-float rounding.
    return f"CAST(round(CAST({expr} AS DECIMAL(38, 10)), {digits}) AS DOUBLE)"


def _round2(expr: str) -> str:
    return _round(expr, 2)


def _with_parsed(variant: str = "plain") -> str:
    return f"WITH p AS ({parsed_cte(variant)})\n"


_MINUTE = "time_bucket(INTERVAL 1 minute, \"timestamp\")"
_ERR4 = "CAST(sum(CASE WHEN starts_with(status, '4') THEN 1 ELSE 0 END) AS BIGINT)"
_ERR5 = "CAST(sum(CASE WHEN starts_with(status, '5') THEN 1 ELSE 0 END) AS BIGINT)"
_BYTES = "CAST(sum(TRY_CAST(bytes AS BIGINT)) AS BIGINT)"
_ENDPOINT = f"regexp_extract(request, {_q(P.ENDPOINT_PATTERN)}, 1)"
_STATUS_CLASS = "CASE WHEN length(status) > 0 THEN concat(substr(status, 1, 1), 'xx') ELSE '' END"


def _enriched(variant: str = "plain") -> str:
    req = _q(P.REQUEST_PATTERN)
    return (_with_parsed(variant) +
            f""", e AS (SELECT "offset", {event_time_sql('datetime')} AS event_time, ip,
              regexp_extract(request, {req}, 1) AS method,
              regexp_extract(request, {req}, 2) AS uri,
              regexp_extract(request, {req}, 3) AS protocol,
              {_ENDPOINT} AS endpoint, {_STATUS_CLASS} AS status_class,
              TRY_CAST(bytes AS BIGINT) AS bytes_long
            FROM p WHERE status <> '')\n""")


def _browser(ua: str) -> str:
    arms = " ".join(f"WHEN regexp_matches({ua}, {_q(rx)}) THEN {_q(lbl)}" for rx, lbl in P.BROWSER_RULES)
    return f"CASE {arms} ELSE {_q(P.BROWSER_OTHER)} END"


def _device(ua: str) -> str:
    arms = " ".join(f"WHEN regexp_matches({ua}, {_q(rx)}) THEN {_q(lbl)}" for rx, lbl in P.DEVICE_RULES)
    return f"CASE WHEN {ua} = '' THEN {_q(P.DEVICE_EMPTY)} {arms} ELSE {_q(P.DEVICE_OTHER)} END"


def _overview_body(variant: str = "plain") -> str:
    return (_with_parsed(variant) +
            f""", m AS (SELECT {_MINUTE} AS window_start, count(*) AS total_requests,
                 {_ERR4} + {_ERR5} AS errors, {_BYTES} AS total_bytes,
                 count(DISTINCT ip) AS active_ip_count
               FROM p GROUP BY 1)
            , o AS (SELECT window_start, window_start + INTERVAL 1 minute AS window_end,
                 total_requests AS request_per_minute,
                 {_round2('CAST(errors AS DOUBLE) / total_requests * 100')} AS error_rate_percent,
                 {_round2('CAST(total_bytes AS DOUBLE) / total_requests')} AS average_response_size,
                 active_ip_count FROM m)\n""")


def _minute_metrics(variant: str, time_expr: str, where: str = "") -> str:
    return (_with_parsed(variant) +
            f"""SELECT time_bucket(INTERVAL 1 minute, {time_expr}) AS window_start,
                 time_bucket(INTERVAL 1 minute, {time_expr}) + INTERVAL 1 minute AS window_end,
                 count(*) AS total_requests, {_ERR4} AS error_4xx_count, {_ERR5} AS error_5xx_count,
                 {_BYTES} AS total_bytes
               FROM p {where} GROUP BY 1""")


_LEVEL = ("CASE WHEN event_type = 'error' THEN CASE WHEN event_id % 3 = 0 THEN 'CRITICAL' ELSE 'ERROR' END "
          "WHEN event_type = 'purchase' THEN 'WARN' ELSE 'INFO' END")


def _json_alerts() -> str:
    level = _LEVEL
    levels = ", ".join(_q(x) for x in P.ALERT_LEVELS)
    return f"""SELECT event_id AS "offset", ts AS kafka_ingestion_time,
                 date_trunc('second', ts) AS log_timestamp, {level} AS log_level,
                 event_type AS log_message, CAST(user_id AS INTEGER) AS user_id
               FROM events WHERE event_id % 89 <> 0 AND ({level}) IN ({levels})"""


def alert_documents() -> str:
    levels = ", ".join(_q(x) for x in P.ALERT_LEVELS)
    return f"""SELECT * FROM (SELECT concat({_q(R.APP_TOPIC)}, '-', CAST(event_id % 3 AS VARCHAR), '-', CAST(event_id AS VARCHAR)) AS doc_id,
          {_LEVEL} AS log_level, CAST(CAST(ts AS DATE) AS VARCHAR) AS date FROM events WHERE event_id % 89 <> 0) a WHERE log_level IN ({levels})"""


def rejected_lines() -> str:
    return f"""SELECT * FROM (SELECT event_id AS "offset", line AS value,
          CASE WHEN line IS NULL THEN 'null' WHEN regexp_matches(line, {_q(P.ANY_PATTERN)}) THEN 'parsed_other' ELSE 'unparsed' END AS line_class
        FROM ({lines_cte()}) l WHERE line IS NULL OR NOT regexp_matches(line, {_q(P.EXTENDED_PATTERN)})) r"""


def batch_oracles() -> dict[str, str]:
    pat_any = _q(P.ANY_PATTERN)
    pat_elf = _q(P.EXTENDED_PATTERN)
    any_fields = ", ".join(f"regexp_extract(line, {pat_any}, {i + 1}) AS {n}"
                           for i, n in enumerate(P.ANY_FIELDS))
    parsed_cols = '"offset", "timestamp", ip, datetime, request, status, bytes, referrer, user_agent'
    lines = lines_cte("plain")
    s = {}
    s["envelope_decode"] = f"""SELECT CAST(NULL AS VARCHAR) AS "key", line AS value,
        {_q(R.ACCESS_TOPIC)} AS topic, CAST(event_id % 3 AS INTEGER) AS "partition",
        event_id AS "offset", ingest_ts AS "timestamp" FROM ({lines}) l"""
    s["access_log_parse"] = _with_parsed() + f"SELECT {parsed_cols} FROM p"
    s["access_log_typed"] = _with_parsed() + f"""SELECT {parsed_cols},
        TRY_CAST(status AS INTEGER) AS status_code_int, TRY_CAST(bytes AS INTEGER) AS bytes_int,
        "timestamp" AS timestamp_ts FROM p"""
    s["access_log_parse_any"] = f"""SELECT event_id AS "offset", {any_fields} FROM ({lines}) l"""
    s["access_log_enriched"] = _enriched() + "SELECT * FROM e"
    s["parse_quality"] = f"""SELECT CASE WHEN line IS NULL THEN 'null'
          WHEN regexp_matches(line, {pat_elf}) THEN 'parsed_elf'
          WHEN regexp_matches(line, {pat_any}) THEN 'parsed_other'
          ELSE 'unparsed' END AS line_class, count(*) AS line_count
        FROM ({lines}) l GROUP BY 1"""
    s["text_log_quality"] = s["parse_quality"]
    s["minute_metrics"] = _minute_metrics("plain", '"timestamp"')
    s["minute_overview"] = _overview_body() + "SELECT * FROM o"
    s["dense_minute_overview"] = _overview_body("dense") + "SELECT * FROM o"
    s["minute_active_ips_exact"] = _with_parsed() + \
        f"SELECT {_MINUTE} AS window_start, count(DISTINCT ip) AS active_ip_count FROM p GROUP BY 1"
    s["minute_mean_bytes"] = _with_parsed() + \
        f"SELECT {_MINUTE} AS window_start, {_round2('avg(TRY_CAST(bytes AS BIGINT))')} AS mean_bytes FROM p GROUP BY 1"
    s["event_time_minute_metrics"] = _minute_metrics(
        "late", event_time_sql("datetime"), f"WHERE status <> '' AND {event_time_sql('datetime')} IS NOT NULL")
    s["error_windows"] = _overview_body() + """SELECT window_start, request_per_minute AS total_requests,
        error_rate_percent FROM o WHERE error_rate_percent >= 50.0 AND request_per_minute >= 2"""
    s["status_class_share"] = _with_parsed() + f"""SELECT status_class, requests,
          {_round2('requests * 100.0 / sum(requests) OVER ()')} AS share_percent
        FROM (SELECT {_STATUS_CLASS} AS status_class, count(*) AS requests
              FROM p WHERE status <> '' GROUP BY 1) c"""
    s["top_endpoints"], s["endpoint_share"] = (_with_parsed(v) + f"""SELECT {_ENDPOINT} AS endpoint, count(*) AS requests
        FROM p WHERE status <> '' GROUP BY 1 ORDER BY requests DESC, endpoint ASC LIMIT 10""" for v in ("wide", "weighted"))
    s["hour_active_ips_error"] = _with_parsed("dense") + """SELECT time_bucket(INTERVAL 1 hour, "timestamp") AS window_start,
        count(DISTINCT ip) AS active_ip_count, true AS within_error FROM p GROUP BY 1"""
    s["publish_lines_envelope"] = f"""SELECT {_q(R.ACCESS_TOPIC)} AS topic, line AS value, count(*) AS records, count(*) AS dated
        FROM ({lines}) l GROUP BY line"""
    s["text_file_lines"] = f"SELECT line AS value, count(*) AS lines, true AS named FROM ({lines}) l GROUP BY line"
    s["gzip_member_lines"] = f"SELECT line AS value, count(*) AS lines FROM ({lines}) l GROUP BY line"
    s["user_agent_share"] = _with_parsed() + f"""SELECT {_browser('user_agent')} AS browser,
          {_device('user_agent')} AS device, count(*) AS requests
        FROM p WHERE status <> '' GROUP BY 1, 2"""
    et = event_time_sql("datetime")
    s["access_heatmap"] = _with_parsed() + f"""SELECT CAST(dayofweek(et) + 1 AS INTEGER) AS day_of_week,
          CAST(hour(et) AS INTEGER) AS "hour", count(*) AS requests
        FROM (SELECT {et} AS et FROM p WHERE status <> '') x WHERE et IS NOT NULL GROUP BY 1, 2"""
    s["client_profile"] = _enriched() + """SELECT ip, count(*) AS requests,
          count(DISTINCT endpoint) AS endpoints, min(event_time) AS first_seen,
          max(event_time) AS last_seen,
          CAST(sum(CASE WHEN status_class >= '4xx' THEN 1 ELSE 0 END) AS BIGINT) AS errors
        FROM e GROUP BY ip"""
    s["json_alerts"] = _json_alerts()
    s["error_anomalies"] = _enriched() + f""", eh AS (
          SELECT endpoint, date_trunc('hour', event_time) AS hour_start,
                 CAST(sum(CASE WHEN status_class >= '4xx' THEN 1 ELSE 0 END) AS BIGINT) AS errors
          FROM e GROUP BY 1, 2)
        , z AS (SELECT endpoint, hour_start, errors,
            {_round('(errors - avg(errors) OVER w) / nullif(stddev_pop(errors) OVER w, 0)', 4)} AS z_score
          FROM eh WHERE hour_start IS NOT NULL
          WINDOW w AS (PARTITION BY endpoint ORDER BY hour_start ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING))
        SELECT * FROM z WHERE z_score >= 3.0"""
    from loglens.plans.queries import INDEXED_SEARCH, SEARCH
    s["log_search"] = _with_parsed() + f"""SELECT "offset", "timestamp", ip, request, status FROM p
        WHERE contains(request, {_q(SEARCH['contains'])}) AND status = {_q(SEARCH['status'])}
          AND "timestamp" >= TIMESTAMP {_q(SEARCH['start'])} AND "timestamp" < TIMESTAMP {_q(SEARCH['end'])}"""
    s["lake_log_search"] = s["log_search"]
    s["indexed_log_search"] = _with_parsed() + f"""SELECT "offset", "timestamp", ip, request, status FROM p
        WHERE contains(request, {_q(INDEXED_SEARCH['contains'])}) AND ip = {_q(INDEXED_SEARCH['ip'])}"""
    return s


def all_oracles() -> dict[str, str]:
    from loglens.streaming.queries import stream_oracles
    out = batch_oracles()
    out.update(stream_oracles())
    return out
