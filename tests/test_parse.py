"""Line-class table (FIXTURES.md section 3) and parser equivalences."""

import datetime as dt

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from loglens.functions import patterns as P
from loglens.operators import alerts, parse

PREFIX = '1.2.3.4 - - [20/Oct/2025:09:13:26 +0700] "GET /list HTTP/1.0"'
FULL = ("1.2.3.4", "20/Oct/2025:09:13:26 +0700", "GET /list HTTP/1.0")
EMPTY = ("",) * 7

CASES = [
    ("extended", PREFIX + ' 200 12 "-" "UA"', FULL + ("200", "12", "-", "UA")),
    ("common", PREFIX + " 404 5000", EMPTY),
    ("dash bytes", PREFIX + ' 304 - "-" "UA"', EMPTY),
    ("remote user", PREFIX.replace("- -", "- bob") + ' 200 1 "-" "UA"', EMPTY),
    ("leading space", " " + PREFIX + ' 200 12 "-" "UA"', EMPTY),
    ("big bytes", PREFIX + ' 500 5000000000 "-" "UA"', FULL + ("500", "5000000000", "-", "UA")),
    ("inner quotes", PREFIX + ' 200 12 "-" "UA \\"x\\" y" trailing', FULL + ("200", "12", "-", "UA \\")),
    ("newline", PREFIX + ' 200 12 "-" "UA"\nmore text', FULL + ("200", "12", "-", "UA")),
    ("sep byte", PREFIX + ' 200 12 "-" "U\u0001A"', FULL + ("200", "12", "-", "U\u0001A")),
    ("junk", "hello", EMPTY),
    ("empty", "", EMPTY),
    ("null", None, (None,) * 7),
]


def _frame(spark, lines):
    rows = [(i, line) for i, line in enumerate(lines)]
    return spark.createDataFrame(rows, "offset bigint, value string")


@pytest.mark.parametrize("single_pass", [True, False])
def test_line_classes(spark, single_pass):
    df = _frame(spark, [c[1] for c in CASES])
    out = parse.parse_access(df, keep=("offset",), single_pass=single_pass) \
        .orderBy("offset").collect()
    for (name, _, expected), row in zip(CASES, out):
        got = tuple(row[f] for f in P.EXTENDED_FIELDS)
        assert got == expected, name


def test_typed_overflow_and_ansi(spark):
    df = _frame(spark, [CASES[0][1], CASES[5][1], "junk"]).withColumn(
        "key", F.lit(None).cast("string")).withColumn("timestamp", F.current_timestamp())
    rows = parse.typed(parse.parse_access(df, keep=("offset", "key", "timestamp"))) \
        .orderBy("offset").collect()
    assert (rows[0].status_code_int, rows[0].bytes_int) == (200, 12)
    assert (rows[1].status_code_int, rows[1].bytes_int) == (500, None)
    assert (rows[2].status_code_int, rows[2].bytes_int) == (None, None)


def test_parse_any_common_format(spark):
    lines = [PREFIX + " 404 5000", PREFIX + ' 304 - "-" "UA"',
             PREFIX.replace("- -", "- bob") + ' 200 1 "r" "UA"', "junk"]
    rows = parse.parse_any(_frame(spark, lines)).orderBy("offset").collect()
    assert (rows[0].status, rows[0].bytes, rows[0].referrer, rows[0].user_agent) == ("404", "5000", "", "")
    assert (rows[1].bytes, rows[1].user_agent) == ("-", "UA")
    assert rows[2].remote_user == "bob"
    assert rows[3].ip == ""


def test_event_time_utc(spark):
    df = _frame(spark, [CASES[0][1]]).withColumn("timestamp", F.current_timestamp())
    row = parse.enrich(parse.parse_access(df, keep=("offset",)), keep=("offset",)).collect()[0]
    assert row.event_time == dt.datetime(2025, 10, 20, 2, 13, 26)
    assert (row.method, row.uri, row.protocol, row.endpoint, row.status_class) == \
        ("GET", "/list", "HTTP/1.0", "/list", "2xx")


def test_parse_quality_classes(spark):
    lines = [CASES[0][1], PREFIX + " 404 5000", "junk", None]
    got = {r.line_class: r.line_count for r in parse.parse_quality(_frame(spark, lines)).collect()}
    assert got == {"parsed_elf": 1, "parsed_other": 1, "unparsed": 1, "null": 1}


def test_json_classes(spark):
    docs = [
        '{"timestamp":"2024-01-01T00:00:05Z","level":"ERROR","message":"m","user_id":7}',
        "notjson",
        '{"timestamp":"2024-01-01T00:00:05Z","level":"WARN","message":"m","user_id":"abc"}',
        '{"timestamp":"2024-01-01T00:00:05Z","level":"CRITICAL","message":"m","user_id":99999999999}',
        '{"timestamp":"yesterday","level":"ERROR","message":"m","user_id":1}',
        '{"timestamp":"2024-01-01T00:00:05Z","level":"error","message":"m","user_id":1}',
        '{"timestamp":"2024-01-01T00:00:05Z","message":"m","user_id":1}',
        None,
    ]
    env = spark.createDataFrame([(i, d) for i, d in enumerate(docs)], "offset bigint, v string") \
        .select("offset", F.encode("v", "UTF-8").alias("value"),
                F.current_timestamp().alias("timestamp"))
    rows = {r.offset: r for r in alerts.severity_filter(
        alerts.parse_json_log(env, keep=("offset",))).collect()}
    assert sorted(rows) == [0, 2, 3, 4]
    assert {r.offset for r in alerts.json_alerts(env, keep=("offset",)).collect()} == set(rows)
    assert rows[0].user_id == 7 and rows[0].log_timestamp == dt.datetime(2024, 1, 1, 0, 0, 5)
    assert rows[2].user_id is None and rows[2].log_level == "WARN"
    assert rows[3].user_id is None
    assert rows[4].log_timestamp is None and rows[4].user_id == 1


_token = st.text(alphabet=st.characters(blacklist_characters=' "\n\r\t\u0001',
                                        blacklist_categories=("Cs", "Zs", "Zl", "Zp", "Cc")),
                 min_size=1, max_size=12)
_quoted = st.text(alphabet=st.characters(blacklist_characters='"\n\u0001',
                                         blacklist_categories=("Cs",)), max_size=20)
# Java's "." does not match these, so a quoted field holding one makes the
# whole line unparsed (same as the original job's regexp_extract).
_JAVA_LINE_TERMINATORS = set("\n\r\u0085\u2028\u2029")


@settings(max_examples=15, deadline=None)
@given(ip=_token, req=_quoted, status=st.integers(100, 999), size=st.integers(0, 10**9),
       ref=_quoted, ua=_quoted, common=st.booleans())
def test_render_then_parse(spark, ip, req, status, size, ref, ua, common):
    stamp = "01/Jan/2024:00:00:00 +0000"
    if common:
        line = f'{ip} - - [{stamp}] "{req}" {status} {size}'
    else:
        line = f'{ip} - - [{stamp}] "{req}" {status} {size} "{ref}" "{ua}"'
    df = _frame(spark, [line])
    elf = parse.parse_access(df, keep=("offset",)).collect()[0]
    naive = parse.parse_access(df, keep=("offset",), single_pass=False).collect()[0]
    assert elf == naive
    assert parse.parse_any(df).collect() == parse.parse_any(df, single_pass=False).collect()
    if _JAVA_LINE_TERMINATORS & set(req + ("" if common else ref + ua)):
        return
    any_row = parse.parse_any(df).collect()[0]
    assert (any_row.ip, any_row.request, any_row.status, any_row.bytes) == (ip, req, str(status), str(size))
    if not common:
        assert (elf.referrer, elf.user_agent) == (ref, ua)
        assert (any_row.referrer, any_row.user_agent) == (ref, ua)
    else:
        assert elf.ip == ""


@pytest.mark.parametrize("pattern", [P.EXTENDED_PATTERN, P.ANY_PATTERN])
def test_single_pass_equals_per_group_on_line_classes(spark, pattern):
    from loglens.functions import parsing as fx
    names = tuple(f"g{i}" for i in range(1, 9 if pattern == P.ANY_PATTERN else 8))
    df = _frame(spark, [c[1] for c in CASES] + [PREFIX + " 404 -", PREFIX + ' 200 5 "r"'])
    fast = fx.with_groups(df, "value", pattern, names, ["offset"]).orderBy("offset").collect()
    slow = df.select("offset", *fx.extract_groups_naive(F.col("value"), pattern, names)) \
        .orderBy("offset").collect()
    assert fast == slow


def test_pattern_with_quote_is_rejected(spark):
    from loglens.functions import parsing as fx
    with pytest.raises(ValueError):
        fx.with_groups(_frame(spark, ["x"]), "value", "(')", ("a",), ["offset"])


def test_literal_alternations_match_like_rlike(spark):
    from loglens.functions import parsing as fx
    texts = ["Opera/9.80", "x OPR/1", "Mozilla Firefox", "", None, "a.b", "aXb"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for rx in ("Opera|OPR/", "Firefox|FxiOS", "Safari", "a.b"):
        got = df.select(fx.matches(df.t, rx).alias("m"), df.t.rlike(rx).alias("r")).collect()
        assert all(r.m == r.r for r in got), rx


def test_matched_parse_equals_filter_then_parse(spark):
    df = _frame(spark, [c[1] for c in CASES])
    one_pass = parse.parse_access_matched(df, keep=("offset",)).orderBy("offset").collect()
    two_pass = parse.parse_access(df.where(df.value.rlike(P.EXTENDED_PATTERN)), keep=("offset",)) \
        .orderBy("offset").collect()
    assert one_pass == two_pass and len(one_pass) == 5
