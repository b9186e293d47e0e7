
import datetime as dt

from loglens.operators import metrics, parse

LINE = '{ip} - - [01/Jan/2024:00:00:00 +0000] "GET /x HTTP/1.0" {status} {size} "-" "UA"'


def _parsed(spark, rows):
    df = spark.createDataFrame(
        [(i, v, dt.datetime(2024, 1, 1, 0, m, 5)) for i, (m, v) in enumerate(rows)],
        "offset bigint, value string, timestamp timestamp")
    return parse.parse_access(df, keep=("offset", "timestamp"))


def test_unparsed_lines_count_everywhere_they_did(spark):
    p = _parsed(spark, [
        (0, LINE.format(ip="1.1.1.1", status=404, size=100)),
        (0, LINE.format(ip="2.2.2.2", status=200, size=300)),
        (0, "garbage line"),
        (0, "another garbage line"),
        (1, "garbage line"),
    ])
    ov = {r.window_start.minute: r for r in metrics.overview(p).collect()}
    m0 = ov[0]
    assert m0.request_per_minute == 4                 # unparsed rows count (trap 3)
    assert m0.error_rate_percent == 25.0              # 1 error / 4 rows (trap 7)
    assert m0.average_response_size == 100.0          # 400 bytes / 4 rows (trap 6)
    assert m0.active_ip_count == 3                    # two IPs plus '' once (trap 3)
    m1 = ov[1]
    assert (m1.request_per_minute, m1.error_rate_percent) == (1, 0.0)
    assert m1.average_response_size is None           # no row with bytes
    approx = {r.window_start.minute: r.active_ip_count
              for r in metrics.active_ips(p, exact=False).collect()}
    assert approx == {0: 3, 1: 1}
    mean = {r.window_start.minute: r.mean_bytes for r in metrics.mean_bytes(p).collect()}
    assert mean == {0: 200.0, 1: None}                # avg over rows with bytes only


def test_window_metrics_match_overview(spark):
    p = _parsed(spark, [(0, LINE.format(ip="1.1.1.1", status=500, size=7)), (0, "junk")])
    row = metrics.flatten_window(metrics.window_metrics(p)).collect()[0]
    assert (row.total_requests, row.error_4xx_count, row.error_5xx_count, row.total_bytes,
            row.active_ip_count) == (2, 0, 1, 7, 2)
    assert row.window_end - row.window_start == dt.timedelta(minutes=1)
    ov = metrics.overview_from_metrics(metrics.window_metrics(p)).collect()[0]
    assert (ov.error_rate_percent, ov.average_response_size) == (50.0, 3.5)
