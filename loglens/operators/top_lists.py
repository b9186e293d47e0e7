"""Top lists that stay current: mergeable frequent-item sketches, recounted exactly.

A sketch of bounded size (Spark's ``approx_top_k_accumulate``) of each micro-batch
and day is kept beside the metrics, and sketches add up: a dashboard combines the few
rows of its days instead of grouping all records by endpoint. The sketch only
names candidates. Their numbers come from an exact recount of the stored records, and the
result is known to be the true list if its last number is above the sketch's error: an endpoint
the sketch does not name has at most ``error_bound`` requests. Otherwise (nearly equal
endpoints beyond the sketch's size) all endpoints are counted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loglens.functions import parsing as fx
from loglens.operators.dashboards import is_parsed, top_endpoints

ITEMS = 1024
# Fixed values of the sketch: its error is this share of all items over its map size, of which it fills this part.
ERROR, FILL = 3.5, 0.75


def endpoint_sketches(parsed: DataFrame, items: int = ITEMS) -> DataFrame:
    """(day, requests, sketch) of parsed records: one bounded row per day of ``timestamp``, combined map-side."""
    rows = parsed.select(F.to_date("timestamp").alias("day"), is_parsed().alias("ok"),
                         F.when(is_parsed(), fx.endpoint_of(F.col("request"))).alias("endpoint"))
    return rows.groupBy("day").agg(F.count_if("ok").alias("requests"),
                                   F.expr(f"approx_top_k_accumulate(endpoint, {items})").alias("sketch"))


def add_sketches(sketches: DataFrame, items: int = ITEMS) -> DataFrame:
    """The sketches of many batches, one row per day; ``batch_id`` becomes the newest one."""
    return sketches.groupBy("day").agg(F.sum("requests").alias("requests"),
                                       F.expr(f"approx_top_k_combine(sketch, {items})").alias("sketch"),
                                       F.max("batch_id").alias("batch_id"))


def error_bound(requests: int, items: int = ITEMS) -> float:
    """The most requests of an endpoint that is not among the sketch's candidates.

    The estimate lists items whose lower bound exceeds the error, so an item left out has at most twice the error."""
    return 2 * ERROR * FILL / items * requests


def candidates(sketches: DataFrame, items: int = ITEMS) -> DataFrame:
    """(endpoint, estimate): what the sketches of all given days name, at most ``items`` rows."""
    found = F.expr(f"approx_top_k_estimate(approx_top_k_combine(sketch, {items}), {items})")
    return (sketches.agg(found.alias("found")).select(F.explode("found").alias("f"))
            .select(F.col("f.item").alias("endpoint"), F.col("f.count").alias("estimate")).where("endpoint is not null"))


def live_top_endpoints(records: DataFrame, sketches: DataFrame, k: int = 10, items: int = ITEMS) -> DataFrame:
    """``dashboards.top_endpoints`` of the stored ``records`` (request, status) that ``sketches`` summarise: the same rows.

    Only records of candidates are grouped; the candidates, at most ``items``, are broadcast."""
    total = sketches.agg(F.sum("requests")).first()[0] or 0
    named = candidates(sketches, items).select("endpoint")
    rows = records.select("request", "status").withColumn("endpoint", fx.endpoint_of(F.col("request")))
    listed = top_endpoints(rows.join(F.broadcast(named), "endpoint", "left_semi"), k)
    top = [r.requests for r in listed.collect()]   # k rows
    if total and len(top) == k and top[-1] > error_bound(total, items):
        return listed
    return top_endpoints(records, k)
