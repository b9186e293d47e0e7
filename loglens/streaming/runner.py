"""Run a streaming query over everything available, then stop."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

AVAILABLE_NOW = {"availableNow": True}
_SHUFFLE = "spark.sql.shuffle.partitions"
# What queries with ``transformWithState`` need: only this provider keeps several states of a key.
KEYED_STATE = {"spark.sql.streaming.stateStore.providerClass":
               "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}

# Progress summary of the last blocking run per label (rows, batches, time).
PROGRESS: dict[str, dict] = {}


def summarize(query: StreamingQuery) -> dict:
    """Rows, micro-batches and processing rate from the query's progress log."""
    prog = [p for p in query.recentProgress if p.numInputRows is not None]
    rows = sum(p.numInputRows for p in prog)
    ms = sum((p.durationMs or {}).get("triggerExecution", 0) for p in prog)
    late = sum(op.numRowsDroppedByWatermark or 0 for p in prog for op in (p.stateOperators or []))
    state = [op.numRowsTotal for op in (prog[-1].stateOperators or [])] if prog else []
    return {"rows": rows, "batches": sum(1 for p in prog if p.numInputRows),
            "trigger_ms": ms, "rows_per_sec": round(rows * 1000.0 / ms, 1) if ms else None,
            "dropped_by_watermark": late, "state_rows": state}


def added(total: dict, run: dict) -> dict:
    """Progress of several runs of one query."""
    if not total:
        return dict(run)
    out = total | {k: total[k] + run[k] for k in ("rows", "batches", "trigger_ms", "dropped_by_watermark")}
    out["rows_per_sec"] = round(out["rows"] * 1000.0 / out["trigger_ms"], 1) if out["trigger_ms"] else None
    return out | {"state_rows": run["state_rows"]}


def finish(query: StreamingQuery, timeout_s: float | None = None) -> StreamingQuery:
    """Wait for an availableNow query, as long as its backlog takes, and re-raise
    its failure. ``timeout_s`` is for callers that want a limit."""
    if timeout_s is None:
        query.awaitTermination()
    elif not query.awaitTermination(timeout_s):
        query.stop()
        raise TimeoutError(f"streaming query {query.name or query.id} did not finish in {timeout_s}s")
    exc = query.exception()
    if exc is not None:
        raise RuntimeError(f"streaming query failed: {exc}")
    return query


def finish_all(spark: SparkSession, queries: list[StreamingQuery], timeout_s: float | None = None) -> list[StreamingQuery]:
    """Wait until all of several availableNow queries have ended. As soon as one fails, in whatever order they were
    given, the others are stopped and its failure is raised. ``timeout_s`` is for callers that want a limit."""
    end = None if timeout_s is None else time.monotonic() + timeout_s
    while True:
        spark.streams.resetTerminated()
        broken = [q for q in queries if q.exception() is not None]
        late = end is not None and time.monotonic() >= end and any(q.isActive for q in queries)
        if broken or late:
            for q in queries:
                if q.isActive:
                    q.stop()
            if broken:
                raise RuntimeError(f"streaming query failed: {broken[0].exception()}")
            raise TimeoutError(f"streaming queries did not finish in {timeout_s}s")
        if not any(q.isActive for q in queries):
            return queries
        try:
            # Returns at once if a query has ended since the reset above.
            if end is None:
                spark.streams.awaitAnyTermination()
            else:
                spark.streams.awaitAnyTermination(max(0.1, end - time.monotonic()))
        except StreamingQueryException:
            continue  # reported above, with its siblings stopped


def run_available(spark: SparkSession,
                  start: Callable[[], StreamingQuery | list[StreamingQuery]],
                  state_partitions: int | None = None, timeout_s: float | None = None,
                  label: str | None = None, settings: dict[str, str] | None = None) -> StreamingQuery | list[StreamingQuery]:
    """Start a query (or several) with ``start()`` and block until each has
    consumed its input.

    A stateful query fixes its shuffle (= state store) width at its first
    batch and keeps it for the life of the checkpoint. ``state_partitions``
    (default: the parallelism at this moment, which suits a checkpoint used
    once; give it for one that is kept) applies to this query only: a
    streaming query runs on a copy of the session taken when it starts, so
    the caller's setting is restored as soon as ``start()`` returns. So are
    further ``settings`` that the query needs, e.g. ``KEYED_STATE``.
    """
    width = state_partitions or spark.sparkContext.defaultParallelism
    own = {_SHUFFLE: str(width)} | (settings or {})
    before = {k: spark.conf.get(k, None) for k in own}
    for k, v in own.items():
        spark.conf.set(k, v)
    try:
        started = start()
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    many = isinstance(started, list)
    qs = finish_all(spark, started if many else [started], timeout_s)
    if label:
        parts = [summarize(q) for q in qs]
        PROGRESS[label] = parts[0] if len(parts) == 1 else {"queries": parts}
    return qs if many else qs[0]
