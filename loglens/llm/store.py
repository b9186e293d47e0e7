"""Tables written to the shared folder between the steps of an operator."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from loglens.session import scratch_path

SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

# Arrow batches of whole texts, in which Spark and its Python workers pass documents on.
BATCH_SETTINGS = {"spark.sql.execution.arrow.maxRecordsPerBatch": ("10000", "1000"),
                  "spark.sql.execution.arrow.maxBytesPerBatch": (str(64 << 20) + "b", str(4 << 20) + "b")}


def small_batches(spark: SparkSession) -> None:
    """Let Arrow batches hold a few MB of texts where the session has Spark's defaults (10,000 rows, 64 MB): a task holds several
    of them at once, in the JVM and in its worker. A setting of the user's own stays."""
    for key, (default, ours) in BATCH_SETTINGS.items():
        if spark.conf.get(key, default) == default:
            spark.conf.set(key, ours)


def stored(df: DataFrame, name: str, by: str | None = None) -> DataFrame:
    """Write ``df`` below ``spark.checkpoint.dir`` and read it back: later steps neither recompute it nor lose it with an executor.
    With ``by``, a column, each of its values has a folder of its own."""
    path = scratch_path(df.sparkSession, name)
    (df.write.partitionBy(by) if by else df.write).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def shuffles_deleted(spark: SparkSession) -> Iterator[None]:
    """Within it Spark deletes a query's shuffle files as soon as the query ends, not when the driver's JVM collects its plan."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)


def dropped(table: DataFrame, value: str = "") -> None:
    """Delete a ``stored`` table that no later step reads, or the folder ``column=value`` of one stored by that column."""
    spark = table.sparkSession
    for name in {f.rsplit("/", 1)[0] for f in table.inputFiles() if not value or f"/{value}/" in f}:
        path = spark._jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
