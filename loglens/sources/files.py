"""Plain-text and gzip access-log files (the generator's file outputs)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Generator file names: [prefix_]access_log_<yyyymmdd-HHMMSS>.log[.gz]
ACCESS_LOG_GLOB = "*access_log_*.log*"
# Text files as Spark writes them, compressed or not.
TEXT_GLOB = "part-*.txt*"


def log_files(spark: SparkSession, path: str, glob: str = ACCESS_LOG_GLOB,
              streaming: bool = False, min_partitions: int | None = None) -> DataFrame:
    """Lines of matching files as ``value`` plus the source ``file_name``.

    ``.gz`` files are decompressed transparently but cannot be split: each
    is read by one task. Where files are large, pass ``min_partitions``: a
    round-robin redistribution of the lines (no key, so no skew) before any
    parsing, so only the decompression stays on one task per file.
    """
    reader = spark.readStream if streaming else spark.read
    df = reader.option("pathGlobFilter", glob).option("recursiveFileLookup", "true") \
        .format("text").load(path)
    df = df.select("value", F.col("_metadata.file_name").alias("file_name"))
    return df if streaming or min_partitions is None else df.repartition(min_partitions)
