"""Substring search that skips files: an n-gram Bloom filter per data file.

``log_search`` pushes equality and time predicates into the Parquet scan, but
a substring test must read every file of the date range. The index is a side
table with one row per data file of a lake: its name, size and modification
time, the range of its time stamps, and a Bloom filter of

* all runs of ``GRAM`` characters of the text columns (``request`` by default),
* all values of the key columns (``ip`` by default).

A text that contains a needle contains all grams of the needle, so a file whose
filter lacks one of them can't have a hit. False positives cost a read, misses
do not occur: files the index does not know (new or rewritten ones) and needles
shorter than a gram are always searched.

Building is one aggregation over the files that are not indexed yet: distinct
texts per file, their distinct grams as 64-bit hashes, then Spark's bitmap
aggregate per (file, 4 KB bucket). A filter has ``BITS`` bits per distinct entry,
rounded up to a power of two, ``MOST_BITS`` at most, so the table is a small
part of the lake and grows with its number of files. Searching tests the filters
row by row, without a shuffle; only names of files with possible hits reach the
driver, as in every Spark read.
"""

from __future__ import annotations

import uuid
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loglens.operators.dashboards import log_search
from loglens.sources.feeds import path_exists
from loglens.streaming import tables

GRAM = 3
HASHES = 4
BITS = 12
MOST_BITS = 1 << 23
# Bits of one value of Spark's bitmap aggregate (a fixed value of that function).
BUCKET = 32_768

FILE = ["path", "size", "modified"]
_META = {"path": "_metadata.file_path", "size": "_metadata.file_size", "modified": "_metadata.file_modification_time"}


def _file_columns() -> list[Column]:
    return [F.col(c).alias(name) for name, c in _META.items()]


def lake_files(spark: SparkSession, lake: str) -> DataFrame:
    """(path, size, modified) of the data files of a lake, of a managed one those that its manifest names; no content is read."""
    parts = tables.part_paths(spark, lake) if tables.is_managed(spark, lake) else lake
    return (spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
            .load(parts).select(*_file_columns()))


def _records(spark: SparkSession, lake: str, names: list[str] | None = None, add: tuple[Column, ...] = ()) -> DataFrame:
    """The records of a lake with the columns ``add`` of the scan, or only those of the files ``names``."""
    if tables.is_managed(spark, lake):
        return tables.read(spark, lake, names, add).drop("batch_id")
    whole = spark.read.parquet(lake)
    if names is None:
        return whole.select("*", *add)
    names = [unquote(n) for n in names]
    rows = spark.read.schema(whole.schema).option("basePath", lake).parquet(*names) if names else whole.where(F.lit(False))
    return rows.select("*", *add)


def _entry(kind: str, value: Column) -> Column:
    return F.xxhash64(F.lit(kind), value)


def _grams(text: Column) -> Column:
    """The distinct runs of ``GRAM`` characters of a text."""
    last = F.length(text) - (GRAM - 1)
    return F.when(last >= 1, F.array_distinct(F.transform(F.sequence(F.lit(1), last), lambda i: F.substr(text, i, F.lit(GRAM)))))


def _places(entry: Column, bits: Column) -> Column:
    return F.array(*[F.pmod(F.xxhash64(entry, F.lit(i)), bits) for i in range(HASHES)])


def file_filters(records: DataFrame, texts: tuple[str, ...], keys: tuple[str, ...]) -> DataFrame:
    """One row per file of ``records`` (with the columns of ``FILE`` and ``timestamp``): rows, first and last time stamp,
    number of distinct entries, ``bits`` and the filter ``bloom``."""
    facts = records.groupBy(*FILE).agg(F.count(F.lit(1)).alias("rows"), F.min("timestamp").alias("first"), F.max("timestamp").alias("last"))
    parts = []
    for name in texts:
        distinct = records.where(F.col(name).isNotNull()).select(*FILE, F.col(name).alias("t")).distinct()
        parts.append(distinct.select(*FILE, F.explode(_grams(F.col("t"))).alias("g")).select(*FILE, _entry(f"gram {name}", F.col("g")).alias("entry")))
    for name in keys:
        parts.append(records.where(F.col(name).isNotNull()).select(*FILE, _entry(f"key {name}", F.col(name)).alias("entry")))
    entries = parts[0]
    for p in parts[1:]:
        entries = entries.unionByName(p)
    entries = entries.distinct()
    # A power of two of at least BITS bits an entry, whole bitmap buckets.
    need = F.greatest(F.lit(BUCKET), F.least(F.lit(MOST_BITS), F.pow(F.lit(2.0), F.ceil(F.log2(F.col("entries") * BITS))).cast("long")))
    sizes = entries.groupBy(*FILE).agg(F.count(F.lit(1)).alias("entries")).withColumn("bits", need.cast("long"))
    placed = (entries.join(sizes, FILE).select(*FILE, "bits", F.explode(_places(F.col("entry"), F.col("bits"))).alias("place"))
              .groupBy(*FILE, "bits", F.floor(F.col("place") / BUCKET).alias("bucket"))
              .agg(F.bitmap_construct_agg((F.col("place") % BUCKET)).alias("bitmap")))
    empty = F.unhex(F.repeat(F.lit("00"), F.lit(BUCKET // 8)))
    whole = F.aggregate(F.transform(F.sequence(F.lit(0).cast("long"), F.floor(F.col("bits") / BUCKET) - 1),
                                    lambda b: F.coalesce(F.try_element_at(F.col("of"), b), empty)),
                        F.lit(b""), lambda acc, x: F.concat(acc, x))
    blooms = (placed.groupBy(*FILE, "bits").agg(F.map_from_entries(F.collect_list(F.struct("bucket", "bitmap"))).alias("of"))
              .select(*FILE, "bits", whole.alias("bloom")))
    return facts.join(sizes.drop("bits"), FILE, "left").join(blooms, FILE, "left")


def index_lake(spark: SparkSession, lake: str, index: str, texts: tuple[str, ...] = ("request",), keys: tuple[str, ...] = ("ip",)) -> int:
    """Index the files of ``lake`` that the table ``index`` does not have; the number of files added.

    The side table is only appended to. Two runs at a time may both add a file, which costs space and nothing else."""
    names = None
    if path_exists(spark, index):
        new = lake_files(spark, lake).join(_index(spark, index).select(*FILE), FILE, "left_anti")
        names = [r.path for r in new.select("path").collect()]
        if not names:
            return 0
    part = f"{index}/part={uuid.uuid4().hex[:12]}"
    file_filters(_records(spark, lake, names, tuple(_file_columns())), texts, keys).write.parquet(part)
    return spark.read.parquet(part).count()


def _index(spark: SparkSession, index: str) -> DataFrame:
    return spark.read.parquet(index).drop("part")


def _may_hold(entries: list[Column]) -> Column:
    """Whether a filter has all the places of all entries."""
    def bit(place: Column) -> Column:
        # The aggregate puts bit n of a bucket into byte n / 8, at n % 8.
        byte = F.conv(F.hex(F.substr(F.col("bloom"), (F.floor(place / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
        return F.getbit(byte, (place % 8).cast("int")) == 1

    ok = F.lit(True)
    for e in entries:
        for i in range(HASHES):
            ok = ok & bit(F.pmod(F.xxhash64(e, F.lit(i)), F.col("bits")))
    return F.col("bloom").isNull() | ok


def candidate_files(spark: SparkSession, lake: str, index: str, contains: str | None = None, start: str | None = None,
                    end: str | None = None, ip: str | None = None, text: str = "request") -> DataFrame:
    """(path) of the files of ``lake`` that may have a hit: all that the index does not rule out."""
    entries = []
    for at in range(len(contains or "") - GRAM + 1):
        entries.append(_entry(f"gram {text}", F.lit(contains[at:at + GRAM])))
    if ip is not None:
        entries.append(_entry("key ip", F.lit(ip)))
    known = _index(spark, index)
    keep = _may_hold(entries) if entries else F.lit(True)
    if start is not None:
        keep = keep & (F.col("last") >= F.lit(start).cast("timestamp"))
    if end is not None:
        keep = keep & (F.col("first") < F.lit(end).cast("timestamp"))
    out = known.where(~F.coalesce(keep, F.lit(True))).select(*FILE)
    return lake_files(spark, lake).join(out, FILE, "left_anti").select("path")


def indexed_search(spark: SparkSession, lake: str, index: str, contains: str | None = None, status: str | None = None,
                   start: str | None = None, end: str | None = None, ip: str | None = None) -> DataFrame:
    """``log_search`` over the files that the index does not rule out. The result equals that of the whole lake."""
    names = [r.path for r in candidate_files(spark, lake, index, contains, start, end, ip).collect()]
    return log_search(_records(spark, lake, names), contains, status, start, end, ip)
