"""Benchmark decontamination: SimHash of item-sized windows, multi-index Hamming search, exact check.

Words are the lower-cased runs of letters and digits; shingles are five words.
For every occurrence of one of a benchmark item's shingles in a document, the
window of the item's own size that lines the two up is fingerprinted (64-bit
SimHash of its shingles). Windows without any of them have similarity 0 with
all items, so none is lost. Each item's fingerprint is filed under every value
within ``BLOCK_RADIUS`` bits of each of its eight bytes, with the item's size:
a window finds by equality all items of its size whose fingerprint differs in
fewer than 8 * (BLOCK_RADIUS + 1) bits. Pairs within ``RADIUS`` are verified
by weighted Jaccard similarity of their shingle bags (weights: how rare a
shingle is among the items) of ``THRESHOLD`` or more.

Native: DataFrame functions only. A first read of the documents yields the
places of such windows, written as a table; a second one cuts the windows out
of the documents that have any. No key groups documents, so no hot passage
gathers anywhere. The places and the items' tables are broadcast only up to
``BROADCAST_ROWS`` counted rows and are joined by shuffle beyond.

Defined results: null or empty texts and items of fewer than five words match
nothing; a document shorter than an item is one window as a whole; repeated
documents return repeated rows only once per doc_id; repeated items of one
item_id return the best one. Other columns are ignored. Empty in, empty out.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loglens.llm.store import stored

SHINGLE = 5
THRESHOLD = 0.8
RADIUS = 22
BLOCK_RADIUS = 2
BROADCAST_ROWS = 1_000_000

_WORDS = "filter(split(lower(coalesce(text, '')), '[^\\\\p{L}\\\\p{N}]+'), w -> w <> '')"
# Elements are named one by one: slice() copies the whole array at every call.
_SHINGLES = (f"CASE WHEN size(words) < {SHINGLE} THEN array() ELSE transform(sequence(0, size(words) - {SHINGLE}), "
             f"i -> xxhash64({', '.join(f'words[i + {k}]' for k in range(SHINGLE))})) END")
_MASKS = sorted({(1 << a | 1 << b) * (a != b) for a in range(8) for b in range(8)} | {1 << a for a in range(8)} | {0})


def shingled(df: DataFrame, *keep: str) -> DataFrame:
    """The columns ``keep`` and ``hs``, the hashes of a text's shingles in order.

    Each step is a generator of one row: the optimizer copies no filter on a
    later column, and so no second evaluation of the step, below a generator."""
    split = df.select(*keep, F.explode(F.array(F.expr(_WORDS))).alias("words"))
    return split.select(*keep, F.explode(F.array(F.expr(_SHINGLES).cast("array<bigint>"))).alias("hs"))


def simhash(shingles: str) -> Column:
    """64-bit SimHash of an array of hashes: bit b is the majority of the hashes' bits b."""
    votes = f"aggregate({shingles}, 0, (s, h) -> s + IF(shiftright(h, b) & 1 = 1, 1, -1))"
    return F.expr(f"aggregate(sequence(0, 63), 0L, (f, b) -> f | IF({votes} > 0, shiftleft(1L, b), 0L))")


def _bytes(fingerprint: str) -> str:
    return f"transform(sequence(0, 7), k -> cast(shiftrightunsigned({fingerprint}, 8 * k) & 255 as int))"


def _small(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def benchmark_items(benchmark: DataFrame) -> DataFrame:
    """Per item with shingles: item_id, hs, n (shingles), fingerprint."""
    return (shingled(benchmark.select("item_id", "text").distinct(), "item_id").where("size(hs) > 0")
            .select("item_id", "hs", F.size("hs").alias("n"), simhash("hs").alias("fp")))


def find_leaks(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, radius: int = RADIUS) -> DataFrame:
    """Pairs (doc_id, item_id) with a window of similarity ``threshold`` or more: similarity of the best window.

    ``RADIUS`` covers thresholds from ``THRESHOLD`` on; a lower one needs a ``radius`` given with it."""
    if threshold < THRESHOLD and radius <= RADIUS:
        raise ValueError(f"a threshold below {THRESHOLD} needs a radius above {RADIUS}")
    items = benchmark_items(benchmark)
    places = items.select("item_id", "n", F.posexplode("hs").alias("at", "h"))
    sizes = places.agg(F.count(F.lit(1)).alias("rows"), F.countDistinct("item_id").alias("items")).first()
    rows, total = sizes["rows"], sizes["items"]
    weights = places.groupBy("h").agg(F.log(1 + total / F.countDistinct("item_id")).alias("w"))
    rarest = math.log(1 + total)

    seeds = places.select("h", "n", "at").distinct()
    # First the places alone (rows of a few numbers), then the windows of the documents that have any.
    spots = stored(shingled(docs, "doc_id").select("doc_id", F.size("hs").alias("size"), F.posexplode_outer("hs").alias("pos", "h"))
                   .join(_small(seeds, rows), "h")
                   .select("doc_id", "n", F.greatest(F.lit(0), F.least(F.col("pos") - F.col("at"), F.col("size") - F.col("n"))).alias("start"))
                   .distinct(), "leak-spots")
    marked = spots.groupBy(F.col("doc_id").alias("id")).agg(F.collect_set(F.struct("start", "n")).alias("spots"))
    held = docs.select("doc_id", "text").join(_small(marked, spots.count()), F.col("doc_id").eqNullSafe(F.col("id")))
    hits = (shingled(held, "doc_id", "spots").select("doc_id", "hs", F.explode("spots").alias("spot"))
            .select("doc_id", "spot.start", "spot.n", F.expr("slice(hs, spot.start + 1, spot.n)").alias("win"))
            .where("size(win) > 0").distinct())
    weighed = (hits.select("doc_id", "start", "n", "win", F.explode("win").alias("h"))
               .join(_small(weights, rows), "h", "left")
               .groupBy("doc_id", "start", "n", "win").agg(F.sum(F.coalesce("w", F.lit(rarest))).alias("mass")))
    windows = weighed.withColumn("fp", simhash("win"))

    index = (items.select("item_id", "n", "fp", F.posexplode(F.expr(_bytes("fp"))).alias("block", "byte"))
             .withColumn("mask", F.explode(F.array(*[F.lit(m) for m in _MASKS])))
             .select("item_id", "n", F.col("fp").alias("item_fp"), "block", F.expr("byte ^ mask").alias("byte")))
    near = (windows.select("*", F.posexplode(F.expr(_bytes("fp"))).alias("block", "byte"))
            .join(_small(index, total * 8 * len(_MASKS)), ["n", "block", "byte"])
            .where(F.bit_count(F.expr("fp ^ item_fp")) <= radius)
            .select("doc_id", "start", "n", "win", "mass", "item_id").distinct())

    bags = (places.groupBy("item_id", "n", "h").agg(F.count(F.lit(1)).alias("c")).join(weights, "h")
            .groupBy("item_id", "n").agg(F.collect_list(F.struct("h", "c", "w")).alias("bag"), F.sum(F.col("c") * F.col("w")).alias("item_mass")))
    common = F.expr("aggregate(bag, 0D, (s, b) -> s + b.w * least(b.c, size(filter(win, h -> h = b.h))))")
    similarity = F.col("common") / (F.col("mass") + F.col("item_mass") - F.col("common"))
    return (near.join(_small(bags, rows), ["item_id", "n"]).withColumn("common", common)
            .withColumn("similarity", F.round(similarity, 6)).where(F.col("similarity") >= threshold)
            .groupBy("doc_id", "item_id").agg(F.max("similarity").alias("similarity")))


def clean_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the documents that hold a benchmark item.

    Rows are named by a digest of doc_id and text, so rows without doc_id go as well if they hold
    one, and of two texts under one doc_id only that which does."""
    digest = F.md5(F.concat_ws("|", F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.coalesce("text", F.lit(""))).cast("binary"))
    named = docs.withColumn("_row", digest)
    leaked = find_leaks(named.select(F.col("_row").alias("doc_id"), "text"), benchmark).select(F.col("doc_id").alias("_row")).distinct()
    return named.join(leaked, "_row", "left_anti").select(*docs.columns)


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, with the similarity of the best window."""
    return find_leaks(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def _shingle_sql(table: str, key: str) -> str:
    return f"""SELECT {key}, CASE WHEN len(w) < {SHINGLE} THEN [] ELSE list_transform(range(1, len(w) - {SHINGLE - 2}),
      lambda i: array_to_string(w[i:i + {SHINGLE - 1}], ' ')) END AS hs
    FROM (SELECT {key}, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\\p{{L}}\\p{{N}}]+'), lambda x: x <> '') AS w FROM {table})"""


ORACLE = f"""
WITH i AS ({_shingle_sql('(SELECT DISTINCT item_id, text FROM benchmark)', 'item_id')}),
p AS (SELECT item_id, len(hs) AS n, unnest(hs) AS h, generate_subscripts(hs, 1) - 1 AS q FROM i WHERE len(hs) > 0),
w AS (SELECT h, ln(1 + (SELECT count(DISTINCT item_id) FROM p) / count(DISTINCT item_id)) AS w FROM p GROUP BY h),
d AS ({_shingle_sql('documents', 'doc_id')}),
x AS (SELECT doc_id, hs, unnest(hs) AS h, generate_subscripts(hs, 1) - 1 AS pos FROM d),
win AS (SELECT DISTINCT doc_id, item_id, n, greatest(0, least(pos - q, len(hs) - n)) AS start,
    hs[greatest(0, least(pos - q, len(hs) - n)) + 1 : greatest(0, least(pos - q, len(hs) - n)) + n] AS win FROM x JOIN p USING (h)),
a AS (SELECT doc_id, item_id, n, start, h, count(*) AS c FROM (SELECT doc_id, item_id, n, start, unnest(win) AS h FROM win) GROUP BY ALL),
b AS (SELECT item_id, n, h, count(*) AS c FROM p GROUP BY ALL),
pair AS (SELECT doc_id, item_id, n, start, coalesce(w, ln(1 + (SELECT count(DISTINCT item_id) FROM p))) AS w, a.c AS ac, coalesce(b.c, 0) AS bc
  FROM a LEFT JOIN b USING (item_id, n, h) LEFT JOIN w USING (h)),
mass AS (SELECT item_id, n, sum(c * w) AS mass FROM b JOIN w USING (h) GROUP BY ALL),
s AS (SELECT doc_id, item_id, sum(w * least(ac, bc)) / (sum(w * ac) + any_value(mass) - sum(w * least(ac, bc))) AS s
  FROM pair JOIN mass USING (item_id, n) GROUP BY doc_id, item_id, n, start)
SELECT doc_id, item_id, max(round(s, 6)) AS similarity FROM s WHERE round(s, 6) >= {THRESHOLD} GROUP BY ALL
"""

QUERIES = {"op5_decontamination": op5_decontamination}
ORACLES = {"op5_decontamination": ORACLE}
