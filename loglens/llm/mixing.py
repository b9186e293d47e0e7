"""Mixing sources to target weights.

A corpus of several sources is mixed so that each source gives a wanted number
of words. The words of every source are added up, the targets follow from the
sources' weights, and ``rate = target / words`` says how often a source's
documents are repeated: each document is taken ``floor(rate)`` times and once
more if a coin with probability ``rate - floor(rate)``, seeded by a hash of
the document, says so.

* Targets: all sources together get ``share`` of all words, dealt by weight. A
  source whose part would be above ``cap`` times its words stops there, and
  what is too much goes to the others by weight, until none is above. Each
  round is one aggregate over the table of sources; three numbers of it reach
  the driver. All is integer arithmetic up to one last division.
* The coin is the md5 of (seed, doc_id, source, md5 of the text), so a rerun,
  another partitioning or a lost executor gives the same mix.
* The texts are read once, and what is kept of them is narrow: id, source,
  size and coin. A source that holds most rows is no hot key: sizes combine
  before the shuffle, and the few facts about a source come back by broadcast
  while the table of sources is small (counted), by a salted join beyond.

Everything is DataFrame functions; no Python worker runs.

Defined results: a null text has size 0; null is a source of its own; a source
without words has target 0 and is never taken. Rows alike in doc_id, source and
text are m copies of one document: together they get ``floor(m * fraction +
coin)`` extra takes, so a large group of them also comes near its share
(with m = 1 that is the Bernoulli coin). ``mixed`` takes the extra copies of
such a group from the one of its rows that is first by its other columns.
Extra columns, also ones named like those of the result, are kept by ``mixed``
and ignored elsewhere. Empty in, empty out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loglens.llm.joins import salted_join
from loglens.llm.store import stored

SEED = "mix"
# A table of sources of up to so many rows is broadcast.
BROADCAST_SOURCES = 20_000
# Copies of one document that a task deals out at a time.
COPIES = 4096
# Places that the table of sources is sorted into.
RANK_PARTS = 16

_GAP = r"\x20\x09-\x0D"


def word_count(text: Column) -> Column:
    """How many words ``[^\\x20\\x09-\\x0D]+`` a text has (null: 0): every word, with the
    white space around it, becomes one character in a single pass."""
    marks = F.regexp_replace(text, f"[{_GAP}]*+[^{_GAP}]++[{_GAP}]*+", "w")
    return F.when(text.rlike(f"[^{_GAP}]"), F.length(marks)).otherwise(0).cast("long")


def _coin_key(seed: str) -> Column:
    """32 hexadecimal digits that tell documents (doc_id, source, text) apart; no two parts can run into each other."""
    parts = [F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("-")),
             F.when(F.col("source").isNull(), F.lit("-")).otherwise(F.md5(F.col("source").cast("binary"))),
             F.when(F.col("text").isNull(), F.lit("-")).otherwise(F.md5(F.col("text").cast("binary")))]
    return F.md5(F.concat_ws("|", *parts).cast("binary"))


def _coin(key: Column) -> Column:
    """The key as a number of [0, 1), by its first 52 bits."""
    return F.conv(F.substring(key, 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))


def sized(docs: DataFrame, seed: str = SEED) -> DataFrame:
    """doc_id, source, size and coin key of every document, from one read of the texts, in the shared folder."""
    return stored(docs.select("doc_id", F.col("source").cast("string").alias("source"), word_count(F.col("text")).alias("size"),
                              _coin_key(seed).alias("key")), "mix-sized")


def source_sizes(rows: DataFrame) -> DataFrame:
    """(source, source_size): the words of every source, null among them."""
    return rows.groupBy("source").agg(F.sum("size").alias("source_size"))


def cyclic_weights(sources: DataFrame, cycle: tuple[int, ...]) -> DataFrame:
    """Add ``weight``: the sources in code-point order, null last, take the numbers of ``cycle`` in turn.

    The rank comes from a range partitioning: the place in the own partition
    behind the number of sources in the partitions before, so no task sees all sources."""
    placed = stored(sources.repartitionByRange(RANK_PARTS, F.col("source").asc_nulls_last())
                    .withColumn("place", F.spark_partition_id()), "mix-placed")
    before = (placed.groupBy("place").agg(F.count(F.lit(1)).alias("n"))   # at most RANK_PARTS rows
              .select("place", (F.sum("n").over(Window.orderBy("place")) - F.col("n")).alias("before")))
    inside = F.row_number().over(Window.partitionBy("place").orderBy(F.col("source").asc_nulls_last())) - 1
    rank = F.col("before") + F.col("inside")
    return (placed.withColumn("inside", inside).join(F.broadcast(before), "place")
            .withColumn("weight", F.element_at(F.array(*[F.lit(w).cast("long") for w in cycle]), (rank % len(cycle) + 1).cast("int")))
            .drop("place", "inside", "before"))


def targets(sources: DataFrame, share: tuple[int, int] = (1, 1), cap: int = 2) -> DataFrame:
    """Add ``target`` and ``rate`` to (source, source_size, weight): ``share`` (a fraction) of all
    words by weight, no source above ``cap`` times its words, the excess to the others by weight.

    Weights are positive integers. With ``left / open`` the words and weight that the sources not yet capped still share,
    a source is capped when ``cap * source_size * open < left * weight``; each round may cap more, and the share
    of the rest only grows, so the rounds end."""
    num, den = share
    sources = stored(sources, "mix-sources")
    words, weight = (F.col(c).cast("decimal(38,0)") for c in ("source_size", "weight"))
    exact = lambda n: F.lit(str(n)).cast("decimal(38,0)")
    zero = exact(0)
    total = int(sources.agg(F.coalesce(F.sum(words), zero)).first()[0])
    capped, known, left, open_weight = F.lit(False), -1, num * total, 0
    while True:
        row = sources.agg(F.coalesce(F.sum(F.when(capped, zero).otherwise(weight)), zero),
                          F.coalesce(F.sum(F.when(capped, words)), zero), F.count_if(capped)).first()
        if int(row[2]) == known:
            break
        open_weight, left, known = int(row[0]), max(num * total - den * cap * int(row[1]), 0), int(row[2])
        if open_weight == 0:
            break
        capped = words * exact(den * cap * open_weight) < weight * exact(left)
    target = F.when(capped, (F.col("source_size") * cap).cast("double")).otherwise(
        (weight * exact(left)).cast("double") / F.lit(float(den * max(open_weight, 1))))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    return sources.withColumn("target", target).withColumn("rate", rate)


def _with_source(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """``rows`` (source, key) with the columns of their source."""
    named = sources.select(F.col("source").alias("_of"), *[c for c in sources.columns if c != "source"])
    if sources.count() <= BROADCAST_SOURCES:
        return rows.join(F.broadcast(named), F.col("source").eqNullSafe(F.col("_of")), "left").drop("_of")
    mark = lambda c: F.concat(F.when(F.col(c).isNull(), F.lit("-")).otherwise(F.lit("+")), F.coalesce(F.col(c), F.lit("")))
    return salted_join(rows.withColumn("_src", mark("source")), named.select(mark("_of").alias("_src"), *named.columns[1:]), "_src", ["key"]).drop("_src")


def takes(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """(doc_id, source, size, key, source facts, ``copies``, ``m``, ``extra``): one row per
    distinct document, which ``m`` rows hold; all of them are taken ``copies`` times and ``extra`` of them once more."""
    groups = rows.groupBy("key", "doc_id", "source", "size").agg(F.count(F.lit(1)).alias("m"))
    fraction = F.col("rate") - F.floor("rate")
    return (_with_source(groups, sources).withColumn("copies", F.floor("rate").cast("long"))
            .withColumn("extra", F.floor(F.col("m") * fraction + _coin(F.col("key"))).cast("long")))


def _dealt_out(df: DataFrame, times: str, index: str, spread: bool = False) -> DataFrame:
    """Every row ``times`` times with ``index`` from 0; with ``spread`` a row of very many copies is first cut into runs for several tasks."""
    last = F.col(times) - 1
    if not spread:
        return df.where(F.col(times) > 0).withColumn(index, F.explode(F.sequence(F.lit(0).cast("long"), last)))
    runs = df.where(F.col(times) > 0).withColumn("_from", F.explode(F.sequence(F.lit(0).cast("long"), last, F.lit(COPIES).cast("long"))))
    width = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (runs.repartition(width)
            .withColumn(index, F.explode(F.sequence("_from", F.least(F.col("_from") + COPIES - 1, last)))).drop("_from"))


def mix_plan(docs: DataFrame, weights: DataFrame | tuple[int, ...], share: tuple[int, int] = (1, 1), cap: int = 2,
             seed: str = SEED) -> DataFrame:
    """Per row of ``docs`` (doc_id, source, text): doc_id, source, size, source_size, target, rate and ``times``, how often the mix takes it.

    ``weights`` is a table (source, weight) of positive integers, one row for each source, or a cycle of weights for the sources in order."""
    rows = sized(docs, seed)
    planned = stored(takes(rows, _sources(rows, weights, share, cap)), "mix-takes")
    each = _dealt_out(planned.where(F.col("m") <= COPIES), "m", "i").unionByName(
        _dealt_out(planned.where(F.col("m") > COPIES), "m", "i", spread=True))
    return each.select("doc_id", "source", "size", "source_size", "target", "rate",
                       (F.col("copies") + F.when(F.col("i") < F.col("extra"), 1).otherwise(0)).alias("times"))


def _sources(rows: DataFrame, weights: DataFrame | tuple[int, ...], share: tuple[int, int], cap: int) -> DataFrame:
    sources = source_sizes(rows)
    if isinstance(weights, DataFrame):
        given = weights.select(F.col("source").cast("string").alias("_of"), F.col("weight").cast("long").alias("weight"))
        sources = sources.join(given, F.col("source").eqNullSafe(F.col("_of"))).drop("_of")
    else:
        sources = cyclic_weights(sources, weights)
    return stored(targets(sources, share, cap), "mix-targets")


def mixed(docs: DataFrame, weights: DataFrame | tuple[int, ...], share: tuple[int, int] = (1, 1), cap: int = 2,
          seed: str = SEED) -> DataFrame:
    """The mix itself: the rows of ``docs``, whole, each as often as it is taken.

    A source without a row in ``weights`` is not taken at all."""
    rows = sized(docs, seed)
    sources = _sources(rows, weights, share, cap)
    planned = stored(takes(rows, sources), "mix-takes")
    whole = docs.select(F.struct(*docs.columns).alias("_doc"), F.col("source").cast("string").alias("source"), _coin_key(seed).alias("key"))
    rated = _with_source(whole, sources.select("source", "rate")).where("rate is not null")
    repeated = planned.where("m > 1 and extra > 0").select("key", "extra")
    times, fraction = F.floor("rate").cast("long"), F.col("rate") - F.floor("rate")
    once = F.floor(fraction + _coin(F.col("key"))).cast("long")
    keys = planned.where("m > 1").select("key", "extra")
    if keys.isEmpty():
        return _dealt_out(rated.withColumn("_times", times + once), "_times", "_i").select("_doc.*")
    single = rated.join(keys, "key", "left_anti").select("_doc", (times + once).alias("_times"))
    copies = rated.join(keys, "key", "left_semi")
    # Among repeats, every row is taken ``floor(rate)`` times, and one of them for all the extra takes of the group.
    first = copies.groupBy("key").agg(F.min("_doc").alias("_doc")).join(keys, "key").select("_doc", F.col("extra").alias("_times"))
    return (_dealt_out(single.unionByName(copies.select("_doc", times.alias("_times"))), "_times", "_i")
            .unionByName(_dealt_out(first, "_times", "_i", spread=True)).select("_doc.*"))


def op11_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed to 150 % of their words, sources weighing 5, 2, 1 in turn, none above twice its words."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source", "text")
    plan = mix_plan(docs, (5, 2, 1), (3, 2), 2)
    return plan.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("times")).alias("taken"))


# The targets by a closed form: sources by words per weight, each capped while its share of what is left is above its cap.
ORACLE = r"""
WITH d AS (SELECT doc_id, source, text, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size FROM documents),
k AS (SELECT doc_id, source, size, md5(concat_ws('|', 'mix', coalesce(CAST(doc_id AS VARCHAR), '-'),
    CASE WHEN source IS NULL THEN '-' ELSE md5(source) END, CASE WHEN text IS NULL THEN '-' ELSE md5(text) END)) AS key FROM d),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
r AS (SELECT *, [5, 2, 1][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS INTEGER) + 1] AS weight FROM s),
t AS (SELECT *, 3 * sum(source_size) OVER () - 4 * (sum(source_size) OVER o - source_size) AS l,
    sum(weight) OVER () - (sum(weight) OVER o - weight) AS w FROM r
  WINDOW o AS (ORDER BY CAST(source_size AS DOUBLE) / weight, source NULLS LAST ROWS UNBOUNDED PRECEDING)),
m AS (SELECT *, 4 * source_size * w < weight * l AS capped FROM t),
e AS (SELECT max(l) AS l, max_by(w, l) AS w FROM m WHERE NOT capped),
g AS (SELECT source, source_size, CASE WHEN capped THEN CAST(2 * source_size AS DOUBLE)
    ELSE CAST(weight * e.l AS DOUBLE) / CAST(2 * e.w AS DOUBLE) END AS target FROM m LEFT JOIN e ON true),
h AS (SELECT k.doc_id, k.size, g.source_size, g.target, CASE WHEN g.source_size > 0 THEN g.target / g.source_size ELSE 0 END AS rate,
    CAST(CAST('0x' || substr(k.key, 1, 13) AS BIGINT) AS DOUBLE) / 4503599627370496 AS coin,
    count(*) OVER (PARTITION BY k.key) AS m, row_number() OVER (PARTITION BY k.key) AS i
  FROM k JOIN g ON k.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target, CAST(size * (floor(rate)
    + CASE WHEN i <= floor(m * (rate - floor(rate)) + coin) THEN 1 ELSE 0 END) AS BIGINT) AS taken FROM h
"""

QUERIES = {"op11_source_mix": op11_source_mix}
ORACLES = {"op11_source_mix": ORACLE}
