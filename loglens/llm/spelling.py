"""Spelling variants: rare words that are one edit away from a much more frequent word.

Words one edit (an inserted, deleted or replaced letter) apart are found by
asymmetric q-chunks. Of two words the shorter one (of equal ones the smaller)
contributes two disjoint chunks, its first and its last half; the other one
contributes its positional grams of that length. One edit touches at most one of
the two chunks, so the other one is a gram of the second word, at its own place or
shifted by the one letter that the second word is longer: the first half is not
shifted, the last half by the difference of the lengths. Grams at other places can't
join and are not written. Behind the kept half, what remains of the two words is
again one edit apart, so the lemma holds there once more: the remainder's own two
chunks refine the key to about three quarters of the word, which few words share.
Candidates are verified by the edit distance.

A key that very many words share all the same (counted: ``HOT`` candidate pairs
or more) would pair all of them. Such words join on the key and a form of the word with
at most one letter deleted; words one edit apart have such a form in common, and a
form belongs to a bounded number of words (an alphabet's worth for each place),
however many share the key.

The words and their counts come from one pass over the texts (partial counts per
slice, then a grouping by word); all later tables have at most a few rows per
distinct word, not per occurrence. The link of a word to its form at least
multiplies the count by ``ratio``, so the chains to the root are short and
resolved by pointer doubling.

Defined results: null and empty texts have no words; a row without doc_id
takes part (its words are not altered by the query's planted misspellings);
repeated rows count again; ties between forms go to the smallest word in code-point
order; a word without near words has no form and is its own root. Extra columns are
ignored. Empty in, empty out.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loglens.llm import text as T
from loglens.llm.store import stored

LEAST_LENGTH = 7
LEAST_COUNT = 2
RATIO = 10
# Candidate pairs of one key from which on its words join by deletion forms.
HOT = 4096
# A table of hot keys of up to so many rows is broadcast.
BROADCAST_KEYS = 50_000
# Distinct words whose counts a task holds at a time.
HELD = 100_000

LETTERS = re.compile("[A-Za-zÀ-ÿ]+")
_LOWER = {c: c + 32 for c in range(65, 91)}


def misspelled(doc_id: object, word: str) -> str:
    """The query's planted misspellings: by a hash of document and word, one word in 31 loses a letter."""
    h = zlib.crc32(f"{doc_id}:{word}".encode())
    if h % 31:
        return word
    at = h % len(word)
    return word[:at] + word[at + 1:]


def word_counts(docs: DataFrame, least_length: int = LEAST_LENGTH, alter: Callable[[object, str], str] | None = None) -> DataFrame:
    """(word, n): occurrences of all runs of letters of at least ``least_length``, A-Z lower-cased, over all
    texts of ``docs`` (doc_id, text). ``alter(doc_id, word)`` may shorten a word before it is counted; rows without doc_id are not altered."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[str] = Counter()
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for a, b, buf, offsets in T.slices(batch.column(1)):
                raw = buf.tobytes()
                for i in range(b - a):
                    of = Counter(w for w in LETTERS.findall(raw[offsets[i]:offsets[i + 1]].decode().translate(_LOWER)) if len(w) >= least_length)
                    if alter is None or ids[a + i] is None:
                        total.update(of)
                        continue
                    for w, n in of.items():
                        w = alter(ids[a + i], w)
                        if len(w) >= least_length:
                            total[w] += n
                if len(total) > HELD:
                    yield _counted(total)
                    total.clear()
        yield _counted(total)

    return (docs.select("doc_id", "text").mapInArrow(run, "word string, n long")
            .groupBy("word").agg(F.sum("n").alias("n")))


def _counted(total: Counter[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], names=["word", "n"])


def _chunk_keys(length: Column) -> Column:
    """The four keys of ``word`` as the partner of a chunk word of ``length`` letters: a kept half with a chunk of what remains."""
    word = F.col("word")
    half = F.floor(length / 2).cast("int")
    sub = F.floor((length - half) / 2).cast("int")
    ahead, behind = F.substr(word, half + 1, F.length(word)), F.substr(word, F.lit(1), F.length(word) - half)
    kept = {"first": (F.left(word, half), ahead), "last": (F.right(word, half), behind)}
    return F.array(*[F.xxhash64(length, F.lit(f"{name} {side.__name__}"), chunk, side(rest, sub))
                     for name, (chunk, rest) in kept.items() for side in (F.left, F.right)])


def chunk_keys(words: DataFrame) -> DataFrame:
    """(key, word, chunk): the keys of every word as a chunk word (``chunk``; these are also its grams for chunk words of its length)
    and its grams for chunk words that are one letter shorter. Keys are hashes; a collision only adds a candidate."""
    n = F.length("word")
    own = F.transform(_chunk_keys(n), lambda k: F.struct(k.alias("key"), F.lit(True).alias("chunk")))
    shorter = F.transform(_chunk_keys(n - 1), lambda k: F.struct(k.alias("key"), F.lit(False).alias("chunk")))
    return words.select("word", F.explode(F.concat(own, shorter)).alias("k")).select("k.key", "word", "k.chunk")


def _forms(word: Column) -> Column:
    """Hashes of a word and of all that is left of it when one letter is deleted."""
    n = F.length(word)
    shorter = F.transform(F.sequence(F.lit(1), n), lambda i: F.concat(F.substr(word, F.lit(1), i - 1), F.substr(word, i + 1, n)))
    return F.array_distinct(F.transform(F.concat(F.array(word), shorter), lambda w: F.xxhash64(w)))


def _joined(keys: DataFrame, on: list[str]) -> DataFrame:
    """Candidates (u, v): a chunk word and another word with the same key."""
    return (keys.where("chunk").select(*on, F.col("word").alias("u")).join(keys.select(*on, F.col("word").alias("v"), "chunk"), on)
            .where("not chunk or u < v").select("u", "v"))


def near_pairs(words: DataFrame, hot: int | None = None) -> DataFrame:
    """(u, v): the pairs of words one edit apart, each once. ``words`` has distinct ``word`` values of four letters or more."""
    hot = HOT if hot is None else hot
    keys = stored(chunk_keys(words.select("word")), "spelling-keys")
    heat = stored(keys.groupBy("key").agg(F.count_if("chunk").alias("a"), F.count(F.lit(1)).alias("b"))
                  .where(F.col("a") * F.col("b") >= hot).select("key"), "spelling-hot")
    n = heat.count()
    if n == 0:
        found = _joined(keys, ["key"])
    else:
        heat = F.broadcast(heat) if n <= BROADCAST_KEYS else heat
        formed = keys.join(heat, "key").withColumn("form", F.explode(_forms(F.col("word"))))
        found = _joined(keys.join(heat, "key", "left_anti"), ["key"]).unionByName(_joined(formed, ["key", "form"]))
    return found.where(F.levenshtein("u", "v", 1) == 1).distinct()


def variants(words: DataFrame, ratio: int = RATIO, hot: int | None = None) -> DataFrame:
    """``words`` (word, n; distinct words) with ``n_near`` (words one edit apart), ``form`` (the most frequent of them, if ``ratio``
    times as frequent or more; else null), ``form_n`` and ``root`` (the last form of the chain)."""
    words = words.select("word", "n")
    pairs = stored(near_pairs(words, hot), "spelling-pairs")
    both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
    best = (both.join(words.select(F.col("word").alias("v"), "n"), "v").groupBy("u")
            .agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("n")).alias("minus"), F.col("v"))).alias("best")))
    rows = words.join(best, words["word"] == best["u"], "left")
    is_form = -F.col("best.minus") >= F.col("n") * ratio
    rows = stored(rows.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                              F.when(is_form, F.col("best.v")).alias("form"), F.when(is_form, -F.col("best.minus")).alias("form_n")), "spelling-forms")
    up = rows.where("form is not null").select("word", F.col("form").alias("root"))
    while True:
        up = stored(up, "spelling-roots")
        step = up.select(F.col("word").alias("root"), F.col("root").alias("further"))
        if up.join(step, "root", "left_semi").isEmpty():
            break
        up = up.join(step, "root", "left").select("word", F.coalesce("further", "root").alias("root"))
    return rows.join(up, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The spelling variants among all words of all documents, the planted misspellings among them."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    words = stored(word_counts(docs, LEAST_LENGTH, misspelled).where(F.col("n") >= LEAST_COUNT), "spelling-words")
    return variants(words, RATIO)


QUERIES = {"op13_spelling_variants": op13_spelling_variants}
ORACLES: dict[str, str] = {}
