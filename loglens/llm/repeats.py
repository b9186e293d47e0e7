"""Periodic runs of words: passages that repeat a unit of words at least four times on end.

A run of period q is a stretch of words of one text in which words q apart are
equal, q is the smallest such number, the stretch has at least ``max(LEAST, 4
q)`` words and can't be made longer. All runs of a text are found by block
convolution:

* At each dyadic scale B the words are cut into blocks of B words. A run with
  a period in [B, 2 B) is at least 4 B long, so it holds a whole block, and
  this block stands again q words later, still in the run.
* For a block and the window of 2 B words behind it, the sums of squared
  differences of word numbers at all distances d of [B, 2 B) are two sums of
  squares and one correlation, which an integer number-theoretic transform
  (modulo 998244353) gives exactly. Distances where the sum is 0 are occurrences
  of the block. A sum that is only 0 modulo the prime is thrown out by the next step.
* Every (block, distance) is a seed: equal words at that distance are followed
  to both sides, word by word in numpy, which yields the maximal stretch.

Two exact tests spare most transforms. Every word of a block that returns
within the window has its own next occurrence there, so the largest such gap of
the block must be below 2 B; in plain text hardly a block passes. And a block
that lies with its window in a run of a smaller period is left out, because two
runs that share that many words would have one period (Fine and Wilf), which
also tells repeated units ("a b a b") from smallest ones.

The work of a text of n words is O(n log^2 n) at worst, in one task with memory
in proportion to its longest text; slices of ``SLICE_BYTES`` of short texts are
worked on together. Nothing is shuffled.

Defined results: a null or empty text has no words and no runs and collapses
to an empty text; a text of any length is handled whole; repeated rows give
their result each; a null doc_id is kept. Extra columns are ignored. Empty in, empty out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loglens.llm import text as T

LEAST = 6
# Words of a slice's text that are transformed at a time.
CHUNK = 1 << 18

PRIME = 998244353        # 119 * 2**23 + 1, with 3 as a generator
_P = np.uint64(PRIME)
_roots: dict[tuple[int, bool], np.ndarray] = {}


def _mod(x: np.ndarray) -> np.ndarray:
    return x - x // _P * _P


def _powers(size: int, inverse: bool) -> np.ndarray:
    """The first ``size / 2`` powers of a root of unity of order ``size``."""
    have = _roots.get((size, inverse))
    if have is None:
        root = pow(3, (PRIME - 1) // size, PRIME)
        root = pow(root, -1, PRIME) if inverse else root
        have = np.ones(1, dtype=np.uint64)
        while len(have) < size // 2:
            have = np.concatenate([have, _mod(have * np.uint64(pow(root, len(have), PRIME)))])
        if size <= 1 << 16:
            _roots[size, inverse] = have
    return have


def _transform(a: np.ndarray, inverse: bool = False) -> np.ndarray:
    """The transform of every column of ``a`` (a power of two of rows), in place. Forward leaves the rows in
    bit-reversed order and inverse takes them so, up to the factor ``len(a)``."""
    size, many = a.shape
    half = 1 if inverse else size // 2
    while 1 <= half < size:
        w = np.repeat(_powers(2 * half, inverse), many)
        pair = a.reshape(size // (2 * half), 2, half * many)
        if inverse:
            v = _mod(pair[:, 1] * w)
            u = pair[:, 0].copy()
            pair[:, 0] = _mod(u + v)
            pair[:, 1] = _mod(u + _P - v)
        else:
            u, v = pair[:, 0].copy(), pair[:, 1].copy()
            pair[:, 0] = _mod(u + v)
            pair[:, 1] = _mod(_mod(u + _P - v) * w)
        half = half * 2 if inverse else half // 2
    return a


def block_matches(x: np.ndarray, at: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(block start, distance) of all distances in [size, 2 size) at which the block of ``size`` numbers at
    each of ``at`` stands again, by sums of squared differences modulo ``PRIME``. ``x`` reaches 3 ``size`` beyond every block."""
    starts, gaps = [], []
    step = max(1, CHUNK // (2 * size))
    for i in range(0, len(at), step):
        p = at[i:i + step]
        block = np.zeros((2 * size, len(p)), dtype=np.uint64)
        block[:size] = x[p + np.arange(size - 1, -1, -1)[:, None]]
        window = x[p + size + np.arange(2 * size)[:, None]]
        squares = np.zeros((2 * size + 1, len(p)), dtype=np.uint64)
        np.cumsum(_mod(window * window), axis=0, out=squares[1:])
        own = _mod(block * block).sum(axis=0)
        product = _mod(_transform(block) * _transform(window))
        product = _mod(_transform(product, inverse=True) * np.uint64(pow(2 * size, -1, PRIME)))
        corr = product[size - 1:2 * size - 1]
        total = _mod(own) + _mod(squares[size:2 * size] - squares[:size]) + np.uint64(2) * (_P - corr)
        d, k = np.nonzero(_mod(total) == 0)
        starts.append(p[k])
        gaps.append(d + size)
    return (np.concatenate(starts), np.concatenate(gaps)) if starts else (at[:0], at[:0])


def _agree(x: np.ndarray, a: int, b: int, most: int, back: bool = False) -> int:
    """How many words from ``a`` and ``b`` on (back: before them) are equal, ``most`` at most."""
    done, step = 0, 64
    while done < most:
        n = min(step, most - done)
        same = x[a - done - n:a - done] == x[b - done - n:b - done] if back else x[a + done:a + done + n] == x[b + done:b + done + n]
        if not same.all():
            return done + int(np.argmin(same[::-1] if back else same))
        done, step = done + n, min(step * 4, 1 << 20)
    return done


def find_runs(words: np.ndarray, first: np.ndarray, least: int = LEAST) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, period) of all runs of several texts, by start and period. ``words`` are hashes of
    all words in order, ``first`` the index of each text's first word and, at the end, the number of words."""
    n, lengths = len(words), np.diff(first)
    found: list[tuple[int, int, int]] = []
    longest = int(lengths.max()) if len(lengths) else 0
    if longest < least:
        return _sorted(found)
    order = np.argsort(words, kind="stable")
    new = np.ones(n, dtype=bool)
    new[1:] = words[order][1:] != words[order][:-1]
    top = 1 << max(0, (longest // 4).bit_length() - 1)
    x = np.zeros(n + 3 * top, dtype=np.uint64)
    x[order] = np.cumsum(new).astype(np.uint64)
    end_of = np.repeat(first[1:], lengths)
    begin_of = np.repeat(first[:-1], lengths)
    never = np.iinfo(np.int64).max
    worst = np.full(n, never)          # the largest gap to a next occurrence in each block
    again = ~new[1:] & (begin_of[order[1:]] == begin_of[order[:-1]])
    worst[order[:-1][again]] = (order[1:] - order[:-1])[again]
    reach = np.zeros(n, dtype=np.int64)  # where the runs found so far that begin here or before end
    size = 1
    while 4 * size <= longest:
        at = np.flatnonzero(worst < 2 * size) * size
        at = at[(at + 2 * size <= end_of[at]) & (reach[at] < at + 3 * size)]
        if len(at):
            p, d = block_matches(x, at, size)
            inside = p + d + size <= end_of[p]
            new_runs = _extended(x, p[inside], d[inside], size, begin_of, end_of, reach, least)
            if new_runs:
                found += new_runs
                runs = np.array(new_runs)
                np.maximum.at(reach, runs[:, 0], runs[:, 1])
                np.maximum.accumulate(reach, out=reach)
        pairs = len(worst) // 2
        worst = np.maximum(worst[0:2 * pairs:2], worst[1:2 * pairs:2])
        size *= 2
    return _sorted(found)


def _sorted(found: list[tuple[int, int, int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    runs = np.array(sorted((s, q, e) for s, e, q in found), dtype=np.int64).reshape(-1, 3)
    return runs[:, 0], runs[:, 2], runs[:, 1]


def _extended(x: np.ndarray, starts: np.ndarray, gaps: np.ndarray, size: int, begin_of: np.ndarray, end_of: np.ndarray,
              reach: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """The runs that the seeds of one scale lie in."""
    order = np.lexsort((starts, gaps))
    found, last, until = [], -1, -1
    for p, q in zip(starts[order].tolist(), gaps[order].tolist(), strict=True):
        if q == last and p + size <= until:
            continue                    # of a stretch that has been followed already
        ahead = _agree(x, p, p + q, int(end_of[p]) - p - q)
        if ahead < size:
            continue                    # 0 only modulo the prime
        start = p - _agree(x, p, p + q, p - int(begin_of[p]), back=True)
        last, until = q, p + ahead
        end = until + q
        if end - start >= max(least, 4 * q) and reach[start] < end:
            found.append((start, end, q))
    return found


RUN_TYPE = "array<struct<start:long,length:long,period:long>>"


def periodic_runs(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, ``runs`` (by start, then period) and ``collapsed``, the
    text's words joined by one space without those that any run holds behind its first period."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, buf, offsets in T.slices(batch.column(1)):
                starts, ends, first = T.word_spans(buf, offsets)
                words = T.span_hash(T.prefix_hash(buf), starts, ends) if len(starts) else np.zeros(0, np.uint64)
                start, end, period = find_runs(words, first, least)
                of = np.searchsorted(first, start, "right") - 1
                cover = np.zeros(len(words) + 1, dtype=np.int64)
                np.add.at(cover, start + period, 1)
                np.add.at(cover, end, -1)
                gone = np.cumsum(cover) > 0
                raw, has = buf.tobytes(), np.zeros(b - a, dtype=bool)
                has[of] = True
                texts = []
                for i in range(b - a):
                    units = raw[offsets[i]:offsets[i + 1]].split()  # the words again: at these bytes it splits
                    if has[i]:
                        units = [w for w, out in zip(units, gone[first[i]:first[i + 1]].tolist(), strict=True) if not out]
                    texts.append(b" ".join(units))
                fields = pa.StructArray.from_arrays([pa.array(v) for v in (start - first[of], end - start, period)], names=["start", "length", "period"])
                bounds = np.concatenate([[0], np.cumsum(np.bincount(of, minlength=b - a))]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.ListArray.from_arrays(pa.array(bounds), fields),
                     pa.array(texts, pa.binary()).cast(pa.string())], names=["doc_id", "runs", "collapsed"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, runs {RUN_TYPE}, collapsed string")


def tiled(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text), one text in ten made periodic from some word on, as the query's contract plants it."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10).cast("long")
    words = F.regexp_extract_all("text", F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(0))
    n = F.size("_w").cast("long")
    a = g % n
    p = F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8)).cast("long")
    held = docs.select("doc_id", "text", F.when(h % 10 == 0, words).alias("_w"))
    unit = F.slice("_w", F.col("_a").cast("int") + 1, F.col("_p").cast("int"))
    head = F.slice("_w", F.lit(1), F.col("_a").cast("int"))
    rest = F.col("_n") - F.col("_a")
    full = F.flatten(F.array_repeat(unit, F.ceil(rest / F.col("_p")).cast("int")))
    text = F.array_join(F.concat(head, F.slice(full, F.lit(1), rest.cast("int"))), " ")
    sized = held.select("doc_id", "text", "_w", F.when(F.size("_w") > 0, n).alias("_n"), F.when(F.size("_w") > 0, a).alias("_a"), F.when(F.size("_w") > 0, p).alias("_p"))
    return sized.select("doc_id", F.when(F.col("_n") > 0, text).otherwise(F.col("text")).alias("text"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The runs of all documents, the planted ones among them: their number, the longest one, and digests of all runs and of the collapsed text."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    rows = periodic_runs(tiled(docs))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    best = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("l"), r["start"].alias("s"), r["period"].alias("p"))))
    digest = lambda c: F.sha2(c.cast("binary"), 256)
    listed = F.when(F.size("runs") > 0, F.concat(F.array_join(lines, "\n"), F.lit("\n"))).otherwise("")
    return rows.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("_b"),
                       digest(listed).alias("runs_sha256"), digest(F.col("collapsed")).alias("collapsed_sha256")).select(
        "doc_id", "n_runs", F.col("_b.s").alias("start"), (-F.col("_b.l")).alias("length"), F.col("_b.p").alias("period"),
        F.floor(F.col("_b.l") * -1000 / F.col("_b.p")).cast("long").alias("exponent_milli"), "runs_sha256", "collapsed_sha256")


QUERIES = {"op12_periodic_runs": op12_periodic_runs}
ORACLES: dict[str, str] = {}
