"""N-gram Jaccard self-join with adaptive multi-match prefixes.

A document is the set of its n-word shingles (64-bit hashes). All sets order
their shingles alike, rarest first. If two sets reach the similarity, their
prefixes of length ``size - least overlap + k`` share at least k shingles, for
every k. Each document picks its own k: the one whose prefix has the least
estimated cost (postings met, plus verifications, of which there are at most
the postings over k); a pair must share as many prefix shingles as the
smaller k of the two, and is then verified on the whole sets.

How it is spread:

* Frequencies for the order and the cost come from a count sketch of fixed
  size (``SKETCH_BITS``) over all documents. The result does not depend on
  it; only the amount of work does. Its log-quantised form is the only thing
  broadcast: 2**SKETCH_BITS bytes at every corpus size.
* Equal sets are one node from the start, so copies cost nothing.
* Nodes that share a prefix shingle with another are put into small blocks of
  like nodes (same most frequent shared shingle, similar size, about
  ``BLOCK_SHINGLES`` shingles and at most ``MOST_BLOCK`` nodes). Only pairs of blocks with a common prefix shingle and
  compatible sizes meet; a group of many near copies becomes many block pairs,
  dealt to all tasks, which compare tiles of ``TILE`` nodes, ``TILE_CELLS`` cells of them at a time. A block pair returns link counts and a spanning forest
  per node, never its pairs.

Defined results: null and empty texts have the empty set, linked with nothing;
a text of fewer words is one shingle; rows with one doc_id are one node of the
graph, whatever their texts, and each of their texts keeps its links; a row without doc_id has no node of its own (its component is that of
its copies, or null). Other columns are ignored. Empty in, empty out.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loglens.llm import text as T
from loglens.llm.components import connected_components
from loglens.llm.joins import salted_join
from loglens.llm.store import dropped, stored

SKETCH_BITS = 22
SLICE_BITS = 16
STEPS = 8                # quantisation: steps per doubling of a frequency
MOST_MATCHES = 8
VERIFY_COST = 16.0       # of one verification, in postings
TILE = 256               # nodes compared at a time within a pair of blocks
MOST_BLOCK = 256         # nodes of a block
BLOCK_SHINGLES = 1 << 20  # shingles of a block's sets, about
TILE_CELLS = 1 << 20     # cells of a tile's table of nodes and shingles, at a time
FLUSH = 1 << 19          # shingles that a task of the sketch holds
HOT_KEYS = 100_000       # sets with many copies that are broadcast, at most
HOT_COPIES = 1000


def _sets(column: pa.Array, n: int) -> Iterator[np.ndarray]:
    """The shingle set of every text of a column: sorted distinct hashes."""
    for a, b, buf, offsets in T.slices(column):
        words, first = T.word_hashes(buf, offsets)
        for i in range(b - a):
            yield np.unique(T.shingle_hashes(words[first[i]:first[i + 1]], n))


def frequency_sketch(docs: DataFrame, n: int, bits: int = SKETCH_BITS) -> np.ndarray:
    """For every bucket of shingle hashes a byte: the log of how many documents' shingles fall into it."""
    shift, part = np.uint64(64 - bits), 1 << min(SLICE_BITS, bits)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << bits, dtype=np.uint32)
        for batch in batches:
            held, size = [], 0
            for s in _sets(batch.column(0), n):
                held.append((s >> shift).astype(np.uint32))
                size += len(s)
                if size > FLUSH:
                    where, times = np.unique(np.concatenate(held), return_counts=True)
                    counts[where] += times.astype(np.uint32)
                    held, size = [], 0
            if size:
                where, times = np.unique(np.concatenate(held), return_counts=True)
                counts[where] += times.astype(np.uint32)
        parts = [i for i in range(len(counts) // part) if counts[i * part:(i + 1) * part].any()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(parts, pa.int32()), pa.array([zlib.compress(counts[i * part:(i + 1) * part].tobytes(), 1) for i in parts], pa.binary())],
            names=["part", "counts"])

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, blob in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                one = np.frombuffer(zlib.decompress(blob.as_buffer()), np.uint32)
                sums[i] = sums[i] + one if i in sums else one.astype(np.uint64)
        levels = [np.minimum(np.round(STEPS * np.log2(np.maximum(v, 1))), 255).astype(np.uint8).tobytes() for v in sums.values()]
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array(levels, pa.binary())], names=["part", "levels"])

    parts = (1 << bits) // part
    summed = (docs.select("text").mapInArrow(count, "part int, counts binary")
              .repartition(min(parts, 64), "part").mapInArrow(total, "part int, levels binary"))
    out = np.zeros(1 << bits, dtype=np.uint8)
    for row in summed.toLocalIterator():
        out[row["part"] * part:(row["part"] + 1) * part] = np.frombuffer(row["levels"], np.uint8)
    return out


def choose_prefix(shingles: np.ndarray, level: np.ndarray, noise: float, num: int, den: int) -> tuple[int, np.ndarray]:
    """(k, prefix) of one set: its shingles rarest first, cut where the k of least estimated cost ends."""
    size = len(shingles)
    spare = size - -(-size * num // den)
    most = min(MOST_MATCHES, size - spare)
    length = spare + most
    if length < size:
        near = np.argpartition(level, length - 1)
        near = np.flatnonzero(level <= level[near[length - 1]])
    else:
        near = np.arange(size)
    order = near[np.lexsort((shingles[near], level[near]))][:length]
    others = np.maximum(np.exp2(level[order] / STEPS) - noise - 1, 0)
    met = np.cumsum(others)[spare:]
    k = int(np.argmin(met + VERIFY_COST * met / np.arange(1, most + 1))) + 1
    return k, shingles[order[:spare + k]]


def signatures(docs: DataFrame, sketch: np.ndarray, n: int, num: int, den: int) -> DataFrame:
    """Per document: doc_id, n_shingles, digest of the set, k (``matches``) and ``prefix``."""
    shared = docs.sparkSession.sparkContext.broadcast(sketch.tobytes())
    shift = np.uint64(64 - (len(sketch).bit_length() - 1))
    kind = docs.schema["doc_id"].dataType.simpleString()
    noise = float(np.exp2(sketch.astype(np.float64) / STEPS)[sketch > 0].mean()) - 1 if (sketch > 0).mean() > 0.5 else 0.0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        levels = np.frombuffer(shared.value, np.uint8)
        for batch in batches:
            sizes, digests, matches, prefixes = [], [], [], []
            for s in _sets(batch.column(1), n):
                k, prefix = choose_prefix(s, levels[(s >> shift).astype(np.int64)], noise, num, den) if len(s) else (0, s)
                sizes.append(len(s))
                digests.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
                matches.append(k)
                prefixes.append(prefix.tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.array(matches, pa.int32()), pa.array(prefixes, pa.binary())],
                names=["doc_id", "n_shingles", "digest", "matches", "prefix"])

    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, n_shingles long, digest binary, matches int, prefix binary")


def _postings(nodes: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            blobs = [np.frombuffer(b.as_buffer(), np.int64) for b in batch.column(1)]
            of = np.repeat(np.arange(len(blobs)), [len(b) for b in blobs])
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(of)), pa.array(np.concatenate(blobs) if blobs else [], pa.int64())],
                                             names=["node", "token"])

    return nodes.select("node", "prefix").mapInArrow(run, "node long, token long")


def make_blocks(nodes: DataFrame, num: int, den: int) -> DataFrame:
    """Nodes that share a prefix shingle with another: their shared shingles, block and size class."""
    postings = _postings(nodes)
    often = postings.groupBy("token").agg(F.count(F.lit(1)).alias("f")).where("f > 1")
    homes = (postings.join(often, "token").groupBy("node")
             .agg(F.max(F.struct("f", "token")).alias("home"), F.array_sort(F.collect_list("token")).alias("tokens")))
    grade = F.floor(F.log(F.col("n_shingles")) / float(np.log(den / num))).cast("int")
    room = F.least(F.lit(MOST_BLOCK), F.greatest(F.lit(TILE // 4), F.floor(BLOCK_SHINGLES / F.pow(F.lit(den / num), F.col("grade")))))
    chunk = F.pmod(F.xxhash64("node"), F.greatest(F.lit(1), F.ceil(F.col("home.f") / room).cast("long")))
    return (homes.join(nodes.select("node", "n_shingles", "copies", "matches", "digest"), "node")
            .withColumn("grade", grade)
            .select("node", "n_shingles", "copies", "matches", "digest", "tokens", "grade",
                    F.xxhash64("home.token", "grade", chunk).alias("block")))


def block_pairs(blocks: DataFrame) -> DataFrame:
    """Pairs of blocks (a <= b) that have a prefix shingle in common and sizes that allow a link."""
    lists = blocks.select("block", "grade", F.explode("tokens").alias("token")).groupBy("token", "block", "grade").agg(F.count(F.lit(1)).alias("m"))
    a = lists.select("token", F.col("block").alias("a"), F.col("grade").alias("ga"), "m")
    b = lists.select("token", F.col("block").alias("b"), F.col("grade").alias("gb"))
    # Sizes within num/den of each other are in the same or adjacent grades.
    return a.join(b, "token").where("abs(ga - gb) <= 1 and (a < b or a = b and m > 1)").select("a", "b").distinct()


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, list]]:
    """(a, b, records) of rows sorted by a and b, whole runs across batches."""
    key, held = None, []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if row[:2] != key:
                if held:
                    yield *key, held
                key, held = row[:2], []
            held.append(row[2:])
    if held:
        yield *key, held


def _tile_candidates(left: list, right: list, num: int, den: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of records of two tiles that share enough prefix shingles and have compatible sizes."""
    tokens = [np.frombuffer(r[4], np.int64) for r in (*left, *right)]
    distinct, local = np.unique(np.concatenate(tokens), return_inverse=True)
    node = np.repeat(np.arange(len(tokens)), [len(t) for t in tokens])
    # Only shingles of both sides count; the table of nodes by shingles is made a range of them at a time.
    of_left = node < len(left)
    both = np.zeros(len(distinct), dtype=bool)
    both[local[of_left]] = True
    both &= np.bincount(local[~of_left], minlength=len(distinct)) > 0
    used = np.flatnonzero(both[local])
    used = used[np.argsort(local[used])]
    node, local = node[used], (np.cumsum(both) - 1)[local[used]]
    shared = np.zeros((len(left), len(right)), dtype=np.float32)
    width = max(1, TILE_CELLS // len(tokens))
    for a in range(0, int(both.sum()), width):
        lo, hi = np.searchsorted(local, [a, a + width])
        has = np.zeros((len(tokens), width), dtype=np.float32)
        has[node[lo:hi], local[lo:hi] - a] = 1
        shared += has[:len(left)] @ has[len(left):].T
    size, least = (np.array([r[c] for r in (*left, *right)]) for c in (2, 3))
    (na, nb), (ka, kb) = ((v[:len(left), None], v[None, len(left):]) for v in (size, least))
    ok = shared >= np.minimum(ka, kb)
    return np.nonzero(ok & (den * np.minimum(na, nb) >= num * np.maximum(na, nb)))


def candidates(records: list, a: int, b: int, num: int, den: int) -> Iterator[tuple[int, int]]:
    """Index pairs of the records of two blocks (or one) that may be linked, tile by tile.

    A record begins with block, node, n_shingles, matches, tokens."""
    at = {x: [i for i, r in enumerate(records) if r[0] == x] for x in {a, b}}
    left, right = ([at[x][i:i + TILE] for i in range(0, len(at[x]), TILE)] for x in (a, b))
    right = left if a == b else right
    for m, one in enumerate(left):
        for other in (right[m:] if a == b else right):
            i, j = _tile_candidates([records[x] for x in one], [records[x] for x in other], num, den)
            for x, y in zip(i.tolist(), j.tolist(), strict=True):
                if one is not other or x < y:
                    yield one[x], other[y]


def _dealt(pairs: DataFrame, records: DataFrame) -> DataFrame:
    """``records`` (block first) of both blocks of every pair, all rows of a pair together."""
    sides = pairs.select("a", "b", F.explode(F.array_distinct(F.array("a", "b"))).alias("block"))
    met = sides.join(records, "block").select("a", "b", *records.columns)
    width = int(records.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return met.repartition(width, "a", "b").sortWithinPartitions("a", "b", "node")


def _packed_texts(docs: DataFrame) -> DataFrame:
    """doc_id and compressed text: a third of the text, a quarter of the set's hashes."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            for a, b, buf, offsets in T.slices(batch.column(1)):
                raw = buf.tobytes()
                packed = [squeeze(raw[x:y]) for x, y in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(packed, pa.binary())], names=["doc_id", "packed"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, packed binary")


def _set_of(packed: bytes, n: int) -> np.ndarray:
    raw = np.frombuffer(zstandard.decompress(packed), np.uint8)
    return np.unique(T.shingle_hashes(T.word_hashes(raw, np.array([0, len(raw)]))[0], n))


def _hopeful(dealt: DataFrame, num: int, den: int) -> DataFrame:
    """(a, b, node) of the nodes that have a candidate in their block pair."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple[int, int, int]] = []
        for a, b, records in _runs(batches):
            if len(records) > 1:
                hopeful = {x for pair in candidates(records, a, b, num, den) for x in pair}
                out += [(a, b, node) for node in sorted({records[x][1] for x in hopeful})]
            if len(out) > 10_000:
                yield _longs(out, ("a", "b", "node"))
                out = []
        yield _longs(out, ("a", "b", "node"))

    return dealt.mapInArrow(run, "a long, b long, node long")


def _longs(rows: list, names: tuple[str, ...]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[] for _ in names]
    return pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in columns], names=list(names))


def _verified(dealt: DataFrame, n: int, num: int, den: int) -> DataFrame:
    """(node, digest, root, links) per block pair: a spanning forest of its links, and how many documents each set links to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for a, b, records in _runs(batches):
            # A row of the node comes with every text of its doc_id; repeated rows bring one text again.
            by_set = {}
            for r in records:
                if (r[1], r[6]) not in by_set:
                    s = _set_of(r[7], n)
                    if hashlib.blake2b(s.tobytes(), digest_size=16).digest() == r[6]:
                        by_set[r[1], r[6]] = (r, s)
            if len(by_set) < 2:
                continue
            records, sets = (list(x) for x in zip(*by_set.values(), strict=True))
            links, root = [0] * len(records), list(range(len(records)))

            def find(x: int, root: list[int] = root) -> int:
                while root[x] != x:
                    root[x] = root[root[x]]
                    x = root[x]
                return x

            for i, j in candidates(records, a, b, num, den):
                both = len(sets[i]) + len(sets[j])
                common = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                if den * common >= num * (both - common):
                    links[i] += records[j][5]
                    links[j] += records[i][5]
                    root[find(i)] = find(j)
            out += [(r[1], r[6], records[find(i)][1], links[i]) for i, r in enumerate(records) if links[i]]
            if len(out) > 10_000:
                yield _links(out)
                out = []
        yield _links(out)

    return dealt.mapInArrow(run, "node long, digest binary, root long, links long")


def _links(rows: list) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[], [], [], []]
    return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, (pa.int64(), pa.binary(), pa.int64(), pa.int64()), strict=True)],
                                      names=["node", "digest", "root", "links"])


def jaccard_groups(docs: DataFrame, n: int = 5, num: int = 4, den: int = 5, sketch_bits: int = SKETCH_BITS) -> DataFrame:
    """Link documents whose shingle sets have ``den * intersection >= num * union``.

    Returns doc_id, n_shingles, class_id (smallest doc_id with the same set), n_links (documents linked to this
    row) and component_id (smallest doc_id reachable), one row per row of ``docs`` (integer doc_id, text)."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    signed = stored(signatures(docs, frequency_sketch(docs, n, sketch_bits), n, num, den), "jaccard-signed")
    nodes = stored(signed.where("digest is not null").groupBy("digest").agg(
        F.min("doc_id").alias("node"), F.count(F.lit(1)).alias("copies"), F.first("n_shingles").alias("n_shingles"),
        F.first("matches").alias("matches"), F.first("prefix").alias("prefix")), "jaccard-nodes")
    # Sets of one doc_id that differ (repeated ids) are told apart by their digest.
    blocks = stored(make_blocks(nodes.where("node is not null"), num, den), "jaccard-blocks")
    small = _packed_tokens(blocks)
    pairs = stored(block_pairs(blocks), "jaccard-pairs")
    hopeful = stored(_hopeful(_dealt(pairs, small), num, den), "jaccard-hopeful")
    wanted = hopeful.select("node").distinct().join(small, "node")
    full = wanted.join(_packed_texts(docs).withColumnRenamed("doc_id", "node"), "node").select(
        "node", "block", "n_shingles", "matches", "tokens", "copies", "digest", "packed")
    width = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    met = (hopeful.join(full, "node").where("block = a or block = b")
           .select("a", "b", "block", "node", "n_shingles", "matches", "tokens", "copies", "digest", "packed")
           .repartition(width, "a", "b").sortWithinPartitions("a", "b", "node"))
    found = stored(_verified(met, n, num, den), "jaccard-links")
    for done in (blocks, pairs, hopeful):
        dropped(done)
    # A doc_id with several texts holds their nodes together.
    h = F.xxhash64("digest")
    several = (signed.where("doc_id is not null and digest is not null").groupBy("doc_id")
               .agg(F.min(h).alias("least"), F.max(h).alias("most")).where("least <> most").select("doc_id"))
    held = (several.join(signed.select("doc_id", "digest").distinct(), "doc_id").join(nodes.select("digest", "node"), "digest")
            .select(F.col("doc_id").alias("src"), F.col("node").alias("dst")))
    component = connected_components(found.select(F.col("node").alias("src"), F.col("root").alias("dst")).unionByName(held))
    links = found.groupBy("digest").agg(F.sum("links").alias("links"))
    classes = (nodes.select("digest", "node", "copies").join(component, "node", "left").join(links, "digest", "left")
               .select("digest", F.col("node").alias("class_id"), F.coalesce("component", "node").alias("component_id"),
                       (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")))
    # At most HOT_KEYS sets can have that many copies.
    many = max(HOT_COPIES, -(-signed.count() // HOT_KEYS))
    hot = nodes.where(F.col("copies") >= many).select("digest")
    return (salted_join(signed.select("doc_id", "n_shingles", "digest"), classes, "digest", ["doc_id"], hot=hot)
            .select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"),
                    F.coalesce("class_id", "doc_id").alias("class_id"), F.coalesce("n_links", F.lit(0)).alias("n_links")))


def one_per_group(docs: DataFrame, n: int = 5, num: int = 4, den: int = 5) -> DataFrame:
    """``docs`` with one row of each component: the one with the smallest doc_id, a null one last.

    Every text counts for itself: rows without doc_id, or whose doc_id other rows have as well, are told apart by a hash
    of doc_id and text, so copies among them go too and an unlike text under a used doc_id stays. Of rows
    alike in doc_id and text one stays (any: they may differ in other columns), of rows without words all."""
    seen = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("c")).where("c > 1 or doc_id is null").select(F.col("doc_id").alias("_id"))
    seen = stored(seen, "jaccard-repeated")
    rows = seen.count()
    if rows == 0:
        groups = jaccard_groups(docs.select("doc_id", "text"), n, num, den)
        return docs.join(groups.where("doc_id = component_id").select("doc_id"), "doc_id", "left_semi").select(*docs.columns)
    seen = seen.withColumn("_again", F.lit(True))
    # Below 0, where such a key does not meet a doc_id of its own.
    other = F.lit(-1) - F.shiftrightunsigned(F.xxhash64("doc_id", F.coalesce("text", F.lit(""))), 1)
    keyed = (docs.join(F.broadcast(seen) if rows <= HOT_KEYS else seen, F.col("doc_id").eqNullSafe(F.col("_id")), "left")
             .withColumn("_key", F.when(F.col("_again"), other).otherwise(F.col("doc_id").cast("long"))).drop("_id"))
    members = stored(jaccard_groups(keyed.select(F.col("_key").alias("doc_id"), "text"), n, num, den)
                     .select(F.col("doc_id").alias("_key"), "component_id", "n_shingles").distinct(), "jaccard-members")
    best = (members.join(keyed.select("_key", "doc_id").distinct(), "_key")
            .groupBy("component_id").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_key")).alias("b")))
    first = best.select("b._key").join(members.select("_key", "n_shingles"), "_key")
    kept = keyed.join(first, "_key")
    once = kept.where("_again and n_shingles > 0").dropDuplicates(["_key"])
    return kept.where("_again is null or n_shingles = 0").unionByName(once).select(*docs.columns)


def _packed_tokens(blocks: DataFrame) -> DataFrame:
    """The blocks' records with ``tokens`` as one binary value."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(4)
            blobs = [lists[i].values.to_numpy().tobytes() for i in range(batch.num_rows)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(blobs, pa.binary()), *batch.columns[5:]], names=batch.schema.names)

    return (blocks.select("block", "node", "n_shingles", "matches", "tokens", "copies", "digest")
            .mapInArrow(run, "block long, node long, n_shingles long, matches int, tokens binary, copies long, digest binary"))


def op1_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose 3-word shingle sets have a Jaccard similarity of 0.9 or more."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return jaccard_groups(docs, 3, 9, 10)


ORACLE = """
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS words FROM documents),
sets AS (SELECT doc_id, list_distinct(CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 3 THEN [array_to_string(words, ' ')]
    ELSE list_transform(range(1, len(words) - 1), lambda i: words[i] || ' ' || words[i + 1] || ' ' || words[i + 2]) END) AS s FROM w),
x AS (SELECT doc_id, len(s) AS n, unnest(s) AS t FROM sets),
links AS (SELECT a.doc_id AS a, b.doc_id AS b FROM x a JOIN x b ON a.t = b.t AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id HAVING 100 * count(*) >= 90 * (any_value(a.n) + any_value(b.n) - count(*))),
reach AS (SELECT a AS node, b AS other FROM links UNION SELECT r.node, l.b FROM reach r JOIN links l ON l.a = r.other),
k AS (SELECT a, count(*) AS n_links FROM links GROUP BY a),
same AS (SELECT min(doc_id) AS class_id, list_sort(s) AS s FROM sets WHERE len(s) > 0 GROUP BY list_sort(s))
SELECT doc_id, len(sets.s) AS n_shingles, least(doc_id, coalesce(m.least, doc_id)) AS component_id,
  coalesce(class_id, doc_id) AS class_id, coalesce(n_links, 0) AS n_links
FROM sets LEFT JOIN (SELECT node, min(other) AS least FROM reach GROUP BY node) m ON m.node = doc_id
LEFT JOIN k ON k.a = doc_id LEFT JOIN same ON same.s = list_sort(sets.s)
"""

QUERIES = {"op1_jaccard_join": op1_jaccard_join}
ORACLES = {"op1_jaccard_join": ORACLE}
