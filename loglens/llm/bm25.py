"""Exact BM25 top-k search: block maxima over an inverted index per shard, blocks by falling bound.

Global statistics (documents, mean length, document frequencies) are counted
over all documents first, so every shard scores alike. Documents are dealt by
hash into bins, and a task takes those of its bin in shards of about
``SHARD_BYTES`` of text. It builds a shard's
index in memory: postings with their term-frequency parts, and for each term
and block of ``BLOCK`` documents the largest of them. Queries visit every
shard in packed batches; a bin's best scores so far are the floor of its later shards. A block's bound is the sum of the query's weighted
block maxima; blocks are taken by falling bound, and those whose bound is
below the k-th best score so far are skipped, which cannot lose a result. Where a
query's postings are too thinly spread over blocks for that (those of a long text:
fewer than ``RUN_POSTINGS`` to a block, so bounds cost more than scores and few blocks
stay below), all its postings are scored, together with those of the batch's other long
queries: words in many of the queries and documents by a product of matrices, of
others the postings, each read once for all queries that have its word. The
bins' top lists are merged by a grouped top-k.

Bins are as many as shards, but so few that the queries, which go to each, stay below
half of the texts: what is shuffled grows with the input, not with its square.

Within a shard documents are ordered by their most frequent word and length,
so blocks hold like documents and their bounds are tight; queries are batched by their most frequent word.

Scores are rounded to ``DIGITS`` digits and ties go to the smaller doc_id.

Defined results: a null or empty text is never found, and as a query finds
nothing; documents without any of the query's words are not results; repeated
rows are all searched, and repeated query rows with one id are one query with
all their words; rows without an id are neither. Other columns are ignored.
Empty in, empty out.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from functools import cached_property, partial
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loglens.llm import text as T
from loglens.llm.store import small_batches, stored

K1, B = 1.2, 0.75
BLOCK = 16
# Half a block: with fewer postings to a block, bounds cost more than they save (measured on texts as queries).
RUN_POSTINGS = 8
SHARD_BYTES = 24 << 20
# A bin's texts are gathered to shards of so many times this, so that one a little larger than a shard isn't two.
SHARD_OVER = 1.25
# Of a bin's packed queries so many bytes are held in memory, more in a temporary file; of its texts this many are added to a shard at a time.
HELD_QUERIES, PIECE_BYTES = 16 << 20, 2 << 20
# Long queries are scored so many, and with about so many terms, at a time, against wide blocks of documents; a packing task has up to so many batches.
BATCH_QUERIES, BATCH_TERMS, GROUP_BATCHES, WIDE = 512, 1 << 18, 4, 4096
# A word's cells (its queries times its documents of a wide block) of all cells, from which a row of a matrix costs less than its postings.
MATRIX_SHARE, MATRIX_WORDS = 0.01, 512
# Postings that are scored at a time.
CHUNK = 1 << 16
# Postings are sorted as one integer of word, document and frequency if these fit so many bits.
KEY_BITS = 63
COUNT_BYTES = 8 << 20
DIGITS = 6


def term_statistics(docs: DataFrame) -> DataFrame:
    """(term, df, words): document frequency per word hash; the row with a null term has the numbers of documents and words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = docs_seen = words_seen = 0

        def flush() -> pa.RecordBatch:
            nonlocal held, size
            terms, n = np.unique(np.concatenate(held), return_counts=True) if held else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
            held, size = [], 0
            return pa.RecordBatch.from_arrays([pa.array(terms.view(np.int64), pa.int64()), pa.array(n, pa.int64()),
                                               pa.array(np.zeros(len(n)), pa.int64())], names=["term", "df", "words"])

        for batch in batches:
            for a, b, buf, offsets in T.slices(batch.column(0)):
                words, first = T.word_hashes(buf, offsets)
                docs_seen += b - a
                words_seen += len(words)
                held += [np.unique(words[first[i]:first[i + 1]]) for i in range(b - a)]
                size += len(buf)
                if size >= COUNT_BYTES:
                    yield flush()
        yield flush()
        yield pa.RecordBatch.from_arrays([pa.array([None], pa.int64()), pa.array([docs_seen], pa.int64()),
                                          pa.array([words_seen], pa.int64())], names=["term", "df", "words"])

    return (docs.select("text").mapInArrow(run, "term long, df long, words long")
            .groupBy("term").agg(F.sum("df").alias("df"), F.sum("words").alias("words")))


def query_terms(queries: DataFrame) -> DataFrame:
    """(query_id, term, times) of ``queries`` (query_id, text)."""
    kind = queries.schema["query_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, buf, offsets in T.slices(batch.column(1)):
                words, first = T.word_hashes(buf, offsets)
                got = [np.unique(words[first[i]:first[i + 1]], return_counts=True) for i in range(b - a)]
                of = np.repeat(np.arange(a, b), [len(t) for t, _ in got])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(of, pa.int64())), pa.array(np.concatenate([t for t, _ in got]).view(np.int64)),
                     pa.array(np.concatenate([c for _, c in got]).astype(np.int64))], names=["query_id", "term", "times"])

    found = queries.select("query_id", "text").mapInArrow(run, f"query_id {kind}, term long, times long")
    return found.groupBy("query_id", "term").agg(F.sum("times").alias("times"))


def packed_queries(terms: DataFrame, queries: int = BATCH_QUERIES, size: int = BATCH_TERMS) -> DataFrame:
    """Terms of queries (query_id, term, times, idf) in batches of at most ``queries`` like ones and about ``size`` terms, compressed."""
    groups = max(1, -(-terms.count() // (GROUP_BATCHES * size)))

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("query_id", "ascending"), ("term", "ascending")])
        ids, term = table["query_id"].to_numpy(), table["term"].to_numpy().astype(np.int64).view(np.uint64)
        times, idf = table["times"].to_numpy().astype(np.int64), table["idf"].to_numpy()
        first = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]]))
        count = np.diff(np.append(first, len(ids)))
        # Like queries side by side: by their most frequent word.
        order = np.argsort(term[np.lexsort((term, times, np.repeat(np.arange(len(first)), count)))[np.cumsum(count) - 1]], kind="stable")
        blobs = []
        while len(order):
            now = order[:max(1, min(queries, int(np.searchsorted(np.cumsum(count[order[:queries]]), size, "right"))))]
            order = order[len(now):]
            own = _spread(first[now], count[now])
            row = np.repeat(np.arange(len(now)), count[now])
            by_word = np.lexsort((row, term[own]))
            own, row = own[by_word], row[by_word]
            words, at, uses = np.unique(term[own], return_index=True, return_counts=True)
            blobs.append(zstandard.compress(b"".join([
                np.array([len(now), len(words), len(own)], np.int64).tobytes(), ids[first[now]].astype(np.int64).tobytes(), np.diff(words, prepend=np.uint64(0)).tobytes(),
                idf[own[at]].tobytes(), uses.astype(np.int32).tobytes(), row.astype(np.int32).tobytes(), times[own].astype(np.int32).tobytes()]), 3))
        return pa.table({"queries": pa.array(blobs, pa.binary())})

    return (terms.withColumn("g", F.pmod(F.xxhash64("query_id"), F.lit(groups))).groupBy("g")
            .applyInArrow(run, "queries binary"))


class Queries(NamedTuple):
    """A batch of queries: those with ``words[i]`` are ``row[first[i]:first[i + 1]]``, with the weights at these places."""

    ids: np.ndarray
    words: np.ndarray
    first: np.ndarray
    row: np.ndarray
    weight: np.ndarray


def _unpacked(blob: bytes) -> Queries:
    raw = zstandard.decompress(blob)
    n, v, m = np.frombuffer(raw, np.int64, 3).tolist()
    ids, words = np.frombuffer(raw, np.int64, n, 24), np.frombuffer(raw, np.uint64, v, at := 24 + 8 * n)
    idf, uses = np.frombuffer(raw, np.float64, v, at := at + 8 * v), np.frombuffer(raw, np.int32, v, at := at + 8 * v)
    row, times = np.frombuffer(raw, np.int32, m, at := at + 4 * v), np.frombuffer(raw, np.int32, m, at + 4 * m)
    return Queries(ids, np.cumsum(words, dtype=np.uint64), np.concatenate([[0], np.cumsum(uses)]), row.astype(np.int64), times * np.repeat(idf, uses))


class Best:
    """The k best documents so far of each query of a group; places still free have the score minus infinity."""

    def __init__(self, queries: int, k: int):
        self.ids = np.full((queries, k), np.iinfo(np.int64).max)
        self.scores = np.full((queries, k), -np.inf)

    def add(self, rows: np.ndarray, of: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        """Documents ``ids`` with ``scores`` of the queries ``rows[of]``."""
        if not len(of):
            return
        k = self.ids.shape[1]
        of = np.concatenate([np.repeat(np.arange(len(rows)), k), of])
        ids, scores = np.concatenate([self.ids[rows].ravel(), ids]), np.concatenate([self.scores[rows].ravel(), scores])
        order = np.lexsort((ids, -scores, of))
        of = of[order]
        order = order[np.arange(len(of)) - np.searchsorted(of, np.arange(len(rows)))[of] < k]
        self.ids[rows], self.scores[rows] = ids[order].reshape(-1, k), scores[order].reshape(-1, k)


def _spread(lo: np.ndarray, size: np.ndarray) -> np.ndarray:
    """lo[0], lo[0] + 1, ... (size[0] numbers), lo[1], ..."""
    return np.arange(size.sum()) + np.repeat(lo - (np.cumsum(size) - size), size)


class Shard:
    """Inverted index of some documents with block maxima."""

    def __init__(self, ids: np.ndarray, texts: pa.Array, mean_length: float, block: int = BLOCK):
        self.block = block
        n = len(ids)
        words, lengths = [], [np.zeros(0, np.int64)]
        for _, _, buf, offsets in T.slices(texts):
            w, first = T.word_hashes(buf, offsets)
            words.append(w)
            lengths.append(np.diff(first))
        length = np.concatenate(lengths)
        words = np.concatenate(words) if words else np.zeros(0, np.uint64)
        # Numbers of words by a hash table, then in order of the words.
        coded = pa.array(words).dictionary_encode()
        del words
        self.terms = coded.dictionary.to_numpy()
        order = np.argsort(self.terms)
        number = np.empty(len(order), dtype=np.int64)
        number[order] = np.arange(len(order))
        self.terms = self.terms[order]
        # One sorted key per word occurrence, in place: the largest array of the build.
        key = number[coded.indices.to_numpy()]
        del coded, number, order
        key *= max(n, 1)
        key += np.repeat(np.arange(n), length)
        key.sort()
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
        tf = np.diff(np.append(first, len(key)))
        pairs = key[first]
        del key, first
        p_term, p_doc = np.divmod(pairs, max(n, 1))
        del pairs
        # Like documents side by side: by their most frequent word, then length.
        main = np.full(n, -1)
        np.maximum.at(main, p_doc, tf * max(len(self.terms), 1) + p_term)
        main %= max(len(self.terms), 1)
        rank = np.empty(n, dtype=np.int64)
        rank[np.lexsort((length, main))] = np.arange(n)
        self.ids = np.empty(n, dtype=np.int64)
        self.ids[rank] = ids
        ranked = np.empty(n, dtype=np.int64)
        ranked[rank] = length
        for_doc, for_tf = n.bit_length(), int(tf.max(initial=0)).bit_length()
        if len(self.terms).bit_length() + for_doc + for_tf <= KEY_BITS:
            key = p_term << (for_doc + for_tf)
            key |= rank[p_doc] << for_tf
            key |= tf
            del p_doc, tf
            key.sort()
            self.doc, tf = key >> for_tf & (1 << for_doc) - 1, key & (1 << for_tf) - 1
            del key
        else:
            order = np.lexsort((rank[p_doc], p_term))
            self.doc, tf = rank[p_doc][order], tf[order]
        self.part = tf * (K1 + 1) / (tf + (K1 * (1 - B + B * ranked / mean_length))[self.doc]) if mean_length else np.zeros(len(tf))
        self.term_at = np.searchsorted(p_term, np.arange(len(self.terms) + 1))
        # Runs of postings of one term in one block, and in one wide block.
        self.blocks = -(-n // block)
        self.run, self.term_run = self._runs(p_term, block)
        self.wide, self.term_wide = self._runs(p_term, WIDE)
        self.wide_size = np.diff(np.append(self.wide, len(self.doc)))
        self.wide_block = self.doc[self.wide] // WIDE
        self.cells = np.zeros(0)

    def _runs(self, p_term: np.ndarray, block: int) -> tuple[np.ndarray, np.ndarray]:
        place = p_term * (len(self.ids) // block + 1)
        place += self.doc // block
        run = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]])) if len(place) else np.zeros(0, np.int64)
        return run, np.searchsorted(run, self.term_at)

    # Only queries that are scored by blocks need these.
    @cached_property
    def run_end(self) -> np.ndarray:
        return np.append(self.run[1:], len(self.doc))

    @cached_property
    def run_block(self) -> np.ndarray:
        return self.doc[self.run] // self.block

    @cached_property
    def run_max(self) -> np.ndarray:
        return np.maximum.reduceat(self.part, self.run) if len(self.part) else self.part

    def top(self, terms: np.ndarray, weights: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(doc ids, rounded scores) of the k best, with all ties of the last one that may matter cut by id."""
        at = self._found(terms)
        return self._top(at[at >= 0], weights[at >= 0], k)

    def _found(self, terms: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.terms, terms)
        there = at < len(self.terms)
        there[there] = self.terms[at[there]] == terms[there]
        return np.where(there, at, -1)

    def _top(self, at: np.ndarray, w: np.ndarray, k: int, floor: float = -np.inf) -> tuple[np.ndarray, np.ndarray]:
        """Those of the k best that reach ``floor``; some below it may be among them."""
        lo, hi = self.term_run[at], self.term_run[at + 1]
        count = hi - lo
        if (self.term_at[at + 1] - self.term_at[at]).sum() < RUN_POSTINGS * count.sum():
            return self._score_all(at, w, k)
        runs = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count - lo, count)
        run_w = np.repeat(w, count)
        block = self.run_block[runs]
        bound = np.bincount(block, run_w * self.run_max[runs], minlength=self.blocks)
        order = np.argsort(-bound, kind="stable")
        order = order[:np.count_nonzero(bound)]
        ids, scores = np.zeros(0, np.int64), np.zeros(0)
        done, step = 0, max(4, 4 * k // self.block)
        while done < len(order):
            least = max(floor, scores[k - 1] if len(scores) >= k else -np.inf) - 10.0 ** -DIGITS
            if least > -np.inf:
                # Bounds fall: all blocks from the first one too low on can be skipped.
                left = done + int(np.searchsorted(-bound[order[done:]], -least, "right"))
                if left == done:
                    break
                take = order[done:min(left, done + step)]
            else:
                take = order[done:done + step]
            got_ids, got = self._evaluate(take, runs, run_w, block)
            ids, scores = np.concatenate([ids, got_ids]), np.concatenate([scores, got])
            best = np.lexsort((ids, -scores))[:k]
            ids, scores = ids[best], scores[best]
            done, step = done + len(take), 4 * step
        return ids, scores

    def improve(self, queries: Queries, best: Best) -> None:
        """Put the documents that are among the best of any query into ``best``."""
        n, k = best.ids.shape
        at = self._found(queries.words)
        there = at >= 0
        at, uses = at[there], np.diff(queries.first)[there]
        entry = _spread(queries.first[:-1][there], uses)
        row, w, word = queries.row[entry], queries.weight[entry], np.repeat(np.arange(len(at)), uses)
        postings = np.bincount(row, np.repeat(self.term_at[at + 1] - self.term_at[at], uses), n)
        thin = postings < RUN_POSTINGS * np.bincount(row, np.repeat(self.term_run[at + 1] - self.term_run[at], uses), n)
        rows = np.flatnonzero((postings > 0) & ~thin)
        if len(rows):
            own = np.flatnonzero(~thin[row])
            own = own[np.argsort(row[own], kind="stable")]
            for i, e in zip(rows.tolist(), np.split(own, np.searchsorted(row[own], rows[1:])), strict=True):
                ids, scores = self._top(at[word[e]], w[e], k, best.scores[i, -1])
                best.add(np.array([i]), np.zeros(len(ids), np.int64), ids, scores)
            own = np.flatnonzero(thin[row])
            row, w, word = row[own], w[own], word[own]
            uses = np.bincount(word, minlength=len(at))
        rows = np.flatnonzero(thin)
        if not len(rows):
            return
        row = np.searchsorted(rows, row)
        # Runs of the words by wide block, those of the most queries first.
        count = self.term_wide[at + 1] - self.term_wide[at]
        run, word = _spread(self.term_wide[at], count), np.repeat(np.arange(len(at)), count)
        block, uses, first = self.wide_block[run], uses[word], (np.cumsum(uses) - uses)[word]
        key = block * (len(rows) + 1) + len(rows) - uses
        order = np.argsort(key.astype(np.uint16) if (block.max() + 1) * (len(rows) + 1) <= 1 << 16 else key, kind="stable")
        run, uses, first = run[order], uses[order], first[order]
        ends = np.searchsorted(block[order], np.arange(-(-len(self.ids) // WIDE) + 1)).tolist()
        for block, (a, b) in enumerate(zip(ends[:-1], ends[1:], strict=True)):
            if a < b:
                total = self._tile(block, run[a:b], uses[a:b], first[a:b], row, w, len(rows))
                self._keep(total, block * WIDE, rows, best)

    def _tile(self, block: int, run: np.ndarray, uses: np.ndarray, first: np.ndarray, row: np.ndarray, w: np.ndarray, queries: int) -> np.ndarray:
        """Scores (query, document) of a wide block. ``run[i]`` is of ``uses[i]`` queries, the rows and weights from ``first[i]`` on.
        Words that many of the queries and documents have are scored by a product of matrices, the postings of others one by one."""
        start, n = block * WIDE, min(WIDE, len(self.ids) - block * WIDE)
        lo, size = self.wide[run], self.wide_size[run]
        dense = uses * size > MATRIX_SHARE * queries * n
        if len(self.cells) < queries * n:
            self.cells = np.empty(queries * n)
        cells = self.cells[:queries * n]
        total = cells.reshape(queries, n)
        own = np.flatnonzero(dense)
        if not len(own):
            total[:] = 0
        for a in range(0, len(own), MATRIX_WORDS):
            i = own[a:a + MATRIX_WORDS]
            weight, part = np.zeros((len(i), queries)), np.zeros((len(i), n))
            e, p = _spread(first[i], uses[i]), _spread(lo[i], size[i])
            weight[np.repeat(np.arange(len(i)), uses[i]), row[e]] = w[e]
            part[np.repeat(np.arange(len(i)), size[i]), self.doc[p] - start] = self.part[p]
            if a:
                total += weight.T @ part
            else:
                np.matmul(weight.T, part, out=total)
        row = row * n
        own = np.flatnonzero(~dense & (uses > 0))
        cuts = [*np.flatnonzero(np.diff(np.cumsum(size[own]) // CHUNK, prepend=-1)).tolist(), len(own)]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            i = own[a:b]
            p, s, at = _spread(lo[i], size[i]), size[i], first[i]
            doc, part = self.doc[p] - start, self.part[p]
            # The j-th queries of all these runs: a shrinking part of them, as those of the most queries are first.
            left = np.searchsorted(-uses[i], -np.arange(uses[i[0]]))
            for j, (r, m) in enumerate(zip(left.tolist(), np.cumsum(s)[left - 1].tolist(), strict=True)):
                cell = np.repeat(row[at[:r] + j], s[:r])
                cell += doc[:m]
                value = np.repeat(w[at[:r] + j], s[:r])
                value *= part[:m]
                np.add.at(cells, cell, value)
        return total

    def _keep(self, total: np.ndarray, start: int, rows: np.ndarray, best: Best) -> None:
        """Put documents from ``start`` on, with scores ``total`` by query, into the best of ``rows``."""
        n, k = total.shape[1], best.ids.shape[1]
        # Those that may round to the k-th best score or above.
        floor = np.maximum(best.scores[rows, -1] - 10.0 ** -DIGITS, np.finfo(float).tiny)
        hit = np.flatnonzero(total >= floor[:, None])
        if len(hit) > 8 * k * len(rows) and (some := total[:, ::4]).shape[1] > k:
            floor = np.maximum(floor, np.partition(some, some.shape[1] - k, axis=1)[:, some.shape[1] - k] - 10.0 ** -DIGITS)
            hit = np.flatnonzero(total >= floor[:, None])
        of, doc = np.divmod(hit, n)
        best.add(rows, of, self.ids[start + doc], np.round(total.reshape(-1)[hit], DIGITS))

    def _score_all(self, at: np.ndarray, w: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        total = np.zeros(len(self.ids))
        for lo, hi, weight in zip(self.term_at[at].tolist(), self.term_at[at + 1].tolist(), w.tolist(), strict=True):
            total[self.doc[lo:hi]] += weight * self.part[lo:hi]  # a document is once in a list
        hit = np.flatnonzero(total)
        if len(hit) > k:
            # Those that may round to the k-th best score or above.
            hit = hit[total[hit] >= np.partition(total[hit], len(hit) - k)[len(hit) - k] - 10.0 ** -DIGITS]
        ids, scores = self.ids[hit], np.round(total[hit], DIGITS)
        best = np.lexsort((ids, -scores))[:k]
        return ids[best], scores[best]

    def _evaluate(self, take: np.ndarray, runs: np.ndarray, run_w: np.ndarray, block: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        slot = np.full(self.blocks, -1, dtype=np.int64)
        slot[take] = np.arange(len(take))
        use = slot[block] >= 0
        r = runs[use]
        lo, size = self.run[r], self.run_end[r] - self.run[r]
        at = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size - lo, size)
        doc = self.doc[at]
        local = slot[doc // self.block] * self.block + doc % self.block
        total = np.bincount(local, np.repeat(run_w[use], size) * self.part[at], minlength=len(take) * self.block)
        hit = np.flatnonzero(total)
        return self.ids[take[hit // self.block] * self.block + hit % self.block], np.round(total[hit], DIGITS)


def _search(batches: Iterator[pa.RecordBatch], mean_length: float, k: int, shard_bytes: int) -> Iterator[pa.RecordBatch]:
    """The k best of each query of a bin (bin, queries, doc_id, text): its packed queries come first, then its documents, shard by shard."""
    held: list[tuple[np.ndarray, pa.Array]] = []
    best: list[tuple[np.ndarray, Best]] = []
    size, at, ends = 0, None, [0]

    def searched() -> None:
        nonlocal held, size
        if held and best:
            ids, texts = np.concatenate([i for i, _ in held]), pa.concat_arrays([t for _, t in held])
            held = []
            shard = Shard(ids, texts, mean_length)
            del texts
            for j, (_, top) in enumerate(best):
                blobs.seek(ends[j])
                shard.improve(_unpacked(blobs.read(ends[j + 1] - ends[j])), top)
        held, size = [], 0

    def found() -> Iterator[pa.RecordBatch]:
        searched()
        for ids, top in best:
            row, place = np.nonzero(top.scores > -np.inf)
            yield pa.RecordBatch.from_arrays([pa.array(ids[row]), pa.array(top.ids[row, place]), pa.array(top.scores[row, place])],
                                             names=["query_id", "doc_id", "score"])

    with tempfile.SpooledTemporaryFile(HELD_QUERIES) as blobs:
        for batch in batches:
            place = batch.column("bin").to_numpy()
            asks = batch.column("queries").is_valid().to_numpy(zero_copy_only=False)
            cuts = np.flatnonzero((place[1:] != place[:-1]) | (asks[1:] != asks[:-1])) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(place)], strict=True):
                if a == b:
                    continue
                if place[a] != at:
                    yield from found()
                    best, at, ends = [], place[a], [0]
                    blobs.seek(0)
                rows = batch.slice(a, b - a)
                if asks[a]:
                    for blob in rows.column("queries").to_pylist():
                        ids = _unpacked(blob).ids.copy()
                        best.append((ids, Best(len(ids), k)))
                        ends.append(ends[-1] + blobs.write(blob))
                    continue
                ids, text = rows.column("doc_id").to_numpy(zero_copy_only=False).astype(np.int64), rows.column("text")
                for c, d, buf, _ in T.slices(text, PIECE_BYTES):
                    held.append((ids[c:d], text.slice(c, d - c)))
                    size += len(buf)
                    if size > SHARD_OVER * shard_bytes:
                        searched()
        yield from found()


def bin_count(text_bytes: int, query_bytes: int, shard_bytes: int) -> int:
    """As many bins as there are shards, but no more than let the queries, sent to each, stay below half of the texts."""
    return max(1, min(-(-text_bytes // shard_bytes), text_bytes // (2 * query_bytes + 1)))


def bm25_search(docs: DataFrame, queries: DataFrame, k: int, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """The ``k`` best documents (integer doc_id, text) of every query (integer query_id, text): query_id, rank, doc_id, score."""
    small_batches(docs.sparkSession)
    docs = docs.where("doc_id is not null").select("doc_id", "text")
    stats = stored(term_statistics(docs), "bm25-terms")
    head = stats.where("term is null").first()
    number, mean = (head["df"], head["words"] / head["df"] if head["df"] else 0.0) if head else (0, 0.0)
    idf = F.log(1 + (number - F.col("df") + 0.5) / (F.col("df") + 0.5))
    weighted = stored(query_terms(queries.where("query_id is not null")).join(stats.where("term is not null"), "term")
                      .select("query_id", "term", "times", idf.alias("idf")), "bm25-queries")
    packed = stored(packed_queries(weighted), "bm25-packed")
    size = docs.agg(F.sum(F.octet_length("text")).alias("b")).first()["b"] or 0
    asked = packed.agg(F.sum(F.octet_length("queries")).alias("b")).first()["b"] or 0
    bins = bin_count(size, asked, shard_bytes)
    rows = (packed.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1)))).select("bin", "queries")
            .unionByName(docs.withColumn("bin", F.pmod(F.xxhash64("doc_id", "text"), F.lit(bins)).cast("int")), allowMissingColumns=True))
    found = (rows.repartitionById(bins, "bin").sortWithinPartitions("bin", F.col("queries").isNull())
             .mapInArrow(partial(_search, mean_length=mean, k=k, shard_bytes=shard_bytes), "query_id long, doc_id long, score double"))
    # At most k rows per query and bin get here.
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "doc_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "doc_id", "score")


TOP = 10


def op6_bm25_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents for every document whose id is divisible by 100, searched with its whole text."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return bm25_search(docs, docs.where("doc_id % 100 = 0").withColumnRenamed("doc_id", "query_id"), TOP)


ORACLE = f"""
WITH w AS (SELECT doc_id, unnest(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+')) AS t FROM documents),
tf AS (SELECT doc_id, t, count(*) AS tf FROM w GROUP BY ALL),
len AS (SELECT doc_id, count(*) AS n FROM w GROUP BY ALL),
c AS (SELECT count(*) AS n, (SELECT count(*) FROM w) / count(*) AS mean FROM documents),
idf AS (SELECT t, ln(1 + ((SELECT n FROM c) - count(*) + 0.5) / (count(*) + 0.5)) AS idf FROM tf GROUP BY t),
s AS (SELECT q.doc_id AS query_id, d.doc_id, round(sum(q.tf * idf * d.tf * {K1 + 1} / (d.tf + {K1} * ({1 - B} + {B} * len.n / (SELECT mean FROM c)))), {DIGITS}) AS score
  FROM tf q JOIN idf USING (t) JOIN tf d USING (t) JOIN len ON len.doc_id = d.doc_id WHERE q.doc_id % 100 = 0 GROUP BY ALL)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score FROM s
QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) <= {TOP}
"""

QUERIES = {"op6_bm25_topk": op6_bm25_topk}
ORACLES = {"op6_bm25_topk": ORACLE}
