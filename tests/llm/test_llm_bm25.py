import collections
import math
import random
import re

import numpy as np
import pyarrow as pa
from llm_texts import corpus, rows_of, words

from loglens.llm import bm25 as M
from loglens.llm import text as T

WORD = re.compile("[^\x20\x09-\x0d]+")
LOW = {i: i + 32 for i in range(65, 91)}


def brute(rows, queries, k):
    bags = [(i, collections.Counter(WORD.findall((t or "").translate(LOW)))) for i, t in rows]
    df = collections.Counter(w for _, b in bags for w in b)
    n, mean = len(bags), sum(sum(b.values()) for _, b in bags) / len(bags)
    out = []
    for q, text in queries:
        bag, scores = collections.Counter(WORD.findall((text or "").translate(LOW))), []
        for i, b in bags:
            length = sum(b.values())
            s = sum(bag[w] * math.log(1 + (n - df[w] + 0.5) / (df[w] + 0.5)) * b[w] * (M.K1 + 1) /
                    (b[w] + M.K1 * (1 - M.B + M.B * length / mean)) for w in bag if w in b)
            if s:
                scores.append((-round(s, M.DIGITS), i))
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(sorted(scores)[:k])]
    return sorted(out)


def test_equals_brute_force_over_shards(spark, docs):
    texts = corpus(4, 80)
    rng = random.Random(1)
    queries = [(0, "BA co di"), (1, None), (2, ""), (3, texts[10]), (4, "unheard-of"), (5, "ba ba ba"), (6, " ".join(words(rng, 40)))]
    asked = spark.createDataFrame(queries, "query_id long, text string")
    got = M.bm25_search(docs(texts), asked, 7, shard_bytes=6000).collect()
    want = brute(list(enumerate(texts)), queries, 7)
    assert sorted((r.query_id, r.rank, r.doc_id) for r in got) == [w[:3] for w in want]
    assert np.allclose(sorted(r.score for r in got), sorted(w[3] for w in want), atol=2e-6)


def test_query_equals_its_sql(docs, table_dir, twin):
    texts = corpus(9, 60)
    rows = [(i * 25, t, "en", "s", 0) for i, t in enumerate(texts)]
    ours, theirs = twin(M, "op6_bm25_topk", table_dir(documents=docs(rows)))
    assert ours == theirs and ours


def test_blocks_below_the_bound_are_skipped():
    rng = random.Random(3)
    texts = [" ".join([*rng.choices(["common", "usual", "plain"], k=30), *(["rare"] * 5 if i % 97 == 0 else [])]) for i in range(2000)]
    shard = M.Shard(np.arange(2000), pa.array(texts), 30.0)
    looked = []
    inner = shard._evaluate
    shard._evaluate = lambda take, *a: (looked.append(len(take)), inner(take, *a))[1]
    terms = np.sort(shard.terms[np.isin(shard.terms, shard.terms)])
    df = {t: n for t, n in zip(shard.terms.tolist(), np.add.reduceat(shard.run_end - shard.run, shard.term_run[:-1]).tolist(), strict=True)}
    weights = np.array([math.log(1 + (2000 - df[t] + 0.5) / (df[t] + 0.5)) for t in terms.tolist()])
    ids, scores = shard.top(terms, weights, 5)
    assert sum(looked) < shard.blocks / 2
    shard.block = 1
    every = M.Shard(np.arange(2000), pa.array(texts), 30.0, block=2000)
    assert [x.tolist() for x in every.top(terms, weights, 5)] == [ids.tolist(), scores.tolist()]


def test_repeated_and_null_ids_clashing_columns_and_empty_tables(spark, docs):
    df = spark.createDataFrame([(1, "a b", "x"), (1, "a b", "y"), (None, "a b", "z"), (2, "c", "w")], "doc_id long, text string, shard string")
    asked = spark.createDataFrame([(9, "a"), (9, "c"), (None, "a")], "query_id long, text string")
    got = sorted((r.query_id, r.rank, r.doc_id) for r in M.bm25_search(df, asked, 5).collect())
    assert [g[0] for g in got] == [9] * 3 and sorted(g[2] for g in got) == [1, 1, 2] and [g[1] for g in got] == [1, 2, 3]
    assert M.bm25_search(docs([]), asked, 5).collect() == []
    assert M.bm25_search(docs(rows_of(["a"])), spark.createDataFrame([], asked.schema), 5).collect() == []


def test_long_queries_are_scored_list_by_list():
    rng = np.random.default_rng(3)
    texts = [" ".join(f"w{x}" for x in rng.integers(0, 3000, 80)) for _ in range(600)] + ["w1 w2 only", "", None]
    ids = rng.permutation(len(texts))
    shard = M.Shard(ids, pa.array(texts), 80.0)
    looked = []
    inner = shard._evaluate
    shard._evaluate = lambda take, *a: (looked.append(len(take)), inner(take, *a))[1]
    for text in texts[:30]:
        _, _, buf, offsets = next(iter(T.slices(pa.array([text]))))
        terms, times = np.unique(T.word_hashes(buf, offsets)[0], return_counts=True)
        weights = times * (1 + (terms % np.uint64(97)).astype(float) / 10)
        got = shard.top(terms, weights, 10)
        totals = np.zeros(len(ids))
        for term, weight in zip(terms, weights, strict=True):
            i = int(np.searchsorted(shard.terms, term))
            for run in range(shard.term_run[i], shard.term_run[i + 1]):
                for p in range(shard.run[run], shard.run_end[run]):
                    totals[shard.doc[p]] += weight * shard.part[p]
        best = sorted((-round(x, M.DIGITS), d) for x, d in zip(totals.tolist(), shard.ids.tolist(), strict=True) if x)[:10]
        assert got[0].tolist() == [d for _, d in best]
        assert np.allclose(got[1], [-x for x, _ in best])
    assert not looked


def test_batches_of_queries_equal_single_ones(spark, monkeypatch):
    for name, value in (("WIDE", 128), ("MATRIX_WORDS", 16), ("CHUNK", 512), ("MATRIX_SHARE", 0.05)):
        monkeypatch.setattr(M, name, value)
    rng = np.random.default_rng(5)
    tongues = [np.array([f"{c}{i}" for i in range(800)]) for c in "xy"]
    long = [" ".join(tongues[rng.integers(2)][np.minimum(rng.zipf(1.3, rng.integers(1, 120)) - 1, 799)]) for _ in range(500)]
    texts = [*long, *long[:40], None, "", "x0 y0"]
    ids = rng.permutation(len(texts))
    asked = [*long[:90], "x0", "x0 y0 x1", "unheard", ""]
    rows = []
    for q, text in enumerate(asked):
        _, _, buf, offsets = next(iter(T.slices(pa.array([text]))))
        terms, times = np.unique(T.word_hashes(buf, offsets)[0], return_counts=True)
        rows += [(q, int(t), int(n), 1 + int(t) % 97 / 10) for t, n in zip(terms.view(np.int64), times, strict=True)]
    blobs = [r["queries"] for r in M.packed_queries(spark.createDataFrame(rows, "query_id long, term long, times long, idf double"), 40, 900).collect()]
    shards = [M.Shard(ids[part], pa.array([texts[i] for i in part]), 40.0) for part in np.array_split(np.arange(len(texts)), 3)]
    read = []
    inner = M._spread
    seen = {}
    for batch in map(M._unpacked, blobs):
        best = M.Best(len(batch.ids), 10)
        assert len(batch.ids) <= 40
        for shard in shards:
            shard.improve(batch, best)
        monkeypatch.setattr(M, "_spread", lambda lo, size: (read.append(int(size.sum())), inner(lo, size))[1])
        shards[0].improve(batch, M.Best(len(batch.ids), 10))
        monkeypatch.setattr(M, "_spread", inner)
        seen |= {q: [*zip(best.ids[i].tolist(), best.scores[i].tolist(), strict=True)] for i, q in enumerate(batch.ids.tolist())}
    postings = 0
    for q in {r[0] for r in rows}:
        terms, weights = np.array([r[1] for r in rows if r[0] == q]).view(np.uint64), np.array([r[2] * r[3] for r in rows if r[0] == q])
        want = sorted((-s, d) for shard in shards for d, s in zip(*(x.tolist() for x in shard.top(terms, weights, 10)), strict=True))[:10]
        got = [(d, s) for d, s in seen.pop(q) if s > -np.inf]
        assert [d for d, _ in got] == [d for _, d in want]
        assert np.allclose([s for _, s in got], [-s for s, _ in want])
        at = shards[0]._found(terms)
        postings += int((shards[0].term_at[at[at >= 0] + 1] - shards[0].term_at[at[at >= 0]]).sum())
    assert not seen
    # A posting is read once for all queries of a batch that have its word.
    assert sum(read) < postings / 2


def test_many_queries_go_to_few_bins_of_several_shards(spark, docs):
    assert M.bin_count(800 << 20, 4 << 20, 24 << 20) == 34 and M.bin_count(0, 0, 24 << 20) == 1
    # Ten times the documents and queries: as many bytes of queries for one of texts, not ten times as many.
    for times in (10, 100):
        assert 0.4 < M.bin_count(times * 800 << 20, times * 4 << 20, 24 << 20) * 4 / 800 <= 0.5
    texts = corpus(6, 70)
    asked = spark.createDataFrame(list(enumerate(texts)), "query_id long, text string")
    got = M.bm25_search(docs(texts), asked, 5, shard_bytes=4000).collect()
    want = brute(list(enumerate(texts)), list(enumerate(texts)), 5)
    assert sorted((r.query_id, r.rank, r.doc_id) for r in got) == [w[:3] for w in want]
    assert np.allclose([r.score for r in sorted(got, key=lambda r: (r.query_id, r.rank))], [w[3] for w in want], atol=2e-6)


def test_postings_too_wide_for_one_integer_are_sorted_alike(monkeypatch):
    texts = pa.array(corpus(2, 50))
    narrow = M.Shard(np.arange(len(texts)), texts, 50.0)
    monkeypatch.setattr(M, "KEY_BITS", 0)
    wide = M.Shard(np.arange(len(texts)), texts, 50.0)
    for name in ("terms", "ids", "doc", "part", "run", "run_end", "run_block", "run_max", "term_run", "term_at"):
        assert np.array_equal(getattr(narrow, name), getattr(wide, name))
