import collections
import math
import pathlib
import re
import tracemalloc
import zlib

import numpy as np
import pandas as pd
import pytest
from llm_texts import corpus
from pyspark.sql import functions as F

from loglens.llm import katz as K
from loglens.llm.store import SHUFFLE_CLEANUP
from loglens.session import shared_root

WORD = re.compile("[^\x20\x09-\x0d]+")
LOW = {i: i + 32 for i in range(65, 91)}
END, BEGIN = object(), object()


def tokens(text):
    return [*WORD.findall((text or "").translate(LOW)), END]


class Model:
    """The same model, read off its definition."""

    def __init__(self, texts):
        self.c, pairs = collections.Counter(), collections.Counter()
        for t in texts:
            w = tokens(t)
            self.c.update(w)
            pairs.update(zip([BEGIN, *w], w, strict=False))
        self.n, self.base = sum(self.c.values()), sum(self.c.values()) + len(self.c) + 1
        self.d = K.discounts([sum(v == r for v in pairs.values()) for r in range(1, K.MOST_DISCOUNTED + 2)])
        self.after = collections.defaultdict(dict)
        for (h, w), c in pairs.items():
            self.after[h][w] = c

    def unigram(self, w):
        return (self.c[w] + 1) / self.base

    def p(self, h, w):
        if h not in self.after:
            return self.unigram(w)
        seen = self.after[h]
        total = sum(seen.values()) + all(c > K.MOST_DISCOUNTED for c in seen.values())
        keep = {x: (self.d[c] if c <= K.MOST_DISCOUNTED else 1) * c / total for x, c in seen.items()}
        if w in seen:
            return keep[w]
        return (1 - sum(keep.values())) / (1 - sum(self.unigram(x) for x in seen)) * self.unigram(w)


def in_training(i):
    return zlib.crc32(str(i).encode()) % 7 != 2


def check(rows, texts, train):
    model = Model([t for i, t in enumerate(texts) if train(i)])
    assert sorted(r.doc_id for r in rows) == list(range(len(texts)))
    for r in rows:
        w = tokens(texts[r.doc_id])
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(w), sum(model.c[x] > 0 for x in w), model.n)
        assert r.base_score == pytest.approx(sum(math.log10(model.unigram(x)) for x in w), abs=1e-8)
        assert r.score == pytest.approx(sum(math.log10(model.p(h, x)) for h, x in zip([BEGIN, *w], w, strict=False)), abs=1e-7)


@pytest.mark.parametrize("hot_share", [10_000, 20])
def test_equals_brute_force(docs, hot_share):
    # With 20, frequent words' contexts are split over parts and added up.
    texts = [(t or "") + " the the of the" if i % 3 else t for i, t in enumerate(corpus(6, 60))]
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2
    rows = K.katz_scores(docs(texts), ~held_out, parts=4, block_bytes=20_000, hot_share=hot_share).collect()
    check(rows, texts, in_training)


def test_every_context_sums_to_one():
    model = Model([t for t in corpus(6, 30) if len(t or "") < 2000])
    words = [*model.c, "unknown to the model"]
    for h in [*list(model.after)[:40], BEGIN, "never seen"]:
        assert sum(model.p(h, w) for w in words) == pytest.approx(1, abs=1e-9)


def test_no_training_rows(docs):
    rows = K.katz_scores(docs(["a b", None]), F.lit(False)).collect()
    assert [(r.train_tokens, r.n_known, r.base_score, r.score) for r in rows] == [(0, 0, 0.0, 0.0)] * 2


def test_null_ids_repeated_rows_clashing_columns_and_empty_table(spark, docs):
    df = spark.createDataFrame([(1, "a a", 1), (1, "a a", 2), (None, None, 3)], "doc_id long, text string, block int")
    rows = K.katz_scores(df, F.col("doc_id") == 1).collect()
    assert sorted((str(r.doc_id), r.train, r.n_tokens) for r in rows) == [("1", True, 3), ("1", True, 3), ("None", True, 1)]
    assert K.katz_scores(docs([]), F.lit(True)).collect() == []


def test_discounts_lie_between_zero_and_one():
    for counts in ([100, 40, 20, 11, 7, 5], [0] * 6, [5, 0, 0, 0, 0, 9], [1, 1, 1, 1, 1, 1]):
        d = K.discounts(counts)
        assert all(0 < x < 1 for x in d[1:-1]) and d[-1] == 1


class HigherModel:
    """Katz of any order, read off its recursive definition: a context is a tuple of preceding tokens."""

    def __init__(self, texts, order):
        self.order, self.uni = order, Model(texts)
        self.after, self.d = {}, {}
        for k in range(2, order + 1):
            grams = collections.Counter(g for t in texts for g in self.grams(t, k))
            self.d[k] = K.discounts([sum(v == r for v in grams.values()) for r in range(1, K.MOST_DISCOUNTED + 2)])
            for (*h, w), c in grams.items():
                self.after.setdefault(tuple(h), {})[w] = c

    def grams(self, text, k):
        w = [BEGIN, *tokens(text)]
        return [tuple(w[i - k + 1:i + 1]) for i in range(k - 1, len(w))]

    def p(self, h, w):
        if not h:
            return self.uni.unigram(w)
        if h not in self.after:
            return self.p(h[1:], w)
        seen, d = self.after[h], self.d[len(h) + 1]
        total = sum(seen.values()) + all(c > K.MOST_DISCOUNTED for c in seen.values())
        keep = {x: (d[c] if c <= K.MOST_DISCOUNTED else 1) * c / total for x, c in seen.items()}
        if w in seen:
            return keep[w]
        return (1 - sum(keep.values())) / (1 - sum(self.p(h[1:], x) for x in seen)) * self.p(h[1:], w)

    def score(self, text):
        w = [BEGIN, *tokens(text)]
        return sum(math.log10(self.p(tuple(w[max(0, i - self.order + 1):i]), w[i])) for i in range(1, len(w)))


@pytest.mark.parametrize("order,hot_share", [(3, 10_000), (3, 20), (4, 20)])
def test_higher_orders_equal_brute_force(docs, order, hot_share):
    # Blocks of a few texts and parts share some n-grams and have others alone; repeats give counts over 5.
    texts = [(t or "") + " the the of the and so the the of it" if i % 3 else t for i, t in enumerate(corpus(6, 45)) if len(t or "") < 3000]
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2
    rows = K.katz_scores(docs(texts), ~held_out, parts=4, block_bytes=5_000, hot_share=hot_share, order=order).collect()
    model = HigherModel([t for i, t in enumerate(texts) if in_training(i)], order)
    assert sorted(r.doc_id for r in rows) == list(range(len(texts)))
    for r in rows:
        assert r.score == pytest.approx(model.score(texts[r.doc_id]), abs=1e-7)


def test_registered_query_uses_contexts_of_two_words(spark, docs, table_dir):
    texts = ["a b c", "x b d", "a b c", "x b d", *["e f"] * 6]
    folder = table_dir(documents=docs(texts))
    train = [t for i, t in enumerate(texts) if in_training(i)]
    for r in K.QUERIES["op9_katz_scores"](spark, folder).collect():
        assert r.score == pytest.approx(HigherModel(train, 3).score(texts[r.doc_id]), abs=1e-7)


def test_stored_tables_that_no_later_step_reads_are_deleted(spark, docs):
    root = pathlib.Path(shared_root(spark).removeprefix("file:"))
    before, setting = set(root.glob("katz-*")), spark.conf.get(SHUFFLE_CLEANUP, None)
    texts = ["a b c d", "a b c e", "x b d", "a b c d", None]
    scored = K.katz_scores(docs(texts), F.lit(True), parts=3, block_bytes=10, order=3)
    left = [f for table in set(root.glob("katz-*")) - before for f in table.rglob("*.parquet")]
    # What the scores are read from is there; the word lists and the parts' own tables are not.
    assert {f.relative_to(root).parts[0].rsplit("-", 1)[0] for f in left} == {"katz-blocks", "katz-unigrams", "katz-2-grams", "katz-3-grams"}
    assert {f.parent.name for f in left} == {"half=body", "of_model=false"}
    assert spark.conf.get(SHUFFLE_CLEANUP, None) == setting
    model = HigherModel(texts, 3)
    rows = scored.collect()
    assert sorted(r.doc_id for r in rows) == list(range(len(texts)))
    for r in rows:
        assert r.score == pytest.approx(model.score(texts[r.doc_id]), abs=1e-7)


@pytest.mark.parametrize("order", [2, 3, 4])
def test_shares_of_blocks_give_the_same_scores_and_leave_only_them(spark, docs, order):
    root = pathlib.Path(shared_root(spark).removeprefix("file:"))
    texts = [(t or "") + " the the of the" if i % 3 else t for i, t in enumerate(corpus(6, 30)) if len(t or "") < 3000]
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2
    scored = lambda **x: K.katz_scores(docs(texts), ~held_out, parts=4, block_bytes=5_000, hot_share=20, order=order, **x)
    whole = sorted(scored().collect())
    before = set(root.glob("katz-*"))
    staged = scored(staged_tokens=0)
    left = [f for table in set(root.glob("katz-*")) - before for f in table.rglob("*.parquet")]
    assert {f.parent.name.rsplit("-", 1)[0] for f in left} == {"katz-scores"}
    assert sorted(staged.collect()) == whole and len(whole) == len(texts)


def test_distinct_equals_unique():
    for a in ([], [5], [3, 1, 3, 2, 1, 3]):
        a = np.array(a, dtype=np.uint64)
        values, place, index = K._distinct(a)
        assert values.tolist() == sorted(set(a.tolist()))
        assert a[place].tolist() == values.tolist() and values[index].tolist() == a.tolist()


class Groups:
    """Stands for messages: gives back the function that a part's rows are handed to."""

    def groupBy(self, _):  # noqa: N802
        return self

    def applyInPandas(self, run, _):  # noqa: N802
        return run


def test_contexts_and_part_answers_stay_narrow():
    # One block and one part; 20,000 distinct words in 100 texts, most contexts seen once.
    rng = np.random.default_rng(3)
    lengths = np.full(100, 600)
    index = rng.integers(0, 20_000, lengths.sum() + 1)
    total = np.bincount(index, minlength=20_000)
    words = [{"part": 0, "answer": K.pack(np.ones(20_000, dtype=int), total)}]
    b = K.Block(K.pack(np.ones(100, dtype=bool), lengths, index), words, n=60_100, parts=1, hot_share=10_000)
    asked = pd.DataFrame({"part": [0], "block": [7], "message": [b.level.message(0)], "local": [None]})
    answered = K._answers(Groups(), 2, False, 60_100, 1, 10_000)
    tracemalloc.start()
    try:
        got = answered(asked)
        assert tracemalloc.get_traced_memory()[1] < 130 * len(b.level.h)
        answers = got[got["block"] == 7].to_dict("records")
        count, _ = b.level.read(answers)
        h, sums = b.level.contexts(answers, count)
        assert len(h) > 15_000 and sum(s.nbytes for s in sums) <= 10 * len(h)
    finally:
        tracemalloc.stop()
    assert count.tolist() == b.level.counts.tolist()
    pairs = collections.Counter(zip(b.before(b.w.astype(np.uint64), K.START).tolist(), b.w.tolist(), strict=True))
    freed = collections.defaultdict(lambda: [0] * (K.MOST_DISCOUNTED + 2))
    for (x, w), c in pairs.items():
        freed[x][min(c, K.MOST_DISCOUNTED + 1) - 1] += 1 if c <= K.MOST_DISCOUNTED else c
        freed[x][-1] += int(total[w - K.FIRST_WORD]) + 1
    assert {x: [int(s[i]) for s in sums] for i, x in enumerate(h.tolist())} == freed


def test_scores_are_the_same_whatever_number_of_contexts_is_wide_at_a_time(monkeypatch):
    texts = [(t or "") + " the the of the" for t in corpus(6, 12) if len(t or "") < 3000]
    log_p, of = [], lambda n: (np.zeros(n), np.full(n, 9.0))
    w = [(t * 40).split() for t in texts]
    words, index = np.unique(np.concatenate(w), return_inverse=True)
    index = np.append(index, 0)
    lengths, total = np.array([len(x) for x in w]), np.bincount(index) + 5
    answer = [{"part": 0, "answer": K.pack(np.ones(len(words), dtype=int), total)}]
    for contexts in (7, 1 << 15):
        monkeypatch.setattr(K, "CONTEXTS", contexts)
        b = K.Block(K.pack(np.ones(len(w), dtype=bool), lengths, index), answer, n=1000, parts=1, hot_share=50)
        got = K._answers(Groups(), 2, True, 1000, 1, 50)(pd.DataFrame({"part": [0], "block": [7], "message": [b.level.message(0)], "local": [None]}))
        answers = got[got["block"] == 7].to_dict("records")
        p, below = of(len(b.w))
        hot = np.array([K.START], dtype=np.uint64)
        K._backed_off(b.level, answers, b.level.read(answers)[0], p, below, np.linspace(0.2, 1, K.MOST_DISCOUNTED + 2), None,
                      hot, [np.array([300])] * (K.MOST_DISCOUNTED + 2))
        log_p.append((p.tolist(), below.tolist()))
    assert log_p[0] == log_p[1] and len(set(log_p[0][1])) > 20


def test_word_numbers_are_sent_as_steps():
    # 4 blocks with a fourth of 40,000 words each: a step fits in a byte, a number would not.
    hashes = np.sort(np.random.default_rng(4).integers(1, 1 << 62, 40_000).astype(np.uint64))
    sent = [hashes[i::4] for i in range(4)]
    got = K._word_answers(Groups(), 3)(pd.DataFrame({"part": [1] * 4, "block": range(4), "words": [x.tobytes() for x in sent],
                                                     "counts": [K.pack((x % np.uint64(5) > 0).astype(int)) for x in sent]}))
    number = dict(zip(hashes[hashes % np.uint64(5) > 0].tolist(), K.FIRST_WORD + 1 + 3 * np.arange(40_000), strict=False))
    for block, x in enumerate(sent):
        step, total = K.unpack(got[got["block"] == block]["answer"].iloc[0])
        assert step.itemsize == 1
        assert K._numbers(step, 1, 3).tolist() == [number.get(v, K.UNKNOWN) for v in x.tolist()]
        assert total.tolist() == [int(v % 5 > 0) for v in x.tolist()]
