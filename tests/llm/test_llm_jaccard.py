import random
import re
import tracemalloc

import numpy as np
import pytest
from llm_texts import corpus, words

from loglens.llm import jaccard_join as J
from loglens.llm import text as T
from loglens.llm.components import connected_components

WORD = re.compile("[^\x20\x09-\x0d]+")
LOW = {i: i + 32 for i in range(65, 91)}


def shingles(text, n):
    w = WORD.findall((text or "").translate(LOW))
    return {tuple(w[i:i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()


def brute(rows, n, num, den):
    """{doc_id: (n_shingles, component, links)} by comparing all pairs."""
    sets = [(i, shingles(t, n)) for i, t in rows]
    root = {i: i for i, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    links = [0] * len(sets)
    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if x and y and den * len(x & y) >= num * len(x | y):
                links[a] += 1
                links[b] += 1
                p, q = find(sets[a][0]), find(sets[b][0])
                root[max(p, q)] = min(p, q)
    return [(i, len(s), find(i), k) for (i, s), k in zip(sets, links, strict=True)]


def result(df):
    return sorted((r.doc_id, r.n_shingles, r.component_id, r.n_links) for r in df.collect())


@pytest.mark.parametrize("n,num,den", [(3, 9, 10), (5, 4, 5)])
def test_equals_brute_force(docs, n, num, den):
    texts = corpus(3)
    df = docs(texts)
    assert result(J.jaccard_groups(df, n, num, den)) == sorted(brute(list(enumerate(texts)), n, num, den))


def test_result_does_not_depend_on_the_sketch(docs):
    texts = corpus(5, 40)
    want = result(J.jaccard_groups(docs(texts), 3, 9, 10))
    assert result(J.jaccard_groups(docs(texts), 3, 9, 10, sketch_bits=4)) == want


def test_large_group_of_near_copies_is_split_into_blocks(docs, monkeypatch):
    monkeypatch.setattr(J, "MOST_BLOCK", 7)
    monkeypatch.setattr(J, "TILE", 3)
    monkeypatch.setattr(J, "HOT_COPIES", 2)
    rng = random.Random(9)
    base = words(rng, 120)
    texts = []
    for _ in range(50):
        near = list(base)
        for _ in range(rng.randint(0, 4)):
            near[rng.randrange(120)] = rng.choice(["ba", "co"])
        texts.append(" ".join(near))
    texts += texts[:9] * 2
    assert result(J.jaccard_groups(docs(texts), 3, 9, 10)) == sorted(brute(list(enumerate(texts)), 3, 9, 10))


def test_tiles_of_many_shingles_are_compared_in_little_memory():
    rng = np.random.default_rng(3)
    common = rng.integers(1, 1 << 60, 3000)
    records = [(i % 2, i, 900, 450, np.sort(np.concatenate([common[i // 2 % 5 * 600:][:600], rng.integers(1, 1 << 60, 300)])).tobytes())
               for i in range(2 * J.TILE)]
    tracemalloc.start()
    i, j = J._tile_candidates(records[::2], records[1::2], 4, 5)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sorted(zip(i.tolist(), j.tolist(), strict=True)) == [(a, b) for a in range(J.TILE) for b in range(J.TILE) if a % 5 == b % 5]
    assert peak < 120 << 20


def test_repeated_ids_null_ids_and_clashing_columns(spark):
    rows = [(7, "a b c d e f"), (7, "a b c d e f"), (7, "x y z"), (None, "a b c d e f"), (None, "lone text here"), (9, "x y z"), (3, None)]
    df = spark.createDataFrame([(i, t, 1, "q") for i, t in rows], "doc_id long, text string, node int, digest string")
    got = sorted((str(r.doc_id), r.n_shingles, r.component_id) for r in J.jaccard_groups(df, 3, 9, 10).collect())
    assert got == sorted([("7", 4, 7), ("7", 4, 7), ("7", 1, 7), ("None", 4, 7), ("None", 1, None), ("9", 1, 7), ("3", 0, 3)])


def several_texts_under_one_id(seed):
    """Rows whose ids are used again for other texts and missing here and there, with near copies of all texts."""
    rng = random.Random(seed)
    rows = []
    for g in range(8):
        base = words(rng, 60)
        for _ in range(rng.randint(1, 4)):
            near = list(base)
            near[rng.randrange(60)] = "ba"
            rows.append((rng.choice([None, *range(100, 112), 20 + 10 * g + len(rows)]), " ".join(near)))
    return rows


@pytest.mark.parametrize("n,num,den", [(3, 9, 10), (5, 4, 5)])
def test_two_texts_under_one_id_keep_their_links(spark, n, num, den):
    rng = random.Random(4)
    x, y = words(rng, 80), words(rng, 80)
    near = lambda w: " ".join([*w[:40], "ba", *w[41:]])
    rows = [(5, " ".join(x)), (5, " ".join(y)), (1, near(x)), (2, near(y)), (9, "far away from all of them")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = result(J.jaccard_groups(df, n, num, den))
    assert got == sorted(brute(rows, n, num, den))
    assert {r[2] for r in got if r[0] in (1, 2, 5)} == {1} and all(r[3] == 1 for r in got if r[0] != 9)


@pytest.mark.parametrize("seed", range(2))
def test_used_ids_equal_brute_force(spark, seed):
    rows = [r for r in several_texts_under_one_id(seed) if r[0] is not None]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = brute(rows, 3, 9, 10)
    # Rows with one id are one node: its texts lie in one component.
    root = {i: i for i, _ in rows}
    find = lambda x: x if root[x] == x else find(root[x])
    sets = [(i, shingles(t, 3)) for i, t in rows]
    for a, x in sets:
        for b, y in sets:
            if 10 * len(x & y) >= 9 * len(x | y):
                p, q = sorted((find(a), find(b)))
                root[q] = p
    want = sorted((i, n, find(i), k) for i, n, _, k in want)
    assert result(J.jaccard_groups(df, 3, 9, 10)) == want


@pytest.mark.parametrize("seed", range(2))
def test_one_per_group_loses_no_text_that_has_no_copy(spark, seed):
    rows = [*several_texts_under_one_id(seed), (None, ""), (None, ""), (100, None), (3, "one lone text"), (3, "another lone text"), (3, "one lone text")]
    df = spark.createDataFrame([(*r, "c") for r in rows], "doc_id long, text string, node string").repartition(4)
    kept = [(r.doc_id, r.text) for r in J.one_per_group(df).collect()]
    full = [(i, t, shingles(t, 5)) for i, t in rows]
    similar = lambda x, y: 5 * len(x & y) >= 4 * len(x | y)
    # Of each component of texts one row stays, that with the smallest id.
    left = [f for f in full if f[2]]
    while left:
        group, grown = [left.pop()], True
        while grown:
            more = [f for f in left if any(similar(f[2], g[2]) for g in group)]
            left = [f for f in left if f not in more]
            group, grown = group + more, bool(more)
        stay = [k for k in kept if any(k == g[:2] for g in group)]
        assert len(stay) == 1
        ids = [g[0] for g in group if g[0] is not None]
        assert stay[0][0] == (min(ids) if ids else None)
    assert sum(not shingles(t, 5) for _, t in kept) == 3


def test_empty_table(docs):
    assert J.jaccard_groups(docs([]), 3, 9, 10).collect() == []


def test_query_equals_its_sql(docs, table_dir, twin):
    ours, theirs = twin(J, "op1_jaccard_join", table_dir(documents=docs(corpus(11, 40))))
    assert ours == theirs


def test_one_per_group_keeps_one_row_of_each(docs):
    texts = ["same text as that one here"] * 3 + [None, "", "another text that differs much from it"]
    kept = J.one_per_group(docs(texts))
    assert sorted(r.doc_id for r in kept.collect()) == [0, 3, 4, 5]
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars"]


def test_components_of_paths_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(1, 30)] + [(100, x) for x in range(101, 120)] + [(5, 5), (120, 119), (120, 119)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "src long, dst long")).collect()}
    assert got == {i: 1 for i in range(1, 31)} | {i: 100 for i in range(100, 121)}


def test_prefix_shares_k_tokens_with_every_similar_set():
    rng = np.random.default_rng(2)
    level = rng.integers(0, 40, 1 << 16).astype(np.uint8)
    for _ in range(200):
        base = np.unique(rng.integers(0, 1 << 16, rng.integers(5, 80)).astype(np.uint64))
        other = np.unique(np.concatenate([base[rng.random(len(base)) > 0.05], rng.integers(0, 1 << 16, 2).astype(np.uint64)]))
        common = len(np.intersect1d(base, other))
        if 10 * common >= 9 * (len(base) + len(other) - common):
            (k, p), (m, q) = (J.choose_prefix(s, level[s.astype(int)], 0.0, 9, 10) for s in (base, other))
            assert len(np.intersect1d(p, q)) >= min(k, m)


def test_word_hashes_do_not_depend_on_place():
    a = np.frombuffer("Über den Bergen".encode(), np.uint8)
    b = np.frombuffer("x über DEN  bergen".encode(), np.uint8)
    one, _ = T.word_hashes(a, np.array([0, len(a)]))
    two, _ = T.word_hashes(b, np.array([0, len(b)]))
    assert one[1] == two[2] and one[0] != two[1] and len(two) == 4  # Ü is not A-Z
    assert one[2] == two[3]
