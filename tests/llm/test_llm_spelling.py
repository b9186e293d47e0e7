import random
import re
import zlib
from collections import Counter

import pytest
from llm_texts import corpus, words

from loglens.llm import spelling as S


def near(u, v):
    if abs(len(u) - len(v)) > 1 or u == v:
        return False
    if len(u) == len(v):
        return sum(a != b for a, b in zip(u, v, strict=True)) == 1
    u, v = sorted((u, v), key=len)
    return any(v[:i] + v[i + 1:] == u for i in range(len(v)))


def brute_counts(rows):
    total = Counter()
    for doc_id, text in rows:
        for w in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = "".join(c.lower() if "A" <= c <= "Z" else c for c in w)
            h = zlib.crc32(f"{doc_id}:{w}".encode())
            if doc_id is not None and h % 31 == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            total[w] += 1
    return {w: n for w, n in total.items() if len(w) >= 7 and n >= 2}


def brute_variants(counts, ratio=10):
    out = {}
    for w, n in counts.items():
        close = [v for v in counts if near(w, v)]
        best = min(close, key=lambda v: (-counts[v], v), default=None)
        form = best if best is not None and counts[best] >= ratio * n else None
        out[w] = [form, None, n, len(close), counts[form] if form else None]
    for w, row in out.items():
        root = w
        while out[root][0] is not None:
            root = out[root][0]
        row[1] = root
    return {w: tuple(r) for w, r in out.items()}


def rows_of(df):
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()}


def vocabulary(rng, n):
    """Long words with many near ones, by one and two edits."""
    letters = "abcéÿ"
    out = set()
    for w in words(rng, n):
        w = (w * 4)[:rng.randint(7, 12)]
        for _ in range(rng.randint(0, 3)):
            i = rng.randrange(len(w))
            w = rng.choice([w[:i] + w[i + 1:], w[:i] + rng.choice(letters) + w[i:], w[:i] + rng.choice(letters) + w[i + 1:]])
            if len(w) >= 4:
                out.add(w)
    return sorted(out)


@pytest.mark.parametrize("hot", [10 ** 9, 1, 30])
def test_near_pairs_equal_brute_force(spark, hot):
    rng = random.Random(5)
    vocab = vocabulary(rng, 250) + ["aaaa", "aaaaa", "aaab", "baaa", "aabaa", "abab", "babab"]
    vocab = sorted(set(vocab))
    got = [tuple(sorted((r.u, r.v))) for r in S.near_pairs(spark.createDataFrame([(w,) for w in vocab], "word string"), hot).collect()]
    want = {tuple(sorted((u, v))) for i, u in enumerate(vocab) for v in vocab[:i] if near(u, v)}
    assert len(got) == len(set(got)) and set(got) == want and len(want) > 200


def test_a_hot_chunk_does_not_pair_all_its_words(spark):
    rng = random.Random(6)
    tails = {"".join(rng.choice("abcdefghij") for _ in range(4)) for _ in range(1500)}
    vocab = sorted("unverwechselbar" + t for t in tails)
    df = spark.createDataFrame([(w,) for w in vocab], "word string")
    got = {tuple(sorted((r.u, r.v))) for r in S.near_pairs(df, 64).collect()}
    assert got == {tuple(sorted((r.u, r.v))) for r in S.near_pairs(df, 10 ** 12).collect()}
    keys = S.chunk_keys(df)
    forms = keys.withColumn("form", S.F.explode(S._forms(S.F.col("word")))).drop("word")
    assert forms.groupBy("key", "form").count().agg({"count": "max"}).first()[0] < 120


def test_forms_and_roots_equal_brute_force(spark):
    rng = random.Random(7)
    counts = {w: int(10 ** rng.uniform(0.31, 4)) for w in vocabulary(rng, 150)}
    counts |= {"abcdefg": 20_000, "abcdefgh": 2_000, "abcdefghi": 200, "abcdefghij": 20, "abcdefghijk": 2, "abcdefgx": 2_000, "abcdefghy": 200}
    got = rows_of(S.variants(spark.createDataFrame(list(counts.items()), "word string, n long")))
    assert got == brute_variants(counts)
    assert got["abcdefghijk"][:2] == ("abcdefghij", "abcdefg")
    assert got["abcdefg"][3] == 2


def test_query_equals_brute_force(spark, docs, table_dir):
    rng = random.Random(8)
    vocab = [w for w in vocabulary(rng, 60) if len(w) >= 7]
    weights = [1 / (i + 1) for i in range(len(vocab))]
    texts = [" ".join(rng.choices(vocab, weights, k=rng.randint(1, 400))) for _ in range(80)]
    rows = [(i, t) for i, t in enumerate([*corpus(2, 30), *texts, "ÀÉÎÕÜ×÷ÿ Straßenbahn STRASSENBAHN Strassenbahn!straſſenbahn_naïveté-Naïveté"])]
    rows += [rows[40], (None, texts[0]), (None, None)]
    df = spark.createDataFrame([(i, t, 0, "x") for i, t in rows], "doc_id long, text string, n long, word string").repartition(4)
    got = rows_of(S.op13_spelling_variants(spark, table_dir(documents=df)))
    want = brute_variants(brute_counts(rows))
    assert got == want
    assert sum(r[0] is not None for r in want.values()) > 20


def test_empty_tables_and_texts(spark, table_dir):
    for data in ([], [(1, None)], [(None, ""), (2, "short words only")], [(3, "a" * 300_000), (4, "a" * 300_000)]):
        df = spark.createDataFrame(data, "doc_id long, text string")
        got = rows_of(S.op13_spelling_variants(spark, table_dir(documents=df)))
        assert set(got) == set(brute_counts(data))
        assert all(r[0] is None for r in got.values())
