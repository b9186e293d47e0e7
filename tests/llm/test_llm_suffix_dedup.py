import hashlib
import random

import numpy as np
import pytest
from llm_texts import corpus, words

from loglens.llm import suffix_dedup as S


def brute(texts):
    """(n_bytes, n_removed, n_spans, kept_sha256) of every text."""
    raw = [(t or "").encode() for t in texts]
    seen = {}
    for b in raw:
        for i in range(len(b) - S.LENGTH + 1):
            seen[b[i:i + S.LENGTH]] = seen.get(b[i:i + S.LENGTH], 0) + 1
    out = []
    for b in raw:
        gone = bytearray(len(b) + 1)
        for i in range(len(b) - S.LENGTH + 1):
            if seen[b[i:i + S.LENGTH]] > 1:
                gone[i:i + S.LENGTH] = b"\x01" * S.LENGTH
        spans = sum(gone[i] and (i == 0 or not gone[i - 1]) for i in range(len(b)))
        kept = bytes(x for x, g in zip(b, gone, strict=False) if not g)
        out.append((len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def hard_texts():
    rng = random.Random(4)
    shared = " ".join(words(rng, 70))
    texts = corpus(8, 50)
    texts += ["a" * 500, "a" * 199, "b" * 200, "ab" * 300 + "c", "ab" * 150, ("é" * 101) + "x", ("é" * 101) + "y"]
    texts += [" ".join(words(rng, rng.randint(0, 30))) + shared + " ".join(words(rng, rng.randint(0, 30))) for _ in range(20)]
    texts += [shared[:300] + "X" + shared[301:], shared[5:260], shared[:200], shared[1:201]]
    return texts


def result(df):
    return sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect())


@pytest.mark.parametrize("hot,block", [(1000, 1 << 20), (1, 2000)])
def test_equals_brute_force(docs, hot, block):
    # The second run treats every anchor of two blocks as hot, over many small blocks.
    texts = hard_texts()
    got = result(S.dedup_bytes(docs(texts), parts=5, block_bytes=block, hot_blocks=hot))
    assert got == [(i, *row) for i, row in enumerate(brute(texts))]


def test_spans_are_the_removed_bytes(docs):
    texts = ["x" * 10 + "".join(map(chr, range(33, 120))) * 3, "".join(map(chr, range(33, 120))) * 3 + "tail"]
    rows = {r.doc_id: r for r in S.dedup_bytes(docs(texts)).collect()}
    assert [tuple(s) for s in rows[0].spans] == [(10, 271)]
    assert [tuple(s) for s in rows[1].spans] == [(0, 261)]


def test_query_equals_its_sql(docs, table_dir, twin):
    ours, theirs = twin(S, "op2_suffix_dedup", table_dir(documents=docs([t for t in hard_texts() if len(t or "") < 3000])))
    assert ours == theirs


def test_repeated_rows_clashing_columns_and_empty_table(spark, docs):
    text = "0123456789" * 25
    df = spark.createDataFrame([(1, text, "b"), (1, text, "c"), (None, "short", "d")], "doc_id long, text string, block string")
    got = sorted((str(r.doc_id), r.n_removed) for r in S.dedup_bytes(df).collect())
    assert got == [("1", 250), ("1", 250), ("None", 0)]
    assert S.dedup_bytes(docs([])).collect() == []


def test_cover_is_a_difference_cover():
    assert {(a - b) % S.PERIOD for a in S.COVER for b in S.COVER} == set(range(S.PERIOD))


def test_sorting_finds_equal_windows_of_different_stretches():
    rng = np.random.default_rng(3)
    core = rng.integers(97, 100, 260).astype(np.uint8)
    pieces, left, windows = [], [], []
    for cut in (0, 7, 20, 40):
        p = core[cut:cut + 230].copy()
        if cut == 20:
            p[150] = 1
        pieces.append(p)
        left.append(100 - cut)
        windows.append(len(p) - S.LENGTH + 1)
    buf = np.concatenate(pieces)
    starts = np.cumsum([0] + [len(p) for p in pieces[:-1]])
    got = S.repeated_windows(buf, starts, np.array(windows), np.array(left), np.zeros(4, np.uint64))
    at, want = [], []
    for s, p in enumerate(pieces):
        for i in range(windows[s]):
            at.append((100 - left[s] + i, p[i:i + S.LENGTH].tobytes()))
    want = [at.count(x) > 1 for x in at]
    assert got.tolist() == want
