import hashlib
import random
import zlib

import numpy as np
import pytest
from llm_texts import corpus, words

from loglens.llm import repeats as R


def brute_runs(w, least=R.LEAST):
    """All runs by trying every period at every stretch of equal words."""
    out = []
    for q in range(1, len(w) // 4 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            start, end = i, j + q
            if j > i and end - start >= max(least, 4 * q):
                piece = w[start:end]
                if not any(all(piece[k] == piece[k + r] for k in range(len(piece) - r)) for r in range(1, q)):
                    out.append((start, end - start, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def brute_collapsed(w, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def planted(doc_id, w):
    h = zlib.crc32(str(doc_id).encode())
    n, g = len(w), h // 10
    if h % 10 or not n:
        return w
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]


def periodic(rng, units):
    """Random words with stretches of repeated units in them, also of few different words."""
    out = []
    for _ in range(rng.randint(1, 4)):
        out += words(rng, rng.randint(0, 30))
        unit = [rng.choice("ab") if rng.random() < 0.5 else rng.choice(units) for _ in range(rng.choice([1, 1, 2, 3, 4, 5, 7, 8, 9, 16, 31]))]
        out += unit * rng.randint(2, 9) + unit[:rng.randint(0, len(unit))]
    return out


def texts():
    rng = random.Random(3)
    units = words(rng, 12)
    many = [" ".join(periodic(rng, units)) for _ in range(120)]
    few = [" ".join(rng.choice("ab") for _ in range(rng.randint(0, 60))) for _ in range(120)]
    lines = ["a", "a a a a a", "a a a a a a", "b a a a a a a c", "A a A a A a A a", "x\t" * 40, "one two\x0bone\ftwo one two\rone two",
             " ".join(["aa b"] * 200 + ["aa c"] * 200), "é   é   é   é  "]
    return corpus(4, 60) + many + few + lines


def test_convolution_finds_every_occurrence():
    rng = np.random.default_rng(1)
    for size in (1, 2, 4, 8, 32, 128):
        x = rng.integers(1, 3 if size < 16 else 2, 40 * size).astype(np.uint64)
        x[rng.integers(0, len(x), 3 * size)] = 7
        x = np.concatenate([x, np.zeros(3 * size, np.uint64)])
        at = np.arange(0, 40 * size, size)
        p, d = R.block_matches(x, at, size)
        want = {(int(b), g) for b in at for g in range(size, 2 * size) if (x[b:b + size] == x[b + g:b + g + size]).all()}
        assert set(zip(p.tolist(), d.tolist(), strict=True)) == want


def test_transform_is_exact():
    rng = np.random.default_rng(2)
    a = rng.integers(0, R.PRIME, (64, 3)).astype(np.uint64)
    back = R._transform(R._transform(a.copy()), inverse=True)
    assert (back.astype(object) == a.astype(object) * 64 % R.PRIME).all()


def test_runs_and_collapsed_texts_equal_brute_force(docs):
    all_texts = texts()
    rows = {r.doc_id: r for r in R.periodic_runs(docs(all_texts)).collect()}
    assert len(rows) == len(all_texts)
    total = 0
    for i, t in enumerate(all_texts):
        w = (t or "").encode().split()
        w = [x.decode() for x in w]
        runs = brute_runs(w) if len(w) < 3000 else None
        if runs is None:
            continue
        total += len(runs)
        assert [tuple(r) for r in rows[i].runs] == runs, t
        assert rows[i].collapsed == brute_collapsed(w, runs)
    assert total > 200


def test_random_words_of_a_small_alphabet():
    rng = random.Random(8)
    for _ in range(300):
        w = periodic(rng, ["a", "b", "c"])
        hashes = np.array([hash(x) & 0xFFFF for x in w], dtype=np.uint64)
        s, e, q = R.find_runs(hashes, np.array([0, len(w)]))
        assert list(zip(s.tolist(), (e - s).tolist(), q.tolist(), strict=True)) == brute_runs(w), w


def test_one_long_text():
    rng = random.Random(9)
    unit = words(rng, 7000)
    w = words(rng, 1000) + unit * 5 + unit[:100] + ["zz"] * 50
    hashes = np.array([zlib.crc32(x.encode()) for x in w], dtype=np.uint64)
    s, e, q = R.find_runs(hashes, np.array([0, len(w)]))
    assert (1000, 7000) in {(int(a), int(p)) for a, p in zip(s, q, strict=True)} and (len(w) - 50, 1) in {(int(a), int(p)) for a, p in zip(s, q, strict=True)}


def test_query_equals_brute_force(spark, docs, table_dir):
    all_texts = texts()
    folder = table_dir(documents=docs(all_texts))
    rows = {r.doc_id: r for r in R.op12_periodic_runs(spark, folder).collect()}
    seen = 0
    for i, t in enumerate(all_texts):
        w = planted(i, [x.decode() for x in (t or "").encode().split()])
        if len(w) > 3000:
            continue
        runs = brute_runs(w)
        r = rows[i]
        assert r.n_runs == len(runs)
        best = min(runs, key=lambda x: (-x[1], x[0], x[2]), default=None)
        assert (r.start, r.length, r.period) == ((best[0], best[1], best[2]) if best else (None, None, None))
        assert r.exponent_milli == (1000 * best[1] // best[2] if best else None)
        assert r.runs_sha256 == hashlib.sha256("".join(f"{a},{b},{c}\n" for a, b, c in runs).encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(brute_collapsed(w, runs).encode()).hexdigest()
        seen += bool(best) and zlib.crc32(str(i).encode()) % 10 == 0
    assert seen > 5


@pytest.mark.parametrize("rows", [[], [(None, None)], [(None, "a " * 9), (1, ""), (1, ""), (2, None)]])
def test_nulls_repeats_and_empty_tables(spark, table_dir, rows):
    df = spark.createDataFrame([(a, b, 1, "x") for a, b in rows], "doc_id long, text string, runs int, start string")
    out = R.periodic_runs(df).collect()
    assert sorted(str(r.doc_id) for r in out) == sorted(str(a) for a, _ in rows)
    assert [r.collapsed for r in out if r.runs] == ["a"] * sum("a" in (b or "") for _, b in rows)
    got = R.op12_periodic_runs(spark, table_dir(documents=df)).collect()
    assert len(got) == len(rows)
    empty = hashlib.sha256(b"").hexdigest()
    assert all(r.start is None and r.collapsed_sha256 == empty for r in got if r.n_runs == 0)
