import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from llm_texts import corpus, rows_of

from loglens.llm import packing as P
from loglens.llm import text as T

public_tokenizers = pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(public_tokenizers.path(P.TOKENIZER))


def texts():
    rng = random.Random(5)
    return [*corpus(2, 40), " ".join(str(rng.random()) for _ in range(1500))]


def expected(tokenizer, texts):
    out = []
    for i, t in enumerate(texts):
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0]
        at = piece = 0
        while at < len(ids):
            n = (len(ids) - at) % 2048 or 2048
            out.append((i, piece, at, n, zlib.crc32(np.array(ids[at:at + n], "<u4").tobytes())))
            at, piece = at + n, piece + 1
    return sorted(out)


def test_pieces_and_places(docs, tokenizer):
    rows = P.pack_documents(docs(texts()), with_ids=True).collect()
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == expected(tokenizer, texts())
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= P.CAPACITY
    least = -(-sum(r.length for r in rows) // P.CAPACITY)
    assert len(by_sequence) <= least + 2


def test_sequences_hold_the_documents_ids(docs, tokenizer):
    packed = P.pack_documents(docs(["one two", "three"]), with_ids=True)
    (row,) = P.sequences(packed).collect()
    ids = np.frombuffer(row.ids, "<u4").tolist()
    parts = [[*tokenizer.encode(t, add_special_tokens=False).ids, 0] for t in ("one two", "three")]
    assert ids in (parts[0] + parts[1], parts[1] + parts[0])


def test_chunked_encoding_equals_the_tokenizer(tokenizer):
    rng = random.Random(1)
    letters = [*"ab'sZé ß  \n\n\t\r\x0b\x0c1239.,!?-_’　\x1c\x85 日本tllré🙂\x00", "<|endoftext|>", "'ll", " "]
    some = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 40))) for _ in range(3000)] + [None, "", " ", "\n", "  \n  "]
    enc = P.Encoder(public_tokenizers.path(P.TOKENIZER))
    for a, b, buf, offsets in T.slices(pa.array(some), 1 << 14):
        ids, bounds = enc.encode(buf, offsets)
        for i in range(b - a):
            want = [*tokenizer.encode(some[a + i] or "", add_special_tokens=False).ids, 0]
            assert ids[bounds[i]:bounds[i + 1]].tolist() == want


def test_cache_is_bounded(monkeypatch, tokenizer):
    monkeypatch.setattr(P, "CACHE_CHUNKS", 10)
    enc = P.Encoder(public_tokenizers.path(P.TOKENIZER))
    for text in ("a b c d e f g h i j k l m n", "n m l k", "a z"):
        buf = np.frombuffer(text.encode(), np.uint8)
        ids, _ = enc.encode(buf, np.array([0, len(buf)]))
        assert ids.tolist() == [*tokenizer.encode(text, add_special_tokens=False).ids, 0]
    assert len(enc.rows) <= 10 + 4


class Plain:
    """Bounded best-fit by scanning all open bins."""

    def __init__(self, capacity, most):
        self.capacity, self.most, self.open, self.made = capacity, most, [], 0

    def place(self, size):
        fits = [(free, n) for n, free in self.open if free >= size]
        if fits:
            best = min(f for f, _ in fits)
            n = [n for n, free in self.open if free == best][-1]
            self.open = [(m, f) for m, f in self.open if m != n]
            free = best
        else:
            n, free = self.made, self.capacity
            self.made += 1
            if free > size and len(self.open) == self.most:
                least = min(f for _, f in self.open)
                full = [m for m, f in self.open if f == least][-1]
                self.open = [(m, f) for m, f in self.open if m != full]
        if free > size:
            self.open.append((n, free - size))
        return n, self.capacity - free


@pytest.mark.parametrize("most", [1, 3, 50])
def test_best_fit_equals_a_plain_scan(most):
    rng = random.Random(most)
    fast, plain = P.BestFit(100, most), Plain(100, most)
    for _ in range(2000):
        size = rng.randint(1, 100)
        assert fast.place(size) == plain.place(size)
        assert fast.open <= most


def test_repeated_rows_clashing_columns_and_empty_table(spark, docs):
    df = spark.createDataFrame([(1, "a", 5), (1, "a", 6), (None, None, 7)], "doc_id long, text string, piece int")
    rows = P.pack_documents(df).collect()
    assert sorted((str(r.doc_id), r.piece, r.length) for r in rows) == [("1", 0, 2), ("1", 0, 2), ("None", 0, 1)]
    assert len({(r.sequence_id, r.offset) for r in rows}) == 3
    assert P.pack_documents(docs([])).collect() == []


def test_query_reads_the_table(spark, docs, table_dir, tokenizer):
    folder = table_dir(documents=docs(rows_of(["x y", None])))
    got = P.QUERIES["op8_best_fit_packing"](spark, folder).drop("sequence_id", "offset").collect()
    assert sorted(tuple(r) for r in got) == expected(tokenizer, ["x y", None])
