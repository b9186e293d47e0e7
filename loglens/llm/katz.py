"""Katz backoff language model of any order over add-one unigrams.

    P(w | h) = d[c] * c / C(h)           for an n-gram h w seen c > 0 times in training
    P(w | h) = alpha(h) * P(w | h')      otherwise; h' is h without its first word
    P(w)     = (c(w) + 1) / (N + V + 1)

d are each order's Good-Turing discounts for counts up to ``MOST_DISCOUNTED``;
alpha(h) is the mass freed in h over the mass that h' leaves to the words not
seen after h, from exact integer sums, so every context's probabilities sum to
1 over the V known words and one unknown class. A context without any
discounted count frees 1 / (C + 1). A text is its lower-cased words and one
end token; the first word follows a start symbol, and no context reaches
beyond it.

How it is spread. Documents are packed into blocks (a few MB of text as
indices into the block's own sorted word list), written once. A block sends
each of its distinct words once, with its training count, to the part its
hash falls in; the part answers with the word's number and total. It then
does the same with its distinct word pairs; the parts sum up the model's
counts, partitioned, and their answers are stored. As a block sends a key
only once, a word on every line costs a part one entry per block. Pairs go to
the part of their first word, so that a part can sum up the context; words
with over 1/``HOT_SHARE`` of all tokens (at most ``HOT_SHARE`` of them, so
their table is of bounded size) are split into ``HOT_SPLIT`` parts by the
second word, and their partial sums are added up afterwards.

Each further order is one more such exchange, of (context number, word) keys:
a part numbers the n-grams it holds, and a block reads the contexts of the
next order off the answers. An n-gram that only one block has is not numbered:
all that follows it stands in that block, which counts it by itself and sends
only its counts of counts. What a block needs of the model is in its answers:
word lists and the parts' own sums are deleted as soon as they are used.

Blocks and their answers are the bulk of the disk, and a join by block holds
them once more in shuffle files. With over ``STAGED_TOKENS`` training tokens
orders from 3 on and the scores are therefore made of one of ``SLOTS`` shares
of the blocks after the other, and the parts answer in ``SHARES`` shares, each
of which deletes the messages it has read. The steps and rows are the same.

A task holds the arrays of one block or part, and they are its worker's largest
use of memory: contexts' sums keep the narrow types they are sent in, ``CONTEXTS``
of them at a time are made wide, what an order needs of its own is gone before the
next, and a worker hands freed memory back when its task or part is done.

Defined results: null and empty texts are one end token; rows are scored one
by one, repeated or not; a row without doc_id counts as training. A word
unseen in training has the unknown class's probability after every context;
after an unseen context all words have their unigram probability. More than
2**32 - 2 distinct words raise an error. Other columns are ignored. Empty in,
empty out.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from contextlib import suppress
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loglens.llm import text as T
from loglens.llm.store import dropped, shuffles_deleted, small_batches, stored

BLOCK_BYTES = 4 << 20
MOST_DISCOUNTED = 5
HOT_SHARE = 10_000
HOT_SPLIT = 64
UNKNOWN, START, FIRST_WORD = 0, 1, 2
END_HASH = np.uint64(0x5851F42D4C957F2D)
LOCAL = np.uint64(1 << 63)      # numbers from here on are a block's own
ORDER = 3                # of the registered query
MODEL = -1               # "block" of the rows that hold the model's own tables
STAGED_TOKENS = 1 << 26
SLOTS = 3                # shares of the blocks
SHARES = 2               # shares of the parts
CONTEXTS = 1 << 15       # contexts whose sums are wide at a time


# --- packed arrays --------------------------------------------------------

def _narrow(a: np.ndarray) -> np.ndarray:
    if a.dtype == np.bool_:
        return a
    return a.astype(np.min_scalar_type(int(a.max())) if len(a) else np.uint8)


def pack(*arrays: np.ndarray) -> bytes:
    """Non-negative integer arrays, each in the narrowest type and by byte planes, compressed."""
    out = [np.array([len(arrays)], dtype=np.int64).tobytes()]
    for a in arrays:
        a = np.ascontiguousarray(_narrow(np.asarray(a)))
        kind = a.dtype if a.dtype == np.bool_ else np.dtype(f"u{a.dtype.itemsize}")
        planes = a.view(np.uint8).reshape(len(a), a.dtype.itemsize).T
        out += [np.array([len(a), kind.itemsize, kind == np.bool_], dtype=np.int64).tobytes(), planes.tobytes()]
    return zstandard.compress(b"".join(out), 3)


def unpack(blob: bytes) -> list[np.ndarray]:
    raw = zstandard.decompress(blob)
    at, out = 8, []
    for _ in range(int(np.frombuffer(raw, np.int64, 1)[0])):
        n, width, flag = np.frombuffer(raw, np.int64, 3, at).tolist()
        planes = np.frombuffer(raw, np.uint8, n * width, at + 24).reshape(width, n)
        out.append(np.ascontiguousarray(planes.T).reshape(-1).view(np.bool_ if flag else np.dtype(f"u{width}")))
        at += 24 + n * width
    return out


def _distinct(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct values, a place of each (any) and each element's value's index: ``np.unique`` without a stable sort."""
    order = np.argsort(a)
    ordered = a[order]
    new = np.ones(len(a), dtype=bool)
    np.not_equal(ordered[1:], ordered[:-1], out=new[1:])
    index = np.empty(len(a), dtype=np.int64)
    index[order] = np.cumsum(new) - 1
    return ordered[new], order[new], index


def _handed_back() -> None:
    """Give the system what was freed: workers stay, and would hold one step's arrays beside the next one's."""
    pa.default_memory_pool().release_unused()
    with suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)  # of glibc


def _runs(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values of a sorted array, and how often each comes."""
    starts = np.flatnonzero(np.concatenate([np.ones(min(len(a), 1), dtype=bool), a[1:] != a[:-1]]))
    return a[starts], np.diff(starts, append=len(a))


# --- blocks ---------------------------------------------------------------

def make_blocks(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` (doc_id, text, train) as blocks: ``ids`` of the documents, ``words`` (sorted distinct hashes),
    ``counts`` (their training counts) and ``body`` (per document train and length, per word its index)."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, made = TaskContext.get().partitionId(), 0
        held: list[tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]] = []
        size = 0

        def flush() -> pa.RecordBatch:
            nonlocal made, held, size
            ids = pa.concat_arrays([h[0] for h in held])
            train = np.concatenate([h[1] for h in held])
            lengths = np.concatenate([h[2] for h in held])
            words, index = np.unique(np.concatenate([*[h[3] for h in held], [END_HASH]]), return_inverse=True)
            of_train = np.repeat(train, lengths)
            counts = np.bincount(index[:-1][of_train], minlength=len(words))
            counts[index[-1]] += int(train.sum())
            row = [pa.array([(task << 32) + made], pa.int64()), pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
                   pa.array([words.tobytes()], pa.binary()), pa.array([pack(counts)], pa.binary()),
                   pa.array([pack(train, lengths, index)], pa.binary())]
            made, held, size = made + 1, [], 0
            return pa.RecordBatch.from_arrays(row, names=["block", "ids", "words", "counts", "body"])

        for batch in batches:
            train = batch.column(2).to_numpy(zero_copy_only=False).astype(bool)
            for a, b, buf, offsets in T.slices(batch.column(1)):
                words, first = T.word_hashes(buf, offsets)
                held.append((batch.column(0).slice(a, b - a), train[a:b], np.diff(first), words))
                size += len(buf) + 64 * (b - a)
                if size >= block_bytes:
                    yield flush()
        if held:
            yield flush()
        _handed_back()

    return docs.select("doc_id", "text", "train").mapInArrow(
        run, f"block long, ids array<{kind}>, words binary, counts binary, body binary")


def _part_bounds(words: np.ndarray, parts: int) -> np.ndarray:
    """Where the parts' ranges of hashes begin in a sorted list of hashes (and its end)."""
    step = (1 << 64) // parts + 1
    return np.searchsorted(words, np.array([min(i * step, (1 << 64) - 1) for i in range(parts)], dtype=np.uint64)).tolist() + [len(words)]


# --- numbers --------------------------------------------------------------

def _steps(rank: np.ndarray) -> np.ndarray:
    """Ranks, rising but for the 0 of what has none, as differences: the narrower, the more keys a block has of the part's."""
    step = np.zeros(len(rank), dtype=np.int64)
    step[rank > 0] = np.diff(rank[rank > 0], prepend=0)
    return step


def _numbers(step: np.ndarray, part: int, parts: int) -> np.ndarray:
    """The numbers that a part gives to the ranks behind ``step``."""
    r = np.cumsum(step, dtype=np.uint64)
    return np.where(step > 0, np.uint64(FIRST_WORD + part) + np.uint64(parts) * (r - np.uint64(1)), np.uint64(UNKNOWN))


# --- unigrams -------------------------------------------------------------

def _word_messages(blocks: DataFrame, parts: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, words, counts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                keys, n = np.frombuffer(words, np.uint64), unpack(counts)[0]
                at = _part_bounds(keys, parts)
                used = [p for p in range(parts) if at[p + 1] > at[p]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(used, pa.int32()), pa.array([block] * len(used), pa.int64()),
                     pa.array([keys[at[p]:at[p + 1]].tobytes() for p in used], pa.binary()),
                     pa.array([pack(n[at[p]:at[p + 1]]) for p in used], pa.binary())], names=["part", "block", "words", "counts"])

    return blocks.select("block", "words", "counts").mapInArrow(run, "part int, block long, words binary, counts binary")


def _word_answers(messages: DataFrame, parts: int) -> DataFrame:
    """Per (block, part): numbers and totals of the block's words; per part the unigram table."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        part = int(pdf["part"].iloc[0])
        keys = [np.frombuffer(w, np.uint64) for w in pdf["words"]]
        words, index = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.zeros(len(words), dtype=np.int64)
        np.add.at(total, index, np.concatenate([unpack(c)[0] for c in pdf["counts"]]).astype(np.int64))
        known = total > 0
        rank = np.where(known, np.cumsum(known), 0)
        if FIRST_WORD + part + parts * (int(known.sum()) - 1) >= 1 << 32:
            raise ValueError("more than 2**32 - 2 distinct words")
        out, at = [(MODEL, part, int(total.sum()), int(known.sum()), pack(words[known], total[known]))], 0
        for block, k in zip(pdf["block"], keys, strict=True):
            own = index[at:at + len(k)]
            at += len(k)
            out.append((block, part, 0, 0, pack(_steps(rank[own]), total[own])))
        return pd.DataFrame(out, columns=["block", "part", "tokens", "types", "answer"])

    def let_go(pdf: pd.DataFrame) -> pd.DataFrame:
        out = run(pdf)
        _handed_back()
        return out

    return messages.groupBy("part").applyInPandas(let_go, "block long, part int, tokens long, types long, answer binary")


# --- n-grams --------------------------------------------------------------

class Level:
    """The distinct n-grams of a block at one order, as (context number, word) keys.

    Per token of the block: ``ctx`` is the place of its context in ``numbers`` (whose ``UNKNOWN`` ones are not looked up;
    the others differ), ``ctx_count`` that context's training count, ``low`` the count of the token's n-gram one order below."""

    def __init__(self, order: int, ctx: np.ndarray, numbers: np.ndarray, ctx_count: np.ndarray, low: np.ndarray, w: np.ndarray, train: np.ndarray,
                 n: int, parts: int, hot_share: int):
        self.order_n, self.parts = order, parts
        # An unknown last word is asked for too, as its context's sums are needed.
        by_number = np.argsort(numbers)
        names = numbers[by_number]
        index = np.empty(len(numbers), dtype=np.uint64)
        index[by_number] = np.arange(len(numbers), dtype=np.uint64)
        del by_number
        self.known = numbers[ctx] != UNKNOWN
        everywhere = bool(self.known.all())
        of = (lambda a: a) if everywhere else (lambda a: a[self.known])
        keys = index[of(ctx)]
        del index
        keys <<= np.uint64(32)
        keys |= of(w).astype(np.uint64)
        # Of a key's tokens any will do: all have the same counts of its context and of the order below.
        keys, self.first, self.inverse = _distinct(keys)
        self.h, self.w = names[keys >> np.uint64(32)], keys & np.uint64(0xFFFFFFFF)
        self.counts = np.bincount(self.inverse[of(train)], minlength=len(keys))
        self.low = of(low)[self.first]
        split = np.where(of(ctx_count)[self.first] * hot_share > n, self.w % np.uint64(HOT_SPLIT) + np.uint64(1), np.uint64(0)).astype(np.uint64)
        part = (T.mix(self.h * np.uint64(HOT_SPLIT + 1) + split) % np.uint64(parts)).astype(np.int64)
        part[self.h >= LOCAL] = parts
        self.order = np.argsort(part.astype(np.min_scalar_type(parts)), kind="stable")
        self.at = np.searchsorted(part[self.order], np.arange(parts + 2))

    def own(self, part: int) -> np.ndarray:
        return self.order[self.at[part]:self.at[part + 1]]

    def message(self, part: int) -> bytes:
        own = self.own(part)
        h, runs = _runs(self.h[own])
        w, first, index = _distinct(self.w[own])
        zero = np.uint64(0)
        # Below a bigram is its word; of longer ones only the seen n-grams' counts are needed.
        low = self.low[own][first] if self.order_n == 2 else np.where(self.counts[own] > 0, self.low[own], 0)
        return pack(np.diff(h, prepend=zero), runs, np.diff(w, prepend=zero), low, index, self.counts[own])

    def local_counts(self) -> np.ndarray:
        """Counts of counts of the n-grams that are not exchanged."""
        return _of_counts(self.counts[self.own(self.parts)])

    def read(self, answers: list) -> tuple[np.ndarray, np.ndarray]:
        """Per key its training count and number (if the parts sent numbers)."""
        count, number = np.zeros(len(self.h), dtype=np.int64), np.zeros(len(self.h), dtype=np.uint64)
        for a in answers:
            own = self.own(a["part"])
            total, rank = unpack(a["answer"])
            count[own] = total
            if len(rank):
                number[own] = _numbers(rank, a["part"], self.parts)
        own = self.own(self.parts)
        count[own] = self.counts[own]
        alone = (count > 0) & (number == UNKNOWN)
        number[alone] = LOCAL | np.flatnonzero(alone).astype(np.uint64)
        return count, number

    def contexts(self, answers: list, count: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        """The contexts and their sums, in narrow types; ``count`` as ``read`` returns it."""
        names, columns = [np.zeros(0, np.uint64)], [[np.zeros(0, np.uint8)] * _width(self.order_n)]
        for a in answers:
            names.append(_runs(self.h[self.own(a["part"])])[0])
            columns.append(unpack(a["sums"]))
        own = self.own(self.parts)
        if len(own):
            h, index = np.unique(self.h[own], return_inverse=True)
            seen = count[own] > 0
            found, sums = _context_sums(index[seen], count[own][seen], self.low[own][seen], self.order_n)
            names.append(h)
            columns.append([_spread(c, found, len(h)) for c in sums])
        return np.concatenate(names), [np.concatenate(c) for c in zip(*columns, strict=True)]


def _spread(values: np.ndarray, places: np.ndarray, n: int) -> np.ndarray:
    out = np.zeros(n, dtype=values.dtype)
    out[places] = values
    return out


class Block:
    """A block with its words' numbers and totals: its tokens, and from order 2 on its n-grams."""

    def __init__(self, body: bytes, answers: list, n: int, parts: int, hot_share: int):
        self.train, self.lengths, index = unpack(body)
        self.train = self.train.astype(bool)
        answers = sorted(answers, key=lambda a: a["part"])
        unpacked = [unpack(a["answer"]) for a in answers]
        number = np.concatenate([_numbers(u[0], a["part"], parts).astype(np.int64) for a, u in zip(answers, unpacked, strict=True)])
        total = np.concatenate([u[1].astype(np.int64) for u in unpacked])
        self.bounds = np.concatenate([[0], np.cumsum(self.lengths.astype(np.int64) + 1)])
        ends = self.bounds[1:] - 1
        place = np.ones(self.bounds[-1], dtype=bool)
        place[ends] = False
        self.w = np.empty(self.bounds[-1], dtype=np.int64)
        self.w_count = np.empty_like(self.w)
        for into, source in ((self.w, number), (self.w_count, total)):
            into[place], into[ends] = source[index[:-1]], source[index[-1]]
        self.train_token = np.repeat(self.train, self.lengths.astype(np.int64) + 1)
        self.spread = (n, parts, hot_share)
        # Places of the contexts: the block's words, all unknown ones as one, and the start symbol.
        numbers = np.concatenate([number[number != UNKNOWN], [UNKNOWN, START]]).astype(np.uint64)
        known = number != UNKNOWN
        places = np.where(known, np.cumsum(known) - 1, len(numbers) - 2)
        words = np.empty_like(self.w)
        words[place], words[ends] = places[index[:-1]], places[index[-1]]
        ctx_count = self.before(self.w_count, self.w_count[ends[0]] if len(ends) else 0)
        self.level = Level(2, self.before(words, len(numbers) - 1), numbers, ctx_count, self.w_count, self.w, self.train_token, *self.spread)

    def before(self, values: np.ndarray, first: int) -> np.ndarray:
        """Each token's predecessor's value, ``first`` for a text's first token."""
        out = np.empty_like(values)
        out[1:] = values[:-1]
        out[self.bounds[:-1]] = first
        return out

    def climb(self, count: np.ndarray, number: np.ndarray) -> None:
        """Go on to the next order, with what ``read`` returned of this one."""
        order, known, inverse = self.level.order_n + 1, self.level.known, self.level.inverse
        self.level = None
        # Of n-grams without a number, and for tokens without one, the last place is there.
        places, low = np.full(len(self.w), len(number), dtype=np.int64), np.zeros(len(self.w), np.int64)
        places[known], low[known] = inverse, count[inverse]
        del known, inverse
        numbers = np.append(number, np.uint64(UNKNOWN))
        places = self.before(places, len(number))
        self.level = Level(order, places, numbers, self.before(low, 0), low, self.w, self.train_token, *self.spread)


_ANSWERS = "collect_list(struct({})) AS {}"


def _halves(blocks: DataFrame) -> DataFrame:
    """Each block as two rows: its word list, that only the unigrams need, and what all orders read."""
    rows = blocks.withColumn("half", F.explode(F.array(F.lit("words"), F.lit("body"))))
    of = {"ids": "body", "body": "body", "words": "words", "counts": "words"}
    return rows.select("block", *[F.when(F.col("half") == half, F.col(c)).alias(c) for c, half in of.items()], "half")


def _by_use(answers: DataFrame) -> DataFrame:
    """The answers with ``of_model``: whether a row holds a part's own tables, for no block."""
    return answers.withColumn("of_model", F.col("block") == MODEL)


def _collected(answers: DataFrame, name: str, columns: str = "part, answer") -> DataFrame:
    """(block, ``name``): each block's answers, one per part, so a block's list is as bounded as the block."""
    return answers.where(~F.col("of_model")).groupBy("block").agg(F.expr(_ANSWERS.format(columns, name)))


def _blocks_with(blocks: DataFrame, answers: DataFrame, name: str) -> DataFrame:
    """Each block with its answers."""
    return blocks.join(_collected(answers, name), "block")


def _of_slot(rows: DataFrame, slot: int | None) -> DataFrame:
    """The rows of one of ``SLOTS`` shares of the blocks, or of all."""
    return rows if slot is None else rows.where(F.pmod(F.xxhash64("block"), F.lit(SLOTS)) == slot)


def _met(blocks: DataFrame, words: DataFrame, grams: list[DataFrame], slot: int | None, sums: bool = False) -> DataFrame:
    """Each block (of a share) with its answers of all orders so far. Only the scores need the contexts' ``sums``."""
    met = _blocks_with(_of_slot(blocks, slot), _of_slot(words, slot), "words_known")
    for k, answers in enumerate(grams, 2):
        met = met.join(_collected(_of_slot(answers, slot), f"known_{k}", "part, answer" + ", sums" * sums), "block", "left")
    return met


def _known(order: int) -> list[str]:
    """Columns of the answers a block needs for its n-grams of this order."""
    return ["words_known", *[f"known_{k}" for k in range(2, order)]]


def _messages(met: DataFrame, order: int, n: int, parts: int, hot_share: int) -> DataFrame:
    # A call for each block: what it made is let go of before the next one begins.
    def sent(block: int, body: bytes, words: list, *answers: list) -> pa.RecordBatch:
        b = Block(body, words, n, parts, hot_share)
        for known in answers:
            b.climb(*b.level.read(known or []))
        level = b.level
        used = [p for p in range(parts) if level.at[p + 1] > level.at[p]]
        rows = [(p, level.message(p), None) for p in used]
        if level.at[parts + 1] > level.at[parts]:
            rows.append((block % parts, None, pack(level.local_counts())))
        return pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.int32()), pa.array([block] * len(rows), pa.int64()),
             pa.array([r[1] for r in rows], pa.binary()), pa.array([r[2] for r in rows], pa.binary())],
            names=["part", "block", "message", "local"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                yield sent(*(c[i].as_py() for c in batch.columns))
        _handed_back()

    return met.select("block", "body", *_known(order)).mapInArrow(run, "part int, block long, message binary, local binary")


def _staged_messages(blocks: DataFrame, words: DataFrame, grams: list[DataFrame], order: int, n: int, parts: int,
                     hot_share: int) -> list[DataFrame]:
    """The messages stored by ``share`` of the parts, a table per share of the blocks."""
    return [stored(_messages(_met(blocks, words, grams, slot), order, n, parts, hot_share).withColumn("share", F.pmod("part", F.lit(SHARES))),
                   f"katz-{order}-messages", "share") for slot in range(SLOTS)]


def _of_counts(total: np.ndarray) -> np.ndarray:
    return np.bincount(np.minimum(total, MOST_DISCOUNTED + 2), minlength=MOST_DISCOUNTED + 3)


def _width(order: int) -> int:
    """Number of a context's sums: its counts, and what the order below says of its words."""
    return MOST_DISCOUNTED + 2 if order == 2 else 2 * (MOST_DISCOUNTED + 1)


def _by_count(counts: np.ndarray) -> list[np.ndarray]:
    return [*[counts == r for r in range(1, MOST_DISCOUNTED + 1)], np.where(counts > MOST_DISCOUNTED, counts, 0)]


def _context_sums(h: np.ndarray, counts: np.ndarray, low: np.ndarray, order: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Contexts (sorted) of seen n-grams with: n-grams of count 1..k and total of larger counts; then of the
    bigrams' words the sum of c(w) + 1, of longer n-grams the same numbers of their counts one order below."""
    names, starts = np.unique(h, return_index=True)
    columns = _by_count(counts) + ([low + 1] if order == 2 else _by_count(low))
    return names, [_narrow(np.add.reduceat(c.astype(np.int64), starts)) if len(starts) else np.zeros(0, np.uint8) for c in columns]


def _answers(messages: DataFrame, order: int, last: bool, n: int, parts: int, hot_share: int) -> DataFrame:
    """Per (block, part): counts of the block's n-grams, unless ``last`` their numbers, and the sums of their
    contexts; per part counts of counts, numbers of hot n-grams and sums."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        out = _part_answers(pdf, order, last, n, parts, hot_share)
        _handed_back()
        return out

    return messages.groupBy("part").applyInPandas(run, "block long, part int, answer binary, sums binary")


def _part_answers(pdf: pd.DataFrame, order: int, last: bool, n: int, parts: int, hot_share: int) -> pd.DataFrame:
    """A part's answers to its messages."""
    part = int(pdf["part"].iloc[0])
    of_counts = np.zeros(MOST_DISCOUNTED + 3, dtype=np.int64)
    for blob in pdf["local"].dropna():
        of_counts += unpack(blob)[0]
    pdf = pdf[pdf["message"].notna()]
    # Each list goes as soon as it is one array; counts stay in the narrow types they were sent in.
    hs, (times, ws, lows, counts), asked = [np.zeros(0, np.uint64)], ([np.zeros(0, np.uint8)] for _ in range(4)), []
    for blob in pdf["message"]:
        h, runs, w, low, index, c = unpack(blob)
        h, w = np.cumsum(h, dtype=np.uint64), np.cumsum(w, dtype=np.uint64)
        hs.append(h)
        times.append(runs)
        ws.append(_narrow(w)[index])
        lows.append(low[index] if order == 2 else low)
        counts.append(c)
        asked.append((h, len(index)))
    names, index = np.unique(_joined(hs), return_inverse=True)
    keys = np.repeat(index.astype(np.uint64) << np.uint64(32), _joined(times))
    keys |= _joined(ws).astype(np.uint64)
    grams, index = np.unique(keys, return_inverse=True)
    del keys
    total, low = np.zeros(len(grams), dtype=np.int64), np.zeros(len(grams), dtype=np.int64)
    np.add.at(total, index, _joined(counts).astype(np.int64))
    np.maximum.at(low, index, _joined(lows).astype(np.int64))
    seen = total > 0
    h = names[grams[seen] >> np.uint64(32)]
    del names, grams
    names, sums = _context_sums(h, total[seen], low[seen], order)
    del h, low
    of_counts += _of_counts(total[seen])
    # A block sends a key once: what one block has is not numbered.
    shared = seen & (np.bincount(index, minlength=len(total)) > 1) & (not last)
    rank = np.where(shared, np.cumsum(shared), 0)
    hot = FIRST_WORD + part + parts * (rank[shared & (total * hot_share > n)] - 1)
    out, at = [(MODEL, part, pack(of_counts, hot, names, *sums), None)], 0
    for block, (h, size) in zip(pdf["block"], asked, strict=True):
        own = index[at:at + size]
        at += size
        spot = np.searchsorted(names, h)
        hit = spot < len(names)
        hit[hit] = names[spot[hit]] == h[hit]
        rows = []
        for s in sums:
            v = np.zeros(len(h), dtype=np.int64)
            v[hit] = s[spot[hit]]
            rows.append(v)
        out.append((block, part, pack(total[own], _steps(rank[own]) if not last else np.zeros(0, np.uint8)), pack(*rows)))
    return pd.DataFrame(out, columns=["block", "part", "answer", "sums"])


def _joined(arrays: list[np.ndarray]) -> np.ndarray:
    """The arrays as one; the list is emptied."""
    out = np.concatenate(arrays)
    arrays.clear()
    return out


def _staged_answers(messages: list[DataFrame], order: int, last: bool, n: int, parts: int, hot_share: int) -> DataFrame:
    """All parts' answers to stored messages, one share of the parts after the other; its messages go with it."""
    out = []
    for share in range(SHARES):
        sent = reduce(DataFrame.unionByName, [m.where(F.col("share") == share).drop("share") for m in messages])
        out.append(stored(_by_use(_answers(sent, order, last, n, parts, hot_share)), f"katz-{order}-grams", "of_model"))
        for m in messages:
            dropped(m, f"share={share}")
        _release(sent.sparkSession)
    return reduce(DataFrame.unionByName, out)


def _hot_contexts(answers: DataFrame, hot: list[int], order: int) -> DataFrame:
    """(h, c0..): the sums of the given contexts, and with h = -1 the numbers of n-grams seen 1, 2, .. times."""
    wanted, sums_of = np.array(sorted(hot), dtype=np.int64), [f"c{i}" for i in range(_width(order))]
    names = ["h", *sums_of]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for blob in batch.column(0).to_pylist():
                of_counts, _, h, *sums = unpack(blob)
                use = np.isin(h.astype(np.int64), wanted)
                columns = np.vstack([h[use].astype(np.int64), *[s[use].astype(np.int64) for s in sums]])
                first = np.zeros(len(names), dtype=np.int64)
                first[0], first[1:len(of_counts)] = -1, of_counts[1:]
                columns = np.hstack([first[:, None], columns])
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)

    parts = answers.where("of_model").select("answer").mapInArrow(run, ", ".join(f"{c} long" for c in names))
    return parts.groupBy("h").agg(*[F.sum(c).alias(c) for c in sums_of])


def _hot_grams(answers: DataFrame) -> list[int]:
    """Numbers of the n-grams with over 1/hot_share of all training tokens: at most hot_share."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for blob in batch.column(0).to_pylist():
                yield pa.RecordBatch.from_arrays([pa.array(unpack(blob)[1].astype(np.int64))], names=["number"])

    return [r["number"] for r in answers.where("of_model").select("answer").mapInArrow(run, "number long").collect()]


def discounts(of_counts: list[int]) -> np.ndarray:
    """Good-Turing discounts d[0..k + 1] from the numbers of pairs seen 1, 2, .. k + 1 times: d[r] of count r,
    the last one for all larger counts. Where the estimate is not in (0, 1), half a count is taken off."""
    k = MOST_DISCOUNTED
    n = [0, *of_counts]
    d = np.ones(k + 2)
    tail = (k + 1) * n[k + 1] / n[1] if n[1] else 0.0
    for r in range(1, k + 1):
        value = ((r + 1) * n[r + 1] / (r * n[r]) - tail) / (1 - tail) if n[r] and tail != 1 else 0.0
        d[r] = value if 0 < value < 1 else (r - 0.5) / r
    return d


def _release(spark: SparkSession) -> None:
    """Spark lets go of what finished steps broadcast when the driver's JVM collects their plans."""
    spark.sparkContext._jvm.java.lang.System.gc()


def kept_mass(sums: list[np.ndarray], d: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Total and discounted total of counts given as numbers of 1..k and a total of larger ones."""
    small = np.array(sums[:MOST_DISCOUNTED], dtype=np.float64)
    r, big = np.arange(1, MOST_DISCOUNTED + 1)[:, None], sums[MOST_DISCOUNTED].astype(np.float64)
    return (r * small).sum(axis=0) + big, (d[1:-1, None] * r * small).sum(axis=0) + big


def backoff(sums: list[np.ndarray], d: np.ndarray, below: np.ndarray | int, d_below: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Per context its denominator and its alpha (1 for a context never seen). ``below`` is the denominator one
    order below, whose discounts are ``d_below`` (none for unigrams)."""
    sums = [np.asarray(s).astype(np.int64) for s in sums]
    total, kept = kept_mass(sums, d)
    # Nothing discounted: one more count frees the mass.
    plain = sum(sums[:MOST_DISCOUNTED]) == 0
    total = total + plain
    seen = kept > 0
    free = np.where(seen, (total - kept) / np.where(seen, total, 1), 1)
    taken = sums[-1] if d_below is None else kept_mass(sums[MOST_DISCOUNTED + 1:], d_below)[1]
    rest = (below - np.where(seen, taken, 0)) / below
    return total, free / rest


def _backed_off(level: Level, answers: list, count: np.ndarray, log_p: np.ndarray, below: np.ndarray, d: np.ndarray,
                d_below: np.ndarray | None, hot_h: np.ndarray, hot_sums: list[np.ndarray]) -> None:
    """Take ``log_p``, the tokens' log10 probabilities, and ``below``, their contexts' denominators, up to this order."""
    h, sums = level.contexts(answers, count)
    if not len(h):
        return
    # The parts of a hot context have a share of its sums each; the whole ones replace them.
    h, first, _ = _distinct(h)
    sums = [s[first] for s in sums]
    del first, _
    spot = np.searchsorted(hot_h, h)
    is_hot = spot < len(hot_h)
    is_hot[is_hot] = hot_h[spot[is_hot]] == h[is_hot]
    at = np.searchsorted(h, level.h)
    own_below = np.ones(len(h))
    own_below[at] = below[level.known][level.first]
    total, alpha = np.empty(len(h)), np.empty(len(h))
    for start in range(0, len(h), CONTEXTS):
        some = slice(start, start + CONTEXTS)
        wide = [s[some].astype(np.int64) for s in sums]
        for s, whole in zip(wide, hot_sums, strict=True):
            s[is_hot[some]] = whole[spot[some][is_hot[some]]]
        total[some], alpha[some] = backoff(wide, d, own_below[some], d_below)
    del h, sums, spot, is_hot, own_below
    total, seen = total[at], count > 0
    p = np.where(seen, np.log10(d[np.minimum(count, MOST_DISCOUNTED + 1)] * np.maximum(count, 1) / total), np.log10(alpha[at]))
    log_p[level.known] = p[level.inverse] + np.where(seen[level.inverse], 0, log_p[level.known])
    below[level.known] = total[level.inverse]


def katz_scores(docs: DataFrame, train: Column, parts: int | None = None, block_bytes: int = BLOCK_BYTES,
                hot_share: int = HOT_SHARE, order: int = 2, staged_tokens: int = STAGED_TOKENS) -> DataFrame:
    """Train n-grams up to ``order`` (2 or more) on the rows of ``docs`` (doc_id, text) where ``train`` holds
    and score all rows.

    Returns doc_id, train, n_tokens, n_known, train_tokens, base_score and score (log10)."""
    if order < 2:
        raise ValueError("order must be 2 or more")
    spark = docs.sparkSession
    small_batches(spark)
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select("doc_id", "text", F.coalesce(train, F.lit(True)).alias("train"))
    with shuffles_deleted(spark):
        blocks = stored(_halves(make_blocks(rows, block_bytes)), "katz-blocks", "half")
        words = stored(_by_use(_word_answers(_word_messages(blocks.where("half = 'words'"), parts), parts)), "katz-unigrams", "of_model")
        dropped(blocks, "half=words")
        size = words.where("of_model").agg(F.sum("tokens").alias("n"), F.sum("types").alias("v")).first()
        n, v = size["n"] or 0, size["v"] or 0
        base = n + v + 1
        dropped(words, "of_model=true")
        _release(spark)
        staged = n > staged_tokens
        bodies, answered = blocks.where("half = 'body'").select("block", "ids", "body"), []
        hot = [START, *_hot_words(words, n, parts, hot_share)]
        levels: list[tuple[np.ndarray, np.ndarray, list[np.ndarray]]] = []
        for k in range(2, order + 1):
            if staged and k > 2:
                grams = _staged_answers(_staged_messages(bodies, words, answered, k, n, parts, hot_share), k, k == order, n, parts, hot_share)
            else:
                sent = _messages(_met(bodies, words, answered, None), k, n, parts, hot_share)
                grams = stored(_by_use(_answers(sent, k, k == order, n, parts, hot_share)), f"katz-{k}-grams", "of_model")
            # At most hot_share contexts, the start symbol and one row of counts of counts.
            got = _hot_contexts(grams, hot, k).toPandas()
            sums_of = [c for c in got.columns if c != "h"]
            of_counts = got[got["h"] == -1][sums_of].to_numpy().sum(axis=0).tolist()[:MOST_DISCOUNTED + 2]
            own = got[got["h"] >= 0].sort_values("h")
            levels.append((discounts(of_counts), own["h"].to_numpy().astype(np.uint64), [own[c].to_numpy() for c in sums_of]))
            hot = _hot_grams(grams) if k < order else []
            # The blocks have their answers; of the parts' tables only the hot contexts' sums are used, and those are here.
            dropped(grams, "of_model=true")
            _release(spark)
            answered.append(grams)
    kind = docs.schema["doc_id"].dataType.simpleString()

    # As in _messages, a call for each block.
    def scored(batch: pa.RecordBatch, i: int) -> pa.RecordBatch:
        ids = batch.column(1)[i].values
        b = Block(batch.column(2)[i].as_py(), batch.column(3)[i].as_py(), n, parts, hot_share)
        log_p = np.log10((b.w_count + 1) / base)
        base_score = np.add.reduceat(log_p, b.bounds[:-1])
        below, d_below = np.full(len(b.w), base, dtype=np.float64), None
        for j, (d, *hot) in enumerate(levels):
            answers = batch.column(4 + j)[i].as_py() or []
            got = b.level.read(answers)
            _backed_off(b.level, answers, got[0], log_p, below, d, d_below, *hot)
            if j + 1 < len(levels):
                b.climb(*got)
            d_below = d
        score = np.add.reduceat(log_p, b.bounds[:-1])
        known = np.add.reduceat((b.w_count > 0).astype(np.int64), b.bounds[:-1])
        return pa.RecordBatch.from_arrays(
            [ids, pa.array(b.train), pa.array(np.diff(b.bounds)), pa.array(known),
             pa.array(np.full(len(ids), n, dtype=np.int64)), pa.array(base_score), pa.array(score)],
            names=["doc_id", "train", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                yield scored(batch, i)
        _handed_back()

    def scores(slot: int | None) -> DataFrame:
        return _met(bodies, words, answered, slot, sums=True).select("block", "ids", "body", *_known(order + 1)).mapInArrow(
            run, f"doc_id {kind}, train boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")

    if not staged:
        return scores(None)
    with shuffles_deleted(spark):
        done = [stored(scores(slot), "katz-scores") for slot in range(SLOTS)]
    for spent in (blocks, words, *answered):
        dropped(spent)
    return reduce(DataFrame.unionByName, done)


def _hot_words(words: DataFrame, n: int, parts: int, hot_share: int) -> list[int]:
    """Numbers of the words with over 1/hot_share of all training tokens: at most hot_share."""
    answers = words.where("not of_model").select("part", "answer")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: set[int] = set()
        for batch in batches:
            for part, blob in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                step, total = unpack(blob)
                found.update(_numbers(step, part, parts)[total.astype(np.int64) * hot_share > n].tolist())
        yield pa.RecordBatch.from_arrays([pa.array(sorted(found), pa.int64())], names=["number"])

    return [r["number"] for r in answers.mapInArrow(run, "number long").distinct().collect()]


def op9_katz_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Katz log10 probability of every document, learned from six sevenths of them."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2
    return katz_scores(docs, ~held_out, order=ORDER).select(
        "doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


QUERIES = {"op9_katz_scores": op9_katz_scores}
ORACLES: dict[str, str] = {}
