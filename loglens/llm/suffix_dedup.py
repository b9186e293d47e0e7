"""Removal of repeated byte strings, by blockwise suffix sorting with cover-sample ranks.

Every byte covered by a string of ``LENGTH`` bytes that also starts anywhere
else in the corpus is removed. So of all suffixes only their first ``LENGTH``
bytes matter, and only ones with an equal elsewhere.

Suffix buckets. Every window of ``LENGTH`` bytes has an anchor: its
``GRAM``-byte string of least hash (the leftmost of equal ones). Equal windows
have equal anchors at equal offsets, and neighbouring windows mostly share
theirs, so a document becomes stretches of text, one per anchor, each holding
all windows of that anchor. The suffixes of one anchor string are a bucket.

1. Each block of documents sends its distinct anchor hashes to parts, which
   answer which ones occur more than once in the corpus; the rest of the text,
   most of it, needs no sorting.
2. Blocks send the distinct stretches of repeated anchors to the parts. An
   anchor that occurs in more than ``HOT_BLOCKS`` blocks would make a hot
   bucket: its stretches are cut into shorter ones which are dealt by the hash
   of the bytes their windows have in common.
3. A part sorts its buckets, a few MB of text at a time. Stretches that are
   equal as wholes are settled by counting. In the others, cover samples
   (positions that lie in a difference cover modulo ``PERIOD``, counted from
   the anchor, hence in phase for all members of a bucket) are ranked first,
   by doubling; every suffix is then placed by its few bytes up to the next
   sample and, however long the tie, by that sample's rank. Equal neighbours
   are compared byte by byte.
4. The parts answer with a bit per window; blocks join their bits and cut.

Blocks are written once; every exchange carries each distinct string once per
block, so no string of the corpus gathers more rows than there are blocks.

Defined results: null text is empty; texts below ``LENGTH`` bytes are never
touched; rows are judged one by one, so repeated rows of ``LENGTH`` bytes or
more remove each other. Other columns are ignored. Empty in, empty out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loglens.llm import text as T
from loglens.llm.katz import pack, unpack
from loglens.llm.store import stored

LENGTH = 200
GRAM = 72
BLOCK_BYTES = 2 << 20
SORT_BYTES = 1 << 20
PARTS_PER_TASK = 4       # a task sorts its parts one after the other
HOT_BLOCKS = 1000
HOT_STARTS = 8
# A difference cover; every distance modulo 31 is a difference of two of its members.
PERIOD, COVER = 31, (1, 5, 11, 24, 25, 27)
_IN_COVER = np.zeros(PERIOD, dtype=bool)
_IN_COVER[list(COVER)] = True
#: For a position's residue, the distance to the next cover sample.
_TO_SAMPLE = np.array([next(d for d in range(PERIOD) if _IN_COVER[(r + d) % PERIOD]) for r in range(PERIOD)])


# --- blocks and stretches -------------------------------------------------

def make_blocks(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` (doc_id, text) as blocks: ``ids``, text ``sizes`` and compressed ``body``."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, made, held, size = TaskContext.get().partitionId(), 0, [], 0

        def flush() -> pa.RecordBatch:
            ids = pa.concat_arrays([h[0] for h in held])
            body = zstandard.compress(b"".join(h[2] for h in held), 3)
            return pa.RecordBatch.from_arrays(
                [pa.array([(task << 32) + made], pa.int64()), pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
                 pa.array([pack(np.concatenate([h[1] for h in held]))], pa.binary()), pa.array([body], pa.binary())],
                names=["block", "ids", "sizes", "body"])

        for batch in batches:
            for a, b, buf, offsets in T.slices(batch.column(1)):
                held.append((batch.column(0).slice(a, b - a), np.diff(offsets), buf.tobytes()))
                size += len(buf) + 64 * (b - a)
                if size >= block_bytes:
                    yield flush()
                    made, held, size = made + 1, [], 0
        if held:
            yield flush()

    return docs.select("doc_id", "text").mapInArrow(run, f"block long, ids array<{kind}>, sizes binary, body binary")


def _least_grams(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values."""
    n = len(values)
    rows = -(-n // width)
    padded = np.full(rows * width, np.iinfo(np.uint64).max, dtype=np.uint64)
    padded[:n] = values
    grid = padded.reshape(rows, width)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    back = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n - width + 1], ahead[width - 1:n])


class Stretches:
    """The stretches of a block: window starts ``a``..``z`` (inclusive) around the gram at ``anchor``."""

    def __init__(self, sizes: bytes, body: bytes):
        self.raw = zstandard.decompress(body)
        self.buf = np.frombuffer(self.raw, np.uint8)
        self.offsets = np.concatenate([[0], np.cumsum(unpack(sizes)[0].astype(np.int64))])
        self.sums = T.prefix_hash(self.buf)
        n, width = len(self.buf), LENGTH - GRAM + 1
        if n < LENGTH:
            self.a = self.z = self.anchor = np.zeros(0, dtype=np.int64)
        else:
            at = np.arange(n - GRAM + 1)
            grams = T.span_hash(self.sums, at, at + GRAM)
            least = _least_grams((grams & np.uint64(0xFFFFFFFF00000000)) | at.astype(np.uint64), width)
            anchor = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
            valid = np.zeros(n - LENGTH + 2, dtype=np.int8)
            long = np.diff(self.offsets) >= LENGTH
            np.add.at(valid, self.offsets[:-1][long], 1)
            np.add.at(valid, self.offsets[1:][long] - LENGTH + 1, -1)
            inside = np.cumsum(valid[:-1]) > 0
            first = inside.copy()
            first[1:] &= ~inside[:-1] | (anchor[1:] != anchor[:-1])
            # Windows of neighbouring texts never touch: between two lie LENGTH - 1 invalid starts.
            self.a = np.flatnonzero(first)
            last = inside.copy()
            last[:-1] &= ~inside[1:] | (anchor[1:] != anchor[:-1])
            self.z = np.flatnonzero(last)
            self.anchor = anchor[self.a]
        self.key = T.span_hash(self.sums, self.anchor, self.anchor + GRAM)
        self.keys, self.of_key, self.times = np.unique(self.key, return_inverse=True, return_counts=True)

    def parted(self, parts: int) -> list[int]:
        step = (1 << 64) // parts + 1
        return np.searchsorted(self.keys, np.array([i * step for i in range(parts)], dtype=np.uint64)).tolist() + [len(self.keys)]

    def choose(self, level: np.ndarray, parts: int) -> None:
        """Keep the stretches whose anchors have a ``level`` (per distinct key; 1 repeated, 2 hot), cut up the hot
        ones, and set their distinct contents in the order they are sent: ``order``, cut by part at ``at``."""
        own = level[self.of_key]
        use = own == 1
        a, z, anchor, hot = self.a[use], self.z[use], self.anchor[use], np.zeros(use.sum(), dtype=bool)
        if (own == 2).any():
            ha, hz, hc = self.a[own == 2], self.z[own == 2], self.anchor[own == 2]
            # Pieces of windows whose distance to the anchor is the same multiple of HOT_STARTS.
            top, low = (hc - ha) // HOT_STARTS, (hc - hz) // HOT_STARTS
            count = top - low + 1
            grade = np.repeat(top, count) - (np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count))
            pc = np.repeat(hc, count)
            pa_ = np.maximum(np.repeat(ha, count), pc - grade * HOT_STARTS - HOT_STARTS + 1)
            pz = np.minimum(np.repeat(hz, count), pc - grade * HOT_STARTS)
            a, z, anchor = np.concatenate([a, pa_]), np.concatenate([z, pz]), np.concatenate([anchor, pc])
            hot = np.concatenate([hot, np.ones(len(pc), dtype=bool)])
        self.pa, self.pz, self.panchor = a, z, anchor
        content = T.span_hash(self.sums, a, z + LENGTH)
        _, first, self.of_content, times = np.unique(content, return_index=True, return_inverse=True, return_counts=True)
        self.twice = times > 1
        self.first = first
        bucket = T.span_hash(self.sums, anchor[first], anchor[first] + GRAM)
        if hot.any():
            h = hot[first]
            lo = anchor[first][h] - (anchor[first][h] - a[first][h]) // HOT_STARTS * HOT_STARTS
            # The bytes that all windows of the piece's grade hold.
            core = T.span_hash(self.sums, lo, lo - HOT_STARTS + 1 + LENGTH)
            bucket[h] = T.mix(core + (anchor[first][h] - lo).astype(np.uint64))
        self.bucket = bucket
        part = ((bucket >> np.uint64(16)) % np.uint64(parts)).astype(np.int64)
        self.order = np.lexsort((first, part))
        self.at = np.searchsorted(part[self.order], np.arange(parts + 1))

    def message(self, part: int) -> tuple[bytes, bytes]:
        own = self.order[self.at[part]:self.at[part + 1]]
        a, z, anchor = self.pa[self.first[own]], self.pz[self.first[own]], self.panchor[self.first[own]]
        text = b"".join([self.raw[x:y] for x, y in zip(a.tolist(), (z + LENGTH).tolist(), strict=True)])
        return pack(z - a + 1, anchor - a, self.bucket[own]), zstandard.compress(text, 3)


# --- exchanges ------------------------------------------------------------

def _anchor_messages(blocks: DataFrame, parts: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, sizes, body in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                s = Stretches(sizes, body)
                at = s.parted(parts)
                used = [p for p in range(parts) if at[p + 1] > at[p]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(used, pa.int32()), pa.array([block] * len(used), pa.int64()),
                     pa.array([s.keys[at[p]:at[p + 1]].tobytes() for p in used], pa.binary()),
                     pa.array([pack(s.times[at[p]:at[p + 1]] > 1) for p in used], pa.binary())], names=["part", "block", "keys", "twice"])

    return blocks.select("block", "sizes", "body").mapInArrow(run, "part int, block long, keys binary, twice binary")


def _anchor_answers(messages: DataFrame, hot_blocks: int) -> DataFrame:
    """Per (block, part) the level of each of the block's anchors: 0 unique, 1 repeated, 2 hot."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        keys = [np.frombuffer(k, np.uint64) for k in pdf["keys"]]
        _, index, blocks = np.unique(np.concatenate(keys), return_inverse=True, return_counts=True)
        twice = np.zeros(len(blocks), dtype=bool)
        twice[index[np.concatenate([unpack(t)[0] for t in pdf["twice"]])]] = True
        level = np.where(blocks > hot_blocks, 2, (twice | (blocks > 1)).astype(np.int64)).astype(np.uint8)
        bounds = np.concatenate([[0], np.cumsum([len(k) for k in keys])])
        return pd.DataFrame({"block": pdf["block"], "part": pdf["part"],
                             "answer": [pack(level[index[a:b]]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]})

    return messages.groupBy("part").applyInPandas(run, "block long, part int, answer binary")


def _with_answers(blocks: DataFrame, answers: DataFrame, name: str, how: str = "inner") -> DataFrame:
    lists = answers.groupBy("block").agg(F.expr(f"collect_list(struct(part, answer)) AS {name}"))
    return blocks.join(lists, "block", how)


def _levels(s: Stretches, answers: list | None) -> np.ndarray:
    parts = [unpack(a["answer"])[0] for a in sorted(answers or [], key=lambda a: a["part"])]
    return np.concatenate(parts) if parts else np.zeros(len(s.keys), dtype=np.uint8)


def _stretch_messages(blocks: DataFrame, parts: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, sizes, body, levels in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                s = Stretches(sizes, body)
                s.choose(_levels(s, levels), parts)
                used = [p for p in range(parts) if s.at[p + 1] > s.at[p]]
                sent = [s.message(p) for p in used]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(used, pa.int32()), pa.array([block] * len(used), pa.int64()),
                     pa.array([m[0] for m in sent], pa.binary()), pa.array([m[1] for m in sent], pa.binary())],
                    names=["part", "block", "shape", "text"])

    return blocks.select("block", "sizes", "body", "levels").mapInArrow(run, "part int, block long, shape binary, text binary")


# --- sorting one group of buckets -----------------------------------------

def _words(padded: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The eight bytes from each position as one big-endian number."""
    out = np.zeros(len(at), dtype=np.uint64)
    for i in range(8):
        out = (out << np.uint64(8)) | padded[at + i]
    return out


def _dense(keys: tuple[np.ndarray, ...]) -> np.ndarray:
    """Ranks (from 1, equal for equals) of rows by ``keys``, most significant first."""
    order = np.lexsort(keys[::-1])
    new = np.zeros(len(order), dtype=bool)
    for k in keys:
        s = k[order]
        new[1:] |= s[1:] != s[:-1]
    ranks = np.empty(len(order), dtype=np.int64)
    ranks[order] = np.cumsum(new) + 1
    return ranks


def repeated_windows(buf: np.ndarray, starts: np.ndarray, windows: np.ndarray, left: np.ndarray, bucket: np.ndarray) -> np.ndarray:
    """A bit for every window of different stretches: whether an equal window exists in another one.

    Stretch s has the text ``buf[starts[s]:starts[s] + windows[s] + LENGTH - 1]`` and its anchor at ``left[s]`` in it."""
    size = windows + LENGTH - 1
    padded = np.concatenate([buf, np.zeros(LENGTH + 64, dtype=np.uint8)])
    # Cover samples, in phase by their distance to the anchor.
    total = int(size.sum())
    of = np.repeat(np.arange(len(starts)), size)
    rel = np.arange(total) - np.repeat(np.cumsum(size) - size, size)
    phase = (rel - left[of]) % PERIOD
    sample = np.flatnonzero(_IN_COVER[phase])
    s_of, s_rel = of[sample], rel[sample]
    s_at = starts[s_of] + s_rel
    room = size[s_of] - s_rel
    keys = [bucket[s_of], (s_rel - left[s_of]).astype(np.int64)]
    for i in range(0, 32, 8):
        word = _words(padded, s_at + i)
        here = np.clip(np.minimum(room, PERIOD) - i, 0, 8)
        word = np.where(here == 8, word, np.where(here == 0, 0, word & ~((np.uint64(1) << (np.uint64(8) * (np.uint64(8) - here.astype(np.uint64))) % np.uint64(64)) - np.uint64(1))))
        keys.append(word.astype(np.uint64))
    keys.append(np.minimum(room, PERIOD))
    rank = _dense(tuple(keys))
    spot = np.full(total + 1, -1, dtype=np.int64)
    spot[sample] = np.arange(len(sample))
    step = PERIOD
    while step < LENGTH:
        after = np.where(room > step, rank[spot[np.minimum(sample + step, total)]], 0)
        rank = _dense((rank, after))
        step *= 2
    # Every window: bucket, distance to the anchor, the bytes up to its next sample, that sample's rank.
    w_of = np.repeat(np.arange(len(starts)), windows)
    w_rel = np.arange(len(w_of)) - np.repeat(np.cumsum(windows) - windows, windows)
    flat = np.repeat(np.cumsum(size) - size, windows) + w_rel
    w_at = starts[w_of] + w_rel
    far = _TO_SAMPLE[phase[flat]]
    keys = [bucket[w_of], (w_rel - left[w_of]).astype(np.int64)]
    for i in range(0, 16, 8):
        here = np.clip(far - i, 0, 8).astype(np.uint64)
        mask = np.where(here == 0, np.uint64(0), ~np.uint64(0) << ((np.uint64(8) * (np.uint64(8) - here)) % np.uint64(64)))
        keys.append(_words(padded, w_at + i) & mask)
    keys.append(rank[spot[flat + far]])
    order = np.lexsort(keys[::-1])
    same = np.ones(max(len(order) - 1, 0), dtype=bool)
    for k in keys[:4]:
        s = k[order]
        same &= s[1:] == s[:-1]
    # Neighbours that begin alike: are all LENGTH bytes equal?
    pairs = np.flatnonzero(same)
    x, y = w_at[order[pairs]], w_at[order[pairs + 1]]
    for i in range(0, LENGTH, 8):
        ok = _words(padded, x + i) == _words(padded, y + i)
        if not ok.all():
            pairs, x, y = pairs[ok], x[ok], y[ok]
    out = np.zeros(len(order), dtype=bool)
    out[order[pairs]] = True
    out[order[pairs + 1]] = True
    return out


def content_hashes(buf: np.ndarray, starts: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Hashes of stretches that lie one behind the other, a few MB at a time."""
    out = [np.zeros(0, dtype=np.uint64)]
    a = 0
    while a < len(starts):
        z = max(a + 1, int(np.searchsorted(starts, starts[a] + T.SLICE_BYTES, "right")) - 1)
        base, end = int(starts[a]), int(starts[z - 1] + size[z - 1])
        own = starts[a:z] - base
        out.append(T.span_hash(T.prefix_hash(buf[base:end]), own, own + size[a:z]))
        a = z
    return np.concatenate(out)


def settle(buf: np.ndarray, windows: np.ndarray, left: np.ndarray, bucket: np.ndarray, sort_bytes: int = SORT_BYTES) -> np.ndarray:
    """Bits of all windows of a part's stretches, in their order."""
    size = (windows + LENGTH - 1).astype(np.int64)
    starts = np.cumsum(size) - size
    content = content_hashes(buf, starts, size)
    _, first, of_content, times = np.unique(content, return_index=True, return_inverse=True, return_counts=True)
    bits: list[np.ndarray | None] = [np.ones(int(windows[f]), dtype=bool) if t > 1 else None for f, t in zip(first, times, strict=True)]
    # Distinct contents by bucket; only buckets with several need sorting.
    by_bucket = np.argsort(bucket[first], kind="stable")
    names = bucket[first][by_bucket]
    cuts = np.flatnonzero(np.concatenate([[True], names[1:] != names[:-1], [True]])) if len(names) else np.zeros(1, dtype=np.int64)
    group: list[np.ndarray] = []
    held = 0

    def sort_group() -> None:
        own = np.concatenate(group)
        f = first[own]
        found = repeated_windows(buf, starts[f], windows[f].astype(np.int64), left[f].astype(np.int64), bucket[f])
        ends = np.cumsum(windows[f])
        for c, a, z in zip(own.tolist(), (ends - windows[f]).tolist(), ends.tolist(), strict=True):
            if bits[c] is None:
                bits[c] = found[a:z]

    for a, z in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        own = by_bucket[a:z]
        if len(own) > 1 and (times[own] == 1).any():
            group.append(own)
            held += int(size[first[own]].sum())
            if held >= sort_bytes:
                sort_group()
                group, held = [], 0
    if group:
        sort_group()
    per_content = [b if b is not None else np.zeros(int(windows[f]), dtype=bool) for b, f in zip(bits, first, strict=True)]
    return np.concatenate([per_content[c] for c in of_content]) if len(of_content) else np.zeros(0, dtype=bool)


def _stretch_answers(messages: DataFrame) -> DataFrame:
    """Per (block, part): a bit for every window sent."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        shapes = [unpack(s) for s in pdf["shape"]]
        buf = np.frombuffer(b"".join(zstandard.decompress(t) for t in pdf["text"]), np.uint8)
        windows, left, bucket = (np.concatenate([s[i].astype(t) for s in shapes]) for i, t in enumerate((np.int64, np.int64, np.uint64)))
        bits = settle(buf, windows, left, bucket)
        ends = np.cumsum([int(s[0].sum(dtype=np.int64)) for s in shapes])
        return pd.DataFrame({"block": pdf["block"], "part": pdf["part"],
                             "answer": [pack(np.packbits(bits[a:b])) for a, b in zip([0, *ends[:-1]], ends, strict=True)]})

    return messages.groupBy("part").applyInPandas(run, "block long, part int, answer binary")


# --- cutting --------------------------------------------------------------

def repeated_starts(s: Stretches, answers: list | None) -> np.ndarray:
    """Starts of all windows of the block that have an equal elsewhere, in order."""
    windows = s.pz - s.pa + 1
    bits = np.zeros(int(windows.sum()), dtype=bool)
    begin = np.cumsum(windows) - windows
    per_content: dict[int, np.ndarray] = {}
    for a in answers or []:
        own = s.order[s.at[a["part"]]:s.at[a["part"] + 1]]
        sizes = windows[s.first[own]]
        flags = np.unpackbits(unpack(a["answer"])[0], count=int(sizes.sum())).astype(bool)
        ends = np.cumsum(sizes)
        per_content.update(zip(own.tolist(), (flags[x:y] for x, y in zip(ends - sizes, ends, strict=True)), strict=True))
    for i, c in enumerate(s.of_content.tolist()):
        if s.twice[c]:
            bits[begin[i]:begin[i] + windows[i]] = True
        elif c in per_content:
            bits[begin[i]:begin[i] + windows[i]] = per_content[c]
    at = np.repeat(s.pa - begin, windows) + np.arange(len(bits))
    return np.sort(at[bits])


def dedup_bytes(docs: DataFrame, parts: int | None = None, block_bytes: int = BLOCK_BYTES,
                hot_blocks: int = HOT_BLOCKS) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): n_bytes, n_removed, n_spans, kept_sha256 and ``spans``, the removed
    byte ranges (start, end exclusive)."""
    spark = docs.sparkSession
    parts = parts or PARTS_PER_TASK * int(spark.conf.get("spark.sql.shuffle.partitions"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    blocks = stored(make_blocks(docs, block_bytes), "dedup-blocks")
    levels = stored(_anchor_answers(_anchor_messages(blocks, parts), hot_blocks), "dedup-anchors")
    leveled = _with_answers(blocks, levels, "levels", "left")
    bits = stored(_stretch_answers(_stretch_messages(leveled, parts)), "dedup-windows")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                ids = batch.column(0)[i].values
                sizes, body, levels, answers = (batch.column(j)[i].as_py() for j in range(1, 5))
                s = Stretches(sizes, body)
                s.choose(_levels(s, levels), parts)
                yield cut_batch(ids, s, repeated_starts(s, answers))

    met = _with_answers(leveled, bits, "bits", "left")
    return met.select("ids", "sizes", "body", "levels", "bits").mapInArrow(
        run, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<start:long,end:long>>")


def cut_batch(ids: pa.Array, s: Stretches, starts: np.ndarray) -> pa.RecordBatch:
    """The result rows of a block, from its repeated windows' starts."""
    new = np.ones(len(starts), dtype=bool)
    of = np.searchsorted(s.offsets, starts, "right") - 1
    if len(starts):
        new[1:] = (starts[1:] > starts[:-1] + LENGTH) | (of[1:] != of[:-1])
    a = starts[new]
    z = starts[np.concatenate([new[1:], [True]])] + LENGTH if len(starts) else a
    doc = of[new]
    n = len(ids)
    n_spans = np.bincount(doc, minlength=n)
    n_removed = np.bincount(doc, weights=z - a, minlength=n).astype(np.int64)
    view, digests, bounds = memoryview(s.buf), [], np.concatenate([[0], np.cumsum(n_spans)])
    for i in range(n):
        at, kept = int(s.offsets[i]), hashlib.sha256()
        for x, y in zip(a[bounds[i]:bounds[i + 1]].tolist(), z[bounds[i]:bounds[i + 1]].tolist(), strict=True):
            kept.update(view[at:x])
            at = y
        kept.update(view[at:int(s.offsets[i + 1])])
        digests.append(kept.hexdigest())
    base = s.offsets[doc]
    spans = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()),
                                     pa.StructArray.from_arrays([pa.array(a - base, pa.int64()), pa.array(z - base, pa.int64())], names=["start", "end"]))
    return pa.RecordBatch.from_arrays(
        [ids, pa.array(np.diff(s.offsets)), pa.array(n_removed), pa.array(n_spans.astype(np.int64)), pa.array(digests, pa.string()), spans],
        names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"])


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without its repeated 200-byte strings."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return dedup_bytes(docs).drop("spans")


ORACLE = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (SELECT r, i, md5(substr(h, 2 * i + 1, {2 * LENGTH})) AS k FROM d, range(len(h) // 2 - {LENGTH} + 1) t(i)),
k AS (SELECT k FROM w GROUP BY k HAVING count(*) > 1),
s AS (SELECT r, i, CASE WHEN i > lag(i) OVER (PARTITION BY r ORDER BY i) + {LENGTH} THEN 1 ELSE 0 END AS jump FROM w JOIN k USING (k)),
g AS (SELECT r, i, sum(jump) OVER (PARTITION BY r ORDER BY i) AS g FROM s),
span AS (SELECT r, min(i) AS a, max(i) + {LENGTH} AS z FROM g GROUP BY r, g.g),
piece AS (SELECT r, coalesce(lag(z) OVER (PARTITION BY r ORDER BY a), 0) AS x, a AS y FROM span
  UNION ALL SELECT d.r, coalesce(max(z), 0), any_value(len(h) // 2) FROM d LEFT JOIN span USING (r) GROUP BY d.r),
kept AS (SELECT r, string_agg(substr(h, 2 * x + 1, 2 * (y - x)), '' ORDER BY x) AS h FROM piece JOIN d USING (r) GROUP BY r),
n AS (SELECT r, sum(z - a) AS removed, count(*) AS spans FROM span GROUP BY r)
SELECT doc_id, len(d.h) // 2 AS n_bytes, coalesce(removed, 0)::BIGINT AS n_removed, coalesce(spans, 0)::BIGINT AS n_spans,
  sha256(unhex(kept.h)) AS kept_sha256
FROM d JOIN kept USING (r) LEFT JOIN n USING (r)
"""

QUERIES = {"op2_suffix_dedup": op2_suffix_dedup}
ORACLES = {"op2_suffix_dedup": ORACLE}
