"""Best-fit packing of tokenised documents into sequences of a fixed length.

A document's tokens, closed by an end id, are cut into pieces of at most
``CAPACITY`` (full pieces last, so only the first may be shorter). Pieces are
packed online, in the order of a hash, by bounded-space best-fit: at most
``OPEN_BINS`` sequences are open, kept by their free space with a bitset of
the occupied sizes; a piece goes where it leaves least room, and when it fits
nowhere and all places are taken, the fullest open sequence closes.

Packing needs lengths only. Pieces are dealt by a hash into independent
packers of about ``PACKER_ROWS`` rows, whatever the size of the corpus; every
packer sorts its rows first, so a rerun after a lost executor gives the same
sequences. Tokenising is one pass without a shuffle: texts are split at ASCII
white space exactly as the tokenizer's own pattern does, and only chunks not
seen before by the worker are encoded; texts with other white space or with a
special token's string are encoded as a whole.

Defined results: a null or empty text is one piece holding the end id alone;
repeated rows are packed one by one; further columns are ignored. Empty in,
empty out.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loglens.llm import text as T

CAPACITY = 2048
OPEN_BINS = 512
PACKER_ROWS = 16384
END_ID = 0
TOKENIZER = "byte_bpe_50k.json"
CACHE_CHUNKS = 400_000
SLICE = 1 << 20

# White space beyond ASCII in UTF-8, and the special token's string.
UNUSUAL = re.compile(rb"\xc2[\x85\xa0]|\xe1\x9a\x80|\xe2\x80[\x80-\x8a\xa8\xa9\xaf]|\xe2\x81\x9f|\xe3\x80\x80|<\|endoftext\|>")


# The byte-level tokenizer's pre-tokenisation pattern, and the characters that stand for bytes in
# its vocabulary: printable ones for themselves, the others, in order, for 256 and up.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
_BYTE_OF = {chr(b): b for b in _PRINTABLE}
_BYTE_OF.update((chr(256 + i), b) for i, b in enumerate(b for b in range(256) if b not in _PRINTABLE))


class Encoder:
    """Token ids of whole slices of texts, with a bounded cache of chunks.

    New chunks are encoded many at a time from one string; the tokenizer's
    pattern cuts it between them, and the ids' byte lengths tell where."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import tiktoken
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        ranks = {bytes(map(_BYTE_OF.__getitem__, token)): rank for token, rank in vocabulary.items()}
        self.merger = tiktoken.Encoding("chunks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.width = np.zeros(max(ranks.values()) + 1, dtype=np.int64)
        for token, rank in ranks.items():
            self.width[rank] = len(token)
        self._forget()

    def _chunks(self, chunks: list[bytes]) -> list[np.ndarray]:
        """Ids of chunks: of words after one space, of words (each put behind a line end), of white space."""
        out: list[np.ndarray] = [None] * len(chunks)  # type: ignore[list-item]
        spaced, plain = [], []
        for i, c in enumerate(chunks):
            if T.SPACE[c[-1]]:
                out[i] = np.array(self.merger.encode_ordinary(c.decode()), dtype=np.uint32)
            else:
                (spaced if c[0] == 32 else plain).append(i)
        for rows, lead in ((spaced, b""), (plain, b"\n")):
            if not rows:
                continue
            ids = np.array(self.merger.encode_ordinary(b"".join([lead + chunks[i] for i in rows]).decode()), dtype=np.uint32)
            ends = np.cumsum([len(lead) + len(chunks[i]) for i in rows])
            stops = np.searchsorted(np.cumsum(self.width[ids]), ends) + 1
            starts = np.concatenate([[0], stops[:-1]]) + len(lead)
            for i, a, b in zip(rows, starts.tolist(), stops.tolist(), strict=True):
                out[i] = ids[a:b]
        return out

    def _forget(self) -> None:
        self.rows: dict[int, int] = {}
        self.offsets = np.zeros(1, dtype=np.int64)
        self.ids = np.zeros(0, dtype=np.uint32)

    def _whole(self, text: bytes) -> np.ndarray:
        return np.array(self.tokenizer.encode(text.decode(), add_special_tokens=False).ids, dtype=np.uint32)

    def encode(self, buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the slice, every text closed by ``END_ID``, and the texts' id offsets."""
        n = len(offsets) - 1
        raw = buf.tobytes()
        odd = [i for i in range(n) if UNUSUAL.search(raw, int(offsets[i]), int(offsets[i + 1]))]
        cuts = chunk_cuts(buf, offsets)
        starts, ends = cuts[:-1], cuts[1:]
        first = np.searchsorted(starts, offsets) if len(buf) else np.zeros(n + 1, dtype=np.int64)
        if odd:
            keep = np.ones(len(starts), dtype=bool)
            for i in odd:
                keep[first[i]:first[i + 1]] = False
            starts, ends = starts[keep], ends[keep]
            first = np.searchsorted(starts, offsets)
        place = self._lookup(raw, buf, starts, ends)
        sizes = np.diff(self.offsets)[place]
        total = np.concatenate([[0], np.cumsum(sizes)])
        flat = self.ids[np.arange(total[-1]) - np.repeat(total[:-1] - self.offsets[place], sizes)]
        bounds = total[first]
        counts = np.diff(bounds)
        whole = {i: self._whole(raw[offsets[i]:offsets[i + 1]]) for i in odd}
        for i, ids in whole.items():
            counts[i] = len(ids)
        out_offsets = np.concatenate([[0], np.cumsum(counts + 1)])
        out = np.full(out_offsets[-1], END_ID, dtype=np.uint32)
        if whole:
            for i in range(n):
                part = whole[i] if i in whole else flat[bounds[i]:bounds[i + 1]]
                out[out_offsets[i]:out_offsets[i] + len(part)] = part
        else:
            out[np.arange(len(flat)) + np.repeat(np.arange(n), counts)] = flat
        return out, out_offsets

    def _lookup(self, raw: bytes, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        if not len(starts):
            return np.zeros(0, dtype=np.int64)
        if len(self.rows) > CACHE_CHUNKS:
            self._forget()
        keys, at, inverse = np.unique(T.span_hash(T.prefix_hash(buf), starts, ends), return_index=True, return_inverse=True)
        found = list(map(self.rows.get, keys.tolist()))
        new = [i for i, f in enumerate(found) if f is None]
        if new:
            got = self._chunks([raw[a:b] for a, b in zip(starts[at[new]].tolist(), ends[at[new]].tolist(), strict=True)])
            for i, row in zip(new, range(len(self.rows), len(self.rows) + len(new)), strict=True):
                found[i] = row
            self.rows.update(zip(keys[new].tolist(), range(len(self.rows), len(self.rows) + len(new)), strict=True))
            self.ids = np.concatenate([self.ids, *got])
            self.offsets = np.concatenate([self.offsets, self.offsets[-1] + np.cumsum([len(g) for g in got])])
        return np.array(found, dtype=np.int64)[inverse]


def chunk_cuts(buf: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Positions where the tokenizer's pattern always cuts: a word takes one space before it; of longer
    white space before a word all but the last character stand together, and at a text's end all."""
    starts, ends, _ = T.word_spans(buf, offsets)
    if not len(starts):
        return np.unique(offsets)
    edge = np.zeros(len(buf) + 1, dtype=bool)
    edge[offsets] = True
    gap = ~edge[starts] & (starts > 0)
    before = np.where(gap, starts - 1, starts)
    is_gap = gap & T.SPACE[buf[before]]
    # Either the word takes the space there, or that character stands alone: both cut before it.
    plain = is_gap & (buf[before] != 0x20)
    return np.unique(np.concatenate([offsets, np.where(is_gap, before, starts), starts[plain], ends]))


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def tokenize(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """Pieces of all documents: doc_id, piece, start, length, ids_crc32 and, if asked for, ``ids``
    (little-endian unsigned 32-bit)."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        for batch in batches:
            for a, b, buf, offsets in T.slices(batch.column(1), SLICE):
                ids, bounds = enc.encode(buf, offsets)
                rows: list[tuple[int, int, int, int, int]] = []
                blobs = []
                data = memoryview(ids.astype("<u4").tobytes())
                for i in range(b - a):
                    lo, n = int(bounds[i]), int(bounds[i + 1] - bounds[i])
                    at, piece = 0, 0
                    while at < n:
                        size = (n - at) % capacity or capacity
                        blob = data[4 * (lo + at):4 * (lo + at + size)]
                        rows.append((a + i, piece, at, size, zlib.crc32(blob)))
                        if with_ids:
                            blobs.append(bytes(blob))
                        at, piece = at + size, piece + 1
                of, piece, start, size, crc = (np.array(x, dtype=np.int64) for x in zip(*rows, strict=True))
                columns = [batch.column(0).take(pa.array(of)), pa.array(piece, pa.int32()), pa.array(start), pa.array(size), pa.array(crc)]
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                if with_ids:
                    columns.append(pa.array(blobs, pa.binary()))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long"
    return docs.select("doc_id", "text").mapInArrow(run, schema + (", ids binary" if with_ids else ""))


class BestFit:
    """Online bounded-space best-fit; ``place`` returns (sequence number, offset)."""

    def __init__(self, capacity: int = CAPACITY, open_bins: int = OPEN_BINS):
        self.capacity, self.open_bins = capacity, open_bins
        self.sizes = 0                                   # bit f: an open sequence has f free places
        self.by_free: dict[int, list[int]] = {}
        self.open = self.made = 0

    def _take(self, free: int) -> int:
        bins = self.by_free[free]
        taken = bins.pop()
        if not bins:
            del self.by_free[free]
            self.sizes &= ~(1 << free)
        self.open -= 1
        return taken

    def place(self, size: int) -> tuple[int, int]:
        fits = self.sizes >> size
        if fits:
            free = size + (fits & -fits).bit_length() - 1
            number = self._take(free)
        else:
            free, number = self.capacity, self.made
            self.made += 1
            if free > size and self.open == self.open_bins:
                self._take((self.sizes & -self.sizes).bit_length() - 1)
        left = free - size
        if left:
            self.by_free.setdefault(left, []).append(number)
            self.sizes |= 1 << left
            self.open += 1
        return number, self.capacity - free


def pack(pieces: DataFrame, rows: int, capacity: int = CAPACITY, open_bins: int = OPEN_BINS,
         packer_rows: int = PACKER_ROWS) -> DataFrame:
    """``pieces`` (about ``rows`` of them; with doc_id, piece, length) with sequence_id and offset."""
    from pyspark.sql.types import LongType, StructField, StructType
    packers = max(1, -(-rows // packer_rows))
    dealt = pieces.withColumn("_order", F.xxhash64("doc_id", "piece")).withColumn("_packer", F.pmod("_order", F.lit(packers)))
    size = dealt.columns.index("length")
    dealt = dealt.repartition(packers, "_packer").sortWithinPartitions("_packer", "_order", *pieces.columns[:4])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fit, current = BestFit(capacity, open_bins), None
        for batch in batches:
            numbers, places = [], []
            for packer, length in zip(batch.column(batch.num_columns - 1).to_pylist(), batch.column(size).to_pylist(), strict=True):
                if packer != current:
                    fit, current = BestFit(capacity, open_bins), packer
                number, place = fit.place(length)
                numbers.append((packer << 36) + number)
                places.append(place)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-2], pa.array(numbers, pa.int64()), pa.array(places, pa.int64())],
                                             names=[*batch.schema.names[:-2], "sequence_id", "offset"])

    schema = StructType([*pieces.schema.fields, StructField("sequence_id", LongType()), StructField("offset", LongType())])
    return dealt.mapInArrow(run, schema)


def sequences(packed: DataFrame) -> DataFrame:
    """The packed token sequences, from ``pack`` of pieces with ids: sequence_id, ids. A group holds at most one sequence."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(parts.alias("p")).select(
        "sequence_id", F.expr("aggregate(p, X'', (a, x) -> concat(a, x.ids))").alias("ids"))


def pack_documents(docs: DataFrame, tokenizer: str | None = None, with_ids: bool = False) -> DataFrame:
    if tokenizer is None:
        import public_tokenizers
        tokenizer = public_tokenizers.path(TOKENIZER)
    return pack(tokenize(docs, tokenizer, with_ids=with_ids), docs.count())


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their places in packed sequences."""
    return pack_documents(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))


QUERIES = {"op8_best_fit_packing": op8_best_fit_packing}
ORACLES: dict[str, str] = {}
