"""Secret scan: fixed patterns plus character Markov models.

Patterns find assignments, access keys and long hex runs. Two first-order
character models, one of random strings and one of ordinary identifiers, are
trained from labelled samples (by default the patterns' values and all other
tokens of the corpus). What the patterns leave of a text is scored in runs of at
least ``MIN_TOKEN`` token characters, of whatever classes: a run is a secret (kind ``markov``) when its
log-likelihood ratio reaches ``MIN_RATIO``, ``MIN_RATE`` per character. Of a run
that doesn't, the parts of at least ``MIN_TOKEN`` characters that do are, the
best-scoring one first, so a key in a path or behind a long name is not diluted.

The models are count matrices of a fixed size, summed over all documents;
only they reach the driver. Scanning is one pass without a shuffle.

Defined results: null and empty texts have no spans; offsets are code points,
ends exclusive; repeated rows are scanned and returned one by one; a markov
span never overlaps a pattern's span, patterns of different kinds may overlap
each other. Transitions are smoothed by plain symbol
frequencies; without any sample of a class its model is uniform. Further
columns of the input are ignored by ``find_secrets`` and kept by ``redact``.
Empty in, empty out.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loglens.llm import text as T

KINDS = ("assign", "access", "hex", "markov")
MIN_ASSIGNED, MIN_ACCESS, MIN_HEX, MIN_TOKEN = 6, 20, 24, 20
MIN_RATIO, MIN_RATE = 20.0, 0.5
PRIOR = 500.0            # weight of the plain symbol frequencies in each transition, so that few samples decide nothing
MARK = "[SECRET]"

# The patterns and the words an assignment starts with.
ASSIGN = re.compile(rb"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
ASSIGN_WORDS = (b"password", b"passwd", b"secret", b"token", b"api")

ALPHABET = b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-"
SYMBOL = np.full(256, 255, dtype=np.uint8)
SYMBOL[np.frombuffer(ALPHABET, np.uint8)] = np.arange(len(ALPHABET))
START = len(ALPHABET)
SIZE = START + 1
HEX = np.zeros(256, dtype=bool)
HEX[np.frombuffer(b"0123456789abcdef", np.uint8)] = True


def _runs(inside: np.ndarray, offsets: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of at least ``least`` set bytes that stay in one text."""
    edge = np.zeros(len(inside) + 1, dtype=bool)
    edge[offsets] = True
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1] | edge[1:-1]
    last[:-1] &= ~inside[1:] | edge[1:-1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    long = ends - starts >= least
    return starts[long], ends[long]


def pattern_spans(buf: np.ndarray, offsets: np.ndarray) -> tuple[list[tuple[int, int, int]], list[tuple[int, int]]]:
    """Of one slice of texts: (start, kind, end) byte spans of the patterns, and the spans of the secret values in them."""
    spans, values = [], []
    low = T.LOWER[buf].tobytes()
    raw = buf.tobytes()
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        if any(low.find(w, a, b) >= 0 for w in ASSIGN_WORDS):
            for m in ASSIGN.finditer(raw, a, b):
                if m.end(2) - m.start(2) >= MIN_ASSIGNED:
                    spans.append((m.start(), 0, m.end()))
                    values.append(m.span(2))
        if raw.find(b"AKIA", a, b) >= 0:
            for m in ACCESS.finditer(raw, a, b):
                if m.end() - m.start() >= MIN_ACCESS:
                    spans.append((m.start(), 1, m.end()))
                    values.append(m.span())
    for a, b in zip(*(x.tolist() for x in _runs(HEX[buf], offsets, MIN_HEX)), strict=True):
        spans.append((a, 2, b))
        values.append((a, b))
    return spans, values


def transition_counts(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Counts of (previous symbol, symbol) over the given spans of token characters."""
    at = SYMBOL[buf]
    before = np.full(len(buf), START, dtype=np.int32)
    before[1:] = at[:-1]
    before[starts] = START
    cover = np.zeros(len(buf) + 1, dtype=np.int32)
    np.add.at(cover, starts, 1)
    np.add.at(cover, ends, -1)
    use = (np.cumsum(cover[:-1]) > 0) & (at < START)
    before[before > START] = START
    return np.bincount(before[use] * SIZE + at[use], minlength=SIZE * SIZE)


def sample_counts(docs: DataFrame) -> DataFrame:
    """Transition counts of all values of the patterns (``random``) and of all other tokens (``ordinary``), by cell."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        random = np.zeros(SIZE * SIZE, dtype=np.int64)
        ordinary = np.zeros(SIZE * SIZE, dtype=np.int64)
        for batch in batches:
            for _, _, buf, offsets in T.slices(batch.column(0)):
                if not len(buf):
                    continue
                found, values = pattern_spans(buf, offsets)
                starts = np.array([a for a, _ in values], dtype=np.int64)
                ends = np.array([b for _, b in values], dtype=np.int64)
                random += transition_counts(buf, starts, ends)
                masked = buf.copy()
                for a, _, b in found:
                    masked[a:b] = 32
                ordinary += transition_counts(masked, *_runs(SYMBOL[masked] < START, offsets, 1))
        cells = np.flatnonzero(random + ordinary)
        yield pa.RecordBatch.from_arrays([pa.array(cells, pa.int32()), pa.array(random[cells]), pa.array(ordinary[cells])],
                                         names=["cell", "random", "ordinary"])

    return (docs.select("text").mapInArrow(count, "cell int, random long, ordinary long")
            .groupBy("cell").agg(F.sum("random").alias("random"), F.sum("ordinary").alias("ordinary")))


class MarkovModels:
    """Log-likelihood ratios of the two character models per transition."""

    def __init__(self, cells: np.ndarray, random: np.ndarray, ordinary: np.ndarray):
        logs = []
        for counts in (random, ordinary):
            m = np.zeros(SIZE * SIZE)
            m[cells] = counts
            m = m.reshape(SIZE, SIZE)[:, :START]
            plain = m.sum(axis=0) + 0.5
            m = m + PRIOR * plain / plain.sum()
            logs.append(np.log(m / m.sum(axis=1, keepdims=True)))
        self.ratio = np.hstack([logs[0] - logs[1], np.zeros((SIZE, 1))]).ravel()

    @classmethod
    def train(cls, counts: DataFrame) -> MarkovModels:
        # At most SIZE * SIZE rows, whatever the corpus.
        got = counts.toPandas()
        return cls(got["cell"].to_numpy(), got["random"].to_numpy(), got["ordinary"].to_numpy())

    def secrets(self, buf: np.ndarray, offsets: np.ndarray) -> list[tuple[int, int]]:
        """Byte spans of all runs, or parts of runs, that look random."""
        found = []
        for a, b in zip(*(x.tolist() for x in _runs(SYMBOL[buf] < START, offsets, MIN_TOKEN)), strict=True):
            s = SYMBOL[buf[a:b]].astype(np.int64)
            gain = self.ratio[np.concatenate([[START], s[:-1]]) * SIZE + s]
            whole = float(gain.sum())
            if whole >= MIN_RATIO and whole >= MIN_RATE * (b - a):
                found.append((a, b))
            else:
                found += [(a + x, a + y) for x, y in random_parts(gain)]
        return found


def random_parts(gain: np.ndarray) -> list[tuple[int, int]]:
    """Disjoint parts of a run whose gains reach ``MIN_RATIO``, and ``MIN_RATE`` on average: the part that exceeds the rate
    most, then the same on both sides of it."""
    found, todo = [], [(0, len(gain))]
    while todo:
        lo, hi = todo.pop()
        surplus = np.concatenate([[0.0], np.cumsum(gain[lo:hi] - MIN_RATE)])
        # A part of the second length has the ratio if it has the rate.
        for least in (MIN_TOKEN, int(MIN_RATIO / MIN_RATE)):
            if hi - lo < least:
                break
            over = surplus[least:] - np.minimum.accumulate(surplus[:len(surplus) - least])
            last = int(np.argmax(over))
            if over[last] < 0:
                break
            x, y = lo + int(np.argmin(surplus[:last + 1])), lo + last + least
            if gain[x:y].sum() >= MIN_RATIO:
                found.append((x, y))
                todo += [(lo, x), (y, hi)]
                break
    return found


def all_spans(buf: np.ndarray, offsets: np.ndarray, models: MarkovModels) -> list[tuple[int, int, int]]:
    """(start, kind, end) byte spans of a slice, sorted by start, then kind."""
    spans, _ = pattern_spans(buf, offsets)
    if spans:
        buf = buf.copy()
        for a, _, b in spans:
            buf[a:b] = 32
    return sorted(spans + [(a, 3, b) for a, b in models.secrets(buf, offsets)])


_SPANS = "array<struct<kind:string,start:int,end:int>>"


def find_secrets(docs: DataFrame, models: MarkovModels) -> DataFrame:
    """Per document: doc_id and ``spans``, sorted by start, then kind as in ``KINDS``."""
    kind_of = docs.schema["doc_id"].dataType.simpleString()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            starts, ends, kinds, counts = [], [], [], np.zeros(batch.num_rows, dtype=np.int64)
            for a, _, buf, offsets in T.slices(batch.column(1)):
                if not len(buf):
                    continue
                spans = all_spans(buf, offsets, models)
                if not spans:
                    continue
                points = np.zeros(len(buf) + 1, dtype=np.int64)
                np.cumsum((buf & 0xC0) != 0x80, out=points[1:])
                at = np.array([s for s, _, _ in spans])
                doc = np.searchsorted(offsets, at, "right") - 1
                base = points[offsets[doc]]
                starts.append(points[at] - base)
                ends.append(points[[e for _, _, e in spans]] - base)
                kinds += [KINDS[k] for _, k, _ in spans]
                np.add.at(counts, a + doc, 1)
            flat = pa.StructArray.from_arrays(
                [pa.array(kinds, pa.string()),
                 pa.array(np.concatenate(starts) if starts else np.zeros(0), pa.int32()),
                 pa.array(np.concatenate(ends) if ends else np.zeros(0), pa.int32())], names=["kind", "start", "end"])
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()), flat)
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], names=["doc_id", "spans"])

    return docs.select("doc_id", "text").mapInArrow(scan, f"doc_id {kind_of}, spans {_SPANS}")


def redact(docs: DataFrame, models: MarkovModels, mark: str = MARK) -> DataFrame:
    """``docs`` with every span (overlapping ones as one) replaced by ``mark``; ``n_chars`` follows the text."""
    place = docs.columns.index("text")
    sizes = docs.columns.index("n_chars") if "n_chars" in docs.columns else None
    schema = docs.schema

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            new: dict[int, str] = {}
            for a, _, buf, offsets in T.slices(batch.column(place)):
                pieces: dict[int, list[tuple[int, int]]] = {}
                for s, _, e in all_spans(buf, offsets, models) if len(buf) else ():
                    doc = int(np.searchsorted(offsets, s, "right")) - 1
                    held = pieces.setdefault(doc, [])
                    if held and s < held[-1][1]:
                        held[-1] = (held[-1][0], max(e, held[-1][1]))
                    else:
                        held.append((s, e))
                for doc, held in pieces.items():
                    out, at = [], int(offsets[doc])
                    for s, e in held:
                        out += [buf[at:s].tobytes().decode(), mark]
                        at = e
                    new[a + doc] = "".join(out) + buf[at:offsets[doc + 1]].tobytes().decode()
            if new:
                columns = list(batch.columns)
                rows = np.fromiter(new, dtype=np.int64)
                hit = np.zeros(batch.num_rows, dtype=bool)
                hit[rows] = True
                texts = [new[r] for r in np.flatnonzero(hit).tolist()]
                import pyarrow.compute as pc
                columns[place] = pc.replace_with_mask(columns[place], pa.array(hit), pa.array(texts, columns[place].type))
                if sizes is not None:
                    columns[sizes] = pc.replace_with_mask(columns[sizes], pa.array(hit),
                                                          pa.array([len(t) for t in texts], columns[sizes].type))
                batch = pa.RecordBatch.from_arrays(columns, schema=batch.schema)
            yield batch

    return docs.mapInArrow(clean, schema)


def _joined(spans: str) -> str:
    return f"array_join(transform({spans}, s -> concat(s.kind, ':', s.start, ':', s.end)), ',')"


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document: pattern counts, a digest of the pattern spans, and all spans."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    models = MarkovModels.train(sample_counts(docs))
    found = find_secrets(docs, models)
    count = [F.expr(f"cast(size(filter(spans, s -> s.kind = '{k}')) as bigint)").alias(f"n_{k}") for k in KINDS[:3]]
    return found.select("doc_id", *count,
                        F.expr(f"sha2({_joined('''filter(spans, s -> s.kind <> 'markov')''')}, 256)").alias("base_sha256"),
                        F.expr(_joined("spans")).alias("spans"))


QUERIES = {"op10_secret_scan": op10_secret_scan}
ORACLES: dict[str, str] = {}
