"""Toxicity: a convolutional text classifier, trained in numpy.

Each word is the sum of three hashed embeddings (the word, its first four and
its first five bytes, so that inflected forms share their stem's). Filters of
several widths slide over the words of a whole text; each filter's maximum
over the text feeds a logistic output. Thresholds are calibrated per language
on all labelled rows kept out of the training.

Training takes a bounded sample: at most ``TRAIN_PER_CLASS`` labelled rows of
each class, the ones with the smallest hash of their id (the bound and the
order are parameters of ``fit``), less every ``CALIBRATION_PARTS``-th of them.
Thresholds are not sampled: every other labelled row is scored and counted by
language, class and score to ``CALIBRATION_DIGITS`` digits. A class's counts
weigh as much as all its labelled rows of the language, trained ones included,
so that the F1 is the one at the labels' own class shares, whatever part of a
class the training took. Scoring is one pass over all texts, without a
shuffle, in slices of a few MB; the model has a fixed size.

Defined results: a null or empty text scores as a text in which no filter
answers; repeated rows score alike and calibrate once each; labelled ids
without a document and null labels are ignored; with one class or none in the sample every score is that
class's share (0.5 without rows); languages with fewer than
``LEAST_CALIBRATION`` toxic calibration rows, and null languages, use the
threshold of all languages together, or the default if that has too few as well. Empty in, empty out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loglens.llm import text as T

TRAIN_PER_CLASS = 1500
CALIBRATION_PARTS = 5          # one part in so many of the sample is not trained on
CALIBRATION_DIGITS = 4
LEAST_CALIBRATION = 10
DEFAULT_THRESHOLD = 0.7
BUCKETS = 1 << 16
DIMENSIONS = 8
WIDTHS = (1, 2, 3)
FILTERS = 8
EPOCHS = 12
BATCH = 16
RATE = 0.05
STEMS = (4, 5)
SEED = 7
LEAST_TEXTS = 3          # training texts a feature must occur in


def token_ids(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashed ids (one row per word, one column per feature) and the word offsets of the texts."""
    starts, ends, first = T.word_spans(buf, offsets)
    if not len(starts):
        return np.zeros((0, 1 + len(STEMS)), np.int64), first
    sums = T.prefix_hash(T.LOWER[buf])
    columns = [T.span_hash(sums, starts, ends)]
    columns += [T.mix(T.span_hash(sums, starts, np.minimum(starts + k, ends)) + np.uint64(k)) for k in STEMS]
    return (np.stack(columns, axis=1) >> np.uint64(48)).astype(np.int64), first


class TextCNN:
    """Embeddings ``e``, filters ``w[k]`` (width k, flattened input) with bias, output ``v``, ``b``."""

    def __init__(self, seed: int = SEED):
        rng = np.random.default_rng(seed)
        self.e = (rng.standard_normal((BUCKETS, DIMENSIONS)) * 0.05).astype(np.float32)
        self.w = {k: (rng.standard_normal((k, DIMENSIONS, FILTERS)) * 0.3).astype(np.float32) for k in WIDTHS}
        self.c = np.zeros(FILTERS * len(WIDTHS), dtype=np.float32)
        self.v = (np.abs(rng.standard_normal(FILTERS * len(WIDTHS))) * 0.2 *
                  np.where(np.arange(FILTERS * len(WIDTHS)) % 2, 1, -1)).astype(np.float32)
        self.b = np.float32(0)
        self.constant: float | None = None

    def pooled(self, ids: np.ndarray, first: np.ndarray, where: bool = False):
        """Per text the rectified maximum of every filter; with ``where`` also its position (-1 for an empty text)."""
        n = len(first) - 1
        out = np.zeros((n, FILTERS * len(WIDTHS)), dtype=np.float32)
        best = np.full(out.shape, -1, dtype=np.int64) if where else None
        if len(ids):
            full = np.flatnonzero(first[1:] > first[:-1])
            lo = first[:-1][full]
            x = self.e[ids[:, 0]]
            for j in range(1, ids.shape[1]):
                x = x + self.e[ids[:, j]]
            room = np.repeat(first[1:], np.diff(first)) - np.arange(len(ids))
            for i, k in enumerate(WIDTHS):
                y = x @ self.w[k][0]
                for j in range(1, k):
                    part = x[j:] @ self.w[k][j]
                    part[room[:-j] <= j] = 0
                    y[:-j] += part
                cols = slice(i * FILTERS, (i + 1) * FILTERS)
                y += self.c[cols]
                out[full, cols] = np.maximum(np.maximum.reduceat(y, lo, axis=0), 0)
                if where:
                    for t, a, z in zip(full, lo, first[1:][full], strict=True):
                        best[t, cols] = a + y[a:z].argmax(axis=0)
        return (out, best) if where else out

    def scores(self, ids: np.ndarray, first: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(first) - 1, self.constant)
        z = self.pooled(ids, first) @ self.v + self.b
        return 1 / (1 + np.exp(-np.clip(z.astype(np.float64), -40, 40)))

    def train(self, texts: list[np.ndarray], toxic: np.ndarray, epochs: int = EPOCHS, seed: int = SEED) -> TextCNN:
        """Adagrad on the log loss, classes weighted alike; gradients flow through each filter's maximum only."""
        if len(set(toxic.tolist())) < 2:
            self.constant = float(toxic.mean()) if len(toxic) else 0.5
            return self
        rng = np.random.default_rng(seed)
        # What a single text has can't be told from chance: such features stay at zero.
        spread = np.zeros(BUCKETS, dtype=np.int64)
        for t in texts:
            spread[np.unique(t)] += 1
        known = spread >= LEAST_TEXTS
        self.e[~known] = 0
        share = toxic.mean()
        weight = np.where(toxic == 1, 0.5 / share, 0.5 / (1 - share)).astype(np.float32)
        seen = {"e": np.full_like(self.e, 1e-6), "c": np.full_like(self.c, 1e-6), "v": np.full_like(self.v, 1e-6), "b": 1e-6}
        seen |= {k: np.full_like(self.w[k], 1e-6) for k in WIDTHS}
        for _ in range(epochs):
            for rows in np.array_split(rng.permutation(len(texts)), -(-len(texts) // BATCH)):
                first = np.concatenate([[0], np.cumsum([len(texts[r]) for r in rows])])
                ids = np.concatenate([texts[r] for r in rows])
                out, best = self.pooled(ids, first, where=True)
                p = 1 / (1 + np.exp(-np.clip(out @ self.v + self.b, -40, 40)))
                dz = (p - toxic[rows]) * weight[rows] / len(rows)
                dv, db = out.T @ dz, dz.sum()
                dy = dz[:, None] * self.v * (out > 0)
                de: list[tuple[np.ndarray, np.ndarray]] = []
                for i, k in enumerate(WIDTHS):
                    cols = slice(i * FILTERS, (i + 1) * FILTERS)
                    t, f = np.nonzero(dy[:, cols])
                    g = dy[:, cols][t, f]
                    dw = np.zeros_like(self.w[k])
                    for j in range(k):
                        at = best[:, cols][t, f] + j
                        ok = at < first[t + 1]
                        feats = ids[at[ok]]
                        x = self.e[feats].sum(axis=1)
                        np.add.at(dw[j].T, f[ok], g[ok, None] * x)
                        dx = g[ok, None] * self.w[k][j][:, f[ok]].T
                        de += [(feats[:, q], dx) for q in range(feats.shape[1])]
                    seen[k] += dw * dw
                    self.w[k] -= RATE * dw / np.sqrt(seen[k])
                dc = dy.sum(axis=0)
                if de:
                    where, inverse = np.unique(np.concatenate([a for a, _ in de]), return_inverse=True)
                    total = np.zeros((len(where), DIMENSIONS), dtype=np.float32)
                    np.add.at(total, inverse, np.concatenate([d for _, d in de]))
                    where, total = where[known[where]], total[known[where]]
                    seen["e"][where] += total * total
                    self.e[where] -= RATE * total / np.sqrt(seen["e"][where])
                for name, grad in (("c", dc), ("v", dv)):
                    seen[name] += grad * grad
                    getattr(self, name).__isub__(RATE * grad / np.sqrt(seen[name]))
                seen["b"] += db * db
                self.b = np.float32(self.b - RATE * db / np.sqrt(seen["b"]))
        return self


def best_threshold(scores: np.ndarray, toxic: np.ndarray, weights: np.ndarray | None = None) -> float:
    """The score cut with the best F1 (the middle of the gap below it); the default without positive weight."""
    if weights is None:
        if toxic.sum() < LEAST_CALIBRATION:
            return DEFAULT_THRESHOLD
        weights = np.ones(len(scores))
    order = np.argsort(-scores, kind="stable")
    s, w = scores[order], weights[order]
    hits = np.cumsum(w * toxic[order])
    f1 = 2 * hits / (np.cumsum(w) + hits[-1])
    f1[:-1][s[:-1] == s[1:]] = -1
    i = int(np.argmax(f1))
    below = s[i + 1] if i + 1 < len(s) else 0.0
    return float((s[i] + below) / 2)


def threshold_of_counts(counts: pd.DataFrame) -> float | None:
    """The best threshold of rows (toxic, score, n), where rows without a score were trained on: they
    only add to their class's share. None with too few toxic rows to calibrate on."""
    left = counts[counts["score"].notna()]
    toxic, n = left["toxic"].to_numpy() == 1, left["n"].to_numpy(dtype=np.float64)
    if n[toxic].sum() < LEAST_CALIBRATION:
        return None
    for label in (True, False):
        if n[toxic == label].sum():
            n[toxic == label] *= counts["n"][(counts["toxic"] == 1) == label].sum() / n[toxic == label].sum()
    # Cuts lie between two rounded scores, so rounding again only removes what the division added.
    return round(best_threshold(left["score"].to_numpy(dtype=np.float64), toxic, n), CALIBRATION_DIGITS + 2)


class ToxicityModel:
    def __init__(self, net: TextCNN, thresholds: dict[str | None, float]):
        self.net, self.thresholds = net, thresholds

    def threshold(self, lang: Column) -> Column:
        out = F.lit(self.thresholds[None])
        for name, cut in self.thresholds.items():
            if name is not None:
                out = F.when(lang == name, cut).otherwise(out)
        return out


def fit(docs: DataFrame, labels: DataFrame, per_class: int = TRAIN_PER_CLASS, epochs: int = EPOCHS) -> ToxicityModel:
    """Train on ``docs`` (doc_id, text, lang) with ``labels`` (doc_id, toxic), of which at most
    ``per_class`` rows of each class, by the smallest hash of the id, are trained on; all others calibrate."""
    known = labels.select("doc_id", "toxic").where("toxic in (0, 1) and doc_id is not null").dropDuplicates(["doc_id"])
    picked = None
    for label in (0, 1):
        part = known.where(F.col("toxic") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)
        picked = part if picked is None else picked.unionByName(part)

    def ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for a, b, buf, offsets in T.slices(batch.column("text")):
                found, first = token_ids(buf, offsets)
                rows += [found[first[i]:first[i + 1]].astype(np.uint16).tobytes() for i in range(b - a)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("lang"), batch.column("toxic"),
                                              pa.array(rows, pa.binary())], names=["doc_id", "lang", "toxic", "ids"])

    # The sample has at most 2 * per_class rows, so it is broadcast.
    sample = docs.select("doc_id", "text", "lang").join(F.broadcast(picked), "doc_id").select("doc_id", "lang", "toxic", "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    got = sample.mapInArrow(ids, f"doc_id {kind}, lang string, toxic int, ids binary").toPandas()
    got = got.sort_values("doc_id", kind="stable").drop_duplicates("doc_id").reset_index(drop=True)
    texts = [np.frombuffer(x, np.uint16).reshape(-1, 1 + len(STEMS)).astype(np.int64) for x in got["ids"]]
    toxic = got["toxic"].to_numpy(dtype=np.float32)
    turn = np.zeros(len(got), dtype=bool)
    for label in (0, 1):
        turn[np.flatnonzero(toxic == label)[CALIBRATION_PARTS - 1::CALIBRATION_PARTS]] = True
    kept = np.flatnonzero(~turn)
    net = TextCNN().train([texts[i] for i in kept], toxic[kept], epochs)
    trained = docs.sparkSession.createDataFrame([(x, True) for x in got["doc_id"].iloc[kept].tolist()], f"doc_id {kind}, trained boolean")
    return ToxicityModel(net, calibrate(docs, known, trained, net))


def calibrate(docs: DataFrame, known: DataFrame, trained: DataFrame, net: TextCNN) -> dict[str | None, float]:
    """Thresholds per language (None: all together) from all rows of ``known`` (doc_id, toxic) with a document."""
    # Scored before the join: it then moves no text. At most 2 * (10 ** CALIBRATION_DIGITS + 2) counts a language.
    scored = score(docs.select("doc_id", "text", "lang"), ToxicityModel(net, {})).select("doc_id", "lang", "score")
    rows = scored.join(known, "doc_id").join(F.broadcast(trained), "doc_id", "left")
    cell = F.when(F.col("trained").isNull(), F.round("score", CALIBRATION_DIGITS))
    counts = rows.groupBy("lang", "toxic", cell.alias("score")).agg(F.count("*").alias("n")).toPandas()
    every = threshold_of_counts(counts)
    thresholds: dict[str | None, float] = {None: DEFAULT_THRESHOLD if every is None else every}
    for name, own in counts[counts["lang"].notna()].groupby("lang", sort=True):
        cut = threshold_of_counts(own)
        if cut is not None:
            thresholds[name] = cut
    return thresholds


def score(docs: DataFrame, model: ToxicityModel, name: str = "score") -> DataFrame:
    """``docs`` with a column ``name`` of scores (an existing one is replaced); the text alone decides it."""
    docs = docs.drop(name)
    place = docs.columns.index("text")
    net = model.net

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [net.scores(*token_ids(buf, offsets)) for _, _, buf, offsets in T.slices(batch.column(place))]
            scores = np.round(np.concatenate(parts), 6) if parts else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())],
                                             names=[*batch.schema.names, name])

    from pyspark.sql.types import DoubleType, StructField, StructType
    schema = StructType([*docs.schema.fields, StructField(name, DoubleType())])
    return docs.mapInArrow(run, schema)


def accepted(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """``docs`` without the documents that reach their language's threshold."""
    mark = "_toxicity"
    return score(docs, model, mark).where(F.col(mark) < model.threshold(F.col("lang"))).select(*docs.columns)


def fold(doc_id: Column, parts: int) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % parts


def op7_toxicity_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document; ``flagged`` applies the language's calibrated threshold."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = fit(docs, labels.where(fold(F.col("doc_id"), 3) != 1))
    return score(docs, model).select(
        "doc_id", F.coalesce(fold(F.col("doc_id"), 3) == 1, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= DEFAULT_THRESHOLD).cast("int").alias("predicted"),
        (F.col("score") >= model.threshold(F.col("lang"))).cast("int").alias("flagged"))


QUERIES = {"op7_toxicity_cnn": op7_toxicity_cnn}
ORACLES: dict[str, str] = {}
