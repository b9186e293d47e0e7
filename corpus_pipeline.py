"""The training-corpus pipeline: five stages from raw documents to packed sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, written as
Parquet and read again as the next stage's documents. All but the last return
the columns of ``documents``:

1. toxicity: documents at or above their language's calibrated threshold go;
2. near duplicates: of each group of documents linked by a 5-word-shingle
   Jaccard similarity of 0.8 or more, the one with the smallest doc_id stays;
3. decontamination: documents that hold a benchmark item go;
4. secrets: found secrets are replaced in the text;
5. packing: every piece of every document with its place in a sequence.

Rows without a doc_id take part in all stages, and so does each of several
texts under one doc_id: stages 2 and 3 tell such rows apart by their text.
Rows alike in doc_id and text are one document to stage 2. Empty in, empty out.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from loglens.llm import decontaminate, jaccard_join, packing, secret_scan, toxicity
from loglens.llm.store import small_batches, stored


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.accepted(docs, model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return jaccard_join.one_per_group(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return decontaminate.clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return secret_scan.redact(docs, secret_scan.MarkovModels.train(secret_scan.sample_counts(docs)))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return packing.pack_documents(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("jaccard_join", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secret_scan", redact_secrets),
    ("best_fit_packing", pack_sequences),
]

# Trained and hashed stages have no SQL form; tests hold every stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
