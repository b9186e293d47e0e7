"""The registered queries of the subpackage and their SQL twins."""

from __future__ import annotations

import importlib

import corpus_pipeline

MODULES = ("url_filter", "secret_scan", "toxicity", "packing", "warc_zip", "jaccard_join", "decontaminate", "katz", "suffix_dedup", "bm25",
           "mixing", "repeats", "spelling")


def _gather(what: str) -> dict:
    out: dict = {}
    for name in MODULES:
        out.update(getattr(importlib.import_module(f"loglens.llm.{name}"), what))
    return out


def llm_queries() -> dict:
    return _gather("QUERIES") | {"pipeline": corpus_pipeline.run}


def llm_oracles() -> dict:
    return _gather("ORACLES") | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})
