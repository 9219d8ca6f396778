"""Loads every module of this package that registers queries, and the pipeline."""

from __future__ import annotations

import corpus_pipeline
from textloom.llm import (  # noqa: F401
    bfd_pack,
    bpe_tables,
    cutting_stock,
    divergence,
    exact_dedup,
    fill_middle,
    multi_index,
    ngram_join,
    quality,
    secret_scan,
    shards,
    simplex_means,
    toxicity,
)
from textloom.llm.catalog import ORACLES, QUERIES, register

register("pipeline", corpus_pipeline.ORACLE_SQL)(corpus_pipeline.run)

__all__ = ["ORACLES", "QUERIES"]
