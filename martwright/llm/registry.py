"""Queries and SQL of the operators in this subpackage (``(spark, sf_dir) -> DataFrame``)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (alignment, backoff_lm, containment, fm_dedup, line_runs, ngram_join, period_runs, piece_codec, secret_scan, suffix_levels,
               threshold_topk, token_store, toxicity)
from .ship import ship

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_secret_scan": secret_scan.op1,
    "op2_token_store": token_store.op2,
    "op3_decontamination": containment.op3,
    "op4_line_dedup": line_runs.op4,
    "op5_suffix_dedup": suffix_levels.op5,
    "op6_sentencepiece": piece_codec.op6,
    "op7_threshold_topk": threshold_topk.op7,
    "op8_lm_scores": backoff_lm.op8,
    "op8_lm_scores_order3": backoff_lm.op8_order3,
    "op9_ngram_join": ngram_join.op9,
    "op10_toxicity": toxicity.op10,
    "op11_fm_dedup": fm_dedup.op11,
    "op12_period_runs": period_runs.op12,
    "op13_alignment": alignment.op13,
}

ORACLE_SQL: dict[str, str] = {
    "op3_decontamination": containment.OP3_SQL,
    "op4_line_dedup": line_runs.OP4_SQL,
    "op7_threshold_topk": threshold_topk.OP7_SQL,
    "op8_lm_scores": backoff_lm.OP8_SQL,
    "op8_lm_scores_order3": backoff_lm.OP8_ORDER3_SQL,
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: lambda spark, sf_dir, f=f: f(ship(spark), sf_dir) for k, f in QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE_SQL)
