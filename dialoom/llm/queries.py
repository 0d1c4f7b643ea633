"""Queries over the tables: one for each operator, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import chat_formatting, embedding_dedup, exact_dedup, html_extraction, lm_scoring, mixing, packing, sharding, simhash_dedup, toxicity
from .common import table

Query = Callable[[SparkSession, str], DataFrame]


def over(name: str, operator: Callable[..., DataFrame], *more: str) -> Query:
    """The operator, with its defaults, over the whole table (and ``more`` tables)."""
    return lambda spark, sf_dir: operator(*(table(spark, sf_dir, t) for t in (name, *more)))


QUERIES: dict[str, Query] = {
    "op1_exact_dedup": over("documents", exact_dedup.op1_exact_dedup),
    "op2_simhash_dedup": over("documents", simhash_dedup.op2_simhash_dedup),
    "op3_embedding_dedup": over("embeddings", embedding_dedup.op3_embedding_dedup),
    "op4_html_extraction": over("pages", html_extraction.op4_html_extraction),
    "op5_toxicity": over("documents", toxicity.op5_toxicity, "labels"),
    "op6_sharding": over("documents", sharding.op6_sharding),
    "op7_lm_scoring": over("documents", lm_scoring.op7_lm_scoring),
    "op8_chat_formatting": over("conversations", chat_formatting.op8_chat_formatting),
    "op9_packing": over("documents", packing.op9_packing),
    "op10_mixing": over("documents", mixing.op10_mixing),
}

ORACLES: dict[str, str] = {"op1_exact_dedup": exact_dedup.ORACLE}
