"""Exact deduplication of conversations, first one wins."""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import conversation_hash


def first_wins(df: DataFrame, digest: Column, order: str = "ord", carry: tuple[str, ...] = ("id", "source")) -> DataFrame:
    """Adds ``hash`` and ``kept`` (struct of ``order`` and ``carry`` of the first row with that hash).

    The first row of each hash comes from an aggregation that combines before the shuffle, so copies of one
    content, however many, meet as one row per task; a join that can be split brings it back.
    """
    hashed = df.withColumn("hash", digest)
    first = hashed.groupBy("hash").agg(F.min(F.struct(order, *carry)).alias("kept"))
    return hashed.join(first, "hash")


def deduplicate(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(kept rows, removed rows: ord, kept and removed id and source, hash)."""
    marked = first_wins(df, conversation_hash(F.col("messages")))
    kept = marked.where(F.col("ord") == F.col("kept.ord")).select(*df.columns)
    removed = marked.where(F.col("ord") != F.col("kept.ord")).select(
        "ord", F.col("kept.id").alias("kept_conversation_id"), F.col("id").alias("removed_conversation_id"), F.col("kept.source").alias("kept_source"), F.col("source").alias("removed_source"), "hash")
    return kept, removed


def manifest(before: int, removed: int, version: str) -> dict:
    return {
        "dataset_version": version,
        "created_at": datetime.now(UTC).isoformat(),
        "total_conversations_before": before,
        "total_conversations_after": before - removed,
        "duplicates_removed": removed,
        "duplicate_percentage": round(removed / before * 100.0, 2) if before else 0.0,
    }
