"""Normalisers (N01-N06): raw conversations to the canonical row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import is_blank
from ..schemas import SPAN, ParseError
from .curate import runs
from .parse import Registry


def alternating_roles(messages: Column) -> Column:
    """The first speaker is the user; the role flips whenever the speaker changes."""

    def said(run: Column, k: Column) -> Column:
        role = F.when(k % 2 == 0, F.lit("user")).otherwise(F.lit("assistant"))
        return F.transform(run, lambda m: F.struct(role.alias("role"), m["content"].alias("content")))

    return F.flatten(F.transform(runs(messages, "speaker_id"), said))


def fixed_roles(messages: Column, user: str) -> Column:
    """One speaker is the user, all others the assistant."""
    return F.transform(messages, lambda m: F.struct(F.when(m["speaker_id"] == user, F.lit("user")).otherwise(F.lit("assistant")).alias("role"), m["content"].alias("content")))


def canonical(parsed: DataFrame, messages: Column, dataset_index: int = 0) -> DataFrame:
    """The canonical row with its checks (N04, N05): ``quarantine_reason`` is null for rows that may go on."""
    out = parsed.withColumn("messages", messages)
    reason = (
        F.when(is_blank(F.col("id")), F.lit("blank id"))
        .when(is_blank(F.col("source")), F.lit("blank source"))
        .when(F.size("messages") <= 0, F.lit("no messages"))
        .when(F.exists("messages", lambda m: ~F.coalesce(m["role"].isin("user", "assistant"), F.lit(False))), F.lit("invalid role"))
        .when(F.exists("messages", lambda m: is_blank(m["content"])), F.lit("blank content"))
    )
    metadata = F.struct(F.col("split"), F.col("source").alias("source_dataset"), F.col("id").alias("original_id"), F.col("context"))
    return out.select((F.col("ord") + F.lit(dataset_index * SPAN)).alias("ord"), "id", "source", metadata.alias("metadata"), "messages", reason.alias("quarantine_reason"))


def normalize_alternating(parsed: DataFrame, dataset_index: int = 0) -> DataFrame:
    return canonical(parsed, alternating_roles(F.col("messages")), dataset_index)


def normalize_dialog(parsed: DataFrame, dataset_index: int = 0) -> DataFrame:
    return canonical(parsed, fixed_roles(F.col("messages"), "usr"), dataset_index)


def normalize_pairs(parsed: DataFrame, dataset_index: int = 0) -> DataFrame:
    return canonical(parsed, fixed_roles(F.col("messages"), "Context"), dataset_index)


def split_quarantine(df: DataFrame, strict: bool = False) -> tuple[DataFrame, DataFrame]:
    """(rows that go on, quarantined rows); ``strict`` fails on the first bad row instead."""
    if strict:
        bad = df.where("quarantine_reason is not null").orderBy("ord").limit(1).collect()
        if bad:
            raise ParseError(f"conversation {bad[0]['id']!r}: {bad[0]['quarantine_reason']}")
    return df.where("quarantine_reason is null").drop("quarantine_reason"), df.where("quarantine_reason is not null")


NORMALIZERS = Registry("normalizer")
NORMALIZERS.register("grouped", normalize_alternating)
NORMALIZERS.register("json_dialog", normalize_dialog)
NORMALIZERS.register("pairs", normalize_pairs)
