"""Parsers (P01-P12): raw rows to raw conversations, with rejects as data.

A parsed frame has: ord, id, source, split, context, attributes (VARIANT-free map of JSON text),
messages ARRAY<STRUCT<speaker_id, content, attributes>>, reject_reason (null: accepted).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import is_blank, py_strip
from ..functions.udfs import strict_json_errors
from ..schemas import ParseError, ParseReport

ParserFn = Callable[[DataFrame, str, str], DataFrame]
PARSED = ["ord", "id", "source", "split", "context", "attributes", "messages", "reject_reason"]


def require_columns(rows: DataFrame, needed: list[str]) -> None:
    """Missing columns are an error, but not for a split without rows."""
    missing = [c for c in needed if c not in rows.columns]
    if missing and not rows.isEmpty():
        raise ParseError(f"dataset schema lacks required columns: {missing}")


def _with(rows: DataFrame, names: list[str]) -> DataFrame:
    return rows.withColumns({c: F.lit(None).cast("string") for c in names if c not in rows.columns})


def _json_map(pairs: dict[str, Column]) -> Column:
    return F.create_map(*[x for k, v in pairs.items() for x in (F.lit(k), v.cast("string"))])


def parse_grouped(rows: DataFrame, dataset_id: str, split: str) -> DataFrame:
    """One row per utterance, grouped by ``conv_id`` and sorted by ``utterance_idx``.

    ``rows`` has ``row_idx``. The first bad turn in sorted order gives the reason; per turn the order is
    index, order, speaker, utterance. A blank utterance that is not empty passes here.
    """
    require_columns(rows, ["conv_id", "utterance_idx", "speaker_idx", "utterance"])
    rows = _with(rows, ["conv_id", "utterance_idx", "speaker_idx", "utterance", "context", "prompt", "selfeval", "tags"])
    keyed = rows.where(~is_blank(F.col("conv_id").cast("string")))
    turn = F.struct(
        F.col("utterance_idx").cast("long").alias("idx"), F.col("row_idx").alias("row"), F.col("speaker_idx").cast("string").alias("speaker"), F.col("utterance").cast("string").alias("text"),
        F.col("context").cast("string").alias("context"), F.col("prompt").cast("string").alias("prompt"), F.col("selfeval").cast("string").alias("selfeval"), F.col("tags").cast("string").alias("tags"),
    )
    grouped = keyed.groupBy(F.col("conv_id").cast("string").alias("id")).agg(F.array_sort(F.collect_list(turn)).alias("turns"), F.min("row_idx").alias("ord"))

    def reason(t: Column, k: Column) -> Column:
        before = F.get(F.col("turns"), k - 1)
        return (
            F.when(t["idx"].isNull(), F.lit("missing utterance_idx"))
            .when((k > 0) & (t["idx"] == before["idx"]), F.concat(F.lit("non-increasing utterance_idx at "), t["idx"].cast("string")))
            .when(is_blank(t["speaker"]), F.lit("missing speaker_idx"))
            .when(t["text"].isNull() | (t["text"] == ""), F.concat(F.lit("empty utterance at "), t["idx"].cast("string")))
        )

    reasons = F.transform("turns", reason)
    messages = F.transform("turns", lambda t: F.struct(t["speaker"].alias("speaker_id"), t["text"].alias("content"), _json_map({"selfeval": t["selfeval"], "tags": t["tags"], "utterance_idx": t["idx"]}).alias("attributes")))
    first = F.get(F.col("turns"), F.lit(0))
    return grouped.withColumn("reasons", reasons).select(
        "ord", "id", F.lit(dataset_id).alias("source"), F.lit(split).alias("split"), first["context"].alias("context"), _json_map({"context": first["context"], "prompt": first["prompt"], "split": F.lit(split)}).alias("attributes"),
        messages.alias("messages"), F.get(F.filter("reasons", lambda r: r.isNotNull()), F.lit(0)).alias("reject_reason"),
    )


def rows_without_key(rows: DataFrame) -> DataFrame:
    """Rows that the grouped parser skips for want of a conversation id: (row_idx, reject_reason)."""
    return rows.where(is_blank(F.col("conv_id").cast("string"))).select("row_idx", F.lit("missing conv_id").alias("reject_reason"))


DIALOG = "struct<dialog:array<map<string,string>>>"


def parse_json_dialog(rows: DataFrame, dataset_id: str, split: str, prefix: str = "dialog", strict_json: bool = False) -> DataFrame:
    """One JSON object per row in ``text``, with a list ``dialog`` of turns.

    ``strict_json`` takes the reasons from the standard library's parser (an Arrow UDF); otherwise they
    come from VARIANT, which differs for NaN, repeated keys and text behind the object.
    """
    require_columns(rows, ["text"])
    rows = _with(rows, ["text"]).withColumn("text", F.col("text").cast("string"))
    v = F.try_parse_json("text")
    base = rows.withColumn("v", v).withColumn("kind", F.schema_of_variant("v")).withColumn("dialog", F.try_variant_get("v", "$.dialog", "array<variant>"))
    base = base.withColumn("dialog_kind", F.schema_of_variant(F.try_variant_get("v", "$.dialog", "variant")))
    turns = F.transform("dialog", lambda t: F.struct(F.schema_of_variant(t).alias("kind"), F.try_variant_get(t, "$.text", "string").alias("text"), F.try_variant_get(t, "$.speaker", "string").alias("speaker"), F.to_json(t).alias("json")))
    base = base.withColumn("turns", turns)

    def reason(t: Column) -> Column:
        return (
            F.when(~F.coalesce(t["kind"].startswith("OBJECT"), F.lit(False)), F.lit("turn is not an object"))
            .when(t["text"].isNull() | (t["text"] == ""), F.lit("empty text"))
            .when(is_blank(t["speaker"]), F.lit("missing speaker"))
        )

    native = (
        F.when(F.col("text").isNull(), F.lit("missing text"))
        .when(F.col("v").isNull(), F.lit("invalid json"))
        .when(~F.col("kind").startswith("OBJECT"), F.lit("not an object"))
        .when(~F.coalesce(F.col("dialog_kind").startswith("ARRAY"), F.lit(False)), F.lit("missing dialog"))
        .otherwise(F.get(F.filter(F.transform("turns", reason), lambda r: r.isNotNull()), F.lit(0)))
    )
    without = lambda j, drop: F.map_filter(F.from_json(j, "map<string,string>"), lambda k, _: ~k.isin(*drop))
    messages = F.transform("turns", lambda t: F.struct(t["speaker"].alias("speaker_id"), t["text"].alias("content"), without(t["json"], ("text", "speaker")).alias("attributes")))
    attributes = F.map_concat(F.coalesce(without(F.to_json("v"), ("dialog", "split")), F.create_map().cast("map<string,string>")), F.create_map(F.lit("split"), F.lit(split)))
    return base.select(
        F.col("row_idx").alias("ord"), F.concat(F.lit(f"{prefix}_{split}_"), F.col("row_idx").cast("string")).alias("id"), F.lit(dataset_id).alias("source"), F.lit(split).alias("split"),
        F.try_variant_get("v", "$.emotion_type", "string").alias("context"), attributes.alias("attributes"), messages.alias("messages"), (strict_json_errors("text") if strict_json else native).alias("reject_reason"),
    )


def parse_pairs(rows: DataFrame, dataset_id: str, split: str, prefix: str = "pair") -> DataFrame:
    """``Context`` and ``Response`` columns become two messages (P09); ids keep the raw row index, so rejects leave gaps."""
    require_columns(rows, ["Context", "Response"])
    rows = _with(rows, ["Context", "Response"])
    none = F.create_map().cast("map<string,string>")
    say = lambda name: F.struct(F.lit(name).alias("speaker_id"), F.col(name).cast("string").alias("content"), none.alias("attributes"))
    reason = F.when(is_blank(F.col("Context").cast("string")), F.lit("empty or missing Context")).when(is_blank(F.col("Response").cast("string")), F.lit("empty or missing Response"))
    return rows.select(
        F.col("row_idx").alias("ord"), F.concat(F.lit(f"{prefix}_{split}_"), F.col("row_idx").cast("string")).alias("id"), F.lit(dataset_id).alias("source"), F.lit(split).alias("split"), F.lit(None).cast("string").alias("context"),
        _json_map({"split": F.lit(split)}).alias("attributes"), F.array(say("Context"), say("Response")).alias("messages"), reason.alias("reject_reason"),
    )


def accepted(parsed: DataFrame) -> DataFrame:
    return parsed.where("reject_reason is null").drop("reject_reason")


def rejects(parsed: DataFrame) -> DataFrame:
    """(ord, id, reject_reason, warning) of what was skipped (P10)."""
    warning = F.concat(F.lit("Skipping conversation '"), "id", F.lit("': "), "reject_reason")
    return parsed.where("reject_reason is not null").select("ord", "id", "reject_reason", warning.alias("warning"))


def parse_stats(parsed: DataFrame) -> DataFrame:
    """One row: conversations, skipped, mean, most and least turns of the accepted."""
    turns = F.when(F.col("reject_reason").isNull(), F.size("messages"))
    return parsed.agg(
        F.count_if(F.col("reject_reason").isNull()).alias("num_conversations"), F.count_if(F.col("reject_reason").isNotNull()).alias("skipped_conversations"),
        F.coalesce(F.avg(turns), F.lit(0.0)).alias("avg_turns"), F.coalesce(F.max(turns), F.lit(0)).cast("long").alias("max_turns"), F.coalesce(F.min(turns), F.lit(0)).cast("long").alias("min_turns"),
    )


def parse_report(parsed: DataFrame, dataset_id: str) -> ParseReport:
    """The report lists every warning; where rejects may be many, ``rejects`` is the table to write instead."""
    s = parse_stats(parsed).first()
    warnings = [r["warning"] for r in rejects(parsed).orderBy("ord").toLocalIterator()]
    return ParseReport(dataset_id, s["num_conversations"], s["avg_turns"], s["max_turns"], s["min_turns"], s["skipped_conversations"], warnings)


class Registry:
    """Implementations by name: exact, else without regard to case, by the full name or its last path segment."""

    def __init__(self, what: str, segments: bool = True):
        self.what, self.segments, self._by = what, segments, {}

    def register(self, name: str, made: object) -> None:
        self._by[name] = made

    def get(self, name: str):
        if name in self._by:
            return self._by[name]
        low = name.lower()
        for key, made in self._by.items():
            if key.lower() == low or self.segments and key.split("/")[-1].lower() == low.split("/")[-1]:
                return made
        raise KeyError(f"no {self.what} registered for {name!r}; registered: {list(self._by)}")


PARSERS = Registry("parser")
PARSERS.register("grouped", parse_grouped)
PARSERS.register("json_dialog", parse_json_dialog)
PARSERS.register("pairs", parse_pairs)
__all__ = ["PARSED", "PARSERS", "ParserFn", "Registry", "accepted", "parse_grouped", "parse_json_dialog", "parse_pairs", "parse_report", "parse_stats", "py_strip", "rejects", "require_columns", "rows_without_key"]
