"""Validation and filtering."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import is_blank
from ..schemas import FilterError
from .parse import Registry

# The messages that reports show, and the categories they fall into.
ID_ERROR = "Conversation ID is null, empty or missing."
SOURCE_ERROR = "Conversation source is null, empty or missing."
METADATA_ERROR = "Conversation metadata is null or missing."
MESSAGES_ERROR = "Conversation messages list is null or missing."
CATEGORIES = (
    ("fewer than 2 messages", "Conversation has fewer than 2 messages"),
    ("invalid role:", "Message has invalid role"),
    ("empty or null content", "Message has empty/null content"),
    ("Conversation ID is null, empty or missing", "Conversation ID is null/missing"),
    ("Conversation source is null, empty or missing", "Conversation source is null/missing"),
)


def validation_errors(id_: Column, source: Column, metadata: Column, messages: Column) -> Column:
    """All structural errors of a conversation, in order: ARRAY<STRING>, empty if there are none."""
    maybe = lambda bad, text: F.when(bad, F.array(F.lit(text)))
    at = lambda i: F.concat(F.lit("Message at index "), i.cast("string"))

    def of_message(m: Column, i: Column) -> Column:
        role_bad = ~F.coalesce(m["role"].isin("user", "assistant"), F.lit(False))
        role = F.when(role_bad, F.concat(at(i), F.lit(" has invalid role: '"), F.coalesce(m["role"], F.lit("None")), F.lit("'.")))
        content = F.when(is_blank(m["content"]), F.concat(at(i), F.lit(" has empty or null content.")))
        return F.when(m.isNull(), F.array(F.concat(at(i), F.lit(" is null.")))).otherwise(F.filter(F.array(role, content), lambda e: e.isNotNull()))

    few = F.when(F.size(messages) < 2, F.array(F.concat(F.lit("Conversation has fewer than 2 messages (got "), F.size(messages).cast("string"), F.lit(")."))))
    none = F.array().cast("array<string>")
    head = [F.coalesce(x, none) for x in (maybe(is_blank(id_), ID_ERROR), maybe(is_blank(source), SOURCE_ERROR), maybe(metadata.isNull(), METADATA_ERROR))]
    tail = F.when(messages.isNull(), F.array(F.lit(MESSAGES_ERROR))).otherwise(F.concat(F.coalesce(few, none), F.flatten(F.transform(messages, of_message))))
    return F.concat(*head, tail)


def validated(df: DataFrame) -> DataFrame:
    return df.withColumn("errors", validation_errors(F.col("id"), F.col("source"), F.col("metadata"), F.col("messages")))


def validation_report(checked: DataFrame) -> DataFrame:
    """(id, errors): of repeated ids the last one by ``ord`` counts."""
    return checked.groupBy("id").agg(F.max_by("errors", "ord").alias("errors"))


def validation_counts(checked: DataFrame) -> DataFrame:
    return checked.agg(F.count(F.lit(1)).alias("num_checked"), F.count_if(F.size("errors") == 0).alias("num_valid"), F.count_if(F.size("errors") > 0).alias("num_invalid"))


def filter_valid(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(kept, removed (ord, id)) row by row; right where ids are unique, and without a shuffle."""
    return checked.where(F.size("errors") == 0).drop("errors"), checked.where(F.size("errors") > 0).select("ord", "id")


def filter_by_report(df: DataFrame, report: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(kept, removed) by an id-keyed report; an id without a result is an error."""
    missing = df.join(report, "id", "left_anti").orderBy("ord").limit(1).collect()
    if missing:
        raise FilterError(f"conversation {missing[0]['id']!r} is missing from the validation report")
    joined = df.join(report.select("id", F.col("errors").alias("_errors")), "id")
    return joined.where(F.size("_errors") == 0).select(*df.columns), joined.where(F.size("_errors") > 0).select("ord", "id")


def error_category(error: Column) -> Column:
    out = F.lit(None).cast("string")
    for part, category in CATEGORIES:
        out = F.coalesce(out, F.when(F.contains(error, F.lit(part)), F.lit(category)))
    return F.coalesce(out, error)


VALIDATORS = Registry("validator", segments=False)
VALIDATORS.register("conversation", validated)
FILTERS = Registry("filter", segments=False)
FILTERS.register("conversation", filter_by_report)
