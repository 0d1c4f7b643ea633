"""Corpus statistics (A01-A06) and the stage funnel."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..schemas import StatisticsReport
from .validate import error_category

# The stages of a funnel, in order.
STAGES = ("Loaded", "Parsed", "Normalized", "Validated", "Filtered", "Merged")


def per_source(df: DataFrame) -> DataFrame:
    """(source, n, percent, first_ord) (A01, A02); the window is over sources only."""
    counts = df.groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.min("ord").alias("first_ord"))
    return counts.withColumn("percent", F.col("n") * 100.0 / F.sum("n").over(Window.partitionBy(F.lit(1))))


def turn_stats(df: DataFrame, messages: str = "messages") -> DataFrame:
    n = F.size(messages)
    return df.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.avg(n), F.lit(0.0)).alias("avg_turns"), F.coalesce(F.median(n), F.lit(0.0)).alias("median_turns"), F.coalesce(F.min(n), F.lit(0)).cast("long").alias("min_turns"), F.coalesce(F.max(n), F.lit(0)).cast("long").alias("max_turns"))


def length_stats(df: DataFrame, messages: str = "messages") -> DataFrame:
    """Mean code points of user and assistant messages, and the longest of all (A04), in one pass."""
    m = df.select(F.explode(messages).alias("m")).select("m.role", F.length("m.content").alias("n"))
    mean = lambda role: F.coalesce(F.avg(F.when(F.col("role") == role, F.col("n"))), F.lit(0.0))
    return m.agg(mean("user").alias("avg_user"), mean("assistant").alias("avg_assistant"), F.coalesce(F.max("n"), F.lit(0)).cast("long").alias("max_length"))


def context_distribution(df: DataFrame) -> DataFrame:
    """(context, n, first_ord): nulls count as ``None``; order by n descending, then first appearance."""
    return df.groupBy(F.coalesce("metadata.context", F.lit("None")).alias("context")).agg(F.count(F.lit(1)).alias("n"), F.min("ord").alias("first_ord"))


def statistics(df: DataFrame) -> StatisticsReport:
    """All of A01-A06; zeros for an empty corpus."""
    sources = per_source(df).orderBy("first_ord").collect()
    t, m = turn_stats(df).first(), length_stats(df).first()
    contexts = context_distribution(df).orderBy(F.desc("n"), "first_ord").collect()
    total = t["n"]
    return StatisticsReport(
        total, {r["source"]: r["n"] for r in sources}, {r["source"]: round(r["n"] / total * 100, 2) for r in sources}, round(t["avg_turns"], 2), float(t["median_turns"]), t["min_turns"], t["max_turns"],
        round(m["avg_user"], 2), round(m["avg_assistant"], 2), m["max_length"], {r["context"]: r["n"] for r in contexts},
    )


def stage_order(stage: Column) -> Column:
    return F.array_position(F.array(*map(F.lit, STAGES)), stage)


def stage_losses(counts: DataFrame) -> DataFrame:
    """(stage, dataset, n) rows -> with ``loss_percent`` against the stage before: null for the first, 0 where that was 0.

    Dataset ``Total`` is added. Unknown stages are ignored. One window per dataset over six stages.
    """
    known = counts.where(F.col("stage").isin(*STAGES))
    total = known.groupBy("stage").agg(F.sum("n").alias("n")).select("stage", F.lit("Total").alias("dataset"), "n")
    every = known.select("stage", "dataset", "n").unionByName(total).withColumn("stage_idx", stage_order(F.col("stage")))
    before = F.lag("n").over(Window.partitionBy("dataset").orderBy("stage_idx"))
    loss = F.when(before.isNull(), None).when(before > 0, (before - F.col("n")) / before * 100.0).otherwise(F.lit(0.0))
    return every.withColumn("loss_percent", loss)


def error_breakdown(checked: DataFrame) -> DataFrame:
    """(category, n, percent, first_ord, first_pos) of all errors (A12); ids are not made distinct. Ties in n fall by first appearance."""
    errors = checked.select("ord", F.posexplode("errors").alias("pos", "error")).withColumn("category", error_category(F.col("error")))
    out = errors.groupBy("category").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("ord", "pos")).alias("first"))
    return out.select("category", "n", (F.col("n") * 100.0 / F.sum("n").over(Window.partitionBy(F.lit(1)))).alias("percent"), F.col("first.ord").alias("first_ord"), F.col("first.pos").alias("first_pos"))


def error_examples(checked: DataFrame, most: int = 10) -> DataFrame:
    """(category, rn, ord, id): the first distinct conversations of each category (A13). The limit is the feature."""
    pairs = checked.select("ord", "id", F.explode("errors").alias("error")).select(error_category(F.col("error")).alias("category"), "ord", "id")
    first = pairs.groupBy("category", "id").agg(F.min("ord").alias("ord"))
    return first.withColumn("rn", F.row_number().over(Window.partitionBy("category").orderBy("ord"))).where(F.col("rn") <= most)
