"""Token statistics of chat records."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import WHITE_CLASS, py_strip
from ..schemas import TokenReport
from ..sources.readers import with_row_index

# The histogram's upper bounds and names, and the context lengths that are offered first.
BINS = ((128, "0-128"), (256, "129-256"), (512, "257-512"), (1024, "513-1024"), (2048, "1025-2048"), (4096, "2049-4096"), (8192, "4097-8192"), (None, "8193+"))
CONTEXTS = (1024, 2048, 4096, 8192)


def turn_template(messages: Column) -> Column:
    """User and assistant (or model) turns between turn marks, contents stripped; other roles vanish."""
    said = F.filter(messages, lambda m: m["role"].isin("user", "assistant", "model"))
    name = lambda m: F.when(m["role"] == "user", F.lit("user")).otherwise(F.lit("model"))
    return F.concat_ws("", F.transform(said, lambda m: F.concat(F.lit("<start_of_turn>"), name(m), F.lit("\n"), py_strip(m["content"]), F.lit("<end_of_turn>\n"))))


def plain_template(messages: Column) -> Column:
    """``role: content`` lines."""
    return F.concat_ws("\n", F.transform(messages, lambda m: F.concat(m["role"], F.lit(": "), m["content"])))


def char_count(text: Column) -> Column:
    """The built-in counter: characters other than white space."""
    return F.length(F.regexp_replace(text, WHITE_CLASS, "")).cast("long")


def token_counts(df: DataFrame, template: Callable[[Column], Column] = turn_template, counter: Callable[[Column], Column] = char_count) -> DataFrame:
    """Adds ``tokens`` and ``turns``; template and counter are pluggable Column functions."""
    return df.withColumn("tokens", counter(template(F.col("messages")))).withColumn("turns", F.size("messages").cast("long"))


def bin_name(tokens: Column) -> Column:
    out = F.lit(None).cast("string")
    for top, name in BINS:
        out = F.coalesce(out, F.when(tokens <= top, F.lit(name)) if top is not None else F.lit(name))
    return out


def histogram(counted: DataFrame) -> DataFrame:
    """(bin, n) for all eight bins, empty ones too: one aggregation, then a list of eight."""
    names = [name for _, name in BINS]
    sums = counted.agg(*[F.count_if(bin_name(F.col("tokens")) == name).alias(name) for name in names])
    rows = F.array(*[F.struct(F.lit(k).alias("bin_idx"), F.lit(name).alias("bin"), F.col(f"`{name}`").alias("n")) for k, name in enumerate(names)])
    return sums.select(F.explode(rows).alias("r")).select("r.*")


def interpolate(low: float, high: float, part: float) -> int:
    return int(round(low + (high - low) * part))


def exact_percentiles(counted: DataFrame, percents: list[float], column: str = "tokens") -> list[int]:
    """Linear interpolation between the two neighbouring order statistics, rounded half to even."""
    n = counted.count()
    if not n:
        return [0] * len(percents)
    places = [(n - 1) * p / 100 for p in percents]
    wanted = sorted({int(k) for k in places} | {min(int(k) + 1, n - 1) for k in places})
    ranked = with_row_index(counted.select(column), "pos", [column])
    at = {r["pos"]: r[column] for r in ranked.where(F.col("pos").isin(*wanted)).collect()}
    return [interpolate(at[int(k)], at[min(int(k) + 1, n - 1)], k - int(k)) for k in places]


def recommended_context(p99: float) -> int:
    for c in CONTEXTS:
        if p99 <= c:
            return c
    size = 2 * CONTEXTS[-1]
    while size < p99:
        size *= 2
    return size


def token_stats(counted: DataFrame) -> DataFrame:
    """One row of exact aggregates, unrounded."""
    t = F.col("tokens")
    return counted.agg(
        F.count(F.lit(1)).alias("total_conversations"), F.coalesce(F.sum(t), F.lit(0)).alias("total_tokens"), F.coalesce(F.avg(t), F.lit(0.0)).alias("average_tokens"), F.coalesce(F.median(t), F.lit(0.0)).alias("median_tokens"),
        F.coalesce(F.min(t), F.lit(0)).alias("minimum_tokens"), F.coalesce(F.max(t), F.lit(0)).alias("maximum_tokens"), F.coalesce(F.avg("turns"), F.lit(0.0)).alias("average_turns"),
        *[F.count_if(t > c).alias(f"over_{c}") for c in CONTEXTS],
    )


def token_report(counted: DataFrame) -> TokenReport:
    s = token_stats(counted).first()
    if not s["total_conversations"]:
        raise ValueError("no conversations to count")
    p95, p99 = exact_percentiles(counted, [95, 99])
    bins = {r["bin"]: r["n"] for r in histogram(counted).orderBy("bin_idx").collect()}
    assert math.isclose(sum(bins.values()), s["total_conversations"])
    return TokenReport(
        s["total_conversations"], s["total_tokens"], round(s["average_tokens"], 2), float(s["median_tokens"]), s["minimum_tokens"], s["maximum_tokens"], p95, p99, round(s["average_turns"], 2), recommended_context(p99),
        *(s[f"over_{c}"] for c in CONTEXTS), bins,
    )
