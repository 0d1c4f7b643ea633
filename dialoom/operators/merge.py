"""Merging datasets."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import MergeError, MergeReport, StatisticsReport


def collisions(df: DataFrame) -> DataFrame:
    """(id, n, ord, source) of ids that occur more than once; ord and source of the second occurrence."""
    from pyspark.sql.window import Window

    nth = F.row_number().over(Window.partitionBy("id").orderBy("ord"))
    n = F.count(F.lit(1)).over(Window.partitionBy("id"))
    return df.select("id", "source", "ord", nth.alias("nth"), n.alias("n")).where("nth = 2").drop("nth")


def merge(datasets: list[DataFrame], check: bool = True) -> DataFrame:
    """UNION ALL in the given order, which ``ord`` carries; an id that occurs twice is an error."""
    if not datasets:
        raise MergeError("nothing to merge")
    out = reduce(DataFrame.unionByName, datasets)
    if check:
        twice = out.groupBy("id").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        if not twice.isEmpty():
            first = collisions(out).orderBy("ord").first()
            raise MergeError(f"duplicate conversation id {first['id']!r} in dataset segment {first['ord'] >> 40} ({first['source']})")
    return out


def contributions(df: DataFrame) -> DataFrame:
    """(source, n, first_ord), one row for each source."""
    return df.groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.min("ord").alias("first_ord"))


def merge_report(df: DataFrame) -> MergeReport:
    rows = contributions(df).orderBy("first_ord").collect()
    order = df.groupBy(F.shiftright("ord", 40).alias("d")).agg(F.min_by("source", "ord").alias("source")).orderBy("d").collect()
    return MergeReport(sum(r["n"] for r in rows), {r["source"]: r["n"] for r in rows}, [r["source"] for r in order])


def refreshed(report: MergeReport, kept: StatisticsReport) -> MergeReport:
    """The merge report after dedup (D06): counts of what was kept, from its statistics; the datasets' order stays."""
    return MergeReport(kept.total_conversations, dict(kept.conversations_per_dataset), list(report.dataset_order))
