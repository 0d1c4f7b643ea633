"""Seeded order, splits and samples."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.readers import with_row_index

#: Above this many rows a permutation is not built on the driver; use the hash mode.
PERMUTATION_ROWS = 5_000_000


def permutation(n: int, seed: int, times: int = 1) -> list[int]:
    """place -> row: what ``times`` shuffles, each by a fresh ``random.Random(seed)``, make of range(n)."""
    rows = list(range(n))
    for _ in range(times):
        random.Random(seed).shuffle(rows)
    return rows


def positions_frame(spark: SparkSession, rows: list[int]) -> DataFrame:
    """(pos, place) of a permutation."""
    at = [(int(row), place) for place, row in enumerate(rows)]
    return spark.createDataFrame(at, "pos long, place long")


def dense_position(df: DataFrame, by: list[str], name: str = "pos") -> DataFrame:
    """Gapless numbers in the order of ``by``: a range sort, ranks by partition, no single task for all rows."""
    return with_row_index(df, name, by)


def shuffled(df: DataFrame, seed: int, times: int = 1, by: list[str] | None = None, mode: str = "exact") -> DataFrame:
    """Adds ``place``, the row's place after seeded shuffling.

    ``exact`` follows the standard library's generator, which needs the row count and a permutation on the
    driver, so it is bounded by PERMUTATION_ROWS; ``hash`` orders by a seeded hash of id, which has other
    members but no bound.
    """
    by = by or ["ord"]
    if mode == "hash":
        return with_row_index(df.withColumn("_h", F.xxhash64("id", F.lit(seed))), "place", ["_h", "id"]).drop("_h")
    placed = dense_position(df, by)
    n = df.count()
    if n > PERMUTATION_ROWS:
        raise ValueError(f"{n} rows are over the bound of the exact mode ({PERMUTATION_ROWS}); use mode='hash'")
    return placed.join(positions_frame(df.sparkSession, permutation(n, seed, times)), "pos").drop("pos")


def train_size(n: int, ratio: float) -> int:
    return int(n * ratio)


def split_by_ratio(df: DataFrame, ratio: float, n: int | None = None, place: str = "place") -> tuple[DataFrame, DataFrame]:
    """The first int(n * ratio) places, and the rest."""
    n = df.count() if n is None else n
    cut = train_size(n, ratio)
    return df.where(F.col(place) < cut), df.where(F.col(place) >= cut)


def review_positions(n: int, k: int, seed: int) -> list[int]:
    return list(range(n)) if n <= k else sorted(random.Random(seed).sample(range(n), k))


def review_sample(df: DataFrame, k: int, seed: int) -> DataFrame:
    """A seeded sample of ``k`` rows in original order."""
    wanted = review_positions(df.count(), k, seed)
    at = df.sparkSession.createDataFrame([(int(p),) for p in wanted], "pos long")
    return dense_position(df, ["ord"]).join(F.broadcast(at), "pos", "left_semi").drop("pos").orderBy("ord")


def random_sample(df: DataFrame, k: int, seed: int = 42) -> DataFrame:
    """``k`` rows; the reference's kind has no seed, this one has."""
    return df.orderBy(F.rand(seed)).limit(k)
