"""Sources (S04-S06, S14): files as splits, JSON lines, row indices, the system prompt."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..schemas import MESSAGES, ConfigError

FORMATS = {".parquet": "parquet", ".json": "json", ".jsonl": "json", ".csv": "csv", ".orc": "orc", ".txt": "text"}
CHAT = T.StructType([T.StructField("messages", MESSAGES)])


def read_any(spark: SparkSession, path: str, fmt: str | None = None, schema: T.StructType | None = None) -> DataFrame:
    """A table by its format or suffix. Nothing that comes with the data is ever executed."""
    fmt = fmt or FORMATS.get(Path(path.rstrip("/")).suffix, "parquet")
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.option("header", True).csv(path) if fmt == "csv" else reader.format(fmt).load(path)


def read_splits(spark: SparkSession, paths: str | dict[str, str], fmt: str | None = None) -> dict[str, DataFrame]:
    """Split name -> table; a single table is the split ``train``."""
    if isinstance(paths, str):
        paths = {"train": paths}
    return {name: read_any(spark, path, fmt) for name, path in paths.items()}


def select_split(splits: dict[str, DataFrame], name: str) -> DataFrame:
    if name not in splits:
        raise ValueError(f"split {name!r} is not in the dataset; it has {sorted(splits)}")
    return splits[name]


#: Ranges that a numbering in an order is dealt out by, and keys looked at for each to choose their bounds.
RANGES, KEYS_EACH = 64, 32


def _range(by: list[str], bounds: list[tuple]) -> Column:
    """The number of bounds that are not above the row's key, nulls first: a search by halves."""

    def below(bound: tuple) -> Column:
        out = F.lit(False)
        for c, v in reversed(list(zip(by, bound, strict=True))):
            out = F.col(c).isNull() & out if v is None else F.col(c).isNull() | (F.col(c) < F.lit(v)) | (F.col(c) == F.lit(v)) & out
        return out

    def search(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        half = (low + high) // 2
        return F.when(below(bounds[half]), search(low, half)).otherwise(search(half + 1, high))

    return search(0, len(bounds))


def with_row_index(df: DataFrame, name: str = "row_idx", by: list[str] | None = None) -> DataFrame:
    """A gapless row number: in the order of ``by`` if given, else in file order.

    Parts are ranked by themselves and shifted by the sizes of those before them. File splits are parts as they are.
    In an order, parts are ranges between fixed bounds: a range exchange chooses its bounds, and adaptive execution its
    partitions, anew in each plan, so sizes and ranks from two of them need not fit. What reaches the driver is a
    bounded number of keys, which decide the bounds alone.
    """
    if by:
        key = lambda r: tuple((v is not None, v) if v is not None else (False,) for v in r)
        keys = sorted({tuple(r) for r in df.select(*by).orderBy(F.rand(42)).limit(RANGES * KEYS_EACH).collect()}, key=key)
        bounds = sorted({keys[k * len(keys) // RANGES] for k in range(1, RANGES)}, key=key) if keys else []
        part = df.withColumn("_part", _range(by, bounds))
        part = part.withColumn("_at", F.row_number().over(Window.partitionBy("_part").orderBy(*by)) - 1)
        counts = df.select(_range(by, bounds).alias("_part")).groupBy("_part").agg(F.count(F.lit(1)).alias("n"))
    else:
        part = df.withColumn("_part", F.spark_partition_id()).withColumn("_at", F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1))
        counts = part.groupBy("_part").agg(F.count(F.lit(1)).alias("n"))
    start = counts.select("_part", (F.sum("n").over(Window.orderBy("_part")) - F.col("n")).alias("_start"))
    return part.join(F.broadcast(start), "_part").withColumn(name, F.col("_start") + F.col("_at")).drop("_part", "_at", "_start")


def read_chat_jsonl(spark: SparkSession, path: str) -> DataFrame:
    """Chat records in line order: (row_idx, messages). Blank lines are skipped; bad JSON or no record at all is an error."""
    lines = spark.read.text(path).where(F.trim("value") != "")
    parsed = lines.select(F.from_json("value", CHAT, {"mode": "FAILFAST"}).alias("r")).select("r.messages")
    if parsed.isEmpty():
        raise ValueError(f"{path} has no records")
    return with_row_index(parsed)


def read_system_prompt(path: str | None) -> str | None:
    """The stripped prompt; None if no path is given or the file is blank."""
    if path is None:
        return None
    if not Path(path).exists():
        raise ConfigError(f"system prompt file not found: {path}")
    return Path(path).read_text(encoding="utf-8").strip() or None
