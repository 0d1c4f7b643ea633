"""Schema-agnostic profiling."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import is_blank, py_strip
from .sample import random_sample

# Names that group rows into conversations, and the lengths that count as extreme.
ID_PATTERNS = ("conv_id", "conversation_id", "dialog_id", "dialogue_id")
LONG, SHORT = 5000, 10
TYPE_NAMES = {"byte": "int8", "short": "int16", "integer": "int32", "long": "int64", "float": "float32", "double": "float64", "boolean": "bool", "string": "string", "timestamp": "timestamp", "timestamp_ntz": "timestamp", "date": "date32", "binary": "binary"}


def type_name(kind: T.DataType) -> str:
    if isinstance(kind, T.ArrayType):
        return f"list[{type_name(kind.elementType)}]"
    if isinstance(kind, T.StructType):
        return "{" + ", ".join(f"{f.name}: {type_name(f.dataType)}" for f in kind.fields) + "}"
    if isinstance(kind, T.MapType):
        return "{" + f"{type_name(kind.keyType)}: {type_name(kind.valueType)}" + "}"
    return TYPE_NAMES.get(kind.typeName(), kind.simpleString())


def describe_schema(df: DataFrame) -> list[dict]:
    nested = (T.ArrayType, T.StructType, T.MapType)
    return [{"name": f.name, "dtype": type_name(f.dataType), "is_nested": isinstance(f.dataType, nested)} for f in df.schema.fields]


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def list_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.ArrayType)]


def grouping_column(df: DataFrame) -> str | None:
    """Exact names first, then names that hold a pattern; patterns in order, without regard to case."""
    for same in (lambda c, p: c.lower() == p, lambda c, p: p in c.lower()):
        for p in ID_PATTERNS:
            for c in df.columns:
                if same(c, p):
                    return c
    return None


def conversation_stats(df: DataFrame) -> tuple[str, str | None, DataFrame]:
    """(method, column, one row: n, avg, median, min, max of turns)."""
    group = grouping_column(df)
    lists = list_columns(df)
    if group:
        method, column = "id_grouped", group
        turns = df.groupBy(group).agg(F.count(F.lit(1)).alias("t")).select("t")
    elif lists:
        method, column = "sequence_column", lists[0]
        turns = df.select(F.when(F.col(lists[0]).isNull(), F.lit(1)).otherwise(F.size(lists[0])).cast("long").alias("t"))
    else:
        method, column = "row_level", None
        turns = df.select(F.lit(max(len(text_columns(df)), 1)).cast("long").alias("t"))
    stats = turns.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.avg("t"), F.lit(0.0)).alias("avg"), F.coalesce(F.median("t"), F.lit(0.0)).alias("median"), F.coalesce(F.min("t"), F.lit(0)).alias("min"), F.coalesce(F.max("t"), F.lit(0)).alias("max"))
    return method, column, stats


def _strings(c: Column, kind: T.DataType) -> Column | None:
    """All strings below a value as one array; None if its type holds none."""
    if isinstance(kind, T.StringType):
        return F.array(c)
    if isinstance(kind, T.ArrayType):
        if isinstance(kind.elementType, T.StringType):
            return F.coalesce(c, F.array().cast("array<string>"))
        if _strings(F.lit(None), kind.elementType) is None:
            return None
        return F.coalesce(F.flatten(F.transform(c, lambda x: _strings(x, kind.elementType))), F.array().cast("array<string>"))
    if isinstance(kind, T.StructType):
        parts = [p for f in kind.fields if (p := _strings(c[f.name], f.dataType)) is not None]
        return F.concat(*parts) if parts else None
    return None


def message_stats(df: DataFrame) -> tuple[list[str], DataFrame] | None:
    """(columns, one row: n, avg, max of string lengths) over text columns and strings nested in lists."""
    found = [(f.name, s) for f in df.schema.fields if isinstance(f.dataType, T.StringType | T.ArrayType) and (s := _strings(F.col(f"`{f.name}`"), f.dataType)) is not None]
    if not found:
        return None
    every = df.select(F.explode(F.filter(F.concat(*[s for _, s in found]), lambda x: x.isNotNull())).alias("s"))
    return [c for c, _ in found], every.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.avg(F.length("s")), F.lit(0.0)).alias("avg"), F.coalesce(F.max(F.length("s")), F.lit(0)).cast("long").alias("max"))


def quality_counts(df: DataFrame) -> DataFrame:
    """(check, column, n): nulls of all columns; blank, long and short strings of text columns (I05-I07). One scan, one aggregation."""
    checks: list[tuple[str, str, Column]] = [("missing", c, F.col(f"`{c}`").isNull()) for c in df.columns]
    for c in text_columns(df):
        x = F.col(f"`{c}`")
        stripped = F.length(py_strip(x))
        checks += [("empty", c, x.isNotNull() & is_blank(x)), ("long", c, F.length(x) > LONG), ("short", c, (stripped > 0) & (stripped < SHORT))]
    sums = df.agg(*[F.count_if(cond).alias(f"c{k}") for k, (_, _, cond) in enumerate(checks)])
    rows = F.array(*[F.struct(F.lit(check).alias("check"), F.lit(c).alias("column"), F.col(f"c{k}").alias("n")) for k, (check, c, _) in enumerate(checks)])
    return sums.select(F.explode(rows).alias("r")).select("r.check", "r.column", "r.n")


def duplicate_rows(df: DataFrame) -> DataFrame:
    """One row ``n``: rows beyond the first of their kind, nulls equal (I08). Maps count by their sorted entries."""
    keys = [F.to_json(F.struct(F.col(f"`{f.name}`"))).alias(f.name) if isinstance(f.dataType, T.MapType | T.VariantType) else F.col(f"`{f.name}`") for f in df.schema.fields]
    groups = df.select(*keys).groupBy(*[f"`{c}`" for c in df.columns]).agg(F.count(F.lit(1)).alias("_n"))
    return groups.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("long").alias("n"))


def id_columns(df: DataFrame) -> list[str]:
    group = grouping_column(df)
    return [c for c in df.columns if (c.lower() == "id" or c.lower().endswith("_id")) and c != group]


def duplicate_ids(df: DataFrame) -> DataFrame:
    """(column, n): repeated values of id columns but the grouping one."""
    ids = id_columns(df)
    if not ids:
        return df.sparkSession.createDataFrame([], "column string, n long")
    sums = df.agg(*[(F.count(f"`{c}`") - F.count_distinct(f"`{c}`")).alias(f"c{k}") for k, c in enumerate(ids)])
    rows = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"c{k}").alias("n")) for k, c in enumerate(ids)])
    return sums.select(F.explode(rows).alias("r")).select("r.column", "r.n")


@dataclass
class SplitInspection:
    num_rows: int
    schema: list[dict]
    method: str
    grouping_column: str | None
    turns: dict
    message_columns: list[str] | None
    messages: dict | None
    quality: dict[str, dict[str, int]]
    duplicate_rows: int
    duplicate_ids: dict[str, int]
    samples: list[dict] = field(default_factory=list)


def inspect_split(df: DataFrame, samples: int = 3, seed: int = 42) -> SplitInspection:
    """All checks of one split, which is scanned once and held while they run."""
    df = df.persist()
    try:
        method, column, turns = conversation_stats(df)
        t = turns.first().asDict()
        t["avg"] = round(t["avg"], 2)
        m = message_stats(df)
        quality: dict[str, dict[str, int]] = {}
        for r in quality_counts(df).where("n > 0").collect():
            quality.setdefault(r["check"], {})[r["column"]] = r["n"]
        texts = set(text_columns(df))
        quality["null_messages"] = {c: n for c, n in quality.get("missing", {}).items() if c in texts}
        ids = {r["column"]: r["n"] for r in duplicate_ids(df).where("n > 0").collect()}
        stats = m[1].first().asDict() if m else None
        if stats:
            stats["avg"] = round(stats["avg"], 2)
        rows = [r.asDict(recursive=True) for r in random_sample(df, samples, seed).collect()]
        return SplitInspection(df.count(), describe_schema(df), method, column, t, m[0] if m else None, stats, quality, duplicate_rows(df).first()["n"], ids, rows)
    finally:
        df.unpersist()


def inspect_dataset(splits: dict[str, DataFrame], samples: int = 3, seed: int = 42) -> dict[str, SplitInspection]:
    return {name: inspect_split(df, samples, seed) for name, df in splits.items()}
