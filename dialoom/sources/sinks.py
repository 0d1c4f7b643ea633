"""Sinks (S07-S12): ordered JSON lines and small reports."""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def compact_json(df: DataFrame) -> DataFrame:
    """(ord, line): the canonical record with nulls kept."""
    record = F.struct("id", "source", "metadata", "messages")
    return df.select("ord", F.to_json(record, {"ignoreNullFields": "false"}).alias("line"))


def spaced_json(messages: Column) -> Column:
    """{"messages": [...]} with a blank behind every comma and colon, as the standard library writes it."""
    quote = lambda c: F.coalesce(F.regexp_replace(F.to_json(F.array(c), {"ignoreNullFields": "false"}), r"\A\[|\]\z", ""), F.lit("null"))
    turn = lambda m: F.concat(F.lit('{"role": '), quote(m["role"]), F.lit(', "content": '), quote(m["content"]), F.lit("}"))
    return F.concat(F.lit('{"messages": ['), F.concat_ws(", ", F.transform(messages, turn)), F.lit("]}"))


def write_lines(df: DataFrame, path: str, order: str = "ord", single_file: bool = True) -> int:
    """Writes column ``line`` in ``order``; returns the number of lines.

    A single file streams through the driver, partition by partition; else a folder of part files is
    written whose names are in order.
    """
    lines = df.select(order, "line")
    if not single_file:
        seen = Observation()
        lines.orderBy(order).observe(seen, F.count(F.lit(1)).alias("n")).select("line").write.mode("overwrite").text(path)
        return seen.get["n"]
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    n = 0
    with open(path, "w", encoding="utf-8") as f:
        for row in lines.orderBy(order).toLocalIterator():
            f.write(row["line"] + "\n")
            n += 1
    return n


def export_canonical(df: DataFrame, path: str, single_file: bool = True) -> int:
    return write_lines(compact_json(df), path, single_file=single_file)


def export_chat(df: DataFrame, path: str, order: str = "ord", single_file: bool = True) -> int:
    return write_lines(df.select(order, spaced_json(F.col("messages")).alias("line")), path, order, single_file)


def write_json(data: object, path: str) -> None:
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    Path(path).write_text(json.dumps(data, indent=2, ensure_ascii=False), encoding="utf-8")


def write_text(text: str, path: str) -> None:
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    Path(path).write_text(text, encoding="utf-8")


def size_of(path: str) -> str:
    """MB from 1 MiB on, KB below; part files count together."""
    p = Path(path)
    n = sum(x.stat().st_size for x in p.rglob("*") if x.is_file()) if p.is_dir() else p.stat().st_size
    return f"{n / (1 << 20):.2f} MB" if n >= 1 << 20 else f"{n / 1024:.2f} KB"
