"""Command lines (O07): run, audit, parse, inspect, export, tokens."""

from __future__ import annotations

import argparse
import logging
import sys

from pyspark.sql import SparkSession

from ..functions.udfs import bpe_counter
from ..operators import inspect as profile
from ..operators import parse, tokens
from ..sources import sinks
from ..sources.catalog import Catalog
from ..sources.readers import read_chat_jsonl, read_splits
from . import pipeline, reports

log = logging.getLogger("dialoom")


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="dialoom")
    p.add_argument("-v", "--verbose", action="store_true")
    p.add_argument("--catalog", default="configs/datasets.yaml")
    sub = p.add_subparsers(dest="command", required=True)
    for name in ("run", "audit"):
        s = sub.add_parser(name)
        s.add_argument("--config", default="configs/pipeline_config.yaml")
        if name == "run":
            s.add_argument("--dry-run", action="store_true")
        else:
            s.add_argument("--output", default="outputs/reports")
    s = sub.add_parser("parse")
    s.add_argument("dataset")
    s.add_argument("--split", default="train")
    s = sub.add_parser("inspect")
    s.add_argument("dataset")
    s.add_argument("--samples", type=int, default=3)
    s.add_argument("--output", default="outputs/inspection")
    s = sub.add_parser("export")
    s.add_argument("input")
    s.add_argument("output")
    s.add_argument("--split-ratio", type=float, default=0.95)
    s.add_argument("--seed", type=int, default=42)
    s = sub.add_parser("tokens")
    s.add_argument("input")
    s.add_argument("output")
    s.add_argument("--model-id", default="characters")
    s.add_argument("--tokenizer", help="file of a published byte-level vocabulary, or 'byte_bpe' for the installed one; characters are counted without")
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    a = parser().parse_args(argv)
    logging.basicConfig(level=logging.DEBUG if a.verbose else logging.INFO, format="%(asctime)s %(levelname)s %(name)s %(message)s")
    try:
        return _run(a, spark)
    except Exception as e:
        log.error("%s failed: %s", a.command, e, exc_info=a.verbose)
        return 1


def _run(a: argparse.Namespace, spark: SparkSession | None) -> int:
    if a.command in ("run", "audit"):
        config, catalog = pipeline.load_config(a.config, audit=a.command == "audit"), Catalog.from_yaml(a.catalog)
        if a.command == "run" and a.dry_run:
            print(pipeline.dry_run(config, catalog))
            return 0
    spark = spark or SparkSession.builder.appName("dialoom").getOrCreate()
    if a.command == "run":
        manifest, report = pipeline.run_pipeline(spark, config, catalog)
        print(reports.pipeline_console(manifest, config["outputs"], report))
    elif a.command == "audit":
        pipeline.run_audit(spark, config, catalog, f"{a.output}/pipeline_audit.md", f"{a.output}/validation_breakdown.md", f"{a.output}/validation_examples")
    elif a.command == "parse":
        entry = Catalog.from_yaml(a.catalog)[a.dataset]
        parsed = parse.PARSERS.get(entry.dataset_id or entry.key)(pipeline.load_rows(spark, entry, a.split), entry.dataset_id or entry.key, a.split)
        print(reports.parse_console(parse.parse_report(parsed, entry.dataset_id or entry.key)))
    elif a.command == "inspect":
        entry = Catalog.from_yaml(a.catalog)[a.dataset]
        splits = profile.inspect_dataset(read_splits(spark, entry.local_path), a.samples)
        name = entry.dataset_id or entry.name
        sinks.write_text(reports.inspection_md(entry.name, entry.dataset_id, splits), f"{a.output}/{reports.inspection_file_name(name)}")
    elif a.command == "export":
        rows = read_chat_jsonl(spark, a.input).withColumnRenamed("row_idx", "ord")
        n = pipeline.simple_export(rows, a.split_ratio, a.seed, f"{a.output}/train.jsonl", f"{a.output}/validation.jsonl")
        print(f"train: {n[0]}, validation: {n[1]}")
    else:
        counter = tokens.char_count if a.tokenizer is None else bpe_counter(None if a.tokenizer == "byte_bpe" else a.tokenizer)
        t = tokens.token_report(tokens.token_counts(read_chat_jsonl(spark, a.input), counter=counter))
        sinks.write_json(t.to_dict(), f"{a.output}/token_statistics.json")
        sinks.write_text(reports.token_md(t, a.model_id), f"{a.output}/token_statistics.md")
        print(reports.token_console(t))
    return 0


if __name__ == "__main__":
    sys.exit(main())
