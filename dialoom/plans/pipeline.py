"""Configuration checks, dry run, and the corpus pipeline."""

from __future__ import annotations

import logging
from dataclasses import dataclass
from pathlib import Path
from typing import Protocol

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators import curate, dedup, merge, normalize, parse, sample, stats, validate
from ..schemas import ConfigError, CurationReport
from ..sources import sinks
from ..sources.catalog import Catalog, DatasetEntry
from ..sources.config import load_yaml
from ..sources.readers import read_splits, read_system_prompt, select_split, with_row_index
from . import reports

log = logging.getLogger("dialoom")
# The fields of a pipeline configuration.
FIELDS = ("datasets", "split", "validation", "sampling", "outputs", "dataset_version")
OUTPUTS = (
    "statistics_json", "statistics_md", "review_sample_json", "review_sample_md", "canonical_dataset_jsonl", "deduplicated_dataset_jsonl", "manifest_json", "duplicate_report_json", "duplicate_report_md",
    "train_jsonl", "validation_jsonl", "curation_report_json", "curation_report_md",
)


class Parser(Protocol):
    def __call__(self, rows: DataFrame, dataset_id: str, split: str) -> DataFrame: ...


class Normalizer(Protocol):
    def __call__(self, parsed: DataFrame, dataset_index: int = 0) -> DataFrame: ...


def _text(x: object) -> bool:
    return isinstance(x, str) and bool(x.strip())


def _need(ok: bool, why: str) -> None:
    if not ok:
        raise ConfigError(why)


def check_pipeline_config(config: object) -> dict:
    """The strict rules (O01); bool counts as int, as the language has it."""
    _need(isinstance(config, dict), "the configuration must be a mapping")
    for f in FIELDS:
        _need(f in config, f"missing configuration field {f!r}")
    datasets = config["datasets"]
    _need(isinstance(datasets, list) and all(isinstance(d, str) for d in datasets), "'datasets' must be a list of strings")
    _need(bool(datasets), "'datasets' must not be empty")
    _need(_text(config["split"]), "'split' must be a non-empty string")
    for f in ("validation", "sampling", "outputs"):
        _need(isinstance(config[f], dict), f"{f!r} must be a mapping")
    for f in ("sample_size", "seed"):
        _need(isinstance(config["sampling"].get(f), int), f"'sampling.{f}' must be an integer")
    for f in OUTPUTS:
        _need(_text(config["outputs"].get(f)), f"'outputs.{f}' must be a non-empty path")
    _need(_text(config["dataset_version"]), "'dataset_version' must be a non-empty string")
    c = config.get("curation")
    if c is not None:
        _need(isinstance(c, dict), "'curation' must be a mapping")
        ratio = c.get("split_ratio", 0.95)
        _need(isinstance(ratio, int | float) and 0.0 < float(ratio) < 1.0, "'curation.split_ratio' must lie between 0 and 1")
        _need(isinstance(c.get("seed", 42), int), "'curation.seed' must be an integer")
        caps = c.get("source_caps", {})
        _need(isinstance(caps, dict), "'curation.source_caps' must be a mapping")
        for source, cap in caps.items():
            _need(cap is None or isinstance(cap, int) and cap >= 1, f"'curation.source_caps.{source}' must be a positive integer or null")
        _need(c.get("system_prompt_file") is None or isinstance(c["system_prompt_file"], str), "'curation.system_prompt_file' must be a path")
    return config


def check_audit_config(config: object) -> dict:
    """The loose rules."""
    _need(isinstance(config, dict), "the configuration must be a mapping")
    for f in FIELDS[:-1]:
        _need(f in config, f"missing configuration field {f!r}")
    return config


def load_config(path: str, audit: bool = False) -> dict:
    if not Path(path).exists():
        raise ConfigError(f"configuration file not found: {path}")
    try:
        raw = load_yaml(path)
    except Exception as e:
        raise ConfigError(f"cannot read {path}: {e}") from e
    return (check_audit_config if audit else check_pipeline_config)(raw)


@dataclass(frozen=True)
class Curator:
    """What curation does (O04); the trimmer and the quality rules share ``min_chars``."""

    strip_urls: bool = True
    separator: str = "\n\n"
    min_chars: int = 40
    max_short_ratio: float = 0.5
    echo_threshold: float = 0.8
    min_messages: int = 2
    caps: tuple[tuple[str, int | None], ...] = ()
    seed: int = 42
    split_ratio: float = 0.95
    system_prompt: str | None = None
    shuffle: str = "exact"

    @property
    def rules(self) -> dict:
        return {"min_messages": self.min_messages, "min_chars": self.min_chars, "max_short_ratio": self.max_short_ratio, "echo_threshold": self.echo_threshold}

    def shaped(self, df: DataFrame) -> DataFrame:
        """Cleaned and shaped conversations: one narrow stage."""
        return curate.shape_turns(curate.clean_conversations(df, self.strip_urls), self.separator, self.min_chars)

    def kept(self, df: DataFrame) -> DataFrame:
        return curate.quality_filter(self.shaped(df), **self.rules)

    def sampled(self, kept: DataFrame) -> DataFrame:
        return curate.cap_sources(kept, dict(self.caps))

    def ordered(self, sampled: DataFrame, first_ord: DataFrame) -> DataFrame:
        """Adds ``place``: sources by first appearance, input or rank order within, then shuffled twice with one seed."""
        by = sampled.join(F.broadcast(first_ord), "source")
        return sample.shuffled(by, self.seed, 2, ["first_ord", "rank"], self.shuffle).drop("first_ord")


def build_curator(config: dict) -> Curator | None:
    c = config.get("curation") or {}
    if not c.get("enabled", True):
        return None
    q, d = c.get("quality") or {}, Curator()
    return Curator(
        (c.get("cleaning") or {}).get("strip_urls", True), d.separator, q.get("min_assistant_chars", 40), q.get("max_short_assistant_ratio", 0.5), q.get("echo_similarity_threshold", 0.8), q.get("min_messages", 2),
        tuple((c.get("source_caps") or {}).items()), c.get("seed", 42), c.get("split_ratio", 0.95), read_system_prompt(c.get("system_prompt_file")), c.get("shuffle", "exact"),
    )


def curate_corpus(df: DataFrame, curator: Curator, train_path: str | None = None, validation_path: str | None = None) -> tuple[DataFrame, DataFrame, CurationReport]:
    """(train, validation, report) of chat records with ``place``."""
    by_source = lambda x: {r["source"]: r["n"] for r in stats.per_source(x).orderBy("first_ord").collect()}
    r = CurationReport(seed=curator.seed)
    r.counts_before = by_source(df)
    seen = curate.clean_counts(curate.clean_messages(df, curator.strip_urls)).first().asDict()
    r.cleaning = {"messages_seen": seen["messages_seen"], "messages_changed": seen["messages_changed"], "replacements": {k: seen[k] for k in curate.COUNTS if seen[k]}}
    shaped = curator.shaped(df).persist()
    marked = curate.quality_reasons(shaped, **curator.rules).persist()
    reasons = {x["reason"]: x["n"] for x in curate.quality_counts(marked).collect()}
    r.quality = {"num_seen": sum(reasons.values()), "num_kept": reasons.pop(None, 0), "drops_by_reason": {k: reasons[k] for k in curate.RULES if k in reasons}}
    kept = marked.where("reason is null").drop("reason")
    first = stats.per_source(kept).select("source", "first_ord")
    r.counts_after_quality = by_source(kept)
    final = curator.sampled(kept).persist()
    r.counts_after_sampling = by_source(final)
    n = sum(r.counts_after_sampling.values())
    placed = curate.chat_record(curator.ordered(final, first), curator.system_prompt).persist()
    train, validation = sample.split_by_ratio(placed, curator.split_ratio, n)
    r.num_train = sample.train_size(n, curator.split_ratio)
    r.num_validation = n - r.num_train
    if train_path:
        sinks.export_chat(train, train_path, "place")
    if validation_path:
        sinks.export_chat(validation, validation_path, "place")
    return train, validation, r


def resolve(config: dict, catalog: Catalog) -> list[tuple[DatasetEntry, Parser, Normalizer]]:
    """Entry, parser and normaliser of every configured dataset."""
    out = []
    for dataset_id in config["datasets"]:
        entry = catalog.by_dataset_id(dataset_id)
        _need(entry is not None, f"dataset {dataset_id!r} is not in the catalog")
        try:
            out.append((entry, parse.PARSERS.get(dataset_id), normalize.NORMALIZERS.get(dataset_id)))
        except KeyError as e:
            raise ConfigError(f"{dataset_id}: {e}") from e
    return out


def dry_run(config: dict, catalog: Catalog) -> str:
    """The plan that a run would follow; no data is touched."""
    steps = resolve(config, catalog)
    _need(validate.VALIDATORS.get("conversation") is validate.validated, "unexpected validator")
    _need(validate.FILTERS.get("conversation") is validate.filter_by_report, "unexpected filter")
    name = lambda f: getattr(f, "__name__", repr(f))
    c, line = config.get("curation") or {}, "=" * 60
    out = ["", line, "PIPELINE DRY-RUN EXECUTION PLAN (VALID)", "-" * 60, f"Target Split: {config['split']}", "Datasets to process:", *[f"  - {e.dataset_id} ({name(p)} -> {name(n)})" for e, p, n in steps]]
    out += ["", "Validation settings:", "  - Purely structural validation enabled", "", "Sampling parameters:", f"  - sample_size: {config['sampling']['sample_size']} conversations", f"  - seed: {config['sampling']['seed']}", "", "Configured outputs:", *[f"  - {k}: {config['outputs'][k]}" for k in OUTPUTS], "", "Curation settings:"]
    if not c.get("enabled", True):
        out.append("  - DISABLED (no training splits will be written)")
    else:
        q, caps = c.get("quality") or {}, c.get("source_caps") or {}
        out += [f"  - system_prompt_file: {c.get('system_prompt_file') or '(none)'}", f"  - split_ratio: {c.get('split_ratio', 0.95)}", f"  - min_assistant_chars: {q.get('min_assistant_chars', 40)}", f"  - echo_similarity_threshold: {q.get('echo_similarity_threshold', 0.8)}", "  - source caps:"]
        out += [f"      {s}: {'uncapped' if caps.get(s) is None else caps[s]}" for s in config["datasets"]]
    return "\n".join([*out, line, ""])


def load_rows(spark: SparkSession, entry: DatasetEntry, split: str) -> DataFrame:
    """A split with ``row_idx``. Only files are read: ``local_path`` is a table, or a folder with one table for each split."""
    _need(bool(entry.local_path), f"dataset {entry.key!r} has no local_path")
    at = Path(entry.local_path)
    named = {p.stem: str(p) for p in sorted(at.iterdir()) if p.suffix} if at.is_dir() and not at.suffix else {}
    splits = read_splits(spark, named or entry.local_path)
    return with_row_index(select_split(splits, split))


def prepare(spark: SparkSession, config: dict, catalog: Catalog) -> tuple[list[DataFrame], list[DataFrame], list[dict]]:
    """Valid canonical rows and all checked rows of every dataset, and the counts of the first five stages."""
    valid, every, counts = [], [], []
    for k, (entry, parser, normalizer) in enumerate(resolve(config, catalog)):
        rows = load_rows(spark, entry, config["split"])
        seen = Observation()
        parsed = parse.accepted(parser(rows, entry.dataset_id, config["split"])).observe(seen, F.count(F.lit(1)).alias("n"))
        ok, _ = normalize.split_quarantine(normalizer(parsed, k))
        checked = validate.validated(ok).persist()
        kept, _ = validate.filter_valid(checked)
        valid.append(kept)
        every.append(checked)
        n = validate.validation_counts(checked).first()  # fills what is held, and counts what was parsed on the way
        steps = (rows.count(), seen.get["n"], n["num_checked"], n["num_checked"], n["num_valid"])
        counts += [{"stage": s, "dataset": entry.dataset_id, "n": v} for s, v in zip(stats.STAGES, steps, strict=False)]
    return valid, every, counts


def run_pipeline(spark: SparkSession, config: dict, catalog: Catalog) -> tuple[dict, CurationReport | None]:
    """All stages, with every artefact written."""
    out = config["outputs"]
    valid, _, _ = prepare(spark, config, catalog)
    merged = merge.merge(valid).persist()
    before = sinks.export_canonical(merged, out["canonical_dataset_jsonl"])
    contributed = merge.merge_report(merged)
    kept, removed = dedup.deduplicate(merged)
    kept = kept.persist()
    listed = [r.asDict() for r in removed.orderBy("ord").drop("ord").toLocalIterator()]
    manifest = dedup.manifest(before, len(listed), config["dataset_version"])
    sinks.export_canonical(kept, out["deduplicated_dataset_jsonl"])
    sinks.write_json(manifest, out["manifest_json"])
    sinks.write_json(reports.duplicate_json(manifest, listed), out["duplicate_report_json"])
    sinks.write_text(reports.duplicate_md(manifest, listed), out["duplicate_report_md"])
    s = stats.statistics(kept)
    contributed = merge.refreshed(contributed, s)
    log.info("after dedup %d conversations: %s", contributed.total_conversations, contributed.dataset_counts)
    sinks.write_json(s.to_dict(), out["statistics_json"])
    sinks.write_text(reports.statistics_md(s), out["statistics_md"])
    shown = [r.asDict(recursive=True) for r in sample.review_sample(kept, config["sampling"]["sample_size"], config["sampling"]["seed"]).collect()]
    sinks.write_json(reports.review_json(shown), out["review_sample_json"])
    sinks.write_text(reports.review_md(shown), out["review_sample_md"])
    curator, report = build_curator(config), None
    if curator is not None:
        _, _, report = curate_corpus(kept, curator, out["train_jsonl"], out["validation_jsonl"])
        sinks.write_json(report.to_dict(), out["curation_report_json"])
        sinks.write_text(reports.curation_md(report), out["curation_report_md"])
    return manifest, report


def run_audit(spark: SparkSession, config: dict, catalog: Catalog, audit_path: str, breakdown_path: str, examples_dir: str) -> DataFrame:
    """Stage counts, error categories and examples (O06, R04-R07); returns the losses."""
    valid, every, counts = prepare(spark, config, catalog)
    merged = merge.contributions(merge.merge(valid)).collect()
    counts += [{"stage": "Merged", "dataset": r["source"], "n": r["n"]} for r in merged]
    losses = stats.stage_losses(spark.createDataFrame(counts, "stage string, dataset string, n long"))
    checked = every[0]
    for other in every[1:]:
        checked = checked.unionByName(other)
    write_audit(losses, checked, audit_path, breakdown_path, examples_dir)
    return losses


def failing_ids(checked: DataFrame) -> dict[str, list[str]]:
    """Ids of the failing conversations by category, one for each error: the report lists them all."""
    ids: dict[str, list[str]] = {}
    failing = checked.select("ord", "id", F.posexplode("errors").alias("pos", "error")).select(validate.error_category(F.col("error")).alias("category"), "ord", "pos", "id")
    for r in failing.orderBy("ord", "pos").toLocalIterator():
        ids.setdefault(r["category"], []).append(r["id"])
    return ids


def write_audit(losses: DataFrame, checked: DataFrame, audit_path: str, breakdown_path: str, examples_dir: str) -> None:
    sinks.write_text(reports.audit_md([r.asDict() for r in losses.collect()]), audit_path)
    categories = [r.asDict() for r in stats.error_breakdown(checked).orderBy(F.desc("n"), "first_ord", "first_pos").collect()]
    sinks.write_text(reports.breakdown_md(categories, failing_ids(checked)), breakdown_path)
    chosen = stats.error_examples(checked).select("category", "rn", F.col("ord").alias("_o"))
    rows = checked.join(chosen, F.col("ord") == F.col("_o")).orderBy("category", "rn").collect()
    for c in categories:
        some = [r.asDict(recursive=True) for r in rows if r["category"] == c["category"]]
        sinks.write_text(reports.examples_md(c["category"], some), f"{examples_dir}/{reports.example_file_name(c['category'])}")


def simple_export(df: DataFrame, ratio: float, seed: int, train_path: str, validation_path: str, mode: str = "exact") -> tuple[int, int]:
    """One seeded shuffle, a split, messages only."""
    n = df.count()
    placed = sample.shuffled(df, seed, 1, ["ord"], mode).persist()
    train, validation = sample.split_by_ratio(placed, ratio, n)
    return sinks.export_chat(train, train_path, "place"), sinks.export_chat(validation, validation_path, "place")
