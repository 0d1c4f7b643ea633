"""Report texts (R01-R12), rendered on the driver from small results. Layouts are fixed formats."""

from __future__ import annotations

import json
from datetime import UTC, datetime

from ..operators.inspect import LONG, SHORT, SplitInspection
from ..operators.stats import STAGES
from ..operators.tokens import BINS
from ..schemas import CurationReport, ParseReport, StatisticsReport, TokenReport


def table(heads: list[str], marks: list[str], rows: list[list[object]]) -> list[str]:
    return ["| " + " | ".join(map(str, r)) + " |" for r in (heads, marks, *rows)]


def statistics_md(s: StatisticsReport) -> str:
    sources = [[k, s.conversations_per_dataset[k], f"{s.percentage_contribution_per_dataset.get(k, 0.0):.2f}%"] for k in sorted(s.conversations_per_dataset)]
    summary = [("Total Conversations", s.total_conversations), ("Average Turns", f"{s.average_turns:.2f}"), ("Median Turns", f"{s.median_turns:.1f}"), ("Minimum Turns", s.minimum_turns), ("Maximum Turns", s.maximum_turns)]
    lengths = [("Average User Message Length (chars)", f"{s.average_user_message_length:.2f}"), ("Average Assistant Message Length (chars)", f"{s.average_assistant_message_length:.2f}"), ("Maximum Message Length (chars)", s.maximum_message_length)]
    points = lambda pairs: [f"- **{k}**: {v}" for k, v in pairs]
    return "\n".join([
        "# Dataset Merger Statistics Report", "", "## Overall Summary", *points(summary), "", "## Message Metrics", *points(lengths), "", "## Dataset Contributions", "",
        *table(["Dataset Key", "Conversations", "Contribution %"], [":---"] * 3, sources), "", "## Context Distribution", "",
        *table(["Context", "Conversations"], [":---"] * 2, [[k, v] for k, v in s.context_distribution.items()]), "",
    ])


def transcript(c: dict, head: str, with_original: bool) -> list[str]:
    meta = c["metadata"] or {}
    said = [line for m in c["messages"] or [] for line in (f"**[{m['role']}]**: {m['content']}", "")]
    original = [f"- **Original ID**: {meta.get('original_id') or 'None'}"] if with_original else []
    return [head, f"- **Source**: {c['source']}", f"- **Split**: {meta.get('split') or 'None'}", f"- **Context**: {meta.get('context') or 'None'}", *original, "", "### Dialogue Turns", "", *said, "---", ""]


def review_md(sample: list[dict]) -> str:
    lines = ["# Dataset Review Sample", "", f"This sample contains {len(sample)} conversations selected deterministically for review.", ""]
    for k, c in enumerate(sample, 1):
        lines += transcript(c, f"## Conversation {k}: {c['id']}", True)
    return "\n".join(lines)


def review_json(sample: list[dict]) -> list[dict]:
    return [{k: c[k] for k in ("id", "source", "metadata", "messages")} for c in sample]


def duplicate_json(manifest: dict, removed: list[dict]) -> dict:
    return {"total_conversations_before": manifest["total_conversations_before"], "total_duplicates_found": manifest["duplicates_removed"], "total_conversations_after": manifest["total_conversations_after"], "removed_duplicates": removed}


def duplicate_md(manifest: dict, removed: list[dict]) -> str:
    keys = ("kept_conversation_id", "removed_conversation_id", "kept_source", "removed_source")
    details = table(["Kept ID", "Removed ID", "Kept Source", "Removed Source"], [":---"] * 4, [[r[k] for k in keys] for r in removed]) if removed else ["No duplicate conversations were found."]
    return "\n".join([
        "# Exact Conversation Deduplication Report", "", "## Summary", f"- **Conversations before**: {manifest['total_conversations_before']}", f"- **Duplicates removed**: {manifest['duplicates_removed']}",
        f"- **Conversations after**: {manifest['total_conversations_after']}", f"- **Duplicate percentage**: {manifest['duplicate_percentage']:.2f}%", "", "## Details", "", *details, "",
    ])


def audit_md(losses: list[dict]) -> str:
    """From rows stage, dataset, n, loss_percent (dataset ``Total`` last)."""
    at = {(r["stage"], r["dataset"]): r for r in losses}
    names = sorted({r["dataset"] for r in losses} - {"Total"})
    heads, rows = ["Stage"], []
    for name in names:
        heads += [f"{name.split('/')[-1]} Count", "% Loss"]
    for k, stage in enumerate(STAGES):
        row: list[object] = [stage]
        for name in [*names, "Total"]:
            r = at.get((stage, name))
            n, loss = (r["n"], r["loss_percent"]) if r else (0, None)
            if r is None and k:
                before = at.get((STAGES[k - 1], name))
                loss = 100.0 if before and before["n"] else 0.0
            row += [n, "-" if k == 0 else f"{loss or 0.0:.2f}%"]
        rows.append(row)
    heads += ["Total Count", "% Loss"]
    return "\n".join(["# Pipeline Audit Report", "", "This report documents conversation counts and data loss percentages at each stage of the pipeline.", "", "## Stage-by-Stage Summary Table", "", *table(heads, [":---"] + [":---:"] * (len(heads) - 1), rows)])


def breakdown_md(categories: list[dict], ids: dict[str, list[str]]) -> str:
    """From rows category, n, percent (most first) and the failing ids of each."""
    lines = ["# Validation Failures Breakdown Report", "", "This report analyzes the distribution of validation failures across the dataset.", "", "## Summary of Validation Error Categories", ""]
    lines += table(["Error Category", "Failures Count", "% of All Failures"], [":---", ":---:", ":---:"], [[c["category"], c["n"], f"{c['percent']:.2f}%"] for c in categories])
    lines += ["", "## Detailed Conversations Breakdown per Category", ""]
    for c in categories:
        lines += [f"### Category: {c['category']}", f"- **Total Failures**: {c['n']}", "- **Failing Conversation IDs**:", *[f"  - `{i}`" for i in ids.get(c["category"], [])], ""]
    return "\n".join(lines)


def example_file_name(category: str) -> str:
    return category.lower().replace(" ", "_").replace("/", "_").replace("'", "") + ".md"


def examples_md(category: str, examples: list[dict]) -> str:
    lines = [f"# Validation Examples: {category}", "", f"Below are representative examples of conversations that failed the validation check: `{category}`.", ""]
    for k, c in enumerate(examples, 1):
        lines += transcript(c, f"## Example {k}: {c['id']}", False)
    return "\n".join(lines)


def curation_md(r: CurationReport) -> str:
    total = sum(r.counts_after_sampling.values()) or 1
    sources = sorted({*r.counts_before, *r.counts_after_quality, *r.counts_after_sampling})
    funnel = [[f"`{s}`", r.counts_before.get(s, 0), r.counts_after_quality.get(s, 0), (n := r.counts_after_sampling.get(s, 0)), f"{n / total * 100:.2f}%"] for s in sources]

    def ranked(counts: dict[str, int], heads: list[str], none: str) -> list[str]:
        return table(heads, [":---", "---:"], [[f"`{k}`", v] for k, v in sorted(counts.items(), key=lambda kv: -kv[1])]) if counts else [none]

    return "\n".join([
        "# Training Curation Report", "", "Documents how the deduplicated corpus was cleaned, filtered and", "rebalanced into the final supervised fine-tuning splits.", "", "## Summary", "",
        f"- **Training conversations**: {r.num_train}", f"- **Validation conversations**: {r.num_validation}", f"- **Random seed**: {r.seed}", "", "## Source Funnel", "",
        *table(["Source", "Deduplicated", "After Quality", "After Rebalancing", "Final Share"], [":---", "---:", "---:", "---:", "---:"], funnel), "", "## Text Repairs", "",
        f"- **Messages inspected**: {r.cleaning['messages_seen']}", f"- **Messages rewritten**: {r.cleaning['messages_changed']}", "", *ranked(r.cleaning["replacements"], ["Rule", "Replacements"], "_No text repairs were required._"), "", "## Quality Filtering", "",
        f"- **Conversations inspected**: {r.quality['num_seen']}", f"- **Conversations retained**: {r.quality['num_kept']}", "", *ranked(r.quality["drops_by_reason"], ["Drop Reason", "Conversations"], "_No conversations were dropped._"), "",
    ])


def token_lines(t: TokenReport) -> list[tuple[str, str]]:
    return [
        ("Total conversations", f"{t.total_conversations}"), ("Total tokens", f"{t.total_tokens}"), ("Average tokens", f"{t.average_tokens:.2f}"), ("Median tokens", f"{t.median_tokens:.1f}"), ("Minimum tokens", f"{t.minimum_tokens}"),
        ("Maximum tokens", f"{t.maximum_tokens}"), ("95th percentile", f"{t.percentile_95_tokens}"), ("99th percentile", f"{t.percentile_99_tokens}"), ("Average turns per conversation", f"{t.average_turns_per_conversation:.2f}"), ("Recommended context length", f"{t.recommended_context_length}"),
    ]


OVER = (1024, 2048, 4096, 8192)


def token_md(t: TokenReport, model_id: str) -> str:
    bins = [[name, t.histogram[name], f"{round(t.histogram[name] / t.total_conversations * 100.0, 2):.2f}%"] for _, name in BINS]
    return "\n".join([
        "# Token Analysis Report", "", f"**Model ID**: `{model_id}`", "", "## Summary Metrics", *[f"- **{k}**: {v}" for k, v in token_lines(t)], "", "## Conversations Over Length Thresholds",
        *[f"- **Tokens > {n}**: {getattr(t, f'conversations_over_{n}')}" for n in OVER], "", "## Token Length Histogram", "", *table(["Length Range", "Conversation Count", "Percentage"], [":---", ":---:", ":---:"], bins), "",
    ])


def token_console(t: TokenReport) -> str:
    return "\n".join([f"{k}: {v}" for k, v in token_lines(t)] + [f"Conversations > {n}: {getattr(t, f'conversations_over_{n}')}" for n in OVER])


def inspection_md(name: str, dataset_id: str | None, splits: dict[str, SplitInspection]) -> str:
    now = datetime.now(UTC).strftime("%Y-%m-%d %H:%M UTC")
    lines = [f"# Inspection Report: {name}\n", f"**Hugging Face ID:** `{dataset_id}`  ", f"**Inspection Date:** {now}  ", "**Splits:** " + ", ".join(f"`{s}`" for s in splits) + "\n"]
    for split, s in splits.items():
        lines += ["---\n", f"## Split: `{split}` — {s.num_rows:,} rows\n", "### Schema\n", "| # | Column | Type | Nested |", "|---|--------|------|--------|"]
        lines += [f"| {k} | `{c['name']}` | `{c['dtype']}` | " + (f"Yes — `{c['dtype']}`" if c["is_nested"] else "No") + " |" for k, c in enumerate(s.schema, 1)] + [""]
        lines += ["### Conversation Structure\n", "| Metric | Value |", "|--------|-------|", f"| Detection method | `{s.method}` |", f"| Grouping column | `{s.grouping_column or 'N/A'}` |", f"| Conversations | {s.turns['n']:,} |", f"| Avg turns per conversation | {s.turns['avg']} |"]
        lines += [f"| Median turns | {s.turns['median']} |", f"| Min turns | {s.turns['min']} |", f"| Max turns | {s.turns['max']} |", ""]
        if s.messages is None:
            lines += ["### Message Statistics\n", "_No text columns detected._\n"]
        else:
            columns = ", ".join(f"`{c}`" for c in s.message_columns or [])
            lines += ["### Message Statistics\n", "| Metric | Value |", "|--------|-------|", f"| Columns analyzed | {columns} |", f"| Avg character length | {s.messages['avg']:,.1f} |", f"| Max character length | {s.messages['max']:,} |", ""]
        lines += [*_quality_lines(s), f"### Sample Records ({len(s.samples)})\n"]
        for k, record in enumerate(s.samples, 1):
            lines += [f"#### Sample {k}\n", "```json", json.dumps(record, indent=2, default=str, ensure_ascii=False), "```\n"]
        if not s.samples:
            lines.append("_No samples available._\n")
    return "\n".join(lines) + "\n"


def _quality_lines(s: SplitInspection) -> list[str]:
    rows = []
    for check, title in (("missing", "Missing values"), ("empty", "Empty strings")):
        rows += [(title, f"`{c}`", n) for c, n in s.quality.get(check, {}).items()]
    if s.duplicate_rows:
        rows.append(("Duplicate rows", "_all columns_", s.duplicate_rows))
    rows += [("Duplicate IDs", f"`{c}`", n) for c, n in s.duplicate_ids.items()]
    for check, title in (("null_messages", "Null messages"), ("long", f"Extremely long (>{LONG}ch)"), ("short", f"Extremely short (<{SHORT}ch)")):
        rows += [(title, f"`{c}`", n) for c, n in s.quality.get(check, {}).items()]
    if not rows:
        return ["### Data Quality\n", "_No quality issues detected._\n"]
    return ["### Data Quality\n", "| Check | Column | Count |", "|-------|--------|-------|", *[f"| {a} | {b} | {n:,} |" for a, b, n in rows], ""]


def inspection_file_name(dataset_id: str) -> str:
    return dataset_id.replace("/", "_").replace(" ", "_").lower() + ".md"


def parse_console(r: ParseReport) -> str:
    line = "=" * 40
    out = ["", line, f"Dataset:\n{r.dataset_id}\n", f"Conversations parsed: {r.num_conversations}\n", f"Average turns: {r.avg_turns:.2f}\n", f"Maximum turns: {r.max_turns}\n", f"Minimum turns: {r.min_turns}\n", f"Skipped conversations: {r.skipped_conversations}", line]
    for title, items in (("Warnings", r.warnings), ("Errors", r.errors)):
        if items:
            out += [f"\n{title}:", *[f"  - {x}" for x in items]]
    return "\n".join(out)


def pipeline_console(manifest: dict, outputs: dict[str, str], report: CurationReport | None) -> str:
    line, dash = "=" * 40, "-" * 40
    labels = [("Canonical JSONL", "canonical_dataset_jsonl"), ("Deduplicated JSONL", "deduplicated_dataset_jsonl"), ("Manifest JSON", "manifest_json"), ("Duplicate JSON Rep", "duplicate_report_json"), ("Duplicate MD Rep", "duplicate_report_md"), ("Statistics JSON", "statistics_json"), ("Statistics MD", "statistics_md"), ("Review Sample JSON", "review_sample_json"), ("Review Sample MD", "review_sample_md")]
    pad = lambda label: f"{label + ':':<22}"
    out = ["", line, "PIPELINE EXECUTION COMPLETED SUCCESSFULLY!", f"{pad('Conversations before')}{manifest['total_conversations_before']}", f"{pad('Duplicates removed')}{manifest['duplicates_removed']}", f"{pad('Conversations after')}{manifest['total_conversations_after']}", f"{pad('Duplicate percentage')}{manifest['duplicate_percentage']:.2f}%", dash]
    out += [pad(label) + outputs[key] for label, key in labels]
    if report is not None:
        out += [dash, *[pad(label) + outputs[key] for label, key in (("Training JSONL", "train_jsonl"), ("Validation JSONL", "validation_jsonl"), ("Curation Report JSON", "curation_report_json"), ("Curation Report MD", "curation_report_md"))], dash]
        out += [f"{pad('Train conversations')}{report.num_train}", f"{pad('Val conversations')}{report.num_validation}", *[f"  {s}: {n}" for s, n in sorted(report.counts_after_sampling.items())]]
    return "\n".join([*out, line, ""])
