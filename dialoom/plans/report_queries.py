"""More queries with their SQL: seeded order, report texts, profiling, registries and configuration.

Report texts come as one row ``report``; the SQL spells the fixed layout out on its own. Seeded orders follow the
standard library's generator, so the SQL holds their positions as lists for the row counts that the tables have.
"""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.udfs import bpe_counter
from ..operators import curate, dedup, inspect, merge, normalize, parse, sample, stats, tokens, validate
from ..schemas import ConfigError, MergeError, ParseError
from ..sources.catalog import Catalog, DatasetEntry
from . import pipeline, reports
from .queries import COUNTED, CURATOR, E2E, FAULTY, NORMAL, ORACLES, PAIRS, PLAIN, UTTERANCES, counted, dialogs, dirty_conversations, expanded, faulty, pairs, plain, query, read, utterances

#: Row counts that the seeded queries meet: conversations at each scale factor, and small samples.
COUNTS = (20, 100, 1000)
SMALL = range(1, 80)
LF = "chr(10)"


def one_text(spark: SparkSession, text: str) -> DataFrame:
    return spark.createDataFrame([(text,)], "report string")


def text_sql(*lines: str) -> str:
    return f"array_to_string([{', '.join(lines)}], {LF})"


def places(times: int, counts, n: str = "n", pos: str = "pos") -> str:
    """SQL: the place of row ``pos`` among ``n`` after seeded shuffles."""
    cases = []
    for size in counts:
        rows = list(range(size))
        for _ in range(times):
            random.Random(42).shuffle(rows)
        where = [0] * size
        for place, row in enumerate(rows):
            where[row] = place
        cases.append(f"WHEN {size} THEN {where}[{pos} + 1]")
    return f"CAST(CASE {n} {' '.join(cases)} END AS BIGINT)"


def sampled(k: int, n: str = "n", pos: str = "pos") -> str:
    """SQL: whether row ``pos`` of ``n`` is in the seeded sample."""
    picked = {size: sorted(random.Random(42).sample(range(size), k)) if size > k else list(range(size)) for size in COUNTS}
    return f"CASE {n} {' '.join(f'WHEN {size} THEN list_contains({rows}, {pos})' for size, rows in picked.items())} END"


NUMBERED = f"WITH {PLAIN}, p AS (SELECT *, row_number() OVER (ORDER BY ord) - 1 AS pos, count(*) OVER () AS n FROM conv)"

# --- seeded order, echoes and the whole curation: SQL for queries that are registered without ---

ORACLES["w06_shuffle"] = expanded(f"{NUMBERED} SELECT ord, {places(2, COUNTS)} AS place FROM p")
ORACLES["w09_sample"] = expanded(f"{NUMBERED} SELECT ord, id FROM p WHERE {sampled(30)}")
ORACLES["q05_echo"] = expanded("""WITH r AS (SELECT conv_id, turn, role, text, lag(text) OVER w AS before, lag(role) OVER w AS said FROM talk WINDOW w AS (PARTITION BY conv_id ORDER BY turn)),
  e AS (SELECT *, CASE WHEN conv_id % 3 = 0 AND role = 'assistant' AND before IS NOT NULL THEN upper(before) || '!' ELSE text END AS content FROM r),
  a AS (SELECT conv_id, count(*) AS n, count(*) FILTER (WHERE role = 'assistant') AS said, arg_max(length(content), turn) FILTER (WHERE role = 'assistant') AS final, count(*) FILTER (WHERE role = 'assistant' AND length(content) < 40) AS short,
    bool_or(conv_id % 3 = 0 AND role = 'assistant' AND said = 'user') AS echo FROM e GROUP BY 1)
  SELECT conv_id AS ord, CASE WHEN n < 2 THEN 'too_few_messages' WHEN said = 0 THEN 'no_assistant_turn' WHEN final < 40 THEN 'final_response_too_short' WHEN short / said > 0.5 THEN 'mostly_short_responses' WHEN echo THEN 'assistant_echoes_user' ELSE 'kept' END AS reason FROM a""")
SHAPED = E2E[: E2E.index("SELECT conv_id AS ord")]
KEPT = SHAPED + E2E[E2E.index("SELECT conv_id AS ord") :].replace("SELECT conv_id AS ord, 's' || (conv_id % 3) AS source, count(*) AS turns,", ", kept AS (SELECT conv_id AS ord, 's' || (conv_id % 3) AS source, 'conv_' || conv_id AS id, count(*) AS turns, sum(length(content)) FILTER (WHERE role = 'assistant') AS said,") + ")"
FINAL = KEPT + """, s AS (SELECT *, CASE source WHEN 's0' THEN 10 WHEN 's1' THEN 20 END AS cap, row_number() OVER (PARTITION BY source ORDER BY said DESC, id DESC) AS rn, count(*) OVER (PARTITION BY source) AS size, min(ord) OVER (PARTITION BY source) AS first FROM kept),
  f AS (SELECT *, CASE WHEN size > cap THEN rn ELSE ord END AS rank FROM s WHERE cap IS NULL OR rn <= cap), p AS (SELECT *, row_number() OVER (ORDER BY first, rank) - 1 AS pos, count(*) OVER () AS n FROM f)"""
ORACLES["f02_curate_end_to_end"] = expanded(f"{FINAL}, x AS (SELECT *, {places(2, SMALL)} AS place FROM p) SELECT id, source, place, CASE WHEN place < floor(n * 0.95) THEN 'train' ELSE 'validation' END AS part, turns FROM x")


@query("w13_simple_export", f"""{NUMBERED}, x AS (SELECT *, {places(1, COUNTS)} AS place FROM p) SELECT ord, place, CASE WHEN place < floor(n * 0.9) THEN 'train' ELSE 'validation' END AS part FROM x""")
def w13(spark, d):
    placed = sample.shuffled(plain(spark, d), 42, 1)
    train, validation = sample.split_by_ratio(placed, 0.9)
    return train.select("ord", "place", F.lit("train").alias("part")).unionByName(validation.select("ord", "place", F.lit("validation").alias("part")))


@query("w04_previous_turn", "WITH r AS (SELECT conv_id, role, text, lag(text) OVER w AS before, lag(role) OVER w AS said FROM talk WINDOW w AS (PARTITION BY conv_id ORDER BY turn)), n AS (SELECT conv_id AS ord, trim(regexp_replace(lower(before), '[^a-z0-9 ]+', '', 'g')) AS \"user\", trim(regexp_replace(lower(text), '[^a-z0-9 ]+', '', 'g')) AS assistant FROM r WHERE role = 'assistant' AND said = 'user') SELECT * FROM n WHERE \"user\" <> '' AND assistant <> ''")
def w04(spark, d):
    return curate.echo_pairs(plain(spark, d))


@query("a07_curation_counts", f"""{FINAL} SELECT 'before' AS stage, 's' || (conv_id % 3) AS source, count(DISTINCT conv_id) AS n FROM talk GROUP BY 2
  UNION ALL SELECT 'after_quality', source, count(*) FROM kept GROUP BY 2 UNION ALL SELECT 'after_sampling', source, count(*) FROM f GROUP BY 2""")
def a07(spark, d):
    _, _, r = pipeline.curate_corpus(dirty_conversations(spark, d), CURATOR)
    stages = {"before": r.counts_before, "after_quality": r.counts_after_quality, "after_sampling": r.counts_after_sampling}
    return spark.createDataFrame([(stage, source, n) for stage, counts in stages.items() for source, n in counts.items()], "stage string, source string, n long")


# --- parsing and normalising ---


@query("p06_attributes", f"""WITH {UTTERANCES}, t AS (SELECT u.conv_id, u.turn, u.idx FROM u JOIN x ON x.conv_id = u.conv_id WHERE x.reason IS NULL) SELECT CAST(conv_id AS VARCHAR) AS id, 'ctx' AS context, 'train' AS split, string_agg(CAST(idx AS VARCHAR), ',' ORDER BY turn) AS indices, count(*) AS n_null_tags FROM t GROUP BY conv_id""")
def p06(spark, d):
    p = parse.accepted(parse.parse_grouped(utterances(spark, d), "grouped", "train"))
    indices = F.concat_ws(",", F.transform("messages", lambda m: m["attributes"]["utterance_idx"]))
    return p.select("id", F.col("attributes")["context"].alias("context"), F.col("attributes")["split"].alias("split"), indices.alias("indices"), F.size(F.filter("messages", lambda m: m["attributes"]["tags"].isNull())).cast("long").alias("n_null_tags"))


@query("p08_dialog_attributes", "SELECT 'dialog_train_' || conv_id AS id, 'e' || (conv_id % 4) AS emotion, 'train' AS split, CAST(2 AS BIGINT) AS n FROM (SELECT DISTINCT conv_id FROM conversations) WHERE conv_id % 6 NOT IN (2, 3, 4)")
def p08(spark, d):
    p = parse.parse_json_dialog(dialogs(spark, d), "json_dialog", "train").where("context is not null")
    return p.select("id", F.col("attributes")["emotion_type"].alias("emotion"), F.col("attributes")["split"].alias("split"), F.size("attributes").cast("long").alias("n"))


@query("n03_pair_roles", f"WITH {PAIRS} SELECT 'pair_train_' || row_idx AS id, 'user:' || context || '~assistant:' || response AS joined, 'pairs' AS dataset, 'pair_train_' || row_idx AS original FROM p WHERE trim(context) <> '' AND trim(response) <> ''")
def n03(spark, d):
    ok, _ = normalize.split_quarantine(normalize.normalize_pairs(parse.accepted(parse.parse_pairs(pairs(spark, d), "pairs", "train"))))
    said = F.concat_ws("~", F.transform("messages", lambda m: F.concat(m["role"], F.lit(":"), m["content"])))
    return ok.select("id", said.alias("joined"), F.col("metadata.source_dataset").alias("dataset"), F.col("metadata.original_id").alias("original"))


def raised(call, kinds=Exception) -> bool:
    try:
        call()
    except kinds:
        return True
    return False


@query("p01_required_columns", "SELECT * FROM (VALUES ('all there', false), ('one missing', true), ('missing, no rows', false)) v(\"case\", raised)")
def p01(spark, d):
    rows = utterances(spark, d)
    cases = {"all there": rows, "one missing": rows.drop("utterance"), "missing, no rows": rows.drop("utterance").where("false")}
    return spark.createDataFrame([(k, raised(lambda r=r: parse.require_columns(r, ["conv_id", "utterance_idx", "speaker_idx", "utterance"]), ParseError)) for k, r in cases.items()], "case string, raised boolean")


@query("p12_registries", """SELECT * FROM (VALUES ('parser', 'grouped', 'parse_grouped'), ('parser', 'owner/GROUPED', 'parse_grouped'), ('parser', 'json_dialog', 'parse_json_dialog'), ('parser', 'Pairs', 'parse_pairs'), ('parser', 'none', NULL),
  ('normalizer', 'grouped', 'normalize_alternating'), ('normalizer', 'x/json_dialog', 'normalize_dialog'), ('normalizer', 'PAIRS', 'normalize_pairs'), ('validator', 'conversation', 'validated'), ('validator', 'other', NULL), ('filter', 'conversation', 'filter_by_report')) v(kind, name, found)""")
def p12(spark, d):
    kinds = {"parser": parse.PARSERS, "normalizer": normalize.NORMALIZERS, "validator": validate.VALIDATORS, "filter": validate.FILTERS}
    asked = [("parser", n) for n in ("grouped", "owner/GROUPED", "json_dialog", "Pairs", "none")] + [("normalizer", n) for n in ("grouped", "x/json_dialog", "PAIRS")] + [("validator", "conversation"), ("validator", "other"), ("filter", "conversation")]
    return spark.createDataFrame([(k, n, None if raised(lambda k=k, n=n: kinds[k].get(n), KeyError) else kinds[k].get(n).__name__) for k, n in asked], "kind string, name string, found string")


# --- dedup and merging ---


def as_conversations(spark: SparkSession, d: str) -> DataFrame:
    docs = read(spark, d, "documents")
    meta = F.struct(F.lit("train").alias("split"), F.col("source").alias("source_dataset"), F.col("doc_id").cast("string").alias("original_id"), F.col("lang").alias("context"))
    return docs.select(F.col("doc_id").alias("ord"), F.concat(F.lit("doc_"), F.col("doc_id").cast("string")).alias("id"), "source", meta.alias("metadata"), F.array(F.struct(F.lit("user").alias("role"), F.col("text").alias("content"))).alias("messages"))


COPIES = f"WITH n AS (SELECT doc_id, source, {NORMAL} AS t FROM documents), k AS (SELECT *, first_value(doc_id) OVER w AS kept, first_value(source) OVER w AS kept_source FROM n WINDOW w AS (PARTITION BY t ORDER BY doc_id)), r AS (SELECT 'doc_' || kept AS kept_id, 'doc_' || doc_id AS removed_id, kept_source, source, doc_id FROM k WHERE doc_id <> kept)"


@query("d05_removed", f"{COPIES} SELECT doc_id AS ord, kept_id AS kept_conversation_id, removed_id AS removed_conversation_id, kept_source, source AS removed_source FROM r")
def d05(spark, d):
    return dedup.deduplicate(as_conversations(spark, d))[1].drop("hash")


@query("d06_merge_report", f"{COPIES} SELECT source, count(*) AS n FROM k WHERE doc_id = kept GROUP BY 1")
def d06(spark, d):
    """The merge report counted anew on what dedup has kept."""
    rows = as_conversations(spark, d)
    report = merge.refreshed(merge.merge_report(rows), stats.statistics(dedup.deduplicate(rows)[0]))
    return spark.createDataFrame(list(report.dataset_counts.items()), "source string, n long")


@query("m03_dataset_order", "SELECT CAST(0 AS INTEGER) AS place, 's0' AS source UNION ALL SELECT 1, 's1' UNION ALL SELECT 2, 's2'")
def m03_order(spark, d):
    parts = [plain(spark, d).where(F.col("ord") % 3 == k).withColumn("ord", F.col("ord") + F.lit(k << 40)) for k in range(3)]
    report = merge.merge_report(merge.merge(parts))
    return spark.createDataFrame(list(enumerate(report.dataset_order)), "place int, source string")


# --- statistics ---


@query("a05_context_order", f"WITH {PLAIN}, c AS (SELECT coalesce(metadata.context, 'None') AS context, count(*) AS n, min(ord) AS first FROM conv GROUP BY 1) SELECT row_number() OVER (ORDER BY n DESC, first) - 1 AS place, context, n FROM c")
def a05_order(spark, d):
    s = stats.statistics(plain(spark, d))
    return spark.createDataFrame([(k, c, n) for k, (c, n) in enumerate(s.context_distribution.items())], "place long, context string, n long")


@query("a06_empty_corpus", "SELECT CAST(0 AS BIGINT) AS total, 0.0::DOUBLE AS average_turns, 0.0::DOUBLE AS median_turns, CAST(0 AS BIGINT) AS maximum_turns, 0.0::DOUBLE AS user_length, CAST(0 AS BIGINT) AS longest, CAST(0 AS BIGINT) AS sources FROM conversations WHERE conv_id < 0 HAVING count(*) = 0")
def a06(spark, d):
    s = stats.statistics(plain(spark, d).where("ord < 0"))
    return spark.createDataFrame([(s.total_conversations, float(s.average_turns), s.median_turns, s.maximum_turns, float(s.average_user_message_length), s.maximum_message_length, len(s.conversations_per_dataset))], "total long, average_turns double, median_turns double, maximum_turns long, user_length double, longest long, sources long")


@query("a17_context_length", f"WITH {COUNTED}, q AS (SELECT round_even(quantile_cont(tokens::DOUBLE, 0.99), 0) AS p99 FROM t) SELECT CAST(p99 AS BIGINT) AS p99, CAST(CASE WHEN p99 <= 1024 THEN 1024 ELSE pow(2, ceil(log2(p99))) END AS BIGINT) AS context FROM q")
def a17(spark, d):
    r = tokens.token_report(counted(spark, d))
    return spark.createDataFrame([(r.percentile_99_tokens, r.recommended_context_length)], "p99 long, context long")


@query("t02_bpe_tokens")
def t02_bpe(spark, d):
    """Tokens by a published byte-level vocabulary."""
    return tokens.token_counts(plain(spark, d), counter=bpe_counter()).select("ord", "tokens", "turns")


# --- inspection ---

KIND_SQL = "CASE data_type WHEN 'BIGINT' THEN 'int64' WHEN 'INTEGER' THEN 'int32' WHEN 'DOUBLE' THEN 'float64' WHEN 'VARCHAR' THEN 'string' WHEN 'TIMESTAMP' THEN 'timestamp' WHEN 'FLOAT[]' THEN 'list[float32]' END"
TABLES = ("documents", "embeddings", "events", "orders", "conversations")


@query("i01_schema", f"SELECT table_name AS \"table\", column_name AS name, {KIND_SQL} AS dtype, data_type LIKE '%[]' AS is_nested FROM information_schema.columns WHERE table_name IN {TABLES}")
def i01(spark, d):
    return spark.createDataFrame([(t, c["name"], c["dtype"], c["is_nested"]) for t in TABLES for c in inspect.describe_schema(read(spark, d, t))], "table string, name string, dtype string, is_nested boolean")


@query("i02_columns", f"SELECT table_name AS \"table\", string_agg(column_name, ',' ORDER BY ordinal_position) FILTER (WHERE data_type = 'VARCHAR') AS texts, string_agg(column_name, ',' ORDER BY ordinal_position) FILTER (WHERE data_type LIKE '%[]') AS lists, max(CASE WHEN column_name = 'conv_id' THEN column_name END) AS grouping FROM information_schema.columns WHERE table_name IN {TABLES} GROUP BY 1")
def i02(spark, d):
    rows = [(t, ",".join(inspect.text_columns(x)) or None, ",".join(inspect.list_columns(x)) or None, inspect.grouping_column(x)) for t in TABLES for x in [read(spark, d, t)]]
    return spark.createDataFrame(rows, "table string, texts string, lists string, grouping string")


@query("i03_list_column", "SELECT count(*) AS n, avg(len(embedding)) AS avg, median(len(embedding)) AS median, min(len(embedding)) AS min, max(len(embedding)) AS max FROM embeddings")
def i03_lists(spark, d):
    return inspect.conversation_stats(read(spark, d, "embeddings"))[2]


@query("i03_row_level", "SELECT count(*) AS n, 3.0::DOUBLE AS avg, 3.0::DOUBLE AS median, CAST(3 AS BIGINT) AS min, CAST(3 AS BIGINT) AS max FROM documents")
def i03_rows(spark, d):
    return inspect.conversation_stats(read(spark, d, "documents"))[2]


@query("i08_all_columns", "SELECT CAST(count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM conversations)) AS BIGINT) AS n FROM conversations")
def i08_all(spark, d):
    return inspect.duplicate_rows(read(spark, d, "conversations"))


@query("i11_splits", "SELECT 'train' AS split, count(*) AS rows, 'row_level' AS method, CAST(count(*) - count(DISTINCT doc_id) AS BIGINT) AS repeated_ids, CAST(3 AS BIGINT) AS samples FROM documents UNION ALL SELECT 'test', count(*), 'id_grouped', 0, 3 FROM conversations")
def i11(spark, d):
    found = inspect.inspect_dataset({"train": read(spark, d, "documents"), "test": read(spark, d, "conversations")})
    return spark.createDataFrame([(k, s.num_rows, s.method, s.duplicate_ids.get("doc_id", 0), len(s.samples)) for k, s in found.items()], "split string, rows long, method string, repeated_ids long, samples long")


# --- report texts ---


@query("r01_statistics", f"""WITH {PLAIN}, t AS (SELECT count(*) AS n, avg(len(messages)) AS a, median(len(messages)) AS m, min(len(messages)) AS low, max(len(messages)) AS high FROM conv),
  l AS (SELECT avg(length(text)) FILTER (WHERE role = 'user') AS u, avg(length(text)) FILTER (WHERE role = 'assistant') AS s, max(length(text)) AS x FROM talk),
  s AS (SELECT source, count(*) AS n, printf('%.2f', round(count(*) / (SELECT n FROM t) * 100, 2)) AS p FROM conv GROUP BY 1), c AS (SELECT coalesce(metadata.context, 'None') AS context, count(*) AS n, min(ord) AS first FROM conv GROUP BY 1)
  SELECT {text_sql("'# Dataset Merger Statistics Report'", "''", "'## Overall Summary'", "'- **Total Conversations**: ' || t.n", "'- **Average Turns**: ' || printf('%.2f', round(t.a, 2))", "'- **Median Turns**: ' || printf('%.1f', t.m)", "'- **Minimum Turns**: ' || t.low", "'- **Maximum Turns**: ' || t.high", "''", "'## Message Metrics'",
  "'- **Average User Message Length (chars)**: ' || printf('%.2f', round(l.u, 2))", "'- **Average Assistant Message Length (chars)**: ' || printf('%.2f', round(l.s, 2))", "'- **Maximum Message Length (chars)**: ' || l.x", "''", "'## Dataset Contributions'", "''", "'| Dataset Key | Conversations | Contribution % |'", "'| :--- | :--- | :--- |'",
  f"(SELECT string_agg('| ' || source || ' | ' || n || ' | ' || p || '% |', {LF} ORDER BY source) FROM s)", "''", "'## Context Distribution'", "''", "'| Context | Conversations |'", "'| :--- | :--- |'", f"(SELECT string_agg('| ' || context || ' | ' || n || ' |', {LF} ORDER BY n DESC, first) FROM c)", "''")} AS report FROM t, l""")
def r01(spark, d):
    return one_text(spark, reports.statistics_md(stats.statistics(plain(spark, d))))


TRANSCRIPT = "'- **Source**: ' || source || chr(10) || '- **Split**: train' || chr(10) || '- **Context**: ' || coalesce(metadata.context, 'None') || chr(10)"
TURNS = "chr(10) || '### Dialogue Turns' || chr(10) || chr(10) || list_aggregate(list_transform(messages, lambda m: '**[' || m.role || ']**: ' || m.content || chr(10) || chr(10)), 'string_agg', '') || '---' || chr(10)"


@query("r02_review_sample", f"""{NUMBERED}, s AS (SELECT *, row_number() OVER (ORDER BY ord) AS k FROM p WHERE {sampled(7)})
  SELECT '# Dataset Review Sample' || {LF} || {LF} || 'This sample contains ' || count(*) || ' conversations selected deterministically for review.' || {LF} || {LF} || string_agg('## Conversation ' || k || ': ' || id || {LF} || {TRANSCRIPT} || '- **Original ID**: ' || metadata.original_id || {LF} || {TURNS}, {LF} ORDER BY k) AS report FROM s""")
def r02(spark, d):
    shown = [r.asDict(recursive=True) for r in sample.review_sample(plain(spark, d), 7, 42).collect()]
    return one_text(spark, reports.review_md(shown))


@query("r03_duplicates", f"""{COPIES}, c AS (SELECT (SELECT count(*) FROM n) AS b, (SELECT count(*) FROM r) AS r) SELECT {text_sql("'# Exact Conversation Deduplication Report'", "''", "'## Summary'", "'- **Conversations before**: ' || c.b", "'- **Duplicates removed**: ' || c.r", "'- **Conversations after**: ' || (c.b - c.r)", "'- **Duplicate percentage**: ' || printf('%.2f', round(c.r / c.b * 100.0, 2)) || '%'", "''", "'## Details'", "''", "'| Kept ID | Removed ID | Kept Source | Removed Source |'", "'| :--- | :--- | :--- | :--- |'",
  f"(SELECT string_agg('| ' || kept_id || ' | ' || removed_id || ' | ' || kept_source || ' | ' || source || ' |', {LF} ORDER BY doc_id) FROM r)", "''")} AS report FROM c""")
def r03(spark, d):
    rows = as_conversations(spark, d)
    listed = [r.asDict() for r in dedup.deduplicate(rows)[1].orderBy("ord").drop("ord").toLocalIterator()]
    return one_text(spark, reports.duplicate_md(dedup.manifest(rows.count(), len(listed), "v1"), listed))


STAGE_SQL = """SELECT * FROM (VALUES ('Loaded', 0), ('Parsed', 1), ('Normalized', 2), ('Validated', 3), ('Filtered', 4), ('Merged', 5)) v(stage, s)"""
AUDIT = f"""WITH {FAULTY}, bad AS (SELECT DISTINCT conv_id FROM e), k AS (SELECT DISTINCT conv_id, 's' || (conv_id % 3) AS dataset FROM f), v AS ({STAGE_SQL}),
  c AS (SELECT 's' || (conv_id % 3) AS dataset, count(*) AS n, 0 AS kind FROM conversations GROUP BY 1 UNION ALL SELECT dataset, count(*), 1 FROM k GROUP BY 1 UNION ALL SELECT dataset, count(*), 2 FROM k WHERE conv_id NOT IN (SELECT conv_id FROM bad) GROUP BY 1),
  y AS (SELECT v.stage, v.s, c.dataset, c.n FROM v JOIN c ON c.kind = CASE WHEN s = 0 THEN 0 WHEN s < 4 THEN 1 ELSE 2 END), z AS (SELECT * FROM y UNION ALL SELECT stage, s, 'Total', CAST(sum(n) AS BIGINT) FROM y GROUP BY stage, s),
  q AS (SELECT *, lag(n) OVER (PARTITION BY dataset ORDER BY s) AS before FROM z),
  r AS (SELECT s, stage, string_agg(n || ' | ' || CASE WHEN s = 0 THEN '-' ELSE printf('%.2f', coalesce((before - n) / before::DOUBLE * 100.0, 0)) || '%' END, ' | ' ORDER BY dataset = 'Total', dataset) AS cells FROM q GROUP BY 1, 2)"""


def staged(spark: SparkSession, d: str) -> DataFrame:
    checked = validate.validated(faulty(spark, d))
    dataset = F.concat(F.lit("s"), (F.col("conv_id") % 3).cast("string")).alias("dataset")
    loaded = read(spark, d, "conversations").groupBy(dataset).agg(F.count(F.lit(1)).alias("n"))
    each = lambda df: df.groupBy(F.col("source").alias("dataset")).agg(F.count(F.lit(1)).alias("n"))
    counts = {"Loaded": loaded, "Parsed": each(checked), "Normalized": each(checked), "Validated": each(checked), "Filtered": each(checked.where(F.size("errors") == 0)), "Merged": each(checked.where(F.size("errors") == 0))}
    out = None
    for stage, rows in counts.items():
        one = rows.select(F.lit(stage).alias("stage"), "dataset", "n")
        out = one if out is None else out.unionByName(one)
    return out


@query("r04_audit", f"""{AUDIT} SELECT {text_sql("'# Pipeline Audit Report'", "''", "'This report documents conversation counts and data loss percentages at each stage of the pipeline.'", "''", "'## Stage-by-Stage Summary Table'", "''", "'| Stage | s0 Count | % Loss | s1 Count | % Loss | s2 Count | % Loss | Total Count | % Loss |'", "'| :--- | :---: | :---: | :---: | :---: | :---: | :---: | :---: | :---: |'", f"(SELECT string_agg('| ' || stage || ' | ' || cells || ' |', {LF} ORDER BY s) FROM r)")} AS report""")
def r04(spark, d):
    return one_text(spark, reports.audit_md([r.asDict() for r in stats.stage_losses(staged(spark, d)).collect()]))


BREAKDOWN = f"""WITH {FAULTY}, i AS (SELECT h.*, CASE WHEN conv_id % 10 = 3 THEN ' ' ELSE 'conv_' || conv_id END AS id FROM h), g AS (SELECT category, count(*) AS n, min(conv_id * 1000000 + k * 10 + j) AS first, count(*) * 100.0 / (SELECT count(*) FROM h) AS p, string_agg('  - `' || id || '`', {LF} ORDER BY conv_id, k, j) AS ids FROM i GROUP BY 1)"""


@query("r05_breakdown", f"""{BREAKDOWN} SELECT {text_sql("'# Validation Failures Breakdown Report'", "''", "'This report analyzes the distribution of validation failures across the dataset.'", "''", "'## Summary of Validation Error Categories'", "''", "'| Error Category | Failures Count | % of All Failures |'", "'| :--- | :---: | :---: |'", f"(SELECT string_agg('| ' || category || ' | ' || n || ' | ' || printf('%.2f', p) || '% |', {LF} ORDER BY n DESC, first) FROM g)", "''", "'## Detailed Conversations Breakdown per Category'", "''",
  f"(SELECT string_agg('### Category: ' || category || {LF} || '- **Total Failures**: ' || n || {LF} || '- **Failing Conversation IDs**:' || {LF} || ids || {LF}, {LF} ORDER BY n DESC, first) FROM g)")} AS report""")
def r05(spark, d):
    checked = validate.validated(faulty(spark, d))
    categories = [r.asDict() for r in stats.error_breakdown(checked).orderBy(F.desc("n"), "first_ord", "first_pos").collect()]
    return one_text(spark, reports.breakdown_md(categories, pipeline.failing_ids(checked)))


@query("r06_examples", f"""WITH {FAULTY}, g AS (SELECT conv_id, 's' || (conv_id % 3) AS source, {{'context': CASE WHEN conv_id % 5 > 0 THEN 'c' || (conv_id % 5) END}} AS metadata, list({{'role': role, 'content': CASE WHEN trim(text) = '' THEN ' ' || chr(10) ELSE text END}} ORDER BY turn) AS messages FROM f GROUP BY conv_id),
  x AS (SELECT DISTINCT conv_id FROM h WHERE category = 'Message has invalid role'), y AS (SELECT CASE WHEN conv_id % 10 = 3 THEN ' ' ELSE 'conv_' || conv_id END AS id, min(conv_id) AS conv_id FROM x GROUP BY 1), z AS (SELECT *, row_number() OVER (ORDER BY conv_id) AS k FROM y)
  SELECT '# Validation Examples: Message has invalid role' || {LF} || {LF} || 'Below are representative examples of conversations that failed the validation check: `Message has invalid role`.' || {LF} || {LF} || string_agg('## Example ' || k || ': ' || z.id || {LF} || {TRANSCRIPT} || {TURNS}, {LF} ORDER BY k) AS report FROM z JOIN g USING (conv_id) WHERE k <= 10""")
def r06(spark, d):
    checked = validate.validated(faulty(spark, d))
    chosen = stats.error_examples(checked).where(F.col("category") == "Message has invalid role").select("rn", F.col("ord").alias("_o"))
    rows = checked.join(chosen, F.col("ord") == F.col("_o")).orderBy("rn").collect()
    return one_text(spark, reports.examples_md("Message has invalid role", [r.asDict(recursive=True) for r in rows]))


@query("r09_tokens", f"""WITH {COUNTED}, q AS (SELECT count(*) AS n, CAST(sum(tokens) AS BIGINT) AS s, avg(tokens) AS a, median(tokens) AS m, CAST(min(tokens) AS BIGINT) AS low, CAST(max(tokens) AS BIGINT) AS high, CAST(round_even(quantile_cont(tokens::DOUBLE, 0.95), 0) AS BIGINT) AS p95, CAST(round_even(quantile_cont(tokens::DOUBLE, 0.99), 0) AS BIGINT) AS p99, avg(turns) AS t FROM t),
  b AS (SELECT * FROM (VALUES (0, '0-128', 0, 128), (1, '129-256', 128, 256), (2, '257-512', 256, 512), (3, '513-1024', 512, 1024), (4, '1025-2048', 1024, 2048), (5, '2049-4096', 2048, 4096), (6, '4097-8192', 4096, 8192), (7, '8193+', 8192, 1e18)) v(k, bin, low, high)), h AS (SELECT k, bin, (SELECT count(*) FROM t WHERE tokens > low AND tokens <= high) AS c FROM b)
  SELECT {text_sql("'# Token Analysis Report'", "''", "'**Model ID**: `plain`'", "''", "'## Summary Metrics'", "'- **Total conversations**: ' || n", "'- **Total tokens**: ' || s", "'- **Average tokens**: ' || printf('%.2f', round(a, 2))", "'- **Median tokens**: ' || printf('%.1f', m)", "'- **Minimum tokens**: ' || low", "'- **Maximum tokens**: ' || high", "'- **95th percentile**: ' || p95", "'- **99th percentile**: ' || p99", "'- **Average turns per conversation**: ' || printf('%.2f', round(t, 2))",
  "'- **Recommended context length**: ' || CASE WHEN p99 <= 1024 THEN 1024 ELSE CAST(pow(2, ceil(log2(p99))) AS BIGINT) END", "''", "'## Conversations Over Length Thresholds'", *[f"'- **Tokens > {k}**: ' || (SELECT count(*) FROM t WHERE tokens > {k})" for k in (1024, 2048, 4096, 8192)], "''", "'## Token Length Histogram'", "''", "'| Length Range | Conversation Count | Percentage |'", "'| :--- | :---: | :---: |'",
  f"(SELECT string_agg('| ' || bin || ' | ' || c || ' | ' || printf('%.2f', round(c / (SELECT n FROM q) * 100.0, 2)) || '% |', {LF} ORDER BY k) FROM h)", "''")} AS report FROM q""")
def r09(spark, d):
    return one_text(spark, reports.token_md(tokens.token_report(counted(spark, d)), "plain"))


@query("r11_parse_console", f"""WITH {UTTERANCES}, o AS (SELECT count(*) FILTER (WHERE reason IS NULL) AS ok, count(*) FILTER (WHERE reason IS NOT NULL) AS skipped, avg(n) FILTER (WHERE reason IS NULL) AS a, max(n) FILTER (WHERE reason IS NULL) AS high, min(n) FILTER (WHERE reason IS NULL) AS low, string_agg('  - Skipping conversation ''' || conv_id || ''': ' || reason, {LF} ORDER BY conv_id) FILTER (WHERE reason IS NOT NULL) AS why FROM x)
  SELECT {text_sql("''", "repeat('=', 40)", "'Dataset:'", "'grouped'", "''", "'Conversations parsed: ' || ok", "''", "'Average turns: ' || printf('%.2f', a)", "''", "'Maximum turns: ' || high", "''", "'Minimum turns: ' || low", "''", "'Skipped conversations: ' || skipped", "repeat('=', 40)", "''", "'Warnings:'", "why")} AS report FROM o""")
def r11(spark, d):
    return one_text(spark, reports.parse_console(parse.parse_report(parse.parse_grouped(utterances(spark, d), "grouped", "train"), "grouped")))


OUTPUT_LABELS = (("Canonical JSONL", "canonical_dataset_jsonl"), ("Deduplicated JSONL", "deduplicated_dataset_jsonl"), ("Manifest JSON", "manifest_json"), ("Duplicate JSON Rep", "duplicate_report_json"), ("Duplicate MD Rep", "duplicate_report_md"), ("Statistics JSON", "statistics_json"), ("Statistics MD", "statistics_md"), ("Review Sample JSON", "review_sample_json"), ("Review Sample MD", "review_sample_md"))


@query("r12_pipeline_console", f"""{COPIES}, c AS (SELECT (SELECT count(*) FROM n) AS b, (SELECT count(*) FROM r) AS r) SELECT {text_sql("''", "repeat('=', 40)", "'PIPELINE EXECUTION COMPLETED SUCCESSFULLY!'", "rpad('Conversations before:', 22, ' ') || c.b", "rpad('Duplicates removed:', 22, ' ') || c.r", "rpad('Conversations after:', 22, ' ') || (c.b - c.r)", "rpad('Duplicate percentage:', 22, ' ') || printf('%.2f', round(c.r / c.b * 100.0, 2)) || '%'", "repeat('-', 40)", *[f"rpad('{label}:', 22, ' ') || 'out/{key}'" for label, key in OUTPUT_LABELS], "repeat('=', 40)", "''")} AS report FROM c""")
def r12(spark, d):
    rows = as_conversations(spark, d)
    kept, removed = dedup.deduplicate(rows)
    return one_text(spark, reports.pipeline_console(dedup.manifest(rows.count(), removed.count(), "v1"), {key: f"out/{key}" for _, key in OUTPUT_LABELS}, None))


# --- catalog, configuration and failures ---

CATALOG = {"datasets": [{"key": "a", "name": "A", "source": "huggingface", "dataset_id": "x/grouped"}, {"key": "b", "name": "B", "source": "local", "local_path": "/data/b", "dataset_id": "y/pairs"}]}


@query("s02_catalog", "SELECT * FROM (VALUES ('a', 'A', 'huggingface', 'x/grouped'), ('b', 'B', 'local', 'y/pairs'), ('c', NULL, NULL, NULL)) v(\"key\", name, source, dataset_id)")
def s02(spark, d):
    catalog = Catalog.from_dict(CATALOG)
    rows = [(k, *((e.name, e.source, e.dataset_id) if (e := catalog.get(k)) else (None, None, None))) for k in "abc"]
    return spark.createDataFrame(rows, "key string, name string, source string, dataset_id string")


@query("s03_entry_checks", "SELECT * FROM (VALUES ('hub', false), ('local', false), ('hub without id', true), ('local without path', true), ('unknown source', true), ('key twice', true), ('no datasets', true), ('datasets no list', true)) v(\"case\", raised)")
def s03(spark, d):
    entry = lambda **how: lambda: DatasetEntry("k", "n", **how)
    cases = {
        "hub": entry(source="huggingface", dataset_id="x"), "local": entry(source="local", local_path="/x"), "hub without id": entry(source="huggingface"), "local without path": entry(source="local"), "unknown source": entry(source="ftp", local_path="/x"),
        "key twice": lambda: Catalog([DatasetEntry("k", "n", "local", local_path="/x")] * 2), "no datasets": lambda: Catalog.from_dict({}), "datasets no list": lambda: Catalog.from_dict({"datasets": "x"}),
    }
    return spark.createDataFrame([(k, raised(f)) for k, f in cases.items()], "case string, raised boolean")


def config(**changes) -> dict:
    base = {"datasets": ["x/grouped", "y/pairs"], "split": "train", "validation": {}, "sampling": {"sample_size": 5, "seed": 42}, "outputs": {k: f"out/{k}" for k in pipeline.OUTPUTS}, "dataset_version": "v1"}
    return {k: v for k, v in (base | changes).items() if v is not None}


CASES = {
    "complete": config(), "with curation": config(curation={"split_ratio": 0.9, "source_caps": {"x": 3, "y": None}}), "no datasets": config(datasets=[]), "datasets no list": config(datasets="x"), "no split": config(split=None), "blank version": config(dataset_version=" "),
    "seed no number": config(sampling={"sample_size": 5, "seed": "x"}), "an output missing": config(outputs={"manifest_json": "x"}), "ratio of one": config(curation={"split_ratio": 1.0}), "cap of zero": config(curation={"source_caps": {"x": 0}}),
}


@query("o01_pipeline_config", "SELECT * FROM (VALUES ('complete', false), ('with curation', false), ('no datasets', true), ('datasets no list', true), ('no split', true), ('blank version', true), ('seed no number', true), ('an output missing', true), ('ratio of one', true), ('cap of zero', true)) v(\"case\", raised)")
def o01(spark, d):
    return spark.createDataFrame([(k, raised(lambda c=c: pipeline.check_pipeline_config(c), ConfigError)) for k, c in CASES.items()], "case string, raised boolean")


@query("o02_audit_config", "SELECT * FROM (VALUES ('complete', false), ('no version', false), ('no datasets', false), ('no split', true), ('no outputs', true), ('no mapping', true)) v(\"case\", raised)")
def o02(spark, d):
    cases = {"complete": config(), "no version": config(dataset_version=None), "no datasets": config(datasets=[]), "no split": config(split=None), "no outputs": config(outputs=None), "no mapping": []}
    return spark.createDataFrame([(k, raised(lambda c=c: pipeline.check_audit_config(c), ConfigError)) for k, c in cases.items()], "case string, raised boolean")


DRY_RUN = ["''", "repeat('=', 60)", "'PIPELINE DRY-RUN EXECUTION PLAN (VALID)'", "repeat('-', 60)", "'Target Split: train'", "'Datasets to process:'", "'  - x/grouped (parse_grouped -> normalize_alternating)'", "'  - y/pairs (parse_pairs -> normalize_pairs)'", "''", "'Validation settings:'", "'  - Purely structural validation enabled'", "''", "'Sampling parameters:'", "'  - sample_size: 5 conversations'", "'  - seed: 42'", "''", "'Configured outputs:'", *[f"'  - {k}: out/{k}'" for k in pipeline.OUTPUTS], "''", "'Curation settings:'"]


@query("o03_dry_run", f"SELECT {text_sql(*DRY_RUN, *[repr(x) for x in ('  - system_prompt_file: (none)', '  - split_ratio: 0.9', '  - min_assistant_chars: 40', '  - echo_similarity_threshold: 0.8', '  - source caps:', '      x/grouped: 3', '      y/pairs: uncapped')], "repeat('=', 60)", "''")} AS report")
def o03(spark, d):
    return one_text(spark, pipeline.dry_run(config(curation={"split_ratio": 0.9, "source_caps": {"x/grouped": 3}}), Catalog.from_dict(CATALOG)))


@query("o04_curator", "SELECT * FROM (VALUES ('default', true, 40, 0.5::DOUBLE, 0.8::DOUBLE, 2, 42, 0.95::DOUBLE, 0), ('changed', false, 10, 0.25::DOUBLE, 0.9::DOUBLE, 3, 7, 0.9::DOUBLE, 1)) v(\"case\", strip_urls, min_chars, max_short_ratio, echo_threshold, min_messages, seed, split_ratio, caps)")
def o04(spark, d):
    changed = {"cleaning": {"strip_urls": False}, "quality": {"min_assistant_chars": 10, "max_short_assistant_ratio": 0.25, "echo_similarity_threshold": 0.9, "min_messages": 3}, "seed": 7, "split_ratio": 0.9, "source_caps": {"x": 3}}
    made = {"default": pipeline.build_curator(config()), "changed": pipeline.build_curator(config(curation=changed))}
    assert pipeline.build_curator(config(curation={"enabled": False})) is None
    return spark.createDataFrame([(k, c.strip_urls, c.min_chars, c.max_short_ratio, c.echo_threshold, c.min_messages, c.seed, c.split_ratio, len(c.caps)) for k, c in made.items()], "case string, strip_urls boolean, min_chars int, max_short_ratio double, echo_threshold double, min_messages int, seed int, split_ratio double, caps int")


@query("o09_failures", "SELECT * FROM (VALUES ('merge nothing', 'MergeError'), ('merge one id twice', 'MergeError'), ('unknown dataset', 'ConfigError'), ('strict quarantine', 'ParseError')) v(\"case\", error)")
def o09(spark, d):
    one = plain(spark, d)
    bad = one.withColumn("quarantine_reason", F.when(F.col("ord") % 2 == 1, F.lit("blank id")))
    cases = {"merge nothing": lambda: merge.merge([]), "merge one id twice": lambda: merge.merge([one, one]), "unknown dataset": lambda: pipeline.resolve(config(datasets=["z/none"]), Catalog.from_dict(CATALOG)), "strict quarantine": lambda: normalize.split_quarantine(bad, strict=True)}
    rows = []
    for k, call in cases.items():
        try:
            call()
        except (MergeError, ConfigError, ParseError) as e:
            rows.append((k, type(e).__name__))
    return spark.createDataFrame(rows, "case string, error string")
