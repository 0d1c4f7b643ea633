"""Queries over the tables, one or more for each operator, each over its whole table, and the SQL that gives the same rows.

The tables hold clean text and regular conversations, so queries disturb them first, by rules on keys that the
SQL repeats: placeholders, lost blanks, links and entities by ``conv_id % 4``, roles from ``turn``, and so on.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions.udfs import unescape_entities
from ..operators import curate, dedup, inspect, merge, normalize, parse, sample, stats, tokens, validate
from ..schemas import METADATA
from ..sources import sinks
from .pipeline import Curator

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


#: Canonical conversations know two roles, so queries let the user speak what the tables call system turns.
TALK = "(SELECT conv_id, turn, CASE role WHEN 'system' THEN 'user' ELSE role END AS role, text FROM conversations)"


def expanded(sql: str) -> str:
    return sql.replace("FROM talk", f"FROM {TALK}")


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql is not None:
            ORACLES[name] = expanded(sql)
        return f

    return add


def read(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def talk(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "conversations").withColumn("role", F.when(F.col("role") == "system", F.lit("user")).otherwise(F.col("role")))


def grouped(rows: DataFrame, text: Column, role: Column | None = None, then: tuple[str, ...] = ()) -> DataFrame:
    """Canonical conversations of (conv_id, turn, role, text) rows, in the order of the turn, ``then`` of these columns."""
    turn = F.struct("turn", *then, (F.col("role") if role is None else role).alias("role"), text.alias("content"))
    c = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("t"))
    messages = F.transform("t", lambda m: F.struct(m["role"].alias("role"), m["content"].alias("content")))
    source = F.concat(F.lit("s"), (F.col("conv_id") % 3).cast("string"))
    meta = F.struct(F.lit("train").alias("split"), source.alias("source_dataset"), F.col("conv_id").cast("string").alias("original_id"), F.when(F.col("conv_id") % 5 > 0, F.concat(F.lit("c"), (F.col("conv_id") % 5).cast("string"))).alias("context")).cast(METADATA)
    return c.select(F.col("conv_id").alias("ord"), F.concat(F.lit("conv_"), F.col("conv_id").cast("string")).alias("id"), source.alias("source"), meta.alias("metadata"), messages.alias("messages"))


def plain(spark: SparkSession, d: str) -> DataFrame:
    return grouped(talk(spark, d), F.col("text"))


PLAIN = """conv AS (SELECT conv_id AS ord, 'conv_' || conv_id AS id, 's' || (conv_id % 3) AS source,
  {'split': 'train', 'source_dataset': 's' || (conv_id % 3), 'original_id': CAST(conv_id AS VARCHAR), 'context': CASE WHEN conv_id % 5 > 0 THEN 'c' || (conv_id % 5) END} AS metadata,
  list({'role': role, 'content': text} ORDER BY turn) AS messages FROM talk GROUP BY conv_id)"""


def dirty(text: Column, key: Column) -> Column:
    k = key % 4
    return (
        F.when(k == 0, F.replace(F.replace(text, F.lit(", "), F.lit("_comma_ ")), F.lit("\n"), F.lit("\n\n\n\n")))
        .when(k == 1, F.replace(text, F.lit(". "), F.lit(".")))
        .when(k == 2, F.concat(F.lit("  "), text, F.lit(" see https://example.org/a?b=1 or www.example.org  now")))
        .otherwise(F.concat(F.replace(text, F.lit(" "), F.lit(" \t ")), F.lit(" &amp; &lt;b&gt; _quote_")))
    )


DIRTY = """CASE conv_id % 4 WHEN 0 THEN replace(replace(text, ', ', '_comma_ '), chr(10), chr(10)||chr(10)||chr(10)||chr(10)) WHEN 1 THEN replace(text, '. ', '.')
  WHEN 2 THEN '  ' || text || ' see https://example.org/a?b=1 or www.example.org  now' ELSE replace(text, ' ', ' '||chr(9)||' ') || ' &amp; &lt;b&gt; _quote_' END"""


def dirty_rows(spark: SparkSession, d: str) -> DataFrame:
    return talk(spark, d).select("conv_id", "turn", "role", dirty(F.col("text"), F.col("conv_id")).alias("content"))


DIRTY_ROWS = f"d AS (SELECT conv_id, turn, role, {DIRTY} AS content FROM talk)"
PLACED = "replace(replace(replace(content, '_comma_', ','), '_period_', '.'), '_quote_', '\"')"
UNESCAPED = f"replace(replace(replace({PLACED}, '&lt;', '<'), '&gt;', '>'), '&amp;', '&')"
SPACED = rf"regexp_replace({UNESCAPED}, '([a-z])([.!?])([A-Z])', '\1\2 \3', 'g')"
UNLINKED = rf"regexp_replace({SPACED}, 'https?://[^\s]+|www\.[^\s]+', '', 'g')"
CLEAN = rf"trim(regexp_replace(regexp_replace({UNLINKED}, '[ \t\r\f\v]{{2,}}', ' ', 'g'), '\n{{3,}}', chr(10)||chr(10), 'g'), ' '||chr(9)||chr(10)||chr(13))"


# --- cleaning ---


@query("c01_placeholder", f"WITH {DIRTY_ROWS} SELECT conv_id, turn, {PLACED} AS placed, CAST((length(content) - length(replace(content, '_comma_', ''))) / 7 AS BIGINT) AS n_comma, CAST((length(content) - length(replace(content, '_quote_', ''))) / 7 AS BIGINT) AS n_quote FROM d")
def c01(spark, d):
    n = X.placeholder_counts(F.col("content"))
    return dirty_rows(spark, d).select("conv_id", "turn", X.replace_placeholders(F.col("content")).alias("placed"), n["comma"].alias("n_comma"), n["quote"].alias("n_quote"))


MARKED = "replace(replace(replace(html, '&amp;', chr(1)), '&quot;', '\"'), '&copy;', '©')"


@query("c02_unescape", f"SELECT page_id, replace(replace(replace({MARKED}, '&middot;', '·'), '&amp', '&'), chr(1), '&') AS plain FROM pages")
def c02(spark, d):
    return read(spark, d, "pages").select("page_id", unescape_entities(F.col("html")).alias("plain"))


@query("c03_missing_space", rf"WITH {DIRTY_ROWS} SELECT conv_id, turn, regexp_replace(content, '([a-z])([.!?])([A-Z])', '\1\2 \3', 'g') AS spaced, CAST(len(regexp_extract_all(content, '[a-z][.!?][A-Z]')) AS BIGINT) AS n FROM d")
def c03(spark, d):
    return dirty_rows(spark, d).select("conv_id", "turn", X.space_after_sentence(F.col("content")).alias("spaced"), X.missing_spaces(F.col("content")).alias("n"))


@query("c04_url", rf"WITH {DIRTY_ROWS} SELECT conv_id, turn, regexp_replace(content, 'https?://[^\s]+|www\.[^\s]+', '', 'g') AS unlinked, CAST(len(regexp_extract_all(content, 'https?://[^\s]+|www\.[^\s]+')) AS BIGINT) AS n FROM d")
def c04(spark, d):
    return dirty_rows(spark, d).select("conv_id", "turn", X.strip_urls(F.col("content")).alias("unlinked"), X.url_count(F.col("content")).alias("n"))


@query("c05_whitespace", rf"WITH {DIRTY_ROWS} SELECT conv_id, turn, regexp_replace(content, '[ \t\r\f\v]{{2,}}', ' ', 'g') AS one_blank, regexp_replace(content, '\n{{3,}}', chr(10)||chr(10), 'g') AS two_lines, trim(content, ' '||chr(9)||chr(10)||chr(13)) AS stripped FROM d")
def c05(spark, d):
    c = F.col("content")
    return dirty_rows(spark, d).select("conv_id", "turn", X.collapse_horizontal(c).alias("one_blank"), X.collapse_newlines(c).alias("two_lines"), X.py_strip(c).alias("stripped"))


@query("c08_clean", f"WITH {DIRTY_ROWS} SELECT conv_id, turn, {CLEAN} AS cleaned, {CLEAN} <> content AS changed FROM d")
def c08(spark, d):
    return curate.cleaned_columns(dirty_rows(spark, d)).select("conv_id", "turn", "cleaned", "changed")


def dirty_conversations(spark: SparkSession, d: str) -> DataFrame:
    return grouped(talk(spark, d), dirty(F.col("text"), F.col("conv_id")))


@query("c09_clean_conversation", f"WITH {DIRTY_ROWS} SELECT conv_id AS ord, string_agg({CLEAN}, '~' ORDER BY turn) AS joined FROM d WHERE {CLEAN} <> '' GROUP BY 1")
def c09(spark, d):
    return curate.clean_conversations(dirty_conversations(spark, d)).select("ord", F.concat_ws("~", F.transform("messages", lambda m: m["content"])).alias("joined"))


@query("a08_clean_counts", rf"""WITH {DIRTY_ROWS} SELECT count(*) AS messages_seen, count(*) FILTER (WHERE {CLEAN} <> content) AS messages_changed,
  CAST(sum((length(content) - length(replace(content, '_comma_', ''))) / 7) AS BIGINT) AS comma, CAST(0 AS BIGINT) AS period, CAST(sum((length(content) - length(replace(content, '_quote_', ''))) / 7) AS BIGINT) AS quote,
  count(*) FILTER (WHERE {UNESCAPED} <> {PLACED}) AS html_entity, CAST(sum(len(regexp_extract_all({UNESCAPED}, '[a-z][.!?][A-Z]'))) AS BIGINT) AS missing_space, CAST(sum(len(regexp_extract_all({SPACED}, 'https?://[^\s]+|www\.[^\s]+'))) AS BIGINT) AS url FROM d""")
def a08(spark, d):
    return curate.clean_counts(curate.clean_messages(dirty_conversations(spark, d)))


# --- turns and quality ---

RUNS = "CASE WHEN (turn + 2 * (conv_id % 2)) % 5 < 2 THEN 'user' ELSE 'assistant' END"


def in_runs(spark: SparkSession, d: str) -> DataFrame:
    """Roles from the turn, so runs of one role occur; odd conversations start with the assistant."""
    rows = read(spark, d, "conversations")
    return grouped(rows, F.col("text"), F.when((F.col("turn") + 2 * (F.col("conv_id") % 2)) % 5 < 2, F.lit("user")).otherwise(F.lit("assistant")))


RUN_ROWS = f"""r AS (SELECT conv_id, turn, {RUNS} AS role, text FROM conversations),
  s AS (SELECT *, CASE WHEN role IS DISTINCT FROM lag(role) OVER (PARTITION BY conv_id ORDER BY turn) THEN 1 ELSE 0 END AS new FROM r),
  g AS (SELECT *, sum(new) OVER (PARTITION BY conv_id ORDER BY turn) AS run FROM s),
  m AS (SELECT conv_id, run, any_value(role) AS role, string_agg(text, chr(10)||chr(10) ORDER BY turn) AS content FROM g GROUP BY 1, 2)"""
RUN_LEAD = RUN_ROWS + ", l AS (SELECT * FROM m WHERE NOT (run = 1 AND role = 'assistant'))"
JOINED = "string_agg(role || ':' || content, '~' ORDER BY run) AS joined"


def joined(c: Column) -> Column:
    return F.concat_ws("~", F.transform(c, lambda m: F.concat(m["role"], F.lit(":"), m["content"]))).alias("joined")


@query("w01_merge_runs", f"WITH {RUN_ROWS} SELECT conv_id AS ord, {JOINED} FROM m GROUP BY 1")
def w01(spark, d):
    return in_runs(spark, d).select("ord", joined(curate.merge_runs(F.col("messages"))))


@query("w02_leading", f"WITH {RUN_LEAD} SELECT conv_id AS ord, coalesce(string_agg(role || ':' || content, '~' ORDER BY run) FILTER (WHERE NOT (run = 1 AND role = 'assistant')), '') AS joined FROM m GROUP BY 1")
def w02(spark, d):
    return in_runs(spark, d).select("ord", joined(curate.drop_leading_assistant(curate.merge_runs(F.col("messages")))))


TRIM = "t AS (SELECT l.*, max(CASE WHEN role = 'assistant' AND length(content) >= 700 THEN run END) OVER (PARTITION BY conv_id) AS cut FROM l)"


@query("w03_trim", f"WITH {RUN_LEAD}, {TRIM} SELECT m.conv_id AS ord, coalesce((SELECT string_agg(role || ':' || content, '~' ORDER BY run) FROM t WHERE t.conv_id = m.conv_id AND run <= cut), '') AS joined FROM (SELECT DISTINCT conv_id FROM m) m")
def w03(spark, d):
    return curate.shape_turns(in_runs(spark, d), min_chars=700).select("ord", joined(F.col("messages")))


REASONS = """q AS (SELECT ord, CASE WHEN len(messages) < 3 THEN 'too_few_messages' WHEN len(list_filter(messages, lambda m: m.role = 'assistant')) = 0 THEN 'no_assistant_turn'
  WHEN length(list_filter(messages, lambda m: m.role = 'assistant')[-1].content) < 300 THEN 'final_response_too_short'
  WHEN len(list_filter(messages, lambda m: m.role = 'assistant' AND length(m.content) < 300)) / len(list_filter(messages, lambda m: m.role = 'assistant')) > 0.3 THEN 'mostly_short_responses' END AS reason FROM conv)"""


@query("q07_quality_reason", f"WITH {PLAIN}, {REASONS} SELECT ord, coalesce(reason, 'kept') AS reason FROM q")
def q07(spark, d):
    return plain(spark, d).select("ord", F.coalesce(curate.cheap_reason(F.col("messages"), 3, 300, 0.3), F.lit("kept")).alias("reason"))


@query("a09_quality_counts", f"WITH {PLAIN}, {REASONS} SELECT coalesce(reason, 'kept') AS reason, count(*) AS n FROM q GROUP BY 1")
def a09(spark, d):
    marked = plain(spark, d).withColumn("reason", curate.cheap_reason(F.col("messages"), 3, 300, 0.3))
    return curate.quality_counts(marked).select(F.coalesce("reason", F.lit("kept")).alias("reason"), "n")


#: Letters whose upper case is more than one letter ("ß": "SS"), and stand-ins without a case.
LONGER = "".join(c for c in map(chr, range(0x80, 0xD800)) if len(c.upper()) > 1) + "".join(c for c in map(chr, range(0xF900, 0x10000)) if len(c.upper()) > 1)
STAND_INS = "".join(chr(0xE000 + k) for k in range(len(LONGER)))


def upper_each(c: Column) -> Column:
    """Upper case letter by letter, as the SQL has it: what has no single upper-case letter stays."""
    return F.translate(F.upper(F.translate(c, LONGER, STAND_INS)), STAND_INS, LONGER)


def echoing(spark: SparkSession, d: str) -> DataFrame:
    """Every third conversation's assistant repeats the user, upper-cased, with a mark at the end."""
    c = plain(spark, d)
    said = F.transform("messages", lambda m, i: F.struct(m["role"].alias("role"), F.when((F.col("ord") % 3 == 0) & (m["role"] == "assistant") & (i > 0), F.concat(upper_each(F.get(F.col("messages"), i - 1)["content"]), F.lit("!"))).otherwise(m["content"]).alias("content")))
    return c.withColumn("messages", said)


@query("q05_echo")
def q05(spark, d):
    return curate.quality_reasons(echoing(spark, d)).select("ord", F.coalesce("reason", F.lit("kept")).alias("reason"))


@query("q06_echo_normal", "SELECT conv_id, turn, trim(regexp_replace(lower(text), '[^a-z0-9 ]+', '', 'g')) AS normal FROM conversations")
def q06(spark, d):
    return read(spark, d, "conversations").select("conv_id", "turn", X.normalise_for_echo(F.col("text")).alias("normal"))


ASSISTANT = "list_sum(list_transform(list_filter(messages, lambda m: m.role = 'assistant'), lambda m: length(m.content)))"


@query("w05_source_cap", f"WITH {PLAIN}, x AS (SELECT *, coalesce({ASSISTANT}, 0) AS chars FROM conv), y AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY chars DESC, id DESC) AS rn FROM x) SELECT id, source FROM y WHERE source = 's2' OR rn <= CASE source WHEN 's0' THEN 10 ELSE 20 END")
def w05(spark, d):
    return curate.cap_sources(plain(spark, d), {"s0": 10, "s1": 20, "s2": None}).select("id", "source")


@query("w06_shuffle")
def w06(spark, d):
    return sample.shuffled(plain(spark, d), 42, 2).select("ord", "place")


@query("w08_split", f"WITH {PLAIN}, n AS (SELECT count(*) AS n FROM conv) SELECT CAST(floor(n * 0.95) AS BIGINT) AS train, CAST(n - floor(n * 0.95) AS BIGINT) AS validation FROM n")
def w08(spark, d):
    train, validation = sample.split_by_ratio(sample.shuffled(plain(spark, d), 42), 0.95)
    return train.agg(F.count(F.lit(1)).alias("train")).join(validation.agg(F.count(F.lit(1)).alias("validation")))


@query("w09_sample")
def w09(spark, d):
    return sample.review_sample(plain(spark, d), 30, 42).select("ord", "id")


# --- parsing and normalising ---


def utterances(spark: SparkSession, d: str) -> DataFrame:
    c, t = F.col("conv_id"), F.col("turn")
    return read(spark, d, "conversations").select(
        F.when(c % 13 == 5, F.lit(" ")).otherwise(c.cast("string")).alias("conv_id"), F.when(c % 5 == 0, (t / 2).cast("long")).otherwise(t).alias("utterance_idx"), F.lit("ctx").alias("context"), F.when(~((c % 11 == 1) & (t == 0)), (t % 2).cast("string")).alias("speaker_idx"),
        F.when((c % 7 == 0) & (t == 1), F.lit("")).otherwise(F.col("text")).alias("utterance"), (c * 1000 + t).alias("row_idx"),
    )


UTTERANCES = """u AS (SELECT conv_id, turn, CASE WHEN conv_id % 5 = 0 THEN turn // 2 ELSE turn END AS idx, CASE WHEN NOT (conv_id % 11 = 1 AND turn = 0) THEN turn % 2 END AS speaker,
  CASE WHEN conv_id % 7 = 0 AND turn = 1 THEN '' ELSE text END AS text FROM conversations WHERE conv_id % 13 <> 5),
  v AS (SELECT *, lag(idx) OVER (PARTITION BY conv_id ORDER BY turn) AS before FROM u),
  w AS (SELECT conv_id, turn, CASE WHEN before = idx THEN 'non-increasing utterance_idx at ' || idx WHEN speaker IS NULL THEN 'missing speaker_idx' WHEN text = '' THEN 'empty utterance at ' || idx END AS reason FROM v),
  x AS (SELECT conv_id, arg_min(reason, turn) FILTER (WHERE reason IS NOT NULL) AS reason, count(*) AS n FROM w GROUP BY 1)"""


@query("p03_grouped", f"WITH {UTTERANCES} SELECT CAST(conv_id AS VARCHAR) AS id, conv_id * 1000 AS ord, n AS turns FROM x WHERE reason IS NULL")
def p03(spark, d):
    p = parse.accepted(parse.parse_grouped(utterances(spark, d), "grouped", "train"))
    return p.select("id", "ord", F.size("messages").cast("long").alias("turns"))


@query("p05_rejects", f"WITH {UTTERANCES} SELECT CAST(conv_id AS VARCHAR) AS id, reason FROM x WHERE reason IS NOT NULL")
def p05(spark, d):
    return parse.rejects(parse.parse_grouped(utterances(spark, d), "grouped", "train")).select("id", F.col("reject_reason").alias("reason"))


@query("p02_missing_key", "SELECT conv_id * 1000 + turn AS row_idx, 'missing conv_id' AS reject_reason FROM conversations WHERE conv_id % 13 = 5")
def p02(spark, d):
    return parse.rows_without_key(utterances(spark, d))


@query("p11_parse_report", f"WITH {UTTERANCES} SELECT count(*) FILTER (WHERE reason IS NULL) AS num_conversations, count(*) FILTER (WHERE reason IS NOT NULL) AS skipped_conversations, coalesce(avg(n) FILTER (WHERE reason IS NULL), 0) AS avg_turns, coalesce(max(n) FILTER (WHERE reason IS NULL), 0) AS max_turns, coalesce(min(n) FILTER (WHERE reason IS NULL), 0) AS min_turns FROM x")
def p11(spark, d):
    return parse.parse_stats(parse.parse_grouped(utterances(spark, d), "grouped", "train"))


def dialogs(spark: SparkSession, d: str) -> DataFrame:
    turn = F.struct("turn", F.when((F.col("conv_id") % 7 == 1) & (F.col("turn") == 1), F.lit("")).otherwise(F.col("text")).alias("text"), F.when(F.col("turn") % 2 == 0, F.lit("usr")).otherwise(F.lit("sys")).alias("speaker"))
    c = read(spark, d, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("t"))
    dialog = F.transform("t", lambda m: F.struct(m["text"].alias("text"), m["speaker"].alias("speaker")))
    whole = F.to_json(F.struct(F.concat(F.lit("e"), (F.col("conv_id") % 4).cast("string")).alias("emotion_type"), dialog.alias("dialog")))
    text = F.when(F.col("conv_id") % 6 == 2, F.lit('{"dialog": [')).when(F.col("conv_id") % 6 == 3, F.lit('{"dialog": 7}')).when(F.col("conv_id") % 6 == 4, F.lit("[1]")).otherwise(whole)
    return c.select(F.col("conv_id").alias("row_idx"), text.alias("text"))


DIALOGS = "CASE conv_id % 6 WHEN 2 THEN 'invalid json' WHEN 3 THEN 'missing dialog' WHEN 4 THEN 'not an object' ELSE CASE WHEN conv_id % 7 = 1 AND count(*) > 1 THEN 'empty text' END END"


@query("p07_json_dialog", f"SELECT 'dialog_train_' || conv_id AS id, coalesce({DIALOGS}, 'ok') AS reason, CASE WHEN {DIALOGS} IS NULL THEN count(*) END AS turns, CASE WHEN conv_id % 6 NOT IN (2, 3, 4) THEN 'e' || (conv_id % 4) END AS context FROM conversations GROUP BY conv_id")
def p07(spark, d):
    p = parse.parse_json_dialog(dialogs(spark, d), "json_dialog", "train")
    return p.select("id", F.coalesce("reject_reason", F.lit("ok")).alias("reason"), F.when(F.col("reject_reason").isNull(), F.size("messages").cast("long")).alias("turns"), "context")


PAIRS = "p AS (SELECT a.conv_id * 1000 + a.turn AS row_idx, CASE WHEN a.conv_id % 4 = 1 THEN '  ' ELSE a.text END AS context, CASE WHEN a.conv_id % 9 = 2 THEN '' ELSE b.text END AS response FROM conversations a JOIN conversations b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1 AND a.role = 'user' AND b.role = 'assistant')"


def pairs(spark: SparkSession, d: str) -> DataFrame:
    c = read(spark, d, "conversations")
    b = c.where("role = 'assistant'").select(F.col("conv_id").alias("bc"), (F.col("turn") - 1).alias("bt"), F.col("text").alias("answer"))
    j = c.where("role = 'user'").join(b, (F.col("conv_id") == F.col("bc")) & (F.col("turn") == F.col("bt")))
    return j.select((F.col("conv_id") * 1000 + F.col("turn")).alias("row_idx"), F.when(F.col("conv_id") % 4 == 1, F.lit("  ")).otherwise(F.col("text")).alias("Context"), F.when(F.col("conv_id") % 9 == 2, F.lit("")).otherwise(F.col("answer")).alias("Response"))


@query("p09_pairs", f"WITH {PAIRS} SELECT 'pair_train_' || row_idx AS id, CASE WHEN trim(context) = '' THEN 'empty or missing Context' WHEN trim(response) = '' THEN 'empty or missing Response' ELSE 'ok' END AS reason, length(context) + length(response) AS chars FROM p")
def p09(spark, d):
    p = parse.parse_pairs(pairs(spark, d), "pairs", "train")
    return p.select("id", F.coalesce("reject_reason", F.lit("ok")).alias("reason"), F.aggregate("messages", F.lit(0).cast("long"), lambda a, m: a + F.length(m["content"])).alias("chars"))


SPEAKERS = "z AS (SELECT conv_id, turn, CAST(turn // 2 AS VARCHAR) AS speaker, text FROM conversations), y AS (SELECT *, CASE WHEN speaker IS DISTINCT FROM lag(speaker) OVER (PARTITION BY conv_id ORDER BY turn) THEN 1 ELSE 0 END AS new FROM z), k AS (SELECT *, sum(new) OVER (PARTITION BY conv_id ORDER BY turn) AS run FROM y)"


@query("n01_alternating_roles", f"WITH {SPEAKERS} SELECT CAST(conv_id AS VARCHAR) AS id, string_agg(CASE WHEN run % 2 = 1 THEN 'user' ELSE 'assistant' END, ',' ORDER BY turn) AS roles FROM k GROUP BY 1")
def n01(spark, d):
    rows = read(spark, d, "conversations").select(F.col("conv_id").cast("string").alias("conv_id"), F.col("turn").alias("utterance_idx"), (F.col("turn") / 2).cast("long").cast("string").alias("speaker_idx"), F.col("text").alias("utterance"), (F.col("conv_id") * 1000 + F.col("turn")).alias("row_idx"))
    ok, _ = normalize.split_quarantine(normalize.normalize_alternating(parse.accepted(parse.parse_grouped(rows, "grouped", "train"))))
    return ok.select("id", F.concat_ws(",", F.transform("messages", lambda m: m["role"])).alias("roles"))


@query("n02_fixed_roles", f"SELECT 'dialog_train_' || conv_id AS id, string_agg(CASE WHEN turn % 2 = 0 THEN 'user' ELSE 'assistant' END, ',' ORDER BY turn) AS roles, 'e' || (conv_id % 4) AS context FROM conversations GROUP BY conv_id HAVING {DIALOGS} IS NULL")
def n02(spark, d):
    ok, _ = normalize.split_quarantine(normalize.normalize_dialog(parse.accepted(parse.parse_json_dialog(dialogs(spark, d), "json_dialog", "train"))))
    return ok.select("id", F.concat_ws(",", F.transform("messages", lambda m: m["role"])).alias("roles"), F.col("metadata.context").alias("context"))


@query("n05_quarantine", "SELECT conv_id, CASE WHEN count(*) FILTER (WHERE conv_id % 3 = 0 AND turn = 1) > 0 THEN 'blank content' ELSE 'ok' END AS reason FROM conversations GROUP BY 1")
def n05(spark, d):
    t = F.when((F.col("conv_id") % 3 == 0) & (F.col("turn") == 1), F.lit("  \t")).otherwise(F.col("text"))
    rows = read(spark, d, "conversations").select(F.col("conv_id").cast("string").alias("conv_id"), F.col("turn").alias("utterance_idx"), (F.col("turn") % 2).cast("string").alias("speaker_idx"), t.alias("utterance"), (F.col("conv_id") * 1000 + F.col("turn")).alias("row_idx"))
    n = normalize.normalize_alternating(parse.accepted(parse.parse_grouped(rows, "grouped", "train")))
    return n.select(F.col("id").cast("long").alias("conv_id"), F.coalesce("quarantine_reason", F.lit("ok")).alias("reason"))


# --- validation, merging, dedup ---


def faulty(spark: SparkSession, d: str) -> DataFrame:
    """Raw roles (system among them), some ids blank, some texts blank; of every sixth conversation each turn is one of its own.

    Such a turn may get the number of another conversation; of two with the same turn, the one of the lower original number comes first.
    """
    rows = read(spark, d, "conversations").withColumn("of", F.col("conv_id")).withColumn("conv_id", F.when(F.col("conv_id") % 6 == 1, F.col("conv_id") * 1000 + F.col("turn")).otherwise(F.col("conv_id")))
    c = grouped(rows, F.when((F.col("conv_id") % 4 == 2) & (F.col("turn") == 1), F.lit(" \n")).otherwise(F.col("text")), then=("of",))
    return c.withColumn("id", F.when(F.col("ord") % 10 == 3, F.lit(" ")).otherwise(F.col("id")))


FAULTY = """r0 AS (SELECT CASE WHEN conv_id % 6 = 1 THEN conv_id * 1000 + turn ELSE conv_id END AS conv_id, turn, role, text FROM conversations),
  f AS (SELECT conv_id, turn, role, CASE WHEN conv_id % 4 = 2 AND turn = 1 THEN ' ' ELSE text END AS text, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS i FROM r0),
  e AS (SELECT conv_id, 0 AS k, 0 AS j, 'Conversation ID is null, empty or missing.' AS error FROM (SELECT DISTINCT conv_id FROM f) WHERE conv_id % 10 = 3
    UNION ALL SELECT conv_id, 1, 0, 'Conversation has fewer than 2 messages (got ' || count(*) || ').' FROM f GROUP BY conv_id HAVING count(*) < 2
    UNION ALL SELECT conv_id, 2 + i, 0, 'Message at index ' || i || ' has invalid role: ''' || role || '''.' FROM f WHERE role NOT IN ('user', 'assistant')
    UNION ALL SELECT conv_id, 2 + i, 1, 'Message at index ' || i || ' has empty or null content.' FROM f WHERE trim(text) = ''),
  h AS (SELECT e.*, CASE WHEN error LIKE '%fewer than 2%' THEN 'Conversation has fewer than 2 messages' WHEN error LIKE '%invalid role%' THEN 'Message has invalid role' WHEN error LIKE '%empty or null content%' THEN 'Message has empty/null content' ELSE 'Conversation ID is null/missing' END AS category FROM e)"""


@query("v01_errors", f"WITH {FAULTY} SELECT c.conv_id AS ord, coalesce((SELECT string_agg(error, '|' ORDER BY k, j) FROM e WHERE e.conv_id = c.conv_id), '') AS errors FROM (SELECT DISTINCT conv_id FROM f) c")
def v01(spark, d):
    return validate.validated(faulty(spark, d)).select("ord", F.concat_ws("|", "errors").alias("errors"))


@query("v02_report_counts", f"WITH {FAULTY}, c AS (SELECT DISTINCT conv_id FROM f) SELECT count(*) AS num_checked, count(*) FILTER (WHERE conv_id NOT IN (SELECT conv_id FROM e)) AS num_valid, count(*) FILTER (WHERE conv_id IN (SELECT conv_id FROM e)) AS num_invalid FROM c")
def v02(spark, d):
    return validate.validation_counts(validate.validated(faulty(spark, d)))


@query("v03_filter", f"WITH {FAULTY} SELECT DISTINCT conv_id AS ord FROM f WHERE conv_id NOT IN (SELECT conv_id FROM e) AND conv_id % 10 <> 3")
def v03(spark, d):
    checked = validate.validated(faulty(spark, d))
    kept, _ = validate.filter_by_report(checked.drop("errors"), validate.validation_report(checked))
    return kept.select("ord")


@query("v06_categories", f"WITH {FAULTY} SELECT category, count(*) AS n, count(*) * 100.0::DOUBLE / sum(count(*)) OVER () AS percent, min(conv_id) AS first_ord FROM h GROUP BY 1")
def v06(spark, d):
    return stats.error_breakdown(validate.validated(faulty(spark, d))).drop("first_pos")


@query("a13_error_examples", f"WITH {FAULTY}, x AS (SELECT category, CASE WHEN conv_id % 10 = 3 THEN ' ' ELSE 'conv_' || conv_id END AS id, min(conv_id) AS ord FROM h GROUP BY 1, 2), y AS (SELECT *, row_number() OVER (PARTITION BY category ORDER BY ord) AS rn FROM x) SELECT category, CAST(rn AS INTEGER) AS rn, ord, id FROM y WHERE rn <= 10")
def a13(spark, d):
    return stats.error_examples(validate.validated(faulty(spark, d))).select("category", "rn", "ord", "id")


def parts(spark: SparkSession, d: str) -> list[DataFrame]:
    return [plain(spark, d).where(F.col("ord") % 3 == k) for k in range(3)]


@query("m01_union", f"WITH {PLAIN} SELECT ord, id, source FROM conv")
def m01(spark, d):
    return merge.merge(parts(spark, d)).select("ord", "id", "source")


@query("m02_collisions", f"WITH {PLAIN}, x AS (SELECT 'k' || (ord // 2) AS id, ord, source FROM conv), y AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY ord) AS nth, count(*) OVER (PARTITION BY id) AS n FROM x) SELECT id, source, ord, n FROM y WHERE nth = 2")
def m02(spark, d):
    return merge.collisions(plain(spark, d).withColumn("id", F.concat(F.lit("k"), (F.col("ord") / 2).cast("long").cast("string")))).select("id", "source", "ord", "n")


@query("m03_contrib", f"WITH {PLAIN} SELECT source, count(*) AS n, min(ord) AS first_ord FROM conv GROUP BY 1")
def m03(spark, d):
    return merge.contributions(merge.merge(parts(spark, d), check=False))


NORMAL = r"trim(regexp_replace(lower(text), '\s+', ' ', 'g'))"


@query("d02_hash", f"""SELECT doc_id, sha256('[{{"content":' || to_json({NORMAL}) || ',"role":"user"}}]') AS hash FROM documents""")
def d02(spark, d):
    one = F.array(F.struct(F.lit("user").alias("role"), F.col("text").alias("content")))
    return read(spark, d, "documents").select("doc_id", X.conversation_hash(one).alias("hash"))


@query("d03_exact_dedup", f"WITH n AS (SELECT doc_id, source, {NORMAL} AS t FROM documents), k AS (SELECT t, min(doc_id) AS kept_id, arg_min(source, doc_id) AS kept_source FROM n GROUP BY 1) SELECT doc_id, kept_id, kept_source, doc_id = kept_id AS kept FROM n JOIN k USING (t)")
def d03(spark, d):
    one = F.array(F.struct(F.lit("user").alias("role"), F.col("text").alias("content")))
    marked = dedup.first_wins(read(spark, d, "documents").select("doc_id", "source", one.alias("messages")), X.conversation_hash(F.col("messages")), "doc_id", ("source",))
    return marked.select("doc_id", F.col("kept.doc_id").alias("kept_id"), F.col("kept.source").alias("kept_source"), (F.col("doc_id") == F.col("kept.doc_id")).alias("kept"))


@query("d04_manifest", f"WITH n AS (SELECT {NORMAL} AS t FROM documents) SELECT count(*) AS before, count(DISTINCT t) AS after, count(*) - count(DISTINCT t) AS removed FROM n")
def d04(spark, d):
    one = F.array(F.struct(F.lit("user").alias("role"), F.col("text").alias("content")))
    hashes = read(spark, d, "documents").select(X.conversation_hash(one).alias("h")).groupBy("h").agg(F.count(F.lit(1)).alias("n"))
    return hashes.agg(F.sum("n").alias("before"), F.count(F.lit(1)).alias("after"), F.sum(F.col("n") - 1).alias("removed"))


# --- statistics ---


@query("a01_per_source", f"WITH {PLAIN} SELECT source, count(*) AS n, min(ord) AS first_ord, count(*) * 100.0::DOUBLE / sum(count(*)) OVER () AS percent FROM conv GROUP BY 1")
def a01(spark, d):
    return stats.per_source(plain(spark, d))


@query("a03_turns", f"WITH {PLAIN} SELECT count(*) AS n, avg(len(messages)) AS avg_turns, median(len(messages)) AS median_turns, min(len(messages)) AS min_turns, max(len(messages)) AS max_turns FROM conv")
def a03(spark, d):
    return stats.turn_stats(plain(spark, d))


@query("a04_lengths", "SELECT avg(length(text)) FILTER (WHERE role = 'user') AS avg_user, avg(length(text)) FILTER (WHERE role = 'assistant') AS avg_assistant, max(length(text)) AS max_length FROM talk")
def a04(spark, d):
    return stats.length_stats(plain(spark, d))


@query("a05_context", f"WITH {PLAIN} SELECT coalesce(metadata.context, 'None') AS context, count(*) AS n, min(ord) AS first_ord FROM conv GROUP BY 1")
def a05(spark, d):
    return stats.context_distribution(plain(spark, d))


FUNNEL = f"WITH {FAULTY}, c AS (SELECT conv_id, 's' || (conv_id % 3) AS dataset FROM conversations), bad AS (SELECT DISTINCT conv_id FROM e), k AS (SELECT DISTINCT conv_id, 's' || (conv_id % 3) AS dataset FROM f), x AS (SELECT 'Loaded' AS stage, 0 AS s, dataset, count(*) AS n FROM c GROUP BY ALL UNION ALL SELECT 'Parsed', 1, dataset, count(*) FROM k GROUP BY ALL UNION ALL SELECT 'Filtered', 2, dataset, count(*) FROM k WHERE conv_id NOT IN (SELECT conv_id FROM bad) GROUP BY ALL), y AS (SELECT stage, s, dataset, n FROM x UNION ALL SELECT stage, s, 'Total', CAST(sum(n) AS BIGINT) FROM x GROUP BY stage, s)"


@query("a11_funnel", FUNNEL + " SELECT stage, dataset, n, CASE WHEN lag(n) OVER w > 0 THEN (lag(n) OVER w - n) / (lag(n) OVER w)::DOUBLE * 100.0 END AS loss_percent FROM y WINDOW w AS (PARTITION BY dataset ORDER BY s)")
def a11(spark, d):
    dataset = F.concat(F.lit("s"), (F.col("conv_id") % 3).cast("string")).alias("dataset")
    loaded = read(spark, d, "conversations").groupBy(dataset).agg(F.count(F.lit(1)).alias("n"))
    checked = validate.validated(faulty(spark, d))
    count = lambda df: df.groupBy(F.col("source").alias("dataset")).agg(F.count(F.lit(1)).alias("n"))
    at = lambda df, stage: df.select(F.lit(stage).alias("stage"), "dataset", "n")
    rows = at(loaded, "Loaded").unionByName(at(count(checked), "Parsed")).unionByName(at(count(checked.where(F.size("errors") == 0)), "Filtered"))
    return stats.stage_losses(rows).select("stage", "dataset", "n", "loss_percent")


COUNTED = "t AS (SELECT conv_id, sum(length(regexp_replace(role || ':' || text, '\\s', '', 'g'))) AS tokens, count(*) AS turns FROM talk GROUP BY 1)"


def counted(spark: SparkSession, d: str) -> DataFrame:
    return tokens.token_counts(plain(spark, d), tokens.plain_template)


@query("t02_tokens", f"WITH {COUNTED} SELECT conv_id AS ord, CAST(tokens AS BIGINT) AS tokens, turns FROM t")
def t02(spark, d):
    return counted(spark, d).select("ord", "tokens", "turns")


@query("t01_template", "SELECT conv_id AS ord, coalesce(string_agg('<start_of_turn>' || CASE role WHEN 'user' THEN 'user' ELSE 'model' END || chr(10) || trim(text, ' '||chr(9)||chr(10)||chr(13)) || '<end_of_turn>' || chr(10), '' ORDER BY turn) FILTER (WHERE role <> 'system'), '') AS rendered FROM conversations GROUP BY 1")
def t01(spark, d):
    return grouped(read(spark, d, "conversations"), F.col("text")).select("ord", tokens.turn_template(F.col("messages")).alias("rendered"))


@query("a14_token_stats", f"WITH {COUNTED} SELECT count(*) AS total_conversations, CAST(sum(tokens) AS BIGINT) AS total_tokens, avg(tokens) AS average_tokens, median(tokens) AS median_tokens, CAST(min(tokens) AS BIGINT) AS minimum_tokens, CAST(max(tokens) AS BIGINT) AS maximum_tokens, avg(turns) AS average_turns, count(*) FILTER (WHERE tokens > 1024) AS over_1024, count(*) FILTER (WHERE tokens > 2048) AS over_2048, count(*) FILTER (WHERE tokens > 4096) AS over_4096, count(*) FILTER (WHERE tokens > 8192) AS over_8192 FROM t")
def a14(spark, d):
    return tokens.token_stats(counted(spark, d))


@query("a15_percentiles", f"WITH {COUNTED} SELECT CAST(round_even(quantile_cont(tokens::DOUBLE, 0.95), 0) AS BIGINT) AS p95, CAST(round_even(quantile_cont(tokens::DOUBLE, 0.99), 0) AS BIGINT) AS p99 FROM t")
def a15(spark, d):
    p = lambda q: F.bround(F.percentile("tokens", F.lit(q)), 0).cast("long")
    return counted(spark, d).agg(p(0.95).alias("p95"), p(0.99).alias("p99"))


BIN_SQL = "(0, '0-128', 0, 128), (1, '129-256', 128, 256), (2, '257-512', 256, 512), (3, '513-1024', 512, 1024), (4, '1025-2048', 1024, 2048), (5, '2049-4096', 2048, 4096), (6, '4097-8192', 4096, 8192), (7, '8193+', 8192, 1e18)"


@query("a16_histogram", f"WITH {COUNTED}, b AS (SELECT * FROM (VALUES {BIN_SQL}) v(bin_idx, bin, low, high)) SELECT bin_idx, bin, (SELECT count(*) FROM t WHERE tokens > low AND tokens <= high) AS n FROM b")
def a16(spark, d):
    return tokens.histogram(counted(spark, d))


# --- inspection ---


@query("i03_conv_stats", "WITH t AS (SELECT conv_id, count(*) AS t FROM conversations GROUP BY 1) SELECT count(*) AS n, avg(t) AS avg, median(t) AS median, min(t) AS min, max(t) AS max FROM t")
def i03(spark, d):
    return inspect.conversation_stats(read(spark, d, "conversations"))[2]


@query("i04_message_stats", "WITH s AS (SELECT unnest([text, lang, source]) AS s FROM documents) SELECT count(s) AS n, avg(length(s)) AS avg, max(length(s)) AS max FROM s")
def i04(spark, d):
    return inspect.message_stats(read(spark, d, "documents"))[1]


def quality_sql(table: str, columns: list[str], texts: list[str]) -> str:
    stripped = "length(trim({c}, ' '||chr(9)||chr(10)||chr(13)))"
    checks = [("missing", c, f"{c} IS NULL") for c in columns]
    for c in texts:
        n = stripped.format(c=c)
        checks += [("empty", c, f"{n} = 0"), ("long", c, f"length({c}) > 5000"), ("short", c, f"{n} BETWEEN 1 AND 9")]
    return " UNION ALL ".join(f"SELECT '{check}' AS \"check\", '{c}' AS \"column\", count(*) FILTER (WHERE {when}) AS n FROM {table}" for check, c, when in checks)


@query("i05_nulls", "WITH e AS (SELECT event_id, ts, user_id, event_type, CASE WHEN event_id % 7 <> 0 THEN value END AS value, CASE WHEN event_id % 3 <> 0 THEN props END AS props FROM events) " + quality_sql("e", ["event_id", "ts", "user_id", "event_type", "value", "props"], ["event_type", "props"]))
def i05(spark, d):
    e = read(spark, d, "events").withColumn("props", F.when(F.col("event_id") % 3 != 0, F.col("props"))).withColumn("value", F.when(F.col("event_id") % 7 != 0, F.col("value")))
    return inspect.quality_counts(e)


@query("i07_extremes", "WITH d AS (SELECT doc_id, CASE WHEN doc_id % 9 = 0 THEN '  ' || chr(10) ELSE text END AS text, lang, CASE WHEN doc_id % 5 > 0 THEN source END AS source, n_chars FROM documents) " + quality_sql("d", ["doc_id", "text", "lang", "source", "n_chars"], ["text", "lang", "source"]))
def i07(spark, d):
    docs = read(spark, d, "documents").withColumn("text", F.when(F.col("doc_id") % 9 == 0, F.lit("  \n")).otherwise(F.col("text"))).withColumn("source", F.when(F.col("doc_id") % 5 > 0, F.col("source")))
    return inspect.quality_counts(docs)


@query("i08_dup_rows", "SELECT CAST(count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM lineitem)) AS BIGINT) AS n FROM lineitem")
def i08(spark, d):
    return inspect.duplicate_rows(read(spark, d, "lineitem"))


@query("i09_dup_ids", "SELECT unnest(['event_id','user_id']) AS \"column\", unnest([count(event_id) - count(DISTINCT event_id), count(user_id) - count(DISTINCT user_id)]) AS n FROM events")
def i09(spark, d):
    return inspect.duplicate_ids(read(spark, d, "events"))


# --- output ---


@query("f01_chat", "SELECT conv_id AS ord, '{\"messages\": [{\"role\": \"system\", \"content\": \"Be kind.\"}, ' || string_agg('{\"role\": ' || to_json(role) || ', \"content\": ' || to_json(text) || '}', ', ' ORDER BY turn) || ']}' AS line FROM talk GROUP BY 1")
def f01(spark, d):
    return curate.chat_record(plain(spark, d), " Be kind.\n").select("ord", sinks.spaced_json(F.col("messages")).alias("line"))


@query("s07_canonical_json", f"WITH {PLAIN} SELECT ord, CAST(to_json({{'id': id, 'source': source, 'metadata': metadata, 'messages': messages}}) AS VARCHAR) AS line FROM conv")
def s07(spark, d):
    return sinks.compact_json(plain(spark, d))


CURATOR = Curator(min_chars=120, caps=(("s0", 10), ("s1", 20)))


@query("f02_curate_end_to_end")
def f02(spark, d):
    """Clean, shape, filter, rebalance, shuffle and split the disturbed corpus; ``part`` tells the split."""
    c = CURATOR
    kept = c.kept(dirty_conversations(spark, d)).persist()
    first = stats.per_source(kept).select("source", "first_ord")
    final = c.sampled(kept)
    placed = c.ordered(final, first)
    cut = sample.train_size(placed.count(), c.split_ratio)
    return placed.select("id", "source", "place", F.when(F.col("place") < cut, F.lit("train")).otherwise(F.lit("validation")).alias("part"), F.size("messages").cast("long").alias("turns"))


E2E = f"""WITH {DIRTY_ROWS}, c AS (SELECT conv_id, turn, role, {CLEAN} AS content FROM d), l AS (SELECT *, CASE WHEN role IS DISTINCT FROM lag(role) OVER (PARTITION BY conv_id ORDER BY turn) THEN 1 ELSE 0 END AS new FROM c WHERE content <> ''),
  g AS (SELECT *, sum(new) OVER (PARTITION BY conv_id ORDER BY turn) AS run FROM l), m AS (SELECT conv_id, run, any_value(role) AS role, string_agg(content, chr(10)||chr(10) ORDER BY turn) AS content FROM g GROUP BY 1, 2),
  j AS (SELECT * FROM m WHERE NOT (run = 1 AND role = 'assistant')), t AS (SELECT *, max(CASE WHEN role = 'assistant' AND length(content) >= 120 THEN run END) OVER (PARTITION BY conv_id) AS cut FROM j)
  SELECT conv_id AS ord, 's' || (conv_id % 3) AS source, count(*) AS turns, CAST(sum(length(content)) AS BIGINT) AS chars FROM t WHERE run <= cut GROUP BY conv_id HAVING count(*) >= 2 AND count(*) FILTER (WHERE role = 'assistant') > 0
  AND count(*) FILTER (WHERE role = 'assistant' AND length(content) < 120) / count(*) FILTER (WHERE role = 'assistant') <= 0.5"""


@query("q08_quality_filter", E2E)
def q08(spark, d):
    kept = curate.quality_filter(CURATOR.shaped(dirty_conversations(spark, d)), min_chars=120)
    return kept.select("ord", "source", F.size("messages").cast("long").alias("turns"), F.aggregate("messages", F.lit(0).cast("long"), lambda a, m: a + F.length(m["content"])).alias("chars"))
