"""Curation: cleaning, turn shaping, quality rules, rebalancing, chat records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import text as X
from ..functions.udfs import sequence_ratio, unescape_each, unescape_entities

# The quality rules' names, in the order in which they are tried.
RULES = ("too_few_messages", "no_assistant_turn", "final_response_too_short", "mostly_short_responses", "assistant_echoes_user")


def cleaned_columns(df: DataFrame, content: str = "content", strip_urls: bool = True) -> DataFrame:
    """Adds ``cleaned`` and the match counts n_comma ... n_url, n_html_entity, ``changed`` to rows of one message each.

    Every step is a column of its own, so a match is computed once and Catalyst merges the projections.
    """
    counts = X.placeholder_counts(F.col(content))
    df = df.withColumns({f"n_{k}": v for k, v in counts.items()} | {"_c": X.replace_placeholders(F.col(content))})
    df = df.withColumn("_u", unescape_entities(F.col("_c"))).withColumn("n_html_entity", (F.col("_u") != F.col("_c")).cast("long"))
    df = df.withColumn("n_missing_space", X.missing_spaces(F.col("_u"))).withColumn("_s", X.space_after_sentence(F.col("_u")))
    url = X.strip_urls(F.col("_s")) if strip_urls else F.col("_s")
    df = df.withColumn("n_url", X.url_count(F.col("_s")) if strip_urls else F.lit(0).cast("long")).withColumn("_r", url)
    done = X.py_strip(X.collapse_newlines(X.collapse_horizontal(F.col("_r"))))
    return df.withColumn("cleaned", done).withColumn("changed", F.col("cleaned") != F.col(content)).drop("_c", "_u", "_s", "_r")


COUNTS = ("comma", "period", "quote", "html_entity", "missing_space", "url")


def clean_messages(df: DataFrame, strip_urls: bool = True) -> DataFrame:
    """One row per message: every column of ``df`` but messages, then pos, role, content, cleaned, counts, changed."""
    rest = [c for c in df.columns if c != "messages"]
    m = df.select(*rest, F.posexplode("messages").alias("pos", "m")).select(*rest, "pos", "m.role", "m.content")
    return cleaned_columns(m, strip_urls=strip_urls)


def clean_counts(messages: DataFrame) -> DataFrame:
    """One row: messages seen, changed, and replacements by rule."""
    return messages.agg(F.count(F.lit(1)).alias("messages_seen"), F.count_if("changed").alias("messages_changed"), *[F.coalesce(F.sum(f"n_{k}"), F.lit(0)).cast("long").alias(k) for k in COUNTS])


def clean_conversations(df: DataFrame, strip_urls: bool = True) -> DataFrame:
    """Messages cleaned in place; those that become empty go.

    The nested form has no shuffle; entities go through one Arrow call per batch of conversations,
    on the texts that have an ampersand.
    """
    has_entity = F.exists("messages", lambda m: F.contains(F.coalesce(m["content"], F.lit("")), F.lit("&")))
    placed = F.transform("messages", lambda m: F.struct(m["role"].alias("role"), X.replace_placeholders(m["content"]).alias("content")))
    df = df.withColumn("_entity", has_entity).withColumn("messages", placed)
    joined = F.when(F.col("_entity"), F.transform("messages", lambda m: m["content"]))
    df = df.withColumn("_texts", unescape_each(joined))
    unescaped = F.when(F.col("_entity"), F.transform("messages", lambda m, i: F.struct(m["role"].alias("role"), F.get(F.col("_texts"), i).alias("content")))).otherwise(F.col("messages"))

    def finish(c: Column) -> Column:
        c = X.space_after_sentence(c)
        c = X.strip_urls(c) if strip_urls else c
        return X.py_strip(X.collapse_newlines(X.collapse_horizontal(c)))

    df = df.withColumn("messages", unescaped)
    done = F.transform("messages", lambda m: F.struct(m["role"].alias("role"), finish(m["content"]).alias("content")))
    return df.withColumn("messages", F.filter(done, lambda m: m["content"] != "")).drop("_entity", "_texts")


def runs(messages: Column, name: str) -> Column:
    """The messages cut where the field ``name`` changes: an array of arrays, in time linear in the turns."""
    changes = F.transform(messages, lambda m, i: F.when((i == 0) | ~m[name].eqNullSafe(F.get(messages, i - 1)[name]), i))
    starts = F.filter(changes, lambda i: i.isNotNull())
    return F.transform(starts, lambda i, k: F.slice(messages, i + 1, F.coalesce(F.get(starts, k + 1), F.size(messages)) - i))


def merge_runs(messages: Column, separator: str = "\n\n") -> Column:
    """Consecutive turns of one role become one (W01); a run with a null content has none."""
    said = lambda run: F.transform(run, lambda m: m["content"])
    content = lambda run: F.when(~F.exists(said(run), lambda c: c.isNull()), F.array_join(said(run), separator))
    return F.transform(runs(messages, "role"), lambda run: F.struct(F.get(run, F.lit(0))["role"].alias("role"), content(run).alias("content")))


def drop_leading_assistant(messages: Column) -> Column:
    """At most one leading assistant turn goes."""
    leads = F.coalesce(F.try_element_at(messages, F.lit(1))["role"] == "assistant", F.lit(False))
    return F.when(leads, F.slice(messages, 2, F.greatest(F.size(messages) - 1, F.lit(0)))).otherwise(messages)


def trim_to_substantive(messages: Column, min_chars: int = 40) -> Column:
    """Everything behind the last assistant turn of at least ``min_chars`` goes; without one, all."""
    last = F.array_max(F.transform(messages, lambda m, i: F.when((m["role"] == "assistant") & (F.length(m["content"]) >= min_chars), i + 1).otherwise(0)))
    return F.slice(messages, 1, F.coalesce(last, F.lit(0)))


def shape_turns(df: DataFrame, separator: str = "\n\n", min_chars: int = 40) -> DataFrame:
    df = df.withColumn("messages", merge_runs(F.col("messages"), separator))
    df = df.withColumn("messages", drop_leading_assistant(F.col("messages")))
    return df.withColumn("messages", trim_to_substantive(F.col("messages"), min_chars))


def cheap_reason(messages: Column, min_messages: int = 2, min_chars: int = 40, max_short_ratio: float = 0.5) -> Column:
    """The first violated rule of Q01-Q04, or null."""
    said = F.filter(messages, lambda m: m["role"] == "assistant")
    short = F.filter(said, lambda m: F.length(m["content"]) < min_chars)
    return (
        F.when(F.size(messages) < min_messages, RULES[0])
        .when(F.size(said) == 0, RULES[1])
        .when(F.length(F.try_element_at(said, F.lit(-1))["content"]) < min_chars, RULES[2])
        .when(F.size(short) / F.greatest(F.size(said), F.lit(1)) > max_short_ratio, RULES[3])
    )


def echo_pairs(df: DataFrame, key: str = "ord") -> DataFrame:
    """(key, user, assistant), normalised: assistant turns behind a user turn, neither empty.

    The outer explode infers no filter, and a filter on what it gives stays above it: below, it would repeat the whole
    expression behind ``messages`` for every mention. Null messages give no pairs.
    """
    pairs = F.transform("messages", lambda m, i: F.struct(F.get(F.col("messages"), i - 1).alias("before"), m.alias("now")))
    near = F.filter(pairs, lambda p: (p["now"]["role"] == "assistant") & (p["before"]["role"] == "user"))
    p = df.select(key, F.explode_outer(near).alias("p")).select(key, X.normalise_for_echo(F.col("p.before.content")).alias("user"), X.normalise_for_echo(F.col("p.now.content")).alias("assistant"))
    return p.where("user <> '' and assistant <> ''")


def echoes(df: DataFrame, threshold: float = 0.8, key: str = "ord") -> DataFrame:
    """Keys of conversations in which an assistant turn echoes its user turn (Q05).

    Equal texts have ratio 1; a ratio is at most 2 * shorter / both, so most pairs are told apart by their
    lengths and only the others reach the UDF.
    """
    pairs = echo_pairs(df, key)
    a, b = F.length("user"), F.length("assistant")
    possible = 2.0 * F.least(a, b) / (a + b) >= threshold
    equal = pairs.where("user = assistant").select(key) if threshold <= 1 else pairs.where("false").select(key)
    other = pairs.where("user <> assistant").where(possible).where(sequence_ratio("user", "assistant") >= threshold).select(key)
    return equal.unionByName(other).distinct()


def quality_reasons(df: DataFrame, min_messages: int = 2, min_chars: int = 40, max_short_ratio: float = 0.5, echo_threshold: float = 0.8, key: str = "ord") -> DataFrame:
    """Adds ``reason``: the first violated rule, or null (Q07). Echoes are looked for only among what the other rules pass."""
    first = df.withColumn("reason", cheap_reason(F.col("messages"), min_messages, min_chars, max_short_ratio))
    found = echoes(first.withColumn("messages", F.when(F.col("reason").isNull(), F.col("messages"))), echo_threshold, key).select(F.col(key).alias("_echo"))
    joined = first.join(found, F.col(key) == F.col("_echo"), "left")
    return joined.withColumn("reason", F.coalesce("reason", F.when(F.col("_echo").isNotNull(), F.lit(RULES[4])))).drop("_echo")


def quality_filter(df: DataFrame, **rules) -> DataFrame:
    return quality_reasons(df, **rules).where("reason is null").drop("reason")


def quality_counts(marked: DataFrame) -> DataFrame:
    """(reason, n): null for what is kept."""
    return marked.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


def assistant_chars(messages: Column) -> Column:
    return F.aggregate(F.filter(messages, lambda m: m["role"] == "assistant"), F.lit(0).cast("long"), lambda acc, m: acc + F.length(m["content"]))


def cap_sources(df: DataFrame, caps: dict[str, int | None]) -> DataFrame:
    """At most ``cap`` conversations of a capped source, those with most assistant text, then the largest id.

    Adds ``rank``: the place within its source (input order where nothing is cut, else rank order). Capped and
    uncapped sources are separate branches with a literal bound, so the limit is pushed below the shuffle and a
    source that holds most rows sends each task's best only.
    """
    limits = {s: c for s, c in caps.items() if c is not None}
    free = df.where(~F.col("source").isin(*limits) if limits else F.lit(True)).withColumn("rank", F.col("ord"))
    if not limits:
        return free
    cap = F.create_map(*[x for s, c in limits.items() for x in (F.lit(s), F.lit(c))])[F.col("source")]
    best = Window.partitionBy("source").orderBy(F.desc("_chars"), F.desc("id"))
    some = df.where(F.col("source").isin(*limits)).withColumn("_chars", assistant_chars(F.col("messages")))
    some = some.withColumn("_rn", F.row_number().over(best)).where((F.col("_rn") <= cap) & (F.col("_rn") <= max(limits.values())))
    sizes = df.where(F.col("source").isin(*limits)).groupBy("source").agg(F.count(F.lit(1)).alias("_n"))
    some = some.join(F.broadcast(sizes), "source").withColumn("rank", F.when(F.col("_n") > cap, F.col("_rn").cast("long")).otherwise(F.col("ord")))
    return free.unionByName(some.select(*free.columns))


def chat_record(df: DataFrame, system_prompt: str | None = None) -> DataFrame:
    """(all other columns, messages with the stripped system turn first, if there is one)."""
    prompt = (system_prompt or "").strip()
    if not prompt:
        return df
    head = F.array(F.struct(F.lit("system").alias("role"), F.lit(prompt).alias("content")))
    return df.withColumn("messages", F.concat(head, "messages"))
