"""Stages on small inputs, against plain Python."""

import html
import json
import random
import re
from difflib import SequenceMatcher

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from dialoom.functions import text as X
from dialoom.operators import curate, dedup, inspect, merge, normalize, parse, sample, stats, tokens, validate
from dialoom.schemas import CANONICAL, FilterError, MergeError, ParseError
from dialoom.sources import readers, sinks

GROUPED = "conv_id string, utterance_idx int, context string, prompt string, speaker_idx string, utterance string, selfeval string, tags string, row_idx long"


def rows(spark, data):
    return spark.createDataFrame([(*r, k) for k, r in enumerate(data)], GROUPED)


def u(conv, idx, speaker, said):
    return (conv, idx, "sad", "p", speaker, said, None, "")


def conv(k, *turns, id=None, source="s", context=None, split="train"):
    return (k, id if id is not None else f"c{k}", source, (split, source, str(k), context), [tuple(t) for t in turns])


def frame(spark, *convs):
    return spark.createDataFrame(list(convs), CANONICAL)


U, A = "user", "assistant"


def messages(df):
    return {r.ord: [(m.role, m.content) for m in r.messages] for r in df.collect()}


def test_grouped_parser(spark):
    p = parse.parse_grouped(rows(spark, [
        u("a", 2, "1", "second"), u("a", 1, "0", "first"), u("b", 1, "x", "hi"), u("dup", 1, "0", "x"), u("dup", 1, "1", "y"), u("empty", 1, "0", ""), u("blank", 1, "0", "  "),
        u("spk", 1, " ", "x"), u("nospk", 1, None, "x"), u(None, 1, "0", "x"), u(" ", 1, "0", "x"), u("noidx", None, "0", "x"),
    ]), "d", "train")
    got = {r.id: r for r in p.collect()}
    assert [m.content for m in got["a"].messages] == ["first", "second"] and got["a"].ord == 0 and got["a"].context == "sad" and got["a"].messages[0].attributes["utterance_idx"] == "1"
    assert {i: r.reject_reason for i, r in got.items()} == {"a": None, "b": None, "dup": "non-increasing utterance_idx at 1", "empty": "empty utterance at 1", "blank": None, "spk": "missing speaker_idx", "nospk": "missing speaker_idx", "noidx": "missing utterance_idx"}
    report = parse.parse_report(p, "d")
    assert (report.num_conversations, report.skipped_conversations, report.max_turns, report.min_turns) == (3, 5, 2, 1) and len(report.warnings) == 5
    with pytest.raises(ParseError):
        parse.parse_grouped(rows(spark, [u("a", 1, "0", "x")]).drop("utterance"), "d", "train")
    assert parse.parse_grouped(rows(spark, []).drop("utterance"), "d", "train").collect() == []


TEXTS = [
    '{"emotion_type": "joy", "situation": "s", "dialog": [{"text": "hi", "speaker": "usr", "strategy": "Q"}, {"text": "yo", "speaker": "sys"}]}', "nope", '{"x": 1}', '{"dialog": []}', '{"dialog": 3}', '{"dialog": [1]}', '{"dialog": [{"text": "", "speaker": "usr"}]}',
    '{"dialog": [{"text": "x"}]}', "[1]", None, '{"dialog": [{"text": "x", "speaker": "  "}]}',
]
REASONS = [None, "invalid json", "missing dialog", None, "missing dialog", "turn is not an object", "empty text", "missing speaker", "not an object", "missing text", "missing speaker"]


@pytest.mark.parametrize("strict", [False, True])
def test_json_dialog_parser(spark, strict):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "row_idx long, text string")
    got = parse.parse_json_dialog(df, "d", "test", strict_json=strict).orderBy("ord").collect()
    assert [r.reject_reason for r in got] == REASONS and got[0].id == "dialog_test_0" and got[0].context == "joy"
    assert got[0].messages[0].attributes == {"strategy": "Q"} and got[0].attributes == {"emotion_type": "joy", "situation": "s", "split": "test"}


def test_json_leniency(spark):
    odd = ['{"dialog": [{"text": "x", "speaker": "usr"}]} trailing', '{"dialog": [{"text": NaN, "speaker": "usr"}]}']
    df = spark.createDataFrame(list(enumerate(odd)), "row_idx long, text string")
    assert [r.reject_reason for r in parse.parse_json_dialog(df, "d", "t", strict_json=True).orderBy("ord").collect()] == ["invalid json", None]


def test_pair_parser(spark):
    df = spark.createDataFrame([(0, "q", "a"), (1, " ", "a"), (2, "q", None), (3, None, None)], "row_idx long, Context string, Response string")
    got = parse.parse_pairs(df, "d", "train").orderBy("ord").collect()
    assert [r.reject_reason for r in got] == [None, "empty or missing Context", "empty or missing Response", "empty or missing Context"] and got[0].id == "pair_train_0"
    assert [(m.speaker_id, m.content) for m in got[0].messages] == [("Context", "q"), ("Response", "a")]


def test_registry():
    assert parse.PARSERS.get("GROUPED") is parse.parse_grouped and parse.PARSERS.get("some/json_dialog") is parse.parse_json_dialog
    with pytest.raises(KeyError):
        validate.VALIDATORS.get("x/conversation")


def test_normalisers(spark):
    p = parse.parse_grouped(rows(spark, [u("a", k, s, f"t{k}") for k, s in enumerate("112233")] + [u("b", 1, "0", " \t")]), "d", "train")
    n = normalize.normalize_alternating(parse.accepted(p), 2)
    ok, bad = normalize.split_quarantine(n)
    r = ok.first()
    assert [m.role for m in r.messages] == [U, U, A, A, U, U] and r.ord == 2 << 40 and r.metadata.original_id == "a" and r.metadata.source_dataset == "d"
    assert bad.first().quarantine_reason == "blank content"
    with pytest.raises(ParseError):
        normalize.split_quarantine(n, strict=True)
    d = parse.accepted(parse.parse_json_dialog(spark.createDataFrame(list(enumerate(TEXTS)), "row_idx long, text string"), "d", "t"))
    got = {r.id: r for r in normalize.normalize_dialog(d).collect()}
    assert [m.role for m in got["dialog_t_0"].messages] == [U, A] and got["dialog_t_3"].quarantine_reason == "no messages"


def test_validation_and_filter(spark):
    df = frame(spark, conv(0, (U, "a"), (A, "b")), conv(1, (U, "a")), conv(2, ("bot", "a"), (A, " ")), conv(3, (A, "x"), (A, "y"), id=" "), (4, "c4", "s", None, None), conv(5, (U, None), (None, "y")))
    checked = validate.validated(df)
    got = {r.ord: r.errors for r in checked.collect()}
    assert got == {
        0: [], 1: ["Conversation has fewer than 2 messages (got 1)."], 2: ["Message at index 0 has invalid role: 'bot'.", "Message at index 1 has empty or null content."], 3: ["Conversation ID is null, empty or missing."],
        4: ["Conversation metadata is null or missing.", "Conversation messages list is null or missing."], 5: ["Message at index 0 has empty or null content.", "Message at index 1 has invalid role: 'None'."],
    }
    kept, removed = validate.filter_valid(checked)
    assert [r.ord for r in kept.collect()] == [0] and {r.ord for r in removed.collect()} == {1, 2, 3, 4, 5}
    report = validate.validation_report(checked)
    assert [r.ord for r in validate.filter_by_report(df, report)[0].collect()] == [0]
    with pytest.raises(FilterError):
        validate.filter_by_report(df, report.where("id <> 'c1'"))
    n = validate.validation_counts(checked).first()
    assert (n.num_checked, n.num_valid, n.num_invalid) == (6, 1, 5)
    b = {r.category: r.n for r in stats.error_breakdown(checked).collect()}
    assert b["Message has invalid role"] == 2 and b["Conversation metadata is null or missing."] == 1


def test_merge(spark):
    a, b = frame(spark, conv(0, (U, "a"), source="x")), frame(spark, conv(1 << 40, (U, "b"), id="d", source="y"), conv((1 << 40) + 1, (U, "c"), id="e", source="y"))
    m = merge.merge([a, frame(spark), b])
    r = merge.merge_report(m)
    assert r.total_conversations == 3 and r.dataset_counts == {"x": 1, "y": 2} and r.dataset_order == ["x", "y"]
    with pytest.raises(MergeError, match="'d'.*segment 2"):
        merge.merge([b, frame(spark, conv(2 << 40, (U, "z"), id="d"))])


def test_dedup(spark):
    df = frame(spark, conv(0, (U, "Hello  World\r\n"), (A, "x")), conv(1, (U, "hello world"), (A, " X"), context="other"), conv(2, (U, "hello world!"), (A, "x")), conv(3, (A, "hello world"), (A, "x")))
    kept, removed = dedup.deduplicate(df)
    assert sorted(r.ord for r in kept.collect()) == [0, 2, 3]
    r = removed.collect()
    assert [(x.kept_conversation_id, x.removed_conversation_id) for x in r] == [("c0", "c1")] and len(r[0].hash) == 64
    assert dedup.manifest(4, 1, "v")["duplicate_percentage"] == 25.0 and dedup.manifest(0, 0, "v")["duplicate_percentage"] == 0.0
    assert dedup.deduplicate(frame(spark))[0].collect() == []


def test_statistics(spark):
    df = frame(spark, conv(0, (U, "a" * 10), (A, "b" * 20), source="x", context="sad"), conv(1, (U, "é" * 5), (A, "b" * 26), (U, "c"), (A, "d"), source="y"), conv(2, (U, "q"), (A, "r"), source="x"))
    s = stats.statistics(df)
    assert (s.total_conversations, s.average_turns, s.median_turns, s.minimum_turns, s.maximum_turns) == (3, 2.67, 2.0, 2, 4)
    assert s.conversations_per_dataset == {"x": 2, "y": 1} and s.percentage_contribution_per_dataset == {"x": 66.67, "y": 33.33}
    assert (s.average_user_message_length, s.average_assistant_message_length, s.maximum_message_length) == (4.25, 12.0, 26) and s.context_distribution == {"None": 2, "sad": 1}
    e = stats.statistics(frame(spark))
    assert e.total_conversations == 0 and e.average_turns == 0 and e.context_distribution == {}


def model_clean(t, urls=True):
    for a, b in (("_comma_", ","), ("_period_", "."), ("_quote_", '"')):
        t = t.replace(a, b)
    t = html.unescape(t)
    t = re.sub(r"(?<=[a-z])([.!?])(?=[A-Z])", r"\1 ", t)
    if urls:
        t = re.sub(r"https?://\S+|www\.\S+", "", t)
    t = re.sub(r"[^\S\n]{2,}", " ", t)
    return re.sub(r"\n{3,}", "\n\n", t).strip()


PIECES = ["_comma_", "_period_", "_quote_", "&amp;", "&lt;", "&#233;", "&copy", "end.Next", "3.14", " ", "  ", "\t", "\n", "\n\n\n", "\r", "\xa0", "　", "\x1c", "\x1f", "http://x.y/z", "www.a.b", " ", "é", "word", ".", "A", "a"]


def test_clean_matches_python(spark):
    rng = random.Random(7)
    texts = ["".join(rng.choice(PIECES) for _ in range(rng.randrange(12))) for _ in range(1500)]
    df = spark.createDataFrame(list(enumerate(texts)), "k long, content string").repartition(4)
    got = {r.k: r for r in curate.cleaned_columns(df).collect()}
    bad = [(texts[k], got[k].cleaned, model_clean(texts[k])) for k in got if got[k].cleaned != model_clean(texts[k])]
    assert not bad, bad[:5]
    assert all(got[k].changed == (model_clean(t) != t) for k, t in enumerate(texts))
    c = frame(spark, conv(0, *[(U, t) for t in texts[:300]]))
    assert [m.content for m in curate.clean_conversations(c).first().messages] == [x for t in texts[:300] if (x := model_clean(t))]
    assert curate.cleaned_columns(df, strip_urls=False).where("n_url > 0").count() == 0


def model_shape(turns, least):
    out = []
    for role, text in turns:
        if out and out[-1][0] == role:
            out[-1] = (role, out[-1][1] + "\n\n" + text)
        else:
            out.append((role, text))
    if out and out[0][0] == A:
        out = out[1:]
    last = max((k for k, (r, t) in enumerate(out) if r == A and len(t) >= least), default=-1)
    return out[: last + 1]


def test_shape_matches_python(spark):
    rng = random.Random(9)
    convs = [[(rng.choice([U, A]), "x" * rng.randrange(1, 60)) for _ in range(rng.randrange(8))] for _ in range(300)]
    got = messages(curate.shape_turns(frame(spark, *[conv(k, *c) for k, c in enumerate(convs)])))
    assert got == {k: model_shape(c, 40) for k, c in enumerate(convs)}


def model_reason(turns):
    said = [t for r, t in turns if r == A]
    if len(turns) < 2:
        return "too_few_messages"
    if not said:
        return "no_assistant_turn"
    if len(said[-1]) < 40:
        return "final_response_too_short"
    if sum(len(t) < 40 for t in said) / len(said) > 0.5:
        return "mostly_short_responses"
    norm = lambda t: re.sub(r"[^a-z0-9 ]+", "", t.lower()).strip()
    for (r, a), (q, b) in zip(turns, turns[1:], strict=False):
        if r == U and q == A and norm(a) and norm(b) and SequenceMatcher(None, norm(a), norm(b)).ratio() >= 0.8:
            return "assistant_echoes_user"
    return None


def test_quality_matches_python(spark):
    rng = random.Random(11)
    base = ["the quick brown fox jumps over the lazy dog again and again", "so it goes", "an entirely different and quite long statement of some kind", "ok", "ab" * 120]
    convs = []
    for _ in range(250):
        c = []
        for _ in range(rng.randrange(6)):
            t = rng.choice(base)
            c.append((rng.choice([U, A]), t.upper() + rng.choice(["", "!", "?? yes"])))
        convs.append(c)
    marked = curate.quality_reasons(frame(spark, *[conv(k, *c) for k, c in enumerate(convs)]))
    got = {r.ord: r.reason for r in marked.select("ord", "reason").collect()}
    want = {k: model_reason(c) for k, c in enumerate(convs)}
    assert got == want and len(set(want.values())) == 6


def test_caps(spark):
    convs = [conv(k, (U, "q"), (A, "x" * n), source="x", id=i) for k, (n, i) in enumerate([(10, "a"), (50, "b"), (30, "c"), (50, "d")])] + [conv(9, (U, "q"), (A, "x"), source="y")]
    df = frame(spark, *convs)
    top = curate.cap_sources(df, {"x": 2, "y": None}).orderBy("source", "rank").collect()
    assert [r.id for r in top] == ["d", "b", "c9"]
    assert [r.id for r in curate.cap_sources(df, {"x": 9}).where("source = 'x'").orderBy("rank").collect()] == ["a", "b", "c", "d"]
    assert curate.cap_sources(df, {}).count() == 5


def test_chat_record(spark):
    df = frame(spark, conv(0, (U, 'a "b"\n'), (A, "é\\")))
    assert messages(curate.chat_record(df, "  "))[0] == [(U, 'a "b"\n'), (A, "é\\")]
    line = curate.chat_record(df, " Be kind. ").select(sinks.spaced_json(F.col("messages")).alias("l")).first().l
    assert line == json.dumps({"messages": [{"role": "system", "content": "Be kind."}, {"role": U, "content": 'a "b"\n'}, {"role": A, "content": "é\\"}]}, ensure_ascii=False)


def test_shuffle_and_split(spark):
    df = frame(spark, *[conv(k, (U, "q"), (A, "a")) for k in range(57)]).repartition(5)
    for times in (1, 2):
        want = list(range(57))
        for _ in range(times):
            random.Random(42).shuffle(want)
        assert [r.ord for r in sample.shuffled(df, 42, times).orderBy("place").collect()] == want
    train, validation = sample.split_by_ratio(sample.shuffled(df, 1), 0.95)
    assert (train.count(), validation.count()) == (54, 3)
    assert sorted(r.place for r in sample.shuffled(df, 1, mode="hash").collect()) == list(range(57))
    picked = [r.ord for r in sample.review_sample(df, 10, 42).collect()]
    assert picked == sorted(random.Random(42).sample(range(57), 10)) and sample.review_sample(df, 99, 1).count() == 57 and sample.random_sample(df, 5).count() == 5


def test_tokens(spark):
    df = frame(spark, *[conv(k, (U, "x" * n), (A, "y")) for k, n in enumerate([0, 100, 150, 1100, 9000])])
    counted = tokens.token_counts(df, tokens.plain_template)
    t = [r.tokens for r in counted.orderBy("ord").collect()]
    assert t == [len("user:" + "assistant:y") + n for n in [0, 100, 150, 1100, 9000]]
    r = tokens.token_report(counted)
    assert r.total_tokens == sum(t) and r.histogram["0-128"] == 2 and r.histogram["129-256"] == 1 and r.histogram["8193+"] == 1 and sum(r.histogram.values()) == 5 and r.conversations_over_1024 == 2
    tens = spark.createDataFrame([(v,) for v in (10, 20, 30, 40, 50)], "tokens long")
    assert tokens.exact_percentiles(tens, [0, 50, 95, 99, 100]) == [10, 30, 48, 50, 50]
    assert [tokens.recommended_context(p) for p in (1, 1024, 1025, 8192, 8193, 16385)] == [1024, 1024, 2048, 8192, 16384, 32768]
    assert tokens.exact_percentiles(tens.where("false"), [50]) == [0]


@settings(max_examples=30, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet=" \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0     　﻿ab", max_size=8), min_size=1, max_size=20))
def test_strip_and_blank(spark, texts):
    got = spark.createDataFrame([(t,) for t in texts], "t string").select(X.py_strip(F.col("t")).alias("s"), X.is_blank(F.col("t")).alias("b")).collect()
    assert [(r.s, r.b) for r in got] == [(t.strip(), not t.strip()) for t in texts]


def test_inspection(spark):
    df = spark.createDataFrame([(1, "a", "hello there you", ["x", "yy"], 7), (1, None, "  ", None, 7), (1, None, "  ", None, 7), (2, "b", "z" * 6000, ["q"], 8)], "conv_id int, tag string, text string, parts array<string>, item_id int")
    s = inspect.inspect_split(df, 2)
    assert s.num_rows == 4 and s.method == "id_grouped" and s.turns == {"n": 2, "avg": 2.0, "median": 2.0, "min": 1, "max": 3} and s.duplicate_rows == 1 and s.duplicate_ids == {"item_id": 2} and len(s.samples) == 2
    assert s.quality["missing"] == {"tag": 2, "parts": 2} and s.quality["empty"] == {"text": 2} and s.quality["long"] == {"text": 1} and s.quality["short"] == {"tag": 2} and s.quality["null_messages"] == {"tag": 2}
    assert s.messages["max"] == 6000 and s.message_columns == ["tag", "text", "parts"] and s.schema[3]["dtype"] == "list[string]" and s.schema[3]["is_nested"]
    assert inspect.conversation_stats(df.drop("conv_id"))[:2] == ("sequence_column", "parts") and inspect.conversation_stats(df.select("text"))[0] == "row_level"


def test_sources_and_sinks(spark, tmp_path):
    df = frame(spark, *[conv(k, (U, f"q{k}"), (A, "a")) for k in range(40)]).repartition(7)
    path = str(tmp_path / "x" / "out.jsonl")
    assert sinks.export_canonical(df, path) == 40
    lines = [json.loads(x) for x in open(path)]
    assert [x["id"] for x in lines] == [f"c{k}" for k in range(40)] and lines[0]["metadata"]["context"] is None
    assert sinks.export_canonical(frame(spark), path) == 0 and open(path).read() == ""
    chat = str(tmp_path / "chat.jsonl")
    sinks.export_chat(df, chat)
    back = readers.read_chat_jsonl(spark, chat).orderBy("row_idx").collect()
    assert [r.messages[0].content for r in back] == [f"q{k}" for k in range(40)] and [r.row_idx for r in back] == list(range(40))
    (tmp_path / "empty.jsonl").write_text("\n\n")
    with pytest.raises(ValueError, match="no records"):
        readers.read_chat_jsonl(spark, str(tmp_path / "empty.jsonl"))
    (tmp_path / "bad.jsonl").write_text('{"messages": [}\n')
    with pytest.raises(Exception):  # noqa: B017
        readers.read_chat_jsonl(spark, str(tmp_path / "bad.jsonl")).collect()
    with pytest.raises(ValueError, match="split"):
        readers.select_split({"train": df}, "test")
    assert sinks.size_of(chat).endswith(" KB") and sinks.export_canonical(df, str(tmp_path / "many"), single_file=False) == 40


def test_row_numbers_hold_where_partitions_are_merged(spark):
    """Of rows too large to be merged into one partition, while their keys alone are not."""
    df = spark.range(6000).select(F.when(F.col("id") % 1000 != 7, (F.col("id") * 2654435761) % 99991).alias("ord"), F.concat(F.lit("c"), F.col("id")).alias("id"), F.expr("transform(sequence(1, 400), x -> xxhash64(id, x))").alias("messages"))
    places = [r.row_idx for r in readers.with_row_index(df, by=["ord"]).select("row_idx", F.hash("messages")).collect()]
    assert sorted(places) == list(range(6000))
    in_order = [r.ord for r in readers.with_row_index(df, by=["ord", "id"]).orderBy("row_idx").select("ord").collect()]
    assert in_order == sorted(in_order, key=lambda v: -1 if v is None else v) and in_order[0] is None
    flat = [r.row_idx for r in readers.with_row_index(df.withColumn("one", F.lit(1)), by=["one"]).select("row_idx").collect()]
    assert sorted(flat) == list(range(6000)) and readers.with_row_index(df.where("false"), by=["ord"]).collect() == []
    assert len(sample.review_sample(df.where("ord is not null"), 30, 42).collect()) == 30


def test_planted_texts_follow_the_sql(spark):
    """Letters with a longer upper case stay as they are (F2)."""
    from dialoom.plans import queries

    one = spark.createDataFrame([("Straße ﬁn äé",)], "t string")
    assert one.select(queries.upper_each(F.col("t")).alias("t")).first().t == "STRAßE ﬁN ÄÉ"


def test_turns_of_one_number(spark, tmp_path):
    """Of two turns with one number the one of the lower original conversation comes first."""
    from dialoom.plans import queries

    spark.createDataFrame([(1000, 0, "system", "a"), (1, 0, "user", "b"), (1000, 1, "user", "c")], "conv_id long, turn long, role string, text string").write.parquet(str(tmp_path / "conversations.parquet"))
    found = {r.ord: r.errors for r in queries.QUERIES["v01_errors"](spark, str(tmp_path)).collect()}
    assert found == {1000: "Message at index 1 has invalid role: 'system'."}
