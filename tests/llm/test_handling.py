"""Nulls in any column, empty and long texts, ties, repeated rows, empty tables and clashing column names, for every operator."""

from collections import Counter

import pytest

from dialoom.llm import chat_formatting, embedding_dedup, exact_dedup, html_extraction, lm_scoring, mixing, packing, sharding, simhash_dedup, toxicity

DOCS = [
    (None, None, None, None, 1), (1, None, "en", "s", 1), (2, "", None, "s", 1), (3, " \t\n", "en", None, 1), (4, "One two three four five six", "en", "s", 1), (4, "One two three four five six", "en", "s", 1),
    (5, "one TWO three four five six", "de", "t", 1), (6, "long words here " * 20_000, "en", "t", 1), (7, "x", "en", "t", None), (7, "other text of one id", "en", "t", 3), (-8, "\x00 é ß 漢字 \U0001f600", "fr", "s", 2),
]
CLASH = ["row", "digest", "fp", "score", "text_key", "cell", "word", "offset", "held_out", "_id", "_text", "key", "doc", "size", "source_size", "component_id", "html", "embedding"]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(DOCS, "doc_id long, text string, lang string, source string, n_chars long")


def with_clashes(df):
    return df.selectExpr("*", *[f"'x' AS `{c}`" for c in CLASH if c not in df.columns])


def rows(df):
    return sorted(map(repr, df.collect()))


LABELS = [(k, k % 2) for k in range(1, 9)] + [(None, 1), (4, None), (4, 0)]


def labels(spark):
    return spark.createDataFrame(LABELS, "doc_id long, toxic int")


OPERATORS = {
    "op1": exact_dedup.op1_exact_dedup, "op2": simhash_dedup.op2_simhash_dedup, "op5": lambda d: toxicity.op5_toxicity(d, labels(d.sparkSession)), "op6": sharding.op6_sharding, "op7": lm_scoring.op7_lm_scoring, "op9": packing.op9_packing, "op10": mixing.op10_mixing,
}


@pytest.mark.parametrize("name", OPERATORS)
def test_documents(docs, name):
    operator = OPERATORS[name]
    out = rows(operator(docs))
    assert rows(operator(with_clashes(docs))) == out
    ids = Counter(r.doc_id for r in operator(docs).collect())
    assert ids.keys() == {d[0] for d in DOCS}
    if name != "op9":  # there, a document may be several pieces
        assert ids == Counter(d[0] for d in DOCS)
    assert operator(with_clashes(docs).where("false")).collect() == []


FORMS = {"op1": exact_dedup.deduplicated, "op2": simhash_dedup.representatives, "op5": lambda d: toxicity.accepted(d, labels(d.sparkSession)), "op10": mixing.repeated}


@pytest.mark.parametrize("name", FORMS)
def test_pipeline_forms(docs, name):
    form, clashing = FORMS[name], with_clashes(docs)
    out = form(clashing)
    assert out.columns == clashing.columns and rows(out.select(docs.columns)) == rows(form(docs))
    assert form(clashing.where("false")).collect() == []
    if name == "op1":
        assert sorted((r.doc_id for r in out.collect()), key=repr) == sorted([2, 3, 5, 6, 7, 7, -8], key=repr)
    if name == "op2":  # null, empty and white space are one group, the texts of six words another
        assert sorted((r.doc_id for r in out.collect()), key=repr) == sorted([None, 4, 6, 7, 7, -8], key=repr)


def test_embeddings(spark):
    near = [1.0, 0.001, 0.0, 0.0]
    data = [(1, [1.0, 0.0, 0.0, 0.0], 1), (1, [1.0, 0.0, 0.0, 0.0], 1), (2, near, 1), (3, near, 2), (4, near, None), (5, None, 1), (6, [0.0] * 4, 1), (7, [1.0, None, 0.0, 0.0], 1), (8, [float("nan")] * 4, 1), (None, near, 1), (9, [float("inf"), 0.0, 0.0, 0.0], 1)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<float>, label int")
    out = embedding_dedup.op3_embedding_dedup(df)
    got = Counter((r.vec_id, r.n_links, r.component_id) for r in out.collect())
    assert sum(got.values()) == len(data)
    assert got[(1, 3, 1)] == 2 and got[(2, 3, 1)] == 1 and got[(None, 3, 1)] == 1
    assert all(got[(k, 0, k)] == 1 for k in (3, 4, 5, 6, 7, 8, 9))
    clash = df.selectExpr("*", "'x' AS bucket", "1 AS id", "2 AS n", "3 AS low", "'y' AS vector", "'z' AS `group`", "1 AS fit")
    assert rows(embedding_dedup.op3_embedding_dedup(clash)) == rows(out)
    assert embedding_dedup.op3_embedding_dedup(df.where("false")).collect() == []


def test_pages(spark):
    page = "<html><body><article><h1>A title of the page</h1><p>Some words that make up the main text of it.</p></article>"
    data = [(1, "u", page), (1, "u", page), (None, None, page), (2, "v", None), (3, None, ""), (4, "w", "  "), (5, "x", "<p>" + "many words in one block " * 30_000)]
    df = spark.createDataFrame(data, "page_id long, url string, html string")
    out = html_extraction.op4_html_extraction(df)
    got = out.collect()
    assert Counter((r.page_id, r.url) for r in got) == Counter((p, u) for p, u, _ in data) and all(r.n_chars == len(r.text) for r in got)
    assert len({r.text for r in got if r.page_id in (1, None)}) == 1 and all(r.text == "" for r in got if r.page_id in (2, 3, 4))
    assert rows(html_extraction.op4_html_extraction(df.selectExpr("*", "'x' AS text", "1 AS n_chars"))) == rows(out)


def test_conversations(spark):
    data = [(1, 0, "user", "a"), (1, 0, "user", "a"), (1, None, None, None), (None, None, None, None), (2, 5, "assistant", "b" * 100_000), (2, 5, "user", ""), (2, 6, "tool", "c")]
    df = spark.createDataFrame(data, "conv_id long, turn long, role string, text string")
    out = chat_formatting.op8_chat_formatting(df)
    assert Counter({r.conv_id: r.n_turns for r in out.collect()}) == Counter(c for c, *_ in data)
    assert rows(chat_formatting.op8_chat_formatting(df.selectExpr("*", "1 AS k", "2 AS part", "'x' AS kind", "'y' AS turns", "1 AS _row", "2 AS _h"))) == rows(out)
