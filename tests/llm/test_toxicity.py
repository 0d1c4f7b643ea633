import re
import zlib
from collections import Counter

import numpy as np
import pytest

from dialoom.llm import toxicity as X


@pytest.fixture(scope="module")
def model():
    words = "idiot loser trash stupid clown moron the and that with over reading water paper little letter".split()
    return X.char_model(X.trigrams(" ".join(words * 50)).reshape(X.SIZE, X.SIZE, X.SIZE))


@pytest.mark.parametrize(("seen", "meant"), [("1d10t", "idiot"), ("id!ot", "idiot"), ("i.d.i.o.t", "idiot"), ("idiooooot", "idiot"), ("l0s3r", "loser"), ("tr@sh", "trash"), ("$tupid", "stupid"), ("st-up-id", "stupid"), ("m0r0nnn", "moron"), ("cl0wn", "clown")])
def test_restores(model, seen, meant):
    assert meant in X.Reader(model).read(f"so, {seen}!")


def test_spaced_letters(model):
    assert "idiot" in X.Reader(model).read("what an i d i o t you are")


def test_plain_words_stay(model):
    assert X.Reader(model).read("Reading the little letter, twice; water.") == {"reading", "the", "little", "letter", "twice", "water"}
    for odd in ("", "   ", "1234", "\x00", "a" * 100_000, "!" * 5000, "a1" * 5000, "a " * 5000):
        X.Reader(model).read(odd)


def plain_trigrams(text):
    counts = Counter()
    for token in text.split():
        core = token.strip("".join({c for c in token if not c.isalpha()}))
        if core and core.isalpha() and not re.search(r"(.)\1\1", core):
            codes = [0, 0, *(X.INDEX.get(c, 1) for c in core), 0]
            counts.update((codes[k - 2] * X.SIZE + codes[k - 1]) * X.SIZE + codes[k] for k in range(2, len(codes)))
    return counts


def test_trigrams_against_plain_loops(tables):
    texts = [r.text.lower() for r in tables("documents").where("text is not null").limit(60).collect()]
    texts += ["", " ", "a", "(well), so-so x1y aaab é. -- l0ser? don't", "größe  straße\u3000ende", "a\ud800b".encode("utf-16", "surrogatepass").decode("utf-16", "replace")]
    for text in texts:
        want = plain_trigrams(text)
        got = X.trigrams(text)
        assert {int(k): int(got[k]) for k in np.flatnonzero(got)} == dict(want)


def test_query_against_plain_scores(spark, tables):
    """Every score from the restored words of the whole text and the fitted weights, without caches."""
    docs, labels = tables("documents"), tables("labels")
    model, chosen, weights, bias = X.fit(docs, labels)
    got = {r.doc_id: r for r in X.op5_toxicity(docs, labels).collect()}
    at = {int(f): k for k, f in enumerate(chosen)}
    for r in docs.collect():
        words = X.Reader(model).read(r.text or "")
        found = {at[f] for w in words for f in X.features(w) if f in at}
        assert abs(got[r.doc_id].score - 1 / (1 + np.exp(-(bias + sum(weights[k] for k in found))))) < 1e-9


def test_quality_on_held_out_labels(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{n}.parquet") for n in ("documents", "labels"))
    rows = X.op5_toxicity(docs, labels).join(labels.select("doc_id", "toxic"), "doc_id").where("held_out").collect()
    caught = sum(r.predicted and r.toxic for r in rows)
    assert caught >= 0.85 * sum(r.toxic for r in rows) and caught >= 0.9 * sum(r.predicted for r in rows)
    ranked = sorted(rows, key=lambda r: r.score)
    places = [k for k, r in enumerate(ranked) if r.toxic]
    auc = (sum(places) - len(places) * (len(places) - 1) / 2) / (len(places) * (len(rows) - len(places)))
    print("held out:", caught, sum(r.toxic for r in rows), sum(r.predicted for r in rows), auc)
    assert auc >= 0.95


def test_repeated_rows_nulls_and_clashing_names(spark):
    text = "alpha beta idiot " * 3
    docs = [(k, text if k % 4 == 0 else "alpha beta gamma", 0.5, "x") for k in range(400)] + [(8, text, 0.1, "y")] * 3 + [(None, None, None, None)]
    d = spark.createDataFrame(docs, "doc_id long, text string, score double, toxic string")
    labels = spark.createDataFrame([(k, int(k % 4 == 0)) for k in range(400)] + [(8, 0), (None, 1)], "doc_id long, toxic int")
    out = X.op5_toxicity(d, labels).collect()
    assert Counter(r.doc_id for r in out) == Counter(x[0] for x in docs)
    assert all(r.predicted == int(r.doc_id % 4 == 0) for r in out if r.doc_id is not None)
    kept = X.accepted(d, labels)
    assert kept.columns == d.columns and kept.where("text is not null").count() == 300


def test_held_out_fold(spark):
    df = spark.range(200).withColumnRenamed("id", "doc_id")
    for r in df.select("doc_id", X.held_out(df.doc_id).alias("h")).collect():
        assert r.h == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)


def test_learns_words_and_disguises(spark):
    good, bad = "alpha beta gamma delta epsilon zeta eta theta".split(), "idiot moron loser trash".split()
    docs, labels = [], []
    for k in range(800):
        toxic = k % 5 == 0
        words = [good[(k * 7 + j * j) % 8] for j in range(12)] + ([bad[k % 4], bad[(k + 1) % 4]] if toxic else [])
        docs.append((k, " ".join(words)))
        labels.append((k, int(toxic)))
    probes = [(10_000, "alpha beta m0r0n gamma"), (10_001, "alpha i d i o t beta"), (10_002, "alpha beta gamma"), (10_003, None), (10_004, "")]
    d = spark.createDataFrame(docs + probes + [(None, "alpha")], "doc_id long, text string")
    rows = X.op5_toxicity(d, spark.createDataFrame(labels, "doc_id long, toxic int")).collect()
    by = {r.doc_id: r for r in rows}
    assert len(rows) == len(docs) + 6 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    assert all(by[k].predicted == y for k, y in labels if by[k].held_out)
    assert [by[k].predicted for k, _ in probes] == [1, 1, 0, 0, 0]


def test_without_labels(spark):
    d = spark.createDataFrame([(1, "a"), (2, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert [r.score for r in X.op5_toxicity(d, none).collect()] == [0.5, 0.5]
    assert X.op5_toxicity(d.where("false"), none).collect() == []
    assert X.accepted(d, spark.createDataFrame([(k, 0) for k in range(50)], "doc_id long, toxic int")).count() == 2
