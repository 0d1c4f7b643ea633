"""Toxicity by a noisy-channel reading of the text: restore disguised words, then score what was restored.

A token that looks disguised (letters mixed with look-alike digits and signs, letters repeated three times
or more, letters set apart by blanks or marks) becomes a lattice: every character may stand for itself or
for the letters it resembles, repeats may stand for one letter or two, separators may stand for nothing.
Viterbi decoding under a character trigram model, with a cost for every disguise, gives the restored word.
Other tokens have a single path, which is themselves. The trigrams are counted over the plain words of all
documents.

The score is a logistic regression over hashed features of the distinct restored words: the word and its
first four, five and six letters. Feature counts come from all labelled training rows that the bound
``train_rows`` lets in (the rows with the smallest hash of their id; the bound limits the classifier's
sample only). Features of the text alone count; labels, language, source and id are never inputs.

Defined results: null and empty texts have no features and score by the intercept; white space of any kind
separates tokens; a null doc_id counts as held out = false; with no labelled training rows, or only one
class among them, the score is the smoothed share of label 1 (1/2 without any); of labelled rows that repeat an
id, the text that sorts last trains, and an id labelled both 0 and 1 counts as 1; an empty table gives no rows.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage

TRAIN_ROWS = 50_000
FEATURE_BITS = 20
#: Features with a smaller log-likelihood ratio against the label tell nothing.
LEAST_GAIN = 12.0
THRESHOLD = 0.3
#: Tokens whose reading a task keeps; their number bounds its memory.
CACHE = 150_000

#: What a sign may stand for besides itself.
LOOKS_LIKE = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "€": "e", "(": "c", "£": "l"}
SEPARATORS = frozenset(".-_*~·'`,:;/\\\u200b\u200c\u200d\u00ad")
#: Natural logarithms: what the channel pays for a look-alike, a dropped repeat, a dropped separator.
LOOK_COST, REPEAT_COST, SEPARATOR_COST = -0.7, -0.3, -0.3

EDGE = re.compile(r"^[^\w@$€£|!+(]+|[^\w@$€£|!+(]+$")
RUN = re.compile(r"(.)\1\1")
APART = re.compile(r"(?<!\S)(?:\w[^\w\s]?\s+){2,}\w[^\w\s]?(?!\S)")
PARTS = re.compile(r"[\W_\d]+")
MARKS = re.compile(r"([^\w\s])\1+")
ALPHABET = "abcdefghijklmnopqrstuvwxyzäöüßàâçéèêëîïôùûœæáíóúñ¿¡"
INDEX = {c: i + 2 for i, c in enumerate(ALPHABET)}  # 0: edge of a word, 1: any other
SIZE = len(ALPHABET) + 2


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def char_model(tri: np.ndarray) -> np.ndarray:
    """Log probabilities (SIZE, SIZE, SIZE) of a letter after two others, from counts: trigrams backed off to bigrams and single letters."""
    one = tri.sum((0, 1)) + 0.5
    one /= one.sum()
    pair = tri.sum(0)
    two = (pair + 4 * one) / (pair.sum(1, keepdims=True) + 4)
    three = (tri + 4 * two[None]) / (tri.sum(2, keepdims=True) + 4)
    return np.log(three)


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Of every code point: 0 for white space, 1 for other signs, 2 for letters outside the alphabet, else its index + 1."""
    out = np.array([2 if c.isalpha() else 0 if c.isspace() else 1 for c in map(chr, range(0x110000))], np.int32)
    for c, k in INDEX.items():
        out[ord(c)] = k + 1
    return out


def trigrams(text: str) -> np.ndarray:
    """Counts (SIZE ** 3) of letters after two others over the plain words of a lower-case text: those of letters alone but for signs at their edges, without a letter three times in a row."""
    points = np.frombuffer(f" {text} ".encode("utf-32-le", "replace"), np.uint32)
    kind = _letters()[points]
    x = np.where(kind > 1, kind - 1, 0)
    one = np.r_[0, x[:-1]]
    two = np.where(one > 0, np.r_[0, 0, x[:-2]], 0)
    token = np.cumsum(kind == 0)
    odd = np.bincount(token[(x > 0) & (one == 0)], minlength=token[-1] + 1) > 1  # letters in more than one piece
    odd[token[2:][(x[2:] > 0) & (points[2:] == points[1:-1]) & (points[2:] == points[:-2])]] = True
    counts = ((x > 0) | (one > 0)) & ~np.where(x > 0, odd[token], odd[np.r_[0, token[:-1]]])
    return np.bincount((two[counts] * SIZE + one[counts]) * SIZE + x[counts], minlength=SIZE**3)


def lattice(token: str) -> list[list[tuple[str, float]]]:
    """For each character, what it may stand for and the cost; the empty string stands for nothing."""
    out: list[list[tuple[str, float]]] = []
    letters = [k for k, c in enumerate(token) if c.isalpha()]
    first, last = (letters[0], letters[-1]) if letters else (len(token), -1)
    run = 0
    for k, c in enumerate(token):
        run = run + 1 if k and token[k - 1] == c else 0
        arcs = []
        if c.isalpha():
            arcs.append((c, -2.0 * max(0, run - 1)))
            if run:
                arcs.append(("", REPEAT_COST))
        else:
            arcs.append((c, -1.0))
            arcs += [(x, LOOK_COST) for x in LOOKS_LIKE.get(c, "")]
            if c in SEPARATORS or c.isspace():
                arcs.append(("", SEPARATOR_COST))
            elif k >= last or k <= first or run:  # a sign at either edge, or repeated, may be ornament
                arcs.append(("", -1.5))
        out.append(arcs)
    return out


def restore(token: str, model: np.ndarray) -> str:
    """The likeliest word behind a disguised token (Viterbi over the last two letters), in time linear in its length."""
    # What was read is a chain (before, letter), so no step copies it.
    states: dict[tuple[int, int], tuple[float, tuple | None]] = {(0, 0): (0.0, None)}
    for arcs in lattice(token):
        after: dict[tuple[int, int], tuple[float, tuple | None]] = {}
        for (a, b), (score, chain) in states.items():
            for c, cost in arcs:
                if c:
                    x = INDEX.get(c, 1)
                    key, total, out = (b, x), score + cost + float(model[a, b, x]), (chain, c)
                else:
                    key, total, out = (a, b), score + cost, chain
                if key not in after or after[key][0] < total:
                    after[key] = total, out
        states = after
    chain = max(states.items(), key=lambda s: s[1][0] + float(model[s[0][0], s[0][1], 0]))[1][1]
    read = []
    while chain is not None:
        chain, c = chain
        read.append(c)
    return "".join(reversed(read))


def looks_disguised(core: str) -> bool:
    if core.isalpha():
        return RUN.search(core) is not None
    return any(c.isalpha() for c in core) or any(c in "@$!|" for c in core)


class Reader:
    """Distinct restored words of a text; what a token restores to is kept between texts."""

    def __init__(self, model: np.ndarray):
        self.model = model
        self.kept: dict[str, tuple[str, ...]] = {}

    def words_in(self, token: str) -> set[str]:
        core = EDGE.sub("", MARKS.sub(r"\1", token))
        words = set()
        if core:
            words.add(restore(core, self.model) if looks_disguised(core) else core)
            if not core.isalpha():
                words.update(p for p in PARTS.split(core) if p.isalpha())  # words joined by marks
        return words - {""}

    def words_of(self, token: str) -> tuple[str, ...]:
        found = self.kept.get(token)
        if found is None:
            found = tuple(self.words_in(token))
            if len(self.kept) >= CACHE:
                self.kept.clear()
            self.kept[token] = found
        return found

    def apart(self, text: str, tokens: set[str]) -> set[str]:
        """Words of letters set apart by blanks."""
        out: set[str] = set()
        if tokens and min(map(len, tokens)) <= 2:
            for run in APART.finditer(text):
                letters = "".join(x[0] for x in run.group().split())
                # A run of single letters may hold a word and its neighbours: every window that a word can fill counts,
                # of the run as it is and of what it restores to.
                restored = restore(letters, self.model)
                out.add(restored)
                for whole in {letters, restored}:
                    for size in range(3, min(13, len(whole)) + 1):
                        out.update(whole[at : at + size] for at in range(len(whole) - size + 1))
        return out

    def read(self, text: str) -> set[str]:
        text = text.lower()
        tokens = set(text.split())
        out = self.apart(text, tokens)
        for token in tokens:
            out.update(self.words_of(token))
        return out


def features(word: str) -> list[int]:
    """Hashed features: the word, and its first four, five and six letters."""
    h, mask = xxhash.xxh32_intdigest, (1 << FEATURE_BITS) - 1
    out = [h("w" + word) & mask]
    out += [h(f"{k}{word[:k]}") & mask for k in (4, 5, 6) if len(word) >= k]
    return out


def _texts(batch: pa.RecordBatch) -> list[str]:
    return [t or "" for t in batch.column("text").to_pylist()]


def _count_trigrams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(cell, n): what all texts of the task add to the trigrams."""
    total = np.zeros(SIZE**3, np.int64)
    for batch in batches:
        held, size = [], 0
        for text in [*_texts(batch), None]:
            if text is None or size > 1 << 18:
                total += trigrams(" ".join(held).lower())
                held, size = [], 0
            if text:
                held.append(text)
                size += len(text)
    seen = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], ["cell", "n"])


def _count_features(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(model.value)
        counts = np.zeros((2, 1 << FEATURE_BITS), np.int64)
        for batch in batches:
            for text, toxic in zip(_texts(batch), batch.column("toxic").to_pylist(), strict=True):
                found = list({f for word in reader.read(text) for f in features(word)})
                counts[int(toxic), found] += 1
        seen = np.flatnonzero(counts.sum(0))
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(counts[0, seen]), pa.array(counts[1, seen])], ["feature", "clean", "toxic"])

    return run


class Scorer:
    def __init__(self, model: np.ndarray, chosen: np.ndarray, weights: np.ndarray, bias: float):
        self.reader = Reader(model)
        self.at = {int(f): k for k, f in enumerate(chosen)}
        self.weights, self.bias = weights, bias
        self.kept: dict[str, tuple[int, ...]] = {}

    def hit(self, word: str) -> tuple[int, ...]:
        return tuple(k for f in features(word) if (k := self.at.get(f)) is not None)

    def found(self, text: str) -> set[int]:
        out: set[int] = set()
        text = text.lower()
        tokens = set(text.split())
        for token in tokens:
            hit = self.kept.get(token)
            if hit is None:
                hit = tuple({k for word in self.reader.words_in(token) for k in self.hit(word)})
                if len(self.kept) >= CACHE:
                    self.kept.clear()
                self.kept[token] = hit
            if hit:
                out.update(hit)
        for word in self.reader.apart(text, tokens):
            out.update(self.hit(word))
        return out

    def score(self, text: str) -> float:
        x = self.bias + math.fsum(self.weights[k] for k in self.found(text))
        return 1 / (1 + math.exp(-max(-40.0, min(40.0, x))))


def _find(parts):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, chosen = parts.value
        scorer = Scorer(model, chosen, np.zeros(len(chosen)), 0.0)
        for batch in batches:
            hits = [np.array(sorted(scorer.found(t)), np.int32).tobytes() for t in _texts(batch)]
            yield pa.RecordBatch.from_arrays([pa.array(hits, pa.binary()), batch.column("toxic").cast(pa.int64())], ["hits", "toxic"])

    return run


def _score(parts):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(*parts.value)
        for batch in batches:
            names = [c for c in batch.schema.names if c != "text"]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array([scorer.score(t) for t in _texts(batch)])], [*names, "score"])

    return run


def logistic(rows: list[np.ndarray], labels: np.ndarray, width: int, rounds: int = 300) -> tuple[np.ndarray, float]:
    """Logistic regression over present features by full-batch Adam, penalty half the squared weights; the intercept is free of it.

    Gradients are summed over blocks of rows, so beside the rows themselves only one block's numbers are held.
    """
    l2 = 1 / max(1, len(rows))
    sizes = np.array([len(r) for r in rows], np.int64)
    which = np.concatenate([*rows, np.empty(0, np.int32)]).astype(np.int32)
    ends = np.cumsum(sizes)
    blocks = [(at, min(at + 4096, len(rows))) for at in range(0, len(rows), 4096)]
    y = labels.astype(np.float64)
    share = (y.sum() + 1) / (len(y) + 2)
    w, b = np.zeros(width), math.log(share / (1 - share))
    if not 0 < y.sum() < len(y):
        return w, b
    m = np.zeros(width + 1)
    v = np.zeros(width + 1)
    for step in range(1, rounds + 1):
        g = np.zeros(width + 1)
        for first, last in blocks:
            here = which[ends[first] - sizes[first] : ends[last - 1]]
            who = np.repeat(np.arange(last - first), sizes[first:last])
            p = 1 / (1 + np.exp(-np.clip(b + np.bincount(who, w[here], last - first), -40, 40)))
            err = (p - y[first:last]) / len(y)
            g[:-1] += np.bincount(here, err[who], width)
            g[-1] += err.sum()
        g[:-1] += l2 * w
        m = 0.9 * m + 0.1 * g
        v = 0.99 * v + 0.01 * g * g
        move = 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-9)
        w -= move[:-1]
        b -= float(move[-1])
    return w, b


def fit(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS):
    """(char model, chosen features, weights, intercept), learned from labelled rows outside the held-out fold.

    ``train_rows`` bounds the sample of labelled rows; what reaches the driver is bounded by it, by the alphabet
    (letter trigrams) and by the number of feature buckets.
    """
    spark = docs.sparkSession
    marked = labels.select(F.col("doc_id").cast("long").alias("_id"), F.col("toxic").cast("int").alias("toxic")).where("toxic in (0, 1) and _id is not null").groupBy("_id").agg(F.max("toxic").alias("toxic"))
    marked = cut_lineage(marked.where(~held_out(F.col("_id"))).orderBy(F.xxhash64("_id"), "_id").limit(train_rows))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    # At most ``train_rows`` rows of two numbers: their number is the check of what is broadcast.
    train = texts.join(F.broadcast(marked), F.col("doc_id") == F.col("_id")).groupBy("_id").agg(F.max("text").alias("text"), F.max("toxic").alias("toxic"))
    train = cut_lineage(train.select("text", "toxic").repartition(max(12, spark.sparkContext.defaultParallelism)))
    cells = texts.select("text").mapInArrow(_count_trigrams, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect()
    tri = np.zeros(SIZE**3)
    if cells:
        tri[[r["cell"] for r in cells]] = [r["n"] for r in cells]
    model = char_model(tri.reshape(SIZE, SIZE, SIZE))
    shared = spark.sparkContext.broadcast(model)
    counted = train.mapInArrow(_count_features(shared), "feature long, clean long, toxic long").groupBy("feature").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    total = train.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("t")).first()
    n, t = total["n"], total["t"]
    # The log-likelihood ratio of the feature against the label: what is left of the entropy of its four cells.
    cell = lambda k: k * F.log(F.greatest(k.cast("double"), F.lit(1e-9)))
    a, b = F.col("toxic"), F.col("clean")
    gain = 2 * (cell(a) + cell(b) + cell(t - a) + cell(n - t - b) + cell(F.lit(n)) - cell(a + b) - cell(n - a - b) - cell(F.lit(t)) - cell(F.lit(n - t)))
    best = counted.where("toxic + clean >= 3").withColumn("gain", gain).where(F.col("gain") >= LEAST_GAIN).select("feature").collect()
    chosen = np.array(sorted(r["feature"] for r in best), np.int64)
    found = train.mapInArrow(_find(spark.sparkContext.broadcast((model, chosen))), "hits binary, toxic long")
    hits, marks = [], []
    for r in cut_lineage(found).toLocalIterator():  # one task's rows at a time
        hits.append(np.frombuffer(r["hits"], np.int32))
        marks.append(r["toxic"])
    weights, bias = logistic(hits, np.array(marks, np.int64), len(chosen))
    return model, chosen, weights, bias


def score(docs: DataFrame, parts, keep: list[str]) -> DataFrame:
    """``keep`` and the score of each text, in one pass without a shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(parts)
    rows = docs.select(*keep, F.col("text").alias("text") if "text" not in keep else F.col("text"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "text")
    return rows.mapInArrow(_score(shared), f"{kinds}, score double")


def op5_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    parts = fit(docs, labels)
    scored = score(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), parts, ["doc_id"])
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def accepted(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that are not toxic, with all their columns."""
    parts = fit(docs, labels)
    shared = docs.sparkSession.sparkContext.broadcast(parts)
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(*shared.value)
        for batch in batches:
            yield batch.filter(pa.array([scorer.score(t) < threshold for t in _texts(batch)], pa.bool_()))

    return docs.mapInArrow(run, kinds)
