"""The pipeline's near-duplicate stage against brute force over all pairs."""

import random

import corpus_pipeline as P

DATA = "/root/testdata/sf0.001"


def shingles(text):
    words = (text or "").lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute(rows):
    sets, up = [shingles(t) for _, t in rows], list(range(len(rows)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if 5 * len(a & sets[j]) >= 4 * len(a | sets[j]):
                up[find(i)] = find(j)
    groups = {}
    for i, (key, _) in enumerate(rows):
        groups.setdefault(find(i), []).append(key)
    return {min(g) for g in groups.values()}


def made():
    """Texts around the bound, one group of many near copies of each other, and a passage that unlike texts share."""
    rng = random.Random(5)
    word = lambda: f"w{rng.randrange(400)}"
    passage, base, rows = [word() for _ in range(40)], [word() for _ in range(120)], ["", "  ", None, "a b", "A  b"]
    for _ in range(60):
        text = [word() for _ in range(rng.randrange(20, 150))]
        near = list(text)
        for _ in range(rng.randrange(1, 5)):
            near[rng.randrange(len(near))] = word()
        rows += [" ".join(text), " ".join(near), " ".join([*passage, *(word() for _ in range(20))])]
    for _ in range(80):
        near = list(base)
        for _ in range(rng.randrange(1, 4)):
            near[rng.randrange(len(near))] = word()
        rows.append(" ".join(near))
    return list(enumerate(rows))


def test_brute_force(spark):
    rows = made()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = [r.doc_id for r in P.drop_near_copies(spark, docs, DATA).collect()]
    assert len(kept) == len(set(kept)) and set(kept) == brute(rows)
    assert P.drop_near_copies(spark, docs.where("false"), DATA).collect() == []


def test_sketches_lose_no_similar_pair(spark):
    """The bits that differ are no more than the shingles that do; unlike texts that share a passage are told apart."""
    import numpy as np
    from pyspark.sql import functions as F

    from dialoom.llm import jaccard_dedup as J

    rng = np.random.default_rng(3)
    pairs = []
    for n in (1, 9, 60, 300, 1500, 6000):
        a = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
        for changed in (0, n // 10, n // 9, n // 2, n):
            b = np.unique(np.r_[a[changed:], rng.integers(0, 1 << 63, changed, dtype=np.uint64)])
            pairs.append((a, b))
    rows = [(k, len(a), len(b), *J.sketch(a).tolist(), *J.sketch(b).tolist(), J.similar(a, b)) for k, (a, b) in enumerate(pairs)]
    names = ["k", "n", "l_n", *J.PARTS, *[f"l_{c}" for c in J.PARTS], "similar"]
    found = spark.createDataFrame(rows, names).select("k", "n", "similar", J._close("n", J.PARTS, "l_n", [f"l_{c}" for c in J.PARTS]).alias("close")).collect()
    assert all(r.close for r in found if r.similar) and sum(r.similar for r in found) >= 12
    assert not any(r.close for r in found if r.k % 5 == 4 and 9 <= r.n <= 1500)


def test_few_pairs_are_compared_without_rounds(spark, monkeypatch):
    """Leaders are for large groups of near copies; where unlike texts meet in few pairs, rounds would only shuffle all meetings again."""
    from dialoom.llm import jaccard_dedup as J

    monkeypatch.setattr(J, "COMMON", 0)
    made, with_roots = [], J._with_roots
    monkeypatch.setattr(J, "_with_roots", lambda *a: (made.append(1), with_roots(*a))[1])
    texts = [f"g{g}a g{g}b g{g}c g{g}d g{g}e u{k} v{k} w{k} x{k}" for g in range(12) for k in range(24 * g, 24 * g + 24)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    prints = J.prints_of(docs).cache()
    links = J.near_links(prints, docs, spark.createDataFrame([], "a long, b long"))
    assert links.count() == 0 and len(made) == 1
