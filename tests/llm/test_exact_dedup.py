import hashlib
import random

from dialoom.llm import exact_dedup as X

ODD = [(1, "Same Text"), (2, "same text"), (3, None), (4, ""), (None, "same TEXT"), (5, "ÄB"), (6, "äB"), (7, "x" * 200_000), (8, "x" * 200_000), (9, "only"), (9, "only")]


def lower(t):
    return (t or "").encode().translate(X.LOWER_AZ)


def brute(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(lower(t), []).append(i)
    out = []
    for i, t in rows:
        ids = groups[lower(t)]
        top = max((x for x in ids if x is not None), default=None)
        out.append((i, top, len(ids), hashlib.sha256(lower(t)).hexdigest()))
    return sorted(out, key=repr)


def test_against_brute_force(spark):
    df = spark.createDataFrame([(i, t, "extra", 1) for i, t in ODD], "doc_id long, text string, digest string, row int").repartition(3)
    found = X.op1_exact_dedup(df).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in found), key=repr) == brute(ODD)
    kept = [r for r in found if r.kept]
    assert len(kept) == len({lower(t) for _, t in ODD})
    assert sum(r.kept for r in found if r.doc_id == 9) == 1  # rows that repeat an id and text


def test_deduplicated_keeps_columns(spark):
    df = spark.createDataFrame([(i, t, "s", k) for k, (i, t) in enumerate(ODD)], "doc_id long, text string, source string, same int")
    out = X.deduplicated(df)
    assert out.columns == df.columns
    rows = out.collect()
    assert len(rows) == len({lower(t) for _, t in ODD})
    assert {lower(r.text) for r in rows} == {lower(t) for _, t in ODD}


def test_deduplicated_with_clashing_names(spark):
    df = spark.createDataFrame([(1, "a", 5, "x", b"d", 1), (2, "A", 6, "y", b"e", 2), (2, "A", 6, "y", b"e", 2), (None, None, None, None, None, None)], "doc_id long, text string, _row int, __text string, digest binary, `top n` int")
    out = X.deduplicated(df)
    assert out.columns == df.columns
    assert sorted((tuple(r) for r in out.collect()), key=repr) == [(2, "A", 6, "y", b"e", 2), (None,) * 6]


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert X.op1_exact_dedup(df).collect() == []
    assert X.deduplicated(df).collect() == []


def test_grace_spills_and_merges():
    rng = random.Random(1)
    texts = [f"text {rng.randrange(400)} ".encode() * 20 for _ in range(5000)]
    records = [(hashlib.sha256(t).digest(), t, 1, k, k, 1) for k, t in enumerate(texts)]
    want = {}
    for d, t, n, top, *_ in records:
        a = want.setdefault(t, [0, -1])
        a[0] += 1
        a[1] = max(a[1], top)
    for budget in (1 << 30, 20_000, 1000):
        got = {c: [n, top] for _, c, n, top, _, _ in X.grace(iter(records), budget)}
        assert got == want


def test_same_digest_of_other_content_is_an_error():
    table = X.ContentTable()
    table.add(b"d" * 32, b"one", 1, 1, 0, 1)
    try:
        table.add(b"d" * 32, b"two", 1, 2, 1, 1)
    except ValueError:
        return
    raise AssertionError
