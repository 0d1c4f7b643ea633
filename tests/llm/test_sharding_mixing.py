import zlib
from collections import Counter, defaultdict

from dialoom.llm import mixing as M
from dialoom.llm import sharding as S


def sharded(spark, rows, **how):
    return S.shard_rows(spark.createDataFrame(rows, "doc_id long, text string, shard int"), **how).collect()


def test_rows_law(spark):
    rows = [(k, f"text {k}" if k % 4 else f"group {k % 40}", 0) for k in range(1003)] + [(5000, None, 0), (5001, "", 0), (7, "text 7", 0)]
    out = sharded(spark, rows)
    assert len(out) == len(rows)
    sizes = Counter(r.shard for r in out)
    assert set(sizes) == set(range(24)) and max(sizes.values()) - min(sizes.values()) <= 1
    slots = defaultdict(list)
    for r in out:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    text = {i: t or "" for i, t, _ in rows}
    assert all(r.size == len(text[r.doc_id].encode()) + 8 and r.text_crc32 == zlib.crc32(text[r.doc_id].encode()) and r.law == "rows" and r.grown_shard is None for r in out)
    where = defaultdict(set)
    for r in out:
        where[text[r.doc_id]].add(r.shard)
    assert sum(len(s) > 1 for s in where.values()) <= 2  # groups stay together


def test_group_larger_than_a_shard(spark):
    rows = [(k, "hot" if k % 3 == 0 else f"t{k}", 0) for k in range(900)]
    out = sharded(spark, rows, shards=9)
    sizes = Counter(r.shard for r in out)
    assert set(sizes.values()) == {100}
    hot = Counter(r.shard for r in out if r.doc_id % 3 == 0)
    assert sorted(hot.values()) == [100, 100, 100]  # as few shards as hold it


def cut_edges(pairs):
    """Pairs of equal texts in different shards."""
    cells, groups = Counter(pairs), Counter(t for t, _ in pairs)
    return (sum(n * n for n in groups.values()) - sum(n * n for n in cells.values())) // 2


def plain_sharding(sizes, total, shards):
    """Largest group first into the shard with most room: a plain bound to hold the cut against."""
    room, out = [total // shards + (s < total % shards) for s in range(shards)], []
    for t, n in sorted(sizes.items(), key=lambda x: -x[1]):
        while n:
            s = max(range(shards), key=lambda s: room[s])
            k = min(n, room[s])
            out += [(t, s)] * k
            room[s] -= k
            n -= k
    return out


def test_cut_edges_against_a_plain_version(spark):
    sizes = {f"g{k}": 2 + k * k % 37 for k in range(60)} | {f"t{k}": 1 for k in range(400)} | {"big": 700}
    texts = [t for t, n in sizes.items() for _ in range(n)]
    out = sharded(spark, [(k % 500, t, 0) for k, t in enumerate(texts)], shards=5)
    crc = {zlib.crc32(t.encode()): t for t in sizes}
    got = [(crc[r.text_crc32], r.shard) for r in out]
    assert Counter(t for t, _ in got) == Counter(sizes)
    assert max(Counter(s for _, s in got).values()) - min(Counter(s for _, s in got).values()) <= 1
    spread = [(t, k % 5) for k, t in enumerate(texts)]
    assert cut_edges(got) <= 1.05 * cut_edges(plain_sharding(sizes, len(texts), 5)) < cut_edges(spread)


def test_every_document_is_linked_and_repeated_rows(spark):
    rows = [(1, "same", 0)] * 60 + [(k, f"pair {k // 2}", 0) for k in range(100)]
    out = sharded(spark, rows, shards=7)
    sizes = Counter(r.shard for r in out)
    assert len(out) == 160 and max(sizes.values()) - min(sizes.values()) <= 1 and len({(r.shard, r.slot) for r in out}) == 160


def test_small_and_empty(spark):
    assert sharded(spark, []) == []
    assert Counter(r.shard for r in sharded(spark, [(1, "a", 0), (2, "a", 0)])) == {0: 1, 1: 1}


def water(sizes, share=1.5, most=2.0, weights=(3, 1, 2)):
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + ([None] if None in sizes else [])
    w = {s: weights[k % 3] for k, s in enumerate(names)}
    total, capped = share * sum(sizes.values()), set()
    while True:
        left = total - sum(most * sizes[s] for s in capped)
        open_w = sum(w[s] for s in names if s not in capped) or 1
        t = {s: most * sizes[s] if s in capped else left * w[s] / open_w for s in names}
        over = {s for s in names if t[s] > most * sizes[s] + 1e-9} - capped
        if not over:
            return t
        capped |= over


def test_targets_and_taken(spark):
    rows = [(k, " ".join(["w"] * (k % 50)), f"s{k % 7}" if k % 7 else None) for k in range(2000)] + [(9000, None, "empty"), (9001, "x \t\ny", "Z"), (9001, "x \t\ny", "Z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = M.op10_mixing(df).collect()
    assert len(out) == len(rows)
    sizes, taken = Counter(), Counter()
    for r in out:
        sizes[r.source] += r.size
        taken[r.source] += r.taken
        assert r.taken <= 2 * r.size
    want = water(sizes)
    for r in out:
        assert abs(r.target - want[r.source]) < 1e-6 and r.source_size == sizes[r.source]
    assert all(abs(taken[s] - want[s]) <= 50 for s in sizes)
    again = M.op10_mixing(df.repartition(5)).collect()
    assert sorted(map(repr, again)) == sorted(map(repr, out))
    mix = M.repeated(df)
    assert mix.columns == df.columns
    got = Counter()
    for r in mix.collect():
        got[r.source] += len((r.text or "").split())
    assert got == Counter({s: n for s, n in taken.items() if n})


def test_repeated_with_clashing_names_and_repeated_rows(spark):
    rows = [(k, "w " * 20, "s", k, "h", k) for k in range(40)] + [(7, "w " * 20, "s", 99, "z", None)] * 5 + [(None, None, None, None, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, __id long, __hash string, n long")
    mix = M.repeated(df)
    assert mix.columns == df.columns
    first, again = (sorted(map(repr, M.repeated(d).collect())) for d in (df, df.repartition(3)))
    assert first == again and len(first) == sum(r.taken // 20 for r in M.op10_mixing(df).collect() if r.size)


def test_mixing_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string, source string")
    assert M.op10_mixing(df).collect() == [] and M.repeated(df).collect() == []
    one = spark.createDataFrame([(1, None, "a"), (2, "", None)], "doc_id long, text string, source string")
    assert all(r.taken == 0 and r.target == 0 for r in M.op10_mixing(one).collect())
