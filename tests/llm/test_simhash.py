import numpy as np
import xxhash

from dialoom.llm import simhash_dedup as S
from dialoom.llm.common import LOWER_AZ, connected_components


def fingerprint(text):
    w = (text or "").encode().translate(LOWER_AZ).split()
    shingles = [b" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))] if w else []
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(prints, ids, bits=3):
    up = list(range(len(ids)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(ids)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= bits:
                a, b = find(i), find(j)
                up[max(a, b)] = min(a, b)
    low = {}
    for i, d in enumerate(ids):
        low[find(i)] = min(low.get(find(i), d), d)
    return {d: low[find(i)] for i, d in enumerate(ids)}


def test_against_brute_force(spark, tables):
    rows = [(r.doc_id, r.text) for r in tables("documents").collect()]
    rows += [(100_000 + k, t) for k, t in enumerate([None, "", " \n\t", "one", "One two", "a b c", "a b c a b c", "é x y z", rows[0][1] + " tail", "w " * 30_000])]
    found = S.op2_simhash_dedup(spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, fp int")).collect()
    prints = [fingerprint(t) for _, t in rows]
    want = components(prints, [i for i, _ in rows])
    assert {r.doc_id: r.component_id for r in found} == want
    assert {r.doc_id: r.fingerprint for r in found} == {i: f"{p:016x}" for (i, _), p in zip(rows, prints, strict=True)}
    assert S.op2_simhash_dedup(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_every_link_meets_at_an_anchor():
    rng = np.random.default_rng(3)
    x = rng.integers(0, 1 << 63, 3000, dtype=np.int64).view(np.uint64)
    for n in (1, 2, 3):
        y = x.copy()
        for k in range(len(x)):
            for b in rng.choice(64, n, replace=False):
                y[k] ^= np.uint64(1) << np.uint64(b)
        met = np.zeros(len(x), bool)
        for part in (0, 1):
            a, b = ((v >> np.uint64(32 * part)).astype(np.uint32) for v in (x, y))
            own, _, _ = S.anchors(a)
            own_b, of, near = S.anchors(b)
            met |= own == own_b
            hit = near == own[of]
            met[of[hit]] = True
        assert met.all()


def test_hot_anchor_loses_no_link():
    rng = np.random.default_rng(4)
    base = np.uint64(0x0123456789ABCDEF)
    fps = [base]
    for _ in range(1500):
        v = fps[rng.integers(len(fps))]
        for b in rng.choice(64, 2, replace=False):
            v = v ^ (np.uint64(1) << np.uint64(b))
        fps.append(v)
    fps = np.array(fps + list(rng.integers(0, 1 << 63, 200).astype(np.uint64)), np.uint64)
    want = components([int(x) for x in np.unique(fps)], [int(x) for x in np.unique(fps)])
    links = S.bucket_links(fps, np.ones(len(fps), bool))
    up = {int(x): int(x) for x in fps}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        x, y = find(a), find(b)
        up[max(x, y)] = min(x, y)
    assert {x: find(x) for x in up} == want


def test_components(spark):
    edges = [(k, k + 1) for k in range(30)] + [(100, k) for k in range(101, 140)] + [(200, 201), (201, 200), (7, 7)]
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {k: 0 for k in range(31)} | {k: 100 for k in range(100, 140)} | {200: 200, 201: 200}
    assert got == want


def test_hot_anchors_are_dealt_out(spark, monkeypatch):
    rng = np.random.default_rng(6)
    low = rng.integers(0, 1 << 32, 400, dtype=np.int64)
    fps = [int(x) << 32 | 0x1234 for x in low] + [int(x) << 32 | 0x1234 ^ (1 << int(b)) for x, b in zip(low[:200], rng.integers(0, 32, 200), strict=True)] + [(int(x) ^ 5) << 32 | 0x1235 for x in low[:50]]
    fps = sorted({x - (1 << 64) if x >> 63 else x for x in fps})
    monkeypatch.setattr(S, "SPLIT_OVER", 20)
    links = S.fingerprint_links(spark.createDataFrame([(x,) for x in fps], "fp long")).collect()
    got = {r.node: r.root for r in connected_components(spark.createDataFrame([(r.a, r.b) for r in links], "a long, b long")).collect()}
    assert {x: got.get(x, x) for x in fps} == components([x & (1 << 64) - 1 for x in fps], fps)


def test_representatives(spark):
    text = " ".join(f"word{k}" for k in range(300))
    rows = [(5, text, "a"), (3, text + " more", "b"), (9, "something else entirely, short", "c"), (None, None, "d"), (None, None, "d"), (9, "something else entirely, short", "c")]
    out = S.representatives(spark.createDataFrame([(*r, k, "x") for k, r in enumerate(rows)], "doc_id long, text string, source string, __id long, key string"))
    assert out.columns == ["doc_id", "text", "source", "__id", "key"]
    assert sorted((r.doc_id for r in out.collect()), key=repr) == [3, 9, None]
