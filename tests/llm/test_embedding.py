import numpy as np

from dialoom.llm import embedding_dedup as E


def brute(rows, cosine=0.98):
    ok = [r for r in rows if r[2] is not None and r[1] and all(v is not None and np.isfinite(v) for v in r[1]) and any(r[1])]
    links, up = {id(r): 0 for r in rows}, {id(r): r for r in rows}
    group = {id(r): {id(r)} for r in rows}
    for i, a in enumerate(ok):
        for b in ok[:i]:
            if a[2] == b[2] and len(a[1]) == len(b[1]):
                x, y = np.float32(a[1]).astype(float), np.float32(b[1]).astype(float)
                if x @ y / np.sqrt((x @ x) * (y @ y)) >= cosine:
                    links[id(a)] += 1
                    links[id(b)] += 1
                    both = group[id(a)] | group[id(b)]
                    for k in both:
                        group[k] = both
    return sorted((r[0], links[id(r)], min(up[k][0] for k in group[id(r)])) for r in rows)


def planted(n=400, dim=64, seed=0):
    rng = np.random.default_rng(seed)
    rows = []
    for k in range(n):
        if k % 3 == 0 or k < 3:
            v = rng.standard_normal(dim)
        else:
            v = np.array(rows[k - k % 3][1]) + rng.standard_normal(dim) * rng.choice([0.0, 0.02, 0.1, 0.14, 0.16])
        rows.append((k, [float(np.float32(x)) for x in v], (k - k % 3) % 5))
    return rows


def found(spark, rows, **how):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    return sorted((r.vec_id, r.n_links, r.component_id) for r in E.embedding_groups(df, **how).collect())


def test_against_brute_force(spark):
    rows = planted()
    rows += [(1000, None, 1), (1001, [], 1), (1002, [0.0] * 64, 1), (1003, [float("nan")] * 64, 1), (1004, [None] + [1.0] * 63, 1), (1005, rows[0][1], None), (1006, rows[0][1][:32], 0), (1007, [float("inf")] * 64, 0)]
    rows += [(2000 + k, rows[6][1], rows[6][2]) for k in range(50)]
    got, want = found(spark, rows), brute(rows)
    near = sum(a == b for a, b in zip(got, want, strict=True))
    assert sum(r[1] for r in got) >= 0.98 * sum(r[1] for r in want) and near >= 0.98 * len(want)
    assert all(a[1] <= b[1] for a, b in zip(got, want, strict=True))  # none below the threshold, none twice


def test_hot_bucket_in_blocks(spark):
    rng = np.random.default_rng(5)
    base = rng.standard_normal(16)
    rows = [(k, [float(np.float32(x)) for x in base + 0.01 * rng.standard_normal(16)], 0) for k in range(300)]
    assert found(spark, rows, block=32) == brute(rows)


def test_empty(spark):
    assert found(spark, []) == []


def test_recall_of_hashing():
    rng = np.random.default_rng(6)
    x = rng.standard_normal((4000, 64))
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    other = rng.standard_normal((4000, 64))
    other -= (other * unit).sum(1, keepdims=True) * unit
    other /= np.linalg.norm(other, axis=1, keepdims=True)
    y = 0.9801 * unit + np.sqrt(1 - 0.9801**2) * other
    a, b = E.signatures(unit), E.signatures(y)
    meets = (a[:, :, :, :, None] == b[:, :, :, None, :]).any((3, 4)).all(2).any(1)
    print("recall at the threshold", meets.mean())
    assert meets.mean() >= 0.97
