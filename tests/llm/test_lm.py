import math
import zlib
from collections import Counter

import numpy as np

from dialoom.llm import lm_scoring as L


def test_against_plain_counts(spark, tables):
    docs = tables("documents").select("doc_id", "text")
    docs = docs.unionByName(spark.createDataFrame([(90_001, None), (90_002, ""), (90_003, " \t"), (None, "Never seen anywhereatall"), (90_005, "the " * 20_000)], "doc_id long, text string"))
    rows = docs.collect()
    tokens = {k: L.tokens_of((r.text or "").encode()) + [L.END_TOKEN] for k, r in enumerate(rows)}
    out_of = {k: r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 7 == 2 for k, r in enumerate(rows)}
    counts = Counter(w for k, t in tokens.items() if not out_of[k] for w in t)
    n, v = sum(counts.values()), len(counts)
    base = {rows[k].doc_id: sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in t) for k, t in tokens.items()}
    out = L.op7_lm_scoring(docs).collect()
    assert len(out) == len(rows)
    at = {r.doc_id: k for k, r in enumerate(rows)}
    for r in out:
        t = tokens[at[r.doc_id]]
        assert r.held_out == out_of[at[r.doc_id]] and r.n_tokens == len(t) and r.n_known == sum(counts[w] > 0 for w in t) and r.train_tokens == n
        assert abs(r.base_score - base[r.doc_id]) < 1e-6 * max(1, abs(base[r.doc_id])) and r.score < 0
    assert all(r.bits_per_byte > 0 for r in out if r.n_tokens > 1)
    held = [r for r in out if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)  # higher probability on texts it has not seen


def test_code_is_complete():
    code = L.Code([b"a", b"b", b"c", b"d"], [5, 3, 2, 1], [4, 0], 6, 10)
    assert abs(sum(2.0**-n for n in code.lengths.tolist()) - 1) < 1e-12
    paths = {tuple(zip(code.nodes[a:b].tolist(), code.bits[a:b].tolist(), strict=True)) for a, b in zip(code.starts[:-1], code.starts[1:], strict=True)}
    assert len(paths) == 7


def small_model():
    rng = np.random.default_rng(0)
    words = [b"w%d" % k for k in range(20)]
    classes = [0] * L.CLASSES
    texts = [[words[i] if i < 20 else b"rare%d" % i for i in rng.integers(0, 26, 30)] for _ in range(200)]
    for w in (w for t in texts for w in t if w not in words):
        classes[L.class_of(w)] += 1
    code = L.Code(words, [40 - k for k in range(20)], classes, 30, 16)
    counts, weights = L.Counts(code), L.first_weights()
    for step in range(20):
        symbols, starts, outside = code.encode(texts[step * 10 : step * 10 + 10])
        assert all(len(o) == sum(w not in words for w in t) for o, t in zip(outside, texts[step * 10 :], strict=False))
        ctx, match = L.contexts(symbols, starts, code)
        mixer = L.Mixer(code, [L._At(t) for t in counts.tables], weights)
        mixer.learn(symbols, ctx, match, step)
        weights = mixer.weights
        counts.add(symbols, ctx)
    return code, L.Mixer(code, counts.slots(), weights)


def test_probabilities_sum_to_one_in_every_context():
    code, mixer = small_model()
    rng = np.random.default_rng(1)
    for length in (0, 1, 7, 16, 40, 200):  # within and behind segments, where the text's own scales have moved
        before = np.array(([1, 2, 3, 1, 2] * 40)[:length], np.int32) if length % 2 else rng.integers(0, code.n, length).astype(np.int32)
        texts = [np.r_[before, [s]].astype(np.int32) for s in range(code.n)]
        starts = np.cumsum([0] + [len(t) for t in texts[:-1]])
        after = mixer.score(np.concatenate(texts), starts)
        base = mixer.score(before, np.array([0]))[0] if length else 0.0
        assert abs(np.exp(after - base).sum() - 1) < 2e-3


def test_grouping_does_not_change_scores():
    code, mixer = small_model()
    rng = np.random.default_rng(2)
    texts = [np.r_[rng.integers(1, code.n, n), 0].astype(np.int32) for n in (0, 3, 15, 16, 17, 300, 1000)]
    alone = [mixer.score(t, np.array([0]))[0] for t in texts]
    together = mixer.score(np.concatenate(texts), np.cumsum([0] + [len(t) for t in texts[:-1]]))
    assert np.allclose(alone, together, rtol=1e-4)


def test_one_text_against_plain_loops():
    """The vectorised score of a short text, decision by decision."""
    code, mixer = small_model()
    symbols = np.array([3, 1, 2, 5, 1, 2, 5, 0], np.int32)
    total = 0.0
    for t, s in enumerate(symbols.tolist()):
        one = int(symbols[t - 1]) if t else 0
        two = int(symbols[t - 2]) if t > 1 else 0
        frequent = next((int(x) for x in symbols[:t][::-1] if code.frequent[x]), 0)
        guess = next((int(symbols[i]) for i in range(t - 1, 0, -1) if symbols[i - 1] == one and (int(symbols[i - 2]) if i > 1 else 0) == two), -1)
        guess = -1 if t == 0 or one >= code.first_class or guess >= code.first_class else guess
        ctx = [L._hashed(np.array([frequent | 1 << 60], np.uint64), 16)[0], L._hashed(np.array([one | 1 << 61], np.uint64), 16)[0]]
        path = range(code.starts[s], code.starts[s + 1])
        other = list(zip(code.nodes[code.starts[guess] : code.starts[guess + 1]], code.bits[code.starts[guess] : code.starts[guess + 1]], strict=True)) if guess >= 0 else []
        for depth, at in enumerate(path):
            codes = [code.plain[code.nodes[at]], *(mixer.slots[k][ctx[k] ^ code.node_hash[at]] for k in range(L.TABLES))]
            z = sum(mixer.weights[k][c >> L.LEVEL_BITS] * L.ODDS[c] for k, c in enumerate(codes))
            if depth < len(other) and other[depth][0] == code.nodes[at]:
                z += (2 * other[depth][1] - 1) * mixer.weights[-1][codes[-1] >> L.LEVEL_BITS]
            z = max(-L.CLIP, min(L.CLIP, float(z)))
            total -= math.log1p(math.exp(-z if code.bits[at] else z))
    assert abs(mixer.score(symbols, np.array([0]))[0] - total) < 1e-3 * abs(total)


def test_classes_share_their_probability():
    scale = L.Scale(100, 50, 20, 10, [30, 0], [7, 0])
    counts = [10, 8, 5, 3, 2, 1, 1]
    known = sum((c - scale.discount) / 30 for c in counts)
    assert abs(known + 10 ** scale.unknown[0] - 1) < 1e-9 and scale.unknown[1] == 0


def test_no_training_text(spark):
    ids = [k for k in range(100) if zlib.crc32(str(k).encode()) % 7 == 2][:2]
    df = spark.createDataFrame([(ids[0], "a b"), (ids[1], None)], "doc_id long, text string")
    held = df.where(L.held_out(df.doc_id))
    assert held.count() == 2
    out = L.op7_lm_scoring(held).collect()
    assert [r.train_tokens for r in out] == [0, 0] and all(math.isfinite(r.score) for r in out)
    assert L.op7_lm_scoring(df.where("false")).collect() == []


def test_weights_learn_from_every_text():
    """Of each group of training texts all decisions are predicted before they are counted (F8)."""
    import numpy as np
    import pyarrow as pa

    from dialoom.llm import lm_scoring as L

    class Shared:
        value = L.Code([b"a", b"b", b"c"], [5, 3, 2], [1] * L.CLASSES, 4, 16)

    def fitted(texts):
        batches = [pa.RecordBatch.from_arrays([pa.array([t])], ["text"]) for t in texts]
        rows = [r for out in L._count_contexts(Shared)(iter(batches)) for r in out.to_pylist() if r["kind"] == 8]
        return [np.frombuffer(r["data"], np.float64)[-1] for r in rows][0]

    one = fitted(["a b c unseen a b"])
    assert one > 0 and fitted(["a b c unseen a b"] * 40) == 40 * one


def test_codes_of_small_counts_are_looked_up(monkeypatch):
    """Exactly those that would be worked out; only pairs with a large count still are."""
    rng = np.random.default_rng(3)
    small = rng.integers(0, 1 << L.SMALL_BITS, 4000).astype(np.uint32)
    mixed = np.where(rng.random(4000) < 0.3, rng.integers(0, 1 << 32, 4000), small).astype(np.uint32)
    where = rng.integers(0, 2000, 9000).astype(np.int32)
    assert (L.slot_codes_at(mixed, where) == L.slot_codes(mixed)[where]).all()
    want = L.slot_codes(small)[where]
    monkeypatch.setattr(L, "slot_codes", None)
    assert (L.slot_codes_at(small, where) == want).all()
