from collections import Counter, defaultdict
from pathlib import Path

import corpus_pipeline as P
import numpy as np
from dialoom.llm import mixing, toxicity
from dialoom.llm.queries import ORACLES, QUERIES
from test_near_copies import brute
from test_sharding_mixing import water

DATA = "/root/testdata/sf0.001"


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def test_every_stage_against_a_plain_version(spark, tmp_path):
    """Each stage on what its predecessor kept, of the whole table and odd rows with columns that clash."""
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    odd = [(900_001, None, "en", None, 0), (900_002, "", None, "s", 0), (None, " \t", "en", "s", 2), (900_003, "word " * 30_000, "en", "long", 150_000), (900_004, "twice", "en", "s", 5), (900_004, "twice", "en", "s", 5)]
    docs = docs.unionByName(spark.createDataFrame(odd, docs.schema)).selectExpr("*", "doc_id AS key", "text AS doc", "1 AS _id")
    seen = {}
    for name, stage in P.STAGES:
        seen[name, "in"] = docs.collect()
        out = stage(spark, docs, DATA)
        if name == "packing":
            seen[name, "out"] = out.collect()
            break
        assert out.columns == docs.columns
        out.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        seen[name, "out"] = docs.collect()
    assert [name for name, _ in P.STAGES] == ["toxicity", "exact_dedup", "simhash_dedup", "mixing", "packing"]

    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    first = spark.createDataFrame(seen["toxicity", "in"], docs.schema)
    model, chosen, weights, bias = toxicity.fit(first, labels)
    at = {int(f): k for k, f in enumerate(chosen)}

    def score(text):
        found = {at[f] for w in toxicity.Reader(model).read(text or "") for f in toxicity.features(w) if f in at}
        return 1 / (1 + np.exp(-(bias + sum(weights[k] for k in found))))

    rows = lambda name, side: Counter(map(repr, seen[name, side]))
    assert rows("toxicity", "out") == Counter(repr(r) for r in seen["toxicity", "in"] if score(r.text) < 0.3)

    top = {}
    for r in seen["exact_dedup", "in"]:
        key = lower(r.text)
        top[key] = max(top.get(key, -1), -1 if r.doc_id is None else r.doc_id)
    assert Counter((lower(r.text), -1 if r.doc_id is None else r.doc_id) for r in seen["exact_dedup", "out"]) == Counter(top.items())

    ids = [(-1 if r.doc_id is None else r.doc_id, r.text) for r in seen["simhash_dedup", "in"]]
    assert sorted(-1 if r.doc_id is None else r.doc_id for r in seen["simhash_dedup", "out"]) == sorted(brute(ids))

    sizes, taken, times = Counter(), Counter(), Counter(repr(r) for r in seen["mixing", "out"])
    for r in seen["mixing", "in"]:
        n = len((r.text or "").encode().split())
        sizes[r.source] += n
        taken[r.source] += n * times[repr(r)]
        assert times[repr(r)] <= mixing.MAX_EPOCHS
    assert set(times) <= {repr(r) for r in seen["mixing", "in"]}
    want = water(sizes)
    longest = defaultdict(int)
    for r in seen["mixing", "in"]:
        longest[r.source] = max(longest[r.source], len((r.text or "").split()))
    assert all(abs(taken[s] - want[s]) <= longest[s] for s in sizes)

    pieces = defaultdict(list)
    for r in seen["packing", "out"]:
        pieces[r.doc_id].append(r)
    for doc_id, n in Counter(r.doc_id for r in seen["packing", "in"]).items():
        spans = Counter((r.start, r.length) for r in pieces[doc_id])
        assert sum(r.length for r in pieces[doc_id]) == n * pieces[doc_id][0].doc_tokens and spans
    used = defaultdict(list)
    for r in seen["packing", "out"]:
        used[r.sequence_id].append((r.offset, r.length))
    for spans in used.values():
        upto = 0
        for offset, length in sorted(spans):
            assert offset == upto
            upto += length
        assert upto <= 2048


def test_run(spark):
    out = P.run(spark, DATA)
    assert set(out.columns) == {"doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"} and out.count() > 0
    folders = [p for p in Path(spark.sparkContext.getCheckpointDir().removeprefix("file:")).glob("pipeline-*/*")]
    assert [p.name for p in folders] == ["3-mixing"]  # what the result reads


def test_registry():
    assert len(QUERIES) == 10 and set(ORACLES) <= set(QUERIES) and Path(P.__file__).parent.joinpath("__spark_entry__.py").exists()
