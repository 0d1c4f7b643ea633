import random
import zlib
from collections import defaultdict

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from dialoom.llm import packing as P

ODD = [None, "", " ", "  ", "a  b", "a   b\n\n c ", "tail ", "tail\n ", "\n\n", "x  y", "don't  stop", "<|endoftext|> a <|endoftext|>b", "1234 5678", "é　ü", "word " * 9000, "\t\tindent\r\n", "a\x0b\x0cb"]


def tokenizer():
    return Tokenizer.from_file(P.tokenizer_path())


def test_round_trip(spark, tables):
    rows = [(r.doc_id, r.text) for r in tables("documents").collect()] + [(70_000 + k, t) for k, t in enumerate(ODD)] + [(None, "no id here")]
    out = P.op9_packing(spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, offset int").repartition(3)).collect()
    t = tokenizer()
    ids = {i: np.array(t.encode(x or "", add_special_tokens=False).ids + [1], "<u4") for i, x in rows}
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in out:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    assert pieces.keys() == ids.keys()
    for i, ps in pieces.items():
        ps.sort(key=lambda r: r.start)
        assert [p.start for p in ps] == np.cumsum([0] + [p.length for p in ps[:-1]]).tolist() and sum(p.length for p in ps) == len(ids[i])
        for p in ps:
            assert p.doc_tokens == len(ids[i]) and p.ids_crc32 == zlib.crc32(ids[i][p.start : p.start + p.length].tobytes())
    padding = total = 0
    for ps in sequences.values():
        ps.sort(key=lambda r: r.offset)
        assert [p.offset for p in ps] == np.cumsum([0] + [p.length for p in ps[:-1]]).tolist()
        n = sum(p.length for p in ps)
        assert 0 < n <= 2048
        padding += 0 if n & (n - 1) == 0 else 2048 - n
        total += n
    assert padding / total < 0.03
    assert P.op9_packing(spark.createDataFrame([], "doc_id long, text string")).collect() == []


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet=" \t\nab'1.é <|>Z", max_size=40))
def test_units_give_the_tokenizer_s_ids(text):
    ids = test_units_give_the_tokenizer_s_ids.__dict__.setdefault("ids", P.Ids(P.tokenizer_path()))
    assert ids.encode(text)[0].tolist() == ids.tokenizer.encode(text, add_special_tokens=False).ids + [1]


def test_ids_of_whole_texts_and_many_strings(spark):
    """Both encoders against the tokenizer itself: every document of a table, and strings of likely troublemakers."""
    ids = P.Ids(P.tokenizer_path())
    texts = [r.text or "" for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").collect()]
    rng, signs = random.Random(9), ["  ", " ", "\n", "\t", "'s", "'LL", "12", "3", ".", "...", "word", "Wörd", "é", "漢", "<", "|>", "_", "-", "\u00a0", "\u200b", "ABC", "a"]
    texts += ["".join(rng.choice(signs) for _ in range(rng.randrange(1, 30))) for _ in range(20_000)]
    for at in range(0, len(texts), 2000):
        part = texts[at : at + 2000]
        for text, want in zip(part, ids.tokenizer.encode_batch(part, add_special_tokens=False), strict=True):
            assert ids.encode(text)[0].tolist() == want.ids + [1]


def test_runs_of_every_white_space_stay_whole():
    """A run may mix blanks with other white space, of Unicode too; it is never cut inside."""
    ids = P.Ids(P.tokenizer_path())
    texts = ["a\xa0 \xa0\nb", "\x85 \x85 x"] + [f"a{s} {t}b {s}{s} c{t} " for s in P.SPACES + "\x1c\x1f" for t in P.SPACES]
    rng = random.Random(4)
    texts += ["".join(rng.choice(P.SPACES + "  \x1c\u200bab'é1") for _ in range(rng.randrange(1, 20))) for _ in range(20_000)]
    for text, want in zip(texts, ids.tokenizer.encode_batch(texts, add_special_tokens=False), strict=True):
        assert ids.encode(text)[0].tolist() == want.ids + [1]


def brute(places, penalties, window):
    best, back = [0.0] + [float("inf")] * (len(places) - 1), [0] * len(places)
    for j in range(1, len(places)):
        for i in range(j):
            n = places[j] - places[i]
            if n <= window:
                cost = best[i] + (0 if n & (n - 1) == 0 else window - n) + (penalties[j] if j < len(places) - 1 else 0)
                if cost < best[j]:
                    best[j] = cost
    return best[-1]


def test_plan_is_optimal():
    rng = random.Random(2)
    for _ in range(200):
        window = rng.choice([16, 32])
        places = [0]
        while len(places) < rng.randrange(2, 40):
            places.append(places[-1] + rng.randrange(1, window + 1))
        penalties = [rng.choice([0.0, 4.0, 9.0]) for _ in places]
        cuts = P.plan(places, penalties, window)
        cost = sum((0 if (n := places[b] - places[a]) & (n - 1) == 0 else window - n) + (penalties[b] if b < len(places) - 1 else 0) for a, b in zip(cuts, cuts[1:], strict=False))
        assert cuts[0] == 0 and cuts[-1] == len(places) - 1 and cost == brute(places, penalties, window)


def test_stream_is_bounded():
    stream = P.Stream(0, horizon=4096)
    rows = []
    for k in range(300):
        rows += stream.add(k, np.full(97 + k, 7, np.uint32), np.arange(10, 97 + k, 10))
        assert stream.held < 2 * 4096 + 500
    rows += stream.write(True)
    assert sum(r[2] for r in rows) == sum(97 + k for k in range(300)) and [r[0] for r in rows] == sorted(r[0] for r in rows)
