"""Disguised words are found wherever they stand in long runs and long tokens."""

import random
import time

from dialoom.llm import toxicity as T

WORDS = "stupid idiot house garden window people river morning winter market".split()
MODEL = T.char_model(T.trigrams(" ".join(WORDS * 50)).reshape(T.SIZE, T.SIZE, T.SIZE))


def run_of(word, before, after):
    rng = random.Random(3)
    words = "house garden window people river morning winter market".split()
    side = lambda n: "".join(rng.choice(words) for _ in range(n))
    return " ".join(side(before) + word + side(after))


def test_middle_of_a_long_run():
    for before, after in ((2, 2), (40, 40), (400, 10)):
        assert "stupid" in T.Reader(MODEL).read(run_of("stupid", before, after))


def test_look_alikes_inside_a_run():
    for before, after in ((2, 2), (40, 40)):
        assert "stupid" in T.Reader(MODEL).read(run_of("stup1d", before, after))


def test_behind_the_256th_character():
    long = "house" * 60
    assert T.restore(long + "stup1d", MODEL).endswith("stupid")
    assert T.restore(".".join(long + "idiot"), MODEL).endswith("idiot")


def test_long_tokens_take_linear_time():
    start = time.monotonic()
    assert T.restore("h0use" * 8000, MODEL)
    assert time.monotonic() - start < 20
