"""Packing token streams into windows by order-preserving dynamic programming.

Documents stay in order; a task's documents are one stream of token ids. Windows of at most ``window``
tokens are cut at ends of documents (free), ends of sentences (a small penalty) or, where a sentence is
long, at fixed strides (a larger penalty). The plan minimises padding plus penalties:
f(j) = penalty(j) + min over i of f(i) + padding(j - i), where padding is window - length, so that
the best i within reach is a sliding minimum of f(i) + i, kept by a monotone queue. A length that is a
power of two is not padded; those few i are looked up beside the queue.

The stream is planned in pieces of about ``HORIZON`` tokens: windows that end well before the end of a
piece are written, the rest is planned again with what follows, so memory is bounded and only the end of
a task's stream can be short.

Defined results: a null or empty text is the end id alone; an empty table gives no rows; rows that repeat a
doc_id are packed each; other columns are ignored. Sequence ids are unique over tasks, not gapless.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections import deque
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW = 2048
END_ID = 1
HORIZON = 1 << 16
STRIDE = 64
SENTENCE_PENALTY, STRIDE_PENALTY = 4.0, 48.0
CACHE = 600_000
TOKENIZER = "byte_bpe_50k.json"

#: Latin letters of every kind, digits, marks and white space: no letter class differs between the encoders here.
COMMON = re.compile("[\x00-\u024f\u2010-\u2027\u20ac]*")
#: What the tokenizer takes for white space; Python's own also has 0x1C to 0x1F.
SPACES = "\t\n\v\f\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
UNITS = re.compile(f"[{SPACES}]*[^{SPACES}]+|[{SPACES}]+\\Z")
#: A blank behind white space begins no run, so no unit.
INSIDE_ASCII, INSIDE = ([s + " " for s in some] for some in (SPACES[:6], SPACES))


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_names() -> dict[str, int]:
    """The printable character by which a byte-level vocabulary names each byte: itself, or one from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(others)}


class Ids:
    """Token ids of texts. The tokenizer never joins what is on both sides of a run of white space, save that run's last
    blank with the word behind it; so a text is cut before every run, and what a unit becomes is kept between texts.

    New units of common letters go to a faster encoder over the same vocabulary, whose merges are the ids in rising
    order; others, and those with a <, which may hold a special token, go to the tokenizer itself. Tests hold the two equal.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.quick = self._quick(path)
        self._clear()

    @staticmethod
    def _quick(path: str):
        """None if the vocabulary is not one of merges in the order of their ids."""
        import public_tokenizers
        import tiktoken

        with open(path, encoding="utf-8") as f:
            raw = json.load(f)
        names, vocab = byte_names(), raw["model"].get("vocab")
        special = {t["content"] for t in raw.get("added_tokens") or ()}
        merges = [m.split(" ") if isinstance(m, str) else m for m in raw["model"].get("merges") or ()]
        made = [vocab.get(a + b) for a, b in merges] if isinstance(vocab, dict) else [None]
        plain = {t: k for t, k in vocab.items() if t not in special} if isinstance(vocab, dict) else {}
        if None in made or made != sorted(made) or len(merges) + 256 != len(plain):
            return None
        ranks = {bytes(names[c] for c in t): k for t, k in plain.items()}
        return tiktoken.Encoding("units", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    def _clear(self) -> None:
        self.at: dict[str, int] = {}
        self.flat = np.empty(1 << 16, np.uint32)
        self.used = 0
        self.first = np.empty(1 << 16, np.int64)
        self.size = np.empty(1 << 16, np.int64)
        self.ends = np.empty(1 << 16, bool)

    @staticmethod
    def units(text: str) -> list[str]:
        if not text.endswith(" ") and not any(s in text for s in (INSIDE_ASCII if text.isascii() else INSIDE)):
            head, *rest = text.split(" ")
            return [head, *(" " + r for r in rest)] if head else [" " + r for r in rest]
        return UNITS.findall(text)

    @staticmethod
    def _room(a: np.ndarray, n: int) -> np.ndarray:
        return a if n <= len(a) else np.concatenate([a, np.empty(max(len(a), n - len(a)), a.dtype)])

    def _learn(self, units: list[str]) -> None:
        quick = [u for u in units if self.quick is not None and (u.isascii() or COMMON.fullmatch(u)) and "<" not in u]
        slow = [*{*units}.difference(quick)] if len(quick) < len(units) else []
        for some, encode in ((quick, self.quick), (slow, None)):
            for begin in range(0, len(some), 4096):
                part = some[begin : begin + 4096]
                codes = map(encode, part) if encode else (c.ids for c in self.tokenizer.encode_batch(part, add_special_tokens=False))
                self._keep(part, codes)

    def _keep(self, units: list[str], codes: Iterable[list[int]]) -> None:
        codes = list(codes)
        size = np.fromiter(map(len, codes), np.int64, len(codes))
        upto, k, n = np.cumsum(size), len(self.at), len(units)
        total = int(upto[-1]) if n else 0
        self.flat = self._room(self.flat, self.used + total)
        self.first, self.size, self.ends = (self._room(a, k + n) for a in (self.first, self.size, self.ends))
        self.flat[self.used : self.used + total] = np.fromiter(chain.from_iterable(codes), np.uint32, total)
        self.first[k : k + n], self.size[k : k + n] = self.used + upto - size, size
        self.ends[k : k + n] = [u[-1:] in ".!?\n" for u in units]
        self.used += total
        self.at.update(zip(units, range(k, k + n), strict=True))

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """(ids with the end id, counts of ids before which a sentence ends)."""
        units = self.units(text)
        fresh = {u for u in units if u not in self.at}
        if fresh:
            if len(self.at) + len(fresh) > CACHE and self.at:
                self._clear()
                fresh = set(units)
            self._learn(sorted(fresh))
        k = np.fromiter(map(self.at.__getitem__, units), np.int64, len(units))
        size = self.size[k]
        upto = np.cumsum(size)
        n = int(upto[-1]) if len(units) else 0
        out = np.empty(n + 1, np.uint32)
        out[:n] = self.flat[np.repeat(self.first[k] - (upto - size), size) + np.arange(n)]
        out[n] = END_ID
        return out, upto[self.ends[k]]


@lru_cache(maxsize=2)
def worker_ids(path: str) -> Ids:
    """One for each worker process: its tasks share what units have become, up to CACHE of them."""
    return Ids(path)


def power_starts(places: np.ndarray, window: int) -> dict[int, list[int]]:
    """For each place the earlier places from which its distance is a power of two, at most ``window``; few have any."""
    out: dict[int, list[int]] = {}
    for bit in range(window.bit_length()):
        if 1 << bit <= window:
            want = places - (1 << bit)
            at = np.searchsorted(places, want)
            hit = np.flatnonzero((want >= 0) & (places[np.minimum(at, len(places) - 1)] == want))
            for j, k in zip(hit.tolist(), at[hit].tolist(), strict=True):
                out.setdefault(j, []).append(k)
    return out


def plan(places: list[int], penalties: list[float], window: int = WINDOW) -> list[int]:
    """Indices of the cuts, from the first place to the last, of least padding plus penalties.

    ``places`` rise from 0 by at most ``window``; the penalty of the last is not counted.
    """
    m = len(places)
    best, back = [0.0] * m, [0] * m
    exact = power_starts(np.asarray(places, np.int64), window)
    queue: deque[tuple[float, int]] = deque([(0.0, 0)])  # f(i) + i rising: the first is the least in reach
    for j in range(1, m):
        p = places[j]
        while places[queue[0][1]] < p - window:
            queue.popleft()
        low, i = queue[0]
        cost = low + window - p
        for k in exact.get(j, ()):
            if best[k] < cost:
                cost, i = best[k], k
        if j < m - 1:
            cost += penalties[j]
        best[j], back[j] = cost, i
        value = cost + p
        while queue and queue[-1][0] >= value:
            queue.pop()
        queue.append((value, j))
    cuts = [m - 1]
    while cuts[-1]:
        cuts.append(back[cuts[-1]])
    return cuts[::-1]


class Stream:
    """Documents in order; ``write`` gives the pieces of all windows that are settled."""

    def __init__(self, base: int, window: int = WINDOW, horizon: int = HORIZON):
        self.window, self.horizon = window, horizon
        self.next = base
        self.docs: deque[tuple[object, np.ndarray, np.ndarray, int]] = deque()  # id, ids, sentence ends, ids already written
        self.held = 0

    def add(self, doc_id: object, ids: np.ndarray, ends: np.ndarray) -> Iterator[tuple]:
        self.docs.append((doc_id, ids, ends, 0))
        self.held += len(ids)
        while self.held >= 2 * self.horizon:
            yield from self.write(False)

    def write(self, last: bool) -> Iterator[tuple]:
        parts, costs, at = [np.zeros(1, np.int64)], [np.zeros(1)], 0
        for _, ids, ends, done in self.docs:
            n = len(ids) - done
            here = np.arange(STRIDE, n, STRIDE)
            inner = ends[(ends > done) & (ends < len(ids))] - done
            place = np.union1d(np.r_[here, inner], [n]).astype(np.int64)
            cost = np.full(len(place), STRIDE_PENALTY)
            cost[np.isin(place, inner)] = SENTENCE_PENALTY
            cost[-1] = 0
            parts.append(place + at)
            costs.append(cost)
            at += n
            if at >= 2 * self.horizon and not last:
                break
        if at == 0:
            return
        places = np.concatenate(parts)
        cuts = plan(places.tolist(), np.concatenate(costs).tolist(), self.window)
        stops = places[cuts][1:]
        if not last:
            stops = stops[stops <= at - self.horizon // 8]
        begin = 0
        for stop in stops.tolist():
            offset = 0
            while begin < stop:
                doc_id, ids, ends, done = self.docs[0]
                n = min(len(ids) - done, stop - begin)
                piece = ids[done : done + n]
                yield doc_id, done, n, zlib.crc32(piece.astype("<u4").tobytes()), len(ids), self.next, offset
                offset += n
                begin += n
                if done + n == len(ids):
                    self.docs.popleft()
                else:
                    self.docs[0] = (doc_id, ids, ends, done + n)
            self.next += 1
        self.held -= begin


NAMES = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


def _pack(path: str | None, window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = worker_ids(path or tokenizer_path())
        stream = Stream(TaskContext.get().partitionId() << 33, window)
        rows: list[tuple] = []

        def out() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], NAMES)
            rows.clear()
            return batch

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                rows.extend(stream.add(doc_id, *ids.encode(text or "")))
                if len(rows) > 20_000:
                    yield out()
        rows.extend(stream.write(True))
        if rows:
            yield out()

    return run


def packed(docs: DataFrame, tokenizer: str | None = None, window: int = WINDOW, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset. One pass, no shuffle."""
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(_pack(tokenizer, window), ", ".join(f"`{c}` long" for c in NAMES))


def op9_packing(docs: DataFrame) -> DataFrame:
    return packed(docs)
