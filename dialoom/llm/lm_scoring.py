"""Language-model scores by online logistic context mixing, and a smoothed word-count baseline.

Tokens are words and one end for each text. A token is coded in binary decisions along a Huffman path: its
leaves are the most frequent training words (``DICTIONARY`` at most), the end, and ``CLASSES`` classes that all other
words fall into by a hash. Every decision is predicted by several hashed contexts (none, the last frequent
word, the last symbol) and by what followed the same two symbols earlier in the same
text. Each predictor's log odds are weighted by a gate, chosen by how often its context was seen, and
summed; the sum gives the probability. The gated weights are refined online while the training texts are
counted: every group of texts is predicted before its counts are added, and the weights
follow the gradient, so they learn from all training texts. While a text is scored, its own scale
for every predictor follows the gradient too, segment by segment; the segments double from 16 tokens on.

Behind a class, a known word has its training count less a discount, out of its class; the unknown words of
a class have all its discounts together. These counts are a table of all training words: it grows with the
corpus, and is joined, word by word. All probabilities sum to 1 over the baseline's events, in every context.
``bits_per_byte`` adds the price of spelling each unknown word, bit by bit, from its last one to four bytes.

Context counts come from all training texts, whatever their number: each task adds up its own tables, and
they are merged slot by slot. The tables have a slot for each training token, up to 2^``SLOT_BITS``: at that
size, the dictionary, the tables and the weights take about 30 MB, which is what is broadcast at most.

Defined results: a null text counts as empty and consists of the end; a null doc_id is never held out;
rows that repeat an id stay rows of their own; without training texts every count is 0 and all decisions are
even; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER_AZ, cut_lineage, most_frequent

DICTIONARY = 1 << 16
#: Hash classes of the words outside the dictionary; a power of two.
CLASSES = 1 << 10
SLOT_BITS = 22
SPELL_BITS = 18
FREQUENT = 512
END = 0
TABLES = 2
INPUTS = 2 + TABLES  # none, frequent, last, match
GATES = 8
#: A slot's code: its gate, and its log odds in steps of 1 / STEPS.
LEVEL_BITS, STEPS = 10, 32
SPELL_ORDERS = 4
END_TOKEN = b" "  # no word holds a blank
PIECES = 64
CLIP = 14.0


def held_out(doc_id):
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 7 == 2, F.lit(False))


def tokens_of(data: bytes | None) -> list[bytes]:
    return (data or b"").translate(LOWER_AZ).split()


def class_of(word: bytes) -> int:
    return xxhash.xxh64_intdigest(word, 42) % CLASSES


# --- the code -------------------------------------------------------------------------------------


class Code:
    """Huffman paths of the end (symbol 0), the dictionary's words and the classes: nodes from the root, and the bit taken at each."""

    def __init__(self, words: list[bytes], weights: list[int], classes: list[int], end: int, slot_bits: int = SLOT_BITS):
        self.ids = {w: k + 1 for k, w in enumerate(words)}
        self.first_class = len(words) + 1
        self.slot_bits = slot_bits
        every = [max(1, w) for w in (end, *weights, *classes)]
        n = len(every)
        heap = [(w, k) for k, w in enumerate(every)]
        heapq.heapify(heap)
        parent, bit = [0] * (2 * n - 1), [0] * (2 * n - 1)
        for node in range(n, 2 * n - 1):
            (a, x), (b, y) = heapq.heappop(heap), heapq.heappop(heap)
            parent[x], parent[y], bit[y] = node, node, 1
            heapq.heappush(heap, (a + b, node))
        root = 2 * n - 2
        nodes, bits, starts = [], [], [0]
        for k in range(n):
            path, x = [], k
            while x != root:
                path.append((parent[x] - n, bit[x]))
                x = parent[x]
            for node, taken in reversed(path):
                nodes.append(node)
                bits.append(taken)
            starts.append(len(nodes))
        self.n = n
        self.nodes, self.bits, self.starts = np.array(nodes, np.int32), np.array(bits, np.int32), np.array(starts, np.int32)
        self.signs = (2 * self.bits - 1).astype(np.float32)
        self.lengths = np.diff(self.starts)
        self.node_hash = _hashed(self.nodes.astype(np.uint64) + np.uint64(1 << 33), slot_bits)
        frequent = np.argsort(-np.array(every[: self.first_class]), kind="stable")[: FREQUENT + 1]
        self.frequent = np.zeros(n, bool)
        self.frequent[frequent] = True
        self.frequent[END] = False
        # Without a context: how often each node took either bit.
        plain = np.zeros(2 * n, np.uint64)
        seen = np.array([end, *weights, *classes], np.uint64)
        np.add.at(plain, self.nodes * 2 + self.bits, np.repeat(seen, self.lengths))
        self.plain = slot_codes(plain)

    def spread(self, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(decisions of each token, place of each decision in the paths)."""
        lengths = self.lengths[symbols]
        upto = np.cumsum(lengths, dtype=np.int32)
        at = np.repeat(self.starts[symbols] - upto + lengths, lengths)
        at += np.arange(len(at), dtype=np.int32)
        return lengths, at

    def encode(self, split: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray, list[list[bytes]]]:
        """(symbols of all texts, each with its end; first token of each text; each text's words outside the dictionary)."""
        sizes = np.array([len(words) + 1 for words in split], np.int64)
        ends = np.cumsum(sizes)
        out = np.full(int(ends[-1]) if len(ends) else 0, END, np.int32)
        outside, ids, first = [], self.ids, self.first_class
        for words, end, n in zip(split, ends.tolist(), sizes.tolist(), strict=True):
            here = np.fromiter(map(ids.get, words, repeat(-1)), np.int32, n - 1)
            rare = np.flatnonzero(here < 0).tolist()
            those = [words[k] for k in rare]
            if rare:
                here[rare] = [first + class_of(w) for w in those]
            out[end - n : end - 1] = here
            outside.append(those)
        return out, ends - sizes, outside


def _hashed(x: np.ndarray, bits: int) -> np.ndarray:
    h = (x + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return (h >> np.uint64(64 - bits)).astype(np.int32)


def contexts(symbols: np.ndarray, starts: np.ndarray, code: Code, matches: bool = True) -> tuple[np.ndarray, np.ndarray | None]:
    """((TABLES, n) context hashes, (n,) predicted symbol or -1) of each token; ``starts``: where texts begin."""
    n = len(symbols)
    rows = np.arange(n, dtype=np.int32)
    one = np.empty_like(symbols)
    one[1:] = symbols[:-1]
    one[starts] = END
    # The last frequent word of the same text before each token.
    last = np.empty(n, np.int32)
    last[1:] = np.maximum.accumulate(np.where(code.frequent[symbols], rows, -1))[:-1]
    last[0] = -1
    sizes = np.diff(np.r_[starts, n])
    first = np.repeat(starts.astype(np.int32), sizes)
    frequent = np.where(last >= first, symbols[np.maximum(last, 0)], END)
    ctx = np.stack([_hashed(frequent.astype(np.uint64) | np.uint64(1 << 60), code.slot_bits), _hashed(one.astype(np.uint64) | np.uint64(1 << 61), code.slot_bits)])
    if not matches:
        return ctx, None
    # What followed the same two tokens earlier in the text (classes predict nothing).
    two = np.empty_like(symbols)
    two[1:] = one[:-1]
    two[starts] = END
    key = (np.repeat(np.arange(len(starts)), sizes) << 40) | (one.astype(np.int64) << 20) | two
    order = np.argsort(key, kind="stable")
    same = np.flatnonzero(key[order[1:]] == key[order[:-1]])
    match = np.full(n, -1, np.int32)
    match[order[same + 1]] = symbols[order[same]]
    match[(match >= code.first_class) | (one >= code.first_class)] = -1
    match[starts] = -1
    return ctx, match


# --- counting --------------------------------------------------------------------------------------


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, c): occurrences, the end among the words."""
    counts: Counter = Counter()

    def flush() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], ["word", "c"])

    for batch in batches:
        for data in batch.column("text").cast(pa.binary()):
            counts.update(tokens_of(data.as_py()))
            counts[END_TOKEN] += 1
            if len(counts) > 400_000:
                yield flush()
                counts = Counter()
    yield flush()


def _groups(texts: list[bytes | None], most: int = 1 << 20) -> Iterator[list[int]]:
    """Indices of texts, about ``most`` bytes together."""
    held, size = [], 0
    for k, t in enumerate(texts):
        held.append(k)
        size += len(t or b"") + 8
        if size >= most:
            yield held
            held, size = [], 0
    if held:
        yield held


class Counts:
    """Occurrences of the bits 0 and 1 at the nodes in hashed contexts."""

    def __init__(self, code: Code):
        self.code = code
        self.tables = [np.zeros(2 << code.slot_bits, np.uint32) for _ in range(TABLES)]

    def add(self, symbols: np.ndarray, ctx: np.ndarray, most: int = 1 << 14) -> None:
        for at in range(0, len(symbols), most):  # pieces stay in the processor's cache
            lengths, place = self.code.spread(symbols[at : at + most])
            node_hash = self.code.node_hash[place]
            self.add_at([np.repeat(ctx[k, at : at + most], lengths) ^ node_hash for k in range(TABLES)], self.code.bits[place])

    def add_at(self, where: list[np.ndarray], bit: np.ndarray) -> None:
        """Of each table the slots, and the bits taken there."""
        for table, slots in zip(self.tables, where, strict=True):
            np.add.at(table, slots * 2 + bit, np.uint32(1))

    def slots(self) -> list[np.ndarray]:
        return [slot_codes(t) for t in self.tables]


def slot_codes(counts: np.ndarray) -> np.ndarray:
    """Pairs of counts as codes: gate, then quantised log odds of a 1."""
    n0, n1 = counts[::2].astype(np.float32), counts[1::2].astype(np.float32)
    gate = np.minimum(np.log2(n0 + n1 + 1), GATES - 1).astype(np.uint16)
    odds = np.log((n1 + np.float32(0.05)) / (n0 + np.float32(0.05)))
    half = 1 << (LEVEL_BITS - 1)
    return (gate << np.uint16(LEVEL_BITS)) | np.clip(np.rint(odds * STEPS) + half, 0, 2 * half - 1).astype(np.uint16)


#: Codes of all pairs of counts below 1 << SMALL_BITS, which most pairs are while counts grow: looked up, not worked out again.
SMALL_BITS = 9
SMALL = slot_codes(np.stack([np.repeat(np.arange(1 << SMALL_BITS), 1 << SMALL_BITS), np.tile(np.arange(1 << SMALL_BITS), 1 << SMALL_BITS)], 1).astype(np.uint32).reshape(-1))

#: Of every code: its log odds and its gate.
ODDS = ((np.arange(GATES << LEVEL_BITS) & ((1 << LEVEL_BITS) - 1)) - (1 << (LEVEL_BITS - 1))).astype(np.float32) / STEPS
GATE = (np.arange(GATES << LEVEL_BITS) >> LEVEL_BITS).astype(np.intp)


def first_weights() -> np.ndarray:
    weights = np.zeros((INPUTS, GATES), np.float64)
    weights[:-1] = (np.arange(GATES) + 1) / ((INPUTS - 1.0) * GATES)
    weights[-1] = 0.5
    return weights


class Mixer:
    """Predictions from the slots of the context tables; all of fixed size."""

    def __init__(self, code: Code, slots: list, weights: np.ndarray):
        self.code, self.slots = code, slots
        self.use(weights)

    def use(self, weights: np.ndarray) -> None:
        self.weights = weights
        self.votes = [(weights[k][GATE] * ODDS).astype(np.float32) for k in range(INPUTS - 1)]
        self.match_vote = weights[-1][GATE].astype(np.float32)

    def found(self, symbols: np.ndarray, ctx: np.ndarray, match: np.ndarray, asked: list | None = None) -> tuple[np.ndarray, np.ndarray, list[np.ndarray], np.ndarray, np.ndarray]:
        """(decisions of each token, sign of each bit, slot codes of the other predictors, matched decisions, signs of the matched bits).

        ``asked`` gets the tables' slots and the bits, for ``Counts.add_at``.
        """
        code = self.code
        lengths, place = code.spread(symbols)
        node_hash = code.node_hash[place]
        where = [np.repeat(ctx[k], lengths) ^ node_hash for k in range(TABLES)]
        if asked is not None:
            asked.append((where, code.bits[place]))
        codes = [code.plain[code.nodes[place]], *[self.slots[k][where[k]] for k in range(TABLES)]]
        # Where the matched word's path is still this one's, the bit that it takes.
        who = np.flatnonzero(match >= 0)
        there = match[who]
        both = np.minimum(lengths[who], code.lengths[there])
        upto = np.cumsum(both)
        depth = np.arange(upto[-1] if len(upto) else 0, dtype=np.int32) - np.repeat(upto - both, both)
        a = np.repeat(code.starts[symbols[who]], both) + depth
        b = np.repeat(code.starts[there], both) + depth
        ok = np.flatnonzero(code.nodes[a] == code.nodes[b])
        decision = np.repeat((np.cumsum(lengths) - lengths)[who], both)[ok] + depth[ok]
        return lengths, code.signs[place], codes, decision, code.signs[b[ok]]

    def inputs(self, codes: list[np.ndarray], decision: np.ndarray, sign: np.ndarray) -> list[np.ndarray]:
        x = [votes[c] for votes, c in zip(self.votes, codes, strict=True)]
        x.append(np.zeros(len(codes[0]), np.float32))
        x[-1][decision] = sign * self.match_vote[codes[-1][decision]]
        return x

    def learn(self, symbols: np.ndarray, ctx: np.ndarray, match: np.ndarray, step: int, asked: list | None = None) -> int:
        """Gated weights follow the gradient over texts that the counts leave out; steps follow each gate's curvature."""
        _, signs, codes, decision, matched = self.found(symbols, ctx, match, asked)
        z = sum(self.inputs(codes, decision, matched))
        p = 1 / (1 + np.exp(-np.clip(z, -CLIP, CLIP)))
        err, curve = ((signs + 1) / 2 - p).astype(np.float64), (p * (1 - p)).astype(np.float64)
        rate, weights = 0.2 / (1 + step / 50), self.weights.copy()
        for k in range(INPUTS):
            if k < INPUTS - 1:
                # Summed by code first: all decisions of a code have its odds and gate.
                at = codes[k].astype(np.intp)
                e, c = (np.bincount(at, x, len(ODDS)) for x in (err, curve))
                slope, bend = (e * ODDS).reshape(GATES, -1).sum(1), (c * ODDS * ODDS).reshape(GATES, -1).sum(1)
            else:
                gate = GATE[codes[-1][decision]]
                slope, bend = np.bincount(gate, err[decision] * matched, GATES), np.bincount(gate, curve[decision], GATES)
            weights[k] += rate * slope / (bend + 50)
        self.use(weights)
        return len(signs)

    def score(self, symbols: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Natural logarithm of the probability of each text's symbols."""
        ctx, match = contexts(symbols, starts, self.code)
        sizes = np.diff(np.r_[starts, len(symbols)])
        total = np.zeros(len(starts))
        scale = np.ones((INPUTS, len(starts)), np.float32)
        # Segment by segment through all texts at once; only texts that are long enough stay.
        begun, width = 0, 16
        while len(live := np.flatnonzero(sizes > begun)):
            n = np.minimum(sizes[live] - begun, width)
            upto = np.cumsum(n)
            at = np.repeat(starts[live] + begun - upto + n, n) + np.arange(upto[-1])
            lengths, signs, codes, decision, matched = self.found(symbols[at], ctx[:, at], match[at])
            x = self.inputs(codes, decision, matched)
            ends = np.cumsum(lengths)[upto - 1]
            cuts = np.r_[0, ends[:-1]]
            z = np.zeros(len(signs), np.float32)
            for k in range(INPUTS):
                z += x[k] if not begun else np.repeat(scale[k, live], ends - cuts) * x[k]
            e, away = surprise(z, signs)
            total[live] -= np.add.reduceat(e, cuts, dtype=np.float64)
            if (sizes[live] > begun + width).any():
                err, curve = signs * away, away * (1 - away)
                for k in range(INPUTS):
                    ex = err * x[k]
                    g, h = np.add.reduceat(ex, cuts), np.add.reduceat(curve * x[k] * x[k], cuts) + 60
                    scale[k, live] = np.clip(scale[k, live] + 0.25 * g / h, 0.3, 2)
            begun, width = begun + width, min(128, 2 * width)
        return total


def surprise(z: np.ndarray, signs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(-ln of the probability of each bit, probability of the other bit); log odds are clipped to +-CLIP."""
    e = np.exp(-np.clip(z * signs, -CLIP, CLIP))
    return np.log(1 + e), e / (1 + e)


# --- spelling --------------------------------------------------------------------------------------


def spell_paths(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """((SPELL_ORDERS, n) slots, bit, bits of each word): bytes and a final blank, high bit first."""
    sizes = np.array([len(w) + 1 for w in words], np.int64)
    ends = np.cumsum(sizes)
    data = np.frombuffer(b" ".join(words) + b" ", np.uint8) if words else np.empty(0, np.uint8)
    n = len(data)
    place = np.arange(n) - np.repeat(ends - sizes, sizes)
    history, ctx = np.zeros(n, np.uint64), []
    for order in range(1, SPELL_ORDERS + 1):
        before = np.zeros(n, np.uint64)
        if n > order:
            before[order:] = data[:-order]
        history = (history << np.uint64(8)) | np.where(place >= order, before, np.uint64(32))
        ctx.append((history + np.uint64(order << 40)) * np.uint64(0x9E3779B97F4A7C15))
    bits = np.unpackbits(data[:, None], axis=1)  # (n, 8)
    partial = np.ones((n, 8), np.uint64)
    for k in range(1, 8):
        partial[:, k] = (partial[:, k - 1] << np.uint64(1)) | bits[:, k - 1]
    out = np.empty((SPELL_ORDERS, n * 8), np.int64)
    for k, c in enumerate(ctx):
        h = (c[:, None] ^ (partial * np.uint64(0xD6E8FEB86659FD93))) * np.uint64(0xFF51AFD7ED558CCD)
        out[k] = (h >> np.uint64(64 - SPELL_BITS)).astype(np.int64).reshape(-1)
    return out, bits.reshape(-1).astype(np.int64), sizes * 8


class Speller:
    def __init__(self, codes: list[np.ndarray], weights: np.ndarray):
        self.codes = codes
        self.votes = [(weights[k][GATE] * ODDS).astype(np.float32) for k in range(SPELL_ORDERS)]

    def bits(self, words: list[bytes]) -> list[float]:
        """-log2 of the probability of each word and its end."""
        out: list[float] = []
        for at in range(0, len(words), 2000):
            where, bit, size = spell_paths(words[at : at + 2000])
            z = sum(self.votes[k][self.codes[k][where[k]]] for k in range(SPELL_ORDERS))
            cost, _ = surprise(z, (2 * bit - 1).astype(np.float32))
            out += (np.add.reduceat(cost, np.cumsum(size) - size, dtype=np.float64) / math.log(2)).tolist()
        return out


def spell_weights() -> np.ndarray:
    return np.full((SPELL_ORDERS, GATES), 1 / SPELL_ORDERS) * ((np.arange(GATES) + 1) / GATES)


def _count_spelling(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All distinct training words, each counted once: how words are built. Every piece is predicted before it is counted."""
    tables = [np.zeros(2 << SPELL_BITS, np.uint32) for _ in range(SPELL_ORDERS)]
    weights, fitted, piece = spell_weights(), 0, 0
    for batch in batches:
        words = [w for w in batch.column("word").to_pylist() if w != END_TOKEN]
        for at in range(0, len(words), 2000):
            where, bit, _ = spell_paths(words[at : at + 2000])
            codes = [slot_codes_at(tables[k], where[k]) for k in range(SPELL_ORDERS)]
            z = sum(weights[k][GATE[codes[k]]] * ODDS[codes[k]] for k in range(SPELL_ORDERS))
            p = 1 / (1 + np.exp(-np.clip(z, -CLIP, CLIP)))
            for k in range(SPELL_ORDERS):
                o, gate = ODDS[codes[k]], GATE[codes[k]]
                weights[k] += 0.2 / (1 + piece / 400) * np.bincount(gate, (bit - p) * o, GATES) / (np.bincount(gate, p * (1 - p) * o * o, GATES) + 50)
            fitted += len(bit)
            for k in range(SPELL_ORDERS):
                np.add.at(tables[k], where[k] * 2 + bit, np.uint32(1))
            piece += 1
    for k in range(SPELL_ORDERS):
        yield from _pieces(4 + k, tables[k])
    yield _sums(9, weights * fitted, fitted)


def slot_codes_at(counts: np.ndarray, where: np.ndarray) -> np.ndarray:
    pairs = counts.view("<u8")[where]
    n0, n1 = pairs.astype(np.uint32), (pairs >> np.uint64(32)).astype(np.uint32)
    large = np.flatnonzero((n0 | n1) >> np.uint32(SMALL_BITS))
    out = SMALL.take(((n0 << np.uint32(SMALL_BITS)) | n1) & np.uint32(len(SMALL) - 1))
    if len(large):
        out[large] = slot_codes(pairs[large].view("<u4"))
    return out


# --- tables in pieces ------------------------------------------------------------------------------

KINDS = "kind int, piece int, data binary"
WIDTHS = {1: np.uint8, 2: np.uint16, 4: np.uint32, 8: np.uint64}


def _row(kind: int, piece: int, data: bytes) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([kind], pa.int32()), pa.array([piece], pa.int32()), pa.array([data], pa.binary())], ["kind", "piece", "data"])


def _pieces(kind: int, values: np.ndarray) -> Iterator[pa.RecordBatch]:
    """A table in PIECES parts of one size; the first byte tells the width of its numbers."""
    for k, part in enumerate(values.reshape(PIECES, -1)):
        if most := int(part.max()):
            width = 1 if most < 1 << 8 else 2 if most < 1 << 16 else 4 if most < 1 << 32 else 8
            yield _row(kind, k, bytes([width]) + part.astype(WIDTHS[width]).tobytes())


def _sums(kind: int, weights: np.ndarray, fitted: int) -> pa.RecordBatch:
    return _row(kind, 0, np.r_[weights.reshape(-1), fitted].astype(np.float64).tobytes())


def _count_contexts(shared):
    """Tables of kinds 0 and 1 over all texts of the task, and its weights (kind 8)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = shared.value
        counts, weights, fitted, step = Counts(code), first_weights(), 0, 0
        for batch in batches:
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            for group in _groups(texts, 1 << 18):
                symbols, starts, _ = code.encode([tokens_of(texts[k]) for k in group])
                ctx, match = contexts(symbols, starts, code)
                mixer, asked = Mixer(code, [_At(t) for t in counts.tables], weights), []
                for at in range(0, len(symbols), 8192):
                    cut = slice(at, at + 8192)
                    fitted += mixer.learn(symbols[cut], ctx[:, cut], match[cut], step, asked)
                weights = mixer.weights
                for where, bit in asked:
                    counts.add_at(where, bit)
                step += 1
        for k in range(TABLES):
            yield from _pieces(k, counts.tables[k])
        yield _sums(8, weights * fitted, fitted)

    return run


class _At:
    """Slot codes of counts that still grow: made where they are asked for."""

    def __init__(self, counts: np.ndarray):
        self.counts = counts

    def __getitem__(self, where: np.ndarray) -> np.ndarray:
        return slot_codes_at(self.counts, where)


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums the pieces that meet in this task, none of which is larger than one table's part; counts leave it as slot codes."""
    sums: dict[tuple[int, int], np.ndarray] = {}
    for batch in batches:
        for kind, piece, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            part = np.frombuffer(data, np.float64) if kind >= 8 else np.frombuffer(data, WIDTHS[data[0]], offset=1).astype(np.uint64)
            sums[kind, piece] = sums[kind, piece] + part if (kind, piece) in sums else part
    for (kind, piece), total in sums.items():
        yield _row(kind, piece, (total if kind >= 8 else slot_codes(total)).tobytes())


def _assembled(rows: list, kind: int, slots: int) -> np.ndarray:
    """A table's slot codes; parts without a row were never counted."""
    out = np.full(slots, 1 << (LEVEL_BITS - 1), np.uint16)
    for r in rows:
        if r["kind"] == kind:
            part = np.frombuffer(r["data"], np.uint16)
            out[r["piece"] * len(part) : (r["piece"] + 1) * len(part)] = part
    return out


def _averaged(rows: list, kind: int, default: np.ndarray) -> np.ndarray:
    """Weights of all tasks, by the decisions that each has learned from."""
    total = sum((np.frombuffer(r["data"], np.float64) for r in rows if r["kind"] == kind), np.zeros(default.size + 1))
    return total[:-1].reshape(default.shape) / total[-1] if total[-1] else default


# --- the operator ----------------------------------------------------------------------------------


def dictionary_rows(counts: DataFrame) -> list:
    """(word, c) of the dictionary, in a fixed order. Words seen once stay outside, so that classes are learned from them at every size."""
    top = most_frequent(counts.where(F.col("word") != F.lit(END_TOKEN)), "c", DICTIONARY, 2).collect()
    return sorted(top, key=lambda r: (-r["c"], bytes(r["word"])))


class Scale:
    """What is known of the training tokens: their number, the distinct ones, and for each class the rare words' tokens and types."""

    def __init__(self, n: int, v: int, once: int, twice: int, tokens: list[int], types: list[int]):
        self.n, self.v, self.tokens, self.types = n, v, tokens, types
        self.discount = min(0.95, max(0.1, once / max(1, once + 2 * twice)))
        # log10 of what a class keeps for unknown words; all of it, where no training word is in the class.
        self.unknown = [math.log10(self.discount * k / m) if k else 0.0 for m, k in zip(tokens, types, strict=True)]


def train(rows: DataFrame) -> tuple[Mixer, Speller, DataFrame, np.ndarray, Scale]:
    """(mixer, speller, counts of all training tokens (word, c, rare), counts of the code's symbols, totals) from rows (text, held_out)."""
    spark = rows.sparkSession
    learn = rows.where("not held_out").select("text")
    counts = cut_lineage(learn.mapInArrow(_count_words, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c")))
    top = dictionary_rows(counts)
    words, weights = [bytes(r["word"]) for r in top], [r["c"] for r in top]
    in_dictionary = F.col("c") >= (weights[-1] if top else 1 << 62)
    counts = counts.withColumn("rare", ~in_dictionary & (F.col("word") != F.lit(END_TOKEN)))
    by_class = counts.groupBy("rare", F.when(F.col("rare"), F.pmod(F.xxhash64("word"), F.lit(CLASSES))).otherwise(F.when(F.col("word") == F.lit(END_TOKEN), -1).otherwise(-2)).alias("k"))
    found = by_class.agg(F.sum("c").alias("m"), F.count(F.lit(1)).alias("v"), F.count(F.when(F.col("c") == 1, 1)).alias("once"), F.count(F.when(F.col("c") == 2, 1)).alias("twice")).collect()
    tokens, types, end = [0] * CLASSES, [0] * CLASSES, 0
    for r in found:
        if r["rare"]:
            tokens[r["k"]], types[r["k"]] = r["m"], r["v"]
        elif r["k"] == -1:
            end = r["m"]
    total = lambda c: sum(r[c] for r in found)
    scale = Scale(total("m"), total("v"), total("once"), total("twice"), tokens, types)
    slot_bits = min(SLOT_BITS, max(16, scale.n.bit_length()))
    code = Code(words, weights, tokens, end, slot_bits)
    each = np.array([end, *weights, *[0] * CLASSES], np.float64)
    shared = spark.sparkContext.broadcast(code)
    # A table for each task, not for each file split: a task takes many splits.
    tasks = max(4, 2 * spark.sparkContext.defaultParallelism)
    pieces = learn.coalesce(tasks).mapInArrow(_count_contexts(shared), KINDS)
    spelled = counts.select("word").coalesce(tasks).mapInArrow(_count_spelling, KINDS)
    merged = pieces.unionByName(spelled).repartition("kind", "piece").mapInArrow(_merge, KINDS).collect()
    slots = [_assembled(merged, k, 1 << slot_bits) for k in range(TABLES)]
    speller = Speller([_assembled(merged, 4 + k, 1 << SPELL_BITS) for k in range(SPELL_ORDERS)], _averaged(merged, 9, spell_weights()))
    return Mixer(code, slots, _averaged(merged, 8, first_weights())), speller, counts, each, scale


def _score(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """What a text can tell without the counts of rare words: tokens, known ones and base of the dictionary's words, bits, rare words.

        Only held-out texts can hold unknown words, so only theirs are spelled.
        """
        mixer, speller, logs, known = shared.value
        for batch in batches:
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            names = [c for c in batch.schema.names if c != "text"]
            out_of = batch.column("held_out").to_pylist()
            for group in _groups(texts):
                symbols, starts, outside = mixer.code.encode([tokens_of(texts[k]) for k in group])
                coded = mixer.score(symbols, starts)
                sums, n_known = np.add.reduceat(logs[symbols], starts), np.add.reduceat(known[symbols], starts)
                n_tokens = np.diff(np.r_[starts, len(symbols)])
                words_of, copies, sizes, spell = [], [], [0], []
                for k, those in zip(group, outside, strict=True):
                    rare = Counter(those)
                    words_of += rare.keys()
                    copies += rare.values()
                    sizes.append(len(words_of))
                    if out_of[k]:
                        spell += range(sizes[-2], sizes[-1])
                bits = np.zeros(len(words_of))
                bits[spell] = speller.bits([words_of[k] for k in spell])
                kept = [batch.column(c).take(pa.array(group)) for c in names]
                pairs = pa.StructArray.from_arrays([pa.array(words_of, pa.binary()), pa.array(copies, pa.int64()), pa.array(bits)], ["w", "k", "bits"])
                listed = pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), pairs)
                yield pa.RecordBatch.from_arrays([*kept, pa.array(n_tokens), pa.array(n_known), pa.array(sums), pa.array(coded), listed], [*names, "n_tokens", "n_known", "base", "coded", "rare"])

    return run


def scores(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte.

    ``score`` is over the same events as the baseline: known tokens, and the unknown words of a class as one event each.
    ``bits_per_byte`` spells unknown words too, so it is the price of the whole text.
    """
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), held_out(F.col(key).cast("long")).alias("held_out"), F.octet_length(F.coalesce(F.col(text), F.lit(""))).cast("long").alias("n_bytes"), F.col(text).alias("text"))
    mixer, speller, counts, each, scale = train(rows)
    space = scale.n + scale.v + 1
    logs = np.log10((each + 1) / space)
    logs[mixer.code.first_class :] = 0
    known = (each > 0).astype(np.int64)
    shared = docs.sparkSession.sparkContext.broadcast((mixer, speller, logs, known))
    kinds = "doc_id long, held_out boolean, n_bytes long, n_tokens long, n_known long, base double, coded double, rare array<struct<w:binary,k:long,bits:double>>"
    told = cut_lineage(rows.mapInArrow(_score(shared), kinds).withColumn("row", F.monotonically_increasing_id()))
    # Counts of rare words: one row for each text and distinct word, joined with all counts.
    asked = told.select("row", F.explode("rare").alias("x")).select("row", F.col("x.w").alias("w"), F.col("x.k").alias("k"), F.col("x.bits").alias("bits"))
    in_class = F.pmod(F.xxhash64("word"), F.lit(CLASSES)).cast("int")
    priced = counts.where("rare").select("word", "c", F.log10((F.col("c") - F.lit(scale.discount)) / F.get(F.lit([float(m) for m in scale.tokens]), in_class)).alias("price"))
    found = asked.join(priced, F.col("w") == F.col("word"), "left")
    seen = F.col("c").isNotNull()
    unknown = F.get(F.lit(scale.unknown), F.pmod(F.xxhash64("w"), F.lit(CLASSES)).cast("int"))
    sums = found.groupBy(F.col("row").alias("_row")).agg(
        F.sum(F.col("k") * F.log10((F.coalesce("c", F.lit(0)) + 1) / F.lit(float(space)))).alias("_base"),
        F.sum(F.when(seen, F.col("k")).otherwise(0)).alias("_known"),
        F.sum(F.col("k") * F.when(seen, F.col("price")).otherwise(unknown)).alias("_rare"),
        F.sum(F.when(seen, 0.0).otherwise(F.col("k") * F.col("bits"))).alias("_spelling"),
    )
    out = told.join(sums, F.col("row") == F.col("_row"), "left")
    score = F.col("coded") / F.lit(math.log(10)) + F.coalesce("_rare", F.lit(0.0))
    return out.select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("_known", F.lit(0))).alias("n_known"), F.lit(scale.n).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("_base", F.lit(0.0))).alias("base_score"), score.alias("score"),
        ((F.coalesce("_spelling", F.lit(0.0)) - score * math.log2(10)) / F.greatest(F.col("n_bytes"), F.lit(1))).alias("bits_per_byte"),
    )


def op7_lm_scoring(docs: DataFrame) -> DataFrame:
    return scores(docs)
