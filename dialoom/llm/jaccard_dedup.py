"""Near-duplicates by exact Jaccard similarity of word shingles: every pair at ``SIMILAR`` or more is linked.

Prefix filtering: with the shingles of all texts in one order, two sets of that similarity share one of the
first n - ceil(0.8 n) + 1 shingles of either. Any common order gives the same links; common shingles
come last, so few texts meet at a shingle that says little. Texts that meet are candidates where their sizes
and sketches leave the similarity possible, and a candidate counts only after its whole sets were compared.

A sketch has a bit for each of SKETCH classes of shingles: whether their number in the set is odd. A shingle that only
one of two sets has changes one bit, so sketches differ in no more bits than the sets in shingles, and no similar
pair is lost; unrelated texts of up to about 2,000 shingles differ in more bits than similar ones may.

A group of many near copies would meet in pairs of its size squared. First every text is compared with one
leader of each of its shingles, in rounds; then with all others that it meets and that stand in other
components. Pairs inside a component are left out: they cannot change it.

Defined results: texts of fewer than SHINGLE words are one shingle; null and empty texts and white space alone
are equal to each other; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import connected_components, cut_lineage, majority, most_frequent, release, shingle_hashes

SHINGLE = 5
#: The similarity as a fraction of whole numbers, so that no rounding decides a pair.
SIMILAR = (4, 5)
#: Shingles known as common, for their order alone; what is not among them is in order of its hash.
COMMON = 1 << 17
#: Leaders are tried where more pairs than this for each meeting are left to compare, and again while a round doubles the links.
ROUNDS, PAIRS_EACH = 4, 16
#: Bytes of a shingle's hash that travel: two texts of 1,000 shingles have one falsely in common once in a million pairs.
SENT = 5
#: Size of the filter that keeps texts without candidates out of a shuffle: 4 MB, whatever the number of candidates.
FILTER_BITS = 25
#: Bits of a sketch, in whole longs.
SKETCH = 1 << 10
PARTS = [f"s{k}" for k in range(SKETCH // 64)]
#: Longs of a folded sketch, which goes along with a text's shingles: enough for texts of up to about 500.
FOLDED = [f"f{k}" for k in range(4)]


def shingle_set(text: bytes | None) -> np.ndarray:
    return np.unique(shingle_hashes(text or b"", SHINGLE))


def prefix_size(n: int) -> int:
    """Shingles of a set of n of which a similar set must share one."""
    num, den = SIMILAR
    return n - -(-num * n // den) + 1 if n else 0


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both * SIMILAR[1] >= SIMILAR[0] * (len(a) + len(b) - both)


def sketch(found: np.ndarray) -> np.ndarray:
    """Of distinct hashes: whether an odd number falls into each class."""
    odd = np.bincount((found & np.uint64(SKETCH - 1)).astype(np.int64), minlength=SKETCH) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view("<i8")


def _close(n: str, parts: list[str], other_n: str, other_parts: list[str]) -> Column:
    """Whether two sketches leave the similarity possible: similar sets differ in at most (den - num) of num + den parts of both."""
    num, den = SIMILAR
    differing = sum((F.bit_count(F.col(a).bitwiseXOR(F.col(b))) for a, b in zip(parts, other_parts, strict=True)), F.lit(0))
    return differing * (num + den) <= (F.col(n) + F.col(other_n)) * (den - num)


def _texts(batch: pa.RecordBatch) -> list[bytes | None]:
    return batch.column("_text").cast(pa.binary()).to_pylist()


def _count_common(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(token, n) of the shingles that come three times or more among a few million."""
    held, size = [], 0

    def flush() -> pa.RecordBatch:
        token, n = np.unique(np.concatenate([*held, np.empty(0, np.uint64)]), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(token[n > 2].view(np.int64)), pa.array(n[n > 2])], ["token", "n"])

    for batch in batches:
        for text in _texts(batch):
            held.append(shingle_set(text))
            size += len(held[-1])
            if size > 4_000_000:
                yield flush()
                held, size = [], 0
    yield flush()


def _lists(parts: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, parts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([*parts, np.empty(0, np.int64)])))


def _prefixes(common):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token, often = common.value
        for batch in batches:
            nodes, sizes, rare, often_met, prints, sketches = [], [], [], [], [], []
            for text in _texts(batch):
                hashes = shingle_hashes(text or b"", SHINGLE)
                prints.append(majority(hashes))
                found = np.unique(hashes)
                nodes.append(xxhash.xxh64_intdigest(found.tobytes()) if len(found) else 0)
                sizes.append(len(found))
                sketches.append(sketch(found))
                rank = np.zeros(len(found), np.int64)
                if len(token):
                    at = np.minimum(np.searchsorted(token, found), len(token) - 1)
                    rank = np.where(token[at] == found, often[at], 0)
                first = np.lexsort((found, rank))[: prefix_size(len(found))]
                rare.append(found[first[rank[first] == 0]].view(np.int64))
                often_met.append(found[first[rank[first] > 0]].view(np.int64))
            by_part = np.array(sketches, np.int64).reshape(-1, len(PARTS)).T
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), batch.column("_h"), pa.array(np.array(nodes, np.uint64).view(np.int64)), pa.array(sizes, pa.int32()), _lists(rare), _lists(often_met), pa.array(np.array(prints, np.uint64).view(np.int64)), *[pa.array(np.ascontiguousarray(x)) for x in by_part]],
                ["_id", "_h", "node", "n", "rare", "common", "fp", *PARTS],
            )

    return run


def _meeting(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows in order of token, n: those beside a row of the same token and of a size that leaves the similarity possible."""
    num, den = SIMILAR
    held, decided = None, 0  # the last row waits for its successor, the one before it only tells
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = pa.Table.from_batches([batch] if held is None else [held, batch]).combine_chunks().to_batches()[0]
        token, n = (rows.column(c).to_numpy(zero_copy_only=False) for c in ("token", "n"))
        beside = (token[1:] == token[:-1]) & (n[:-1].astype(np.int64) * den >= n[1:].astype(np.int64) * num)
        keep = np.r_[False, beside] | np.r_[beside, False]
        yield rows.filter(pa.array(keep)).slice(0, 0) if rows.num_rows - 1 <= decided else rows.slice(decided, rows.num_rows - 1 - decided).filter(pa.array(keep[decided:-1]))
        held = rows.slice(max(0, rows.num_rows - 2))
        decided = held.num_rows - 1
    if held is not None and held.num_rows == 2:
        token, n = held.column("token").to_pylist(), held.column("n").to_pylist()
        if token[0] == token[1] and n[0] * den >= n[1] * num:
            yield held.slice(1)


def packed_set(hashes: np.ndarray) -> bytes:
    """The set by SENT of each hash's bytes, which is what sets are compared by."""
    return np.unique(hashes & np.uint64((1 << 8 * SENT) - 1)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :SENT].tobytes()


def unpacked_set(data: bytes) -> np.ndarray:
    parts = np.frombuffer(data, np.uint8).reshape(-1, SENT)
    whole = np.zeros((len(parts), 8), np.uint8)
    whole[:, :SENT] = parts
    return whole.reshape(-1).view("<u8")


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array([packed_set(shingle_set(t)) for t in _texts(batch)], pa.binary())], ["node", "hashes"])


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        a, b = batch.column("set_a").to_pylist(), batch.column("set_b").to_pylist()
        yield batch.select(["a", "b"]).filter(pa.array([similar(unpacked_set(x), unpacked_set(y)) for x, y in zip(a, b, strict=True)], pa.bool_()))


def key_of(doc_id: str, text_hash: str) -> Column:
    return F.xxhash64(doc_id, text_hash)


def among_keys(keys: DataFrame):
    """A test whether a key may be among ``keys`` (key long): a filter of FILTER_BITS bits that misses none, whatever their number."""
    mask = (1 << FILTER_BITS) - 1
    places = keys.select(F.explode(F.array(F.col("key").bitwiseAND(F.lit(mask)), F.shiftrightunsigned("key", 32).bitwiseAND(F.lit(mask)))).alias("p"))
    words = places.groupBy(F.shiftright("p", 6).alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, int(p & 63))")).alias("bits")).collect()  # 2^(FILTER_BITS - 6) rows at most
    table = np.zeros(1 << (FILTER_BITS - 6), np.int64)
    if words:
        table[[r["w"] for r in words]] = [r["bits"] for r in words]
    shared = keys.sparkSession.sparkContext.broadcast(table)

    @F.pandas_udf("boolean")
    def among(key: pd.Series) -> pd.Series:
        k, bits = key.to_numpy().view(np.uint64), shared.value.view(np.uint64)
        found = np.ones(len(k), bool)
        for shift in (0, 32):
            p = (k >> np.uint64(shift)) & np.uint64(mask)
            found &= (bits[(p >> np.uint64(6)).astype(np.int64)] >> (p & np.uint64(63)) & np.uint64(1)).astype(bool)
        return pd.Series(found)

    return among


def _sketches(prints: DataFrame) -> DataFrame:
    """(node, n, PARTS), once for each set."""
    return prints.select("node", "n", *PARTS).dropDuplicates(["node"])


def _folded(prints: DataFrame) -> DataFrame:
    """(node, FOLDED): sketches of fewer classes, which are those of SKETCH taken together."""
    sketches = _sketches(prints)
    return sketches.select("node", *[reduce(Column.bitwiseXOR, [F.col(c) for c in PARTS[k :: len(FOLDED)]]).alias(f) for k, f in enumerate(FOLDED)])


def _verified(pairs: DataFrame, prints: DataFrame, docs: DataFrame) -> DataFrame:
    """Of the candidates (a, b) those whose whole sets are similar; each set is made from one text that has it.

    Sketches are compared first, so few sets are made and travel.
    """
    sketches = _sketches(prints)
    one = lambda x: sketches.select(F.col("node").alias(x), *[F.col(c).alias(f"{x}_{c}") for c in ("n", *PARTS)])
    possible = _close("a_n", [f"a_{c}" for c in PARTS], "b_n", [f"b_{c}" for c in PARTS])
    pairs = cut_lineage(pairs.join(one("a"), "a").join(one("b"), "b").where(possible).select("a", "b"))
    nodes = pairs.select("a").unionByName(pairs.select(F.col("b").alias("a"))).distinct().withColumnRenamed("a", "node")
    there = cut_lineage(prints.select("node", "_id", "_h").join(nodes, "node", "left_semi").groupBy("node").agg(F.min(F.struct("_id", "_h")).alias("x")).select("node", "x._id", "x._h"))
    among = among_keys(there.select(key_of("_id", "_h").alias("key")))
    texts = docs.select(F.col("doc_id").cast("long").alias("__id"), F.xxhash64("text").alias("__h"), F.col("text").alias("_text")).where(among(key_of("__id", "__h")))
    sets = texts.join(there, F.col("__id").eqNullSafe(F.col("_id")) & (F.col("__h") == F.col("_h"))).select("node", "_text").mapInArrow(_sets, "node long, hashes binary")
    sets = cut_lineage(sets)
    side = lambda x: sets.select(F.col("node").alias(x), F.col("hashes").alias(f"set_{x}"))
    # Rows that repeat an id and text give a set more than once, and so a link.
    return cut_lineage(pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "set_a", "set_b").mapInArrow(_verify, "a long, b long").distinct())


def _possible(joined: DataFrame) -> DataFrame:
    """Candidates (a, b): pairs whose sizes, shared shingles so far and what is left behind the last of them leave the similarity possible."""
    num, den = SIMILAR
    joined = joined.where(F.least("n", "l_n") * den >= F.greatest("n", "l_n") * num)
    # Before the first shared shingle nothing is shared. Those that meet this bound are the first ones of their pair, so the count below holds.
    joined = joined.where(F.least(F.col("n") - F.col("i"), F.col("l_n") - F.col("l_i")) * (num + den) >= (F.col("n") + F.col("l_n")) * num)
    pairs = joined.groupBy("node", "l_node").agg(F.count(F.lit(1)).alias("k"), F.max("i").alias("i"), F.max("l_i").alias("l_i"), F.first("n").alias("n"), F.first("l_n").alias("l_n"))
    most = F.col("k") + F.least(F.col("n") - F.col("i"), F.col("l_n") - F.col("l_i")) - 1
    pairs = pairs.where(most * (num + den) >= (F.col("n") + F.col("l_n")) * num)
    return pairs.select(F.least("node", "l_node").alias("a"), F.greatest("node", "l_node").alias("b")).distinct()


def _with_roots(meets: DataFrame, links: DataFrame) -> DataFrame:
    roots = connected_components(links)
    return cut_lineage(meets.drop("root").join(roots, "node", "left").select("token", "node", "n", "i", F.coalesce("root", "node").alias("root")))


def near_links(prints: DataFrame, docs: DataFrame, proposed: DataFrame) -> DataFrame:
    """Links (a, b) between sets that span every group of similar sets in ``prints`` (of ``prints_of``).

    ``proposed`` (a, b) are checked first. They and the rounds with leaders may miss a pair, whose shingles can have
    several leaders; the last comparison misses none.
    """
    rows = lambda kind, before: prints.select(F.posexplode(kind).alias("i", "token"), "node", "n", before.alias("b")).select("token", "node", "n", (F.col("i") + F.col("b")).alias("i"))
    rare = rows("rare", F.lit(0)).repartition(F.col("token")).sortWithinPartitions("token", "n").mapInArrow(_meeting, "token long, node long, n int, i int")
    # Common shingles surely meet: they are not dealt out to find that.
    meets = rare.unionByName(rows("common", F.size("rare"))).dropDuplicates(["token", "node"])
    links = _verified(proposed, prints, docs)
    meets = _with_roots(meets.select("token", "node", "n", "i"), links)
    release(docs.sparkSession)
    by_root = meets.groupBy("token", "root").agg(F.count(F.lit(1)).alias("k")).groupBy("token").agg(F.sum("k").alias("k"), F.sum(F.col("k") * F.col("k")).alias("kk"))
    left = by_root.agg(F.sum((F.col("k") * F.col("k") - F.col("kk")) / 2).alias("pairs"), F.sum("k").alias("k")).first()
    before = links.count()
    for k in range(ROUNDS if (left["pairs"] or 0) > PAIRS_EACH * (left["k"] or 0) else 0):
        lead = meets.groupBy("token").agg(F.min(F.struct(F.xxhash64("node", F.lit(k)), "node", "n", "i", "root")).alias("l"), F.min("root").alias("low"), F.max("root").alias("high"))
        lead = lead.where("low < high").select("token", *[F.col(f"l.{c}").alias(f"l_{c}") for c in ("node", "n", "i", "root")])
        found = _verified(_possible(meets.join(lead, "token").where("root <> l_root")), prints, docs)
        links = links.unionByName(found)
        meets = _with_roots(meets, links)
        release(docs.sparkSession)
        # What is left then is mostly unlike, and sketches tell that.
        new = found.count()
        if not new or new < before:
            break
        before += new
    mixed = meets.groupBy("token").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high").select("token")
    rest = meets.join(mixed, "token").join(_folded(prints), "node")
    other = rest.select("token", *[F.col(c).alias(f"l_{c}") for c in ("node", "n", "i", "root", *FOLDED)])
    both = rest.join(other, "token").where("root < l_root").where(_close("n", FOLDED, "l_n", [f"l_{c}" for c in FOLDED]))
    return links.unionByName(_verified(_possible(both), prints, docs))


def prints_of(docs: DataFrame) -> DataFrame:
    """(_id, _h, node, n, rare, common, fp, PARTS) of each document: its shingle set's hash and size, what it must share with similar sets, its fingerprint, its sketch."""
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("_id"), F.xxhash64("text").alias("_h"), F.col("text").alias("_text"))
    counts = cut_lineage(texts.select("_text").mapInArrow(_count_common, "token long, n long").groupBy("token").agg(F.sum("n").alias("n")))
    often = most_frequent(counts, "n", COMMON).collect()
    token = np.array([r["token"] for r in often], np.int64).view(np.uint64)
    order = np.argsort(token)
    common = spark.sparkContext.broadcast((token[order], np.array([r["n"] for r in often], np.int64)[order]))
    return texts.mapInArrow(_prefixes(common), "_id long, _h long, node long, n int, rare array<long>, common array<long>, fp long, " + ", ".join(f"{s} long" for s in PARTS))
