"""SimHash near-duplicates by anchor-point covering.

Fingerprints of 64 bits link at 3 or fewer differing bits. Of such a pair, one 32-bit half differs in at
most one bit. Each half is covered by anchors: the words of the perfect Hamming code of length 31, whose
covering radius is 1, with the last bit kept as it is. A fingerprint stands at the anchor nearest to its
half, and is replicated to every anchor within the covering radius plus the threshold of one bit (16
words of the code, or one, and the anchor beyond the last bit). Any linked pair then meets: where one
stands, the other has a replica. What meets at an anchor is compared in full.

Only distinct fingerprints are replicated, so copies cost nothing. Anchors where many stand are first dealt
out by the bytes of the other half, then cut by 16-bit blocks of the fingerprint (of 3 differing bits, one of
four has none), which loses no link. An anchor compares what stands there with all that meets there, and
reports a spanning forest of the links that it found, not all pairs; components come from alternating star
joins.

The query has its contract's shingles and threshold. ``representatives`` is for pipelines: five words, an exact
Jaccard similarity of 0.8 or more.

Defined results: a null or empty text, or one of white space only, has fingerprint zero and links like
any other; null ids form no component of their own but take the smallest id of their group; an empty
table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import jaccard_dedup
from .common import connected_components, cut_lineage, majority, shingle_hashes

SHINGLE = 3
BITS = 3
SEED = 42
#: An anchor with more fingerprints than this is cut by blocks before it is compared.
BLOCK_OVER = 512
#: An anchor where more than this stand is dealt out before it is compared.
SPLIT_OVER = 4096


def _fingerprints(k: int, seed: int, keep: tuple[str, ...] = ("_id",)):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("_text").cast(pa.binary()).to_pylist()
            prints = np.array([0 if t is None else majority(shingle_hashes(t, k, seed)) for t in texts], np.uint64)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(prints.view(np.int64))], [*keep, "fp"])

    return run


def fingerprints(docs: DataFrame, k: int = SHINGLE, seed: int = SEED, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Rows (_id, fp): the fingerprint as a signed long."""
    return docs.select(F.col(key).cast("long").alias("_id"), F.col(text).alias("_text")).mapInArrow(_fingerprints(k, seed), "_id long, fp long")


def _parity_masks() -> np.ndarray:
    """Position p (bit p - 1) of the Hamming code has the column p; row r checks the positions whose bit r is set."""
    return np.array([sum(1 << (p - 1) for p in range(1, 32) if p >> r & 1) for r in range(5)], np.uint32)


def _near_masks() -> np.ndarray:
    """For syndrome s, what to flip to reach each code word at a distance of at most 2: one mask, or sixteen (rows padded with 2^32 - 1)."""
    out = np.full((32, 16), 0xFFFFFFFF, np.uint32)
    out[0, 0] = 0
    for s in range(1, 32):
        pairs = [(i, i ^ s) for i in range(1, 32) if i != s and i < i ^ s]
        out[s] = [1 << (s - 1), *(1 << (i - 1) | 1 << (j - 1) for i, j in pairs)]
    return out


PARITY, NEAR = _parity_masks(), _near_masks()
CODE_BITS = np.uint32((1 << 31) - 1)
LAST_BIT = np.uint32(1 << 31)


def syndromes(half: np.ndarray) -> np.ndarray:
    out = np.zeros(len(half), np.uint32)
    for r, mask in enumerate(PARITY):
        out |= (np.bitwise_count(half & mask).astype(np.uint32) & 1) << np.uint32(r)
    return out


def anchors(half: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(own, of, near): the anchor where each half stands, and the other anchors in reach of half ``of``."""
    s = syndromes(half & CODE_BITS)
    own = half ^ NEAR[s, 0]
    rows = np.arange(len(half))
    flip = NEAR[s][:, 1:]
    there = flip != np.uint32(0xFFFFFFFF)
    of = np.concatenate([np.repeat(rows, there.sum(1)), rows])
    near = np.concatenate([(half[:, None] ^ flip)[there], own ^ LAST_BIT])
    return own, of, near


def _replicas(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        every = batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
        for at in range(0, len(every), 1 << 13):
            fp = every[at : at + (1 << 13)]
            for part in (0, 1):
                half = (fp >> np.uint64(32 * part)).astype(np.uint32)
                own, of, near = anchors(half)
                anchor = np.concatenate([own, near]).astype(np.int64) | (part << 32)
                value = np.concatenate([fp, fp[of]])
                stands = np.concatenate([np.ones(len(own), bool), np.zeros(len(of), bool)])
                yield pa.RecordBatch.from_arrays([pa.array(anchor), pa.array(value.view(np.int64)), pa.array(stands)], ["anchor", "fp", "stands"])


def linked(fp: np.ndarray, stands: np.ndarray, bits: int, group: np.ndarray, at: np.ndarray) -> Iterator[tuple[int, int]]:
    """Spanning links between fingerprints that stand here and all others, compared in rows of blocks. ``group`` tells what is linked already; ``at``: places in it."""
    who = np.flatnonzero(stands)
    for i in range(0, len(who), 256):
        near = np.bitwise_count(fp[who[i : i + 256], None] ^ fp[None, :]) <= bits
        for a, row in zip(who[i : i + 256].tolist(), near, strict=True):
            there = np.flatnonzero(row)
            groups, first = np.unique(group[at[there]], return_index=True)
            own = group[at[a]]
            if len(groups) > 1:
                group[np.isin(group, groups)] = groups[0]
                yield from ((int(at[a]), int(at[there[f]])) for g, f in zip(groups.tolist(), first.tolist(), strict=True) if g != own)


def bucket_links(fp: np.ndarray, stands: np.ndarray, bits: int = BITS) -> list[tuple[int, int]]:
    """Spanning links among the fingerprints that meet at an anchor, at least one of each link standing there."""
    fp, first = np.unique(fp, return_index=True)
    stands, group, out = stands[first], np.arange(len(fp)), []
    if len(fp) <= BLOCK_OVER:
        out = list(linked(fp, stands, bits, group, np.arange(len(fp))))
    else:
        # bits + 1 blocks: at most ``bits`` differing bits leave one block the same.
        edges = np.linspace(0, 64, bits + 2).astype(int)
        for low, high in zip(edges[:-1], edges[1:], strict=True):
            block = (fp >> np.uint64(low)) & np.uint64((1 << int(high - low)) - 1)
            order = np.argsort(block, kind="stable")
            cuts = np.flatnonzero(np.diff(block[order])) + 1
            for run in np.split(order, cuts):
                if len(run) > 1 and stands[run].any():
                    out += linked(fp[run], stands[run], bits, group, run)
    return [(int(fp[a]), int(fp[b])) for a, b in out]


def _compare(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by anchor; an anchor may go on in the next batch."""
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def work(anchor: np.ndarray, fp: np.ndarray, stands: np.ndarray) -> pa.RecordBatch | None:
            first = np.flatnonzero(np.r_[True, anchor[1:] != anchor[:-1]])
            size = np.diff(np.r_[first, len(anchor)])
            has = np.add.reduceat(stands.astype(np.int64), first) > 0  # links are with a fingerprint that stands there
            found = []
            pairs = first[(size == 2) & has]
            near = pairs[np.bitwise_count(fp[pairs] ^ fp[pairs + 1]) <= bits]
            found += zip(fp[near].tolist(), fp[near + 1].tolist(), strict=True)
            for i, n in zip(first[(size > 2) & has].tolist(), size[(size > 2) & has].tolist(), strict=True):
                found += bucket_links(fp[i : i + n], stands[i : i + n], bits)
            if found:
                both = np.array(found, np.uint64).view(np.int64).reshape(-1, 2)
                return pa.RecordBatch.from_arrays([pa.array(both[:, 0].copy()), pa.array(both[:, 1].copy())], ["a", "b"])
            return None

        for batch in batches:
            if not batch.num_rows:
                continue
            anchor = batch.column("anchor").to_numpy(zero_copy_only=False)
            fp = batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
            stands = batch.column("stands").to_numpy(zero_copy_only=False)
            held.append((anchor, fp, stands))
            if held[0][0][0] == anchor[-1]:
                continue  # one anchor so far
            anchor, fp, stands = (np.concatenate(x) for x in zip(*held, strict=True))
            cut = int(np.searchsorted(anchor, anchor[-1]))
            if (out := work(anchor[:cut], fp[:cut], stands[:cut])) is not None:
                yield out
            held = [(anchor[cut:], fp[cut:], stands[cut:])]
        if held:
            anchor, fp, stands = (np.concatenate(x) for x in zip(*held, strict=True))
            if (out := work(anchor, fp, stands)) is not None:
                yield out

    return run


def _standing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        fp = batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
        for part in (0, 1):
            own, _, _ = anchors((fp >> np.uint64(32 * part)).astype(np.uint32))
            yield pa.RecordBatch.from_arrays([pa.array(own.astype(np.int64) | (part << 32))], ["anchor"])


def fingerprint_links(distinct: DataFrame, bits: int = BITS) -> DataFrame:
    """Links (a, b) that span every group of the distinct fingerprints in ``distinct`` (fp long).

    Anchors where more than SPLIT_OVER fingerprints stand are dealt out by bytes of the other half: of its four
    bytes, at most three differing bits leave one the same, so each linked pair still meets in one of the four.
    """
    hot = distinct.select("fp").mapInArrow(_standing, "anchor long").groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > SPLIT_OVER).select(F.col("anchor").alias("_hot"))
    replicas = distinct.select("fp").mapInArrow(_replicas, "anchor long, fp long, stands boolean").join(cut_lineage(hot), F.col("anchor") == F.col("_hot"), "left")
    other = F.when(F.shiftright("anchor", 32) == 0, F.shiftrightunsigned("fp", 32)).otherwise(F.col("fp"))
    pieces = F.array(*[F.lit(k * 256) + F.shiftright(other, 8 * k).bitwiseAND(F.lit(255)) for k in range(4)])
    dealt = replicas.withColumn("sub", F.explode(F.when(F.col("_hot").isNull(), F.array(F.lit(-1).cast("long"))).otherwise(pieces)))
    # One number for the anchor and its piece; the anchor has 33 bits, the piece 11.
    dealt = dealt.select((F.col("anchor") * 2048 + F.col("sub") + 1).alias("anchor"), "fp", "stands")
    return dealt.repartition(F.col("anchor")).sortWithinPartitions("anchor").mapInArrow(_compare(bits), "a long, b long")


def _components(prints: DataFrame, bits: int) -> DataFrame:
    """(_fp, group): the fingerprint that stands for each fingerprint's component."""
    if not 0 <= bits <= 3:
        raise ValueError("two halves with radius 1 cover links of at most 3 bits")
    distinct = prints.select("fp").distinct()
    roots = connected_components(fingerprint_links(distinct, bits))
    return distinct.join(roots, F.col("fp") == F.col("node"), "left").select(F.col("fp").alias("_fp"), F.coalesce("root", "fp").alias("group"))


def near_groups(docs: DataFrame, k: int = SHINGLE, bits: int = BITS, seed: int = SEED) -> DataFrame:
    """One row per document: doc_id, fingerprint, component_id."""
    prints = cut_lineage(fingerprints(docs, k, seed))
    groups = _components(prints, bits)
    least = prints.groupBy("fp").agg(F.min("_id").alias("low"))
    grouped = groups.join(least, F.col("fp") == F.col("_fp")).select("_fp", "group", "low")
    lowest = grouped.groupBy("group").agg(F.min("low").alias("component_id"))
    components = grouped.join(lowest, "group").select("_fp", "component_id")
    joined = prints.join(components, F.col("fp") == F.col("_fp"))
    return joined.select(F.col("_id").alias("doc_id"), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def candidates(prints: DataFrame, bits: int = BITS) -> DataFrame:
    """Pairs (a, b) of nodes whose fingerprints are the same, or linked: they span each group. ``prints``: rows (node, fp)."""
    nodes = cut_lineage(prints.select("node", "fp").distinct())
    lead = cut_lineage(nodes.groupBy("fp").agg(F.min("node").alias("lead")))
    same = nodes.join(lead.select(F.col("fp").alias("_fp"), "lead"), F.col("fp") == F.col("_fp")).select(F.col("lead").alias("a"), F.col("node").alias("b"))
    links = fingerprint_links(lead.select("fp"), bits)
    side = lambda x: lead.select(F.col("fp").alias(x), F.col("lead").alias(f"lead_{x}"))
    near = links.join(side("a"), "a").join(side("b"), "b").select(F.col("lead_a").alias("a"), F.col("lead_b").alias("b"))
    return same.unionByName(near).where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def representatives(docs: DataFrame) -> DataFrame:
    """Of each group of near duplicates (5-word shingles, Jaccard similarity 0.8 or more) the row with the smallest id (then text hash, then the other columns), with all its columns.

    Fingerprints that meet at an anchor propose pairs, each of which is checked by its whole shingle sets. Pairs of that
    similarity may differ in more bits than anchors can cover, so what they leave goes an exact way (``jaccard_dedup``).
    """
    prints = cut_lineage(jaccard_dedup.prints_of(docs))
    links = jaccard_dedup.near_links(prints, docs, candidates(prints))
    roots = connected_components(links).select(F.col("node").alias("_node"), "root")
    least = prints.groupBy("node").agg(F.min(F.struct("_id", "_h")).alias("low"))
    lowest = least.join(roots, F.col("node") == F.col("_node"), "left").groupBy(F.coalesce("root", "node").alias("group")).agg(F.min("low").alias("low"))
    # Only rows that go, or whose id and text are repeated, have to meet others: all else stays where it is.
    lowest = cut_lineage(lowest.select(F.col("low").alias("key")))
    keys = prints.groupBy(F.struct("_id", "_h").alias("key")).agg(F.count(F.lit(1)).alias("copies"))
    single = lowest.withColumn("stays", F.lit(True))
    decided = cut_lineage(keys.join(single, "key", "left").where("copies > 1 or stays is null").select(jaccard_dedup.key_of("key._id", "key._h").alias("key")))
    among = jaccard_dedup.among_keys(decided)
    # Structs are equal where the same fields are null; columns of any name stay inside ``doc``.
    rows = docs.select(F.struct(F.col("doc_id").cast("long").alias("_id"), F.xxhash64("text").alias("_h")).alias("key"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")).withColumn("meets", among(jaccard_dedup.key_of("key._id", "key._h")))
    met = rows.where("meets").join(lowest, "key", "left_semi").groupBy("key").agg(F.min("doc").alias("doc"))
    return rows.where("not meets").select("doc.*").unionByName(met.select("doc.*"))


def op2_simhash_dedup(docs: DataFrame) -> DataFrame:
    return near_groups(docs)
