"""Helpers that the training-data operators share: tables, checkpoints, row numbering, components."""

from __future__ import annotations

import gc
import re
import tempfile

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Words are runs of bytes other than ASCII white space; only A-Z are lower-cased.
LOWER_AZ = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))

#: Buckets of a two-level numbering: each is sorted by itself, the offsets are a table of this many rows.
NUMBER_BUCKETS = 2048


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words_of(data: bytes) -> list[bytes]:
    """Lower-cased words: ``bytes.split`` cuts at exactly 0x20 and 0x09-0x0D."""
    return data.translate(LOWER_AZ).split()


def shingle_hashes(data: bytes, k: int, seed: int = 42) -> np.ndarray:
    """XXH64 of every k-word shingle, repeats included; of the whole sequence if it is shorter; none without words."""
    words = data.translate(LOWER_AZ).split()
    if not words:
        return np.empty(0, np.uint64)
    h = xxhash.xxh64_intdigest
    if len(words) <= k:
        return np.array([h(b" ".join(words), seed)], np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.empty_like(ends)
    starts[0] = 0
    starts[1:] = ends[:-1] + 1
    return np.array([h(joined[a:b], seed) for a, b in zip(starts[: len(words) - k + 1].tolist(), ends[k - 1 :].tolist(), strict=True)], np.uint64)


def majority(hashes: np.ndarray) -> int:
    """A bit is 1 if it is set in over half the hashes."""
    n = len(hashes)
    if not n:
        return 0
    counts = np.zeros(64, np.int64)
    for at in range(0, n, 1 << 14):  # bounded memory for very long texts
        part = hashes[at : at + (1 << 14)].astype(">u8")
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > n).tobytes(), "big")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Uses the shared folder of ``spark.checkpoint.dir``; a folder of its own only on one machine (tests), where none is set."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        shared = spark.conf.get("spark.checkpoint.dir", None)
        if shared is None and not re.fullmatch(r"local(\[.*\])?", context.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        context.setCheckpointDir(shared or tempfile.mkdtemp(prefix="dialoom-checkpoint-"))


def cut_lineage(df: DataFrame) -> DataFrame:
    """Writes the rows to the shared checkpoint folder; later reads survive lost executors."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def release(spark: SparkSession) -> None:
    """Lets go of shuffle files and checkpoints that no frame refers to any more; else they stay until the driver happens to collect its garbage."""
    gc.collect()
    spark._jvm.System.gc()


def numbered(df: DataFrame, name: str, within: list[str], order: list[Column], spread: list[Column], buckets: int = NUMBER_BUCKETS, weight: str | None = None) -> DataFrame:
    """Adds gapless numbers from 0 within each group of ``within``, in order of the bucket, then of ``order``; of ``weight``, its running sum before each row.

    A group may hold all rows: it is dealt over ``buckets`` by a hash of ``spread``,
    each bucket is ranked by itself and starts at the sum of the earlier buckets' counts.
    """
    keys = [F.col(c) for c in within]
    dealt = df.withColumn("_bucket", F.pmod(F.xxhash64(*spread), F.lit(buckets)))
    counts = dealt.groupBy(*within, "_bucket").agg((F.sum(weight) if weight else F.count(F.lit(1))).alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(*[F.col(c).alias(f"_k_{c}") for c in within], F.col("_bucket").alias("_kb"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    inside = Window.partitionBy(*keys, "_bucket").orderBy(*order)
    rank = F.coalesce(F.sum(weight).over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) if weight else F.row_number().over(inside) - 1
    ranked = dealt.withColumn("_rank", rank)
    on = (F.col("_bucket") == F.col("_kb")) if not within else None
    for c in within:
        same = F.col(c).eqNullSafe(F.col(f"_k_{c}"))
        on = same & (F.col("_bucket") == F.col("_kb")) if on is None else on & same
    joined = ranked.join(starts, on, "inner")
    return joined.withColumn(name, (F.col("_start") + F.col("_rank")).cast("long")).drop("_bucket", "_kb", "_start", "_rank", *[f"_k_{c}" for c in within])


def most_frequent(counts: DataFrame, count: str, most: int, least: int = 1) -> DataFrame:
    """The rows whose ``count`` is at least ``least`` and so high that at most ``most`` rows are as frequent: ties stay or go together.

    Only numbers of rows by count reach the driver, so no task sends it ``most`` rows of its own.
    """
    by_count = counts.where(F.col(count) >= least).groupBy(F.col(count).alias("c")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("c")).limit(most).collect()
    total, bound = 0, None
    for r in by_count:
        total += r["n"]
        if total > most:
            break
        bound = r["c"]
    return counts.where(F.col(count) >= bound) if bound is not None else counts.where(F.lit(False))


def connected_components(edges: DataFrame) -> DataFrame:
    """Component of each node of ``edges`` (a long, b long): rows (node, root), root the smallest node of the component.

    Alternating large-star and small-star joins; every round is a checkpoint. Nodes without an edge have no row.
    A hub costs a join that can be split, not a list in one task: only minima are aggregated. Labels only fall, so the
    rounds end; their number grows with the logarithm of the longest chain.
    """
    e = cut_lineage(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = None
    while True:
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        # A node keeps at least its link to the smallest neighbour.
        star = large.unionByName(low.where("m < a").select("a", F.col("m").alias("b"))).distinct()
        least = star.groupBy("a").agg(F.min("b").alias("m"))
        small = star.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        e = cut_lineage(small.unionByName(least.select("a", F.col("m").alias("b"))).where("a <> b").distinct())
        stats = e.agg(F.count(F.lit(1)).alias("n"), F.countDistinct("a").alias("nodes"), F.sum(F.hash("a", "b").cast("long")).alias("h"), F.bit_xor(F.xxhash64("a", "b")).alias("x")).first()
        now = tuple(stats)
        if now == before:
            break
        before = now
    return e.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root")).unionByName(e.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
