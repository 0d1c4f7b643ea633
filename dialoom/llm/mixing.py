"""Mixing sources to target weights by capped water-filling, with DataFrame operations only.

Every source has a weight and may be repeated at most ``max_epochs`` times. Targets are proportional to
the weights; a target above its cap stops there and the excess goes to the others by weight, until none is
above. That ends at one water level L with target = min(cap, weight * L), which is found by sorting the
sources by cap / weight and two running sums, not by iterating.

A source is taken floor(target / size) whole times, and its documents in seeded random order fill the
fraction that is left: a document is in if the running size at its middle lies below the rest. So each
source misses its target by at most about half a document, and equal seeds give equal samples.

Defined results: a null source is a source of its own and sorts last; a null text has size 0 and takes
nothing; sources of size 0 have target 0; documents that repeat an id and text are rows of their own
(ties between them are the same row); an empty table gives no rows; other columns are ignored or carried.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import NUMBER_BUCKETS, cut_lineage, numbered

SHARE, MAX_EPOCHS, SEED = 1.5, 2.0, 42
WEIGHTS = (3.0, 1.0, 2.0)


def word_count(text: Column) -> Column:
    """Runs of other characters than ASCII white space; a null text has none. One pass, without a list of the words."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, share: float = SHARE, max_epochs: float = MAX_EPOCHS, weights: tuple[float, ...] = WEIGHTS) -> DataFrame:
    """Adds ``target`` to rows (source, source_size): one row for each source, so single-task windows are over sources only."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    place = F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights)))
    weighted = sizes.withColumn("_weight", F.element_at(F.array(*map(F.lit, weights)), (place + 1).cast("int")))
    cap = F.col("source_size") * F.lit(max_epochs)
    order = Window.orderBy(F.col("source_size") * F.lit(max_epochs) / F.col("_weight"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    levels = (
        weighted.withColumn("_cap", cap.cast("double"))
        .withColumn("_budget", F.least(F.sum("source_size").over(every) * F.lit(share), F.sum("_cap").over(every)))
        .withColumn("_capped", F.coalesce(F.sum("_cap").over(before), F.lit(0.0)))
        .withColumn("_open", F.sum("_weight").over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing)))
        # The level if all sources before this one stop at their caps and none from here on does.
        .withColumn("_level", (F.col("_budget") - F.col("_capped")) / F.col("_open"))
        .withColumn("_water", F.max(F.when(F.col("_level") * F.col("_weight") <= F.col("_cap"), F.col("_level"))).over(every))
    )
    target = F.when(F.col("_water").isNull(), F.col("_cap")).otherwise(F.least(F.col("_cap"), F.col("_weight") * F.col("_water")))
    return levels.withColumn("target", target).select("source", "source_size", "target")


def mixed(docs: DataFrame, share: float = SHARE, max_epochs: float = MAX_EPOCHS, weights: tuple[float, ...] = WEIGHTS, seed: int = SEED, text: str = "text", key: str = "doc_id", source: str = "source") -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, repeats (times it is taken), taken."""
    rows = cut_lineage(docs.select(F.col(key).cast("long").alias("doc_id"), F.col(source).cast("string").alias("source"), word_count(F.col(text)).alias("size"), F.xxhash64(F.col(text), F.lit(seed)).alias("_text")))
    targets = cut_lineage(source_targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), share, max_epochs, weights))
    # The seeded order: random buckets, then a second hash inside a bucket. A bucket is a small part even of a source that holds most rows.
    dealt = rows.withColumn("_bucket", F.pmod(F.xxhash64("doc_id", "_text", F.lit(seed)), F.lit(NUMBER_BUCKETS))).withColumn("_in", F.xxhash64("doc_id", "_text", F.lit(seed + 1)))
    sums = dealt.groupBy("source", "_bucket").agg(F.sum("size").alias("_sum"))
    before = Window.partitionBy("source").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.withColumn("_start", F.coalesce(F.sum("_sum").over(before), F.lit(0)))
    t = targets.select(F.col("source").alias("_ts"), "source_size", "target")
    starts = starts.join(t, F.col("source").eqNullSafe(F.col("_ts"))).select(F.col("source").alias("_bs"), F.col("_bucket").alias("_bb"), "_start", "source_size", "target")
    inside = Window.partitionBy("source", "_bucket").orderBy("_in", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    ranked = dealt.withColumn("_inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    joined = ranked.join(starts, F.col("source").eqNullSafe(F.col("_bs")) & (F.col("_bucket") == F.col("_bb")))
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    whole = F.floor(ratio)
    rest = F.col("target") - whole * F.col("source_size")
    extra = (F.col("_start") + F.col("_inside") + F.col("size") / 2.0 < rest).cast("long")
    repeats = F.least(whole + extra, F.lit(max_epochs).cast("long"))
    return joined.withColumn("repeats", repeats.cast("long")).select("doc_id", "source", "size", "source_size", "target", "repeats", (F.col("repeats") * F.col("size")).alias("taken"), F.col("_text").alias("text_hash"))


def op10_mixing(docs: DataFrame) -> DataFrame:
    return mixed(docs).drop("repeats", "text_hash")


def repeated(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """The mix itself: every document as many times as it is taken, with all its columns, of any name."""
    plan = mixed(docs, seed=seed).where("repeats > 0").select(F.struct("doc_id", "text_hash", "source").alias("key"), "repeats")
    plan = plan.groupBy("key").agg(F.sum("repeats").alias("repeats"), F.count(F.lit(1)).alias("rows"))
    # Structs are equal where the same fields are null; the document's columns stay inside ``doc``.
    key = F.struct(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.col("text"), F.lit(seed)).alias("text_hash"), F.col("source").cast("string").alias("source"))
    counts = docs.select(key.alias("key"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")).join(plan, "key")
    single = counts.where("rows = 1").withColumn("n", F.col("repeats"))
    # Rows that repeat one document share its count evenly; the first ones, in order of all their columns, take what is left.
    several = cut_lineage(counts.where("rows > 1").withColumn("row", F.monotonically_increasing_id()))
    several = numbered(several, "nr", ["key"], [F.col("doc"), F.col("row")], [F.col("row")])
    several = several.withColumn("n", F.floor(F.col("repeats") / F.col("rows")) + (F.col("nr") < F.col("repeats") % F.col("rows")).cast("long")).drop("nr", "row")
    taken = single.unionByName(several).where("n > 0")
    return taken.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("n").cast("int")))).select("doc.*")
