"""Sharding by balanced label propagation, with DataFrame operations only.

Linked documents (equal texts) start spread evenly over the shards. What propagates is how many members a
group has in each shard: one row for each group, with at most as many entries as there are shards, so no
row of a document moves before the end. In every round each group reads its labels: it prefers the shards
where most of its members are, and wants to fill as few of them as hold it, under the room that is left.
The wishes for a shard are dealt over priority buckets and admitted up to its quota: whole buckets while
they fit, and of the next one the same share of every wish. Members always move from a less to a more
preferred shard, so the cut edges fall in every round; the rounds end when nothing moves. At last the
documents take the places that their groups have, and those without links fill what is left of every quota
exactly.

The law is ``rows``: shard s holds floor(N / shards) documents, and one more if s < N mod shards.

Defined results: a null text counts as empty (size 8) and is linked to empty texts; rows that repeat an id,
with the same text or another, stay rows of their own; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import cut_lineage, numbered

SHARDS = 24
#: Priority buckets per shard and round: 32 classes of group sizes, the largest first, with 8 buckets each.
PRIORITIES = 256
#: The members of a group are dealt over so many cells, and ranked in each by itself.
CELLS = 256


def quotas(total: int, shards: int) -> list[int]:
    return [total // shards + (s < total % shards) for s in range(shards)]


def _held(groups: DataFrame, shards: int) -> list[int]:
    """Members in every shard: as many rows as there are shards."""
    found = groups.select(F.explode("members").alias("m")).groupBy("m.shard").agg(F.sum("m.c").alias("c")).collect()
    held = Counter({r["shard"]: r["c"] for r in found})
    return [held[s] for s in range(shards)]


def started(linked: DataFrame, shards: int) -> DataFrame:
    """(text_key, n, members): the members of all groups (text_key, n) dealt over the shards in turn."""
    every = numbered(linked, "_at", [], [F.col("text_key")], [F.col("text_key")], weight="n")
    low, more = F.floor(F.col("n") / shards), F.col("n") % shards
    share = lambda i: F.struct(F.pmod(F.col("_at") + i, F.lit(shards)).cast("int").alias("shard"), (low + (i < more).cast("long")).alias("c"))
    return every.withColumn("members", F.transform(F.sequence(F.lit(0), (F.least("n", F.lit(shards)) - 1).cast("int")), share)).select("text_key", "n", "members")


def wishes(groups: DataFrame, room: list[int], shards: int) -> DataFrame:
    """Adds ``w``: the group's shards from the most preferred one on, with members and how many of them it wishes to have there."""
    rooms = F.lit(room)
    turn = lambda m: F.pmod(m["shard"] + F.xxhash64("text_key"), F.lit(shards))  # noqa: E731  ties fall in an order of the group's own, so small groups spread
    ordered = F.array_sort(F.transform("members", lambda m: F.struct((-m["c"]).alias("less"), turn(m).alias("turn"), m["shard"].alias("shard"), m["c"].alias("c"))))
    none = F.array().cast("array<struct<shard:int,c:long,t:long>>")

    def take(acc: Column, m: Column) -> Column:
        t = F.least(acc["left"], m["c"] + F.get(rooms, m["shard"]))
        return F.struct((acc["left"] - t).alias("left"), F.concat(acc["w"], F.array(F.struct(m["shard"].alias("shard"), m["c"].alias("c"), t.alias("t")))).alias("w"))

    return groups.withColumn("w", F.aggregate(ordered, F.struct(F.col("n").alias("left"), none.alias("w")), take)["w"])


def admissions(asked: DataFrame, room: list[int], shards: int) -> list[tuple[int, int, int]]:
    """For every shard (bucket, left, asked): earlier buckets fit whole, of the wishes in this one left / asked do."""
    demand = asked.select("_p", F.explode("w").alias("m")).where("m.t > m.c").groupBy(F.col("m.shard").alias("shard"), "_p").agg(F.sum(F.col("m.t") - F.col("m.c")).alias("d"))
    demand = demand.withColumn("upto", F.sum("d").over(Window.partitionBy("shard").orderBy("_p")))  # shards x PRIORITIES rows at most
    over = demand.where(F.col("upto") > F.get(F.lit(room), F.col("shard")))
    first = over.groupBy("shard").agg(F.min(F.struct("_p", "upto", "d")).alias("x")).collect()
    out = [(PRIORITIES, 0, 1)] * shards
    for r in first:
        p, upto, d = r["x"]
        out[r["shard"]] = (p, room[r["shard"]] - (upto - d), d)
    return out


def moved(asked: DataFrame, admitted: list[tuple[int, int, int]]) -> DataFrame:
    """Groups after what was admitted has moved, out of the least preferred shards first; ``moves`` counts members."""
    bucket, left, demand = (F.lit([a[k] for a in admitted]) for k in range(3))

    def into(m: Column) -> Column:
        ask = F.greatest(m["t"] - m["c"], F.lit(0))
        at = F.get(bucket, m["shard"])
        some = F.floor(ask * F.get(left, m["shard"]) / F.get(demand, m["shard"]))
        return F.when(F.col("_p") < at, ask).when(F.col("_p") == at, F.least(ask, some)).otherwise(F.lit(0)).cast("long")

    entered = asked.withColumn("w", F.transform("w", lambda m: F.struct(m["shard"].alias("shard"), m["c"].alias("c"), m["t"].alias("t"), into(m).alias("a"))))
    entered = entered.withColumn("moves", F.aggregate("w", F.lit(0).cast("long"), lambda acc, m: acc + m["a"]))
    none = F.array().cast("array<struct<shard:int,c:long>>")

    def leave(acc: Column, m: Column) -> Column:
        out = F.least(acc["due"], F.greatest(m["c"] - m["t"], F.lit(0)))
        return F.struct((acc["due"] - out).alias("due"), F.concat(acc["members"], F.array(F.struct(m["shard"].alias("shard"), (m["c"] - out + m["a"]).alias("c")))).alias("members"))

    after = F.aggregate(F.reverse("w"), F.struct(F.col("moves").alias("due"), none.alias("members")), leave)["members"]
    return entered.select("text_key", "n", F.filter(after, lambda m: m["c"] > 0).alias("members"), "moves")


def _priority() -> Column:
    size_class = F.least(F.lit(31), F.floor(F.log2(F.col("n").cast("double"))))
    return ((31 - size_class) * 8 + F.pmod(F.xxhash64("text_key"), F.lit(8))).cast("int")


def propagate(groups: DataFrame, total: int, shards: int) -> tuple[DataFrame, list[int]]:
    """(groups where no more members can move, members in every shard). Every round is a checkpoint; the cut edges fall in each."""
    quota = quotas(total, shards)
    held = _held(groups, shards)
    while True:
        room = [q - h for q, h in zip(quota, held, strict=True)]
        asked = wishes(groups, room, shards).withColumn("_p", _priority())
        after = cut_lineage(moved(asked, admissions(asked, room, shards)))
        groups = after.drop("moves")
        held = _held(groups, shards)
        if not after.where("moves > 0").limit(1).count():
            return groups, held


def placed(rows: DataFrame, shards: int) -> DataFrame:
    """Adds ``shard`` and ``group_size`` to rows (text_key, cell, row, ...)."""
    # Cells of one group are few, however large it is; a group without links is one cell of one row.
    every = Window.partitionBy("text_key")
    before = every.orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = rows.groupBy("text_key", "cell").agg(F.count(F.lit(1)).alias("k"))
    cells = cut_lineage(cells.withColumn("start", F.coalesce(F.sum("k").over(before), F.lit(0))).withColumn("n", F.sum("k").over(every)).drop("k"))
    linked = cells.where("n > 1 and start = 0").select("text_key", "n")
    total = rows.count()
    groups, held = propagate(cut_lineage(started(linked, shards)), total, shards)

    # What is left of each quota, as the number of the first document without links that goes there.
    first, upto = [], 0
    for q, h in zip(quotas(total, shards), held, strict=True):
        first.append(upto)
        upto += q - h
    one = numbered(cells.where("n = 1"), "_nr", [], [F.col("text_key")], [F.col("text_key")])
    only = F.size(F.filter(F.lit(first), lambda x: x <= F.col("_nr"))) - 1
    one = one.select("text_key", "cell", "start", "n", only.alias("only"), F.lit(None).cast("array<struct<shard:int,c:long>>").alias("members"))
    several = cells.where("n > 1").join(groups.select(F.col("text_key").alias("_key"), "members"), F.col("text_key") == F.col("_key"))
    several = several.select("text_key", "cell", "start", "n", F.lit(None).cast("int").alias("only"), "members")
    places = one.unionByName(several).select(F.col("text_key").alias("_key"), F.col("cell").alias("_cell"), "start", "n", "only", "members")

    ranked = rows.withColumn("_rank", F.row_number().over(Window.partitionBy("text_key", "cell").orderBy("doc_id", "row")) - 1)
    joined = ranked.join(places, (F.col("text_key") == F.col("_key")) & (F.col("cell") == F.col("_cell")))
    # The member at this place of its group: the shard whose members the running count passes it with.
    at = F.col("start") + F.col("_rank")
    found = F.aggregate("members", F.struct(at.cast("long").alias("left"), F.lit(None).cast("int").alias("shard")), lambda acc, m: F.struct((acc["left"] - m["c"]).alias("left"), F.when(acc["shard"].isNull() & (acc["left"] < m["c"]), m["shard"]).otherwise(acc["shard"]).alias("shard")))["shard"]
    return joined.withColumn("shard", F.coalesce("only", found)).withColumn("group_size", F.col("n")).drop("_rank", "_key", "_cell", "start", "n", "only", "members")


def shard_rows(docs: DataFrame, shards: int = SHARDS, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Rows doc_id, size, text_crc32, law, shard, slot, grown_shard, group_size."""
    whole = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        F.col(key).cast("long").alias("doc_id"), (F.octet_length(whole) + 8).cast("long").alias("size"), F.crc32(whole.cast("binary")).cast("long").alias("text_crc32"),
        F.unhex(F.sha2(whole, 256)).alias("text_key"), F.monotonically_increasing_id().alias("row"),
    )
    rows = cut_lineage(rows.withColumn("cell", F.pmod(F.xxhash64("row"), F.lit(CELLS)).cast("int")))
    out = numbered(placed(rows, shards), "slot", ["shard"], [F.col("row")], [F.col("row")])
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "group_size")


def op6_sharding(docs: DataFrame) -> DataFrame:
    return shard_rows(docs)
