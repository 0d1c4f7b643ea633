"""Embedding near-duplicates: cross-polytope hashing after fast Hadamard rotations, with multiprobe buckets.

A hash rotates a vector by three rounds of random signs and a fast Hadamard transform, and takes the
signed axis of largest magnitude. A bucket is two such hashes; in every table a vector goes to the four
buckets of its two best axes for each hash. Two vectors that share a bucket are a candidate pair, which
is verified by the cosine in double precision. A pair that meets in several buckets counts in the first
of them only, told from the signatures that the rows carry, so links are counted without listing pairs.

Equal vectors of a label are one class before anything is hashed. A bucket with many classes is dealt
out in blocks, each pair of blocks a unit of work of its own, so that no task gets a whole hot bucket and
no pair is dropped. Units report counts and a spanning forest.

Defined results: null labels, and vectors that are null, empty, all zero or hold a null or non-finite
component link with nothing (n_links 0, their own component, kept); vectors of other lengths never link;
rows that repeat a vec_id stay rows of their own; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import connected_components, cut_lineage

COSINE = 0.98
TABLES, SEED = 5, 42
ROUNDS = 3
#: Classes of one bucket that are compared in one unit; larger buckets are dealt out in blocks of about this many.
BLOCK = 1024


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of each row; the width is a power of two."""
    n, width = x.shape
    step = 1
    while step < width:
        y = x.reshape(n, width // (2 * step), 2, step)
        x = np.stack([y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]], axis=2).reshape(n, width)
        step *= 2
    return x


def signatures(vectors: np.ndarray, tables: int = TABLES, seed: int = SEED) -> np.ndarray:
    """(n, tables, 2, 2): for each table and hash the two best signed axes."""
    n, dim = vectors.shape
    width = 1 << max(1, (dim - 1).bit_length())
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    padded = np.zeros((n, width))
    padded[:, :dim] = unit
    signs = np.random.default_rng((seed, dim)).integers(0, 2, (tables, 2, ROUNDS, width)) * 2.0 - 1
    out = np.empty((n, tables, 2, 2), np.int32)
    rows = np.arange(n)
    for t in range(tables):
        for h in range(2):
            x = padded
            for r in range(ROUNDS):
                x = hadamard(x * signs[t, h, r])
            size = np.abs(x)
            for best in range(2):
                axis = size.argmax(1)
                out[:, t, h, best] = axis * 2 + (x[rows, axis] < 0)
                size[rows, axis] = -1
    return out


def _matrix(column: pa.Array, wide: bool) -> np.ndarray:
    kind = np.float64 if wide else np.float32
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), -1)


ROW_SQL = "bucket binary, id long, n long, vector binary, sig binary"


def _bucket_rows(tables: int, seed: int, wide: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = np.float64 if wide else np.float32
        for batch in batches:
            vectors = batch.column("embedding")
            lengths = np.array([len(v) for v in vectors])
            labels = batch.column("label").to_numpy(zero_copy_only=False)
            ids, sizes = batch.column("id").to_numpy(), batch.column("n").to_numpy()
            for dim in np.unique(lengths):
                at = np.flatnonzero(lengths == dim)
                for part in np.array_split(at, max(1, len(at) // 2048)):
                    x = np.array(vectors.take(pa.array(part)).to_pylist(), kind)
                    sig = signatures(x.astype(np.float64), tables, seed)
                    raw = [v.tobytes() for v in x]
                    code = [s.tobytes() for s in sig]
                    keys, who = [], []
                    for t in range(tables):
                        for a in range(2):
                            for b in range(2):
                                key = np.stack([labels[part].astype(np.int64), np.full(len(part), (int(dim) << 8) | t), sig[:, t, 0, a], sig[:, t, 1, b]], 1)
                                keys += [k.tobytes() for k in np.ascontiguousarray(key.astype(">i8"))]
                                who += range(len(part))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(keys, pa.binary()), pa.array(ids[part][who]), pa.array(sizes[part][who]), pa.array([raw[i] for i in who], pa.binary()), pa.array([code[i] for i in who], pa.binary())],
                        ["bucket", "id", "n", "vector", "sig"],
                    )

    return run


def unit_links(key: bytes, x: np.ndarray, sig: np.ndarray, side: np.ndarray, cosine: float) -> np.ndarray:
    """(m, m) booleans above the diagonal: pairs of this unit that link and whose first common bucket this is.

    ``side``: -1 where all pairs count, else 0 and 1, and only pairs across count.
    """
    _, packed, a, b = np.frombuffer(key, ">i8").tolist()
    t = packed & 0xFF
    norm = np.sqrt((x * x).sum(1))
    link = np.triu((x @ x.T) / (norm[:, None] * norm[None, :]) >= cosine, 1)
    if side[0] >= 0 or side[-1] >= 0:
        link &= side[:, None] != side[None, :]
    i, j = np.nonzero(link)
    if not len(i):
        return link
    p, q = sig[i], sig[j]  # (pairs, tables, 2, 2)
    same = p[:, :, :, :, None] == q[:, :, :, None, :]
    meets = same.any((3, 4)).all(2)  # by table
    first = ~meets[:, :t].any(1)
    shared = np.where(same.any(4)[:, t], p[:, t], np.iinfo(np.int32).max).min(2)  # least common axis of either hash
    first &= (shared[:, 0] == a) & (shared[:, 1] == b)
    link[i[~first], j[~first]] = False
    return link


def _forest(n: int, pairs: Iterator[tuple[int, int]]) -> list[tuple[int, int]]:
    up, out = list(range(n)), []
    for a, b in pairs:
        x, y = a, b
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        while up[y] != y:
            up[y] = up[up[y]]
            y = up[y]
        if x != y:
            up[max(x, y)] = min(x, y)
            out.append((a, b))
    return out


def _verify(cosine: float, tables: int, wide: bool):
    def work(batch: pa.Table) -> Iterator[pa.RecordBatch]:
        keys = batch.column("bucket").to_pylist()
        units = np.stack([batch.column(c).to_numpy() for c in ("i", "j")], 1)
        new = np.array([True] + [keys[k] != keys[k - 1] for k in range(1, len(keys))]) | np.r_[True, (units[1:] != units[:-1]).any(1)]
        first = np.flatnonzero(new)
        size = np.diff(np.r_[first, len(keys)])
        ids, n, block = (batch.column(c).to_numpy() for c in ("id", "n", "block"))
        vectors, sigs = batch.column("vector").to_pylist(), batch.column("sig").to_pylist()
        a, b, links = [], [], []
        for at, m in zip(first[size > 1].tolist(), size[size > 1].tolist(), strict=True):
            x = [np.frombuffer(v, np.float64 if wide else np.float32) for v in vectors[at : at + m]]
            x = np.array(x, np.float64)
            sig = np.array([np.frombuffer(s, np.int32) for s in sigs[at : at + m]]).reshape(m, tables, 2, 2)
            i, j = units[at]
            side = np.full(m, -1) if i == j else (block[at : at + m] == j).astype(int)
            link = unit_links(keys[at], x, sig, side, cosine)
            who = np.flatnonzero(link.any(0) | link.any(1))
            if len(who):
                both = link | link.T
                total = both[who] @ n[at : at + m]
                p, q = np.nonzero(link)
                for s, e in _forest(m, zip(p.tolist(), q.tolist(), strict=True)):
                    a.append(ids[at + s])
                    b.append(ids[at + e])
                    links.append(None)
                a += ids[at + who].tolist()
                b += [None] * len(who)
                links += total.tolist()
        if a:
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(links, pa.int64())], ["a", "b", "links"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by unit; the last unit of a batch may go on in the next."""
        held: list[pa.RecordBatch] = []
        last = lambda x, k: (x.column("bucket")[k].as_py(), x.column("i")[k].as_py(), x.column("j")[k].as_py())
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            rows = pa.Table.from_batches(held)
            end = last(rows, rows.num_rows - 1)
            if last(rows, 0) == end:
                continue
            low, high = 0, rows.num_rows - 1
            while low < high:  # the first row of the last unit
                mid = (low + high) // 2
                low, high = (low, mid) if last(rows, mid) == end else (mid + 1, high)
            yield from work(rows.slice(0, low))
            held = rows.slice(low).combine_chunks().to_batches()
        if held:
            yield from work(pa.Table.from_batches(held))

    return run


def embedding_groups(rows: DataFrame, cosine: float = COSINE, tables: int = TABLES, seed: int = SEED, block: int = BLOCK, vector: str = "embedding", key: str = "vec_id", label: str = "label") -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept."""
    kind = rows.schema[vector].dataType
    wide = not isinstance(kind.elementType, T.FloatType)
    base = rows.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).alias("embedding"), F.col(label).cast("long").alias("label"))
    number = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    fit = F.col("label").isNotNull() & F.coalesce(F.forall("embedding", number) & F.exists("embedding", lambda x: x != 0), F.lit(False))
    base = base.withColumn("fit", fit)
    valid = base.where("fit")
    classes = cut_lineage(valid.groupBy("label", "embedding").agg(F.count(F.lit(1)).alias("n"), F.min("vec_id").alias("low")).withColumn("id", F.monotonically_increasing_id()))

    dealt = classes.select("label", "embedding", "id", "n").mapInArrow(_bucket_rows(tables, seed, wide), ROW_SQL)
    sizes = dealt.groupBy("bucket").agg(F.count(F.lit(1)).alias("size"))
    hot = sizes.where(F.col("size") > block).select(F.col("bucket").alias("_hot"), F.ceil(F.col("size") / block).cast("int").alias("blocks"))
    joined = dealt.join(hot, F.col("bucket") == F.col("_hot"), "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    joined = joined.withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    units = joined.withColumn("_other", other).withColumn("i", F.least("block", "_other")).withColumn("j", F.greatest("block", "_other"))
    units = units.select("bucket", "i", "j", "block", "id", "n", "vector", "sig").repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j")
    found = cut_lineage(units.mapInArrow(_verify(cosine, tables, wide), "a long, b long, links long"))

    counts = found.where("links is not null").groupBy(F.col("a").alias("_id")).agg(F.sum("links").alias("_links"))
    roots = connected_components(found.where("b is not null").select("a", "b"))
    grouped = classes.join(counts, F.col("id") == F.col("_id"), "left").join(roots, F.col("id") == F.col("node"), "left")
    grouped = grouped.select("label", "embedding", "low", F.coalesce("root", "id").alias("group"), (F.col("n") - 1 + F.coalesce("_links", F.lit(0))).alias("n_links"))
    lowest = grouped.groupBy("group").agg(F.min("low").alias("component_id"))
    answer = grouped.join(lowest, "group").select(F.col("label").alias("_label"), F.col("embedding").alias("_embedding"), "n_links", "component_id")
    linked = valid.join(answer, (F.col("label") == F.col("_label")) & (F.col("embedding") == F.col("_embedding")), "left")
    alone = base.where("not fit").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    out = linked.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id")).unionByName(alone)
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def op3_embedding_dedup(rows: DataFrame) -> DataFrame:
    return embedding_groups(rows)
