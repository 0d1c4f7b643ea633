"""Exact deduplication by Grace hashing.

Texts are equal when they are identical after lower-casing A-Z only. Records are dealt to tasks by a
digest of the whole text; inside a task they go into an open-addressing table that compares complete
contents, and once the table is over its budget, records are partitioned to spill files by further
digest bits, recursively, until each file fits. The spill files belong to one task and go with it: a
task that is lost is simply run again, and no other task reads them.

Every map task first combines its own copies, so a content that holds a third of all rows sends one row
per task (and budget), not one per copy.

Defined results: a null text counts as empty; a null doc_id is the smallest; of equal texts the row with
the largest doc_id stays, and of rows that repeat that doc_id and text the last in scan order; other
columns are kept as they are; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import os
import struct
import tempfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import LOWER_AZ

RECORD = struct.Struct("<32sqqqqI")  # digest, copies, largest id (LEAST: null), its last row, rows with that id, bytes
LEAST = -(1 << 63)
FAN_OUT_BITS = 4


class ContentTable:
    """Open addressing with linear probing; an entry is found only if the complete content is the same."""

    def __init__(self, slots: int = 1 << 12):
        self.slots = [-1] * slots
        self.digests: list[bytes] = []
        self.contents: list[bytes] = []
        self.entries: list[list[int]] = []
        self.size = 0

    def _place(self, digest: bytes) -> int:
        return int.from_bytes(digest[8:16], "little") & (len(self.slots) - 1)

    def add(self, digest: bytes, content: bytes, n: int, top: int, row: int, same: int) -> None:
        slots, i = self.slots, self._place(digest)
        mask = len(slots) - 1
        while (at := slots[i]) >= 0:
            if self.digests[at] == digest:
                if self.contents[at] != content:
                    raise ValueError(f"two contents share the digest {digest.hex()}")
                entry = self.entries[at]
                entry[0] += n
                if top > entry[1]:
                    entry[1:] = top, row, same
                elif top == entry[1]:
                    entry[2] = max(entry[2], row)
                    entry[3] += same
                return
            i = (i + 1) & mask
        slots[i] = len(self.contents)
        self.digests.append(digest)
        self.contents.append(content)
        self.entries.append([n, top, row, same])
        self.size += len(content) + 200
        if 3 * len(self.contents) > 2 * len(slots):
            self._grow()

    def _grow(self) -> None:
        self.slots = [-1] * (2 * len(self.slots))
        mask = len(self.slots) - 1
        for at, digest in enumerate(self.digests):
            i = self._place(digest)
            while self.slots[i] >= 0:
                i = (i + 1) & mask
            self.slots[i] = at

    def rows(self) -> Iterator[tuple]:
        for digest, content, entry in zip(self.digests, self.contents, self.entries, strict=True):
            yield digest, content, *entry


def grace(records: Iterator[tuple], budget: int, level: int = 0) -> Iterator[tuple]:
    """One record for each distinct content; memory stays near ``budget`` bytes, the rest is spilled and recursed."""
    seen = ContentTable()
    for record in records:
        seen.add(*record)
        # A table of one entry cannot be split, nor can one whose digest bits are used up.
        if seen.size > budget and len(seen.contents) > 1 and level < 256 // FAN_OUT_BITS:
            break
    else:
        yield from seen.rows()
        return
    with tempfile.TemporaryDirectory(prefix="grace-") as folder:
        files = [open(os.path.join(folder, str(k)), "wb", buffering=1 << 16) for k in range(1 << FAN_OUT_BITS)]  # noqa: SIM115
        for source in (seen.rows(), records):
            for digest, content, n, top, row, same in source:
                out = files[_branch(digest, level)]
                out.write(RECORD.pack(digest, n, top, row, same, len(content)))
                out.write(content)
        del seen
        for f in files:
            f.close()
        for k in range(1 << FAN_OUT_BITS):
            path = os.path.join(folder, str(k))
            if os.path.getsize(path):
                yield from grace(_spilled(path), budget, level + 1)
            os.remove(path)


def _branch(digest: bytes, level: int) -> int:
    """Later bits than those that dealt the records to tasks come first."""
    bits = int.from_bytes(digest, "little") >> ((64 + FAN_OUT_BITS * level) % 256)
    return bits & ((1 << FAN_OUT_BITS) - 1)


def _spilled(path: str) -> Iterator[tuple]:
    with open(path, "rb", buffering=1 << 20) as f:
        while head := f.read(RECORD.size):
            digest, n, top, row, same, size = RECORD.unpack(head)
            yield digest, f.read(size), n, top, row, same


def _batches(rows: Iterator[tuple], schema: pa.Schema, most: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += 100 + (len(row[1]) if len(row) > 1 and isinstance(row[1], bytes) else 0)
        if size >= most:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)


CONTENT = pa.schema([("digest", pa.binary()), ("content", pa.binary()), ("n", pa.int64()), ("top", pa.int64()), ("row", pa.int64()), ("same", pa.int64())])
CONTENT_SQL = "digest binary, content binary, n long, top long, row long, same long"
CLASS = pa.schema([("digest", pa.binary()), ("n", pa.int64()), ("top", pa.int64()), ("row", pa.int64()), ("same", pa.int64())])
CLASS_SQL = "digest binary, n long, top long, row long, same long"


def _texts(batch: pa.RecordBatch, name: str = "_text") -> list[bytes]:
    return [b"" if t is None else t.translate(LOWER_AZ) for t in batch.column(name).cast(pa.binary()).to_pylist()]


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sha = hashlib.sha256
    for batch in batches:
        digests = pa.array([sha(t).digest() for t in _texts(batch)], pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column("_id"), batch.column("_row"), digests], ["_id", "_row", "digest"])


def _combine(budget: int):
    """The map side: copies within a task become one record; a full table is sent on as it is."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sha, seen = hashlib.sha256, ContentTable()
        for batch in batches:
            for text, top, row in zip(_texts(batch), batch.column("_id").to_pylist(), batch.column("_row").to_pylist(), strict=True):
                seen.add(sha(text).digest(), text, 1, LEAST if top is None else top, row, 1)
                if seen.size > budget:
                    yield from _batches(seen.rows(), CONTENT)
                    seen = ContentTable()
        yield from _batches(seen.rows(), CONTENT)

    return run


def _classes(budget: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        records = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns), strict=True))
        yield from _batches(((d, n, top, row, same) for d, _, n, top, row, same in grace(records, budget)), CLASS)

    return run


def content_classes(docs: DataFrame, text: str = "text", key: str = "doc_id", budget: int = 48 << 20) -> DataFrame:
    """Rows (digest, n, top, row, same): a class of equal texts, its copies, largest id and that id's last row.

    ``budget``: bytes of contents that a task holds in memory; beyond it, it spills.
    """
    records = docs.select(F.col(key).cast("long").alias("_id"), F.monotonically_increasing_id().alias("_row"), F.col(text).alias("_text")).mapInArrow(_combine(budget), CONTENT_SQL)
    return records.repartition(F.col("digest")).mapInArrow(_classes(budget), CLASS_SQL)


def exact_groups(docs: DataFrame, text: str = "text", key: str = "doc_id", budget: int = 48 << 20) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    classes = content_classes(docs, text, key, budget).withColumn("keep_id", F.when(F.col("top") != LEAST, F.col("top")))
    members = docs.select(F.col(key).cast("long").alias("_id"), F.monotonically_increasing_id().alias("_row"), F.col(text).alias("_text")).mapInArrow(_digest, "_id long, _row long, digest binary")
    # One row per class on the right; a class that holds many rows is split by the skewed-join rule.
    joined = members.join(classes, "digest")
    kept = F.col("_id").eqNullSafe(F.col("keep_id")) & ((F.col("same") == 1) | (F.col("_row") == F.col("row")))
    return joined.select(F.col("_id").alias("doc_id"), "keep_id", F.col("n").alias("group_size"), kept.alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"), F.col("_row").alias("_scan_row"))


def op1_exact_dedup(docs: DataFrame) -> DataFrame:
    return exact_groups(docs).drop("_scan_row")


def _carry(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sha = hashlib.sha256
    for batch in batches:
        digests = pa.array([sha(t).digest() for t in _texts(batch)], pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column("doc"), batch.column("_id"), batch.column("_row"), digests], ["doc", "_id", "_row", "_digest"])


def deduplicated(docs: DataFrame, budget: int = 48 << 20) -> DataFrame:
    """The documents that stay, with all their columns, of any name: each row carries its digest to the join with its class."""
    classes = content_classes(docs, budget=budget)
    doc = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")
    rows = docs.select(doc, F.col("doc_id").cast("long").alias("_id"), F.monotonically_increasing_id().alias("_row"), F.col("text").alias("_text"))
    kinds = T.StructType([rows.schema["doc"], T.StructField("_id", T.LongType()), T.StructField("_row", T.LongType()), T.StructField("_digest", T.BinaryType())])
    keep = F.col("_id").eqNullSafe(F.when(F.col("top") != LEAST, F.col("top"))) & ((F.col("same") == 1) | (F.col("_row") == F.col("row")))
    return rows.mapInArrow(_carry, kinds).join(classes, F.col("_digest") == F.col("digest")).where(keep).select("doc.*")


ORACLE = r"""
WITH d AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
  FROM documents
), g AS (SELECT text_sha256, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY 1)
SELECT d.doc_id, g.keep_id, CAST(g.group_size AS BIGINT) AS group_size, d.doc_id = g.keep_id AS kept, text_sha256
FROM d JOIN g USING (text_sha256)
"""
