"""The corpus pipeline: toxicity filter, exact dedup, near-dedup by 5-word shingles, mixing to target weights, packing.

Each stage works on all rows that its predecessor kept, and hands on the columns of ``documents``; the last
one returns the packed pieces. ``run`` writes every stage as Parquet below the shared checkpoint folder and
reads it again, so a lost executor never sends a later stage back to the start. A stage's folder is removed once
its successor is written; the last one stays, as the result reads it.

Defined results: a null text counts as empty, so of all null and empty texts one row stays, the one with the
largest doc_id (of rows that repeat it too); it scores by the intercept, has size 0 and is not taken by the mix.
A null doc_id is an id of its own, and the smallest. White space alone is near to empty. A null source is a source of
its own. Very long texts are read whole. Columns that are not the documents' own, of any name, are carried along. An
empty table gives no rows.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from dialoom.llm import exact_dedup, mixing, packing, simhash_dedup, toxicity
from dialoom.llm.common import ensure_checkpoint_dir, table


def filter_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the threshold; labels outside the held-out fold train the score."""
    return toxicity.accepted(docs, table(spark, sf_dir, "labels"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the row with the largest doc_id."""
    return exact_dedup.deduplicated(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near-duplicates (5-word shingles, similarity 0.8 or more), the document with the smallest doc_id."""
    return simhash_dedup.representatives(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as many times as the mix takes it."""
    return mixing.repeated(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of at most 2048 tokens."""
    return packing.packed(docs)


STAGES = [("toxicity", filter_toxic), ("exact_dedup", drop_copies), ("simhash_dedup", drop_near_copies), ("mixing", mix_sources), ("packing", pack)]

#: Learned scores, fingerprints and token ids are beyond SQL; tests hold the stages against plain versions.
ORACLE_SQL = None


def remove(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_checkpoint_dir(spark)
    folder = f"{spark.sparkContext.getCheckpointDir()}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        if k == len(STAGES) - 1:
            return out
        out.write.parquet(f"{folder}/{k}-{name}")
        docs = spark.read.parquet(f"{folder}/{k}-{name}")
        if k:
            remove(spark, f"{folder}/{k - 1}-{STAGES[k - 1][0]}")
    return docs
