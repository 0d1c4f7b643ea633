"""The stateless stages and exact dedup on streams of canonical conversations: an extension, batch and stream share the code."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import conversation_hash
from ..operators import curate, validate


def clean_stream(df: DataFrame, strip_urls: bool = True, min_chars: int = 40) -> DataFrame:
    """Valid, cleaned and shaped conversations; narrow, so it holds no state."""
    kept, _ = validate.filter_valid(validate.validated(df))
    shaped = curate.shape_turns(curate.clean_conversations(kept, strip_urls), min_chars=min_chars)
    return shaped.where(curate.cheap_reason(F.col("messages"), min_chars=min_chars).isNull())


def dedup_stream(df: DataFrame, time: str, delay: str = "1 hour") -> DataFrame:
    """The first of equal conversations within the watermark; state is one hash for each until it passes."""
    return df.withColumn("hash", conversation_hash(F.col("messages"))).withWatermark(time, delay).dropDuplicatesWithinWatermark(["hash"])
