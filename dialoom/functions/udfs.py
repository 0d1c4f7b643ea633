"""The functions that Spark does not have, as Arrow-batched UDFs (C02, P07 exact, Q05, T02).

Callers send nulls, or filter, so that rows which need no work are cheap.
"""

from __future__ import annotations

import html
import json
from collections.abc import Callable
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf


@pandas_udf(T.StringType())
def _unescape(texts: pd.Series) -> pd.Series:
    return texts.map(html.unescape, na_action="ignore")


@pandas_udf(T.ArrayType(T.StringType()))
def unescape_each(texts: pd.Series) -> pd.Series:
    """Every text of a list; null lists stay null."""
    return texts.map(lambda ts: None if ts is None else [None if t is None else html.unescape(t) for t in ts])


def unescape_entities(c: Column) -> Column:
    """All named and numeric character references; texts without an ampersand never leave the JVM as text."""
    return F.when(F.contains(c, F.lit("&")), F.coalesce(_unescape(F.when(F.contains(c, F.lit("&")), c)), c)).otherwise(c)


@pandas_udf(T.DoubleType())
def sequence_ratio(first: pd.Series, second: pd.Series) -> pd.Series:
    """difflib's similarity, arguments in this order (it is not symmetric); null where either is."""
    return pd.Series([None if a is None or b is None else SequenceMatcher(None, a, b).ratio() for a, b in zip(first, second, strict=True)], dtype="float64")


def strict_json_error(text: str | None) -> str | None:
    """Why a row is no JSON dialogue, by the standard library's rules; None if it is one."""
    if text is None:
        return "missing text"
    try:
        data = json.loads(text)
    except (ValueError, RecursionError):
        return "invalid json"
    if not isinstance(data, dict):
        return "not an object"
    if not isinstance(data.get("dialog"), list):
        return "missing dialog"
    for turn in data["dialog"]:
        if not isinstance(turn, dict):
            return "turn is not an object"
        if turn.get("text") in (None, ""):
            return "empty text"
        speaker = turn.get("speaker")
        if speaker is None or isinstance(speaker, str) and not speaker.strip():
            return "missing speaker"
    return None


@pandas_udf(T.StringType())
def strict_json_errors(texts: pd.Series) -> pd.Series:
    return texts.map(strict_json_error)


def token_counter(make: Callable[[], Callable[[str], int]]):
    """A UDF that counts tokens; ``make`` builds the counter once in each worker."""

    @pandas_udf(T.LongType())
    def count(texts: pd.Series) -> pd.Series:
        counter = make()
        return texts.map(lambda t: None if t is None else counter(t)).astype("Int64")

    return count


def bpe_counter(path: str | None = None):
    """A counter of tokens by a published byte-level vocabulary; ``path``: its file, else the installed one."""

    def make() -> Callable[[str], int]:
        import public_tokenizers
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(str(path or public_tokenizers.path("byte_bpe_50k.json")))
        return lambda text: len(tokenizer.encode(text, add_special_tokens=False).ids)

    return token_counter(make)
