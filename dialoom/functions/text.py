"""Text functions as Column builders (C01, C03-C08, D01, D02, Q06 and Unicode white space).

Each is a composition of built-in expressions, so all of them stay in generated code.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space as Python's str methods and ``re`` see it; Java's class lacks the four separators.
WHITE = r"\s\x{1c}-\x{1f}"
WHITE_CLASS = f"(?U)[{WHITE}]"

# Placeholder spellings of punctuation in the sources, and what they stand for.
PLACEHOLDERS = (("comma", "_comma_", ","), ("period", "_period_", "."), ("quote", "_quote_", '"'))
MISSING_SPACE = r"(?<=[a-z])([.!?])(?=[A-Z])"
URL = f"(?U)https?://[^{WHITE}]+|www\\.[^{WHITE}]+"


def py_strip(c: Column) -> Column:
    return F.regexp_replace(c, f"(?U)\\A[{WHITE}]+|[{WHITE}]+\\z", "")


def is_blank(c: Column) -> Column:
    """True for null, empty and white-space-only text."""
    return c.isNull() | ~F.rlike(c, F.lit(f"(?U)[^{WHITE}]"))


def chars(c: Column) -> Column:
    return F.length(c).cast("long")


def occurrences(c: Column, literal: str) -> Column:
    return ((F.length(c) - F.length(F.replace(c, F.lit(literal), F.lit("")))) / F.lit(len(literal))).cast("long")


def replace_placeholders(c: Column) -> Column:
    for _, spelling, mark in PLACEHOLDERS:
        c = F.replace(c, F.lit(spelling), F.lit(mark))
    return c


def placeholder_counts(c: Column) -> dict[str, Column]:
    """Matches of each placeholder, counted on the text as the earlier ones left it."""
    out = {}
    for name, spelling, mark in PLACEHOLDERS:
        out[name] = occurrences(c, spelling)
        c = F.replace(c, F.lit(spelling), F.lit(mark))
    return out


def space_after_sentence(c: Column) -> Column:
    return F.regexp_replace(c, MISSING_SPACE, "$1 ")


def missing_spaces(c: Column) -> Column:
    return F.regexp_count(c, F.lit(MISSING_SPACE)).cast("long")


def strip_urls(c: Column) -> Column:
    return F.regexp_replace(c, URL, "")


def url_count(c: Column) -> Column:
    return F.regexp_count(c, F.lit(URL)).cast("long")


def collapse_horizontal(c: Column) -> Column:
    """Two or more white-space characters other than line feeds become one blank."""
    return F.regexp_replace(c, f"(?U)[{WHITE}&&[^\\n]]{{2,}}", " ")


def collapse_newlines(c: Column) -> Column:
    return F.regexp_replace(c, "\n{3,}", "\n\n")


def normalise_for_hash(c: Column) -> Column:
    """Lower case, every run of white space one blank, stripped (line ends need no step of their own)."""
    return F.regexp_replace(F.regexp_replace(F.lower(c), f"(?U)[{WHITE}]+", " "), "\\A +| +\\z", "")


def conversation_hash(messages: Column) -> Column:
    """SHA-256 of the compact JSON of (content, role) pairs; metadata does not count."""
    pairs = F.transform(messages, lambda m: F.struct(normalise_for_hash(m["content"]).alias("content"), m["role"].alias("role")))
    return F.sha2(F.to_json(pairs, {"ignoreNullFields": "false"}), 256)


def normalise_for_echo(c: Column) -> Column:
    """Lower case, only a-z, 0-9 and blanks stay, stripped."""
    return F.trim(F.regexp_replace(F.lower(c), "[^a-z0-9 ]+", ""))
