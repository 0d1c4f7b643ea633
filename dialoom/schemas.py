"""The canonical conversation as a row, and the reports that stages fill in."""

from __future__ import annotations

from dataclasses import asdict, dataclass, field

from pyspark.sql import types as T

MESSAGE = T.StructType([T.StructField("role", T.StringType()), T.StructField("content", T.StringType())])
MESSAGES = T.ArrayType(MESSAGE)
METADATA = T.StructType([T.StructField(c, T.StringType()) for c in ("split", "source_dataset", "original_id", "context")])
CANONICAL = T.StructType([T.StructField("ord", T.LongType()), T.StructField("id", T.StringType()), T.StructField("source", T.StringType()), T.StructField("metadata", METADATA), T.StructField("messages", MESSAGES)])

#: Rows of one dataset in the global order ``ord`` = dataset index * SPAN + row index.
SPAN = 1 << 40


class ConfigError(Exception):
    """A configuration that cannot be run."""


class FilterError(Exception):
    """A conversation has no validation result."""


class MergeError(Exception):
    """Two conversations share an id."""


class ParseError(ValueError):
    """A table lacks columns that its parser needs, or a strict stage met a bad row."""


@dataclass
class ParseReport:
    dataset_id: str
    num_conversations: int = 0
    avg_turns: float = 0.0
    max_turns: int = 0
    min_turns: int = 0
    skipped_conversations: int = 0
    warnings: list[str] = field(default_factory=list)
    errors: list[str] = field(default_factory=list)


@dataclass
class StatisticsReport:
    total_conversations: int = 0
    conversations_per_dataset: dict[str, int] = field(default_factory=dict)
    percentage_contribution_per_dataset: dict[str, float] = field(default_factory=dict)
    average_turns: float = 0.0
    median_turns: float = 0.0
    minimum_turns: int = 0
    maximum_turns: int = 0
    average_user_message_length: float = 0.0
    average_assistant_message_length: float = 0.0
    maximum_message_length: int = 0
    context_distribution: dict[str, int] = field(default_factory=dict)

    def to_dict(self) -> dict:
        return asdict(self)


@dataclass
class MergeReport:
    total_conversations: int = 0
    dataset_counts: dict[str, int] = field(default_factory=dict)
    dataset_order: list[str] = field(default_factory=list)


@dataclass
class CurationReport:
    cleaning: dict = field(default_factory=lambda: {"messages_seen": 0, "messages_changed": 0, "replacements": {}})
    quality: dict = field(default_factory=lambda: {"num_seen": 0, "num_kept": 0, "drops_by_reason": {}})
    counts_before: dict[str, int] = field(default_factory=dict)
    counts_after_quality: dict[str, int] = field(default_factory=dict)
    counts_after_sampling: dict[str, int] = field(default_factory=dict)
    num_train: int = 0
    num_validation: int = 0
    seed: int = 42

    def to_dict(self) -> dict:
        return asdict(self)


@dataclass
class TokenReport:
    total_conversations: int
    total_tokens: int
    average_tokens: float
    median_tokens: float
    minimum_tokens: int
    maximum_tokens: int
    percentile_95_tokens: int
    percentile_99_tokens: int
    average_turns_per_conversation: float
    recommended_context_length: int
    conversations_over_1024: int
    conversations_over_2048: int
    conversations_over_4096: int
    conversations_over_8192: int
    histogram: dict[str, int]

    def to_dict(self) -> dict:
        return asdict(self)
