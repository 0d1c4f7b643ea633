"""Dataset catalog (S01-S03): entries, loading, lookup."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from pathlib import Path

SOURCES = ("huggingface", "local")


@dataclass(frozen=True)
class DatasetEntry:
    """One dataset: a hub id for ``huggingface``, a path for ``local``."""

    key: str
    name: str
    source: str
    dataset_id: str | None = None
    local_path: str | None = None
    description: str = ""

    def __post_init__(self):
        if self.source not in SOURCES:
            raise ValueError(f"{self.key}: source must be one of {SOURCES}, not {self.source!r}")
        needed = "dataset_id" if self.source == "huggingface" else "local_path"
        if not getattr(self, needed):
            raise ValueError(f"{self.key}: source {self.source!r} needs {needed}")


class Catalog:
    """Entries in file order, by key."""

    def __init__(self, entries: list[DatasetEntry]):
        self._entries: dict[str, DatasetEntry] = {}
        for e in entries:
            if e.key in self._entries:
                raise ValueError(f"dataset key {e.key!r} is used twice")
            self._entries[e.key] = e

    @classmethod
    def from_dict(cls, raw: object, where: str = "catalog") -> Catalog:
        if not isinstance(raw, dict) or "datasets" not in raw:
            raise KeyError(f"{where} has no 'datasets'")
        if not isinstance(raw["datasets"], list):
            raise TypeError(f"'datasets' in {where} must be a list, not {type(raw['datasets']).__name__}")
        return cls([DatasetEntry(**item) for item in raw["datasets"]])

    @classmethod
    def from_yaml(cls, path: str | Path) -> Catalog:
        from .config import load_yaml

        return cls.from_dict(load_yaml(path), str(path))

    def get(self, key: str) -> DatasetEntry | None:
        return self._entries.get(key)

    def __getitem__(self, key: str) -> DatasetEntry:
        if key not in self._entries:
            raise KeyError(f"dataset {key!r} is not registered; registered: {sorted(self._entries)}")
        return self._entries[key]

    def by_dataset_id(self, dataset_id: str) -> DatasetEntry | None:
        return next((e for e in self if e.dataset_id == dataset_id), None)

    def keys(self) -> list[str]:
        return list(self._entries)

    def list_all(self) -> list[DatasetEntry]:
        return list(self._entries.values())

    def __contains__(self, key: object) -> bool:
        return key in self._entries

    def __iter__(self) -> Iterator[DatasetEntry]:
        return iter(self._entries.values())

    def __len__(self) -> int:
        return len(self._entries)

    def __repr__(self) -> str:
        return f"Catalog({self.keys()})"
