"""Configuration files: YAML where a parser is installed, else JSON, which is YAML too."""

from __future__ import annotations

import json
from pathlib import Path


def load_yaml(path: str | Path) -> object:
    text = Path(path).read_text(encoding="utf-8")
    try:
        import yaml
    except ImportError:
        return json.loads(text)
    return yaml.safe_load(text)
