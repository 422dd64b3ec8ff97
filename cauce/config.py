"""Configuration files: JSON, or YAML where its package is installed."""

from __future__ import annotations

import json
from pathlib import Path


def load(path: str) -> dict:
    """CLI-2: the content of a configuration file; FileNotFoundError if it is missing."""
    text = Path(path).read_text(encoding="utf-8")
    if path.endswith((".yaml", ".yml")):
        try:
            import yaml
        except ImportError as e:
            raise RuntimeError("YAML files need the package yaml; write the configuration as JSON") from e
        return yaml.safe_load(text)
    return json.loads(text)
