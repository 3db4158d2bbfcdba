"""Settings of a pipeline: defaults, a JSON (or YAML, if there is a reader) file, the environment.

Keys for services come from the environment only and are not written out.
"""

from __future__ import annotations

import copy
import json
import os
from pathlib import Path
from typing import Any

# Default settings.
DEFAULTS: dict[str, Any] = {
    "paths": {"data": "./data", "output": "./output", "logs": "./logs"},
    "download": {"max_retries": 3, "timeout": 30, "finders": ["generic_citation", "pubmed_central", "acs", "nejm", "science_direct"]},
    "ocr": {"dpi": 200, "max_retries": 1},
    "tables": {"context_lines": 5},
    "model": {"name": "", "temperature": 0.0},
}


def merged(base: dict, over: dict) -> dict:
    out = copy.deepcopy(base)
    for k, v in over.items():
        out[k] = merged(out[k], v) if isinstance(v, dict) and isinstance(out.get(k), dict) else copy.deepcopy(v)
    return out


class Config:
    def __init__(self, path: str | None = None, environment: dict[str, str] | None = None, prefix: str = "LITSPARK_"):
        self.values = copy.deepcopy(DEFAULTS)
        if path:
            self.values = merged(self.values, self.read(path))
        for name, value in (os.environ if environment is None else environment).items():
            if name.startswith(prefix):
                self.set(name.removeprefix(prefix).lower().replace("__", "."), value)

    @staticmethod
    def read(path: str) -> dict:
        text = Path(path).read_text(encoding="utf-8")
        if path.endswith((".yaml", ".yml")):
            try:
                import yaml
            except ImportError as e:
                raise ValueError("no YAML reader is installed; use JSON") from e
            return yaml.safe_load(text) or {}
        return json.loads(text)

    def get(self, path: str, default: Any = None) -> Any:
        """The value at a dotted path."""
        at: Any = self.values
        for part in path.split("."):
            if not isinstance(at, dict) or part not in at:
                return default
            at = at[part]
        return at

    def set(self, path: str, value: Any) -> None:
        *parents, last = path.split(".")
        at = self.values
        for part in parents:
            at = at.setdefault(part, {})
        at[last] = value

    def save(self, path: str) -> None:
        Path(path).write_text(json.dumps(self.values, ensure_ascii=False, indent=2), encoding="utf-8")
