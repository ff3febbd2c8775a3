"""Settings: YAML or JSON files with environment variables, and overrides by dotted names."""

from __future__ import annotations

import json
import os
from copy import deepcopy
from pathlib import Path

DEFAULTS = {
    "sampling": {"min_steps": 2, "max_steps": 5, "min_completeness": 0.0, "max_attempts": 100},
    "similarity": {"threshold": 0.7, "top_k": 0},
    "quality": {"min_score": 6.0, "max_retries": 3, "repair_threshold": 6},
    "generation": {"max_turns": 20, "seed": 42},
}


def _filled(text: str) -> str:
    """The text with the values of its variables; what is no variable stays. A default ends at the first brace, so none is nested."""
    out, at = [], 0
    while (start := text.find("${", at)) >= 0 and (end := text.find("}", start)) >= 0:
        name, given, default = text[start + 2 : end].partition(":-")
        if not name or ":" in name:
            out.append(text[at : start + 2])
            at = start + 2
            continue
        if name not in os.environ and not given:
            raise ValueError(f"the environment has no {name}, and no default is given")
        out += [text[at:start], os.environ.get(name, default)]
        at = end + 1
    return "".join(out) + text[at:]


def expand(value):
    """${NAME} and ${NAME:-default} in strings, at any depth; words for true and false become booleans."""
    if isinstance(value, dict):
        return {k: expand(v) for k, v in value.items()}
    if isinstance(value, list):
        return [expand(v) for v in value]
    if not isinstance(value, str):
        return value
    text = _filled(value)
    return {"true": True, "false": False}.get(text.lower(), text)


def merge(base: dict, more: dict) -> dict:
    out = deepcopy(base)
    for k, v in more.items():
        out[k] = merge(out[k], v) if isinstance(v, dict) and isinstance(out.get(k), dict) else v
    return out


def _yaml():
    try:
        import yaml
    except ImportError as e:
        raise RuntimeError("YAML settings need the yaml package; JSON works without") from e
    return yaml


def load(path: str | Path) -> dict:
    """The defaults, with what the file says."""
    text = Path(path).read_text(encoding="utf-8")
    read = json.loads(text) if str(path).endswith(".json") else _yaml().safe_load(text)
    return merge(DEFAULTS, expand(read or {}))


def override(config: dict, **values) -> dict:
    """Values by dotted names (dots or double underscores); None changes nothing."""
    for name, value in values.items():
        if value is not None:
            for part in reversed(name.replace("__", ".").split(".")):
                value = {part: value}
            config = merge(config, value)
    return config


def save(config: dict, path: str | Path) -> None:
    Path(path).write_text(json.dumps(config, indent=2) if str(path).endswith(".json") else _yaml().safe_dump(config), encoding="utf-8")


def warnings(config: dict) -> list[str]:
    found = []
    s = config.get("sampling", {})
    if s.get("min_steps", 1) > s.get("max_steps", 1):
        found.append("sampling: min_steps is above max_steps")
    if not 0 <= config.get("similarity", {}).get("threshold", 0) <= 1:
        found.append("similarity: the threshold is outside 0 to 1")
    if not 1 <= config.get("quality", {}).get("min_score", 1) <= 10:
        found.append("quality: min_score is outside 1 to 10")
    return found
