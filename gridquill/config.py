"""Settings: defaults, a YAML file over them, and paths from the environment."""

from __future__ import annotations

import copy
import os
from pathlib import Path

#: Fixed values.
DEFAULTS: dict = {
    "extraction": {"table_ref_line_base": 1},
    "retrieval": {
        "top_k": 20, "fetch_multiplier": 6, "fallback_quota": 2, "candidates_in_prompt": 4, "submission_tables": 5, "max_csv_chars": 6000,
        "year_expand": True, "min_table_cells": 4, "require_numeric": True,
    },
    "generation": {"model": "7B", "fallback_model": "3B", "load_in_4bit": True, "max_new_tokens": 320, "temperature": 0.0, "max_prompt_chars": 24000},
    "execution": {"timeout_s": 20, "startup_timeout_s": 120},
    "answer": {"abs_tol": 0.0, "rel_tol": 2e-4, "fallback_answer": 0.0},
}

EXTRACTION_VERSION = 3


def merged(base: dict, over: dict) -> dict:
    """A copy of base with over's values; mappings are merged key by key."""
    out = copy.deepcopy(base)
    for key, value in over.items():
        out[key] = merged(out[key], value) if isinstance(value, dict) and isinstance(out.get(key), dict) else copy.deepcopy(value)
    return out


def load_config(path: str | Path | None = None) -> dict:
    """Defaults, with the YAML file's values where it exists. A file that isn't a mapping is an error."""
    if path is None or not Path(path).exists():
        return copy.deepcopy(DEFAULTS)
    import yaml

    found = yaml.safe_load(Path(path).read_text(encoding="utf-8"))
    if found is None:
        found = {}
    if not isinstance(found, dict):
        raise ValueError(f"{path} must hold a mapping")
    return merged(DEFAULTS, found)


def paths(root: str | None = None) -> dict[str, str]:
    """Data, interim and output folders: GRIDQUILL_DATA_DIR, GRIDQUILL_INTERIM_DIR, GRIDQUILL_OUT_DIR, or below root."""
    root = root or os.getcwd()
    return {
        "data": os.environ.get("GRIDQUILL_DATA_DIR", f"{root}/data"),
        "interim": os.environ.get("GRIDQUILL_INTERIM_DIR", f"{root}/interim"),
        "out": os.environ.get("GRIDQUILL_OUT_DIR", f"{root}/out"),
    }


def extraction_key(config: dict) -> str:
    """Version of an extraction cache. It holds the line base, so a change of that extracts again."""
    return f"{EXTRACTION_VERSION}-{config['extraction']['table_ref_line_base']}"
