"""Outputs: a pair's two JSON files, and the same of many profiles as tables."""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import DataFrame


def write_json(value: dict, path: str | Path) -> bool:
    """Indented JSON as written; False if the file can't be written."""
    try:
        Path(path).parent.mkdir(parents=True, exist_ok=True)
        Path(path).write_text(json.dumps(value, indent=2, ensure_ascii=False, default=str), encoding="utf-8")
    except OSError:
        return False
    return True


def write_tables(profiles: DataFrame, transformed: DataFrame, folder: str, mode: str = "overwrite") -> None:
    """Both outputs of a batch: JSON lines that keep nulls, written by all tasks.
    The caller persists what the two have in common."""
    profiles.write.mode(mode).option("ignoreNullFields", "false").json(f"{folder}/canonical_profile")
    transformed.select("json").write.mode(mode).text(f"{folder}/transformed_profile")
