"""Runtime configuration: read and checked on the driver, used while plans are built."""

from __future__ import annotations

from pathlib import Path

STRATEGIES = ("union", "prefer_first", "prefer_last")


def load(path: str | Path) -> dict:
    """The YAML mapping; a missing, malformed or empty file, or one that holds no
    mapping, is an empty config."""
    import yaml

    try:
        found = yaml.safe_load(Path(path).read_text(encoding="utf-8"))
    except (OSError, UnicodeDecodeError, yaml.YAMLError):
        return {}
    return found if isinstance(found, dict) else {}


def check(config: dict) -> list[str]:
    """What is wrong with a config; an empty list if nothing is."""
    found = []
    if not isinstance(config.get("fields"), list):
        found.append("Missing or invalid 'fields' key — must be a list")
    order = config.get("source_priority")
    if order is not None and not isinstance(order, dict):
        found.append("'source_priority' must be a dict")
    for key, value in order.items() if isinstance(order, dict) else ():
        if not isinstance(value, list) and not (isinstance(value, dict) and value.get("merge") in STRATEGIES):
            found.append(f"Invalid merge strategy for '{key}': must be 'union', 'prefer_first', or 'prefer_last'")
    if config.get("missing_policy") is not None and not isinstance(config["missing_policy"], str):
        found.append("Invalid 'missing_policy' value")
    if "rename" in config and not isinstance(config["rename"], dict):
        found.append("'rename' must be a dict")
    found += [f"'{k}' must be bool" for k in ("include_confidence", "include_provenance") if k in config and not isinstance(config[k], bool)]
    return found
