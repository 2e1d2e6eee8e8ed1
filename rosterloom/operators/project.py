"""Config-driven projection: the config is read while the plan is built, so what
isn't selected is never computed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rosterloom.schemas import CANONICAL

# Names in a config for fields of a profile.
ALIASES = {"email": "emails", "phone": "phones"}


def selected(config: dict, columns=CANONICAL) -> list[tuple[str, str]]:
    """(field, output name) in output order. Toggles act before selection; the
    identifier is always there; a renamed field moves to the end, over any field
    that has the name already."""
    known = [c for c in columns if not (c == "overall_confidence" and not config.get("include_confidence", True)) and not (c == "provenance" and not config.get("include_provenance", True))]
    fields = config.get("fields")
    wanted = known if fields is None else [ALIASES.get(f, f) for f in fields]
    out = {f: f for f in wanted if f in known}
    if "candidate_id" in known:
        out.setdefault("candidate_id", "candidate_id")
    for old, new in (config.get("rename") or {}).items():
        name = ALIASES.get(old, old)
        if name in out:
            out[new] = out.pop(name)
    return [(field, name) for name, field in out.items()]


def project(profiles: DataFrame, config: dict) -> DataFrame:
    """Selected and renamed columns. A default for missing values replaces nulls of
    string columns; others become their JSON text so that the default fits. Rows
    can't lack columns, so "omit" keeps nulls here; see ``project_json``."""
    policy, out = config.get("missing_policy"), []
    for field, name in selected(config, [c for c in CANONICAL if c in profiles.columns]):
        c, kind = F.col(field), profiles.schema[field].dataType
        if policy not in (None, "omit"):
            if isinstance(kind, T.DoubleType):
                c = F.coalesce(c.cast("string"), F.lit(policy))
            elif isinstance(kind, T.StringType):
                c = F.coalesce(c, F.lit(policy))
            else:
                c = F.coalesce(F.to_json(c, {"ignoreNullFields": "false"}), F.lit(policy))
        out.append(c.alias(name))
    return profiles.select(*out)


def project_json(profiles: DataFrame, config: dict) -> DataFrame:
    """(candidate_id, json): an object for each row, from its own keys: "omit"
    leaves out top-level nulls, empty lists and empty maps, but no nested ones."""
    policy, entries = config.get("missing_policy"), []
    for field, name in selected(config, [c for c in CANONICAL if c in profiles.columns]):
        c, kind = F.col(field), profiles.schema[field].dataType
        # one value as JSON: that of a one-field object without the braces and the key
        text = F.to_json(F.struct(c.alias("v")), {"ignoreNullFields": "false"})
        value = F.substring(text, F.lit(6), F.length(text) - 6)
        if policy == "omit":
            gone = c.isNull() | (F.size(c) == 0 if isinstance(kind, (T.ArrayType, T.MapType)) else F.lit(False))
            value = F.when(~gone, value)
        elif isinstance(policy, str):
            value = F.when(c.isNull(), F.get_json_object(F.to_json(F.struct(F.lit(policy).alias("v"))), "$")).otherwise(value)
            value = F.when(c.isNull(), F.expr(f"substring(to_json(named_struct('v', '{policy.replace(chr(39), chr(92) + chr(39))}')), 6)")).otherwise(value)
            value = F.when(c.isNull(), F.regexp_replace(value, r"\}$", "")).otherwise(value)
        key = F.lit(f'"{name}":')
        entries.append(F.when(value.isNotNull(), F.concat(key, value)))
    kept = F.filter(F.array(*entries), lambda x: x.isNotNull())
    return profiles.select("candidate_id", F.concat(F.lit("{"), F.array_join(kept, ","), F.lit("}")).alias("json"))
