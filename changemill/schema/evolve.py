"""Schema drift between a change set and its target, and derived columns."""

from __future__ import annotations

from fnmatch import fnmatchcase

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changemill.spec import FLAG_COL, OP_COL


def new_columns(
    source: list[str], target: list[str], derived: list[str] = (), burst_only: list[str] = (OP_COL, FLAG_COL)
) -> list[str]:
    """Source columns the target lacks, in source order; names compare without case."""
    known = {c.lower() for c in [*target, *derived, *burst_only]}
    return [c for c in source if c.lower() not in known]


def detect_drift(src: DataFrame, tgt: DataFrame, derived: list[str] = (), evolve: bool = True) -> list[str]:
    """New columns of the data; an error if there are any and evolution is off."""
    found = new_columns(src.columns, tgt.columns, derived)
    if found and not evolve:
        raise ValueError(f"columns not in the target: {found}")
    return found


def evolve_table(t: DataFrame, types: dict[str, str]) -> DataFrame:
    """The target with new columns; rows already there get NULL."""
    fresh = {c: F.lit(None).cast(d) for c, d in types.items() if c not in t.columns}
    return t.withColumns(fresh) if fresh else t


def evolve_for(t: DataFrame, src: DataFrame, types: dict[str, str] | None = None) -> DataFrame:
    """Add what ``src`` has and the target lacks; types from ``types``, else from the data."""
    have = {f.name: f.dataType.simpleString() for f in src.schema.fields}
    names = detect_drift(src, t)
    return evolve_table(t, {c: (types or {}).get(c, have[c]) for c in names})


def derived_columns(df: DataFrame, exprs: dict[str, str]) -> DataFrame:
    """Add columns generated from others, e.g. partition columns, as SQL expressions."""
    return df.withColumns({c: F.expr(e) for c, e in exprs.items()})


def partition_columns(spec: dict[str, list[str]], table: str) -> list[str]:
    """Partition columns of a table: exact name first, then a wildcard, then ``*``."""
    if table in spec:
        return spec[table]
    for pattern, cols in spec.items():
        if pattern == "*":
            continue
        hit = fnmatchcase(table, pattern.removeprefix("!"))
        if hit != pattern.startswith("!"):
            return cols
    return spec.get("*", [])

