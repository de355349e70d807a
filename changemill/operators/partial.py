"""Deletes with an incomplete key and truncate markers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changemill.functions.columns import col
from changemill.operators.joins import one_row_per_key, spread, update_from, without
from changemill.spec import FLAG_COL, OP_COL, Op


#: Tables known to send deletes with an incomplete key, and the key column these leave out
#: (fixed values).
KNOWN_UNUSED = {"bseg": ["pageno"], "bset": ["pageno"], "bsem": ["pageno"]}


def unused_keys(table: str, configured: dict[str, list[str]] = {}) -> list[str]:
    """Key columns that a partial-key delete of this table leaves out; none for most tables.

    A configured entry replaces the known one.
    """
    return list(configured.get(table, KNOWN_UNUSED.get(table, [])))


def _used(keys: list[str], unused: list[str]) -> list[str]:
    used = [k for k in keys if k not in unused]
    if not used:
        raise ValueError("a partial-key delete needs at least one used key column")
    return used


def multi_delete_hard(
    t: DataFrame, b: DataFrame, keys: list[str], unused: list[str], op_col: str = OP_COL
) -> DataFrame:
    """Remove every target row whose used key columns equal a partial-key delete."""
    used = _used(keys, unused)
    gone = b.filter(col(op_col) == Op.PARTIAL_DELETE).select(*[col(k) for k in used]).distinct()
    return without(t, spread(gone), used, null_safe=False)


def multi_delete_soft(
    t: DataFrame,
    b: DataFrame,
    keys: list[str],
    unused: list[str],
    op_col: str = OP_COL,
    flag_col: str = FLAG_COL,
    keep_unused_keys: bool = True,
) -> DataFrame:
    """Set all columns of the target rows covered by a flagged partial-key delete.

    The delete row has no value for the unused key columns; they keep the target's value
    unless ``keep_unused_keys=False``.
    """
    used = _used(keys, unused)
    cols = [c for c in t.columns if c in b.columns]
    if keep_unused_keys:
        cols = [c for c in cols if c not in unused]
    rows = b.filter((col(flag_col) == 1) & (col(op_col) == Op.PARTIAL_DELETE))
    return update_from(t, one_row_per_key(rows, used, cols), used, cols)


def multi_delete_flag(
    t: DataFrame,
    b: DataFrame,
    keys: list[str],
    unused: list[str],
    flag_col: str = FLAG_COL,
    op_col: str = OP_COL,
) -> DataFrame:
    """Set only the flag of the target rows that share the used key columns of a delete."""
    used = _used(keys, unused)
    rows = b.filter((col(op_col) == Op.DELETE) & (col(flag_col) == 1))
    rows = rows.select(*[col(k) for k in used], col(flag_col)).distinct()
    return update_from(t, spread(rows), used, [flag_col], null_safe=False)


def apply_truncate(t: DataFrame, b: DataFrame, listed: bool = True, op_col: str = OP_COL) -> DataFrame:
    """The target, or no rows if the change set holds a truncate marker.

    The marker test is one subquery that stops at its first hit; it is no join.
    """
    if not listed:
        return t
    return t.filter(~b.filter(col(op_col) == Op.TRUNCATE).exists())
