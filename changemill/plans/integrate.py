"""One integrate cycle as one lazy plan: truncate, partial deletes, then the merge."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changemill.functions.columns import col
from changemill.operators import merge, partial
from changemill.operators.changes import by_op, coalesce_changes
from changemill.operators.joins import append, touched
from changemill.schema.evolve import evolve_table, new_columns
from changemill.spec import ApplySpec, Op


def coalesced(b: DataFrame, spec: ApplySpec) -> DataFrame:
    """The change set with one row per key, if the spec names an order."""
    if not spec.order:
        return b
    if not spec.truncate:
        # markers mean nothing to this table, so they must not cut its log either
        b = b.filter(~col(spec.op_col).eqNullSafe(F.lit(Op.TRUNCATE)))
    return coalesce_changes(b, spec.merge_keys, list(spec.order), spec.op_col, list(spec.unused_keys))


def append_history(t: DataFrame, b: DataFrame) -> DataFrame:
    """All changes go to the history as they are."""
    return append(t, b)


def integrate(t: DataFrame, b: DataFrame, spec: ApplySpec) -> DataFrame:
    """The new target after one change set.

    With ``spec.order`` the change set may hold any number of rows per key; without it the
    caller vouches for one row per key, except for the delete-and-insert pair of a key
    change. Columns the target lacks fail, are added, or are left out (``spec.new_columns``).
    """
    fresh = new_columns(b.columns, t.columns, spec.order, (spec.op_col, spec.flag_col))
    if fresh and spec.new_columns == "fail":
        raise ValueError(f"columns not in the target: {fresh}")
    if fresh and spec.new_columns == "add":
        types = {f.name: f.dataType.simpleString() for f in b.schema.fields}
        t = evolve_table(t, {c: types[c] for c in fresh})
    if spec.style == "history":
        return merge.merge_history(t, b, spec.merge_keys, spec.null_safe) if spec.merge_history else append_history(t, b)

    keys, op, log = spec.merge_keys, spec.op_col, b
    # control rows are taken from the log as it is: a filter that reaches the scan. Those
    # older than a truncate marker meet an empty target and do nothing
    if op in b.columns:
        t = partial.apply_truncate(t, log, spec.truncate, op)
    if spec.unused_keys:
        unused = list(spec.unused_keys)
        if spec.style == "replicate":
            t = partial.multi_delete_hard(t, log, keys, unused, op)
        else:
            t = partial.multi_delete_soft(t, log, keys, unused, op, spec.flag_col)

    if spec.keyless:
        return merge.merge_soft_nokey(t, log, keys, op, spec.null_safe)
    net = coalesced(log, spec)
    if spec.style == "soft_delete":
        return merge.merge_soft(t, net, keys, op, spec.flag_col, spec.null_safe, spec.unique_keys, check=not spec.order)
    if spec.split_inserts:
        return merge.merge_then_insert(t, net, keys, op, spec.null_safe, check=not spec.order)
    if spec.order:
        return merge.merge_log(t, log, net, keys, op, spec.null_safe, spec.unique_keys)
    return merge.merge_key_change(t, net, keys, op, spec.null_safe, spec.unique_keys)


def plain_changes(spec: ApplySpec, changed: list[str], target: list[str]) -> bool:
    """Is ``integrate`` a merge that replaces whole rows by key (``merge_key_change`` on unique keys)?"""
    other = spec.order or spec.truncate or spec.unused_keys or spec.keyless or spec.split_inserts or not spec.unique_keys
    fresh = new_columns(changed, target, spec.order, (spec.op_col, spec.flag_col))
    return spec.style == "replicate" and not other and set(target) <= set(changed) and not (fresh and spec.new_columns != "ignore")


def integrate_touched(t: DataFrame, b: DataFrame, spec: ApplySpec) -> DataFrame:
    """``integrate`` for the partitions that occur in ``b``: their new rows, nothing of the others.

    For ``sinks.files.write_touched``. The partition columns join the merge keys, and
    ``spec.partition_stable`` vouches that no key moves to another partition: a changed partition
    value would leave the old row behind.
    """
    if not spec.partition_stable:
        raise ValueError("integrate_touched needs partition_stable=True")
    return integrate(touched(t, b, list(spec.partition_cols)), b, spec)


def changes_of(b: DataFrame, spec: ApplySpec, *ops: int) -> DataFrame:
    return by_op(b, *(ops or (Op.INSERT, Op.UPDATE, Op.DELETE)), op_col=spec.op_col)


def preloaded(b: DataFrame, suffix: str, name: str) -> tuple[DataFrame, str]:
    """A change set that was loaded elsewhere, and the table it belongs to: its name
    without the staging suffix."""
    return b, name[: -len(suffix)] if suffix and name.endswith(suffix) else name
