"""Applying a change set to a target with merge semantics.

All functions take a target ``t``, a change set ``b`` and key columns, and give the new
target. ``b`` should hold one row per key (see ``changes.coalesce_changes``); where
several rows are allowed the docstring says so. Control rows (truncate markers and
partial-key deletes) never reach the target from here; see ``partial``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from changemill.functions.columns import col
from changemill.operators.changes import latest, row_changes
from changemill.operators.joins import (
    _TWICE,
    align,
    append,
    fail_if,
    key_side,
    key_test,
    keys_in,
    matching,
    missing,
    one_row_per_key,
    repeated,
    replace,
    several,
    spread,
    update_from,
    without,
)
from changemill.spec import FLAG_COL, OP_COL, Op


def _shared(t: DataFrame, b: DataFrame) -> list[str]:
    return [c for c in t.columns if c in b.columns]


def _replaces(t: DataFrame, b: DataFrame, unique_keys: bool) -> bool:
    """May a matched row simply be replaced? Yes with unique target keys and no column that
    only the target has: then one anti join does, and the target is read once."""
    return unique_keys and len(_shared(t, b)) == len(t.columns)


def _keys_of(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.select(*[col(k) for k in keys])


def _checked(rows: DataFrame, by: list[str], check: bool) -> DataFrame:
    return repeated(rows, by) if check else rows


def _upsert(t, live, keys, null_safe, unique_keys, check):
    """Write the rows of ``live`` over the rows with their key."""
    if _replaces(t, live, unique_keys):
        return append(without(t, live, keys, null_safe, once=check), live)
    kept = update_from(t, _checked(live, keys, check), keys, _shared(t, live), null_safe)
    return append(kept, missing(live, t, keys, null_safe))


class ApplyCounts:
    """Rows that a merge deletes, updates and inserts, counted while its result is written.

    Given to one merge; ``get`` waits for the first action on the result. No query of its own
    runs: the counts are metrics of the merge's join and of the scan of its change set.
    """

    def __init__(self) -> None:
        self._met, self._live = Observation(), Observation()

    def on_join(self, joined: DataFrame, met: Column, op: Column) -> DataFrame:
        """Count target rows that meet a change row with code ``op``."""
        n = lambda c: F.count(F.when(met & c, 1))
        return joined.observe(self._met, n(op == Op.DELETE).alias("deleted"), n(op != Op.DELETE).alias("updated"))

    def on_outer_join(self, joined: DataFrame, known: Column, met: Column, op: Column) -> DataFrame:
        n = lambda c: F.count(F.when(c, 1))
        self._live = None
        return joined.observe(self._met, n(known & met & (op == Op.DELETE)).alias("deleted"), n(known & met & (op != Op.DELETE)).alias("updated"),
                              n(~known & (op != Op.DELETE)).alias("inserted"))

    def on_live(self, live: DataFrame) -> DataFrame:
        """Count the rows that are written: over a matched row or as a new one."""
        return live.observe(self._live, F.count(F.lit(1)).alias("live"))

    @property
    def get(self) -> dict[str, int]:
        found = dict(self._met.get)
        if self._live is not None:
            found["inserted"] = self._live.get["live"] - found["updated"]
        return found

    def frame(self, spark) -> DataFrame:
        """(action, n_rows); actions that didn't occur are left out."""
        return spark.createDataFrame([(a, n) for a, n in self.get.items() if n], "action string, n_rows long")


def merge_hard(
    t: DataFrame,
    b: DataFrame,
    keys: list[str],
    op_col: str = OP_COL,
    null_safe: bool = True,
    unique_keys: bool = True,
    check: bool = True,
    counts: ApplyCounts | None = None,
) -> DataFrame:
    """Matched deletes remove the row, other matches set all columns, unmatched rows that
    are no deletes are inserted and unmatched deletes are ignored.

    ``unique_keys=False`` updates every duplicate of a target key. A target row that several
    change rows match fails the job; of several rows with a key that the target lacks all are
    inserted or ignored. ``check=False`` is for a set that holds a key once. ``counts``: see
    ``ApplyCounts``; without unique keys it needs ``merge_outer``.
    """
    rows = row_changes(b, op_col).filter(col(op_col).isNotNull())
    live = rows.filter(col(op_col) != Op.DELETE)
    if counts is not None:
        if not _replaces(t, b, unique_keys):
            raise ValueError("merge_outer counts where target keys repeat or the target has columns of its own")
        kept = without(t, rows, keys, null_safe, once=True, op=col(op_col), watch=counts.on_join)
        return append(kept, counts.on_live(live))
    if _replaces(t, b, unique_keys):
        return append(without(t, rows, keys, null_safe, once=check), live)
    kept = update_from(t, _checked(rows, keys, check), keys, _shared(t, b), null_safe, drop=col(op_col) == Op.DELETE)
    return append(kept, missing(live, t, keys, null_safe))


def merge_outer(
    t: DataFrame,
    b: DataFrame,
    keys: list[str],
    op_col: str = OP_COL,
    null_safe: bool = True,
    check: bool = True,
    counts: ApplyCounts | None = None,
) -> DataFrame:
    """``merge_hard`` with ``unique_keys=False`` as one full outer join, so one scan of the target.

    Every duplicate of a target key is updated, columns that only the target has keep their
    values (NULL in new rows). Presence is told by markers, as keys may be NULL. Both sides
    shuffle on the keys whatever the size of the change set, and Spark splits no hot key of a full
    outer join: this is the form for a change set that would be shuffled anyway, over keys of
    which none holds a large share of the rows. ``merge_hard`` scans the target's keys a second
    time, broadcasts small change sets and splits hot keys.
    """
    rows = row_changes(b, op_col).filter(col(op_col).isNotNull())
    cols = [c for c in _shared(t, b) if c not in keys]
    value = {c: f"__mill_v{i}" for i, c in enumerate(cols)}
    marked = _checked(rows, keys, check)
    side = marked.select(*key_side(marked, keys), *[col(c).alias(v) for c, v in value.items()], col(op_col).alias("__mill_op"),
                         *[_TWICE] * check, F.lit(True).alias("__mill_change"))
    joined = t.withColumn("__mill_known", F.lit(True)).join(side, key_test(keys, null_safe), "full_outer")
    known, met, op = F.col("__mill_known").isNotNull(), F.col("__mill_change").isNotNull(), F.col("__mill_op")
    if check:
        joined = joined.filter(F.when(known & F.col(_TWICE), several()).otherwise(F.lit(True)))
    if counts is not None:
        joined = counts.on_outer_join(joined, known, met, op)
    types = {f.name: f.dataType for f in t.schema.fields}
    new = {**{k: F.col(f"__mill_k{i}") for i, k in enumerate(keys)}, **{c: F.col(v) for c, v in value.items()}}
    out = [F.when(~known if c in keys else met, new[c].cast(types[c])).otherwise(col(c)).alias(c) if c in new else col(c) for c in t.columns]
    return joined.filter(~met | (op != Op.DELETE)).select(*out)


def merge_key_change(
    t: DataFrame,
    b: DataFrame,
    keys: list[str],
    op_col: str = OP_COL,
    null_safe: bool = True,
    unique_keys: bool = True,
    check: bool = True,
) -> DataFrame:
    """``merge_hard`` for change sets where a key may be deleted and written again.

    If several change rows match a target row, the deletes go first (plain key equality)
    and the other rows are merged after them. A surviving target row that is still matched
    by several rows fails the job (``check``).
    """
    rows = row_changes(b, op_col).filter(col(op_col).isNotNull())
    live = rows.filter(col(op_col) != Op.DELETE)
    gone = rows.filter(col(op_col) == Op.DELETE)
    facts = _ambiguity(t, rows, keys, op_col, null_safe).scalar() if null_safe or check else None
    if null_safe:
        # a delete with a NULL in its key counts only while no target row is ambiguous
        gone = gone.filter(_known(keys) | ~F.coalesce(facts["ambiguous"], F.lit(False)))
    if _replaces(t, b, unique_keys):
        changed = _keys_of(live, keys).unionAll(_keys_of(gone, keys))
        out = append(without(t, changed, keys, null_safe), live)
    else:
        # one join with the target: the deletes of a key come before its other rows
        first = _first_op(live.unionByName(gone), keys, op_col)
        kept = update_from(t, first, keys, _shared(t, b), null_safe, drop=col(op_col) == Op.DELETE)
        held = without(matching(_keys_of(t, keys), live, keys, null_safe).distinct(), gone, keys, null_safe)
        out = append(kept, without(live, held, keys, null_safe))
    if check:
        stop = F.raise_error(F.lit("several change rows match one target row")).cast("boolean")
        out = out.filter(F.when(F.coalesce(facts["clash"], F.lit(False)), stop).otherwise(F.lit(True)))
    return out


def _known(keys: list[str]):
    return reduce(lambda a, c: a & c, [col(k).isNotNull() for k in keys])


def _ambiguity(t, rows, keys, op_col, null_safe) -> DataFrame:
    """One row: does a target row meet several change rows (``ambiguous``), and does one
    survive the deletes and still meet several (``clash``)? Usually no key repeats in the
    change set; the join with the target's keys is then empty at run time."""
    n = F.count(F.lit(1))
    n_live = F.count(F.when(col(op_col) != Op.DELETE, 1))
    twice = (
        rows.groupBy(*[col(k) for k in keys])
        .agg(n.alias("n"), ((n_live > 1) & (~_known(keys) | (n == n_live))).alias("clash"))
        .filter("n > 1")
    )
    side = twice.select(*key_side(twice, keys), F.col("clash").alias("__mill_clash"))
    met = _keys_of(t, keys).join(side, key_test(keys, null_safe), "inner")
    return met.agg(F.struct((n > 0).alias("ambiguous"), F.max("__mill_clash").alias("clash")).alias("facts"))


def _first_op(rows: DataFrame, keys: list[str], op_col: str) -> DataFrame:
    """The row with the lowest code of each key: a delete if there is one."""
    return latest(rows.withColumn("__mill_low", -col(op_col)), keys, ["__mill_low"]).drop("__mill_low")


def merge_then_insert(
    t: DataFrame, b: DataFrame, keys: list[str], op_col: str = OP_COL, null_safe: bool = True, check: bool = True
) -> DataFrame:
    """Merge deletes and updates, then append every insert without a look-up.

    Unmatched updates are dropped. Not repeatable: applying a set twice inserts twice. A target
    row that several deletes or updates match fails the job (``check``).
    """
    rows = row_changes(b, op_col).filter(col(op_col) != Op.INSERT)
    kept = update_from(t, _checked(rows, keys, check), keys, _shared(t, b), null_safe, drop=col(op_col) == Op.DELETE)
    return append(kept, b.filter(col(op_col) == Op.INSERT))


def merge_soft(
    t: DataFrame,
    b: DataFrame,
    keys: list[str],
    op_col: str = OP_COL,
    flag_col: str = FLAG_COL,
    null_safe: bool = True,
    unique_keys: bool = True,
    check: bool = True,
) -> DataFrame:
    """Soft delete in two passes: flagged rows update their match, then live rows upsert.

    A key that is deleted and inserted again in one set ends alive. A target row that several
    flagged or several live rows match fails the job (``check``).
    """
    rows = row_changes(b, op_col)
    cols = _shared(t, b)
    dead = rows.filter(col(flag_col) == 1)
    live = rows.filter(col(flag_col) == 0)
    if _replaces(t, b, unique_keys):
        kept = update_from(t, _checked(dead, keys, check), keys, cols, null_safe)
        return append(without(kept, live, keys, null_safe, once=check), live)
    # one join with the target, so that a key it repeats often can be split: the live row
    # of a key hides its flagged one
    both = _checked(dead.unionByName(live), [*keys, flag_col], check).withColumn("__mill_low", -col(flag_col))
    last = latest(both, keys, [*[c for c in both.columns if c == _TWICE], "__mill_low"])
    kept = update_from(t, last, keys, cols, null_safe)
    return append(kept, missing(live, t, keys, null_safe))


def merge_soft_nokey(
    t: DataFrame, b: DataFrame, keys: list[str], op_col: str = OP_COL, null_safe: bool = True
) -> DataFrame:
    """Soft delete for a table without a real key; ``keys`` are its comparison columns.

    Deletes set the other columns on every duplicate of the row, inserts are appended.
    ``null_safe=False`` compares with plain equality.
    """
    cols = _shared(t, b)
    dead = one_row_per_key(b.filter(col(op_col) == Op.DELETE), keys, cols)
    dead = dead if null_safe else spread(dead)
    return append(update_from(t, dead, keys, cols, null_safe), b.filter(col(op_col) == Op.INSERT))


def merge_history(t: DataFrame, b: DataFrame, keys: list[str], null_safe: bool = True) -> DataFrame:
    """Insert the rows whose key the history lacks; rows new to it with one key all go in."""
    return append(t, missing(b, t, keys, null_safe))


def merge_plain(
    t: DataFrame,
    b: DataFrame,
    keys: list[str],
    op_col: str = OP_COL,
    soft: bool = False,
    insert_unmatched_deletes: bool = False,
    unique_keys: bool = True,
    check: bool = True,
) -> DataFrame:
    """Merge by plain key equality: a NULL key never matches, and a target row may match one
    change row (``check``).

    ``soft=True`` has no deletes: matched rows are updated, unmatched ones inserted.
    ``insert_unmatched_deletes=True`` also writes a delete that matches nothing.
    """
    if soft:
        rows = row_changes(b, op_col)
        return _upsert(t, rows, keys, False, unique_keys, check)
    out = merge_hard(t, b, keys, op_col, null_safe=False, unique_keys=unique_keys, check=check)
    if insert_unmatched_deletes:
        gone = b.filter(col(op_col) == Op.DELETE)
        out = append(out, missing(gone, t, keys, null_safe=False))
    return out


def apply_three_step(t: DataFrame, b: DataFrame, keys: list[str], op_col: str = OP_COL) -> DataFrame:
    """Delete by code 0, set the non-key columns by code 2, append code 1, in this order."""
    cols = [c for c in _shared(t, b) if c not in keys and c != op_col]
    steps = b.filter(col(op_col).isin(Op.DELETE, Op.UPDATE))
    if cols:
        first = spread(_first_op(steps, keys, op_col))
        left = update_from(t, first, keys, cols, null_safe=False, drop=col(op_col) == Op.DELETE)
    else:
        left = without(t, steps.filter(col(op_col) == Op.DELETE), keys, null_safe=False)
    return append(left, b.filter(col(op_col) == Op.INSERT))


def apply_update_insert(
    t: DataFrame | None,
    b: DataFrame,
    keys: list[str],
    flag_col: str = FLAG_COL,
    op_col: str | None = None,
    unused_keys: list[str] = (),
    check: bool = True,
) -> DataFrame:
    """Soft-delete apply as update-from, then insert where no row exists.

    A target row that several rows match fails the job (``check``).

    Without a target the change set becomes the target. With ``unused_keys`` only codes
    above 0 update and insert, and deletes with an incomplete key set the flag.
    """
    if t is None:
        return b
    cols = [c for c in _shared(t, b) if c != op_col]
    rows = b.filter(col(op_col) > 0) if unused_keys else b
    out = update_from(t, _checked(rows, keys, check), keys, cols, null_safe=False)
    if unused_keys:
        from changemill.operators.partial import multi_delete_flag

        out = multi_delete_flag(out, b, keys, unused_keys, flag_col, op_col)
    fresh = missing(rows, t, keys, null_safe=False)
    return append(out, fresh.select(*[col(c) for c in cols]))


def apply_files_in_order(
    t: DataFrame, b: DataFrame, keys: list[str], file_order: list[str], op_col: str = OP_COL
) -> DataFrame:
    """Merge the files of a cycle as if one after the other: a later file wins.

    ``file_order`` orders the rows, for example ``[file_seq, row_seq]``. The last row of a
    key decides, so one merge does what a merge per file would do.
    """
    return merge_log(t, row_changes(b, op_col), latest(row_changes(b, op_col), keys, file_order), keys, op_col, null_safe=False)


def merge_log(
    t: DataFrame,
    log: DataFrame,
    net: DataFrame,
    keys: list[str],
    op_col: str = OP_COL,
    null_safe: bool = True,
    unique_keys: bool = True,
) -> DataFrame:
    """``merge_hard`` with ``net``, the one row per key that ``log`` comes to.

    The keys to replace are taken from the log itself, so the costly reduction to ``net``
    is computed once.
    """
    if not _replaces(t, net, unique_keys):
        return merge_hard(t, net, keys, op_col, null_safe, unique_keys, check=False)
    images = row_changes(log, op_col).filter(~col(op_col).eqNullSafe(F.lit(Op.BEFORE)))
    live = row_changes(net, op_col).filter(col(op_col) != Op.DELETE)
    return replace(t, keys_in(images, keys), live, keys, null_safe)


def insert_strict(t: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """Append; a key that exists in the target or occurs twice in the set fails the job."""
    have = matching(_keys_of(t, keys), b, keys)
    twice = b.groupBy(*[col(k) for k in keys]).count().filter("count > 1")
    bad = have.unionAll(_keys_of(twice, keys))
    return fail_if(append(t, b), bad, "insert of a key that exists")


def apply_counts(t: DataFrame, b: DataFrame, keys: list[str], op_col: str = OP_COL) -> DataFrame:
    """Target rows deleted and updated, and rows inserted: ``action``, ``n_rows``."""
    marks = (
        b.filter(col(op_col).isin(Op.DELETE, Op.UPDATE))
        .groupBy(*[col(k).alias(f"__mill_c{i}") for i, k in enumerate(keys)])
        .agg(F.min(col(op_col)).alias("__mill_op"))
    )
    on = reduce(lambda a, c: a & c, [col(k) == F.col(f"__mill_c{i}") for i, k in enumerate(keys)])
    # the marks come from an aggregate by the same keys; a hot key of the target stays splittable
    hit = t.select(*[col(k) for k in keys]).join(spread(marks), on, "inner")
    named = hit.select(
        F.when(F.col("__mill_op") == Op.DELETE, "deleted").otherwise("updated").alias("action")
    )
    added = b.filter(col(op_col) == Op.INSERT).select(F.lit("inserted").alias("action"))
    return named.unionAll(added).groupBy("action").agg(F.count(F.lit(1)).alias("n_rows"))


def align_to_target(df: DataFrame, t: DataFrame) -> DataFrame:
    """The target's columns in the target's order and types."""
    return align(df, t)
