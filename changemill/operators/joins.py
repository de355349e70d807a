"""The four row-set steps every apply operator is made of.

``t`` is the target and may be far larger than ``rows``. No step forces a broadcast:
Catalyst broadcasts ``rows`` when its size is known to be under the threshold, and AQE
does so at run time; otherwise both sides shuffle on the keys. ``t`` is always on the
left of a left join or semi/anti join, so AQE can split a hot key of the target.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changemill.functions.columns import col

_KEY = "__mill_k{}"
_VALUE = "__mill_v{}"
_HIT = "__mill_hit"
_TWICE = "__mill_twice"


def key_side(rows: DataFrame, keys: list[str]) -> list[Column]:
    """The key columns of the right side under names that clash with nothing."""
    return [col(k).alias(_KEY.format(i)) for i, k in enumerate(keys)]


def key_test(keys: list[str], null_safe: bool) -> Column:
    """Join condition of a left side with the columns of ``key_side``."""
    pairs = [(col(k), F.col(_KEY.format(i))) for i, k in enumerate(keys)]
    tests = [a.eqNullSafe(b) if null_safe else a == b for a, b in pairs]
    return reduce(lambda a, b: a & b, tests)


def _need(keys: list[str]) -> None:
    if not keys:
        raise ValueError("at least one key column is needed")


def matching(t: DataFrame, rows: DataFrame, keys: list[str], null_safe: bool = True) -> DataFrame:
    """Rows of ``t`` that have a row with the same key in ``rows``."""
    _need(keys)
    return t.join(rows.select(*key_side(rows, keys)), key_test(keys, null_safe), "left_semi")


def without(
    t: DataFrame, rows: DataFrame, keys: list[str], null_safe: bool = True, once: bool = False, op: Column | None = None, watch=None
) -> DataFrame:
    """Rows of ``t`` that have no row with the same key in ``rows``.

    ``once``: a row of ``t`` that has several fails the job. The keys of ``rows`` are counted
    for that; ``t`` is joined once as before. ``watch(joined, met, op)`` may look at the joined
    rows before any is left out; ``op`` is a column of ``rows``.
    """
    _need(keys)
    if not once:
        return t.join(rows.select(*key_side(rows, keys)), key_test(keys, null_safe), "left_anti")
    more = [] if op is None else [F.min(op).alias(_HIT)]
    met = rows.groupBy(*key_side(rows, keys)).agg((F.count(F.lit(1)) > 1).alias(_TWICE), *more)
    joined = t.join(spread(met), key_test(keys, null_safe), "left")
    if watch is not None:
        joined = watch(joined, F.col(_TWICE).isNotNull(), F.col(_HIT))
    return joined.filter(F.when(F.col(_TWICE), several()).otherwise(F.col(_TWICE).isNull())).select(*[col(c) for c in t.columns])


def several() -> Column:
    """A condition that fails the job wherever it is evaluated."""
    return F.raise_error(F.lit("several change rows for one key of the target")).cast("boolean")


def repeated(rows: DataFrame, by: list[str]) -> DataFrame:
    """``rows`` with a mark on those whose values in ``by`` occur several times, else NULL.

    Usually none does: the join then has nothing on its right side and is left out at run time.
    """
    twice = rows.groupBy(*key_side(rows, by)).agg(F.count(F.lit(1)).alias("n_rows")).filter("n_rows > 1")
    twice = twice.select(*[_KEY.format(i) for i in range(len(by))], F.lit(True).alias(_TWICE))
    return spread(rows.join(twice, key_test(by, True), "left").select(*[col(c) for c in rows.columns], _TWICE))


def update_from(
    t: DataFrame,
    rows: DataFrame,
    keys: list[str],
    cols: list[str],
    null_safe: bool = True,
    drop: Column | None = None,
    value=lambda new, old: new,
) -> DataFrame:
    """Set ``cols`` of every target row from the row of ``rows`` with its key.

    ``rows`` must hold a key once, or come from ``repeated``: then a target row that meets a
    marked row fails the job, and marked rows that meet nothing do no harm. ``drop`` is a condition on ``rows`` that deletes the
    matched target row. Key columns keep the target's value: it is equal by the match, and
    leaving it untouched keeps the partitioning of the join for a following step.
    """
    _need(keys)
    cols = [c for c in cols if c not in keys]
    hit = F.lit(1) if drop is None else F.when(drop, 2).otherwise(1)
    marked = _TWICE in rows.columns
    side = rows.select(
        *key_side(rows, keys),
        *[col(c).alias(_VALUE.format(i)) for i, c in enumerate(cols)],
        hit.alias(_HIT),
        *[_TWICE] * marked,
    )
    joined = t.join(side, key_test(keys, null_safe), "left")
    if marked:
        joined = joined.filter(F.when(F.col(_TWICE), several()).otherwise(F.lit(True)))
    if drop is not None:
        joined = joined.filter(F.coalesce(F.col(_HIT), F.lit(1)) != 2)
    types = {f.name: f.dataType for f in t.schema.fields}
    out = []
    for c in t.columns:
        if c in cols:
            new = value(F.col(_VALUE.format(cols.index(c))), col(c)).cast(types[c])
            out.append(F.when(F.col(_HIT).isNotNull(), new).otherwise(col(c)).alias(c))
        else:
            out.append(col(c))
    return joined.select(*out)


def missing(rows: DataFrame, t: DataFrame, keys: list[str], null_safe: bool = True) -> DataFrame:
    """Rows of ``rows`` whose key the target lacks.

    The target's keys are first reduced to those that occur in ``rows``. A plain anti join
    would have to shuffle or build the whole target, while this way a small change set is
    broadcast to the target scan and the second join sees only keys of the change set. A
    key repeated many times in the target is collapsed before that second shuffle.

    The first join is null-safe in any case (without NULL keys on the right that is plain
    equality): its partitioning then differs from what ``distinct`` needs, the exchange in
    between leaves AQE free to split a hot key of the target.
    """
    known = rows
    if not null_safe:
        known = known.filter(reduce(lambda a, b: a & b, [col(k).isNotNull() for k in keys]))
    hit = matching(t.select(*[col(k) for k in keys]), known, keys, True).distinct()
    return without(rows, hit, keys, null_safe)


def keys_in(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The distinct keys. Combined before the shuffle, and far cheaper than reducing whole
    rows to one per key only to look at the keys."""
    return rows.select(*[col(k) for k in keys]).distinct()


def touched(t: DataFrame, b: DataFrame, partition_cols: list[str]) -> DataFrame:
    """Rows of ``t`` in the partitions that occur in ``b``.

    A semi join on the partition columns: where Spark broadcasts the distinct values it prunes the
    scan of ``t`` by them, so files of other partitions aren't opened. The partition of NULL, which
    no equality finds, is read if ``t`` has it.
    """
    cols = [col(c) for c in partition_cols]
    unknown = reduce(lambda a, c: a | c, [c.isNull() for c in cols])
    named = b.select(*[c.alias(f"__mill_p{i}") for i, c in enumerate(cols)]).distinct()
    on = reduce(lambda a, c: a & c, [c == F.col(f"__mill_p{i}") for i, c in enumerate(cols)])
    return t.join(named, on, "left_semi").unionAll(t.filter(unknown))


def replace(t: DataFrame, changed: DataFrame, live: DataFrame, keys: list[str], null_safe: bool = True) -> DataFrame:
    """``t`` without the keys of ``changed``, plus ``live``."""
    return append(without(t, changed, keys, null_safe), live)


def spread(rows: DataFrame) -> DataFrame:
    """Cut the tie between the partitioning of aggregated ``rows`` and a following join.

    AQE splits a hot key of the target only if both sides of the join come straight from an
    exchange. After an aggregate by the join's own keys Spark would save that exchange. It
    is the reduced change set that is moved once more, not the target.
    """
    return rows.hint("rebalance")


def align(rows: DataFrame, t: DataFrame) -> DataFrame:
    """``rows`` with exactly the target's columns, order and types; missing ones NULL."""
    have = {f.name: f.dataType for f in rows.schema.fields}
    out = []
    for f in t.schema.fields:
        if f.name not in have:
            out.append(F.lit(None).cast(f.dataType).alias(f.name))
        elif have[f.name] != f.dataType:
            out.append(col(f.name).cast(f.dataType).alias(f.name))
        else:
            out.append(col(f.name))
    return rows.select(*out)


def append(t: DataFrame, rows: DataFrame) -> DataFrame:
    return t.unionAll(align(rows, t))


def fail_if(df: DataFrame, bad: DataFrame, message: str) -> DataFrame:
    """``df``, or a failing job if ``bad`` holds any row. ``bad`` runs as one subquery."""
    stop = F.raise_error(F.lit(message)).cast("boolean")
    return df.filter(F.when(bad.exists(), stop).otherwise(F.lit(True)))


def one_row_per_key(rows: DataFrame, keys: list[str], cols: list[str]) -> DataFrame:
    """Equal rows collapsed to one per key; different rows for one key fail the job.

    Aggregates before the shuffle, so many copies of one key cost one row per task.
    """
    rest = [c for c in cols if c not in keys]
    if not rest:
        return rows.select(*[col(k) for k in keys]).distinct()
    body = F.struct(*[col(c).alias(f"f{i}") for i, c in enumerate(rest)])
    g = rows.groupBy(*[col(k) for k in keys]).agg(
        F.min(body).alias("__mill_lo"), F.max(body).alias("__mill_hi")
    )
    clash = F.raise_error(F.lit("several different change rows for one key"))
    same = F.when(F.col("__mill_lo").eqNullSafe(F.col("__mill_hi")), F.col("__mill_lo"))
    g = g.select(*[col(k) for k in keys], same.otherwise(clash.cast(g.schema["__mill_lo"].dataType)).alias("__mill_row"))
    return g.select(
        *[col(k) for k in keys],
        *[F.col(f"__mill_row.f{i}").alias(c) for i, c in enumerate(rest)],
    )
