"""Before and after images of updates: pairing, collapsing and checking."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changemill.functions.columns import col
from changemill.operators.ordering import with_neighbour
from changemill.spec import OP_COL, Op


def with_previous(
    df: DataFrame,
    cols: list[str],
    order: list[str],
    group: list[str] = (),
    only=None,
    pos_col: str | None = None,
    prefix: str = "prev_",
) -> DataFrame:
    """Add ``prefix + c`` of the row directly before, within ``group``; ``prefix + 'hit'``
    tells whether there is one (and, with ``only``, whether it satisfies the condition).

    No group has to fit in a task. ``pos_col`` names a gap-free position within the group if the
    source has one: rows then meet their predecessor by an equi join on it, every key of which
    occurs once. Otherwise they are sorted by ``order`` and look at their neighbour
    (``ordering.with_neighbour``).
    """
    if pos_col is None:
        return with_neighbour(df, {prefix + c: c for c in cols}, order, group, only=only, hit=prefix + "hit")
    at = pos_col
    left = df if only is None else df.filter(only)
    side = left.select(
        *[col(g).alias(f"__mill_g{i}") for i, g in enumerate(group)],
        (col(at) + 1).alias("__mill_at"),
        *[col(c).alias(prefix + c) for c in cols],
        F.lit(True).alias(prefix + "hit"),
    )
    on = [col(at) == F.col("__mill_at")]
    on += [col(g).eqNullSafe(F.col(f"__mill_g{i}")) for i, g in enumerate(group)]
    out = df.join(side, reduce(lambda a, b: a & b, on), "left").drop(
        "__mill_at", *[f"__mill_g{i}" for i in range(len(group))]
    )
    return out.withColumn(prefix + "hit", F.coalesce(F.col(prefix + "hit"), F.lit(False)))


def collapse_updates(
    df: DataFrame,
    order: list[str],
    group: list[str] = (),
    op_col: str = OP_COL,
    mode: str = "changed",
    ignore: list[str] = (),
    prefix: str = "Old&",
    pos_col: str | None = None,
    check: bool = True,
) -> DataFrame:
    """One row per update: the after image plus the before values as ``prefix + column``.

    ``mode='changed'`` keeps a before value only where it differs, ``'all'`` keeps all.
    Ignored columns and the op column are not compared and get no before column.
    ``changed_cols`` lists what differs; it is NULL for rows without a before image, which
    tells "changed from NULL" from "unchanged". A before image followed by anything but an
    update's after image fails the job unless ``check=False``.
    """
    if mode not in ("changed", "all"):
        raise ValueError("mode must be 'changed' or 'all'")
    if op_col not in df.columns:
        raise ValueError(f"column {op_col!r} is needed to pair images")
    skip = {op_col, *ignore, *group, *([pos_col] if pos_col else [])}
    compared = [c for c in df.columns if c not in skip and c not in order]
    rows = with_previous(
        df, compared, order, group, col(op_col) == Op.BEFORE, pos_col, prefix="__mill_b_"
    ).filter(~col(op_col).eqNullSafe(F.lit(Op.BEFORE)))
    hit = F.col("__mill_b_hit")
    if check:
        stop = F.raise_error(F.lit("a before image is not followed by its after image")).cast("boolean")
        rows = rows.filter(F.when(hit & ~col(op_col).eqNullSafe(F.lit(Op.UPDATE)), stop).otherwise(F.lit(True)))
    old = {c: col("__mill_b_" + c) for c in compared}
    differs = {c: hit & ~old[c].eqNullSafe(col(c)) for c in compared}
    names = F.array_compact(F.array(*[F.when(differs[c], F.lit(c)) for c in compared]))
    before = [
        F.when(hit if mode == "all" else differs[c], old[c]).alias(prefix + c) for c in compared
    ]
    return rows.select(*[col(c) for c in df.columns], *before, F.when(hit, names).alias("changed_cols"))


def discard_unchanged(df: DataFrame, keep_col: str | None = None) -> DataFrame:
    """Drop collapsed updates in which nothing changed; inserts and deletes always stay.

    ``keep_col`` names an end-of-transaction marker (1 on the last row of a transaction);
    a marked row stays although it is unchanged, so that it can carry the marker.
    """
    keep = F.col("changed_cols").isNull() | (F.size("changed_cols") > 0)
    if keep_col is not None:
        keep = keep | col(keep_col).eqNullSafe(F.lit(1))
    return df.filter(keep)


def check_pairs(
    df: DataFrame,
    order: list[str],
    group: list[str] = (),
    op_col: str = OP_COL,
    pos_col: str | None = None,
    strict: bool = True,
) -> DataFrame:
    """Before images that are not followed by an after image, with ``next_op``.

    ``strict=False`` leaves out those followed by another before image or by nothing,
    which collapsing drops without an error.
    """
    if op_col not in df.columns:
        raise ValueError(f"column {op_col!r} is needed to pair images")
    if pos_col is None:
        out = with_neighbour(df, {"next_op": op_col}, order, group, ahead=True).filter(col(op_col) == Op.BEFORE)
    else:
        side = df.select(
            *[col(g).alias(f"__mill_g{i}") for i, g in enumerate(group)],
            (col(pos_col) - 1).alias("__mill_at"),
            col(op_col).alias("next_op"),
        )
        on = [col(pos_col) == F.col("__mill_at")]
        on += [col(g).eqNullSafe(F.col(f"__mill_g{i}")) for i, g in enumerate(group)]
        out = df.filter(col(op_col) == Op.BEFORE).join(side, reduce(lambda a, b: a & b, on), "left")
        out = out.drop("__mill_at", *[f"__mill_g{i}" for i in range(len(group))])
    out = out.filter(~F.col("next_op").eqNullSafe(F.lit(Op.UPDATE)))
    if not strict:
        out = out.filter(F.col("next_op").isNotNull() & (F.col("next_op") != Op.BEFORE))
    return out


def collapsed_json(
    df: DataFrame, columns: list[str], prefix: str = "Old&", mode: str = "changed", value_col: str = "value"
) -> DataFrame:
    """Rows of ``collapse_updates`` as JSON text in which only real before values appear."""

    def field(name, value):
        text = F.to_json(F.struct(value.alias(name)), {"ignoreNullFields": "false"})
        return F.substring(text, F.lit(2), F.length(text) - 2)

    parts = [field(c, col(c)) for c in columns]
    for name in [c for c in df.columns if c.startswith(prefix)]:
        shown = F.col("changed_cols").isNotNull()
        if mode == "changed":
            shown = F.array_contains("changed_cols", name[len(prefix):])
        parts.append(F.when(shown, field(name, col(name))))
    return df.withColumn(value_col, F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}")))


def mark_tx_end(
    df: DataFrame, tx: list[str], order: list[str], end_col: str = "tx_end", partition: list[str] = ()
) -> DataFrame:
    """Set ``end_col`` to 1 on the last row of each transaction within its partition.

    The last position is an aggregate per transaction, combined before the shuffle; it is
    joined back on transaction *and* position, so a huge transaction spreads over all tasks.
    An existing ``end_col`` keeps its other values, a new one is 0 elsewhere.
    """
    keys = [*partition, *tx]
    last = df.groupBy(*[col(k).alias(f"__mill_t{i}") for i, k in enumerate(keys)]).agg(
        F.max(F.struct(*[col(c).alias(f"o{i}") for i, c in enumerate(order)])).alias("__mill_o")
    )
    last = last.select(
        *[f"__mill_t{i}" for i in range(len(keys))],
        *[F.col(f"__mill_o.o{i}").alias(f"__mill_o{i}") for i in range(len(order))],
        F.lit(1).alias("__mill_end"),
    )
    on = [col(k).eqNullSafe(F.col(f"__mill_t{i}")) for i, k in enumerate(keys)]
    on += [col(c).eqNullSafe(F.col(f"__mill_o{i}")) for i, c in enumerate(order)]
    joined = df.join(last, reduce(lambda a, b: a & b, on), "left")
    other = col(end_col) if end_col in df.columns else F.lit(0)
    mark = F.when(F.col("__mill_end") == 1, F.lit(1)).otherwise(other).alias(end_col)
    return joined.select(*[col(c) for c in df.columns if c != end_col], mark)
