"""Selecting, tidying and coalescing the rows of a change set."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from changemill.functions.columns import col, order_value
from changemill.operators.joins import without
from changemill.spec import CONTROL_OPS, FLAG_COL, OP_COL, Op

_ORD = "__mill_ord"

#: Parts into which the rows under one partial-key delete are spread, unless a caller says otherwise.
SALTS = 16


def drop_burst_only(
    df: DataFrame, target_columns: list[str], op_col: str = OP_COL, flag_col: str = FLAG_COL
) -> DataFrame:
    """Drop the op and flag columns unless the target has them too."""
    return df.drop(*[c for c in (op_col, flag_col) if c not in target_columns])


def drop_ignored(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.drop(*cols)


def rename(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed(names)


def lower_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower() for c in df.columns])


def by_op(df: DataFrame, *ops: int, exclude: bool = False, op_col: str = OP_COL) -> DataFrame:
    """Rows with one of the codes, or with none of them. A NULL code passes neither test."""
    test = col(op_col).isin(*ops)
    return df.filter(~test if exclude else test)


def by_flag(df: DataFrame, value: int, flag_col: str = FLAG_COL) -> DataFrame:
    return df.filter(col(flag_col) == value)


def where(df: DataFrame, condition: str) -> DataFrame:
    """Rows that satisfy a condition given as SQL text."""
    return df.filter(F.expr(condition))


def exists(df: DataFrame) -> DataFrame:
    """One row with a BOOLEAN column ``found``; reads at most one row of the input."""
    return df.limit(1).agg((F.count(F.lit(1)) > 0).alias("found"))


def empty_like(df: DataFrame) -> DataFrame:
    """The structure of a table without its rows."""
    return df.limit(0)


def row_changes(b: DataFrame, op_col: str = OP_COL) -> DataFrame:
    """The rows of a change set that describe a target row; control rows are left out."""
    return b.filter(~col(op_col).isin(*CONTROL_OPS)) if op_col in b.columns else b


def latest(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last row of each key.

    A rank filter is pre-limited in each task before the shuffle, so a key with a third of
    all rows sends one row per task.
    """
    w = Window.partitionBy(*[col(k) for k in keys]).orderBy(*[col(c).desc() for c in order])
    return df.withColumn(_ORD, F.row_number().over(w)).filter(F.col(_ORD) == 1).drop(_ORD)


def coalesce_changes(
    b: DataFrame,
    keys: list[str],
    order: list[str],
    op_col: str = OP_COL,
    unused_keys: list[str] = (),
    salts: int = SALTS,
) -> DataFrame:
    """One row per key: the last image of the key with a code for the net effect.

    The code is 0 if the key's last change is a delete, else 1 if its first change is an
    insert, else 2. Before images are left out. Truncate markers and partial-key deletes
    stay in the result. Applying the result as *truncate, partial deletes, merge* equals
    applying the log in order: rows older than the last truncate marker, or older than a
    partial-key delete that covers them (``unused_keys`` given), are left out.
    """
    rows = b.filter(~col(op_col).eqNullSafe(F.lit(Op.BEFORE)))
    control = rows.filter(col(op_col).isin(*CONTROL_OPS))
    data = rows.filter(~F.coalesce(col(op_col).isin(*CONTROL_OPS), F.lit(False)))

    cut = control.filter(col(op_col) == Op.TRUNCATE).agg(F.max(order_value(order)).alias("c"))
    # one value each; a subquery, not a join
    after_cut = F.coalesce(order_value(order) > cut.scalar(), F.lit(True))
    data = data.filter(after_cut)
    control = control.filter((col(op_col) == Op.TRUNCATE) | after_cut)

    partial = [k for k in keys if k not in unused_keys]
    if unused_keys:
        # salted: a used key may cover a third of the rows, and the aggregate that follows
        # would otherwise have to keep them together
        covers = (
            control.filter(col(op_col) == Op.PARTIAL_DELETE)
            .groupBy(*[col(k).alias(f"__mill_p{i}") for i, k in enumerate(partial)])
            .agg(F.max(order_value(order)).alias("__mill_cut"))
            .withColumn("__mill_s", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        )
        salt = F.pmod(F.xxhash64(*[col(c) for c in [*keys, *order]]), F.lit(salts)).cast("int")
        on = [col(k) == F.col(f"__mill_p{i}") for i, k in enumerate(partial)]
        data = data.withColumn("__mill_d", salt).join(
            covers, [*on, F.col("__mill_d") == F.col("__mill_s")], "left"
        )
        later = F.coalesce(order_value(order) > F.col("__mill_cut"), F.lit(True))
        data = data.filter(later).select(*[col(c) for c in b.columns])

    rest = [c for c in b.columns if c not in keys]
    body = F.struct(*[col(c).alias(f"f{i}") for i, c in enumerate(rest)])
    net = (
        data.select(*[col(k) for k in keys], order_value(order).alias(_ORD), body.alias("__mill_b"), col(op_col).alias("__mill_op"))
        .groupBy(*[col(k) for k in keys])
        .agg(
            F.max_by("__mill_b", _ORD).alias("__mill_b"),
            F.min_by("__mill_op", _ORD).alias("__mill_first"),
            F.max_by("__mill_op", _ORD).alias("__mill_last"),
        )
    )
    code = (
        F.when(F.col("__mill_last") == Op.DELETE, Op.DELETE)
        .when(F.col("__mill_first") == Op.INSERT, Op.INSERT)
        .otherwise(Op.UPDATE)
        .cast(b.schema[op_col].dataType)
    )
    out = []
    for c in b.columns:
        if c == op_col:
            out.append(code.alias(c))
        elif c in keys:
            out.append(col(c))
        else:
            out.append(F.col(f"__mill_b.f{rest.index(c)}").alias(c))
    return net.select(*out).unionByName(control)


def duplicate_changes(b: DataFrame, keys: list[str], op_col: str = OP_COL) -> DataFrame:
    """Keys with more than one change row: ``keys`` and ``n_changes``."""
    return (
        row_changes(b, op_col)
        .groupBy(*[col(k) for k in keys])
        .agg(F.count(F.lit(1)).alias("n_changes"))
        .filter(F.col("n_changes") > 1)
    )


def order_columns(columns_df: DataFrame) -> DataFrame:
    """Dictionary rows by table and column sequence."""
    return columns_df.orderBy("tbl_name", "col_sequence")


def unprocessed(files: DataFrame, done: DataFrame, by: str = "file_name") -> DataFrame:
    return without(files, done, [by])
