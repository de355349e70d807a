"""Checks of staged data. Row checks give the violating rows and never stop a job."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from changemill.functions.columns import col
from changemill.spec import FLAG_COL, OP_COL


def check_column_count(src: DataFrame, tgt: DataFrame, burst_only: list[str] = (OP_COL, FLAG_COL)) -> None:
    n_src = len([c for c in src.columns if c not in burst_only or c in tgt.columns])
    if n_src != len(tgt.columns):
        raise ValueError(f"{n_src} source columns, {len(tgt.columns)} target columns")


def check_column_names(src: DataFrame, tgt: DataFrame, burst_only: list[str] = (OP_COL, FLAG_COL)) -> None:
    known = {c.lower() for c in tgt.columns}
    lost = [c for c in src.columns if c.lower() not in known and c not in burst_only]
    if lost:
        raise ValueError(f"source columns not in the target: {lost}")


def require_columns(df: DataFrame, cols: list[str]) -> DataFrame:
    lost = [c for c in cols if c not in df.columns]
    if lost:
        raise ValueError(f"columns needed but absent: {lost}")
    return df


def _violations(df: DataFrame, tests: dict, values: dict) -> DataFrame:
    """One output row per violated column: the row plus ``column`` and ``value``.

    One scan: every row carries an array of its violations, which is then exploded.
    """
    found = F.array_compact(F.array(*[
        F.when(test, F.struct(F.lit(c).alias("column"), values[c].cast("string").alias("value")))
        for c, test in tests.items()
    ]))
    return df.withColumn("__mill_v", F.explode(found)).select(
        *[col(c) for c in df.columns], F.col("__mill_v.column"), F.col("__mill_v.value")
    )


def long_text(df: DataFrame, lengths: dict[str, int]) -> DataFrame:
    """Text longer than its declared length, with the row."""
    return _violations(
        df, {c: F.length(col(c)) > n for c, n in lengths.items()}, {c: col(c) for c in lengths}
    )


def long_dates(df: DataFrame, date_cols: list[str], file_col: str | None = None, order: list[str] = ()) -> DataFrame:
    """Date text of more than ten characters; with ``file_col`` only the first per file.

    The first-row filter is limited in each task before the shuffle, so one file with most
    of the rows is no problem.
    """
    out = _violations(df, {c: F.length(col(c)) > 10 for c in date_cols}, {c: col(c) for c in date_cols})
    if file_col is None:
        return out
    w = Window.partitionBy(col(file_col)).orderBy(*[col(c) for c in order], F.col("column"))
    return out.withColumn("__mill_n", F.row_number().over(w)).filter("__mill_n = 1").drop("__mill_n")


def null_violations(df: DataFrame, cols: list[str]) -> DataFrame:
    """Rows with NULL in a column that must not be NULL, one per column."""
    return _violations(df, {c: col(c).isNull() for c in cols}, {c: col(c) for c in cols})


def violation_counts(violations: DataFrame) -> DataFrame:
    return violations.groupBy("column").agg(F.count(F.lit(1)).alias("n_rows"))

