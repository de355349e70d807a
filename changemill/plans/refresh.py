"""Refreshing a target from full data. All plans are lazy; a sink writes the result."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changemill.functions.columns import col
from changemill.operators.joins import align, append
from changemill.operators.keyed import upsert_partial
from changemill.schema.types import struct_type
from changemill.spec import OP_COL, Op


def refresh_full(t: DataFrame, b: DataFrame) -> DataFrame:
    """The loaded rows replace all target rows; the target's columns stay."""
    return align(b, t)


def refresh_restrict(t: DataFrame, b: DataFrame, condition: str) -> DataFrame:
    """Replace the target rows that satisfy the condition; a NULL condition keeps a row."""
    return append(t.filter(~F.coalesce(F.expr(condition), F.lit(False))), b)


def refresh_append(t: DataFrame, b: DataFrame) -> DataFrame:
    """Load without removing anything."""
    return append(t, b)


def refresh_upsert(t: DataFrame, b: DataFrame, keys: list[str], order: list[str] = ()) -> DataFrame:
    """Load over existing rows: known keys are updated, new ones inserted.

    An empty or NULL value of the load is absent, as in a change: the stored value stays.
    With ``order`` a key may be loaded several times; its last filled values win.
    """
    return upsert_partial(t, b, keys, list(order) or keys, null_safe=False)


def refresh_recreate(b: DataFrame, drop: list[str] = ()) -> DataFrame:
    """The loaded rows are the new table, with their own columns."""
    return b.drop(*drop)


def refresh_inserts_only(b: DataFrame, op_col: str = OP_COL) -> DataFrame:
    """Only the rows coded as inserts, without the code."""
    return b.filter(col(op_col) == Op.INSERT).drop(op_col)


def empty_target(spark, schema: T.StructType) -> DataFrame:
    """A table of the given schema without rows."""
    return spark.createDataFrame([], schema)


def create_target(target, mapped: DataFrame, table: str, lower: bool = False) -> T.StructType:
    """Create or recreate a snapshot table, empty, from the typed dictionary rows of a table."""
    schema = struct_type(mapped, table, lower)
    target.commit(empty_target(mapped.sparkSession, schema), "create")
    return schema
