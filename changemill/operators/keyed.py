"""Upserts of wide rows, documents and key/value pairs: the last write of a key wins."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from changemill.functions.columns import col, join_keys, order_value
from changemill.operators.changes import latest
from changemill.operators.joins import append, keys_in, missing, replace, update_from
from changemill.spec import FLAG_COL


def to_text(df: DataFrame) -> DataFrame:
    """Every column as text."""
    return df.select(*[col(c).cast("string").alias(c) for c in df.columns])


def to_struct_key(df: DataFrame, keys: list[str], key_col: str = "row_key", text: bool = True) -> DataFrame:
    """The key columns as one struct column, followed by all columns, as text by default."""
    body = to_text(df) if text else df
    return body.select(F.struct(*[col(k).alias(k) for k in keys]).alias(key_col), *[col(c) for c in df.columns])


def upsert_lww(
    t: DataFrame,
    b: DataFrame,
    keys: list[str],
    order: list[str],
    flag_col: str | None = FLAG_COL,
    null_safe: bool = True,
) -> DataFrame:
    """The last row of each key replaces the stored row.

    With ``flag_col`` a last row flagged 1 deletes the key and the flag is not stored;
    with ``flag_col=None`` the full row is always written.
    """
    last = latest(b, keys, order)
    live = last
    if flag_col is not None:
        live = last.filter(~F.coalesce(col(flag_col).cast("int") == 1, F.lit(False)))
    return replace(t, keys_in(b, keys), live, keys, null_safe)


def upsert_partial(
    t: DataFrame, b: DataFrame, keys: list[str], order: list[str], null_safe: bool = True
) -> DataFrame:
    """Empty values of a change are absent: a stored value stays, a new row gets NULL.

    Several changes of a key are folded column by column: the last non-empty value wins,
    which need not come from the last row.
    """
    cols = [c for c in t.columns if c in b.columns and c not in keys]
    text = {f.name for f in b.schema.fields if f.dataType.typeName() in ("string", "varchar", "char")}
    ordv = order_value(order)

    def last_filled(c):
        filled = col(c).isNotNull() & (col(c) != "") if c in text else col(c).isNotNull()
        return F.max_by(col(c), F.when(filled, ordv)).alias(c)

    folded = b.groupBy(*[col(k) for k in keys]).agg(*[last_filled(c) for c in cols])
    kept = update_from(t, folded, keys, cols, null_safe, value=lambda new, old: F.coalesce(new, old))
    return append(kept, missing(folded, t, keys, null_safe))


def with_id(df: DataFrame, keys: list[str], sep: str = "", id_col: str = "_id") -> DataFrame:
    """Document id from the key values. Without a separator (1, 23) and (12, 3) are equal."""
    return df.withColumn(id_col, join_keys([col(k) for k in keys], sep))


def docs_replace(
    t: DataFrame, b: DataFrame, keys: list[str], order: list[str], sep: str = "", id_col: str = "_id"
) -> DataFrame:
    """Replace documents by the id made from their keys."""
    return upsert_lww(t, with_id(b, keys, sep, id_col), [id_col], order, flag_col=None)


def docs_append(t: DataFrame, b: DataFrame, id_col: str = "_id", order: list[str] | None = None) -> DataFrame:
    """Append documents; one without an id gets a random one, a known id is skipped.

    Of several new documents with one id the first by ``order`` is added; by default the
    order of all their columns. The generated ids are random, so a re-run gives other ids
    for the same rows.
    """
    if id_col not in b.columns:
        return append(t, b.withColumn(id_col, F.uuid()))
    by = order or [c for c in b.columns if c != id_col]
    w = Window.partitionBy(col(id_col)).orderBy(*[col(c) for c in by or [id_col]])
    fresh_ids = missing(b.filter(col(id_col).isNotNull()), t, [id_col])
    known = fresh_ids.withColumn("__mill_first", F.row_number().over(w)).filter("__mill_first = 1").drop("__mill_first")
    fresh = b.filter(col(id_col).isNull()).withColumn(id_col, F.uuid())
    return append(append(t, known), fresh)


def to_pairs(df: DataFrame, table: str, keys: list[str]) -> DataFrame:
    """``key`` = ``table::k1::k2``, ``value`` = the row as JSON, NULLs written out."""
    value = F.to_json(F.struct(*[col(c) for c in df.columns]), {"ignoreNullFields": "false"})
    return df.select(join_keys([F.lit(table), *[col(k) for k in keys]], "::").alias("key"), value.alias("value"))


def kv_upsert(t: DataFrame, b: DataFrame, table: str, keys: list[str], order: list[str]) -> DataFrame:
    """Upsert ``(key, value)`` pairs; the last row of a key wins."""
    changed = to_pairs(b, table, keys).select("key").distinct()
    return replace(t, changed, to_pairs(latest(b, keys, order), table, keys), ["key"])
