"""Reshaping rows into messages: envelope, destination, partition and size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changemill.functions.columns import col, join_keys, strip_schema, template
from changemill.operators.joins import fail_if
from changemill.sources.routing import file_elements

META_COLS = ("op_type", "op_timestamp")

#: Default size limit of a message batch in bytes (fixed value).
MESSAGE_LIMIT = 1_046_500


def to_envelope(df: DataFrame, table: str, stream: str, value_col: str = "value") -> DataFrame:
    """Add the JSON envelope ``{columns, op_type?, op_timestamp?, tablename?}``.

    The two metadata columns move out of ``columns``; ``tablename`` is present only if the
    stream is not named after the table.
    """
    body = F.struct(*[col(c) for c in df.columns if c not in META_COLS])
    parts = [body.alias("columns")] + [col(c) for c in META_COLS if c in df.columns]
    if stream != table:
        parts.append(F.lit(table).alias("tablename"))
    text = F.to_json(F.struct(*parts), {"ignoreNullFields": "false"})
    return df.withColumn(value_col, text)


def partition_key(df: DataFrame, key_cols: list[str], name: str = "partition_key") -> DataFrame:
    """Key values joined with a pipe; a column the message body lacks gives ``Undefined``."""
    body = [c for c in df.columns if c not in META_COLS]
    parts = [col(k) if k in body else F.lit("Undefined") for k in key_cols]
    return df.withColumn(name, join_keys(parts, "|"))


def destination(df: DataFrame, pattern: str, table: str | Column, name: str = "dest") -> DataFrame:
    """Destination from a pattern such as ``cdc-{tbl_name}``; the schema prefix is removed."""
    table = F.lit(table) if isinstance(table, str) else table
    return df.withColumn(name, template(pattern, {"tbl_name": strip_schema(table)}))


def destination_from_file(
    df: DataFrame,
    file_expr: str,
    name_pattern: str,
    file_col: str = "file_name",
    name: str = "dest",
    **fixed: str,
) -> DataFrame:
    """Destination built from elements of the file name and fixed values such as a channel.

    An element that neither the file pattern nor ``fixed`` provides is an error.
    """
    values = {k: F.lit(v) for k, v in fixed.items()}
    values.update(file_elements(col(file_col), file_expr))
    return df.withColumn(name, template(name_pattern, values))


def tx_hex(tx: Column) -> Column:
    """The 16 significant hex digits of a 24 or 36 character sequence; else the whole text."""
    return F.when(F.length(tx).isin(24, 36), F.substring(tx, 5, 16)).otherwise(tx)


def tx_partition(
    df: DataFrame,
    n: int,
    tx_col: str | None = None,
    integ_col: str | None = None,
    name: str = "partition_id",
) -> DataFrame:
    """Partition number: the transaction's hex id modulo ``n``; text that is no hex counts 0.

    Each sequence is shortened by its own length rule (24 characters for ``tx_col``, 36 for
    ``integ_col``); the integrate sequence wins if both are given.
    """
    if tx_col is None and integ_col is None:
        raise ValueError("tx_col or integ_col is needed")
    seq, width = (integ_col, 36) if integ_col is not None else (tx_col, 24)
    text = F.when(F.length(col(seq)) == width, F.substring(col(seq), 5, 16)).otherwise(col(seq))
    valid = F.coalesce(text.rlike("^[0-9a-fA-F]+$"), F.lit(False))
    short = F.conv(text, 16, 10).cast("decimal(20,0)") % F.lit(n).cast("decimal(20,0)")
    # ids over 64 bits: Horner's rule modulo n, exact for any length
    digit = lambda d: F.conv(d, 16, 10).cast("long")
    long_ = F.aggregate(F.split(text, ""), F.lit(0).cast("long"), lambda a, d: (a * 16 + digit(d)) % n)
    part = F.when(~valid, 0).when(F.length(text) <= 16, short.cast("long")).otherwise(long_)
    return df.withColumn(name, part.cast("int"))


def tx_id(tx: Column) -> Column:
    """The transaction id as a number (up to 64 bits unsigned); 0 if it is no hex text."""
    text = tx_hex(tx)
    ok = F.coalesce(text.rlike("^[0-9a-fA-F]{1,16}$"), F.lit(False))
    return F.when(ok, F.conv(text, 16, 10)).otherwise("0").cast("decimal(20,0)")


def message_size(value_col: str = "value") -> Column:
    return F.octet_length(col(value_col)).cast("long")


def size_violations(msgs: DataFrame, max_bytes: int = MESSAGE_LIMIT, value_col: str = "value") -> DataFrame:
    """Messages over the limit, with ``n_bytes``."""
    return msgs.withColumn("n_bytes", message_size(value_col)).filter(F.col("n_bytes") > max_bytes)


def check_message_size(msgs: DataFrame, max_bytes: int = MESSAGE_LIMIT, value_col: str = "value") -> DataFrame:
    """The messages unchanged; one over the limit fails the job that reads them."""
    stop = F.raise_error(F.lit(f"a message exceeds {max_bytes} bytes")).cast("boolean")
    return msgs.filter(F.when(message_size(value_col) > max_bytes, stop).otherwise(F.lit(True)))


def files_to_messages(files: DataFrame, text_col: str = "content") -> DataFrame:
    """Whole files as messages: the file's text is the payload; empty files send nothing."""
    return files.withColumn("value", col(text_col)).filter(F.length("value") > 0)


def file_sizes(df: DataFrame, file_cols: list[str], value_col: str = "value") -> DataFrame:
    """Bytes that each file's rows take as one JSON array: ``file_cols`` and ``n_bytes``."""
    total = F.sum(message_size(value_col) + 1) + 1
    return df.groupBy(*[col(c) for c in file_cols]).agg(total.alias("n_bytes"))


def rows_to_file_messages(
    df: DataFrame,
    file_cols: list[str],
    order: list[str],
    value_col: str = "value",
    max_bytes: int | None = MESSAGE_LIMIT,
) -> DataFrame:
    """Reshaped rows back to one JSON array per file, in order.

    A file is one message, so its rows have to fit the message limit. That is tested on
    the sums of their lengths before any row is collected; a larger file fails the job.
    ``max_bytes=None`` is for callers that have made this test.
    """
    if max_bytes is not None:
        large = file_sizes(df, file_cols, value_col).filter(F.col("n_bytes") > max_bytes)
        df = fail_if(df, large, f"a file exceeds {max_bytes} bytes as one message")
    item = F.struct(F.struct(*[col(c) for c in order]).alias("o"), col(value_col).alias("v"))
    rows = F.transform(F.array_sort(F.collect_list(item)), lambda x: x["v"])
    return df.groupBy(*[col(c) for c in file_cols]).agg(
        F.concat(F.lit("["), F.array_join(rows, ","), F.lit("]")).alias(value_col)
    )


def publish_counts(msgs: DataFrame, by: list[str], value_col: str = "value") -> DataFrame:
    """Messages and bytes per destination."""
    return msgs.groupBy(*[col(c) for c in by]).agg(
        F.count(F.lit(1)).alias("n_messages"),
        F.sum(message_size(value_col)).alias("n_bytes"),
    )


def files_by_destination(files: DataFrame, dest_col: str = "dest", size_col: str = "size_bytes") -> DataFrame:
    """Files and bytes per destination; the file rows themselves stay flat in ``files``."""
    return files.groupBy(col(dest_col)).agg(
        F.count(F.lit(1)).alias("n_files"),
        F.sum(col(size_col)).cast("long").alias("n_bytes"),
        F.min("file_name").alias("first_file"),
        F.max("file_name").alias("last_file"),
    )
