"""Matching staged files to tables, and checking the staged files against a manifest.

All inputs are DataFrames of file names: ``files`` has ``file_name`` and optionally
``n_rows``, ``size_bytes`` and ``file_seq``; ``tables`` has ``tbl_name``, ``base_name``,
``columns`` and ``keys``.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changemill.functions.columns import col
from changemill.operators.joins import without

TABLE_ELEMENT = "tbl_name"


def _pieces(expr: str) -> list[str]:
    return [p for p in re.split(r"(\{[^}]*\})", expr) if p]


def file_elements(name: Column, expr: str) -> dict[str, Column]:
    """``{element}`` values of a file name: the text up to the next literal of ``expr``."""
    pieces, out, pattern, group = _pieces(expr), {}, "^", 0
    where = {}
    for i, piece in enumerate(pieces):
        if piece.startswith("{"):
            group += 1
            pattern += "(.*)$" if i == len(pieces) - 1 else "(.*?)"
            where[piece[1:-1]] = group
        else:
            pattern += re.sub(r"([\\.^$+*?(){}\[\]|])", r"\\\1", piece)
    for element, g in where.items():
        out[element] = F.regexp_extract(name, pattern, g)
    return out


def parse_file_name(df: DataFrame, expr: str, file_col: str = "file_name") -> DataFrame:
    """One column per ``{element}`` of the naming expression."""
    for element, value in file_elements(col(file_col), expr).items():
        df = df.withColumn(element, value)
    return df


def table_in_file_name(
    name: Column,
    ext: str = "csv",
    split: str = "first",
    expr: str | None = None,
    by: str = "name",
    lower: bool = False,
) -> Column:
    """Table name in a file name.

    By default ``<stamp>-<table>.<ext>`` is split at its first dash (``split='first'``; no
    dash: the whole name) or at its last one (``'last'``; no dash: no table). ``expr`` is a
    naming expression whose element ``tbl_name`` (any prefix allowed) is the table;
    ``by='folder'`` takes the first folder of the path.
    """
    if by == "folder":
        out = F.regexp_extract(name, "^([^/]+)/", 1)
    elif expr is not None:
        found = [e for e in file_elements(name, expr) if e.endswith(TABLE_ELEMENT)]
        if not found:
            raise ValueError(f"no {{{TABLE_ELEMENT}}} element in {expr!r}")
        out = file_elements(name, expr)[found[0]]
    else:
        tail = r"\.(?i:" + re.escape(ext) + ")$"
        stem = F.regexp_replace(name, tail, "")
        if split == "first":
            out = F.regexp_replace(stem, "^[^-]*-", "")
        elif split == "last":
            out = F.regexp_extract(stem, "-([^-]*)$", 1)
        else:
            raise ValueError("split must be 'first' or 'last'")
    return F.lower(out) if lower else out


def route_files(files: DataFrame, tables: DataFrame, **how) -> DataFrame:
    """Files with the table they belong to: ``tables`` columns followed by ``files`` columns.

    Files of no known table are left out; see ``unrouted_files``. The number of tables and
    files is metadata, so Catalyst picks the join by their size.
    """
    named = files.withColumn("__mill_table", table_in_file_name(F.col("file_name"), **how))
    key = F.lower(F.col("tbl_name")) if how.get("lower") else F.col("tbl_name")
    joined = tables.join(named, key == F.col("__mill_table"), "inner").drop("__mill_table")
    return joined


def target_names(tables: DataFrame, mapped: DataFrame) -> DataFrame:
    """Set ``base_name`` from an explicit ``tbl_name``/``target`` map where it has a row."""
    m = mapped.select(F.col("tbl_name").alias("__mill_n"), F.col("target").alias("__mill_target"))
    out = tables.join(m, F.col("tbl_name") == F.col("__mill_n"), "left")
    name = F.coalesce("__mill_target", "base_name").alias("base_name")
    return out.select(*[name if c == "base_name" else col(c) for c in tables.columns])


def unrouted_files(files: DataFrame, routed: DataFrame) -> DataFrame:
    """Files that match no table."""
    return without(files, routed, ["file_name"])


def require_routed(files: DataFrame, routed: DataFrame, strict: bool = True) -> DataFrame:
    """``routed``, checked now: ``strict`` rejects any unmatched file, else only a cycle in
    which no file matched. The lists are metadata; at most five names reach the driver."""
    if strict:
        lost = [r["file_name"] for r in unrouted_files(files, routed).limit(5).collect()]
        if lost:
            raise ValueError(f"files that belong to no table: {lost}")
    elif routed.isEmpty() and not files.isEmpty():
        raise ValueError("no file belongs to a table")
    return routed


def skip_tables(routed: DataFrame, names: list[str]) -> DataFrame:
    return routed.filter(~F.col("tbl_name").isin(*names)) if names else routed


def exclude_processed(files: DataFrame, done: DataFrame) -> DataFrame:
    """Files that are not in the list of files already processed."""
    return without(files, done, ["file_name"])


def limit_file_size(files: DataFrame, max_bytes: int, on_error: str = "fail") -> DataFrame:
    """Files within the limit; ``on_error='fail'`` fails the job if one is over it.

    With ``'drop'`` the files left out are ``oversize_files(files, max_bytes)``.
    """
    if on_error not in ("fail", "drop"):
        raise ValueError("on_error must be 'fail' or 'drop'")
    small = files.filter(F.col("size_bytes") <= max_bytes)
    if on_error == "drop":
        return small
    stop = F.raise_error(F.lit(f"a file exceeds {max_bytes} bytes")).cast("boolean")
    return files.filter(F.when(F.col("size_bytes") > max_bytes, stop).otherwise(F.lit(True)))


def oversize_files(files: DataFrame, max_bytes: int) -> DataFrame:
    return files.filter(F.col("size_bytes") > max_bytes)


def reconcile(manifest: DataFrame, listing: DataFrame) -> DataFrame:
    """Per table: files listed in the manifest, found, missing and extra, and a verdict.

    ``manifest`` has ``tbl_name`` and ``file_name``; ``listing`` has the same columns for
    the files present. ``skip``: nothing found; ``incomplete``: some files are missing;
    ``ok``: all are there, whatever else lies beside them.
    """
    m = manifest.select("tbl_name", "file_name", F.lit(1).alias("in_m")).distinct()
    f = listing.select("tbl_name", "file_name", F.lit(1).alias("in_f")).distinct()
    both = m.join(f, ["tbl_name", "file_name"], "full_outer")
    count = lambda c: F.count(F.when(c, 1))
    in_m, in_f = F.col("in_m").isNotNull(), F.col("in_f").isNotNull()
    out = both.groupBy("tbl_name").agg(
        count(in_m).alias("n_listed"),
        count(in_m & in_f).alias("n_found"),
        count(in_m & ~in_f).alias("n_missing"),
        count(~in_m & in_f).alias("n_extra"),
    )
    verdict = (
        F.when(F.col("n_found") == 0, "skip")
        .when(F.col("n_missing") > 0, "incomplete")
        .otherwise("ok")
    )
    return out.withColumn("status", verdict)


def require_complete(reconciled: DataFrame) -> DataFrame:
    """Tables whose files are all there; a table with some files missing fails the job."""
    stop = F.raise_error(F.lit("staged files are missing")).cast("boolean")
    # one condition: as two filters, the second would let the optimizer fold the first away
    return reconciled.filter(
        F.when(F.col("status") == "incomplete", stop).otherwise(F.col("status") == "ok")
    )


def table_counts(routed: DataFrame) -> DataFrame:
    """Files and rows per table."""
    return routed.groupBy("tbl_name").agg(
        F.count(F.lit(1)).alias("n_files"), F.sum("n_rows").cast("long").alias("n_rows")
    )
