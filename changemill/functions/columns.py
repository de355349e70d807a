"""Column expressions shared by the operators. Everything here stays inside the JVM."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(name: str) -> Column:
    """A column by its exact name, whatever characters it holds (``class#``, ``a.b``)."""
    return F.col("`" + name.replace("`", "``") + "`")


def order_value(order: list[str]) -> Column:
    """One comparable value for an ordering; a struct only if several columns are needed."""
    cols = [col(c) for c in order]
    return cols[0] if len(cols) == 1 else F.struct(*cols)


def cast_to(c: Column, dtype, on_error: str = "fail") -> Column:
    """Cast that fails the job on a bad value, or gives NULL with ``on_error='null'``."""
    if on_error not in ("fail", "null"):
        raise ValueError("on_error must be 'fail' or 'null'")
    return c.try_cast(dtype) if on_error == "null" else c.cast(dtype)


def empty_to_null(c: Column) -> Column:
    """An empty text is a missing value."""
    return F.when(c != "", c)


def lenient_double(c: Column) -> Column:
    """Text as double where text that is no number counts as 0 and NULL stays NULL."""
    return F.when(c.isNotNull(), F.coalesce(c.try_cast("double"), F.lit(0.0)))


def int_or_text(c: Column) -> Column:
    """Text that parses as a whole number in its canonical spelling, else the text."""
    return F.coalesce(c.try_cast("bigint").cast("string"), c)


def join_keys(cols: list[Column], sep: str = "") -> Column:
    """Key values as one text. A NULL part becomes empty, so no part is skipped."""
    return F.concat_ws(sep, *[F.coalesce(c.cast("string"), F.lit("")) for c in cols])


def template(text: str, values: dict[str, Column]) -> Column:
    """Fill ``{name}`` places of a text with columns; an unknown place is an error."""
    parts = []
    for piece in re.split(r"(\{[^}]*\})", text):
        if not piece:
            continue
        if piece.startswith("{"):
            if piece[1:-1] not in values:
                raise ValueError(f"no value for {piece} in {text!r}")
            parts.append(values[piece[1:-1]])
        else:
            parts.append(F.lit(piece))
    return F.concat(*parts) if parts else F.lit("")


def strip_schema(name: Column) -> Column:
    """The part after the first dot, or the whole name."""
    return F.regexp_replace(name, r"^[^.]*\.", "")


def table_of(name: Column) -> tuple[Column, Column]:
    """(schema, table) of a name split at its first dot; the schema may be empty."""
    return F.regexp_extract(name, r"^([^.]*)\.", 1), strip_schema(name)


def wildcard_regex(pattern: Column) -> Column:
    """A shell wildcard column (``*``, ``?``, ``[a-c]``, ``[!a-c]``) as a regex column."""
    escaped = F.regexp_replace(pattern, r"([\\.^$+(){}|])", r"\\$1")
    escaped = F.regexp_replace(escaped, r"\[!", "[^")
    escaped = F.regexp_replace(escaped, r"\*", ".*")
    escaped = F.regexp_replace(escaped, r"\?", ".")
    return F.concat(F.lit("(?s)^"), escaped, F.lit("$"))


def wildcard(pattern: Column) -> Column:
    """A wildcard pattern taken apart once, for tests against many names.

    ``negate``: it starts with ``!``; ``prefix``: the text before the first wildcard;
    ``regex``: the whole test, NULL if the prefix alone decides.
    """
    body = F.regexp_replace(pattern, "^!", "")
    prefix = F.regexp_extract(body, r"^[^*?\[]*", 0)
    regex = F.when(body != F.concat(prefix, F.lit("*")), wildcard_regex(body))
    return F.struct(pattern.startswith("!").alias("negate"), prefix.alias("prefix"), regex.alias("regex"))


def matches_wildcard(name: Column, parts: Column) -> Column:
    """Test a name against a taken-apart pattern; most names fail at the prefix already."""
    starts = F.startswith(name, parts["prefix"])
    hit = F.when(starts, F.when(parts["regex"].isNull(), True).otherwise(F.rlike(name, parts["regex"])))
    return F.coalesce(hit, F.lit(False)) != parts["negate"]

