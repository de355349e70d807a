"""Column rules: add, remove and change dictionary columns, for many tables at once.

Rules apply strictly in ``rule_seq`` order and see the effect of earlier ones, so each
table's columns are folded over the table's rules. A table's columns and the rule list are
configuration; the tables are spread over the cluster.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changemill.functions.columns import matches_wildcard, wildcard

COLUMN_TYPE = (
    "struct<col_sequence:int,col_name:string,base_name:string,col_key:int,"
    "col_datatype:string,col_length:string,col_nullable:int>"
)
COLUMN_FIELDS = [
    "col_sequence", "col_name", "base_name", "col_key", "col_datatype", "col_length", "col_nullable",
]
RULE_FIELDS = [
    "rule_seq", "tbl_pattern", "context", "name", "base_name", "extra", "absent", "datatype",
    "datatype_match", "length", "precision", "scale", "nullable", "is_key",
]


def _filled(c: Column) -> Column:
    return c.isNotNull() & (c != "")


def _rule_length(r: Column, otherwise: str) -> Column:
    digits = F.concat(
        r["precision"].cast("string"),
        F.when(r["scale"].isNotNull(), F.concat(F.lit(","), r["scale"].cast("string"))).otherwise(""),
    )
    return F.coalesce(digits, F.when(_filled(r["length"]), r["length"]), F.lit(otherwise))


def _column(seq, name, base, key, dtype, length, nullable) -> Column:
    parts = [seq, name, base, key, dtype, length, nullable]
    return F.struct(*[p.alias(f) for p, f in zip(parts, COLUMN_FIELDS)]).cast(COLUMN_TYPE)


def _matches(c: Column, r: Column) -> Column:
    """Does a modify rule apply to a column, by name or by datatype and precision?"""
    attr = r"^(.*?)\[prec(<=|>=|=|<|>)(-?[0-9]+) .*scale=0\]$"
    full = F.coalesce(r["datatype_match"], F.lit(""))
    op = F.regexp_extract(full, attr, 2)
    dtype = F.when(op != "", F.regexp_extract(full, attr, 1)).otherwise(full)
    limit_text = F.regexp_extract(full, attr, 3)
    limit, have = limit_text.try_cast("int"), c["col_length"].try_cast("int")
    within = (
        F.when(F.contains(c["col_length"], F.lit(",")), False)
        .when(op == "=", c["col_length"] == limit_text)
        .when(op == "<", have < limit)
        .when(op == ">", have > limit)
        .when(op == "<=", have <= limit)
        .when(op == ">=", have >= limit)
        .otherwise(True)
    )
    named = F.coalesce(c["col_name"] == r["name"], F.lit(False))
    typed = (dtype != "") & (c["col_datatype"] == dtype)
    return (named | F.coalesce(typed, F.lit(False))) & ((op == "") | F.coalesce(within, F.lit(False)))


def _modify(cols: Column, r: Column) -> Column:
    first = F.array_position(F.transform(cols, lambda c: _matches(c, r)), F.lit(True))

    def change(c, i):
        hit = _matches(c, r) & (~_filled(r["name"]) | (i + 1 == first))
        new = _column(
            c["col_sequence"],
            c["col_name"],
            F.coalesce(r["base_name"], c["base_name"]),
            F.when(r["is_key"], 1).otherwise(c["col_key"]),
            F.coalesce(r["datatype"], c["col_datatype"]),
            F.when(r["datatype"].isNotNull(), _rule_length(r, "")).otherwise(c["col_length"]),
            F.when(r["nullable"], 1).otherwise(c["col_nullable"]),
        )
        return F.when(hit, new).otherwise(c)

    return F.transform(cols, change)


def _add(cols: Column, r: Column, left_out: list[str]) -> Column:
    last = F.coalesce(F.array_max(F.transform(cols, lambda c: c["col_sequence"])), F.lit(0))
    new = _column(
        last + 1,
        r["name"],
        F.when(_filled(r["base_name"]), r["base_name"]).otherwise(r["name"]),
        F.when(r["is_key"], 1).otherwise(0),
        r["datatype"],
        _rule_length(r, "0"),
        F.when(r["nullable"], 1).otherwise(0),
    )
    skip = r["name"].isin(*left_out) if left_out else F.lit(False)
    return F.when(skip, cols).otherwise(F.concat(cols, F.array(new)))


def _key(kind: str, text: Column) -> Column:
    return F.struct(F.lit(kind).alias("kind"), text.alias("text"))


def _with_rules(tables: DataFrame, rules_df: DataFrame, context: str | None) -> DataFrame:
    """Each table with the array of its rules in order.

    Rules meet names by equality: a rule's key is the literal text its pattern begins with or,
    where that is empty, the one it ends with; a name's keys are its beginnings and ends of the
    lengths that occur among the rules. Only what meets is tested against the pattern. Rules
    without literal text at either end, and those for all other names (``!``), meet every name.
    """
    rules = rules_df if context is None else rules_df.filter(~_filled(F.col("context")) | (F.col("context") == context))
    pattern = wildcard(F.col("tbl_pattern"))
    rules = rules.select(F.struct(*[F.col(c) for c in RULE_FIELDS], pattern.alias("wildcard")).alias("r"))
    ends_with = F.regexp_extract("r.tbl_pattern", r"[^*?\[\]]*$", 0)
    literal = F.when(F.col("r.wildcard.negate"), _key("any", F.lit(""))).when(F.col("r.wildcard.prefix") != "", _key("begins", F.col("r.wildcard.prefix"))).when(
        F.col("r.tbl_pattern").startswith("*") & (ends_with != ""), _key("ends", ends_with)).otherwise(_key("any", F.lit("")))
    rules = rules.withColumn("key", literal)
    # at most a few dozen lengths
    lengths = rules.agg(F.collect_set(F.struct("key.kind", F.length("key.text").alias("n"))).alias("l")).scalar()
    names = tables.select("tbl_name").distinct().withColumn("__mill_l", lengths)
    name, fits = F.col("tbl_name"), F.filter("__mill_l", lambda x: x["n"] <= F.length(F.col("tbl_name")))
    part = lambda x: F.when(x["kind"] == "ends", F.right(name, x["n"])).otherwise(F.left(name, x["n"]))
    keys = names.select("tbl_name", F.explode(F.transform(fits, lambda x: F.struct(x["kind"].alias("kind"), part(x).alias("text")))).alias("k"))
    met = keys.join(rules, F.col("k") == F.col("key")).filter(matches_wildcard(F.col("tbl_name"), F.col("r.wildcard")))
    mine = met.groupBy(F.col("tbl_name").alias("__mill_t")).agg(F.array_sort(F.collect_list("r")).alias("__mill_rules"))
    out = tables.join(mine, F.col("tbl_name") == F.col("__mill_t"), "left").drop("__mill_t")
    none = F.array().cast(mine.schema["__mill_rules"].dataType)
    return out.withColumn("__mill_rules", F.coalesce("__mill_rules", none))


def rules_for(rules_df: DataFrame, tables: DataFrame, context: str | None = None) -> DataFrame:
    """The rules of each table: ``tbl_name`` and the rule's fields."""
    mine = _with_rules(tables.select("tbl_name"), rules_df, context)
    # outer: a plain explode would make Spark compute the list once more to filter on its size
    each = mine.select("tbl_name", F.explode_outer("__mill_rules").alias("r"))
    return each.filter("r IS NOT NULL").select("tbl_name", *[F.col("r")[c].alias(c) for c in RULE_FIELDS])


def apply_rules(
    columns_df: DataFrame,
    rules_df: DataFrame,
    context: str | None = None,
    burst_only: list[str] = (),
    ignored: list[str] = (),
) -> DataFrame:
    """Dictionary rows after all rules of their table, in order.

    An *absent* rule removes the named column, an *extra* rule appends one unless its name
    is burst-only or ignored, any other rule changes columns by name (first hit only) or by
    datatype. Tables are told apart by ``tbl_name``.
    """
    left_out = [*burst_only, *ignored]
    item = F.struct(*[F.col(c) for c in COLUMN_FIELDS]).cast(COLUMN_TYPE)
    tables = columns_df.groupBy("tbl_name").agg(F.array_sort(F.collect_list(item)).alias("cols"))

    def step(cols, r):
        kept = F.filter(cols, lambda c: ~c["col_name"].eqNullSafe(r["name"]))
        return (
            F.when(F.coalesce(r["absent"], F.lit(False)), kept)
            .when(F.coalesce(r["extra"], F.lit(False)), _add(cols, r, left_out))
            .otherwise(_modify(cols, r))
        )

    mine = _with_rules(tables, rules_df, context)
    # outer: a plain explode would make Spark fold the rules once more to filter on the size
    done = mine.select(
        "tbl_name", F.explode_outer(F.aggregate("__mill_rules", F.col("cols"), step)).alias("c")
    )
    return done.filter("c IS NOT NULL").select("tbl_name", *[F.col("c")[f].alias(f) for f in COLUMN_FIELDS])


def _kind(rules_df: DataFrame, kind: str) -> DataFrame:
    absent, extra = F.coalesce("absent", F.lit(False)), F.coalesce("extra", F.lit(False))
    tests = {"absent": absent, "extra": extra & ~absent, "modify": ~absent & ~extra}
    return rules_df.filter(tests[kind])


def apply_extra(columns_df, rules_df, context=None, burst_only=(), ignored=()) -> DataFrame:
    """Only the rules that add columns."""
    return apply_rules(columns_df, _kind(rules_df, "extra"), context, burst_only, ignored)


def apply_absent(columns_df, rules_df, context=None) -> DataFrame:
    """Only the rules that remove columns."""
    return apply_rules(columns_df, _kind(rules_df, "absent"), context)


def apply_modify(columns_df, rules_df, context=None) -> DataFrame:
    """Only the rules that change columns."""
    return apply_rules(columns_df, _kind(rules_df, "modify"), context)
