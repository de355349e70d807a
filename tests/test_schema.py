"""Types, column rules and schema drift."""

import pytest
from pyspark.sql import functions as F

from changemill.operators import merge
from changemill.schema import evolve, rules, types

COLS = "tbl_name string, col_sequence int, col_name string, base_name string, col_key int, col_datatype string, col_length string, col_nullable int"
RULE = ("rule_seq int, tbl_pattern string, context string, name string, base_name string, extra boolean, absent boolean, datatype string, "
        "datatype_match string, length string, precision int, scale int, nullable boolean, is_key boolean")


def one_type(spark, dtype, length="", **kw):
    df = spark.createDataFrame([("t", 1, "c", "c", 0, dtype, length, 1)], COLS)
    return types.map_types(df, **kw).first()["target_type"]


def test_every_listed_name_has_a_type(spark):
    data = [("t", i, "c", "c", 0, n, "10", 1) for i, n in enumerate(
        [n for names in types.PLAIN.values() for n in names] + types.BOOLEAN_NAMES + types.DECIMAL_NAMES + list(types.MONEY_NAMES))]
    got = types.map_types(spark.createDataFrame(data, COLS)).select("col_datatype", "target_type").collect()
    assert len(got) == len({r["col_datatype"] for r in got}) and all(r["target_type"] for r in got)
    for r in got:
        spark.createDataFrame([], f"x {r['target_type']}")


@pytest.mark.parametrize("dtype,length,want", [
    ("number", "0", "DOUBLE"), ("number", "8", "DECIMAL(8,0)"), ("number", "8,0", "DECIMAL(8,0)"), ("number", "10,-2", "DECIMAL(12,0)"),
    ("number", "2,6", "DECIMAL(2,2)"), ("number", "40,2", "DOUBLE"), ("decimal", "38,38", "DOUBLE"), ("decimal", "38,37", "DECIMAL(38,37)"),
    ("integer identity", "", "INTEGER"), (" identity", "", None), ("money", "", "DECIMAL(19,4)"), ("bit", "", "BYTE"),
    ("date", "", "TIMESTAMP"), ("date (mysql)", "", "DATE"), ("time2", "", "STRING"), ("rowversion", "", "BINARY"),
    ("strange", "", None), ("decimal", "", None), ("decimal", "0", None),
])
def test_type_rules(spark, dtype, length, want):
    if want is None:
        with pytest.raises(Exception, match="no Spark type"):
            one_type(spark, dtype, length)
    else:
        assert one_type(spark, dtype, length) == want


def test_type_options(spark):
    assert one_type(spark, "bit", bool_to_boolean=True) == "BOOLEAN"
    assert one_type(spark, "number", "0", number_to_integer=True) == "INTEGER"
    assert one_type(spark, "number", "10,0", number_to_integer=True) == "INTEGER"
    assert one_type(spark, "number", "11", number_to_integer=True) == "DECIMAL(11,0)"
    assert one_type(spark, "number", "10,2", number_to_integer=True) == "DECIMAL(10,2)"


def rule(seq, pattern="*", **kw):
    names = [f.split()[0] for f in RULE.split(", ")]
    base = {n: None for n in names} | {"extra": False, "absent": False, "nullable": False, "is_key": False}
    return tuple({**base, "rule_seq": seq, "tbl_pattern": pattern, **kw}[n] for n in names)


def applied(spark, cols, rule_rows, **kw):
    c = spark.createDataFrame([("t", i, n, n, 0, d, ln, 0) for i, (n, d, ln) in enumerate(cols)], COLS)
    r = spark.createDataFrame(rule_rows, RULE)
    out = rules.apply_rules(c, r, **kw).orderBy("col_sequence").collect()
    return [(x["col_name"], x["base_name"], x["col_datatype"], x["col_length"], x["col_nullable"], x["col_key"]) for x in out]


def test_rules_apply_in_order(spark):
    got = applied(spark, [("a", "number", "5"), ("b", "number", "9"), ("c", "number", "5,2"), ("d", "number", "x")], [
        rule(2, name="e", datatype="bigint"),
        rule(1, name="e", extra=True, datatype="number", precision=4, scale=1, is_key=True),
        rule(3, datatype_match="number[prec<=6 && scale=0]", datatype="integer", nullable=True),
        rule(4, name="b", absent=True),
    ])
    assert got == [("a", "a", "integer", "", 1, 0), ("c", "c", "number", "5,2", 0, 0), ("d", "d", "number", "x", 0, 0),
                   ("e", "e", "bigint", "", 0, 1)]


def test_rule_by_name_stops_at_its_first_hit(spark):
    # the datatype matches the first column, so the named one is never reached
    got = applied(spark, [("a", "x", "1"), ("b", "y", "1")], [rule(1, name="b", datatype_match="x", base_name="hit")])
    assert [g[1] for g in got] == ["hit", "b"]
    got = applied(spark, [("a", "x", "1"), ("b", "x", "1")], [rule(1, datatype_match="x", base_name="hit")])
    assert [g[1] for g in got] == ["hit", "hit"]


@pytest.mark.parametrize("match,hit", [
    ("n[prec=5 && scale=0]", True), ("n[prec<5 && scale=0]", False), ("n[prec>4 && scale=0]", True), ("n[prec>=6 && scale=0]", False),
    ("n[prec<=5 && scale=0]", True), ("n[scale=0]", False), ("n", True), ("m", False),
])
def test_datatype_match(spark, match, hit):
    got = applied(spark, [("a", "n", "5")], [rule(1, datatype_match=match, base_name="hit")])
    assert (got[0][1] == "hit") is hit


def test_rule_scope(spark):
    cols = [("a", "x", "1")]
    for kw, pattern, hit in [({}, "t", True), ({}, "!t", False), ({}, "u*", False), ({"context": "other"}, "t", False), ({"context": "c"}, "t", True)]:
        got = applied(spark, cols, [rule(1, pattern, name="a", base_name="hit", context="c")], **kw)
        assert (got[0][1] == "hit") is hit
    got = applied(spark, cols, [rule(1, name="op_type", extra=True, datatype="integer")], burst_only=["op_type"])
    assert len(got) == 1


def test_schema_of_a_table(spark):
    df = spark.createDataFrame([("t", 2, "b", "B", 0, "varchar", "5", 1), ("t", 1, "a", "A", 1, "number", "9,2", 0), ("u", 1, "z", "z", 0, "int", "", 0)], COLS)
    s = types.struct_type(types.map_types(df), "t", lower=True)
    assert s.simpleString() == "struct<a:decimal(9,2),b:string>" and [f.nullable for f in s] == [False, True]
    assert [tuple(r) for r in types.key_columns(df).collect()] == [("t", ["A"])]


def test_drift(spark, rows):
    t = spark.createDataFrame([(1, "a")], "k int, v string")
    b = spark.createDataFrame([(2, "b", 5, 1)], "K int, v string, extra int, op_type int")
    assert evolve.detect_drift(b, t) == ["extra"]
    with pytest.raises(ValueError, match="extra"):
        evolve.detect_drift(b, t, evolve=False)
    assert evolve.detect_drift(b, t, derived=["extra"], evolve=False) == []
    wide = evolve.evolve_for(t, b, {"extra": "bigint"})
    assert rows(merge.merge_hard(wide, b.withColumnRenamed("K", "k"), ["k"])) == [(1, "a", None), (2, "b", 5)]


def test_partition_spec():
    spec = {"*": ["z"], "o*": ["y"], "orders": ["x"]}
    assert [evolve.partition_columns(spec, t) for t in ("orders", "other", "lines")] == [["x"], ["y"], ["z"]]
    assert evolve.partition_columns({"!o*": ["n"]}, "lines") == ["n"] and evolve.partition_columns({}, "t") == []


def _rules(spark, patterns):
    rows = [(i, p) for i, p in enumerate(patterns)]
    df = spark.createDataFrame(rows, "rule_seq int, tbl_pattern string")
    types = {"extra": "boolean", "absent": "boolean", "nullable": "boolean", "is_key": "boolean", "precision": "int", "scale": "int"}
    return df.select("*", *[F.lit(None).cast(types.get(c, "string")).alias(c) for c in rules.RULE_FIELDS if c not in df.columns])


def test_rules_meet_tables_like_their_patterns(spark):
    import fnmatch

    patterns = ["*", "ord*", "orders", "*_hist", "!ord*", "!*_hist", "o?ders", "[a-c]*", "*mid*", "ord*_hist", "", "x[!a]z", "*s", "ord*"]
    names = ["orders", "orders_hist", "cust", "amidb", "xbz", "xaz", "", "s", "ord"]
    found = rules.rules_for(_rules(spark, patterns), spark.createDataFrame([(n,) for n in names], "tbl_name string"))
    got = sorted((r["tbl_name"], r["rule_seq"]) for r in found.collect())
    want = [(n, i) for n in names for i, p in enumerate(patterns) if (fnmatch.fnmatchcase(n, p[1:]) is False if p.startswith("!") else fnmatch.fnmatchcase(n, p))]
    assert got == sorted(want)


def test_many_rules_and_tables_meet_by_key(spark):
    many = _rules(spark, [f"area{k}_*" for k in range(5_000)] + [f"*_end{k}" for k in range(5_000)])
    tables = spark.range(100_000).select(F.format_string("area%d_t%d_end%d", F.col("id") % 20_000, F.col("id"), F.col("id") % 10_000).alias("tbl_name"))
    out = rules.rules_for(many, tables)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert out.count() == 25_000 + 50_000
