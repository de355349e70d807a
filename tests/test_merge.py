"""Merges against hand-made cases and against a row-by-row model of the statements."""

import random

import pytest
from pyspark.sql import functions as F

from changemill.operators import changes, keyed, merge, partial
from changemill.plans.integrate import integrate
from changemill.spec import ApplySpec

T = "k int, v string"
B = "k int, v string, op_type int, is_deleted int"


def frames(spark, t, b, ts=T, bs=B):
    return spark.createDataFrame(t, ts), spark.createDataFrame(b, bs)


def test_hard_merge_cases(spark, rows):
    t, b = frames(spark, [(1, "a"), (2, "b"), (3, "c")], [(1, "A", 2, 0), (2, None, 0, 1), (9, "n", 1, 0), (8, "x", 0, 1), (7, "u", 2, 0)])
    want = rows(spark.createDataFrame([(1, "A"), (3, "c"), (9, "n"), (7, "u")], T))
    assert rows(merge.merge_hard(t, b, ["k"])) == want
    assert rows(merge.merge_hard(t, b, ["k"], unique_keys=False)) == want
    assert rows(merge.merge_key_change(t, b, ["k"])) == want
    assert rows(merge.merge_key_change(t, b, ["k"], unique_keys=False)) == want
    assert rows(merge.merge_plain(t, b, ["k"])) == want
    assert rows(merge.merge_plain(t, b, ["k"], insert_unmatched_deletes=True)) == sorted(want + [(8, "x")], key=repr)


def test_null_keys(spark, rows):
    t, b = frames(spark, [(None, "old"), (1, "a")], [(None, "new", 2, 0)])
    assert rows(merge.merge_hard(t, b, ["k"])) == rows(spark.createDataFrame([(None, "new"), (1, "a")], T))
    assert rows(merge.merge_plain(t, b, ["k"])) == rows(spark.createDataFrame([(None, "old"), (None, "new"), (1, "a")], T))


def test_control_rows_never_reach_the_target(spark, rows):
    t, b = frames(spark, [(1, "a")], [(2, "x", 5, 0), (3, "y", 8, 1), (4, "z", 1, 0)])
    for out in (merge.merge_hard(t, b, ["k"]), merge.merge_soft(t.withColumn("is_deleted", F.lit(0)), b, ["k"]).drop("is_deleted")):
        assert rows(out) == [(1, "a"), (4, "z")]


def test_duplicate_targets_are_all_updated(spark, rows):
    t, b = frames(spark, [(1, "a"), (1, "b"), (2, "c"), (2, "d")], [(1, "A", 2, 0), (2, None, 0, 1)])
    assert rows(merge.merge_hard(t, b, ["k"], unique_keys=False)) == [(1, "A"), (1, "A")]
    assert rows(merge.merge_hard(t, b, ["k"])) == [(1, "A")]


def test_target_only_column_is_kept(spark, rows):
    t = spark.createDataFrame([(1, "a", "keep"), (2, "b", "gone")], "k int, v string, extra string")
    b = spark.createDataFrame([(1, "A", 2, 0), (2, "", 0, 1), (3, "C", 1, 0)], B)
    assert rows(merge.merge_hard(t, b, ["k"])) == [(1, "A", "keep"), (3, "C", None)]


@pytest.mark.parametrize("unique", [True, False])
def test_key_change_pair(spark, rows, unique):
    t, b = frames(spark, [(1, "a"), (2, "b")], [(1, "a", 0, 1), (1, "new", 1, 0), (5, "x", 0, 1), (5, "y", 1, 0)])
    assert rows(merge.merge_key_change(t, b, ["k"], unique_keys=unique)) == [(1, "new"), (2, "b"), (5, "y")]


def test_key_change_two_key_columns(spark, rows):
    ts, bs = "a int, b int, v string", "a int, b int, v string, op_type int"
    t = spark.createDataFrame([(1, 1, "x"), (1, 2, "y")], ts)
    b = spark.createDataFrame([(1, 1, "x", 0), (1, 1, "z", 1), (1, 2, "w", 2)], bs)
    assert rows(merge.merge_key_change(t, b, ["a", "b"])) == [(1, 1, "z"), (1, 2, "w")]


def test_null_key_delete_counts_only_without_ambiguity(spark, rows):
    t, b = frames(spark, [(None, "n"), (1, "a")], [(None, "n", 0, 1)])
    assert rows(merge.merge_key_change(t, b, ["k"])) == [(1, "a")]
    b2 = b.union(spark.createDataFrame([(1, "a", 0, 1), (1, "b", 1, 0)], B))
    assert rows(merge.merge_key_change(t, b2, ["k"])) == [(1, "b"), (None, "n")]


def test_ambiguous_merge_fails(spark):
    t, b = frames(spark, [(1, "a")], [(1, "x", 2, 0), (1, "y", 2, 0)])
    with pytest.raises(Exception, match="several change rows"):
        merge.merge_key_change(t, b, ["k"]).collect()
    with pytest.raises(Exception, match="several change rows"):
        merge.merge_hard(t, b, ["k"], check=True).collect()


def test_ambiguous_new_keys_are_inserted_twice(spark, rows):
    t, b = frames(spark, [(1, "a")], [(2, "x", 1, 0), (2, "y", 1, 0)])
    assert rows(merge.merge_key_change(t, b, ["k"])) == [(1, "a"), (2, "x"), (2, "y")]


def _merges():
    """Every merge that fails where a target row meets several change rows."""
    for unique in (True, False):
        yield f"hard {unique}", lambda t, b, u=unique: merge.merge_hard(t, b, ["k"], unique_keys=u)
        yield f"soft {unique}", lambda t, b, u=unique: merge.merge_soft(t, b, ["k"], unique_keys=u)
        yield f"plain {unique}", lambda t, b, u=unique: merge.merge_plain(t, b, ["k"], unique_keys=u)
        yield f"plain soft {unique}", lambda t, b, u=unique: merge.merge_plain(t, b, ["k"], soft=True, unique_keys=u)
    yield "split", lambda t, b: merge.merge_then_insert(t, b, ["k"])
    yield "update insert", lambda t, b: merge.apply_update_insert(t, b, ["k"])


@pytest.mark.parametrize("name", [n for n, _ in _merges()])
def test_repeated_change_keys(spark, rows, name):
    """Two rows of a key fail only where a target row meets both."""
    fn = dict(_merges())[name]
    t = spark.createDataFrame([(1, "a", 0), (None, "n", 0)], "k int, v string, is_deleted int")
    new = spark.createDataFrame([(2, "x", 2, 0), (2, "y", 2, 0), (3, "p", 0, 1), (3, "q", 0, 1), (1, "A", 2, 0)], B)
    out = rows(fn(t, new).select("k", "v"))
    assert (1, "A") in out and (None, "n") in out
    added = [r for r in out if r[0] in (2, 3)]
    if name == "split":
        assert added == []
    elif name == "update insert" or "plain soft" in name:
        assert added == [(2, "x"), (2, "y"), (3, "p"), (3, "q")]
    else:
        assert added == [(2, "x"), (2, "y")]
    for twice in ([(1, "x", 2, 0), (1, "y", 2, 0)], [(1, "x", 0, 1), (1, "y", 0, 1), (1, "z", 2, 0)]):
        with pytest.raises(Exception, match="several change rows"):
            fn(t, spark.createDataFrame(twice, B)).collect()


def test_checked_merge_reads_the_target_once(spark, tmp_path):
    spark.range(100).select(F.col("id").cast("int").alias("k"), F.lit("a").alias("v")).write.parquet(str(tmp_path / "t"))
    t = spark.read.parquet(str(tmp_path / "t"))
    b = spark.createDataFrame([(1, "A", 2, 0)], B)
    plan = merge.merge_hard(t, b, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1


def test_split_inserts(spark, rows):
    t, b = frames(spark, [(1, "a"), (2, "b")], [(1, "A", 2, 0), (2, "", 0, 1), (3, "n", 1, 0), (4, "lost", 2, 0)])
    once = merge.merge_then_insert(t, b, ["k"])
    assert rows(once) == [(1, "A"), (3, "n")]
    assert rows(merge.merge_then_insert(once, b, ["k"])) == [(1, "A"), (3, "n"), (3, "n")]


@pytest.mark.parametrize("unique", [True, False])
def test_soft_delete_and_reinsert_ends_alive(spark, rows, unique):
    t = spark.createDataFrame([(1, "a", 0), (2, "b", 0), (3, "c", 0)], "k int, v string, is_deleted int")
    b = spark.createDataFrame([(1, "a", 0, 1), (1, "again", 1, 0), (2, "dead", 0, 1), (7, "ignored", 0, 1)], B)
    out = merge.merge_soft(t, b, ["k"], unique_keys=unique)
    assert rows(out) == [(1, "again", 0), (2, "dead", 1), (3, "c", 0)]


def test_soft_without_key(spark, rows):
    t = spark.createDataFrame([(1, "a", 0), (1, "a", 0), (2, "b", 0)], "k int, v string, is_deleted int")
    b = spark.createDataFrame([(1, "a", 0, 1), (1, "a", 0, 1), (2, "b", 1, 0)], B)
    want = [(1, "a", 1), (1, "a", 1), (2, "b", 0), (2, "b", 0)]
    for null_safe in (True, False):
        assert rows(merge.merge_soft_nokey(t, b, ["k", "v"], null_safe=null_safe)) == want
    clash = spark.createDataFrame([(1, "x", 0, 1), (1, "y", 0, 1)], B)
    with pytest.raises(Exception, match="several different change rows"):
        merge.merge_soft_nokey(t, clash, ["k"]).collect()


def test_history(spark, rows):
    t, b = frames(spark, [(1, "a")], [(1, "b", 2, 0), (2, "x", 1, 0), (2, "y", 2, 0)])
    assert rows(merge.merge_history(t, b, ["k"])) == [(1, "a"), (2, "x"), (2, "y")]


def test_three_step_is_not_repeatable(spark, rows):
    t, b = frames(spark, [(1, "a"), (2, "b"), (None, "n")], [(1, "A", 2, 0), (2, "", 0, 1), (3, "n", 1, 0), (None, "x", 0, 1)])
    once = merge.apply_three_step(t, b, ["k"])
    assert rows(once) == rows(spark.createDataFrame([(1, "A"), (3, "n"), (None, "n")], T))
    assert once.count() + 1 == merge.apply_three_step(once, b, ["k"]).count()


def test_three_step_without_other_columns(spark, rows):
    t, b = spark.createDataFrame([(1,), (2,)], "k int"), spark.createDataFrame([(1, 2), (2, 0), (3, 1)], "k int, op_type int")
    assert rows(merge.apply_three_step(t, b, ["k"])) == [(1,), (3,)]


def test_update_insert_without_target(spark, rows):
    b = spark.createDataFrame([(1, "a", 0, 1)], B)
    assert rows(merge.apply_update_insert(None, b, ["k"])) == rows(b)


def test_insert_strict(spark, rows):
    t, b = frames(spark, [(1, "a")], [(2, "b", 1, 0)])
    assert rows(merge.insert_strict(t, b, ["k"])) == [(1, "a"), (2, "b")]
    for bad in ([(1, "x", 1, 0)], [(3, "x", 1, 0), (3, "y", 1, 0)]):
        with pytest.raises(Exception, match="key that exists"):
            merge.insert_strict(t, spark.createDataFrame(bad, B), ["k"]).collect()


def test_odd_column_names(spark, rows):
    t = spark.createDataFrame([(1, "a", 0)], "`class#` int, `a.b` string, `is_deleted` int")
    b = spark.createDataFrame([(1, "b", 2, 0), (2, "c", 1, 0)], "`class#` int, `a.b` string, op_type int, is_deleted int")
    want = [(1, "b", 0), (2, "c", 0)]
    assert rows(merge.merge_hard(t, b, ["class#"])) == want
    assert rows(merge.merge_hard(t, b, ["class#"], unique_keys=False)) == want
    assert rows(merge.merge_soft(t, b, ["class#"], unique_keys=False)) == want
    assert rows(merge.merge_soft_nokey(t, b, ["class#"])) == [(1, "a", 0), (2, "c", 0)]
    assert rows(keyed.upsert_partial(t, b, ["class#"], ["op_type"])) == want
    assert rows(changes.coalesce_changes(b, ["class#"], ["op_type"])) == [(1, "b", 2, 0), (2, "c", 1, 0)]


def test_target_types_are_kept(spark):
    t = spark.createDataFrame([(1, "a")], "k bigint, v string")
    b = spark.createDataFrame([(2, "b", 1, 0)], B)
    for out in (merge.merge_hard(t, b, ["k"]), merge.merge_hard(t, b, ["k"], unique_keys=False)):
        assert out.schema.simpleString() == t.schema.simpleString()


def test_partial_deletes(spark, rows):
    ts, bs = "a int, p int, v string, is_deleted int", "a int, p int, v string, op_type int, is_deleted int"
    t = spark.createDataFrame([(1, 1, "x", 0), (1, 2, "y", 0), (2, 1, "z", 0)], ts)
    b = spark.createDataFrame([(1, None, None, 8, 1), (1, None, None, 8, 1)], bs)
    assert rows(partial.multi_delete_hard(t, b, ["a", "p"], ["p"])) == [(2, 1, "z", 0)]
    assert rows(partial.multi_delete_soft(t, b, ["a", "p"], ["p"])) == rows(spark.createDataFrame([(1, 1, None, 1), (1, 2, None, 1), (2, 1, "z", 0)], ts))
    assert rows(partial.multi_delete_soft(t, b, ["a", "p"], ["p"], keep_unused_keys=False)) == rows(spark.createDataFrame([(1, None, None, 1), (1, None, None, 1), (2, 1, "z", 0)], ts))
    flags = spark.createDataFrame([(1, None, None, 0, 1)], bs)
    assert rows(partial.multi_delete_flag(t, flags, ["a", "p"], ["p"])) == [(1, 1, "x", 1), (1, 2, "y", 1), (2, 1, "z", 0)]
    two = spark.createDataFrame([(1, 1, 1, "x"), (1, 2, 1, "y")], "a int, b int, p int, v string")
    gone = spark.createDataFrame([(1, 2, None, None, 8)], "a int, b int, p int, v string, op_type int")
    assert rows(partial.multi_delete_hard(two, gone, ["a", "b", "p"], ["p"])) == [(1, 1, 1, "x")]
    assert partial.unused_keys("bset") == ["pageno"] and partial.unused_keys("x", {"x": ["y"]}) == ["y"] and partial.unused_keys("x") == []


def test_truncate_only_for_listed_tables(spark, rows):
    t, b = frames(spark, [(1, "a")], [(None, None, 5, 0), (2, "b", 1, 0)])
    assert rows(partial.apply_truncate(t, b)) == []
    assert rows(partial.apply_truncate(t, b, listed=False)) == [(1, "a")]
    spec = ApplySpec(keys=("k",), truncate=True)
    assert rows(integrate(t, b, spec)) == [(2, "b")]
    assert rows(integrate(t, b, ApplySpec(keys=("k",)))) == [(1, "a"), (2, "b")]


def test_markers_of_unlisted_tables_do_not_cut_the_log(spark, rows):
    t, b = frames(spark, [(1, "a"), (2, "b")], [(1, "A", 2, 0), (None, None, 5, 0), (3, "c", 1, 0)])
    b = b.withColumn("seq", F.when(F.col("k") == 1, 0).when(F.col("op_type") == 5, 1).otherwise(2))
    assert rows(integrate(t, b, ApplySpec(keys=("k",), order=("seq",)))) == [(1, "A"), (2, "b"), (3, "c")]
    assert rows(integrate(t, b, ApplySpec(keys=("k",), order=("seq",), truncate=True))) == [(3, "c")]


def test_new_columns_fail_are_added_or_left_out(spark, rows):
    t = spark.createDataFrame([(1, "a")], T)
    b = spark.createDataFrame([(2, "b", 1, 0, 9)], B + ", extra int")
    with pytest.raises(ValueError, match="extra"):
        integrate(t, b, ApplySpec(keys=("k",)))
    assert rows(integrate(t, b, ApplySpec(keys=("k",), new_columns="add"))) == [(1, "a", None), (2, "b", 9)]
    assert rows(integrate(t, b, ApplySpec(keys=("k",), new_columns="ignore"))) == [(1, "a"), (2, "b")]


def test_upsert_partial_keeps_stored_values(spark, rows):
    s = "k int, a string, b string"
    t = spark.createDataFrame([(1, "x", "y")], s)
    b = spark.createDataFrame([(1, "", "n1", 0), (1, "m", "", 1), (2, "", "q", 0)], s + ", seq int")
    assert rows(keyed.upsert_partial(t, b, ["k"], ["seq"])) == [(1, "m", "n1"), (2, None, "q")]


def test_documents(spark, rows):
    t = spark.createDataFrame([("123", "old")], "_id string, v string")
    b = spark.createDataFrame([(1, 23, "a", 0), (12, 3, "b", 1)], "x int, y int, v string, seq int")
    assert rows(keyed.docs_replace(t, b, ["x", "y"], ["seq"])) == [("123", "b")]
    assert rows(keyed.docs_replace(t, b, ["x", "y"], ["seq"], sep="-")) == [("1-23", "a"), ("12-3", "b"), ("123", "old")]
    more = keyed.docs_append(t, spark.createDataFrame([("n",)], "v string"))
    assert more.count() == 2 and more.filter("length(_id) = 36").count() == 1
    dup = keyed.docs_append(t, spark.createDataFrame([("123", "no"), ("7", "yes")], "_id string, v string"))
    assert rows(dup) == [("123", "old"), ("7", "yes")]


def test_key_value_text(spark):
    row = keyed.to_pairs(spark.createDataFrame([(1, None, "v")], "a int, b string, c string"), "t", ["a", "b"]).first()
    assert row["key"] == "t::1::" and row["value"] == '{"a":1,"b":null,"c":"v"}'


# ---- random change sets against a model that applies row after row

def _model(target, log, keys, soft=False):
    """Apply the log row by row to a dict of rows."""
    state = dict(target)
    for op, key, value in log:
        if op == 5:
            state.clear()
        elif op == 8:
            for k in [k for k in state if k[0] == key[0]]:
                del state[k]
        elif op == 0:
            state.pop(key, None)
        elif op in (1, 2):
            state[key] = value
    return sorted(((*k, v) for k, v in state.items()), key=repr)


@pytest.mark.parametrize("seed", range(6))
def test_integrate_equals_row_by_row(spark, rows, seed):
    rnd = random.Random(seed)
    target = {(rnd.randrange(6), rnd.randrange(4)): f"t{i}" for i in range(12)}
    log, ops = [], [0, 1, 2, 2, 4, 8] + ([5] if seed % 2 else [])
    for i in range(60):
        op = rnd.choices(ops, [4, 6, 6, 6, 2, 1, 1][: len(ops)])[0]
        key = (rnd.randrange(6), None if op in (5, 8) else rnd.randrange(4))
        log.append((op, key, f"v{i}"))
    t = spark.createDataFrame([(*k, v) for k, v in target.items()], "a int, p int, v string")
    b = spark.createDataFrame([(k[0], k[1], v, op, i // 20, i % 20) for i, (op, k, v) in enumerate(log)],
                              "a int, p int, v string, op_type int, file_seq int, row_seq int")
    spec = ApplySpec(keys=("a", "p"), order=("file_seq", "row_seq"), unused_keys=("p",), truncate=True)
    want = _model(target, log, ["a", "p"])
    assert rows(integrate(t, b, spec)) == want
    # the result does not depend on how the target is stored or joined
    wide = t.withColumn("note", F.lit("x"))
    assert rows(integrate(wide, b, spec).drop("note")) == want


@pytest.mark.parametrize("op", ["merge_hard", "merge_soft", "merge_history", "upsert_lww", "upsert_partial"])
def test_replay_gives_the_same_target(spark, rows, op):
    t = spark.createDataFrame([(i, f"t{i}", 0) for i in range(8)], "k int, v string, is_deleted int")
    b = spark.createDataFrame([(i, f"b{i}" if i % 2 else "", (0, 1, 2)[i % 3], int(i % 3 == 0), i) for i in range(4, 14)],
                              "k int, v string, op_type int, is_deleted int, seq int")
    fn = {
        "merge_hard": lambda t: merge.merge_hard(t, b, ["k"]),
        "merge_soft": lambda t: merge.merge_soft(t, b, ["k"]),
        "merge_history": lambda t: merge.merge_history(t, b, ["k"]),
        "upsert_lww": lambda t: keyed.upsert_lww(t, b, ["k"], ["seq"]),
        "upsert_partial": lambda t: keyed.upsert_partial(t, b, ["k"], ["seq"]),
    }[op]
    once = fn(t)
    assert rows(fn(once)) == rows(once)


def test_files_in_order_equals_a_merge_per_file(spark, rows):
    rnd = random.Random(3)
    t = spark.createDataFrame([(i, f"t{i}") for i in range(6)], T)
    log = [(rnd.randrange(9), f"v{i}", rnd.choice([0, 1, 2]), 0, i // 5, i % 5) for i in range(30)]
    b = spark.createDataFrame(log, B + ", file_seq int, row_seq int")
    state = {i: f"t{i}" for i in range(6)}
    for k, v, op, *_ in log:
        state.pop(k, None) if op == 0 else state.__setitem__(k, v)
    out = merge.apply_files_in_order(t, b, ["k"], ["file_seq", "row_seq"])
    assert rows(out) == sorted(state.items(), key=repr)


# ---- plans

def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_nested_loop_joins(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        t = spark.range(100).selectExpr("id AS k", "cast(id AS string) AS v", "0 AS is_deleted")
        b = spark.range(50).selectExpr("id AS k", "'x' AS v", "cast(id % 3 AS int) AS op_type", "0 AS is_deleted", "id AS seq")
        for df in (
            merge.merge_hard(t, b, ["k", "v"]),
            merge.merge_hard(t, b, ["k", "v"], unique_keys=False),
            merge.merge_key_change(t, b, ["k", "v"]),
            merge.merge_soft(t, b, ["k", "v"]),
            merge.merge_history(t, b, ["k", "v"]),
            keyed.upsert_partial(t, b, ["k"], ["seq"]),
            partial.apply_truncate(t, b),
        ):
            text = plan(df)
            assert "NestedLoop" not in text and "Cartesian" not in text
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_hard_merge_reads_the_target_once(spark):
    t = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    b = spark.range(5).selectExpr("id AS o_orderkey", "id AS o_custkey", "'F' AS o_orderstatus", "1D AS o_totalprice",
                                  "timestamp_ntz'2001-01-01' AS o_orderdate", "'x' AS o_orderpriority", "1 AS op_type")
    assert plan(merge.merge_hard(t, b, ["o_orderkey"])).count("FileScan") == 1


def test_last_write_is_limited_before_the_shuffle(spark):
    b = spark.range(50).selectExpr("id % 3 AS k", "id AS seq")
    assert plan(changes.latest(b, ["k"], ["seq"])).count("WindowGroupLimit") == 2


@pytest.mark.parametrize("op", ["merge_hard", "merge_hard_in_place", "merge_soft", "merge_plain", "merge_plain_soft", "merge_then_insert", "apply_update_insert"])
def test_two_changes_of_one_key_fail(spark, op):
    t = spark.createDataFrame([(1, "a", 0), (2, "b", 0)], "k int, v string, is_deleted int")
    b = spark.createDataFrame([(1, "x", 0, 2), (1, "y", 0, 2), (2, "z", 0, 2)], "k int, v string, is_deleted int, op_type int")
    run = {
        "merge_hard": lambda **o: merge.merge_hard(t, b, ["k"], **o),
        "merge_hard_in_place": lambda **o: merge.merge_hard(t, b, ["k"], unique_keys=False, **o),
        "merge_soft": lambda **o: merge.merge_soft(t, b, ["k"], **o),
        "merge_plain": lambda **o: merge.merge_plain(t, b, ["k"], **o),
        "merge_plain_soft": lambda **o: merge.merge_plain(t, b, ["k"], soft=True, **o),
        "merge_then_insert": lambda **o: merge.merge_then_insert(t, b, ["k"], **o),
        "apply_update_insert": lambda **o: merge.apply_update_insert(t, b, ["k"], op_col="op_type", **o),
    }[op]
    with pytest.raises(Exception, match="several change rows for one key"):
        run().collect()
    run(check=False).collect()


def test_outer_merge(spark, rows, tmp_path):
    """Duplicates are all updated, own columns kept, NULL keys equal; the target is scanned once."""
    t = [(1, "a", "x"), (1, "b", "y"), (2, "c", "z"), (None, "n", "w"), (5, "e", "v")]
    spark.createDataFrame(t, "k int, v string, own string").write.parquet(str(tmp_path / "t"))
    t = spark.read.parquet(str(tmp_path / "t"))
    b = spark.createDataFrame([(1, "A", 2, 0), (2, None, 0, 1), (None, "N", 2, 0), (7, "new", 1, 0), (7, "twice", 2, 0), (8, "", 0, 1), (9, "p", 5, 0)], B)
    counts = merge.ApplyCounts()
    out = merge.merge_outer(t, b, ["k"], counts=counts)
    assert out._jdf.queryExecution().executedPlan().toString().count("FileScan parquet") == 1
    assert rows(out) == sorted([(1, "A", "x"), (1, "A", "y"), (None, "N", "w"), (5, "e", "v"), (7, "new", None), (7, "twice", None)], key=repr)
    assert counts.get == {"deleted": 1, "updated": 3, "inserted": 2}
    assert rows(merge.merge_hard(t, b, ["k"], unique_keys=False)) == rows(out)
    plain = rows(merge.merge_outer(t, b, ["k"], null_safe=False))
    assert (None, "n", "w") in plain and (None, "N", None) in plain
    with pytest.raises(Exception, match="several change rows"):
        merge.merge_outer(t, b.union(spark.createDataFrame([(5, "x", 2, 0), (5, "y", 0, 1)], B)), ["k"]).collect()


def test_counts_of_a_written_merge(spark, rows, tmp_path):
    t, b = frames(spark, [(1, "a"), (2, "b"), (3, "c")], [(1, "A", 2, 0), (2, None, 0, 1), (9, "n", 1, 0), (8, "x", 0, 1), (7, "u", 2, 0)])
    counts = merge.ApplyCounts()
    merge.merge_hard(t, b, ["k"], counts=counts).write.parquet(str(tmp_path / "out"))
    assert counts.get == {"deleted": 1, "updated": 1, "inserted": 2}
    assert rows(counts.frame(spark)) == [("deleted", 1), ("inserted", 2), ("updated", 1)]
    none = merge.ApplyCounts()
    merge.merge_hard(t, b.limit(0), ["k"], counts=none).write.parquet(str(tmp_path / "same"))
    assert none.get == {"deleted": 0, "updated": 0, "inserted": 0} and none.frame(spark).count() == 0
    with pytest.raises(ValueError, match="merge_outer"):
        merge.merge_hard(t, b, ["k"], unique_keys=False, counts=none)


def test_stable_partitions_prune_the_scan(spark, rows, tmp_path):
    from changemill.plans.integrate import integrate_touched
    from changemill.sinks.files import write_touched

    path, schema = str(tmp_path / "t"), "k int, v string, p string"
    old = [(i, f"v{i}", f"p {i % 5}/x") for i in range(50)] + [(100, "n", None), (200, "last", "alone"), (7, "other partition", "p 3/x")]
    spark.createDataFrame(old, schema).repartition(1).write.partitionBy("p").parquet(path)
    spark.createDataFrame([(2, "B", "p 2/x", 2), (7, "x", "p 2/x", 0), (300, "new", "q", 1), (200, "", "alone", 0), (100, "N", None, 2), (9, "", None, 5)],
                          f"{schema}, op_type int").write.parquet(str(tmp_path / "b"))
    spec = ApplySpec(keys=("k",), partition_cols=("p",), partition_stable=True)
    t, b = spark.read.parquet(path), spark.read.parquet(str(tmp_path / "b")).filter("op_type < 5")
    new = integrate_touched(t, b, spec)
    plan = new._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan.lower()
    untouched = {f for f in (tmp_path / "t").rglob("*.parquet") if "p=p 3" in str(f)}
    write_touched(new, path, ["p"], b)
    assert untouched and untouched <= set((tmp_path / "t").rglob("*.parquet"))
    want = {(k, v, p) for k, v, p in old if (k, p) not in {(2, "p 2/x"), (7, "p 2/x"), (200, "alone"), (100, None)}}
    want |= {(2, "B", "p 2/x"), (300, "new", "q"), (100, "N", None)}
    assert rows(spark.read.parquet(path), "k", "v", "p") == sorted(want, key=repr)
    with pytest.raises(ValueError, match="partition_stable"):
        integrate_touched(t, b, ApplySpec(keys=("k",), partition_cols=("p",)))
    with pytest.raises(ValueError, match="partition_cols"):
        ApplySpec(keys=("k",), partition_stable=True)
