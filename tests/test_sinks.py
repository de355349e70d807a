"""Snapshot tables, file sinks and streaming cycles."""

import json
import os

import pytest
from pyspark.sql import functions as F

from changemill.operators import merge
from changemill.plans import refresh
from changemill.plans.integrate import integrate
from changemill.sinks import files as sink
from changemill.sinks.bucketed import BucketedTable
from changemill.sinks.snapshots import SnapshotTable, slice_state, slices_done
from changemill.spec import ApplySpec
from changemill.streaming import cycles

B = "k int, v string, op_type int"


def test_versions_stay_readable(spark, tmp_path, rows):
    t = SnapshotTable(spark, str(tmp_path / "t"))
    assert not t.exists() and t.version() == 0
    with pytest.raises(ValueError):
        t.read()
    t.commit(spark.createDataFrame([(1, "a")], "k int, v string"))
    t.apply(lambda t, b: merge.merge_hard(t, b, ["k"]), spark.createDataFrame([(1, "b", 2), (2, "c", 1)], B), "x-1")
    assert rows(t.read()) == [(1, "b"), (2, "c")] and rows(t.read(1)) == [(1, "a")]
    assert t.is_committed("x-1") and not t.is_committed("x-2")
    t.append(spark.createDataFrame([("d", 9)], "v string, k bigint"))
    assert rows(t.read()) == [(1, "b"), (2, "c"), (9, "d")]
    with pytest.raises(ValueError, match="not in the target"):
        t.append(spark.createDataFrame([(1, "a", 2)], "k int, v string, extra int"))
    t.append(spark.createDataFrame([(4,)], "k int"))
    assert rows(t.read().filter("v IS NULL")) == [(4, None)]
    t.commit(refresh.refresh_restrict(t.read(), spark.createDataFrame([(3, "z")], "k int, v string"), "k > 1"))
    assert rows(t.read()) == [(1, "b"), (3, "z")]


def test_append_may_add_columns(spark, tmp_path, rows):
    t = SnapshotTable(spark, str(tmp_path / "t"))
    t.commit(spark.createDataFrame([(1, "a")], "k int, v string"))
    wide = spark.createDataFrame([(2, "b", 7)], "k int, v string, n int")
    t.append(wide, new_columns="ignore")
    t.append(wide, new_columns="add")
    assert rows(t.read()) == [(1, "a", None), (2, "b", 7), (2, "b", None)] and t.read(2).columns == ["k", "v"]


def test_uncommitted_write_is_invisible(spark, tmp_path, rows):
    t = SnapshotTable(spark, str(tmp_path / "t"))
    t.commit(spark.createDataFrame([(1, "a")], "k int, v string"))
    bad = spark.createDataFrame([(1, "a")], "k int, v string").withColumn("v", F.raise_error(F.lit("boom")).cast("string"))
    with pytest.raises(Exception, match="boom"):
        t.commit(bad)
    assert t.version() == 1 and rows(t.read()) == [(1, "a")]
    t.commit(spark.createDataFrame([(2, "b")], "k int, v string"))
    assert rows(t.read()) == [(2, "b")]


def test_only_touched_partitions_are_rewritten(spark, tmp_path, rows):
    t = SnapshotTable(spark, str(tmp_path / "t"), ["p"])
    df = spark.createDataFrame([(1, "a", "x y"), (2, "b", "z/1"), (3, "c", None), (4, "d", "z/1")], "k int, v string, p string")
    t.commit(df)
    b = spark.createDataFrame([(1, "a", "x y", 0), (3, "C", None, 2), (5, "n", "new", 1)], "k int, v string, p string, op_type int")
    t.apply_touched(lambda t, b: merge.merge_hard(t, b, ["k", "p"]), b)
    assert rows(t.read()) == [(2, "b", "z/1"), (3, "C", None), (4, "d", "z/1"), (5, "n", "new")]
    parts = t._state()["parts"]
    assert sorted(f.split("-")[0] for f in parts.values()) == ["_v=1", "_v=2", "_v=2"]
    t.append(spark.createDataFrame([(6, "e", "new")], "k int, v string, p string"))
    t.apply_touched(lambda t, b: merge.merge_hard(t, b, ["k", "p"]), spark.createDataFrame([(6, "E", "new", 2)], "k int, v string, p string, op_type int"))
    assert rows(t.read()) == [(2, "b", "z/1"), (3, "C", None), (4, "d", "z/1"), (5, "n", "new"), (6, "E", "new")]
    t.apply_touched(lambda t, b: t.filter("k < 0"), spark.createDataFrame([("new",)], "p string"))
    assert rows(t.read(), "k") == [(2,), (3,), (4,)]


def test_second_writer_fails(spark, tmp_path):
    root = str(tmp_path / "t")
    a = SnapshotTable(spark, root)
    a.commit(spark.range(1))
    with pytest.raises(RuntimeError, match="another writer"):
        a._commit(1, "late", spark.range(1).schema, {})


def test_two_writers_that_both_passed_the_version_test(spark, tmp_path, rows, monkeypatch):
    root = str(tmp_path / "t")
    a, b = SnapshotTable(spark, root), SnapshotTable(spark, root)
    a.commit(spark.range(1))
    folder = b._folder(2)
    b._write(spark.range(5), folder)
    a.commit(spark.range(2))
    monkeypatch.setattr(b, "version", lambda: 1)  # b looked before a committed
    with pytest.raises(RuntimeError, match="another writer"):
        b._commit(2, "late", spark.range(1).schema, {"": folder})
    assert a.read().count() == 2 and a.version() == 2


def test_incomplete_commit_is_not_visible(spark, tmp_path):
    root = tmp_path / "t"
    t = SnapshotTable(spark, str(root))
    t.commit(spark.range(3))
    (root / "_commits" / "00000002.json").write_text('{"version": 2')
    assert t.read().count() == 3
    t.commit(spark.range(4))
    assert t.version() == 3 and t.read().count() == 4


def test_null_and_empty_partitions_lose_no_row(spark, tmp_path, rows):
    t = SnapshotTable(spark, str(tmp_path / "t"), ["p"])
    t.commit(spark.createDataFrame([(1, None), (2, "x"), (3, None)], "k int, p string"))
    t.apply_touched(lambda t, b: t.unionAll(b), spark.createDataFrame([(9, "")], "k int, p string"))
    assert rows(t.read(), "k") == [(1,), (2,), (3,), (9,)]
    with pytest.raises(RuntimeError, match="moved to partitions"):
        t.apply_touched(lambda t, b: t.withColumn("p", F.lit("x")), spark.createDataFrame([(9, None)], "k int, p string"))


def test_replay_compact_and_expire(spark, tmp_path):
    t = SnapshotTable(spark, str(tmp_path / "t"))
    t.commit(spark.range(1), "create")
    for n in (0, 1, 2):
        t.append(spark.range(1), f"job-{n}")
    assert t.is_committed("job-1") and not t.is_committed("job-3") and not t.is_committed("other-0")
    t.compact()
    assert len(t._state()["parts"]) == 1 and t.read().count() == 4
    assert t.expire(1) == [1, 2, 3, 4]
    assert t.read().count() == 4 and t.is_committed("job-2")
    t.commit(spark.range(2), "after")
    assert t.read().count() == 2


def test_publish_keeps_the_order_of_a_destination(spark, tmp_path):
    out = str(tmp_path)
    msgs = spark.range(3000).selectExpr("id % 3 AS dest", "id AS seq").repartition(8)

    def send(it):
        for r in it:
            with open(f"{out}/{r['dest']}", "a") as f:
                f.write(f"{r['seq']}\n")

    sink.publish(msgs, send, ["dest"], ["seq"])
    for d in range(3):
        with open(f"{out}/{d}") as f:
            assert [int(x) for x in f] == list(range(d, 3000, 3))


def test_repeated_cycle_writes_messages_once(spark, tmp_path):
    msgs = spark.range(10).selectExpr("id % 2 AS dest", "id AS seq", "'x' AS value")
    for _ in range(2):
        sink.write_messages(msgs, str(tmp_path / "m"), ["dest"], ["seq"], batch_id=4)
        sink.journal(msgs, str(tmp_path / "j"), "c", "l", 4, ["dest"], ["seq"])
    assert spark.read.json(str(tmp_path / "m")).count() == 10
    kept = spark.read.json(str(tmp_path / "j/c/l/cycle=00000004"))
    assert sorted(r["sequence"] for r in kept.collect()) == sorted([*range(5)] * 2)


def test_bucketed_merge_moves_only_the_change_set(spark, tmp_path, rows):
    root = str(tmp_path / "t")
    t = BucketedTable(spark, root, ["k"], 4)
    t.commit(spark.range(100).selectExpr("cast(id AS int) AS k", "cast(id AS string) AS v"))
    b = spark.range(50, 150).selectExpr("cast(id AS int) AS k", "'n' AS v", "cast(if(id < 60, 0, 2) AS int) AS op_type")
    fn = lambda t, b: merge.merge_hard(t, b, ["k"], null_safe=False, check=False)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        df = fn(t.read(), b.repartition(4, "k"))
        text = df._jdf.queryExecution().executedPlan().toString()
        assert text.count("FileScan") == 1 and text.count("Exchange hashpartitioning") == 2  # both over the change set
        assert text.index("FileScan") < text.index("Exchange") and "Bucketed: true" in text
        t.apply(fn, b, "one")
        t.apply(fn, b, "two")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    want = sorted([(i, str(i)) for i in range(50)] + [(i, "n") for i in range(60, 150)], key=repr)
    assert rows(t.read()) == want
    for v in (1, 2, 3):  # another session knows the commits but not the catalog entries
        spark.sql(f"DROP TABLE {t._table(t._state(v)['parts'][''])}")
    again = BucketedTable(spark, root, ["k"], 4)
    assert rows(again.read()) == want and again.read(1).count() == 100
    files = [n for n in os.listdir(f"{root}/{t._state(3)['parts']['']}") if n.endswith(".parquet")]
    assert len(files) <= 8  # one file per bucket from the kept rows, one from the changes


@pytest.mark.parametrize("parts", [[], ["v"]])
def test_sliced_refresh(spark, tmp_path, rows, parts):
    t = SnapshotTable(spark, str(tmp_path / "t"), parts)
    t.commit(spark.createDataFrame([(0, "old")], "k int, v string"))
    one = lambda k: spark.createDataFrame([(k, f"s{k}")], "k int, v string")
    assert not t.write_slice(one(1), 0, 3)
    assert not t.write_slice(one(9), 0, 2)  # the total changed: the slice of 3 does not count
    assert rows(t.read()) == [(0, "old")]
    assert not t.write_slice(one(1), 0, 2) and t.done_slices(2) == [0]
    assert t.write_slice(one(2), 1, 2)
    assert rows(t.read()) == [(1, "s1"), (2, "s2")] and t.done_slices(2) == []
    t.append(one(3))
    assert rows(t.read(), "k") == [(1,), (2,), (3,)]
    with pytest.raises(ValueError):
        t.write_slice(one(1), 2, 2)


def test_slice_state(spark, rows):
    s = spark.createDataFrame([], "job string, slice int, total int, done int")
    for n, total in ((0, 3), (1, 3), (1, 3)):
        s = slice_state(s, "j", n, total)
    assert rows(slices_done(s)) == [("j", 2, 3, False)]
    assert rows(slices_done(slice_state(s, "j", 0, 1))) == [("j", 1, 1, True)]


def test_refresh_plans(spark, rows):
    t = spark.createDataFrame([(1, "a"), (None, "n")], "k int, v string")
    b = spark.createDataFrame([(5, "b", 1), (6, "c", 2)], B)
    assert rows(refresh.refresh_full(t, b)) == [(5, "b"), (6, "c")]
    assert rows(refresh.refresh_restrict(t, b.limit(0), "k >= 1")) == [(None, "n")]
    assert refresh.refresh_append(t, b).count() == 4
    assert rows(refresh.refresh_upsert(t, spark.createDataFrame([(1, "z")], "k int, v string"), ["k"])) == rows(spark.createDataFrame([(1, "z"), (None, "n")], "k int, v string"))
    assert rows(refresh.refresh_inserts_only(b)) == [(5, "b")]
    assert refresh.refresh_recreate(b, ["op_type"]).columns == ["k", "v"]


def test_file_sinks(spark, tmp_path, rows):
    df = spark.createDataFrame([(i, f"v{i % 3}") for i in range(9)], "k int, v string")
    path = str(tmp_path / "p")
    sink.write_partitioned(df, path, ["v"])
    sink.write_partitioned(spark.createDataFrame([(99, "v0")], "k int, v string"), path, ["v"])
    assert spark.read.parquet(path).filter("v = 'v0'").count() == 1 and spark.read.parquet(path).count() == 7
    assert sink.discard(spark.read.parquet(path)) == len(spark.read.parquet(path).inputFiles())
    assert sink.convert_copy(df, "copy_t", "_orc") == "copy_t_orc" and spark.table("copy_t_orc").count() == 9
    sink.convert_copy(df, "copy_t", "_orc")
    assert spark.table("copy_t_orc").count() == 18


def test_messages_are_sent_in_order(spark, tmp_path):
    df = spark.range(200).selectExpr("concat('d', id % 2) AS dest", "id AS seq", "cast(id AS string) AS value")
    out = str(tmp_path / "sent")
    os.makedirs(out)

    def send(rows):
        import uuid

        got = [(r["dest"], r["seq"]) for r in rows]
        with open(f"{out}/{uuid.uuid4().hex}", "w") as f:
            json.dump(got, f)

    sink.publish(df, send, ["dest"], ["seq"])
    sent = [json.load(open(f"{out}/{n}")) for n in os.listdir(out)]
    assert sum(map(len, sent)) == 200 and all(s == sorted(s) for s in sent)


def stage(spark, folder, name, rows):
    spark.createDataFrame(rows, B).coalesce(1).write.mode("append").parquet(f"{folder}/{name}")


def stream(spark, folder, target, spec, ckpt, **kw):
    src = cycles.staged_stream(spark, f"{folder}/*", B)
    cycles.apply_stream(src, target, spec, ckpt, **kw).awaitTermination()


def test_stream_equals_batch_and_restart_is_harmless(spark, tmp_path, rows):
    folder, ckpt = str(tmp_path / "in"), str(tmp_path / "ck")
    start = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    target = SnapshotTable(spark, str(tmp_path / "t"))
    target.commit(start)
    # inserts without look-up: a batch applied twice would show
    spec = ApplySpec(keys=("k",), split_inserts=True)
    one, two = [(1, "A", 2), (3, "c", 1)], [(2, "", 0), (4, "d", 1)]
    stage(spark, folder, "one", one)
    stream(spark, folder, target, spec, ckpt)
    version = target.version()
    stream(spark, folder, target, spec, ckpt)
    assert target.version() == version
    stage(spark, folder, "two", two)
    stream(spark, folder, target, spec, ckpt)
    want = start
    for batch in (one, two):
        want = integrate(want, spark.createDataFrame(batch, B), spec)
    assert rows(target.read()) == rows(want)
    # the checkpoint lost its last commit: the batch comes again and is recognised
    os.remove(os.path.join(ckpt, "commits", "1"))
    for crc in [n for n in os.listdir(os.path.join(ckpt, "commits")) if n == ".1.crc"]:
        os.remove(os.path.join(ckpt, "commits", crc))
    version = target.version()
    stream(spark, folder, target, spec, ckpt)
    assert target.version() == version and rows(target.read()) == rows(want)


def test_stream_with_own_apply_function_and_partitions(spark, tmp_path, rows):
    folder = str(tmp_path / "in")
    target = SnapshotTable(spark, str(tmp_path / "t"), ["k"])
    target.commit(spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string"))
    stage(spark, folder, "one", [(1, "A", 2)])
    stream(spark, folder, target, ApplySpec(keys=("k",)), str(tmp_path / "ck"), touched_only=True,
           apply_fn=lambda t, b, spec: merge.merge_hard(t, b, list(spec.keys)).withColumn("v", F.upper("v")))
    assert rows(target.read()) == [(1, "A"), (2, "b")]


def test_history_stream_takes_new_columns(spark, tmp_path, rows):
    folder = str(tmp_path / "in")
    target = SnapshotTable(spark, str(tmp_path / "t"))
    target.commit(spark.createDataFrame([(1, "a")], "k int, v string"))
    spark.createDataFrame([(2, "b", 7)], "k int, v string, n int").write.parquet(folder)
    src = cycles.staged_stream(spark, folder, "k int, v string, n int")
    spec = ApplySpec(keys=("k",), style="history", new_columns="add")
    cycles.apply_stream(src, target, spec, str(tmp_path / "ck")).awaitTermination()
    assert rows(target.read()) == [(1, "a", None), (2, "b", 7)]


def test_spec_is_checked():
    with pytest.raises(ValueError, match="style"):
        ApplySpec(keys=("k",), style="other")
    assert ApplySpec(keys=("k", "op_type"), partition_cols=("p", "k")).merge_keys == ["k", "p"]


def test_cycles_of_plain_changes_do_not_rewrite_the_target(spark, tmp_path, rows, monkeypatch):
    """Every version reads as sequential merges; written bytes follow the changes, not cycles times the target."""
    start = spark.range(20_000).selectExpr("cast(id AS int) AS k", "concat('v', hash(id)) AS v").unionAll(spark.createDataFrame([(None, "n")], "k int, v string"))
    batches = [[(1, "A", 2), (30_000, "c", 1), (None, "N", 2)], [(1, "", 0), (2, "x", 2), (2, "", 0)], [(1, "back", 1), (30_000, "", 0), (5, None, 2)], [(None, "", 0), (9, "o", None)],
               [(40_000, "p", 1), (40_000, "q", 1), (7, "", 4)], [(8, "r", 2)]]
    for null_safe in (True, False):
        target, want = SnapshotTable(spark, str(tmp_path / f"t{null_safe}")), start
        target.commit(start.coalesce(1))
        base, spec = target._bytes(""), ApplySpec(keys=("k",), null_safe=null_safe)
        for n, batch in enumerate(batches):
            b = spark.createDataFrame(batch, B).coalesce(1)
            cycles._apply_batch(b, target, spec, f"q-{n}", integrate, False)
            want = spark.createDataFrame(integrate(want, b, spec).collect(), "k int, v string")
            assert target.version() == n + 2 and rows(target.read()) == rows(want), (null_safe, n)
        assert target._bytes("") < 1.5 * base
        assert rows(target.read(1)) == rows(start)
        with pytest.raises(Exception, match="several change rows match one target row"):
            cycles._apply_batch(spark.createDataFrame([(3, "a", 2), (3, "b", 2)], B), target, spec, "q-90", integrate, False)
        target.expire()
        assert rows(target.read()) == rows(want)
        target.append(spark.createDataFrame([(1, "again")], "k int, v string"))
        assert rows(target.read()) == rows(want.unionAll(spark.createDataFrame([(1, "again")], "k int, v string")))
        target.apply_changes(lambda t, b: integrate(t, b, spec), spark.createDataFrame([(50_000, "s", 1)], B), ["k"], null_safe=null_safe)
        monkeypatch.setattr("changemill.sinks.snapshots.MOST_CHANGES", 1)
        cycles._apply_batch(spark.createDataFrame([(50_000, "", 0)], B), target, spec, "q-91", integrate, False)
        monkeypatch.undo()
        assert "changes" not in target._state() and target.read().filter("k = 50000").isEmpty()
