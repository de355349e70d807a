"""The message sink with a commit, and the stream of complete cycles."""

import json
import os
import subprocess
import sys
import textwrap

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from changemill.sinks import message_log
from changemill.sinks.store import Store
from changemill.sources import cycle_source
from changemill.streaming import cycles

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture
def msgs(spark):
    spark.dataSource.register(message_log.MessageLog)
    spark.dataSource.register(cycle_source.CycleSource)
    return spark.range(500).select((F.col("id") % 3).alias("dest"), F.col("id").alias("seq"), F.concat(F.lit("v"), "id").alias("value"))


def save(df, path, mode="append", **options):
    df.write.format("mill_messages").mode(mode).options(**options).save(path)


def load(spark, path):
    return spark.read.format("mill_messages").load(path)


def test_order_and_commits(spark, msgs, tmp_path):
    path = str(tmp_path)
    save(message_log.send(msgs, ["dest"], ["seq"]), path)
    save(message_log.send(msgs, ["dest"], ["seq"], ordered=False), f"file://{path}", tag="second")
    out = load(spark, path).orderBy("commit", "part", "place").collect()
    assert len(out) == 1000
    for commit in {r["commit"] for r in out}:
        for dest in range(3):
            mine = [r for r in out if r["commit"] == commit and r["dest"] == dest]
            assert [r["seq"] for r in mine] == list(range(dest, 500, 3))
            if commit != "second":
                assert len({r["part"] for r in mine}) == 1
    counted = {r["commit"]: (r["n_rows"], r["n_bytes"] > 0) for r in message_log.sent(spark, path).collect()}
    assert counted["second"] == (500, True) and len(counted) == 2


def test_a_tag_is_committed_once_and_overwrite_begins_anew(spark, msgs, tmp_path):
    path = str(tmp_path)
    for _ in range(2):
        save(msgs, path, tag="cycle-1")
    assert load(spark, path).count() == 500
    assert len(os.listdir(tmp_path / "parts")) == message_log.sent(spark, path).collect()[0]["n_parts"]
    save(msgs.limit(7), path, "overwrite")
    assert load(spark, path).count() == 7
    assert message_log.drop_orphans(path, -10) == 0


def test_a_failed_write_leaves_nothing_to_read(spark, msgs, tmp_path):
    path = str(tmp_path)
    save(msgs.limit(3), path)
    bad = msgs.repartition(4).withColumn("value", F.when(F.col("seq") == 400, F.raise_error(F.lit("stop"))).otherwise(F.col("value")))
    with pytest.raises(Exception, match="stop"):
        save(bad, path)
    assert load(spark, path).count() == 3
    (tmp_path / "parts" / "orphan.parquet").write_bytes(b"x")
    assert message_log.drop_orphans(path) == 0 and message_log.drop_orphans(path, -10) >= 1
    assert load(spark, path).count() == 3


def test_no_messages(spark, msgs, tmp_path):
    save(msgs.limit(0), str(tmp_path), tag="empty")
    assert [tuple(r) for r in message_log.sent(spark, str(tmp_path)).collect()] == [("empty", 0, 0, 0)]
    with pytest.raises(Exception, match="nothing was committed"):
        load(spark, str(tmp_path)).count()


def test_a_killed_task_repeats_nothing(tmp_path):
    """The first attempt of a task dies after it has written; its second one sends all again."""
    code = textwrap.dedent(f"""
        import os, sys
        sys.path.insert(0, {ROOT!r})
        from pyspark.sql import SparkSession
        from changemill.sinks import message_log

        spark = SparkSession.builder.master("local[2,3]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").getOrCreate()
        spark.dataSource.register(message_log.MessageLog)

        def dies(batches):
            from pyspark import TaskContext
            for batch in batches:
                yield batch
            if TaskContext.get().attemptNumber() == 0 and TaskContext.get().partitionId() == 1:
                open({str(tmp_path / 'died')!r}, "w").close()
                os._exit(1)

        rows = spark.range(0, 60000, 1, 3).mapInArrow(dies, "id long")
        rows.write.format("mill_messages").mode("append").option("tag", "once").save({str(tmp_path / 'log')!r})
        out = spark.read.format("mill_messages").load({str(tmp_path / 'log')!r})
        print("FOUND", out.count(), out.select("id").distinct().count())
    """)
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=180)
    assert (tmp_path / "died").exists()
    assert "FOUND 60000 60000" in done.stdout, done.stderr[-2000:]


def test_a_replayed_batch_is_sent_once(spark, msgs, tmp_path):
    """The stream's progress is lost after its commit: the same batch number is dropped."""
    msgs.write.parquet(str(tmp_path / "in"))
    for checkpoint in ("a", "b"):
        source = spark.readStream.schema(msgs.schema).parquet(str(tmp_path / "in"))
        cycles.message_stream(source, str(tmp_path / "out"), str(tmp_path / checkpoint), "q").awaitTermination()
    assert load(spark, str(tmp_path / "out")).count() == 500
    assert [r["commit"] for r in message_log.sent(spark, str(tmp_path / "out")).collect()] == ["q-0"]


def put(folder, name, ids):
    pq.write_table(pa.table({"id": ids, "v": [f"v{i}" for i in ids]}), folder / name)


def test_cycles_wait_for_their_files(spark, msgs, tmp_path):
    put(tmp_path, "a.parquet", [1, 2])
    put(tmp_path, "extra.parquet", [100])
    (tmp_path / "d.json").write_text('{"id": 9, "v": "j", "other": 1}\n{"id": 10}\n')
    for cycle, files in ((0, ["a.parquet"]), (1, ["late.parquet", "a.parquet"]), (2, ["d.json"])):
        cycle_source.write_manifest(str(tmp_path), cycle, files, {"d.json": "t"} if cycle == 2 else None)
    schema = "id long, v string, cycle long, file_name string, tbl_name string, lacking double"

    def run():
        source = cycles.cycle_stream(spark, str(tmp_path), schema)
        cycles.message_stream(source, str(tmp_path / "out"), str(tmp_path / "checkpoint")).awaitTermination()
        return sorted(tuple(r) for r in load(spark, str(tmp_path / "out")).select("cycle", "id", "v", "file_name", "tbl_name", "commit").collect())

    first = [(0, 1, "v1", "a.parquet", None, "stream-0"), (0, 2, "v2", "a.parquet", None, "stream-0")]
    assert run() == first
    assert run() == first  # nothing new
    assert cycle_source.waiting(Store(str(tmp_path)), 0) == [(1, 2, 1), (2, 1, 0)]
    put(tmp_path, "late.parquet", [5])
    then = [(1, 1, "v1", "a.parquet", None), (1, 2, "v2", "a.parquet", None), (1, 5, "v5", "late.parquet", None), (2, 9, "j", "d.json", "t"), (2, 10, None, "d.json", "t")]
    assert run() == sorted(first + [(*r, "stream-1") for r in then])
    # cleared cycles: manifests go first, and the stream goes on after them
    for cycle in (0, 1, 2):
        os.remove(tmp_path / "manifests" / f"{cycle}.json")
    put(tmp_path, "e.parquet", [77])
    cycle_source.write_manifest(str(tmp_path), 3, ["e.parquet"])
    assert [r for r in run() if r[0] == 3] == [(3, 77, "v77", "e.parquet", None, "stream-2")]


def test_manifest_without_files_is_an_empty_cycle(tmp_path):
    store = Store(str(tmp_path))
    cycle_source.write_manifest(store.path, 4, [])
    assert cycle_source.complete_until(store, cycle_source.NONE) == 4
    assert json.loads((tmp_path / "manifests" / "4.json").read_text()) == {"files": []}
    assert cycle_source.complete_until(Store(str(tmp_path / "none")), -1) == -1


def test_many_tables_from_one_stream(spark, tmp_path):
    """A failing table leaves the others committed; the replayed batch applies only what failed."""
    from changemill.plans.refresh import empty_target
    from changemill.sinks.snapshots import SnapshotTable
    from changemill.spec import ApplySpec

    rows = spark.range(60).select((F.col("id") % 6).cast("string").alias("tbl"), F.col("id").alias("k"), F.lit(1).alias("op_type"))
    rows.write.partitionBy("tbl").parquet(str(tmp_path / "in"))
    schema = "k long, op_type int"
    tables = {str(t): SnapshotTable(spark, str(tmp_path / f"t{t}")) for t in range(6)}
    for t in tables.values():
        t.commit(empty_target(spark, rows.drop("tbl").schema))
    specs = {t: ApplySpec(keys=("k",), new_columns="ignore") for t in tables}
    broken = [True]

    def apply_fn(t, b, spec):
        if broken[0] and b.filter("k = 3").count():
            raise RuntimeError("no space")
        return t.unionByName(b)

    def run(known):
        files = cycles.staged_files(spark, str(tmp_path / "in"), "/tbl=([^/]+)/")
        q = cycles.apply_tables(files, known, specs, dict.fromkeys(known, schema), str(tmp_path / "checkpoint"), apply_fn=apply_fn)
        q.awaitTermination()

    with pytest.raises(Exception, match="1 of 6 tables failed, 3: no space"):
        run(tables)
    assert {n: t.read().count() for n, t in tables.items()} == {n: 0 if n == "3" else 10 for n in tables}
    broken[0] = False
    with pytest.raises(Exception, match="unknown tables"):
        run({n: t for n, t in tables.items() if n != "5"})
    run(tables)
    assert all(t.read().count() == 10 and t.version() == 2 for t in tables.values())
