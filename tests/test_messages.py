"""Images, transactions, envelopes and batch packing."""

import json
import random
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from changemill.operators import images, messages, packing
from changemill.operators.ordering import with_position
from changemill.plans.publish import PublishSpec, publish_plan

S = "f string, pos long, op_type int, a int, b string"


def model(array, mode="c", discard=False, ignore=(), end_col=None, end=False, prefix="Old&"):
    """What collapsing a file's rows gives, as a list of dicts, one row after the other."""
    out, before, held = [], None, None
    for row in array:
        row = dict(row)
        if row["op_type"] == 4:
            before = row
            continue
        changed = None
        if before is not None:
            if row["op_type"] != 2:
                raise ValueError("pair")
            changed = [k for k in before if k not in ("op_type", *ignore) and row[k] != before[k]]
            for k in before:
                if k not in ("op_type", *ignore) and (mode == "a" or k in changed):
                    row[prefix + k] = before[k]
            before = None
        if discard and changed == []:
            held = row
            continue
        held = None
        out.append(row)
    if end_col and end and held:
        out.append(held)
    if end_col and end and out and end_col in out[-1]:
        out[-1][end_col] = 1
    return out


def random_file(rnd, n):
    array = []
    for _ in range(n):
        row = {"op_type": 1, "a": rnd.randrange(3), "b": rnd.choice(["x", "y", None]), "eot": 0}
        kind = rnd.randrange(4)
        if kind == 0:
            array.append(row)
        elif kind == 1:
            array.append({**row, "op_type": 0})
        else:
            after = {**row, "op_type": 2}
            if rnd.random() < 0.6:
                after["a"], after["b"] = rnd.randrange(3), rnd.choice(["x", "y", None])
            array += [{**row, "op_type": 4}, after]
    return array


@pytest.mark.parametrize("mode", ["changed", "all"])
@pytest.mark.parametrize("dense", [True, False])
def test_collapse_equals_row_by_row(spark, mode, dense):
    rnd = random.Random(5)
    files = {f"f{i}": random_file(rnd, rnd.randrange(0, 12)) for i in range(8)}
    data = [(f, p, r["op_type"], r["a"], r["b"], r["eot"]) for f, rs in files.items() for p, r in enumerate(rs)]
    df = spark.createDataFrame(data, S + ", eot int")
    # gaps in the order must not matter unless the caller says the position has none
    if not dense:
        df = df.withColumn("pos", F.col("pos") * 7)
    args = dict(group=["f"], mode=mode, ignore=["eot"], pos_col="pos" if dense else None)
    out = images.collapse_updates(df, ["pos"], **args)
    out = images.mark_tx_end(out, ["f"], ["pos"], end_col="eot")
    out = images.discard_unchanged(out, keep_col="eot")
    out = images.collapsed_json(out, ["op_type", "a", "b", "eot"], mode=mode)
    got = {}
    for r in out.select("f", "pos", "value").collect():
        got.setdefault(r["f"], []).append((r["pos"], json.loads(r["value"])))
    for f, rs in files.items():
        want = model(rs, mode[0], True, ["eot"], "eot", True)
        # JSON cannot show which row the model marks if the last row of the file is a before image
        assert [v for _, v in sorted(got.get(f, []), key=lambda x: x[0])] == want


def test_broken_pair_fails(spark):
    df = spark.createDataFrame([("f", 0, 4, 1, "x"), ("f", 1, 1, 1, "x")], S)
    with pytest.raises(Exception, match="not followed"):
        images.collapse_updates(df, ["pos"], ["f"]).collect()
    assert images.check_pairs(df, ["pos"], ["f"]).count() == 1
    with pytest.raises(ValueError, match="needed"):
        images.collapse_updates(df.drop("op_type"), ["pos"], ["f"])


def test_pairs_do_not_cross_files(spark, rows):
    df = spark.createDataFrame([("f", 0, 4, 1, "x"), ("g", 0, 2, 2, "x")], S)
    out = images.collapse_updates(df, ["pos"], ["f"])
    assert rows(out, "f", "a", "changed_cols") == [("g", 2, None)]
    bad = images.check_pairs(df, ["pos"], ["f"])
    assert rows(bad, "f", "next_op") == [("f", None)]
    assert images.check_pairs(df, ["pos"], ["f"], strict=False).count() == 0


def test_second_before_image_replaces_the_first(spark, rows):
    df = spark.createDataFrame([("f", 0, 4, 1, "x"), ("f", 1, 4, 5, "x"), ("f", 2, 2, 6, "x")], S)
    out = images.collapse_updates(df, ["pos"], ["f"])
    assert rows(out, "a", "Old&a", "Old&b") == [(6, 5, None)]


def test_changed_from_null_shows(spark):
    df = spark.createDataFrame([("f", 0, 4, None, "x"), ("f", 1, 2, 6, "x")], S)
    r = images.collapsed_json(images.collapse_updates(df, ["pos"], ["f"]), ["a", "b"]).first()
    assert r["changed_cols"] == ["a"] and json.loads(r["value"]) == {"a": 6, "b": "x", "Old&a": None}


def test_positions_over_many_chunks(spark):
    df = spark.range(1000).select((F.col("id") * 37 % 1000).alias("o"))
    for n in (1, 3, 40):
        got = with_position(df, ["o"], chunks=n).collect()
        assert all(r["o"] == r["pos"] for r in got) and len(got) == 1000


def test_tx_partition_values(spark, rows):
    h = "00000000000000ff"
    data = [("",), ("zz",), ("12zz",), ("ffffffffffffffff",), ("0000" + h + "0000",), ("ff" * 20,), (None,), ("10",)]
    out = messages.tx_partition(spark.createDataFrame(data, "s string"), 7, "s")
    want = {"": 0, "zz": 0, "12zz": 0, "ffffffffffffffff": (2**64 - 1) % 7, "0000" + h + "0000": 255 % 7,
            "ff" * 20: int("ff" * 20, 16) % 7, None: 0, "10": 16 % 7}
    assert dict(rows(out, "s", "partition_id")) == want
    both = spark.createDataFrame([("03", "0000" + h + "0" * 16)], "s string, i string")
    assert messages.tx_partition(both, 7, "s", "i").first()["partition_id"] == 255 % 7


def test_envelope_text(spark):
    df = spark.createDataFrame([(1, None, 2, "t")], "a int, b string, op_type int, op_timestamp string")
    r = messages.to_envelope(df, "tbl", "stream").first()["value"]
    assert r == '{"columns":{"a":1,"b":null},"op_type":2,"op_timestamp":"t","tablename":"tbl"}'
    assert "tablename" not in messages.to_envelope(df, "tbl", "tbl").first()["value"]
    assert messages.partition_key(df, ["a", "b", "op_type"]).first()["partition_key"] == "1||Undefined"


def test_oversize_message_fails(spark):
    df = spark.createDataFrame([("é" * 10,)], "value string")
    assert messages.check_message_size(df, 20).count() == 1
    assert messages.size_violations(df, 19).first()["n_bytes"] == 20
    with pytest.raises(Exception, match="exceeds"):
        messages.check_message_size(df, 19).collect()


def test_rows_back_to_file_messages(spark, rows):
    df = spark.createDataFrame([("f", i, f'{{"a":{i}}}') for i in (2, 0, 1)], "f string, pos int, value string")
    want = '[{"a":0},{"a":1},{"a":2}]'
    assert rows(messages.rows_to_file_messages(df, ["f"], ["pos"], max_bytes=len(want))) == [("f", want)]
    with pytest.raises(Exception, match="exceeds"):
        messages.rows_to_file_messages(df, ["f"], ["pos"], max_bytes=len(want) - 1).collect()


def test_publish_plan_end_to_end(spark):
    rnd = random.Random(11)
    files = {(f"f{i:02}", i, rnd.randrange(5)): random_file(rnd, rnd.randrange(1, 9)) for i in range(30)}
    data = [(f, s, f"{tx:x}", p, r["op_type"], r["a"], r["b"], 0) for (f, s, tx), rs in files.items() for p, r in enumerate(rs)]
    df = spark.createDataFrame(data, "f string, seq int, tx string, pos long, op_type int, a int, b string, eot int")
    spec = PublishSpec(columns=("op_type", "a", "b", "eot"), file_cols=("f",), file_order=("seq",), discard=True,
                       tx_col="tx", partitions=2, end_col="eot", max_bytes=400)
    got = {}
    for r in publish_plan(df, spec).collect():
        got.setdefault(r["partition_id"], []).append((r["seq"], r["value"], r["batch_no"]))
    for part in (0, 1):
        mine = [(s, tx, rs) for (f, s, tx), rs in files.items() if tx % 2 == part]
        want = []
        for s, tx, rs in mine:
            end = s == max(x for x, t, _ in mine if t == tx)
            out = model(rs, "c", True, ["eot"], "eot", end)
            if out:
                want.append((s, out))
        have = sorted(got[part])
        assert [(s, json.loads(v)) for s, v, _ in have] == want
        assert [b for *_, b in have] == greedy([len(v.encode()) for _, v, _ in have], 400)
    with pytest.raises(Exception, match="exceeds"):
        publish_plan(df, replace(spec, max_bytes=50))


def test_publish_plan_without_collapse(spark, rows):
    df = spark.createDataFrame([("f", 0, 1, "x"), ("f", 1, 4, None)], "f string, pos int, op_type int, b string")
    spec = PublishSpec(columns=("op_type", "b"), file_cols=("f",), file_order=("f",), collapse=None)
    assert rows(publish_plan(df, spec), "value", "batch_no") == [('[{"op_type":1,"b":"x"},{"op_type":4,"b":null}]', 0)]


def greedy(sizes, limit):
    out, used, batch = [], 0, 0
    for i, s in enumerate(sizes):
        if i and used + s > limit:
            batch, used = batch + 1, 0
        used += s
        out.append(batch)
    return out


@pytest.mark.parametrize("seed", range(8))
def test_packing_equals_one_pass(spark, seed):
    rnd = random.Random(seed)
    limit = rnd.choice([1, 10, 50, 400])
    dests = {f"d{i}": rnd.choice([0, 1, 5, 40, 700]) for i in range(4)}
    dests["hot"] = 900
    kinds = [lambda: rnd.randrange(0, 30), lambda: 10, lambda: rnd.choice([0, 0, 1, 60]), lambda: rnd.randrange(1, 4)]
    data = {d: [rnd.choice(kinds[seed % 4:] or kinds)() for _ in range(n)] for d, n in dests.items()}
    flat = [(d, i, s) for d, ss in data.items() for i, s in enumerate(ss)]
    rnd.shuffle(flat)
    df = spark.createDataFrame(flat, "d string, i long, n long")
    out = packing.pack_batches(df, ["i"], ["d"], limit, size_col="n", chunks=rnd.choice([1, 2, 9, 30]))
    got = {}
    for r in out.collect():
        got.setdefault(r["d"], {})[r["i"]] = r["batch_no"]
    for d, ss in data.items():
        assert [got[d][i] for i in range(len(ss))] == greedy(ss, limit) if ss else d not in got


def test_packing_without_destination_and_with_nulls(spark):
    df = spark.createDataFrame([(1, "aa"), (2, None), (3, "bbb"), (4, "c")], "i int, value string")
    out = packing.pack_batches(df, ["i"], max_bytes=4)
    assert [r["batch_no"] for r in out.orderBy("i").collect()] == [0, 0, 1, 1]


def test_packing_bounds_the_messages_of_a_task(spark, monkeypatch):
    """Messages of one byte: the number of chunks follows from the rows."""
    monkeypatch.setattr(packing, "ROWS", 300)
    held, real = [], packing.sorted_chunks
    monkeypatch.setattr(packing, "sorted_chunks", lambda df, order, n: (held.append(n), real(df, order, n))[1])
    df = spark.range(9000).select("id", F.lit(1).alias("n"))
    out = packing.pack_batches(df, ["id"], max_bytes=1000, size_col="n")
    assert [r["batch_no"] for r in out.orderBy("id").collect()] == [i // 1000 for i in range(9000)]
    assert held == [30]


def test_packing_small_arrow_batches(spark):
    """State carries over from one Arrow batch to the next."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    old = spark.conf.get(key)
    spark.conf.set(key, 7)
    try:
        df = spark.range(500).select("id", (F.col("id") % 13).alias("n"))
        out = packing.pack_batches(df, ["id"], max_bytes=20, size_col="n", chunks=3)
        got = [r["batch_no"] for r in out.orderBy("id").collect()]
    finally:
        spark.conf.set(key, old)
    assert got == greedy([i % 13 for i in range(500)], 20)


def test_workers_do_not_need_the_package():
    """Run from a folder and with a path on which workers cannot import the package."""
    import os
    import subprocess
    import sys
    import tempfile

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = f"""
import sys; sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession
from changemill.operators.packing import pack_batches
s = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").getOrCreate()
print("BATCHES", [r.batch_no for r in pack_batches(s.range(4), ["id"], max_bytes=2, size_col="id").orderBy("id").collect()])
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], cwd=tempfile.mkdtemp(), env=env, capture_output=True, text=True, timeout=300)
    assert "BATCHES [0, 0, 1, 2]" in out.stdout, out.stderr[-2000:]


@pytest.mark.parametrize("ahead", [False, True])
def test_neighbours_across_chunks(spark, ahead):
    """Groups longer than a chunk, groups of one row, NULL groups, empty chunks."""
    from changemill.operators.ordering import with_neighbour

    rnd = random.Random(7)
    data = [("hot", i) for i in range(700)] + [(f"g{k}", i) for k in range(60) for i in range(rnd.choice([1, 2, 5]))] + [(None, i) for i in range(9)]
    rnd.shuffle(data)
    df = spark.createDataFrame([(*d, None if d[1] % 3 else f"{d[0]}{d[1]}") for d in data], "g string, i int, t string")
    out = with_neighbour(df, {"near": "i", "far": "t"}, ["i"], ["g"], ahead, hit="there")
    got = {(r["g"], r["i"]): (r["near"], r["far"]) for r in out.collect()}
    assert all(r["there"] == (r["near"] is not None) for r in out.collect())
    have, step = set(data), 1 if ahead else -1
    want = {}
    for g, i in data:
        near = i + step if (g, i + step) in have else None
        want[(g, i)] = (near, None if near is None or near % 3 else f"{g}{near}")
    assert got == want and len(got) == len(data)
    one = with_neighbour(df.limit(1), {"near": "i"}, ["i"], ["g"], ahead).collect()
    assert [r["near"] for r in one] == [None]
    assert with_neighbour(df.limit(0), {"near": "i"}, ["i"], ["g"], ahead).count() == 0


def test_collapsing_joins_no_data_with_itself(spark):
    """Only the borders of the chunks are joined: the join's left side is filtered to them."""
    df = spark.range(400).select((F.col("id") % 3).alias("g"), "id", F.when(F.col("id") % 2 == 0, 4).otherwise(2).alias("op_type"), F.lit("x").alias("v"))
    out = images.with_previous(df, ["v"], ["id"], ["g"])
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join" in line]
    assert len(joins) == 2 and plan.count("Window ") == 1
    assert out.filter("prev_hit").count() == 397
