"""Readers, routing, reconciling and checks."""

import json
import os

import pytest
from pyspark.sql import functions as F

from changemill import functions as fn
from changemill.functions.columns import matches_wildcard, wildcard
from changemill.operators import messages, quality
from changemill.sources import files, routing


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)
    return str(path)


def test_csv_separators_and_quotes(spark, tmp_path, rows):
    p = write(tmp_path / "a.csv", 'k|v~1|"x ""q"" | y"~2|z~')
    assert rows(files.read_csv(spark, p, "k int, v string", sep="|", line_sep="~")) == [(1, 'x "q" | y'), (2, "z")]
    with pytest.raises(ValueError):
        files.read_csv(spark, p, "k int", sep="||")


def test_strict_csv_fails_on_bad_lines(spark, tmp_path, rows):
    good = write(tmp_path / "g.csv", '"a", "b"\n"1", "x, y"\n')
    assert rows(files.read_csv_strict(spark, good)) == [("1", "x, y")]
    bad = write(tmp_path / "b.csv", "a,b\n1,2,3\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        files.read_csv_strict(spark, bad, "a string, b string").collect()


def test_columns_meet_by_name(spark, tmp_path, rows):
    a, b = write(tmp_path / "a.csv", "k,v\n1,x\n"), write(tmp_path / "b.csv", "v,k,extra\ny,2,e\n")
    out = files.read_csv_by_header(spark, [a, b], {"k": "int"})
    assert out.schema["k"].dataType.simpleString() == "int"
    assert rows(out, "k", "v", "extra") == [(1, "x", None), (2, "y", "e")]
    assert rows(files.read_csv_by_header(spark, [a], uniform=True)) == [("1", "x")]
    with pytest.raises(Exception):
        files.read_csv_by_header(spark, [a, b], uniform=True).collect()


def test_json_array_keeps_positions(spark, tmp_path, rows):
    p = write(tmp_path / "a.json", json.dumps([{"a": 3}, {"a": 1}, {"a": None}]))
    out = files.read_json_array(spark, p, "a int")
    assert rows(out, "file_name", "pos", "a") == [("a.json", 0, 3), ("a.json", 1, 1), ("a.json", 2, None)]
    with pytest.raises(Exception):
        files.read_json_array(spark, write(tmp_path / "b.json", "[{]"), "a int").collect()


def test_whole_files_and_listing(spark, tmp_path, rows):
    write(tmp_path / "x" / "a.txt", "é\nb")
    write(tmp_path / "x" / "e.txt", "")
    out = files.read_whole_files(spark, str(tmp_path / "x"))
    assert rows(messages.files_to_messages(out), "file_name", "value", "size_bytes") == [("a.txt", "é\nb", 4)]
    assert rows(files.list_files(spark, str(tmp_path / "x")), "file_name", "size_bytes") == [("a.txt", 4), ("e.txt", 0)]


def test_avro_without_its_module_says_so(spark, tmp_path):
    with pytest.raises(RuntimeError, match="spark-avro"):
        files.read_staged(spark, str(tmp_path), "avro")


def test_typed_load(spark, rows):
    df = spark.createDataFrame([("1", "x", "0", "n", "g")], "k string, v string, op_type string, new string, gen string")
    out = files.load_typed(df, {"k": "bigint", "v": "string", "gen": "int"}, generated=["gen"])
    assert [f.dataType.simpleString() for f in out.schema] == ["bigint", "string", "int", "string"]
    with pytest.raises(Exception):
        files.load_typed(df, {"v": "int"}, burst_cols=[]).select("v").collect()
    assert files.load_typed(df, {"v": "int"}, burst_cols=[], on_error="null").select("v").first()["v"] is None
    with pytest.raises(ValueError, match="missing"):
        files.load_typed(df, {"zz": "int"})
    assert files.load_typed(df, {"zz": "int"}, allow_missing=True).first()["zz"] is None


def test_numeric_text_stays_text(spark, rows):
    df = spark.createDataFrame([("007",), ("x",), ("",), ("1.5",), (None,)], "v string")
    assert rows(files.load_typed(df, {"v": "string"}, [])) == rows(df)
    got = df.select(fn.int_or_text(F.col("v")), fn.lenient_double(F.col("v")), fn.empty_to_null(F.col("v"))).collect()
    assert [tuple(r) for r in got] == [("7", 7.0, "007"), ("x", 0.0, "x"), ("", 0.0, None), ("1.5", 1.5, "1.5"), (None, None, None)]


@pytest.mark.parametrize("fmt", ["json", "csv"])
def test_quarantine(spark, tmp_path, rows, fmt):
    text = {"json": '{"k":1,"d":"2.50"}\n{oops\n\n{"k":2}\n', "csv": "1,2.50\n1,2,3,4\n\n2,\n"}[fmt]
    p = write(tmp_path / "a.txt", text)
    good, bad = files.read_or_quarantine(spark, p, "k int, d decimal(10,2)", fmt)
    assert [(k, None if d is None else str(d)) for k, d in rows(good)] == [(1, "2.50"), (2, None)]
    assert rows(bad) == [("a.txt", text.split("\n")[1])]
    assert bad.count() == 1 and good.count() == 2


TABLES = [("t1", "dw_t1"), ("t2", "dw_t2"), ("s.t3", "dw_t3")]


def routed(spark, names, **how):
    f = spark.createDataFrame([(n,) for n in names], "file_name string")
    t = spark.createDataFrame(TABLES, "tbl_name string, base_name string")
    return f, routing.route_files(f, t, **how)


def test_routing_by_first_dash(spark, rows):
    names = ["20240101-t1.csv", "t2.CSV", "1-2-t1.csv", "1-s.t3.csv", "1-t1.parquet", "1-t9.csv"]
    f, r = routed(spark, names)
    assert rows(r, "file_name", "base_name") == [("1-s.t3.csv", "dw_t3"), ("20240101-t1.csv", "dw_t1"), ("t2.CSV", "dw_t2")]
    assert rows(routing.unrouted_files(f, r)) == [("1-2-t1.csv",), ("1-t1.parquet",), ("1-t9.csv",)]
    with pytest.raises(ValueError, match="no table"):
        routing.require_routed(f, r)
    assert routing.require_routed(f, r, strict=False) is r
    f, r = routed(spark, ["1-t9.csv"])
    with pytest.raises(ValueError, match="no file"):
        routing.require_routed(f, r, strict=False)


def test_routing_by_last_dash_folder_and_expression(spark, rows):
    assert rows(routed(spark, ["1-2-t1.csv", "t2.csv"], split="last")[1], "tbl_name") == [("t1",)]
    assert rows(routed(spark, ["t1/x.orc", "a/t1/x.orc"], by="folder")[1], "file_name") == [("t1/x.orc",)]
    r = routed(spark, ["q/7_t2_9.csv", "q/t2.csv"], expr="q/{x_tstamp}_{x_tbl_name}_{x_tx_seq}.csv")[1]
    assert rows(r, "file_name", "tbl_name") == [("q/7_t2_9.csv", "t2")]
    assert rows(routed(spark, ["1-T1.csv"], lower=True)[1], "tbl_name") == [("t1",)]


def test_file_name_elements(spark):
    f = spark.createDataFrame([("tranx/1_a.b_0f.csv",)], "file_name string")
    r = routing.parse_file_name(f, "tranx/{t}_{tbl}_{tx}.csv").first()
    assert (r["t"], r["tbl"], r["tx"]) == ("1", "a.b", "0f")
    with pytest.raises(ValueError, match="no value"):
        messages.destination_from_file(f, "tranx/{t}.csv", "{nope}")


def test_reconcile_verdicts(spark, rows):
    m = spark.createDataFrame([("a", "1"), ("a", "2"), ("b", "1"), ("c", "1")], "tbl_name string, file_name string")
    f = spark.createDataFrame([("a", "1"), ("b", "1"), ("b", "9")], "tbl_name string, file_name string")
    out = routing.reconcile(m, f)
    assert rows(out) == [("a", 2, 1, 1, 0, "incomplete"), ("b", 1, 1, 0, 1, "ok"), ("c", 1, 0, 1, 0, "skip")]
    with pytest.raises(Exception, match="missing"):
        routing.require_complete(out).collect()
    assert rows(routing.require_complete(out.filter("tbl_name <> 'a'")), "tbl_name") == [("b",)]


def test_file_size_limit(spark):
    f = spark.createDataFrame([("a", 5), ("b", 50)], "file_name string, size_bytes long")
    assert routing.limit_file_size(f, 10, "drop").count() == 1
    with pytest.raises(Exception, match="exceeds"):
        routing.limit_file_size(f, 10).collect()


@pytest.mark.parametrize("pattern,name,hit", [
    ("*", "x", True), ("a*", "abc", True), ("a*", "bc", False), ("!a*", "bc", True), ("!a*", "abc", False),
    ("a?c", "abc", True), ("a.c", "abc", False), ("[a-c]x", "bx", True), ("[!a-c]x", "bx", False), ("a+(b)", "a+(b)", True),
    ("abc", "abc", True), ("abc", "abcd", False), ("!abc", "abc", False), ("a*c*", "abcd", True), ("", "", True),
])
def test_wildcards(spark, pattern, name, hit):
    df = spark.createDataFrame([(name, pattern)], "n string, p string")
    assert df.select(matches_wildcard(F.col("n"), wildcard(F.col("p")))).first()[0] is hit


def test_checks(spark, rows):
    df = spark.createDataFrame([("f", 1, "abcdef", "2020-01-01"), ("f", 2, None, "2020-01-01 00:00"), ("f", 3, "x", "2020-01-01 00:00")],
                               "file string, n int, s string, d string")
    assert rows(quality.long_text(df, {"s": 3, "d": 12}), "n", "column") == [(1, "s"), (2, "d"), (3, "d")]
    assert rows(quality.long_dates(df, ["d"], "file", ["n"]), "n") == [(2,)]
    assert rows(quality.null_violations(df, ["s", "n"]), "n", "column") == [(2, "s")]
    assert rows(quality.violation_counts(quality.long_text(df, {"d": 1}))) == [("d", 3)]
    with pytest.raises(ValueError):
        quality.check_column_count(df, df.drop("n"))
    with pytest.raises(ValueError):
        quality.check_column_names(df, df.drop("n"))
    with pytest.raises(ValueError):
        quality.require_columns(df, ["op_type"])
    quality.check_column_count(df.withColumn("op_type", F.lit(1)), df)


def test_csv_columns_are_found_by_name(spark, tmp_path, rows):
    (tmp_path / "a.csv").write_text("id,name\n1,x\n")
    (tmp_path / "b.csv").write_text("name,id\ny,2\n")
    folder = str(tmp_path)
    assert rows(files.read_csv(spark, folder, "id int, name string")) == [(1, "x"), (2, "y")]
    assert rows(files.read_csv_by_header(spark, folder, {"id": "int"}), "id", "name") == [(1, "x"), (2, "y")]
    t = spark.createDataFrame([(7, "t")], "id int, name string")
    assert rows(files.insert_from_file(spark, t, folder, ["id", "name"])) == [(1, "x"), (2, "y"), (7, "t")]
    with pytest.raises(ValueError, match="missing"):
        files.read_csv(spark, folder, "id int, other string")
    (tmp_path / "c.csv").write_text("id,name\nten,z\n")
    with pytest.raises(Exception, match="ten"):
        files.read_csv(spark, folder, "id int, name string").collect()


def test_missing_files_are_reported_or_fail(spark, tmp_path, rows):
    (tmp_path / "a.json").write_text('{"k": 1}\n{bad\n')
    paths = [str(tmp_path / "a.json"), str(tmp_path / "gone.json")]
    good, bad = files.read_or_quarantine(spark, paths, "k int", on_missing="report")
    assert rows(good) == [(1,)] and rows(bad) == [("a.json", "{bad"), ("gone.json", None)]
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        files.read_or_quarantine(spark, paths, "k int")[0].collect()
    with pytest.raises(ValueError):
        files.read_or_quarantine(spark, paths, "k int", on_missing="skip")


def test_headers_read_only_the_heads_of_files(spark, tmp_path, rows):
    """Empty lines first, a header longer than a block, other line ends, odd names; no file is read to its end."""
    (tmp_path / "sub dir=1").mkdir()
    (tmp_path / "a b%20c.csv").write_text("\n\nk,v\n1,x\n")
    (tmp_path / "sub dir=1" / "b.csv").write_bytes(b"\xef\xbb\xbfv,k\r\ny,2\r\n")
    long = [f"c{i:05}" for i in range(12_000)]
    (tmp_path / "c.csv").write_text(",".join(["k", "v", *long]) + "\n" + ",".join(["3", "z"] + ["" for _ in long]) + "\n")
    (tmp_path / "empty.csv").write_text("")
    found = files._headers(spark, [str(tmp_path)], ",", None)
    assert sorted((len(n), n[:2], len(p)) for n, p in found.items()) == [(2, ("k", "v"), 1), (2, ("v", "k"), 1), (12_002, ("k", "v"), 1)]

    big = tmp_path / "big.csv"
    big.write_text("k,v\n" + "1,x\n" * 300_000)
    import pyarrow as pa

    reads = []
    real = files.located

    class Seen:
        def __init__(self, f):
            self.f = f

        def __enter__(self):
            return self

        def __exit__(self, *a):
            self.f.close()

        def read(self, n):
            out = self.f.read(n)
            reads.append(len(out))
            return out

    class Opened:
        def __init__(self, store):
            self.store = store

        def open_input_file(self, name):
            return Seen(self.store.open_input_file(name))

    files.located = lambda p: (Opened(real(p)[0]), real(p)[1])
    try:
        got = next(files._first_lines(b"\n")(iter([pa.RecordBatch.from_pydict({"path": [f"file:{big}"]})])))
    finally:
        files.located = real
    assert got.column(1).to_pylist() == ["k,v"] and sum(reads) == files.HEAD < big.stat().st_size


def test_listing_by_tasks(spark, tmp_path, rows):
    for name, size in (("a.txt", 3), ("x y/e.txt", 0), ("x y/deep/er/f.txt", 1), ("x y/deep/g.csv", 2), ("_hid/h.txt", 4), (".i.txt", 5)):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text("z" * size)
    (tmp_path / "none").mkdir()
    out = files.list_files(spark, str(tmp_path), "*.txt")
    assert rows(out, "file_name", "size_bytes") == [("a.txt", 3), ("e.txt", 0), ("f.txt", 1)]
    same = files.list_files(spark, str(tmp_path), "*.txt", include_empty=False)
    assert rows(same, "file_path") == [r for r in rows(out, "file_path") if "e.txt" not in r[0]]
