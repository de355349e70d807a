"""Dictionary types and rules, schema drift, data checks, table sinks and cycles."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import functions as F

from catalog.apply_queries import COLS, KEY, LCOLS, MERGE_HARD, MERGE_HARD_NULL, NULL_KEY, _LAST, _tb
from catalog.fixtures import CHANGES, CHANGES_NULL, DICTIONARY, LOG, LOG_TARGET, ORDERS, ORDERS_NULL, ctes, frame, plain, scratch, table
from catalog.registry import query
from changemill.operators import merge, quality
from changemill.operators.changes import empty_like, order_columns
from changemill.operators.keyed import to_text
from changemill.plans.integrate import integrate
from changemill.plans.refresh import create_target, empty_target
from changemill.schema import evolve, rules, types
from changemill.sinks import files as sink_files
from changemill.sinks.bucketed import BucketedTable
from changemill.sinks.snapshots import SnapshotTable, slice_state, slices_done
from changemill.sources.files import load_typed
from changemill.spec import ApplySpec
from changemill.streaming import cycles

_TARGET_TYPE = """CASE col_datatype WHEN 'integer identity' THEN 'INTEGER' WHEN 'varchar2' THEN 'STRING' WHEN 'date' THEN 'TIMESTAMP'
 WHEN 'date (mysql)' THEN 'DATE' WHEN 'money' THEN 'DECIMAL(19,4)' WHEN 'bit' THEN 'BYTE' WHEN 'blob' THEN 'BINARY'
 WHEN 'float8' THEN 'DOUBLE' WHEN 'bigint unsigned' THEN 'LONG' WHEN 'time2' THEN 'STRING'
 ELSE CASE col_length WHEN '0' THEN 'DOUBLE' WHEN '8' THEN 'DECIMAL(8,0)' WHEN '8,0' THEN 'DECIMAL(8,0)' WHEN '10,-2' THEN 'DECIMAL(12,0)'
   WHEN '2,6' THEN 'DECIMAL(2,2)' WHEN '40,2' THEN 'DOUBLE' WHEN '18,4' THEN 'DECIMAL(18,4)' WHEN '6' THEN 'DECIMAL(6,0)' END END"""


@query("map_types", ctes(d=DICTIONARY) + f"SELECT tbl_name, col_name, {_TARGET_TYPE} AS target_type FROM d")
def map_types(spark, sf):
    return types.map_types(frame(spark, sf, DICTIONARY)).select("tbl_name", "col_name", "target_type")


@query("map_types_options", ctes(d=DICTIONARY) + f"""
SELECT col_name, CASE WHEN col_datatype = 'bit' THEN 'BOOLEAN'
  WHEN col_datatype = 'number' AND col_length IN ('0', '8', '8,0', '6') THEN 'INTEGER' ELSE {_TARGET_TYPE} END AS target_type FROM d""")
def map_types_options(spark, sf):
    d = frame(spark, sf, DICTIONARY).filter("NOT (col_datatype = 'number' AND col_length = '10,-2')")
    rest = frame(spark, sf, DICTIONARY).filter("col_datatype = 'number' AND col_length = '10,-2'")
    out = types.map_types(d, number_to_integer=True, bool_to_boolean=True).unionAll(types.map_types(rest))
    return out.select("col_name", "target_type")


@query("order_columns", ctes(d=DICTIONARY) + "SELECT tbl_name, col_sequence, col_name FROM d")
def order_cols(spark, sf):
    return order_columns(frame(spark, sf, DICTIONARY)).select("tbl_name", "col_sequence", "col_name")


@query("key_columns", ctes(d=DICTIONARY) + "SELECT tbl_name, string_agg(base_name, ',' ORDER BY col_sequence) AS keys FROM d WHERE col_key > 0 GROUP BY tbl_name")
def key_columns(spark, sf):
    return types.key_columns(frame(spark, sf, DICTIONARY)).select("tbl_name", F.array_join("keys", ",").alias("keys"))


# one rule of every kind per brand, named after the table pattern it is for
_R = "rule_seq, tbl_pattern, context, name, base_name, extra, absent, datatype, datatype_match, length, precision, scale, nullable, is_key"
_BRANDS = "SELECT p_brand AS brand, CAST(min(p_partkey) AS INT) AS first_key, row_number() OVER (ORDER BY p_brand) AS n FROM {part} GROUP BY p_brand"
RULES = f"""
SELECT CAST(n * 10 AS INT) AS rule_seq, concat(brand, '_*') AS tbl_pattern, CAST(NULL AS VARCHAR(20)) AS context, 'op_val' AS name, CAST(NULL AS VARCHAR(20)) AS base_name,
       true AS extra, false AS absent, 'integer' AS datatype, CAST(NULL AS VARCHAR(40)) AS datatype_match, CAST(NULL AS VARCHAR(20)) AS length,
       CAST(NULL AS INT) AS precision, CAST(NULL AS INT) AS scale, true AS nullable, false AS is_key FROM ({_BRANDS}) b
UNION ALL SELECT CAST(n * 10 + 1 AS INT), concat(brand, '_*'), NULL, concat('c', CAST(first_key AS VARCHAR(20))), NULL, false, true, NULL, NULL, NULL, NULL, NULL, false, false FROM ({_BRANDS}) b
UNION ALL SELECT CAST(n * 10 + 2 AS INT), concat(brand, '_*'), 'dw', 'op_val', 'change_code', false, false, NULL, NULL, NULL, NULL, NULL, false, true FROM ({_BRANDS}) b
UNION ALL SELECT CAST(n * 10 + 3 AS INT), concat(brand, '_ECONOMY_*'), NULL, NULL, NULL, false, false, 'bigint', 'number[prec<=8 && scale=0]', NULL, NULL, NULL, true, false FROM ({_BRANDS}) b
UNION ALL SELECT CAST(n * 10 + 4 AS INT), concat('!', brand, '*'), 'other', NULL, NULL, false, false, 'varchar2', 'float8', '99', NULL, NULL, false, false FROM ({_BRANDS}) b
"""
_D_FIELDS = "tbl_name, col_name, base_name, col_key, col_datatype, col_length, col_nullable"
_RULED = ctes(d=DICTIONARY, f=_BRANDS) + """,
b AS (SELECT d.*, split_part(tbl_name, '_', 1) AS brand FROM d),
k AS (SELECT b.* FROM b JOIN f ON f.brand = b.brand WHERE col_name <> concat('c', CAST(first_key AS VARCHAR))),
m AS (SELECT tbl_name, col_name, base_name, col_key, CAST(col_nullable AS INTEGER) AS nul, col_datatype, col_length,
        tbl_name LIKE '%_ECONOMY_%' AND col_datatype = 'number' AND col_length IN ('0', '8', '6') AS hit FROM k)
"""
_RULED_SQL = _RULED + """SELECT tbl_name, col_name, base_name, col_key, CASE WHEN hit THEN 'bigint' ELSE col_datatype END AS col_datatype,
  CASE WHEN hit THEN '' ELSE col_length END AS col_length, CASE WHEN hit THEN 1 ELSE nul END AS col_nullable FROM m
UNION ALL SELECT DISTINCT tbl_name, 'op_val', 'change_code', 1, 'integer', '0', 1 FROM b"""


@query("apply_rules", _RULED_SQL)
def apply_rules(spark, sf):
    out = rules.apply_rules(frame(spark, sf, DICTIONARY), frame(spark, sf, RULES), context="dw")
    return out.select(*_D_FIELDS.split(", "))


@query("apply_extra", ctes(d=DICTIONARY) + """
SELECT tbl_name, col_name, base_name FROM d UNION ALL SELECT DISTINCT tbl_name, 'op_val', 'op_val' FROM d""")
def apply_extra(spark, sf):
    out = rules.apply_extra(frame(spark, sf, DICTIONARY), frame(spark, sf, RULES))
    return out.select("tbl_name", "col_name", "base_name")


@query("apply_extra_ignored", ctes(d=DICTIONARY) + "SELECT tbl_name, col_name FROM d")
def apply_extra_ignored(spark, sf):
    out = rules.apply_extra(frame(spark, sf, DICTIONARY), frame(spark, sf, RULES), burst_only=["op_val"])
    return out.select("tbl_name", "col_name")


@query("apply_absent", _RULED + "SELECT tbl_name, col_name FROM k")
def apply_absent(spark, sf):
    return rules.apply_absent(frame(spark, sf, DICTIONARY), frame(spark, sf, RULES)).select("tbl_name", "col_name")


@query("apply_modify", ctes(d=DICTIONARY) + """
SELECT tbl_name, col_name, CASE WHEN hit THEN 'bigint' ELSE col_datatype END AS col_datatype, CASE WHEN hit THEN '' ELSE col_length END AS col_length
FROM (SELECT *, tbl_name LIKE '%_ECONOMY_%' AND col_datatype = 'number' AND col_length IN ('0', '8', '6') AS hit FROM d) x""")
def apply_modify(spark, sf):
    out = rules.apply_modify(frame(spark, sf, DICTIONARY), frame(spark, sf, RULES), context="dw")
    return out.select("tbl_name", "col_name", "col_datatype", "col_length")


@query("rules_for", ctes(d=DICTIONARY, r=RULES) + """
SELECT DISTINCT d.tbl_name, r.rule_seq, r.name FROM d JOIN r ON r.tbl_pattern IN (concat(split_part(d.tbl_name, '_', 1), '_*'), concat(split_part(d.tbl_name, '_', 1), '_', split_part(d.tbl_name, '_', 2), '_*'))
WHERE r.context IS NULL OR r.context = 'dw'""")
def rules_for(spark, sf):
    tables = frame(spark, sf, DICTIONARY).select("tbl_name").distinct()
    return rules.rules_for(frame(spark, sf, RULES), tables, "dw").select("tbl_name", "rule_seq", "name")


# source types under which the dictionary lists the columns of a table
_SOURCE_TYPES = {"bigint": "bigint", "int": "integer", "double": "float8", "string": "varchar2"}


def _dictionary_of(spark, df, name):
    """The dictionary of a table, from its schema, with one column it has no data for."""
    fields = [(f.name, _SOURCE_TYPES[f.dataType.simpleString()]) for f in df.schema.fields] + [("note", "clob")]
    rows = [(name, i, c, c, 0, t, "0", 1) for i, (c, t) in enumerate(fields)]
    return spark.createDataFrame(
        rows, "tbl_name string, col_sequence int, col_name string, base_name string, col_key int, "
        "col_datatype string, col_length string, col_nullable int")


_CONFORMED = plain("SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, CAST(NULL AS VARCHAR) AS note FROM {customer}")


@query("conform", _CONFORMED)
def conform(spark, sf):
    """Text rows cast to the schema that a dictionary gives."""
    df = table(spark, sf, "customer")
    schema = types.struct_type(types.map_types(_dictionary_of(spark, df, "customer")), "customer")
    return types.conform(to_text(df), schema)


@query("create_target", _CONFORMED)
def create_target_query(spark, sf):
    """Create from a dictionary, then load: an empty version, then the rows."""
    df = table(spark, sf, "customer")
    target = SnapshotTable(spark, scratch(spark, "create"))
    schema = create_target(target, types.map_types(_dictionary_of(spark, df, "customer")), "customer")
    target.commit(types.conform(to_text(df), schema), "load")
    return target.read()


_WIDER = f"SELECT {COLS}, op_type, is_deleted, o_orderstatus AS channel FROM ({CHANGES}) c"


@query("schema_drift", ctes(t=ORDERS, b=_WIDER) + f"""
SELECT {COLS}, CAST(NULL AS VARCHAR) AS channel FROM t WHERE NOT EXISTS (SELECT 1 FROM b WHERE b.o_orderkey = t.o_orderkey)
UNION ALL SELECT {COLS}, channel FROM b WHERE op_type <> 0""")
def schema_drift(spark, sf):
    t, b = frame(spark, sf, ORDERS), frame(spark, sf, _WIDER)
    return merge.merge_hard(evolve.evolve_for(t, b), b, KEY)


@query("new_columns", ctes(b=_WIDER) + "SELECT 'channel' AS col_name, count(*) AS n_rows FROM b")
def new_columns(spark, sf):
    b = frame(spark, sf, _WIDER)
    found = evolve.detect_drift(b, frame(spark, sf, ORDERS))
    return b.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("col_name", F.lit(",".join(found)))


@query("missing_input_column", plain("SELECT o_orderkey, o_custkey, CAST(NULL AS VARCHAR) AS channel FROM {orders}"))
def missing_input_column(spark, sf):
    staged = table(spark, sf, "orders").selectExpr("CAST(o_orderkey AS STRING) AS o_orderkey", "CAST(o_custkey AS STRING) AS o_custkey")
    return load_typed(staged, {"o_orderkey": "bigint", "o_custkey": "bigint", "channel": "string"}, [], allow_missing=True)


@query("derived_columns", plain("SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS o_year FROM {orders}"))
def derived_columns(spark, sf):
    return evolve.derived_columns(table(spark, sf, "orders"), {"o_year": "year(o_orderdate)"}).select("o_orderkey", "o_year")


# ---- checks

@query("quality_length", plain("""SELECT o_orderkey, 'o_orderpriority' AS "column", o_orderpriority AS value FROM {orders} WHERE length(o_orderpriority) > 8
UNION ALL SELECT o_orderkey, 'o_orderstatus', o_orderstatus FROM {orders} WHERE length(o_orderstatus) > 0"""))
def quality_length(spark, sf):
    out = quality.long_text(table(spark, sf, "orders"), {"o_orderpriority": 8, "o_orderstatus": 0})
    return out.select("o_orderkey", "column", "value")


_DATES = "SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderpriority = '1-URGENT' THEN '2001-02-03 04:05:06' ELSE '2001-02-03' END AS d FROM {orders}"


@query("quality_date", ctes(x=_DATES) + """SELECT o_orderkey, 'd' AS "column", d AS value FROM x WHERE length(d) > 10""")
def quality_date(spark, sf):
    return quality.long_dates(frame(spark, sf, _DATES), ["d"]).select("o_orderkey", "column", "value")


@query("quality_date_first", ctes(x=_DATES) + "SELECT o_orderstatus, min(o_orderkey) AS o_orderkey FROM x WHERE length(d) > 10 GROUP BY o_orderstatus")
def quality_date_first(spark, sf):
    out = quality.long_dates(frame(spark, sf, _DATES), ["d"], "o_orderstatus", ["o_orderkey"])
    return out.select("o_orderstatus", "o_orderkey")


_GAPS = "SELECT o_orderkey, nullif(o_orderstatus, 'P') AS s, nullif(o_orderpriority, '5-LOW') AS p FROM {orders}"


@query("quality_notnull", ctes(x=_GAPS) + """SELECT o_orderkey, 's' AS "column" FROM x WHERE s IS NULL UNION ALL SELECT o_orderkey, 'p' FROM x WHERE p IS NULL""")
def quality_notnull(spark, sf):
    return quality.null_violations(frame(spark, sf, _GAPS), ["s", "p"]).select("o_orderkey", "column")


@query("quality_columns", plain("SELECT count(*) AS n_rows FROM {orders}"))
def quality_columns(spark, sf):
    t, b = _tb(spark, sf)
    quality.check_column_count(b, t)
    quality.check_column_names(b, t)
    return quality.require_columns(table(spark, sf, "orders"), KEY).agg(F.count(F.lit(1)).alias("n_rows"))


# ---- table sinks

@query("snapshot_apply", MERGE_HARD_NULL)
def snapshot_apply(spark, sf):
    t, b = frame(spark, sf, ORDERS_NULL), frame(spark, sf, CHANGES_NULL)
    target = SnapshotTable(spark, scratch(spark, "snapshot"))
    target.commit(t)
    target.apply(lambda t, b: merge.merge_hard(t, b, NULL_KEY), b, "cycle-1")
    return target.read()


@query("snapshot_touched", MERGE_HARD)
def snapshot_touched(spark, sf):
    """Only the partitions in the change set are read and written again."""
    t, b = _tb(spark, sf)
    target = SnapshotTable(spark, scratch(spark, "touched"), ["o_orderpriority"])
    target.commit(t)
    target.apply_touched(lambda t, b: merge.merge_hard(t, b, KEY + ["o_orderpriority"]), b, "cycle-1")
    return target.read()


_PARTS = "SELECT o_orderkey, o_totalprice, CASE o_orderpriority WHEN '5-LOW' THEN NULL WHEN '4-NOT SPECIFIED' THEN '' ELSE o_orderpriority END AS part FROM {orders}"


@query("snapshot_touched_nulls", plain(f"SELECT o_orderkey, o_totalprice, nullif(part, '') AS part FROM ({_PARTS}) x UNION ALL SELECT -1, 0.5, NULL"))
def snapshot_touched_nulls(spark, sf):
    """NULL and empty partition values share a folder; an insert into it loses no row."""
    t = frame(spark, sf, _PARTS)
    target = SnapshotTable(spark, scratch(spark, "touched"), ["part"])
    target.commit(t)
    b = spark.createDataFrame([(-1, 0.5, "")], t.schema)
    target.apply_touched(lambda t, b: t.unionAll(b), b, "cycle-1")
    return target.read()


@query("load_dictionary", ctes(x=DICTIONARY) + "SELECT tbl_name, count(*) AS n_columns, CAST(sum(col_key) AS BIGINT) AS n_keys FROM x GROUP BY tbl_name")
def load_dictionary_query(spark, sf):
    """The dictionary kept as a data set, loaded and typed."""
    folder = scratch(spark, "dictionary")
    frame(spark, sf, DICTIONARY).write.parquet(folder)
    mapped = types.map_types(types.load_dictionary(spark, folder))
    return mapped.groupBy("tbl_name").agg(F.count("target_type").alias("n_columns"), F.sum("col_key").cast("long").alias("n_keys"))


@query("snapshot_bucketed", MERGE_HARD)
def snapshot_bucketed(spark, sf):
    """Only the change set is shuffled; the target stays in its buckets."""
    t, b = _tb(spark, sf)
    target = BucketedTable(spark, scratch(spark, "bucketed"), KEY, 8)
    target.commit(t)
    target.apply(lambda t, b: merge.merge_hard(t, b, KEY, null_safe=False), b, "cycle-1")
    return target.read()


@query("partitioned_target", plain("SELECT o_orderkey, o_totalprice, o_orderpriority, o_orderstatus FROM {orders}"))
def partitioned_target(spark, sf):
    folder = scratch(spark, "parts")
    by = evolve.partition_columns({"ord*": ["o_orderpriority", "o_orderstatus"], "*": []}, "orders")
    df = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority", "o_orderstatus")
    sink_files.write_partitioned(df, folder, by)
    return spark.read.schema(df.schema).parquet(folder)


@query("sliced_refresh", plain("SELECT o_orderkey, o_orderstatus, o_totalprice FROM {orders}"))
def sliced_refresh(spark, sf):
    """Three slices, one of them written twice."""
    df = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    target = SnapshotTable(spark, scratch(spark, "slices"))
    target.commit(empty_like(df), "create")
    for n, s in ((0, "F"), (1, "O"), (1, "O"), (2, "P")):
        target.write_slice(df.filter(F.col("o_orderstatus") == s), n, 3)
    return target.read()


@query("slices_done", plain("SELECT o_orderpriority AS job, count(DISTINCT o_orderstatus) AS n_done, 4 AS n_total, false AS finished FROM {orders} WHERE o_orderpriority <> '5-LOW' GROUP BY o_orderpriority UNION ALL SELECT '5-LOW', 1, 2, false"))
def slices_done_query(spark, sf):
    """State of one job per priority; job 5-LOW starts again with another total."""
    no = F.ascii("o_orderstatus").cast("int").alias("slice")
    state = table(spark, sf, "orders").select(F.col("o_orderpriority").alias("job"), no, F.lit(4).alias("total"), F.lit(1).alias("done")).distinct()
    out = slices_done(slice_state(state, "5-LOW", 0, 2))
    return out.select("job", "n_done", F.col("n_total").cast("int").alias("n_total"), "finished")


@query("convert_copy", plain("SELECT p_partkey, p_name FROM {part}"))
def convert_copy(spark, sf):
    folder = scratch(spark, "orc")
    name = sink_files.convert_copy(table(spark, sf, "part").select("p_partkey", "p_name"), folder.rsplit("/", 1)[1].replace("-", "_"), "_orc", path=folder)
    return spark.table(name)


@query("discard", plain("SELECT count(*) AS n_rows, 1 AS n_files FROM {orders}"))
def discard(spark, sf):
    df = table(spark, sf, "orders")
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_files", F.lit(sink_files.discard(df)))


# ---- streaming cycles

def _stage(spark, sf, sql, folder):
    """The rows of a fixture as staged files of bounded size, written by all tasks."""
    df = frame(spark, sf, sql)
    df.write.option("maxRecordsPerFile", 1_000_000).parquet(folder)
    return df.schema


@query("apply_stream", MERGE_HARD)
def apply_stream(spark, sf):
    """One cycle per staged file; each key occurs once over all files."""
    root = scratch(spark, "stream")
    schema = _stage(spark, sf, CHANGES, f"{root}/staged")
    target = SnapshotTable(spark, f"{root}/target")
    target.commit(frame(spark, sf, ORDERS))
    source = cycles.staged_stream(spark, f"{root}/staged", schema, max_files=1)
    spec = ApplySpec(keys=("o_orderkey",))
    cycles.apply_stream(source, target, spec, f"{root}/checkpoint", "orders").awaitTermination()
    return target.read()


@query("apply_replay", MERGE_HARD)
def apply_replay(spark, sf):
    """The stream's progress is lost after its commits; what is replayed changes nothing."""
    root = scratch(spark, "replay")
    schema = _stage(spark, sf, CHANGES, f"{root}/staged")
    target = SnapshotTable(spark, f"{root}/target")
    target.commit(frame(spark, sf, ORDERS))
    source = cycles.staged_stream(spark, f"{root}/staged", schema)
    spec = ApplySpec(keys=("o_orderkey",))
    for attempt in ("first", "again"):
        cycles.apply_stream(source, target, spec, f"{root}/{attempt}", "orders").awaitTermination()
    if target.version() != 2:
        raise AssertionError("a replayed cycle was committed again")
    return target.read()


@query("apply_stream_history", ctes(b=LOG) + f"SELECT {LCOLS}, op_type, row_seq FROM b")
def apply_stream_history(spark, sf):
    root = scratch(spark, "stream")
    schema = _stage(spark, sf, LOG, f"{root}/staged")
    target = SnapshotTable(spark, f"{root}/target")
    target.commit(empty_target(spark, schema))
    source = cycles.staged_stream(spark, f"{root}/staged", schema, max_files=1)
    spec = ApplySpec(keys=("o_orderkey",), style="history")
    cycles.apply_stream(source, target, spec, f"{root}/checkpoint", "log").awaitTermination()
    return target.read().select(*LCOLS.split(", "), "op_type", "row_seq")


@query("apply_streams", ctes(t=LOG_TARGET, b=LOG, c=CHANGES) + _LAST + f"""
SELECT 'orders' AS tbl, {LCOLS} FROM t WHERE NOT EXISTS (SELECT 1 FROM l WHERE l.o_orderkey = t.o_orderkey)
UNION ALL SELECT 'orders', {LCOLS} FROM l WHERE op_type <> 0
UNION ALL SELECT 'history', {LCOLS} FROM c""")
def apply_streams(spark, sf):
    """Two tables fed from one staging root, by a query each."""
    root = scratch(spark, "streams")
    spec = {"orders": ApplySpec(keys=("o_orderkey",), order=("file_seq", "row_seq")),
            "history": ApplySpec(keys=("o_orderkey",), style="history")}
    sources, tables, schemas = {}, {}, {}
    for name, rows in (("orders", LOG), ("history", CHANGES)):
        schemas[name] = _stage(spark, sf, rows, f"{root}/staged/{name}")
        sources[name] = cycles.staged_stream(spark, f"{root}/staged/{name}", schemas[name])
        tables[name] = SnapshotTable(spark, f"{root}/{name}")
    tables["orders"].commit(frame(spark, sf, LOG_TARGET))
    tables["history"].commit(empty_target(spark, schemas["history"]))
    for q in cycles.apply_streams(sources, tables, spec, f"{root}/checkpoint"):
        q.awaitTermination()
    cols = LCOLS.split(", ")
    return tables["orders"].read().select(F.lit("orders").alias("tbl"), *cols).unionAll(
        tables["history"].read().select(F.lit("history"), *cols))


N_TABLES = 50
_DEALT = f"SELECT concat('t', CAST(o_custkey % {N_TABLES} AS VARCHAR(20))) AS tbl, x.* FROM ({CHANGES}) x"


@query("apply_tables", ctes(b=_DEALT, t=ORDERS) + f"""
SELECT tbl, {COLS} FROM b WHERE tbl NOT IN ('t0', 't1')
UNION ALL SELECT concat('t', CAST(o_custkey % {N_TABLES} AS VARCHAR)), {COLS} FROM t WHERE o_custkey % {N_TABLES} < 2 AND NOT EXISTS (SELECT 1 FROM b WHERE b.o_orderkey = t.o_orderkey)
UNION ALL SELECT tbl, {COLS} FROM b WHERE tbl IN ('t0', 't1') AND op_type <> 0""")
def apply_tables(spark, sf):
    """Fifty tables in one query: two are merged, the others are histories."""
    root, cols = scratch(spark, "tables"), COLS.split(", ")
    dealt = frame(spark, sf, _DEALT.replace("VARCHAR(20)", "STRING"))
    dealt.repartition("tbl").write.partitionBy("tbl").parquet(f"{root}/staged")
    schema = dealt.drop("tbl").schema
    tables = {f"t{k}": SnapshotTable(spark, f"{root}/target/t{k}") for k in range(N_TABLES)}
    with ThreadPoolExecutor(8) as pool:
        first = [frame(spark, sf, ORDERS).filter(F.col("o_custkey") % N_TABLES == k) if k < 2 else empty_target(spark, schema) for k in range(N_TABLES)]
        list(pool.map(lambda t, rows: t.commit(rows), tables.values(), first))
    specs = {n: ApplySpec(keys=("o_orderkey",), style="replicate" if n in ("t0", "t1") else "history") for n in tables}
    files = cycles.staged_files(spark, f"{root}/staged", "/tbl=([^/]+)/")
    cycles.apply_tables(files, tables, specs, dict.fromkeys(tables, schema), f"{root}/checkpoint").awaitTermination()
    out = [t.read().select(F.lit(n).alias("tbl"), *cols) for n, t in tables.items()]
    return reduce(lambda a, b: a.unionAll(b), out)


@query("publish_stream", plain("SELECT event_id, CAST(user_id AS VARCHAR) AS partition_key FROM {events}"))
def publish_stream(spark, sf):
    from changemill.operators import messages

    root = scratch(spark, "publish")
    schema = _stage(spark, sf, "SELECT event_id, user_id, event_type, value FROM {events}", f"{root}/staged")
    source = cycles.staged_stream(spark, f"{root}/staged", schema, max_files=1)

    def reshape(df):
        return messages.partition_key(messages.to_envelope(df, "events", "cdc", "body"), ["user_id"])

    def sink(msgs, batch_id):
        sink_files.journal(msgs.withColumn("part", F.lit(0)), f"{root}/out", "c", "l", batch_id, ["part"], ["event_id"], "body")
        msgs.select("partition_key", "body").write.mode("overwrite").json(f"{root}/sent/cycle={batch_id}")

    cycles.publish_stream(source, reshape, sink, f"{root}/checkpoint").awaitTermination()
    sent = spark.read.schema("partition_key string, body string").json(f"{root}/sent")
    return sent.select(F.get_json_object("body", "$.columns.event_id").cast("bigint").alias("event_id"), "partition_key")


@query("integrate_soft", ctes(t=f"SELECT {COLS}, 0 AS is_deleted FROM ({ORDERS}) o", b=CHANGES) + f"""
SELECT {COLS}, is_deleted FROM t WHERE NOT EXISTS (SELECT 1 FROM b WHERE b.o_orderkey = t.o_orderkey)
UNION ALL SELECT {COLS}, is_deleted FROM b WHERE is_deleted = 0 OR EXISTS (SELECT 1 FROM t WHERE t.o_orderkey = b.o_orderkey)""")
def integrate_soft(spark, sf):
    t = frame(spark, sf, f"SELECT {COLS}, 0 AS is_deleted FROM ({ORDERS}) o")
    return integrate(t, frame(spark, sf, CHANGES), ApplySpec(keys=("o_orderkey",), style="soft_delete"))

