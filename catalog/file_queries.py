"""Reading staged files, routing and reconciling them. Files are written by the query from
the test tables into a fresh folder, and read back as a staging area."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.fixtures import FILES, ctes, frame, plain, scratch, table
from catalog.registry import query
from changemill.sources import files, routing

CUSTOMER = "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM {customer}"
C_SCHEMA = "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
C_TYPES = {"c_custkey": "bigint", "c_name": "string", "c_nationkey": "int", "c_acctbal": "double", "c_mktsegment": "string"}


@query("read_csv", plain(CUSTOMER))
def read_csv(spark, sf):
    folder = scratch(spark, "csv")
    frame(spark, sf, CUSTOMER).write.option("header", True).option("sep", ";").csv(folder)
    return files.read_csv(spark, folder, C_SCHEMA, sep=";")


@query("read_csv_mixed", plain(CUSTOMER + " UNION ALL " + CUSTOMER))
def read_csv_mixed(spark, sf):
    """One folder whose files have their columns in different order."""
    folder = scratch(spark, "csv")
    df = frame(spark, sf, CUSTOMER)
    df.write.option("header", True).csv(folder)
    df.select(*reversed(df.columns)).write.mode("append").option("header", True).csv(folder)
    return files.read_csv(spark, folder, C_SCHEMA)


@query("read_csv_noheader", plain("SELECT CAST(p_partkey AS VARCHAR) AS k, p_name AS n, CAST(p_size AS VARCHAR) AS s FROM {part}"))
def read_csv_noheader(spark, sf):
    folder = scratch(spark, "csv")
    table(spark, sf, "part").select("p_partkey", "p_name", "p_size").write.csv(folder)
    return files.read_csv_noheader(spark, folder, ["k", "n", "s"])


@query("read_csv_strict", plain("SELECT CAST(event_id AS VARCHAR) AS event_id, event_type, props FROM {events}"))
def read_csv_strict(spark, sf):
    folder = scratch(spark, "csv")
    df = table(spark, sf, "events").select("event_id", "event_type", "props")
    df.write.options(header=True, quoteAll=True, escape='"').csv(folder)
    return files.read_csv_strict(spark, folder, "event_id string, event_type string, props string")


@query("read_csv_by_header", plain("SELECT c_custkey, c_name, c_nationkey FROM {customer} UNION ALL SELECT s_suppkey, s_name, s_nationkey FROM {supplier}"))
def read_csv_by_header(spark, sf):
    """Two files with their columns in different order."""
    a, b = scratch(spark, "csv"), scratch(spark, "csv")
    table(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey").write.option("header", True).csv(a)
    other = table(spark, sf, "supplier").selectExpr("s_nationkey AS c_nationkey", "s_suppkey AS c_custkey", "s_name AS c_name")
    other.write.option("header", True).csv(b)
    return files.read_csv_by_header(spark, [a, b], {"c_custkey": "bigint", "c_name": "string", "c_nationkey": "int"})


@query("read_staged_parquet", plain(CUSTOMER))
def read_staged_parquet(spark, sf):
    return files.read_staged(spark, f"{sf}/customer.parquet").select(*C_TYPES)


@query("read_json_lines", plain("SELECT conv_id, turn, role, text FROM {conversations}"))
def read_json_lines(spark, sf):
    folder = scratch(spark, "json")
    table(spark, sf, "conversations").write.json(folder)
    return files.read_json_lines(spark, folder, "conv_id bigint, turn bigint, role string, text string")


@query("read_json_array", plain("SELECT conv_id, turn, role, text, row_number() OVER (PARTITION BY floor(conv_id / 20.0) ORDER BY conv_id, turn) - 1 AS pos FROM {conversations}"))
def read_json_array(spark, sf):
    """Array files keep the position of every row."""
    from changemill.operators.messages import rows_to_file_messages

    folder = scratch(spark, "json")
    rows = table(spark, sf, "conversations").withColumns({
        "value": F.to_json(F.struct("conv_id", "turn", "role", "text")),
        "file_no": F.floor(F.col("conv_id") / 20),
    })
    rows_to_file_messages(rows, ["file_no"], ["conv_id", "turn"]).write.partitionBy("file_no").text(folder)
    out = files.read_json_array(spark, folder, "conv_id bigint, turn bigint, role string, text string")
    return out.drop("file_name")


@query("read_whole_files", plain("SELECT event_type AS kind, count(*) AS n_lines FROM {events} GROUP BY event_type"))
def read_whole_files(spark, sf):
    folder = scratch(spark, "text")
    df = table(spark, sf, "events").select(F.col("event_id").cast("string").alias("value"), "event_type", F.pmod(F.xxhash64("event_id"), F.lit(16)).alias("part"))
    df.repartition("event_type", "part").write.partitionBy("event_type", "part").option("maxRecordsPerFile", 100_000).text(folder)
    out = files.read_whole_files(spark, folder)
    lines = out.select(
        F.regexp_extract("file_path", "event_type=([^/]*)/", 1).alias("kind"),
        (F.size(F.split("content", "\n")) - 1).cast("long").alias("n_lines"),
    )
    return lines.groupBy("kind").agg(F.sum("n_lines").alias("n_lines"))


@query("staged_view", plain(CUSTOMER))
def staged_view(spark, sf):
    folder = scratch(spark, "csv")
    frame(spark, sf, CUSTOMER).write.option("header", True).csv(folder)
    name = folder.rsplit("/", 1)[1].replace("-", "_")
    files.staged_view(spark, folder, C_TYPES, name)
    return spark.table(name)


@query("insert_from_file", plain("SELECT s_suppkey AS id, s_name AS name, s_nationkey AS nation FROM {supplier} UNION ALL SELECT c_custkey, c_name, NULL FROM {customer}"))
def insert_from_file(spark, sf):
    folder = scratch(spark, "csv")
    staged = table(spark, sf, "customer").selectExpr("c_acctbal AS junk", "c_name AS name", "c_custkey AS id")
    staged.write.option("header", True).csv(folder)
    t = table(spark, sf, "supplier").selectExpr("s_suppkey AS id", "s_name AS name", "s_nationkey AS nation")
    return files.insert_from_file(spark, t, folder, ["id", "name"])


@query("read_or_quarantine", plain("SELECT source, count(*) AS n_rows FROM (SELECT CASE WHEN o_orderstatus = 'P' THEN 'bad' ELSE 'good' END AS source FROM {orders}) x GROUP BY source"))
def read_or_quarantine(spark, sf):
    folder = scratch(spark, "json")
    body = F.to_json(F.struct("o_orderkey", "o_orderstatus"))
    lines = table(spark, sf, "orders").select(
        F.when(F.col("o_orderstatus") == "P", F.concat(F.lit("{broken "), "o_orderstatus")).otherwise(body).alias("value")
    )
    lines.write.text(folder)
    good, bad = files.read_or_quarantine(spark, folder, "o_orderkey bigint, o_orderstatus string")
    both = good.select(F.lit("good").alias("source")).unionAll(bad.select(F.lit("bad")))
    return both.groupBy("source").agg(F.count(F.lit(1)).alias("n_rows"))


_TEXT = """SELECT CAST(o_orderkey AS VARCHAR(20)) AS o_orderkey,
 CASE WHEN o_orderstatus = 'P' THEN 'n/a' ELSE CAST(o_custkey AS VARCHAR(20)) END AS o_custkey,
 CASE WHEN o_orderpriority = '5-LOW' THEN '' ELSE o_orderpriority END AS o_orderpriority,
 '1' AS op_type, o_orderstatus AS note FROM {orders}"""


@query("load_typed", ctes(x=_TEXT) + """
SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey, TRY_CAST(o_custkey AS BIGINT) AS o_custkey, o_orderpriority,
       CAST(op_type AS INTEGER) AS op_type, note, CAST(NULL AS DOUBLE) AS o_limit FROM x""")
def load_typed(spark, sf):
    types = {"o_orderkey": "bigint", "o_custkey": "bigint", "o_orderpriority": "string", "o_limit": "double"}
    return files.load_typed(frame(spark, sf, _TEXT), types, on_error="null", allow_missing=True)


@query("scalar_functions", ctes(x=_TEXT) + """
SELECT o_orderkey, coalesce(TRY_CAST(o_custkey AS DOUBLE), 0) AS as_double, nullif(o_orderpriority, '') AS filled,
       coalesce(CAST(TRY_CAST(o_custkey AS BIGINT) AS VARCHAR), o_custkey) AS int_or_text,
       concat(o_orderkey, '::', note) AS joined, concat('shop', '.', note) AS named, note AS bare,
       length(o_orderpriority) > 6 AS too_long, upper(o_orderpriority) AS up, lower(note) AS low FROM x""")
def scalar_functions(spark, sf):
    from changemill import functions as fn

    x = frame(spark, sf, _TEXT)
    named = fn.template("shop.{t}", {"t": F.col("note")})
    return x.select(
        "o_orderkey",
        fn.lenient_double(F.col("o_custkey")).alias("as_double"),
        fn.empty_to_null(F.col("o_orderpriority")).alias("filled"),
        fn.int_or_text(F.col("o_custkey")).alias("int_or_text"),
        fn.join_keys([F.col("o_orderkey"), F.col("note")], "::").alias("joined"),
        named.alias("named"),
        fn.strip_schema(named).alias("bare"),
        (F.length("o_orderpriority") > 6).alias("too_long"),
        F.upper("o_orderpriority").alias("up"),
        F.lower("note").alias("low"),
    )


# ---- routing

TABLES = "SELECT DISTINCT event_type AS tbl_name, concat('dw_', event_type) AS base_name FROM {events} WHERE event_type <> 'error'"
_TABLE = "regexp_replace(regexp_replace(file_name, '\\.csv$', ''), '^[^-]*-', '')"
_ROUTED = ctes(f=FILES, t=TABLES) + f", r AS (SELECT t.tbl_name, t.base_name, f.file_name, f.n_rows, f.size_bytes FROM f JOIN t ON t.tbl_name = {_TABLE})\n"


def _routed(spark, sf):
    return routing.route_files(frame(spark, sf, FILES), frame(spark, sf, TABLES))


@query("route_files", _ROUTED + "SELECT * FROM r")
def route_files(spark, sf):
    return _routed(spark, sf)


_LAST_DASH = "SELECT concat('a-b-', event_type, '.csv') AS file_name, event_id FROM {events} UNION ALL SELECT event_type, event_id FROM {events}"


@query("route_files_last_dash", ctes(f=_LAST_DASH, t=TABLES) + """
SELECT t.tbl_name, t.base_name, f.file_name, f.event_id FROM f JOIN t ON t.tbl_name = regexp_extract(regexp_replace(file_name, '\\.csv$', ''), '-([^-]*)$', 1)""")
def route_files_last_dash(spark, sf):
    return routing.route_files(frame(spark, sf, _LAST_DASH), frame(spark, sf, TABLES), split="last")


_EXPR = "SELECT concat('tranx/', CAST(event_id AS VARCHAR(20)), '_', event_type, '_', CAST(user_id AS VARCHAR(20)), '.csv') AS file_name FROM {events}"


@query("route_files_expression", ctes(f=_EXPR, t=TABLES) + """
SELECT t.tbl_name, t.base_name, f.file_name FROM f JOIN t ON t.tbl_name = regexp_extract(file_name, '^tranx/[0-9]+_([a-z]+)_', 1)""")
def route_files_expression(spark, sf):
    return routing.route_files(frame(spark, sf, _EXPR), frame(spark, sf, TABLES), expr="tranx/{stamp}_{tbl_name}_{tx_seq}.csv")


_FOLDER = "SELECT concat(event_type, '/part-', CAST(event_id AS VARCHAR(20)), '.orc') AS file_name FROM {events}"


@query("route_files_folder", ctes(f=_FOLDER, t=TABLES) + """
SELECT t.tbl_name, t.base_name, f.file_name FROM f JOIN t ON t.tbl_name = split_part(file_name, '/', 1)""")
def route_files_folder(spark, sf):
    return routing.route_files(frame(spark, sf, _FOLDER), frame(spark, sf, TABLES), by="folder")


@query("route_files_lower", ctes(f=FILES, t=TABLES) + f"""
SELECT upper(t.tbl_name) AS tbl_name, t.base_name, upper(f.file_name) AS file_name FROM f JOIN t ON t.tbl_name = {_TABLE}""")
def route_files_lower(spark, sf):
    f = frame(spark, sf, FILES).select(F.upper("file_name").alias("file_name"))
    t = frame(spark, sf, TABLES).select(F.upper("tbl_name").alias("tbl_name"), "base_name")
    return routing.route_files(f, t, lower=True)


@query("parse_file_name", ctes(f=_EXPR) + """
SELECT file_name, regexp_extract(file_name, '^tranx/([0-9]+)_', 1) AS stamp, regexp_extract(file_name, '_([a-z]+)_', 1) AS tbl_name,
       regexp_extract(file_name, '_([0-9]+)\\.csv$', 1) AS tx_seq FROM f""")
def parse_file_name(spark, sf):
    return routing.parse_file_name(frame(spark, sf, _EXPR), "tranx/{stamp}_{tbl_name}_{tx_seq}.csv")


@query("target_names", plain("SELECT DISTINCT event_type AS tbl_name, CASE WHEN event_type LIKE 'c%' THEN concat('map_', event_type) ELSE concat('dw_', event_type) END AS base_name FROM {events} WHERE event_type <> 'error'"))
def target_names(spark, sf):
    t = frame(spark, sf, TABLES)
    return routing.target_names(t, t.filter("tbl_name LIKE 'c%'").select("tbl_name", F.concat(F.lit("map_"), "tbl_name").alias("target")))


@query("unrouted_files", _ROUTED + "SELECT file_name, n_rows, size_bytes FROM f WHERE NOT EXISTS (SELECT 1 FROM r WHERE r.file_name = f.file_name)")
def unrouted_files(spark, sf):
    return routing.unrouted_files(frame(spark, sf, FILES), _routed(spark, sf))


@query("skip_tables", _ROUTED + "SELECT * FROM r WHERE tbl_name NOT IN ('click', 'view')")
def skip_tables(spark, sf):
    return routing.skip_tables(_routed(spark, sf), ["click", "view"])


@query("table_counts", _ROUTED + "SELECT tbl_name, count(*) AS n_files, CAST(sum(n_rows) AS BIGINT) AS n_rows FROM r GROUP BY tbl_name")
def table_counts(spark, sf):
    return routing.table_counts(_routed(spark, sf))


_DONE = "SELECT concat(CAST(event_id AS VARCHAR(20)), '-', event_type, '.csv') AS file_name FROM {events} WHERE value < 30"


@query("exclude_processed", ctes(f=FILES, d=_DONE) + "SELECT * FROM f WHERE NOT EXISTS (SELECT 1 FROM d WHERE d.file_name = f.file_name)")
def exclude_processed(spark, sf):
    return routing.exclude_processed(frame(spark, sf, FILES), frame(spark, sf, _DONE))


@query("limit_file_size", ctes(f=FILES) + "SELECT * FROM f WHERE size_bytes <= 100")
def limit_file_size(spark, sf):
    return routing.limit_file_size(frame(spark, sf, FILES), 100, "drop")


@query("oversize_files", ctes(f=FILES) + "SELECT * FROM f WHERE size_bytes > 100")
def oversize_files(spark, sf):
    return routing.oversize_files(frame(spark, sf, FILES), 100)


# one table per user and kind; cheap errors are missing, dear clicks lie there unlisted
_MANIFEST = "SELECT concat(event_type, CAST(user_id AS VARCHAR(20))) AS tbl_name, CAST(event_id AS VARCHAR(20)) AS file_name FROM {events} WHERE NOT (event_type = 'click' AND value > 60)"
_LISTING = "SELECT concat(event_type, CAST(user_id AS VARCHAR(20))) AS tbl_name, CAST(event_id AS VARCHAR(20)) AS file_name FROM {events} WHERE NOT (event_type = 'error' AND value < 30) AND event_type <> 'view'"


@query("reconcile", ctes(m=_MANIFEST, f=_LISTING) + """,
j AS (SELECT coalesce(m.tbl_name, f.tbl_name) AS tbl_name, m.file_name AS a, f.file_name AS b
      FROM m FULL OUTER JOIN f ON m.tbl_name = f.tbl_name AND m.file_name = f.file_name),
c AS (SELECT tbl_name, count(a) AS n_listed, count(CASE WHEN a IS NOT NULL THEN b END) AS n_found,
       count(CASE WHEN b IS NULL THEN a END) AS n_missing, count(CASE WHEN a IS NULL THEN b END) AS n_extra FROM j GROUP BY tbl_name)
SELECT *, CASE WHEN n_found = 0 THEN 'skip' WHEN n_missing > 0 THEN 'incomplete' ELSE 'ok' END AS status FROM c""")
def reconcile(spark, sf):
    return routing.reconcile(frame(spark, sf, _MANIFEST), frame(spark, sf, _LISTING))


@query("list_files", plain("SELECT DISTINCT event_type AS kind FROM {events}"))
def list_files(spark, sf):
    folder = scratch(spark, "list")
    table(spark, sf, "events").select("event_id", "event_type").write.partitionBy("event_type").parquet(folder)
    found = files.list_files(spark, folder, "*.parquet")
    return found.select(F.regexp_extract("file_path", "event_type=([^/]*)/", 1).alias("kind")).distinct()


@query("with_provenance", plain("SELECT n_nationkey, n_name, 'nation.parquet' AS file_name FROM {nation}"))
def with_provenance(spark, sf):
    return files.with_provenance(table(spark, sf, "nation")).select("n_nationkey", "n_name", "file_name")
