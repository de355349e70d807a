"""Images, transactions, envelopes, destinations and batches."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.fixtures import FILES, PAIRS, PAIRS_BROKEN, TX, ctes, frame, plain, scratch, table
from catalog.registry import query
from changemill.operators import images, messages, packing
from changemill.operators.ordering import with_position
from changemill.plans.publish import PublishSpec, publish_plan
from changemill.sinks import files as sink_files
from changemill.sources.files import read_whole_files

ORDER, GROUP = ["event_id", "row_seq"], ["user_id"]

_LAGGED = ctes(p=PAIRS) + """,
q AS (SELECT *, lag(op_type) OVER w AS b_op, lag(value) OVER w AS b_value, lag(event_type) OVER w AS b_type
      FROM p WINDOW w AS (PARTITION BY user_id ORDER BY event_id, row_seq)),
r AS (SELECT *, b_op = 4 AS hit, CASE WHEN b_op = 4 AND b_value IS DISTINCT FROM value THEN 'value' ELSE '' END AS changed
      FROM q WHERE op_type <> 4)
"""


def _collapsed(spark, sf, mode, **kw):
    df = images.collapse_updates(frame(spark, sf, PAIRS), ORDER, GROUP, mode=mode, prefix="Old&", **kw)
    return df.withColumns({
        "paired": F.col("changed_cols").isNotNull(),
        "changed": F.coalesce(F.array_join("changed_cols", ","), F.lit("")),
    }).drop("changed_cols")


@query("collapse_changed", _LAGGED + """
SELECT user_id, event_id, row_seq, op_type, value, event_type, coalesce(hit, false) AS paired, changed,
       CASE WHEN changed <> '' THEN b_value END AS "Old&value", CAST(NULL AS VARCHAR) AS "Old&event_type" FROM r""")
def collapse_changed(spark, sf):
    return _collapsed(spark, sf, "changed")


@query("collapse_all", _LAGGED + """
SELECT user_id, event_id, row_seq, op_type, value, event_type, coalesce(hit, false) AS paired, changed,
       CASE WHEN hit THEN b_value END AS "Old&value", CASE WHEN hit THEN b_type END AS "Old&event_type" FROM r""")
def collapse_all(spark, sf):
    return _collapsed(spark, sf, "all")


@query("discard_unchanged", _LAGGED + "SELECT event_id, op_type, value FROM r WHERE NOT coalesce(hit, false) OR changed <> ''")
def discard_unchanged(spark, sf):
    df = images.collapse_updates(frame(spark, sf, PAIRS), ORDER, GROUP)
    return images.discard_unchanged(df).select("event_id", "op_type", "value")


@query("collapse_ignored_columns", _LAGGED + """
SELECT event_id, op_type, coalesce(hit, false) AS paired, CASE WHEN hit THEN b_type END AS "Old&event_type" FROM r""")
def collapse_ignored_columns(spark, sf):
    out = _collapsed(spark, sf, "all", ignore=["value"])
    return out.select("event_id", "op_type", "paired", "Old&event_type")


@query("pair_violations", ctes(p=PAIRS_BROKEN) + """,
q AS (SELECT *, lead(op_type) OVER (PARTITION BY user_id ORDER BY event_id, row_seq) AS next_op FROM p)
SELECT user_id, event_id, op_type, value, next_op FROM q WHERE op_type = 4 AND next_op IS DISTINCT FROM 2""")
def pair_violations(spark, sf):
    bad = images.check_pairs(frame(spark, sf, PAIRS_BROKEN), ORDER, GROUP)
    return bad.select("user_id", "event_id", "op_type", "value", "next_op")


@query("collapsed_json", _LAGGED + """
SELECT event_id, value, event_type, CASE WHEN changed <> '' THEN b_value END AS old_value, changed <> '' AS has_old FROM r""")
def collapsed_json(spark, sf):
    df = images.collapse_updates(frame(spark, sf, PAIRS), ORDER, GROUP)
    text = images.collapsed_json(df, ["event_id", "value", "event_type"], value_col="body")
    row = F.from_json("body", "event_id bigint, value double, event_type string, `Old&value` double")
    return text.select(
        row["event_id"].alias("event_id"), row["value"].alias("value"), row["event_type"].alias("event_type"),
        row["Old&value"].alias("old_value"), F.contains("body", F.lit('"Old&value"')).alias("has_old"),
    )


@query("row_positions", plain("SELECT event_id, row_number() OVER (ORDER BY user_id, event_id) - 1 AS pos FROM {events}"))
def row_positions(spark, sf):
    return with_position(table(spark, sf, "events").select("user_id", "event_id"), ["user_id", "event_id"]).select("event_id", "pos")


# ---- transactions

_HEX_VALUE = """CASE WHEN regexp_full_match({0}, '[0-9a-fA-F]{{1,16}}') THEN CAST(concat('0x', {0}) AS BIGINT) ELSE 0 END"""


@query("tx_partition", ctes(x=TX) + f""",
y AS (SELECT event_id, CASE WHEN length(tx_seq) = 24 THEN substring(tx_seq, 5, 16) ELSE tx_seq END AS s, substring(integ_seq, 5, 16) AS i FROM x)
SELECT event_id, CAST({_HEX_VALUE.format('s')} % 4 AS INTEGER) AS by_tx, CAST({_HEX_VALUE.format('i')} % 4 AS INTEGER) AS by_integ FROM y""")
def tx_partition(spark, sf):
    df = messages.tx_partition(frame(spark, sf, TX), 4, "tx_seq", name="by_tx")
    return messages.tx_partition(df, 4, "tx_seq", "integ_seq", name="by_integ").select("event_id", "by_tx", "by_integ")


@query("tx_id", ctes(x=TX) + f"""
SELECT event_id, CAST({_HEX_VALUE.format('substring(integ_seq, 5, 16)')} AS BIGINT) AS tx FROM x""")
def tx_id(spark, sf):
    return frame(spark, sf, TX).select("event_id", messages.tx_id(F.col("integ_seq")).cast("bigint").alias("tx"))


_ENDS = ctes(x=TX) + """,
y AS (SELECT *, CAST(user_id % 4 AS INTEGER) AS partition_id FROM x)
SELECT event_id, user_id, partition_id,
       CASE WHEN row_number() OVER (PARTITION BY partition_id, user_id ORDER BY event_id DESC) = 1 THEN 1 ELSE 0 END AS tx_end FROM y"""


@query("mark_tx_end", _ENDS)
def mark_tx_end(spark, sf):
    df = messages.tx_partition(frame(spark, sf, TX), 4, integ_col="integ_seq")
    out = images.mark_tx_end(df, ["user_id"], ["event_id"], partition=["partition_id"])
    return out.select("event_id", "user_id", "partition_id", "tx_end")


@query("discard_keeps_tx_end", _LAGGED + """,
e AS (SELECT *, CASE WHEN row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC, row_seq DESC) = 1 THEN 1 ELSE 0 END AS tx_end FROM r)
SELECT event_id, op_type, tx_end FROM e WHERE NOT coalesce(hit, false) OR changed <> '' OR tx_end = 1""")
def discard_keeps_tx_end(spark, sf):
    df = images.collapse_updates(frame(spark, sf, PAIRS), ORDER, GROUP)
    df = images.mark_tx_end(df, GROUP, ORDER)
    return images.discard_unchanged(df, keep_col="tx_end").select("event_id", "op_type", "tx_end")


# ---- envelope and destination

_CHANGED = "SELECT event_id, user_id, event_type, value, CAST(2 AS INT) AS op_type, ts AS op_timestamp FROM {events}"


@query("envelope", plain("""SELECT event_id, event_type, value, 2 AS op_type, 'events' AS tablename, false AS op_inside, true AS has_stamp FROM {events}"""))
def envelope(spark, sf):
    df = messages.to_envelope(frame(spark, sf, _CHANGED), "events", "cdc-events")
    row = F.from_json("value_json", "columns struct<event_id:bigint,event_type:string,value:double>, op_type int, op_timestamp string, tablename string")
    return df.withColumnRenamed("value", "value_json").select(row.alias("r"), "value_json").select(
        F.col("r.columns.event_id"), F.col("r.columns.event_type"), F.col("r.columns.value"), F.col("r.op_type"), F.col("r.tablename"),
        F.get_json_object("value_json", "$.columns.op_type").isNotNull().alias("op_inside"),
        F.col("r.op_timestamp").isNotNull().alias("has_stamp"),
    )


@query("envelope_own_stream", plain("SELECT c_custkey, c_name, false AS has_table FROM {customer}"))
def envelope_own_stream(spark, sf):
    df = messages.to_envelope(table(spark, sf, "customer").select("c_custkey", "c_name"), "customer", "customer")
    return df.select("c_custkey", "c_name", F.get_json_object("value", "$.tablename").isNotNull().alias("has_table"))


@query("partition_key", plain("""SELECT event_id, concat(CAST(user_id AS VARCHAR), '|', event_type) AS by_keys,
concat(CAST(event_id AS VARCHAR), '|Undefined|Undefined') AS with_unknown FROM {events}"""))
def partition_key(spark, sf):
    df = messages.partition_key(frame(spark, sf, _CHANGED), ["user_id", "event_type"], "by_keys")
    # metadata columns are no longer in the row when the key is made
    df = messages.partition_key(df, ["event_id", "op_type", "nothing"], "with_unknown")
    return df.select("event_id", "by_keys", "with_unknown")


@query("destination", plain("SELECT event_id, concat('cdc-', event_type) AS dest FROM {events}"))
def destination(spark, sf):
    df = table(spark, sf, "events").select("event_id", F.concat(F.lit("app."), "event_type").alias("tbl"))
    return messages.destination(df, "cdc-{tbl_name}", F.col("tbl")).select("event_id", "dest")


_NAMES = "SELECT concat('tx/', CAST(event_id AS VARCHAR(20)), '_', event_type, '_', CAST(user_id AS VARCHAR(20)), '.json') AS file_name, event_type, user_id, event_id FROM {events}"


@query("destination_from_file", ctes(n=_NAMES) + "SELECT file_name, concat('hub-prod-', event_type, '-', CAST(user_id AS VARCHAR)) AS dest FROM n")
def destination_from_file(spark, sf):
    df = frame(spark, sf, _NAMES).select("file_name")
    return messages.destination_from_file(df, "tx/{stamp}_{tbl_name}_{tx_seq}.json", "hub-{chn_name}-{tbl_name}-{tx_seq}", chn_name="prod")


@query("publish_counts", plain("SELECT role, count(*) AS n_messages, CAST(sum(strlen(text)) AS BIGINT) AS n_bytes FROM {conversations} GROUP BY role"))
def publish_counts(spark, sf):
    return messages.publish_counts(table(spark, sf, "conversations"), ["role"], "text")


@query("files_by_destination", ctes(f=FILES) + """
SELECT concat('cdc-', regexp_extract(file_name, '-([^.]*)', 1)) AS dest, count(*) AS n_files, CAST(sum(size_bytes) AS BIGINT) AS n_bytes,
       min(file_name) AS first_file, max(file_name) AS last_file FROM f GROUP BY ALL""")
def files_by_destination(spark, sf):
    df = messages.destination_from_file(frame(spark, sf, FILES), "{stamp}-{tbl_name}.csv", "cdc-{tbl_name}")
    return messages.files_by_destination(df)


@query("size_violations", plain("SELECT doc_id, CAST(strlen(text) AS BIGINT) AS n_bytes FROM {documents} WHERE strlen(text) > 4000"))
def size_violations(spark, sf):
    return messages.size_violations(table(spark, sf, "documents"), 4000, "text").select("doc_id", "n_bytes")


@query("check_message_size", plain("SELECT page_id, strlen(html) AS n FROM {pages}"))
def check_message_size(spark, sf):
    return messages.check_message_size(table(spark, sf, "pages"), value_col="html").select(
        "page_id", F.octet_length("html").cast("long").alias("n")
    )


# ---- batches

_PACK_SQL = plain("""
WITH RECURSIVE m AS (SELECT lang, doc_id, CAST(strlen(text) AS BIGINT) AS n,
  row_number() OVER (PARTITION BY lang ORDER BY doc_id) AS i FROM {documents}),
g AS (SELECT lang, doc_id, n, i, n AS used, CAST(0 AS BIGINT) AS batch_no FROM m WHERE i = 1
      UNION ALL
      SELECT m.lang, m.doc_id, m.n, m.i, CASE WHEN g.used + m.n > 100000 THEN m.n ELSE g.used + m.n END,
             g.batch_no + CASE WHEN g.used + m.n > 100000 THEN 1 ELSE 0 END
      FROM g JOIN m ON m.lang = g.lang AND m.i = g.i + 1)
SELECT lang, doc_id, batch_no FROM g""")


@query("pack_batches", _PACK_SQL)
def pack_batches(spark, sf):
    docs = table(spark, sf, "documents").select("lang", "doc_id", "text")
    return packing.pack_batches(docs, ["doc_id"], ["lang"], 100_000, "text").select("lang", "doc_id", "batch_no")


@query("batch_totals", _PACK_SQL.replace("SELECT lang, doc_id, batch_no FROM g", "SELECT lang, batch_no, count(*) AS n_messages, CAST(sum(n) AS BIGINT) AS n_bytes FROM g GROUP BY lang, batch_no"))
def batch_totals(spark, sf):
    docs = table(spark, sf, "documents").select("lang", "doc_id", "text")
    packed = packing.pack_batches(docs, ["doc_id"], ["lang"], 100_000, "text", chunks=5)
    return packing.batch_totals(packed, ["lang"], "text")


@query("whole_file_messages", plain("SELECT CAST(floor(conv_id / 20.0) AS BIGINT) AS file_no, count(*) AS n_turns, max(conv_id) AS last_conv FROM {conversations} GROUP BY ALL"))
def whole_file_messages(spark, sf):
    """One message per file, the files written from the conversations."""
    folder = scratch(spark, "messages")
    turns = table(spark, sf, "conversations").select(
        F.floor(F.col("conv_id") / 20).alias("file_no"), "conv_id", "turn",
        F.to_json(F.struct("conv_id", "turn", "role")).alias("value"),
    )
    arrays = messages.rows_to_file_messages(turns, ["file_no"], ["conv_id", "turn"])
    arrays.write.partitionBy("file_no").text(folder)
    sent = messages.files_to_messages(read_whole_files(spark, folder))
    rows = F.from_json("value", "array<struct<conv_id:bigint,turn:bigint>>")
    return sent.withColumn("rows", rows).select(
        F.floor(F.col("rows")[0]["conv_id"] / 20).alias("file_no"),
        F.size("rows").cast("long").alias("n_turns"),
        F.element_at("rows", -1)["conv_id"].alias("last_conv"),
    )


# files of ten events of one user, with positions; the user is the transaction
_FILED = f"""SELECT user_id, CAST(floor(event_id / 1000.0) AS BIGINT) AS file_no, event_id, op_type, value, event_type, 0 AS tx_end,
 concat('0000', lpad(lower(hex(user_id)), 16, '0'), '0000') AS tx,
 row_number() OVER (PARTITION BY user_id, CAST(floor(event_id / 1000.0) AS BIGINT) ORDER BY event_id, row_seq) - 1 AS pos FROM ({PAIRS}) p"""


@query("publish_cycle", ctes(p=_FILED) + """,
q AS (SELECT *, lag(op_type) OVER w AS b_op, lag(value) OVER w AS b_value FROM p WINDOW w AS (PARTITION BY user_id, file_no ORDER BY pos)),
r AS (SELECT *, b_op = 4 AND b_value IS DISTINCT FROM value AS changed, b_op = 4 AND b_value IS NOT DISTINCT FROM value AS same,
        row_number() OVER (PARTITION BY user_id ORDER BY file_no DESC, pos DESC) = 1 AS last FROM q WHERE op_type <> 4)
SELECT user_id, file_no, CAST(user_id % 3 AS INTEGER) AS partition_id, count(*) AS n_rows, min(event_id) AS first_event,
       CAST(sum(CASE WHEN changed THEN 1 ELSE 0 END) AS BIGINT) AS n_old, CAST(sum(CASE WHEN last THEN 1 ELSE 0 END) AS BIGINT) AS n_ends
FROM r WHERE NOT coalesce(same, false) OR last GROUP BY ALL""")
def publish_cycle(spark, sf):
    """Collapse, discard, mark, partition, one message per file, batches."""
    spec = PublishSpec(
        columns=("event_id", "op_type", "value", "event_type", "tx_end"), file_cols=("user_id", "file_no"),
        file_order=("file_no", "user_id"), discard=True, tx_col="tx", partitions=3, end_col="tx_end",
    )
    sent = publish_plan(frame(spark, sf, _FILED), spec)
    rows = F.from_json("value", "array<struct<event_id:bigint,tx_end:int,`Old&value`:double>>")
    hits = lambda test: F.size(F.filter("rows", test)).cast("long")
    return sent.withColumn("rows", rows).select(
        "user_id", "file_no", "partition_id", F.size("rows").cast("long").alias("n_rows"),
        F.col("rows")[0]["event_id"].alias("first_event"),
        hits(lambda x: x["Old&value"].isNotNull()).alias("n_old"), hits(lambda x: x["tx_end"] == 1).alias("n_ends"),
    )


@query("journal", plain("SELECT lang, doc_id, row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS sequence FROM {documents}"))
def journal(spark, sf):
    """Messages kept by batch in the order of sending, read back with their sequence."""
    folder = scratch(spark, "journal")
    docs = table(spark, sf, "documents").select("lang", "doc_id", F.to_json(F.struct("doc_id")).alias("value"))
    sink_files.journal(docs, folder, "chan", "loc", 7, by=["lang"], order=["doc_id"])
    kept = spark.read.schema("sequence bigint, value string, lang string").json(f"{folder}/chan/loc/cycle=00000007")
    return kept.select("lang", F.get_json_object("value", "$.doc_id").cast("bigint").alias("doc_id"), "sequence")


@query("publish_files", plain("SELECT role, conv_id, turn, text FROM {conversations}"))
def publish_files(spark, sf):
    folder = scratch(spark, "publish")
    msgs = table(spark, sf, "conversations")
    sink_files.write_messages(msgs, folder, ["role"], ["conv_id", "turn"], batch_id=3)
    return spark.read.schema("conv_id bigint, turn bigint, text string, role string").json(f"{folder}/cycle=00000003")
