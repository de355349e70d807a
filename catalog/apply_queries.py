"""Merges, partial deletes, keyed upserts, coalescing and refreshes."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.fixtures import (
    BAG,
    BAG_CHANGES,
    BAG_ORDER_CHANGES,
    BAG_ORDERS,
    CHANGES,
    CHANGES_KEY,
    CHANGES_NULL,
    LINE_DELETES,
    LINE_FLAGS,
    LINES,
    LOG,
    LOG_TARGET,
    ORDER_COLS,
    ORDER_LINES,
    ORDERS,
    ORDERS_NULL,
    ctes,
    frame,
    plain,
    scratch,
    table,
)
from catalog.registry import query
from changemill.operators import changes, keyed, merge, partial
from changemill.operators.joins import align
from changemill.plans import integrate as plans
from changemill.plans import refresh
from changemill.sinks.files import write_touched
from changemill.spec import ApplySpec

KEY = ["o_orderkey"]
COLS = ORDER_COLS
TB = ctes(t=ORDERS, b=CHANGES)
NCOLS = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority"
LCOLS = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority"


def _tb(spark, sf):
    return frame(spark, sf, ORDERS), frame(spark, sf, CHANGES)


def _anti(src, other, keys=("o_orderkey",), op="="):
    test = " AND ".join(f"{src}.{k} {op} {other}.{k}" for k in keys)
    return f"NOT EXISTS (SELECT 1 FROM {other} WHERE {test})"


# ---- hard delete

MERGE_HARD = TB + f"""SELECT {COLS} FROM t WHERE {_anti('t', 'b')}
UNION ALL SELECT {COLS} FROM b WHERE op_type <> 0"""


@query("merge_hard", MERGE_HARD)
def merge_hard(spark, sf):
    t, b = _tb(spark, sf)
    return merge.merge_hard(t, b, KEY)


@query("merge_hard_full_form", MERGE_HARD)
def merge_hard_full_form(spark, sf):
    """In-place form, as for targets whose key may repeat."""
    t, b = _tb(spark, sf)
    return merge.merge_hard(t, b, KEY, unique_keys=False)


_NS = " AND ".join(f"t.{k} IS NOT DISTINCT FROM b.{k}" for k in ("o_orderkey", "o_orderpriority"))


NULL_KEY = ["o_orderkey", "o_orderpriority"]
MERGE_HARD_NULL = ctes(t=ORDERS_NULL, b=CHANGES_NULL) + f"""
SELECT {NCOLS} FROM t WHERE NOT EXISTS (SELECT 1 FROM b WHERE {_NS})
UNION ALL SELECT {NCOLS} FROM b WHERE op_type <> 0"""


@query("merge_hard_nullkeys", MERGE_HARD_NULL)
def merge_hard_nullkeys(spark, sf):
    t, b = frame(spark, sf, ORDERS_NULL), frame(spark, sf, CHANGES_NULL)
    return merge.merge_hard(t, b, ["o_orderkey", "o_orderpriority"])


@query("merge_plain_nullkeys", ctes(t=ORDERS_NULL, b=CHANGES_NULL) + f"""
SELECT {NCOLS} FROM t WHERE {_anti('t', 'b', ('o_orderkey', 'o_orderpriority'))}
UNION ALL SELECT {NCOLS} FROM b WHERE op_type <> 0""")
def merge_plain_nullkeys(spark, sf):
    t, b = frame(spark, sf, ORDERS_NULL), frame(spark, sf, CHANGES_NULL)
    return merge.merge_plain(t, b, ["o_orderkey", "o_orderpriority"])


@query("merge_hard_dup_targets", ctes(t=BAG, b=BAG_CHANGES) + """
SELECT t.l_orderkey, t.l_linenumber, t.l_quantity, t.is_deleted FROM t
LEFT JOIN b ON t.l_orderkey = b.l_orderkey AND t.l_linenumber = b.l_linenumber AND b.op_type = 0
WHERE b.l_orderkey IS NULL
UNION ALL SELECT l_orderkey, l_linenumber, l_quantity, is_deleted FROM b WHERE op_type <> 0""")
def merge_hard_dup_targets(spark, sf):
    t, b = frame(spark, sf, BAG), frame(spark, sf, BAG_CHANGES)
    return merge.merge_hard(t, b, ["l_orderkey", "l_linenumber"], unique_keys=False)


@query("merge_key_change", ctes(t=ORDERS, b=CHANGES_KEY) + f"""
SELECT {COLS} FROM t WHERE {_anti('t', 'b')} UNION ALL SELECT {COLS} FROM b WHERE op_type <> 0""")
def merge_key_change(spark, sf):
    return merge.merge_key_change(frame(spark, sf, ORDERS), frame(spark, sf, CHANGES_KEY), KEY)


@query("merge_then_insert", TB + f"""
SELECT {COLS} FROM t WHERE {_anti('t', 'b')}
UNION ALL SELECT {COLS} FROM b WHERE op_type = 2 AND EXISTS (SELECT 1 FROM t WHERE t.o_orderkey = b.o_orderkey)
UNION ALL SELECT {COLS} FROM b WHERE op_type = 1""")
def merge_then_insert(spark, sf):
    t, b = _tb(spark, sf)
    return merge.merge_then_insert(t, b, KEY)


# ---- soft delete

_SOFT_T = f"SELECT {COLS}, 0 AS is_deleted FROM ({ORDERS}) o"
_SOFT = ctes(t=_SOFT_T, b=CHANGES_KEY) + f""",
p1 AS (SELECT t.o_orderkey,
  CASE WHEN b.o_orderkey IS NULL THEN t.o_orderstatus ELSE b.o_orderstatus END AS o_orderstatus,
  CASE WHEN b.o_orderkey IS NULL THEN t.o_totalprice ELSE b.o_totalprice END AS o_totalprice,
  CASE WHEN b.o_orderkey IS NULL THEN t.is_deleted ELSE b.is_deleted END AS is_deleted,
  t.o_custkey, t.o_orderdate, t.o_orderpriority
  FROM t LEFT JOIN (SELECT * FROM b WHERE is_deleted = 1) b ON t.o_orderkey = b.o_orderkey)
SELECT {COLS}, is_deleted FROM p1 WHERE NOT EXISTS (SELECT 1 FROM b WHERE b.is_deleted = 0 AND b.o_orderkey = p1.o_orderkey)
UNION ALL SELECT {COLS}, is_deleted FROM b WHERE is_deleted = 0"""


@query("merge_soft", _SOFT)
def merge_soft(spark, sf):
    return merge.merge_soft(frame(spark, sf, _SOFT_T), frame(spark, sf, CHANGES_KEY), KEY)


_NOKEY = ctes(t=BAG, b=BAG_CHANGES) + """
SELECT t.l_orderkey, t.l_linenumber, CASE WHEN b.l_orderkey IS NULL THEN t.l_quantity ELSE b.l_quantity END AS l_quantity,
       CASE WHEN b.l_orderkey IS NULL THEN t.is_deleted ELSE b.is_deleted END AS is_deleted
FROM t LEFT JOIN (SELECT * FROM b WHERE op_type = 0) b ON t.l_orderkey = b.l_orderkey AND t.l_linenumber = b.l_linenumber
UNION ALL SELECT l_orderkey, l_linenumber, l_quantity, is_deleted FROM b WHERE op_type = 1"""


@query("merge_soft_nokey", _NOKEY)
def merge_soft_nokey(spark, sf):
    t, b = frame(spark, sf, BAG), frame(spark, sf, BAG_CHANGES)
    return merge.merge_soft_nokey(t, b, ["l_orderkey", "l_linenumber"])


@query("merge_soft_nokey_plain", _NOKEY)
def merge_soft_nokey_plain(spark, sf):
    """Change rows repeat: equal ones must not multiply target rows."""
    t, b = frame(spark, sf, BAG), frame(spark, sf, BAG_CHANGES)
    b = b.unionAll(b.filter("op_type = 0"))
    return merge.merge_soft_nokey(t, b, ["l_orderkey", "l_linenumber"], null_safe=False)


# ---- history

@query("append_history", TB + f"SELECT {COLS}, 3 AS op_type, 0 AS is_deleted FROM t UNION ALL SELECT {COLS}, op_type, is_deleted FROM b")
def append_history(spark, sf):
    t, b = _tb(spark, sf)
    return plans.append_history(t.withColumns({"op_type": F.lit(3), "is_deleted": F.lit(0)}), b)


@query("merge_history", TB + f"SELECT {COLS} FROM t UNION ALL SELECT {COLS} FROM b WHERE {_anti('b', 't')}")
def merge_history(spark, sf):
    t, b = _tb(spark, sf)
    return merge.merge_history(t, b, KEY)


# ---- deletes with an incomplete key, truncate markers

_LK, _LU = ["l_orderkey", "l_linenumber"], ["l_linenumber"]


@query("multi_delete_hard", ctes(t=LINES, b=LINE_DELETES) + f"SELECT l_orderkey, l_linenumber, l_quantity, is_deleted FROM t WHERE {_anti('t', 'b', ('l_orderkey',))}")
def multi_delete_hard(spark, sf):
    return partial.multi_delete_hard(frame(spark, sf, LINES), frame(spark, sf, LINE_DELETES), _LK, _LU)


@query("multi_delete_soft", ctes(t=LINES, b=LINE_DELETES) + """
SELECT t.l_orderkey, t.l_linenumber, CASE WHEN b.l_orderkey IS NULL THEN t.l_quantity END AS l_quantity,
       CASE WHEN b.l_orderkey IS NULL THEN t.is_deleted ELSE 1 END AS is_deleted
FROM t LEFT JOIN b ON t.l_orderkey = b.l_orderkey""")
def multi_delete_soft(spark, sf):
    return partial.multi_delete_soft(frame(spark, sf, LINES), frame(spark, sf, LINE_DELETES), _LK, _LU)


@query("multi_delete_soft_whole_row", ctes(t=LINES, b=LINE_DELETES) + """
SELECT t.l_orderkey, CASE WHEN b.l_orderkey IS NULL THEN t.l_linenumber END AS l_linenumber,
       CASE WHEN b.l_orderkey IS NULL THEN t.l_quantity END AS l_quantity,
       CASE WHEN b.l_orderkey IS NULL THEN t.is_deleted ELSE 1 END AS is_deleted
FROM t LEFT JOIN b ON t.l_orderkey = b.l_orderkey""")
def multi_delete_soft_whole_row(spark, sf):
    return partial.multi_delete_soft(
        frame(spark, sf, LINES), frame(spark, sf, LINE_DELETES), _LK, _LU, keep_unused_keys=False
    )


@query("multi_delete_flag", ctes(t=LINES, b=LINE_FLAGS) + """
SELECT t.l_orderkey, t.l_linenumber, t.l_quantity, CASE WHEN b.l_orderkey IS NULL THEN t.is_deleted ELSE 1 END AS is_deleted
FROM t LEFT JOIN b ON t.l_orderkey = b.l_orderkey""")
def multi_delete_flag(spark, sf):
    return partial.multi_delete_flag(frame(spark, sf, LINES), frame(spark, sf, LINE_FLAGS), _LK, _LU)


# the dearest order carries the marker, so the set always holds one
_TRUNC = f"""SELECT {COLS}, op_type, is_deleted FROM ({CHANGES}) c
UNION ALL SELECT {COLS}, 5, 0 FROM {{orders}} WHERE o_totalprice = (SELECT max(o_totalprice) FROM {{orders}})"""


@query("truncate_marker", ctes(b=_TRUNC) + f"SELECT {COLS} FROM b WHERE op_type NOT IN (0, 5)")
def truncate_marker(spark, sf):
    t, b = frame(spark, sf, ORDERS), frame(spark, sf, _TRUNC)
    return merge.merge_hard(partial.apply_truncate(t, b), b, KEY)


@query("truncate_marker_absent", MERGE_HARD_NULL)
def truncate_marker_absent(spark, sf):
    t, b = frame(spark, sf, ORDERS_NULL), frame(spark, sf, CHANGES_NULL)
    return merge.merge_hard(partial.apply_truncate(t, b), b, NULL_KEY)


# ---- other statement forms

@query("apply_three_step", TB + f""",
d AS (SELECT * FROM t WHERE NOT EXISTS (SELECT 1 FROM b WHERE op_type = 0 AND b.o_orderkey = t.o_orderkey))
SELECT d.o_orderkey, coalesce(u.o_custkey, d.o_custkey) AS o_custkey, coalesce(u.o_orderstatus, d.o_orderstatus) AS o_orderstatus,
       coalesce(u.o_totalprice, d.o_totalprice) AS o_totalprice, coalesce(u.o_orderdate, d.o_orderdate) AS o_orderdate,
       coalesce(u.o_orderpriority, d.o_orderpriority) AS o_orderpriority
FROM d LEFT JOIN (SELECT * FROM b WHERE op_type = 2) u ON d.o_orderkey = u.o_orderkey
UNION ALL SELECT {COLS} FROM b WHERE op_type = 1""")
def apply_three_step(spark, sf):
    t, b = _tb(spark, sf)
    return merge.apply_three_step(t, b, KEY)


_SOFT_CHANGES = f"SELECT {COLS}, is_deleted FROM ({CHANGES}) c"


@query("apply_update_insert", ctes(t=_SOFT_T, b=_SOFT_CHANGES) + f"""
SELECT {COLS}, is_deleted FROM t WHERE {_anti('t', 'b')} UNION ALL SELECT {COLS}, is_deleted FROM b""")
def apply_update_insert(spark, sf):
    return merge.apply_update_insert(frame(spark, sf, _SOFT_T), frame(spark, sf, _SOFT_CHANGES), KEY)


#: Deletes that name only the first key part, updates and inserts.
_LINE_MIX = """SELECT DISTINCT o_custkey AS l_orderkey, CAST(NULL AS BIGINT) AS l_linenumber, CAST(NULL AS DOUBLE) AS l_quantity, 0 AS op_type, 1 AS is_deleted
FROM {orders} WHERE o_orderstatus = 'F' AND o_orderpriority = '5-LOW'
UNION ALL SELECT o_custkey, o_orderkey, o_totalprice + 1, 2, 0 FROM {orders} WHERE o_orderstatus = 'O'
UNION ALL SELECT o_custkey + 10000000, o_orderkey, o_totalprice, 1, 0 FROM {orders} WHERE o_orderstatus = 'P'"""


@query("apply_update_insert_partial", ctes(t=ORDER_LINES, b=_LINE_MIX) + """
SELECT t.l_orderkey, t.l_linenumber, CASE WHEN u.l_orderkey IS NULL THEN t.l_quantity ELSE u.l_quantity END AS l_quantity,
       CASE WHEN f.l_orderkey IS NOT NULL THEN 1 WHEN u.l_orderkey IS NOT NULL THEN u.is_deleted ELSE t.is_deleted END AS is_deleted
FROM t LEFT JOIN (SELECT * FROM b WHERE op_type > 0) u ON t.l_orderkey = u.l_orderkey AND t.l_linenumber = u.l_linenumber
LEFT JOIN (SELECT * FROM b WHERE op_type = 0 AND is_deleted = 1) f ON t.l_orderkey = f.l_orderkey
UNION ALL SELECT l_orderkey, l_linenumber, l_quantity, is_deleted FROM b WHERE op_type > 0 AND NOT EXISTS (
  SELECT 1 FROM t WHERE t.l_orderkey = b.l_orderkey AND t.l_linenumber = b.l_linenumber)""")
def apply_update_insert_partial(spark, sf):
    return merge.apply_update_insert(
        frame(spark, sf, ORDER_LINES), frame(spark, sf, _LINE_MIX), _LK, op_col="op_type", unused_keys=_LU
    )


@query("merge_plain", MERGE_HARD)
def merge_plain(spark, sf):
    t, b = _tb(spark, sf)
    return merge.merge_plain(t, b, KEY)


@query("merge_plain_inserts_deletes", MERGE_HARD + f" UNION ALL SELECT {COLS} FROM b WHERE op_type = 0 AND {_anti('b', 't')}")
def merge_plain_inserts_deletes(spark, sf):
    t, b = _tb(spark, sf)
    return merge.merge_plain(t, b, KEY, insert_unmatched_deletes=True)


_PLAIN_SOFT = ctes(t=_SOFT_T, b=CHANGES) + f"SELECT {COLS}, is_deleted FROM t WHERE {_anti('t', 'b')} UNION ALL SELECT {COLS}, is_deleted FROM b"


@query("merge_plain_soft", _PLAIN_SOFT)
def merge_plain_soft(spark, sf):
    return merge.merge_plain(frame(spark, sf, _SOFT_T), frame(spark, sf, CHANGES), KEY, soft=True)


_LAST = """, l AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY file_seq DESC, row_seq DESC) AS rn FROM b) x WHERE rn = 1)"""


@query("apply_files_in_order", ctes(t=LOG_TARGET, b=LOG) + _LAST + f"""
SELECT {LCOLS} FROM t WHERE {_anti('t', 'l')} UNION ALL SELECT {LCOLS} FROM l WHERE op_type <> 0""")
def apply_files_in_order(spark, sf):
    return merge.apply_files_in_order(frame(spark, sf, LOG_TARGET), frame(spark, sf, LOG), KEY, ["file_seq", "row_seq"])


@query("insert_strict", TB + f"SELECT {COLS} FROM t UNION ALL SELECT {COLS} FROM b WHERE op_type = 1")
def insert_strict(spark, sf):
    t, b = _tb(spark, sf)
    return merge.insert_strict(t, b.filter("op_type = 1"), KEY)


@query("apply_counts", TB + """
SELECT action, count(*) AS n_rows FROM (
  SELECT CASE WHEN op_type = 0 THEN 'deleted' ELSE 'updated' END AS action FROM t JOIN b ON t.o_orderkey = b.o_orderkey WHERE op_type IN (0, 2)
  UNION ALL SELECT 'inserted' FROM b WHERE op_type = 1) x GROUP BY action""")
def apply_counts(spark, sf):
    t, b = _tb(spark, sf)
    return merge.apply_counts(t, b, KEY)


OUTER_COUNTS = TB + """
SELECT action, count(*) AS n_rows FROM (
  SELECT CASE WHEN op_type = 0 THEN 'deleted' ELSE 'updated' END AS action FROM t JOIN b ON t.o_orderkey = b.o_orderkey
  UNION ALL SELECT 'inserted' FROM b WHERE op_type <> 0 AND NOT EXISTS (SELECT 1 FROM t WHERE t.o_orderkey = b.o_orderkey)) x GROUP BY action"""


@query("apply_counts_written", OUTER_COUNTS)
def apply_counts_written(spark, sf):
    """Counts taken while the merged target is written: no second join."""
    t, b = _tb(spark, sf)
    counts = merge.ApplyCounts()
    merge.merge_hard(t, b, KEY, counts=counts).write.parquet(scratch(spark, "counted"))
    return counts.frame(spark)


@query("apply_counts_outer", OUTER_COUNTS)
def apply_counts_outer(spark, sf):
    t, b = _tb(spark, sf)
    counts = merge.ApplyCounts()
    merge.merge_outer(t, b, KEY, counts=counts).write.parquet(scratch(spark, "counted"))
    return counts.frame(spark)


@query("merge_outer_dup_targets", ctes(t=BAG_ORDERS, b=BAG_ORDER_CHANGES) + """
SELECT t.o_custkey, CASE WHEN b.o_custkey IS NULL THEN t.o_orderstatus ELSE b.o_orderstatus END AS o_orderstatus, t.o_totalprice
FROM t LEFT JOIN b ON t.o_custkey IS NOT DISTINCT FROM b.o_custkey WHERE b.o_custkey IS NULL OR b.op_type <> 0
UNION ALL SELECT b.o_custkey, b.o_orderstatus, NULL FROM b WHERE op_type <> 0 AND NOT EXISTS (SELECT 1 FROM t WHERE t.o_custkey = b.o_custkey)""")
def merge_outer_dup_targets(spark, sf):
    """A customer's orders share one key, and the price is the target's own column."""
    t, b = frame(spark, sf, BAG_ORDERS), frame(spark, sf, BAG_ORDER_CHANGES)
    return merge.merge_outer(t, b, ["o_custkey"])


_PARTS = f"SELECT {COLS} FROM ({ORDERS}) o"


@query("merge_partition_stable", ctes(t=_PARTS, b=f"SELECT * FROM ({CHANGES}) c WHERE o_orderpriority IN ('1-URGENT', '5-LOW')") + f"""
SELECT {COLS} FROM t WHERE {_anti('t', 'b')} UNION ALL SELECT {COLS} FROM b WHERE op_type <> 0""")
def merge_partition_stable(spark, sf):
    """The change set names two of five partitions; the others aren't read or written."""
    path = scratch(spark, "stable")
    frame(spark, sf, _PARTS).write.partitionBy("o_orderpriority").parquet(path)
    t = spark.read.parquet(path)
    b = frame(spark, sf, CHANGES).filter(F.col("o_orderpriority").isin("1-URGENT", "5-LOW"))
    spec = ApplySpec(keys=("o_orderkey",), partition_cols=("o_orderpriority",), partition_stable=True)
    write_touched(plans.integrate_touched(t, b, spec), path, ["o_orderpriority"], b)
    return spark.read.schema(t.schema).parquet(path).select(*COLS.split(", "))


# ---- keyed stores

@query("upsert_lww", ctes(t=LOG_TARGET, b=LOG) + _LAST + f"""
SELECT {LCOLS} FROM t WHERE {_anti('t', 'l')} UNION ALL SELECT {LCOLS} FROM l WHERE is_deleted = 0""")
def upsert_lww(spark, sf):
    return keyed.upsert_lww(frame(spark, sf, LOG_TARGET), frame(spark, sf, LOG), KEY, ["file_seq", "row_seq"])


_FLAGGED = f"SELECT {LCOLS}, 0 AS is_deleted FROM ({LOG_TARGET}) q"


@query("upsert_lww_soft", ctes(t=_FLAGGED, b=LOG) + _LAST + f"""
SELECT {LCOLS}, is_deleted FROM t WHERE {_anti('t', 'l')} UNION ALL SELECT {LCOLS}, is_deleted FROM l""")
def upsert_lww_soft(spark, sf):
    return keyed.upsert_lww(
        frame(spark, sf, _FLAGGED), frame(spark, sf, LOG), KEY, ["file_seq", "row_seq"], flag_col=None
    )


def _last_filled(c, empty=True):
    cond = f"{c} IS NOT NULL" + (f" AND {c} <> ''" if empty else "")
    return f"""(SELECT o_orderkey, {c} FROM (SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY file_seq DESC, row_seq DESC) AS rn
 FROM b WHERE {cond}) x WHERE rn = 1)"""


_PARTIAL = ctes(t=LOG_TARGET, b=LOG) + f""",
k AS (SELECT DISTINCT o_orderkey FROM b)
SELECT coalesce(t.o_orderkey, k.o_orderkey) AS o_orderkey, coalesce(c.o_custkey, t.o_custkey) AS o_custkey,
       coalesce(s.o_orderstatus, t.o_orderstatus) AS o_orderstatus, coalesce(p.o_totalprice, t.o_totalprice) AS o_totalprice,
       coalesce(r.o_orderpriority, t.o_orderpriority) AS o_orderpriority
FROM t FULL OUTER JOIN k ON t.o_orderkey = k.o_orderkey
LEFT JOIN {_last_filled('o_custkey', False)} c ON k.o_orderkey = c.o_orderkey
LEFT JOIN {_last_filled('o_orderstatus')} s ON k.o_orderkey = s.o_orderkey
LEFT JOIN {_last_filled('o_totalprice', False)} p ON k.o_orderkey = p.o_orderkey
LEFT JOIN {_last_filled('o_orderpriority')} r ON k.o_orderkey = r.o_orderkey"""


@query("upsert_partial", _PARTIAL)
def upsert_partial(spark, sf):
    return keyed.upsert_partial(frame(spark, sf, LOG_TARGET), frame(spark, sf, LOG), KEY, ["file_seq", "row_seq"])


_DOCS_T = "SELECT concat(CAST(c_nationkey AS VARCHAR(20)), CAST(c_custkey AS VARCHAR(20))) AS _id, c_custkey, c_nationkey, c_name FROM {customer} WHERE c_acctbal < 5000"
_DOCS_B = "SELECT c_custkey, c_nationkey, concat(c_name, '!') AS c_name, 0 AS seq FROM {customer} WHERE c_acctbal > 0 UNION ALL SELECT c_custkey, c_nationkey, c_name, 1 FROM {customer} WHERE c_mktsegment = 'BUILDING'"


@query("docs_replace", ctes(t=_DOCS_T, b=_DOCS_B) + """,
l AS (SELECT * FROM (SELECT *, concat(CAST(c_nationkey AS VARCHAR), CAST(c_custkey AS VARCHAR)) AS _id,
  row_number() OVER (PARTITION BY concat(CAST(c_nationkey AS VARCHAR), CAST(c_custkey AS VARCHAR)) ORDER BY seq DESC, c_custkey DESC) AS rn FROM b) x WHERE rn = 1)
SELECT _id, c_custkey, c_nationkey, c_name FROM t WHERE NOT EXISTS (SELECT 1 FROM l WHERE l._id = t._id)
UNION ALL SELECT _id, c_custkey, c_nationkey, c_name FROM l""")
def docs_replace(spark, sf):
    t = frame(spark, sf, _DOCS_T)
    return keyed.docs_replace(t, frame(spark, sf, _DOCS_B), ["c_nationkey", "c_custkey"], ["seq", "c_custkey"])


@query("docs_append", ctes(t="SELECT CAST(s_suppkey AS VARCHAR(20)) AS _id, s_name AS name FROM {supplier}",
                           b="SELECT CAST(c_custkey AS VARCHAR(20)) AS _id, c_name AS name FROM {customer}") + """
SELECT _id, name FROM t UNION ALL SELECT _id, name FROM b WHERE NOT EXISTS (SELECT 1 FROM t WHERE t._id = b._id)""")
def docs_append(spark, sf):
    t = frame(spark, sf, "SELECT CAST(s_suppkey AS VARCHAR(20)) AS _id, s_name AS name FROM {supplier}")
    b = frame(spark, sf, "SELECT CAST(c_custkey AS VARCHAR(20)) AS _id, c_name AS name FROM {customer}")
    return keyed.docs_append(t, b)


@query("kv_upsert", plain("""
WITH b AS (SELECT c_custkey, c_name, c_nationkey, 0 AS seq FROM {customer}
           UNION ALL SELECT c_custkey, concat(c_name, '!'), c_nationkey, 1 FROM {customer} WHERE c_acctbal > 0),
l AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY c_custkey ORDER BY seq DESC) AS rn FROM b) x WHERE rn = 1)
SELECT concat('customer::', CAST(c_nationkey AS VARCHAR), '::', CAST(c_custkey AS VARCHAR)) AS key, c_name, seq FROM l
UNION ALL SELECT concat('supplier::', CAST(s_suppkey AS VARCHAR)), s_name, 0 FROM {supplier}"""))
def kv_upsert(spark, sf):
    old = frame(spark, sf, "SELECT s_suppkey, s_name AS c_name, 0 AS seq FROM {supplier}")
    b = frame(spark, sf, """SELECT c_custkey, c_name, c_nationkey, 0 AS seq FROM {customer}
        UNION ALL SELECT c_custkey, concat(c_name, '!'), c_nationkey, 1 FROM {customer} WHERE c_acctbal > 0""")
    t = keyed.to_pairs(old, "supplier", ["s_suppkey"])
    t = t.unionAll(keyed.to_pairs(b.filter("seq = 0"), "customer", ["c_nationkey", "c_custkey"]))
    out = keyed.kv_upsert(t, b, "customer", ["c_nationkey", "c_custkey"], ["seq"])
    body = F.from_json("value", "c_name string, seq int")
    return out.select("key", body["c_name"].alias("c_name"), body["seq"].alias("seq"))


@query("struct_key", plain("""SELECT CAST(c_nationkey AS VARCHAR) AS key_nation, CAST(c_custkey AS VARCHAR) AS key_cust,
CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, c_mktsegment FROM {customer}"""))
def struct_key(spark, sf):
    df = table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment", "c_nationkey")
    out = keyed.to_struct_key(df, ["c_nationkey", "c_custkey"])
    return out.select(
        F.col("row_key.c_nationkey").alias("key_nation"), F.col("row_key.c_custkey").alias("key_cust"),
        "c_custkey", "c_name", "c_mktsegment",
    )


@query("to_text", plain("SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_name, CAST(p_size AS VARCHAR) AS p_size FROM {part}"))
def to_text(spark, sf):
    return keyed.to_text(table(spark, sf, "part").select("p_partkey", "p_name", "p_size"))


# ---- change sets

_COALESCED = ctes(b=LOG) + f""",
d AS (SELECT * FROM b WHERE op_type <> 4),
f AS (SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY file_seq DESC, row_seq DESC) AS rn,
  first_value(op_type) OVER (PARTITION BY o_orderkey ORDER BY file_seq, row_seq) AS op1 FROM d)
SELECT {LCOLS}, CASE WHEN op_type = 0 THEN 0 WHEN op1 = 1 THEN 1 ELSE 2 END AS op_type, is_deleted, file_seq, row_seq FROM f WHERE rn = 1"""


@query("coalesce_changes", _COALESCED)
def coalesce_changes(spark, sf):
    return changes.coalesce_changes(frame(spark, sf, LOG), KEY, ["file_seq", "row_seq"])


# a log over lines in which a delete of the whole order falls between two writes
_LINE_LOG = """
SELECT l_orderkey, l_linenumber, min(l_quantity) AS l_quantity, 1 AS op_type, 0 AS seq FROM {lineitem} GROUP BY l_orderkey, l_linenumber
UNION ALL SELECT DISTINCT l_orderkey, CAST(NULL AS INT), CAST(NULL AS DOUBLE), 8, 1 FROM {lineitem} WHERE l_returnflag = 'R' AND l_quantity > 45
UNION ALL SELECT l_orderkey, l_linenumber, max(l_quantity) + 1, 2, 2 FROM {lineitem} WHERE l_returnflag = 'N' GROUP BY l_orderkey, l_linenumber"""


@query("coalesce_with_barriers", ctes(g=_LINE_LOG) + """,
cut AS (SELECT l_orderkey AS k, max(seq) AS s FROM g WHERE op_type = 8 GROUP BY l_orderkey),
d AS (SELECT g.* FROM g LEFT JOIN cut ON g.l_orderkey = cut.k WHERE g.op_type <> 8 AND (cut.s IS NULL OR g.seq > cut.s)),
f AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY seq DESC) AS rn,
  first_value(op_type) OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY seq) AS op1 FROM d)
SELECT l_orderkey, l_linenumber, l_quantity, CASE WHEN op1 = 1 THEN 1 ELSE 2 END AS op_type, seq FROM f WHERE rn = 1
UNION ALL SELECT l_orderkey, l_linenumber, l_quantity, op_type, seq FROM g WHERE op_type = 8""")
def coalesce_with_barriers(spark, sf):
    return changes.coalesce_changes(frame(spark, sf, _LINE_LOG), _LK, ["seq"], unused_keys=_LU)


@query("duplicate_changes", ctes(b=LOG) + "SELECT o_orderkey, count(*) AS n_changes FROM b GROUP BY o_orderkey HAVING count(*) > 1")
def duplicate_changes(spark, sf):
    return changes.duplicate_changes(frame(spark, sf, LOG), KEY)


@query("drop_burst_only", ctes(b=CHANGES) + f"SELECT {COLS} FROM b")
def drop_burst_only(spark, sf):
    t, b = _tb(spark, sf)
    return changes.drop_burst_only(b, t.columns)


@query("drop_ignored", ctes(b=CHANGES) + "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, op_type, is_deleted FROM b")
def drop_ignored(spark, sf):
    return changes.drop_ignored(frame(spark, sf, CHANGES), ["o_orderdate", "o_orderpriority"])


@query("rename_columns", plain("SELECT c_custkey AS id, c_name AS full_name, c_acctbal FROM {customer}"))
def rename_columns(spark, sf):
    df = table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal")
    return changes.rename(df, {"c_custkey": "id", "c_name": "full_name"})


@query("lower_names", plain("SELECT c_custkey, c_name FROM {customer}"))
def lower_names(spark, sf):
    return changes.lower_names(table(spark, sf, "customer").selectExpr("c_custkey AS C_CUSTKEY", "c_name AS C_Name"))


@query("op_predicates", ctes(b=LOG) + """
SELECT 'is' AS test, o_orderkey, op_type FROM b WHERE op_type IN (0, 2)
UNION ALL SELECT 'not', o_orderkey, op_type FROM b WHERE op_type NOT IN (0, 1, 8)""")
def op_predicates(spark, sf):
    b = frame(spark, sf, LOG).select("o_orderkey", "op_type")
    hit = changes.by_op(b, 0, 2).select(F.lit("is").alias("test"), "*")
    return hit.unionAll(changes.by_op(b, 0, 1, 8, exclude=True).select(F.lit("not"), "*"))


@query("flag_predicate", ctes(b=LOG) + "SELECT o_orderkey, row_seq FROM b WHERE is_deleted = 1")
def flag_predicate(spark, sf):
    return changes.by_flag(frame(spark, sf, LOG), 1).select("o_orderkey", "row_seq")


@query("user_condition", plain("SELECT o_orderkey FROM {orders} WHERE o_totalprice > 200000 AND o_orderstatus = 'O'"))
def user_condition(spark, sf):
    return changes.where(table(spark, sf, "orders"), "o_totalprice > 200000 AND o_orderstatus = 'O'").select("o_orderkey")


@query("exists_test", plain("SELECT count(*) > 0 AS found FROM {orders} WHERE o_orderstatus = 'P'"))
def exists_test(spark, sf):
    return changes.exists(table(spark, sf, "orders").filter("o_orderstatus = 'P'"))


@query("empty_like", plain("SELECT c_custkey, c_name FROM {customer} WHERE 1 = 0"))
def empty_like(spark, sf):
    return changes.empty_like(table(spark, sf, "customer").select("c_custkey", "c_name"))


# ---- refreshes

@query("refresh_full", ctes(b=CHANGES) + f"SELECT {COLS} FROM b")
def refresh_full(spark, sf):
    t, b = _tb(spark, sf)
    return refresh.refresh_full(t, b)


@query("refresh_restrict", ctes(t=ORDERS_NULL, b=plain("SELECT * FROM {orders}")) + f"""
SELECT {NCOLS} FROM t WHERE NOT coalesce(o_orderpriority > '2', false)
UNION ALL SELECT {NCOLS} FROM b WHERE o_orderpriority > '2'""")
def refresh_restrict(spark, sf):
    t, b = frame(spark, sf, ORDERS_NULL), table(spark, sf, "orders").filter("o_orderpriority > '2'")
    return refresh.refresh_restrict(t, b, "o_orderpriority > '2'")


@query("refresh_append", TB + f"SELECT {COLS} FROM t UNION ALL SELECT {COLS} FROM b")
def refresh_append(spark, sf):
    t, b = _tb(spark, sf)
    return refresh.refresh_append(t, b)


_LOAD = f"""SELECT o_orderkey, o_custkey, CASE WHEN o_orderpriority = '5-LOW' THEN '' ELSE o_orderstatus END AS o_orderstatus,
 CASE WHEN o_orderpriority = '2-HIGH' THEN NULL ELSE o_totalprice + 1 END AS o_totalprice, o_orderdate, o_orderpriority FROM ({CHANGES}) x"""


@query("refresh_upsert", ctes(t=ORDERS, b=_LOAD) + f"""
SELECT {COLS} FROM t WHERE {_anti('t', 'b')} UNION ALL
SELECT b.o_orderkey, coalesce(b.o_custkey, t.o_custkey), coalesce(nullif(b.o_orderstatus, ''), t.o_orderstatus), coalesce(b.o_totalprice, t.o_totalprice),
       coalesce(b.o_orderdate, t.o_orderdate), coalesce(b.o_orderpriority, t.o_orderpriority) FROM b LEFT JOIN t ON b.o_orderkey = t.o_orderkey""")
def refresh_upsert(spark, sf):
    return refresh.refresh_upsert(frame(spark, sf, ORDERS), frame(spark, sf, _LOAD), KEY)


@query("refresh_recreate", ctes(b=CHANGES) + f"SELECT {COLS}, op_type FROM b")
def refresh_recreate(spark, sf):
    return refresh.refresh_recreate(frame(spark, sf, CHANGES), ["is_deleted"])


@query("refresh_inserts_only", ctes(b=CHANGES) + f"SELECT {COLS}, is_deleted FROM b WHERE op_type = 1")
def refresh_inserts_only(spark, sf):
    return refresh.refresh_inserts_only(frame(spark, sf, CHANGES))


@query("align_to_target", plain("SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(NULL AS DOUBLE) AS c_limit FROM {customer}"))
def align_to_target(spark, sf):
    t = spark.createDataFrame([], "c_custkey string, c_name string, c_limit double")
    return align(table(spark, sf, "customer").select("c_name", "c_custkey", "c_acctbal"), t)


# ---- whole cycles

@query("integrate_log", ctes(t=LOG_TARGET, b=LOG) + _LAST + f"""
SELECT {LCOLS} FROM t WHERE {_anti('t', 'l')} UNION ALL SELECT {LCOLS} FROM l WHERE op_type <> 0""")
def integrate_log(spark, sf):
    spec = ApplySpec(keys=("o_orderkey",), order=("file_seq", "row_seq"))
    return plans.integrate(frame(spark, sf, LOG_TARGET), frame(spark, sf, LOG), spec)


@query("integrate_preloaded", MERGE_HARD)
def integrate_preloaded(spark, sf):
    t, b = _tb(spark, sf)
    b, name = plans.preloaded(b, "__bur", "orders__bur")
    assert name == "orders"
    return plans.integrate(t, b, ApplySpec(keys=("o_orderkey",)))


_LOG_LINES_T = "SELECT l_orderkey, l_linenumber, min(l_extendedprice) AS l_quantity FROM {lineitem} GROUP BY l_orderkey, l_linenumber"


@query("integrate_partial_deletes", ctes(t=_LOG_LINES_T, g=_LINE_LOG) + """,
cut AS (SELECT DISTINCT l_orderkey FROM g WHERE op_type = 8),
d AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY seq DESC) AS rn FROM g WHERE op_type <> 8
      AND (seq > 1 OR NOT EXISTS (SELECT 1 FROM cut WHERE cut.l_orderkey = g.l_orderkey)))
SELECT l_orderkey, l_linenumber, l_quantity FROM d WHERE rn = 1
UNION ALL SELECT l_orderkey, l_linenumber, l_quantity FROM t
WHERE NOT EXISTS (SELECT 1 FROM cut WHERE cut.l_orderkey = t.l_orderkey)
  AND NOT EXISTS (SELECT 1 FROM d WHERE d.l_orderkey = t.l_orderkey AND d.l_linenumber = t.l_linenumber)""")
def integrate_partial_deletes(spark, sf):
    spec = ApplySpec(keys=tuple(_LK), order=("seq",), unused_keys=tuple(_LU))
    return plans.integrate(frame(spark, sf, _LOG_LINES_T), frame(spark, sf, _LINE_LOG), spec)


