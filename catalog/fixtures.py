"""Change sets derived from the test tables.

Each fixture is one SELECT that Spark SQL and the checking SQL engine both understand;
``{orders}`` and the like stand for the tables. All rows of the tables take part.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession

from changemill.operators.ordering import shared_dir

CUT = "TIMESTAMP '2001-01-01 00:00:00'"
ORDER_COLS = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority"

#: Orders known before the cut.
ORDERS = f"SELECT {ORDER_COLS} FROM {{orders}} WHERE o_orderdate < {CUT}"

#: One change per key: later orders are new, pending ones are completed, low-priority ones
#: go; plus deletes and updates of keys the target never had.
CHANGES = f"""
SELECT o_orderkey, o_custkey,
       CASE WHEN o_orderdate < {CUT} AND o_orderstatus = 'P' THEN 'F' ELSE o_orderstatus END AS o_orderstatus,
       CASE WHEN o_orderdate < {CUT} AND o_orderstatus = 'P' THEN o_totalprice + 100 ELSE o_totalprice END AS o_totalprice,
       o_orderdate, o_orderpriority,
       CASE WHEN o_orderdate >= {CUT} THEN 1 WHEN o_orderstatus = 'P' THEN 2 ELSE 0 END AS op_type,
       CASE WHEN o_orderdate >= {CUT} OR o_orderstatus = 'P' THEN 0 ELSE 1 END AS is_deleted
FROM {{orders}}
WHERE o_orderdate >= {CUT} OR o_orderstatus = 'P' OR (o_orderstatus = 'F' AND o_orderpriority = '5-LOW')
UNION ALL
SELECT o_orderkey + 10000000, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority, 0, 1
FROM {{orders}} WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'
UNION ALL
SELECT o_orderkey + 10000000, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority, 2, 0
FROM {{orders}} WHERE o_orderstatus = 'F' AND o_orderpriority = '2-HIGH'
"""

_NULLED = "CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN NULL ELSE o_orderpriority END AS o_orderpriority"

#: The same with a key (o_orderkey, o_orderpriority) whose second part may be NULL.
ORDERS_NULL = f"SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, {_NULLED} FROM ({ORDERS}) x"
CHANGES_NULL = f"SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, {_NULLED}, op_type, is_deleted FROM ({CHANGES}) x"

#: Adds keys that are deleted and written again in one set.
CHANGES_KEY = f"""
SELECT * FROM ({CHANGES}) x
UNION ALL
SELECT {ORDER_COLS}, 0, 1 FROM {{orders}}
WHERE o_orderdate < {CUT} AND o_orderstatus = 'O' AND o_orderpriority = '3-MEDIUM'
UNION ALL
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice + 1, o_orderdate, o_orderpriority, 1, 0 FROM {{orders}}
WHERE o_orderdate < {CUT} AND o_orderstatus = 'O' AND o_orderpriority = '3-MEDIUM'
"""

#: Lines with a two-part key, and deletes that name only the order.
LINES = """
SELECT l_orderkey, l_linenumber, min(l_quantity) AS l_quantity, 0 AS is_deleted
FROM {lineitem} GROUP BY l_orderkey, l_linenumber
"""
LINE_DELETES = """
SELECT DISTINCT l_orderkey, CAST(NULL AS INT) AS l_linenumber, CAST(NULL AS DOUBLE) AS l_quantity,
       8 AS op_type, 1 AS is_deleted
FROM {lineitem} WHERE l_returnflag = 'R' AND l_quantity > 45
"""
#: The same lines as flagged ordinary deletes.
LINE_FLAGS = """
SELECT DISTINCT l_orderkey, CAST(NULL AS INT) AS l_linenumber, CAST(NULL AS DOUBLE) AS l_quantity,
       0 AS op_type, 1 AS is_deleted
FROM {lineitem} WHERE l_returnflag = 'R' AND l_quantity > 45
"""

#: Lines named after order columns: the customer is the first key part, the order the second.
ORDER_LINES = "SELECT o_custkey AS l_orderkey, o_orderkey AS l_linenumber, o_totalprice AS l_quantity, 0 AS is_deleted FROM {orders}"

#: A table without a key (urgent orders are in it twice), and deletes and inserts for it; high
#: orders are inserted twice.
BAG = f"{ORDER_LINES} UNION ALL {ORDER_LINES} WHERE o_orderpriority = '1-URGENT'"
BAG_CHANGES = """
SELECT o_custkey AS l_orderkey, o_orderkey AS l_linenumber, o_totalprice AS l_quantity, 0 AS op_type, 1 AS is_deleted
FROM {orders} WHERE o_orderstatus = 'F'
UNION ALL
SELECT o_custkey + 10000000, o_orderkey, o_totalprice, 1, 0 FROM {orders} WHERE o_orderstatus = 'O'
UNION ALL
SELECT o_custkey + 10000000, o_orderkey, o_totalprice, 1, 0 FROM {orders} WHERE o_orderstatus = 'O' AND o_orderpriority = '2-HIGH'
"""

#: The orders as a table whose key, the customer, repeats, and one change for each customer.
BAG_ORDERS = "SELECT o_custkey, o_orderstatus, o_totalprice FROM {orders}"
BAG_ORDER_CHANGES = """
SELECT c_custkey AS o_custkey, c_mktsegment AS o_orderstatus, CASE WHEN c_acctbal < 0 THEN 0 WHEN c_acctbal < 5000 THEN 2 ELSE 1 END AS op_type
FROM {customer}
"""

#: A log with several rows per order: insert, update with images, delete, insert again.
LOG = """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority, 1 AS op_type, 0 AS is_deleted, 0 AS file_seq, 0 AS row_seq FROM {orders}
UNION ALL
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority, 4, 0, 0, 1 FROM {orders} WHERE o_orderstatus <> 'F'
UNION ALL
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice + 1, '', 2, 0, 0, 2 FROM {orders} WHERE o_orderstatus <> 'F'
UNION ALL
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority, 0, 1, 1, 0 FROM {orders} WHERE o_orderpriority = '5-LOW'
UNION ALL
SELECT o_orderkey, o_custkey, '', o_totalprice + 2, o_orderpriority, 1, 0, 1, 1 FROM {orders} WHERE o_orderpriority = '5-LOW' AND o_orderstatus = 'P'
"""
LOG_TARGET = f"SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM {{orders}} WHERE o_orderdate < {CUT}"

#: Before and after images; the user is the transaction. Purchases are updates without a change.
PAIRS = """
SELECT user_id, event_id, 0 AS row_seq, 4 AS op_type, value, event_type FROM {events} WHERE event_type IN ('click', 'purchase')
UNION ALL
SELECT user_id, event_id, 1, 2, CASE WHEN event_type = 'click' THEN value + 1 ELSE value END, event_type FROM {events} WHERE event_type IN ('click', 'purchase')
UNION ALL
SELECT user_id, event_id, 0, 1, value, event_type FROM {events} WHERE event_type NOT IN ('click', 'purchase')
"""
#: The same log in which after images of cheap clicks are lost.
PAIRS_BROKEN = f"SELECT * FROM ({PAIRS}) p WHERE NOT (op_type = 2 AND event_type = 'click' AND value < 20)"

_TX_HEX = "lpad(lower(hex(user_id)), 16, '0')"
TX = f"""
SELECT event_id, user_id,
       CASE event_type WHEN 'click' THEN concat('0000', {_TX_HEX}, '0000')
                       WHEN 'view' THEN concat('0000', {_TX_HEX}, '00000000')
                       WHEN 'error' THEN 'zz'
                       WHEN 'signup' THEN ''
                       ELSE lower(hex(user_id)) END AS tx_seq,
       concat('0000', {_TX_HEX}, repeat('0', 16)) AS integ_seq
FROM {{events}}
"""

#: Staged file names: one file per event, its table the event type.
FILES = """
SELECT concat(CAST(event_id AS VARCHAR(20)), '-', event_type, '.csv') AS file_name, user_id AS n_rows,
       length(props) + user_id AS size_bytes FROM {events}
"""

#: A dictionary with one column per part; at most fifty columns make a table.
_TYPES = """CASE WHEN p_size <= 4 THEN 'integer identity' WHEN p_size <= 8 THEN 'varchar2' WHEN p_size <= 16 THEN 'number'
 WHEN p_size <= 20 THEN 'date' WHEN p_size <= 24 THEN 'date (mysql)' WHEN p_size <= 28 THEN 'money' WHEN p_size <= 32 THEN 'bit'
 WHEN p_size <= 36 THEN 'blob' WHEN p_size <= 40 THEN 'float8' WHEN p_size <= 44 THEN 'bigint unsigned' ELSE 'time2' END"""
_LENGTHS = """CASE WHEN p_size <= 8 THEN '20' WHEN p_size = 9 THEN '0' WHEN p_size = 10 THEN '8' WHEN p_size = 11 THEN '8,0'
 WHEN p_size = 12 THEN '10,-2' WHEN p_size = 13 THEN '2,6' WHEN p_size = 14 THEN '40,2' WHEN p_size = 15 THEN '18,4' WHEN p_size = 16 THEN '6' ELSE '0' END"""
DICTIONARY = f"""
SELECT concat(p_brand, '_', p_type, '_', CAST(CAST(floor(p_partkey / 50.0) AS INT) AS VARCHAR(20))) AS tbl_name, CAST(p_partkey AS INT) AS col_sequence,
       concat('c', CAST(p_partkey AS VARCHAR(20))) AS col_name, concat('c', CAST(p_partkey AS VARCHAR(20))) AS base_name,
       CASE WHEN p_size = 1 THEN 1 ELSE 0 END AS col_key,
       {_TYPES} AS col_datatype, {_LENGTHS} AS col_length, 0 AS col_nullable
FROM {{part}}
"""


def tables_in(sql: str) -> list[str]:
    return sorted(set(re.findall(r"\{(\w+)\}", sql)))


def plain(sql: str) -> str:
    """The SQL with the tables' own names."""
    return re.sub(r"\{(\w+)\}", r"\1", sql)


def frame(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """The fixture as a DataFrame over the Parquet tables."""
    return spark.sql(sql, **{t: table(spark, sf_dir, t) for t in tables_in(sql)})


_SCHEMAS: dict = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table; its schema is looked up once per path."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def scratch(spark: SparkSession, what: str) -> str:
    """A fresh folder in the shared checkpoint folder."""
    return f"{shared_dir(spark).rstrip('/')}/mill-{what}-{uuid.uuid4().hex[:12]}"


def ctes(**named: str) -> str:
    return "WITH " + ", ".join(f"{k} AS ({plain(v)})" for k, v in named.items()) + "\n"
