"""Source column types to Spark types, for whole dictionaries at once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changemill.functions.columns import cast_to, col

# Source type names by the Spark type they map to.
BYTE_NAMES = ["byteint", "integer1", "tinyint", "tinyint signed", "tinyint unsigned"]
SHORT_NAMES = ["integer2", "smallint", "smallint unsigned", "unsigned smallint"]
INTEGER_NAMES = [
    "mediumint", "mediumint unsigned",
    "int", "int unsigned", "integer", "integer4", "unsigned int",
]
LONG_NAMES = ["bigint", "bigint unsigned", "integer8", "unsigned bigint"]
FLOAT_NAMES = ["binary_float", "float4", "real"]
DOUBLE_NAMES = ["binary_double", "double", "float", "float8"]
DECIMAL_NAMES = ["decimal", "number", "numeric", "numeric (db2i)"]
MONEY_NAMES = {"money (ingres)": "DECIMAL(14,2)", "money": "DECIMAL(19,4)", "smallmoney": "DECIMAL(10,4)"}
STRING_NAMES = [
    "c", "char", "nchar", "unichar",
    "nvarchar", "nvarchar2", "univarchar", "varchar", "varchar2", "varchar (sybase)",
    "clob", "dbclob", "json", "jsonb", "long char", "long nvarchar (db2)", "long nvarchar",
    "long varchar (db2)", "long varchar", "long", "nclob", "ntext", "nvarchar(max)",
    "text (ingres)", "text (sqlserver)", "text (sybase)", "unitext", "varchar(max)", "xml", "db2 xml",
    "time", "time (mysql)", "time (sybase)", "time2", "time with local time zone", "time with time zone",
    "interval day to second", "interval day to second (ingres)",
    "interval year to month", "interval year to month (ingres)",
    "rowid", "urowid", "uniqueidentifier", "decfloat", "graphic", "vargraphic",
]
BINARY_NAMES = [
    "binary", "byte varying", "byte", "raw", "varbinary (sybase)", "varbinary", "varbinary(max)", "varbyte",
    "bfile", "blob", "image (sybase)", "image", "long byte", "long raw", "long varbinary", "rowversion",
]
DATE_NAMES = ["ansidate", "date (mysql)", "date (sybase)", "postgres date"]
TIMESTAMP_NAMES = [
    "date", "datetime", "datetime2", "datetime (bigquery)", "datetime (mysql)", "datetime (sybase)",
    "datetimeoffset", "ingresdate", "smalldatetime", "db2 timestamp with time zone",
    "postgres timestamp", "postgres timestamp with time zone", "timestamp", "timestamp (bigquery)",
    "timestamp (db2)", "timestamp (ingres)", "timestamp (mysql)", "timestamp (oracle)",
    "timestamp (sqlserver)", "timestamp (sybase)", "timestamp with local time zone",
    "timestamp with local tz (oracle)", "timestamp with time zone", "timestamp with tz (oracle)", "epoch",
]
BOOLEAN_NAMES = ["bit", "bit (mysql)", "bool", "boolean"]

PLAIN = {
    "BYTE": BYTE_NAMES,
    "SHORT": SHORT_NAMES,
    "INTEGER": INTEGER_NAMES,
    "LONG": LONG_NAMES,
    "FLOAT": FLOAT_NAMES,
    "DOUBLE": DOUBLE_NAMES,
    "STRING": STRING_NAMES,
    "BINARY": BINARY_NAMES,
    "DATE": DATE_NAMES,
    "TIMESTAMP": TIMESTAMP_NAMES,
}


def length_parts(length: Column) -> tuple[Column, Column]:
    """A length text ``p`` or ``p,s`` as two numbers; an absent part is 0."""
    number = lambda i: F.coalesce(F.split(length, ",", 2).getItem(i).try_cast("int"), F.lit(0))
    return number(0), F.when(F.contains(length, F.lit(",")), number(1)).otherwise(0)


def decimal_type(precision: Column, scale: Column) -> Column:
    """A negative scale widens the precision; too wide becomes DOUBLE; the scale never
    exceeds the precision. Precision 0 has no decimal type and fails."""
    p = F.when(scale < 0, precision - scale).otherwise(precision)
    s = F.when(scale < 0, 0).otherwise(scale)
    none = F.raise_error(F.lit("a decimal column without precision has no Spark type"))
    return (
        F.when((p > 38) | (s > 37), "DOUBLE")
        .when(p == 0, none.cast("string"))
        .otherwise(F.format_string("DECIMAL(%d,%d)", p, F.least(s, p)))
    )


def spark_type(
    datatype: Column, length: Column, number_to_integer: bool = False, bool_to_boolean: bool = False
) -> Column:
    """Name of the Spark type for a source type and its length text."""
    name = F.regexp_replace(datatype, "(?<=.) identity$", "")
    p, s = length_parts(length)
    out = F.when(name.isin(*PLAIN["BYTE"]), "BYTE")
    for target, names in PLAIN.items():
        if target != "BYTE":
            out = out.when(name.isin(*names), target)
    out = out.when(name.isin(*BOOLEAN_NAMES), "BOOLEAN" if bool_to_boolean else "BYTE")
    for money, target in MONEY_NAMES.items():
        out = out.when(name == money, target)
    if number_to_integer:
        # documented rule: any number of at most 10 digits without a scale
        out = out.when((name == "number") & (p <= 10) & (s == 0), "INTEGER")
    out = out.when((name == "number") & (length == "0"), "DOUBLE")
    out = out.when(name.isin(*DECIMAL_NAMES), decimal_type(p, s))
    unknown = F.raise_error(F.concat(F.lit("no Spark type for source type "), name)).cast("string")
    return out.otherwise(unknown)


def map_types(columns_df: DataFrame, number_to_integer: bool = False, bool_to_boolean: bool = False) -> DataFrame:
    """Add ``target_type`` to the rows of a dictionary. A plain projection: no join."""
    t = spark_type(F.col("col_datatype"), F.col("col_length"), number_to_integer, bool_to_boolean)
    return columns_df.withColumn("target_type", t)


def load_dictionary(spark, path: str, fmt: str = "parquet") -> DataFrame:
    """Dictionary rows (tables, columns, keys, types) kept as a data set."""
    return spark.read.format(fmt).load(path)


def struct_type(mapped: DataFrame, table: str, lower: bool = False) -> T.StructType:
    """The schema of one table from the rows of ``map_types``; reads one table's columns."""
    rows = (
        mapped.filter(F.col("tbl_name") == table)
        .select("col_sequence", "base_name", "target_type", "col_nullable")
        .collect()
    )
    fields = []
    for r in sorted(rows, key=lambda r: r["col_sequence"]):
        name = r["base_name"].lower() if lower else r["base_name"]
        dtype = T.StructType.fromDDL(f"x {r['target_type']}").fields[0].dataType
        fields.append(T.StructField(name, dtype, bool(r["col_nullable"])))
    return T.StructType(fields)


def conform(df: DataFrame, schema: T.StructType, on_error: str = "fail") -> DataFrame:
    """Rows in the columns and types of a target schema; missing columns are NULL."""
    have = set(df.columns)
    return df.select(*[
        (cast_to(col(f.name), f.dataType, on_error) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in schema.fields
    ])


def key_columns(columns_df: DataFrame) -> DataFrame:
    """Key columns per table in sequence order: ``tbl_name``, ``keys``."""
    item = F.struct("col_sequence", "base_name")
    return (
        columns_df.filter("col_key > 0")
        .groupBy("tbl_name")
        .agg(F.transform(F.array_sort(F.collect_list(item)), lambda x: x["base_name"]).alias("keys"))
    )
