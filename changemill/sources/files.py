"""Readers for staged change files. All are lazy scans; no reader infers a schema unless
it is asked to, and column pruning and filters reach the scan where the format allows."""

from __future__ import annotations

import csv
import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changemill.functions.columns import cast_to, col
from changemill.operators.ordering import checkpoint
from changemill.sinks.store import is_known, located
from changemill.spec import FLAG_COL, OP_COL

# functions that run in tasks travel as they are: workers need not have this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

HEAD = 1 << 16  # bytes of a file that are read at a time to find its first line


def _paths(paths) -> list[str]:
    return [paths] if isinstance(paths, str) else list(paths)


def _one_char(name: str, value: str) -> str:
    if len(value) != 1:
        raise ValueError(f"{name} must be one character")
    return value


def read_csv(spark: SparkSession, paths, schema, sep: str = ",", line_sep: str | None = None) -> DataFrame:
    """CSV with a header line; the columns of ``schema`` are found by their names in each header.

    A column that a file lacks, or a value that is not of its type, fails.
    """
    want = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    types = {f.name: f.dataType.simpleString() for f in want.fields}
    rows = read_csv_by_header(spark, paths, sep=_one_char("sep", sep), line_sep=line_sep and _one_char("line_sep", line_sep), need=list(types))
    return load_typed(rows.select(*[col(c) for c in types]), types, burst_cols=[])


def read_csv_noheader(spark: SparkSession, paths, names: list[str], sep: str = ",") -> DataFrame:
    """CSV without header; all columns text."""
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    r = spark.read.option("header", False).option("sep", sep).option("quote", '"').option("escape", '"')
    return r.schema(schema).csv(_paths(paths))


def read_csv_strict(spark: SparkSession, paths, schema=None, sep: str = ",") -> DataFrame:
    """Quoted CSV with header; spaces after a separator are skipped, bad lines fail."""
    r = (
        spark.read.option("header", True)
        .option("sep", sep)
        .option("quote", '"')
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", True)
        .option("mode", "FAILFAST")
    )
    if schema is not None:
        r = r.schema(schema).option("enforceSchema", False)
    return r.csv(_paths(paths))


def _first_lines(sep: bytes):
    """Paths → path and first line that isn't empty; reads no further than that line's block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lines = []
            for path in batch.column(0).to_pylist():
                store, name = located(path)
                with store.open_input_file(name) as f:
                    held = b""
                    while True:
                        block = f.read(HEAD)
                        held = (held + block).lstrip(sep + b"\r\n")
                        if not block or sep in held or (sep == b"\n" and b"\r" in held):
                            break
                line = held.split(sep, 1)[0]
                lines.append((line.splitlines() or [b""])[0].decode() if sep == b"\n" else line.decode())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(lines, pa.string())], names=["path", "header"])

    return run


def _headers(spark: SparkSession, paths: list[str], sep: str, line_sep: str | None) -> dict[tuple[str, ...], list[str]]:
    """Column names → files that have this header, by one job over all files.

    Spark lists the files; tasks open each and read its first block. In a store that only Spark
    can open, Spark's text reader is used instead, which reads the files to their ends.
    """
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(paths).select("path")
    some = listed.head(1)
    if some and is_known(some[0][0]):
        first = listed.repartition(spark.sparkContext.defaultParallelism * 2).mapInArrow(_first_lines((line_sep or "\n").encode()), "path string, header string")
        first = first.filter("length(header) > 0")
    else:
        r = spark.read.option("lineSep", line_sep) if line_sep else spark.read
        lines = r.option("recursiveFileLookup", True).text(paths).select(
            F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("at"),
            F.monotonically_increasing_id().alias("row"), "value",
        ).filter("at = 0 AND length(value) > 0")
        first = lines.groupBy("path").agg(F.min_by("value", "row").alias("header"))
    out: dict[tuple[str, ...], list[str]] = {}
    for r in first.orderBy("path").collect():  # one row per file; the reader needs their names
        names = next(csv.reader([r["header"].removeprefix("\ufeff")], delimiter=sep))
        out.setdefault(tuple(names), []).append(r["path"])
    return out


def read_csv_by_header(
    spark: SparkSession, paths, types: dict[str, str] | None = None, sep: str = ",", uniform: bool = False,
    line_sep: str | None = None, need: list[str] = (),
) -> DataFrame:
    """CSV files whose column order may differ: columns meet by header name, not position.

    One job finds the header of every file, also inside folders; files with the same header
    share one scan, which fails if a header is not what was found. ``uniform=True`` reads one
    header and lets the scan itself reject a file with another one; use it for many files of
    one writer. A file that lacks a column of ``need`` fails, another column is NULL there.
    Columns in ``types`` are cast; the others stay text.
    """
    options = {"header": True, "sep": sep, "escape": '"', "enforceSchema": False} | ({"lineSep": line_sep} if line_sep else {})
    if uniform:
        names = tuple(spark.read.options(**options).csv(_paths(paths)[0]).columns)
        headers = {names: _paths(paths)}
    else:
        headers = _headers(spark, _paths(paths), sep, line_sep)
    out = None
    for names, group in headers.items():
        lost = [c for c in need if c not in names]
        if lost:
            raise ValueError(f"columns {lost} are missing in {group[0]}")
        schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
        df = spark.read.options(**options).schema(schema).csv(group)
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    if out is None:
        names = list(need) or list(types or [])
        out = spark.createDataFrame([], T.StructType([T.StructField(n, T.StringType()) for n in names]))
    return load_typed(out, types, burst_cols=[]) if types else out


def read_json_lines(spark: SparkSession, paths, schema=None) -> DataFrame:
    """One JSON object per line; without a schema the files are read twice."""
    r = spark.read if schema is None else spark.read.schema(schema)
    return r.json(_paths(paths))


def read_json_array(spark: SparkSession, paths, schema: str | T.StructType) -> DataFrame:
    """Files that hold one JSON array of rows; adds ``file_name`` and the position ``pos``."""
    text = schema if isinstance(schema, str) else ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields
    )
    names = T.StructType.fromDDL(text).fieldNames()
    files = read_whole_files(spark, paths)
    rows = F.from_json("content", f"array<struct<{_ddl_fields(text)}>>", {"mode": "FAILFAST"})
    # outer: a plain explode would make Spark parse the text twice to filter on the size
    each = files.select("file_name", F.posexplode_outer(rows).alias("pos", "r"))
    return each.filter("pos IS NOT NULL").select(
        "file_name", F.col("pos").cast("long").alias("pos"), *[F.col("r")[n].alias(n) for n in names]
    )


def _ddl_fields(ddl: str) -> str:
    fields = T.StructType.fromDDL(ddl).fields
    return ", ".join(f"`{f.name}`: {f.dataType.simpleString()}" for f in fields)


def read_whole_files(spark: SparkSession, paths) -> DataFrame:
    """One row per file: ``file_path``, ``file_name``, ``size_bytes``, ``content`` (UTF-8)."""
    df = spark.read.text(_paths(paths), wholetext=True)
    return df.select(
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_name").alias("file_name"),
        F.col("_metadata.file_size").alias("size_bytes"),
        F.col("value").alias("content"),
    )


def _listed(pattern: str):
    """Folders → what lies in each, folders included; hidden names are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from fnmatch import fnmatchcase

        from pyarrow import fs

        for batch in batches:
            for folder in batch.column(0).to_pylist():
                store, name = located(folder)
                found = [f for f in store.get_file_info(fs.FileSelector(name)) if f.base_name[0] not in "._"]
                found = [f for f in found if f.type == fs.FileType.Directory or fnmatchcase(f.base_name, pattern)]
                yield pa.RecordBatch.from_arrays([
                    pa.array([f"{folder.rstrip('/')}/{f.base_name}" for f in found], pa.string()), pa.array([f.base_name for f in found], pa.string()),
                    pa.array([f.size if f.type == fs.FileType.File else None for f in found], pa.int64())], names=["file_path", "file_name", "size_bytes"])

    return run


_LISTING = "file_path string, file_name string, size_bytes long"


def list_files(spark: SparkSession, folder: str, pattern: str = "*", include_empty: bool = True) -> DataFrame:
    """Listing of a staging folder without reading it: ``file_path, file_name, size_bytes``.

    Tasks list the folders, a level of the tree after the other; only the question whether there
    are more of them reaches the driver. ``include_empty=False`` leaves out files without content, as
    Spark's own listing does, which also serves stores that only Spark can open (there the driver
    adds the empty files).
    """
    at = spark._jvm.org.apache.hadoop.fs.Path(folder)
    store = at.getFileSystem(spark._jsc.hadoopConfiguration())
    root = store.makeQualified(at).toString()
    if include_empty and is_known(root):
        level, out = spark.createDataFrame([(root,)], "path string"), None
        while True:
            found = checkpoint(level.repartition(spark.sparkContext.defaultParallelism).mapInArrow(_listed(pattern), _LISTING))
            files, level = found.filter("size_bytes IS NOT NULL"), found.filter("size_bytes IS NULL").select("file_path")
            out = files if out is None else out.unionAll(files)
            if level.isEmpty():
                return out
    df = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(folder)
    df = df.select(F.col("path").alias("file_path"), F.element_at(F.split("path", "/"), -1).alias("file_name"), F.col("length").alias("size_bytes"))
    if not include_empty:
        return df
    listed, empty = store.listFiles(at, True), []
    glob = spark._jvm.org.apache.hadoop.fs.GlobFilter(pattern)
    while listed.hasNext():
        status = listed.next()
        name = status.getPath().getName()
        if status.getLen() == 0 and name[0] not in "._" and glob.accept(status.getPath()):
            empty.append((status.getPath().toString(), name, 0))
    return df.unionAll(spark.createDataFrame(empty, df.schema)) if empty else df


def read_staged(spark: SparkSession, paths, fmt: str = "parquet", schema=None, logical_types: bool = True) -> DataFrame:
    """Columnar or row staging files by format name.

    ``logical_types=False`` reads the raw values of Avro logical types. The Avro reader is
    a separate Spark module; without it Spark's own message names what to add.
    """
    r = spark.read.format(fmt)
    if schema is not None:
        r = r.schema(schema)
    if fmt == "avro" and not logical_types:
        if schema is None:
            raise ValueError("reading Avro without logical types needs a schema of plain types")
    try:
        return r.load(_paths(paths))
    except Exception as ex:
        if fmt == "avro" and ("AVRO" in str(ex).upper()):
            raise RuntimeError("the spark-avro module is not on the class path") from ex
        raise


def with_provenance(df: DataFrame) -> DataFrame:
    """Add ``file_name`` of the file each row came from; use right after a scan."""
    return df.select("*", F.col("_metadata.file_name").alias("file_name"))


def load_typed(
    df: DataFrame,
    types: dict[str, str],
    burst_cols: list[str] = (OP_COL, FLAG_COL),
    generated: list[str] = (),
    on_error: str = "fail",
    allow_missing: bool = False,
) -> DataFrame:
    """Cast staged columns to the target's types.

    Generated target columns are skipped, columns unknown to the target stay text and the
    burst columns become int. ``on_error='null'`` gives NULL for a bad value instead of
    failing. A target column the data lacks is an error unless ``allow_missing`` adds it
    as NULL.
    """
    out = []
    for c in df.columns:
        if c in generated:
            continue
        if c in burst_cols:
            out.append(cast_to(col(c), "int", on_error).alias(c))
        elif c in types:
            out.append(cast_to(col(c), types[c], on_error).alias(c))
        else:
            out.append(col(c).cast("string").alias(c))
    lost = [c for c in types if c not in df.columns and c not in generated]
    if lost and not allow_missing:
        raise ValueError(f"columns missing in the staged data: {lost}")
    out += [F.lit(None).cast(types[c]).alias(c) for c in lost]
    return df.select(*out)


def _lacking(spark: SparkSession, paths: list[str]) -> list[str]:
    """Paths that match no file. One look-up per argument, not per file."""
    out = []
    for p in paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(p)
        found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
        if found is None or len(found) == 0:
            out.append(p)
    return out


def read_or_quarantine(
    spark: SparkSession, paths, schema: T.StructType | str, fmt: str = "json", on_missing: str = "fail", **options
) -> tuple[DataFrame, DataFrame]:
    """Good rows, and bad lines with their file: ``(rows, quarantine)``, for JSON or CSV lines.

    No line is lost: one that cannot be read is kept as text in ``line`` of the second frame.
    A path without a file fails the call; with ``on_missing='report'`` it is a row of the
    second frame without a line. A file that vanishes before it is read fails the job.
    """
    if on_missing not in ("fail", "report"):
        raise ValueError("on_missing must be 'fail' or 'report'")
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    wide = T.StructType([*schema.fields, T.StructField("_corrupt_record", T.StringType())])
    parse = {"json": F.from_json, "csv": lambda c, s, o: F.from_csv(c, s.simpleString(), o)}
    if fmt not in parse:
        raise ValueError("fmt must be 'json' or 'csv'")
    how = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record", **options}
    lost = _lacking(spark, _paths(paths)) if on_missing == "report" else []
    there = [p for p in _paths(paths) if p not in lost]
    if there:
        lines = spark.read.text(there).select(F.col("value").alias("line"), F.col("_metadata.file_name").alias("file_name"))
    else:
        lines = spark.createDataFrame([], "line string, file_name string")
    rows = lines.filter(F.length("line") > 0).withColumn("r", parse[fmt](F.col("line"), wide, how))
    is_bad = F.col("r._corrupt_record").isNotNull()
    good = rows.filter(~is_bad).select(*[F.col("r")[f.name].alias(f.name) for f in schema.fields])
    bad = rows.filter(is_bad).select("file_name", "line")
    if lost:
        bad = bad.unionAll(spark.createDataFrame([(p.rsplit("/", 1)[-1], None) for p in lost], "file_name string, line string"))
    return good, bad


def staged_view(spark: SparkSession, folder: str, types: dict[str, str], name: str, fmt: str = "csv", **options) -> DataFrame:
    """Read a staging folder in place under a view name."""
    schema = ", ".join(f"`{c}` {t}" for c, t in types.items())
    r = spark.read.format(fmt).schema(schema).options(**options)
    if fmt == "csv":
        r = r.option("header", True)
    df = r.load(folder)
    df.createOrReplaceTempView(name)
    return df


def insert_from_file(spark: SparkSession, t: DataFrame, paths, cols: list[str], sep: str = ",") -> DataFrame:
    """Target plus the rows of CSV files, of which only ``cols`` are taken, by name."""
    from changemill.operators.joins import append

    types = {f.name: f.dataType.simpleString() for f in t.schema.fields if f.name in cols}
    rows = read_csv_by_header(spark, paths, sep=sep).select(*[col(c) for c in cols])
    return append(t, load_typed(rows, types, burst_cols=[]))
