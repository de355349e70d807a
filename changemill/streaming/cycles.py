"""Integrate and publish cycles as Structured Streaming queries.

Every micro-batch is one cycle over the files that arrived. The checkpoint knows which
files are done; a commit tag per query and batch makes a replayed batch harmless.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from changemill.plans.integrate import integrate, plain_changes
from changemill.sinks.message_log import FORMAT as MESSAGES
from changemill.sinks.message_log import MessageLog
from changemill.sinks.snapshots import SnapshotTable
from changemill.sources.cycle_source import FORMAT as CYCLES
from changemill.sources.cycle_source import CycleSource
from changemill.spec import ApplySpec


def staged_stream(
    spark: SparkSession, folder: str, schema, fmt: str = "parquet", table: str | None = None, ext: str | None = None, max_files: int | None = None, **options
) -> DataFrame:
    """Files of a staging folder as a stream; ``table`` takes only ``<stamp>-<table>.<ext>``."""
    r = spark.readStream.format(fmt).schema(schema).options(**options)
    if table is not None:
        r = r.option("pathGlobFilter", f"*-{table}.{ext or fmt}")
    if max_files is not None:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.load(folder)


def cycle_stream(spark: SparkSession, folder: str, schema) -> DataFrame:
    """Staged cycles as a stream: each is offered once its manifest and all its files are there."""
    spark.dataSource.register(CycleSource)
    return spark.readStream.format(CYCLES).schema(schema).load(folder)


def message_stream(source: DataFrame, path: str, checkpoint: str, tag: str = "", once: bool = True) -> StreamingQuery:
    """Send every micro-batch to a message log; a batch is committed once, whatever is repeated."""
    source.sparkSession.dataSource.register(MessageLog)
    w = source.writeStream.format(MESSAGES).option("checkpointLocation", checkpoint).option("tag", tag)
    return (w.trigger(availableNow=True) if once else w).start(path)


def _start(source: DataFrame, name: str, checkpoint: str, each, once: bool) -> StreamingQuery:
    w = source.writeStream.queryName(name).foreachBatch(each).option("checkpointLocation", checkpoint)
    return (w.trigger(availableNow=True) if once else w).start()


def apply_stream(
    source: DataFrame,
    table: SnapshotTable,
    spec: ApplySpec,
    checkpoint: str,
    name: str = "apply",
    apply_fn: Callable[[DataFrame, DataFrame, ApplySpec], DataFrame] = integrate,
    touched_only: bool = False,
    once: bool = True,
) -> StreamingQuery:
    """Apply every micro-batch to a table.

    ``apply_fn(target, changes, spec)`` gives the new target. A history that takes all rows
    is appended to; nothing is rewritten. ``touched_only`` rewrites only the partitions that
    occur in the batch. Plain changes are merged by readers until they outweigh the table
    (``SnapshotTable.apply_changes``).
    """

    def each(batch: DataFrame, batch_id: int) -> None:
        _apply_batch(batch, table, spec, f"{name}-{batch_id}", apply_fn, touched_only)

    return _start(source, name, checkpoint, each, once)


def _apply_batch(batch: DataFrame, table: SnapshotTable, spec: ApplySpec, tag: str, apply_fn, touched_only: bool) -> None:
    if table.is_committed(tag):
        return
    if spec.style == "history" and not spec.merge_history and apply_fn is integrate:
        table.append(batch, tag, spec.new_columns)
        return
    fn = lambda t, b: apply_fn(t, b, spec)
    if apply_fn is integrate and not touched_only and table.exists() and plain_changes(spec, batch.columns, table.schema().fieldNames()):
        table.apply_changes(fn, batch, spec.merge_keys, spec.op_col, spec.null_safe, tag)
        return
    (table.apply_touched if touched_only else table.apply)(fn, batch, tag)


def staged_files(spark: SparkSession, root: str, pattern: str, max_files: int = 1000) -> DataFrame:
    """The files that arrive below ``root`` as a stream of ``tbl_name`` and ``path``, unread.

    The table is the first group of ``pattern`` in the path. One listing and one offset log serve
    all tables.
    """
    files = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary")
    files = files.option("recursiveFileLookup", True).option("maxFilesPerTrigger", max_files).load(root)
    return files.select(F.regexp_extract("path", pattern, 1).alias("tbl_name"), "path").filter("tbl_name <> ''")


def apply_tables(
    files: DataFrame,
    tables: dict[str, SnapshotTable],
    specs: dict[str, ApplySpec],
    schemas: dict,
    checkpoint: str,
    fmt: str = "parquet",
    name: str = "apply",
    side_by_side: int = 8,
    apply_fn: Callable[[DataFrame, DataFrame, ApplySpec], DataFrame] = integrate,
    once: bool = True,
) -> StreamingQuery:
    """Many tables from one stream of staged files (``staged_files``): one cycle per micro-batch.

    Only file names, at most the stream's files per trigger, pass the driver; each table's files
    are read as one scan with the schema of ``schemas`` and applied under the table's own commit
    tag, ``side_by_side`` tables at a time. If some tables fail the others are committed and the
    batch fails; when it is replayed, the committed ones are left alone. Files of a table without
    an entry in ``tables`` fail the batch before any table is touched.
    """
    spark = files.sparkSession

    def each(batch: DataFrame, batch_id: int) -> None:
        paths: dict[str, list[str]] = {}
        for r in batch.select("tbl_name", "path").collect():
            paths.setdefault(r["tbl_name"], []).append(r["path"])
        strange = sorted(set(paths) - set(tables))
        if strange:
            raise ValueError(f"files of unknown tables: {strange[:5]}")

        def one(t: str) -> None:
            rows = spark.read.schema(schemas[t]).format(fmt).load(sorted(paths[t]))
            _apply_batch(rows, tables[t], specs[t], f"{name}-{batch_id}", apply_fn, False)

        with ThreadPoolExecutor(side_by_side) as pool:
            done = {t: pool.submit(one, t) for t in sorted(paths)}
        failed = {t: f.exception() for t, f in done.items() if f.exception() is not None}
        if failed:
            t, e = next(iter(failed.items()))
            raise RuntimeError(f"{len(failed)} of {len(paths)} tables failed, {t}: {e}") from e

    return _start(files, name, checkpoint, each, once)


def apply_streams(
    sources: dict[str, DataFrame],
    tables: dict[str, SnapshotTable],
    specs: dict[str, ApplySpec],
    checkpoint: str,
    once: bool = True,
) -> list[StreamingQuery]:
    """Several tables from one staging root: one query per table, run side by side."""
    return [
        apply_stream(sources[t], tables[t], specs[t], f"{checkpoint}/{t}", f"apply_{t}", once=once)
        for t in sources
    ]


def publish_stream(
    source: DataFrame,
    reshape: Callable[[DataFrame], DataFrame],
    sink: Callable[[DataFrame, int], None],
    checkpoint: str,
    name: str = "publish",
    once: bool = True,
) -> StreamingQuery:
    """Reshape every micro-batch into messages and hand it to ``sink(messages, batch_id)``.

    A batch may be handed over again after a failure, with the same id; a sink that writes
    by batch id (see ``sinks.files.journal``) then replaces what it wrote.
    """
    return _start(source, name, checkpoint, lambda b, i: sink(reshape(b), i), once)
