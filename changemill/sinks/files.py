"""Writing tables and messages to plain files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changemill.functions.columns import col
from changemill.operators.joins import key_side, key_test, spread, touched
from changemill.operators.ordering import with_position


def convert_copy(df: DataFrame, name: str, suffix: str = "_orc", fmt: str = "orc", path: str | None = None) -> str:
    """Append the rows to table ``name + suffix`` in another format; gives the table's name."""
    w = df.write.format(fmt).mode("append")
    if path is not None:
        w = w.option("path", path)
    w.saveAsTable(name + suffix)
    return name + suffix


def discard(df: DataFrame) -> int:
    """Read everything, keep nothing; gives the number of files read."""
    df.write.format("noop").mode("overwrite").save()
    return len(df.inputFiles())


def write_partitioned(df: DataFrame, path: str, by: list[str], mode: str = "overwrite") -> None:
    """Write by partition columns, replacing only the partitions that occur in ``df``.

    Rows are rebalanced by partition first: few files per partition, and a partition with
    most of the rows is split over several tasks.
    """
    out = df.hint("rebalance", *[col(c) for c in by]) if by else df
    w = out.write.mode(mode).option("partitionOverwriteMode", "dynamic")
    (w.partitionBy(*by) if by else w).parquet(path)


def write_touched(new: DataFrame, path: str, by: list[str], b: DataFrame) -> None:
    """Replace the partitions of the Parquet table at ``path`` that occur in the change set ``b``
    by ``new`` (see ``plans.integrate.integrate_touched``).

    Old files of a partition that got no rows are deleted after the others are replaced; their number
    is bounded by the files of the partitions that are rewritten. The schema of ``path`` is kept.
    """
    spark = new.sparkSession
    files = spark.read.parquet(path).select(*[col(c) for c in by], F.col("_metadata.file_path").alias("__mill_file"))
    old = [r[0] for r in touched(files, b, by).select("__mill_file").distinct().collect()]
    write_partitioned(new, path, by)
    for name in old:
        at = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(name))
        store = at.getFileSystem(spark._jsc.hadoopConfiguration())
        if store.exists(at):
            store.delete(at, False)


def write_messages(msgs: DataFrame, path: str, dest: list[str], order: list[str], batch_id: int | None = None) -> None:
    """Messages as JSON rows in one folder per destination, in order.

    With ``batch_id`` they go to a folder of that cycle, which a retry replaces; without it
    every call appends.

    The order of a destination is the order of its file names, then of the lines. Ranges
    are cut by rows, so a large destination fills several files.
    """
    by = [col(c) for c in [*dest, *order]]
    out = msgs.repartitionByRange(*by).sortWithinPartitions(*by)
    if batch_id is None:
        out.write.mode("append").partitionBy(*dest).json(path)
    else:
        out.write.mode("overwrite").partitionBy(*dest).json(f"{path}/cycle={batch_id:08d}")


def publish(msgs: DataFrame, send, dest: list[str], order: list[str], ordered: bool = True) -> None:
    """Hand the messages in order to ``send(rows)``, called once per task on the executors.

    ``ordered``: all messages of a destination go through one task, one after the other, as
    a receiver that keeps the order of arrival needs; ``dest`` should name its partition
    too, so that partitions are sent side by side. Otherwise each task holds one contiguous
    range and a large destination is sent by several at once. A task may run again after a
    failure: the receiver has to accept repeats.
    """
    by = [col(c) for c in [*dest, *order]]
    dealt = msgs.repartition(*[col(c) for c in dest]) if ordered and dest else msgs.repartitionByRange(*by)
    if ordered and not dest:
        dealt = msgs.coalesce(1)
    dealt.sortWithinPartitions(*by).foreachPartition(send)


def journal(msgs: DataFrame, path: str, channel: str, location: str, batch_id: int, by: list[str] = ("partition_id",),
            order: list[str] = (), value_col: str = "value") -> None:
    """Keep the messages of a batch: one folder per channel, location, cycle and partition.

    Rows have their place in the order of sending in ``sequence``, from 0 in each folder, and
    stand in that order in its files. ``order`` sorts the messages of a batch. Places come from a
    range sort, so a large folder is numbered and written by several tasks. A repeated batch
    replaces its own journal.
    """
    target = f"{path}/{channel}/{location}/cycle={batch_id:08d}"
    by, taken = list(by), {"batch_no"} & set(msgs.columns)
    sort = [*taken, *[c for c in order if c not in taken]] or [value_col]
    rows = msgs.select(*[col(c) for c in dict.fromkeys([*by, *sort, value_col])])
    rows = with_position(rows, list(dict.fromkeys([*by, *sort])), "__mill_place")
    first = rows.groupBy(*key_side(rows, by)).agg(F.min("__mill_place").alias("__mill_first"))
    # a row for each folder; the messages are the side that Spark may split
    rows = rows.join(spread(first), key_test(by, True), "left")
    place = (F.col("__mill_place") - F.col("__mill_first")).alias("sequence")
    keep = [col(c) for c in by] + [F.col("batch_no")] * (bool(taken) and "batch_no" not in by)
    rows = rows.select(*keep, place, col(value_col))
    rows.sortWithinPartitions(*[col(c) for c in by], "sequence").write.mode("overwrite").partitionBy(*by).json(target)
