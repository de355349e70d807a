"""Row positions in a total order, without ever sorting a whole group in one task."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from changemill.functions.columns import col

ROW = "__mill_row"
CHUNK_BITS = 33  # layout of monotonically_increasing_id: partition above, row below


def shared_dir(spark) -> str:
    """The checkpoint folder of the cluster; a temporary one only in local mode, where none is set."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    current = spark.sparkContext.getCheckpointDir()
    if current is None:
        master = spark.sparkContext.master
        if configured is None and not re.fullmatch(r"local(\[.*\])?", master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        spark.sparkContext.setCheckpointDir(configured or tempfile.mkdtemp(prefix="mill-"))
        current = spark.sparkContext.getCheckpointDir()
    return configured or current


def checkpoint(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and cut its lineage."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def sorted_chunks(df: DataFrame, order: list[str], chunks: int | None = None) -> DataFrame:
    """``df`` range-partitioned and sorted by ``order``, with a row id in ``__mill_row``.

    Ranges are cut by row count, so a group that holds a third of all rows is spread over a
    third of the chunks. The frame is checkpointed: chunk bounds come from a sample, and
    all later steps must see the same rows in the same chunk, also after a lost executor.
    ``order`` should be unique.
    """
    n = chunks or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by = [col(c) for c in order]
    out = df.repartitionByRange(n, *by).sortWithinPartitions(*by)
    return checkpoint(out.withColumn(ROW, F.monotonically_increasing_id()))


def chunk_of(row=None):
    return F.shiftright(F.col(ROW) if row is None else row, CHUNK_BITS)


def with_position(
    df: DataFrame, order: list[str], pos_col: str = "pos", chunks: int | None = None
) -> DataFrame:
    """Add the row's place in the order of the whole frame: 0, 1, 2, … without gaps.

    One sort shuffle; then each chunk's rows are shifted by the size of the chunks before
    it. Only one number per chunk passes through the driver.
    """
    rows = sorted_chunks(df, order, chunks)
    sizes = rows.groupBy(chunk_of().alias("c")).agg(F.count(F.lit(1)).alias("n")).collect()
    shift, starts = 0, []
    for r in sorted(sizes, key=lambda r: r["c"]):
        starts.append((r["c"], shift))
        shift += r["n"]
    offsets = df.sparkSession.createDataFrame(starts, "__mill_c long, __mill_s long")
    # one row per chunk: bounded by the number of partitions, whatever the data size
    joined = rows.join(F.broadcast(offsets), chunk_of() == F.col("__mill_c"))
    place = F.col("__mill_s") + F.col(ROW).bitwiseAND(F.lit((1 << CHUNK_BITS) - 1))
    return joined.select(*[col(c) for c in df.columns], place.alias(pos_col))


def with_neighbour(df: DataFrame, cols: dict[str, str], order: list[str], group: list[str] = (), ahead: bool = False, only=None, hit: str | None = None) -> DataFrame:
    """Add to every row columns (new name → name in ``df``) of the row before it, or after it (``ahead``),
    in the order of ``group`` and ``order``; NULL where that row is of another group, doesn't satisfy
    ``only`` or isn't there. ``hit`` names a column that tells this apart from a NULL value.

    Rows are range-sorted into chunks and look at their neighbour by a window inside the chunk. Only
    the rows at the chunks' borders, one or two a chunk, are joined with those of the next chunk; the
    data is never joined with itself.
    """
    rows = sorted_chunks(df.withColumn("__mill_only", F.lit(True) if only is None else F.coalesce(only, F.lit(False))), [*group, *order])
    ends = rows.groupBy(chunk_of().alias("c")).agg(F.min(ROW).alias("lo"), F.max(ROW).alias("hi")).collect()  # one row per chunk
    ends.sort(key=lambda r: r["c"], reverse=ahead)
    edge, far = ("hi", "lo") if ahead else ("lo", "hi")
    pairs = [(b[edge], a[far]) for a, b in zip(ends, ends[1:])]  # a chunk's first row, and the last one before it
    look, chunk = F.lead if ahead else F.lag, Window.partitionBy(chunk_of()).orderBy(ROW)
    taken = {f"__mill_n{i}": col(c) for i, c in enumerate([*group, *cols.values()])} | {"__mill_hit": F.col("__mill_only")}
    seen = rows.select("*", *[look(c).over(chunk).alias(n) for n, c in taken.items()])
    if pairs:
        at_edge = F.col(ROW).isin([p for p, _ in pairs])
        met = df.sparkSession.createDataFrame(pairs, "__mill_edge long, __mill_far long")
        given = rows.filter(F.col(ROW).isin([q for _, q in pairs])).select(F.col(ROW).alias("__mill_given"), *[c.alias(n) for n, c in taken.items()])
        given = met.join(given, F.col("__mill_far") == F.col("__mill_given")).drop("__mill_far", "__mill_given")
        borders = rows.filter(at_edge).join(given, F.col(ROW) == F.col("__mill_edge"), "left").drop("__mill_edge")
        seen = seen.filter(~at_edge).unionByName(borders)
    same = F.coalesce(F.col("__mill_hit"), F.lit(False))
    for i, g in enumerate(group):
        same = same & F.col(f"__mill_n{i}").eqNullSafe(col(g))
    found = [F.when(same, F.col(f"__mill_n{len(group) + i}")).alias(n) for i, n in enumerate(cols)]
    return seen.select(*[col(c) for c in df.columns], *found, *([same.alias(hit)] if hit else []))
