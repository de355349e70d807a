"""One publish cycle as one plan: rows of change files to packed messages."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changemill.functions.columns import col
from changemill.operators import images, messages, packing
from changemill.operators.ordering import checkpoint
from changemill.spec import OP_COL


@dataclass(frozen=True)
class PublishSpec:
    """How the rows of change files become messages, one message per file.

    ``file_cols`` name a file and ``file_order`` sorts the files of a partition; ``pos_col``
    is the row's gap-free position in its file. ``collapse`` is ``changed``, ``all`` or None
    (rows pass as they are, as in a refresh). With ``end_col`` the last row of a transaction
    within its partition is marked; it is then kept even if nothing changed in it.
    """

    columns: tuple[str, ...]
    file_cols: tuple[str, ...]
    file_order: tuple[str, ...]
    pos_col: str = "pos"
    op_col: str = OP_COL
    collapse: str | None = "changed"
    discard: bool = False
    ignore: tuple[str, ...] = ()
    prefix: str = "Old&"
    tx_col: str | None = None
    integ_col: str | None = None
    partitions: int = 1
    end_col: str | None = None
    dest: tuple[str, ...] = ()
    max_bytes: int = messages.MESSAGE_LIMIT


def reshape_rows(rows: DataFrame, spec: PublishSpec) -> DataFrame:
    """The rows that are sent, each with its JSON ``value`` and its ``partition_id``."""
    tx = spec.integ_col or spec.tx_col
    out = rows.withColumn("partition_id", F.lit(0))
    if tx is not None:
        out = messages.tx_partition(out, spec.partitions, spec.tx_col, spec.integ_col)
    added = [c for c in out.columns if c not in spec.columns and c not in (spec.op_col, spec.pos_col)]
    if spec.collapse is not None:
        ignore = [*spec.ignore, *added] + ([spec.end_col] if spec.end_col else [])
        out = images.collapse_updates(
            out, [spec.pos_col], list(spec.file_cols), spec.op_col, spec.collapse, ignore, spec.prefix, spec.pos_col
        )
    if spec.end_col is not None and tx is not None:
        order = [*spec.file_order, spec.pos_col]
        out = images.mark_tx_end(out, [tx], order, spec.end_col, ["partition_id"])
    if spec.collapse is None:
        body = F.struct(*[col(c) for c in spec.columns])
        return out.withColumn("value", F.to_json(body, {"ignoreNullFields": "false"}))
    if spec.discard:
        out = images.discard_unchanged(out, spec.end_col if tx is not None else None)
    return images.collapsed_json(out, list(spec.columns), spec.prefix, spec.collapse)


def publish_plan(rows: DataFrame, spec: PublishSpec) -> DataFrame:
    """Messages: destination, partition, file, ``value`` and ``batch_no``.

    Messages of a partition keep the order of their files; a file over the limit fails at
    once. The reshaped rows are checkpointed: they are read for their sizes, by which the
    batches are made, and again for the payload, which is shuffled only once, by file.
    """
    order = list(dict.fromkeys([*spec.file_order, *spec.file_cols]))
    place = [*spec.dest, "partition_id"]
    file = list(dict.fromkeys([*place, *order]))
    sent = checkpoint(reshape_rows(rows, spec).select(*[col(c) for c in [*file, spec.pos_col, "value"]]))
    stop = F.raise_error(F.lit(f"a file exceeds {spec.max_bytes} bytes as one message")).cast("long")
    size = F.when(F.col("n_bytes") > spec.max_bytes, stop).otherwise(F.col("n_bytes"))
    sizes = messages.file_sizes(sent, file).withColumn("n_bytes", size)
    batches = packing.pack_batches(sizes, order, place, spec.max_bytes, size_col="n_bytes")
    payload = messages.rows_to_file_messages(sent, file, [spec.pos_col], max_bytes=None)
    return payload.join(batches.drop("n_bytes"), file)
