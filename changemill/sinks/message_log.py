"""A message sink with a commit: a Spark data source that batch and stream queries write to.

    spark.dataSource.register(MessageLog)
    send(msgs, ["dest", "partition_id"], ["seq"]).write.format("mill_messages").mode("append").save(path)
    msgs.writeStream.format("mill_messages").option("checkpointLocation", c).start(path)
    spark.read.format("mill_messages").load(path)

Every task writes its messages, in the order they come, to a private part with a name of its
own. The driver then commits the names of all parts in one small file; only what a commit names
is read. A task that fails and runs again, or runs twice, leaves a part that no commit names, so
no message is sent twice and none of a failed query is seen. A stream's batch is committed under
its number (and the query's ``tag``): a batch that is replayed finds its commit and drops its new
parts. ``mode("overwrite")`` makes a commit that readers begin from.

Commits carry rows and bytes of each part, so what was sent is known without reading it.
"""

from __future__ import annotations

import sys
import time
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    DataSourceStreamArrowWriter,
    InputPartition,
    WriterCommitMessage,
)
from pyspark.sql.types import LongType, StringType, StructField, StructType

from changemill.functions.columns import col
from changemill.sinks.store import Store

cloudpickle.register_pickle_by_value(sys.modules[__name__])

FORMAT = "mill_messages"
PLACES = [StructField("commit", StringType()), StructField("part", LongType()), StructField("place", LongType())]  # of a message read back


@dataclass
class Part(WriterCommitMessage):
    """What a task wrote."""

    task: int
    name: str
    n_rows: int
    n_bytes: int


@dataclass
class Committed(InputPartition):
    commit: str
    part: int
    name: str


def send(msgs: DataFrame, dest: list[str], order: list[str], ordered: bool = True) -> DataFrame:
    """The messages as they are to be written: all of one ``dest`` by one task, in order; with
    ``ordered=False`` by ranges, so that several tasks share a large destination, whose order is
    then that of the parts' numbers and places."""
    by = [col(c) for c in [*dest, *order]]
    dealt = msgs.repartition(*[col(c) for c in dest]) if ordered and dest else msgs.repartitionByRange(*by)
    return dealt.sortWithinPartitions(*by)


def _commits(store: Store) -> list[str]:
    """Names ``<number>~<tag>.json``; two writers may share a number, no tag is committed twice."""
    return [n for n in store.names("commits") if n.endswith(".json")]


def committed(store: Store) -> list[dict]:
    """The commits in order, from the last one that replaced all before it."""
    found = [{"commit": n.partition("~")[2].removesuffix(".json"), **store.read_json(f"commits/{n}")} for n in _commits(store)]
    first = max((i for i, c in enumerate(found) if c["replace"]), default=0)
    return found[first:]


class _Writer:
    """Of a batch or a stream."""

    def __init__(self, path: str, tag: str, replace: bool) -> None:
        self.store, self.tag, self.replace = Store(path), tag, replace

    def write(self, batches: Iterator[pa.RecordBatch]) -> Part:
        from pyspark import TaskContext

        context = TaskContext.get()
        name, n_rows, writer = f"parts/{uuid.uuid4().hex}.parquet", 0, None
        self.store.fs.create_dir("parts")
        for batch in batches:  # one batch in memory; a row group each
            if writer is None and batch.num_rows:
                writer = pq.ParquetWriter(name, batch.schema, filesystem=self.store.fs)
            if batch.num_rows:
                writer.write_batch(batch)
                n_rows += batch.num_rows
        if writer is None:
            return Part(context.partitionId(), "", 0, 0)
        writer.close()
        return Part(context.partitionId(), name, n_rows, self.store.sizes([name])[0])

    def _commit(self, messages: list[Part | None], tag: str) -> None:
        parts = sorted((m for m in messages if m is not None and m.n_rows), key=lambda m: m.task)
        done = _commits(self.store)
        if any(n.partition("~")[2] == f"{tag}.json" for n in done):  # a replayed batch
            self.store.delete([m.name for m in parts])
            return
        number = 1 + max((int(n.partition("~")[0]) for n in done), default=-1)
        self.store.write_json(f"commits/{number:012d}~{tag}.json", {"replace": self.replace, "parts": [[m.name, m.n_rows, m.n_bytes] for m in parts]})

    def _abort(self, messages: list[Part | None]) -> None:
        self.store.delete([m.name for m in messages if m is not None and m.n_rows])


class BatchWriter(_Writer, DataSourceArrowWriter):
    def commit(self, messages) -> None:
        self._commit(messages, self.tag or uuid.uuid4().hex)

    def abort(self, messages) -> None:
        self._abort(messages)


class StreamWriter(_Writer, DataSourceStreamArrowWriter):
    def commit(self, messages, batchId: int) -> None:
        self._commit(messages, f"{self.tag or 'stream'}-{batchId}")

    def abort(self, messages, batchId: int) -> None:
        self._abort(messages)


class Reader(DataSourceReader):
    def __init__(self, path: str) -> None:
        self.store = Store(path)

    def partitions(self) -> list[Committed]:
        return [Committed(c["commit"], i, p[0]) for c in committed(self.store) for i, p in enumerate(c["parts"])]

    def read(self, partition: Committed) -> Iterator[pa.RecordBatch]:
        place = 0
        with self.store.fs.open_input_file(partition.name) as f:
            for batch in pq.ParquetFile(f).iter_batches(batch_size=4096):
                n = batch.num_rows
                where = [pa.array([partition.commit] * n), pa.array([partition.part] * n, pa.int64()), pa.array(range(place, place + n), pa.int64())]
                yield pa.RecordBatch.from_arrays([*where, *batch.columns], names=["commit", "part", "place", *batch.schema.names])
                place += n


class MessageLog(DataSource):
    """Options: ``path``; ``tag`` names a batch (a second write of it is dropped) or a stream's query."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self):
        from pyspark.sql.pandas.types import from_arrow_schema

        store = Store(self.options["path"])
        for c in committed(store):
            for name, *_ in c["parts"]:
                with store.fs.open_input_file(name) as f:
                    fields = from_arrow_schema(pq.read_schema(f)).fields
                return StructType([*PLACES, *fields])
        raise ValueError("nothing was committed yet: give the schema")

    def reader(self, schema: StructType) -> Reader:
        return Reader(self.options["path"])

    def writer(self, schema: StructType, overwrite: bool) -> BatchWriter:
        return BatchWriter(self.options["path"], self.options.get("tag", ""), overwrite)

    def streamWriter(self, schema: StructType, overwrite: bool) -> StreamWriter:
        return StreamWriter(self.options["path"], self.options.get("tag", ""), False)


def sent(spark, path: str) -> DataFrame:
    """What was committed: commit, n_parts, n_rows, n_bytes, without reading any message."""
    rows = [(c["commit"], len(c["parts"]), sum(p[1] for p in c["parts"]), sum(p[2] for p in c["parts"])) for c in committed(Store(path))]
    return spark.createDataFrame(rows, "commit string, n_parts long, n_rows long, n_bytes long")


def drop_orphans(path: str, older_than: float = 86_400) -> int:
    """Delete parts that no commit names and that are older than a running write can be (seconds)."""
    from pyarrow import fs

    store = Store(path)
    named = {p[0] for n in _commits(store) for p in store.read_json(f"commits/{n}")["parts"]}
    found = store.fs.get_file_info(fs.FileSelector("parts", allow_not_found=True))
    old = [f"parts/{f.base_name}" for f in found if f"parts/{f.base_name}" not in named and f.mtime.timestamp() < time.time() - older_than]
    store.delete(old)
    return len(old)
