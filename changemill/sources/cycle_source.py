"""A stream of staged cycles: a cycle is read only when its manifest and all its files are there.

    spark.dataSource.register(CycleSource)
    spark.readStream.format("mill_cycles").schema(schema).load(folder)

Folder layout: ``manifests/<cycle>.json`` holds ``{"files": [names below the folder]}`` with an
optional ``{"tables": {file: table}}``; cycles are numbered and read in order. The stream's offset
is the last cycle offered. A cycle with a file that hasn't arrived holds the stream back, as do the
ones after it: they may change the same rows. Files that no manifest names are never read. A
manifest that names no file is a cycle without rows. Whoever clears staged cycles deletes the
manifest before the files. Several complete cycles may come in one batch; ``cycle`` orders them.

Each file (Parquet or JSON lines, by ending) is one task's work, read in Arrow batches. Fields of
the schema named ``cycle``, ``file_name`` and ``tbl_name`` are filled in; fields that a file lacks
are NULL.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark import cloudpickle
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

from changemill.sinks.store import Store

cloudpickle.register_pickle_by_value(sys.modules[__name__])

FORMAT = "mill_cycles"
NONE = -1  # the offset before the first cycle


@dataclass
class StagedFile(InputPartition):
    cycle: int
    name: str
    table: str


def manifests(store: Store) -> list[int]:
    names = (n.removesuffix(".json") for n in store.names("manifests") if n.endswith(".json"))
    return sorted(int(n) for n in names if n.isdecimal())


def files_of(store: Store, cycle: int) -> dict[str, str]:
    """File → table of a cycle."""
    said = store.read_json(f"manifests/{cycle}.json")
    tables = said.get("tables", {})
    return {f: tables.get(f, "") for f in said["files"]}


def complete_until(store: Store, after: int) -> int:
    """The last cycle that can be read: all cycles up to it have all their files."""
    for cycle in (c for c in manifests(store) if c > after):
        if None in store.sizes(list(files_of(store, cycle))):
            break
        after = cycle
    return after


def waiting(store: Store, after: int = NONE) -> list[tuple[int, int, int]]:
    """(cycle, files listed, files missing) of the cycles after ``after``."""
    out = []
    for cycle in (c for c in manifests(store) if c > after):
        sizes = store.sizes(list(files_of(store, cycle)))
        out.append((cycle, len(sizes), sizes.count(None)))
    return out


class CycleReader(DataSourceStreamReader):
    def __init__(self, path: str, schema: StructType) -> None:
        self.store, self.schema, self.known = Store(path), schema, NONE

    def initialOffset(self) -> dict:
        return {"cycle": NONE}

    def latestOffset(self) -> dict:
        self.known = complete_until(self.store, self.known)
        return {"cycle": self.known}

    def partitions(self, start: dict, end: dict) -> list[StagedFile]:
        cycles = [c for c in manifests(self.store) if start["cycle"] < c <= end["cycle"]]
        return [StagedFile(c, f, t) for c in cycles for f, t in files_of(self.store, c).items()] or [StagedFile(NONE, "", "")]

    def read(self, partition: StagedFile) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        if not partition.name:
            return
        schema = to_arrow_schema(self.schema)
        given = {"cycle": partition.cycle, "file_name": partition.name, "tbl_name": partition.table or None}
        with self.store.fs.open_input_file(partition.name) as f:
            if partition.name.endswith(".parquet"):
                file = pq.ParquetFile(f)
                batches = file.iter_batches(batch_size=8192, columns=[n for n in schema.names if n in file.schema_arrow.names])
            else:
                from pyarrow import json

                wanted = pa.schema([x for x in schema if x.name not in given])
                batches = json.open_json(f, parse_options=json.ParseOptions(explicit_schema=wanted, unexpected_field_behavior="ignore"))
            for batch in batches:
                cols = [
                    pa.array([given[x.name]] * batch.num_rows, x.type) if x.name in given
                    else batch.column(x.name).cast(x.type) if x.name in batch.schema.names else pa.nulls(batch.num_rows, x.type)
                    for x in schema
                ]
                yield pa.RecordBatch.from_arrays(cols, schema=schema)

    def commit(self, end: dict) -> None:
        """The staged files stay: the checkpoint knows what was read."""


class CycleSource(DataSource):
    """Option: ``path``."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self):
        raise ValueError("give the schema of the staged rows")

    def streamReader(self, schema: StructType) -> CycleReader:
        return CycleReader(self.options["path"], schema)


def write_manifest(path: str, cycle: int, files: list[str], tables: dict[str, str] | None = None) -> None:
    """Announce a cycle; its files may come before or after."""
    Store(path).write_json(f"manifests/{cycle}.json", {"files": files, **({"tables": tables} if tables else {})})
