"""A snapshot table whose versions are bucketed by key.

A merge into a plain table shuffles the whole target once the change set is too large to
broadcast. Here every version is written in the same hash buckets on the keys, so a merge
by plain key equality moves only the change set: the target's buckets are read where they
lie. Each version rewrites all buckets; for changes confined to some partitions use
``SnapshotTable.apply_touched`` instead.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from changemill.functions.columns import col
from changemill.sinks.snapshots import SnapshotTable


class BucketedTable(SnapshotTable):
    """``keys`` must never be NULL: merge with ``null_safe=False``."""

    def __init__(self, spark: SparkSession, root: str, keys: list[str], buckets: int):
        super().__init__(spark, root)
        self.keys, self.buckets = list(keys), buckets
        self._name = "mill_" + hashlib.sha256(self.root.encode()).hexdigest()[:16]

    def _table(self, folder: str) -> str:
        return f"{self._name}_{folder.strip('_').replace('=', '').replace('-', '_')}"

    def _write(self, df: DataFrame, folder: str) -> dict[str, str]:
        # the catalog entry only carries the bucketing; the commit decides what is current
        self.spark.sql(f"DROP TABLE IF EXISTS {self._table(folder)}")
        (
            df.write.format(self.fmt)
            .mode("overwrite")
            .bucketBy(self.buckets, *self.keys)
            .sortBy(*self.keys)
            .option("path", f"{self.root}/{folder}")
            .saveAsTable(self._table(folder))
        )
        return {"": folder}

    def _read_parts(self, schema: T.StructType, parts: dict[str, str]) -> DataFrame:
        folder = parts[""]
        name = self._table(folder)
        if not self.spark.catalog.tableExists(name):
            quoted = lambda c: "`" + c.replace("`", "``") + "`"
            by = ", ".join(quoted(k) for k in self.keys)
            cols = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in schema.fields)
            self.spark.sql(
                f"CREATE TABLE {name} ({cols}) USING {self.fmt} CLUSTERED BY ({by}) SORTED BY ({by}) "
                f"INTO {self.buckets} BUCKETS LOCATION '{self.root}/{folder}'"
            )
        return self.spark.table(name)

    def commit(self, df: DataFrame, tag: str = "write") -> int:
        """Write ``df``, whatever its partitioning, as the whole new content."""
        return super().commit(df.repartition(self.buckets, *[col(k) for k in self.keys]), tag)

    def apply(self, fn, b: DataFrame, tag: str = "apply") -> int:
        """``fn(target, b)`` becomes the new content; only ``b`` is moved.

        The change set is hashed into the table's buckets first, so its rows, too, are
        written by one task per bucket.
        """
        b = b.repartition(self.buckets, *[col(k) for k in self.keys])
        return super().commit(fn(self.read(), b), tag)

    def append(self, df: DataFrame, tag: str = "append", new_columns: str = "fail") -> int:
        raise NotImplementedError("a bucketed table has no appends; merge into it")

    def write_slice(self, df: DataFrame, slice_no: int, total: int, tag: str = "slices") -> bool:
        raise NotImplementedError("a bucketed table has no slices; commit it whole")
