"""What the operators of this folder share: text forms, shared folders, Arrow helpers."""

from __future__ import annotations

import gc
import sys
import uuid

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from changemill.operators.ordering import shared_dir

cloudpickle.register_pickle_by_value(sys.modules[__name__])

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: A word, as Spark and DuckDB read it. bytes.split() cuts UTF-8 text at the same bytes.
WORD = r"[^\x20\x09-\x0D]+"

M64 = np.uint64(0xFFFFFFFFFFFFFFFF)


def text_of(col: str) -> Column:
    """The text; NULL counts as empty."""
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def lower_ascii(text: Column) -> Column:
    """A-Z become a-z; every other character stays."""
    return F.translate(text, UPPER, LOWER)


def crc_mod(id_col: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; a NULL id counts as empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % modulus


def scratch(spark: SparkSession, what: str) -> str:
    """A fresh folder in the shared checkpoint folder."""
    return f"{shared_dir(spark).rstrip('/')}/llm-{what}-{uuid.uuid4().hex[:12]}"


def settled(df: DataFrame, what: str) -> DataFrame:
    """``df`` written to the shared folder and read again: computed once, lineage cut."""
    path = scratch(df.sparkSession, what)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of intermediate rows that nothing will read any more."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def release(spark: SparkSession) -> None:
    """Let Spark drop the shuffle files of plans that are no longer referenced.

    Its cleaner waits for the driver's garbage collection, which a driver with little to do
    may put off for half an hour.
    """
    gc.collect()
    spark._jvm.System.gc()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class WordHashes(dict):
    """64-bit hash of a word, kept for words seen before; the store is emptied when large."""

    def __init__(self, limit: int = 1 << 19) -> None:
        super().__init__()
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        from xxhash import xxh3_64_intdigest

        if len(self) >= self.limit:
            self.clear()
        value = self[word] = xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def window_hashes(words: np.ndarray, width: int, seed: int = 0) -> np.ndarray:
    """One hash for each run of ``width`` words; empty where there are fewer words."""
    n = len(words) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.full(n, np.uint64((seed + 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF), np.uint64)
    for k in range(width):
        out *= np.uint64(0xD6E8FEB86659FD93)
        out += words[k:k + n]
        out ^= out >> np.uint64(32)
    return mix64(out)


def arrow_type(kind: str) -> pa.DataType:
    return {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "string": pa.string(),
            "boolean": pa.bool_(), "double": pa.float64()}[kind]


def arrow_schema(ddl: str) -> pa.Schema:
    """The Arrow form of a flat ``name type, …`` schema."""
    return pa.schema([(n, arrow_type(t)) for n, t in (f.split() for f in ddl.split(","))])


def rows_of(batches):
    """The rows of Arrow batches as tuples, one batch held at a time."""
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)


def batches_of(rows, schema: pa.Schema, size: int = 2048):
    """Tuples as Arrow batches of at most ``size`` rows."""
    held = []
    for r in rows:
        held.append(r)
        if len(held) >= size:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), schema.types)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), schema.types)], schema=schema)
