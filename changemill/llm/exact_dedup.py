"""Exact duplicates by compressed radix tries that own the texts.

Every task inserts the full byte strings of its texts into a trie whose terminal nodes hold
the winning identifier, the number of rows and the number of rows that tie for the win. A
trie that outgrows its budget gives up whole subtrees, the heaviest first. The tries' terminal
nodes are then partitioned by length and content hash and inserted into a second trie, so a
text of which a third of all rows are copies sends one row per task. A subtree given up there
goes into another round over more partitions; rounds end when nothing was given up.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changemill.llm.common import arrow_schema, lower_ascii, scratch, text_of

cloudpickle.register_pickle_by_value(sys.modules[__name__])

_PART = "text binary, id long, n long, ties long"
_OWNER = "text binary, sha string, length long, id long, n long, ties long"
NODE_BYTES = 400  # what a node takes besides its label


class Node:
    __slots__ = ("label", "children", "value")

    def __init__(self, label: bytes, value: tuple | None = None) -> None:
        self.label, self.children, self.value = label, {}, value


def better(a: tuple, b: tuple, largest: bool) -> tuple:
    """The merged terminal value (identifier, rows, ties) of two; a NULL identifier loses."""
    if a[0] == b[0]:
        return a[0], a[1] + b[1], a[2] + b[2]
    a_wins = b[0] is None or (a[0] is not None and (a[0] > b[0]) == largest)
    best = a if a_wins else b
    return best[0], a[1] + b[1], best[2]


class Trie:
    """A compressed radix trie over byte strings; knows how many bytes it holds."""

    def __init__(self, largest: bool) -> None:
        self.root, self.bytes, self.largest = Node(b""), 0, largest

    def insert(self, key: bytes, value: tuple) -> None:
        node, at = self.root, 0
        while at < len(key):
            child = node.children.get(key[at])
            if child is None:
                node.children[key[at]] = Node(key[at:], value)
                self.bytes += len(key) - at + NODE_BYTES
                return
            if key.startswith(child.label, at):
                node, at = child, at + len(child.label)
                continue
            shared = common_prefix(child.label, key[at:at + len(child.label)])
            middle = Node(child.label[:shared])
            child.label = child.label[shared:]
            middle.children[child.label[0]] = child
            node.children[key[at]] = middle
            self.bytes += NODE_BYTES
            node, at = middle, at + shared
        node.value = value if node.value is None else better(node.value, value, self.largest)

    def items(self, node: Node | None = None, prefix: bytes = b"") -> Iterator[tuple[bytes, tuple]]:
        """Texts and values below ``node``, whose own path is ``prefix``."""
        todo = [(node or self.root, prefix)]
        while todo:
            node, path = todo.pop()
            if node.value is not None:
                yield path, node.value
            todo += [(c, path + c.label) for c in node.children.values()]

    def give_up(self, budget: int) -> Iterator[tuple[bytes, Node]]:
        """Detach the heaviest subtrees until half of ``budget`` is left."""
        top, path = self.root, b""
        while len(top.children) == 1 and top.value is None:
            top = next(iter(top.children.values()))
            path += top.label
        sizes = sorted(((weight(c), k) for k, c in top.children.items()), reverse=True)
        for size, k in sizes:
            if self.bytes <= budget // 2:
                return
            child = top.children.pop(k)
            self.bytes -= size
            yield path + child.label, child


def weight(node: Node) -> int:
    total, todo = 0, [node]
    while todo:
        node = todo.pop()
        total += len(node.label) + NODE_BYTES
        todo += node.children.values()
    return total


def common_prefix(a: bytes, b: bytes) -> int:
    low, high = 0, min(len(a), len(b))
    while low < high:
        mid = (low + high + 1) // 2
        if a[low:mid] == b[low:mid]:
            low = mid
        else:
            high = mid - 1
    return low


def _combine(largest: bool, budget: int):
    """Rows of a task → the terminal nodes of its trie; subtrees given up are sent on at once."""
    schema = arrow_schema(_PART)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = Trie(largest)
        for batch in batches:
            for text, i in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                trie.insert(text.as_py().lower(), (i, 1, 1))
                if trie.bytes > budget:
                    for path, node in trie.give_up(budget):
                        yield from pack(trie.items(node, path), schema)
        yield from pack(trie.items(), schema)

    return run


def _own(largest: bool, budget: int):
    """Terminal nodes of one partition → owners; what was given up keeps its text."""
    schema = arrow_schema(_OWNER)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, closed = Trie(largest), ()
        for batch in batches:
            again = []
            for text, i, n, ties in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if closed and text.startswith(closed):
                    again.append((text, (i, n, ties)))
                    continue
                trie.insert(text, (i, n, ties))
                if trie.bytes > budget:
                    for path, node in trie.give_up(budget):
                        closed += (path,)
                        yield from pack(trie.items(node, path), schema, done=False)
            yield from pack(iter(again), schema, done=False)
        yield from pack(trie.items(), schema, done=True)

    return run


def pack(items: Iterator[tuple[bytes, tuple]], schema: pa.Schema, done: bool | None = None, most: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Rows of at most ``most`` bytes at a time, or one row."""
    rows, size = [], 0
    for text, value in items:
        if done is None:
            rows.append((text, *value))
        elif done:
            rows.append((None, hashlib.sha256(text).hexdigest(), len(text), *value))
        else:
            rows.append((text, None, None, *value))
        size += len(text) + 64
        if size > most:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
            rows, size = [], 0
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def text_owners(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest", budget: int = 96 << 20
) -> DataFrame:
    """One row per different text (A-Z lower-cased): sha, length, owner's id, rows, ties.

    ``budget`` bounds the bytes of one trie. The result is written to the shared folder.
    An empty table has no owner. A NULL identifier owns a text only if all are NULL.
    """
    spark, largest = docs.sparkSession, keep == "largest"
    rows = docs.select(text_of(text_col).cast("binary").alias("text"), F.col(id_col).cast("long").alias("id"))
    parts = rows.mapInArrow(_combine(largest, budget // 3), _PART)
    found, more, n = [], True, int(spark.conf.get("spark.sql.shuffle.partitions"))
    while more:
        path = scratch(spark, "owners")
        dealt = parts.repartition(n, F.length("text"), F.xxhash64("text"))
        dealt.mapInArrow(_own(largest, budget), _OWNER).write.parquet(path)
        out = spark.read.schema(_OWNER).parquet(path)
        found.append(out.where("text IS NULL").drop("text"))
        parts, n = out.where("text IS NOT NULL").select("text", "id", "n", "ties"), 2 * n
        more = not parts.isEmpty()
    owners = found[0]
    for f in found[1:]:
        owners = owners.union(f)
    return owners


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest") -> DataFrame:
    """One row per document: its id, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    A NULL text counts as empty. Of rows that repeat identifier and text one is kept.
    """
    owners = text_owners(docs, id_col, text_col, keep)
    digest = F.sha2(lower_ascii(text_of(text_col)).cast("binary"), 256)
    rows = docs.select(F.col(id_col).alias("doc_id"), digest.alias("sha"))
    found = rows.join(owners, "sha", "left")
    won = F.col("doc_id").cast("long").eqNullSafe(F.col("id"))
    cols = [F.col("id").alias("keep_id"), F.col("n").alias("group_size")]
    plain = found.where(~(won & (F.col("ties") > 1))).select("doc_id", *cols, won.alias("kept"), F.col("sha").alias("text_sha256"))
    # rows that tie for the win are alike in all columns of the result
    tied = owners.where("ties > 1").select(
        "*", F.explode(F.sequence(F.lit(1).cast("long"), F.col("ties"))).alias("k")
    ).select(
        F.col("id").cast(docs.schema[id_col].dataType).alias("doc_id"), *cols, (F.col("k") == 1).alias("kept"), F.col("sha").alias("text_sha256")
    )
    return plain.union(tied)


def drop_exact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest") -> DataFrame:
    """The documents that own their texts, with all their columns."""
    own = "__llm_own_"  # documents may have columns of any name
    owners = text_owners(docs, id_col, text_col, keep).select(*[F.col(c).alias(own + c) for c in ("sha", "id", "ties")])
    digest = F.sha2(lower_ascii(text_of(text_col)).cast("binary"), 256)
    won = docs.withColumn(f"{own}sha", digest).join(owners, f"{own}sha").where(F.col(id_col).cast("long").eqNullSafe(F.col(f"{own}id")))
    one = won.where(F.col(f"{own}ties") == 1)
    repeated = won.where(F.col(f"{own}ties") > 1).dropDuplicates([f"{own}sha"])
    return one.union(repeated).select(*[F.col(f"`{c}`") for c in docs.columns])
