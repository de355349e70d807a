"""A target kept as Parquet files of several versions, and the commits that name them.

Plain Spark cannot overwrite a path it reads, nor update rows in place. Each write goes to
a fresh folder ``_v=<n>``; a small commit file then names, for every partition, the folder
that holds it. Readers see the last commit, so a failed write is never visible. A change
set rewrites only the partitions it touches; the others are carried over by name.

A cycle of plain changes (``apply_changes``) rewrites nothing: its rows are written as they are, the
commit names them after the content that they replace keys of, and a reader lays the last row of
each key over it. Once they outweigh that content, the next cycle writes it anew, so that what is
written grows with the changes and not with cycles times the table.

One writer per table is meant. Of two that write the same version one fails: the commit
file has the version's name alone and is created only if it is not there. A commit file that
is not complete (its writer died) counts as a version that was never visible.
"""

from __future__ import annotations

import json
import re
import uuid
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changemill.functions.columns import col
from changemill.operators.changes import row_changes
from changemill.operators.joins import align, key_side, key_test, without
from changemill.spec import FLAG_COL, OP_COL, Op

_GONE, _CYCLE, _LAST = "__mill_gone", "__mill_cycle", "__mill_last"
MOST_CHANGES = 256  # change sets that a reader lays over the content

_NULL_PART = "__HIVE_DEFAULT_PARTITION__"


class SnapshotTable:
    def __init__(self, spark: SparkSession, root: str, partition_by: list[str] = (), fmt: str = "parquet"):
        self.spark, self.root, self.fmt = spark, root.rstrip("/"), fmt
        self.partition_by = list(partition_by)
        self._jvm = spark.sparkContext._jvm
        self._fs = self._path(self.root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    # ---- files

    def _path(self, *parts: str):
        return self._jvm.org.apache.hadoop.fs.Path("/".join(parts))

    def _list(self, *parts: str) -> list[str]:
        p = self._path(self.root, *parts)
        if not self._fs.exists(p):
            return []
        return sorted(s.getPath().getName() for s in self._fs.listStatus(p))

    def _read_text(self, *parts: str) -> str:
        stream = self._fs.open(self._path(self.root, *parts))
        try:
            return bytes(self._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
        finally:
            stream.close()

    # ---- commits

    def _commits(self) -> list[tuple[int, str]]:
        found = []
        for name in self._list("_commits"):
            m = re.fullmatch(r"(\d+)\.json", name)
            if m:
                found.append((int(m[1]), name))
        return sorted(found)

    def version(self) -> int:
        """Number of the last commit; 0 for a table that was never written."""
        commits = self._commits()
        return commits[-1][0] if commits else 0

    @staticmethod
    def _tag(tag: str) -> tuple[str, int]:
        """Name and number of a tag such as ``apply-17``; without a number, -1."""
        m = re.fullmatch(r"(.*)-(\d{1,18})", tag)
        return (m[1], int(m[2])) if m else (tag, -1)

    def is_committed(self, tag: str) -> bool:
        """Was a commit with this tag made? A replayed batch asks before it writes.

        Every commit carries the last number of each tag name, so only one file is read.
        """
        name, number = self._tag(tag)
        tags = (self._state() or {}).get("tags", {})
        return name in tags and number <= tags[name]

    def _folder(self, version: int) -> str:
        """A fresh data folder: two writers of one version never share it."""
        return f"_v={version}-{uuid.uuid4().hex[:12]}"

    def _commit(self, version: int, tag: str, schema: T.StructType, parts: dict[str, str], changes: dict | None = None) -> int:
        state = self._state()
        if self.version() >= version:
            raise RuntimeError(f"version {version} of {self.root} was committed by another writer")
        name, number = self._tag(tag)
        tags = {**(state or {}).get("tags", {})}
        tags[name] = max(number, tags.get(name, -1))
        body = json.dumps({"version": version, "tag": tag, "tags": tags, "schema": schema.jsonValue(), "parts": parts, **({"changes": changes} if changes else {})})
        try:
            out = self._fs.create(self._path(self.root, "_commits", f"{version:08d}.json"), False)
        except Exception as ex:
            if "AlreadyExists" in str(ex) or "already exists" in str(ex):
                raise RuntimeError(f"version {version} of {self.root} was committed by another writer") from ex
            raise
        try:
            out.write(bytearray(body.encode()))
        finally:
            out.close()
        return version

    def _state(self, version: int | None = None) -> dict | None:
        for v, name in reversed(self._commits()):
            if version is None or v == version:
                try:
                    return json.loads(self._read_text("_commits", name))
                except ValueError:  # not completely written: never visible
                    continue
        if version:
            raise ValueError(f"{self.root} has no version {version}")
        return None

    def compact(self, tag: str = "compact") -> int:
        """Write the current rows anew as one version, without the folders of single appends."""
        return self.commit(self.read(), tag)

    def expire(self, keep: int = 1) -> list[int]:
        """Delete all but the last ``keep`` versions and the folders no kept one names.

        Readers of an expired version and open writers must be done.
        """
        if keep < 1:
            raise ValueError("the last version cannot be expired")
        commits = self._commits()
        old, stay = commits[:-keep], commits[-keep:]
        states = [self._state(v) or {"parts": {}} for v, _ in stay]
        used = {folder.split("/")[0] for s in states for folder in [*s["parts"].values(), *s.get("changes", {}).get("folders", {}).values()]}
        for _, name in old:
            self._fs.delete(self._path(self.root, "_commits", name), False)
        last = commits[-1][0] if commits else 0
        for folder in self._list():
            m = re.fullmatch(r"_v=(\d+)(-.*)?", folder)
            if m and int(m[1]) <= last and folder not in used:
                self._fs.delete(self._path(self.root, folder), True)
        return [v for v, _ in old]

    # ---- reading

    def exists(self) -> bool:
        return self._state() is not None

    def schema(self) -> T.StructType:
        state = self._state()
        if state is None:
            raise ValueError(f"{self.root} has no committed version")
        return T.StructType.fromJson(state["schema"])

    def _read_parts(self, schema: T.StructType, parts: dict[str, str]) -> DataFrame:
        if not parts:
            return self.spark.createDataFrame([], schema)
        shapes: dict[tuple, list[str]] = {}
        for part, folder in parts.items():
            shape = tuple(p.split("=")[0] for p in part.split("/") if p)
            shapes.setdefault(shape, []).append("/".join(x for x in (self.root, folder, part) if x))
        frames = [
            self.spark.read.format(self.fmt)
            .schema(schema)
            .option("basePath", self.root)
            .load(paths)
            .select(*[col(f.name) for f in schema.fields])
            for paths in shapes.values()
        ]
        return reduce(DataFrame.unionByName, frames)

    def read(self, version: int | None = None) -> DataFrame:
        """The committed rows; older versions stay readable."""
        state = self._state(version)
        if state is None:
            raise ValueError(f"{self.root} has no committed version")
        schema = T.StructType.fromJson(state["schema"])
        rows = self._read_parts(schema, state["parts"])
        return self._changed(rows, schema, state["changes"]) if state.get("changes") else rows

    def _changed(self, rows: DataFrame, schema: T.StructType, changes: dict) -> DataFrame:
        """``rows`` without the keys of the change sets, plus each key's live rows of the last set that has it."""
        keys, null_safe = changes["keys"], changes["null_safe"]
        paths = [f"{self.root}/{folder}/{_CYCLE}={n}" for n, folder in changes["folders"].items()]
        every = T.StructType([*schema.fields, T.StructField(_GONE, T.BooleanType()), T.StructField(_CYCLE, T.LongType())])
        sets = self.spark.read.format(self.fmt).schema(every).option("basePath", self.root).load(paths)
        live = sets.filter(~F.col(_GONE))
        if len(paths) > 1:
            last = sets.groupBy(*key_side(sets, keys)).agg(F.max(_CYCLE).alias(_LAST))
            live = live.join(last, key_test(keys, null_safe), "left").filter(F.col(_LAST).isNull() | (F.col(_LAST) == F.col(_CYCLE)))
        return without(rows, sets, keys, null_safe).unionAll(live.select(*[col(f.name) for f in schema.fields]))

    # ---- writing

    def _write(self, df: DataFrame, folder: str) -> dict[str, str]:
        w = df
        if self.partition_by:
            # rows of a partition meet in few tasks, and a huge partition is split by AQE
            w = df.hint("rebalance", *[col(c) for c in self.partition_by])
        writer = w.write.format(self.fmt).mode("overwrite")
        if self.partition_by:
            writer = writer.partitionBy(*self.partition_by)
        writer.save(f"{self.root}/{folder}")
        return {p: folder for p in self._leaves(folder, len(self.partition_by))}

    def _leaves(self, folder: str, depth: int) -> list[str]:
        found = [""]
        for _ in range(depth):
            found = [
                f"{base}/{name}".lstrip("/")
                for base in found
                for name in self._list(*[x for x in (folder, base) if x])
                if "=" in name
            ]
        return found

    def commit(self, df: DataFrame, tag: str = "write") -> int:
        """Write ``df`` as the whole new content."""
        version = self.version() + 1
        parts = self._write(df, self._folder(version))
        return self._commit(version, tag, df.schema, parts)

    def append(self, df: DataFrame, tag: str = "append", new_columns: str = "fail") -> int:
        """Add rows without rewriting any: the new files join the old ones.

        Columns the table lacks fail, are added (rows already there read as NULL) or are
        left out.
        """
        state = self._whole()
        if state is None:
            return self.commit(df, tag)
        schema = T.StructType.fromJson(state["schema"])
        fresh = [c for c in df.columns if c not in schema.fieldNames() and c not in (OP_COL, FLAG_COL)]
        if fresh and new_columns == "fail":
            raise ValueError(f"columns not in the target: {fresh}")
        if fresh and new_columns == "add":
            schema = T.StructType([*schema.fields, *[df.schema[c] for c in fresh]])
        version = self.version() + 1
        rows = align(df, self.spark.createDataFrame([], schema))
        folder = self._folder(version)
        self._write(rows, f"{folder}/_add={version}")
        fresh = {f"_add={version}" + (f"/{p}" if p else ""): folder
                 for p in self._leaves(f"{folder}/_add={version}", len(self.partition_by))}
        return self._commit(version, tag, schema, {**state["parts"], **fresh})

    def apply(self, fn, b: DataFrame, tag: str = "apply") -> int:
        """``fn(target, b)`` becomes the new content."""
        return self.commit(fn(self.read(), b), tag)

    def _whole(self) -> dict | None:
        """The last commit; pending change sets are written into the content first."""
        if (self._state() or {}).get("changes"):
            self.compact()
        return self._state()

    def _bytes(self, *paths: str) -> int:
        return sum(self._fs.getContentSummary(self._path(self.root, p)).getLength() for p in paths)

    def apply_changes(self, fn, b: DataFrame, keys: list[str], op_col: str = OP_COL, null_safe: bool = True, tag: str = "apply") -> int:
        """``fn(target, b)`` becomes the new content, where ``fn`` is ``merge_key_change`` with unique keys.

        ``b`` is written and the content carried over. The content is written anew where pending
        change sets outweigh it or are many, have other keys, or ``b`` lacks a column of the table, and
        for a partitioned table, whose readers look for their partitions.
        """
        from changemill.operators.merge import _ambiguity, _known

        state = self._state()
        if state is None:
            raise ValueError(f"{self.root} has no committed version")
        schema, held = T.StructType.fromJson(state["schema"]), state.get("changes") or {"keys": keys, "null_safe": null_safe, "folders": {}}
        like = set(b.columns) >= set(schema.fieldNames()) and (held["keys"], held["null_safe"]) == (keys, null_safe) and not self.partition_by
        like = like and type(self) is SnapshotTable and len(held["folders"]) < MOST_CHANGES
        if not like or self._bytes(*held["folders"].values()) > self._bytes(*[f"{f}/{p}".rstrip("/") for p, f in state["parts"].items()]):
            return self.apply(fn, b, tag)
        rows = row_changes(b, op_col).filter(col(op_col).isNotNull())
        gone = col(op_col) == Op.DELETE
        if not rows.groupBy(*[col(k) for k in keys]).count().filter("count > 1").isEmpty():
            # as in merge_key_change: the target is only asked for keys that repeat in the change set
            facts = _ambiguity(self.read(), rows, keys, op_col, null_safe).first()["facts"]
            if facts["clash"]:
                raise ValueError("several change rows match one target row")
            if null_safe and facts["ambiguous"]:
                rows = rows.filter(~gone | _known(keys))
        version = self.version() + 1
        folder = self._folder(version)
        out = rows.select(*[col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields], gone.alias(_GONE))
        out.write.format(self.fmt).mode("overwrite").save(f"{self.root}/{folder}/{_CYCLE}={version}")
        return self._commit(version, tag, schema, state["parts"], {**held, "folders": {**held["folders"], str(version): folder}})

    def apply_touched(self, fn, b: DataFrame, tag: str = "apply") -> int:
        """Like ``apply``, but read and write only the partitions that occur in ``b``.

        Right only if a change never moves a row to another partition. The list of touched
        partitions is no longer than the table's list of partitions, which the driver holds
        anyway. A partition that becomes empty leaves the table.
        """
        if not self.partition_by:
            return self.apply(fn, b, tag)
        state = self._whole()
        if state is None:
            raise ValueError(f"{self.root} has no committed version")
        schema = T.StructType.fromJson(state["schema"])
        rows = b.select(*[col(c).cast("string") for c in self.partition_by]).distinct().collect()
        # a writer puts NULL and '' into one folder, so both touch it
        touched = {tuple(_NULL_PART if v in (None, "") else v for v in r) for r in rows}
        old = {p: f for p, f in state["parts"].items() if self._values(p) in touched}
        kept = {p: f for p, f in state["parts"].items() if p not in old}
        new = fn(self._read_parts(schema, old), b)
        version = self.version() + 1
        parts = self._write(new, self._folder(version))
        clash = sorted(p for p in parts if p in kept)
        if clash:
            raise RuntimeError(f"rows moved to partitions that were not read: {clash[:5]}")
        return self._commit(version, tag, new.schema, {**kept, **parts})

    def _values(self, part: str) -> tuple:
        pairs = dict(p.split("=", 1) for p in part.split("/") if "=" in p)
        return tuple(unquote(pairs[c]) for c in self.partition_by)

    def write_slice(self, df: DataFrame, slice_no: int, total: int, tag: str = "slices") -> bool:
        """Write one slice of a sliced refresh; True once the last one made the new version.

        A repeated slice replaces itself. Slices of another ``total`` belong to an abandoned
        refresh and are not counted. Until all slices are there, readers see the old rows.
        """
        if not 0 <= slice_no < total:
            raise ValueError("slice_no must be between 0 and total - 1")
        version = self.version() + 1
        folder = f"_v={version}/_slices={total}"
        self._write(df, f"{folder}/_slice={slice_no}")
        if len(self.done_slices(total)) < total:
            return False
        parts = {}
        for n in range(total):
            for p in self._leaves(f"{folder}/_slice={n}", len(self.partition_by)):
                key = f"_slices={total}/_slice={n}" + (f"/{p}" if p else "")
                parts[key] = f"_v={version}"
        self._commit(version, tag, df.schema, parts)
        return True

    def done_slices(self, total: int) -> list[int]:
        """Slices of the open refresh that are completely written."""
        folder = f"_v={self.version() + 1}/_slices={total}"
        names = [n for n in self._list(folder) if n.startswith("_slice=")]
        return sorted(int(n[7:]) for n in names if "_SUCCESS" in self._list(folder, n))


def slice_state(state: DataFrame, job: str, slice_no: int, total: int) -> DataFrame:
    """State rows ``(job, slice, total, done)`` after a slice; another total starts afresh."""
    mine = F.col("job") == job
    keep = state.filter(~mine | ((F.col("total") == total) & (F.col("slice") != slice_no)))
    one = state.sparkSession.createDataFrame([(job, slice_no, total, 1)], "job string, slice int, total int, done int")
    return keep.select("job", "slice", "total", "done").unionByName(one)


def slices_done(state: DataFrame) -> DataFrame:
    """Completed slices out of the total, per job, and whether the job is finished."""
    out = state.groupBy("job").agg(
        F.sum("done").cast("long").alias("n_done"), F.max("total").cast("long").alias("n_total")
    )
    return out.withColumn("finished", F.col("n_done") >= F.col("n_total"))
