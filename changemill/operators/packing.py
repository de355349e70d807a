"""Packing ordered messages into size-bounded batches, in parallel and exactly.

A batch closes when the next message would pass the limit, so the place of every batch
depends on all messages before it. Doing this per destination in one task would not
survive a destination with a third of all messages. Instead:

1. messages are sorted into chunks (``ordering.sorted_chunks``);
2. each chunk describes how it maps "bytes used in the open batch on entry" to the same on
   exit. The first new batch in a chunk must start within its first ``max_bytes``, so the
   map is a table with one entry per message in that window, not per message of the chunk;
3. tables of neighbouring chunks are combined, group by group, and the entry state of every
   group and then of every chunk follows;
4. each chunk numbers its own messages from its entry state.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changemill.functions.columns import col
from changemill.operators.messages import MESSAGE_LIMIT, message_size
from changemill.operators.ordering import CHUNK_BITS, ROW, checkpoint, sorted_chunks

# the functions below travel to the workers as they are: these need not have this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_DEST, _SIZE = "__mill_dest", "__mill_size"
ROWS = 1 << 20  # messages of a chunk

_MAP = (
    "chunk long, grp long, first_dest string, last_dest string, uniform boolean, "
    "total long, starts array<long>, used array<long>, batches array<long>, "
    "last_used long, last_batches long"
)


def _run(ends, limit):
    """(bytes used at the end, batches opened) when a batch opens at the first message."""
    begin, base, opened = 0, 0, 1
    while True:
        begin = max(int(np.searchsorted(ends, base + limit, side="right")), begin + 1)
        if begin >= len(ends):
            return int(ends[-1]) - base, opened
        base, opened = int(ends[begin - 1]), opened + 1


def _entry_table(sizes, limit):
    """Exit state for every message that may open the first new batch of a segment."""
    ends = np.cumsum(sizes)
    before = ends - sizes
    window = int(np.searchsorted(before, limit, side="right"))
    cand = np.flatnonzero(sizes[:window] > 0)
    if not len(cand) or cand[0] != 0:
        cand = np.concatenate([[0], cand])
    cur, opened = cand.copy(), np.ones(len(cand), dtype=np.int64)
    live = np.arange(len(cand))
    while len(live):
        at = cur[live]
        nxt = np.maximum(np.searchsorted(ends, before[at] + limit, side="right"), at + 1)
        live, nxt = live[nxt < len(ends)], nxt[nxt < len(ends)]
        cur[live] = nxt
        opened[live] += 1
    return int(ends[-1]), ends[cand], ends[-1] - before[cur], opened


def _lookup(starts, used, batches, total, entry_used, entry_batches, limit):
    """Exit state of a segment for an entry state."""
    i = int(np.searchsorted(starts, limit - entry_used, side="right"))
    if i < len(starts):
        return int(used[i]), entry_batches + int(batches[i])
    return entry_used + total, entry_batches


def _describe(limit, fan):
    """mapInPandas over one chunk: one row that describes it."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids, dests, sizes = [], [], []
        for pdf in batches:
            if len(pdf):
                ids.append(int(pdf[ROW].iloc[0]) >> CHUNK_BITS)
                codes = (pdf[_DEST] != pdf[_DEST].shift()).to_numpy()
                dests.append((pdf[_DEST].to_numpy()[codes], np.flatnonzero(codes)))
                sizes.append(pdf[_SIZE].to_numpy(dtype=np.int64))
        if not sizes:
            return
        names, begins, shift = [], [], 0
        for (vals, at), s in zip(dests, sizes):
            for v, a in zip(vals, at):
                if not names or names[-1] != v:
                    names.append(v)
                    begins.append(shift + int(a))
            shift += len(s)
        size = np.concatenate(sizes)
        bounds = [*begins, len(size)]
        total, starts, used, opened = _entry_table(size[bounds[0]:bounds[1]], limit)
        last = size[bounds[-2]:]
        last_used, last_opened = _run(np.cumsum(last), limit)
        yield pd.DataFrame({
            "chunk": [ids[0]], "grp": [ids[0] // fan],
            "first_dest": [names[0]], "last_dest": [names[-1]], "uniform": [len(names) == 1],
            "total": [total], "starts": [starts], "used": [used], "batches": [opened],
            "last_used": [last_used], "last_batches": [last_opened],
        })

    return run


def _step(state, c, limit):
    """State (dest, used, batches) after chunk ``c``. A new destination opens a batch at
    its first message, which an entry over the limit expresses."""
    dest, used, opened = state
    if not c["uniform"]:
        return c["last_dest"], int(c["last_used"]), int(c["last_batches"])
    if dest != c["first_dest"]:
        used, opened = limit + 1, 0
    u, b = _lookup(c["starts"], c["used"], c["batches"], int(c["total"]), used, opened, limit)
    return c["last_dest"], u, b


def _combine(limit):
    """applyInPandas over neighbouring chunks: one row that describes them together."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = pdf.sort_values("chunk").to_dict("records")
        head = rows[0]
        uniform = all(r["uniform"] and r["first_dest"] == head["first_dest"] for r in rows)
        state = (None, limit + 1, 0)
        for r in rows:
            state = _step(state, r, limit)
        out = {
            "chunk": head["grp"], "grp": 0, "first_dest": head["first_dest"], "last_dest": state[0],
            "uniform": uniform, "total": 0, "starts": np.array([], np.int64),
            "used": np.array([], np.int64), "batches": np.array([], np.int64),
            "last_used": state[1], "last_batches": state[2],
        }
        if uniform:
            starts, used = np.array(head["starts"], np.int64), np.array(head["used"], np.int64)
            opened, total = np.array(head["batches"], np.int64), int(head["total"])
            for r in rows[1:]:
                rs, ru = np.asarray(r["starts"], np.int64), np.asarray(r["used"], np.int64)
                rb = np.asarray(r["batches"], np.int64)
                i = np.searchsorted(rs, limit - used, side="right")
                hit, j = i < len(rs), np.minimum(i, len(rs) - 1)
                opened = opened + np.where(hit, rb[j], 0)
                used = np.where(hit, ru[j], used + int(r["total"]))
                if total <= limit:  # an entry may still be without a new batch here
                    starts = np.concatenate([starts, total + rs])
                    used, opened = np.concatenate([used, ru]), np.concatenate([opened, rb])
                total += int(r["total"])
            out.update(total=total, starts=starts, used=used, batches=opened)
        return pd.DataFrame([out])

    return run


_ENTRY = "chunk long, dest string, used long, opened long"


def _entries(limit, fan=None):
    """applyInPandas: entry state of each row from the entry state of the first one."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = pdf.sort_values("chunk").to_dict("records")
        first = rows[0]
        state = (None, limit + 1, 0)
        if fan is not None:
            state = (first["e_dest"], int(first["e_used"]), int(first["e_opened"]))
        out = []
        for r in rows:
            out.append((r["chunk"], *state))
            state = _step(state, r, limit)
        return pd.DataFrame(out, columns=["chunk", "dest", "used", "opened"])

    return run


def _number(limit, entry):
    """Iterator UDF over chunks in row order: the batch number of every message."""
    low = (1 << CHUNK_BITS) - 1

    def run(it):
        dest, used, opened, last = None, limit + 1, 0, None
        for row, name, size in it:
            rows, sizes = row.to_numpy(dtype=np.int64), size.to_numpy(dtype=np.int64)
            names, n = name.to_numpy(), len(row)
            out = np.empty(n, dtype=np.int64)
            starts_chunk = rows & low == 0
            follows = np.concatenate([[last is not None and n > 0 and rows[0] == last + 1], np.diff(rows) == 1])
            if not np.all((follows | starts_chunk)[:n] if n else True):
                raise ValueError("messages of a chunk are not in order")
            new_dest = np.concatenate([[True], names[1:] != names[:-1]])[:n]
            cuts = np.flatnonzero(new_dest | starts_chunk)
            for b, e in zip(cuts, [*cuts[1:], n]):
                if starts_chunk[b]:
                    dest, used, opened = entry[int(rows[b]) >> CHUNK_BITS]
                if dest != names[b]:
                    dest, used, opened = names[b], limit + 1, 0
                ends = np.cumsum(sizes[b:e])
                pos, base, opened_here = 0, -used, False
                while True:
                    nxt = int(np.searchsorted(ends, base + limit, side="right"))
                    if opened_here:
                        nxt = max(nxt, pos + 1)
                    out[b + pos:b + min(nxt, e - b)] = opened - 1
                    if nxt >= e - b:
                        used = int(ends[-1]) - base
                        break
                    opened, pos, opened_here = opened + 1, nxt, True
                    base = int(ends[nxt - 1]) if nxt else 0
            if n:
                last = int(rows[-1])
            yield pd.Series(out)

    return run


def pack_batches(
    msgs: DataFrame,
    order: list[str],
    dest: list[str] = (),
    max_bytes: int = MESSAGE_LIMIT,
    value_col: str = "value",
    size_col: str | None = None,
    chunks: int | None = None,
) -> DataFrame:
    """Add ``batch_no``: the number of the message's batch within its destination, from 0.

    Messages stay in ``order`` (unique within ``dest``). A message larger than the limit
    gets a batch of its own; ``check_message_size`` rejects such messages beforehand. Only
    destination, order and size are sorted and checkpointed; the payload is joined to its
    batch number by destination and order.

    A task holds the sizes of one chunk; there are as many chunks as keep it to about ROWS
    messages, whatever their size and the session's number of shuffle partitions.
    """
    if max_bytes <= 0:
        raise ValueError("max_bytes must be positive")
    size = col(size_col).cast("long") if size_col else message_size(value_col)
    # a NULL payload has size 0; destinations compare as text, NULL apart from empty
    name = F.to_json(F.struct(*[col(d).alias(f"d{i}") for i, d in enumerate(dest)])) if dest else F.lit("")
    place = list(dict.fromkeys([*dest, *order]))
    n = chunks or max(int(msgs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-msgs.count() // ROWS))
    rows = sorted_chunks(
        msgs.select(*[col(c) for c in place], F.coalesce(size, F.lit(0)).alias(_SIZE), name.alias(_DEST)),
        place,
        n,
    )
    fan = max(1, math.isqrt(n))
    maps = checkpoint(rows.select(ROW, _DEST, _SIZE).mapInPandas(_describe(max_bytes, fan), _MAP))
    groups = maps.groupBy("grp").applyInPandas(_combine(max_bytes), _MAP)
    # about sqrt(chunks) rows reach this one task, each no larger than a batch window
    starts = groups.groupBy("grp").applyInPandas(_entries(max_bytes), _ENTRY)
    starts = starts.select(
        F.col("chunk").alias("grp"), F.col("dest").alias("e_dest"),
        F.col("used").alias("e_used"), F.col("opened").alias("e_opened"),
    )
    per_chunk = maps.join(starts, "grp").groupBy("grp").applyInPandas(_entries(max_bytes, fan), _ENTRY)
    # one row per chunk: bounded by the number of partitions
    entry = {r["chunk"]: (r["dest"], r["used"], r["opened"]) for r in per_chunk.collect()}
    number = _number(max_bytes, entry)

    def numbered(it: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        return number(it)

    udf = F.pandas_udf("long")(numbered).asNondeterministic()
    out = rows.withColumn("batch_no", udf(F.col(ROW), F.col(_DEST), F.col(_SIZE)))
    numbers = out.select(*[col(c).alias(f"__mill_p{i}") for i, c in enumerate(place)], "batch_no")
    same = reduce(lambda a, b: a & b, [col(c).eqNullSafe(F.col(f"__mill_p{i}")) for i, c in enumerate(place)])
    return msgs.join(numbers, same).select(*[col(c) for c in msgs.columns], "batch_no")


def batch_totals(packed: DataFrame, dest: list[str], value_col: str = "value", size_col: str | None = None) -> DataFrame:
    """Messages and bytes of every batch."""
    size = col(size_col).cast("long") if size_col else message_size(value_col)
    return packed.groupBy(*[col(d) for d in dest], "batch_no").agg(
        F.count(F.lit(1)).alias("n_messages"), F.sum(size).alias("n_bytes")
    )
