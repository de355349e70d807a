"""Substring duplicates by recompression: repeated windows of words, found exactly.

A text's words are replaced, round by round, by names: runs of two equal words, then pairs of
neighbouring symbols of which the first falls to the left and the second to the right half of
the alphabet. A name is a hash of what it stands for, so all tasks give equal substrings the
same interior symbols, without a shared table. Only symbols up to a round's length take part,
so whether a symbol ends at a place follows from REACH words on each side of it, and high-level
symbols stay at most twice the last length.

Every window of words therefore holds an end of a high-level symbol with its REACH; the one
with the smallest hash is the window's anchor, and consecutive windows with one anchor form a
block. Blocks that share the words around their anchors are shared symbols. In Spark:

1. keys (the words around anchors) are counted; those found once are done with;
2. where all blocks of a key have equal words, all their windows are repeated;
3. elsewhere, at the edges of repeats, the windows themselves are hashed and counted.

Anchors depend only on the words of a window, so no repeat is missed.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changemill.llm.common import WordHashes, arrow_schema, mix64, release, remove, scratch, settled, text_of
from changemill.operators.joins import spread

cloudpickle.register_pickle_by_value(sys.modules[__name__])

WINDOW = 35
RUN = 2                  # runs of at most so many equal words get a name of their own
LENGTHS = (1, 2, 3)      # the longest symbols, in words, that later rounds pair
REACH = RUN + sum(LENGTHS)
PLACES = WINDOW - 2 * REACH + 1   # places in a window that can be its anchor
assert PLACES >= 2 * LENGTHS[-1] and REACH == 8 and 32 < WINDOW and WINDOW + PLACES - 1 <= 64
WORDS = 2_000_000        # words handled at a time

A, B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The name of two neighbouring symbols."""
    x = a * A + b * B
    x ^= x >> np.uint64(32)
    x *= B
    x ^= x >> np.uint64(29)
    return x


def symbol_ends(words: np.ndarray) -> np.ndarray:
    """Places at which a high-level symbol begins."""
    n = len(words)
    at, name, size = np.arange(n), words.copy(), np.ones(n, np.int64)

    def merge(first: np.ndarray) -> None:
        nonlocal at, name, size
        i = np.flatnonzero(first)
        name[i] = pair(name[i], name[i + 1])
        size[i] += size[i + 1]
        stay = np.ones(len(at), bool)
        stay[i + 1] = False
        at, name, size = at[stay], name[stay], size[stay]

    same = np.concatenate([words[1:] == words[:-1], [False]])
    alone = same & ~np.concatenate([[False], same[:-1]]) & ~np.concatenate([same[1:], [False]])
    merge(alone)
    for k, most in enumerate(LENGTHS):
        left = (mix64(name + np.uint64(k + 1)) >> np.uint64(63)) == 0
        short = size <= most
        first = np.zeros(len(at), bool)
        first[:-1] = left[:-1] & ~left[1:] & short[:-1] & short[1:]
        merge(first)
    return at


def doubled(words: np.ndarray, times: int) -> np.ndarray:
    """Hashes of the 2 ** times words from every place on; the last places have none."""
    t, width = words, 1
    for _ in range(times):
        t = pair(t[:-width], t[width:]) if len(t) > width else t[:0]
        width *= 2
    return t


def blocks(words: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, ...]:
    """(key, content, first window, last window) of all blocks of concatenated documents."""
    n = len(words) - WINDOW + 1
    none = np.zeros(0, np.int64)
    if n <= 0:
        return none.astype(np.uint64), none.astype(np.uint64), none, none
    eight = doubled(words, 3)
    around = pair(eight[:-8], eight[8:])           # 16 words from a place on
    value = np.full(len(words), np.iinfo(np.uint64).max, np.uint64)
    ends = symbol_ends(words)
    ends = ends[(ends >= REACH) & (ends + REACH <= len(words))]
    low = np.uint64(0xFFFFFFFF)
    value[ends] = (mix64(around[ends - REACH]) & ~low) | ends.astype(np.uint64)
    best, width = value, 1
    while 2 * width <= PLACES:
        best = np.minimum(best[:-width], best[width:])
        width *= 2
    best = np.minimum(best[:len(best) - (PLACES - width)], best[PLACES - width:])[REACH:REACH + n]
    window = np.flatnonzero(doc[:n] == doc[WINDOW - 1:])
    best = best[window]
    if not len(window):
        return none.astype(np.uint64), none.astype(np.uint64), none, none
    cut = np.flatnonzero((best[1:] != best[:-1]) | (window[1:] != window[:-1] + 1)) + 1
    lo, hi = window[np.concatenate([[0], cut])], window[np.concatenate([cut, [len(window)]]) - 1]
    anchor = (best[np.concatenate([[0], cut])] & low).astype(np.int64)
    long = pair(doubled(eight, 0)[:-8], eight[8:])
    wide = pair(long[:-16], long[16:])             # 32 words from a place on
    content = pair(wide[lo] + (hi - lo).astype(np.uint64), wide[hi + WINDOW - 32] + (anchor - lo).astype(np.uint64) * A)
    return mix64(around[anchor - REACH]), content, lo, hi


def window_names(words: np.ndarray) -> np.ndarray:
    """A hash for each window."""
    wide = doubled(words, 5)
    n = len(words) - WINDOW + 1
    return mix64(pair(wide[:n], wide[WINDOW - 32:WINDOW - 32 + n])) if n > 0 else wide[:0]


def bunches(batches: Iterator[pa.RecordBatch], hashes: WordHashes) -> Iterator[tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray]]:
    """(ids, word hashes, document of each word, first word of each document) of some documents at a time."""
    ids, parts, total = [], [], 0

    def bunch():
        size = [len(p) for p in parts]
        return ids, np.concatenate(parts), np.repeat(np.arange(len(parts)), size), np.cumsum([0, *size])

    for batch in batches:
        for rid, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            words = text.as_py().split()
            if len(words) < WINDOW:
                continue
            ids.append(rid)
            parts.append(hashes.of(words))
            total += len(words)
            if total >= WORDS:
                yield bunch()
                ids, parts, total = [], [], 0
    if parts:
        yield bunch()


_BLOCKS = "key long,content long,rid binary,lo int,hi int"


def _blocks():
    schema = arrow_schema(_BLOCKS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, words, doc, first in bunches(batches, WordHashes()):
            key, content, lo, hi = blocks(words, doc)
            who = doc[lo]
            names = pa.array(ids, pa.binary())
            for at in range(0, len(key), 200_000):
                cut = slice(at, at + 200_000)
                yield pa.RecordBatch.from_arrays([
                    pa.array(key[cut].view(np.int64)), pa.array(content[cut].view(np.int64)), names.take(pa.array(who[cut])),
                    pa.array((lo[cut] - first[who[cut]]).astype(np.int32)), pa.array((hi[cut] - first[who[cut]]).astype(np.int32))], schema=schema)

    return run


_WINDOWS = "key long,name long,rid binary,at int,n long"


def _windows():
    """(rid, text, blocks) → the windows of blocks whose keys have different contents."""
    schema = arrow_schema(_WINDOWS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            copies: dict[bytes, int] = {}
            rows: dict[bytes, tuple] = {}
            size = 0
            for rid, text, keys, los, his in zip(*(batch.column(i) for i in range(5)), strict=True):
                rid = rid.as_py()
                copies[rid] = copies.get(rid, 0) + 1
                if rid not in rows:
                    words = hashes.of(text.as_py().split())
                    names = window_names(words)
                    lo, hi = los.values.to_numpy(), his.values.to_numpy()
                    each = hi - lo + 1
                    at = np.repeat(lo - np.concatenate([[0], np.cumsum(each)[:-1]]), each) + np.arange(each.sum())
                    rows[rid] = (np.repeat(keys.values.to_numpy(), each), names[at].view(np.int64), at.astype(np.int32))
                    size += len(at)
                if size > 400_000:
                    yield from flush(rows, copies)
                    copies, rows, size = {}, {}, 0
            yield from flush(rows, copies)

    def flush(rows: dict, copies: dict) -> Iterator[pa.RecordBatch]:
        if rows:
            each = [len(r[2]) for r in rows.values()]
            names = pa.array(list(rows), pa.binary()).take(pa.array(np.repeat(np.arange(len(rows)), each)))
            n = np.repeat(np.fromiter((copies[r] for r in rows), np.int64, len(rows)), each)
            key, name, at = (np.concatenate(c) for c in zip(*rows.values()))
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(name), names, pa.array(at), pa.array(n)], schema=schema)

    return run


_OUT = "doc_id long,n_words long,n_removed long,kept_sha256 string"


def _remove():
    """(doc_id, text, spans) → counts and the hash of what stays."""
    schema = arrow_schema(_OUT)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for i, text, lo, hi in zip(batch.column(0).to_pylist(), *(batch.column(k) for k in (1, 2, 3)), strict=True):
                words = text.as_py().split()
                kept = words if not lo.is_valid else stay(words, lo.values.to_numpy(), hi.values.to_numpy())
                rows.append((i, len(words), len(words) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()))
            cols = list(zip(*rows)) or [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema)], schema=schema)

    return run


def stay(words: list[bytes], lo: np.ndarray, hi: np.ndarray) -> list[bytes]:
    """The words not covered by the windows that start at lo … hi."""
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, lo, 1)
    np.add.at(edge, hi + WINDOW, -1)
    return [words[i] for i in np.flatnonzero(np.cumsum(edge[:-1]) == 0)]


def rid(text_col: str):
    """16 bytes that name a text."""
    return F.unhex(F.md5(text_of(text_col).cast("binary")))


def repeated_windows(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(rid, lo, hi): per text the runs of repeated windows, as arrays of first and last starts."""
    spark = docs.sparkSession
    texts = docs.select(rid(text_col).alias("rid"), text_of(text_col).cast("binary").alias("text"))
    found = scratch(spark, "blocks")
    texts.mapInArrow(_blocks(), _BLOCKS).write.parquet(found)
    all_blocks = spark.read.parquet(found)
    shared = settled(all_blocks.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("content").alias("c1"), F.max("content").alias("c2"))
                     .where("n > 1").select(F.col("key").alias("k"), (F.col("c1") != F.col("c2")).alias("mixed")), "shared")
    hits = all_blocks.select("key", "rid", "lo", "hi").join(shared, F.col("key") == F.col("k"))
    # copies of a text give the same blocks, so a group is at most the blocks of one text
    hits = hits.groupBy("rid", "lo", "hi").agg(F.first("key").alias("key"), F.first("mixed").alias("mixed"))
    hits = settled(hits.groupBy("rid").agg(
        F.collect_list(F.when(~F.col("mixed"), F.struct("lo", "hi"))).alias("whole"),
        F.collect_list(F.when(F.col("mixed"), F.struct("key", "lo", "hi"))).alias("mixed")), "hits")
    remove(spark, found)
    release(spark)
    edges = hits.where(F.size("mixed") > 0).select(F.col("rid").alias("r"), F.col("mixed.key").alias("keys"), F.col("mixed.lo").alias("lo"), F.col("mixed.hi").alias("hi"))
    named = settled(texts.join(edges, F.col("rid") == F.col("r")).select("rid", "text", "keys", "lo", "hi").mapInArrow(_windows(), _WINDOWS), "windows")
    release(spark)
    twice = named.groupBy("key", "name").agg(F.sum("n").alias("times")).where("times > 1").select(F.col("key").alias("k"), F.col("name").alias("w"))
    # a window that stands in very many texts may be split: its rows come straight from an exchange
    again = named.select("key", "name", "rid", "at").join(spread(twice), (F.col("key") == F.col("k")) & (F.col("name") == F.col("w")))
    spans = again.groupBy("rid").agg(F.collect_set("at").alias("at")).select("rid", F.transform("at", lambda x: F.struct(x.alias("lo"), x.alias("hi"))).alias("spans"))
    spans = spans.union(hits.where(F.size("whole") > 0).select("rid", "whole"))
    spans = spans.groupBy("rid").agg(F.flatten(F.collect_list("spans")).alias("s"))
    out = settled(spans.select("rid", F.col("s.lo").alias("lo"), F.col("s.hi").alias("hi")), "spans")
    release(spark)
    return out


def drop_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_sha256.

    A NULL or empty text has no words; texts shorter than a window keep all words. Rows that
    repeat a text repeat its windows, so they lose all words covered by one.
    """
    spans = repeated_windows(docs, text_col).withColumnRenamed("rid", "r")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).cast("binary").alias("text"), rid(text_col).alias("rid"))
    return rows.join(spans, F.col("rid") == F.col("r"), "left").select("doc_id", "text", "lo", "hi").mapInArrow(_remove(), _OUT)
