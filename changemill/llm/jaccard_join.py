"""Near duplicates by a universe-partition pigeonhole join on word shingles, exact.

Two sets with Jaccard similarity of at least 3/4 differ in at most (|r| + |s|) / 7 elements.
Elements are hashed into the M segments of a size band (sizes from a power of two to the
next); of any such pair at least one segment is equal if a set checks H + 1 segments, H being
the most differences. A set therefore indexes the signatures of all its segments that aren't
empty in its own band, and probes H + 1 of them there and, if it can have partners in it, in
the band below. Which ones it probes is decided by cost: signatures rare in the task's own
documents first, then large segments, so frequent passages are passed over. Marked segments
are indexed with their one-deletion neighbourhoods as well; checking one of them for "at most
one difference" counts twice if it holds at least two elements: with one, the partner's can be
empty, and empty segments have no signatures. A set that can't reach H + 1 (its elements fell
into too few segments) is compared with all sets of fitting size.

Signatures travel packed, by hash bucket. A signature with few sets gives all their pairs. One
with many gives links to two hubs, and its sets are remembered: after the hub links are
verified and joined to components, all pairs of remembered sets that are still apart follow.
Every pair is verified on its whole texts. Equal sets share one key and never form pairs.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changemill.llm.common import WordHashes, arrow_schema, mix64, settled, text_of, window_hashes
from changemill.llm.components import components
from changemill.operators.joins import spread

cloudpickle.register_pickle_by_value(sys.modules[__name__])

WIDTH = 5
SMALL_BAND = 4      # below: every segment is marked
MARKED = 16         # above: one segment in so many is
SLACK = 1.2         # segments over those that must be probed
FEW = 24            # sets of one signature whose pairs are all listed at once
FLUSH = 1_500_000   # signatures a task gathers before it packs them
SKETCH = 32         # 64-bit words of a parity sketch
CHUNKS = 1024       # parts into which a hub's partners are dealt when they are verified


def shingle_set(text: bytes, hashes: WordHashes, width: int = WIDTH) -> np.ndarray:
    """Sorted hashes of the distinct shingles; of fewer words, of the whole sequence; empty without words."""
    words = hashes.of(text.lower().split())
    if not len(words):
        return words
    return np.unique(window_hashes(words, min(width, len(words)), seed=min(width, len(words))))


def set_key(s: np.ndarray) -> int:
    """64 bits that name a set of shingles."""
    from xxhash import xxh3_64_intdigest

    return int(np.uint64(xxh3_64_intdigest(s.tobytes())).astype(np.int64))


def sketch(s: np.ndarray) -> np.ndarray:
    """Parities of the set's elements in 64 * SKETCH bins."""
    bins = (mix64(s + np.uint64(3)) % np.uint64(64 * SKETCH)).astype(np.int64)
    return np.packbits((np.bincount(bins, minlength=64 * SKETCH) & 1).astype(np.uint8)).view(np.int64)


def near_enough(a: str, b: str, size_a: str, size_b: str):
    """Do the sketches in columns <a>0 …, <b>0 … leave at most (|r| + |s|) / 7 differences?"""
    differ = sum((F.bit_count(F.col(f"{a}{k}").bitwiseXOR(F.col(f"{b}{k}"))) for k in range(SKETCH)), F.lit(0))
    return 7 * differ <= F.col(size_a) + F.col(size_b)


def segments_of(band: np.ndarray) -> np.ndarray:
    """Number of segments of a size band."""
    most = (2 ** (band + 1) - 1) // 3 + 1
    return np.where(band < SMALL_BAND, np.array([1, 1, 5, 5])[np.minimum(band, 3)], np.ceil(SLACK * most).astype(np.int64))


def differences(n: np.ndarray, band: np.ndarray) -> np.ndarray:
    """Most differences of a set of ``n`` from one of the band that isn't larger."""
    return (n + np.minimum(n, 2 ** (band + 1) - 1)) // 7


class Signatures:
    """Signatures of a bunch of sets: sig, set number, probe flag; and sets that can't probe enough."""

    def __init__(self, sets: list[np.ndarray]) -> None:
        n = np.array([len(s) for s in sets], np.int64)
        own = np.floor(np.log2(n)).astype(np.int64)
        low = np.flatnonzero((own > 0) & (3 * n < 4 * 2 ** own) & (n > 1))
        view_set = np.concatenate([np.arange(len(sets)), low])
        band = np.concatenate([own, own[low] - 1])
        indexes = np.concatenate([np.ones(len(sets), bool), np.zeros(len(low), bool)])
        m = segments_of(band)
        first = np.concatenate([[0], np.cumsum(m)])
        size = n[view_set]
        elements = np.concatenate([sets[i] for i in view_set])
        view = np.repeat(np.arange(len(view_set)), size)
        slot = first[view] + (mix64(elements + np.uint64(7)) % m[view].astype(np.uint64)).astype(np.int64)
        content = np.zeros(first[-1], np.uint64)
        marks = mix64(elements)
        np.add.at(content, slot, marks)
        count = np.bincount(slot, minlength=first[-1])
        slot_view = np.repeat(np.arange(len(view_set)), m)
        number = np.arange(first[-1]) - first[slot_view]
        salt = mix64((band[slot_view].astype(np.uint64) << np.uint64(40)) + number.astype(np.uint64))
        exact = mix64(content ^ salt)
        marked = (band[slot_view] < SMALL_BAND) | (number % MARKED == 0)
        # how often a signature occurs here: its cost
        full = np.flatnonzero(count > 0)
        _, back, times = np.unique(exact[full], return_inverse=True, return_counts=True)
        cost = np.log2(times[back]).astype(np.int64)
        order = np.lexsort((-count[full], cost, slot_view[full]))
        ranked, in_view = full[order], slot_view[full][order]
        starts = np.searchsorted(in_view, np.arange(len(view_set)))
        place = np.arange(len(ranked)) - starts[in_view]
        need = differences(size, band) + 1
        probed = ranked[place < need[in_view]]
        # what is missing is made up by marked segments that are checked for one difference
        missing = need - np.bincount(in_view, minlength=len(view_set))
        twice = np.zeros(0, np.int64)
        short = np.flatnonzero(missing > 0)
        if len(short):
            can = full[marked[full] & (count[full] > 1) & (missing[slot_view[full]] > 0)]
            can = can[np.lexsort((count[can], slot_view[can]))]
            at = np.arange(len(can)) - np.searchsorted(slot_view[can], slot_view[can])
            twice = can[at < missing[slot_view[can]]]
            short = short[missing[short] > np.bincount(slot_view[twice], minlength=len(view_set))[short]]
        self.short = np.unique(view_set[short])
        is_probe = np.zeros(first[-1], bool)
        is_probe[probed] = True
        emit = full[indexes[slot_view[full]] | is_probe[full]]
        # neighbourhoods: each element of a marked segment left out
        loose = np.zeros(first[-1], bool)
        loose[twice] = True
        near_index = marked & indexes[slot_view] & (count > 0)
        pick = np.flatnonzero((near_index | loose)[slot])
        near = mix64((content[slot[pick]] - marks[pick]) ^ salt[slot[pick]])
        self.sig = np.concatenate([exact[emit], near])
        self.set = np.concatenate([view_set[slot_view[emit]], view_set[slot_view[slot[pick]]]])
        self.probe = np.concatenate([is_probe[emit], loose[slot[pick]]])
        self.index = np.concatenate([indexes[slot_view[emit]], near_index[slot[pick]]])


def runs(sorted_values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of runs of equal values."""
    if not len(sorted_values):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    start = np.flatnonzero(np.concatenate([[True], sorted_values[1:] != sorted_values[:-1]]))
    return start, np.diff(np.append(start, len(sorted_values)))


def fits(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Can sets of these sizes be similar enough?"""
    return 4 * np.minimum(a, b) >= 3 * np.maximum(a, b)


def unique_pairs(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    a, b = np.minimum(a, b), np.maximum(a, b)
    a, b = a[a != b], b[a != b]
    order = np.lexsort((b, a))
    a, b = a[order], b[order]
    new = np.ones(len(a), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    return a[new], b[new]


def group(sig, key, size, flag, big, few: int, always: bool):
    """Pairs and remembered sets of signatures.

    flag: 1 index, 2 probe, 3 both. ``big``: the entry stands for sets remembered elsewhere.
    With ``always`` False only large groups are handled, and the rest is returned as it was.
    """
    order = np.lexsort((key, sig))
    sig, key, size, flag, big = sig[order], key[order], size[order], flag[order], big[order]
    new = np.ones(len(sig), bool)
    new[1:] = (sig[1:] != sig[:-1]) | (key[1:] != key[:-1])
    at = np.flatnonzero(new)
    if len(at) < len(sig):  # a set met twice
        flag = np.bitwise_or.reduceat(flag, at) if len(at) else flag
        big = np.logical_or.reduceat(big, at) if len(at) else big
        sig, key, size = sig[at], key[at], size[at]
    start, length = runs(sig)
    run_of = np.repeat(np.arange(len(start)), length)
    is_big = np.logical_or.reduceat(big, start) if len(start) else np.zeros(0, bool)
    probes = np.bitwise_or.reduceat(flag, start) >= 2 if len(start) else np.zeros(0, bool)
    large = (length > few) | is_big
    pairs_a, pairs_b = [], []
    if always:
        for g in range(2, few + 1):
            which = start[(length == g) & ~large & probes]
            if len(which):
                rows = which[:, None] + np.arange(g)
                i, j = np.triu_indices(g, 1)
                a, b = rows[:, i].ravel(), rows[:, j].ravel()
                # one probes, the other is indexed
                ok = (((flag[a] & 2) > 0) & ((flag[b] & 1) > 0) | ((flag[b] & 2) > 0) & ((flag[a] & 1) > 0)) & fits(size[a], size[b])
                pairs_a.append(key[a[ok]])
                pairs_b.append(key[b[ok]])
    in_large = large[run_of] if len(run_of) else np.zeros(0, bool)
    keep = in_large & probes[run_of] if always and len(run_of) else in_large
    rows = np.flatnonzero(keep)
    if len(rows):
        # keys are hashes, so the smallest and the largest are the hubs in most groups of a cluster
        for hub in (start[run_of[rows]], (start + length - 1)[run_of[rows]]):
            ok = fits(size[rows], size[hub]) & probes[run_of[rows]]
            pairs_a.append(key[rows[ok]])
            pairs_b.append(key[hub[ok]])
    none = np.zeros(0, np.int64)
    a, b = unique_pairs(np.concatenate([none, *pairs_a]), np.concatenate([none, *pairs_b]))
    remembered = (sig[keep], key[keep], size[keep], flag[keep])
    if always:
        return a, b, remembered, None
    hubs = np.unique(np.concatenate([start[large], (start + length - 1)[large]])) if len(start) else np.zeros(0, np.int64)
    left = np.concatenate([np.flatnonzero(~in_large), hubs])
    flags = flag.copy()
    if len(hubs):
        flags[hubs] = np.bitwise_or.reduceat(flag, start)[run_of[hubs]]
    marked_big = np.zeros(len(sig), bool)
    marked_big[hubs] = True
    return a, b, remembered, (sig[left], key[left], size[left], flags[left], marked_big[left])


_PACKED = "bucket int,kind int,one binary,two binary,three binary"
ENTRIES, PAIRS, KEPT, SHORT = range(4)


def _signatures(buckets: int):
    """Texts → packed signatures by bucket, and what large local groups gave."""
    schema = arrow_schema(_PACKED)

    def flush(sets: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
        keys = np.fromiter(sets, np.int64, len(sets))
        values = list(sets.values())
        s = Signatures(values)
        size = np.array([len(v) for v in values], np.int32)
        flag = (s.index + 2 * s.probe).astype(np.uint8)
        a, b, kept, (sig, key, n, flag, big) = group(
            s.sig, keys[s.set], size[s.set], flag, np.zeros(len(s.sig), bool), few=64, always=False)
        rows = []
        bucket = (sig % np.uint64(buckets)).astype(np.int64)
        order = np.lexsort((key, bucket))
        sig, key, n, flag, big, bucket = sig[order], key[order], n[order], flag[order], big[order], bucket[order]
        for lo, length in zip(*runs(bucket)):
            cut = slice(lo, lo + length)
            # sorted by key: a set's key and size are sent once for all its signatures here
            at, times = runs(key[cut])
            who = np.rec.fromarrays([key[cut][at], n[cut][at], times.astype(np.int32)]).tobytes()
            rows.append((int(bucket[lo]), ENTRIES, sig[cut].tobytes(), (flag[cut] | big[cut].astype(np.uint8) << 2).tobytes(), who))
        for lo in range(0, len(a), 500_000):
            rows.append((int(a[lo] % buckets), PAIRS, a[lo:lo + 500_000].tobytes(), b[lo:lo + 500_000].tobytes(), None))
        for lo in range(0, len(kept[0]), 500_000):
            part = [x[lo:lo + 500_000] for x in kept]
            rows.append((int(part[0][0] % np.uint64(buckets)), KEPT, part[0].tobytes(), part[1].tobytes(), np.rec.fromarrays(part[2:]).tobytes()))
        if len(s.short):
            rows.append((0, SHORT, keys[s.short].tobytes(), size[s.short].tobytes(), None))
        for lo in range(0, len(rows), 64):
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows[lo:lo + 64]), schema)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, sets, total = WordHashes(), {}, 0
        for batch in batches:
            for text in batch.column(0):
                s = shingle_set(text.as_py(), hashes)
                if len(s) and (k := set_key(s)) not in sets:
                    sets[k] = s
                    total += len(s)
                if 2 * total > FLUSH:
                    yield from flush(sets)
                    sets, total = {}, 0
        if sets:
            yield from flush(sets)

    return run


_FOUND = "kind int,a long,b long,size int,flag int"
WHO = np.dtype([("f0", "<i8"), ("f1", "<i4"), ("f2", "<i4")])
REST = np.dtype([("f0", "<i4"), ("f1", "u1")])


def _match():
    """Packed signatures, sorted by bucket → pairs, and sets of signatures with many."""
    schema = arrow_schema(_FOUND)

    def out(kind: int, a, b, size=None, flag=None) -> Iterator[pa.RecordBatch]:
        n = len(a)
        for lo in range(0, n, 200_000):
            cut = slice(lo, lo + 200_000)
            k = len(a[cut])
            yield pa.RecordBatch.from_arrays([
                pa.array(np.full(k, kind, np.int32)), pa.array(np.asarray(a[cut]).astype(np.int64)), pa.array(np.asarray(b[cut]).astype(np.int64)),
                pa.array(np.zeros(k, np.int32) if size is None else size[cut].astype(np.int32)),
                pa.array(np.zeros(k, np.int32) if flag is None else flag[cut].astype(np.int32))], schema=schema)

    def finish(parts: list) -> Iterator[pa.RecordBatch]:
        if parts:
            a, b, kept, _ = group(*(np.concatenate(c) for c in zip(*parts)), few=FEW, always=True)
            yield from out(PAIRS, a, b)
            yield from out(KEPT, kept[0].view(np.int64), kept[1], kept[2], kept[3])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, bucket = [], None
        for batch in batches:
            for at, kind, one, two, three in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if at != bucket:
                    yield from finish(parts)
                    parts, bucket = [], at
                if kind == ENTRIES:
                    who, flag = np.frombuffer(three, WHO), np.frombuffer(two, np.uint8)
                    parts.append((np.frombuffer(one, np.uint64), np.repeat(who["f0"], who["f2"]), np.repeat(who["f1"], who["f2"]), flag & 3, flag > 3))
                elif kind == PAIRS:
                    yield from out(PAIRS, np.frombuffer(one, np.int64), np.frombuffer(two, np.int64))
                elif kind == KEPT:
                    rest = np.frombuffer(three, REST)
                    yield from out(KEPT, np.frombuffer(one, np.int64), np.frombuffer(two, np.int64), rest["f0"], rest["f1"])
                else:
                    keys = np.frombuffer(one, np.int64)
                    yield from out(SHORT, keys, keys, np.frombuffer(two, np.int32))
        yield from finish(parts)

    return run


_SETS = "doc_id long,text_key long,set_key long,n_shingles long," + ",".join(f"s{k} long" for k in range(SKETCH))


def _sets():
    """Texts → set keys, sizes and sketches; other columns go along."""
    schema = arrow_schema(_SETS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            sets = [shingle_set(t.as_py(), hashes) for t in batch.column(2)]
            keys = pa.array([set_key(s) if len(s) else None for s in sets], pa.int64())
            marks = np.array([sketch(s) for s in sets], np.int64).reshape(-1, SKETCH)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), keys, pa.array([len(s) for s in sets], pa.int64()),
                                              *[pa.array(np.ascontiguousarray(marks[:, k])) for k in range(SKETCH)]], schema=schema)

    return run


def _verify():
    """(a, chunk, b, text) rows in order, b NULL for a's own text → pairs that are similar enough."""
    schema = arrow_schema("a long,b long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, here, mine = WordHashes(), None, None
        for batch in batches:
            a_out, b_out = [], []
            for a, chunk, b, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                s = shingle_set(text, hashes)
                if b is None:
                    here, mine = (a, chunk), s
                elif here == (a, chunk):
                    both = np.intersect1d(mine, s, assume_unique=True).size
                    if 100 * both >= 75 * (len(mine) + len(s) - both):
                        a_out.append(a)
                        b_out.append(b)
                else:
                    raise RuntimeError("a pair's first text is missing")
            yield pa.RecordBatch.from_arrays([pa.array(a_out, pa.int64()), pa.array(b_out, pa.int64())], schema=schema)

    return run


def text_key(text_col: str):
    return F.xxhash64(text_of(text_col))


def verified(pairs: DataFrame, docs: DataFrame, sets: DataFrame, text_col: str) -> DataFrame:
    """The pairs (a, b) of set keys whose sets are similar enough, by their texts."""
    needed = pairs.select("a").union(pairs.select(F.col("b").alias("a"))).distinct()
    one = sets.where("set_key IS NOT NULL").groupBy("set_key").agg(F.min("text_key").alias("k"))
    one = one.join(needed, F.col("set_key") == F.col("a"), "left_semi")
    texts = docs.select(text_key(text_col).alias("text_key"), text_of(text_col).cast("binary").alias("text"))
    texts = texts.join(one, F.col("text_key") == F.col("k")).dropDuplicates(["set_key"])
    texts = settled(texts.select("set_key", "text"), "texts")
    dealt = pairs.withColumn("chunk", F.pmod(F.xxhash64("b"), F.lit(CHUNKS)))
    firsts = dealt.select("a", "chunk").distinct().join(texts, F.col("a") == F.col("set_key")).select("a", "chunk", F.lit(None).cast("long").alias("b"), "text")
    others = dealt.join(texts, F.col("b") == F.col("set_key")).select("a", "chunk", "b", "text")
    rows = firsts.union(others).repartition("a", "chunk").sortWithinPartitions("a", "chunk", F.col("b").asc_nulls_first())
    return rows.mapInArrow(_verify(), "a long, b long")


def marked(marks: DataFrame, prefix: str) -> DataFrame:
    """The sketches with ``prefix`` before key (k), size (n) and words (0 …)."""
    return marks.select(F.col("k").alias(f"{prefix}k"), F.col("n").alias(f"{prefix}n"), *[F.col(f"s{i}").alias(f"{prefix}{i}") for i in range(SKETCH)])


def joined(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(sets, roots): doc_id, text_key, set_key, n_shingles of every document; node → root of linked set keys."""
    spark = docs.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    text = text_of(text_col).cast("binary").alias("text")
    sets = settled(docs.select(F.col(id_col).cast("long").alias("doc_id"), text_key(text_col).alias("text_key"), text).mapInArrow(
        _sets(), _SETS), "sets")
    named = sets.where("set_key IS NOT NULL").dropDuplicates(["set_key"])
    marks = settled(named.select(F.col("set_key").alias("k"), F.col("n_shingles").alias("n"), *[f"s{i}" for i in range(SKETCH)]), "sketches")
    packed = docs.select(text).mapInArrow(_signatures(2 * n), _PACKED)
    found = settled(packed.repartition(n, "bucket").sortWithinPartitions("bucket").mapInArrow(_match(), _FOUND), "found")
    pairs = found.where(F.col("kind") == PAIRS).select("a", "b").distinct()
    # sets that could not probe enough segments meet all sets of fitting sizes, by size
    short = found.where(F.col("kind") == SHORT).select(F.col("a").alias("s"), F.explode(
        F.sequence(F.ceil(F.col("size") * 0.75).cast("long"), F.floor(F.col("size") / 0.75).cast("long"))).alias("n"))
    by_size = sets.where("set_key IS NOT NULL").select("set_key", F.col("n_shingles").alias("n")).distinct()
    more = by_size.join(short.distinct(), "n").where("s <> set_key").select(F.least("s", "set_key").alias("a"), F.greatest("s", "set_key").alias("b"))
    pairs = pairs.union(more).distinct().join(marked(marks, "x"), F.col("a") == F.col("xk")).join(marked(marks, "y"), F.col("b") == F.col("yk"))
    pairs = settled(pairs.where(near_enough("x", "y", "xn", "yn")).select("a", "b"), "pairs")
    links = settled(verified(pairs, docs, sets, text_col), "verified")
    roots = components(links)
    # signatures with many sets: pairs of sets that are still in different components
    kept = found.where(F.col("kind") == KEPT).select(F.col("a").alias("sig"), F.col("b").alias("key"), "size", "flag").distinct()
    kept = kept.join(roots, F.col("key") == F.col("node"), "left").select("sig", "key", "size", "flag", F.coalesce("root", "key").alias("root"))
    apart = kept.groupBy("sig").agg(F.min("root").alias("r1"), F.max("root").alias("r2"), F.max("flag").alias("f")).where("r1 <> r2 AND f >= 2").select(F.col("sig").alias("open"))
    kept = kept.join(spread(apart), F.col("sig") == F.col("open"), "left_semi")
    kept = settled(kept.join(marked(marks, "x"), F.col("key") == F.col("xk")).drop("xk", "xn"), "apart")
    probe = kept.where("flag >= 2").select(F.col("sig").alias("p_sig"), F.col("key").alias("p_key"), F.col("size").alias("p_size"), F.col("root").alias("p_root"),
                                           *[F.col(f"x{i}").alias(f"y{i}") for i in range(SKETCH)])
    cross = kept.where("flag IN (1, 3)").join(probe, (F.col("sig") == F.col("p_sig")) & (F.col("root") != F.col("p_root")) & (
        4 * F.least("size", "p_size") >= 3 * F.greatest("size", "p_size")) & near_enough("x", "y", "size", "p_size"))
    cross = cross.select(F.least("key", "p_key").alias("a"), F.greatest("key", "p_key").alias("b")).distinct()
    cross = settled(cross.join(pairs, ["a", "b"], "left_anti"), "cross")
    if not cross.isEmpty():
        more = settled(verified(cross, docs, sets, text_col), "verified")
        if not more.isEmpty():
            roots = components(links.union(more))
    return sets, roots


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (smallest doc_id reachable by links).

    A NULL or empty text has no shingles and is linked with nothing. Rows with equal sets are
    linked. A component whose identifiers are all NULL has NULL. An empty table has no rows.
    """
    sets, roots = joined(docs, id_col, text_col)
    rows = sets.join(roots, F.col("set_key") == F.col("node"), "left").select("doc_id", "n_shingles", F.coalesce("root", "set_key").alias("root"))
    rows = settled(rows, "rooted")
    least = rows.where("root IS NOT NULL").groupBy("root").agg(F.min("doc_id").alias("component_id")).withColumnRenamed("root", "r")
    out = rows.join(least, F.col("root") == F.col("r"), "left")
    return out.select("doc_id", "n_shingles", F.when(F.col("root").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def drop_near(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One document of each component, the one with the smallest identifier, with all columns."""
    sets, roots = joined(docs, id_col, text_col)
    rows = sets.join(roots, F.col("set_key") == F.col("node"), "left").select("doc_id", "text_key", F.coalesce("root", "set_key").alias("root"))
    rows = settled(rows, "rooted")
    least = rows.where("root IS NOT NULL").groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_key")).alias("w"))
    # the winner is named by identifier and text; rows that repeat both count once
    own = "__llm_near_"  # documents may have columns of any name
    won = least.select(F.col("root").alias(f"{own}root"), F.col("w.doc_id").alias(f"{own}id"), F.col("w.text_key").alias(f"{own}key"))
    keyed = docs.withColumn(f"{own}k", text_key(text_col))
    found = keyed.join(won, (F.col(f"{own}k") == F.col(f"{own}key")) & F.col(id_col).cast("long").eqNullSafe(F.col(f"{own}id")))
    empty = rows.where("root IS NULL").select(F.col("text_key").alias(f"{own}e")).distinct()
    wordless = keyed.join(empty, F.col(f"{own}k") == F.col(f"{own}e"), "left_semi")
    cols = [F.col(f"`{c}`") for c in docs.columns]
    return found.dropDuplicates([f"{own}root"]).select(*cols).union(wordless.select(*cols))
