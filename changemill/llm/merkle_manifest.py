"""Merkle manifest of a dataset: one tree per language below a tree of subroots, proofs by octopus.

Every document is a leaf. Ranks come from a range sort (equal identifiers by digest), interior
nodes from one aggregate a level, eight children each, so a level is an eighth of the one below.

A proof alone needs every sibling on its way to the root. Leaves are therefore proved by runs of
consecutive ones: a task lists the smallest set of node coordinates that the run can't derive from
its own leaves (the octopus of the run, a few dozen for thousands of leaves), these are fetched by
one join, the task derives all shared interiors once and writes out each leaf's own proof.
"""

from __future__ import annotations

import hashlib
import itertools
import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changemill.llm.common import arrow_schema, batches_of, crc_mod, lower_ascii, rows_of, settled
from changemill.operators.ordering import with_position

cloudpickle.register_pickle_by_value(sys.modules[__name__])

FAN = 3        # bits of a node's place below its parent: eight children
RUN = 12       # bits of a leaf's place in the run that is proved together
TOP = 0        # the tree of subroots; the others are numbered from one
DIGEST = 64    # characters of a digest


def _h(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def field(value: Column) -> Column:
    """A value with its length, so that no two rows give one text; NULL is a dash."""
    s = value.cast("string")
    return F.when(s.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s))


def leaf(fields: list[Column]) -> Column:
    return F.sha2(F.concat(*[field(f) for f in fields]).cast("binary"), 256)


def leaves(rows: DataFrame, lang: str = "lang") -> DataFrame:
    """(doc_id, leaf, other) → the same with ``tree``, ``idx`` in it, its size ``n``, the number of
    trees ``trees`` and the row's place ``pos`` in all. Trees by language, NULL first, bytewise;
    leaves by doc_id, NULL first, equal ones by digest."""
    rows = with_position(rows, [lang, "doc_id", "leaf"])
    langs = rows.groupBy(F.col(lang).alias("l")).agg(F.min("pos").alias("first"), F.count(F.lit(1)).alias("n"))
    langs = with_position(langs, ["l"], "rank")
    trees = F.lit(langs.count()).cast("long").alias("trees")
    rows = rows.join(langs, F.col(lang).eqNullSafe(F.col("l")), "left")
    return rows.select("doc_id", "leaf", "other", (F.col("rank") + 1).alias("tree"), (F.col("pos") - F.col("first")).alias("idx"), "n", trees, "pos")


def grown(level0: DataFrame) -> DataFrame:
    """(tree, idx, n, h) of leaves → nodes (tree, level, idx, n, h) of all levels; ``n`` nodes on a level."""
    now, level = level0.withColumn("level", F.lit(0)).select("tree", "level", "idx", "n", "h"), 0
    out = now
    while True:
        children = F.array_sort(F.collect_list(F.struct("idx", "h")))  # eight at most
        level += 1
        now = now.where("n > 1").groupBy("tree", F.shiftright("idx", FAN).alias("idx"), F.shiftright(F.col("n") + ((1 << FAN) - 1), FAN).alias("n")).agg(
            F.sha2(F.concat_ws("", F.transform(children, lambda c: c["h"])).cast("binary"), 256).alias("h"))
        now = settled(now.withColumn("level", F.lit(level)).select("tree", "level", "idx", "n", "h"), "nodes")
        if now.isEmpty():
            return out
        out = out.unionAll(now)


def nodes(known: DataFrame) -> DataFrame:
    """All nodes of all trees; the one of TOP that is alone on its level is the root."""
    low = grown(known.select("tree", "idx", "n", F.col("leaf").alias("h")))
    sub = settled(low.where("n = 1").select(F.lit(TOP).cast("long").alias("tree"), (F.col("tree") - 1).alias("idx"), "h"), "subroots")
    return low.unionAll(grown(sub.withColumn("n", F.lit(sub.count()).cast("long"))))


def unknown(places: list[int], n: int) -> Iterator[tuple[int, int]]:
    """(level, place) of the nodes that leaves at sorted ``places`` of a tree of ``n`` can't derive."""
    level, known = 0, places
    while n > 1:
        above = []
        for parent, children in itertools.groupby(known, lambda i: i >> FAN):
            have = set(children)
            above.append(parent)
            yield from ((level, i) for i in range(parent << FAN, min((parent + 1) << FAN, n)) if i not in have)
        known, n, level = above, (n + (1 << FAN) - 1) >> FAN, level + 1


class Branch:
    """The part of a tree that a run of leaves can see: its own leaves and what was fetched."""

    def __init__(self, n: int, own: dict[int, str], fetched: dict[tuple[int, int], str]) -> None:
        self.runs: list[dict[int, str]] = []  # by level: digests of a parent's children, joined
        level, now = 0, own
        while n > 1:
            joined = {}
            for parent in {i >> FAN for i in now}:
                children = range(parent << FAN, min((parent + 1) << FAN, n))
                joined[parent] = "".join(now[i] if i in now else fetched[level, i] for i in children)
            self.runs.append(joined)
            now, n, level = {p: _h(s) for p, s in joined.items()}, (n + (1 << FAN) - 1) >> FAN, level + 1
        self.root = now[0]
        self.ways: dict[tuple[int, int], str] = {}

    def proof(self, place: int, level: int = 0) -> str:
        """Digests of the siblings from ``place`` up, level by level; shared parts are joined once."""
        if level == len(self.runs):
            return ""
        way = self.ways.get((level, place >> FAN))
        if way is None:
            way = self.ways[level, place >> FAN] = self.proof(place >> FAN, level + 1)
        run, at = self.runs[level][place >> FAN], DIGEST * (place & ((1 << FAN) - 1))
        return run[:at] + run[at + DIGEST:] + way

    def fold(self, place: int, digest: str) -> str:
        """The root that follows from ``digest`` at ``place`` and its siblings."""
        for joined in self.runs:
            run, at = joined[place >> FAN], DIGEST * (place & ((1 << FAN) - 1))
            digest, place = _h(run[:at] + digest + run[at + DIGEST:]), place >> FAN
        return digest


_NEEDED = "part long, tree long, level long, idx long"
_PROOFS = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string"


def _needs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (part, tree, idx, n, trees) → coordinates of the nodes that a part has to fetch."""

    def all_needs():
        for part, rows in itertools.groupby(rows_of(batches), lambda r: r[0]):
            seen, trees = [], 0
            for tree, members in itertools.groupby(rows, lambda r: r[1]):
                members = list(members)  # at most a run
                seen.append(tree - 1)
                trees = members[0][4]
                yield from ((part, tree, level, i) for level, i in unknown([m[2] for m in members], members[0][3]))
            yield from ((part, TOP, level, i) for level, i in unknown(seen, trees))

    return batches_of(all_needs(), arrow_schema(_NEEDED))


def _expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (part, kind, tree, idx, level, n, trees, doc_id, h, other): fetched nodes (kind 0) of a
    part, then its leaves (kind 1) → proofs."""

    def proofs():
        for _, rows in itertools.groupby(rows_of(batches), lambda r: r[0]):
            fetched: dict[int, dict] = {}
            own: dict[int, list] = {}
            for _, kind, tree, idx, level, n, trees, doc_id, h, other in rows:  # a run and its octopus
                if kind == 0:
                    fetched.setdefault(tree, {})[level, idx] = h
                else:
                    own.setdefault(tree, []).append((idx, n, trees, doc_id, h, other))
            low = {t: Branch(m[0][1], {x[0]: x[4] for x in m}, fetched.get(t, {})) for t, m in own.items()}
            top = Branch(next(iter(own.values()))[0][2], {t - 1: b.root for t, b in low.items()}, fetched.get(TOP, {}))
            for tree, members in own.items():
                branch, above = low[tree], top.proof(tree - 1)
                for idx, _, _, doc_id, h, other in members:
                    folded = top.fold(tree - 1, branch.fold(idx, other or h))
                    yield doc_id, h, branch.root, top.root, _h(branch.proof(idx) + above), folded

    return batches_of(proofs(), arrow_schema(_PROOFS))


def prove(known: DataFrame, all_nodes: DataFrame) -> DataFrame:
    """Proofs of the leaves ``known`` (all or some of those the nodes were made from): doc_id, leaf,
    subroot, root, proof_sha256, folded_root. ``other`` replaces the leaf when the root is folded."""
    part = F.shiftright("pos", RUN).alias("part")
    narrow = known.select(part, "tree", "idx", "n", "trees").repartition("part").sortWithinPartitions("part", "tree", "idx")
    needed = narrow.mapInArrow(_needs, _NEEDED)
    at = all_nodes.select(F.col("tree").alias("t"), F.col("level").alias("l"), F.col("idx").alias("i"), "h")
    fetched = needed.join(at, (F.col("tree") == F.col("t")) & (F.col("level") == F.col("l")) & (F.col("idx") == F.col("i")))
    none = F.lit(None).cast("long")
    rows = fetched.select("part", F.lit(0).alias("kind"), "tree", "idx", "level", none.alias("n"), none.alias("trees"), none.alias("doc_id"), "h", F.lit(None).cast("string").alias("other"))
    rows = rows.unionAll(known.select(part, F.lit(1), "tree", "idx", F.lit(0).cast("long"), "n", "trees", "doc_id", "leaf", "other"))
    return rows.repartition("part").sortWithinPartitions("part", "kind", "tree", "idx").mapInArrow(_expand, _PROOFS)


def manifest(docs: DataFrame, id_col: str = "doc_id", lang: str = "lang", text_col: str = "text", tampered: int = 3) -> DataFrame:
    """One row per document: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.

    Where ``tampered`` divides crc32 of the decimal identifier, the root is folded from the leaf of
    the lower-cased text (A-Z); ``verified`` is true where that changes nothing. A NULL is a value of
    its own in every column, so NULL and empty texts differ; a NULL identifier counts as empty text in
    the crc. NULL languages are one tree, the first; rows with one identifier are ordered by digest,
    equal rows are leaves of their own. A lone leaf is its subroot, a lone subroot the root. An empty
    table has no rows. Other columns are not read.
    """
    text = F.col(text_col).cast("string")
    cols = lambda t: [F.col(id_col).cast("long"), F.col("source"), F.col(lang), F.col("n_chars"), t]
    other = F.when(crc_mod(id_col, tampered) == 0, leaf(cols(lower_ascii(text))))
    rows = docs.select(F.col(lang).cast("string").alias("lang"), F.col(id_col).cast("long").alias("doc_id"), leaf(cols(text)).alias("leaf"), other.alias("other"))
    known = settled(leaves(settled(rows, "leaves")), "ranked")
    return prove(known, nodes(known)).withColumn("verified", F.col("root") == F.col("folded_root"))
