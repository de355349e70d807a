"""Conversation structure repair: the cheapest edits to turns of user and assistant, with an audit.

A conversation should read ``system? (user assistant)+`` or be empty. Every row is kept, given
another role or deleted, rows may be inserted, and the edits' initials in order are the audit; of
the cheapest ones the ASCII-least audit is chosen.

The dynamic programme holds a best audit for each of four states (nothing yet, after system, after
user, after assistant). An audit is a linked node: its last label (the edit of one row, with an
insert before it if there is one), the node before it, its rolling hash and its ancestors 2^k rows
up. Audits thus share their prefixes, and two of equal cost are compared by a search for their
longest common prefix over the ancestors; equal hashes of different nodes are checked letter by
letter. Labels are a prefix code, so where two audits part their labels decide, and audits of
different states never are equal (their letters give the state).

Rows are placed by a range sort. A conversation is cut into segments of SEGMENT rows, and a task
finds the best audit of a segment from each state to each; segments then join as rows do, their
audits being labels. So a conversation that holds a third of all rows is split, and only its audit
and at last its digest, which SHA-256 can't compute in parts, pass one task, as streams.
"""

from __future__ import annotations

import hashlib
import itertools
import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changemill.llm.common import arrow_schema, batches_of, rows_of, settled
from changemill.operators.joins import spread
from changemill.operators.ordering import with_position

cloudpickle.register_pickle_by_value(sys.modules[__name__])

WHITE = " \t\n\x0b\x0c\r"
SEGMENT = 12                                    # bits of a row's place in its segment
NOTHING, SYSTEM, USER, ASSISTANT = range(4)     # states: what was put out last
WHOLE, TRUNCATED, DELETE_ONLY = range(3)        # what a row's fault asks for
RELABEL, REMOVE, INSERT, CUT_OFF = 1, 2, 5, 5   # costs
BASE, PRIME = 1_000_003, (1 << 61) - 1
LONGEST = (1 << 63) - 1


class Audit:
    """A string of edits: its last label and the audit before that."""

    __slots__ = ("up", "label", "length", "hash")

    def __init__(self, before: Audit | None, label: str) -> None:
        self.label = label
        if before is None:
            self.up, self.length, self.hash = [], 0, 0
            return
        self.up = [before]
        while len(self.up) <= len(self.up[-1].up):
            self.up.append(self.up[-1].up[len(self.up) - 1])
        self.length, self.hash = before.length + len(label), before.hash
        for letter in label:
            self.hash = (self.hash * BASE + ord(letter)) % PRIME

    def labels(self) -> Iterator[Audit]:
        """This audit and those before it, without the empty one."""
        at = self
        while at.up:
            yield at
            at = at.up[0]

    def text(self) -> str:
        return "".join([a.label for a in self.labels()][::-1])


def same(a: Audit, b: Audit) -> bool:
    """Do two audits of as many labels have the same letters? Equal hashes are checked."""
    if a is b:
        return True
    if a.hash != b.hash or a.length != b.length:
        return False
    for x, y in zip(a.labels(), b.labels()):
        if x is y:
            return True
        if x.label != y.label:
            return False
    return True


def less(a: Audit, b: Audit) -> bool:
    """Is ``a`` ASCII-less than ``b``, which has as many labels? Up to where they part in log steps."""
    if same(a, b):
        return False
    for k in reversed(range(len(a.up))):
        if k < len(a.up) and not same(a.up[k], b.up[k]):
            a, b = a.up[k], b.up[k]
    return a.label < b.label


class Best(dict):
    """State → (cost, audit before the label, label): the cheapest, of them the least."""

    def offer(self, state: int, cost: int, before: Audit, label: str) -> None:
        held = self.get(state)
        if held is not None:
            if cost > held[0]:
                return
            if cost == held[0]:
                better = label < held[2] if before is held[1] else less(before, held[1])
                if not better:
                    return
        self[state] = (cost, before, label)

    def grown(self) -> dict[int, tuple[int, Audit]]:
        return {state: (cost, Audit(before, label)) for state, (cost, before, label) in self.items()}


def step(now: dict[int, tuple[int, Audit]], role: str, fault: int) -> dict[int, tuple[int, Audit]]:
    """The best audits after one more row with the role initial ``role``.

    An insert goes right before the row it makes way for: before a deleted row the same cost
    buys the lesser audit with the insert behind it. Two in a row never pay.
    """
    best = Best()
    for state, (cost, audit) in now.items():
        best.offer(state, cost + REMOVE, audit, "D")
        if fault == DELETE_ONLY:
            continue
        cost += CUT_OFF if fault == TRUNCATED else 0
        if state == NOTHING and role == "s":
            best.offer(SYSTEM, cost, audit, "K")
        due, then = (ASSISTANT, USER) if state == USER else (USER, ASSISTANT)
        for target, before, price in ((due, "", 0), (then, "I", INSERT)):
            fits = role == ("u" if target == USER else "a")
            best.offer(target, cost + price + (0 if fits else RELABEL), audit, before + ("K" if fits else "R"))
    return best.grown()


def closed(now: dict[int, tuple[int, Audit]]) -> tuple[int, str]:
    """Cost and audit of a whole conversation: what is missing at the end is inserted."""
    best = Best()
    for state, inserts in ((NOTHING, ""), (ASSISTANT, ""), (USER, "I"), (SYSTEM, "II")):
        if state in now:
            cost, audit = now[state]
            best.offer(NOTHING, cost + INSERT * len(inserts), audit, inserts)
    cost, audit, inserts = best[NOTHING]
    return cost, audit.text() + inserts


def repaired(audit: str, rows: Iterator[tuple[bytes, bytes]]) -> Iterator[tuple[str, bytes, bytes]]:
    """(edit, role, text) of what the audit leaves of the rows (role, text)."""
    due, rows = b"user", iter(rows)
    for edit in audit:
        role, text = (due, b"") if edit == "I" else next(rows)
        if edit == "D":
            continue
        role = role if edit == "K" else due
        due = b"assistant" if role[:1] == b"u" else b"user"
        yield edit, role, text


def damage(conv: DataFrame, modulus: int = 20) -> DataFrame:
    """(conv_id, turn, role, text): of the crc32 of ``conv_id:turn`` modulo ``modulus``, 0 drops a row,
    1 empties its text, 2 takes its ``.!?``, 3 repeats it, 4 makes it the user's. NULL is one space
    in the crc, as role and as text; conv_id and turn stay NULL."""
    s = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(s("conv_id"), F.lit(":"), s("turn")).cast("binary")) % modulus
    rows = conv.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), s("role").alias("role"), s("text").alias("text"), kind.alias("kind"))
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    times = F.when(F.col("kind") == 0, 0).when(F.col("kind") == 3, 2).otherwise(1)
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(F.array_repeat(F.lit(0), times))).drop("col")


def placed(rows: DataFrame) -> DataFrame:
    """(conv_id, seg, pos, turn, initial, fault) of (conv_id, turn, role, text): by turn, NULL first,
    equal turns by role and then by the digest of the text, so that only equal rows tie."""
    trimmed = F.rtrim("text", F.lit(WHITE))
    marks = rows.select("conv_id", "turn", "role", F.sha2(F.col("text").cast("binary"), 256).alias("digest"), (trimmed == "").alias("blank"),
                        (~F.substring(trimmed, -1, 1).isin(".", "!", "?")).alias("open"))
    marks = settled(with_position(marks, ["conv_id", "turn", "role", "digest"]), "placed")
    begins = marks.groupBy(F.col("conv_id").alias("c")).agg(F.min("pos").alias("first"))
    earliest = marks.groupBy("conv_id", "role", "digest").agg(F.min("pos").alias("e")).select("e")
    known = marks.join(spread(begins), F.col("conv_id").eqNullSafe(F.col("c")), "left")
    known = known.join(earliest, F.col("pos") == F.col("e"), "left")
    fault = F.when(F.col("blank"), "b").when(F.col("e").isNull(), "d").when(F.col("open"), "t").otherwise("")
    return known.select("conv_id", F.shiftright(F.col("pos") - F.col("first"), SEGMENT).alias("seg"), "pos", "turn", F.substring("role", 1, 1).alias("initial"), fault.alias("fault"))


_FACTS = "blank long, duplicate long, truncated long, illegal long, turns long, low long, high long, head string, tail string"
_SEGMENTS = f"conv_id long, seg long, entry long, leaving long, cost long, audit string, {_FACTS}"
_AUDITS = "conv_id long, cost long, audit string, gaps long, blank long, duplicate long, truncated long, illegal long"
_RESULT = f"{_AUDITS}, repaired_sha256 string"


def _illegal(a: str, b: str) -> bool:
    return a + b not in ("su", "ua", "au")


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows of ``placed`` → the best audits of each segment, and what is counted in it."""

    def found():
        for (conv, seg), rows in itertools.groupby(rows_of(batches), lambda r: r[:2]):
            ways = {e: {e: (0, Audit(None, ""))} for e in ((NOTHING,) if seg == 0 else range(4))}
            faults, illegal, turns, low, high, head, tail = dict.fromkeys("bdt", 0), 0, 0, None, None, None, None
            for _, _, _, turn, initial, fault in rows:
                faults[fault] = faults.get(fault, 0) + 1
                illegal += tail is not None and _illegal(tail, initial)
                head, tail = initial if head is None else head, initial
                if turn is not None:
                    turns += turn != high
                    low, high = turn if low is None else low, turn
                kind = DELETE_ONLY if fault in ("b", "d") else TRUNCATED if fault else WHOLE
                ways = {e: step(now, initial, kind) for e, now in ways.items()}
            facts = (faults["b"], faults["d"], faults["t"], illegal, turns, low, high, head, tail)
            for e, now in ways.items():
                for state, (cost, audit) in sorted(now.items()):
                    yield conv, seg, e, state, cost, audit.text(), *facts

    return batches_of(found(), arrow_schema(_SEGMENTS), 256)


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted segments → one row per conversation."""

    def found():
        for conv, of_conv in itertools.groupby(rows_of(batches), lambda r: r[0]):
            now = {NOTHING: (0, Audit(None, ""))}
            blank = duplicate = truncated = illegal = turns = 0
            low = high = tail = None
            for _, ways in itertools.groupby(of_conv, lambda r: r[1]):
                best = Best()
                for _, _, entry, leaving, cost, label, *facts in ways:
                    if entry in now:
                        best.offer(leaving, now[entry][0] + cost, now[entry][1], label)
                now = best.grown()
                blank, duplicate, truncated = blank + facts[0], duplicate + facts[1], truncated + facts[2]
                illegal += facts[3] + (tail is not None and _illegal(tail, facts[7]))
                tail = facts[8]
                if facts[4]:
                    turns += facts[4] - (facts[5] == high)
                    low, high = facts[5] if low is None else low, facts[6]
            cost, audit = closed(now)
            yield conv, cost, audit, 0 if low is None else min(high - low + 1 - turns, LONGEST), blank, duplicate, truncated, illegal

    return batches_of(found(), arrow_schema(_AUDITS), 256)


def audits(rows: DataFrame) -> DataFrame:
    """One row for each conversation that has rows: conv_id, cost, audit and the faults counted."""
    known = placed(rows)
    found = known.repartition("conv_id", "seg").sortWithinPartitions("conv_id", "seg", "pos").mapInArrow(_segments, _SEGMENTS)
    return found.repartition("conv_id").sortWithinPartitions("conv_id", "seg", "entry", "leaving").mapInArrow(_merge, _AUDITS)


def _with_audits(rows: DataFrame, found: DataFrame) -> DataFrame:
    """Each conversation's audit and then its rows in order, in one partition."""
    none = lambda kind: F.lit(None).cast(kind)
    texts = rows.select("conv_id", F.lit(1).alias("kind"), "turn", F.col("role").cast("binary").alias("role"), F.col("text").cast("binary").alias("text"),
                        F.sha2(F.col("text").cast("binary"), 256).alias("digest"), none("long").alias("cost"), none("string").alias("audit"),
                        *[none("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal")])
    heads = found.select("conv_id", F.lit(0).alias("kind"), none("long").alias("turn"), none("binary").alias("role"), none("binary").alias("text"), none("string").alias("digest"),
                         "cost", "audit", "gaps", "blank", "duplicate", "truncated", "illegal")
    return heads.unionAll(texts).repartition("conv_id").sortWithinPartitions("conv_id", "kind", "turn", "role", "digest")


def _streams(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(facts of a conversation, its repaired rows as a stream)."""
    for conv, rows in itertools.groupby(rows_of(batches), lambda r: r[0]):
        _, _, _, _, _, _, cost, audit, *counts = next(rows)
        yield (conv, cost, audit, *counts), repaired(audit, ((r[3], r[4]) for r in rows))


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def found():
        for facts, rows in _streams(batches):
            sha, between = hashlib.sha256(), b""
            for _, role, text in rows:
                sha.update(between + role + b":")
                sha.update(text)
                between = b"\n"
            yield *facts, sha.hexdigest()

    return batches_of(found(), arrow_schema(_RESULT), 256)


_ROWS = "conv_id long, place long, edit string, role binary, text binary"


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found = ((facts[0], i, *row) for facts, rows in _streams(batches) for i, row in enumerate(rows))
    return batches_of(found, arrow_schema(_ROWS), 256)


def repaired_rows(rows: DataFrame) -> DataFrame:
    """The repaired conversations: conv_id, place (from 0), edit (K, R or I), role, text."""
    out = _with_audits(rows, audits(rows)).mapInArrow(_rows, _ROWS)
    return out.select("conv_id", "place", "edit", F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))


def repair(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """One row for each distinct conv_id of ``ids`` (NULL is one): gaps, blank, duplicate, truncated,
    illegal, cost, audit, repaired_sha256, of the rows (conv_id, turn, role, text).

    A conversation without rows has zeros, an empty audit and the digest of nothing. A row's first
    fault counts: blank (NULL and white space), duplicate (role and text seen earlier), truncated.
    Rows without a turn come first and count for no gap; equal turns are ordered by role and the
    text's digest; equal rows are duplicates. A role is read by its first letter; one that is empty
    or begins otherwise than s, u, a can't be kept. Gaps beyond the largest long are that. An empty
    table of ids has no rows.
    """
    found = _with_audits(rows, audits(rows)).mapInArrow(_digests, _RESULT).withColumnRenamed("conv_id", "c")
    every = ids.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    out = every.join(found, F.col("conv_id").eqNullSafe(F.col("c")), "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0).cast("long")).alias(c)
    return out.select("conv_id", *[zero(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")], F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"))
