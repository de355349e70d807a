"""Repetition coverage: how much of a text lies inside n-grams and lines that it repeats.

Per document, in numpy: rolling hashes of its words' n-grams for several n, the words covered
by n-grams found twice or more, and the characters of those words over all characters of
words. Documents are independent, so nothing is shuffled.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changemill.llm.common import WordHashes, arrow_schema, text_of, window_hashes

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: n → the largest share of characters inside repeated n-grams that a kept text may have.
LIMITS = ((3, 0.50), (5, 0.25), (8, 0.24), (13, 0.22))
LINE_LIMIT = 0.30
LEAST_WORDS, REPEAT_PERCENT, BASE_N = 10, 20, 5

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
SYMBOL = np.zeros(256, bool)
SYMBOL[list(b"#*$%&|<>")] = True

OUT = ("doc_id long,n_words long,word_chars long,n_symbols long,n_dup_lines long,n_repeat_words long,"
       "base_failed boolean,kept boolean,line_share double," + ",".join(f"share_{n} double" for n, _ in LIMITS))


def covered(hashes: np.ndarray, n: int, n_words: int) -> np.ndarray:
    """Which words lie in an n-gram found twice or more, the first one included."""
    out = np.zeros(n_words, bool)
    if len(hashes) < 2:
        return out
    s = np.sort(hashes)
    twice = s[1:][s[1:] == s[:-1]]
    if len(twice):
        at = np.flatnonzero(np.isin(hashes, twice))
        edge = np.zeros(n_words + 1, np.int64)
        np.add.at(edge, at, 1)
        np.add.at(edge, at + n, -1)
        out = np.cumsum(edge[:-1]) > 0
    return out


def measure(text: bytes, hashes: WordHashes) -> tuple:
    """All counts of one text, and the verdict."""
    b = np.frombuffer(text, np.uint8)
    words = text.split()
    n = len(words)
    space = SPACE[b]
    starts_char = (b & 0xC0) != 0x80
    if n:
        inside = np.concatenate(([False], ~space, [False]))
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        chars = np.concatenate(([0], np.cumsum(starts_char)))
        sizes = chars[edges[1::2]] - chars[edges[::2]]
    else:
        sizes = np.zeros(0, np.int64)
    total = int(sizes.sum())
    seen, dup_lines, dup_chars, line_chars = set(), 0, 0, 0
    for line in text.split(b"\n"):
        if line.strip():
            line_chars += len(line)
            if line in seen:
                dup_lines += 1
                dup_chars += len(line)
            else:
                seen.add(line)
    ids = hashes.of(words)
    repeat, shares = 0, []
    for k, _ in LIMITS:
        mask = covered(window_hashes(ids, k), k, n)
        shares.append(float(sizes[mask].sum()) / total if total else 0.0)
        if k == BASE_N:
            repeat = int(mask.sum())
    line_share = dup_chars / line_chars if line_chars else 0.0
    failed = n < LEAST_WORDS or 100 * repeat > REPEAT_PERCENT * n
    kept = not failed and line_share <= LINE_LIMIT and all(s <= most for s, (_, most) in zip(shares, LIMITS))
    return n, total, int(SYMBOL[b].sum()), dup_lines, repeat, failed, kept, line_share, *shares


def _run():
    schema = arrow_schema(OUT)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            rows = [measure(t.as_py(), hashes) for t in batch.column(1)]
            cols = list(zip(*rows)) or [()] * (len(schema) - 1)
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, f.type) for c, f in zip(cols, list(schema)[1:])]], schema=schema)

    return run


def repetition(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts, shares and verdict per document.

    A NULL or empty text has no words, so it fails the base rule; repeated rows are measured
    each for itself.
    """
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).cast("binary").alias("t")).mapInArrow(_run(), OUT)
