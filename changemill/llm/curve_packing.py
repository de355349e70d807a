"""Packing along a space-filling curve: neighbours in content become neighbours in sequences.

Every run of bytes has a pseudo-random vector of few dimensions that follows from its hash; a
document's vector is the mean of its runs', which is a random projection of its hashed run
counts, cut to a grid. The cell's place on the Hilbert curve through the grid is the document's sort key. Rows are
dealt by ranges of (key, a hash of the document), so a cell that holds a third of all rows is
cut as well. Each range is one stream of tokens, cut every ``length`` tokens; what is left at
its end is cut at powers of two, which need no padding.
"""

from __future__ import annotations

import re
import sys
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changemill.llm.common import arrow_schema, text_of

cloudpickle.register_pickle_by_value(sys.modules[__name__])

DIMS, BITS = 4, 8
PIECES = "doc_id long,start long,length long,ids_crc32 long,doc_tokens long,sequence_id long,offset long"


def cell(text: bytes) -> np.ndarray:
    """The document's grid cell; a text of less than four bytes lies in the middle.

    Every run of four bytes (A-Z lower-cased) has a pseudo-random vector, the bytes of its
    hash; the document's vector is their mean.
    """
    low = text.lower()
    if len(low) < 4:
        return np.full(DIMS, 1 << (BITS - 1), np.int64)
    # all runs: aligned ones from each of four starts
    h = np.concatenate([np.frombuffer(low, "<u4", (len(low) - k) // 4, k) for k in range(4)])
    h *= np.uint32(0x9E3779B1)
    h ^= h >> np.uint32(15)
    h *= np.uint32(0x85EBCA77)
    h ^= h >> np.uint32(13)
    parts = h.view(np.uint8)
    mean = np.array([int(parts[d::DIMS].sum(dtype=np.uint64)) for d in range(DIMS)]) / len(h) / 127.5 - 1
    mean = mean * 16  # frequent runs leave means of about 0.05
    mean = mean / (1 + np.abs(mean))
    return np.clip(((mean + 1) / 2 * (1 << BITS)).astype(np.int64), 0, (1 << BITS) - 1)


def hilbert(cells: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Places of grid cells (rows) on the Hilbert curve, by Skilling's transposed form."""
    x = cells.astype(np.int64).T.copy()
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        p = q - 1
        for i in range(n):
            set_ = (x[i] & q) != 0
            swap = np.where(set_, 0, (x[0] ^ x[i]) & p)
            x[0] = np.where(set_, x[0] ^ p, x[0] ^ swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    t = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        t = np.where(x[n - 1] & q, t ^ (q - 1), t)
        q >>= 1
    x ^= t
    out = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            out = (out << 1) | ((x[i] >> b) & 1)
    return out


def _keys():
    schema = arrow_schema("doc_id long,text binary,key long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = np.array([cell(t.as_py()) for t in batch.column(1)], np.int64).reshape(-1, DIMS)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(hilbert(cells))], schema=schema)

    return run


#: Letters and digits up to U+024F; white space as the tokenizer knows it.
LETTERS, DIGITS, WHITE = "a-zA-Z\u00aa\u00b5\u00ba\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f", "0-9\u00b2\u00b3\u00b9\u00bc-\u00be", "\\t-\\r \u0085\u00a0"
#: The tokenizer's pattern for lower-cased Latin text.
PIECES_OF = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[{DIGITS}]|[^{WHITE}{LETTERS}{DIGITS}]+")
#: Letters whose small forms lie outside that range.
FAR = "".join(chr(c) for c in range(0x250) if max(chr(c).lower()) > "\u024f")
#: What is left to the tokenizer: other scripts, and what could be a special token.
ODD = re.compile(f"[{FAR}\u0250-\U0010ffff]|<\\|")


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in the tokenizer's vocabulary: printable bytes for
    themselves, the others by letters from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(rest)}


class Tokens(dict):
    """Token ids, as little-endian 32-bit values, of pieces met before.

    The tokenizer lower-cases a text, splits it into runs of letters, digits and signs and
    merges bytes inside each. Latin text is split here by the same pattern, and only pieces
    not met before are merged. What stands between white space and holds other scripts, or
    could be a special token, is given to the tokenizer whole.
    """

    def __init__(self, path: str, limit: int = 900_000) -> None:
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer, self.limit = Tokenizer.from_file(path), limit
        self.merge, self.letters = self.tokenizer.model.tokenize, byte_letters()

    def __missing__(self, piece: str) -> bytes:
        if len(self) >= self.limit:
            self.clear()
        letters = piece.encode().decode("latin-1").translate(self.letters)  # ASCII control characters have letters too
        value = self[piece] = np.array([t.id for t in self.merge(letters)], "<u4").tobytes()
        return value

    def latin(self, text: str) -> bytes:
        return b"".join(map(self.__getitem__, PIECES_OF.findall(text.lower())))

    def of(self, text: bytes) -> bytes:
        whole = text.decode("utf-8", "replace")
        if not ODD.search(whole):
            return self.latin(whole)
        out = []
        for part in text.split():
            part = part.decode("utf-8", "replace")
            if ODD.search(part):
                out.append(np.array(self.tokenizer.encode(part, add_special_tokens=False).ids, "<u4").tobytes())
            else:
                out.append(self.latin(part))
        return b"".join(out)


def cuts(left: int, length: int) -> list[int]:
    """Sizes of the sequences that ``left`` tokens make: whole ones, then powers of two."""
    whole, rest = divmod(left, length)
    return [length] * whole + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]


def _pack(path: str, length: int, end_id: int):
    schema = arrow_schema(PIECES)
    end = np.array([end_id], "<u4").tobytes()

    def flush(rows: list) -> Iterator[pa.RecordBatch]:
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, sequence, base = Tokens(path), 0, None
        open_, filled = [], 0  # pieces of the open sequence, with their ids
        for batch in batches:
            rows = []
            for i, text, part in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist(), strict=True):
                base = part << 40
                ids = tokens.of(text.as_py()) + end
                n, at = len(ids) // 4, 0
                while at < n:
                    take = min(n - at, length - filled)
                    open_.append((i, at, ids[4 * at:4 * (at + take)], n))
                    at, filled = at + take, filled + take
                    if filled == length:
                        rows += close(open_, base + sequence)
                        open_, filled, sequence = [], 0, sequence + 1
            yield from flush(rows)
        rows = []
        for size in cuts(filled, length):
            now, got = [], 0
            while got < size:
                i, at, ids, n = open_.pop(0)
                take = min(size - got, len(ids) // 4)
                now.append((i, at, ids[:4 * take], n))
                if 4 * take < len(ids):
                    open_.insert(0, (i, at + take, ids[4 * take:], n))
                got += take
            rows += close(now, base + sequence)
            sequence += 1
        yield from flush(rows)

    return run


def close(pieces: list[tuple], sequence: int) -> list[tuple]:
    out, offset = [], 0
    for i, at, ids, n in pieces:
        size = len(ids) // 4
        out.append((i, at, size, zlib.crc32(ids), n, sequence, offset))
        offset += size
    return out


def pack(docs: DataFrame, tokenizer: str, length: int = 2048, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A NULL or empty text is its end token alone. Rows that repeat a document are packed each.
    ``length`` must be a power of two. An empty table has no pieces.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).cast("binary").alias("text"))
    keyed = rows.mapInArrow(_keys(), "doc_id long, text binary, key long").withColumn("salt", F.xxhash64("doc_id", "text"))
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ("key", "salt", "doc_id")
    sorted_ = keyed.repartitionByRange(n, *order).sortWithinPartitions(*order)
    return sorted_.select("doc_id", "text", F.spark_partition_id().alias("part")).mapInArrow(_pack(tokenizer, length, end_id), PIECES)
