"""Quality by compression: a dictionary of good and one of bad text, and what each saves.

Two zstandard dictionaries are built from labelled texts. A text is cut into pieces, every
piece is compressed with both, and the difference of the two sizes, over their sum, says which
side the text resembles. A logistic curve fitted on other labelled texts turns the difference
(and the compressed sizes over the length, which give repetition away) into a probability.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changemill.llm import fitting
from changemill.llm.common import arrow_schema, crc_mod, text_of

cloudpickle.register_pickle_by_value(sys.modules[__name__])

PIECE = 2048  # bytes compressed at a time, so that a dictionary counts throughout a text
LEVEL = 3


class Sizes:
    """Compressed sizes of a text under both dictionaries and under none."""

    def __init__(self, good: bytes, bad: bytes) -> None:
        self.by = [zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(d)) if d else
                   zstandard.ZstdCompressor(level=LEVEL) for d in (good, bad)]
        self.plain = zstandard.ZstdCompressor(level=LEVEL)

    def features(self, text: bytes) -> list[float]:
        n = len(text)
        good, bad = (np.array([len(c.compress(text[i:i + PIECE])) for i in range(0, max(n, 1), PIECE)], float) for c in self.by)
        diff = (bad - good) / (bad + good)
        total = (bad.sum() - good.sum()) / (bad.sum() + good.sum())
        whole, ratio = len(self.plain.compress(text)) / (n + 32), good.sum() / (n + 32)
        size = np.log(n + 1)
        return [total, diff.min(), diff.max(), ratio, whole, size, total * size, ratio * size, total * total,
                min(ratio, 0.25), min(whole, 0.25), np.tanh(40 * total), np.tanh(40 * diff.min())]


def build(texts: list[bytes], size: int) -> bytes:
    """A dictionary of at most ``size`` bytes; with too few samples, their own bytes."""
    pieces = [t[i:i + PIECE] for t in texts for i in range(0, len(t), PIECE)]
    try:
        return zstandard.train_dictionary(size, pieces, level=LEVEL).as_bytes()
    except zstandard.ZstdError:
        return b"".join(texts)[-size:]


def fit(sample: list[tuple[str, int]], dictionary_bytes: int = 64 << 10) -> dict:
    """Every other text goes into a dictionary, the rest fit the curve.

    Without texts of both labels the score is the share of label 1, or 0.5.
    """
    by_label = {v: [t.encode() for t, y in sample if y == v] for v in (0, 1)}
    if min(map(len, by_label.values())) < 2:
        n = len(sample)
        return {"prior": (len(by_label[1]) + 1) / (n + 2)}
    good, bad = (build(by_label[v][::2], dictionary_bytes) for v in (1, 0))
    sizes = Sizes(good, bad)
    rest = [(t, v) for v in (0, 1) for t in by_label[v][1::2]]
    x = np.array([sizes.features(t) for t, _ in rest])
    y = np.array([v for _, v in rest], float)
    return {"good": good, "bad": bad, "curve": fitting.fit_logistic(x, y)}


def _score(model: dict):
    schema = arrow_schema("doc_id long,held_out boolean,score double,predicted int")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes = Sizes(model["good"], model["bad"]) if "curve" in model else None
        for batch in batches:
            if sizes is None:
                score = np.full(batch.num_rows, model["prior"])
            else:
                x = np.array([sizes.features(t.as_py()) for t in batch.column(2)]).reshape(batch.num_rows, -1)
                score = fitting.score_logistic(model["curve"], x)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(score), pa.array((score >= 0.5).astype(np.int32))], schema=schema)

    return run


def train(docs: DataFrame, labels: DataFrame, label_col: str = "quality", per_class: int = 1500, most_bytes: int = 24 << 20,
          modulus: int = 3, held_out: int = 1, **columns: str) -> dict:
    """The dictionaries and the curve, from at most ``per_class`` texts and ``most_bytes`` of each label."""
    return fit(fitting.labelled_sample(docs, labels, label_col, lambda i: crc_mod(i, modulus) != held_out, per_class, most_bytes, **columns))


def score(docs: DataFrame, model: dict, modulus: int = 3, held_out: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted per document; NULL and empty texts are scored as empty."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), (crc_mod(id_col, modulus) == held_out).alias("held_out"), text_of(text_col).cast("binary").alias("t"))
    return rows.mapInArrow(_score(model), "doc_id long, held_out boolean, score double, predicted int")
