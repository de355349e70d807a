"""Bounded labelled samples and a small calibrated classifier."""

from __future__ import annotations

import sys

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changemill.llm.common import text_of

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def labelled_sample(docs: DataFrame, labels: DataFrame, label_col: str, training, per_class: int, most_bytes: int,
                    id_col: str = "doc_id", text_col: str = "text") -> list[tuple[str, int]]:
    """At most ``per_class`` whole texts of each label, ``most_bytes`` in all, chosen by a hash of them.

    ``training(id column name)`` says which rows may be learned from. A text of any length can be
    chosen; one that doesn't fit into what is left of the bytes is passed over for the next. Repeated
    texts count once. A label is 0 or 1: rows with another or no label, without an identifier, or
    with both labels for one identifier are left out; equal rows count once. The number of texts
    says which share of hash values is needed: only lengths of that share, and then the chosen
    texts, are sent to the driver. Labels meet hashes and lengths; a text isn't shuffled unless chosen.
    """
    known = docs.select(F.col(id_col).alias("__doc"), text_of(text_col).alias("__t")).where(training("__doc")).withColumn("__h", F.xxhash64("__t"))
    of_id = labels.where(F.col(label_col).isin(0, 1)).groupBy(F.col("doc_id").alias("__id")).agg(F.min(label_col).alias("lo"), F.max(label_col).alias("hi"))
    of_id = of_id.where("lo = hi").select("__id", F.col("lo").alias("__y"))
    pairs = known.select("__doc", "__h", F.octet_length("__t").alias("__n")).join(of_id, F.col("__doc") == F.col("__id"))
    n = {r[0]: r[1] for r in pairs.groupBy("__y").agg(F.approx_count_distinct("__h")).collect()}
    out = []
    for value in (0, 1):
        share = pairs.where((F.col("__y") == value) & (F.pmod("__h", F.lit(max(1, n.get(value, 0) // per_class))) == 0))
        sizes = share.groupBy("__h").agg(F.min("__n"), F.min("__doc")).orderBy("__h").limit(per_class).collect() if value in n else []
        chosen, ids, left = [], [], most_bytes
        for h, size, doc in sizes:
            if size <= left:
                chosen.append(h)
                ids.append(doc)
                left -= size
        # one document stands for all copies of its text
        rows = known.where(F.col("__doc").isin(ids) & F.col("__h").isin(chosen)).dropDuplicates(["__h"]).select("__h", "__t").collect() if chosen else []
        out += [(t, value) for _, t in sorted((r[0], r[1]) for r in rows)]
    return out


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 30) -> dict:
    """Ridge logistic regression on standardised features; classes weigh as they occur."""
    mean, scale = x.mean(0), x.std(0)
    scale[scale == 0] = 1.0
    a = np.column_stack([(x - mean) / scale, np.ones(len(x))])
    w, penalty = np.zeros(a.shape[1]), np.full(a.shape[1], ridge)
    penalty[-1] = 1e-6
    w[-1] = np.log((y.sum() + 1) / (len(y) - y.sum() + 1))
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        h = (a * (p * (1 - p) + 1e-9)[:, None]).T @ a + np.diag(penalty)
        step = np.linalg.solve(h, a.T @ (p - y) + penalty * w)
        w -= np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-6:
            break
    return {"mean": mean, "scale": scale, "w": w}


def score_logistic(model: dict, x: np.ndarray) -> np.ndarray:
    z = ((x - model["mean"]) / model["scale"]) @ model["w"][:-1] + model["w"][-1]
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))
