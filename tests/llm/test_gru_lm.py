import math
import random
import zlib
from collections import Counter

import numpy as np

from changemill.llm import gru_lm
from llm_cases import lower, split


def base(corpus):
    training = [r for r in corpus if zlib.crc32(b"" if r[0] is None else str(r[0]).encode()) % 7 != 2]
    c = Counter(t for r in training for t in [*split(lower(r[1])), "\n"])
    n, v = sum(c.values()), len(c)
    out = []
    for r in corpus:
        tokens = [*split(lower(r[1])), "\n"]
        score = sum(math.log10((c[t] + 1) / (n + v + 1)) for t in tokens)
        out.append((r[0], len(tokens), sum(c[t] > 0 for t in tokens), n, score))
    return out


def test_counts_and_base(docs, corpus, monkeypatch):
    monkeypatch.setattr(gru_lm, "DICTIONARY", 150)  # most words must be joined
    monkeypatch.setattr(gru_lm, "OWN", 40)
    got = gru_lm.score(docs, *gru_lm.train(docs)).collect()
    want = base(corpus)
    key = lambda r: (str(r[0]), r[1], r[2], r[3], round(r[4], 6))
    assert sorted(key((r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"])) for r in got) == sorted(map(key, want))
    assert all(r["held_out"] == (zlib.crc32(b"" if r["doc_id"] is None else str(r["doc_id"]).encode()) % 7 == 2) for r in got)
    assert all(r["score"] < 0 for r in got)


def test_learns_order(spark):
    """Text whose words follow each other in a fixed order is far likelier than by counts."""
    rng = random.Random(1)
    rows = []
    for i in range(400):
        at = rng.randrange(12)
        rows.append((i, " ".join(f"w{(at + k) % 12}" for k in range(60))))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    held = [r for r in gru_lm.score(df, *gru_lm.train(df, rates=(0.03, 0.02, 0.01))).collect() if r["held_out"]]
    assert sum(r["score"] for r in held) > 0.5 * sum(r["base_score"] for r in held)


def small_model(rng):
    counts = np.sort(rng.integers(1, 500, 50))[::-1].astype(float)
    shape = gru_lm.layout(counts) | {"end": 3}
    w = gru_lm.new_weights(shape, counts, np.ones(gru_lm.SUFFIX))
    return {k: (v.astype(np.float64) + rng.normal(0, 0.3, v.shape)) for k, v in w.items()}, shape


def test_probabilities_sum_to_one():
    w, shape = small_model(np.random.default_rng(0))
    h = np.random.default_rng(1).normal(0, 1, (1, gru_lm.HIDDEN))
    every = np.arange(50 + gru_lm.SUFFIX)
    log, _, _ = gru_lm.outputs(w, shape, np.repeat(h, len(every), 0), every)
    assert abs(np.exp(log).sum() - 1) < 1e-9


def test_gradients():
    rng = np.random.default_rng(2)
    w, shape = small_model(rng)
    token = rng.integers(0, 50 + gru_lm.SUFFIX, (6, 3))
    fresh = np.zeros((6, 3), bool)
    fresh[0], fresh[3, 1] = True, True

    class Seen(gru_lm.Trainer):
        def update(self, grads, n):
            self.grads = grads

    def run(weights):
        t = Seen(weights, shape, 0.0)
        t.window(token, fresh, np.zeros((3, gru_lm.HIDDEN)), np.full(3, 3), 3)
        return t

    t = run(w)
    for name, g in t.grads.items():
        for _ in range(4):
            at = tuple(rng.integers(0, s) for s in g.shape)
            up, down = ({k: v.copy() for k, v in w.items()} for _ in range(2))
            up[name][at] += 1e-5
            down[name][at] -= 1e-5
            assert abs((run(up).loss - run(down).loss) / 2e-5 - g[at]) < 1e-4 * (1 + abs(g[at])), name


def test_lanes_carry_state_and_do_not_mix_documents(monkeypatch):
    rng = np.random.default_rng(3)
    w, shape = small_model(rng)
    docs = [np.append(rng.choice([s for s in range(114) if s != 3], rng.integers(0, 150)), 3) for _ in range(40)]
    alone = [gru_lm.score_lanes(w, shape, [d], 3)[0] for d in docs]
    monkeypatch.setattr(gru_lm, "SCORE_LANES", 5)
    assert np.allclose(gru_lm.score_lanes(w, shape, docs, 3), alone, atol=1e-3)


def test_empty(no_docs):
    assert gru_lm.score(no_docs, *gru_lm.train(no_docs)).count() == 0
