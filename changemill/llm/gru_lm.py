"""A gated recurrent language model over words, trained and applied in Spark tasks.

Corpus counts come first: every token of every training document is counted. The most
frequent words have symbols of their own; all others share suffix symbols, inside which a
word has its smoothed share of the counts. The network is a GRU whose output softmax is
factored: first the class, then the frequent word or the suffix symbol in its class.

Training runs in rounds over all training documents. In a round every task starts from the
common weights and trains on its documents by truncated backpropagation, state carried from
window to window; the tasks' weights are averaged in Spark, by tokens seen. Scoring runs whole
documents side by side in lanes, state carried across windows, so a document's score is the
log-likelihood of all its tokens. Counts of words outside the tasks' dictionary are joined.
"""

from __future__ import annotations

import sys
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changemill.llm.common import arrow_schema, crc_mod, release, settled, text_of

cloudpickle.register_pickle_by_value(sys.modules[__name__])

END = b"\n"            # the end token; no word holds white space
HIDDEN = 16
OWN = 1024             # frequent words with symbols of their own
SUFFIX = 64            # symbols of the others, by the hash of their endings
GROUP = 16             # of them in a class
WORD_CLASSES = 16      # classes of the frequent words
DICTIONARY = 200_000   # words whose counts every task knows; the counts of others are joined
WORD_BYTES = 64        # longest word of the dictionary, so that its size is bounded
STEPS = 16             # tokens of a training window in each lane
LANES, SCORE_LANES = 384, 256
BLOCK = 2048           # rows whose class probabilities are computed together
SCORE_STEPS, STRETCH = 96, 960  # steps whose outputs are computed together, and whose lanes are laid out
BUFFER = 600_000       # tokens a training task gathers before it splits them into lanes
SLICE = 8192           # weights in a row when they are averaged


def suffix_class(word: bytes) -> int:
    return zlib.crc32(word[-3:]) % SUFFIX


class Vocabulary(dict):
    """Word → code. Codes count the dictionary's words; a word outside gets -1 - its suffix class."""

    def __init__(self, words: list[bytes]) -> None:
        super().__init__(zip(words, range(len(words))))

    def __missing__(self, word: bytes) -> int:
        return -1 - suffix_class(word)


def layout(counts: np.ndarray) -> dict:
    """Classes of the symbols. Those of the frequent words are runs of equal mass in the square roots of
    their counts; GROUP suffix symbols each make one more."""
    n = len(counts)
    mass = np.cumsum(np.sqrt(counts + 1.0))
    k = np.minimum((mass / mass[-1] * WORD_CLASSES * 0.9999).astype(np.int64), WORD_CLASSES - 1) if n else np.zeros(0, np.int64)
    k = np.unique(k, return_inverse=True)[1].astype(np.int64)
    of_words = int(k.max()) + 1 if n else 0
    starts = np.concatenate([np.searchsorted(k, np.arange(of_words)), n + np.arange(0, SUFFIX + 1, GROUP)])
    class_of = np.concatenate([k, of_words + np.arange(SUFFIX) // GROUP]).astype(np.int16)
    return {"class_of": class_of, "starts": starts, "n_own": n, "n_classes": of_words + SUFFIX // GROUP}


def new_weights(shape: dict, counts: np.ndarray, suffix_mass: np.ndarray, seed: int = 7) -> dict[str, np.ndarray]:
    """Small random weights; biases start at the unigram distribution."""
    rng, n, c = np.random.default_rng(seed), shape["n_own"], shape["n_classes"]
    symbols, mass = n + SUFFIX, np.concatenate([counts + 1.0, suffix_mass + 1.0])
    class_mass = np.bincount(shape["class_of"], mass, minlength=c)
    w = {
        "x": rng.normal(0, 0.1, (symbols, 3 * HIDDEN)), "h": rng.normal(0, 0.2, (HIDDEN, 3 * HIDDEN)), "b": np.zeros(3 * HIDDEN),
        "c": rng.normal(0, 0.05, (HIDDEN, c)), "cb": np.log(class_mass / class_mass.sum()),
        "w": rng.normal(0, 0.05, (symbols, HIDDEN)), "wb": np.log(mass),
    }
    return {k: v.astype(np.float32) for k, v in w.items()}


def recurrent(w: dict) -> tuple[np.ndarray, np.ndarray]:
    """Input and recurrent weights with the signs and factors of the gates' exponentials."""
    sign = np.full(3 * HIDDEN, -1, w["x"].dtype)
    sign[2 * HIDDEN:] = -2
    return (w["x"] + w["b"]) * sign, w["h"] * sign


class Room(dict):
    """Arrays that are used again: fresh ones of this size cost more than what is done in them."""

    def __call__(self, name: str, shape: tuple, dtype) -> np.ndarray:
        size = int(np.prod(shape))
        held = self.get(name)
        if held is None or held.size < size or held.dtype != dtype:
            held = self[name] = np.empty(size, dtype)
        return held[:size].reshape(shape)


def gates(x: np.ndarray, wh: np.ndarray, h: np.ndarray, u: np.ndarray, rz: np.ndarray, n: np.ndarray, new: np.ndarray) -> None:
    """Into ``rz`` the gates, into ``n`` and ``new`` the candidate and the new state, into ``u`` the
    recurrent sums; ``x``: rows of ``recurrent``'s first."""
    np.matmul(h, wh, u)
    np.add(x[:, :2 * HIDDEN], u[:, :2 * HIDDEN], rz)
    np.exp(rz, rz)
    np.add(rz, 1, rz)
    np.reciprocal(rz, rz)
    np.multiply(rz[:, :HIDDEN], u[:, 2 * HIDDEN:], n)
    np.add(n, x[:, 2 * HIDDEN:], n)
    np.exp(n, n)
    np.add(n, 1, n)
    np.reciprocal(n, n)
    np.multiply(n, 2, n)
    np.subtract(n, 1, n)  # tanh
    np.subtract(h, n, new)
    np.multiply(new, rz[:, HIDDEN:], new)
    np.add(new, n, new)


def softmax(h: np.ndarray, w: np.ndarray, b: np.ndarray, rows: np.ndarray, target: np.ndarray, e: np.ndarray, deep: bool) -> tuple[np.ndarray, np.ndarray]:
    """Logs of the targets' probabilities and the sums of the exponentials, which go into ``e``.

    States lie between -1 and 1: only where weights are ``deep`` enough for an exponential to
    overflow the largest logit is taken off first."""
    np.matmul(h, w, e)
    e += b
    if deep:
        e -= e.max(1, keepdims=True)
    picked = e[rows, target]
    np.exp(e, e)
    total = e @ np.ones(e.shape[1], e.dtype)
    return picked - np.log(total), total


def outputs(w: dict, shape: dict, h: np.ndarray, target: np.ndarray, learn: bool = False, room: Room | None = None):
    """Natural logs of the targets' probabilities; with ``learn`` gradients as well.

    Of a word outside the frequent ones its suffix symbol is predicted here.
    """
    room = Room() if room is None else room
    k = shape["class_of"][target]
    order = np.argsort(k, kind="stable")  # rows of a class side by side
    k, h, target = k[order], h.take(order, 0, room("h", h.shape, h.dtype), mode="clip"), target[order]
    rows, n = np.arange(len(target)), len(target)
    deep = any(float((np.abs(w[a]).sum(axis) + np.abs(w[b])).max(initial=0)) > 60 for a, b, axis in (("c", "cb", 0), ("w", "wb", 1)))
    out = np.empty(n, h.dtype)
    grads, dh = {}, None
    if learn:
        grads = {"c": np.zeros_like(w["c"]), "cb": np.zeros_like(w["cb"]), "w": np.zeros_like(w["w"]), "wb": np.zeros_like(w["wb"])}
        dh, back = room("dh", h.shape, h.dtype), w["c"].T.copy()
    for lo in range(0, n, BLOCK):
        at = slice(lo, min(lo + BLOCK, n))
        m = at.stop - lo
        e = room("e", (m, w["c"].shape[1]), h.dtype)
        out[at], total = softmax(h[at], w["c"], w["cb"], rows[:m], k[at], e, deep)
        if learn:
            e *= (1 / total)[:, None]
            e[rows[:m], k[at]] -= 1
            grads["c"] += h[at].T @ e
            grads["cb"] += e.sum(0)
            np.matmul(e, back, dh[at])
    bounds = np.searchsorted(k, np.arange(shape["n_classes"] + 1)).tolist()
    words = w["w"].T.copy()
    for c in range(shape["n_classes"]):
        at, m = slice(bounds[c], bounds[c + 1]), bounds[c + 1] - bounds[c]
        lo, hi = shape["starts"][c], shape["starts"][c + 1]
        if not m or hi - lo == 1:
            continue
        e, t = room("e", (m, hi - lo), h.dtype), target[at] - lo
        log, total = softmax(h[at], words[:, lo:hi], w["wb"][lo:hi], rows[:m], t, e, deep)
        out[at] += log
        if learn:
            e *= (1 / total)[:, None]
            e[rows[:m], t] -= 1
            grads["w"][lo:hi] = e.T @ h[at]
            grads["wb"][lo:hi] = e.sum(0)
            dh[at] += e @ w["w"][lo:hi]
    back = np.empty_like(order)
    back[order] = rows
    return out[back], grads, dh.take(back, 0) if learn else None


class Trainer:
    """Truncated backpropagation with Adam on lanes of tokens."""

    def __init__(self, weights: dict, shape: dict, rate: float) -> None:
        self.w, self.shape, self.rate = {k: v.copy() for k, v in weights.items()}, shape, rate
        self.m = {k: np.zeros_like(v) for k, v in weights.items()}
        self.v = {k: np.zeros_like(v) for k, v in weights.items()}
        self.steps, self.tokens, self.loss = 0, 0, 0.0
        self.room = Room()

    def learn(self, stream: np.ndarray, begins: np.ndarray) -> None:
        """``stream``: symbols of documents in a row; ``begins``: True where a document begins."""
        lanes = int(min(LANES, max(1, len(stream) // (4 * STEPS))))
        length = len(stream) // lanes
        if not length:
            return
        token = stream[:lanes * length].reshape(lanes, length).T
        fresh = begins[:lanes * length].reshape(lanes, length).T
        end = self.shape["end"]
        h, last = np.zeros((lanes, HIDDEN), np.float32), np.full(lanes, end)
        for lo in range(0, length, STEPS):
            h, last = self.window(token[lo:lo + STEPS], fresh[lo:lo + STEPS], h, last, end)
        self.tokens += lanes * length

    def window(self, token, fresh, h, last, end):
        w, steps = self.w, len(token)
        wx, wh = recurrent(w)
        lanes, kind, room = len(last), h.dtype, self.room
        before = np.where(fresh, end, np.concatenate([last[None], token[:-1]]))
        x = wx.take(before.ravel(), 0, room("x", (token.size, 3 * HIDDEN), kind), mode="clip").reshape(steps, lanes, -1)
        keep = (~fresh).astype(kind)[:, :, None]
        u, rz = room("u", (steps, lanes, 3 * HIDDEN), kind), room("rz", (steps, lanes, 2 * HIDDEN), kind)
        n, h0, hs = (room(name, (steps, lanes, HIDDEN), kind) for name in ("n", "h0", "hs"))
        for t in range(steps):
            np.multiply(h, keep[t], h0[t])
            gates(x[t], wh, h0[t], u[t], rz[t], n[t], hs[t])
            h = hs[t]
        h = h.copy()  # the room is used again
        log, grads, dout = outputs(w, self.shape, hs.reshape(-1, HIDDEN), token.reshape(-1), True, room)
        self.loss -= float(log.sum())
        dout = dout.reshape(steps, -1, HIDDEN)
        r, z, un = rz[:, :, :HIDDEN], rz[:, :, HIDDEN:], u[:, :, 2 * HIDDEN:]
        # what each step's error is multiplied with
        to_n = (1 - z) * (1 - n * n)
        to_z = (h0 - n) * z * (1 - z)
        to_r = un * r * (r - 1) * kind.type(0.5)  # un holds -2 times the sum
        dx, du = room("dx", (steps, lanes, 3 * HIDDEN), kind), room("du", (steps, lanes, 3 * HIDDEN), kind)
        back, dh = w["h"].T.copy(), np.zeros_like(h)
        for t in range(steps - 1, -1, -1):
            dh += dout[t]
            dn = dx[t, :, 2 * HIDDEN:]
            np.multiply(dh, to_n[t], dn)
            np.multiply(dn, to_r[t], dx[t, :, :HIDDEN])
            np.multiply(dh, to_z[t], dx[t, :, HIDDEN:2 * HIDDEN])
            du[t, :, :2 * HIDDEN] = dx[t, :, :2 * HIDDEN]
            np.multiply(dn, r[t], du[t, :, 2 * HIDDEN:])
            dh *= z[t]
            dh += du[t] @ back
            dh *= keep[t]
        grads["h"] = h0.reshape(-1, HIDDEN).T @ du.reshape(-1, 3 * HIDDEN)
        dx = dx.reshape(-1, 3 * HIDDEN)
        grads["b"] = dx.sum(0)
        where = before.ravel().astype(np.int16)  # numpy sorts 16 bits by radix
        order = np.argsort(where, kind="stable")
        at = np.flatnonzero(np.concatenate([[True], where[order][1:] != where[order][:-1]]))
        grads["x"] = np.zeros_like(w["x"])
        grads["x"][where[order][at]] = np.add.reduceat(dx.take(order, 0, room("du", dx.shape, kind), mode="clip"), at)
        self.update(grads, token.size)
        return h, token[-1]

    def update(self, grads: dict, n: int) -> None:
        self.steps += 1
        norm = np.sqrt(sum(float((g * g).sum()) for g in grads.values())) / n
        scale = np.float32(min(1.0, 0.5 / (norm + 1e-9)) / n * 100)
        fix = np.sqrt(1 - 0.99 ** self.steps) / (1 - 0.9 ** self.steps)
        for k, g in grads.items():
            g = g * scale
            self.m[k] += 0.1 * (g - self.m[k])
            self.v[k] += 0.01 * (g * g - self.v[k])
            self.w[k] -= np.float32(self.rate * fix) * self.m[k] / (np.sqrt(self.v[k]) + 1e-6)


def score_lanes(w: dict, shape: dict, docs: list[np.ndarray], end: int) -> np.ndarray:
    """Natural log-likelihoods of whole documents, given as symbols with the end symbol last."""
    total = np.zeros(len(docs))
    sizes = np.array([len(d) for d in docs])
    lanes: list[list[int]] = [[] for _ in range(min(SCORE_LANES, len(docs)))]
    load = np.zeros(len(lanes), np.int64)
    import heapq
    heap = [(0, k) for k in range(len(lanes))]
    for i in np.argsort(-sizes, kind="stable"):
        used, k = heapq.heappop(heap)
        lanes[k].append(int(i))
        load[k] = used + sizes[i]
        heapq.heappush(heap, (int(load[k]), k))
    lanes = [lanes[k] for k in np.argsort(-load, kind="stable")]  # the longest first: running lanes are a prefix
    load = -np.sort(-load)
    wx, wh = recurrent(w)
    kind, room = wx.dtype, Room()
    h = np.zeros((len(lanes), HIDDEN), kind)
    last = np.full(len(lanes), end, np.int16)
    # the lanes side by side, a stretch of steps at a time, so that one long document is no large table
    stream = [np.concatenate([docs[i] for i in lane]) for lane in lanes]
    owner = [np.repeat(np.array(lane, np.int32), sizes[lane]) for lane in lanes]
    for begin in range(0, int(load[0]) if len(load) else 0, STRETCH):
        held = int((load > begin).sum())
        steps = int(min(STRETCH, load[0] - begin))
        token, who = np.full((held, steps), end, np.int16), np.zeros((held, steps), np.int32)
        for k in range(held):
            part = stream[k][begin:begin + steps]
            token[k, :len(part)], who[k, :len(part)] = part, owner[k][begin:begin + steps]
        token, who = np.ascontiguousarray(token.T), np.ascontiguousarray(who.T)
        for lo in range(0, steps, SCORE_STEPS):
            n = int((load > begin + lo).sum())
            now = token[lo:lo + SCORE_STEPS, :n]
            before = np.concatenate([last[None, :n], now[:-1]])
            keep = (before != end).astype(kind)[:, :, None]  # the end token closes a document
            hs = room("hs", (*now.shape, HIDDEN), kind)
            x, u, rz, c, h0 = (room(name, (n, m * HIDDEN), kind) for name, m in (("x", 3), ("u", 3), ("rz", 2), ("n", 1), ("h0", 1)))
            state = h[:n]
            for t in range(len(now)):
                wx.take(before[t], 0, x, mode="clip")
                gates(x, wh, np.multiply(state, keep[t], h0), u, rz, c, hs[t])
                state = hs[t]
            h[:n], last[:n] = state, now[-1]
            inside = load[:n] > np.arange(begin + lo, begin + lo + len(now))[:, None]
            if inside.all():
                log, _, _ = outputs(w, shape, hs.reshape(-1, HIDDEN), now.ravel(), room=room)
                total += np.bincount(who[lo:lo + SCORE_STEPS, :n].ravel(), log, minlength=len(docs))
            else:
                log, _, _ = outputs(w, shape, hs[inside], now[inside], room=room)
                total += np.bincount(who[lo:lo + SCORE_STEPS, :n][inside], log, minlength=len(docs))
    return total


def symbols(codes: np.ndarray, tail: np.ndarray, n_own: int) -> np.ndarray:
    """Codes → symbols: frequent words, then suffix classes (``tail``: class of each dictionary word)."""
    inside = codes >= 0
    known = np.where(inside, codes, 0)
    return np.where(inside & (codes < n_own), codes, n_own + np.where(inside, tail[known], -1 - codes))


# ---- counts

def _count(most: int = 400_000):
    schema = arrow_schema("token binary,n long")

    def out(c: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(c), pa.binary()), pa.array(list(c.values()), pa.int64())], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c: Counter = Counter()
        for batch in batches:
            for text in batch.column(0):
                c.update(text.as_py().lower().split())
                c[END] += 1
                if len(c) > most:
                    yield out(c)
                    c = Counter()
        if c:
            yield out(c)

    return run


def _suffixes():
    schema = arrow_schema("k int,n long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k = np.array([suffix_class(t) for t in batch.column(0).to_pylist()], np.int64)
            n = np.bincount(k, batch.column(1).to_numpy(), minlength=SUFFIX) if len(k) else np.zeros(SUFFIX)
            each = np.bincount(k, minlength=SUFFIX)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([np.arange(SUFFIX), SUFFIX + np.arange(SUFFIX)]).astype(np.int32)),
                                              pa.array(np.concatenate([n, each]).astype(np.int64))], schema=schema)

    return run


# ---- training

def _train(common, rate: float):
    schema = arrow_schema("slice int,salt int,tokens long,weights binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = common.value
        shape, tail = state["shape"], state["tail"]
        vocab = Vocabulary(state["words"])
        trainer = Trainer(state["weights"], shape, rate)
        parts, size = [], 0
        salt = 0

        def learn() -> None:
            stream = np.concatenate(parts)
            begins = np.concatenate([[True], stream[:-1] == shape["end"]])
            trainer.learn(stream, begins)

        for batch in batches:
            for text in batch.column(0):
                words = text.as_py()
                salt = zlib.crc32(words, salt)
                words = words.lower().split()
                words.append(END)
                codes = np.fromiter(map(vocab.__getitem__, words), np.int64, len(words))
                parts.append(symbols(codes, tail, shape["n_own"]))
                size += len(words)
                if size >= BUFFER:
                    learn()
                    parts, size = [], 0
        if size:
            learn()
        if trainer.tokens:
            flat = np.concatenate([trainer.w[k].ravel() for k in sorted(trainer.w)]) * np.float32(1)
            rows = [(i, salt % 32, trainer.tokens, (flat[lo:lo + SLICE].astype(np.float64) * trainer.tokens).tobytes()) for i, lo in enumerate(range(0, len(flat), SLICE))]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    return run


def _add():
    """Sums of weighted slices, streamed: a task holds one sum for each of its slices."""
    schema = arrow_schema("slice int,salt int,tokens long,weights binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[int, int], list] = {}
        for batch in batches:
            for i, salt, n, weights in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                one = sums.setdefault((i, salt), [0, 0.0])
                one[0] += n
                one[1] = one[1] + np.frombuffer(weights)
        if sums:
            rows = [(i, salt, n, x.tobytes()) for (i, salt), (n, x) in sums.items()]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    return run


_ROWS = "slice int, salt int, tokens long, weights binary"


def train_round(texts: DataFrame, state: dict, rate: float) -> dict[str, np.ndarray]:
    """The average, by tokens, of the weights that all tasks end with."""
    spark = texts.sparkSession
    common = spark.sparkContext.broadcast(state)  # bounded by OWN, DICTIONARY and HIDDEN
    parts = texts.mapInArrow(_train(common, rate), _ROWS)
    some = parts.repartition("slice", "salt").mapInArrow(_add(), _ROWS).withColumn("salt", F.lit(0))
    rows = some.repartition("slice").mapInArrow(_add(), _ROWS).collect()  # one row per slice: the model's size
    common.unpersist()
    if not rows:
        return state["weights"]
    flat = np.concatenate([np.frombuffer(r["weights"]) / r["tokens"] for r in sorted(rows, key=lambda r: r["slice"])])
    out, at = {}, 0
    for k in sorted(state["weights"]):
        old = state["weights"][k]
        out[k] = flat[at:at + old.size].reshape(old.shape).astype(np.float32)
        at += old.size
    return out


def train(docs: DataFrame, modulus: int = 7, held_out: int = 2, rates: tuple = (0.02, 0.01, 0.005), parts: tuple = (1, 6, 25),
          id_col: str = "doc_id", text_col: str = "text") -> tuple[dict, DataFrame]:
    """(model, counts). Every training document is counted and trained on once; round k takes
    ``parts[k]`` of every sum(parts) documents, so early averages come soon.

    Without training documents the model knows the end token only.
    """
    known = docs.select(F.col(id_col).alias("i"), text_of(text_col).cast("binary").alias("t")).where(crc_mod("i", modulus) != held_out)
    counts = settled(known.select("t").mapInArrow(_count(), "token binary, n long").groupBy("token").agg(F.sum("n").alias("c")), "counts")
    release(docs.sparkSession)
    total = counts.agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v")).first()
    # the most frequent words, by steps of their count's logarithm: at most DICTIONARY of them
    step = F.floor(F.log2("c") * 64).cast("int")
    short = F.octet_length("token") <= WORD_BYTES
    steps, least, n_top = counts.where(short).groupBy(step.alias("s")).count().orderBy(F.desc("s")).collect(), 1 << 30, 0
    for r in steps:  # at most 64 rows for each power of two
        if n_top + r["count"] > DICTIONARY:
            break
        least, n_top = r["s"], n_top + r["count"]
    top = sorted(counts.where(short & (step >= least)).collect(), key=lambda r: (-r["c"], bytes(r["token"])))
    words, c = [bytes(r["token"]) for r in top], np.array([r["c"] for r in top], np.float64)
    if END not in words:  # it has a symbol of its own, however rare it is
        ends = counts.where(F.col("token") == F.lit(END)).first()
        words, c = [*words, END], np.append(c, ends["c"] if ends else 0.0)
    at = words.index(END)
    words.insert(0, words.pop(at))
    c = np.concatenate([c[at:at + 1], np.delete(c, at)])
    n_own = min(OWN, len(words))
    # classes are runs of the order by count; the end token finds its place in it
    order = np.argsort(-c[:n_own], kind="stable")
    words[:n_own], c[:n_own] = [words[i] for i in order], c[:n_own][order]
    per = {r["k"]: r["n"] for r in counts.mapInArrow(_suffixes(), "k int, n long").groupBy("k").agg(F.sum("n").alias("n")).collect()}
    own = np.array([suffix_class(w) for w in words[:n_own]])
    n_k = np.array([per.get(k, 0) for k in range(SUFFIX)], float) - np.bincount(own, c[:n_own], minlength=SUFFIX)
    v_k = np.array([per.get(SUFFIX + k, 0) for k in range(SUFFIX)], float) - np.bincount(own[c[:n_own] > 0], minlength=SUFFIX)
    shape = layout(c[:n_own]) | {"end": words.index(END)}
    state = {"words": words, "shape": shape, "tail": np.array([suffix_class(w) for w in words]), "weights": new_weights(shape, c[:n_own], n_k)}
    slice_ = F.pmod(F.xxhash64("t", "i"), F.lit(sum(parts)))
    low = 0
    for rate, share in zip(rates, parts, strict=True):
        state["weights"] = train_round(known.where((slice_ >= low) & (slice_ < low + share)).select("t"), state, rate)
        low += share
    model = state | {"counts": c, "suffix_mass": np.log10(n_k + v_k + 1), "n": int(total["n"] or 0), "v": int(total["v"])}
    return model, counts


# ---- scoring

_SCORED = "row long,doc_id long,held_out boolean,n_tokens long,n_known long,base double,score double,token binary,n long"


def _score(common):
    schema = arrow_schema(_SCORED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = common.value
        vocab, shape, n_own = Vocabulary(m["words"]), m["shape"], m["shape"]["n_own"]
        log_c = np.log10(m["counts"] + 1)
        floor = np.log10(m["n"] + m["v"] + 1)
        docs, facts, rare = [], [], []

        def flush() -> Iterator[pa.RecordBatch]:
            if facts:
                log = score_lanes(m["weights"], shape, docs, shape["end"]) / np.log(10)
                row, i, held, n, known, base, rest = zip(*facts)
                k = len(facts)
                yield pa.RecordBatch.from_arrays([
                    pa.array(row, pa.int64()), pa.array(i, pa.int64()), pa.array(held, pa.bool_()), pa.array(n, pa.int64()), pa.array(known, pa.int64()),
                    pa.array(base), pa.array(log + np.array(rest)), pa.nulls(k, pa.binary()), pa.nulls(k, pa.int64())], schema=schema)
            for lo in range(0, len(rare), 100_000):
                row, token, n = zip(*rare[lo:lo + 100_000])
                k = len(row)
                yield pa.RecordBatch.from_arrays([pa.array(row, pa.int64()), *[pa.nulls(k, f.type) for f in list(schema)[1:7]], pa.array(token, pa.binary()), pa.array(n, pa.int64())], schema=schema)

        size = 0
        for batch in batches:
            for row, i, held, text in zip(*(batch.column(k).to_pylist() for k in range(3)), batch.column(3), strict=True):
                words = text.as_py().lower().split()
                words.append(END)
                codes = np.fromiter(map(vocab.__getitem__, words), np.int64, len(words))
                s = symbols(codes, m["tail"], n_own)
                inside = codes[codes >= 0]
                logs = log_c[inside]
                in_class = float(logs[inside >= n_own].sum() - m["suffix_mass"][s[s >= n_own] - n_own].sum())
                facts.append((row, i, held, len(words), int((logs > 0).sum()), float(logs.sum() - len(words) * floor), in_class))
                docs.append(s)
                if len(inside) < len(words):
                    rare += [(row, w, k) for w, k in Counter([words[j] for j in np.flatnonzero(codes < 0)]).items()]
                size += len(words)
                if size >= 3_000_000 or len(rare) > 500_000:
                    yield from flush()
                    docs, facts, rare, size = [], [], [], 0
        yield from flush()

    return run


def score(docs: DataFrame, model: dict, counts: DataFrame, modulus: int = 7, held_out: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score per document.

    A NULL or empty text is one end token. Rows that repeat are scored each.
    """
    spark = docs.sparkSession
    common = spark.sparkContext.broadcast(model)  # bounded by DICTIONARY, OWN and HIDDEN
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("doc_id"),
                       (crc_mod(id_col, modulus) == held_out).alias("held_out"), text_of(text_col).cast("binary").alias("t"))
    # written once, so a document and its rare words keep one row number
    done = settled(rows.mapInArrow(_score(common), _SCORED), "scored")
    rare = done.where("token IS NOT NULL").select("row", "token", "n")
    found = rare.join(counts.withColumnRenamed("token", "t"), F.col("token") == F.col("t"))
    more = found.groupBy("row").agg(F.sum("n").alias("known"), F.sum(F.col("n") * F.log10(F.col("c") + 1.0)).alias("logs")).withColumnRenamed("row", "r")
    facts = done.where("token IS NULL").join(more, F.col("row") == F.col("r"), "left")
    logs = F.coalesce("logs", F.lit(0.0))
    return facts.select("doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("known", F.lit(0))).alias("n_known"),
                        F.lit(model["n"]).cast("long").alias("train_tokens"), (F.col("base") + logs).alias("base_score"), (F.col("score") + logs).alias("score"))
