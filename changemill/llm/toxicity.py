"""Toxicity: a lexicon learned from labels, matched by Levenshtein automata, weighed by context.

The lexicon holds whole terms and stems (beginnings with any ending), and beside a stem the
whole terms that begin with it. Its trie is intersected
with the Levenshtein automaton of distance one: a state is the set of trie places a word can
have reached with its edits so far, made deterministic as words meet it. Misspelled terms are
thus found by one walk along a word. The words around a hit tell abuse from quotation: a hit
between quotation marks or beside a word of reporting counts a part of one that isn't.
"""

from __future__ import annotations

import re
import sys
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changemill.llm import fitting
from changemill.llm.common import arrow_schema, crc_mod, text_of

cloudpickle.register_pickle_by_value(sys.modules[__name__])

TOKEN = re.compile(r"\w+")
QUOTES = frozenset("\"'«»“”„‟‘’‹›`")
REPORTS = frozenset(
    "said says say wrote writes written called calls quoted quotes quote term word slur "
    "dit écrit appelé mot terme sagte sagt schrieb nannte wort dijo dice escribió llamó palabra".split()
)
WINDOW = 4  # words looked at on each side
NO_EVIDENCE = 0.49  # highest score of a text without a hit, whatever the labels' shares
FUZZY_FROM = 4  # terms of so many characters may be misspelled
FUZZY_STEM_FROM = 5  # and stems of so many; shorter ones have their whole terms beside them


def may_err(term: str, is_stem: bool) -> bool:
    return len(term) >= (FUZZY_STEM_FROM if is_stem else FUZZY_FROM)


class Lexicon:
    """Terms and stems as a trie, walked through the Levenshtein automaton of distance one."""

    def __init__(self, terms: list[tuple[str, bool]]) -> None:
        self.terms = terms
        self.children: list[dict[str, int]] = [{}]
        self.whole: list[int | None] = [None]
        self.stem: list[int | None] = [None]
        self.fuzzy: list[bool] = [False]  # does a term that may be misspelled lie below
        for k, (term, is_stem) in enumerate(terms):
            node, loose = 0, may_err(term, is_stem)
            self.fuzzy[0] |= loose
            for c in term:
                if c not in self.children[node]:
                    self.children[node][c] = len(self.children)
                    self.children.append({})
                    self.whole.append(None)
                    self.stem.append(None)
                    self.fuzzy.append(False)
                node = self.children[node][c]
                self.fuzzy[node] |= loose
            (self.stem if is_stem else self.whole)[node] = k
        self.states: dict[frozenset, int] = {}
        self.sets: list[frozenset] = []
        self.stems: list[tuple[int | None, int | None]] = []  # the stem that ends there without and with an edit
        self.steps: list[dict[str, int]] = []
        self.start = self.state(self.closed({(0, 0)}))
        self.seen: dict[str, tuple[int, int] | None] = {}

    def closed(self, places: set) -> frozenset:
        """Adds places reached by leaving out a character of a term."""
        out = set(places)
        for node, e in places:
            if e == 0:
                out |= {(c, 1) for c in self.children[node].values() if self.fuzzy[c]}
        return frozenset(out)

    def state(self, places: frozenset) -> int:
        if places not in self.states:
            self.states[places] = len(self.sets)
            self.sets.append(places)
            self.steps.append({})
            ends = sorted((self.stem[node], e) for node, e in places if self.stem[node] is not None)
            self.stems.append((
                next((k for k, e in ends if e == 0), None),
                next((k for k, e in ends if e == 1 and may_err(*self.terms[k])), None)))
        return self.states[places]

    def step(self, s: int, c: str) -> int:
        """The next state, -1 if nothing can match any more."""
        out = set()
        for node, e in self.sets[s]:
            child = self.children[node].get(c)
            if child is not None and (e == 0 or self.fuzzy[child]):
                out.add((child, e))
            if e == 0:
                out |= {(x, 1) for x in self.children[node].values() if self.fuzzy[x]}
                if self.fuzzy[node]:
                    out.add((node, 1))
        to = self.state(self.closed(out)) if out else -1
        if len(self.steps[s]) < 4096:
            self.steps[s][c] = to
        return to

    def match(self, word: str) -> tuple[int, int] | None:
        """(term, edits) of the best match: exact, then stem, then misspelled, then misspelled stem."""
        s, found, erred = self.start, None, None
        for c in word:
            to = self.steps[s].get(c)
            s = self.step(s, c) if to is None else to
            if s < 0:
                return found or erred
            exact, loose = self.stems[s]
            if exact is not None:
                found = (exact, 0)
            if loose is not None:
                erred = (loose, 1)
        best = found
        for node, e in sorted(self.sets[s]):
            k = self.whole[node]
            if k is not None and (e == 0 or (may_err(*self.terms[k]) and best is None)):
                best = (k, e)
                if e == 0:
                    break
        return best or erred

    def lookup(self, word: str) -> tuple[int, int] | None:
        try:
            return self.seen[word]
        except KeyError:
            if len(self.seen) > 400_000:
                self.seen.clear()
            hit = self.seen[word] = self.match(word)
            return hit


def hits(lexicon: Lexicon, text: str) -> list[tuple[int, int, bool]]:
    """(term, edits, quoted) of every hit in the text."""
    low = text.lower()
    words = TOKEN.findall(low)
    found = [i for i, h in enumerate(map(lexicon.lookup, words)) if h is not None]
    if not found:
        return []
    spans, out = [m.span() for m in TOKEN.finditer(low)], []
    for i in found:
        a, b = max(0, i - WINDOW), min(len(words), i + WINDOW + 1)
        before, after = low[max(0, spans[a][0] - 2):spans[i][0]], low[spans[i][1]:spans[b - 1][1] + 2]
        quoted = bool(QUOTES & set(before) and QUOTES & set(after)) or bool(REPORTS & set(words[a:i]))
        out.append((*lexicon.lookup(words[i]), quoted))
    return out


def forms(word: str, shortest: int = 4, longest: int = 10) -> list[tuple[str, bool]]:
    """The word as a term, and its beginnings as stems."""
    return [(word, False)] + [(word[:n], True) for n in range(shortest, min(longest, len(word)) + 1)]


def learn_terms(toxic: list[str], clean: list[str]) -> list[tuple[str, bool]]:
    """Terms and stems that toxic texts have and clean ones don't; as many as there are.

    Greedy cover: the form found in most texts not yet covered comes next, of equal ones the
    whole term, then the longer. A stem must cover clearly more than each of the terms that
    begin with it. Words of one much-copied text cover nothing new and stay out.
    """
    words = [set(TOKEN.findall(t.lower())) for t in toxic]
    count = Counter(f for ws in words for f in {f for w in ws for f in forms(w)})
    least = max(2, len(toxic) // 200)
    few = {f: n for f, n in count.items() if n >= least}
    in_clean: Counter = Counter()
    for t in clean:
        in_clean.update({f for w in set(TOKEN.findall(t.lower())) for f in forms(w) if f in few})
    rate = (len(clean) + 1) / (len(toxic) + 1)
    # as common in clean texts as in toxic ones, it would be expected in four of them at least
    good = {f: n for f, n in few.items() if n * rate >= max(4.0, 30 * (in_clean[f] + 0.02 * rate))}
    have: dict[tuple[str, bool], set[int]] = {f: set() for f in good}
    for i, ws in enumerate(words):
        for f in {f for w in ws for f in forms(w)} & good.keys():
            have[f].add(i)
    left, chosen = set(range(len(toxic))), []
    gain = {f: len(s) for f, s in have.items()}
    while gain:
        top = max(gain.values())
        if top < least:
            break
        stale = [f for f, g in gain.items() if g == top]
        for f in stale:
            gain[f] = len(have[f] & left)
        if all(gain[f] < top for f in stale):
            gain = {f: g for f, g in gain.items() if g >= least}
            continue
        best = max((f for f in stale if gain[f] == top), key=lambda f: (not f[1], len(f[0]), f[0]))
        if best[1]:
            whole = [(len(have[f] & left), f) for f in gain if not f[1] and f[0].startswith(best[0])]
            best = max([w for w in whole if w[0] >= 0.8 * top], default=(top, best))[1]
        chosen.append(best)
        left -= have[best]
        gain.pop(best)
    # what occurs in many texts beside the chosen forms is a term too, and so are all terms of
    # a chosen stem: their misspellings can lie beyond the stem or make it too short
    stems, taken = tuple(f for f, is_stem in chosen if is_stem), set(chosen)
    for f, n in sorted(good.items(), key=lambda x: (-x[1], x[0])):
        if f not in taken and not f[1] and (n >= max(least, len(toxic) // 50) or f[0].startswith(stems)):
            chosen.append(f)
    return chosen


def features(found: list[tuple[int, int, bool]], weights: np.ndarray, quoted_weight: float, n_chars: int) -> list[float]:
    """The hits' weights: sum, largest, different terms, sum over length; quoted hits count in part."""
    total = best = 0.0
    kinds = set()
    for term, edits, quoted in found:
        w = weights[term, edits] * (quoted_weight if quoted else 1.0)
        total += w
        best = max(best, w)
        kinds.add(term)
    return [np.log1p(total), best, min(len(kinds), 4), np.log1p(1000 * total / (n_chars + 200))]


def fit(sample: list[tuple[str, int]], quoted_weight: float = 0.3) -> dict:
    """Lexicon, weights and curve, all from the whole sample.

    With fewer than two texts of a label, or where no term tells them apart, there is no curve:
    every text then has one score below one half, so that nothing is called toxic.
    """
    toxic, clean = ([t for t, y in sample if y == v] for v in (1, 0))
    terms = learn_terms(toxic, clean) if min(len(toxic), len(clean)) >= 2 else []
    if not terms:
        return {"prior": min((len(toxic) + 1) / (len(sample) + 2), NO_EVIDENCE) if sample else 0.0}
    lexicon = Lexicon(terms)
    found = [(hits(lexicon, t), len(t), y) for t, y in sample]
    n = np.full((len(terms) + 1, 2, 2), 0.25)
    # a whole term stands for its stem too, else a stem beside its terms would have no texts
    above = [[k for k, (stem, is_stem) in enumerate(terms) if is_stem and not whole_is_stem and term.startswith(stem)] for term, whole_is_stem in terms]
    for hs, _, y in found:
        for term, edits in {(t, e) for t, e, _ in hs} | {(k, 0) for t, e, _ in hs if e == 0 for k in above[t]}:
            n[term, edits, y] += 1
    odds = np.log(n[:, :, 1] / (len(toxic) + 0.5)) - np.log(n[:, :, 0] / (len(clean) + 0.5))
    weights = np.clip(odds, 0, 6)
    unseen = n[:, 1].sum(1) < 1
    weights[unseen, 1] = 0.6 * weights[unseen, 0]  # a misspelling never seen counts in part
    x = np.array([features(hs, weights, quoted_weight, size) for hs, size, _ in found])
    y = np.array([y for _, _, y in found], float)
    return {"terms": terms, "weights": weights, "quoted": quoted_weight, "curve": fitting.fit_logistic(x, y, ridge=0.1)}


def scores(model: dict, lexicon: Lexicon | None, texts: list[str]) -> np.ndarray:
    """Scores of texts; without a hit nothing speaks for toxicity, so such a text stays below one half."""
    if lexicon is None:
        return np.full(len(texts), model["prior"])
    found = [hits(lexicon, t) for t in texts]
    x = np.array([features(hs, model["weights"], model["quoted"], len(t)) for hs, t in zip(found, texts)]).reshape(len(texts), -1)
    out = fitting.score_logistic(model["curve"], x) if len(texts) else np.zeros(0)
    return np.where([bool(hs) for hs in found], out, np.minimum(out, NO_EVIDENCE))


def _lexicon(model: dict) -> Lexicon | None:
    return Lexicon(model["terms"]) if "curve" in model else None


def _score(model: dict, columns: str):
    schema = arrow_schema(columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = _lexicon(model)
        for batch in batches:
            score = scores(model, lexicon, batch.column(2).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(score), pa.array((score >= 0.5).astype(np.int32))], schema=schema)

    return run


def train(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", per_class: int = 2500, most_bytes: int = 16 << 20,
          modulus: int = 5, held_out: int = 0, **columns: str) -> dict:
    """Lexicon and curve from at most ``per_class`` texts and ``most_bytes`` of each label."""
    return fit(fitting.labelled_sample(docs, labels, label_col, lambda i: crc_mod(i, modulus) != held_out, per_class, most_bytes, **columns))


def score(docs: DataFrame, model: dict, modulus: int = 5, held_out: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted per document; NULL and empty texts are scored as empty."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), (crc_mod(id_col, modulus) == held_out).alias("held_out"), text_of(text_col).alias("t"))
    out = "doc_id long,held_out boolean,score double,predicted int"
    return rows.mapInArrow(_score(model, out), out)


def predicted_udf(model: dict):
    """A column function: 1 for a toxic text, else 0."""
    import pandas as pd

    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        lexicon = _lexicon(model)
        for part in parts:
            yield pd.Series((scores(model, lexicon, list(part)) >= 0.5).astype(np.int32))

    run.__annotations__ = {"parts": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(run, "int")


def drop_toxic(docs: DataFrame, model: dict, text_col: str = "text") -> DataFrame:
    """The documents that aren't scored as toxic, with all their columns.

    A document goes only if a term or a misspelling of one was found in it. NULL and empty texts
    stay, as does everything where the labels gave no curve (labels of one kind, none, or none that
    words tell apart). Repeated rows are judged alike; an empty table has no rows.
    """
    if "curve" not in model:
        return docs
    return docs.where(predicted_udf(model)(text_of(text_col)) == 0)
