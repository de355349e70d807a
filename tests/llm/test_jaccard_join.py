import random
from collections import Counter

import numpy as np
import pytest

from changemill.llm import jaccard_join
from llm_cases import lower, split


def shingles(text):
    w = split(lower(text))
    return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def expected(corpus):
    sets = [shingles(r[1]) for r in corpus]
    root = list(range(len(sets)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(sets)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 75 * len(sets[i] | sets[j]):
                root[top(i)] = top(j)
    least = {}
    for i, r in enumerate(corpus):
        if r[0] is not None:
            least[top(i)] = min(least.get(top(i), r[0]), r[0])
    return Counter((r[0], len(sets[i]), least.get(top(i)) if sets[i] else r[0]) for i, r in enumerate(corpus)), {top(i) for i in range(len(sets))}


def found(df):
    return Counter(tuple(r) for r in df.select("doc_id", "n_shingles", "component_id").collect())


def test_groups(docs, corpus):
    assert found(jaccard_join.near_groups(docs)) == expected(corpus)[0]


def cluster(seed, n=160):
    """Copies with few to many edits, at all sizes from one word up."""
    rng = random.Random(seed)
    rows = []
    for size in (1, 2, 5, 6, 7, 8, 9, 11, 12, 15, 19, 20, 27, 36, 60, 150, 260):
        base = [f"v{rng.randrange(50)}" for _ in range(size)]
        for _ in range(n // 16):
            w = list(base)
            for _ in range(rng.randrange(1 + size // 12 + 1)):
                at = rng.randrange(len(w))
                w[at:at + 1] = rng.choice([[], [f"e{rng.randrange(9)}"], [w[at], f"e{rng.randrange(9)}"]]) or w[at:at + 1]
            if rng.random() < 0.3:
                w += [f"e{rng.randrange(9)}" for _ in range(1 + size // 9)]
            rows.append((len(rows), " ".join(w)))
    return rows


@pytest.mark.parametrize("few", [24, 3])
def test_no_link_is_lost(spark, few, monkeypatch):
    monkeypatch.setattr(jaccard_join, "FEW", few)
    rows = cluster(few)
    assert found(jaccard_join.near_groups(spark.createDataFrame(rows, "doc_id long, text string"))) == expected(rows)[0]


def test_pigeonhole_meets_every_similar_pair():
    """Two sets that are similar enough share a signature that one of them probes, or are short."""
    rng = np.random.default_rng(1)
    for n in (*range(1, 40), 64, 100, 129, 250, 400):
        for _ in range(12):
            base = rng.integers(0, 1 << 62, n).astype(np.uint64)
            drop = rng.integers(0, n // 7 + 1)
            more = rng.integers(0, 1 << 62, rng.integers(0, n // 7 + 1)).astype(np.uint64)
            other = np.unique(np.concatenate([rng.permutation(base)[drop:], more]))
            base = np.unique(base)
            both = len(np.intersect1d(base, other))
            if not len(other) or 100 * both < 75 * len(np.union1d(base, other)):
                continue
            s = jaccard_join.Signatures([base, other])
            if len(s.short):
                continue
            probes = {(int(g), int(d)) for g, d, p in zip(s.sig, s.set, s.probe) if p}
            indexed = {(int(g), int(d)) for g, d, p in zip(s.sig, s.set, s.index) if p}
            assert any((g, 1 - d) in indexed for g, d in probes), (n, len(other))
            assert 7 * int(np.bitwise_count((jaccard_join.sketch(base) ^ jaccard_join.sketch(other)).view(np.uint64)).sum()) <= len(base) + len(other)


@pytest.mark.parametrize("larger, smaller, n", [(8, 6, 20_000), (16, 12, 5000), (20, 15, 2000)])
def test_subsets_at_the_bound_meet(larger, smaller, n):
    """A segment with one element isn't checked for two differences: the partner's may be empty."""
    rng = np.random.default_rng(2)
    sets = []
    for _ in range(n):
        base = rng.integers(0, 1 << 62, larger).astype(np.uint64)
        sets += [np.sort(base), np.sort(base[:smaller])]
    s = jaccard_join.Signatures(sets)
    indexed = {(g, d) for g, d, i in zip(s.sig.tolist(), s.set.tolist(), s.index.tolist()) if i}
    met = {d // 2 for g, d, p in zip(s.sig.tolist(), s.set.tolist(), s.probe.tolist()) if p and (g, d ^ 1) in indexed}
    assert len(s.short) < n // 1000
    assert met | {int(d) // 2 for d in s.short} == set(range(n))


def test_kept_documents(docs, corpus):
    kept = jaccard_join.drop_near(docs)
    assert kept.columns == docs.columns
    want, tops = expected(corpus)
    wordless = [r for r in corpus if not split(r[1])]
    assert kept.count() == len([t for t in tops if split(corpus[t][1])]) + len(wordless)


def test_empty(no_docs):
    assert jaccard_join.near_groups(no_docs).count() == 0
    assert jaccard_join.drop_near(no_docs).count() == 0
