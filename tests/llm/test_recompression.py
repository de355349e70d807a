import hashlib
import random
from collections import Counter, defaultdict

import numpy as np

from changemill.llm import recompression
from changemill.llm.common import WordHashes
from llm_cases import split


def expected(corpus, width=35):
    places = defaultdict(list)
    texts = [split(r[1]) for r in corpus]
    for d, w in enumerate(texts):
        for i in range(len(w) - width + 1):
            places[tuple(w[i:i + width])].append((d, i))
    gone = defaultdict(set)
    for at in places.values():
        if len(at) > 1:
            for d, i in at:
                gone[d].update(range(i, i + width))
    out = Counter()
    for d, (r, w) in enumerate(zip(corpus, texts)):
        kept = " ".join(x for i, x in enumerate(w) if i not in gone[d])
        out[(r[0], len(w), len(gone[d]), hashlib.sha256(kept.encode()).hexdigest())] += 1
    return out


def test_removed_words(docs, corpus):
    got = Counter(tuple(r) for r in recompression.drop_repeats(docs).collect())
    assert got == expected(corpus)


def test_many_edges(spark):
    """Passages of 34 to 40 words, cut and joined at random, over a small vocabulary."""
    rng = random.Random(2)
    pool = [[rng.choice("abcdefg") for _ in range(rng.choice([34, 35, 36, 40, 70]))] for _ in range(12)]
    rows = []
    for i in range(120):
        w = []
        for _ in range(rng.randrange(1, 6)):
            w += rng.choice(pool) if rng.random() < 0.5 else [rng.choice("abcdefg") for _ in range(rng.randrange(30))]
            w += [rng.choice("ab")] * rng.choice([0, 0, 1, 2, 3, 37])
        rows.append((i, " ".join(w)))
    got = Counter(tuple(r) for r in recompression.drop_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == expected(rows)


def test_every_window_has_an_anchor_that_its_words_decide():
    rng = random.Random(3)
    inner = [f"t{rng.randrange(5)}".encode() for _ in range(300)] + [b"z"] * 60 + [b"p", b"q"] * 40
    found = []
    for k in range(2):
        outer = [f"o{rng.randrange(9)}".encode() for _ in range(50)]
        words = WordHashes().of(outer + inner + outer)
        key, content, lo, hi = recompression.blocks(words, np.zeros(len(words), np.int64))
        assert (hi - lo + 1).sum() == len(words) - 34
        inside = (lo > 50) & (hi + 35 < 50 + len(inner))
        found.append(set(zip(key[inside].tolist(), content[inside].tolist(), (lo[inside]).tolist())))
    assert len(found[0] & found[1]) >= len(found[0]) - 4


def test_empty(no_docs):
    assert recompression.drop_repeats(no_docs).count() == 0
