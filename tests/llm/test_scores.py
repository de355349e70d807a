"""Quality, toxicity and repetition: held-out accuracy, defined results, brute force."""

import random
import zlib
from collections import Counter

import pytest

from changemill.llm import quality_zstd, repetition, toxicity
from llm_cases import split

TERMS = ["grumbol", "snarvik", "plodder"]


@pytest.fixture(scope="module")
def labelled(spark):
    rng = random.Random(9)
    docs, labels = [], []
    for i in range(900):
        w = [rng.choice(["alpha", "beta", "gamma", "delta", "omega", "sigma"]) + str(rng.randrange(40)) for _ in range(rng.randrange(20, 200))]
        toxic, good = int(rng.random() < 0.3), int(rng.random() < 0.6)
        if toxic:
            for _ in range(3):
                w.insert(rng.randrange(len(w)), rng.choice([*TERMS, "vexil" + rng.choice(["a", "on", "um", "ierte", "ix", "orra"])]))
        text = " ".join(w) if good else " ".join(x + rng.choice(["***", "%%%", "!!"]) for x in w)
        docs.append((i, text))
        labels.append((i, good, toxic))
    return (spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))


def accuracy(scored, labels, label):
    rows = scored.join(labels, "doc_id").where("held_out").collect()
    assert rows
    return sum(r["predicted"] == r[label] for r in rows) / len(rows)


def held(i, modulus, rest):
    return zlib.crc32(b"" if i is None else str(i).encode()) % modulus == rest


def test_quality(labelled, docs, corpus, no_docs):
    model = quality_zstd.train(*labelled)
    assert accuracy(quality_zstd.score(labelled[0], model), labelled[1], "quality") > 0.95
    rows = quality_zstd.score(docs, model).collect()
    assert Counter((r["doc_id"], r["held_out"]) for r in rows) == Counter((r[0], held(r[0], 3, 1)) for r in corpus)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in rows)
    assert quality_zstd.score(no_docs, quality_zstd.train(no_docs, labelled[1])).count() == 0


def test_toxicity(labelled, docs, corpus, no_docs, spark):
    model = toxicity.train(*labelled)
    assert accuracy(toxicity.score(labelled[0], model), labelled[1], "toxic") > 0.97
    assert {(t, False) for t in TERMS} | {("vexil", True)} <= set(model["terms"])
    rows = toxicity.score(docs, model).collect()
    assert Counter((r["doc_id"], r["held_out"]) for r in rows) == Counter((r[0], held(r[0], 5, 0)) for r in corpus)
    assert not any(r["predicted"] for r in rows)
    assert toxicity.score(no_docs, toxicity.train(no_docs, labelled[1])).count() == 0
    odd = spark.createDataFrame([(1, "you grumbl snarwik plodder"), (2, "alpha1 beta2")], "doc_id long, text string")
    assert [r["predicted"] for r in toxicity.score(odd, model).orderBy("doc_id").collect()] == [1, 0]
    left = toxicity.drop_toxic(labelled[0], model)
    assert left.columns == labelled[0].columns and 0 < left.count() < 900


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def test_automaton_equals_edit_distance():
    rng = random.Random(4)
    terms = [("abcab", False), ("abc", False), ("ccbba", False), ("bab", True)]
    lexicon = toxicity.Lexicon(terms)
    for _ in range(4000):
        w = "".join(rng.choice("abc") for _ in range(rng.randrange(1, 8)))
        got = lexicon.match(w)
        exact = [k for k, (t, stem) in enumerate(terms) if (w.startswith(t) if stem else w == t)]
        loose = [k for k, (t, stem) in enumerate(terms) if not stem and len(t) >= 5 and edits(w, t) == 1]
        if exact:
            assert got[0] in exact and got[1] == 0
        elif loose:
            assert got[0] in loose and got[1] == 1
        else:
            assert got is None


def test_stems_and_short_terms_may_be_misspelled():
    rng = random.Random(5)
    terms = [("abcab", True), ("cacb", False), ("bcba", True)]
    lexicon = toxicity.Lexicon(terms)
    for _ in range(4000):
        w = "".join(rng.choice("abc") for _ in range(rng.randrange(1, 9)))
        ends = [w[:n] for n in range(len(w) + 1)]
        exact = [k for k, (t, stem) in enumerate(terms) if (w.startswith(t) if stem else w == t)]
        near = [1] if edits(w, "cacb") == 1 else [0] if min(edits(x, "abcab") for x in ends) == 1 else []
        got = lexicon.match(w)
        if exact:
            assert got[0] in exact and got[1] == 0, w
        else:
            assert got == ((near[0], 1) if near else None), w


def test_misspelled_members_of_a_stem_family_are_found():
    rng = random.Random(6)
    endings = ["a", "on", "um", "ierte", "ix", "orra"]
    toxic = [" ".join([f"w{rng.randrange(200)}" for _ in range(30)] + [rng.choice(["vexil" + rng.choice(endings), "scum"])]) for _ in range(400)]
    clean = [" ".join(f"w{rng.randrange(200)}" for _ in range(30)) for _ in range(400)]
    model = toxicity.fit([(t, 1) for t in toxic] + [(t, 0) for t in clean])
    assert {("vexil", True), ("vexilierte", False)} <= set(model["terms"])
    lexicon = toxicity.Lexicon(model["terms"])
    for word in ("vxilon", "vexxilum", "bexilorra", "vexiliert", "exila", "skum", "scuum", "scm"):
        x = toxicity.features(toxicity.hits(lexicon, f"w1 w2 w3 {word} w4 w5 w6"), model["weights"], model["quoted"], 30)
        assert toxicity.fitting.score_logistic(model["curve"], toxicity.np.array([x]))[0] >= 0.5, word


def test_quotation_counts_less():
    lexicon = toxicity.Lexicon([("grumbol", False)])
    assert toxicity.hits(lexicon, 'they called him "grumbol" there') == [(0, 0, True)]
    assert toxicity.hits(lexicon, "«so grumbol da»") == [(0, 0, True)]
    assert toxicity.hits(lexicon, "what a grumbol you are") == [(0, 0, False)]


def brute(text):
    w = split(text)
    seen = Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    inside = {j for i in range(len(w) - 4) if seen[tuple(w[i:i + 5])] > 1 for j in range(i, i + 5)}
    lines, dup = set(), 0
    for line in (text or "").split("\n"):
        if split(line):
            dup += line in lines
            lines.add(line)
    failed = len(w) < 10 or 100 * len(inside) > 20 * len(w)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), dup, len(inside), failed


def test_repetition(docs, corpus, no_docs):
    rows = repetition.repetition(docs).collect()
    base = [("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    assert Counter(tuple(r[c] for c in base) for r in rows) == Counter((r[0], *brute(r[1])) for r in corpus)
    for r in rows:
        shares = [(r[f"share_{n}"], most) for n, most in repetition.LIMITS]
        assert r["kept"] == (not r["base_failed"] and r["line_share"] <= repetition.LINE_LIMIT and all(s <= m for s, m in shares))
    assert repetition.repetition(no_docs).count() == 0
