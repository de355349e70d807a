import hashlib
import random
import zlib

import pytest
from changemill.llm import merkle_manifest
from changemill.llm.common import settled
from llm_cases import lower


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row, text):
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (row[0], row[3], row[2], row[4], text)))


def tree(digests):
    levels = [digests]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([h("".join(last[i:i + 8])) for i in range(0, len(last), 8)])
    return levels


def siblings(levels, at):
    for level in levels[:-1]:
        first = at // 8 * 8
        yield level[first:at], level[at + 1:first + 8]
        at //= 8


def expected(rows):
    """Of (doc_id, text, lang, source, n_chars)."""
    by_lang = {}
    for r in rows:
        by_lang.setdefault(r[2], []).append((r[0] is not None, r[0] or 0, leaf(r, r[1]), r))
    langs = sorted(by_lang, key=lambda x: (x is not None, (x or "").encode()))
    members = [sorted(by_lang[x], key=lambda m: m[:3]) for x in langs]
    trees = [tree([m[2] for m in ms]) for ms in members]
    top, out = tree([t[-1][0] for t in trees]), []
    for k, (t, ms) in enumerate(zip(trees, members)):
        for i, (_, _, digest, r) in enumerate(ms):
            way = [*siblings(t, i), *siblings(top, k)]
            folded = digest
            if zlib.crc32(str(r[0] if r[0] is not None else "").encode()) % 3 == 0:
                folded = leaf(r, None if r[1] is None else lower(r[1]))
            for before, after in way:
                folded = h("".join([*before, folded, *after]))
            proof = h("".join("".join(a) + "".join(b) for a, b in way))
            out.append((r[0], digest, t[-1][0], top[-1][0], proof, folded, folded == top[-1][0]))
    return sorted(out, key=repr)


def found(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_manifest(docs, corpus):
    assert found(merkle_manifest.manifest(docs)) == expected([r[:5] for r in corpus])


@pytest.mark.parametrize("run", [1, 5, 12])
def test_many_languages_and_runs_that_cross_trees(spark, monkeypatch, run):
    monkeypatch.setattr(merkle_manifest, "RUN", run)
    rng = random.Random(run)
    rows = [(rng.choice([None, *range(200)]), rng.choice([None, "", "Abc", "é X", "low"]), rng.choice([None, "en", "", "é", *map(str, range(25))]) if i % 3 else "en",
             rng.choice([None, "s"]), rng.choice([None, 1])) for i in range(700)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    assert found(merkle_manifest.manifest(df)) == expected(rows)


@pytest.mark.parametrize("n", [0, 1, 2, 8, 9, 65])
def test_small_trees(spark, n):
    rows = [(i, f"Text {i}", "en", None, i) for i in range(n)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert found(merkle_manifest.manifest(df)) == expected(rows)


def test_octopus_is_minimal():
    """What is listed suffices, and nothing listed follows from the leaves or from the rest."""
    rng = random.Random(4)
    for n in (1, 7, 8, 9, 70, 600):
        levels = tree([h(str(i)) for i in range(n)])
        for size in {1, min(n, 3), n}:
            places = sorted(rng.sample(range(n), size))
            need = list(merkle_manifest.unknown(places, n))
            assert len(set(need)) == len(need)
            branch = merkle_manifest.Branch(n, {i: levels[0][i] for i in places}, {(a, i): levels[a][i] for a, i in need})
            assert branch.root == levels[-1][0]
            for a, i in need:
                assert not any(i << 3 * a <= p < (i + 1) << 3 * a for p in places)
            for p in places:
                assert branch.fold(p, levels[0][p]) == levels[-1][0]
            for gone in need:
                with pytest.raises(KeyError):
                    merkle_manifest.Branch(n, {i: levels[0][i] for i in places}, {(a, i): levels[a][i] for a, i in need if (a, i) != gone})


def test_some_leaves_are_proved(spark):
    rows = spark.createDataFrame([(i, h(str(i)), None, "en") for i in range(100)], "doc_id long, leaf string, other string, lang string")
    known = settled(merkle_manifest.leaves(rows), "known")
    some = merkle_manifest.prove(known.where("doc_id % 31 = 5"), merkle_manifest.nodes(known)).collect()
    root = tree([h(str(i)) for i in range(100)])[-1][0]
    assert sorted(r["doc_id"] for r in some) == [5, 36, 67, 98] and {r["folded_root"] for r in some} == {root}


def test_no_join_of_everything_with_everything(docs):
    plan = merkle_manifest.manifest(docs)._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
