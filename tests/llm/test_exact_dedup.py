import hashlib
from collections import Counter, defaultdict

from changemill.llm import exact_dedup
from llm_cases import lower


def expected(corpus):
    groups = defaultdict(list)
    for r in corpus:
        groups[lower(r[1])].append(r[0])
    out = Counter()
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        sha, spare = hashlib.sha256(text.encode()).hexdigest(), True
        for i in ids:
            kept = i == keep and spare
            spare = spare and not kept
            out[(i, keep, len(ids), kept, sha)] += 1
    return out


def found(df):
    return Counter(tuple(r) for r in df.select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect())


def test_groups(docs, corpus):
    assert found(exact_dedup.exact_groups(docs, keep="largest")) == expected(corpus)


def test_tiny_budget_needs_more_rounds_and_gives_the_same(docs, corpus, monkeypatch):
    rounds = []
    original = exact_dedup._own
    monkeypatch.setattr(exact_dedup, "_own", lambda *a: (rounds.append(1), original(*a))[1])
    real = exact_dedup.text_owners
    monkeypatch.setattr(exact_dedup, "text_owners", lambda *a: real(*a, budget=30_000))
    assert found(exact_dedup.exact_groups(docs, keep="largest")) == expected(corpus)
    assert len(rounds) > 1


def test_kept_documents(docs, corpus):
    kept = exact_dedup.drop_exact(docs, keep="largest")
    assert kept.columns == docs.columns
    assert Counter(lower(r["text"]) for r in kept.collect()) == Counter({lower(r[1]) for r in corpus})


def test_smallest(spark):
    df = spark.createDataFrame([(2, "A"), (1, "a"), (None, "a")], "doc_id long, text string")
    assert {r["keep_id"] for r in exact_dedup.exact_groups(df).collect()} == {1}


def test_empty(no_docs):
    assert exact_dedup.exact_groups(no_docs).count() == 0
    assert exact_dedup.drop_exact(no_docs).count() == 0


def test_trie_splits_and_gives_up():
    trie = exact_dedup.Trie(largest=False)
    keys = [b"abc", b"abd", b"ab", b"", b"x" * 50, b"abc"]
    for i, k in enumerate(keys):
        trie.insert(k, (i, 1, 1))
    assert dict(trie.items()) == {b"abc": (0, 2, 1), b"abd": (1, 1, 1), b"ab": (2, 1, 1), b"": (3, 1, 1), b"x" * 50: (4, 1, 1)}
    gone = [dict(trie.items(n, p)) for p, n in trie.give_up(2)]
    assert sorted(k for g in gone for k in g) == [b"ab", b"abc", b"abd", b"x" * 50]
    assert dict(trie.items()) == {b"": (3, 1, 1)} and trie.bytes == 0
