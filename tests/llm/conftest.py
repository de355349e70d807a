import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id long, size long, s string, root string"


def words(rng, n, vocabulary=400):
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


@pytest.fixture(scope="session")
def corpus():
    """Rows with nulls, empty texts, ties, repeated rows, near copies, shared passages, one long text."""
    rng = random.Random(5)
    texts = [" ".join(words(rng, rng.choice([1, 3, 5, 9, 40, 120, 300]))) for _ in range(60)]
    passage = " ".join(words(rng, 60))
    texts += [f"{a} {passage} {b}" for a, b in ((" ".join(words(rng, 50)), " ".join(words(rng, 30))) for _ in range(6))]
    base = words(rng, 200)
    for k in range(8):
        edited = list(base)
        for at in rng.sample(range(200), k):
            edited[at] = f"edit{k}"
        texts.append(" ".join(edited))
    texts += [texts[3].upper(), texts[3], texts[10] + "\n" + texts[10], "a b " * 90, "x " * 200, "", None, " \n\t", "É é " * 30, "one two", "one two", "one"]
    texts.append(" ".join(words(rng, 20_000)))
    rows = [(i, t, "en", None if i % 11 == 0 else f"src{i % 4}", None, 7, 1, "x", None) for i, t in enumerate(texts)]
    rows += [rows[5], rows[5], rows[70], (None, texts[8], None, "é", 3, None, None, None, "r"), (None, None, None, None, None, None, None, None, None),
             (4, "same id other text " * 5, "en", "src1", 1, 1, 1, "y", "z")]
    return rows


@pytest.fixture(scope="session")
def docs(spark, corpus):
    return spark.createDataFrame(corpus, SCHEMA).repartition(5)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
