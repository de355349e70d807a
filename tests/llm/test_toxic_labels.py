"""Labels of one kind, none, conflicting or only long texts never cost the corpus its documents."""

import random
from collections import Counter

import corpus_pipeline
import pytest
from changemill.llm import fitting, quality_zstd, toxicity

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def text(rng, toxic, n=40):
    words = [f"w{rng.randrange(300)}" for _ in range(n)]
    if toxic:
        words[n // 2] = words[n // 3] = "grumbol"
    return " ".join(words)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    return [(i, text(rng, i % 5 == 0), "en", f"s{i % 3}", None) for i in range(200)] + [(900, None, None, None, None), (901, "", "en", "s1", 0), (None, "w1 w2", "en", "s1", 1)]


LABELS = {
    "all toxic": [(i, 1) for i in range(0, 200, 5)],
    "all clean": [(i, 0) for i in range(1, 200, 5)],
    "one of each": [(0, 1), (1, 0)],
    "none": [],
    "null": [(0, None), (1, None), (None, 1), (None, 0)],
    "conflicting": [(i, k) for i in range(60) for k in (0, 1)],
    "unrelated": [(i, 1) for i in range(1, 200, 5)] + [(i, 0) for i in range(2, 200, 50)],
}


@pytest.mark.parametrize("kind", LABELS)
def test_nothing_is_dropped_without_a_curve(spark, rows, kind):
    docs = spark.createDataFrame(rows, SCHEMA)
    labels = spark.createDataFrame(LABELS[kind], "doc_id long, toxic int")
    model = toxicity.train(docs, labels)
    assert "curve" not in model
    assert toxicity.drop_toxic(docs, model).count() == len(rows)
    assert {r["predicted"] for r in toxicity.score(docs, model).collect()} == {0}


@pytest.mark.parametrize("n_toxic,n_clean", [(12, 160), (40, 12)])
def test_uneven_labels_drop_only_what_has_a_term(spark, rows, n_toxic, n_clean):
    some = [i for i in range(200) if i % 5 == 0][:n_toxic], [i for i in range(200) if i % 5][:n_clean]
    labels = spark.createDataFrame([(i, 1) for i in some[0]] + [(i, 0) for i in some[1]], "doc_id long, toxic int")
    docs = spark.createDataFrame(rows, SCHEMA)
    kept = {r["doc_id"] for r in toxicity.drop_toxic(docs, toxicity.train(docs, labels)).collect()}
    assert kept == {i for i, t, *_ in rows if "grumbol" not in (t or "")}


def test_long_texts_are_learned_from(spark):
    rng = random.Random(1)
    rows = [(i, text(rng, i % 2 == 0, 6000), "en", "s", None) for i in range(80)]
    docs, labels = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame([(i, 1 - i % 2, 1 - i % 2) for i in range(80)], "doc_id long, toxic int, quality int")
    kept = {r["doc_id"] for r in toxicity.drop_toxic(docs, toxicity.train(docs, labels)).collect()}
    assert kept == {i for i in range(80) if i % 2}
    assert "curve" in quality_zstd.train(docs, labels)


def test_the_sample_is_bounded_by_rows_and_bytes(spark):
    rows = [(i, f"{i} " * (1 + i * 37 % 400), "en", "s", None) for i in range(300)] + [(500, "x" * 50_000, "en", "s", None), (7, "7 " * 260, "en", "s", None)]
    docs = spark.createDataFrame(rows, SCHEMA)
    labels = spark.createDataFrame([(i, i % 2) for i in range(300)] * 2 + [(500, 1)], "doc_id long, toxic int")
    take = lambda per_class, most: fitting.labelled_sample(docs, labels, "toxic", lambda i: fitting.F.lit(True), per_class, most)
    whole = take(1000, 1 << 30)
    assert Counter(t for t, _ in whole) == Counter({t for _, t, *_ in rows})
    few = take(20, 1 << 30)
    assert max(Counter(y for _, y in few).values()) <= 20 and set(few) <= set(whole)
    small = take(1000, 20_000)
    for y in (0, 1):
        assert 10_000 < sum(len(t) for t, v in small if v == y) <= 20_000


def test_pipeline_on_labels_of_one_kind(spark, rows, tmp_path):
    spark.createDataFrame(rows, SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i, 1, 1) for i in range(0, 200, 5)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert len({r["doc_id"] for r in out}) > 100


@pytest.mark.parametrize("given", [[], [(1, None, None, None, None), (2, "", "en", "", 0), (2, "", "en", "", 0), (None, "a b", None, "s", 3)]])
def test_pipeline_on_empty_and_null_input(spark, tmp_path, given):
    """Every stage has all columns of its input, clashing names included."""
    schema = SCHEMA + ", size long, root string, taken int, a string, text_key string"
    full = [(*r, 1, "x", 2, "y", "z") for r in given]
    spark.createDataFrame(full, schema).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == [f.split()[0] for f in schema.split(", ")], name
        docs.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
    assert {r["doc_id"] for r in docs.collect()} <= {r[0] for r in given}
    corpus_pipeline.run(spark, str(tmp_path)).collect()


def test_labels_are_joined_without_the_texts(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"t{i} " * 50, "en", "s", None) for i in range(60)] + [(70, "t1 " * 50, "en", "s", None), (3, "other", "en", "s", None)], SCHEMA)
    labels = spark.createDataFrame([(i, i % 2) for i in range(50)] + [(70, 1)], "doc_id long, toxic int")
    joined, join = [], type(docs).join
    monkeypatch.setattr(type(docs), "join", lambda self, *a, **k: (joined.append(self.columns), join(self, *a, **k))[1])
    got = fitting.labelled_sample(docs, labels, "toxic", lambda i: fitting.F.lit(True), 100, 1 << 20)
    assert Counter(got) == Counter([(f"t{i} " * 50, i % 2) for i in range(50)] + [("other", 1)])
    assert joined and all("__t" not in columns for columns in joined)
