import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from changemill.llm import curve_packing

PATH = public_tokenizers.path("word_bpe_49k.json")


def check_packing(rows, documents):
    """Every id of every document lies in one piece; sequences are gapless and not padded."""
    tokenizer = Tokenizer.from_file(PATH)
    want = Counter()
    for i, text in documents:
        want[(i, tuple(tokenizer.encode(text or "", add_special_tokens=False).ids) + (1,))] += 1
    sequences = defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append(r)
        assert r["length"] > 0
    for pieces in sequences.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 2048 and at & (at - 1) == 0
    total = sum(len(ids) * n for (_, ids), n in want.items())
    assert total == sum(r["length"] for r in rows)
    by_doc = defaultdict(list)
    for (i, ids), n in want.items():
        by_doc[(i, len(ids))].append(ids)
    for r in rows:
        ends = r["start"] + r["length"]
        assert any(zlib.crc32(np.array(ids[r["start"]:ends], "<u4").tobytes()) == r["ids_crc32"] for ids in by_doc[(r["doc_id"], r["doc_tokens"])])
    cover = Counter()
    for r in rows:
        for at in range(r["start"], r["start"] + r["length"]):
            cover[(r["doc_id"], r["doc_tokens"], at)] += 1
    copies = Counter()
    for (i, ids), n in want.items():
        copies[(i, len(ids))] += n
    assert all(n == copies[(i, size)] for (i, size, _), n in cover.items())


def test_pack(docs, corpus):
    check_packing(curve_packing.pack(docs, PATH).collect(), [(r[0], r[1]) for r in corpus])


def test_parts_between_white_space_tokenize_alone():
    tokenizer, tokens = Tokenizer.from_file(PATH), curve_packing.Tokens(PATH)
    rng = random.Random(6)
    chars = "aAéÉ'sßΣσ1 9\t\n.,!?-_İﬁ日本 ́<|endoftext|>"
    for _ in range(800):
        text = "".join(rng.choice(chars) for _ in range(rng.randrange(40)))
        assert np.frombuffer(tokens.of(text.encode()), "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids, text


def test_every_latin_code_point_has_its_tokens():
    tokenizer, tokens = Tokenizer.from_file(PATH), curve_packing.Tokens(PATH)
    for code in range(0x250):
        for text in (chr(code), f"!{chr(code)}!", f"a{chr(code)}b 1{chr(code)}{chr(code)}[", f"{chr(code)} x"):
            assert np.frombuffer(tokens.of(text.encode()), "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids, (code, text)


def test_hilbert_neighbours():
    side = 8
    cells = np.array([[a, b, c] for a in range(side) for b in range(side) for c in range(side)])
    key = curve_packing.hilbert(cells, 3)
    assert sorted(key) == list(range(side ** 3))
    steps = np.abs(np.diff(cells[np.argsort(key)], axis=0)).sum(1)
    assert (steps == 1).all()


def test_empty(no_docs):
    assert curve_packing.pack(no_docs, PATH).count() == 0


def test_pipeline(spark, tmp_path):
    """Stages take effect: toxic texts, copies and near copies go, the rest is mixed and packed."""
    rng = random.Random(8)
    rows, labels = [], []
    for i in range(300):
        w = [f"w{rng.randrange(900)}" for _ in range(60)]
        toxic = i % 5 == 0
        if toxic:
            w[10] = w[30] = "grumbol"
        rows.append((i, " ".join(w), "en", f"s{i % 3}", None))
        labels.append((i, 1, int(toxic)))
    rows += [(1000 + k, rows[1][1].upper().replace("W", "w"), "en", "s1", None) for k in range(3)]
    rows += [(2000 + k, rows[2][1] + f" more{k}", "en", "s2", None) for k in range(3)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    docs, sf = spark.read.parquet(str(tmp_path / "documents.parquet")), str(tmp_path)
    want = {i: t for i, t, *_ in rows if "grumbol" not in t}
    seen = []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        docs = stage(spark, docs, sf)
        if k < 4:
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"], name
            docs.write.parquet(str(tmp_path / name))
            docs = spark.read.parquet(str(tmp_path / name))
        seen.append(docs.collect())
    assert {r["doc_id"] for r in seen[0]} == set(want)
    del want[1], want[1000], want[1001]
    assert {r["doc_id"] for r in seen[1]} == set(want)
    for k in (2000, 2001, 2002):
        del want[k]
    assert {r["doc_id"] for r in seen[2]} == set(want)
    assert {r["doc_id"] for r in seen[3]} <= set(want) and max(Counter(r["doc_id"] for r in seen[3]).values()) == 2
    check_packing(seen[4], [(r["doc_id"], r["text"]) for r in seen[3]])
    assert corpus_pipeline.run(spark, sf).columns == docs.columns
