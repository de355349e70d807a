"""The queries opN_<name> and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changemill.llm import (
    conversation_repair,
    curve_packing,
    exact_dedup,
    gru_lm,
    jaccard_join,
    license_scan,
    merkle_manifest,
    mixing,
    oracles,
    quality_zstd,
    recompression,
    repetition,
    simhash_join,
    toxicity,
)
from changemill.llm.common import LOWER, UPPER, WORD, table

TOKENIZER = "word_bpe_49k.json"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


@query("op1_exact_dedup", f"""
WITH d AS (SELECT doc_id, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS t FROM documents)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       row_number() OVER (PARTITION BY t ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, sha256(t) AS text_sha256
FROM d WINDOW g AS (PARTITION BY t)""")
def op1_exact_dedup(spark, sf_dir):
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"), keep="largest")


@query("op2_mixing", mixing.mix_sql())
def op2_mixing(spark, sf_dir):
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", F.col("taken").cast("long").alias("taken"))


LOWERED = f"translate(coalesce(text, ''), '{UPPER}', '{LOWER}')"

NEAR_SQL = f"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({LOWERED}, '{WORD}') AS w FROM documents),
s AS (SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
        ELSE [array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)] END) AS s FROM d),
e AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM s),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS both FROM e a JOIN e b ON a.g = b.g AND 4 * least(a.n, b.n) >= 3 * greatest(a.n, b.n)
      GROUP BY 1, 2, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))),
r(doc_id, c) AS (SELECT a, b FROM p UNION SELECT r.doc_id, p.b FROM r JOIN p ON r.c = p.a)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, least(s.doc_id, coalesce(min(r.c), s.doc_id)) AS component_id
FROM s LEFT JOIN r ON s.doc_id = r.doc_id GROUP BY s.doc_id, len(s.s)"""


@query("op5_quality_zstd")
def op5_quality_zstd(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return quality_zstd.score(docs, quality_zstd.train(docs, table(spark, sf_dir, "labels")))


@query("op6_jaccard_join", NEAR_SQL)
def op6_jaccard_join(spark, sf_dir):
    return jaccard_join.near_groups(table(spark, sf_dir, "documents"))


@query("op7_toxicity")
def op7_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


@query("op8_curve_packing")
def op8_curve_packing(spark, sf_dir):
    return curve_packing.pack(table(spark, sf_dir, "documents"), tokenizer_path())


@query("op9_repetition", oracles.repetition_sql(repetition.LIMITS, repetition.LINE_LIMIT))
def op9_repetition(spark, sf_dir):
    return repetition.repetition(table(spark, sf_dir, "documents"))


WINDOW_SQL = f"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(coalesce(text, ''), '{WORD}') AS w FROM documents),
v AS (SELECT r, unnest(range(1, len(w) - 33)) AS i, w FROM d WHERE len(w) >= 35),
k AS (SELECT r, i, array_to_string(w[i:i + 34], ' ') AS g FROM v),
b AS (SELECT r, i FROM k WHERE g IN (SELECT g FROM k GROUP BY g HAVING count(*) > 1)),
c AS (SELECT DISTINCT r, unnest(range(i, i + 35)) AS j FROM b),
l AS (SELECT r, list(j) AS js FROM c GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(len(js), 0) AS BIGINT) AS n_removed,
       sha256(array_to_string([w[j] FOR j IN range(1, len(w) + 1) IF js IS NULL OR NOT list_contains(js, j)], ' ')) AS kept_sha256
FROM d LEFT JOIN l USING (r)"""


@query("op3_recompression", WINDOW_SQL)
def op3_recompression(spark, sf_dir):
    return recompression.drop_repeats(table(spark, sf_dir, "documents"))


@query("op10_license_scan", license_scan.scan_sql())
def op10_license_scan(spark, sf_dir):
    return license_scan.scan(table(spark, sf_dir, "documents"))


@query("op4_gru_lm")
def op4_gru_lm(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return gru_lm.score(docs, *gru_lm.train(docs))


@query("op11_simhash_grid", oracles.SIMHASH_SQL)
def op11_simhash_grid(spark, sf_dir):
    return simhash_join.near_groups(table(spark, sf_dir, "documents"))


@query("op12_merkle_manifest", oracles.MERKLE_SQL)
def op12_merkle_manifest(spark, sf_dir):
    return merkle_manifest.manifest(table(spark, sf_dir, "documents"))


@query("op13_conversation_repair", oracles.REPAIR_SQL)
def op13_conversation_repair(spark, sf_dir):
    conv = table(spark, sf_dir, "conversations")
    return conversation_repair.repair(conversation_repair.damage(conv), conv)
