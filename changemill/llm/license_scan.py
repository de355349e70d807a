"""License scans in Spark's own functions: MinHash bands find templates, containment verifies.

A text's words (runs of letters and digits, A-Z lower-cased) give three-word shingles as
64-bit hashes. Windows of shingles, two to four times as long as a template and overlapping by half,
are compared with templates by the minima of several hash functions (bands of one row). A template
of which a share lies in a text lies with that share in one of its windows, whose similarity
to the template is then known from below; the number of bands follows from it and from the
wanted probability of a collision. A window without any shingle of any template can't collide
and gets no bands. What collides is verified: the share of the template's shingles that the
window has.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changemill.llm.common import lower_ascii, text_of

SHINGLE = 3
CONTAINMENT = 0.8
MISS = 1e-6  # most that a template contained to CONTAINMENT is missed with, by hash luck

#: Notices as they stand in documents; any (name, text) pairs can be given instead.
TEMPLATES = {
    "MIT": "Released under the MIT License.",
    "MIT-permission": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction"
    ),
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-use": "you may not use this file except in compliance with the License. You may obtain a copy of the License at",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-redistribute": (
        "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the "
        "Free Software Foundation"
    ),
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "BSD-conditions": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met"
    ),
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
}

#: What ends a word, for Java's and DuckDB's regular expressions alike.
BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def bands(share: float = CONTAINMENT, miss: float = MISS, longer: float = 2) -> int:
    """Bands of one row that find a template of which ``share`` lies in a window ``longer`` times its size."""
    similarity = share / (longer + (1 - share))
    return math.ceil(math.log(miss) / math.log(1 - similarity))


def words(text):
    """Runs of letters and digits; without any, no word."""
    return F.filter(F.split(lower_ascii(text), BREAK), lambda w: w != "")


def shingles(w):
    """Hashes of all runs of three words; of fewer words, none."""
    each = F.transform(w, lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2)))
    return F.slice(each, 1, F.greatest(F.size(w) - (SHINGLE - 1), F.lit(0)))


def template_frame(spark: SparkSession, templates: dict[str, str]) -> DataFrame:
    """license, distinct shingles, and the window length in shingles, a power of two."""
    rows = spark.createDataFrame(sorted(templates.items()), "license string, text string")
    t = rows.select("license", words(F.col("text")).alias("w")).select("license", F.array_distinct(shingles(F.col("w"))).alias("t")).where(F.size("t") > 0)
    return t.withColumn("span", F.pow(F.lit(2), F.ceil(F.log2(2.0 * F.size("t")))).cast("int"))


def minima(s, n):
    """One (band, smallest hash) for each of the hash functions 0 … n - 1."""
    return F.transform(F.sequence(F.lit(0), n - 1), lambda k: F.struct(
        k.alias("band"), F.array_min(F.transform(s, lambda x: F.xxhash64(x, k))).alias("low")))


def scan(docs: DataFrame, templates: dict[str, str] | None = None, share: float = CONTAINMENT, miss: float = MISS,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document and license found in it: doc_id, license, containment, n_windows, first_word.

    ``containment`` is the largest share of the template's shingles in one window,
    ``n_windows`` the number of windows with at least ``share`` of them, ``first_word`` the
    place, from 0, of the first such window. Rows that share an identifier are one document
    here. NULL, empty and very short texts hold no license. The templates are an argument of
    the call, not data: their number and size bound what is sent to the tasks.
    """
    spark = docs.sparkSession
    known = template_frame(spark, templates or TEMPLATES)
    made = known.collect()
    # a window has the bands that the shortest template of its span needs
    spans = {r["span"]: 0 for r in sorted(made, key=lambda r: r["span"])}
    for r in made:
        spans[r["span"]] = max(spans[r["span"]], bands(share, miss, r["span"] / len(r["t"])))
    marks = sorted({x for r in made for x in r["t"]})
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), words(text_of(text_col)).alias("w"))
    # the row number keeps the filter below from being evaluated on the text once more
    rows = rows.select("doc_id", shingles(F.col("w")).alias("s"), F.monotonically_increasing_id().alias("row"))
    hit = F.filter(F.transform("s", lambda x, i: F.when(x.isin(marks), i)), lambda i: i.isNotNull())
    rows = rows.withColumn("hits", hit).where(F.size("hits") > 0)
    # windows [k * span / 2, k * span / 2 + span) around hits: a hit lies in at most two of a span
    parts, n_bands = [], F.lit(0)
    for span, n in spans.items():
        n_bands = F.when(F.col("span") == span, n).otherwise(n_bands)
        half = span // 2
        at = F.array_distinct(F.flatten(F.transform("hits", lambda i: F.array(F.floor(i / half), F.greatest(F.floor(i / half) - 1, F.lit(0))))))
        parts.append(F.transform(at, lambda k: F.struct(F.lit(span).alias("span"), (k * half).cast("int").alias("start"))))
    windows = rows.select("doc_id", "row", "s", F.explode(F.concat(*parts)).alias("w")).select(
        "doc_id", "row", "w.span", "w.start", F.array_distinct(F.slice("s", F.col("w.start") + 1, F.col("w.span"))).alias("win"))
    keyed = windows.withColumn("m", F.explode(minima(F.col("win"), n_bands))).select("doc_id", "row", "span", "start", "win", "m.band", "m.low")
    wanted = known.select("license", "t", F.col("span").alias("t_span"), F.explode(minima(F.col("t"), n_bands)).alias("m")).select(
        "license", "t", "t_span", F.col("m.band").alias("t_band"), F.col("m.low").alias("t_low"))
    # templates are arguments: a fixed number of rows
    met = keyed.join(F.broadcast(wanted), (F.col("span") == F.col("t_span")) & (F.col("band") == F.col("t_band")) & (F.col("low") == F.col("t_low")))
    found = met.withColumn("containment", F.size(F.array_intersect("win", "t")) / F.size("t")).where(F.col("containment") >= share)
    found = found.groupBy("row", "doc_id", "license", "start").agg(F.max("containment").alias("containment"))
    return found.groupBy("doc_id", "license").agg(
        F.max("containment").alias("containment"), F.count(F.lit(1)).alias("n_windows"), F.min("start").cast("long").alias("first_word"))


def scan_sql(templates: dict[str, str] | None = None, share: float = CONTAINMENT) -> str:
    """The same for DuckDB, without bands: every window against every template."""
    def quoted(x: str) -> str:
        return "'" + x.replace("'", "''") + "'"

    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    rows = ", ".join(f"({quoted(k)}, {quoted(v)})" for k, v in (templates or TEMPLATES).items())
    w = f"list_filter(string_split_regex(translate(coalesce(text, ''), '{upper}', '{lower}'), '{BREAK}'), lambda x: x <> '')"
    s = "CASE WHEN len(w) < 3 THEN [] ELSE [w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] FOR i IN range(1, len(w) - 1)] END"
    return f"""
WITH t0(license, text) AS (VALUES {rows}),
t1 AS (SELECT license, {w} AS w FROM t0),
t AS (SELECT license, list_distinct({s}) AS t, CAST(pow(2, ceil(log2(2.0 * len(list_distinct({s}))))) AS BIGINT) AS span FROM t1),
d1 AS (SELECT doc_id, row_number() OVER () AS r, {w} AS w FROM documents),
d AS (SELECT doc_id, r, {s} AS s FROM d1),
v AS (SELECT doc_id, r, s, span, unnest(range(0, len(s), span // 2)) AS start FROM d, (SELECT DISTINCT span FROM t)),
x AS (SELECT doc_id, r, span, start, list_distinct(s[start + 1:start + span]) AS win FROM v),
c AS (SELECT doc_id, r, license, start, max(len(list_intersect(win, t)) / len(t)) AS containment FROM x JOIN t USING (span)
      GROUP BY ALL HAVING max(len(list_intersect(win, t)) / len(t)) >= {share})
SELECT doc_id, license, max(containment) AS containment, count(*) AS n_windows, min(start) AS first_word FROM c GROUP BY ALL"""
