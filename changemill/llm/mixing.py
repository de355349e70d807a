"""Mixing sources to target weights by Pareto order sampling.

A source's target over its size says how often each of its documents is taken: the whole part
are certain copies, which go first. One more copy has an inclusion probability p whose sum over
the words fills the rest of the target. p isn't equal: a document longer than an EIGHTH of the
rest has a lower one, in proportion, so that it is expected to fill no more than that and no
single document decides how a source is mixed. Documents are ranked by the odds of a random
number over the odds of p, and the extra copies go down the ranking until the target is filled:
the sample has a fixed size, in words. The random number is a hash of seed and document, so
reruns agree.

The cut in the ranking is found without sorting a source in one task: words are summed by
source and rank bucket, and only the bucket in which the target is crossed is sorted. A document
that doesn't fit is passed over and filling goes on behind it over what still fits, so that less
is missing in the end than the shortest document behind the cut holds. Where one more document
comes nearer to the target by going beyond it, it is taken last. What is missing at the cut is less
than one document, so of each length only the first few documents behind it can be taken: these
are folded in rank order, one short list a source, instead of a round of jobs for each that fits.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from changemill.llm.common import WORD, settled, text_of

BUCKETS = 4096  # of ranks, in which words are summed
EIGHTH = 8      # a document's expected part of a rest is at most one in so many
FIRST = 64      # documents of a length that one fold looks at; another goes on where these don't do


def n_words(text_col: str):
    return F.regexp_count(text_of(text_col), F.lit(WORD)).cast("long")


def random52(id_col: str, seed: str):
    """52 random bits that depend on seed and identifier only; they order as u/(1-u) does."""
    digest = F.md5(F.concat(F.lit(f"{seed}|"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))).cast("binary"))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[int] = (5, 2, 1), percent: int = 150, most: int = 2) -> DataFrame:
    """Targets of sources (source, size): ``percent`` of all words by weight, at most ``most`` times a size.

    Weights repeat along the sources' code-point order, NULL last. What exceeds a limit is
    shared by weight among the others until no source is above its limit: sources are sorted
    by the level at which they fill up, and the level of the others follows from running
    sums. One row per source: counts and sums, not documents, meet in one task.
    """
    s = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("source").isNull(), "source")) - 1
    s = s.withColumn("rank", rank)
    s = s.withColumn("weight", F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int")).cast("long"))
    s = s.withColumn("full_at", (most * F.col("source_size")).cast("double") / F.col("weight"))
    before = Window.orderBy("full_at", "rank").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    left = percent * F.sum("source_size").over(everything) - 100 * most * F.coalesce(F.sum("source_size").over(before), F.lit(0))
    shares = 100 * (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
    s = s.withColumn("level", left.cast("double") / shares)
    s = s.withColumn("filled", F.col("level") > F.col("full_at"))
    level = F.coalesce(F.min(F.when(~F.col("filled"), F.struct("full_at", "rank", "level"))).over(everything)["level"], F.lit(0.0))
    s = s.withColumn("target", F.when(F.col("filled"), (most * F.col("source_size")).cast("double")).otherwise(level * F.col("weight")))
    copies = F.when(F.col("source_size") == 0, 0).otherwise(F.floor(F.col("target") / F.col("source_size")))
    s = s.withColumn("copies", F.least(copies, F.lit(most)).cast("int"))
    return s.withColumn("rest", F.col("target") - F.col("copies") * F.col("source_size")).select("source", "source_size", "target", "copies", "rest")


def few(by_source: DataFrame, most_bytes: int = 8 << 20) -> bool:
    """Is a table with a row per source, and so any other of these sources, small enough to be broadcast?"""
    names = [F.coalesce(F.octet_length(f.name), F.lit(0)) for f in by_source.schema.fields if f.dataType.simpleString() == "string"]
    return (by_source.agg(F.sum(sum(names, F.lit(64)))).first()[0] or 0) <= most_bytes


def small(by_source: DataFrame, is_few: bool) -> DataFrame:
    """A table with a row per source, broadcast if ``few`` found it small; else joins shuffle."""
    return F.broadcast(by_source) if is_few else by_source


def ranked(rows: DataFrame, targets: DataFrame, is_few: bool = False) -> DataFrame:
    """(source, x, rank, words): units that are drawn together, with their place in the ranking.

    Rows that share source and identifier are a unit: they have one random number x.
    """
    units = rows.groupBy("source", "x").agg(F.sum("size").alias("words"))
    of = targets.where("rest > 0").select(F.col("source").alias("s"), "rest", (F.floor(F.col("rest") / EIGHTH) + 1).alias("long"))
    units = units.join(small(of, is_few), F.col("source").eqNullSafe(F.col("s"))).drop("s")
    shares = units.groupBy(F.col("source").alias("s")).agg(F.sum(F.least("words", "long")).alias("held"))
    units = units.join(small(settled(shares, "shares"), is_few), F.col("source").eqNullSafe(F.col("s"))).where("words > 0")
    p = F.least(F.col("rest") / F.col("held"), F.lit(0.999999)) * (F.least("words", "long") / F.col("words"))
    u = (F.col("x") + 0.5) / F.lit(float(1 << 52))
    odds = (u / (1 - u)) / (p / (1 - p))
    return units.select("source", "x", "words", (odds / (1 + odds)).alias("rank"))


def filled(units: DataFrame, rests: DataFrame, is_few: bool) -> DataFrame:
    """(source, cut, cut_x, rest): the place up to which whole units in rank order fit into their
    source's ``rest``, and what is left of it. A source in which all units fit has a cut beyond any."""
    rests = rests.select(F.col("source").alias("s"), "rest")
    bucket = F.floor(F.col("rank") * BUCKETS).alias("b")
    words = units.groupBy("source", bucket).agg(F.sum("words").alias("words"))
    sums = words.withColumn("upto", F.sum("words").over(Window.partitionBy("source").orderBy("b"))).join(small(rests, is_few), F.col("source").eqNullSafe(F.col("s")))
    crossed = sums.groupBy("source").agg(
        F.min(F.when(F.col("upto") > F.col("rest"), F.struct("b", (F.col("upto") - F.col("words")).alias("start")))).alias("c"),
        F.max("upto").alias("every"), F.first("rest").alias("rest"))
    crossed = settled(crossed.select(F.col("source").alias("s"), F.col("c.b").alias("b"), F.coalesce("c.start", "every").alias("start"), "rest"), "crossed")
    # only units of the crossing bucket are sorted
    near = units.join(small(crossed.where("b IS NOT NULL"), is_few), F.col("source").eqNullSafe(F.col("s")) & (F.floor(F.col("rank") * BUCKETS) == F.col("b")))
    run = F.col("start") + F.sum("words").over(Window.partitionBy("source").orderBy("rank", "x"))
    fits = F.col("run") <= F.col("rest")
    inside = near.withColumn("run", run).groupBy(F.col("source").alias("t")).agg(
        F.max(F.when(fits, F.struct("rank", "x"))).alias("last"), F.max(F.when(fits, F.col("run"))).alias("run"))
    out = crossed.join(inside, F.col("s").eqNullSafe(F.col("t")), "left")
    at_start = F.when(F.col("b").isNull(), 2.0).otherwise(F.col("b") / F.lit(float(BUCKETS)))  # nothing of the bucket: just before it
    return out.select(F.col("s").alias("source"), F.coalesce("last.rank", at_start).alias("cut"), F.coalesce("last.x", F.lit(-1)).cast("long").alias("cut_x"),
                      (F.col("rest") - F.coalesce("run", "start")).alias("rest"))


def folded(behind: DataFrame) -> DataFrame:
    """(source, rest, until, at, stopped, taken, last): units behind the cut taken in rank order where they fit.

    ``behind``: units shorter than two of their source's ``rest``. What fits is taken. One that doesn't
    ends a run: units longer than what is left then have no part in what follows, except that after the
    last run the one that comes nearest to the target is ``last``. Of a length w, no more than rest / w
    can be taken and one be the last, so only so many are gathered, and at most FIRST: where one more
    would be needed the fold is ``stopped``, behind ``at`` and with units up to ``until`` words left.
    """
    nth = F.row_number().over(Window.partitionBy("source", "words").orderBy("rank", "x"))
    some = behind.withColumn("nth", nth).where(F.col("nth") <= FIRST).where(F.col("nth") <= F.floor(F.col("rest") / F.col("words")) + 1)
    one = F.struct("rank", "x", F.col("words").cast("double").alias("words"), (F.col("nth") == FIRST).alias("end"))
    lists = some.groupBy("source").agg(F.array_sort(F.collect_list(one)).alias("units"), F.first("rest").cast("double").alias("rest"))
    state = "struct<rest:double,until:double,before:double,took:boolean,at:struct<rank:double,x:bigint>,stopped:boolean,taken:array<bigint>>"
    of = lambda *c: F.struct(*[v.alias(n) for n, v in zip(("rest", "until", "before", "took", "at", "stopped", "taken"), c, strict=True)]).cast(state)
    start = of(F.col("rest"), F.col("rest"), F.lit(float("inf")), F.lit(False), F.struct(F.lit(-1.0), F.lit(-1)), F.lit(False), F.array())

    def step(s, u):
        at, left = F.struct(u["rank"], u["x"]), s["rest"] - u["words"]
        took = of(left, s["until"], s["before"], F.lit(True), at, u["end"] & (u["words"] <= left), F.concat(s["taken"], F.array(u["x"])))
        ended = of(s["rest"], s["rest"], s["until"], F.lit(False), at, F.lit(False), s["taken"])
        return F.when(s["stopped"] | (u["words"] > s["until"]), s).when(u["words"] <= s["rest"], took).otherwise(ended)

    done = lists.select("source", "units", F.aggregate("units", start, step).alias("s")).select("source", "units", "s.*")
    near = F.filter("units", lambda u: (F.struct(u["rank"], u["x"]) >= F.col("at")) & (u["words"] > F.col("rest")) & (u["words"] <= F.col("before")) & (u["words"] < 2 * F.col("rest")))
    nearest = F.array_min(F.transform(near, lambda u: F.struct((u["words"] - F.col("rest")).alias("off"), u["rank"].alias("rank"), u["x"].alias("x"))))["x"]
    return done.select("source", "rest", "until", "at", "stopped", "taken", F.when(~F.col("took") & ~F.col("stopped"), nearest).alias("last"))


def drawn(rows: DataFrame, targets: DataFrame, is_few: bool) -> DataFrame:
    """(source, x) of the units that get an extra copy."""
    units = settled(ranked(rows, targets, is_few), "ranked")
    rests, found = targets.where("rest > 0").select("source", "rest"), None
    while True:
        cut = settled(filled(units, rests, is_few), "cuts").select(F.col("source").alias("s"), "cut", "cut_x", "rest")
        known = units.join(small(cut, is_few), F.col("source").eqNullSafe(F.col("s")))
        before = (F.col("rank") < F.col("cut")) | ((F.col("rank") == F.col("cut")) & (F.col("x") <= F.col("cut_x")))
        # a unit too long to be the last one either has no part in what follows
        behind = known.where(~before & (F.col("words") < 2 * F.col("rest"))).select("source", "x", "words", "rank", "rest")
        ends = settled(folded(behind), "ends")
        more = ends.select("source", F.explode(F.concat("taken", F.array_compact(F.array("last")))).alias("x"))
        taken = known.where(before).select("source", "x").unionAll(more)
        found = taken if found is None else found.unionAll(taken)
        stopped = ends.where("stopped").select(F.col("source").alias("s"), "rest", "until", "at")
        if stopped.isEmpty():
            return settled(found, "drawn")
        left = units.join(small(stopped, is_few), F.col("source").eqNullSafe(F.col("s")))
        units = settled(left.where((F.struct("rank", "x") > F.col("at")) & (F.col("words") <= F.col("until"))).select("source", "x", "words", "rank"), "left")
        rests = stopped.select(F.col("s").alias("source"), "rest")


def plan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
         weights: Sequence[int] = (5, 2, 1), percent: int = 150, most: int = 2, seed: str = "mix"):
    """(rows, per-source decisions, extra copies): rows hold doc_id, source, size and random bits x
    of every document, the extra copies (s2, x2)."""
    rows = settled(
        docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"), n_words(text_col).alias("size"), random52(id_col, seed).alias("x")),
        "mix",
    )
    targets = settled(source_targets(rows, weights, percent, most), "targets")
    is_few = few(targets)
    extra = drawn(rows, targets, is_few).select(F.col("source").alias("s2"), F.col("x").alias("x2"), F.lit(1).alias("extra"))
    return rows, small(targets.withColumnRenamed("source", "s"), is_few), extra


def mix(docs: DataFrame, **options) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, copies, taken.

    A NULL text has no words; NULL is a source of its own; an empty table gives no rows.
    Rows that share an identifier share a random number, so they are drawn together.
    """
    rows, by_source, extra = plan(docs, **options)
    out = rows.join(by_source, F.col("source").eqNullSafe(F.col("s")), "left")
    out = out.join(extra, F.col("source").eqNullSafe(F.col("s2")) & (F.col("x") == F.col("x2")), "left")
    out = out.withColumn("copies_taken", F.col("copies") + F.coalesce("extra", F.lit(0)))
    return out.select("doc_id", "source", "size", "source_size", "target", F.col("copies_taken").alias("copies"), (F.col("copies_taken") * F.col("size")).alias("taken"))


def take_mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: str = "mix", **options) -> DataFrame:
    """The mixture itself: each document as often as it is taken, all columns as they were."""
    _, by_source, extra = plan(docs, id_col, text_col, source_col, seed=seed, **options)
    own = "__llm_mix_"  # documents may have columns of any name
    by_source = by_source.select(F.col("s").alias(f"{own}s"), F.col("copies").alias(f"{own}copies"))
    extra = extra.select(*[F.col(c).alias(own + c) for c in extra.columns])
    source = F.col(source_col).cast("string")
    found = docs.withColumn(f"{own}x", random52(id_col, seed)).join(by_source, source.eqNullSafe(F.col(f"{own}s")), "left")
    found = found.join(extra, source.eqNullSafe(F.col(f"{own}s2")) & (F.col(f"{own}x") == F.col(f"{own}x2")), "left")
    found = found.withColumn(f"{own}n", F.col(f"{own}copies") + F.coalesce(f"{own}extra", F.lit(0)))
    every = F.explode(F.sequence(F.lit(1), F.col(f"{own}n")))
    return found.where(F.col(f"{own}n") > 0).withColumn(f"{own}k", every).select(*[F.col(f"`{c}`") for c in docs.columns])


def mix_sql(weights=(5, 2, 1), percent: int = 150, most: int = 2, seed: str = "mix") -> str:
    """The same for DuckDB, over the view ``documents``."""
    of_rank = " ".join(f"WHEN {i} THEN {w}" for i, w in enumerate(weights))
    return f"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS BIGINT) AS size,
         CAST('0x' || substr(md5('{seed}|' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13) AS BIGINT) AS x
  FROM documents),
s0 AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
s1 AS (SELECT *, row_number() OVER (ORDER BY source IS NULL, source) - 1 AS rank FROM s0),
s2 AS (SELECT *, CASE rank % {len(weights)} {of_rank} END AS weight FROM s1),
s3 AS (SELECT *, CAST({most} * source_size AS DOUBLE) / weight AS full_at FROM s2),
s4 AS (SELECT *, CAST({percent} * sum(source_size) OVER () - {100 * most} * coalesce(sum(source_size) OVER b, 0) AS DOUBLE)
         / CAST(100 * (sum(weight) OVER () - coalesce(sum(weight) OVER b, 0)) AS DOUBLE) AS level
       FROM s3 WINDOW b AS (ORDER BY full_at, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
s5 AS (SELECT *, level > full_at AS filled, coalesce((SELECT arg_min(level, (full_at, rank)) FROM s4 WHERE level <= full_at), 0.0) AS lvl FROM s4),
s6 AS (SELECT source, source_size, CASE WHEN filled THEN CAST({most} * source_size AS DOUBLE) ELSE lvl * weight END AS target FROM s5),
s AS (SELECT *, CASE WHEN source_size = 0 THEN 0 ELSE least(CAST(floor(target / source_size) AS BIGINT), {most}) END AS copies FROM s6),
r AS (SELECT d.source, x, CAST(sum(size) AS BIGINT) AS words, any_value(s.target - s.copies * s.source_size) AS rest
      FROM d JOIN s ON d.source IS NOT DISTINCT FROM s.source WHERE s.target - s.copies * s.source_size > 0 GROUP BY d.source, x),
h AS (SELECT source, sum(least(words, CAST(floor(rest / {EIGHTH}) AS BIGINT) + 1)) AS held FROM r GROUP BY source),
v AS (SELECT r.source, x, words, rest, (x + 0.5) / {float(1 << 52)!r}::DOUBLE AS u,
             least(rest / CAST(h.held AS DOUBLE), 0.999999::DOUBLE) * (least(words, CAST(floor(rest / {EIGHTH}) AS BIGINT) + 1)::DOUBLE / words) AS p
      FROM r JOIN h ON r.source IS NOT DISTINCT FROM h.source WHERE words > 0),
q AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY ((u / (1 - u)) / (p / (1 - p))) / (1 + (u / (1 - u)) / (p / (1 - p))), x) AS k FROM v),
-- down the ranking, one unit after the other: what fits is taken
w(source, k, gap, x, took) AS (
  SELECT DISTINCT source, 0::BIGINT, rest, NULL::BIGINT, false FROM q
  UNION ALL SELECT q.source, q.k, CASE WHEN q.words <= w.gap THEN w.gap - q.words ELSE w.gap END, q.x, q.words <= w.gap
  FROM w JOIN q ON q.source IS NOT DISTINCT FROM w.source AND q.k = w.k + 1),
g AS (SELECT source, arg_max(gap, k) AS gap, max(k) FILTER (took) AS until FROM w GROUP BY source),
-- what didn't fit, behind the last that did, and goes beyond the target by less than is missing
c AS (SELECT q.source, arg_min(q.x, (abs(g.gap - q.words), q.k)) AS x FROM q JOIN g ON q.source IS NOT DISTINCT FROM g.source
      WHERE q.k > coalesce(g.until, 0) AND abs(g.gap - q.words) < g.gap GROUP BY q.source),
e AS (SELECT source, x FROM w WHERE took UNION ALL SELECT source, x FROM c)
SELECT d.doc_id, d.size, s.source_size, s.target, CAST(d.size * (s.copies + CASE WHEN e.x IS NULL THEN 0 ELSE 1 END) AS BIGINT) AS taken
FROM d JOIN s ON d.source IS NOT DISTINCT FROM s.source
LEFT JOIN e ON d.source IS NOT DISTINCT FROM e.source AND d.x = e.x"""
