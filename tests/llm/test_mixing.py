from collections import defaultdict

from changemill.llm import mixing
from llm_cases import split


def targets(sizes):
    """Shares by weight, the excess shared again until none is above its limit."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    left, out, open_ = 1.5 * sum(sizes.values()), {}, set(names)
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if level * weight[s] > 2 * sizes[s]}
        if not full:
            return out | {s: level * weight[s] for s in open_}
        for s in full:
            out[s] = 2.0 * sizes[s]
            left -= out[s]
        open_ -= full
    return out


def test_targets_and_takes(docs, corpus):
    sizes = defaultdict(int)
    for r in corpus:
        sizes[r[3]] += len(split(r[1]))
    want = targets(sizes)
    rows = mixing.mix(docs).collect()
    assert len(rows) == len(corpus)
    assert sorted(str((r["doc_id"], r["size"])) for r in rows) == sorted(str((r[0], len(split(r[1])))) for r in corpus)
    taken, most = defaultdict(int), defaultdict(int)
    for r in rows:
        assert abs(r["target"] - want[r["source"]]) < 1e-6 * (1 + want[r["source"]]) and r["source_size"] == sizes[r["source"]]
        assert 0 <= r["taken"] <= 2 * r["size"]
        taken[r["source"]] += r["taken"]
        most[r["source"]] = max(most[r["source"]], r["size"])
    for s, t in want.items():
        left = [r["size"] for r in rows if r["source"] == s and r["size"] and r["copies"] < 2]
        assert abs(taken[s] - t) <= min(left, default=1), s
    assert sorted(map(str, rows)) == sorted(map(str, mixing.mix(docs.repartition(3)).collect()))


def test_mixture_takes_what_is_decided(docs):
    decided = defaultdict(int)
    for r in mixing.mix(docs).collect():
        decided[(r["doc_id"], r["source"], r["size"])] += r["copies"]
    mixture = mixing.take_mix(docs)
    assert mixture.columns == docs.columns
    got = defaultdict(int)
    for r in mixture.collect():
        got[(r["doc_id"], r["source"], len(split(r["text"])))] += 1
    assert dict(got) == {k: n for k, n in decided.items() if n}


def test_gap_is_closed(spark):
    df = spark.createDataFrame([(i, "a " * (1 + i % 7), f"s{i % 5}") for i in range(500)], "doc_id long, text string, source string")
    taken, target = defaultdict(int), {}
    for r in mixing.mix(df).collect():
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
    assert all(abs(taken[s] - target[s]) <= 3 for s in target)


def test_empty(no_docs):
    assert mixing.mix(no_docs).count() == 0
    assert mixing.take_mix(no_docs).count() == 0


def greedy(docs_of, rest, size_of):
    """What the ranking gives one document after the other."""
    import hashlib

    long, units = int(rest // 8) + 1, []
    held = sum(min(n, long) for n in size_of.values())
    for i in docs_of:
        n = size_of[i]
        if n:
            u = (int(hashlib.md5(f"mix|{i}".encode()).hexdigest()[:13], 16) + 0.5) / 2.0 ** 52
            p = min(rest / held, 0.999999) * (min(n, long) / n)
            odds = (u / (1 - u)) / (p / (1 - p))
            units.append((odds / (1 + odds), n, i))
    took, gap, last = set(), rest, -1
    units.sort()
    for k, (_, n, i) in enumerate(units):
        if n <= gap:
            took.add(i)
            gap, last = gap - n, k
    over = [(abs(gap - n), k, i) for k, (_, n, i) in enumerate(units) if k > last and abs(gap - n) < gap]
    return took | {min(over)[2]} if over else took


def test_very_long_documents_do_not_spoil_the_target(spark):
    """One document as long as a third of its source: filling goes on behind it."""
    for seed in range(3):
        size = {i: 100 for i in range(600)} | {1000 + seed: 30_000, 2000: 7, 2001: 0}
        df = spark.createDataFrame([(i, "a " * n, "s") for i, n in size.items()] + [(5000, "b " * 90_000, "a")], "doc_id long, text string, source string")
        rows = [r for r in mixing.mix(df).collect() if r["source"] == "s"]
        target, source_size = rows[0]["target"], sum(size.values())
        taken = sum(r["taken"] for r in rows)
        assert abs(taken - target) <= 50, (taken, target)
        copies = int(target // source_size)
        extra = greedy(size, target - copies * source_size, size)
        assert {r["doc_id"]: r["copies"] for r in rows if r["size"]} == {i: copies + (i in extra) for i, n in size.items() if n}


def test_inclusion_is_less_likely_for_long_documents(spark):
    """Over many sources of one short and one long document with the same rest."""
    rows = [(2 * k + j, "a " * n, f"s{k:04}") for k in range(300) for j, n in enumerate((10, 10, 10, 10, 60))]
    rows = [(i, t, s) for i, (_, t, s) in enumerate(rows)]
    got = mixing.ranked(*_rows_and_targets(spark, rows)).groupBy("words").agg(mixing.F.avg("rank").alias("r")).collect()
    mean = {r["words"]: r["r"] for r in got}
    assert mean[60] > mean[10] + 0.1


def _rows_and_targets(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    sized = df.select("doc_id", "source", mixing.n_words("text").alias("size"), mixing.random52("doc_id", "mix").alias("x"))
    return sized, mixing.source_targets(sized)


def test_few_jobs_find_the_documents_of_the_sequential_filling(spark, monkeypatch):
    """What greedy filling in rank order takes, in jobs whose number doesn't follow the documents that fit."""
    rows = [(i, "a " * (1 + (i * i) % 211 if i % 5 < 4 else 2 + i % 3), f"s{i % 5}") for i in range(1500)]
    units, wanted = _rows_and_targets(spark, rows), set()
    rest = {r["source"]: r["rest"] for r in units[1].collect() if r["rest"] > 0}
    listed = sorted(mixing.ranked(*units).collect(), key=lambda r: (r["rank"], r["x"]))
    for source, left in rest.items():
        within, run, cut = [r for r in listed if r["source"] == source], None, []
        while within:  # a run ends at a unit that doesn't fit; behind it are only units that still do
            run, within = within, []
            for k, r in enumerate(run):
                if r["words"] > left:
                    cut, within = run[k:], [u for u in run[k:] if u["words"] <= left]
                    break
                wanted.add((source, r["x"]))
                left -= r["words"]
            else:
                cut = []
        over = [(abs(left - r["words"]), r["rank"], r["x"]) for r in cut if abs(left - r["words"]) < left]
        wanted |= {(source, min(over)[2])} if over else set()
    tracker = spark.sparkContext.statusTracker()
    for first, most_jobs in ((64, 45), (1, None)):
        monkeypatch.setattr(mixing, "FIRST", first)
        spark.sparkContext.setJobGroup(f"few-{first}", "")
        got = mixing.drawn(*units, True)
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        assert {(r["source"], r["x"]) for r in got.collect()} == wanted and got.count() == len(wanted)
        assert most_jobs is None or len(tracker.getJobIdsForGroup(f"few-{first}")) <= most_jobs, len(tracker.getJobIdsForGroup(f"few-{first}"))
