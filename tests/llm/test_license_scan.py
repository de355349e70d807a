import math
import re

from pyspark.sql import functions as F

from changemill.llm import license_scan
from llm_cases import lower


def shingles(text):
    w = [x for x in re.split(license_scan.BREAK, lower(text)) if x]
    return [tuple(w[i:i + 3]) for i in range(len(w) - 2)]


def expected(rows, templates):
    out = {}
    for i, text in rows:
        s = shingles(text)
        for name, t in templates.items():
            t = set(shingles(t))
            span = 1
            while span < 2 * len(t):
                span *= 2
            for start in range(0, len(s), span // 2):
                c = len(t & set(s[start:start + span])) / len(t)
                if c >= license_scan.CONTAINMENT:
                    best, n, first = out.get((i, name), (0, 0, start))
                    out[(i, name)] = (max(best, c), n + 1, min(first, start))
    return out


def test_scan(spark):
    filler = " ".join(f"w{i}" for i in range(500))
    rows = [(k, f"{' '.join(filler.split()[:k * 7])} {t}\n{filler}") for k, t in enumerate(license_scan.TEMPLATES.values())]
    mit = license_scan.TEMPLATES["MIT-permission"].split()
    rows += [(20, None), (21, ""), (22, "Released under"), (23, "RELEASED   under the... mit license"), (24, " ".join(mit[:-3])), (25, " ".join(mit[:10])),
             (26, "released under the mit license " * 40), (27, "x " * 3000 + license_scan.TEMPLATES["MIT"]), (None, license_scan.TEMPLATES["MIT"])]
    df = spark.createDataFrame([(i, t, "s", 1) for i, t in rows], "doc_id long, text string, s string, span int").repartition(3)
    got = {(r["doc_id"], r["license"]): (r["containment"], r["n_windows"], r["first_word"]) for r in license_scan.scan(df).collect()}
    assert got == expected(rows, license_scan.TEMPLATES)


def test_bands_follow_from_the_wanted_probability():
    n = license_scan.bands(0.8, 1e-6)
    assert (1 - 0.8 / 2.2) ** n <= 1e-6 < (1 - 0.8 / 2.2) ** (n - 1)


def test_bands_fit_every_template(spark, monkeypatch):
    """Each template has the bands that its window's real length asks for."""
    used = []
    monkeypatch.setattr(license_scan, "minima", lambda s, n, make=license_scan.minima: used.append(n) or make(s, n))
    templates = {**license_scan.TEMPLATES, "seventeen": " ".join(f"t{i}" for i in range(19))}
    license_scan.scan(spark.createDataFrame([(1, "a b c")], "doc_id long, text string"), templates)
    rows = license_scan.template_frame(spark, templates).select("license", "span", "t", *[(n if hasattr(n, "cast") else F.lit(n)).alias(f"n{k}") for k, n in enumerate(used)]).collect()
    assert len(used) == 2 and len(rows) == len(templates)
    for r in rows:
        t = len(r["t"])
        least = math.ceil(license_scan.CONTAINMENT * t)
        similarity = least / (r["span"] + t - least)
        assert (1 - similarity) ** min(r["n0"], r["n1"]) <= license_scan.MISS, r["license"]


def test_no_python_in_the_plan(docs):
    plan = license_scan.scan(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_empty(no_docs, docs):
    assert license_scan.scan(no_docs).count() == 0
    assert license_scan.scan(docs).count() == 0
