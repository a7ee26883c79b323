from __future__ import annotations

import random
import re

import numpy as np
from conftest import SF_DIR
from llm_cases import ODD, documents  # noqa: F401
from pyspark.sql import functions as F

from tidemill.llm import outliers


def plain(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    at = {}
    for i in range(len(words) - 4):
        at.setdefault(tuple(words[i : i + 5]), []).append(i)
    covered = {j for places in at.values() if len(places) > 1 for i in places for j in range(i, i + 5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    n = len(words)
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered),
            n < 10 or 100 * len(covered) > 20 * n)


COLUMNS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def test_query_base_columns(spark):
    texts = {r[0]: r[1] for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()}
    rows = outliers.op7_outliers(spark, SF_DIR).collect()
    assert {r["doc_id"]: tuple(r[c] for c in COLUMNS) for r in rows} == {i: plain(t) for i, t in texts.items()}
    assert all(not r["kept"] for r in rows if r["base_failed"])


def test_odd_texts(spark, documents):  # noqa: F811
    rng = random.Random(1)
    odd = [*ODD, "a b c d e a b c d e", "\n\na\na\n \n \n", "x y " * 9, " ".join(rng.choice("ab") for _ in range(300))]
    docs = documents([(i if i else None, t, None if i % 2 else "en", None) for i, t in enumerate(odd)])
    for name in ("kept", "group", "n_symbols", "distance", "words", "at", "_row", "_text", "a.b"):
        docs = docs.withColumn(name, F.lit(f"own {name}"))
    found = outliers.judge_quality(docs)
    rows = found.collect()
    for name in ("group", "words", "at", "_row", "_text", "a.b"):
        assert found.select(f"`{name}`").distinct().collect() == [(f"own {name}",)]
    assert found.schema["kept"].dataType.typeName() == "boolean" and found.schema["distance"].dataType.typeName() == "double"
    assert len(found.columns) == len(set(found.columns)) == len(docs.columns) - 1 - 3 + 8
    assert {r["doc_id"] or 0: tuple(r[c] for c in COLUMNS) for r in rows} == {i: plain(t) for i, t in enumerate(odd)}
    assert outliers.judge_quality(docs.limit(0)).count() == 0


def test_estimate_resists_outliers(spark):
    """A third of a group far away does not move the estimate; it is near that of the rest alone."""
    rng = np.random.default_rng(4)
    mix = rng.normal(size=(6, 6)) * 0.5 + np.eye(6) * 3
    good = rng.normal(size=(1400, 6)) @ mix
    bad = rng.normal(size=(600, 6)) * 0.3 + 40
    rows = [("g", *map(float, x)) for x in np.vstack([good, bad])]
    df = spark.createDataFrame(rows, "group string, " + ", ".join(f"{x} double" for x in outliers.STATISTICS)).repartition(4)
    e = outliers.estimate_groups(df).first()
    centre = np.array([e[f"m_{x}"] for x in outliers.STATISTICS])
    factor = np.array([[e[f"v_{i}_{j}"] if j <= i else 0.0 for j in range(6)] for i in range(6)])
    distance = (((np.vstack([good, bad]) - centre) @ factor.T) ** 2).sum(1) / e["factor"]
    true = np.cov(good.T) + np.diag([s**2 for s in outliers.STATISTICS.values()])
    want = np.einsum("ij,jk,ik->i", good - good.mean(0), np.linalg.inv(true), good - good.mean(0))
    assert np.corrcoef(distance[:1400], want)[0, 1] > 0.97
    cut = outliers.chi_squared_quantile(0.999999)
    assert (distance[:1400] <= cut).mean() > 0.99 and (distance[1400:] > cut).all()


def least_determinant(x, starts=400):
    """By many random starts, each followed by concentration steps to their end."""
    rng, n = np.random.default_rng(0), len(x)
    ridge = np.diag([s**2 for s in outliers.STATISTICS.values()])
    best = np.inf
    for _ in range(starts):
        own = rng.choice(n, 8, replace=False)
        last = np.inf
        while True:
            cov = np.cov(x[own].T, bias=True) + ridge
            det = np.linalg.slogdet(cov)[1]
            if det >= last - 1e-9 and len(own) > 8:
                break
            last = det if len(own) > 8 else np.inf
            off = x - x[own].mean(0)
            d = np.einsum("ij,jk,ik->i", off, np.linalg.inv(cov), off)
            own = np.flatnonzero(d <= np.sort(d)[-(-n // 2) - 1])
        best = min(best, last)
    return best


def test_the_least_determinant_is_found(spark):
    """Small groups with 30 to 45 % of outliers in a cluster of its own, as wide as the rest, against very many random starts."""
    rng = np.random.default_rng(9)
    groups, rows = {}, []
    for g, share in enumerate((0.0, 0.3, 0.38, 0.45)):
        mix = rng.normal(size=(6, 6)) * 0.7 + np.eye(6) * 2
        bad = int(100 * share)
        x = np.vstack([rng.normal(size=(100 - bad, 6)) @ mix, rng.normal(size=(bad, 6)) @ mix + rng.normal(size=6) * 8])
        groups[f"g{g}"] = x
        rows += [(f"g{g}", *map(float, r)) for r in x]
    df = spark.createDataFrame(rows, "group string, " + ", ".join(f"{x} double" for x in outliers.STATISTICS)).repartition(3)
    found = {r["group"]: r["logdet"] for r in outliers.minimum_determinant(df).collect()}
    for g, x in groups.items():
        assert found[g] <= least_determinant(x) + 0.4, g  # of so few rows many halves are about alike


def test_odd_documents_of_a_group_are_rejected(spark, documents):  # noqa: F811
    rng = random.Random(2)
    def text(upper=False):
        words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8))) for _ in range(rng.randint(60, 200))]
        return (" ".join(w.upper() + "!!" if upper else w for w in words)) + "."
    rows = [(i, text(i % 10 == 0), "en", "src0" if i % 3 else f"s{i % 5}") for i in range(600)]
    found = {r["doc_id"]: r["kept"] for r in outliers.judge_quality(documents(rows)).collect()}
    assert not any(found[i] for i in range(0, 600, 10))
    assert sum(found[i] for i in range(600) if i % 10) >= 0.99 * 540


def test_chi_squared_quantiles():
    # Fixed values, from tables.
    for p, want in ((0.5, 5.348), (0.975, 14.449), (0.999, 22.458)):
        assert abs(outliers.chi_squared_quantile(p) - want) < 0.05 * want


def test_plan_has_no_python(spark):
    plan = outliers.judge_quality(spark.read.parquet(f"{SF_DIR}/documents.parquet"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan
