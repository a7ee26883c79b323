from __future__ import annotations

import math
import random

import numpy as np
import pytest
from llm_cases import ODD, documents  # noqa: F401
from pyspark.sql import functions as F

from tidemill.llm import toxicity
from tidemill.llm.toxicity import Chain, form_of, words_of

def categories():
    return {"low_quality": 1 - F.col("quality"), "toxic": F.col("toxic")}


def test_held_out_accuracy(spark):
    """Learned on the labels of odd ids, compared on those of even ids."""
    folder = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    chain = toxicity.train_chain(docs, labels.where("doc_id % 2 = 1"), categories())
    rest = docs.join(labels.where("doc_id % 2 = 0"), "doc_id").select("toxic", toxicity.score(spark, F.col("text"), chain)[1].alias("p"))
    rows = rest.collect()
    wrong = sum(r["p"] >= chain.cuts[1] for r in rows if not r["toxic"]) / sum(not r["toxic"] for r in rows)
    right = sum(r["p"] >= chain.cuts[1] for r in rows if r["toxic"]) / sum(r["toxic"] for r in rows)
    assert right > 0.8 and wrong < 0.01


def test_later_categories_use_earlier_ones():
    """The second category is the first one; its own words are noise, so the chain must pass the first one on."""
    rng = random.Random(1)
    texts = [" ".join([rng.choice("abcdefgh") for _ in range(6)] + (["mark"] if i % 3 == 0 else ["plain"])) for i in range(900)]
    y = np.array([[i % 3 == 0, (i % 3 == 0) != (rng.random() < 0.05)] for i in range(900)], int)
    chain = Chain.fit(["one", "two"], [sorted(words_of(t)) for t in texts], np.array([form_of(t) for t in texts]), y)
    p = chain.predict(["a b c d e f mark", "a b c d e f plain", None, ""])
    assert p[0, 0] > 0.9 and p[1, 0] < 0.1 and p[0, 1] > 0.8 and p[1, 1] < 0.2
    assert len(chain.models[1].dense) == len(chain.models[0].dense) + 1 and chain.models[1].dense[-1] > 0


def test_odd_texts_and_labels(spark, documents):  # noqa: F811
    docs = documents([*ODD, "you idiot", "you idiot"]).withColumn("p", F.lit(1)).withColumn("y0", F.lit(1)).withColumn("toxic", F.lit("x"))
    schema = "doc_id long, quality int, toxic int"
    none = spark.createDataFrame([], schema)
    one = spark.createDataFrame([(5, 1, 0), (5, 1, 1), (6, None, 1), (None, 1, 1), (9, 0, 1), (77, 1, 1)], schema)
    for labels in (none, one):
        chain = toxicity.train_chain(docs, labels, categories())
        rows = docs.select("doc_id", toxicity.score(spark, F.col("text"), chain).alias("s")).collect()
        assert len(rows) == len(ODD) + 2 and all(len(r["s"]) == 2 and 0 < min(r["s"]) <= max(r["s"]) < 1 for r in rows)
    assert toxicity.train_chain(docs.limit(0), one, categories()).cuts == [0.5, 0.5]


def test_cut_has_the_best_f1():
    assert toxicity.best_cut(np.array([0.9, 0.8, 0.3, 0.2]), np.array([1, 1, 0, 0])) == (0.8 + 0.3) / 2
    assert toxicity.best_cut(np.array([0.9]), np.array([1])) == 0.5


def plain_chain(chain, text):
    """Probabilities of the categories, one after the other, by loops over the words."""
    x = [(v - c) / s for v, c, s in zip(form_of(text), chain.centre, chain.scale, strict=True)]
    out = []
    for model in chain.models:
        logit = model.bias + sum(a * b for a, b in zip(x, model.dense, strict=True)) + sum(w for word, w in model.words.items() if word in words_of(text))
        out.append(1 / (1 + math.exp(-logit)))
        p = min(max(out[-1], 1e-4), 1 - 1e-4)
        x = [*x, math.log(p / (1 - p))]
    return out


def test_query_against_loops(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text"), spark.read.parquet(f"{folder}/labels.parquet")
    chain = toxicity.train_chain(docs, labels, categories())
    got = {r["doc_id"]: r for r in toxicity.op5_toxicity(spark, folder).collect()}
    texts = docs.collect()
    assert len(got) == len(texts)
    for r in texts:
        p, row = plain_chain(chain, r["text"]), got[r["doc_id"]]
        assert (row["p_low_quality"], row["p_toxic"]) == pytest.approx(tuple(p), rel=1e-6, abs=1e-9)
        assert row["toxic"] == (row["p_toxic"] >= chain.cuts[1])


def test_rows_of_one_id_are_bounded(spark, documents):  # noqa: F811
    docs = documents([(i % 2, f"words of text {i}", "en", "a") for i in range(300)])
    labels = spark.createDataFrame([(0, 1, 0), (1, 0, 1)], "doc_id long, quality int, toxic int")
    few = toxicity.train_chain(docs, labels, categories(), most_rows=20)
    assert few.centre.shape == toxicity.train_chain(docs.repartition(7), labels, categories(), most_rows=20).centre.shape
    assert np.allclose(few.centre, toxicity.train_chain(docs.repartition(7), labels, categories(), most_rows=20).centre)
