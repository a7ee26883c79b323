from __future__ import annotations

import math
import zlib
from collections import Counter

import numpy as np
from conftest import SF_DIR
from llm_cases import ODD, documents  # noqa: F401
from pyspark.sql import functions as F

from tidemill.llm import bloom_lm as lm

END = b" "


def tokens(text):
    return (text or "").encode().lower().split() + [END]


def held_out(i):
    return zlib.crc32(str(i).encode()) % 7 == 2


def test_query_against_counting(spark):
    texts = {r[0]: r[1] for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()}
    counts = Counter(w for i, t in texts.items() if not held_out(i) for w in tokens(t))
    total, distinct = counts.total(), len(counts)
    rows = lm.op10_bloom_lm(spark, SF_DIR).collect()
    assert len(rows) == len(texts)
    for r in rows:
        own = tokens(texts[r["doc_id"]])
        assert (r["held_out"], r["n_tokens"], r["train_tokens"]) == (held_out(r["doc_id"]), len(own), total)
        assert r["n_known"] == sum(counts[w] > 0 for w in own)
        assert math.isclose(r["base_score"], sum(math.log10((counts[w] + 1) / (total + distinct + 1)) for w in own), rel_tol=1e-9)
    unseen = [r for r in rows if r["held_out"]]
    assert sum(r["score"] for r in unseen) > sum(r["base_score"] for r in unseen)  # it predicts new texts better


def test_rare_words_are_joined(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    train = F.col("doc_id") % 3 != 0
    columns = ("doc_id", "n_known", F.round("base_score", 6), F.round("score", 6))
    few = lm.score_texts(spark, docs, train, most_head=20).select(*columns).collect()
    assert sorted(few) == sorted(lm.score_texts(spark, docs, train).select(*columns).collect())


def test_levels_never_fall_and_rarely_rise(spark):
    rng = np.random.default_rng(3)
    grams = rng.integers(-(2**63), 2**63, 20_000)
    n = np.minimum(rng.zipf(1.6, 20_000), 10**6)
    counts = spark.createDataFrame([(int(g), int(c)) for g, c in zip(grams, n, strict=True)], "gram long, n long")
    packed = lm.build_filter(counts, int(n.sum()), bits_per_token=16 * 30_000 / n.sum())
    level, true = lm.levels_of(packed, grams.view(np.uint64)), np.floor(np.log2(n)).astype(int) + 1
    assert (level >= true).all() and (level == true).mean() > 0.98
    absent = lm.levels_of(packed, rng.integers(-(2**63), 2**63, 20_000).view(np.uint64))
    assert (absent > 0).mean() < 0.02


def test_filter_is_bounded(spark):
    counts = spark.createDataFrame([(i, 1) for i in range(100)], "gram long, n long")
    assert lm.build_filter(counts, 10**12, most_bytes=1 << 20).nbytes == 1 << 20


def test_formula_with_exact_levels(spark, documents):  # noqa: F811
    texts = ["a b a b", "a c", "b"]
    scored = lm.score_texts(spark, documents(texts), F.lit(True), bits_per_token=10_000, prior=2.0).orderBy("doc_id").collect()
    single = Counter(w for t in texts for w in tokens(t))
    pair = Counter(p for t in texts for p in zip([END, *tokens(t)[:-1]], tokens(t), strict=True))
    middle = lambda c: 0.0 if not c else 1.5 * 2.0 ** math.floor(math.log2(c)) - 0.5
    n, v = single.total(), len(single)
    for r, t in zip(scored, texts, strict=True):
        want = 0.0
        for a, b in zip([END, *tokens(t)[:-1]], tokens(t), strict=True):
            context = middle(single[a])
            want += math.log10((min(middle(pair[a, b]), context) + 2 * (middle(single[b]) + 1) / (n + v + 1)) / (context + 2))
        assert math.isclose(r["score"], want, rel_tol=1e-9)


def test_odd_texts(spark, documents):  # noqa: F811
    docs = documents(ODD).withColumn("score", F.lit(1)).withColumn("at", F.lit(1))
    rows = lm.score_texts(spark, docs, F.lit(True)).orderBy("doc_id").collect()
    assert [r["n_tokens"] for r in rows] == [len(tokens(t)) for t in ODD]
    assert all(r["n_known"] == r["n_tokens"] and math.isfinite(r["score"]) for r in rows)
    none = lm.score_texts(spark, docs, F.lit(False)).collect()
    assert len(none) == len(ODD) and all(r["n_known"] == 0 and r["train_tokens"] == 0 and r["base_score"] == 0 for r in none)
    assert lm.score_texts(spark, docs.limit(0), F.lit(True)).count() == 0


def test_error_rate_at_the_defaults_of_the_query(spark):
    docs = spark.read.parquet(f"{SF_DIR.replace('0.001', '0.01')}/documents.parquet").select("doc_id", "text")
    own = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(7)) == 2
    counts = lm.ngram_counts(docs.where(~own), (1, 2))
    found = counts.toPandas()
    grams, true = found["gram"].to_numpy().view(np.uint64), np.floor(np.log2(found["n"].to_numpy())).astype(int) + 1
    for stretches in (1, 5):
        packed = lm.collected(lm.filter_parts(counts, stretches), stretches)
        level = packed.levels(grams)
        assert (level >= true).all() and (level > true).mean() < 0.01
        absent = np.random.default_rng(1).integers(0, 2**64, 200_000, np.uint64)
        assert 0 < (packed.levels(absent) > 0).mean() < 0.01
    # The scores of held-out texts, next to those from a filter that hardly errs.
    scores = [lm.score_texts(spark, docs, ~own, **o).where(own).agg(F.sum("score") / F.sum("n_tokens")).first()[0] for o in ({}, {"bits_per_token": 400.0})]
    assert abs(scores[0] - scores[1]) < 0.03


def test_filter_in_stretches_gives_the_same_scores(spark, monkeypatch, documents):  # noqa: F811
    monkeypatch.setattr(lm, "_STRETCH_TOKENS", 5_000)
    monkeypatch.setattr(lm, "_RUN_CHARS", 100_000)
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    for frame, train in ((docs, F.col("doc_id") % 3 != 0), (documents(ODD), F.lit(True)), (documents(ODD), F.lit(False)), (docs.limit(0), F.lit(True))):
        order = [F.col(c) for c in ("doc_id", "n_tokens", "n_known", "train_tokens")] + [F.round(c, 6) for c in ("base_score", "score")]
        whole, parted = (sorted(lm.score_texts(spark, frame, train, **o).select(*order).collect()) for o in ({}, {"most_bytes": -1}))
        assert whole == parted
