from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pytest
from compare import differences, oracle_connection
from conftest import SF_DIR
from llm_cases import ODD, documents  # noqa: F401
from pyspark.sql import functions as F

from tidemill.llm import lexical as lx

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return TERM.findall((text or "").translate(UPPER))


def plain(docs, queries, k):
    """The first k (rank, id, score) of each query by scoring every document."""
    counts = [(i, Counter(words(t))) for i, t in docs]
    n = sum(1 for _, c in counts if c)
    total = sum(c.total() for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item, text in queries:
        scores = []
        for place, (i, c) in enumerate(counts):
            score = sum(lx.weight(n, df[t]) * lx.impact(c[t], lx.length_norm(c.total(), n, total)) for t in set(words(text)) if c[t])
            if score:
                scores.append((-score, i is None, i, place))
        out += [(item, rank, i, -low) for rank, (low, _, i, _) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=repr)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_query_against_sql(spark):
    assert differences(lx.op11_ranked_search(spark, SF_DIR), oracle_connection(SF_DIR), lx.OP11_SQL) == []


def test_words_are_those_of_the_pattern():
    for text in [*ODD, "Ünï-cödé ÀB zA9_0 x\x7fy {|} 　 a b"]:
        assert [w.decode() for w in lx.terms(text)] == words(text)


@pytest.mark.parametrize("small", [False, True])
def test_any_blocks_and_seeds_against_scoring_all(spark, small):
    """Copies, so that many scores are equal at the limit; small blocks, a first part and several blocks of queries."""
    rng = np.random.default_rng(5)
    made = [" ".join(f"w{w}" for w in np.minimum(rng.zipf(1.4, rng.integers(0, 40)), 60)) for _ in range(120)]
    docs = [(i, made[i % 120] if i % 3 else "w1 w2 copy") for i in range(600)] + [(None, "w1 w2 copy"), (5, "w1 w2 copy")]
    queries = [(i, f"w{i} w1 w{i + 2}, W7 copy") for i in range(12)] + [(3, "nothing"), (4, ""), (None, "w9"), (6, None), (7, "w1 w1")]
    options = {"seed_docs": 60, "block_docs": 37, "block_postings": 200, "block_chars": 60} if small else {}
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3).orderBy(F.asc_nulls_last("doc_id"))
    asked = spark.createDataFrame(queries, "item_id long, text string")
    assert found(lx.ranked_search(spark, frame, asked, 20, **options)) == plain(sorted(docs, key=lambda d: (d[0] is None, d[0] or 0)), queries, 20)


def test_reading_ends_early_and_is_exact():
    """Of a block with one far better document, the lists are not read to their ends."""
    import pyarrow as pa

    n = 5000
    tf = [[50] if i == 7 else [1] for i in range(n)]
    rows = pa.table({"length": pa.array([50] * n), "places": pa.array([[0]] * n, pa.list_(pa.int32())), "tf": pa.array(tf, pa.list_(pa.int32()))})
    block = lx._Block(rows, np.array([900]), n, 50 * n)
    docs, scores = block.search(np.array([0]), 1, 0)
    assert docs.tolist() == [7] and scores.tolist() == [900 * lx.impact(50, lx.length_norm(50, n, 50 * n))]
    docs, scores = block.search(np.array([0]), 2, 0)
    assert len(docs) == n  # all the others are ties


def test_odd_texts_and_empty_tables(spark, documents):  # noqa: F811
    docs = documents(ODD).withColumn("score", F.lit(1)).withColumn("at", F.lit("x"))
    asked = spark.createDataFrame([("q", "same word"), ("r", "é 12"), (None, None)], "item_id string, text string")
    assert found(lx.ranked_search(spark, docs, asked)) == plain(list(enumerate(ODD)), [("q", "same word"), ("r", "é 12")], 50)
    assert lx.ranked_search(spark, docs.limit(0), asked).count() == 0
    assert lx.ranked_search(spark, docs, asked.limit(0)).count() == 0
