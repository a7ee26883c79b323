from __future__ import annotations

import random
from collections import Counter
from itertools import combinations

import numpy as np
from llm_cases import ODD, documents  # noqa: F401
from pyspark.sql import functions as F

from tidemill.llm import jaccard
from tidemill.llm.components import connected_components


def grams(text, n=5):
    words = (text or "").encode().split()
    n = min(n, len(words))
    return frozenset(tuple(words[i : i + n]) for i in range(len(words) - n + 1)) if words else None


def plain(texts, threshold=0.8):
    """(class id, links, links between different sets, least copy) of each text by comparing all pairs."""
    sets = [grams(t) for t in texts]
    links, class_links, parent = Counter(), Counter(), list(range(len(texts)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    seen = {}
    for i, j in combinations(range(len(texts)), 2):
        a, b = sets[i], sets[j]
        if a and b and len(a & b) >= threshold * len(a | b) - 1e-9:
            links[i] += 1
            links[j] += 1
            x, y = sorted((root(i), root(j)))
            parent[y] = x
            if a != b:
                seen.setdefault(a, set()).add(b)
                seen.setdefault(b, set()).add(a)
    first = {}
    for i, s in enumerate(sets):
        if s:
            first.setdefault(s, i)
    return {
        i: (root(i), links[i], len(seen.get(s, ())) if s else 0, first[s] if s else i) for i, s in enumerate(sets)
    }


def corpus(seed=3):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(3))
    texts = []
    for _ in range(25):
        base = [word() for _ in range(rng.randint(3, 120))]
        texts.append(" ".join(base))
        for _ in range(rng.randint(0, 8)):
            copy = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 5])):
                copy[rng.randrange(len(copy))] = word()
            texts.append(" ".join(copy))
    rng.shuffle(texts)
    return texts


def result(df):
    rows = df.select("row.doc_id", "class_id", "n_links", "n_class_links", "copy_of").collect()
    return {r[0]: tuple(r)[1:] for r in rows}


def test_bands_reach_the_recall():
    bands, rows = jaccard.choose_bands(0.8, 0.995)
    assert 1 - (1 - 0.8**rows) ** bands >= 0.995 and bands * rows <= 256


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(1)
    minhash, hits, total = jaccard.MinHash(200, 1), 0, 0
    for _ in range(30):
        shared, a, b = (rng.integers(0, 2**63, n).astype(np.uint64) for n in (80, 10, 10))
        x, y = minhash.buckets(np.concatenate([shared, a])), minhash.buckets(np.concatenate([shared, b]))
        hits, total = hits + (x == y).sum(), total + 200
    assert abs(hits / total - 0.8) < 0.03


def test_against_all_pairs(spark, documents):  # noqa: F811
    texts = [*corpus(), *ODD]
    assert result(jaccard.similarity_classes(documents(texts))) == plain(texts)


def test_blocks_give_the_same(spark, documents):  # noqa: F811
    texts = corpus(8)
    docs = documents(texts)
    assert result(jaccard.similarity_classes(docs, block_words=60)) == plain(texts)


def test_one_group_with_a_third_of_all_rows(spark, documents):  # noqa: F811
    rng = random.Random(2)
    base = [f"w{i}" for i in range(80)]
    texts = [" ".join(base)] * 150 + [" ".join([*base[:k], "x", *base[k + 1 :]]) for k in range(80) for _ in range(2)]
    texts += [" ".join(f"v{rng.randrange(10**6)}" for _ in range(40)) for _ in range(300)]
    assert result(jaccard.similarity_classes(documents(texts), block_words=2_000)) == plain(texts)


def test_keeps_one_row_of_each_class(spark, documents):  # noqa: F811
    texts = corpus(5)
    docs = documents(texts).withColumn("print", F.lit(1)).withColumn("row", F.lit(2)).withColumn("at", F.lit("x"))
    kept = jaccard.keep_first_of_class(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted({v[0] for v in plain(texts).values()})


def test_null_and_repeated_ids_and_empty_table(spark, documents):  # noqa: F811
    text = "one two three four five six seven"
    docs = documents([(None, text, "en", "a"), (4, text, None, None), (4, text, None, None), (5, None, None, None), (None, "other", None, None)])
    rows = jaccard.similarity_classes(docs).select("row.doc_id", "class_id", "n_links", "first").collect()
    assert sorted((r[0] or -1, r[1] or -1, r[2], r[3]) for r in rows) == [
        (-1, -1, 0, True), (-1, 4, 2, False), (4, 4, 2, False), (4, 4, 2, True), (5, 5, 0, True)
    ]
    assert jaccard.similarity_classes(docs.limit(0)).count() == 0


def test_components_of_a_chain(spark):
    chain = spark.createDataFrame([(i // 2 + i % 2, i // 2) for i in range(24)], "bucket long, node long")
    labels = {r["node"]: r["label"] for r in connected_components(chain).collect()}
    assert labels == {i: 0 for i in range(12)}
