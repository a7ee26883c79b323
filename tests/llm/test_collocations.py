from __future__ import annotations

import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from compare import differences, oracle_connection
from conftest import SF_DIR
from llm_cases import ODD, documents  # noqa: F401
from pyspark.sql import functions as F

from tidemill.llm import collocations as co
from tidemill.llm.common import mixed

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows, least, top, percent=50):
    """The phrases of (lang, text) rows by counting everything."""
    f, total = defaultdict(Counter), Counter()
    for lang, text in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(UPPER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang or "und"] += len(words)
            for size in (1, 2, 3):
                f[lang or "und"].update(tuple(words[i : i + size]) for i in range(len(words) - size + 1))
    out = []
    for lang, counts in f.items():
        often = {g: a for g, a in counts.items() if len(g) > 1 and a >= least}
        found = []
        for gram, a in often.items():
            if any(100 * b >= percent * a for other, b in often.items() if len(other) > len(gram) and gram in (other[:2], other[1:])):
                continue
            cuts = [(1_000_000 * a * a // (counts[gram[:k]] * counts[gram[k:]]), k, counts[gram[:k]], counts[gram[k:]]) for k in range(1, len(gram))]
            score, _, left, right = min(cuts)
            found.append((-score, -a, " ".join(gram).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, total[lang], -score))
    return sorted(out)


def found(df):
    return sorted(tuple(r) for r in df.collect())


def test_query_against_sql(spark):
    assert differences(co.op12_collocations(spark, SF_DIR), oracle_connection(SF_DIR), co.OP12_SQL) == []


def test_permutation_has_an_inverse():
    x = np.random.default_rng(1).integers(0, 2**64, 100_000, np.uint64)
    x[:4] = 0, 1, 2**64 - 1, 2**63
    assert (co.unmixed(mixed(x)) == x).all() and (mixed(co.unmixed(x)) == x).all()


@pytest.mark.parametrize("bits", [0, 1, 5, 13])
@pytest.mark.parametrize("n", [0, 1, 2, 3, 64, 5000])
def test_filters_lose_nothing_and_merge(bits, n):
    rng = np.random.default_rng(n + bits)
    region = int(rng.integers(0, 1 << bits))
    draw = rng.integers(0, 2**64 - 1, n + 200, np.uint64, endpoint=True)
    if bits:
        draw = (draw >> np.uint64(bits)) | (np.uint64(region) << np.uint64(64 - bits))
    draw = np.unique(draw)
    made = []
    for _ in range(4):
        entries = np.sort(rng.choice(draw, n, replace=False)) if n else draw[:0]
        counts = rng.choice([1, 2, 254, 255, 256, 10**12], n)
        back = co.unpacked_filter(co.packed_filter(entries, counts, bits), region, bits)
        assert (back[0] == entries).all() and (back[1] == counts).all()
        made.append(back)
    entries, counts = co.merged(made)
    want = Counter()
    for e, c in made:
        want.update(dict(zip(e.tolist(), c.tolist(), strict=True)))
    assert dict(zip(entries.tolist(), counts.tolist(), strict=True)) == want and (np.diff(entries.astype(object)) > 0).all()


def made_rows():
    rng = np.random.default_rng(8)
    draw = lambda: " ".join(f"W{w}é" + rng.choice(["", "", "", ",", "!", "\n", "\t"]) for w in np.minimum(rng.zipf(1.5, 30), 25))
    rows = [(["en", "fr", None, "und"][i % 4], draw()) for i in range(200)]
    return rows + [("en", "new york city " * 40), ("en", "aa aa aa aa " * 20), ("de", "x y"), ("de", None), (None, "")]


@pytest.mark.parametrize("options", [{}, {"stretch_bytes": 300, "region": 64}, {"most_words": 9}, {"most_bytes": 60, "stretch_bytes": 500}, {"most_words": 0}])
def test_any_filters_regions_and_words_beyond_the_broadcast(spark, options):
    rows = made_rows()
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(5)
    assert found(co.collocations(spark, docs, min_count=4, top=60, **options)) == plain(rows, 4, 60)


def test_wide_products(spark):
    a, left, right = 999_999_999_999_999, 999_999_999_999_999, 1_000_000_000_000 * 999
    df = spark.createDataFrame([(a, left, right)], "a long, l long, r long")
    assert df.select(co._score(F.col("a"), F.col("l"), F.col("r"))).first()[0] == 1_000_000 * a * a // (left * right)


def test_odd_texts_and_empty_tables(spark, documents):  # noqa: F811
    docs = documents(ODD * 2).withColumn("score", F.lit(1)).withColumn("word", F.lit("x")).withColumn("n", F.lit(0))
    rows = [("en", t) for t in ODD * 2]
    assert found(co.collocations(spark, docs, min_count=2)) == plain(rows, 2, 2000)
    assert co.collocations(spark, docs.limit(0)).count() == 0
