from __future__ import annotations

import hashlib

import pytest
from compare import differences, oracle_connection
from conftest import SF_DIR
from llm_cases import ODD, documents  # noqa: F401
from pyspark.sql import functions as F

from tidemill.llm import exact_copies as ec


def plain(rows):
    """Groups of (id, text) rows by a loop; of rows with the same id and text the first stays."""
    groups = {}
    for at, (i, text) in enumerate(rows):
        groups.setdefault("".join(c for c in text or "" if c not in " \t\n\x0b\x0c\r"), []).append((-len(text or ""), i is None, i, at))
    out = []
    for body, members in groups.items():
        first = min(members)
        out += [(i, first[2], len(members), hashlib.sha256(body.encode()).hexdigest()) for _, _, i, _ in members]
    return sorted(out, key=repr)


def found(groups):
    rows = groups.withColumn("digest", F.lower(F.hex("digest"))).collect()
    assert sum(r["kept"] for r in rows) == len({r["digest"] for r in rows})
    assert all(r["id"] == r["keep_id"] for r in rows if r["kept"])
    return sorted(((r["id"], r["keep_id"], r["group_size"], r["digest"]) for r in rows), key=repr)


def test_query_against_sql(spark):
    assert differences(ec.op13_exact_dedup(spark, SF_DIR), oracle_connection(SF_DIR), ec.OP13_SQL) == []


def test_odd_texts_ties_and_repeats(spark):
    texts = [*ODD, "  ", "sametext", "s a m e t e x t", "x y", "xy"]
    rows = [*enumerate(texts), (None, "no id"), (None, "no id"), (7, "same text"), (3, "noid")]
    docs = spark.createDataFrame([(i, t, 1, "x", True) for i, t in rows], "doc_id long, text string, at int, body string, kept boolean")
    assert found(ec.exact_groups(docs)) == plain(rows)
    stay = ec.drop_exact_copies(docs)
    assert stay.columns == docs.columns and stay.count() == len({r[3] for r in plain(rows)})
    assert ec.exact_groups(docs.limit(0)).count() == 0
    named = docs.select(F.col("doc_id").cast("string").alias("name"), "text")
    assert ec.exact_groups(named, "name").where("kept").count() == stay.count()


@pytest.mark.parametrize("digest", [ec.sha256, lambda body: ec.sha256(body)[:0], lambda body: bytes([len(body) % 5])])
def test_salted_groups_and_shared_digests(spark, monkeypatch, digest):
    """One text holds a third of all rows, in very many stretches; weak digests put different texts together."""
    monkeypatch.setattr(ec, "_LEADERS", 3)
    texts = [("hot  text" if i % 3 else f"text {i % 40}") + " " * (i % 7) for i in range(600)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(40)
    groups = ec.exact_groups(docs, digest=digest, stretch_bytes=1).collect()
    want = {i: (keep, size) for i, keep, size, _ in plain(enumerate(texts))}
    assert {r["id"]: (r["keep_id"], r["group_size"]) for r in groups} == want
    assert sum(r["kept"] for r in groups) == len({t.replace(" ", "") for t in texts})
