from __future__ import annotations

import hashlib
import re

import pytest
from conftest import SF_DIR
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_cases import ODD, documents  # noqa: F401
from pyspark.sql import functions as F

from tidemill.llm import pii

PLAIN = (
    re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    re.compile(r"[0-9]([\x20-]?[0-9])+"),
    re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
)


def plain_spans(text):
    def ok(kind, m):
        digits = re.sub("[^0-9]", "", m[0])
        if kind == 1:
            return all(int(p) <= 255 for p in m[0].split("."))
        if kind == 2:
            total = sum(sum(divmod(int(d) * (1 + i % 2), 10)) for i, d in enumerate(reversed(digits)))
            return 16 <= len(digits) <= 19 and total % 10 == 0
        return kind == 0 or 8 <= len(digits) <= 15

    return [(k, *m.span()) for k, p in enumerate(PLAIN) for m in p.finditer(text) if ok(k, m)]


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="a1.0@+-% ()4é25\n", max_size=60))
def test_base_spans_are_those_of_the_patterns(text):
    assert pii.base_spans(text) == plain_spans(text)


def test_query_base_columns(spark):
    got = {r["doc_id"]: r for r in pii.op1_pii(spark, SF_DIR).collect()}
    for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect():
        spans = plain_spans(r["text"] or "")
        text = ",".join(f"{pii.KINDS[k]}:{s}:{e}" for k, s, e in spans)
        row = got[r["doc_id"]]
        assert row["base_sha256"] == hashlib.sha256(text.encode()).hexdigest()
        assert [row[f"n_{k}"] for k in pii.KINDS] == [sum(s[0] == i for s in spans) for i in range(4)]
        assert set(filter(None, text.split(","))) <= set(row["spans"].split(","))


def test_linear_on_long_runs():
    for text in ("a" * 300_000 + "@", "1" * 300_000, "1." * 150_000, "+1" * 150_000, "1 " * 150_000, "@" * 300_000):
        pii.base_spans(text)
        pii.loose_spans(text)


def test_reliabilities_tell_good_labelers_from_bad():
    # Kind 3: labelers 1, 3 and 4 agree; the fifth votes for everything.
    counts = {"3+0++" + "+12": 500, "3-0--" + "+02": 480, "3+0-+" + "+02": 20, "3-0-0" + "+01": 60}
    posterior, reliability = pii.estimate_reliabilities(counts)
    assert posterior["3+0++" + "+12"] > 0.95 and posterior["3-0--" + "+02"] < 0.05
    good, useless = reliability[3, 0], reliability[3, 4]
    assert good[0, 0] > 0.9 and good[1, 1] > 0.9
    assert abs(useless[0, 0] - useless[1, 0]) < 0.05


def test_method_adds_a_number_in_context(spark, documents):
    texts = [f"please call phone (415) 555-{1000 + i} today" for i in range(60)]
    texts += [f"contact tel +1 (212) 555-{1000 + i} now" for i in range(60)]
    texts += [f"version no 1234-{10000 + i} of it" for i in range(60)]
    found = pii.detect(documents(texts)).collect()
    added = {r["doc_id"]: [s["kind"] for s in r["added"]] for r in found}
    assert added[0] == ["phone"] and all(added[i] == [] for i in range(60, 180))


BENIGN = [
    "Please look at example.com for more", "we met at node.js and stayed", "born 1998-2004 or 2001 2002", "isbn 978-0-306-40615-7 here",
    "order number 555-123-4567 of them", "version 1234.5678.90 came out", "page 1000 2000 3000 and on", "sum 12 345 678 90 total",
]
LOOSE = {"mail jane at example.org today": "email", "write jane.d [at] example [dot] com": "email", "please call (415) 555-1000 now": "phone",
         "tel 020 7946 0958 x": "phone", "card 3782 822463 10005 ok": "card"}


def test_benign_forms_among_base_spans_only(spark, documents):  # noqa: F811
    """Nothing but strict forms tells what is personal: ordinary prose stays, loose forms with a cue are still found."""
    base = [f"mail a{i}@b.org and 10.0.0.{i} or +1 (212) 555-{1000 + i}, 4111 1111 1111 1111" for i in range(100)]
    texts = [*base, *BENIGN * 25, *LOOSE]
    found = pii.detect(documents(texts)).collect()
    added = {texts[r["doc_id"]]: [s["kind"] for s in r["added"]] for r in found if r["doc_id"] >= 100}
    assert {t: k for t, k in added.items() if t in BENIGN} == {t: [] for t in BENIGN}
    assert {t: k for t, k in added.items() if t in LOOSE} == {t: [k] for t, k in LOOSE.items()}
    clean = pii.redact(documents(texts)).where(F.col("doc_id").between(100, 100 + 25 * len(BENIGN) - 1)).collect()
    assert all(r["text"] == texts[r["doc_id"]] for r in clean) and len(clean) == 25 * len(BENIGN)


def test_odd_texts_repeats_and_foreign_columns(spark, documents):
    docs = documents([*ODD, "mail a@b.co"]).withColumn("spans", F.lit("x")).withColumn("base", F.lit(1))
    found = pii.detect(docs).collect()
    assert len(found) == len(ODD) + 1
    assert [r["doc_id"] for r in found if r["base"]] == [len(ODD)]
    assert pii.detect(docs.limit(0)).count() == 0


def test_redaction_keeps_columns(spark, documents):
    docs = documents(["write to a.b@c.org or +1 (212) 555-1234", None, ""]).withColumn("row", F.lit("kept")).withColumn("spans", F.lit(7))
    out = {r["doc_id"]: r for r in pii.redact(docs).collect()}
    assert pii.redact(docs).columns == docs.columns
    assert out[0]["text"] == "write to [EMAIL] or [PHONE]" and out[0]["n_chars"] == 27
    assert out[1]["text"] is None and out[1]["n_chars"] is None and out[2]["n_chars"] == 0 and out[0]["row"] == "kept"


@pytest.mark.parametrize("spans, text", [([(0, 0, 3), (2, 2, 5)], "[EMAIL]fg"), ([(3, 1, 2)], "a[PHONE]cdefg")])
def test_overlapping_spans_are_blotted_once(spans, text):
    assert pii._redacted("abcdefg", [{"kind": k, "start": s, "stop": e} for k, s, e in spans]) == text
