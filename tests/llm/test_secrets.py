from __future__ import annotations

import base64
import hashlib
import random
import re

from conftest import SF_DIR
from llm_cases import ODD, documents, tables  # noqa: F401
from pyspark.sql import functions as F

from tidemill.llm import secrets

NAMES = "password|passwd|secret|token|api_?key"
ANY_CASE = "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in NAMES)
ASSIGN = re.compile(rf"""({ANY_CASE})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def plain(text):
    text = text or ""
    spans = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(spans)


def check(rows, texts):
    for r in rows:
        spans = plain(texts[r["doc_id"]])
        text = [f"{secrets.KINDS[k]}:{s}:{e}" for s, k, e in spans]
        assert r["base_sha256"] == hashlib.sha256(",".join(text).encode()).hexdigest(), r
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == [sum(s[1] == k for s in spans) for k in range(3)]
        assert set(text) <= set(r["spans"].split(","))


def test_query_base_columns(spark):
    texts = {r[0]: r[1] for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()}
    check(secrets.op3_secrets(spark, SF_DIR).collect(), texts)


def test_made_up_and_odd_texts(spark, documents, tables):  # noqa: F811
    rng = random.Random(3)
    bits = ["password", "PassWD", "api_key", "APIKEY", "token", "secret", "=", ":", " ", '"', "'", "abc", "12345678", "AKIA", "ABCD1234",
            "AKIAAKIA12345678", "deadbeef" * 4, "0f" * 15, "é", "\U0001f600", "\n", "\u017fecret", "x=y/z+w_v.u-t", "="]
    texts = [*ODD, *("".join(rng.choice(bits) for _ in range(rng.randint(1, 25))) for _ in range(500))]
    docs = documents(texts).withColumn("base", F.lit(1)).withColumn("tokens", F.lit(1)).withColumn("cuts", F.lit(1))
    check(secrets.op3_secrets(spark, tables(documents=docs)).collect(), dict(enumerate(texts)))
    assert secrets.scan(docs.limit(0)).count() == 0


def test_random_tokens_are_told_from_text(spark, documents):  # noqa: F811
    rng = random.Random(9)
    key = lambda: base64.b64encode(rng.randbytes(30)).decode()
    name = lambda: "_".join(rng.choice(["the", "configuration", "reader", "module", "value", "service", "handler"]) for _ in range(4))
    texts = [f"text with {key()} in it" if i % 4 == 0 else f"call {name()} and {'ab' * 15} or {'A' * 30} then" for i in range(400)]
    found = {r["doc_id"]: len(r["added"]) for r in secrets.scan(documents(texts)).collect()}
    assert sum(found[i] for i in range(0, 400, 4)) >= 95
    assert sum(found[i] for i in range(400) if i % 4) <= 2


def test_battery_figures(spark):
    tokens = ["Zm9vYmFyYmF6cXV4MTIzNDU2", "aaaaaaaaaaaaaaaaaaaaaaaa", "0123456789abcdef01234567", "ABCDEFGHABCDEFGH234567AA"]
    rows = spark.createDataFrame([(t,) for t in tokens], "t string").select("t", secrets.battery(F.col("t")).alias("x")).collect()
    for r in rows:
        codes = [ord(c) for c in r["t"]]
        n, mean = len(codes), sum(codes) / len(codes)
        k = {0: 16, 1: 32, 2: 64}[r["x"]["encoding"]]
        chi = k / n * sum(r["t"].count(c) ** 2 for c in set(r["t"])) - n
        assert abs(r["x"]["uneven"] - (chi - k + 1) / (2 * (k - 1)) ** 0.5) < 1e-9
        spread = sum((c - mean) ** 2 for c in codes)
        if spread:
            serial = n**0.5 * sum((a - mean) * (b - mean) for a, b in zip(codes, codes[1:], strict=False)) / spread
            assert abs(r["x"]["serial"] - serial) < 1e-9
    assert [r["x"]["encoding"] for r in rows] == [2, 0, 0, 1]


def test_tail_of_the_normal(spark):
    from statistics import NormalDist

    import math

    zs = [0.0, 0.5, 1.0, 2.0, 3.0, 5.0, 7.0]
    got = spark.createDataFrame([(z,) for z in zs], "z double").select(secrets.upper_tail(F.col("z"))).collect()
    for z, g in zip(zs, got, strict=True):
        assert abs(g[0] - math.log10(NormalDist().cdf(-z))) < 0.03


def test_plan_has_no_python(spark):
    plan = secrets.scan(spark.read.parquet(f"{SF_DIR}/documents.parquet"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan
