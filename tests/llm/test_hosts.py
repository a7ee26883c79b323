from __future__ import annotations

import pytest
from compare import differences, oracle_connection
from pyspark.sql import functions as F

from tidemill.llm import hosts

def good():
    return (F.col("quality") == 1) & (F.col("toxic") == 0)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_against_sql(spark, sf):
    folder = f"/root/testdata/{sf}"
    assert differences(hosts.op6_host_reputation(spark, folder), oracle_connection(folder), hosts.OP6_SQL) == []


def test_urls_and_rules(spark):
    cases = {
        None: ("", "", None),
        "": ("", "", None),
        "no scheme/x": ("", "", None),
        "http://A.Example.ORG/es/1?q": ("a.example.org", "/es/1", "example.org/es/"),
        "http://example.org/en/17#t": ("example.org", "/en/17", "example.org/en/1"),
        "http://example.org/en/27": ("example.org", "/en/27", "org/"),
        "http://notexample.org/es/": ("notexample.org", "/es/", "org/"),
        "http://example.org?x=/es/": ("example.org", "", None),
        "x://com/fr/a": ("com", "/fr/a", "com/fr/"),
        "http://a.com/de/http://b.org/": ("a.com", "/de/http://b.org/", "com/de/"),
        "http://dotcom/fr/": ("dotcom", "/fr/", None),
        "http://h.net/" + "p" * 100_000: ("h.net", "/" + "p" * 100_000, None),
        "http://É.Net/": ("É.net", "/", None),
    }
    pages = spark.createDataFrame([(i, u, 1) for i, u in enumerate(cases)], "page_id long, url string, n long")
    pages = pages.withColumn("good", F.lit("x")).withColumn("host", F.lit("y"))
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    rows = hosts.judge(pages, labels, good()).orderBy("page_id").collect()
    assert [(r["host"], r["path"], r["rule"]) for r in rows] == list(cases.values())
    assert {r["verdict"] for r in rows if r["rule"] in ("org/", "com/fr/")} == {"allow"}
    assert {r["verdict"] for r in rows if r["rule"] and "es" in r["rule"].split("/")} == {"block"}
    assert hosts.judge(pages.limit(0), labels, good()).count() == 0


def test_suffix_and_domain(spark):
    rows = spark.createDataFrame([("a.b.example.co.uk",), ("x.y.net",), ("net",), ("",), ("co.uk",)], "h string")
    got = rows.select(hosts.domain_of(F.col("h")), hosts.suffix_of(F.col("h"))).collect()
    assert [tuple(r) for r in got] == [("example.co.uk", "co.uk"), ("y.net", "net"), ("net", "net"), ("", ""), ("co.uk", "co.uk")]


def test_shrinkage(spark):
    """A bad host of a good domain is blocked by its own outcomes; a new host goes with its relatives."""
    pages, labels = [], []
    for i in range(1200):
        bad = i % 4 == 0
        host = "bad.one.net" if bad else f"h{i % 7}.good{i % 5}.net"
        pages.append((i, f"http://{host}/{i}"))
        labels.append((i, 0 if bad and i % 40 else 1, 0))
    pages += [(5000, "http://new.good1.net/"), (5001, "http://other.one.net/"), (5001, "http://other.one.net/"), (None, "http://h1.good1.net/")]
    labels += [(5000, None, 0), (None, 1, 0)]
    rows = hosts.judge(spark.createDataFrame(pages, "page_id long, url string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), good())
    verdicts = {}
    for r in rows.collect():
        verdicts.setdefault(r["host"], set()).add(r["verdict"])
    assert rows.count() == len(pages) and all(len(v) == 1 for v in verdicts.values())
    assert verdicts["bad.one.net"] == {"block"} and verdicts["other.one.net"] == {"block"}
    assert verdicts["new.good1.net"] == {"allow"} and verdicts["h1.good1.net"] == {"allow"}
