"""Reputation of web hosts by empirical Bayes, with rules that go before it.

Each page with a label is an outcome: good or not. Outcomes are added up per host, registered domain and public suffix.
A suffix has a beta prior at the mean of all outcomes, a domain one at the posterior mean of its suffix, a host one at
the posterior mean of its domain; the strength of the prior is estimated at each level from the spread between the units
by the method of moments for beta-binomial counts. So a host with many pages is judged by its own, a new one by its
relatives. A page passes if the lower bound of its host's posterior (mean less ``z`` standard deviations) is at least
``least``. Rules (host, path) fit a host and its subdomains, where the page's path starts with the rule's; the longest
fitting rule decides alone.

All is counting, joins and arithmetic on columns. Pages are read for id and url only. Counts are combined in each task
before they are shuffled; the few numbers of a level are scalar subqueries; hosts are looked up with their rows dealt over
salts, so a host may hold any share of the pages. A NULL url, or one without ``://``, has an empty host and path; it is
judged like a host of its own. Several labels of one page each count as an outcome; repeated pages are rows of their own.
Without any label every host has the prior mean of one half, whose lower bound is below ``least`` = 0.5. Rules of equal length that fit one
url are impossible unless they are equal. Other columns, whatever their names, are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm.common import salted_lookup, staged, table

# Fixed values: (host, path) rules.
ALLOW = (("org", "/"), ("com", "/fr/"))
BLOCK = (("example.org", "/es/"), ("example.org", "/en/1"), ("com", "/de/"))

# Endings under which names are registered one level deeper.
TWO_PART_SUFFIXES = ("co.uk", "org.uk", "ac.uk", "com.au", "co.jp", "com.br", "co.nz", "co.in")

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _rest(url: Column) -> Column:
    """What follows the first ``://``; empty if there is none."""
    at = F.position(F.lit("://"), url)
    return F.coalesce(F.when(at > 0, F.substr(url, at + 3)), F.lit(""))


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(_rest(url), r"^[^/?#]*", 0), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def suffix_of(host: Column) -> Column:
    """The public suffix: the last label, or the last two where those are a known ending."""
    two = F.substring_index(host, ".", -2)
    return F.when(two.isin(*TWO_PART_SUFFIXES), two).otherwise(F.substring_index(host, ".", -1))


def domain_of(host: Column) -> Column:
    two = F.substring_index(host, ".", -2)
    return F.when(two.isin(*TWO_PART_SUFFIXES), F.substring_index(host, ".", -3)).otherwise(two)


def rule_for(host: Column, path: Column, allow: Sequence[tuple[str, str]], block: Sequence[tuple[str, str]]) -> Column:
    """The longest fitting rule as a struct (rule, verdict), else NULL."""
    rules = [(h, p, "allow") for h, p in allow] + [(h, p, "block") for h, p in block]
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for h, p, verdict in sorted(rules, key=lambda r: len(r[0] + r[1])):  # a longer one goes before
        fits = ((host == h) | host.endswith(f".{h}")) & path.startswith(p)
        found = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def _strength(units: DataFrame, good: str, n: str, mean: Column) -> Column:
    """Prior strength by the method of moments, within 1 and 1,000,000, as a scalar subquery.

    For beta-binomial counts k of n with mean m and strength s, sum((k - n m)^2) is expected to be
    m (1 - m) sum(n (n + s) / (s + 1)), which is solved for s.
    """
    off = F.sum((F.col(good) - F.col(n) * mean) * (F.col(good) - F.col(n) * mean))
    binomial, square = F.sum(F.col(n) * mean * (1 - mean)), F.sum(F.col(n) * F.col(n) * mean * (1 - mean))
    s = F.when(off - binomial > 0, (square - off) / (off - binomial)).otherwise(1e6)
    found = units.agg(F.least(F.greatest(s, F.lit(1.0)), F.lit(1e6)).alias("s")).scalar()
    return F.coalesce(found, F.lit(1e6))


def reputations(pages: DataFrame) -> DataFrame:
    """Posterior (alpha, beta) of each host of ``pages``, which has the columns host, k and n: good and all outcomes."""
    sums = [F.coalesce(F.sum(c), F.lit(0)).cast("double").alias(c) for c in ("k", "n")]
    hosts = pages.groupBy("host").agg(*sums)
    hosts = staged(hosts.withColumns({"domain": domain_of(F.col("host")), "suffix": suffix_of(F.col("host"))}), "hosts")
    mean = F.coalesce(hosts.agg(((F.sum("k") + 1) / (F.sum("n") + 2)).alias("m")).scalar(), F.lit(0.5))
    suffixes = staged(hosts.groupBy("suffix").agg(*sums), "suffixes")
    s0 = _strength(suffixes, "k", "n", mean)
    suffixes = suffixes.select("suffix", ((F.col("k") + s0 * mean) / (F.col("n") + s0)).alias("suffix_mean"))
    domains = staged(salted_lookup(hosts.groupBy("domain", "suffix").agg(*sums), suffixes, "suffix", "inner"), "domains")
    s1 = _strength(domains, "k", "n", F.col("suffix_mean"))
    domains = domains.select("domain", ((F.col("k") + s1 * F.col("suffix_mean")) / (F.col("n") + s1)).alias("domain_mean"))
    hosts = staged(salted_lookup(hosts, domains, "domain", "inner"), "host-priors")
    s2 = _strength(hosts, "k", "n", F.col("domain_mean"))
    return hosts.select(
        "host",
        (F.col("k") + s2 * F.col("domain_mean")).alias("alpha"),
        (F.col("n") - F.col("k") + s2 * (1 - F.col("domain_mean"))).alias("beta"),
    )


def judge(
    pages: DataFrame,
    labels: DataFrame,
    good: Column,
    id_col: str = "page_id",
    url_col: str = "url",
    label_id: str = "doc_id",
    allow: Sequence[tuple[str, str]] = ALLOW,
    block: Sequence[tuple[str, str]] = BLOCK,
    z: float = 1.645,
    least: float = 0.5,
) -> DataFrame:
    """Per page: id, host, path, rule, verdict, reputation (the lower bound of its host).

    ``good`` is the outcome as a boolean column of ``labels``; where it is NULL the label does not count.
    """
    judged = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"))
    judged = judged.select("id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    outcomes = labels.select(F.col(label_id).alias("id"), good.alias("good")).where("id IS NOT NULL AND good IS NOT NULL")
    outcomes = outcomes.groupBy("id").agg(F.sum(F.col("good").cast("long")).alias("k"), F.count("good").alias("n"))
    posterior = reputations(judged.join(outcomes, "id", "left").select("host", "k", "n"))
    a, b = F.col("alpha"), F.col("beta")
    bound = a / (a + b) - z * F.sqrt(a * b / ((a + b) * (a + b) * (a + b + 1)))
    rows = salted_lookup(judged, posterior.select("host", bound.alias("reputation")), "host")
    rows = rows.withColumn("found", rule_for(F.col("host"), F.col("path"), allow, block))
    method = F.when(F.col("reputation") >= least, "allow").otherwise("block")
    return rows.select(
        F.col("id").alias(id_col),
        "host",
        "path",
        F.col("found.rule").alias("rule"),
        F.coalesce(F.col("found.verdict"), method).alias("verdict"),
        "reputation",
    )


def op6_host_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page's label is that of the document with its number; good is quality 1 and not toxic."""
    good = (F.col("quality") == 1) & (F.col("toxic") == 0)
    found = judge(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels"), good)
    return found.select("page_id", "host", "path", "rule", "verdict", F.round("reputation", 6).alias("reputation"))


OP6_SQL = """
WITH u AS (
  SELECT page_id, coalesce(nullif(strpos(url, '://'), 0), 0) AS pos, url FROM pages
), p AS (
  SELECT page_id,
    CASE WHEN pos > 0 THEN translate(regexp_extract(substr(url, pos + 3), '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE '' END AS host,
    CASE WHEN pos > 0 THEN regexp_extract(substr(url, pos + 3), '(?s)^[^/?#]*([^?#]*)', 1) ELSE '' END AS path
  FROM u
), parts AS (SELECT DISTINCT host, string_split(host, '.') AS w FROM p
), named AS (
  SELECT host,
    array_to_string(w[greatest(1, len(w) - 1):], '.') IN ('co.uk', 'org.uk', 'ac.uk', 'com.au', 'co.jp', 'com.br', 'co.nz', 'co.in') AS deep, w
  FROM parts
), labelled AS (
  SELECT doc_id, sum(CASE WHEN quality = 1 AND toxic = 0 THEN 1 ELSE 0 END) AS k, count(*) AS n
  FROM labels WHERE quality IS NOT NULL AND toxic IS NOT NULL GROUP BY doc_id
), h AS (
  SELECT p.host,
    array_to_string(any_value(w)[greatest(1, len(any_value(w)) - CASE WHEN any_value(deep) THEN 2 ELSE 1 END):], '.') AS domain,
    array_to_string(any_value(w)[greatest(1, len(any_value(w)) - CASE WHEN any_value(deep) THEN 1 ELSE 0 END):], '.') AS suffix,
    coalesce(sum(k), 0)::DOUBLE AS k, coalesce(sum(n), 0)::DOUBLE AS n
  FROM p JOIN named USING (host) LEFT JOIN labelled ON doc_id = page_id GROUP BY p.host
), t AS (SELECT (sum(k) + 1) / (sum(n) + 2) AS m FROM h
), s AS (SELECT suffix, sum(k) AS k, sum(n) AS n, any_value(m) AS m FROM h, t GROUP BY suffix
), s0 AS (
  SELECT least(greatest(CASE WHEN sum((k - n * m) * (k - n * m)) > sum(n * m * (1 - m))
    THEN (sum(n * n * m * (1 - m)) - sum((k - n * m) * (k - n * m))) / (sum((k - n * m) * (k - n * m)) - sum(n * m * (1 - m))) ELSE 1e6 END, 1), 1e6) AS s FROM s
), sm AS (SELECT suffix, (k + s0.s * m) / (n + s0.s) AS m FROM s, s0
), d AS (SELECT domain, sum(k) AS k, sum(n) AS n, any_value(m) AS m FROM h JOIN sm USING (suffix) GROUP BY domain
), s1 AS (
  SELECT least(greatest(CASE WHEN sum((k - n * m) * (k - n * m)) > sum(n * m * (1 - m))
    THEN (sum(n * n * m * (1 - m)) - sum((k - n * m) * (k - n * m))) / (sum((k - n * m) * (k - n * m)) - sum(n * m * (1 - m))) ELSE 1e6 END, 1), 1e6) AS s FROM d
), dm AS (SELECT domain, (k + s1.s * m) / (n + s1.s) AS m FROM d, s1
), hm AS (SELECT host, k, n, m FROM h JOIN dm USING (domain)
), s2 AS (
  SELECT least(greatest(CASE WHEN sum((k - n * m) * (k - n * m)) > sum(n * m * (1 - m))
    THEN (sum(n * n * m * (1 - m)) - sum((k - n * m) * (k - n * m))) / (sum((k - n * m) * (k - n * m)) - sum(n * m * (1 - m))) ELSE 1e6 END, 1), 1e6) AS s FROM hm
), ab AS (SELECT host, k + s * m AS a, n - k + s * (1 - m) AS b FROM hm, s2
), r AS (SELECT host, a / (a + b) - 1.645 * sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))) AS reputation FROM ab
), ruled AS (
  SELECT *, CASE
    WHEN (host = 'example.org' OR host LIKE '%.example.org') AND path LIKE '/en/1%' THEN 'example.org/en/1'
    WHEN (host = 'example.org' OR host LIKE '%.example.org') AND path LIKE '/es/%' THEN 'example.org/es/'
    WHEN (host = 'com' OR host LIKE '%.com') AND path LIKE '/fr/%' THEN 'com/fr/'
    WHEN (host = 'com' OR host LIKE '%.com') AND path LIKE '/de/%' THEN 'com/de/'
    WHEN (host = 'org' OR host LIKE '%.org') AND path LIKE '/%' THEN 'org/' END AS rule
  FROM p JOIN r USING (host)
)
SELECT page_id, host, path, rule,
  CASE WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block' WHEN reputation >= 0.5 THEN 'allow' ELSE 'block' END AS verdict,
  round(reputation, 6) AS reputation
FROM ruled
"""
