"""Secrets in texts: fixed forms, and a battery of randomness tests on long tokens. Column functions only.

Base spans have a fixed form (assignments, access keys, hexadecimal strings) and always stay. The method looks at every
other token of at least 20 signs of the base-64 alphabets. Its encoding is inferred (hexadecimal, base 32, base 64), and

* chi-squared tests how evenly it uses the alphabet of its encoding,
* the number of runs of letters of one sort (capitals, small letters, digits, others) tests how often the sort changes,
* the serial correlation of neighbouring signs tests for order.

The first two give p-values against the hypothesis of ordinary text, whose coincidence index and rate of changes are
fixed parameters, so that a longer token can be, and must be, further from text; Stouffer's sum combines them. A token that
fails randomness itself (chi-squared or correlation beyond ``most_z``) is no secret. Among all tokens of the corpus with the same
encoding and length band, Benjamini and Hochberg's procedure at the level ``fdr`` chooses the p-value up to which tokens are
secrets, so long tokens, being rare, neither help nor hurt the short ones. For it, tokens are counted by rounded log p:
a few hundred numbers for each band, added up in Spark over the whole corpus.

A NULL or empty text has no spans. Rows are judged one by one (the level of a band is common to all), so repeated rows get
repeated results, though they count as often as they occur. Tokens with equal p are all taken or all left. Empty tables
give empty results. Columns other than id and text are not read. Texts are searched whole.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemill.llm.common import staged, table

KINDS = ("assign", "access", "hex", "random")

_ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
_ACCESS = r"AKIA[A-Z0-9]+"
_HEX = r"(?<![0-9a-f])[0-9a-f]{32,}"  # a shorter run fails whole, so only whole runs are looked at
_TOKEN = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}"
_LEAST = 20

#: Per encoding: signs, signs of the alphabet, coincidence index of ordinary text in it.
ENCODINGS = (
    ("hex", r"^(?:[0-9a-f]+|[0-9A-F]+)$", 16, 0.1),
    ("base32", r"^[A-Z2-7]+$", 32, 0.065),
    ("base64", r"^[A-Za-z0-9+/_-]+$", 64, 0.065),
)
#: How often the sort of sign changes from one sign to the next in ordinary tokens.
TEXT_CHANGES = 0.1
_STEP = 0.05  # of rounded log10 p
_MOST = 40.0


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def found_in(text: Column, pattern: str) -> Column:
    """All matches of a pattern with their places, array<struct<start, stop, token>>; places are code points."""

    def step(seen: Column, x: Column) -> Column:
        start = seen["at"] + x["gap"]
        one = F.struct(start.alias("start"), (start + x["n"]).alias("stop"), x["token"].alias("token"))
        return F.struct((start + x["n"]).alias("at"), F.concat(seen["out"], F.array(one)).alias("out"))

    def places(tokens: Column) -> Column:
        between = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(tokens))
        parts = F.zip_with(tokens, between, lambda t, b: F.struct(F.length(b).alias("gap"), F.length(t).alias("n"), t.alias("token")))
        none = F.array().cast("array<struct<start:int,stop:int,token:string>>")
        walked = F.aggregate(parts, F.struct(F.lit(0).alias("at"), none.alias("out")), step, lambda seen: seen["out"])
        return F.when(F.size(tokens) > 0, walked).otherwise(none)

    return let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), places)


def _ranked(spans: Column, kind: str) -> Column:
    return F.transform(
        spans, lambda s: F.struct(s["start"].alias("start"), s["stop"].alias("stop"), F.lit(KINDS.index(kind)).alias("rank"))
    )


def base_spans(text: Column) -> Column:
    """array<struct<start, stop, rank>> of the fixed forms, by start and kind."""
    assign = F.filter(found_in(text, _ASSIGN), lambda s: F.length(F.regexp_extract(s["token"], _ASSIGN, 2)) >= 8)
    access = F.filter(found_in(text, _ACCESS), lambda s: F.length(s["token"]) >= 16)
    return F.array_sort(F.concat(_ranked(assign, "assign"), _ranked(access, "access"), _ranked(found_in(text, _HEX), "hex")))


def upper_tail(z: Column) -> Column:
    """log10 of the normal upper tail, by the bounds' mean of Mills' ratio for z > 0 (relative error under 5 %); 0 to 0.5 below."""
    positive = F.greatest(z, F.lit(0.0))
    mills = 2 / (positive + F.sqrt(positive * positive + 8 / math.pi))
    return F.log10(mills / math.sqrt(2 * math.pi)) - positive * positive / (2 * math.log(10))


def battery(token: Column) -> Column:
    """The tests of a token: encoding (index), length, text_p (-log10, rounded) and uneven and serial (z against randomness)."""

    def tests(own: Column) -> Column:
        sign, code = own["signs"], own["codes"]
        n = F.size(sign).cast("double")
        encoding = own["encoding"]
        k = F.element_at(F.array(*[F.lit(float(e[2])) for e in ENCODINGS]), encoding + 1)
        index = F.element_at(F.array(*[F.lit(e[3]) for e in ENCODINGS]), encoding + 1)
        squares = F.aggregate(
            F.array_distinct(sign),
            F.lit(0.0),
            lambda s, c: s + F.pow(F.length(own["token"]) - F.length(F.replace(own["token"], c, F.lit(""))), F.lit(2.0)),
        )
        chi = k / n * squares - n
        far = n * (k * index - 1)
        text_z = (k - 1 + far - chi) / F.sqrt(2 * (k - 1) + 4 * far)
        sorts = F.transform(
            sign, lambda c: F.when(c.between("A", "Z"), 1).when(c.between("a", "z"), 2).when(c.between("0", "9"), 3).otherwise(4)
        )
        changes = F.aggregate(
            F.zip_with(F.slice(sorts, F.lit(2), F.size(sign)), F.slice(sorts, F.lit(1), F.size(sign) - 1), lambda a, b: (a != b).cast("int")),
            F.lit(0),
            lambda s, x: s + x,
        )
        changes_z = (changes - (n - 1) * TEXT_CHANGES) / F.sqrt((n - 1) * TEXT_CHANGES * (1 - TEXT_CHANGES))
        total = lambda xs: F.aggregate(xs, F.lit(0.0), lambda s, x: s + x)
        mean = total(code) / n
        spread = total(F.transform(code, lambda x: x * x)) - n * mean * mean
        pairs = total(F.zip_with(F.slice(code, F.lit(2), F.size(sign)), F.slice(code, F.lit(1), F.size(sign) - 1), lambda a, b: a * b))
        first, last = F.element_at(code, 1), F.element_at(code, -1)
        # sum of (a - mean)(b - mean) over neighbours
        covariance = pairs - mean * (2 * n * mean - first - last) + (n - 1) * mean * mean
        serial = F.when(spread > 0, F.sqrt(n) * covariance / spread).otherwise(1e9)
        p = -upper_tail((text_z + changes_z) / math.sqrt(2))
        return F.struct(
            encoding.alias("encoding"),
            F.size(sign).alias("n"),
            F.least(F.round(p / _STEP), F.lit(_MOST / _STEP)).cast("int").alias("p"),
            ((chi - (k - 1)) / F.sqrt(2 * (k - 1))).alias("uneven"),
            serial.alias("serial"),
        )

    def read(bare: Column) -> Column:
        encoding = F.when(bare.rlike(ENCODINGS[0][1]), 0).when(bare.rlike(ENCODINGS[1][1]), 1).otherwise(2)
        return let(
            F.struct(
                bare.alias("token"),
                encoding.alias("encoding"),
                F.split(bare, "").alias("signs"),
                F.transform(F.split(bare, ""), lambda c: F.ascii(c).cast("double")).alias("codes"),
            ),
            tests,
        )

    return let(F.regexp_replace(token, "=+", ""), read)


def _band(n: Column) -> Column:
    """Length band: half powers of two."""
    return F.floor(F.log2(n / F.lit(float(_LEAST))) * 2).cast("int")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", fdr: float = 0.01, most_z: float = 4.0) -> DataFrame:
    """Per row: id, ``base`` and ``added`` spans, arrays of (start, stop, rank); ranks are places in KINDS."""
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.select("id", base_spans(F.col("text")).alias("base"), found_in(F.col("text"), _TOKEN).alias("tokens"))
    fresh = F.filter("tokens", lambda t: ~F.exists("base", lambda b: (b["start"] < t["stop"]) & (b["stop"] > t["start"])))
    tested = F.transform(fresh, lambda t: F.struct(t["start"].alias("start"), t["stop"].alias("stop"), battery(t["token"]).alias("test")))
    rows = staged(rows.select("id", "base", F.filter(tested, lambda t: t["test"]["n"] >= _LEAST).alias("tokens")), "secrets")

    # A token that is not random itself counts among the tests with the p-value 1.
    def passes(t: Column) -> Column:
        return (t["test"]["uneven"] <= most_z) & (F.abs(t["test"]["serial"]) <= most_z)

    one = F.col("t")
    counted = (
        rows.select(F.explode("tokens").alias("t"))
        .select(one["test"]["encoding"].alias("encoding"), _band(one["test"]["n"]).alias("band"), F.when(passes(one), one["test"]["p"]).otherwise(0).alias("p"))
        .groupBy("encoding", "band", "p")
        .count()
    )
    same = Window.partitionBy("encoding", "band")
    ranked = counted.withColumns({
        "rank": F.sum("count").over(same.orderBy(F.desc("p")).rowsBetween(Window.unboundedPreceding, 0)),
        "all": F.sum("count").over(same),
    })
    # Rounded p-values count as the largest that round to them.
    holds = (F.col("p") > 0) & (F.pow(F.lit(10.0), -(F.col("p") - 0.5) * _STEP) <= fdr * F.col("rank") / F.col("all"))
    cuts = ranked.where(holds).groupBy("encoding", "band").agg(F.min("p").alias("cut"))
    key = F.concat_ws("/", F.col("encoding").cast("string"), F.col("band").cast("string"))
    levels = cuts.agg(F.map_from_entries(F.collect_list(F.struct(key.alias("key"), "cut"))).alias("cuts")).scalar()

    def random(t: Column, cuts: Column) -> Column:
        own = F.concat_ws("/", t["test"]["encoding"].cast("string"), _band(t["test"]["n"]).cast("string"))
        return passes(t) & (t["test"]["p"] >= F.coalesce(F.try_element_at(cuts, own), F.lit(1_000_000)))

    rows = rows.withColumn("cuts", levels)
    added = F.filter("tokens", lambda t: random(t, F.col("cuts")))
    return rows.select(F.col("id").alias(id_col), "base", _ranked(added, "random").alias("added"))


def spans_text(spans: Column) -> Column:
    """``kind:start:end``, comma-joined, by start and kind."""
    names = F.array(*[F.lit(k) for k in KINDS])
    one = lambda s: F.concat_ws(":", F.element_at(names, s["rank"] + 1), s["start"].cast("string"), s["stop"].cast("string"))
    return F.array_join(F.transform(F.array_sort(spans), one), ",")


def _of_kind(kind: str) -> Column:
    return F.size(F.filter("base", lambda s: s["rank"] == KINDS.index(kind))).cast("long")


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        *[_of_kind(k).alias(f"n_{k}") for k in KINDS[:3]],
        F.sha2(spans_text(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        spans_text(F.concat("base", "added")).alias("spans"),
        F.size("added").cast("long").alias("n_random"),
    )
