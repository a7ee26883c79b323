"""Quality rules: plain counts, and robust multivariate outliers by the minimum covariance determinant. Column functions only.

Six statistics of a text are transformed to be about normal: log words, log word length, and the logs of the shares of
signs, distinct words, capitals and punctuation. For each language and source the estimate is the mean and covariance of that half of the rows whose covariance has the least
determinant. It is approached from six starts, all of which outliers hardly move: medians and median deviations, with the
correlations of five transforms of the standardised statistics (``_starts``). A concentration step takes the half of the rows
that lies nearest and estimates anew from it, which never raises the determinant. After two steps from every start the two starts
with the least determinants go on until it falls by less than 0.0001 (logarithm), and the lower one stands. Outliers, up to half the rows, have no say.
The estimate is made consistent (median distance against that of chi-squared), refined once with the rows within its
97.5 % ellipsoid, and texts beyond the ``level`` quantile of chi-squared in Mahalanobis distance are rejected. The small groups
of a language, of fewer than ``least_rows`` rows, are one group, and so are all those of small languages.

Statistics are computed once and written to the shared folder; the steps read these few numbers only. All sums over a
group are combined in each task before they are shuffled, and group estimates are looked up with the rows of a group dealt
over salts, so one group may hold any share of the rows. The half is cut at an approximate quantile (relative rank error
1/10,000). A least spread of each statistic is added to the covariance, so one that is constant in a group does not turn
small differences into outliers.

A NULL text has no words. Texts that fail the plain rules are neither learned from nor judged further. NULL languages
and sources are groups of their own. Rows are judged one by one and learned from as often as they occur; rows at equal
distance are all kept or all rejected. Empty tables give empty results. Of the columns only text, language and source are read;
the others are carried, and one that has the name of a result is replaced by it.
"""

from __future__ import annotations

import math
from statistics import NormalDist

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemill.llm.common import salted_lookup, staged, table

_BLANK = r"[\x20\x09-\x0D]+"
_WINDOW = 5
_FEW = 1000

#: Statistics and their least spread (standard deviation).
STATISTICS = {"words": 0.5, "length": 0.1, "signs": 0.3, "distinct": 0.15, "capitals": 0.3, "points": 0.3}
_D = len(STATISTICS)
_X = tuple(STATISTICS)
_PAIRS = [(i, j) for i in range(_D) for j in range(i + 1)]


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def repeated_words(words: Column, width: int = _WINDOW) -> Column:
    """Number of words in windows of ``width`` words that occur twice or more.

    Only texts with a repeated window are sorted: windows by hash, to find the equal ones, then these by place, where
    each covers as many words as lie before the next one, ``width`` at most.
    """

    def of(w: Column) -> Column:
        def windows(h: Column) -> Column:
            places = F.sequence(F.lit(0), F.size(h) - width)
            return F.transform(places, lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(width)]))

        def covered(own: Column) -> Column:
            def equal(s: Column) -> Column:
                same = lambda x, i: F.coalesce(F.get(s, i - 1)["h"] == x["h"], F.lit(False)) | F.coalesce(F.get(s, i + 1)["h"] == x["h"], F.lit(False))
                return F.array_sort(F.transform(F.filter(s, same), lambda x: x["i"]))

            def total(at: Column) -> Column:
                steps = F.zip_with(F.slice(at, F.lit(2), F.size(at)), F.slice(at, F.lit(1), F.size(at) - 1), lambda b, a: F.least(b - a, F.lit(width)))
                return F.aggregate(steps, F.lit(width), lambda s, x: s + x)

            marked = F.array_sort(F.transform(own, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
            return let(let(marked, equal), total)

        return let(
            let(F.transform(w, lambda x: F.xxhash64(x)), windows),
            lambda own: F.when(F.size(F.array_distinct(own)) == F.size(own), 0).otherwise(covered(own)),
        )

    return F.when(F.size(words) < width + 1, 0).otherwise(let(words, of)).cast("long")


def _without(text: Column, signs: str) -> Column:
    return F.length(text) - F.length(F.translate(text, signs, ""))


def text_counts(docs: DataFrame, text_col: str) -> DataFrame:
    """``docs`` with the counts n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and further ones for the statistics."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    words = F.filter(F.split(text, _BLANK), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))

    def of_words(w: Column) -> Column:
        return F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.size(F.array_distinct(w)).cast("long").alias("n_distinct"),
            repeated_words(w).alias("n_repeat_words"),
        )

    counts = docs.select(
        *docs.columns,
        let(words, of_words).alias("_w"),
        F.length(F.regexp_replace(text, _BLANK, "")).cast("long").alias("word_chars"),
        _without(text, "#*$%&|<>").cast("long").alias("n_symbols"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        (F.length(text) - F.length(F.regexp_replace(text, r"\p{Lu}+", ""))).alias("_capitals"),
        _without(text, ".,;:!?").alias("_points"),
    )
    return counts.select("*", "_w.*").drop("_w")


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def with_statistics(counts: DataFrame) -> DataFrame:
    n = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    chars = F.greatest(F.col("word_chars"), F.lit(1)).cast("double")
    return counts.withColumns({
        "words": F.log(n),
        "length": F.log(chars / n),
        "signs": F.log(F.col("n_symbols") / n + 0.05),
        "distinct": F.log(F.greatest(F.col("n_distinct"), F.lit(1)) / n),
        "capitals": F.log(F.col("_capitals") / chars + 0.02),
        "points": F.log(F.col("_points") / n + 0.05),
    })


def chi_squared_quantile(p: float, d: int = _D) -> float:
    """By Wilson and Hilferty."""
    c = 2 / (9 * d)
    return d * (1 - c + NormalDist().inv_cdf(p) * math.sqrt(c)) ** 3


def _factors(out: DataFrame) -> DataFrame:
    """With the inverse of the Cholesky factor of the covariances ``c_i_j``, each step a set of columns, and ``logdet``."""
    for j in range(_D):
        for i in range(j, _D):
            rest = F.col(f"c_{i}_{j}")
            for k in range(j):
                rest = rest - F.col(f"l_{i}_{k}") * F.col(f"l_{j}_{k}")
            out = out.withColumn(f"l_{i}_{j}", F.sqrt(rest) if i == j else rest / F.col(f"l_{j}_{j}"))
    for j in range(_D):
        for i in range(j, _D):
            if i == j:
                value = 1 / F.col(f"l_{i}_{i}")
            else:
                value = F.lit(0.0)
                for k in range(j, i):
                    value = value - F.col(f"l_{i}_{k}") * F.col(f"v_{k}_{j}")
                value = value / F.col(f"l_{i}_{i}")
            out = out.withColumn(f"v_{i}_{j}", value)
    logdet = sum((2 * F.log(f"l_{i}_{i}") for i in range(_D)), F.lit(0.0))
    return out.withColumn("logdet", logdet)


_FACTORS = tuple(f"v_{i}_{j}" for i, j in _PAIRS)


def _estimate(rows: DataFrame, key: str = "group") -> DataFrame:
    """Of each group the mean, the inverse factor of the covariance and the logarithm of its determinant."""
    sums = [F.avg(x).alias(f"m_{x}") for x in _X]
    sums += [(F.covar_pop(_X[i], _X[j]) + (STATISTICS[_X[i]] ** 2 if i == j else 0.0)).alias(f"c_{i}_{j}") for i, j in _PAIRS]
    out = _factors(rows.groupBy(key).agg(*sums))
    return staged(out.select(key, *[f"m_{x}" for x in _X], *_FACTORS, "logdet"), "mcd")


def _squared(of: dict[str, Column]) -> Column:
    """Squared length of the inverse factor times the values of the statistics."""
    total = F.lit(0.0)
    for i in range(_D):
        y = F.lit(0.0)
        for j in range(i + 1):
            y = y + F.col(f"v_{i}_{j}") * of[_X[j]]
        total = total + y * y
    return total


def _lookup(rows: DataFrame, of_groups: DataFrame, key: str, few: bool) -> DataFrame:
    """Join of what is known of each group; broadcast if there are at most ``_FEW`` groups, by count (a few MB), else salted."""
    return rows.join(F.broadcast(of_groups), key) if few else salted_lookup(rows, of_groups, key, "inner")


def _with_distance(rows: DataFrame, estimate: DataFrame, key: str = "group", few: bool = False) -> DataFrame:
    """The rows with their squared Mahalanobis distance."""
    joined = _lookup(rows, estimate.drop("logdet"), key, few)
    distance = _squared({x: F.col(x) - F.col(f"m_{x}") for x in _X})
    return joined.select(*rows.columns, distance.alias("distance"))


def _quantile(rows: DataFrame, share: float, key: str = "group") -> DataFrame:
    return staged(rows.groupBy(key).agg(F.percentile_approx("distance", share, 10_000).alias("cut")), "mcd-cut")


def _nearest_half(near: DataFrame, key: str, few: bool) -> DataFrame:
    return _lookup(near, _quantile(near, 0.5, key), key, few).where("distance <= cut")


def _starts(z: dict[str, Column]) -> list[dict[str, Column]]:
    """Transforms of standardised statistics that bound what a row adds to a covariance, beside none at all (the first)."""
    size = F.sqrt(sum((v * v for v in z.values()), F.lit(1e-12)))
    return [
        {x: F.lit(0.0) for x in z},
        {x: F.tanh(v) for x, v in z.items()},
        {x: v / size for x, v in z.items()},
        {x: F.greatest(F.least(v, F.lit(1.5)), F.lit(-1.5)) for x, v in z.items()},
        {x: F.signum(v) for x, v in z.items()},
        {x: v * F.least(F.lit(1.0), math.sqrt(_D) / size) for x, v in z.items()},
    ]


def _first_trials(rows: DataFrame, few: bool) -> DataFrame:
    """Each row once for each start, with ``trial`` (start and group) and its distance by that start."""
    middle = staged(rows.groupBy("group").agg(*[F.percentile_approx(x, 0.5, 10_000).alias(f"m_{x}") for x in _X]), "mcd-start")
    off = _lookup(rows, middle, "group", few)
    spread = staged(off.groupBy("group").agg(*[F.percentile_approx(F.abs(F.col(x) - F.col(f"m_{x}")), 0.5, 10_000).alias(f"s_{x}") for x in _X]), "mcd-start")
    off = _lookup(rows, staged(middle.join(spread, "group"), "mcd-start"), "group", few)
    z = {x: (F.col(x) - F.col(f"m_{x}")) / F.greatest(1.4826 * F.col(f"s_{x}"), F.lit(least)) for x, least in STATISTICS.items()}
    standard = off.select(*rows.columns, *[v.alias(f"z_{x}") for x, v in z.items()])
    starts = _starts({x: F.col(f"z_{x}") for x in _X})
    tried = standard.withColumn("start", F.explode(F.sequence(F.lit(0), F.lit(len(starts) - 1))))
    moved = {}
    for x in _X:
        value = F.lit(0.0)
        for n, of in enumerate(starts):
            value = F.when(F.col("start") == n, of[x]).otherwise(value)
        moved[f"u_{x}"] = value
    tried = tried.withColumns(moved).withColumn("trial", F.concat_ws("|", "start", "group"))
    sums = []
    for i, j in _PAIRS:
        c = F.avg(F.col(f"u_{_X[i]}") * F.col(f"u_{_X[j]}"))
        # The first start has no correlations; the others get a little of the unit matrix, for statistics that never vary.
        sums.append((c + (F.when(F.first("start") == 0, 1.0).otherwise(0.05) if i == j else 0.0)).alias(f"c_{i}_{j}"))
    shapes = staged(_factors(tried.groupBy("trial").agg(*sums)).select("trial", *_FACTORS), "mcd-start")
    joined = _lookup(tried, shapes, "trial", few)
    return joined.select(*rows.columns, "trial", _squared({x: F.col(f"z_{x}") for x in _X}).alias("distance"))


def _least(estimate: DataFrame, groups: DataFrame, keep: int) -> DataFrame:
    """(trial, group) of the ``keep`` trials of each group whose determinants are least."""
    order = Window.partitionBy("group").orderBy("logdet", "trial")
    ranked = estimate.join(groups, "trial").withColumn("rank", F.row_number().over(order))
    return ranked.where(F.col("rank") <= keep).select("trial", "group")


def minimum_determinant(
    rows: DataFrame, few: bool = False, first_steps: int = 2, keep: int = 2, most_steps: int = 12, least_fall: float = 1e-4
) -> DataFrame:
    """Of each ``group`` of ``rows`` the estimate from the half of least determinant that was found.

    Steps end when none has lowered the logarithm of a determinant by ``least_fall``, or after ``most_steps``.
    """
    near = _first_trials(rows, few)
    names = staged(near.select("trial", "group").distinct(), "mcd-trials")
    for _ in range(first_steps):
        estimate = _estimate(_nearest_half(near, "trial", few), "trial")
        near = _with_distance(near.drop("distance"), estimate, "trial", few)
    chosen = staged(_least(estimate, names, keep), "mcd-trials")
    per_group = chosen.groupBy("group").agg(F.collect_list("trial").alias("trials"))  # ``keep`` names
    tried = _lookup(rows, staged(per_group, "mcd-trials"), "group", few).select(*rows.columns, F.explode("trials").alias("trial"))
    estimate = staged(estimate.join(chosen.select("trial"), "trial"), "mcd")
    for _ in range(most_steps):
        after = _estimate(_nearest_half(_with_distance(tried, estimate, "trial", few), "trial", few), "trial")
        fell = estimate.select("trial", F.col("logdet").alias("before")).join(after, "trial").where(F.col("logdet") < F.col("before") - least_fall).limit(1).count()
        estimate = after
        if not fell:
            break
    best = _least(estimate, names, 1)
    return staged(estimate.join(best, "trial").drop("trial"), "mcd")


def estimate_groups(rows: DataFrame) -> DataFrame:
    """Robust estimate of each ``group`` of ``rows``: its columns and ``factor``, by which squared distances are divided."""
    few = rows.select("group").distinct().limit(_FEW + 1).count() <= _FEW
    near = _with_distance(rows, minimum_determinant(rows, few), few=few)
    scale = _quantile(near, 0.5).select("group", (F.col("cut") / chi_squared_quantile(0.5)).alias("factor"))
    inner = _lookup(near, scale, "group", few).where(F.col("distance") <= F.col("factor") * chi_squared_quantile(0.975))
    final = _estimate(inner)
    scale = _quantile(_with_distance(rows, final, few=few), 0.5)
    factor = F.greatest(F.col("cut") / chi_squared_quantile(0.5), F.lit(1.0))
    return final.join(scale.select("group", factor.alias("factor")), "group")


def judge_quality(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
    least_rows: int = 60,
    level: float = 0.999999,
) -> DataFrame:
    """``docs`` without its text, with the counts, base_failed, kept and ``distance`` (NULL where the base failed)."""
    others = [c for c in docs.columns if c != text_col]
    own = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in others]).alias("_row"),
        F.col(f"`{text_col}`").alias("_text"),
        F.col(f"`{lang_col}`").cast("string").alias("_lang"),
        F.col(f"`{source_col}`").cast("string").alias("_source"),
    )
    counts = with_statistics(text_counts(own, "_text")).withColumn("base_failed", base_failed())
    name = lambda c: F.when(F.col(c).isNull(), "-").otherwise(F.concat(F.lit("="), F.col(c)))
    counts = counts.withColumns({"narrow": F.to_json(F.array(name("_lang"), name("_source"))), "wide": F.to_json(F.array(name("_lang")))})
    rows = staged(counts.drop("_text", "_lang", "_source", "_capitals", "_points", "n_distinct").withColumn("at", F.monotonically_increasing_id()), "quality")
    judged = rows.where(~F.col("base_failed"))
    sizes = judged.groupBy("narrow", "wide").count()
    sizes = staged(sizes, "quality-groups")
    by_lang = sizes.groupBy("wide").agg(F.sum("count").alias("n"))
    group = F.when(F.col("count") >= least_rows, F.col("narrow")).when(F.col("n") >= least_rows, F.col("wide")).otherwise("")
    groups = staged(salted_lookup(sizes, by_lang, "wide", "inner").select("narrow", group.alias("group")), "quality-groups")
    statistics = staged(salted_lookup(judged.select("at", "narrow", *_X), groups, "narrow", "inner").drop("narrow"), "statistics")
    estimate = estimate_groups(statistics)
    cut = chi_squared_quantile(level)
    far = salted_lookup(_with_distance(statistics, estimate.drop("factor")), estimate.select("group", "factor"), "group", "inner")
    far = far.select("at", (F.col("distance") / F.col("factor")).alias("distance"))
    out = rows.join(far, "at", "left").withColumn("kept", ~F.col("base_failed") & (F.col("distance") <= cut))
    made = [c for c in out.columns if c not in ("_row", "at", "narrow", "wide", *_X)]
    return out.select(*[F.col("_row").getField(c).alias(c) for c in others if c not in made], *made)


def op7_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    found = judge_quality(docs)
    return found.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        F.coalesce("kept", F.lit(False)).alias("kept"), F.round("distance", 6).alias("distance"),
    )
