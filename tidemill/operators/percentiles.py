"""Percentiles per group, or over the whole table when no keys are given."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.operators.joins import total


def _label(p: float) -> str:
    return f"p{p:g}".replace(".", "_")


def approx_percentiles(
    df: DataFrame, value: str, percents: Sequence[float] = (50, 95, 99), keys: Sequence[str] = (), accuracy: int = 10_000
) -> DataFrame:
    """Percentiles from a mergeable sketch of bounded size; each is a value that occurs, not interpolated."""
    sketch = F.percentile_approx(value, [p / 100 for p in percents], accuracy)
    picked = df.groupBy(*keys).agg(sketch.alias("_p"))
    return picked.select(*keys, *[F.col("_p")[i].alias(_label(p)) for i, p in enumerate(percents)])


def percentile_sketches(
    df: DataFrame, value: str, keys: Sequence[str] = (), k: int = 800, name: str = "sketch", count: str = "n"
) -> DataFrame:
    """A KLL sketch of the non-NULL values of each group and their number: a few kilobytes, whatever the group's size.

    Sketches can be stored, and merged with others at any time (``merged_percentiles``), so percentiles over many windows or
    runs need no second look at the rows. The rank of a percentile errs by about 2.3 / k^0.9 (0.6 % for 800) with a
    probability of 99 %, however many sketches are merged.
    """
    values = F.col(value).cast("double")
    return df.groupBy(*keys).agg(F.kll_sketch_agg_double(values, k).alias(name), F.count(values).alias(count))


def merged_percentiles(
    sketches: DataFrame, percents: Sequence[float] = (50, 95, 99), keys: Sequence[str] = (), k: int = 800, name: str = "sketch", count: str = "n"
) -> DataFrame:
    """Percentiles of the values behind all sketches of a group; each is a value that occurs, NULL if there are none."""
    some = F.when(F.col(count) > 0, F.col(name))
    merged = sketches.groupBy(*keys).agg(F.kll_merge_agg_double(some, k).alias("_s"), F.sum(count).alias(count))
    found = [
        F.when(F.col(count) > 0, F.kll_sketch_get_quantile_double("_s", F.lit(p / 100))).alias(_label(p)) for p in percents
    ]
    return merged.select(*keys, count, *found)


def _renamed(columns: Sequence[str]) -> list[Column]:
    return [F.col(c).alias(f"_of_{c}") for c in columns]


def _same_group(columns: Sequence[str]) -> Column:
    """Join condition against :func:`_renamed` columns under which NULL keys form a group too."""
    return reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in columns])


def _with_slice(counted: DataFrame, keys: list[str], max_hot: int, min_split: int, steps: int) -> DataFrame:
    """Number the value ranges of large groups, so that no task has to sort a whole one.

    A group is large if it has more than ``min_split`` distinct values and more than ``1/max_hot`` of those of
    all groups. So there are fewer than ``max_hot`` large groups, and their range bounds, which come from a
    quantile sketch, can be broadcast. There are ``steps * steps`` ranges to a group, and a value's is found in
    two steps: among every ``steps``-th bound, then within those.
    """
    slices = steps * steps
    occurring = F.when(F.col("_c") > 0, F.col("_v"))
    sizes = counted.groupBy(*keys).agg(F.count(occurring).alias("_values"))
    bounds = F.percentile_approx(occurring, [i / slices for i in range(1, slices)], 10 * slices).alias("_edges")
    every = F.transform(F.sequence(F.lit(1), F.lit(steps - 1)), lambda i: F.col("_edges")[i * steps - 1])
    if keys:
        is_large = (F.col("_values") > min_split) & (F.col("_values") * F.lit(max_hot) > total(sizes, "_values"))
        large = sizes.where(is_large).select(*_renamed(keys))
        members = counted.join(F.broadcast(large), _same_group(keys), "left_semi")
        divided = members.groupBy(*keys).agg(bounds).select(*_renamed(keys), "_edges", every.alias("_every"))
        bounded = counted.join(F.broadcast(divided), _same_group(keys), "left")
    else:
        members = counted.where(sizes.scalar() > min_split)
        only = members.select(bounds).select(F.struct("_edges", every.alias("_every"))).scalar()
        bounded = counted.withColumns({c: only.getField(c) for c in ("_edges", "_every")})

    def below(edges: Column | str) -> Column:
        # Without bounds, all values of a group are in slice 0.
        return F.greatest(F.size(F.filter(edges, lambda edge: edge < F.col("_v"))), F.lit(0))

    block = below("_every") * steps
    inner = F.slice("_edges", block + 1, F.lit(steps - 1))
    position = F.when(F.col("_edges").isNull(), 0).otherwise(block + below(inner))
    return bounded.select(*counted.columns, position.alias("_slice"))


def exact_percentiles(
    df: DataFrame,
    value: str,
    percents: Sequence[float] = (50, 95, 99),
    keys: Sequence[str] = (),
    max_hot: int = 65_536,
    min_split: int = 1_000_000,
    steps: int = 12,
) -> DataFrame:
    """Percentiles interpolated linearly at position ``(n - 1) * p / 100`` of the sorted non-NULL values.

    Returns the keys, ``n``, ``max`` and one column per percent (``p50``, ...); all are 0 for a group without
    values, and without keys there is one row even for an empty table.

    Equal values are counted first. Large groups are then cut into value ranges: totals per range locate the
    ranges that hold the wanted positions, and only those are sorted, each by its own task.
    """
    keys = list(keys)
    # A group that has only NULLs stays visible here as one value NULL with count 0.
    counted = (
        df.select(*keys, F.col(value).cast("double").alias("_v"))
        .groupBy(*keys, "_v")
        .agg(F.count("_v").alias("_c"))
    )
    sliced = _with_slice(counted, keys, max_hot, min_split, steps)

    totals = sliced.groupBy(*keys, "_slice").agg(F.sum("_c").alias("_total"), F.max("_v").alias("_top"))
    in_group = Window.partitionBy(*keys)
    before = in_group.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    ranges = totals.select(
        *keys,
        "_slice",
        "_total",
        "_top",
        F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_start"),
        F.sum("_total").over(in_group).alias("_n"),
    )

    # As SQL text, since each operator on a Column is a call to the JVM and there are many here.
    position = {p: f"((_n - 1) * {p / 100!r}D)" for p in percents}
    ranks = {p: (f"floor({pos})", f"ceil({pos})") for p, pos in position.items()}

    def holds(start: str, count: str, rank: str) -> str:
        return f"({start} <= {rank} AND {rank} < {start} + {count})"

    wanted = " OR ".join(holds("_start", "_total", r) for pair in ranks.values() for r in pair)
    slice_of = [*keys, "_slice"]
    targets = ranges.where(wanted).select(*_renamed(slice_of), "_start", "_n")
    values = sliced.join(targets, _same_group(slice_of), "inner").select(*slice_of, "_v", "_c", "_start", "_n")
    earlier = Window.partitionBy(*keys, "_slice").orderBy("_v").rowsBetween(Window.unboundedPreceding, -1)
    placed = values.withColumn("_first", F.col("_start") + F.coalesce(F.sum("_c").over(earlier), F.lit(0)))

    # Picks and totals meet in one aggregation rather than a join, so groups without picks are kept.
    picks, blanks, results = [], [], []
    for p in percents:
        lo, hi = f"_lo_{_label(p)}", f"_hi_{_label(p)}"
        for name, rank in zip((lo, hi), ranks[p], strict=True):
            picks.append(F.expr(f"max(CASE WHEN {holds('_first', '_c', rank)} THEN _v END) AS {name}"))
            blanks.append(F.expr(f"CAST(NULL AS DOUBLE) AS {name}"))
        between = f"{lo} + ({hi} - {lo}) * ({position[p]} - {ranks[p][0]})"
        results.append(F.expr(f"coalesce(CASE WHEN {hi} = {lo} THEN {lo} ELSE {between} END, 0.0D) AS {_label(p)}"))

    nothing = {"_n": F.lit(None).cast("long"), "_top": F.lit(None).cast("double")}
    found = placed.groupBy(*keys).agg(*picks).withColumns(nothing)
    base = ranges.select(*keys, "_n", "_top", *blanks)
    merged = (
        base.unionByName(found)
        .groupBy(*keys)
        .agg(*[F.max(c).alias(c) for c in base.columns if c not in keys])
        .withColumns({"_n": F.coalesce("_n", F.lit(0))})
    )
    return merged.select(
        *keys, F.col("_n").alias("n"), *results, F.coalesce(F.col("_top"), F.lit(0.0)).alias("max")
    )
