"""Joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_UNHASHABLE = (T.MapType, T.VariantType)


def _scatter(df: DataFrame) -> Column:
    """A hash to spread rows by: of their content, and of the task that holds them, as rows may be copies.

    Both are the same when a task is run again, unlike a random number or a row's position.
    """
    hashable = [f.name for f in df.schema.fields if not isinstance(f.dataType, _UNHASHABLE)]
    return F.xxhash64(F.spark_partition_id(), *hashable)


def total(df: DataFrame, column: str) -> Column:
    """Sum of a column as a scalar subquery, for frames that are used elsewhere in the same plan.

    The hash keeps the other columns, which the sum has no use for, in the subquery. So its plan down to the
    last shuffle is the one of the other uses, and Spark runs it once for all of them.
    """
    sums = F.struct(F.sum(column).alias("total"), F.max(F.xxhash64(*df.columns)).alias("_all"))
    return df.select(sums).scalar().getField("total")


def attach_by_key(
    df: DataFrame,
    features: DataFrame,
    keys: Sequence[str],
    weight: str,
    max_hot: int = 65_536,
) -> DataFrame:
    """Left join of ``features``, which has one row per key, onto the rows it was computed from.

    ``weight`` is the column of ``features`` that counts the rows of ``df`` with that key. It is used to keep
    the join balanced and is not part of the result.

    * Keys with more than ``1/max_hot`` of all rows go through a broadcast. The weights add up to the row
      count, so there are fewer than ``max_hot`` such keys however large the data is.
    * All other keys go through an ordinary join, which Spark broadcasts or shuffles by measured size. It is
      made on a hash of the key. Rows that are already served, or have a NULL key, which matches nothing, are
      scattered instead, so no task gets more than its share of them.

    The rows wait for the broadcast of the hot keys. By then the size of ``features`` has been measured, and
    adaptive execution drops the shuffle of the rows if ``features`` turns out to be small.
    """
    keys = list(keys)
    names = [c for c in features.columns if c not in keys and c != weight]
    # The joins imply this filter for their own plans; given to all uses, they can share one shuffle.
    features = features.where(reduce(and_, [F.col(k).isNotNull() for k in keys]))
    is_hot = F.col(weight) * F.lit(max_hot) > total(features, weight)
    hot = features.where(is_hot).select(*keys, F.struct(*names).alias("_hot"))
    cold = features.where(~is_hot).select(
        F.xxhash64(*keys).alias("_cold_at"),
        *[F.col(k).alias(f"_of_{k}") for k in keys],
        *[F.col(n).alias(f"_cold_{n}") for n in names],
    )
    served = reduce(or_, [F.col(k).isNull() for k in keys], F.col("_hot").isNotNull())
    rows = df.join(F.broadcast(hot), keys, "left").withColumn(
        "_at", F.when(served, _scatter(df)).otherwise(F.xxhash64(*keys))
    )
    # Keys are compared as well, since hashes may collide. Inside coalesce the comparison stays a filter on
    # matches: as join keys these columns would have to be sorted by too, which a single number avoids.
    same_key = reduce(and_, [F.col(k) == F.col(f"_of_{k}") for k in keys])
    matches = (F.col("_at") == F.col("_cold_at")) & F.coalesce(same_key, F.lit(False))
    joined = rows.join(cold, matches, "left")
    return joined.select(
        *df.columns, *[F.coalesce(F.col("_hot").getField(n), F.col(f"_cold_{n}")).alias(n) for n in names]
    )


def skip_processed(df: DataFrame, processed: DataFrame, key: str) -> DataFrame:
    """Rows whose ``key`` is not listed in ``processed``; rows with a NULL key are kept.

    The rows of each key are counted first, from that column alone, and each key is marked as done or not. The marks are
    then attached as any features of a key are: through a broadcast for keys with many rows, by an ordinary join for the
    rest. Nothing is copied, and no batch is tested in one place because it is large.
    """
    counts = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))
    done = processed.where(F.col(key).isNotNull()).select(key).distinct().withColumn("_done", F.lit(True))
    marked = attach_by_key(df, counts.join(done, key, "left"), [key], "_rows")
    return marked.where(F.col("_done").isNull()).select(*df.columns)
