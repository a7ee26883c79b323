"""What the text operators share: intermediate tables, balanced lookups, hold-out keys and word hashing."""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.sources.scratch import staged

__all__ = ["WordHashes", "crc_of", "encoded", "in_small_batches", "mixed", "salted_lookup", "staged", "table"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def salted_lookup(df: DataFrame, lookup: DataFrame, key: str, how: str = "left", salts: int = 16) -> DataFrame:
    """Join of ``lookup``, which has one row a key, such that the rows of one key are dealt over ``salts`` tasks.

    NULL keys match nothing and are dealt out too. The salt is a hash of the row, so a task run again deals alike.
    """
    hashable = [f.name for f in df.schema.fields if f.dataType.typeName() in ("long", "integer", "string", "double")]
    salt = F.pmod(F.xxhash64(F.spark_partition_id(), *hashable), F.lit(salts)).cast("int")
    copies = lookup.where(F.col(key).isNotNull()).withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
    )
    return df.withColumn("_salt", salt).join(copies, [key, "_salt"], how).drop("_salt")


def in_small_batches(spark: SparkSession, most_mb: int = 8) -> None:
    """Give texts to Python in batches of at most so many MB from now on, so that what a worker holds, and keeps for the next
    stage, does not depend on the length of texts. A lower setting of the session stays."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(name, "64m"))
    if now > most_mb << 20:
        spark.conf.set(name, f"{most_mb}m")


def crc_of(column: str) -> Column:
    """crc32 of an id as text; a NULL id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary"))


class WordHashes(dict):
    """64-bit hash of a word, remembered for a bounded number of words."""

    def __init__(self, most: int = 200_000):
        super().__init__()
        self.most = most

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.most:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def encoded(text: str | None) -> bytes:
    return b"" if text is None else text.encode("utf-8", "surrogatepass")


def mixed(x: np.ndarray) -> np.ndarray:
    """A finalising mix of 64-bit numbers (the multipliers are the usual ones of such mixes)."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))
