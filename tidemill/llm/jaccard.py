"""Join of documents by Jaccard similarity of their word n-grams, with MinHash banding.

1. Each text becomes its set of hashed word 5-grams and a MinHash signature. Texts with equal sets are one *class* and
   go on as one representative with a count, so copies are never paired.
2. The signature is cut into bands; the band and row counts are the least that reach the wanted recall at the
   threshold (``choose_bands``). A shuffle on band hashes finds representatives that share a bucket. No pair is written:
   each bucket is connected through its least member, and connected buckets form candidate groups.
3. Candidate groups are verified on the full n-gram sets, all against all. A group of more than ``block_words`` words is
   dealt into blocks; each pair of blocks is one unit of work, and a block is copied once for each other block. So a task
   holds two blocks at most, whatever the group, but the texts that are shuffled for a group of w words are about
   w * w / ``block_words`` words: with the square of the group, from 200,000 words on. Only different n-gram sets count,
   as copies have been put together. A unit counts partners with an inverted index and returns one row for each member:
   its number of partners, and the component it belongs to within the unit.
4. Components over units give the class ids.

The result covers every row. Links are symmetric and complete within candidate groups; recall over all linked pairs is
that of the bands or better, as groups join buckets.

A text of one to four words is a single n-gram. A NULL text, or one without words, has no n-grams: it is its own class
with no links. Repeated rows and rows with the same id are rows of their own (a hidden row number tells them apart); a
NULL id stays NULL and such a row can be linked, its class taking the least id that is not NULL. Words are split at
ASCII white space and compared as they are. Other columns, whatever their names, are kept apart. Empty tables give empty
results.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm.common import WordHashes, encoded, mixed, salted_lookup, staged, table
from tidemill.llm.components import connected_components

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def choose_bands(threshold: float, recall: float, most_hashes: int = 256) -> tuple[int, int]:
    """(bands, rows): the most rows a band, hence the fewest chance buckets, that reach ``recall`` at ``threshold``."""
    for rows in range(32, 0, -1):
        bands = math.ceil(math.log(1 - recall) / math.log(1 - threshold**rows))
        if bands * rows <= most_hashes or rows == 1:
            return bands, rows
    raise AssertionError


def shingles(text: str | None, hashes: WordHashes, n: int = 5) -> np.ndarray:
    """Sorted distinct hashes of the word n-grams."""
    words = hashes.of(encoded(text).split())
    if not len(words):
        return words
    width = min(n, len(words))
    found = np.full(len(words) - width + 1, width, np.uint64)
    for i in range(width):
        found = found * _MULTIPLIER + words[i : len(words) - width + 1 + i]
    return np.unique(mixed(found))


class MinHash:
    """Signatures by multiply-and-xor permutations of 32-bit hashes; the constants come from a fixed seed."""

    def __init__(self, bands: int, rows: int):
        rng = np.random.default_rng(20240501)
        self.bands, self.rows = bands, rows
        self.times = (rng.integers(0, 2**31, bands * rows, np.uint32) * np.uint32(2) + np.uint32(1))[:, None]
        self.flip = rng.integers(0, 2**32, bands * rows, np.uint32)[:, None]

    def buckets(self, found: np.ndarray) -> np.ndarray:
        """One 64-bit bucket for each band."""
        short = (found ^ (found >> np.uint64(32))).astype(np.uint32)
        least = np.full(len(self.times), 2**32 - 1, np.uint32)
        for at in range(0, len(short), 512):
            part = short[None, at : at + 512] ^ self.flip
            part *= self.times
            np.minimum(least, part.min(1), out=least)
        rows = least.reshape(self.bands, self.rows).astype(np.uint64)
        bucket = np.arange(1, self.bands + 1, dtype=np.uint64)
        for i in range(self.rows):
            bucket = mixed(bucket * _MULTIPLIER + rows[:, i])
        return bucket.view(np.int64)


_SIGNATURE = "struct<print:binary,size:int,buckets:array<long>>"


def _signature_udf(bands: int, rows: int, n: int):
    def signature(texts: pd.Series) -> pd.DataFrame:
        minhash, hashes, out = MinHash(bands, rows), WordHashes(), []
        for text in texts:
            found = shingles(text, hashes, n)
            if len(found):
                out.append((xxhash.xxh3_128_digest(found.tobytes()), len(found), minhash.buckets(found)))
            else:
                out.append((None, 0, None))
        return pd.DataFrame(out, columns=["print", "size", "buckets"]).astype({"size": "int32"})

    return F.pandas_udf(signature, _SIGNATURE)


def count_partners(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, threshold: float) -> Iterator[tuple[int, np.ndarray]]:
    """For each index in ``left``, the later ones in ``right`` whose sets are similar enough.

    ``left`` and ``right`` are either the same or disjoint. Shared n-grams are counted through an inverted index of the
    right side, so the work is the number of shared n-grams.
    """
    sizes = np.array([len(s) for s in sets])
    grams = np.concatenate([sets[i] for i in right]) if len(right) else np.empty(0, np.uint64)
    owner = np.repeat(np.arange(len(right)), sizes[right])
    order = np.argsort(grams, kind="stable")
    grams, owner = grams[order], owner[order]
    same = left is right
    for position, i in enumerate(left):
        first, last = np.searchsorted(grams, sets[i], "left"), np.searchsorted(grams, sets[i], "right")
        count = last - first
        total = int(count.sum())
        if not total:
            continue
        steps = np.arange(total) - np.repeat(np.cumsum(count) - count, count)
        shared = np.bincount(owner[np.repeat(first, count) + steps], minlength=len(right))
        alike = shared >= threshold * (sizes[i] + sizes[right] - shared) - 1e-9
        if same:
            alike[: position + 1] = False
        if alike.any():
            yield i, right[np.flatnonzero(alike)]


def _verify(threshold: float, n: int):
    def verify(unit: pd.DataFrame) -> pd.DataFrame:
        unit = unit.sort_values("row", kind="stable").reset_index(drop=True)
        hashes = WordHashes()
        sets = [shingles(t, hashes, n) for t in unit["text"]]
        rows, copies, side = unit["row"].to_numpy(), unit["copies"].to_numpy(), unit["side"].to_numpy()
        left = np.flatnonzero(side == 0)
        right = np.flatnonzero(side == 1)
        parent = np.arange(len(unit))

        def root(i: int) -> int:
            while parent[i] != i:
                parent[i] = parent[parent[i]]
                i = parent[i]
            return i

        classes, documents = np.zeros(len(unit), np.int64), np.zeros(len(unit), np.int64)
        if len(unit) and unit["lo"].iloc[0] == unit["hi"].iloc[0]:
            right = left  # a block with itself; two blocks, one of which has no rows, have no pairs
        for i, partners in count_partners(sets, left, right, threshold):
            classes[i] += len(partners)
            documents[i] += copies[partners].sum()
            classes[partners] += 1
            documents[partners] += copies[i]
            a = root(i)
            for j in partners:
                b = root(j)
                if a != b:
                    a, b = min(a, b), max(a, b)
                    parent[b] = a
        group = rows[[root(i) for i in range(len(unit))]] if len(unit) else rows
        out = pd.DataFrame({"row": rows, "comp": unit["comp"], "lo": unit["lo"], "hi": unit["hi"], "blocks": unit["blocks"],
                            "root": group, "classes": classes, "documents": documents})
        return out[out["classes"] > 0]

    return verify


def similarity_classes(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: float = 0.8,
    recall: float = 0.995,
    n: int = 5,
    block_words: int = 200_000,
) -> DataFrame:
    """All rows of ``docs`` as ``row`` (a struct of its columns), with

    * class_id: the least id among the documents it is linked to, directly or over others, itself included;
    * first: whether it is the document of its class that a deduplication keeps (the one with the least id);
    * n_links: other documents at or above the threshold; n_class_links: the same, counting equal n-gram sets once;
    * copy_of: the least id with the same n-gram set.
    """
    bands, rows = choose_bands(threshold, recall)
    text = F.col("row").getField(text_col)
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    signed = staged(
        docs.select(whole, F.col(id_col).alias("id"), F.monotonically_increasing_id().alias("at"))
        .withColumn("sign", _signature_udf(bands, rows, n)(text))
        .select("row", "id", "at", "sign.*"),
        "signed",
    )
    identity = F.struct(F.col("id").isNull().alias("unknown"), F.col("id").alias("id"), F.col("at").alias("at"))
    classes = staged(
        signed.where(F.col("print").isNotNull())
        .groupBy("print")
        .agg(
            F.min("at").alias("rep"),
            F.count("*").alias("copies"),
            F.min(identity).alias("least"),
            F.max("size").alias("size"),
            F.min_by("buckets", "at").alias("buckets"),
        ),
        "classes",
    )
    members = classes.select(F.col("rep").alias("node"), F.explode("buckets").alias("bucket"))
    shared = members.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1").select("bucket")
    groups = connected_components(salted_lookup(members, shared, "bucket", "inner"))

    # Candidate groups, dealt into blocks by their words.
    sized = groups.join(classes.select(F.col("rep").alias("node"), "size", "copies"), "node")
    weight = sized.groupBy("label").agg(F.ceil(F.sum("size") / F.lit(block_words)).cast("int").alias("blocks"))
    placed = salted_lookup(sized, weight, "label", "inner").select(
        F.col("node").alias("at"), F.col("label").alias("comp"), "blocks", "copies",
        F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int").alias("own"),
    )
    units = (
        placed.join(signed.select("at", text.alias("text")), "at")
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            F.col("at").alias("row"), "comp", "blocks", "copies", "text",
            F.least("own", "other").alias("lo"),
            F.greatest("own", "other").alias("hi"),
            F.when(F.col("own") > F.col("other"), 1).otherwise(0).alias("side"),
        )
        .repartitionByRange("comp", "lo", "hi")
    )
    found = staged(
        units.groupBy("comp", "lo", "hi").applyInPandas(
            _verify(threshold, n),
            "row long, comp long, lo int, hi int, blocks int, root long, classes long, documents long",
        ),
        "links",
    )
    links = found.groupBy("row").agg(F.sum("classes").alias("classes"), F.sum("documents").alias("documents"))
    tied = found.select(F.xxhash64("comp", "lo", "hi", "root").alias("bucket"), F.col("row").alias("node"))
    joined = connected_components(tied)
    linked = joined.withColumnRenamed("node", "rep").join(links.withColumnRenamed("row", "rep"), "rep")
    known = staged(
        classes.select("print", "rep", "copies", "least")
        .join(linked, "rep", "left")
        .where("copies > 1 OR label IS NOT NULL")
        .withColumn("label", F.coalesce("label", "rep")),
        "known",
    )
    heads = known.groupBy("label").agg(F.min("least").alias("head"))
    per_class = salted_lookup(known, heads, "label", "inner").select(
        "print",
        F.col("head.id").alias("class_id"),
        F.col("head.at").alias("keep"),
        F.col("least.id").alias("copy_of"),
        (F.coalesce("documents", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("classes", F.lit(0)).alias("n_class_links"),
    )
    whole_rows = salted_lookup(signed.select("row", "id", "at", "print"), per_class, "print")
    return whole_rows.select(
        "row",
        F.when(F.col("keep").isNull(), F.col("id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce(F.col("keep") == F.col("at"), F.lit(True)).alias("first"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
        F.coalesce("n_class_links", F.lit(0)).alias("n_class_links"),
        F.when(F.col("keep").isNull(), F.col("id")).otherwise(F.col("copy_of")).alias("copy_of"),
    )


def keep_first_of_class(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row of each similarity class, with all its columns."""
    return similarity_classes(docs, id_col, text_col, **options).where("first").select("row.*")


def op4_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return similarity_classes(docs).select("row.doc_id", "class_id", "n_links", "n_class_links", "copy_of")
