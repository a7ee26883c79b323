"""Ranked lexical search by NRA (no random access) over impact-sorted postings.

One pass over the documents writes, for each document, its length and its counts of the queries' terms; the number of
documents, their total length and the document frequencies are sums over it. A second pass reads those rows in blocks of
documents. A block sorts the postings of each term by impact, the highest first, and answers each query by NRA:

* the lists of the query's terms are read from the top, all to the same depth, which doubles from step to step;
* each document met has a lower bound, the sum of what was read of it, and an upper bound, which adds for each list in
  which it was not met the impact that the list has been read down to (0 at its end);
* documents whose upper bound is below the k-th lower bound are out, and once a document that was never met would be out too, only
  the remaining ones are followed;
* reading ends when both bounds of every remaining document are the same. Membership, ties and scores are then final.

So a block gives the first k of its documents, exactly, and the first k of all are among those. To keep their number from
growing with the number of blocks, a part of the documents (a hash decides) is searched first: the k-th score of any part is
no higher than that of all, so that no block needs to report, or to read for, documents below it. Equal scores
at the limit are kept, so results are the same for any part.

Terms are the maximal runs of ASCII letters, digits and characters beyond ASCII, A-Z in lower case. The weight of a term and
the impact of a posting are those of BM25 in integers: ``weight`` and ``impact``. All numbers are 64-bit; ``m``, whose
product may pass that, is computed in unbounded integers once for each length of a document.

Queries are dealt into blocks by a hash of their text, of about ``block_chars`` characters each; a block's terms are broadcast
and the documents are read once for each block. A NULL text has no terms, and a query without terms no results. Repeated
documents and queries count as rows of their own; a NULL id comes last among equal scores. Whole texts are read,
in linear time, and documents without a term are not counted in N. An empty table gives an empty result. Other columns are
not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemill.llm.common import encoded, staged, table

#: Separators become spaces and A-Z lower case; what is not ASCII stays.
_FOLD = bytes(
    ord(chr(b).lower()) if chr(b).isalnum() and b < 128 else b if b > 127 else 32 for b in range(256)
)
_FIRST_DEPTH = 64


def terms(text: str | bytes | None) -> list[bytes]:
    raw = text if isinstance(text, bytes) else encoded(text)
    return raw.translate(_FOLD).split()


def weight(documents: int, df: int) -> int:
    """Of a term that ``df`` of ``documents`` hold."""
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


def length_norm(length: int, documents: int, total: int) -> int:
    return 100 - 50 + (50 * length * documents) // total


def impact(tf, norm):
    """Of ``tf`` occurrences in a document with that norm."""
    return (1_000_000_000 * tf) // (1000 * tf + 20 * norm)


@lru_cache(maxsize=2)
def _numbers(shared) -> dict[bytes, int]:
    return {term: i for i, term in enumerate(shared.value)}


def _counting(shared):
    """(id, at, length, places, tf): the places of the query terms of a document, and their counts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = _numbers(shared).get
        size = len(shared.value)
        for batch in batches:
            lengths, found = [], []
            for text in batch["text"]:
                words = terms(text.as_py())
                lengths.append(len(words))
                hits = np.fromiter(map(get, words, repeat(-1)), np.int64, len(words))
                found.append(hits[hits >= 0])
            if not lengths:
                continue
            row = np.repeat(np.arange(len(found)), [len(f) for f in found])
            keys, tf = np.unique(row * max(size, 1) + np.concatenate(found), return_counts=True)
            ends = np.searchsorted(keys, np.arange(len(found) + 1) * max(size, 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    batch["id"],
                    batch["at"],
                    pa.array(lengths, pa.int64()),
                    pa.ListArray.from_arrays(ends, pa.array(keys % max(size, 1), pa.int32())),
                    pa.ListArray.from_arrays(ends, pa.array(tf, pa.int32())),
                ],
                ["id", "at", "length", "places", "tf"],
            )

    return count


class _Block:
    """The impact-sorted postings of a block of documents: of term i, ``docs`` and ``scores`` from ``starts[i]`` on."""

    def __init__(self, rows: pa.Table, weights: np.ndarray, documents: int, total: int):
        self.size = rows.num_rows
        length = rows["length"].to_numpy()
        distinct, which = np.unique(length, return_inverse=True)
        norm = np.array([length_norm(int(n), documents, total) for n in distinct], np.int64)[which]
        places = rows["places"].combine_chunks()
        term = places.flatten().to_numpy().astype(np.int64)
        tf = rows["tf"].combine_chunks().flatten().to_numpy().astype(np.int64)
        docs = np.repeat(np.arange(self.size), np.diff(places.offsets.to_numpy()))
        scores = weights[term] * impact(tf, norm[docs])
        order = np.lexsort((docs, -scores, term))
        self.docs, self.scores = docs[order], scores[order]
        self.starts = np.searchsorted(term[order], np.arange(len(weights) + 1))

    def search(self, query: np.ndarray, k: int, least: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents that may be among the first ``k``, and their scores: ties included, none below ``least``."""
        heads, ends = self.starts[query], self.starts[query + 1]
        lower = np.zeros(self.size, np.int64)
        met = np.zeros((self.size, len(query)), np.int64)
        rest = np.arange(self.size)  # documents that are not out
        follow = np.ones(self.size, bool)
        depth, floor = 0, max(least, 1)
        while True:
            deeper = depth * 2 or _FIRST_DEPTH
            frontier = np.zeros(len(query), np.int64)
            for i, (head, end) in enumerate(zip(heads, ends, strict=True)):
                a, b = min(head + depth, end), min(head + deeper, end)
                if b > a:
                    docs, scores = self.docs[a:b], self.scores[a:b]
                    if len(rest) < self.size:
                        kept = follow[docs]
                        docs, scores = docs[kept], scores[kept]
                    lower[docs] += scores  # a document is once in a list
                    met[docs, i] = 1
                if b < end:
                    frontier[i] = self.scores[b - 1]
            depth = deeper
            low = lower[rest]
            if len(low) >= k:
                floor = max(floor, int(np.partition(low, len(low) - k)[len(low) - k]))
            high = low + frontier.sum() - met[rest] @ frontier
            stay = high >= floor
            if not stay.all():
                follow[rest[~stay]] = False
                rest, low, high = rest[stay], low[stay], high[stay]
            if (low == high).all():
                return rest, low


def _searching(shared, weights: np.ndarray, documents: int, total: int, k: int, block_postings: int, block_docs: int):
    """(query, id, at, score) of each block's first k documents for each query, with the ties of the last."""

    def answer(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(held)
        block = _Block(rows, weights, documents, total)
        ids = rows["id"].combine_chunks()
        at = rows["at"].to_numpy()
        for number, (query, least) in enumerate(shared.value):
            docs, scores = block.search(query, k, least)
            if not len(docs):
                continue
            # The rows are in the order of their ids, so the first of equal scores are those that stay.
            best = np.lexsort((docs, -scores))[:k]
            docs, scores = docs[best], scores[best]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(docs), number, np.int32)), ids.take(pa.array(docs)), pa.array(at[docs]), pa.array(scores)],
                ["query", "id", "at", "score"],
            )

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, postings, docs = [], 0, 0
        for batch in batches:
            for start in range(0, batch.num_rows, block_docs):
                part = batch.slice(start, block_docs)
                if held and (postings >= block_postings or docs + part.num_rows > block_docs):
                    yield from answer(_in_order(held))
                    held, postings, docs = [], 0, 0
                held.append(part)
                postings += len(part["places"].flatten())
                docs += part.num_rows
        if held:
            yield from answer(_in_order(held))

    return search


def _in_order(held: list[pa.RecordBatch]) -> list[pa.RecordBatch]:
    rows = pa.Table.from_batches(held)
    return rows.sort_by([("id", "ascending"), ("at", "ascending")]).combine_chunks().to_batches()


def _first(found: DataFrame, k: int) -> DataFrame:
    """The first k of each query, with their ranks."""
    best = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("id"), "at")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def _query_blocks(queries: DataFrame, block_chars: int) -> Iterator[pa.Table]:
    chars = queries.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = 1 + chars // block_chars
    for block in range(blocks):
        yield queries.where(F.pmod(F.xxhash64("text"), F.lit(blocks)) == block).toArrow()


def _search_block(spark: SparkSession, rows: DataFrame, ids: pa.Array, texts: list[str], k: int, seed_docs: int, block_postings: int, block_docs: int) -> DataFrame:
    sets = [sorted(set(terms(t))) for t in texts]
    vocabulary = sorted({t for s in sets for t in s})
    number = {t: i for i, t in enumerate(vocabulary)}
    counted = rows.mapInArrow(
        _counting(spark.sparkContext.broadcast(vocabulary)),
        f"id {rows.schema['id'].dataType.simpleString()}, at long, length long, places array<int>, tf array<int>",
    )
    index = staged(counted, "postings")
    documents, total = index.where("length > 0").agg(F.count("*"), F.coalesce(F.sum("length"), F.lit(0))).first()
    frequency = index.select(F.explode("places").alias("place")).groupBy("place").count().toArrow()  # a row for each term at most
    df = np.zeros(len(vocabulary), np.int64)
    df[frequency["place"].to_numpy()] = frequency["count"].to_numpy()
    weights = np.array([weight(documents, int(n)) for n in df], np.int64)
    found_schema = f"query int, id {rows.schema['id'].dataType.simpleString()}, at long, score long"

    def search(part: DataFrame, least: list[int]) -> DataFrame:
        wanted = [(np.array([number[t] for t in s], np.int64), low) for s, low in zip(sets, least, strict=True)]
        shared = spark.sparkContext.broadcast(wanted)
        return part.mapInArrow(_searching(shared, weights, documents, max(total, 1), k, block_postings, block_docs), found_schema)

    least = [0] * len(sets)
    parts = documents // seed_docs
    if parts > 1:
        seed = index.where(F.pmod(F.xxhash64("at"), F.lit(parts)) == 0)
        kth = _first(search(seed, least), k).where(F.col("rank") == k).select("query", "score")
        for r in kth.toArrow().to_pylist():  # a row for each query at most
            least[r["query"]] = r["score"]
    named = spark.createDataFrame(pa.table({"query": pa.array(range(len(sets)), pa.int32()), "item": ids}))
    best = _first(search(index, least), k)
    return best.join(F.broadcast(named), "query").select("item", F.col("rank").cast("int").alias("rank"), "id", "score")


def ranked_search(
    spark: SparkSession,
    docs: DataFrame,
    queries: DataFrame,
    k: int = 50,
    id_col: str = "doc_id",
    text_col: str = "text",
    query_id_col: str = "item_id",
    query_text_col: str = "text",
    block_chars: int = 4_000_000,
    seed_docs: int = 8192,
    block_postings: int = 4_000_000,
    block_docs: int = 1 << 15,
) -> DataFrame:
    """(item, rank, id, score): the ``k`` documents of highest score for each query, scores above 0 only."""
    rows = docs.select(F.col(id_col).alias("id"), F.monotonically_increasing_id().alias("at"), F.col(text_col).cast("binary").alias("text"))
    asked = queries.select(F.col(query_id_col).alias("item"), F.coalesce(F.col(query_text_col), F.lit("")).alias("text"))
    found = None
    for block in _query_blocks(asked, block_chars):
        if found is not None and not block.num_rows:
            continue
        item = block["item"].combine_chunks()
        part = _search_block(spark, rows, item, block["text"].to_pylist(), k, seed_docs, block_postings, block_docs)
        found = part if found is None else found.unionByName(part)
    return found


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ranked_search(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(F.col("item").alias("item_id"), "rank", F.col("id").alias("doc_id"), "score")


OP11_SQL = r"""
WITH d AS (
    SELECT doc_id, row_number() OVER () AS place,
           regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS words
    FROM documents),
q AS (
    SELECT item_id, place, unnest(list_distinct(words)) AS term
    FROM (SELECT item_id, row_number() OVER () AS place,
                 regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS words
          FROM benchmark)),
s AS (
    SELECT CAST(count(*) AS BIGINT) AS all_docs, CAST(sum(len(words)) AS BIGINT) AS all_terms FROM d WHERE len(words) > 0),
p AS (
    SELECT place, term, count(*) AS tf
    FROM (SELECT place, unnest(words) AS term FROM d)
    WHERE term IN (SELECT term FROM q)
    GROUP BY place, term),
w AS (
    SELECT term, CAST(floor(1000 * ln((2 * any_value(all_docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS weight
    FROM p, s GROUP BY term),
scored AS (
    SELECT q.item_id, q.place AS item_place, p.place,
           CAST(sum(weight * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * len(words) * all_docs) // all_terms)))) AS BIGINT) AS score
    FROM q JOIN p USING (term) JOIN w USING (term) JOIN d ON d.place = p.place, s
    GROUP BY q.item_id, q.place, p.place)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
FROM (SELECT item_id, doc_id, score,
             row_number() OVER (PARTITION BY item_id, item_place ORDER BY score DESC, doc_id NULLS LAST, d.place) AS rank
      FROM scored JOIN d USING (place) WHERE score > 0)
WHERE rank <= 50
"""
