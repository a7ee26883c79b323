"""Benchmark passages in documents, up to a number of edits, by the pigeonhole principle.

A test item of n code points may differ by k = floor(rate * n) edits. Cut into k + 1 pieces, any such copy holds at
least one piece unchanged. All pieces of all items are searched at once (Aho-Corasick); each hit fixes where the item
would lie, and Myers' bit-parallel algorithm computes the least edit distance within that window.

The documents are not shuffled. The items go to the workers in blocks of at most ``block_chars`` code points, so what
is broadcast is bounded; a benchmark of several blocks is searched in as many passes of the same task.

Whole texts are searched. A NULL or empty text has no match, nor has an item that is NULL or empty. Items shorter than
``min_chars`` would occur by chance: they are searched exactly, where neither a letter nor a digit stands next to them.
Items with equal text are each reported, and repeated documents each get their rows. An item with a NULL id is reported
with a NULL ``item_id``, once for each text, and under their ids only if other items have the same text.
Of overlapping copies of an item the best is a match (the one that ends first, if equal), and the text left and right
of it is searched again until no part is within the budget, so adjacent copies are each reported. An empty table of either
kind gives no match. Other columns are not read.
"""

from __future__ import annotations

import heapq
from bisect import bisect, insort
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm.common import table



def pieces(text: str, edits: int) -> Iterator[tuple[int, str]]:
    """``edits + 1`` pieces of nearly equal length, with their offsets."""
    n, m = len(text), edits + 1
    for i in range(m):
        yield n * i // m, text[n * i // m : n * (i + 1) // m]


def _distances(pattern: str, text: str) -> Iterator[int]:
    """After each character of ``text``, the least edit distance of ``pattern`` to a part that ends there.

    Myers' algorithm: the column of the distance table is held as bits of two integers.
    """
    m = len(pattern)
    at: dict[str, int] = {}
    for i, c in enumerate(pattern):
        at[c] = at.get(c, 0) | 1 << i
    full, last = (1 << m) - 1, 1 << (m - 1)
    up, down, score = full, 0, m
    for c in text:
        eq = at.get(c, 0)
        diagonal = (((eq & up) + up) ^ up) | eq | down
        rise = down | ~(diagonal | up) & full
        fall = up & diagonal
        if rise & last:
            score += 1
        elif fall & last:
            score -= 1
        rise = rise << 1 & full
        fall = fall << 1 & full
        up = fall | ~(diagonal | rise) & full
        down = rise & diagonal
        yield score


def best_match(pattern: str, text: str) -> tuple[int, int]:
    """Least edit distance of ``pattern`` to any part of ``text``, and where the first such part ends."""
    best, end = len(pattern), 0
    for j, score in enumerate(_distances(pattern, text), 1):
        if score < best:
            best, end = score, j
    return best, end


def all_matches(pattern: str, text: str, edits: int) -> list[tuple[int, int, int]]:
    """(start, stop, distance) of parts of ``text`` within the budget that do not overlap, the best first chosen.

    A match changes the distances of ends close behind it only, and those are computed again; so the work is linear.
    """
    within = {j: d for j, d in enumerate(_distances(pattern, text), 1) if d <= edits}
    heap = [(d, j) for j, d in within.items()]
    heapq.heapify(heap)
    taken: list[tuple[int, int, int]] = []
    while heap:
        distance, stop = heapq.heappop(heap)
        if within.get(stop) != distance:
            continue
        place = bisect(taken, (stop,))
        floor = taken[place - 1][1] if place else 0
        # The end is known: the start is where the reversed item ends in the reversed text.
        length = best_match(pattern[::-1], text[max(floor, stop - len(pattern) - edits) : stop][::-1])[1]
        if not length:
            del within[stop]
            continue
        insort(taken, (stop - length, stop, distance))
        behind = min(taken[place + 1][0] if place + 1 < len(taken) else len(text), stop + len(pattern) + edits)
        for j in range(stop - length + 1, behind + 1):
            within.pop(j, None)
        for j, d in enumerate(_distances(pattern, text[stop:behind]), stop + 1):
            if d <= edits:
                within[j] = d
                heapq.heappush(heap, (d, j))
    return taken


def whole_copies(item: str, text: str, lo: int, hi: int) -> Iterator[int]:
    """Where exact copies start in ``text[lo:hi]`` that do not overlap and are not part of a longer word or number."""
    at = text.find(item, lo, hi)
    while at >= 0:
        stop = at + len(item)
        free = not (at and text[at - 1].isalnum()) and not (stop < len(text) and text[stop].isalnum())
        if free:
            yield at
        at = text.find(item, stop if free else at + 1, hi)


class Searcher:
    """Finds the items of one block in texts."""

    def __init__(self, items: tuple[tuple[int | None, str], ...], rate: float, min_chars: int):
        self.items = [(key, text, int(rate * len(text)) if len(text) >= min_chars else 0) for key, text in items]
        self.min_chars = min_chars
        where: dict[str, list[tuple[int, int]]] = {}
        for i, (_, text, edits) in enumerate(self.items):
            for offset, piece in pieces(text, edits):
                where.setdefault(piece, []).append((i, offset + len(piece) - 1))
        self.automaton = ahocorasick.Automaton()
        for piece, places in where.items():
            self.automaton.add_word(piece, places)
        if where:
            self.automaton.make_automaton()

    def windows(self, text: str) -> Iterator[tuple[int, int, int]]:
        """(item, start, stop) of the runs of overlapping windows in which an item may lie."""
        starts: dict[int, list[int]] = {}
        for end, places in self.automaton.iter(text):
            for i, last in places:
                starts.setdefault(i, []).append(end - last)
        for i, found in starts.items():
            _, item, edits = self.items[i]
            lo = hi = None
            for start in sorted(set(found)):
                a, b = max(0, start - edits), min(len(text), start + len(item) + edits)
                if hi is None or a >= hi:
                    if hi is not None:
                        yield i, lo, hi
                    lo, hi = a, b
                hi = max(hi, b)
            yield i, lo, hi

    def matches(self, text: str | None, known: dict) -> list[tuple[int, int, int, int]]:
        if not text or not self.items:
            return []
        found = []
        for i, lo, hi in self.windows(text):
            key, item, edits = self.items[i]
            if len(item) < self.min_chars:
                found += [(key, start, start + len(item), 0) for start in whole_copies(item, text, lo, hi)]
                continue
            window = text[lo:hi]
            if (i, window) not in known:
                known[i, window] = all_matches(item, window, edits)
            found += [(key, lo + start, lo + stop, distance) for start, stop, distance in known[i, window]]
        return sorted(found, key=lambda m: (m[0] is None, 0 if m[0] is None else m[0], *m[1:]))


@lru_cache(maxsize=4)
def _searcher(items: tuple[tuple[int | None, str], ...], rate: float, min_chars: int) -> Searcher:
    return Searcher(items, rate, min_chars)


def _blocks(items: DataFrame, id_col: str, text_col: str, block_chars: int) -> Iterator[tuple]:
    kept = items.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where(F.length("text") > 0)
    named = kept.where(F.col("id").isNotNull())
    kept = named.unionByName(kept.where(F.col("id").isNull()).distinct().join(named.select("text"), "text", "left_anti"))
    size = kept.agg(F.sum(F.length("text"))).first()[0] or 0
    n = max(1, -(-size // max(1, block_chars // 2)))  # at half the bound on average, as hashing is uneven
    for b in range(n):
        own = kept.where(F.pmod(F.xxhash64("id", "text"), F.lit(n)) == b) if n > 1 else kept
        rows = tuple(sorted(((r["id"], r["text"]) for r in own.toLocalIterator()), key=lambda r: (r[0] is None, 0 if r[0] is None else r[0], r[1])))
        if rows:
            yield rows


def _search_udf(shared, rate: float, min_chars: int, kind: str):
    def search(texts: pd.Series) -> pd.Series:
        searcher, known = _searcher(shared.value, rate, min_chars), {}
        names = ("item", "start", "stop", "distance")
        return pd.Series([[dict(zip(names, m, strict=True)) for m in searcher.matches(t, known)] for t in texts], dtype=object)

    return F.pandas_udf(search, kind)


def contamination(
    spark: SparkSession,
    text: Column,
    items: DataFrame,
    item_id: str = "item_id",
    item_text: str = "text",
    rate: float = 0.08,
    min_chars: int = 25,
    block_chars: int = 16_000_000,
) -> Column:
    """The matches in a text as a column of (item, start, stop, distance); positions are code points."""
    kind = f"array<struct<item:{items.schema[item_id].dataType.simpleString()},start:int,stop:int,distance:int>>"
    found = []
    for rows in _blocks(items, item_id, item_text, block_chars):
        found.append(_search_udf(spark.sparkContext.broadcast(rows), rate, min_chars, kind)(text))
    return F.concat(*found) if found else F.array().cast(kind)


def find_contamination(spark: SparkSession, docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row for each item found in a document: id, item_id, start, stop, distance."""
    rows = docs.select(id_col, F.col(text_col).alias("_text"))
    found = rows.select(id_col, contamination(spark, F.col("_text"), items, **options).alias("_matches"))
    return found.select(id_col, F.explode("_matches").alias("m")).select(
        id_col, F.col("m.item").alias("item_id"), *[F.col(f"m.{c}").cast("long").alias(c) for c in ("start", "stop", "distance")]
    )


def drop_contaminated(spark: SparkSession, docs: DataFrame, items: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """The rows in which no item is found, with all their columns."""
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(text_col).alias("text"))
    return row.where(F.size(contamination(spark, F.col("text"), items, **options)) == 0).select("row.*")


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_contamination(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
