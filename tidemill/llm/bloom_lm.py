"""Language-model scores from a log-frequency Bloom filter.

The counts of all unigrams and bigrams of the training texts are quantised, level = 1 + floor(log2(count)), and an n-gram
of level q is put into one Bloom filter q times, as (n-gram, 1) to (n-gram, q). Its level is read back by repeated
membership probes, until the first that fails; an error can only raise a level, and raises it by i with a probability of
the false-positive rate to the power i. The filter is blocked: the bits of an entry lie in one 64-bit word, so that a probe
is one look into memory.

Training is one shuffle of n-gram hashes, each task adding up its own first, by the stretch of the filter that all levels
of an n-gram lie in; a task adds up the counts of a stretch and packs it into as many words as its entries need at
``_ENTRY_BITS`` bits each, so that a probe for an absent entry hits with a probability under 1 % at any size of the input.
A filter of at most ``most_bytes`` is broadcast: 128 MB, of which the driver holds three copies for a while and an
executor one for each of its Python workers. A larger one stays in its stretches: texts are dealt into runs, the distinct
n-grams of a run are sent to the stretches they lie in, and their levels come back to the run. Both ways read the same
bits, so scores do not depend on which is taken. There the texts are shuffled once.

p(w | v) = (c(v, w) + m p(w)) / (c(v) + m), with p(w) = (c(w) + 1) / (N + V + 1), c(v, w) at most c(v) and m = ``prior``
(Dirichlet smoothing); c are the counts as the filter has them, a level standing for the middle of its range. The first
word of a text follows the end token.

The base score needs exact unigram counts. Words above a count that at most ``most_head`` words exceed are broadcast; the
others are joined, by row and word hash, so that the result is exact for any vocabulary.

Words are compared by 64-bit hashes. A NULL text counts as an empty one, whose only token is the end. Rows are scored one
by one and training counts every row, so repeated rows count repeatedly; a NULL id is in training. With no training
rows N and V are 0 and every token is unknown. Other columns are not read. Whole texts are read, in time linear in them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm.common import WordHashes, crc_of, encoded, in_small_batches, mixed, staged, table

_ONE = np.uint64(1)
_PAIR = np.uint64(0x9E3779B97F4A7C15)
_STRETCH = 1 << 14  # words of a stretch, where the caller sets the size of the filter
_STRETCH_TOKENS = 1 << 19  # tokens for each stretch, where its entries set its size: a few MB
_ENTRY_BITS = 14  # bits of the filter for each entry
_RUN_CHARS = 16_000_000
END = b" "  # no word holds a space


def _tokens(texts, hashes: WordHashes) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes of all texts, one after the other, and their numbers. Lowest bit 0: a unigram; 1: a bigram."""
    end = hashes[END]
    parts, lengths = [], []
    for text in texts:
        words = hashes.of(encoded(text).lower().split())  # bytes: A-Z only, ASCII white space only
        parts += [words, np.array([end], np.uint64)]
        lengths.append(len(words) + 1)
    tokens = np.concatenate(parts) if parts else np.empty(0, np.uint64)
    return tokens & ~_ONE, np.array(lengths, np.int64)


def _before(tokens: np.ndarray, lengths: np.ndarray, end: np.uint64) -> np.ndarray:
    before = np.empty_like(tokens)
    before[1:] = tokens[:-1]
    before[(np.cumsum(lengths) - lengths)] = end
    return before


def _bigrams(before: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    return mixed(before * _PAIR + tokens) | _ONE


def _runs(texts: Iterable, chars: int = 3_000_000) -> Iterator[list]:
    run, size = [], 0
    for text in texts:
        run.append(text)
        size += len(text or "")
        if size >= chars:
            yield run
            run, size = [], 0
    if run:
        yield run


def _count(orders: tuple[int, ...]):
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = WordHashes(100_000)
        for batch in batches:
            for run in _runs(batch["text"]):
                tokens, lengths = _tokens(run, hashes)
                grams = [tokens] if 1 in orders else []
                if 2 in orders:
                    grams.append(_bigrams(_before(tokens, lengths, np.uint64(hashes[END]) & ~_ONE), tokens))
                for found in grams:
                    gram, n = np.unique(found, return_counts=True)
                    yield pd.DataFrame({"gram": gram.view(np.int64), "n": n.astype(np.int64)})

    return count


def partial_counts(texts: DataFrame, orders: tuple[int, ...]) -> DataFrame:
    """(gram, n) for a frame with a column ``text``; a gram has a row for each stretch of text that was counted together."""
    return texts.mapInPandas(_count(orders), "gram long, n long")


def ngram_counts(texts: DataFrame, orders: tuple[int, ...]) -> DataFrame:
    return partial_counts(texts, orders).groupBy("gram").agg(F.sum("n").alias("n"))


def _stretch(grams: np.ndarray, stretches: int) -> np.ndarray:
    """All levels of an n-gram lie in one stretch of the filter, which one task can fill from the counts alone."""
    return (grams.view(np.int64) >> np.int64(20)) % np.int64(stretches)


def _stretch_of(gram: str, stretches: int) -> Column:
    return F.pmod(F.shiftright(gram, 20), F.lit(stretches).cast("long"))


def _places(grams: np.ndarray, level: np.ndarray, words: np.ndarray | int) -> tuple[np.ndarray, np.ndarray]:
    """Word within its stretch, of ``words`` words, and bits of the entries (gram, level): four, which may fall together."""
    h = mixed(grams + level * _PAIR)
    bits = np.zeros_like(h)
    for i in range(4):
        bits |= _ONE << ((h >> np.uint64(6 * i)) & np.uint64(63))
    return ((h >> np.uint64(24)) % np.asarray(words).astype(np.uint64)).astype(np.int64), bits


def _pack(least: int, entry_bits: int):
    """Packs the counts of a stretch, into at least ``least`` words."""

    def pack(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        grams, which = np.unique(group["gram"].to_numpy().view(np.uint64), return_inverse=True)
        n = np.bincount(which, group["n"].to_numpy())
        levels = np.floor(np.log2(n)).astype(np.int64) + 1
        which = np.repeat(np.arange(len(grams)), levels)
        level = np.arange(len(which)) - np.repeat(np.cumsum(levels) - levels, levels) + 1
        words = max(1, least, -(-len(which) * entry_bits // 64))
        word, bits = _places(grams[which], level.astype(np.uint64), words)
        packed = np.zeros(words, np.uint64)
        np.bitwise_or.at(packed, word, bits)
        return pd.DataFrame({"stretch": [key[0]], "packed": [packed.tobytes()]})

    return pack


def filter_parts(counts: DataFrame, stretches: int, least: int = 0, entry_bits: int = _ENTRY_BITS) -> DataFrame:
    """The filter of (gram, n) rows, in which a gram may repeat: a row (stretch, packed) for each stretch that has entries."""
    stretch = _stretch_of("gram", stretches)
    # Dealt out by the expression, the number of the stretch need not be shuffled along.
    return counts.repartition(stretch).groupBy(stretch.alias("stretch")).applyInPandas(_pack(least, entry_bits), "stretch long, packed binary")


class Filter:
    """All stretches, one after the other; a stretch without entries has one empty word."""

    def __init__(self, parts: dict[int, np.ndarray], stretches: int):
        self.sizes = np.array([max(1, len(parts.get(i, ()))) for i in range(stretches)], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.words = np.zeros(self.sizes.sum(), np.uint64)
        for i, packed in parts.items():
            self.words[self.starts[i] : self.starts[i] + self.sizes[i]] = packed

    def levels(self, grams: np.ndarray) -> np.ndarray:
        stretch = _stretch(grams, len(self.sizes))
        return _levels(self.words, grams, self.starts[stretch], self.sizes[stretch])


def collected(parts: DataFrame, stretches: int) -> Filter:
    rows = parts.toArrow()
    return Filter({i.as_py(): np.frombuffer(p.as_buffer(), np.uint64) for i, p in zip(rows["stretch"], rows["packed"], strict=True)}, stretches)


def build_filter(counts: DataFrame, tokens: int, bits_per_token: float = 4.0, most_bytes: int = 1 << 28) -> np.ndarray:
    """A filter whose size the caller sets, whatever its entries; an array of 64-bit words, at most ``most_bytes`` long."""
    stretches = max(1, min(int(tokens * bits_per_token / 64 / _STRETCH) + 1, most_bytes // 8 // _STRETCH))
    out = np.zeros(stretches * _STRETCH, np.uint64)
    for r in filter_parts(counts, stretches, _STRETCH, 0).toArrow().to_pylist():
        out[r["stretch"] * _STRETCH : (r["stretch"] + 1) * _STRETCH] = np.frombuffer(r["packed"], np.uint64)
    return out


def _levels(packed: np.ndarray, grams: np.ndarray, starts: np.ndarray, sizes: np.ndarray, most: int = 64) -> np.ndarray:
    """The level of each n-gram, whose stretch has ``sizes`` words from ``starts`` on: probes that hit before the first miss."""
    level = np.zeros(len(grams), np.int64)
    left = np.arange(len(grams))
    for q in range(1, most + 1):
        if not len(left):
            break
        word, bits = _places(grams[left], np.array([q], np.uint64), sizes[left])
        left = left[(packed[starts[left] + word] & bits) == bits]
        level[left] = q
    return level


def levels_of(packed: np.ndarray, grams: np.ndarray) -> np.ndarray:
    """The level of each n-gram in a filter of ``build_filter``."""
    return _levels(packed, grams, _stretch(grams, len(packed) // _STRETCH) * _STRETCH, np.full(len(grams), _STRETCH))


#: The middle of each level's range of counts: 1, 2.5, 5.5, 11.5 ...
_MIDDLE = np.concatenate([[0.0], 1.5 * 2.0 ** np.arange(64) - 0.5])


class Model:
    """What the workers need: the filter if it is broadcast, totals, and exact counts of the head words, sorted by hash."""

    def __init__(self, packed: Filter | None, tokens: int, vocabulary: int, head: np.ndarray, counts: np.ndarray, prior: float):
        self.packed, self.tokens, self.vocabulary, self.prior = packed, tokens, vocabulary, prior
        self.head, self.counts = head, counts

    def exact(self, distinct: np.ndarray) -> np.ndarray:
        """Counts of head words, 0 for others."""
        if not len(self.head):
            return np.zeros(len(distinct), np.int64)
        at = np.minimum(np.searchsorted(self.head, distinct), len(self.head) - 1)
        return np.where(self.head[at] == distinct, self.counts[at], 0)

    def logs(self, tokens: np.ndarray, lengths: np.ndarray, end: np.uint64, levels: Callable) -> np.ndarray:
        """log10 p of each token given the one before."""
        before = _before(tokens, lengths, end)
        distinct, which = np.unique(tokens, return_inverse=True)
        single = _MIDDLE[levels(distinct)]
        start = _MIDDLE[levels(np.array([end]))][0]
        own = single[which]
        context = np.empty_like(own)
        context[1:] = own[:-1]
        context[np.cumsum(lengths) - lengths] = start
        pair = np.minimum(_MIDDLE[levels(_bigrams(before, tokens))], context)
        unigram = (own + 1) / (self.tokens + self.vocabulary + 1)
        return np.log10((pair + self.prior * unigram) / (context + self.prior))


_SCORED = "struct<n_tokens:long,score:double,known:long,logs:double,rare:array<struct<gram:long,n:int>>>"


@lru_cache(maxsize=1)
def _hashes() -> WordHashes:
    """Of a worker; not kept by broadcast, whose filter would stay with it."""
    return WordHashes(100_000)


def _scored(model: Model, hashes: WordHashes, tokens: np.ndarray, lengths: np.ndarray, levels: Callable) -> pa.StructArray:
    starts = np.cumsum(lengths) - lengths
    score = np.add.reduceat(model.logs(tokens, lengths, np.uint64(hashes[END]) & ~_ONE, levels), starts)
    distinct, which = np.unique(tokens, return_inverse=True)
    exact = model.exact(distinct)[which]
    known = np.add.reduceat((exact > 0).astype(np.int64), starts)
    base = np.add.reduceat(np.log10(exact + 1.0), starts)
    # Words outside the head, counted per text.
    rest = np.flatnonzero(exact == 0)
    text = np.searchsorted(starts, rest, "right") - 1
    gram = tokens[rest].view(np.int64)
    order = np.lexsort((gram, text))
    text, gram = text[order], gram[order]
    first = np.flatnonzero(np.append(True, (text[1:] != text[:-1]) | (gram[1:] != gram[:-1]))) if len(rest) else rest
    times = np.diff(np.append(first, len(rest))).astype(np.int32)
    words = pa.StructArray.from_arrays([pa.array(gram[first]), pa.array(times)], ["gram", "n"])
    ends = np.searchsorted(text[first], np.arange(len(lengths) + 1)).astype(np.int32)
    columns = {"n_tokens": pa.array(lengths), "score": pa.array(score), "known": pa.array(known), "logs": pa.array(base),
               "rare": pa.ListArray.from_arrays(pa.array(ends), words)}
    return pa.StructArray.from_arrays(list(columns.values()), list(columns))


def _score_udf(shared):
    def scored(texts: pa.Array) -> pa.Array:
        hashes, model = _hashes(), shared.value
        return pa.concat_arrays([_scored(model, hashes, *_tokens(run, hashes), model.packed.levels) for run in _runs(texts.to_pylist(), 1_000_000)])

    return F.arrow_udf(scored, _SCORED)


def _wanted(tokens: np.ndarray, lengths: np.ndarray, end: np.uint64) -> np.ndarray:
    """The distinct n-grams whose levels a run needs, sorted."""
    return np.unique(np.concatenate([tokens, _bigrams(_before(tokens, lengths, end), tokens), np.array([end], np.uint64)]))


def _ask(stretches: int):
    """The n-grams of a run by the stretch they lie in; within a stretch they are sorted."""
    hashes = WordHashes()

    def ask(run: pa.Table) -> pa.Table:
        tokens, lengths = _tokens(run["text"].to_pylist(), hashes)
        grams = _wanted(tokens, lengths, np.uint64(hashes[END]) & ~_ONE)
        stretch = _stretch(grams, stretches)
        order = np.argsort(stretch, kind="stable")
        found, first = np.unique(stretch[order], return_index=True)
        sent = pa.array([g.tobytes() for g in np.split(grams[order], first[1:])], pa.binary())
        return pa.table({"run": pa.array(np.full(len(found), run["run"][0].as_py())), "stretch": pa.array(found), "grams": sent})

    return ask


def _answer(asked: pa.Table, part: pa.Table) -> pa.Table:
    """The levels of the n-grams asked of a stretch, a byte for each."""
    packed = np.frombuffer(part["packed"][0].as_py(), np.uint64) if part.num_rows else np.zeros(1, np.uint64)
    sent = asked["grams"].to_pylist()
    grams = np.frombuffer(b"".join(sent), np.uint64)
    level = _levels(packed, grams, np.zeros(len(grams), np.int64), np.full(len(grams), len(packed))).astype(np.uint8).tobytes()
    ends = np.cumsum([0, *(len(s) // 8 for s in sent)]).tolist()
    answers = [level[a:b] for a, b in zip(ends, ends[1:], strict=False)]
    return pa.table({"run": asked["run"].cast(pa.int64()), "stretch": asked["stretch"].cast(pa.int64()), "levels": pa.array(answers, pa.binary())})


def _score_run(shared, stretches: int):
    def score(rows: pa.Table, answers: pa.Table) -> pa.Table:
        hashes = _hashes()
        tokens, lengths = _tokens(rows["text"].to_pylist(), hashes)
        grams = _wanted(tokens, lengths, np.uint64(hashes[END]) & ~_ONE)
        order = np.argsort(_stretch(grams, stretches), kind="stable")
        got = np.frombuffer(b"".join(answers.sort_by("stretch")["levels"].to_pylist()), np.uint8)
        if len(got) != len(grams):
            raise RuntimeError(f"{len(got)} levels for the {len(grams)} n-grams of a run: its rows have changed between two reads")
        level = np.empty(len(grams), np.int64)
        level[order] = got
        found = _scored(shared.value, hashes, tokens, lengths, lambda some: level[np.searchsorted(grams, some)])
        return pa.Table.from_arrays([rows["id"], rows["at"], *found.flatten()], ["id", "at", *(f.name for f in found.type)])

    return score


def _scored_in_stretches(shared, rows: DataFrame, parts: DataFrame, stretches: int, chars: int) -> DataFrame:
    """Scores where the filter is too large to be broadcast. A stretch is asked for an n-gram once for each run."""
    runs = max(1, chars // _RUN_CHARS)
    dealt = rows.withColumn("run", F.pmod(F.xxhash64("at"), F.lit(runs).cast("long")))
    asked = dealt.groupBy("run").applyInArrow(_ask(stretches), "run long, stretch long, grams binary")
    answers = asked.groupBy("stretch").cogroup(parts.groupBy("stretch")).applyInArrow(_answer, "run long, stretch long, levels binary")
    fields = _SCORED[len("struct<") : -1]
    schema = f"id {rows.schema['id'].dataType.simpleString()}, at long, " + ", ".join(fields.split(",", 4)).replace(":", " ", 4)
    return dealt.groupBy("run").cogroup(answers.groupBy("run")).applyInArrow(_score_run(shared, stretches), schema)


def _head(unigrams: DataFrame, most_head: int) -> DataFrame:
    """The words above a count, so chosen that there are at most ``most_head`` of them."""
    step = F.floor(F.log2("n") * 8).cast("int")
    sizes = unigrams.groupBy(step.alias("step")).count().orderBy(F.desc("step")).collect()  # at most 8 for each power of two
    least, total = None, 0
    for r in sizes:
        total += r["count"]
        if total > most_head:
            break
        least = r["step"]
    return unigrams.where(step >= least) if least is not None else unigrams.limit(0)


def score_texts(
    spark: SparkSession,
    docs: DataFrame,
    train: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    prior: float = 8.0,
    bits_per_token: float = 0.0,
    most_bytes: int = 1 << 27,
    most_head: int = 500_000,
) -> DataFrame:
    """Per row: id, n_tokens, n_known, train_tokens, base_score, score. ``train`` says which rows are learned from.

    The filter has at least ``bits_per_token`` bits for each training token, and is broadcast up to ``most_bytes``.
    """
    in_small_batches(spark)
    texts = docs.where(train).select(F.col(text_col).alias("text"))
    unigrams = staged(ngram_counts(texts, (1,)), "unigrams")
    total = unigrams.agg(F.sum("n").alias("n"), F.count("*").alias("v")).first()
    tokens, vocabulary = total["n"] or 0, total["v"]
    chars = docs.agg(F.sum(F.length(text_col))).first()[0] or 0
    stretches = 1 + max(tokens, chars // 8) // _STRETCH_TOKENS  # by all texts, as they are what a stretch is asked for
    least = int(tokens * bits_per_token / 64 / stretches)
    parts = staged(filter_parts(partial_counts(texts, (1, 2)), stretches, least), "stretches")
    size = parts.agg(F.sum(F.length("packed"))).first()[0] or 0
    packed = collected(parts, stretches) if size <= most_bytes else None
    head = _head(unigrams, most_head).toArrow().sort_by("gram")
    grams = head.column("gram").to_numpy().view(np.uint64)
    order = np.argsort(grams)
    model = Model(packed, tokens, vocabulary, grams[order], head.column("n").to_numpy()[order], prior)
    shared = spark.sparkContext.broadcast(model)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.monotonically_increasing_id().alias("at"))
    if packed is not None:
        found = rows.withColumn("found", _score_udf(shared)("text")).select("id", "at", "found.*")
    else:
        found = _scored_in_stretches(shared, rows, parts, stretches, chars)
    scored = staged(found, "scored")
    shared.destroy()
    rare = (
        scored.select("at", F.explode("rare").alias("w"))
        .select("at", "w.gram", F.col("w.n").alias("times"))
        .join(unigrams, "gram")
        .groupBy("at")
        .agg(F.sum("times").alias("more_known"), F.sum(F.col("times") * F.log10(F.col("n") + 1.0)).alias("more_logs"))
    )
    return scored.drop("rare").join(rare, "at", "left").select(
        F.col("id").alias(id_col),
        "n_tokens",
        (F.col("known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("logs") + F.coalesce("more_logs", F.lit(0.0)) - F.col("n_tokens") * float(np.log10(tokens + vocabulary + 1))).alias("base_score"),
        "score",
    )


def op10_bloom_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.pmod(crc_of("doc_id"), F.lit(7)) == 2
    scored = score_texts(spark, docs, ~held_out)
    return scored.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
