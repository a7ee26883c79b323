"""Phrases of two and three words that belong together, counted by counting quotient filters.

Words get ids of 21 bits, apart for each language, so that up to three of them pack into one 63-bit number. An invertible
permutation spreads these numbers over 64 bits, of which the upper ones name a region, the next ones are the quotient and
all that are left the remainder. Of a sorted stretch of numbers a filter stores

* for each quotient the number of its entries in unary (as many bits as there are quotients and entries),
* for each entry its remainder, in full, in as many bytes as it needs,
* for each entry its count in one byte, and counts of 255 and more apart.

Nothing is lost: region, quotient and remainder give back the number, and its inverse permutation the words. A task counts
the n-grams of a stretch of texts and sends one filter to each region it has entries for; a region merges its sorted
filters by adding the counts of equal entries. A frequent phrase is one entry of each filter, so no region gets more than
its share, whatever the language or phrase.

Only words that occur ``min_count`` times can be in a phrase that does, so only these get ids, from the exact counts of all
words. They are broadcast, as far as 2^21 - 1 words and ``most_bytes`` of them go, the most frequent first. N-grams with a
word beyond that are counted as text, by one more pass, with the same result.

Everything holds for each language apart; no language counts as ``und``. A NULL text counts as an empty one. A-Z become lower case;
texts are cut into pieces at ``.,;:!?`` and line ends, and pieces into words at spaces and tabs; phrases do not cross
pieces. Repeated rows count repeatedly, ids are not read, and other columns are left alone. Whole texts are read, in
linear time, and a word may be of any length. Scores are exact: products are decimals of up to 38 digits, enough for
counts under 10^15. An empty table gives an empty result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemill.llm.common import mixed, staged, table

_ID_BITS = 21
_MOST_WORDS = (1 << _ID_BITS) - 1
_STRETCH_BYTES = 12 << 20
_REGION = 1 << 21  # entries of a region, at most, if none were equal
_PARTS = 128  # in which the phrases of a language are sorted first
_BREAK = b"\xff"  # in no UTF-8 text
_CUTS = b".,;:!?\n\x0b\x0c\r"
_TO_SPACE = bytes.maketrans(_CUTS + b"\t", b" " * (len(_CUTS) + 1))
_TO_BREAK = bytes.maketrans(_CUTS + b"\t", _BREAK * len(_CUTS) + b" ")

_U = np.uint64
#: Inverses, modulo 2^64, of the multipliers of ``mixed``.
_BACK = [_U(pow(m, -1, 1 << 64)) for m in (0xC4CEB9FE1A85EC53, 0xFF51AFD7ED558CCD)]


def unmixed(x: np.ndarray) -> np.ndarray:
    """The numbers of which ``mixed`` makes ``x``; a shift by more than half undoes itself."""
    for back in _BACK:
        x = (x ^ (x >> _U(33))) * back
    return x ^ (x >> _U(33))


def packed_filter(entries: np.ndarray, counts: np.ndarray, region_bits: int) -> bytes:
    """The filter of sorted, different numbers of one region."""
    n = len(entries)
    quotient_bits = min(max(n - 1, 0).bit_length(), 64 - region_bits)
    low = 64 - region_bits - quotient_bits
    within = entries & _U((1 << (64 - region_bits)) - 1)
    quotient = (within >> _U(low)).astype(np.int64) if low < 64 else np.zeros(n, np.int64)
    unary = np.zeros(n + (1 << quotient_bits), np.uint8)
    unary[quotient + np.arange(n)] = 1
    width = -(-low // 8)
    remainder = (within & _U((1 << low) - 1)).astype("<u8").view(np.uint8).reshape(n, 8)[:, :width]
    small = np.minimum(counts, 255).astype(np.uint8)
    head = np.array([n, quotient_bits], "<i8")
    large = counts[counts >= 255].astype("<i8")
    return b"".join(part.tobytes() for part in (head, np.packbits(unary), np.ascontiguousarray(remainder), small, large))


def unpacked_filter(data: bytes, region: int, region_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The sorted numbers of a filter and their counts."""
    n, quotient_bits = (int(x) for x in np.frombuffer(data, "<i8", 2))
    low = 64 - region_bits - quotient_bits
    width = -(-low // 8)
    bits = n + (1 << quotient_bits)
    at = 16
    unary = np.unpackbits(np.frombuffer(data, np.uint8, -(-bits // 8), at), count=bits)
    at += -(-bits // 8)
    quotient = (np.flatnonzero(unary) - np.arange(n)).astype(np.uint64)
    remainder = np.zeros((n, 8), np.uint8)
    remainder[:, :width] = np.frombuffer(data, np.uint8, n * width, at).reshape(n, width)
    at += n * width
    counts = np.frombuffer(data, np.uint8, n, at).astype(np.int64)
    counts[counts == 255] = np.frombuffer(data, "<i8", -1, at + n)
    entries = remainder.view("<u8").reshape(n).astype(np.uint64)
    if low < 64:
        entries |= quotient << _U(low)
    if region_bits:
        entries |= _U(region) << _U(64 - region_bits)
    return entries, counts


def merged(filters: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted filters as one: counts of equal entries are added."""
    entries = np.concatenate([np.empty(0, np.uint64), *(f[0] for f in filters)])
    counts = np.concatenate([np.empty(0, np.int64), *(f[1] for f in filters)])
    order = np.argsort(entries, kind="stable")
    entries, counts = entries[order], counts[order]
    first = np.flatnonzero(np.append(True, entries[1:] != entries[:-1])) if len(entries) else order
    return entries[first], np.add.reduceat(counts, first) if len(first) else counts


def _stretches(batches: Iterator[pa.RecordBatch], stretch_bytes: int) -> Iterator[dict[str, bytes]]:
    """The texts of each language, lower-cased and put together, for stretches of the input."""
    held: dict[str, list[bytes]] = {}
    size = 0
    for batch in batches:
        for lang, text in zip(batch["lang"].to_pylist(), batch["text"], strict=True):
            body = text.as_py()
            held.setdefault(lang, []).append(body)
            size += len(body)
            if size >= stretch_bytes:
                yield {k: _BREAK.join(v).lower() for k, v in held.items()}
                held, size = {}, 0
    if held:
        yield {k: _BREAK.join(v).lower() for k, v in held.items()}


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, word, n) of each stretch, and with a NULL word the number of all words of the language."""
    for stretch in _stretches(batches, _STRETCH_BYTES):
        for lang, body in stretch.items():
            words = body.replace(_BREAK, b" ").translate(_TO_SPACE).split()
            counts = Counter(words)
            found = pa.array([*counts, None], pa.binary()).cast(pa.string())
            n = pa.array([*counts.values(), len(words)], pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(n), pa.string()), found, n], ["lang", "word", "n"])


@lru_cache(maxsize=1)
def _ids(shared) -> dict[str, dict[bytes, int]]:
    """The id of each word, by language: its place in the broadcast, from 1."""
    out: dict[str, dict[bytes, int]] = {}
    at = 1
    for lang, words in shared.value:
        out[lang] = dict(zip(words.cast(pa.binary()).to_pylist(), range(at, at + len(words)), strict=True))
        at += len(words)
    return out


def _words(body: bytes) -> list[bytes]:
    return body.translate(_TO_BREAK).replace(_BREAK, b" \xff ").split()


def _filters(shared, region_bits: int, stretch_bytes: int):
    """(region, filter) of the two- and three-word n-grams of each stretch."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = _ids(shared)
        for stretch in _stretches(batches, stretch_bytes):
            grams = []
            for lang, body in stretch.items():
                get = ids_of.get(lang, {}).get
                words = _words(body)
                ids = np.fromiter(map(get, words, repeat(0)), np.uint64, len(words))
                del words
                two = (ids[:-1] << _U(_ID_BITS)) | ids[1:]
                both = (ids[:-1] > 0) & (ids[1:] > 0)
                three = (two[:-1] << _U(_ID_BITS)) | ids[2:]
                grams += [two[both], three[both[:-1] & both[1:]]] if len(ids) > 2 else [two[both]]
            entries, counts = np.unique(mixed(np.concatenate(grams)), return_counts=True)
            if not len(entries):
                continue
            region = (entries >> _U(64 - region_bits)).astype(np.int64) if region_bits else np.zeros(len(entries), np.int64)
            named, first = np.unique(region, return_index=True)
            ends = np.append(first[1:], len(entries))
            for r, a, b in zip(named.tolist(), first.tolist(), ends.tolist(), strict=True):
                yield pa.RecordBatch.from_pydict({"region": [r], "filter": [packed_filter(entries[a:b], counts[a:b], region_bits)]})

    return count


def _merging(region_bits: int, min_count: int):
    def merge(key: tuple, rows: pa.Table) -> pa.Table:
        region = key[0].as_py()
        entries, counts = merged([unpacked_filter(f.as_py(), region, region_bits) for f in rows["filter"]])
        often = counts >= min_count
        return pa.table({"gram": pa.array(unmixed(entries[often]).view(np.int64)), "n": pa.array(counts[often])})

    return merge


def _texts(shared, stretch_bytes: int):
    """(lang, words, n) of the n-grams of each stretch that hold a word without an id."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = _ids(shared)
        for stretch in _stretches(batches, stretch_bytes):
            for lang, body in stretch.items():
                known, words = ids_of.get(lang, {}), _words(body)
                grams: Counter[tuple[bytes, ...]] = Counter()
                for size in (2, 3):
                    for gram in zip(*(words[i:] for i in range(size)), strict=False):
                        if _BREAK not in gram and any(w not in known for w in gram):
                            grams[gram] += 1
                texts = pa.array([[w.decode("utf-8", "replace") for w in g] for g in grams], pa.list_(pa.string()))
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(texts), pa.string()), texts, pa.array(list(grams.values()), pa.int64())], ["lang", "words", "n"])

    return count


def _most_frequent(words: DataFrame, most_words: int, most_bytes: int) -> DataFrame:
    """The words above a count, so chosen that they keep to both bounds."""
    step = F.floor(F.log2("n") * 8).cast("int")
    sizes = words.groupBy(step.alias("step")).agg(F.count("*").alias("words"), F.sum(F.octet_length("word") + 1).alias("bytes"))
    least, n, size = None, 0, 0
    for r in sizes.orderBy(F.desc("step")).collect():  # at most 8 for each power of two
        n, size = n + r["words"], size + r["bytes"]
        if n > most_words or size > most_bytes:
            break
        least = r["step"]
    return words.where(step >= least) if least is not None else words.limit(0)


def _by_lang(numbered: DataFrame) -> tuple[list[tuple[str, pa.Array]], int]:
    """The words of each language in the order of their ids, and the number of all."""
    words = numbered.toArrow().sort_by("id").combine_chunks()
    if not words.num_rows:
        return [], 0
    lang = words["lang"].combine_chunks().dictionary_encode()
    first = np.flatnonzero(np.append(True, np.diff(lang.indices.to_numpy()) != 0))
    ends = [*first[1:], words.num_rows]
    return [(words["lang"][int(a)].as_py(), pa.concat_arrays([words["word"].slice(int(a), int(b - a)).combine_chunks()])) for a, b in zip(first, ends, strict=True)], words.num_rows


def frequent_phrases(
    spark: SparkSession, docs: DataFrame, words: DataFrame, min_count: int, most_words: int, most_bytes: int, stretch_bytes: int, region: int
) -> DataFrame:
    """(lang, words, n) of the two- and three-word phrases that occur ``min_count`` times. ``docs`` has lang and text
    (binary), ``words`` the frequent words (lang, word, n)."""
    counted = words.agg(F.count("*").alias("words"), F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()
    head = _most_frequent(words, most_words, most_bytes)
    # One task numbers the words, of which there are no more than ids.
    numbered = staged(head.select("lang", "word", F.row_number().over(Window.orderBy("lang", "word")).cast("long").alias("id")), "ids")
    listed, with_id = _by_lang(numbered)
    shared = spark.sparkContext.broadcast(listed)
    region_bits = (2 * counted["n"] // region).bit_length()
    filters = docs.mapInArrow(_filters(shared, region_bits, stretch_bytes), "region long, filter binary")
    grams = staged(filters.groupBy("region").applyInArrow(_merging(region_bits, min_count), "gram long, n long"), "grams")
    mask = F.lit(_MOST_WORDS).cast("long")
    last = grams.select(
        F.shiftright("gram", 2 * _ID_BITS).alias("a"),
        F.shiftright("gram", _ID_BITS).bitwiseAND(mask).alias("b"),
        F.col("gram").bitwiseAND(mask).alias("c"),
        "n",
    )
    for name in "abc":
        own = numbered.select(F.col("id").alias(name), F.col("word").alias(f"{name}_word"), *([F.col("lang")] if name == "c" else []))
        last = last.join(own, name, "left")
    found = last.select("lang", F.array_compact(F.array("a_word", "b_word", "c_word")).alias("words"), "n")
    if with_id == counted["words"]:
        return found
    rest = docs.mapInArrow(_texts(shared, stretch_bytes), "lang string, words array<string>, n long")
    rest = rest.groupBy("lang", "words").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)
    return found.unionByName(rest)


def _score(a: Column, left: Column, right: Column) -> Column:
    wide = lambda c: c.cast("decimal(15,0)")
    return F.call_function("div", F.lit(1_000_000).cast("decimal(7,0)") * wide(a) * wide(a), wide(left) * wide(right)).cast("long")


def _top(phrases: DataFrame, top: int, *by: str) -> DataFrame:
    best = Window.partitionBy(*by).orderBy(F.desc("score"), F.desc("a"), "phrase")
    return phrases.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)


def collocations(
    spark: SparkSession,
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    min_count: int = 10,
    top: int = 2000,
    inside_percent: int = 50,
    most_words: int = _MOST_WORDS,
    most_bytes: int = 64 << 20,
    stretch_bytes: int = _STRETCH_BYTES,
    region: int = _REGION,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` phrases of each language.

    A phrase of two or three words that occurs ``a >= min_count`` times is cut after its first or second word, whichever
    gives the lower score 1,000,000 a a / (l r), rounded down, from the counts ``l`` and ``r`` of both parts. A phrase of which at least
    ``inside_percent`` of the occurrences lie inside the same longer one is left out. ``n`` counts the words of the language.
    """
    texts = docs.select(
        F.coalesce(F.col(lang_col), F.lit("und")).alias("lang"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text")
    )
    counts = texts.mapInArrow(_word_counts, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    counts = staged(counts.where(F.col("word").isNull() | (F.col("n") >= min_count)), "words")
    totals = counts.where("word IS NULL").select("lang", F.col("n").alias("total"))
    words = counts.where("word IS NOT NULL")
    phrases = staged(frequent_phrases(spark, texts, words, min_count, min(most_words, _MOST_WORDS), most_bytes, stretch_bytes, region), "phrases")

    part = F.col("words")
    single = lambda name, at: words.select("lang", F.col("word").alias(f"word{at}"), F.col("n").alias(name))
    pair = lambda name, at: phrases.where(F.size("words") == 2).select(
        "lang", part[0].alias(f"word{at}"), part[1].alias(f"word{at + 1}"), F.col("n").alias(name)
    )
    placed = lambda size: phrases.where(F.size("words") == size).select(
        "lang", "words", F.col("n").alias("a"), *[part[i].alias(f"word{i}") for i in range(size)]
    )
    a = F.col("a")

    def cut(k: int, left: str, right: str) -> Column:
        return F.struct(_score(a, F.col(left), F.col(right)).alias("score"), F.lit(k).alias("k"), F.col(left).alias("l"), F.col(right).alias("r"))

    twos = placed(2).join(single("n0", 0), ["lang", "word0"]).join(single("n1", 1), ["lang", "word1"])
    threes = (
        placed(3)
        .join(single("n0", 0), ["lang", "word0"])
        .join(pair("n12", 1), ["lang", "word1", "word2"])
        .join(pair("n01", 0), ["lang", "word0", "word1"])
        .join(single("n2", 2), ["lang", "word2"])
    )
    inner = placed(3).select("lang", F.explode(F.array(F.struct("word0", "word1"), F.struct(F.col("word1").alias("word0"), F.col("word2").alias("word1")))).alias("w"), "a")
    longest = inner.groupBy("lang", "w.word0", "w.word1").agg(F.max("a").alias("longer"))
    apart = twos.join(longest, ["lang", "word0", "word1"], "left").where(100 * F.coalesce("longer", F.lit(0)) < inside_percent * a)
    scored = apart.select("lang", "words", "a", cut(1, "n0", "n1").alias("cut")).unionByName(
        threes.select("lang", "words", "a", F.least(cut(1, "n0", "n12"), cut(2, "n01", "n2")).alias("cut"))
    )
    listed = scored.select("lang", F.concat_ws(" ", "words").alias("phrase"), "a", "cut.l", "cut.r", "cut.score")
    # First within parts of a language, so that none of them is sorted in one task.
    dealt = listed.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(_PARTS)))
    ranked = _top(_top(dealt, top, "lang", "part").drop("part", "rank"), top, "lang")
    return ranked.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", F.col("total").alias("n"), "score"
    )


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(spark, table(spark, sf_dir, "documents"))


OP12_SQL = r"""
WITH d AS (
    SELECT coalesce(lang, 'und') AS lang, row_number() OVER () AS doc,
           string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]') AS pieces
    FROM documents),
p AS (
    SELECT lang, doc, unnest(generate_series(1, len(pieces))) AS piece, unnest(pieces) AS text FROM d),
w AS (
    SELECT lang, doc, piece, unnest(generate_series(1, len(words))) AS place, unnest(words) AS word
    FROM (SELECT lang, doc, piece, regexp_extract_all(text, '[^\x20\x09]+') AS words FROM p)),
g AS (
    SELECT lang, word AS w1, lead(word) OVER o AS w2, lead(word, 2) OVER o AS w3 FROM w
    WINDOW o AS (PARTITION BY doc, piece ORDER BY place)),
one AS (SELECT lang, w1, count(*) AS n FROM g GROUP BY ALL),
total AS (SELECT lang, CAST(sum(n) AS BIGINT) AS n FROM one GROUP BY lang),
two AS (SELECT lang, w1, w2, count(*) AS n FROM g WHERE w2 IS NOT NULL GROUP BY ALL HAVING count(*) >= 10),
three AS (SELECT lang, w1, w2, w3, count(*) AS n FROM g WHERE w3 IS NOT NULL GROUP BY ALL HAVING count(*) >= 10),
longer AS (
    SELECT lang, w1, w2, max(n) AS n
    FROM (SELECT lang, w1, w2, n FROM three UNION ALL SELECT lang, w2, w3, n FROM three) GROUP BY ALL),
cuts AS (
    SELECT t.lang, t.w1 || ' ' || t.w2 AS phrase, t.n AS a, 1 AS k, x.n AS l, y.n AS r
    FROM two t
    JOIN one x ON x.lang = t.lang AND x.w1 = t.w1
    JOIN one y ON y.lang = t.lang AND y.w1 = t.w2
    LEFT JOIN longer o ON o.lang = t.lang AND o.w1 = t.w1 AND o.w2 = t.w2
    WHERE 100 * coalesce(o.n, 0) < 50 * t.n
    UNION ALL
    SELECT t.lang, t.w1 || ' ' || t.w2 || ' ' || t.w3, t.n, 1, x.n, y.n
    FROM three t
    JOIN one x ON x.lang = t.lang AND x.w1 = t.w1
    JOIN two y ON y.lang = t.lang AND y.w1 = t.w2 AND y.w2 = t.w3
    UNION ALL
    SELECT t.lang, t.w1 || ' ' || t.w2 || ' ' || t.w3, t.n, 2, x.n, y.n
    FROM three t
    JOIN two x ON x.lang = t.lang AND x.w1 = t.w1 AND x.w2 = t.w2
    JOIN one y ON y.lang = t.lang AND y.w1 = t.w3),
scored AS (
    SELECT *, CAST((1000000 * CAST(a AS HUGEINT) * a) // (CAST(l AS HUGEINT) * r) AS BIGINT) AS score FROM cuts),
lowest AS (
    SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1)
SELECT lang, rank, phrase, a, l, r, total.n AS n, score
FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM lowest)
JOIN total USING (lang)
WHERE rank <= 2000
"""
