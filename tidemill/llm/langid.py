"""Language of each word by a linear-chain conditional random field, and from that the language of a text.

The states are the languages of the training rows. A word's score for a state is a sum of learned weights of its
features: prefixes and suffixes of up to three letters, letter 2- and 3-grams, the word itself if the lexicon has it, and
the language the lexicon holds it for. Transitions between neighbouring words are learned too. Forward-backward gives each
word its probability of each language; a text's language has the largest mean over its words, and that mean is the score.

Training: the field is fitted on the driver to at most ``per_language`` labelled rows of each language and
``most_languages`` languages (others are never predicted), chosen by a hash of their ids, and to at most ``row_words`` words
of a row, in whole chunks of 64 words chosen by a hash from all of the row's text; words of over 100 letters are left out.
These bounds are parameters. The chunks are cut by the tasks, so the driver gets no whole texts. Some chunks are spliced from
two of different languages, at a word that is known, which is what the moves between languages are learned from. The
lexicon is part of the model. Prediction reads whole texts, in
batches whose words are handled together by numpy; every letter of a word is looked at, and a text's work is linear in its
length.

A NULL text, or one without a letter, is ``und`` with score 0. Words without a letter pass the chain on but have no say.
Ties between languages go to the first in order of name. If no labelled row exists, every text is ``und``; ``keep_known`` then
keeps all texts that have a letter, as nothing says that any is of no known language. Otherwise it rejects a text whose letter
3-grams are strange: the share of them that the training words have is under half of the least in the labelled rows that were kept apart (with
fewer than 30 such rows none is strange). Rows are
predicted one by one, so repeated rows get repeated results; other columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemill.llm.common import crc_of, in_small_batches, mixed, table

UNKNOWN = "und"
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_SLOTS = 1 << 17
_LETTERS = 400_000  # of the words whose features are computed together
_LONG = 100  # letters of a word that is not learned from
_SEEN = 1 << 20  # bits for the 3-grams of the training words
_SOME = 5  # 3-grams that any text is credited with, so that a few strange ones do not tell
_RESULT = "struct<lang:string,score:double,words:long>"


def has_letter(text: str) -> bool:
    return text.isalpha() or any(map(str.isalpha, text))


class Lexicon(dict):
    """Words of the training rows seen at least ``least`` times, with the language that has most of them."""

    @classmethod
    def learn(cls, rows: list[tuple[list[str], int]], least: int = 3) -> Lexicon:
        counts: dict[str, Counter] = {}
        for words, lang in rows:
            for w in words:
                counts.setdefault(w, Counter())[lang] += 1
        found = ((w, c.most_common(1)[0]) for w, c in counts.items() if c.total() >= least)
        return cls((w, (lang, n / counts[w].total() >= 0.9)) for w, (lang, n) in found)


def _slots(sort: int, *codes: np.ndarray) -> np.ndarray:
    """Slots of features of a sort from the codes of their letters. Equal features always get the same slot."""
    h = np.full(len(codes[0]), sort, np.uint64)
    for c in codes:
        h = mixed(h * np.uint64(0x9E3779B97F4A7C15) + c)
    return (h % np.uint64(_SLOTS)).astype(np.int64)


def word_features(words: list[str], lexicon: Lexicon) -> tuple[np.ndarray, np.ndarray]:
    """Slots of the features of lower-cased words, and which word each is of. A word without a letter has none.

    All words are handled together: their marked letters lie in one array, and a feature is a few neighbours in it.
    """
    own = np.array([i for i, w in enumerate(words) if has_letter(w)], np.int64)
    if not len(own):
        return own, own
    marked = [f"^{words[i]}$" for i in own]
    code = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    size = np.fromiter(map(len, marked), np.int64, len(marked))
    end = np.cumsum(size) - 1
    start = end + 1 - size
    word = np.repeat(np.arange(len(own)), size)
    left = np.repeat(end, size) - np.arange(len(code))  # letters after this one
    two, three = np.flatnonzero(left >= 1), np.flatnonzero(left >= 2)
    first = [code[np.minimum(start + k, end)] for k in (1, 2, 3)]
    last = [code[np.maximum(end - k, start)] for k in (1, 2, 3)]
    every = np.arange(len(own))
    found = [(_slots(1, code[two], code[two + 1]), word[two]), (_slots(2, code[three], code[three + 1], code[three + 2]), word[three])]
    found += [(_slots(2 + k, *first[:k]), every) for k in (1, 2, 3)] + [(_slots(5 + k, *last[:k]), every) for k in (1, 2, 3)]
    known = [(i, *lexicon[words[w]], xxhash.xxh64_intdigest(words[w].encode("utf-8", "surrogatepass"))) for i, w in enumerate(own) if words[w] in lexicon]
    if known:
        at, lang, sure, itself = (np.array(x, t) for x, t in zip(zip(*known, strict=True), (np.int64, np.uint64, np.uint64, np.uint64), strict=True))
        found += [(_slots(9, itself), at), (_slots(10, lang, sure), at)]
    return np.concatenate([f for f, _ in found]), own[np.concatenate([w for _, w in found])]


def trigrams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """A number for each letter 3-gram of the lower-cased words, marks at both ends included, and which word it is of."""
    marked = [f"^{w}$" for w in words]
    code = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    size = np.fromiter(map(len, marked), np.int64, len(marked))
    left = np.repeat(np.cumsum(size), size) - np.arange(len(code))
    at = np.flatnonzero(left >= 3)
    h = mixed((code[at] << np.uint64(42)) | (code[at + 1] << np.uint64(21)) | code[at + 2])
    return (h % np.uint64(_SEEN)).astype(np.int64), np.repeat(np.arange(len(marked)), size)[at]


class Field:
    """Weights of a fitted field."""

    def __init__(self, langs: list[str], lexicon: Lexicon):
        self.langs, self.lexicon = langs, lexicon
        self.weights = np.zeros((_SLOTS, len(langs)), np.float32)
        self.moves = np.zeros((len(langs), len(langs)), np.float32)
        self.seen = np.zeros(_SEEN, bool)

    def emissions(self, words: list[str]) -> np.ndarray:
        """The score of each word for each language."""
        slots, word = word_features(words, self.lexicon)
        return np.stack([np.bincount(word, self.weights[slots, k], len(words)) for k in range(len(self.langs))], 1).astype(np.float32)

    def emissions_in_parts(self, words: list[str]) -> np.ndarray:
        """The same, by parts of about ``_LETTERS`` letters; a word is never cut."""
        part = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 2) // _LETTERS
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1), len(words)]
        return np.concatenate([self.emissions(words[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)])


def forward_backward(scores: np.ndarray, lengths: np.ndarray, moves: np.ndarray, learning: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Marginals of each word, and when learning the summed probabilities of each move.

    ``scores`` holds the words of all sequences one after the other; ``lengths`` says where they end. Sequences are
    stepped together, the longest first, so that those still running are always the first ones.
    """
    k = scores.shape[1]
    order = np.argsort(-lengths, kind="stable")
    sizes = lengths[order]
    longest = int(sizes[0]) if len(sizes) else 0
    active = np.searchsorted(-sizes, -np.arange(longest), "left")  # sequences longer than t
    begin = np.cumsum(active) - active
    rank = np.empty(len(lengths), np.int64)
    rank[order] = np.arange(len(lengths))
    starts = np.cumsum(lengths) - lengths
    t = np.arange(len(scores)) - np.repeat(starts, lengths)
    place = begin[t] + np.repeat(rank, lengths) if len(scores) else t
    emit = np.empty_like(scores)
    emit[place] = np.exp(scores - scores.max(1, keepdims=True))
    move = np.exp(moves - moves.max())
    alpha = np.empty_like(emit)
    beta = np.ones_like(emit)
    pairs = np.zeros((k, k))
    for i in range(longest):
        a = emit[begin[i] : begin[i] + active[i]]
        if i:
            a = a * (alpha[begin[i - 1] : begin[i - 1] + active[i]] @ move)
        alpha[begin[i] : begin[i] + active[i]] = a / a.sum(1, keepdims=True)
    for i in range(longest - 2, -1, -1):
        n = active[i + 1]
        later = beta[begin[i + 1] : begin[i + 1] + n] * emit[begin[i + 1] : begin[i + 1] + n]
        b = later @ move.T
        beta[begin[i] : begin[i] + n] = b / b.sum(1, keepdims=True)
        if learning:
            joint = alpha[begin[i] : begin[i] + n][:, :, None] * move[None] * later[:, None, :]
            pairs += (joint / joint.sum((1, 2), keepdims=True)).sum(0)
    marginal = alpha * beta
    marginal /= marginal.sum(1, keepdims=True)
    return marginal[place], pairs


def sampled_chunks(text: str, row_words: int) -> list[list[str]]:
    """The lower-cased words of a text in chunks of 64, or as many of its chunks, by hash, as hold ``row_words`` words."""
    words = [w.lower() for w in _WORD.findall(text)]
    chunks = [words[i : i + 64] for i in range(0, len(words), 64)]
    if len(words) <= row_words:
        return chunks
    own = xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass"))
    drawn = sorted(range(len(chunks)), key=lambda i: xxhash.xxh64_intdigest(str(i), own))[: max(1, row_words // 64)]
    return [chunks[i] for i in sorted(drawn)]


def _spliced(chunks: list[tuple[list[str], np.ndarray]], share: float, rng) -> list[tuple[list[str], np.ndarray]]:
    """Chunks of which the first part is of one chunk and the rest of another."""
    if len(chunks) < 2:
        return []
    out = []
    for a, b in rng.integers(0, len(chunks), (int(share * len(chunks)), 2)):
        (one, gold), (two, more) = chunks[a], chunks[b]
        i, j = rng.integers(0, len(one) + 1), rng.integers(0, len(two) + 1)
        if i and j < len(two):
            out.append(([*one[:i], *two[j:]], np.append(gold[:i], more[j:])))
    return out


def fit(rows: list[tuple[str, str]], row_words: int = 400, rounds: int = 3, ridge: float = 1e-6, rate: float = 0.3) -> Field:
    """A field for (text, language) rows, by Adagrad on the likelihood of chunks of 64 words."""
    return fit_chunks([(sampled_chunks(text, row_words), lang) for text, lang in rows], rounds, ridge, rate)


def fit_chunks(rows: list[tuple[list[list[str]], str]], rounds: int = 3, ridge: float = 1e-6, rate: float = 0.3, spliced: float = 0.25) -> Field:
    """The same for (chunks of lower-cased words, language) rows."""
    langs = sorted({lang for _, lang in rows})
    of_one = [(words, langs.index(lang)) for own, lang in rows for words in own if words]
    lexicon = Lexicon.learn(of_one)
    field = Field(langs, lexicon)
    if not of_one:
        return field
    chunks = [(words, np.full(len(words), lang)) for words, lang in of_one]
    chunks += _spliced(chunks, spliced, np.random.default_rng(11))
    ids: dict[str, int] = {}
    for words, _ in chunks:
        for w in words:
            ids.setdefault(w, len(ids))
    names = list(ids)
    field.seen[trigrams(names)[0]] = True
    squares, move_squares = np.full_like(field.weights, 1e-3), np.full_like(field.moves, 1.0)
    rng = np.random.default_rng(7)
    for _ in range(rounds):
        order = rng.permutation(len(chunks))
        for at in range(0, len(order), 64):
            batch = [chunks[i] for i in order[at : at + 64]]
            words = np.array([ids[w] for c, _ in batch for w in c])
            lengths = np.array([len(c) for c, _ in batch])
            gold = np.concatenate([own for _, own in batch])
            distinct, which = np.unique(words, return_inverse=True)
            chosen = [names[i] for i in distinct]
            marginal, pairs = forward_backward(field.emissions(chosen)[which], lengths, field.moves, True)
            marginal[np.arange(len(gold)), gold] -= 1
            found, word = word_features(chosen, lexicon)
            slots, place = np.unique(found, return_inverse=True)
            gradient = np.empty((len(slots), len(langs)), np.float32)
            for k in range(len(langs)):
                by_word = np.bincount(which, marginal[:, k], len(chosen))
                gradient[:, k] = np.bincount(place, by_word[word], len(slots))
            gradient = gradient / len(batch) + ridge * field.weights[slots]
            squares[slots] += gradient**2
            field.weights[slots] -= rate * gradient / np.sqrt(squares[slots])
            seen = np.zeros_like(pairs)
            inside = np.ones(len(gold), bool)
            inside[np.cumsum(lengths) - lengths] = False  # the first word of a chunk comes after none
            at_ = np.flatnonzero(inside)
            np.add.at(seen, (gold[at_ - 1], gold[at_]), 1)
            move_gradient = ((pairs - seen) / len(batch)).astype(np.float32)
            move_squares += move_gradient**2
            field.moves -= 0.1 * move_gradient / np.sqrt(move_squares)
    return field


class _Ids(dict):
    """Numbers of words in order of their first use."""

    def __missing__(self, word: str) -> int:
        value = self[word] = len(self)
        return value


def label_words(field: Field, texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each text, the language probabilities of its words and whether each has a letter."""
    known = _Ids()
    ids = [np.fromiter(map(known.__getitem__, _WORD.findall(t.lower())), np.int64) for t in texts]
    lengths = np.array([len(i) for i in ids], np.int64)
    if not lengths.sum():
        yield from ((np.zeros((0, len(field.langs))), np.zeros(0, bool)) for _ in texts)
        return
    names, words = list(known), np.concatenate(ids)
    emissions = field.emissions_in_parts(names)
    marginal, _ = forward_backward(emissions[words], lengths, field.moves)
    lettered = np.fromiter(map(has_letter, names), bool, len(names))[words]
    ends = np.cumsum(lengths)
    for end, n in zip(ends, lengths, strict=True):
        yield marginal[end - n : end], lettered[end - n : end]


def familiar(field: Field, texts: list[str]) -> np.ndarray:
    """The share of the 3-grams of each text's lettered words that the training words have, ``_SOME`` more of both."""
    known = _Ids()
    ids = [np.fromiter(map(known.__getitem__, _WORD.findall(t.lower())), np.int64) for t in texts]
    names = list(known)
    total, hits = np.zeros(len(names)), np.zeros(len(names))
    part = np.cumsum(np.fromiter(map(len, names), np.int64, len(names)) + 2) // _LETTERS
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1), len(names)]
    for a, b in zip(cuts, cuts[1:], strict=False):
        own = [w if has_letter(w) else "" for w in names[a:b]]
        gram, word = trigrams(own)
        total[a:b] = np.bincount(word, minlength=b - a)
        hits[a:b] = np.bincount(word, field.seen[gram], b - a)
    return np.array([(hits[i].sum() + _SOME) / (total[i].sum() + _SOME) for i in ids])


def predict(field: Field, texts: list[str | None], batch_chars: int = 2_000_000) -> Iterator[tuple[str, float, int]]:
    """(language, score, lettered words) of each text."""
    if not field.langs:
        yield from ((UNKNOWN, 0.0, 0) for _ in texts)
        return
    at = 0
    while at < len(texts):
        stop, chars = at, 0
        while stop < len(texts) and (stop == at or chars < batch_chars):
            chars += len(texts[stop] or "")
            stop += 1
        for marginal, lettered in label_words(field, [t or "" for t in texts[at:stop]]):
            n = int(lettered.sum())
            if not n:
                yield UNKNOWN, 0.0, 0
                continue
            mean = marginal[lettered].mean(0, dtype=float)
            best = int(mean.argmax())
            yield field.langs[best], min(1.0, float(mean[best])), n
        at = stop


def training_rows(docs: DataFrame, id_col: str, text_col: str, lang_col: str, per_language: int, most_languages: int, row_words: int) -> list[tuple[list[list[str]], str]]:
    """At most ``per_language`` labelled rows of each of the ``most_languages`` most frequent languages, as chunks of words.

    Only ids and languages are looked at to choose; the cut by hash leaves few rows of a language to rank.
    """
    labelled = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    labelled = labelled.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"), F.xxhash64(F.lit("langid"), id_col).alias("draw"))
    counts = labelled.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(most_languages).collect()
    if not counts:
        return []
    span = 2.0**64
    # Three times the rows wanted, and more where a language has few, so that a cut by hash cannot fall short of many.
    cut = {r["lang"]: -(2.0**63) + span * min(1.0, (3 * per_language + 30) / r["count"]) for r in counts}
    limit = F.create_map(*[x for lang, c in cut.items() for x in (F.lit(lang), F.lit(c))])
    near = labelled.where(F.col("draw").cast("double") <= F.coalesce(F.try_element_at(limit, F.col("lang")), F.lit(-1e300)))
    ranked = near.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy("draw", "text")))
    chosen = ranked.where(F.col("rank") <= per_language).select("lang", _chunks_udf(row_words)("text").alias("chunks"))
    return sorted(([[*words] for words in r["chunks"]], r["lang"]) for r in chosen.collect())


def _chunks_udf(row_words: int):
    def chunks(texts: pd.Series) -> pd.Series:
        return pd.Series([[[w for w in words if len(w) <= _LONG] for words in sampled_chunks(t, row_words)] for t in texts], dtype=object)

    return F.pandas_udf(chunks, "array<array<string>>")


def _language_udf(shared):
    def language(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame(predict(shared.value, list(texts)), columns=["lang", "score", "words"])

    return F.pandas_udf(language, _RESULT)


def identify(
    spark: SparkSession,
    docs: DataFrame,
    train: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    per_language: int = 400,
    most_languages: int = 64,
    row_words: int = 400,
) -> Column:
    """The language of ``text_col`` as a column (lang, score, words); learned from the rows where ``train`` holds."""
    in_small_batches(spark)
    rows = training_rows(docs.where(train), id_col, text_col, lang_col, per_language, most_languages, row_words)
    return _language_udf(spark.sparkContext.broadcast(fit_chunks(rows)))(F.col(text_col))


def least_familiar(field: Field, apart: list[tuple[list[list[str]], str]], enough: int = 30) -> float:
    """Half of the least share of known 3-grams in rows that were not learned from; 0 if they are fewer than ``enough``."""
    if len(apart) < enough:
        return 0.0
    texts = [" ".join(w for words in chunks for w in words) for chunks, _ in apart]
    return float(familiar(field, texts).min()) / 2


def keep_known(
    spark: SparkSession,
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    per_language: int = 400,
    most_languages: int = 64,
    row_words: int = 400,
    apart: int = 5,
) -> DataFrame:
    """The rows whose text is of a learned language; all their columns as they are.

    A text goes if it is NULL or has no letter, or if its 3-grams are stranger than ``least_familiar`` allows, which is
    taken from every ``apart``-th of the sampled rows; the field learns from the others. Without labelled rows only texts without a
    letter go.
    """
    in_small_batches(spark)
    held_out = F.pmod(crc_of(id_col), F.lit(4)) == 2
    rows = training_rows(docs.where(~held_out), id_col, text_col, lang_col, per_language, most_languages, row_words)
    field = fit_chunks([r for i, r in enumerate(rows) if i % apart])
    least = least_familiar(field, rows[::apart]) if field.langs else 0.0
    shared = spark.sparkContext.broadcast(field)

    def known(texts: pd.Series) -> pd.Series:
        own, given = shared.value, [t or "" for t in texts]
        if not own.langs:
            return pd.Series([has_letter(t) for t in given], dtype=bool)
        lang = [found[0] for found in predict(own, given)]
        return pd.Series([name != UNKNOWN and share >= least for name, share in zip(lang, _familiar_in_parts(own, given), strict=True)], dtype=bool)

    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(text_col).alias("text"))
    return row.where(F.pandas_udf(known, "boolean")("text")).select("row.*")


def _familiar_in_parts(field: Field, texts: list[str], batch_chars: int = 2_000_000) -> Iterator[float]:
    at = 0
    while at < len(texts):
        stop, chars = at, 0
        while stop < len(texts) and (stop == at or chars < batch_chars):
            chars += len(texts[stop])
            stop += 1
        yield from familiar(field, texts[at:stop]).tolist()
        at = stop


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.pmod(crc_of("doc_id"), F.lit(4)) == 2
    found = docs.select("doc_id", held_out.alias("held_out"), identify(spark, docs, ~held_out).alias("found"))
    return found.select("doc_id", "held_out", F.col("found.lang").alias("lang_pred"), "found.score", F.col("found.words").alias("n_words"))
