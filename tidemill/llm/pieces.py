"""SentencePiece encoding by shared-prefix Viterbi, and decoding.

A text is cut before each run of spaces into marked words; no piece of a vocabulary crosses such a cut, so the best
segmentation of a text is that of its words one by one. The distinct marked words of a batch are sorted, which is a
depth-first walk of their trie: from one word to the next, the forward scores (best score of each prefix) of the common
prefix stay, and only the rest is computed. The pieces of frequent words are remembered for a bounded number of words.

Scores are the log probabilities of a unigram model. A vocabulary whose file holds merge ranks instead has them turned
into log probabilities by Zipf's law, log p = -log(rank + 2.7) (less a constant, which all pieces of a path would
add). A character without a piece costs the least score less 10 and becomes its UTF-8 bytes. Equal scores go to the longer
last piece.

Decoding gives back exactly the text, for every text: the mark stands for a space only, and a character U+2581 in the text
itself goes by its bytes. An empty text has no pieces, a NULL text has NULL pieces, ids that are no pieces are left out in
decoding, and bytes that are no UTF-8 become U+FFFD. Rows are handled one by one, so repeats and ties in rows have no
effect. Work is linear in a text's length, however long a word is. The vocabulary is broadcast; ``most_pieces`` bounds it.
"""

from __future__ import annotations

import math
import re
from array import array
from collections.abc import Iterable
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm.common import table

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
_MARKED = re.compile(r" +[^ ]*")


@dataclass(frozen=True)
class Vocabulary:
    """Pieces with a space for the mark: id and score of each, ids of the 256 bytes, and pieces by id for decoding."""

    pieces: dict[str, tuple[int, float]]
    byte_ids: tuple[int, ...]
    unknown: float

    @classmethod
    def read(cls, path: str = VOCABULARY, most_pieces: int = 1_000_000) -> Vocabulary:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        if n > most_pieces:
            raise ValueError(f"{n} pieces are more than the bound of {most_pieces}")
        bytes_, plain = {}, []
        for i in range(n):
            if model.is_byte(i):
                bytes_[int(model.id_to_piece(i)[3:5], 16)] = i
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                plain.append((model.id_to_piece(i).replace(MARK, " "), i))
        if len(bytes_) < 256:
            raise ValueError("the vocabulary has no pieces for bytes")
        scores = [model.get_score(i) for _, i in plain]
        if all(s == int(s) for s in scores):  # ranks
            scores = [-math.log(rank + 2.7) for rank in range(len(plain))]
        return cls(
            {p: (i, s) for (p, i), s in zip(plain, scores, strict=True)},
            tuple(bytes_[b] for b in range(256)),
            min(scores) - 10,
        )


_WHOLE = 256  # letters of a word up to which what is known of every prefix is held


def _trie(vocabulary: Vocabulary) -> dict:
    """For each first letter of a piece: what follows (a trie of the same form), and score and id bytes if it is a piece itself."""
    root: dict = {}
    for piece, (number, score) in vocabulary.pieces.items():
        node = root
        for letter in piece[:-1]:
            node = node.setdefault(letter, [{}, None, b""])[0]
        node.setdefault(piece[-1], [{}, None, b""])[1:] = score, array("i", [number]).tobytes()
    return root


class Encoder:
    """Pieces of texts. The ids of a word are kept as the bytes of 32-bit numbers, so that those of a text need only be joined;
    at most ``most_words`` words of at most ``most_length`` letters are remembered, without their first space."""

    def __init__(self, vocabulary: Vocabulary, most_words: int = 250_000, most_length: int = 48):
        self.vocabulary, self.most_words, self.most_length = vocabulary, most_words, most_length
        self.known: dict[str, bytes] = {}
        self.root = _trie(vocabulary)

    def _bytes(self, letter: str) -> bytes:
        """The ids of a letter without a piece."""
        return array("i", [self.vocabulary.byte_ids[b] for b in letter.encode("utf-8", "surrogatepass")]).tobytes()

    def walk(self, words: Iterable[str]) -> Iterable[tuple[str, tuple[int, ...]]]:
        """The pieces of each of the sorted marked words."""
        for word, ids in self._walk(w[1:] for w in words):
            yield " " + word, tuple(np.frombuffer(ids, np.intc).tolist())

    def _walk(self, words: Iterable[str]) -> Iterable[tuple[str, bytes]]:
        """The ids of each of the sorted words, which are given without their first space.

        A prefix has the ids of its best pieces, and the places at which a piece may have begun that is not over yet, the
        earliest first: each with the score up to there and the trie of what may follow. The last place is its own end.
        Common prefixes share both. The ids of prefixes over ``_WHOLE`` letters are put together from the end.
        """
        root, unknown = self.root, self.vocabulary.unknown
        follow, score, code = root.get(" ", ({}, None, b""))
        going = [(follow, 0.0, 0)] if follow else []
        going.append((root, unknown if score is None else score, 1))
        # Of prefixes with the space; the empty one has a path only.
        begun, path, last = [going], [b"", self._bytes(" ") if score is None else code], ""
        for word in words:
            size = len(word)
            same, most = 0, min(len(last), size, _WHOLE)
            while same < most and word[same] == last[same]:
                same += 1
            del begun[same + 1 :], path[same + 2 :]
            places, rest = begun[same], []
            for end, letter in enumerate(word[same:], same + 2):
                going = []
                top, at, ids = -math.inf, end - 1, b""
                # Of equal scores the longer piece wins, and the longer ones come first.
                for follow, before, place in places:
                    found = follow.get(letter)
                    if found is not None:
                        follow, score, code = found
                        if score is not None and before + score > top:
                            top, at, ids = before + score, place, code
                        if follow:
                            going.append((follow, before, place))
                if places[-1][1] + unknown > top and (letter not in root or root[letter][1] is None):
                    top, at, ids = places[-1][1] + unknown, end - 1, self._bytes(letter)
                going.append((root, top, end))
                places = going
                if end <= _WHOLE + 1:
                    begun.append(going)
                    path.append(path[at] + ids)
                else:
                    rest.append((at, ids))
            if size <= _WHOLE:
                yield word, path[size + 1]
            else:
                parts, end = [], size + 1
                while end > _WHOLE + 1:
                    end, ids = rest[end - _WHOLE - 2]
                    parts.append(ids)
                yield word, path[end] + b"".join(reversed(parts))
            last = word

    def encode(self, texts: list[str | None], batch_chars: int = 4_000_000) -> Iterable[np.ndarray | None]:
        at = 0
        while at < len(texts):
            stop, chars = at, 0
            while stop < len(texts) and (stop == at or chars < batch_chars):
                chars += len(texts[stop] or "")
                stop += 1
            cut = [_marked(text) if text else () for text in texts[at:stop]]
            fresh = set().union(*cut) - self.known.keys()
            self.known.update(self._walk(sorted(fresh)))
            get = self.known.__getitem__
            for text, words in zip(texts[at:stop], cut, strict=True):
                yield None if text is None else np.frombuffer(b"".join(map(get, words)), np.intc)
            if len(self.known) > self.most_words:
                self.known = {}
            else:
                for word in fresh:
                    if len(word) > self.most_length:
                        del self.known[word]
            at = stop


def _marked(text: str) -> list[str]:
    """The marked words of a text, each without the first of its spaces."""
    return [w[1:] for w in _MARKED.findall(" " + text)] if "  " in text or text[0] == " " else text.split(" ")


class Decoder:
    """Texts from ids: the bytes of all pieces lie in one table, from which those of many ids are gathered together."""

    def __init__(self, vocabulary: Vocabulary):
        text = {i: p.encode("utf-8", "surrogatepass") for p, (i, _) in vocabulary.pieces.items()}
        text |= {i: bytes([b]) for b, i in enumerate(vocabulary.byte_ids)}
        most = max(text) + 1  # the place of ids that are no pieces
        size = [len(text.get(i, b"")) for i in range(most + 1)]
        self.size = np.array(size, np.int32)
        self.start = np.cumsum(self.size, dtype=np.int32) - self.size
        self.table = np.frombuffer(b"".join(text.get(i, b"") for i in range(most)), np.uint8)
        self.most = most

    def decode(self, ids: Iterable[int] | None) -> str | None:
        if ids is None:
            return None
        ids = np.asarray(list(ids), np.int64)
        return next(self.texts(ids, np.array([0, len(ids)])))

    def texts(self, ids: np.ndarray, ends: np.ndarray, chunk: int = 1_000_000) -> Iterable[str]:
        """The text of each stretch of ids, from one of ``ends`` to the next, ``chunk`` ids or a text at a time."""
        at = 0
        while at < len(ends) - 1:
            stop = max(at + 1, int(np.searchsorted(ends, ends[at] + chunk, "right")) - 1)
            own = ids[ends[at] : ends[stop]]
            own = np.where((own >= 0) & (own < self.most), own, self.most)
            size = self.size[own]
            to = np.cumsum(size, dtype=np.int64)
            place = np.arange(to[-1] if len(to) else 0) + np.repeat(self.start[own] - (to - size), size)
            body = self.table[place].tobytes()
            bounds = np.append(0, to)[ends[at : stop + 1] - ends[at]].tolist()
            for a, b in zip(bounds, bounds[1:], strict=False):
                yield body[a:b].decode("utf-8", "replace").removeprefix(" ")
            at = stop


@lru_cache(maxsize=1)
def _encoder(shared) -> Encoder:
    return Encoder(shared.value)


@lru_cache(maxsize=1)
def _decoder(shared) -> Decoder:
    return Decoder(shared.value)


def _sizes(rows: pa.ListArray) -> np.ndarray:
    return pc.fill_null(pc.list_value_length(rows), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def encoding(spark: SparkSession, text: Column, vocabulary: Vocabulary | None = None) -> Column:
    """The ids of a text's pieces, array<int>."""
    shared = spark.sparkContext.broadcast(vocabulary or Vocabulary.read())

    def ids(texts: pa.Array) -> pa.Array:
        rows = list(_encoder(shared).encode(texts.to_pylist()))
        ends = np.cumsum([0, *(0 if r is None else len(r) for r in rows)])
        values = np.concatenate([np.empty(0, np.int32), *(r for r in rows if r is not None)])
        missing = pa.array([r is None for r in rows], pa.bool_())
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, pa.int32()), mask=missing)

    return F.arrow_udf(ids, "array<int>")(text)


def decoding(spark: SparkSession, ids: Column, vocabulary: Vocabulary | None = None) -> Column:
    """The text of a column of ids."""
    shared = spark.sparkContext.broadcast(vocabulary or Vocabulary.read())

    def texts(rows: pa.Array) -> pa.Array:
        # A missing row takes up no ids.
        found = _decoder(shared).texts(rows.flatten().to_numpy(zero_copy_only=False), np.append(0, np.cumsum(_sizes(rows))))
        return pa.array([text if valid else None for valid, text in zip(rows.is_valid().to_pylist(), found, strict=True)], pa.string())

    return F.arrow_udf(texts, "string")(ids)


def with_pieces(spark: SparkSession, docs: DataFrame, text_col: str = "text", out_col: str = "piece_ids", vocabulary: Vocabulary | None = None) -> DataFrame:
    """The rows with the ids of their pieces as ``out_col``, which takes the place of a column of that name."""
    return docs.withColumn(out_col, encoding(spark, F.col(text_col), vocabulary))


def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = Vocabulary.read()
    docs = with_pieces(spark, table(spark, sf_dir, "documents").select("doc_id", "text"), vocabulary=vocabulary)
    back = docs.withColumn("back", decoding(spark, F.col("piece_ids"), vocabulary))
    return back.select(
        "doc_id",
        F.coalesce(F.size("piece_ids"), F.lit(0)).cast("long").alias("n_pieces"),
        F.xxhash64("piece_ids").alias("pieces_hash"),
        F.col("back").eqNullSafe(F.col("text")).alias("round_trip"),
    )
