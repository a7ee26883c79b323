from __future__ import annotations

import math
import struct

import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_cases import ODD, documents  # noqa: F401
from pyspark.sql import functions as F

from tidemill.llm import pieces
from tidemill.llm.pieces import Decoder, Encoder, Vocabulary


@pytest.fixture(scope="module")
def vocabulary():
    return Vocabulary.read()


def fields(data, at, end):
    """(number, start of value, end) of the fields of a protocol-buffer message."""

    def varint(i):
        value = shift = 0
        while True:
            value |= (data[i] & 127) << shift
            shift += 7
            i += 1
            if data[i - 1] < 128:
                return value, i

    while at < end:
        key, start = varint(at)
        kind = key & 7
        if kind == 2:
            n, start = varint(start)
            stop = start + n
        else:
            stop = start + (4 if kind == 5 else 8) if kind in (1, 5) else varint(start)[1]
        yield key >> 3, start, stop
        at = stop


@pytest.fixture(scope="module")
def unigram(vocabulary):
    """The library's own unigram encoder with the same pieces and scores."""
    data = bytearray(open(pieces.VOCABULARY, "rb").read())
    number = 0
    for field, start, stop in list(fields(data, 0, len(data))):
        if field == 1:
            text = next(bytes(data[a:b]).decode() for f, a, b in fields(data, start, stop) if f == 1)
            known = vocabulary.pieces.get(text.replace(pieces.MARK, " "))
            for f, a, _ in fields(data, start, stop):
                if f == 2 and known and known[0] == number:
                    data[a : a + 4] = struct.pack("<f", known[1])
            number += 1
        elif field == 2:
            for f, a, b in fields(data, start, stop):
                if f == 3 and b - a == 1:
                    data[a] = 1
    return sentencepiece.SentencePieceProcessor(model_proto=bytes(data))


def best_score(vocabulary, word):
    best = [0.0] + [-math.inf] * len(word)
    for e in range(1, len(word) + 1):
        for s in range(max(0, e - 20), e):
            score = vocabulary.pieces.get(word[s:e], (0, vocabulary.unknown if e - s == 1 else -math.inf))[1]
            best[e] = max(best[e], best[s] + score)
    return best[-1]


def score_of(vocabulary, ids):
    by_id = dict(vocabulary.pieces.values())
    total, left = 0.0, 0
    raw = set(vocabulary.byte_ids)
    for i in ids:
        if i not in raw:
            total += by_id[i]
        else:  # the bytes of one character cost one unknown
            byte = vocabulary.byte_ids.index(i)
            left = left or (1 if byte < 128 else 2 if byte < 224 else 3 if byte < 240 else 4)
            left -= 1
            total += vocabulary.unknown if not left else 0.0
    return total


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text("the ain sr.éñ▁\U0001f600\n", max_size=30), max_size=6))
def test_best_segmentation_and_exact_round_trip(vocabulary, texts):
    encoder, decoder = Encoder(vocabulary), Decoder(vocabulary)
    for text, ids in zip(texts, encoder.encode(texts), strict=True):
        assert decoder.decode(ids.tolist()) == text
        if text:
            assert math.isclose(score_of(vocabulary, ids.tolist()), best_score(vocabulary, " " + text), abs_tol=1e-6)


def test_same_pieces_as_the_library(spark, vocabulary, unigram):
    texts = [r[0] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").limit(60).collect()]
    words = sorted({w for t in texts for w in t.split(" ") if w and pieces.MARK not in w})
    found = dict(Encoder(vocabulary).walk([" " + w for w in words]))
    differ = [w for w in words if list(found[" " + w]) != unigram.encode(w)]
    for w in differ:  # only where two segmentations have the same score
        a, b = score_of(vocabulary, found[" " + w]), score_of(vocabulary, unigram.encode(w))
        assert math.isclose(a, b, abs_tol=1e-4), w
    assert len(differ) < 0.01 * len(words)


def test_prefixes_are_reused_in_any_order(vocabulary):
    words = sorted([" the", " then", " thence", " there", " a", " an", " xyz" * 3, " th"])
    together = dict(Encoder(vocabulary).walk(words))
    assert together == {w: dict(Encoder(vocabulary).walk([w]))[w] for w in words}


def test_bounded_memory_of_words(vocabulary):
    small = Encoder(vocabulary, most_words=3)
    texts = ["one two three four", "five six", "one two", "seven one"]
    assert [i.tolist() for i in small.encode(texts, batch_chars=5)] == [i.tolist() for i in Encoder(vocabulary).encode(texts)]
    assert len(small.known) <= 3


def test_odd_texts_in_a_frame(spark, documents, vocabulary):  # noqa: F811
    docs = documents([*ODD, "  two  spaces ", "▁ mark"]).withColumn("piece_ids", F.lit("old"))
    coded = pieces.with_pieces(spark, docs, vocabulary=vocabulary)
    assert coded.columns == docs.columns
    back = coded.select("text", "piece_ids", pieces.decoding(spark, F.col("piece_ids"), vocabulary).alias("back")).collect()
    assert len(back) == len(ODD) + 2 and all(r["text"] == r["back"] for r in back)
    assert [r["piece_ids"] for r in back if r["text"] in (None, "")] in ([None, []], [[], None])
    assert pieces.with_pieces(spark, docs.limit(0), vocabulary=vocabulary).count() == 0


def test_query(spark):
    assert pieces.op9_sentencepiece(spark, "/root/testdata/sf0.001").where("not round_trip").count() == 0
