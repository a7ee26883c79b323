from __future__ import annotations

import itertools

import numpy as np
from conftest import SF_DIR
from llm_cases import ODD, documents  # noqa: F401
from pyspark.sql import functions as F

from tidemill.llm import langid


def test_forward_backward_against_all_paths():
    rng = np.random.default_rng(0)
    lengths, k = np.array([3, 1, 4, 0, 2]), 3
    scores, moves = rng.normal(size=(lengths.sum(), k)), rng.normal(size=(k, k))
    got, pairs = langid.forward_backward(scores, lengths, moves, True)
    at, want, want_pairs = 0, np.zeros_like(scores), np.zeros((k, k))
    for n in lengths:
        paths = list(itertools.product(range(k), repeat=int(n))) if n else []
        weight = [np.exp(sum(scores[at + i, s] for i, s in enumerate(p)) + sum(moves[a, b] for a, b in zip(p, p[1:], strict=False))) for p in paths]
        for p, w in zip(paths, weight, strict=True):
            for i, s in enumerate(p):
                want[at + i, s] += w / sum(weight)
            for a, b in zip(p, p[1:], strict=False):
                want_pairs[a, b] += w / sum(weight)
        at += n
    np.testing.assert_allclose(got, want, atol=1e-6)
    np.testing.assert_allclose(pairs, want_pairs, atol=1e-6)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF_DIR.replace('0.001', '0.01')}/documents.parquet").select("doc_id", "lang")
    found = langid.op8_language_id(spark, SF_DIR.replace("0.001", "0.01")).join(docs, "doc_id").where("held_out")
    right = found.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double")), F.count("*"), F.min("score"), F.max("score")).first()
    assert right[0] >= 0.97 and right[1] > 150 and 0 <= right[2] and right[3] <= 1


def test_words_of_code_switched_text():
    english = ["the cat and the dog went home with the other one"] * 30
    french = ["le chat et le chien sont dans la maison avec des autres"] * 30
    field = langid.fit([*((t, "en") for t in english), *((t, "fr") for t in french)])
    marginal, lettered = next(langid.label_words(field, ["the dog went home avec le chien dans la maison 12"]))
    assert list(marginal.argmax(1)[:10]) == [0] * 4 + [1] * 6 and list(lettered) == [True] * 10 + [False]


def test_odd_texts(spark, documents):  # noqa: F811
    rows = [(i, t, "en" if i % 2 else "fr", "a") for i, t in enumerate([*ODD, "some english words here", "des mots en français"])]
    docs = documents(rows).withColumn("found", F.lit(1)).withColumn("row", F.lit(1))
    found = docs.select("doc_id", langid.identify(spark, docs, F.lit(True)).alias("x")).collect()
    lang = {r["doc_id"]: (r["x"]["lang"], r["x"]["score"]) for r in found}
    assert all(lang[i] == ("und", 0.0) for i in range(4)) and len(lang) == len(rows)
    assert all(lang[i][0] in ("en", "fr") and 0 < lang[i][1] <= 1 for i in range(4, len(rows)))
    kept = langid.keep_known(spark, docs)
    assert kept.columns == docs.columns and kept.count() == len(rows) - 4
    assert langid.keep_known(spark, docs.limit(0)).count() == 0


def test_without_labels_all_is_unknown(spark, documents):  # noqa: F811
    docs = documents([(1, "some words", None, "a"), (None, "other", None, None)])
    found = docs.select(langid.identify(spark, docs, F.lit(True)).alias("x")).collect()
    assert [r["x"]["lang"] for r in found] == ["und", "und"]


def test_the_end_of_a_long_word_tells():
    same = "pneumonoultramicroscopicsilicovolcanoconi"
    field = langid.fit([*((f"{same}{x}owing {x}nowing", "en") for x in "bcdfgh" * 10), *((f"{same}{x}eront {x}neront", "fr") for x in "bcdfgh" * 10)])
    found = list(langid.predict(field, [f"{same}zzowing", f"{same}zzeront"]))
    assert [f[0] for f in found] == ["en", "fr"] and all(f[1] > 0.6 for f in found)


def test_text_without_spaces_is_read_to_its_end():
    english = "the cat and the dog went home with the other one"
    french = "le chat et le chien sont dans la maison avec des autres"
    field = langid.fit([*((english, "en") for _ in range(30)), *((french, "fr") for _ in range(30))])
    for gap in ("\u00a0", "\u3000", ""):
        texts = [gap.join((french + " " + (english + " ") * 20).split()), gap.join((english + " " + (french + " ") * 20).split())]
        assert [f[0] for f in langid.predict(field, texts)] == ["en", "fr"]


def test_emissions_in_parts(monkeypatch):
    field = langid.fit([("the cat and the dog", "en"), ("le chat et le chien", "fr")] * 10)
    words = ["the", "chien" * 50, "12", "a", "le"] * 20
    monkeypatch.setattr(langid, "_LETTERS", 40)
    np.testing.assert_array_equal(field.emissions_in_parts(words), field.emissions(words))


def test_training_reads_more_than_the_heads_of_long_texts():
    head = "licence terms apply " * 200
    english, french = "the cat and the dog went home with the other one ", "le chat et le chien sont dans la maison avec des autres "
    rows = [(f"{i} " + head + own * 200, lang) for i in range(10) for own, lang in ((english, "en"), (french, "fr"))]
    field = langid.fit(rows)
    assert [f[0] for f in langid.predict(field, [english, french])] == ["en", "fr"]
    for text, _ in rows:
        chunks = langid.sampled_chunks(text, 400)
        assert sum(map(len, chunks)) <= 400 and chunks == langid.sampled_chunks(text, 400)
    assert langid.sampled_chunks("A b " * 100, 400) == [["a", "b"] * 32] * 3 + [["a", "b"] * 4]


def test_switches_are_learned_and_found_in_held_out_splices(spark):
    docs = spark.read.parquet(f"{SF_DIR.replace('0.001', '0.01')}/documents.parquet")
    rows = langid.training_rows(docs.where("lang IS NOT NULL"), "doc_id", "text", "lang", 60, 64, 400)
    field = langid.fit_chunks(rows[::2])
    stay = np.diag(field.moves)
    away = field.moves[~np.eye(len(stay), dtype=bool)]
    assert stay.min() - away.max() > 0.5  # a switch is known to be rare
    rng, right, near, n = np.random.default_rng(2), 0, 0, 0
    apart = [(c, field.langs.index(lang)) for chunks, lang in rows[1::2] for c in chunks if len(c) > 30]
    for a, b in rng.integers(0, len(apart), (200, 2)):
        (one, first), (two, second) = apart[a], apart[b]
        if first == second:
            continue
        words, gold = [*one[:30], *two[:30]], np.repeat([first, second], 30)
        marginal, lettered = next(langid.label_words(field, [" ".join(words)]))
        found = marginal.argmax(1)
        right += (found == gold)[lettered].sum()
        n += lettered.sum()
        near += abs(int(np.argmax(found == second)) - 30) <= 1
    assert right / n > 0.95 and near > 0.8 * (n / 60)


def test_unlearned_languages_go_and_clean_rows_stay(spark, documents):  # noqa: F811
    docs = spark.read.parquet(f"{SF_DIR.replace('0.001', '0.01')}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    strange = ["Съешь же ещё этих мягких французских булок да выпей чаю " * 3, "qxzv wkjf pqzx vvkq zzxw jqkx wvzq xkcd qqzw " * 3, "これは学習していない言語の文章です。" * 4]
    more = documents([(10**6 + i, t, None, "x") for i, t in enumerate(strange)])
    kept = {r[0] for r in langid.keep_known(spark, docs.unionByName(more)).select("doc_id").collect()}
    lettered = {r[0] for r in docs.where(F.col("text").rlike(r"\p{L}")).select("doc_id").collect()}
    assert kept == lettered


def test_without_labels_lettered_texts_stay(spark, documents):  # noqa: F811
    docs = documents([(i, t, None, "a") for i, t in enumerate([*ODD, *(f"some words {i}" for i in range(20))])])
    assert {r["doc_id"] for r in langid.keep_known(spark, docs).collect()} == set(range(4, len(ODD) + 20))


def test_the_driver_gets_bounded_chunks(spark, documents):  # noqa: F811
    docs = documents([(i, "some words " * 5000 + "x" * 50_000, "en", "a") for i in range(30)])
    rows = langid.training_rows(docs, "doc_id", "text", "lang", 10, 64, 400)
    assert len(rows) == 10 and all(sum(map(len, chunks)) <= 400 for chunks, _ in rows)
    assert all(len(w) <= 100 for chunks, _ in rows for words in chunks for w in words)
