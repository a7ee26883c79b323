from __future__ import annotations

import random

import pytest
from llm_cases import ODD, documents, tables  # noqa: F401
from pyspark.sql import functions as F

import __spark_entry__
import corpus_pipeline
from tidemill.llm.pieces import Decoder, Vocabulary


def sentence(rng, n):
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(3, 8))) for _ in range(n))


def test_each_stage_decides(spark, documents, tables):  # noqa: F811
    rng = random.Random(4)
    items = [(i, sentence(rng, 12)) for i in range(5)]
    clean = [sentence(rng, 40) for _ in range(30)]
    texts = [*clean, clean[0], clean[1] + " more", clean[2] + " " + items[3][1], "mail x.y@z.org " + clean[3][:80], *ODD]
    frame = documents(texts).withColumn("extra", F.lit("x")).withColumn("row", F.lit(1)).withColumn("found", F.lit(1))
    folder = tables(documents=frame, benchmark=spark.createDataFrame(items, "item_id long, text string"))
    out = {r["doc_id"]: r for r in corpus_pipeline.run(spark, folder).collect()}
    n = len(clean)
    gone = {n, n + 1, n + 2, n + 4, n + 5, n + 6, n + 7}  # copies, the passage; NULL, empty, blank, no letters
    repeated = len(texts) - 1
    assert set(out) == set(range(len(texts))) - gone - {repeated}
    assert all(out[i]["text"] == clean[i] and out[i]["n_chars"] == len(clean[i]) for i in range(n))
    assert out[n + 3]["text"].startswith("mail [EMAIL] ") and out[n + 3]["extra"] == "x"
    decoder = Decoder(Vocabulary.read())
    assert all(decoder.decode(r["piece_ids"]) == r["text"] for r in out.values())


def test_empty_table(spark, documents, tables):  # noqa: F811
    folder = tables(documents=documents(["a"]).limit(0), benchmark=spark.createDataFrame([], "item_id long, text string"))
    assert corpus_pipeline.run(spark, folder).count() == 0


def test_stages_keep_columns(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language_id", "near_duplicates", "decontaminate", "pii", "pieces"]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, "/root/testdata/sf0.001").columns == docs.columns


@pytest.mark.parametrize("n", range(1, 11))
def test_every_operator_is_registered(n):
    assert len([q for q in __spark_entry__.queries() if q.startswith(f"op{n}_")]) == 1
