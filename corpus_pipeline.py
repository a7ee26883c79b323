"""Preparation of a text corpus in five stages, each on all that the one before it kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the next
stage's docs. All but the last return the columns they were given:

* language_id drops documents of no known language: NULL texts, texts without a letter, and texts whose letter 3-grams are
  strange to all languages that labels were given for;
* near_duplicates keeps one document of each class of similar ones (word 5-grams, Jaccard 0.8 or more), the least id;
* decontaminate drops documents that hold a benchmark item, up to 8 % of its characters edited;
* pii replaces personal data by its kind in brackets and sets n_chars anew;
* pieces adds the ids of the text's SentencePiece pieces.

Once a stage is written, what it was made from is deleted. An empty table passes through all stages. SQL cannot express the first and second stage, so there is none.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemill.llm.common import table
from tidemill.llm.decontaminate import drop_contaminated
from tidemill.llm.jaccard import keep_first_of_class
from tidemill.llm.langid import keep_known
from tidemill.llm.pieces import with_pieces
from tidemill.llm.pii import redact
from tidemill.sources import clear_scratch, scratch_mark, scratch_path


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_known(spark, docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_first_of_class(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_contaminated(spark, docs, table(spark, sf_dir, "benchmark"))


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return redact(docs)


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return with_pieces(spark, docs)


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("decontaminate", decontaminate),
    ("pii", pii),
    ("pieces", pieces),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    begun = scratch_mark()
    for name, stage in STAGES:
        found, path = stage(spark, docs, sf_dir), scratch_path(spark, name)
        found.write.parquet(path)
        docs = spark.read.schema(found.schema).parquet(path)
        clear_scratch(spark, begun, keep=path)
    return docs
