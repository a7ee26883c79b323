"""Fixtures and cases of the tests of the text operators."""

from __future__ import annotations

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark):
    """A frame of documents from texts, or from (id, text, lang, source) rows."""

    def make(rows):
        full = [(i, r, "en", "a") if r is None or isinstance(r, str) else r for i, r in enumerate(rows)]
        return spark.createDataFrame([(*r, None if r[1] is None else len(r[1])) for r in full], DOCS)

    return make


@pytest.fixture
def tables(spark, tmp_path):
    """A folder of tables, written from frames by name."""

    def write(**frames):
        for name, df in frames.items():
            df.write.mode("overwrite").parquet(str(tmp_path / f"{name}.parquet"))
        return str(tmp_path)

    return write


#: Texts that every operator must take: missing, empty, blank, without letters, odd signs, very long, repeated.
ODD = [None, "", " \t\n ", "12 34 . !", "é▁\U0001f600 \x00\x1c x", "word " * 30_000, "a" * 100_000, "same text", "same text"]
