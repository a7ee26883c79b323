"""Every query against its SQL on another engine."""

from __future__ import annotations

import pytest

import __spark_entry__
from compare import differences, oracle_connection
from conftest import SF_DIR

QUERIES, ORACLE = __spark_entry__.queries(), __spark_entry__.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return oracle_connection(SF_DIR)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF_DIR)
    if name in ORACLE:
        assert differences(df, con, ORACLE[name]) == []
    else:
        assert df.count() > 0


def test_every_sql_belongs_to_a_query():
    assert set(ORACLE) <= set(QUERIES)


def test_feature_table_columns(spark):
    df = __spark_entry__.entry(spark)
    assert df.columns[0] == "user_id"
    # inputs, time, logs, flags, ratios, user features, z-scores
    assert len(df.columns) == 12 + 6 + 3 + (5 + 3) + 3 + 7 + 4
