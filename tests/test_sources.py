from __future__ import annotations

import datetime as dt
import re
from pathlib import Path

from pyspark.sql import functions as F

from tidemill.sources import TRANSACTION, read_dated, read_transactions, scratch_path, write_dated, write_table


def transactions(spark, n=100):
    day = dt.datetime(2024, 1, 1)
    rows = [(i, i % 5, day + dt.timedelta(days=i % 4, seconds=i), 1.5, "food", "east", "tablet", 30, 1, 0, 0.0, 1) for i in range(n)]
    return spark.createDataFrame(rows, TRANSACTION)


def test_round_trip(spark, tmp_path):
    df = transactions(spark)
    write_table(df, str(tmp_path / "t"))
    back = read_transactions(spark, str(tmp_path / "t"))
    assert back.schema == TRANSACTION
    assert back.exceptAll(df).count() == 0 and back.count() == 100
    assert read_transactions(spark, str(tmp_path / "t"), partitions=7).rdd.getNumPartitions() == 7
    by_user = read_transactions(spark, str(tmp_path / "t"), partitions=7, by="user_id")
    places = by_user.select("user_id", F.spark_partition_id().alias("place")).distinct()
    assert by_user.count() == 100 and places.count() == 5


def test_date_filter_reads_only_its_days(spark, tmp_path):
    path = str(tmp_path / "dated")
    write_dated(transactions(spark), path)
    assert len(list(Path(path).glob("event_date=*"))) == 4
    days = read_dated(spark, path, "2024-01-02", "2024-01-03")
    assert days.count() == 50
    plan = days._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*event_date", plan)


def test_only_needed_columns_are_read(spark, tmp_path):
    write_table(transactions(spark), str(tmp_path / "t"))
    plan = read_transactions(spark, str(tmp_path / "t")).groupBy("category").agg(F.sum("amount"))
    assert "ReadSchema: struct<amount:double,category:string>" in plan._jdf.queryExecution().executedPlan().toString()


def test_scratch_is_in_the_shared_folder(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    first, second = scratch_path(spark, "a"), scratch_path(spark, "a")
    assert first.startswith(base) and first != second
