"""The driver's tables in the shape of the transaction record."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.sources import DEVICES, REGIONS

EVENT_TYPES = ("view", "signup", "error", "click", "purchase")
SEGMENTS = ("MACHINERY", "BUILDING", "AUTOMOBILE", "HOUSEHOLD", "FURNITURE")
PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _one_of(names: tuple[str, ...], number: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, names)), (F.pmod(number, F.lit(len(names))) + 1).cast("int"))


def event_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as transactions: real times, users and amounts; baskets from ``props``."""
    k = F.get_json_object("props", "$.k").cast("long")
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("transaction_id"),
        "user_id",
        F.col("ts").alias("timestamp"),
        F.col("value").alias("amount"),
        F.col("event_type").alias("category"),
        _one_of(REGIONS, F.col("user_id")).alias("region"),
        _one_of(DEVICES, F.col("user_id")).alias("device_type"),
        (k * 36).alias("session_duration"),
        k.alias("items_in_cart"),
        (F.col("event_type") == "error").cast("long").alias("is_returned"),
        (F.pmod("event_id", F.lit(500)) / F.lit(1000.0)).alias("discount_pct"),
        (F.pmod("event_id", F.lit(50)) + 1).alias("page_views"),
    )


def arrivals(events: DataFrame) -> DataFrame:
    """Event transactions with an arrival time 0 to 10 seconds after the event."""
    delay = F.make_dt_interval(secs=F.pmod("transaction_id", F.lit(11)))
    return events.withColumn("arrival_ts", F.col("timestamp") + delay)


def order_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as transactions: real baskets, returns and discounts.

    The dimensions are joined with the orders first, so the lines are shuffled once for them.
    """
    customers = (
        table(spark, sf_dir, "customer")
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    )
    orders = table(spark, sf_dir, "orders").join(customers, F.col("o_custkey") == F.col("c_custkey"))
    lines = table(spark, sf_dir, "lineitem").join(
        table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey")
    )
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("l_orderkey").alias("transaction_id"),
        F.col("o_custkey").alias("user_id"),
        F.col("o_orderdate").alias("timestamp"),
        F.col("l_extendedprice").alias("amount"),
        F.col("c_mktsegment").alias("category"),
        F.col("r_name").alias("region"),
        F.col("o_orderpriority").alias("device_type"),
        F.col("p_retailprice").alias("session_duration"),
        F.col("l_quantity").alias("items_in_cart"),
        (F.col("l_returnflag") == "R").cast("long").alias("is_returned"),
        F.col("l_discount").alias("discount_pct"),
        F.col("p_size").alias("page_views"),
    )
