"""Connected components of a membership table, without a hub that one task has to hold."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.llm.common import salted_lookup, staged


def connected_components(members: DataFrame) -> DataFrame:
    """Label of each ``node``: the least node it is connected to, where nodes in the same ``bucket`` are connected.

    ``members`` has long columns bucket and node. Labels sink to the least one of a bucket, then to the least one of a
    node's buckets, until a round changes none; rounds are as many as the longest shortest path between two buckets.
    Both steps are sums-like aggregates, combined in each task before the shuffle, and large buckets are salted. Each
    round is written to the shared folder, which keeps the plan short and survives lost executors.
    """
    members = staged(members.select("bucket", "node").distinct(), "members")
    labels = staged(members.groupBy("node").agg(F.min("node").alias("label")), "labels")
    while True:
        least = members.join(labels, "node").groupBy("bucket").agg(F.min("label").alias("least"))
        sunk = salted_lookup(members, least, "bucket", "inner").groupBy("node").agg(F.min("least").alias("label"))
        sunk = staged(sunk, "labels")
        changed = sunk.alias("a").join(labels.alias("b"), "node").where("a.label < b.label").limit(1).count()
        labels = sunk
        if not changed:
            return labels
