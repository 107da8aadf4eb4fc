"""Connected components of a table of memberships, by label propagation with jumps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import lookup, stage


def connected(members: DataFrame) -> DataFrame:
    """Of the rows (item, group): item and label, the smallest item that can be reached by
    going from item to group to item.  An edge is a group of two.

    Each round takes the smallest label of every group and of every item, then follows
    labels once; labels spread in a number of rounds that grows with the logarithm of the
    longest path on usual data.  Each round ends in a stored table.  Groups and labels that
    hold a large share of the rows are joined by broadcast (``lookup``).
    """
    members = stage(members.select("item", "group").distinct(), "members")
    sizes = stage(members.groupBy("group").agg(F.count(F.lit(1)).alias("size")), "group-sizes")
    labels = stage(members.select("item").distinct().withColumn("label", F.col("item")), "labels")
    while True:
        low = members.join(labels, "item").groupBy("group").agg(F.min("label").alias("low"))
        low = stage(low.join(sizes, "group"), "group-labels")
        seen = lookup(members, low, "group", "size").groupBy("item").agg(F.min("low").alias("low"))
        moved = stage(labels.join(seen, "item").select("item", F.col("label").alias("old"), F.least("label", "low").alias("label")), "moved")
        target = moved.select(F.col("item").alias("label"), F.col("label").alias("next"))
        target = stage(moved.groupBy("label").agg(F.count(F.lit(1)).alias("size")).join(target, "label"), "targets")
        labels = stage(lookup(moved, target, "label", "size").select("item", F.col("next").alias("label"), "old"), "labels")
        if labels.filter("label != old").isEmpty():
            return labels.select("item", "label")
        labels = labels.drop("old")
