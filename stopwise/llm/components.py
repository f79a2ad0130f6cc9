"""Connected components of nodes that share keys, in Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stopwise.llm.shared import delete, reclaim, stored_until


def components(members: DataFrame) -> DataFrame:
    """(node, label) for rows (node, key): nodes with a common key are connected.

    The label is the smallest node of the component. Each round takes the smallest
    label of every key and of every node, then that label's own label, so paths
    halve. Rounds end when no label changes; each is a stored table, which replaces
    the one before.
    """
    spark = members.sparkSession
    members, pairs = stored_until(members.select("node", "key").distinct())
    labels, before = members.select("node", F.col("node").alias("label")).distinct(), None
    while True:
        known = members.join(labels, "node")
        keys = known.groupBy("key").agg(F.min("label").alias("least"))
        nearer = members.join(keys, "key").groupBy("node").agg(F.min("least").alias("near"))
        # A label is a node, so its own label is known: jump there.
        jump = nearer.select(F.col("node").alias("near"), F.col("near").alias("far"))
        moved, path = stored_until(
            labels.join(nearer, "node")
            .join(jump, "near")
            .select("node", F.col("far").alias("label"), (F.col("far") != F.col("label")).alias("new"))
        )
        labels = moved.select("node", "label")
        if before is not None:
            delete(spark, before)
        before = path
        reclaim(spark)
        if moved.where("new").isEmpty():
            delete(spark, pairs)
            return labels
