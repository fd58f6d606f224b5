"""Connected components of a table of links, by joins alone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from consentflow.llm.common import stage


def components(links: DataFrame) -> DataFrame:
    """``node``, ``root`` (the smallest node reachable) for every node in
    ``links(a, b)``.

    Each round takes the least label among the neighbours and then the label's
    own label, so paths halve; every round is written to the shared folder, so
    plans stay short and lost executors cost one round. Rounds end when no
    label changes -- their number grows with the logarithm of the longest path.
    Only the number of changed labels comes to the driver.
    """
    both = stage(links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    labels = stage(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select(
        "node", F.least("node", "m").alias("root")), "labels")
    while True:
        least = both.join(labels, both["b"] == labels["node"]).groupBy(F.col("a").alias("node")).agg(
            F.min("root").alias("m"))
        taken = labels.join(least, "node").select(
            "node", F.least("root", "m").alias("root"), F.col("root").alias("old"))
        taken = stage(taken, "labels")
        up = taken.select(F.col("node").alias("root"), F.col("root").alias("top"))
        after = stage(taken.join(up, "root").select("node", F.col("top").alias("root"), "old"), "labels")
        labels = after.select("node", "root")
        if after.where("root <> old").isEmpty():
            return labels
