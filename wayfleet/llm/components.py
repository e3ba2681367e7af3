"""Connected components of a graph too large for one machine: least labels with pointer jumping, each round written down."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfleet.llm.common import settle


def connected(edges: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """(node, root) for every node of an edge; ``root`` is the least node of its component.

    A round takes the least label among a node's neighbours, then the label of that label, so that
    labels travel twice as far each time.  Every round's labels are a table of their own: no lineage grows, and
    a lost executor costs one round.  Only the number of changed labels comes to the driver.  Minima are
    combined in each task before the shuffle, and the joins are ones Spark can split when a node has very many edges.
    """
    both = edges.select(F.col(left).alias("node"), F.col(right).alias("other")).where("node <> other")
    both = settle(both.unionByName(both.select(F.col("other").alias("node"), F.col("node").alias("other"))).distinct(), "edges")
    labels = settle(both.groupBy("node").agg(F.least(F.col("node"), F.min("other")).alias("root")), "labels")
    while True:
        seen = both.join(labels.select(F.col("node").alias("other"), F.col("root").alias("theirs")), "other")
        nearest = seen.groupBy("node").agg(F.min("theirs").alias("theirs"))
        lower = labels.join(nearest, "node").select("node", F.col("root").alias("was"), F.least("root", "theirs").alias("root"))
        lower = settle(lower, "labels")
        jump = lower.select(F.col("node").alias("at"), F.col("root").alias("further"))
        moved = settle(lower.join(jump, F.col("root") == F.col("at")).select("node", "was", F.least("root", "further").alias("root")), "labels")
        if moved.where("was <> root").isEmpty():
            return moved.select("node", "root")
        labels = moved.select("node", "root")
