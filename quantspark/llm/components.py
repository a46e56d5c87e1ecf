"""Connected components as a few DataFrame joins per round, on ever smaller graphs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quantspark.llm.common import stored


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node in ``edges`` (a, b); the component is its smallest node.

    Each round hooks every node to its smallest neighbour, follows the hooks
    to their roots by pointer doubling, and contracts the graph to the roots.
    A root is smaller than all its neighbours, so a round at least halves the
    nodes that still have edges.  Every step is a stored table: a lost
    executor repeats one join at most.  An empty graph has no nodes.
    """
    edges = stored(edges.filter(F.col("a") != F.col("b"))
                   .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    labels = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hook = stored(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("to"))
                      .withColumn("to", F.least("node", "to")))
        while True:
            nxt = hook.select(F.col("node").alias("to"), F.col("to").alias("root"))
            hook = stored(hook.join(nxt, "to").select("node", F.col("root").alias("to"),
                                                      (F.col("root") != F.col("to")).alias("moved")))
            moved = hook.filter("moved").limit(1).count()
            hook = hook.drop("moved")
            if not moved:
                break
        if labels is None:
            labels = hook.withColumnRenamed("to", "component")
        else:
            step = hook.select(F.col("node").alias("component"), "to")
            labels = stored(labels.join(step, "component", "left")
                            .select("node", F.coalesce("to", "component").alias("component")))
        ends = [hook.select(F.col("node").alias(c), F.col("to").alias("t" + c)) for c in "ab"]
        edges = stored(edges.join(ends[0], "a").join(ends[1], "b").filter("ta != tb")
                       .select(F.least("ta", "tb").alias("a"), F.greatest("ta", "tb").alias("b")).distinct())
        if edges.isEmpty():
            return labels
