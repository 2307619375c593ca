"""Connected components by label passing, in Spark tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from waymeter.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for the ends of edges ``a``, ``b`` (bigint); the component is its smallest node.

    Each round takes the smallest label among the neighbours and then the label of that
    label, so the rounds grow with the logarithm of a component's width. A node with very
    many edges meets its labels in a join that Spark can split, and in a minimum that is
    formed in each task first. Loops and repeated edges do no harm.
    """
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = stored(both.filter("a != b").distinct(), "edges")
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("a")).alias("component")), "labels")
    total = None
    while True:
        # labels only ever fall, so an unchanged sum is an unchanged table
        now = labels.agg(F.sum(F.col("component").cast("decimal(38,0)"))).first()[0]
        if now == total:
            return labels
        total = now
        seen = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("component").alias("near"))
        lower = stored(labels.join(seen, "node").select("node", F.least("component", "near").alias("component")), "labels")
        of = lower.select(F.col("node").alias("component"), F.col("component").alias("root"))
        labels = stored(lower.join(of, "component").select("node", F.col("root").alias("component")), "labels")
