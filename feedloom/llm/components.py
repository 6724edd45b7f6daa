"""Connected components by label propagation with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.scratch import materialize, scratch_path


def components(links: DataFrame) -> DataFrame:
    """(node, label) for every node of the links (a, b): label is the smallest node reachable.

    Each round takes the smallest label among the neighbours and then the label of that label, so that chains shrink by
    half or more a round. Every round is a written table, which survives a lost executor. Minima are made before the shuffle; both
    sides of the joins are shuffled tables, so that Spark can split a node with very many links.
    """
    spark = links.sparkSession
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).filter("a != b").distinct()
    edges = materialize(both, scratch_path(spark, "cc-edges"))
    labels = edges.groupBy("a").agg(F.min("b").alias("low"))
    labels = materialize(labels.select(F.col("a").alias("node"), F.least("a", "low").alias("label")), scratch_path(spark, "cc-labels"))
    while True:
        near = edges.join(labels, edges.b == labels.node).groupBy("a").agg(F.min("label").alias("near"))
        met = labels.join(near, labels.node == near.a).select("node", "label", F.least("label", "near").alias("met"))
        met = materialize(met, scratch_path(spark, "cc-met"))
        of = met.select(F.col("node").alias("via"), F.col("met").alias("jump"))
        jumped = met.join(of, met.met == of.via).select("node", F.col("jump").alias("label"), (F.col("label") != F.col("jump")).alias("moved"))
        jumped = materialize(jumped, scratch_path(spark, "cc-labels"))
        labels = jumped.select("node", "label")
        if not jumped.filter("moved").limit(1).count():
            return labels
