"""Connected components of links between 64-bit ids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from estate.llm.storage import stored


def components(links: DataFrame) -> DataFrame:
    """(a, b) -> (id, component): each id of a link with the smallest id of its component.

    Every round takes the smallest label among an id and its neighbours and then the label's own
    label; the rounds grow with the logarithm of the longest chain. All state is in stored tables.
    """
    edges = stored(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = stored(edges.select(F.col("a").alias("id")).distinct().withColumn("component", F.col("id")), "labels")
    while True:
        least = edges.join(labels, edges.b == labels.id).groupBy("a").agg(F.min("component").alias("near"))
        met = labels.join(least, labels.id == least.a).select("id", F.col("component").alias("was"), F.least("component", "near").alias("now"))
        met = stored(met, "labels-met")
        of = met.select(F.col("id").alias("now"), F.col("now").alias("jump"))
        labels = stored(met.join(of, "now").select("id", F.least("now", "jump").alias("component"), (F.least("now", "jump") != F.col("was")).alias("moved")), "labels")
        if labels.where("moved").isEmpty():
            return labels.select("id", "component")
        labels = labels.select("id", "component")
