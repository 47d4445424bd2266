"""Connected components of an edge table, by minimum labels with shortcuts; nothing is gathered on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blockloom.llm.common import drop, store


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, root (the smallest node of its component) for every node that has an edge."""
    both = edges.select(F.col(a).alias("u"), F.col(b).alias("v"))
    links = store(both.union(both.select("v", "u")).filter("u <> v").distinct(), "links")
    labels = store(links.groupBy(F.col("u").alias("node")).agg(F.least(F.col("node"), F.min("v")).alias("root")), "labels")
    while True:
        # the smallest label among a node's neighbours, told to the node and to the node's old root
        seen = links.join(labels, links.v == labels.node).groupBy(F.col("u").alias("node")).agg(F.min("root").alias("low"))
        own = labels.join(seen, "node").select("node", "root", F.least("root", "low").alias("low"))
        told = own.select("node", "low").union(own.select(F.col("root").alias("node"), "low")).groupBy("node").agg(F.min("low").alias("root"))
        told = store(told, "told")
        up = told.select(F.col("node").alias("root"), F.col("root").alias("higher"))
        new = store(told.join(up, "root", "left").select("node", F.least("root", F.coalesce("higher", "root")).alias("root")), "labels")
        changed = new.join(labels.withColumnRenamed("root", "was"), "node").filter("root <> was").limit(1).count()
        drop(labels, told)
        labels = new
        if not changed:
            drop(links)
            return labels
