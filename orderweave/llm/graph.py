"""Connected components of links between documents, as DataFrame rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .spark import written


def components(links: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable over the links (a, b), for every node of a link.

    Union-find by rounds: each node takes the least label around it, then the
    label of its label, until nothing changes. Paths shorten by half a round.
    """
    links = links.select("a", "b").where("a <> b")
    both = written(links.union(links.select("b", "a")).distinct())
    labels = written(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("a")).alias("label")))
    total = _total(labels)
    while True:
        around = both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("label").alias("near"))
        nearer = written(labels.join(around, labels["node"] == around["a"]).select("node", F.least("label", "near").alias("label")))
        above = nearer.select(F.col("node").alias("label"), F.col("label").alias("above"))
        labels = written(nearer.join(above, "label").select("node", F.col("above").alias("label")))
        before, total = total, _total(labels)
        if total == before:  # labels only ever fall
            return labels.withColumnRenamed("label", "component")


def _total(labels: DataFrame):
    return labels.agg(F.sum(F.col("label").cast("decimal(38,0)"))).first()[0]
