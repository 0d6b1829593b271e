"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.session import is_small, stage


def components(edges: DataFrame) -> DataFrame:
    """``node, label`` for every end of the edges ``u, v``; the label is the component's smallest node.

    Labels fall to the smallest among the neighbours, then to the label's own label, so a long chain
    takes about as many rounds as its length has binary digits. Each round is stored; minima are
    taken before the shuffle, so a node with very many neighbours costs no more than its edges. The
    table of labels, which keeps its number of rows, is broadcast if that is found to be small.
    """
    both = stage(edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
                 .where("u <> v").distinct(), "links")
    labels = stage(both.groupBy(F.col("u").alias("node")).agg(F.least(F.col("u"), F.min("v")).alias("label")), "labels")
    side = F.broadcast if is_small(labels) else (lambda df: df)
    while True:
        near = both.join(side(labels.withColumnRenamed("node", "v")), "v").groupBy(F.col("u").alias("node")).agg(F.min("label").alias("near"))
        lower = side(labels).join(near, "node").select("node", "label", F.least("label", "near").alias("lower"))
        target = labels.select(F.col("node").alias("lower"), F.col("label").alias("further"))
        lower = stage(lower.join(side(target), "lower").select(
            "node", F.least("lower", "further").alias("label"), (F.least("lower", "further") != F.col("label")).alias("moved")), "labels")
        labels = lower.select("node", "label")
        if lower.where("moved").isEmpty():
            return labels
