"""Connected components of a table of edges by rounds of least labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from traitlens.llm.common import written

#: A round at least halves the steps to the least label; this is far beyond any graph's need.
MAX_ROUNDS = 60


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of ``edges`` (a, b): the least node of its component.

    Each round sends a node's label to its neighbours (combined before the
    shuffle, so a hub costs one row per task), then follows labels of labels.
    Rounds are written tables; a lost executor costs one round. Nothing but the
    number of changes reaches the driver.
    """
    both = written(edges.select("a", "b").unionByName(edges.selectExpr("b as a", "a as b"))
                   .where("a <> b").distinct(), "edges")
    labels = written(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"))
                     .select("node", F.least("node", "m").alias("label")), "labels")
    for _ in range(MAX_ROUNDS):
        heard = both.join(labels, both.b == labels.node).groupBy("a").agg(F.min("label").alias("heard"))
        told = labels.join(heard, labels.node == heard.a).select(
            "node", F.col("label").alias("old"), F.least("label", "heard").alias("label"))
        told = written(told, "told")
        via = told.select(F.col("node").alias("via"), F.col("label").alias("further"))
        labels = written(told.join(via, told.label == via.via, "left").select(
            "node", "old", F.least("label", F.coalesce("further", "label")).alias("label")), "labels")
        if labels.where("label <> old").isEmpty():
            return labels.select("node", "label")
        labels = labels.select("node", "label")
    raise RuntimeError(f"labels still change after {MAX_ROUNDS} rounds")
