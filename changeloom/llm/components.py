"""Connected components of links between documents, as joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changeloom.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """``(c, label)`` for every node of the links ``(a, b)``: the least node of its component.

    In a round each node takes the least label among its neighbours and itself, then the label of that
    label, so that labels travel twice as far each round. Each round is written: its lineage ends
    there, and lost executors cost one round at most.
    """
    both = stored(links.select("a", "b").union(links.select("b", "a")).distinct(), "links")
    labels = stored(both.select(F.col("a").alias("c")).distinct().select("c", F.col("c").alias("label")), "labels")
    while True:
        near = both.join(labels.select(F.col("c").alias("b"), "label"), "b").groupBy("a").agg(F.min("label").alias("near"))
        pulled = labels.join(near.withColumnRenamed("a", "c"), "c", "left").select(
            "c", F.least("label", F.coalesce("near", "label")).alias("to"), F.col("label").alias("was")
        )
        pulled = stored(pulled, "labels")
        over = pulled.select(F.col("c").alias("to"), F.col("to").alias("label"))
        jumped = pulled.join(over, "to", "left").select("c", F.least("to", F.coalesce("label", "to")).alias("label"), "was")
        jumped = stored(jumped, "labels")
        labels = jumped.select("c", "label")
        if jumped.where("label <> was").isEmpty():
            return labels
