"""Connected components of a table of links, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from territory.llm.blocks import store


def components(links: DataFrame, one: str = "a", other: str = "b") -> DataFrame:
    """The smallest node that each linked node reaches: ``node``, ``label``.

    In a round every node points to its smallest neighbour (or itself),
    pointers are followed to their ends, and the links between the ends go to
    the next round. Pointers lead to smaller nodes, so there are no circles,
    and every node that is not the smallest of its neighbourhood goes; links
    that run into one centre need one round. Links may repeat, run either way
    or from a node to itself; nodes are any type with an order, nulls are no
    nodes. Nothing is collected; hot nodes are combined before the shuffle.
    """
    edges = store(links.select(F.col(one).alias("a"), F.col(other).alias("b")).filter("a <> b").distinct(), "cc-links")
    labels = None
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        pointers = store(
            both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("to")).select(F.col("a").alias("node"), "to"),
            "cc-pointers",
        )
        while True:
            ahead = pointers.select(F.col("node").alias("to"), F.col("to").alias("far"))
            jumped = store(
                pointers.join(ahead, "to").select("node", F.col("far").alias("to"), (F.col("far") != F.col("to")).alias("moved")),
                "cc-pointers",
            )
            pointers = jumped.select("node", "to")
            if jumped.filter("moved").isEmpty():
                break
        if labels is None:
            labels = pointers.withColumnRenamed("to", "label")
        else:
            further = pointers.select(F.col("node").alias("label"), F.col("to").alias("far"))
            labels = store(
                labels.join(further, "label", "left").select("node", F.coalesce("far", "label").alias("label")),
                "cc-labels",
            )
        ends = pointers.select(F.col("node").alias("a"), F.col("to").alias("x"))
        moved = edges.join(ends, "a").select("x", F.col("b")).join(
            pointers.select(F.col("node").alias("b"), F.col("to").alias("y")), "b"
        )
        edges = store(moved.filter("x <> y").select(F.col("x").alias("a"), F.col("y").alias("b")).distinct(), "cc-links")
    if labels is None:
        labels = edges.select(F.col("a").alias("node"), F.col("b").alias("label"))
    return labels
