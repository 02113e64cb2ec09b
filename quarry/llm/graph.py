"""Connected components of a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of the edges (a, b), both bigint: label is the same for connected nodes.

    Each round gives every node one of itself and its neighbours, the one whose hash of that round is least, and contracts
    the edges; as the order is another each round, about half of the nodes go whatever the graph's shape and names, a
    chain too. A table of few columns is written per round, and rounds end when no edge is left. Aggregation comes
    before each shuffle, and a node with very many edges meets its label in a join whose partitions Spark can split.
    """
    edges = cut(edges.select("a", "b").where("a <> b").distinct(), "edges")
    labels = cut(edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct().withColumn("label", F.col("node")), "labels")
    turn = 0
    while not edges.isEmpty():
        turn += 1
        both = edges.union(edges.select("b", "a"))
        ranked = lambda c: F.struct(F.xxhash64(F.lit(turn), c).alias("h"), F.col(c).alias("x"))
        near = both.groupBy("a").agg(F.min(ranked("b")).alias("m"))
        least = cut(near.select(F.col("a").alias("node"), F.least(ranked("a"), "m")["x"].alias("to")), "least")
        labels = cut(labels.join(least.withColumnRenamed("node", "label"), "label", "left").select("node", F.coalesce("to", "label").alias("label")), "labels")
        first = edges.join(least.select(F.col("node").alias("a"), F.col("to").alias("x")), "a")
        second = first.join(least.select(F.col("node").alias("b"), F.col("to").alias("y")), "b")
        edges = cut(second.where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "edges")
    return labels
