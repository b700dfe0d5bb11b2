"""Connected components of a large graph by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isobar.storage import materialise


def components(edges: DataFrame) -> DataFrame:
    """(node, label) of every node of the edges (a, b); a label is a node of its component.

    Each round, every node points to its smallest neighbour if that is smaller, pointers
    are followed to their ends, and only edges between different ends are kept. The graph
    left at least halves its nodes that have edges, so the rounds grow with the logarithm
    of the largest component. Tables are written between the steps.
    """
    left = materialise(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    labels = materialise(_ends(left).select(F.col("a").alias("node"), F.col("a").alias("label")).distinct(), "labels")
    while not left.isEmpty():
        towards = _followed(_ends(left).groupBy("a").agg(F.least(F.min("b"), F.min("a")).alias("to")))
        labels = materialise(_moved(labels, towards, "label"), "labels")
        moved = _moved(_moved(left, towards, "a"), towards, "b").where("a <> b")
        left = materialise(moved.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    return labels


def _ends(edges: DataFrame) -> DataFrame:
    return edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _moved(table: DataFrame, towards: DataFrame, column: str) -> DataFrame:
    """``table`` with the nodes of one column replaced by what they point to."""
    joined = table.join(towards.select(F.col("a").alias("_from"), F.col("to").alias("_to")), F.col(column) == F.col("_from"), "left")
    return joined.withColumn(column, F.coalesce("_to", column)).select(*table.columns)


def _followed(towards: DataFrame) -> DataFrame:
    """Pointers replaced by where they end, each step twice as far."""
    towards = materialise(towards, "pointers")
    while True:
        further = materialise(_moved(towards, towards, "to"), "pointers")
        changed = further.join(towards.select("a", F.col("to").alias("before")), "a").where("to <> before")
        if changed.isEmpty():
            return further
        towards = further
