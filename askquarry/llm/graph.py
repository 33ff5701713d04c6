"""Connected components of an edge table, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from askquarry.llm.common import Stages


def components(edges: DataFrame, stages: Stages) -> DataFrame:
    """(node, root) for every node with an edge; root is the smallest node of its component.

    ``edges`` has long columns a and b, none null; loops and repeats are allowed. Each round
    points every node at its smallest neighbour, follows the pointers to their
    ends, and keeps only edges between different ends. The nodes at
    least halve, a star is done in one round. A node with very many
    edges is met by partial aggregation and by joins of plain tables, which
    adaptive execution splits.
    """
    label, left = None, stages.save(_between(edges), "edges")
    while not left.isEmpty():
        both = left.union(left.select("b", "a"))
        pointers = both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("to"))
        pointers = _ends(stages.save(pointers, "pointers"), stages)
        if label is None:
            label = pointers.select("node", F.col("to").alias("root"))
        else:
            hop = pointers.withColumnRenamed("node", "root")
            moved = label.join(hop, "root", "left").select("node", F.coalesce("to", "root").alias("root"))
            label = stages.save(moved, "labels")
        at_a, at_b = pointers.toDF("a", "ra"), pointers.toDF("b", "rb")
        left = left.join(at_a, "a").join(at_b, "b").select(F.col("ra").alias("a"), F.col("rb").alias("b"))
        left = stages.save(_between(left), "edges")
    return left.toDF("node", "root") if label is None else label


def _between(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").where("a <> b").distinct()


def _ends(pointers: DataFrame, stages: Stages) -> DataFrame:
    """Pointers followed to the end; they never rise, so the ends point at themselves."""
    while True:
        hop = pointers.select(F.col("node").alias("to"), F.col("to").alias("next"))
        jumped = pointers.join(hop, "to", "left").select("node", F.coalesce("next", "to").alias("to"), F.coalesce(F.col("next") < F.col("to"), F.lit(False)).alias("moved"))
        jumped = stages.save(jumped, "jumped")
        pointers = jumped.select("node", "to")
        if jumped.where("moved").isEmpty():
            return pointers
