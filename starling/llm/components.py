"""Connected components of a distributed edge list, without a node's edges in one task.

Every round each node takes the smallest id among itself and its neighbours (a partial aggregate),
and each edge (a, b) becomes an edge between what its ends took. Contracted edges die out after a
number of rounds that grows with the logarithm of the longest path; the labels taken are then
followed back through the rounds. Rounds are written to the shared folder, so lineage stays short.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starling.llm.common import saved


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of `edges` (a, b); component is its smallest node.

    An empty edge list gives no rows; repeated edges and loops change nothing.
    """
    edges = edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a < b")
    rounds: list[DataFrame] = []
    while True:
        edges = saved(edges.distinct(), "component-edges")
        if edges.isEmpty():
            break
        ends = edges.select(F.col("a").alias("node"), F.col("b").alias("next")).unionByName(
            edges.select(F.col("b").alias("node"), F.col("a").alias("next"))
        )
        taken = saved(
            ends.groupBy("node").agg(F.least(F.min("next"), F.first("node")).alias("component")),
            "component-labels",
        )
        rounds.append(taken)
        left = taken.select(F.col("node").alias("a"), F.col("component").alias("_a"))
        right = taken.select(F.col("node").alias("b"), F.col("component").alias("_b"))
        edges = (
            edges.join(left, "a")
            .join(right, "b")
            .select(F.least("_a", "_b").alias("a"), F.greatest("_a", "_b").alias("b"))
            .filter("a < b")
        )
    if not rounds:
        kind = dict(edges.dtypes)["a"]
        return edges.select(F.col("a").alias("node"), F.col("a").cast(kind).alias("component"))
    found = rounds[-1]
    for taken in reversed(rounds[:-1]):
        later = found.select(F.col("node").alias("component"), F.col("component").alias("_last"))
        found = taken.join(later, "component", "left").select(
            "node", F.coalesce("_last", "component").alias("component")
        )
    return found
