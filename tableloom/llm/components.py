"""Connected components by the smallest label, with every round written to the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableloom.session import freeze


def components(edges: DataFrame) -> DataFrame:
    """``id, root`` for each id in ``a, b``: the smallest id it is connected to.

    In a round every id hooks to the smallest id around it, the trees this makes are flattened by doubling, and each tree becomes
    one id, its root, in the graph of the next round. Only ids smaller than all around them stay. Of these, one that nothing hooked
    to sees a smaller id in the round after, and as many ids hooked as there are others: two rounds at least halve the ids. So any
    graph settles, in rounds that grow with the logarithm of its ids, and rounds are as many as it takes.
    Minima are folded on the map side, and a much linked id is a skewed join's many rows, which adaptive execution splits.
    """
    turned = lambda e: e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    left = freeze(turned(edges.where("a <> b").select("a", "b")), "edges")
    rounds = []
    while True:
        trees = freeze(left.groupBy(F.col("a").alias("id")).agg(F.least(F.min("b"), F.first("a")).alias("root")), "labels")
        trees = _flat(trees)
        rounds.append(trees)
        of = lambda end: trees.select(F.col("id").alias(end), F.col("root").alias(f"root_{end}"))  # noqa: B023, E731
        met = left.where("a < b").join(of("a"), "a").join(of("b"), "b").where("root_a <> root_b")
        left = freeze(turned(met.select(F.col("root_a").alias("a"), F.col("root_b").alias("b"))), "edges")
        if left.isEmpty():
            break
    labels = rounds.pop()
    while rounds:  # a round's roots are the ids of the round after, unless nothing was left around them
        heads = labels.select(F.col("id").alias("root"), F.col("root").alias("head"))
        labels = freeze(rounds.pop().join(heads, "root", "left").select("id", F.coalesce("head", "root").alias("root")), "labels")
    return labels


def _flat(trees: DataFrame) -> DataFrame:
    """Each id's root in place of its parent; a pass halves every id's way."""
    while True:
        heads = trees.where("root <> id").select(F.col("id").alias("root"), F.col("root").alias("head"))
        moved = freeze(trees.join(heads, "root", "left").select("id", F.coalesce("head", "root").alias("root"), F.col("head").isNotNull().alias("moved")), "labels")
        trees = moved.select("id", "root")
        if moved.where("moved").isEmpty():
            return trees
