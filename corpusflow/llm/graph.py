"""Connected components of an edge list, by contraction."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from corpusflow.session import materialise


def _ordered(edges: DataFrame) -> DataFrame:
    return edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a != b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of ``edges`` (a, b); the component is its smallest node.

    In each round every node joins the first of itself and its neighbours, in an order that a hash
    draws anew for the round, and the edges move to the joined nodes. That at least halves long
    chains on average, so the number of rounds is logarithmic. Minima are summed up before the
    shuffle; edges at a hot node are only ever one side of an equi-join, whose partitions Spark can
    split. Each round is written down, which cuts the lineage. Rows with a null end are no edges.
    """
    left = materialise(_ordered(edges), "edges")
    moves: list[DataFrame] = []
    while not moves or not left.isEmpty():
        number = len(moves)

        def rank(node: Column) -> Column:
            return F.struct(F.xxhash64(node, F.lit(number)).alias("h"), node.alias("n"))

        ends = left.select(F.col("a").alias("node"), F.col("b").alias("other")).union(left.select("b", "a"))
        first = ends.groupBy("node").agg(F.min(rank(F.col("other"))).alias("m"))
        move = materialise(first.select("node", F.least("m", rank(F.col("node")))["n"].alias("head")), "heads")
        moves.append(move)
        to_a = move.select(F.col("node").alias("a"), F.col("head").alias("ha"))
        to_b = move.select(F.col("node").alias("b"), F.col("head").alias("hb"))
        moved = left.join(to_a, "a").join(to_b, "b").select(F.col("ha").alias("a"), F.col("hb").alias("b"))
        left = materialise(_ordered(moved), "edges")
    labels = moves[0]
    for move in moves[1:]:
        labels = labels.join(move.select(F.col("node").alias("head"), F.col("head").alias("_next")), "head", "left").select(
            "node", F.coalesce("_next", "head").alias("head")
        )
    labels = materialise(labels, "labels")
    # All nodes are on both sides, in files that compress well: too many for a broadcast, whatever their size as files.
    least = labels.groupBy("head").agg(F.min("node").alias("component"))
    return labels.join(least.hint("merge"), "head").select("node", "component")
