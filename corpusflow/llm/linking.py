"""All links between the members of buckets, without all pairs of a bucket.

A bucket may hold a third of all members. Every member is first compared with a few leaders of its
bucket; the links found join the members into classes. Pairs inside a class need no comparison,
because only connectivity is asked for. In each bucket the class with the most members is set
aside, and only members outside it are compared with the others. A bucket of near copies thus
costs rows in proportion to its members, and no link between two classes is lost. A cheap necessary
condition can stand in the joins that make pairs, so that only pairs that meet it are ever written.

Members mostly come out of an explode, which Spark sizes like the rows before it, and their tables are files that compress
well. Neither says how large a side is in memory, so joins of members are never broadcast, whatever Spark's estimate.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from corpusflow.llm.graph import components
from corpusflow.session import materialise

LEADERS = 2

Verify = Callable[[DataFrame], DataFrame]
Fits = Callable[[Column, Column], Column]


def _spread(rows: DataFrame) -> DataFrame:
    """``rows`` for a join by shuffle, whatever size Spark takes them for."""
    return rows.hint("merge")


def shared_members(members: DataFrame) -> DataFrame:
    """Members (bucket, node, n) of buckets of two and more, written down."""
    shared = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return materialise(members.join(_spread(shared), "bucket"), "members")


def _gathered(members: DataFrame) -> DataFrame:
    """Members of buckets of two and more with their number and leaders, the least and the greatest node, by one join."""
    leaders = F.array(F.min("node"), F.max("node")).alias("leaders")
    shared = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), leaders).where("n > 1")
    return materialise(members.join(_spread(shared), "bucket"), "grouped")


def _grouped(kept: DataFrame) -> DataFrame:
    """Members with their bucket's leaders."""

    def leader(number: int) -> Column:
        return F.min(F.struct(F.xxhash64("node", F.lit(number)).alias("h"), F.col("node").alias("n")))["n"]

    leaders = kept.groupBy("bucket").agg(F.array_distinct(F.array(*[leader(k) for k in range(LEADERS)])).alias("leaders"))
    return materialise(kept.join(_spread(leaders), "bucket"), "grouped")


def _pairs(rows: DataFrame) -> DataFrame:
    return rows.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a != b").distinct()


def linked_classes(members: DataFrame, verify: Verify, fits: Fits | None = None, facts: DataFrame | None = None) -> DataFrame:
    """(node, component) of all nodes with a link.

    ``members`` has distinct rows (bucket, node), or is what ``shared_members`` made of them; ``verify``
    keeps those of the pairs (a, b) that are linked. ``fits`` of two facts is true for every linked pair; ``facts``
    has one row (node, fact) per member, else the node is its own fact. Buckets and nodes must not be null.
    """

    def fact(of: str) -> DataFrame:
        return facts.select(F.col("node").alias(of), F.col("fact").alias(f"_f{of}"))

    def fitting(pairs: DataFrame) -> DataFrame:
        if fits is None:
            return pairs
        if facts is None:
            return pairs.where(fits(F.col("a"), F.col("b")))
        return pairs.join(fact("a"), "a").join(fact("b"), "b").where(fits(F.col("_fa"), F.col("_fb"))).select("a", "b")

    grouped = _grouped(members) if "n" in members.columns else _gathered(members)
    leaders = F.col("leaders")
    if fits is not None and facts is None:
        # Tested where the leaders stand, so that only pairs that meet the condition are ever rows.
        leaders = F.filter(leaders, lambda b: (b != F.col("node")) & fits(F.col("node"), b))
    led = grouped.select(F.col("node").alias("a"), F.explode(leaders).alias("b"))
    edges = materialise(verify(fitting(_pairs(led))), "links")
    classes = components(edges)
    # All pairs of a bucket of three are pairs with its least or its greatest node.
    settled = 2 if "n" in members.columns else 3
    placed = grouped.where(F.col("n") > settled).join(_spread(classes), "node", "left").select(
        "bucket", "node", "leaders", F.coalesce("component", "node").alias("class")
    )
    placed = materialise(placed, "placed")
    sizes = placed.groupBy("bucket", "class").agg(F.count(F.lit(1)).alias("size"))
    most = sizes.groupBy("bucket").agg(F.max(F.struct("size", "class"))["class"].alias("most"), F.count(F.lit(1)).alias("classes"))
    compared = F.array_contains("leaders", F.col("node"))
    rest = placed.where(~compared).join(_spread(most.where("classes > 1")), "bucket").drop("leaders")
    rest = materialise(rest, "rest")
    outside = rest.where(F.col("class") != F.col("most")).select("bucket", F.col("node").alias("a"), F.col("class").alias("_ca"))
    others = rest.select("bucket", F.col("node").alias("b"), F.col("class").alias("_cb"))
    met = F.col("_ca") != F.col("_cb")
    if fits is not None and facts is not None:
        # Facts ride along, so that the condition is part of the join and pairs that miss it are never rows.
        outside, others = outside.join(fact("a"), "a"), others.join(fact("b"), "b")
        met = met & fits(F.col("_fa"), F.col("_fb"))
    elif fits is not None:
        met = met & fits(F.col("a"), F.col("b"))
    outside = outside.withColumnRenamed("bucket", "_bucket")
    open_pairs = materialise(_pairs(outside.join(_spread(others), (F.col("_bucket") == F.col("bucket")) & met)), "open")
    if open_pairs.isEmpty():
        return classes
    late = materialise(verify(open_pairs), "links")
    return components(edges.unionByName(late))
