"""Joining facts to a dimension when one key may hold a large share of the facts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def heavy_keys(facts: DataFrame, key: str, parts: int) -> DataFrame:
    """(key, _salts) of the keys that hold more than one part in ``parts`` of the facts, and how many parts that is.

    Shares add up to one, so there are fewer than ``parts`` such keys.
    """
    counts = facts.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    total = counts.agg(F.sum("_n")).scalar()
    return counts.select(key, F.ceil(F.col("_n") * parts / total).cast("int").alias("_salts")).where(F.col("_salts") > 1)


def spread_join(
    facts: DataFrame, dimension: DataFrame, key: str, by: Sequence[str], how: str = "inner", weigh: DataFrame | None = None,
    salts: int | None = None,
) -> DataFrame:
    """Join on ``key`` with the facts of heavy keys spread by the columns ``by``.

    A key with a share of the facts gets that share of the shuffle partitions: its facts are dealt to as many
    salts, and its dimension row is repeated for each. All other rows are joined as they are. ``weigh`` has
    the keys to be counted, where that is cheaper than to count those of ``facts``; ``salts`` stands for the
    number of shuffle partitions.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"unsupported join: {how}")
    parts = salts or int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Fewer rows than there are partitions, see heavy_keys.
    heavy = F.broadcast(heavy_keys(facts if weigh is None else weigh, key, parts))
    own = F.coalesce("_salts", F.lit(1))

    def salted(df: DataFrame, salt: Column) -> DataFrame:
        return df.join(heavy, key, "left").withColumn("_salt", salt).drop("_salts")

    dealt = salted(facts, F.pmod(F.xxhash64(*by), own).cast("int"))
    repeated = salted(dimension, F.explode(F.sequence(F.lit(0), own - 1)))
    return dealt.join(repeated, [key, "_salt"], how).drop("_salt")
