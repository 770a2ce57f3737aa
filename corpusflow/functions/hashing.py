"""Seeded pseudo-random numbers that depend only on a row's key.

Every random choice in the library (shuffles, weighted races, draws) is a function of
``md5(seed : salt : key)``. The order of rows therefore does not depend on partitioning, retries or
the machine, and any SQL engine can recompute it.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

HASH_BITS = 48
HASH_SPAN = float(1 << HASH_BITS)
#: Race gaps are integers in units of 1/GAP_SCALE, so that their running sums are exact.
GAP_SCALE = 65536


def _given(key: Column) -> Column:
    return F.coalesce(key, F.raise_error(F.lit("a key to hash is null")).cast("string"))


def hash_bits(seed: int, salt: str, *keys: Column) -> Column:
    """A uniform integer in [0, 2^48) from seed, salt and key columns. A null key is an error, as two keys could
    not be told apart without it."""
    text = F.concat_ws(":", F.lit(str(seed)), F.lit(salt), *[_given(k.cast("string")) for k in keys])
    return F.conv(F.substring(F.md5(text), 1, HASH_BITS // 4), 16, 10).cast("bigint")


def hash_uniform(seed: int, salt: str, *keys: Column) -> Column:
    """A uniform double in the open interval (0, 1)."""
    return (hash_bits(seed, salt, *keys) + F.lit(0.5)) / F.lit(HASH_SPAN)


def race_gap(uniform: Column, weight: Column) -> Column:
    """Waiting time of a Poisson process of rate ``weight``, in integer units."""
    return F.floor(-F.log(uniform) / weight * F.lit(float(GAP_SCALE))).cast("bigint")


def int_div(value: Column, divisor: int) -> Column:
    """Integer quotient of a non-negative bigint column."""
    return F.floor((value - value % F.lit(divisor)) / F.lit(divisor)).cast("bigint")
