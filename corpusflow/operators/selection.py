"""Row selection: minimum length, systematic head samples, cadence, caps per domain."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window, functions as F

from corpusflow.operators.joins import spread_join
from corpusflow.session import materialise

MIN_TOKENS = 100
#: Parts of a domain that are cut to their first rows before they meet.
SALTS = 64


@dataclass(frozen=True)
class HeadSample:
    """Look at the first ``num_samples`` rows and take every ``every``-th of them."""

    num_samples: int
    every: int


# The validation samples of the default domains.
DEFAULT_SAMPLES = {"web": HeadSample(5000, 100), "code": HeadSample(2000, 50), "math": HeadSample(1000, 20)}


def longer_than(df: DataFrame, min_tokens: int = MIN_TOKENS, n_tokens: str = "n_tokens") -> DataFrame:
    return df.where(F.col(n_tokens) > min_tokens)


def firsts(df: DataFrame, n: int, order: str, domain: str) -> DataFrame:
    """(domain, order, _rank) of the first ``n`` rows of every domain.

    A domain is split into SALTS parts, each of which keeps its first n, in the map tasks already. What
    meets by domain alone are SALTS times n rows of two columns, however many rows and tasks there are.
    """
    keys = df.select(domain, order).withColumn("_salt", F.pmod(F.xxhash64(order), F.lit(SALTS)))
    rank = lambda *by: F.row_number().over(Window.partitionBy(domain, *by).orderBy(order))
    few = keys.withColumn("_rank", rank("_salt")).where(F.col("_rank") <= n)
    return few.withColumn("_rank", rank()).where(F.col("_rank") <= n).select(domain, order, "_rank")


def heads(df: DataFrame, samples: Mapping[str, HeadSample], order: str, domain: str) -> DataFrame:
    """(domain, order, row_index) of the sampled rows."""
    plan = df.sparkSession.createDataFrame(
        [(d, s.num_samples, s.every) for d, s in samples.items()], f"{domain} string, _n int, _k int"
    )
    most = max(s.num_samples for s in samples.values())
    first = firsts(df.where(F.col(domain).isin(*samples)), most, order, domain)
    return (
        first.join(F.broadcast(plan), domain)
        .where((F.col("_rank") <= F.col("_n")) & ((F.col("_rank") - 1) % F.col("_k") == 0))
        .select(domain, order, (F.col("_rank") - 1).alias("row_index"))
    )


def head_sample(
    df: DataFrame, samples: Mapping[str, HeadSample] = DEFAULT_SAMPLES, order: str = "doc_id", domain: str = "domain"
) -> DataFrame:
    """Systematic head sample per domain; adds ``row_index``, the 0-based index in the domain.

    The index is found on the two key columns; the constant limit on it lets every task keep only the
    head of each domain before the shuffle. The few chosen keys are then matched to the full rows and
    the sample is written down: a filter on a later, costly expression would otherwise be pushed below
    the match and run on the whole corpus.
    """
    chosen = heads(df, samples, order, domain)
    return materialise(df.join(chosen, [domain, order]), "sample")


def cadence(df: DataFrame, every: int, step: str = "step", skip_zero: bool = False) -> DataFrame:
    """Rows whose step is a multiple of ``every``; evaluation also skips step 0."""
    kept = df.where(F.col(step) % every == 0)
    return kept.where(F.col(step) > 0) if skip_zero else kept


def first_per_domain(df: DataFrame, n: int | None, order: str, domain: str = "domain") -> DataFrame:
    """The first n rows of every domain; None or 0 keeps all. ``order`` is a total order in a domain; rows without one are left out."""
    if not n:
        return df
    # One key a domain: its n-th, or the last of fewer. The rest is a filter.
    cuts = firsts(df, n, order, domain).groupBy(domain).agg(F.max(order).alias("_cut"))
    known = df.where(F.col(domain).isNotNull())
    return spread_join(known, cuts, domain, [order]).where(F.col(order) <= F.col("_cut")).drop("_cut").select(*df.columns)
