"""Temperature, top-k, nucleus and sampling over a table of scored candidates per query.

Candidates are ranked by (logit descending, token); those without a logit are left out. A query may have
any number of candidates. With top-k the limit on the rank cuts each query in the map tasks, so that a
window of a query holds the k best of every task at most, and their ties. Softmax alone needs two sums per query.
A nucleus without top-k adds up probabilities by bins of logits; only the bin in which the mass is reached is put
in order, in range chunks, so that the largest query does not have to fit into one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from corpusflow.functions.hashing import hash_uniform
from corpusflow.operators.joins import spread_join
from corpusflow.operators.ordering import CHUNK, Running, present, range_chunks, row_count, running
from corpusflow.session import materialise

QUERY, TOKEN, LOGIT = "query_id", "token_id", "logit"
ORDER = ["_down", TOKEN]
_WORK = ("_z", "_down", "_peak", "_e", CHUNK)
#: Bins of one logit, and the last bin, which holds all that is worse.
BINS, LAST_BIN = 16, 800


def _along(df: DataFrame, outs: dict[str, Running]) -> DataFrame:
    return running(df, [QUERY], ORDER, outs, chunk=F.col(CHUNK), stage=False)


def _scaled(df: DataFrame, temperature: float) -> DataFrame:
    if temperature <= 0:
        raise ValueError("temperature must be positive")
    return df.where(F.col(LOGIT).isNotNull()).withColumns(present(df, [QUERY])).withColumn("_z", F.col(LOGIT) / F.lit(float(temperature)))


def ranked(df: DataFrame, temperature: float = 1.0, parts: int | None = None) -> DataFrame:
    """Adds rank, e (probability relative to the best), before and mass (sums of e).

    Candidates without a logit are left out.
    """
    scaled = _scaled(df, temperature).withColumn("_down", -F.col("_z"))
    chunked = range_chunks(scaled, [QUERY, *ORDER], parts)
    peaked = _along(chunked, {"_peak": Running("max", F.col("_z"), whole=True)})
    weighed = peaked.withColumn("_e", F.exp(F.col("_z") - F.col("_peak")))
    return _along(
        weighed,
        {
            "rank": row_count(),
            "before": Running("sum", F.col("_e"), exclusive=True),
            "mass": Running("sum", F.col("_e"), whole=True),
        },
    )


def _clean(df: DataFrame) -> DataFrame:
    return df.drop(*_WORK, "before", "mass", "rank")


def softmax(df: DataFrame, temperature: float = 1.0) -> DataFrame:
    """Adds ``prob``, the softmax of the tempered logits of each query."""
    scaled = _scaled(df, temperature)
    weighed = scaled.join(scaled.groupBy(QUERY).agg(F.max("_z").alias("_peak")), QUERY).withColumn("_e", F.exp(F.col("_z") - F.col("_peak")))
    masses = weighed.groupBy(QUERY).agg(F.sum("_e").alias("mass"))
    return _clean(weighed.join(masses, QUERY).withColumn("prob", F.col("_e") / F.col("mass")))


def _best(scaled: DataFrame, k: int) -> DataFrame:
    """Candidates not below the k-th best of their query. Their number is k per query, and ties with the k-th."""
    by_score = Window.partitionBy(QUERY).orderBy(F.desc("_z"))
    return scaled.withColumn("rank", F.rank().over(by_score)).where(F.col("rank") <= k).drop("rank")


def top_k(df: DataFrame, k: int) -> DataFrame:
    """Candidates not below the k-th best of their query, ties kept; off for k <= 0."""
    return df if k <= 0 else _clean(_best(_scaled(df, 1.0), k))


def _nucleus(scaled: DataFrame, p: float, parts: int | None = None) -> DataFrame:
    """Candidates whose better ones hold at most mass ``p``, with ``_e`` relative to the best of their query.

    A bin is 1 / BINS of a logit; what lies further than LAST_BIN below the best is one bin. All better bins than
    the one that the mass ends in stay whole, all worse ones go. A query has LAST_BIN + 1 bins at most.
    """
    peaks = scaled.groupBy(QUERY).agg(F.max("_z").alias("_peak"))
    below = F.col("_peak") - F.col("_z")
    weighed = spread_join(scaled, peaks, QUERY, [TOKEN]).withColumns(
        {"_e": F.exp(-below), "_bin": F.least(F.floor(below * F.lit(BINS)), F.lit(LAST_BIN)).cast("int")}
    ).drop("_peak")
    bins = weighed.groupBy(QUERY, "_bin").agg(F.sum("_e").alias("_held"))
    better = Window.partitionBy(QUERY).orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    placed = bins.withColumns({
        "_before": F.coalesce(F.sum("_held").over(better), F.lit(0.0)), "_mass": F.sum("_held").over(Window.partitionBy(QUERY)),
    })
    reached = placed.where((F.col("_bin") == 0) | (F.col("_before") / F.col("_mass") <= p))
    cuts = reached.groupBy(QUERY).agg(
        F.max("_bin").alias("_cut"), F.max_by("_before", "_bin").alias("_before"), F.max("_mass").alias("_mass")
    )
    at = spread_join(weighed, cuts, QUERY, [TOKEN], weigh=scaled)
    near = at.where(F.col("_bin") == F.col("_cut")).withColumn("_down", -F.col("_z"))
    ordered = _along(range_chunks(near, [QUERY, *ORDER], parts), {
        "_rank": row_count(), "_inside": Running("sum", F.col("_e"), exclusive=True),
    })
    first = (F.col("_cut") == 0) & (F.col("_rank") == 1)
    kept = ordered.where(first | ((F.col("_before") + F.col("_inside")) / F.col("_mass") <= p))
    names = [*scaled.columns, "_e"]
    return at.where(F.col("_bin") < F.col("_cut")).select(*names).unionByName(kept.select(*names))


def top_p(df: DataFrame, p: float, parts: int | None = None) -> DataFrame:
    """Candidates whose better ones hold at most mass p; the best always stays; off for p >= 1."""
    return df if p >= 1 else _clean(_nucleus(_scaled(df, 1.0), p, parts))


def _ranked_best(df: DataFrame, temperature: float, k: int) -> DataFrame:
    """What ``ranked`` adds, for the k best of each query and their ties alone, by plain windows over them."""
    whole = Window.partitionBy(QUERY)
    ordered = whole.orderBy(F.desc("_z"), TOKEN)
    best = _best(_scaled(df, temperature), k)
    weighed = best.withColumn("_e", F.exp(F.col("_z") - F.max("_z").over(whole)))
    before = F.sum("_e").over(ordered.rowsBetween(Window.unboundedPreceding, -1))
    return weighed.withColumns({
        "rank": F.row_number().over(ordered), "before": F.coalesce(before, F.lit(0.0)), "mass": F.sum("_e").over(whole),
    })


def truncate(
    df: DataFrame, temperature: float = 1.0, k: int = 50, p: float = 0.9, parts: int | None = None
) -> DataFrame:
    """Temperature, then top-k, then nucleus on the renormalised rest; adds the final ``prob``."""
    if k <= 0 and p >= 1:
        return softmax(df, temperature)
    if k <= 0:
        kept = materialise(_nucleus(_scaled(df, temperature), p, parts), "nucleus")
        masses = kept.groupBy(QUERY).agg(F.sum("_e").alias("mass"))
        return _clean(spread_join(kept, masses, QUERY, [TOKEN]).withColumn("prob", F.col("_e") / F.col("mass")))
    rows = _ranked_best(df, temperature, k)
    if p < 1:
        rows = rows.where((F.col("rank") == 1) | (F.col("before") / F.col("mass") <= p)).drop("mass")
        rows = rows.withColumn("mass", F.sum("_e").over(Window.partitionBy(QUERY)))
    return _clean(rows.withColumn("prob", F.col("_e") / F.col("mass")))


def greedy(df: DataFrame) -> DataFrame:
    """The best candidate of each query; the smaller token wins a tie."""
    return df.groupBy(QUERY).agg(F.max_by(TOKEN, F.struct(F.col(LOGIT), -F.col(TOKEN))).alias(TOKEN))


def gumbel(seed: int, *keys: Column) -> Column:
    return -F.log(-F.log(hash_uniform(seed, "gumbel", *keys)))


def sample(df: DataFrame, seed: int, prob: str = "prob") -> DataFrame:
    """One seeded categorical draw per query: the largest log-probability plus Gumbel noise."""
    score = F.log(F.col(prob)) + gumbel(seed, F.col(QUERY), F.col(TOKEN))
    return df.groupBy(QUERY).agg(F.max_by(TOKEN, F.struct(score, -F.col(TOKEN))).alias(TOKEN))
