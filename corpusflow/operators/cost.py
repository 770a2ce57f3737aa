"""Throughput, cost and progress of runs as columns of a step log.

A step log has run, ts, an id that breaks ties, tokens and optionally steps. A run dimension has run,
total_tokens, tokens_per_step, gpu_type and hourly_rate (null where the price list decides).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from corpusflow.functions.format import INF, fixed, grouped
from corpusflow.operators.joins import spread_join
from corpusflow.operators.ordering import CHUNK, Running, range_chunks, row_count, running, trailing

# USD per hour by accelerator, and the rate of those not listed.
PRICES = {"a100_80gb": 2.50, "a100_40gb": 2.00, "h100": 4.00, "v100": 1.00, "t4": 0.35, "a10g": 1.00}
DEFAULT_RATE = 2.50

# The names of the statistics.
STATS = (
    "tokens_processed", "tokens_remaining", "progress_percent", "tokens_per_second", "tokens_per_dollar",
    "elapsed_hours", "eta_hours", "cost_so_far_usd", "estimated_total_cost_usd", "estimated_remaining_cost_usd",
)


def price_list(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(PRICES.items()), "gpu_type string, rate double")


def with_rate(runs: DataFrame, prices: DataFrame | None = None) -> DataFrame:
    """Adds ``rate``: the run's own hourly rate, else the listed one, else 2.50."""
    listed = price_list(runs.sparkSession) if prices is None else prices
    # The default list has six rows; a list handed in is joined as the planner sees fit.
    side = F.broadcast(listed) if prices is None else listed
    joined = runs.join(side.withColumnRenamed("rate", "_listed"), "gpu_type", "left")
    return joined.withColumn("rate", F.coalesce("hourly_rate", "_listed", F.lit(DEFAULT_RATE))).drop("_listed")


def micros(ts: str = "ts") -> Column:
    return F.unix_micros(F.col(ts).cast("timestamp"))


def cumulative(log: DataFrame, runs: DataFrame, order: Sequence[str], group: Sequence[str] = ("run",),
               parts: int | None = None) -> DataFrame:
    """Adds tokens_processed, steps_completed and elapsed_seconds to every step of a run.

    A step without tokens counts ``steps * tokens_per_step``. Put a segment number into ``group`` to
    start the clock afresh after a resume.
    """
    steps = F.coalesce(F.col("steps"), F.lit(1)) if "steps" in log.columns else F.lit(1)
    known = F.coalesce(F.col("tokens"), steps * F.col("tokens_per_step"))
    joined = spread_join(log, runs, "run", order, weigh=log).withColumns({"tokens": known, "_steps": steps.cast("bigint"), "_us": micros()})
    totals = running(
        joined, group, order,
        {
            "tokens_processed": Running("sum", F.col("tokens")),
            "steps_completed": Running("sum", F.col("_steps")),
            "_start": Running("min", F.col("_us"), whole=True),
        },
        parts=parts,
    )
    return totals.withColumn("elapsed_seconds", (F.col("_us") - F.col("_start")) / 1e6).drop("_steps", "_us", "_start")


def progress_columns(df: DataFrame) -> DataFrame:
    """All derived figures from tokens_processed, elapsed_seconds, total_tokens and rate."""
    out = df.withColumn("elapsed_hours", F.col("elapsed_seconds") / 3600)
    out = out.withColumn(
        "tokens_per_second",
        F.when(F.col("elapsed_seconds") < 1, F.lit(0.0)).otherwise(
            F.col("tokens_processed") / F.nullif(F.col("elapsed_seconds"), F.lit(0.0))
        ),
    )
    out = out.withColumns(
        {
            "tokens_per_hour": F.col("tokens_per_second") * 3600,
            "tokens_per_dollar": F.when(F.col("rate") <= 0, F.lit(INF)).otherwise(
                F.col("tokens_per_second") * 3600 / F.nullif(F.col("rate"), F.lit(0.0))
            ),
            "cost_so_far_usd": F.col("elapsed_hours") * F.col("rate"),
            "progress_fraction": F.when(F.col("total_tokens") <= 0, F.lit(0.0)).otherwise(
                F.least(F.lit(1.0), F.col("tokens_processed") / F.nullif(F.col("total_tokens"), F.lit(0)))
            ),
            "tokens_remaining": F.greatest(F.lit(0), F.col("total_tokens") - F.col("tokens_processed")),
        }
    )
    out = out.withColumns(
        {
            "progress_percent": F.col("progress_fraction") * 100,
            "eta_seconds": F.when(F.col("tokens_per_second") <= 0, F.lit(INF)).otherwise(
                F.col("tokens_remaining") / F.nullif(F.col("tokens_per_second"), F.lit(0.0))
            ),
            "estimated_total_cost_usd": F.when(F.col("progress_fraction") <= 0, F.lit(0.0)).otherwise(
                F.col("cost_so_far_usd") / F.nullif(F.col("progress_fraction"), F.lit(0.0))
            ),
        }
    )
    return out.withColumns(
        {
            "eta_hours": F.col("eta_seconds") / 3600,
            "estimated_remaining_cost_usd": F.greatest(
                F.lit(0.0), F.col("estimated_total_cost_usd") - F.col("cost_so_far_usd")
            ),
        }
    )


def with_progress(log: DataFrame, runs: DataFrame, order: Sequence[str], prices: DataFrame | None = None,
                  **kwargs) -> DataFrame:
    """The step log with every cost and progress figure."""
    return progress_columns(cumulative(log, with_rate(runs, prices), order, **kwargs))


def stats_record(df: DataFrame) -> DataFrame:
    """The statistics of each row as one struct, ``stats``."""
    return df.withColumn("stats", F.struct(*STATS))


def status_text() -> Column:
    """Multi-line status of a row of ``with_progress``."""
    c = F.col
    # The words of the lines.
    lines = [
        F.concat(F.lit("Progress: "), fixed(c("progress_percent"), 1), F.lit("%")),
        F.concat(F.lit("Tokens: "), grouped(c("tokens_processed")), F.lit(" / "), grouped(c("total_tokens"))),
        F.concat(F.lit("Speed: "), grouped(c("tokens_per_second")), F.lit(" tokens/sec")),
        F.concat(F.lit("Efficiency: "), grouped(c("tokens_per_dollar")), F.lit(" tokens/$")),
        F.concat(F.lit("Time: "), fixed(c("elapsed_hours"), 1), F.lit("h elapsed, "), fixed(c("eta_hours"), 1),
                 F.lit("h remaining")),
        F.concat(F.lit("Cost: $"), fixed(c("cost_so_far_usd"), 2), F.lit(" spent, $"),
                 fixed(c("estimated_remaining_cost_usd"), 2), F.lit(" remaining")),
        F.concat(F.lit("Total estimated: $"), fixed(c("estimated_total_cost_usd"), 2)),
    ]
    return F.concat_ws("\n", *lines)


def estimate(scenarios: DataFrame, prices: DataFrame | None = None) -> DataFrame:
    """Hours, days, cost and tokens per dollar of (total_tokens, tokens_per_second, gpu_type) rows."""
    given = scenarios if "hourly_rate" in scenarios.columns else scenarios.withColumn("hourly_rate", F.lit(None).cast("double"))
    priced = with_rate(given, prices)
    hours = F.col("total_tokens") / F.col("tokens_per_second") / 3600
    out = priced.withColumns({"total_hours": hours, "total_days": hours / 24, "total_cost_usd": hours * F.col("rate")})
    return out.withColumn(
        "tokens_per_dollar",
        F.when(F.col("total_cost_usd") > 0, F.col("total_tokens") / F.nullif(F.col("total_cost_usd"), F.lit(0.0)))
        .otherwise(F.lit(INF)),
    )


def interval_throughput(log: DataFrame, order: Sequence[str], every: int, mode: str = "literal",
                        parts: int | None = None) -> DataFrame:
    """Tokens per second between logged steps; every ``every``-th step is logged.

    ``literal`` divides the tokens of one step (tokens_per_step) by the whole interval; ``interval``
    divides the tokens of the interval. The first interval starts with the run.
    """
    if mode not in ("literal", "interval"):
        raise ValueError(f"unknown throughput mode: {mode}")
    chunked = range_chunks(log.withColumn("_us", micros()), ["run", *order], parts)
    placed = running(
        chunked, ["run"], order,
        {
            "_pos": row_count(), "_done": Running("sum", F.col("tokens")),
            "_start": Running("min", F.col("_us"), whole=True),
        },
        chunk=F.col(CHUNK), stage=False,
    ).drop(CHUNK)
    logged = placed.withColumn("step", F.col("_pos") - 1).where(F.col("step") % every == 0)
    numbered = logged.withColumn("_at", (F.col("step") / every).cast("bigint") + 1)
    before = trailing(
        numbered, ["run"], "_at", (-1, -1), {"_prev_us": F.max("_us"), "_prev_done": F.max("_done")}
    )
    seconds = F.greatest(
        (F.col("_us") - F.coalesce("_prev_us", "_start")) / 1e6, F.lit(0.001)
    )
    amount = F.col("tokens_per_step") if mode == "literal" else F.col("_done") - F.coalesce("_prev_done", F.lit(0))
    return before.withColumns({"interval_seconds": seconds, "tokens_per_sec": amount / seconds}).drop(
        "_us", "_pos", "_done", "_start", "_at", "_prev_us", "_prev_done"
    )
