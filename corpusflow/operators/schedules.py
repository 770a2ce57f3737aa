"""Learning-rate plans as columns of a metric log joined to a run dimension.

A run dimension has run, base_lr, warmup_steps, total_steps, decay_ratio and min_lr_ratio.
"""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from corpusflow.operators.joins import spread_join

PLAN = ("base_lr", "warmup_steps", "total_steps", "decay_ratio", "min_lr_ratio")


def checked(column: Column) -> Column:
    """``column`` where the plan of the run is possible, an error elsewhere."""
    warmup, total = F.col("warmup_steps"), F.col("total_steps")
    problem = (
        F.when(warmup < 0, F.lit("warmup_steps must not be negative"))
        .when(total <= warmup, F.lit("total_steps must exceed warmup_steps"))
        .when(stable_steps() < 0, F.lit("not enough steps for warm-up and decay"))
    )
    return F.when(problem.isNull(), column).otherwise(F.raise_error(problem).cast("double"))


def decay_steps() -> Column:
    return F.floor(F.col("total_steps") * F.col("decay_ratio")).cast("bigint")


def stable_steps() -> Column:
    return F.col("total_steps") - F.col("warmup_steps") - decay_steps()


def wsd_factor(step: Column) -> Column:
    """Warm-up, stable, cosine decay: the share of the base rate at ``step``."""
    warmup, floor = F.col("warmup_steps"), F.col("min_lr_ratio")
    done = (step - warmup - stable_steps()) / F.greatest(F.lit(1), decay_steps())
    decayed = floor + (1 - floor) * (F.lit(0.5) * (1 + F.cos(F.lit(math.pi) * done)))
    return (
        F.when(step < warmup, step / F.greatest(F.lit(1), warmup))
        .when(step < warmup + stable_steps(), F.lit(1.0))
        .otherwise(decayed)
    )


def wsd_phase(step: Column) -> Column:
    return (
        F.when(step < F.col("warmup_steps"), "warmup")
        .when(step < F.col("warmup_steps") + stable_steps(), "stable")
        .otherwise("decay")
    )


def cosine_factor(step: Column) -> Column:
    """Linear warm-up, then cosine down to the floor."""
    warmup, total, floor = F.col("warmup_steps"), F.col("total_steps"), F.col("min_lr_ratio")
    progress = (step - warmup) / F.greatest(F.lit(1), total - warmup)
    return F.when(step < warmup, step / F.greatest(F.lit(1), warmup)).otherwise(
        floor + (1 - floor) * (1 + F.cos(F.lit(math.pi) * progress)) / 2
    )


def _planned(log: DataFrame, runs: DataFrame) -> DataFrame:
    return spread_join(log, runs.select("run", *PLAN), "run", ["step"])


def with_wsd(log: DataFrame, runs: DataFrame) -> DataFrame:
    """Adds expected_lr, phase, warmup_progress and overall_progress to every step."""
    step = F.col("step")
    return _planned(log, runs).withColumns(
        {
            "expected_lr": checked(F.col("base_lr") * wsd_factor(step)),
            "phase": wsd_phase(step),
            "warmup_progress": F.least(F.lit(1.0), step / F.greatest(F.lit(1), F.col("warmup_steps"))),
            "overall_progress": step / F.col("total_steps"),
        }
    )


def phase_summary(log: DataFrame, runs: DataFrame) -> DataFrame:
    """Steps, mean loss and rate span of each phase of each run."""
    return with_wsd(log, runs).groupBy("run", "phase").agg(
        F.count(F.lit(1)).alias("steps"), F.avg("loss").alias("avg_loss"),
        F.min("expected_lr").alias("min_lr"), F.max("expected_lr").alias("max_lr"),
        F.max("warmup_progress").alias("warmup_progress"), F.max("overall_progress").alias("overall_progress"),
    )


def with_cosine(log: DataFrame, runs: DataFrame) -> DataFrame:
    """Adds expected_lr of linear warm-up and cosine decay."""
    return _planned(log, runs).withColumn("expected_lr", F.col("base_lr") * cosine_factor(F.col("step")))


def total_steps(runs: DataFrame) -> DataFrame:
    """Steps that a token budget pays for, from micro_batch, seq_len, accum and total_tokens."""
    per_step = F.col("micro_batch") * F.col("seq_len") * F.col("accum")
    return runs.withColumns(
        {
            "tokens_per_step": per_step,
            "total_steps": F.floor((F.col("total_tokens") - F.col("total_tokens") % per_step) / per_step).cast("bigint"),
        }
    )


def with_base_rates(log: DataFrame, runs: DataFrame, rates: Mapping[str, float]) -> DataFrame:
    """One schedule, several parameter groups with a base rate each: a row per step and group."""
    groups = F.array(*[F.struct(F.lit(g).alias("g"), F.lit(float(r)).alias("r")) for g, r in rates.items()])
    planned = with_wsd(log, runs.withColumn("base_lr", F.lit(1.0)))
    return planned.withColumn("_group", F.explode(groups)).withColumns(
        {"param_group": F.col("_group")["g"], "expected_lr": F.col("expected_lr") * F.col("_group")["r"]}
    ).drop("_group")
