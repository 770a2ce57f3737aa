"""Rewards of verifiable answers and their averages."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from corpusflow.operators.ordering import ordered_position, trailing

BASELINE = 0.5
WINDOW = 100


def prompt_rewards(df: DataFrame, prompt: str = "prompt_id") -> DataFrame:
    """Mean reward, number of correct responses and responses per prompt."""
    return df.groupBy(prompt).agg(
        F.avg("reward").alias("avg_reward"),
        F.sum((F.col("reward") > 0).cast("bigint")).alias("num_correct"),
        F.count(F.lit(1)).alias("responses"),
    )


def trailing_reward(prompts: DataFrame, n: int = WINDOW, order: str = "prompt_id", run: str | None = None) -> DataFrame:
    """Mean reward of the last n prompts up to each one, per run."""
    group = [run] if run else []
    placed = ordered_position(prompts, group, [order], "pos")
    return trailing(placed, group, "pos", (-(n - 1), 0), {"avg_reward_recent": F.avg("avg_reward")})


def positive_weights(df: DataFrame) -> DataFrame:
    """Correct responses only, weighted by reward minus baseline."""
    return df.where(F.col("reward") > 0).withColumn("weight", F.col("reward") - F.lit(BASELINE))


def overall_reward(prompts: DataFrame) -> DataFrame:
    """Mean over the prompts, 0 when there are none."""
    return prompts.agg(F.coalesce(F.avg("avg_reward"), F.lit(0.0)).alias("avg_reward"))
