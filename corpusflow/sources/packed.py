"""Packed sequences on disk, pruned by step."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from corpusflow.functions.hashing import int_div

STEPS_PER_BUCKET = 1000
STEPS_PER_SLICE = 20


def step_slice(batch_id: Column, accum: int, steps: int = STEPS_PER_SLICE) -> Column:
    """The slice of steps a batch belongs to: pack with this column ``together`` before writing."""
    return int_div(batch_id, accum * steps)


def write_packed(packed: DataFrame, path: str, steps_per_bucket: int = STEPS_PER_BUCKET) -> None:
    """Write packed sequences, which carry ``step``, in folders of consecutive steps.

    Sequences are wide, so they are not shuffled again: packed ``together`` by a slice of steps, every
    task holds whole slices and writes them in order.
    """
    bucketed = packed.withColumn("step_bucket", int_div(F.col("step"), steps_per_bucket))
    ordered = bucketed.sortWithinPartitions("step_bucket", "step", "batch_id", "seq_idx")
    ordered.write.partitionBy("step_bucket").parquet(path)


def read_packed(
    spark: SparkSession, path: str, first_step: int | None = None, last_step: int | None = None,
    steps_per_bucket: int = STEPS_PER_BUCKET,
) -> DataFrame:
    """Packed sequences of the steps first..last; other folders are not read."""
    df = spark.read.parquet(path)
    if first_step is not None:
        df = df.where((F.col("step_bucket") >= first_step // steps_per_bucket) & (F.col("step") >= first_step))
    if last_step is not None:
        df = df.where((F.col("step_bucket") <= last_step // steps_per_bucket) & (F.col("step") <= last_step))
    return df
