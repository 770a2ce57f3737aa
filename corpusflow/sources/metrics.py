"""Metric logs as JSON lines, and their long form."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from corpusflow.operators.joins import spread_join
from corpusflow.operators.ordering import ordered_position

BUILT_IN = ("run", "step", "timestamp", "elapsed_seconds")
#: Folder of one micro-batch of a streaming append.
APPEND_BATCH = "append_batch"


#: What a log knows of its runs: the number of steps counted so far, and when the run began (microseconds).
LOG_STATE_SCHEMA = "run string, counted bigint, started bigint"


def log_entries(
    df: DataFrame, order: Sequence[str], ts: str = "ts", run: str = "run", known: DataFrame | None = None
) -> DataFrame:
    """Rows to log: step, timestamp, elapsed_seconds and the metrics.

    A missing step is counted up from 0 per run over the rows without one. Metric columns called like a
    built-in one win over it. ``known`` (``log_state`` of what was logged before) lets the steps
    count on and the clock run on; a run that it does not have starts afresh.
    """
    metrics = [c for c in df.columns if c not in (run, ts, "step")]
    micros = F.unix_micros(F.col(ts).cast("timestamp"))
    # Pre-aggregated per run, so that a long run costs no more than its partial minima.
    starts = df.groupBy(run).agg(F.min(micros).alias("_start"))
    first = F.lit(0).cast("bigint")
    if known is not None:
        before = known.select(F.col("run").alias(run), F.col("counted").alias("_counted"), F.col("started").alias("_started"))
        starts = starts.join(before, run, "left").select(
            run, F.coalesce("_started", "_start").alias("_start"), F.coalesce("_counted", first).alias("_first")
        )
    else:
        starts = starts.withColumn("_first", first)
    if "step" in df.columns:
        counted = ordered_position(df.withColumn("_auto", F.col("step").isNull()), [run, "_auto"], order, "_n")
        given = F.col("step").cast("bigint")
    else:
        counted = ordered_position(df, [run], order, "_n")
        given = F.lit(None).cast("bigint")
    joined = spread_join(counted, starts, run, [ts], weigh=df)
    stepped = joined.withColumn("step", F.coalesce(given, F.col("_first") + F.col("_n") - 1))
    built_in = {
        "timestamp": micros / 1e6,
        "elapsed_seconds": (micros - F.col("_start")) / 1e6,
    }
    return stepped.select(
        run, "step", *[v.alias(k) for k, v in built_in.items() if k not in metrics], *metrics
    )


def log_state(df: DataFrame, known: DataFrame, ts: str = "ts", run: str = "run") -> DataFrame:
    """(run, counted, started) after the rows of ``df`` were logged, too; runs without new rows stay as they were."""
    counts = F.col("step").isNull() if "step" in df.columns else F.lit(True)
    new = df.groupBy(F.col(run).alias("run")).agg(
        F.sum(counts.cast("bigint")).alias("_more"), F.min(F.unix_micros(F.col(ts).cast("timestamp"))).alias("_start")
    )
    return known.join(new, "run", "full").select(
        "run", (F.coalesce("counted", F.lit(0)) + F.coalesce("_more", F.lit(0))).cast("bigint").alias("counted"),
        F.coalesce("started", "_start").alias("started"),
    )


def write_metrics(entries: DataFrame, path: str) -> None:
    """Append log rows as JSON lines; rows lose their null metrics, as a log omits what it has not."""
    entries.write.mode("append").json(path)


def read_metrics(spark: SparkSession, path: str, metrics: Sequence[str]) -> DataFrame:
    """Read a log back. Bare NaN and Infinity are accepted as numbers."""
    schema = "run string, step bigint, timestamp double, elapsed_seconds double"
    wanted = "".join(f", `{m}` double" for m in metrics if m not in BUILT_IN)
    # Folders of a streaming append are no metric.
    return spark.read.schema(schema + wanted).option("allowNonNumericNumbers", True).json(path).drop(APPEND_BATCH)


def to_long(wide: DataFrame, metrics: Sequence[str], keep: Sequence[str] = ("run", "step")) -> DataFrame:
    """One row per (run, step, name) that has a value."""
    return wide.unpivot(list(keep), list(metrics), "name", "value").where(F.col("value").isNotNull())


def to_wide(long: DataFrame, metrics: Sequence[str], keep: Sequence[str] = ("run", "step")) -> DataFrame:
    return long.groupBy(*keep).pivot("name", list(metrics)).agg(F.first("value"))
