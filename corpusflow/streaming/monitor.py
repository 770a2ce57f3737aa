"""The stability checks on an arriving metric log.

Every micro-batch is a batch job over its rows and a few rows that stand for the past of each run: the
last ``window`` kept rows and the one with the lowest loss. It goes through the same chunked history
and the same rules as a whole log, so a run that holds most of a micro-batch is spread over all
tasks and none of them holds a run. Alerts and state are written per micro-batch and replaced if
it is run again, so each alert is there exactly once.

Within a micro-batch rows are ordered by step, then loss and gradient; across micro-batches by arrival.
Rows at or behind a step that was seen before are checked as they come, and counted in ``late_rows``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from corpusflow.operators.joins import spread_join
from corpusflow.operators.monitoring import (
    ALERT_SCHEMA, StabilityParams, chunked_history, is_finite, kept_rules, non_finite_rules, observed,
)
from corpusflow.operators.ordering import CHUNK, Running, present, range_chunks, running
from corpusflow.session import materialise
from corpusflow.streaming.state import Slots, batch_folder

LOG_SCHEMA = "run string, step bigint, loss double, grad_norm double"
#: A log whose rows may start their run's history afresh.
RESET_SCHEMA = LOG_SCHEMA + ", reset boolean"
LIVE_ALERT_SCHEMA = ALERT_SCHEMA + ", late_rows bigint"
RUNS_SCHEMA = "run string, seen bigint, last_step bigint, late_rows bigint"
PAST_SCHEMA = "run string, pos bigint, loss double, grad_norm double"
#: Files of a micro-batch, unless the caller says otherwise.
MAX_FILES = 100
ALERT_BATCH = "alert_batch"


def _late(rows: DataFrame, runs: DataFrame) -> DataFrame:
    """(run, last_step, late_rows) of the runs in a micro-batch, added to what was known of them."""
    steps = rows.groupBy("run", "step").agg(F.count(F.lit(1)).alias("n"))
    known = runs.select("run", F.col("last_step").alias("_last"), F.col("late_rows").alias("_late"))
    told = spread_join(steps, known, "run", ["step"], "left")
    late = F.when(F.col("step") <= F.col("_last"), F.col("n")).otherwise(F.col("n") - 1)
    return told.groupBy("run").agg(
        F.greatest(F.max("step"), F.max("_last")).alias("last_step"),
        (F.coalesce(F.max("_late"), F.lit(0)) + F.sum(late)).alias("late_rows"),
    )


def check_batch(
    rows: DataFrame, runs: DataFrame, past: DataFrame, params: StabilityParams = StabilityParams()
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Alerts of a micro-batch, and the runs and their past after it.

    ``rows`` has (run, step, loss, grad_norm) and may have ``reset``; ``runs`` and ``past`` are what the micro-batch before returned.
    """
    window = params.window
    log = rows if "reset" in rows.columns else rows.withColumn("reset", F.lit(False))
    log = materialise(log.withColumns(present(log, ["run"])).withColumn("reset", F.coalesce("reset", F.lit(False))), "arrived")
    seen_runs = log.select("run").distinct()
    late = materialise(_late(log, runs), "late")

    order = ["_new", "step", "loss", "grad_norm"]
    arrived = log.select("run", "step", "loss", F.coalesce("grad_norm", F.lit(0.0)).alias("grad_norm"), "reset").withColumns(
        {"_new": F.lit(1), "pos": F.lit(None).cast("bigint")}
    )
    # A run's past comes first, in its own order.
    carried = past.join(seen_runs, "run", "left_semi").select(
        "run", F.col("pos").alias("step"), "loss", "grad_norm", F.lit(False).alias("reset"), F.lit(0).alias("_new"), "pos"
    )
    chunked = range_chunks(arrived.unionByName(carried), ["run", *order])
    marks = Running("sum", F.col("reset").cast("bigint"))
    segmented = running(chunked, ["run"], order, {"segment": marks}, chunk=F.col(CHUNK), stage=False)
    # Only the first segment goes on with what was seen.
    known = runs.select("run", F.col("seen").alias("_seen"))
    joined = spread_join(segmented, known, "run", ["step"], "left", weigh=log).where(F.col("loss").isNotNull()).withColumn(
        "seen", F.when(F.col("segment") == 0, F.coalesce("_seen", F.lit(0))).otherwise(F.lit(0).cast("bigint"))
    ).drop("_seen", "reset")
    group = ["run", "segment"]
    kept = chunked_history(joined.where(is_finite(F.col("loss"))), params, group, order)
    followed = materialise(kept, "followed")

    def fired(df: DataFrame, rules: list) -> DataFrame:
        told = spread_join(df, late.select("run", "late_rows"), "run", ["step"], weigh=log)
        return told.select("run", "step", "late_rows", F.inline(F.filter(F.array(*rules), lambda a: a.isNotNull())))

    broken = observed(log).where(~is_finite(F.col("loss")))
    alerts = fired(followed.where("_new = 1"), kept_rules(params)).unionByName(fired(broken, non_finite_rules()))

    # The last segment of every run, also one that has no kept row yet.
    last = log.groupBy("run").agg(F.sum(F.col("reset").cast("bigint")).alias("_last"))
    ended = followed.groupBy(*group).agg(F.max("pos").alias("seen"), F.max(F.col("pos") - F.col("stalled")).alias("_best"))
    ended = last.join(ended.withColumnRenamed("segment", "_last"), ["run", "_last"], "left")
    after = late.join(ended, "run").select("run", F.coalesce("seen", F.lit(0)).alias("seen"), "last_step", "late_rows")
    idle = lambda df: df.join(seen_runs, "run", "left_anti")
    ends = ended.select("run", "_last", F.col("seen").alias("_seen"), "_best")
    rest = spread_join(followed.drop("seen"), ends, "run", ["pos"], weigh=log).where(
        (F.col("segment") == F.col("_last")) & ((F.col("pos") > F.col("_seen") - window) | (F.col("pos") == F.col("_best")))
    )
    names = lambda schema: [c.split(" ")[0] for c in schema.split(", ")]
    return (
        alerts.select(*names(LIVE_ALERT_SCHEMA)),
        after.select(*names(RUNS_SCHEMA)).unionByName(idle(runs)),
        rest.select(*names(PAST_SCHEMA)).unionByName(idle(past)),
    )


def monitor_log(
    log: DataFrame, path: str, checkpoint: str, params: StabilityParams = StabilityParams(), interval: str | None = None
) -> StreamingQuery:
    """Append the alerts of a streaming log of (run, step, loss, grad_norm) and, optionally, ``reset`` to ``path``.

    Everything there is now, then stop; with an ``interval`` ("10 seconds") the query stays live and
    looks for new rows that often. The state lies beside the checkpoint's files.
    """
    slots = Slots(f"{checkpoint.rstrip('/')}/monitor")

    def check(rows: DataFrame, batch_id: int) -> None:
        spark = rows.sparkSession
        past = slots.read(spark, batch_id, "past", PAST_SCHEMA)
        alerts, runs, past = check_batch(rows, slots.read(spark, batch_id, "runs", RUNS_SCHEMA), past, params)
        slots.write(batch_id, "runs", runs)
        slots.write(batch_id, "past", past)
        alerts.write.mode("overwrite").parquet(batch_folder(path, ALERT_BATCH, batch_id))

    return _started(log, check, checkpoint, interval)


def _started(log: DataFrame, each, checkpoint: str, interval: str | None) -> StreamingQuery:
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    return log.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(**trigger).start()


def read_alerts(spark: SparkSession, path: str) -> DataFrame:
    """The alerts that ``monitor_log`` has written so far."""
    return spark.read.schema(LIVE_ALERT_SCHEMA).parquet(path).drop(ALERT_BATCH)


def read_log_stream(spark: SparkSession, path: str, max_files: int = MAX_FILES, schema: str = LOG_SCHEMA) -> DataFrame:
    """A growing folder of JSON lines. ``max_files`` bounds a micro-batch; further files wait for the next one."""
    reader = spark.readStream.schema(schema).option("allowNonNumericNumbers", True)
    return reader.option("maxFilesPerTrigger", max_files).json(path)


def write_stream(
    df: DataFrame, path: str, checkpoint: str, format: str = "parquet", interval: str | None = None
) -> StreamingQuery:
    """Append a stream (log rows as ``json``, say) to a folder.

    Everything there is now, then stop; with an ``interval`` ("10 seconds") the query stays live and
    looks for new rows that often.
    """
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    return (
        df.writeStream.format(format).outputMode("append").option("path", path)
        .option("checkpointLocation", checkpoint).trigger(**trigger).start()
    )


def late_rows(alerts: DataFrame) -> DataFrame:
    """Rows seen out of order so far, per run, as of the micro-batch of the last alert."""
    return alerts.groupBy("run").agg(F.max("late_rows").alias("late_rows"))
