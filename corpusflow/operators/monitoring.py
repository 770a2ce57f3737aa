"""Rolling statistics and stability alerts over metric logs.

Wide logs have one row per (run, step) with loss and grad_norm; long logs have (run, name, step, value).
Runs may be of any length and one run may hold most of the rows: positions, running minima and trailing
frames all come from chunked order operators.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from corpusflow.functions.format import INF, fixed
from corpusflow.operators.ordering import CHUNK, Running, ordered_position, range_chunks, row_count, running, trailing
from corpusflow.session import scratch_path

WINDOW = 100


@dataclass(frozen=True)
class StabilityParams:
    """Thresholds of the stability checks."""

    loss_spike: float = 2.0
    grad_high: float = 100.0
    grad_spike: float = 5.0
    window: int = 100
    patience: int = 50
    min_history: int = 10


# The rules, severities and categories of alerts below, and the words of their messages.
ALERT_SCHEMA = (
    "run string, step bigint, rule string, severity string, category string, message string, "
    "value double, threshold double"
)


# ------------------------------------------------------------------ tracked metrics

def rolling(long: DataFrame, n: int = WINDOW, group: Sequence[str] = ("run", "name"), order: str = "step",
            parts: int | None = None) -> DataFrame:
    """Mean of the last n values of each metric, at every step."""
    placed = ordered_position(long, group, [order], "pos", parts=parts)
    return trailing(placed, group, "pos", (-(n - 1), 0), {"rolling_mean": F.avg("value")}).drop("pos")


def latest(long: DataFrame) -> DataFrame:
    """The last value of each metric."""
    return long.groupBy("run", "name").agg(
        F.max_by("value", "step").alias("value"), F.max("step").alias("step")
    )


def current_means(long: DataFrame, n: int = WINDOW) -> DataFrame:
    """Mean of the last n values of each metric, now. Every task keeps only n rows per metric."""
    rank = F.row_number().over(Window.partitionBy("run", "name").orderBy(F.desc("step")))
    recent = long.withColumn("_rank", rank).where(F.col("_rank") <= n)
    return recent.groupBy("run", "name").agg(F.avg("value").alias("mean"))


def segments(long: DataFrame, reset: str = "reset", group: Sequence[str] = ("run", "name"), order: str = "step",
             parts: int | None = None) -> DataFrame:
    """Number the stretches between resets: rows marked ``reset`` start a new segment.

    Add ``segment`` to the group of any other operator to make it start afresh. To reset one metric
    mark its rows only, to reset all of them mark the rows of every name.
    """
    marks = F.coalesce(F.col(reset).cast("int"), F.lit(0)).cast("bigint")
    return running(long, group, [order], {"segment": Running("sum", marks)}, parts=parts)


# ------------------------------------------------------------------ stability

def is_finite(x: Column) -> Column:
    return ~(F.isnan(x) | (F.abs(x) == F.lit(INF)))


def observed(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """(run, step, loss, grad_norm) of the rows that have a loss; a missing gradient norm counts as 0."""
    return df.where(F.col("loss").isNotNull()).select(
        "run", "step", "loss", F.coalesce("grad_norm", F.lit(0.0)).alias("grad_norm"), *keep
    )


def reset_log(df: DataFrame, reset: str | None, parts: int | None = None) -> tuple[DataFrame, list[str]]:
    """The observed rows and the columns that tell the histories apart: the run, and the segment between resets.

    A row marked ``reset`` is the first of a new history. A marked row without a loss resets as well.
    """
    if reset is None:
        return observed(df), ["run"]
    return observed(segments(df, reset, ["run"], parts=parts), ["segment"]), ["run", "segment"]


def _number(x: Column) -> Column:
    return F.when(F.isnan(x), F.lit("nan")).when(x > 0, F.lit("inf")).otherwise(F.lit("-inf"))


def _exceeds(value: Column, threshold: Column) -> Column:
    """value > threshold where a comparison with NaN is false."""
    return ~F.isnan(value) & ~F.isnan(threshold) & (value > threshold)


def _alert(rule: str, severity: str, category: str, message: Column, value: Column, threshold: Column) -> Column:
    return F.struct(
        F.lit(rule).alias("rule"), F.lit(severity).alias("severity"), F.lit(category).alias("category"),
        message.alias("message"), value.alias("value"), threshold.cast("double").alias("threshold"),
    )


def _diverging(rule: str, what: str, value: Column) -> Column:
    text = F.concat(F.lit(f"{what} is "), _number(value), F.lit("! Training is diverging."))
    return F.when(~is_finite(value), _alert(rule, "critical", "nan", text, value, F.lit(None)))


def non_finite_rules() -> list[Column]:
    """Rules that need no history."""
    return [
        _diverging("loss_nan", "Loss", F.col("loss")),
        _diverging("grad_nan", "Gradient norm", F.col("grad_norm")),
    ]


def high_gradient_rule(params: StabilityParams) -> Column:
    limit = F.lit(params.grad_high)
    text = F.concat(F.lit("High gradient norm: "), fixed(F.col("grad_norm"), 2), F.lit(f" > {params.grad_high}"))
    return F.when(
        _exceeds(F.col("grad_norm"), limit),
        _alert("grad_high", "warning", "gradient", text, F.col("grad_norm"), limit),
    )


def history(kept: DataFrame, params: StabilityParams = StabilityParams(), parts: int | None = None,
            block_rows: int | None = None, group: Sequence[str] = ("run",)) -> DataFrame:
    """Rows of finite loss with what the checks need to know about the rows before them.

    pos, prev_min (lowest earlier loss), stalled (rows since the last new minimum), n_prior, loss_avg and
    grad_avg over the previous ``window`` rows. ``group`` tells the histories apart.
    """
    chunked = range_chunks(kept, [*group, "step"], parts)
    return chunked_history(chunked, params, group, ["step"], block_rows)


def chunked_history(chunked: DataFrame, params: StabilityParams, group: Sequence[str], order: Sequence[str],
                    block_rows: int | None = None) -> DataFrame:
    """``history`` of rows cut into chunks along (group, order).

    Rows that stand for an earlier part of their history have a ``pos``, and the new rows that go on with it
    the number of rows ``seen`` before. Beside the last ``window`` rows the row of the lowest loss is enough.
    """
    along = lambda df, outs: running(df, group, order, outs, chunk=F.col(CHUNK), stage=False)
    lowest = Running("min", F.col("loss"), exclusive=True)
    if "seen" in chunked.columns:
        new = Running("sum", F.col("pos").isNull().cast("bigint"))
        placed = along(chunked, {"_counted": new, "prev_min": lowest})
        placed = placed.withColumn("pos", F.coalesce("pos", F.col("seen") + F.col("_counted"))).drop("_counted")
    else:
        placed = along(chunked, {"pos": row_count(), "prev_min": lowest})
    improves = F.col("prev_min").isNull() | (F.col("loss") < F.col("prev_min"))
    stalled = along(placed, {"_best_at": Running("max", F.when(improves, F.col("pos")))})
    counted = stalled.withColumn("stalled", F.col("pos") - F.col("_best_at")).drop("_best_at", CHUNK)
    return trailing(
        counted, group, "pos", (-params.window, -1),
        {"n_prior": F.count(F.lit(1)), "loss_avg": F.avg("loss"), "grad_avg": F.avg("grad_norm")},
        block_rows,
    )


def history_rules(params: StabilityParams) -> list[Column]:
    """Loss spike, gradient spike and missing improvement, on the columns of ``history``."""
    loss, grad = F.col("loss"), F.col("grad_norm")
    enough = F.col("n_prior") >= params.min_history
    loss_limit = F.col("loss_avg") * params.loss_spike
    grad_limit = F.col("grad_avg") * params.grad_spike
    lowest = F.least(F.col("prev_min"), loss)
    return [
        F.when(
            enough & _exceeds(loss, loss_limit),
            _alert(
                "loss_spike", "warning", "loss_spike",
                F.concat(F.lit("Loss spike detected: "), fixed(loss, 4), F.lit(" vs rolling avg "),
                         fixed(F.col("loss_avg"), 4)),
                loss, loss_limit,
            ),
        ),
        F.when(
            enough & _exceeds(grad, grad_limit),
            _alert(
                "grad_spike", "warning", "gradient",
                F.concat(F.lit("Gradient spike: "), fixed(grad, 2), F.lit(" vs rolling avg "),
                         fixed(F.col("grad_avg"), 2)),
                grad, grad_limit,
            ),
        ),
        # The count restarts when it fires, so it fires at every multiple of the patience.
        F.when(
            (F.col("stalled") > 0) & (F.col("stalled") % params.patience == 0),
            _alert(
                "no_improvement", "warning", "loss_spike",
                F.concat(F.lit(f"Loss not improving for {params.patience} steps. Min seen: "), fixed(lowest, 4),
                         F.lit(", current: "), fixed(loss, 4)),
                loss, F.lit(None),
            ),
        ),
    ]


def _fired(df: DataFrame, rules: list[Column]) -> DataFrame:
    fired = F.filter(F.array(*rules), lambda a: a.isNotNull())
    return df.select("run", "step", F.inline(fired))


def non_finite_alerts(df: DataFrame) -> DataFrame:
    """Critical alerts for NaN or infinite loss and gradient norm."""
    return _fired(observed(df), non_finite_rules())


def high_gradient_alerts(df: DataFrame, params: StabilityParams = StabilityParams()) -> DataFrame:
    """Gradient norm above the absolute limit, on rows of finite loss."""
    return _fired(observed(df).where(is_finite(F.col("loss"))), [high_gradient_rule(params)])


def history_alerts(df: DataFrame, params: StabilityParams = StabilityParams(), reset: str | None = None, **kwargs) -> DataFrame:
    """Spikes and missing improvement."""
    log, group = reset_log(df, reset, kwargs.get("parts"))
    return _fired(history(log.where(is_finite(F.col("loss"))), params, group=group, **kwargs), history_rules(params))


def kept_rules(params: StabilityParams) -> list[Column]:
    """All rules of a row of finite loss, in the order in which they are checked."""
    loss_spike, grad_spike, no_improvement = history_rules(params)
    return [non_finite_rules()[1], loss_spike, high_gradient_rule(params), grad_spike, no_improvement]


def stability_alerts(df: DataFrame, params: StabilityParams = StabilityParams(), reset: str | None = None, **kwargs) -> DataFrame:
    """Every alert of every run, from (run, step, loss, grad_norm).

    A row with a non-finite loss raises its critical alerts and does not enter the history; a row
    whose gradient alone is not finite does. Rows marked by the column ``reset`` start their run's history
    afresh.
    """
    finite = is_finite(F.col("loss"))
    log, group = reset_log(df, reset, kwargs.get("parts"))
    kept = history(log.where(finite), params, group=group, **kwargs)
    return _fired(kept, kept_rules(params)).unionByName(_fired(log.where(~finite), non_finite_rules()))


def rolling_stats(df: DataFrame, n: int = WINDOW, parts: int | None = None, reset: str | None = None) -> DataFrame:
    """Average, minimum and maximum of the last n losses and gradient norms of each run, since its last ``reset``."""
    log, group = reset_log(df, reset, parts)
    placed = ordered_position(log.where(is_finite(F.col("loss"))), group, ["step"], "pos", parts=parts)
    return trailing(
        placed, group, "pos", (-(n - 1), 0),
        {
            "loss_rolling_avg": F.avg("loss"), "loss_rolling_min": F.min("loss"), "loss_rolling_max": F.max("loss"),
            "grad_norm_rolling_avg": F.avg("grad_norm"), "grad_norm_rolling_max": F.max("grad_norm"),
        },
    ).drop("pos", "segment")


def lifetime_stats(df: DataFrame, params: StabilityParams = StabilityParams(), reset: str | None = None, **kwargs) -> DataFrame:
    """Lowest loss so far, steps since it improved and alerts stored so far, at every kept row; all since the last ``reset``."""
    log, group = reset_log(df, reset, kwargs.get("parts"))
    kept = history(log.where(is_finite(F.col("loss"))), params, group=group, **kwargs)
    fired = F.size(F.filter(F.array(*kept_rules(params)), lambda a: a.isNotNull()))
    counted = kept.select(
        *group, "step", "pos", F.least("prev_min", "loss").alias("min_loss_seen"),
        (F.col("stalled") % params.patience).alias("steps_since_improvement"), fired.cast("bigint").alias("_fired"),
    )
    # The counts are small rows; writing them down keeps the history from being computed twice.
    return running(
        counted, group, ["pos"], {"total_alerts": Running("sum", F.col("_fired"))},
    ).select("run", "step", "min_loss_seen", "steps_since_improvement", "total_alerts")


def append_alerts(alerts: DataFrame, path: str) -> None:
    """Append alerts to an alert table."""
    alerts.write.mode("append").parquet(path)


def alert_table(alerts: DataFrame) -> DataFrame:
    """Write alerts to a table of their own in the shared folder and read it."""
    spark = alerts.sparkSession
    path = scratch_path(spark, "alerts")
    append_alerts(alerts, path)
    return spark.read.schema(ALERT_SCHEMA).parquet(path)
