"""Queries over metric and step logs: monitoring, schedules, cost, user functions, streams."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from corpusflow.functions import format as fm
from corpusflow.functions import text as tx
from corpusflow.operators import cost, monitoring, schedules, selection, udfs
from corpusflow.operators.ordering import ordered_position
from corpusflow.plans import bindings as b
from corpusflow.plans.registry import query
from corpusflow.plans.sequences import SQL_BATCHED, batched
from corpusflow.session import materialise, scratch_path
from corpusflow.sources import metrics
from corpusflow.streaming import monitor
from corpusflow.streaming.append import append_log

# ------------------------------------------------------------------ bindings of events

METRICS = ("loss", "grad_norm")


def events(spark, sf):
    """events as a metric log without steps; some losses and gradients are not finite."""
    e = b.table(spark, sf, "events")
    inf, nan = F.lit(float("inf")), F.lit(float("nan"))
    # The values have two decimals, so that one may be exactly twice the mean of others; a little of the
    # key keeps such ties, which depend on the order of summation, out of the comparison.
    value = F.col("value") + (F.col("event_id") % 1009) * 1e-7
    loss = F.when(F.col("event_id") % 997 == 5, nan).when(F.col("event_id") % 1499 == 7, inf).otherwise(value)
    grad = F.when(F.col("event_id") % 1201 == 3, nan).otherwise(value * 2)
    return e.select(
        F.col("event_type").alias("run"), F.col("ts").cast("timestamp").alias("ts"), "event_id",
        loss.alias("loss"), grad.alias("grad_norm"),
    )


def metric_log(spark, sf):
    """(run, step, loss, grad_norm), steps from 0 per run."""
    placed = ordered_position(events(spark, sf), ["run"], ["ts", "event_id"], "pos")
    return placed.select("run", (F.col("pos") - 1).alias("step"), "ts", *METRICS)


def long_log(spark, sf):
    return metrics.to_long(metric_log(spark, sf), METRICS)


SQL_LOG = """
log AS (
  SELECT event_type AS run, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) - 1 AS step, ts,
         CASE WHEN event_id % 997 = 5 THEN 'nan'::DOUBLE WHEN event_id % 1499 = 7 THEN 'inf'::DOUBLE
              ELSE value + (event_id % 1009) * 1e-7::DOUBLE END AS loss,
         CASE WHEN event_id % 1201 = 3 THEN 'nan'::DOUBLE ELSE (value + (event_id % 1009) * 1e-7::DOUBLE) * 2 END AS grad_norm
  FROM events),
long AS (
  SELECT run, step, 'loss' AS name, loss AS value FROM log UNION ALL SELECT run, step, 'grad_norm', grad_norm FROM log)"""


def number_sql(expression: str, name: str | None = None, digits: int = 6) -> str:
    """SQL of _with_kinds."""
    name = name or expression
    return (
        f"CASE WHEN isfinite({expression}) THEN round({expression} + 3.14159e-{digits + 2}, {digits}) END AS {name}, "
        f"CASE WHEN isnan({expression}) THEN 'nan' WHEN isinf({expression}) THEN CASE WHEN {expression} > 0 THEN 'inf' ELSE '-inf' END "
        f"WHEN {expression} IS NOT NULL THEN 'number' END AS {name}_kind"
    )


def _with_kinds(df, *columns, digits=6):
    """Rounded numbers, and beside each what it is: engines compare values that are not finite differently."""
    out = df
    for c in columns:
        value = F.col(c)
        kind = F.when(F.isnan(value), "nan").when(value == float("inf"), "inf").when(value == float("-inf"), "-inf")
        out = out.withColumn(f"{c}_kind", kind.when(value.isNotNull(), "number"))
        out = out.withColumn(c, F.when(monitoring.is_finite(value), b.near(value, digits)))
    return out


def _rounded(df, *columns, digits=6):
    return df.withColumns({c: b.near(c, digits) for c in columns})


# ------------------------------------------------------------------ logs

@query(
    "s5_append_metrics",
    f"""WITH {SQL_LOG}
SELECT run, step, round(epoch_us(ts) / 1e6 + 3.14159e-8, 6) AS timestamp,
       round((epoch_us(ts) - min(epoch_us(ts)) OVER (PARTITION BY run)) / 1e6 + 3.14159e-8, 6) AS elapsed_seconds,
       {number_sql('loss')}, {number_sql('grad_norm')}
FROM log""",
)
def append_metrics(spark, sf):
    rows = events(spark, sf).select("run", "ts", "event_id", *METRICS)
    entries = metrics.log_entries(rows, ["ts", "event_id"]).drop("event_id")
    path = scratch_path(spark, "log")
    metrics.write_metrics(entries, path)
    back = metrics.read_metrics(spark, path, METRICS)
    return _with_kinds(_rounded(back, "timestamp", "elapsed_seconds"), *METRICS)


@query(
    "s5_append_stream",
    f"""WITH {SQL_LOG}
SELECT run, step, round(epoch_us(ts) / 1e6 + 3.14159e-8, 6) AS timestamp,
       round((epoch_us(ts) - min(epoch_us(ts)) OVER (PARTITION BY run)) / 1e6 + 3.14159e-8, 6) AS elapsed_seconds,
       {number_sql('loss')}, {number_sql('grad_norm')}
FROM log""",
)
def append_stream(spark, sf):
    # Folders of consecutive times, each a micro-batch of the stream.
    source, path = scratch_path(spark, "arriving"), scratch_path(spark, "log")
    rows = events(spark, sf).select("run", "ts", "event_id", *METRICS)
    first, last = rows.agg(F.min(F.unix_micros("ts")), F.max(F.unix_micros("ts"))).first()
    part = F.least(F.floor((F.unix_micros("ts") - F.lit(first)) * 2 / F.lit(max(last - first, 1))), F.lit(1))
    for k in (0, 1):
        rows.where(part == k).coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(source)
    append_log(stream, path, scratch_path(spark, "append"), ["ts", "event_id"], drop=["event_id"]).awaitTermination()
    back = metrics.read_metrics(spark, path, METRICS)
    return _with_kinds(_rounded(back, "timestamp", "elapsed_seconds"), *METRICS)


@query(
    "s6_read_metrics",
    f"""WITH {SQL_LOG}
SELECT run, step, name, CASE WHEN isfinite(value) THEN round(value + 3.14159e-8, 6) END AS value,
       CASE WHEN isnan(value) THEN 'nan' WHEN isinf(value) THEN 'inf' ELSE 'number' END AS kind
FROM long""",
)
def read_metrics(spark, sf):
    path = scratch_path(spark, "log")
    metrics.write_metrics(metric_log(spark, sf).select("run", "step", *METRICS), path)
    back = metrics.to_long(metrics.read_metrics(spark, path, METRICS), METRICS)
    value = F.col("value")
    return back.select(
        "run", "step", "name", F.when(monitoring.is_finite(value), b.near(value)).alias("value"),
        F.when(F.isnan(value), "nan").when(monitoring.is_finite(value), "number").otherwise("inf").alias("kind"),
    )


@query("p4_cadence", f"WITH {SQL_LOG} SELECT run, step FROM log WHERE step % 50 = 0 AND step > 0")
def cadence(spark, sf):
    return selection.cadence(metric_log(spark, sf), 50, skip_zero=True).select("run", "step")


@query(
    "w1_rolling_mean",
    f"""WITH {SQL_LOG},
means AS (SELECT run, name, step, avg(value) OVER (PARTITION BY run, name ORDER BY step ROWS 99 PRECEDING) AS rolling_mean FROM long)
SELECT run, name, step, {number_sql('rolling_mean')} FROM means""",
)
def rolling_mean(spark, sf):
    means = monitoring.rolling(long_log(spark, sf))
    return _with_kinds(means.select("run", "name", "step", "rolling_mean"), "rolling_mean")


@query(
    "w2_latest",
    f"""WITH {SQL_LOG},
last AS (SELECT run, name, arg_max(value, step) AS value, max(step) AS step FROM long GROUP BY run, name)
SELECT run, name, step, {number_sql('value')} FROM last""",
)
def latest(spark, sf):
    return _with_kinds(monitoring.latest(long_log(spark, sf)), "value")


@query(
    "w3_current_means",
    f"""WITH {SQL_LOG},
now AS (
  SELECT run, avg(value) FILTER (name = 'loss') AS loss, avg(value) FILTER (name = 'grad_norm') AS grad_norm
  FROM (SELECT *, row_number() OVER (PARTITION BY run, name ORDER BY step DESC) AS r FROM long)
  WHERE r <= 100 GROUP BY run)
SELECT run, {number_sql('loss')}, {number_sql('grad_norm')} FROM now""",
)
def current_means(spark, sf):
    means = monitoring.current_means(long_log(spark, sf)).withColumnRenamed("mean", "value")
    return _with_kinds(metrics.to_wide(means, METRICS, keep=("run",)), *METRICS)


@query(
    "w4_reset",
    f"""WITH {SQL_LOG},
seg AS (
  SELECT *, sum(CASE WHEN step % 300 = 299 AND name = 'loss' THEN 1 ELSE 0 END)
            OVER (PARTITION BY run, name ORDER BY step ROWS UNBOUNDED PRECEDING) AS segment
  FROM long),
means AS (
  SELECT run, name, step, CAST(segment AS BIGINT) AS segment,
         avg(value) OVER (PARTITION BY run, name, segment ORDER BY step ROWS 99 PRECEDING) AS rolling_mean
  FROM seg)
SELECT run, name, step, segment, {number_sql('rolling_mean')} FROM means""",
)
def reset(spark, sf):
    marked = long_log(spark, sf).withColumn("reset", (F.col("step") % 300 == 299) & (F.col("name") == "loss"))
    segmented = monitoring.segments(marked)
    means = monitoring.rolling(segmented, group=("run", "name", "segment"))
    return _with_kinds(means.select("run", "name", "step", "segment", "rolling_mean"), "rolling_mean")


# ------------------------------------------------------------------ stability

def value_sql(expression: str) -> str:
    return f"CASE WHEN isfinite({expression}) THEN round({expression} + 3.14159e-8, 6) END AS value"


def kept_sql(group: str = "run") -> str:
    """kept: rows of finite loss with their past; alerts of every rule. ``group`` tells the histories apart."""
    return f"""WITH {SQL_LOG},
marked AS (
  SELECT *, sum(CASE WHEN step % 400 = 399 THEN 1 ELSE 0 END) OVER (PARTITION BY run ORDER BY step ROWS UNBOUNDED PRECEDING) AS segment
  FROM log),
prior AS (
  SELECT *, row_number() OVER w AS pos, min(loss) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev_min,
         count(*) OVER (w ROWS BETWEEN 100 PRECEDING AND 1 PRECEDING) AS n_prior,
         avg(loss) OVER (w ROWS BETWEEN 100 PRECEDING AND 1 PRECEDING) AS loss_avg,
         avg(grad_norm) OVER (w ROWS BETWEEN 100 PRECEDING AND 1 PRECEDING) AS grad_avg
  FROM marked WHERE isfinite(loss) WINDOW w AS (PARTITION BY {group} ORDER BY step)),
kept AS (
  SELECT *, pos - max(CASE WHEN prev_min IS NULL OR loss < prev_min THEN pos END)
                  OVER (PARTITION BY {group} ORDER BY pos ROWS UNBOUNDED PRECEDING) AS stalled,
         least(prev_min, loss) AS lowest
  FROM prior),
nonfinite AS (
  SELECT run, step, 'loss_nan' AS rule, 'critical' AS severity, 'nan' AS category,
         'Loss is ' || CASE WHEN isnan(loss) THEN 'nan' WHEN loss > 0 THEN 'inf' ELSE '-inf' END
           || '! Training is diverging.' AS message, NULL::DOUBLE AS value, NULL::DOUBLE AS threshold
  FROM log WHERE NOT isfinite(loss)
  UNION ALL
  SELECT run, step, 'grad_nan', 'critical', 'nan',
         'Gradient norm is ' || CASE WHEN isnan(grad_norm) THEN 'nan' WHEN grad_norm > 0 THEN 'inf' ELSE '-inf' END
           || '! Training is diverging.', NULL, NULL
  FROM log WHERE NOT isfinite(grad_norm)),
loss_spike AS (
  SELECT run, step, 'loss_spike' AS rule, 'warning' AS severity, 'loss_spike' AS category,
         'Loss spike detected: ' || format('{{:.4f}}', loss) || ' vs rolling avg ' || format('{{:.4f}}', loss_avg) AS message, {value_sql('loss')},
         round(loss_avg * 2 + 3.14159e-8, 6) AS threshold
  FROM kept WHERE n_prior >= 10 AND loss > loss_avg * 2),
grad_high AS (
  SELECT run, step, 'grad_high' AS rule, 'warning' AS severity, 'gradient' AS category,
         'High gradient norm: ' || format('{{:.2f}}', grad_norm) || ' > 100.0' AS message, {value_sql('grad_norm')}, 100.0::DOUBLE AS threshold
  FROM kept WHERE NOT isnan(grad_norm) AND grad_norm > 100),
grad_spike AS (
  SELECT run, step, 'grad_spike' AS rule, 'warning' AS severity, 'gradient' AS category,
         'Gradient spike: ' || format('{{:.2f}}', grad_norm) || ' vs rolling avg ' || format('{{:.2f}}', grad_avg) AS message, {value_sql('grad_norm')},
         round(grad_avg * 5 + 3.14159e-8, 6) AS threshold
  FROM kept WHERE n_prior >= 10 AND NOT isnan(grad_norm) AND NOT isnan(grad_avg) AND grad_norm > grad_avg * 5),
no_improvement AS (
  SELECT run, step, 'no_improvement' AS rule, 'warning' AS severity, 'loss_spike' AS category,
         'Loss not improving for 50 steps. Min seen: ' || format('{{:.4f}}', lowest) || ', current: ' || format('{{:.4f}}', loss)
           AS message, {value_sql('loss')}, NULL::DOUBLE AS threshold
  FROM kept WHERE stalled > 0 AND stalled % 50 = 0),
alerts AS (
  SELECT * FROM nonfinite UNION ALL SELECT * FROM loss_spike UNION ALL SELECT * FROM grad_high
  UNION ALL SELECT * FROM grad_spike UNION ALL SELECT * FROM no_improvement)"""

_KEPT = kept_sql()
_ALERT = ("run", "step", "rule", "severity", "category", "message", "value", "threshold")


def _alerts(df, *more):
    # A value that is not finite is named by its message.
    shown = df.select(*_ALERT, *more).withColumn("value", F.when(monitoring.is_finite(F.col("value")), b.near("value")))
    return _rounded(shown, "threshold")


@query("w5_non_finite", f"{_KEPT} SELECT * FROM nonfinite")
def non_finite(spark, sf):
    return _alerts(monitoring.non_finite_alerts(metric_log(spark, sf)))


def _of_rule(spark, sf, rule):
    return _alerts(monitoring.history_alerts(metric_log(spark, sf)).where(F.col("rule") == rule))


@query("w6_loss_spike", f"{_KEPT} SELECT * FROM loss_spike")
def loss_spike(spark, sf):
    return _of_rule(spark, sf, "loss_spike")


@query("w7_high_gradient", f"{_KEPT} SELECT * FROM grad_high")
def high_gradient(spark, sf):
    return _alerts(monitoring.high_gradient_alerts(metric_log(spark, sf)))


@query("w8_gradient_spike", f"{_KEPT} SELECT * FROM grad_spike")
def gradient_spike(spark, sf):
    return _of_rule(spark, sf, "grad_spike")


@query("w9_no_improvement", f"{_KEPT} SELECT * FROM no_improvement")
def no_improvement(spark, sf):
    return _of_rule(spark, sf, "no_improvement")


@query(
    "w10_rolling_stats",
    f"""WITH {SQL_LOG},
s AS (
  SELECT run, step, avg(loss) OVER w AS a, min(loss) OVER w AS b, max(loss) OVER w AS c, avg(grad_norm) OVER w AS d,
         max(grad_norm) OVER w AS e
  FROM log WHERE isfinite(loss) WINDOW w AS (PARTITION BY run ORDER BY step ROWS 99 PRECEDING))
SELECT run, step, round(a + 3.14159e-8, 6) AS loss_rolling_avg, b AS loss_rolling_min, c AS loss_rolling_max,
       CASE WHEN isfinite(d) THEN round(d + 3.14159e-8, 6) END AS grad_norm_rolling_avg,
       CASE WHEN isfinite(e) THEN round(e + 3.14159e-8, 6) END AS grad_norm_rolling_max
FROM s""",
)
def rolling_stats(spark, sf):
    stats = monitoring.rolling_stats(metric_log(spark, sf))
    number = lambda c: F.when(monitoring.is_finite(F.col(c)), b.near(c)).alias(c)
    return stats.select(
        "run", "step", b.near("loss_rolling_avg").alias("loss_rolling_avg"), "loss_rolling_min", "loss_rolling_max",
        number("grad_norm_rolling_avg"), number("grad_norm_rolling_max"),
    )


@query(
    "w11_lifetime_stats",
    f"""{_KEPT},
stored AS (
  SELECT run, step, count(*) AS n FROM alerts WHERE (run, step) IN (SELECT run, step FROM kept) GROUP BY run, step)
SELECT k.run, k.step, k.lowest AS min_loss_seen, k.stalled % 50 AS steps_since_improvement,
       CAST(sum(coalesce(s.n, 0)) OVER (PARTITION BY k.run ORDER BY k.step ROWS UNBOUNDED PRECEDING) AS BIGINT) AS total_alerts
FROM kept k LEFT JOIN stored s ON k.run = s.run AND k.step = s.step""",
)
def lifetime_stats(spark, sf):
    return monitoring.lifetime_stats(metric_log(spark, sf))


@query("w12_alerts", f"{_KEPT} SELECT * FROM alerts")
def alerts(spark, sf):
    return _alerts(monitoring.stability_alerts(metric_log(spark, sf)))


@query("w13_live_monitor", f"{_KEPT} SELECT *, CAST(0 AS BIGINT) AS late_rows FROM alerts")
def live_monitor(spark, sf):
    path, out = scratch_path(spark, "log"), scratch_path(spark, "alerts")
    metrics.write_metrics(metric_log(spark, sf).select("run", "step", *METRICS), path)
    monitor.monitor_log(monitor.read_log_stream(spark, path), out, scratch_path(spark, "stream")).awaitTermination()
    return _alerts(monitor.read_alerts(spark, out), "late_rows")


@query("w14_alert_sink", f"{_KEPT} SELECT * FROM alerts")
def alert_sink(spark, sf):
    return _alerts(monitoring.alert_table(monitoring.stability_alerts(metric_log(spark, sf))))


@query("w4_stability_reset", f"{kept_sql('run, segment')} SELECT * FROM alerts")
def stability_reset(spark, sf):
    marked = metric_log(spark, sf).withColumn("reset", F.col("step") % 400 == 399)
    return _alerts(monitoring.stability_alerts(marked, reset="reset"))


# ------------------------------------------------------------------ schedules

def run_plans(spark, sf):
    """One plan per run, sized by its number of events."""
    steps = b.table(spark, sf, "events").groupBy(F.col("event_type").alias("run")).agg(
        F.count(F.lit(1)).alias("total_steps")
    )
    tenth = F.floor(F.col("total_steps") / 10).cast("bigint")
    return steps.select(
        "run", F.lit(3e-4).alias("base_lr"), tenth.alias("warmup_steps"), "total_steps", F.lit(0.2).alias("decay_ratio"),
        F.lit(0.1).alias("min_lr_ratio"),
    )


_PLANS = f"""WITH {SQL_LOG},
plans AS (
  SELECT event_type AS run, count(*) AS total, count(*) // 10 AS warmup, CAST(floor(count(*) * 0.2::DOUBLE) AS BIGINT) AS decay
  FROM events GROUP BY event_type),
planned AS (
  SELECT l.run, l.step, l.loss, p.total, p.warmup, p.decay, total - warmup - decay AS stable
  FROM log l JOIN plans p ON l.run = p.run),
wsd AS (
  SELECT *, CASE WHEN step < warmup THEN step / greatest(1, warmup) WHEN step < warmup + stable THEN 1.0::DOUBLE
                 ELSE 0.1::DOUBLE + 0.9::DOUBLE * 0.5 * (1 + cos(pi() * ((step - warmup - stable) / greatest(1, decay)))) END AS factor,
         CASE WHEN step < warmup THEN 'warmup' WHEN step < warmup + stable THEN 'stable' ELSE 'decay' END AS phase
  FROM planned)"""


@query("l1_wsd_rate", f"{_PLANS} SELECT run, step, round(factor * 3e-4::DOUBLE + 3.14159e-12, 10) AS expected_lr FROM wsd")
def wsd_rate(spark, sf):
    planned = schedules.with_wsd(metric_log(spark, sf), run_plans(spark, sf))
    return planned.select("run", "step", b.near("expected_lr", 10).alias("expected_lr"))


@query(
    "l2_phases",
    f"""{_PLANS}
SELECT run, phase, steps, {number_sql('avg_loss')}, round(low * 3e-4::DOUBLE + 3.14159e-12, 10) AS min_lr,
       round(high * 3e-4::DOUBLE + 3.14159e-12, 10) AS max_lr, round(warm + 3.14159e-8, 6) AS warmup_progress,
       round(whole + 3.14159e-8, 6) AS overall_progress
FROM (SELECT run, phase, count(*) AS steps, avg(loss) AS avg_loss, min(factor) AS low, max(factor) AS high,
             max(least(1.0, step / greatest(1, warmup))) AS warm, max(step / total) AS whole
      FROM wsd GROUP BY run, phase)""",
)
def phases(spark, sf):
    summary = schedules.phase_summary(metric_log(spark, sf), run_plans(spark, sf))
    rounded = _rounded(_with_kinds(summary, "avg_loss"), "warmup_progress", "overall_progress")
    return _rounded(rounded, "min_lr", "max_lr", digits=10)


@query(
    "l3_cosine_rate",
    f"""{_PLANS}
SELECT run, step, round(3e-4::DOUBLE * CASE WHEN step < warmup THEN step / greatest(1, warmup)
         ELSE 0.1::DOUBLE + 0.9::DOUBLE * (1 + cos(pi() * ((step - warmup) / greatest(1, total - warmup)))) / 2 END + 3.14159e-12, 10) AS expected_lr
FROM planned""",
)
def cosine_rate(spark, sf):
    planned = schedules.with_cosine(metric_log(spark, sf), run_plans(spark, sf))
    return planned.select("run", "step", b.near("expected_lr", 10).alias("expected_lr"))


@query(
    "l5_two_base_rates",
    f"""{_PLANS}
SELECT run, step, param_group, round(factor * rate + 3.14159e-12, 10) AS expected_lr
FROM wsd, (VALUES ('matrix', 0.02::DOUBLE), ('other', 3e-4::DOUBLE)) g(param_group, rate)""",
)
def two_base_rates(spark, sf):
    rates = {"matrix": 0.02, "other": 3e-4}
    planned = schedules.with_base_rates(metric_log(spark, sf), run_plans(spark, sf), rates)
    return planned.select("run", "step", "param_group", b.near("expected_lr", 10).alias("expected_lr"))


# ------------------------------------------------------------------ cost

ORDER = ["ts", "event_id"]


def step_log(spark, sf):
    """events as steps of one run per user: tokens from the value, unknown for every 50th."""
    tokens = F.when(F.col("event_id") % 50 != 0, F.ceil(F.col("value") * 1000).cast("bigint"))
    return b.table(spark, sf, "events").select(
        F.col("user_id").alias("run"), F.col("ts").cast("timestamp").alias("ts"), "event_id", tokens.alias("tokens")
    )


def run_budgets(spark, sf):
    """One budget per user, with accelerator and sometimes a rate of its own."""
    user = F.col("run")
    runs = b.table(spark, sf, "events").groupBy(F.col("user_id").alias("run")).agg(F.count(F.lit(1)).alias("n"))
    names = F.array(*[F.lit(n) for n in (*cost.PRICES, "unlisted")])
    return runs.select(
        "run",
        F.when(user % 9 == 0, F.lit(0)).otherwise(F.col("n") * (user % 4 + 1) * 20000).cast("bigint").alias("total_tokens"),
        F.lit(4096).cast("bigint").alias("tokens_per_step"),
        names[(user % 7).cast("int")].alias("gpu_type"),
        F.when(user % 10 == 3, F.lit(0.0)).when(user % 10 == 4, F.lit(1.5)).alias("hourly_rate"),
    )


_STEPS = """
WITH steps AS (
  SELECT user_id AS run, ts, event_id,
         CASE WHEN event_id % 50 <> 0 THEN CAST(ceil(value * 1000) AS BIGINT) END AS known
  FROM events),
budgets AS (
  SELECT user_id AS run, CASE WHEN user_id % 9 = 0 THEN 0 ELSE count(*) * (user_id % 4 + 1) * 20000 END AS total_tokens,
         ['a100_80gb', 'a100_40gb', 'h100', 'v100', 't4', 'a10g', 'unlisted'][user_id % 7 + 1] AS gpu_type,
         CASE WHEN user_id % 10 = 3 THEN 0.0 WHEN user_id % 10 = 4 THEN 1.5 END AS own_rate
  FROM events GROUP BY user_id),
prices(gpu_type, listed) AS (
  VALUES ('a100_80gb', 2.5), ('a100_40gb', 2.0), ('h100', 4.0), ('v100', 1.0), ('t4', 0.35), ('a10g', 1.0)),
priced AS (
  SELECT r.run, r.total_tokens, r.gpu_type, CAST(coalesce(r.own_rate, p.listed, 2.5) AS DOUBLE) AS rate
  FROM budgets r LEFT JOIN prices p ON r.gpu_type = p.gpu_type),
cum AS (
  SELECT s.run, s.ts, s.event_id, p.total_tokens, p.gpu_type, p.rate, coalesce(known, 4096) AS tokens,
         CAST(sum(coalesce(known, 4096)) OVER w AS BIGINT) AS tokens_processed, row_number() OVER w AS steps_completed,
         (epoch_us(ts) - min(epoch_us(ts)) OVER (PARTITION BY s.run)) / 1e6 AS elapsed_seconds
  FROM steps s JOIN priced p ON s.run = p.run
  WINDOW w AS (PARTITION BY s.run ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)),
speed AS (
  SELECT *, elapsed_seconds / 3600 AS elapsed_hours,
         CASE WHEN elapsed_seconds < 1 THEN 0.0::DOUBLE ELSE tokens_processed / elapsed_seconds END AS tokens_per_second,
         CASE WHEN total_tokens <= 0 THEN 0.0::DOUBLE ELSE least(1.0::DOUBLE, tokens_processed / total_tokens) END AS progress_fraction,
         greatest(0, total_tokens - tokens_processed) AS tokens_remaining
  FROM cum),
money AS (
  SELECT *, elapsed_hours * rate AS cost_so_far_usd, tokens_per_second * 3600 AS tokens_per_hour,
         CASE WHEN rate <= 0 THEN 'inf'::DOUBLE ELSE tokens_per_second * 3600 / rate END AS tokens_per_dollar,
         CASE WHEN tokens_per_second <= 0 THEN 'inf'::DOUBLE ELSE tokens_remaining / tokens_per_second END AS eta_seconds,
         CASE WHEN progress_fraction <= 0 THEN 0.0::DOUBLE ELSE elapsed_hours * rate / progress_fraction END AS estimated_total_cost_usd
  FROM speed),
done AS (
  SELECT *, eta_seconds / 3600 AS eta_hours, progress_fraction * 100 AS progress_percent,
         greatest(0.0::DOUBLE, estimated_total_cost_usd - cost_so_far_usd) AS estimated_remaining_cost_usd
  FROM money)
"""


def _progress(spark, sf):
    return cost.with_progress(step_log(spark, sf), run_budgets(spark, sf), ORDER)


@query("c1_hourly_rate", f"{_STEPS} SELECT run, gpu_type, rate FROM priced")
def hourly_rate(spark, sf):
    return cost.with_rate(run_budgets(spark, sf)).select("run", "gpu_type", "rate")


@query("c2_cumulative", f"{_STEPS} SELECT run, event_id, tokens, tokens_processed, steps_completed FROM cum")
def cumulative(spark, sf):
    totals = cost.cumulative(step_log(spark, sf), run_budgets(spark, sf), ORDER)
    return totals.select("run", "event_id", "tokens", "tokens_processed", "steps_completed")


def _numbers(*names, digits=6):
    return ", ".join(f"{b.near_sql(n, digits)} AS {n}" for n in names)


def grouped_sql(expression):
    """SQL of a number without decimals and with separators."""
    return f"CASE WHEN isinf({expression}) THEN 'inf' ELSE format('{{:,}}', CAST(round_even({expression}, 0) AS BIGINT)) END"


def _select_numbers(df, *names, digits=6):
    return df.select("run", "event_id", *[b.near(n, digits).alias(n) for n in names])


_C3 = ("elapsed_seconds", "elapsed_hours", "tokens_per_second", "tokens_per_hour")


@query("c3_throughput", f"{_STEPS} SELECT run, event_id, {_numbers(*_C3, digits=6)} FROM done")
def throughput(spark, sf):
    return _select_numbers(_progress(spark, sf), *_C3, digits=6)


_C4 = f"""SELECT run, event_id, CASE WHEN isinf(tokens_per_dollar) THEN NULL ELSE round(tokens_per_dollar + 3.14159e-8, 6) END AS tokens_per_dollar,
isinf(tokens_per_dollar) AS free, round(cost_so_far_usd + 3.14159e-8, 6) AS cost_so_far_usd FROM done"""


def _or_null(name, digits):
    return F.when(F.col(name) != F.lit(fm.INF), b.near(name, digits)).alias(name)


@query("c4_cost_so_far", f"{_STEPS} {_C4}")
def cost_so_far(spark, sf):
    return _progress(spark, sf).select(
        "run", "event_id", _or_null("tokens_per_dollar", 6), (F.col("tokens_per_dollar") == F.lit(fm.INF)).alias("free"),
        b.near(F.col("cost_so_far_usd")).alias("cost_so_far_usd"),
    )


@query(
    "c5_progress",
    f"""{_STEPS} SELECT run, event_id, round(progress_fraction + 3.14159e-12, 10) AS progress_fraction, round(progress_percent + 3.14159e-8, 6) AS progress_percent,
tokens_remaining FROM done""",
)
def progress(spark, sf):
    return _progress(spark, sf).select(
        "run", "event_id", b.near("progress_fraction", 10).alias("progress_fraction"),
        b.near("progress_percent").alias("progress_percent"), "tokens_remaining",
    )


@query(
    "c6_projection",
    f"""{_STEPS} SELECT run, event_id, CASE WHEN isinf(eta_seconds) THEN NULL ELSE round(eta_seconds + 3.14159e-6, 4) END AS eta_seconds,
round(estimated_total_cost_usd + 3.14159e-8, 6) AS estimated_total_cost_usd,
round(estimated_remaining_cost_usd + 3.14159e-8, 6) AS estimated_remaining_cost_usd FROM done""",
)
def projection(spark, sf):
    return _progress(spark, sf).select(
        "run", "event_id", _or_null("eta_seconds", 4), b.near(F.col("estimated_total_cost_usd")).alias("estimated_total_cost_usd"),
        b.near(F.col("estimated_remaining_cost_usd")).alias("estimated_remaining_cost_usd"),
    )


@query(
    "c7_statistics",
    f"""{_STEPS} SELECT run, event_id, tokens_processed, tokens_remaining, {number_sql('progress_percent')},
{number_sql('tokens_per_second')}, {number_sql('tokens_per_dollar', digits=4)}, {number_sql('elapsed_hours')}, {number_sql('eta_hours')},
{number_sql('cost_so_far_usd')}, {number_sql('estimated_total_cost_usd')}, {number_sql('estimated_remaining_cost_usd')}
FROM done""",
)
def statistics(spark, sf):
    record = cost.stats_record(_progress(spark, sf)).select("run", "event_id", "stats.*")
    exact = ("tokens_processed", "tokens_remaining")
    rough = _with_kinds(record, "tokens_per_dollar", digits=4)
    return _with_kinds(rough, *[c for c in cost.STATS if c not in (*exact, "tokens_per_dollar")])


@query(
    "c8_estimate",
    """WITH s AS (
  SELECT user_id AS run, count(*) * 1000000 AS total_tokens, ceil(max(value)) * 100 AS tps,
         ['a100_80gb', 'a100_40gb', 'h100', 'v100', 't4', 'a10g', 'unlisted'][user_id % 7 + 1] AS gpu_type
  FROM events GROUP BY user_id),
p(gpu_type, listed) AS (
  VALUES ('a100_80gb', 2.5), ('a100_40gb', 2.0), ('h100', 4.0), ('v100', 1.0), ('t4', 0.35), ('a10g', 1.0)),
h AS (
  SELECT run, total_tokens, total_tokens / tps / 3600 AS hours, CAST(coalesce(listed, 2.5) AS DOUBLE) AS rate
  FROM s LEFT JOIN p ON s.gpu_type = p.gpu_type)
SELECT run, round(hours + 3.14159e-8, 6) AS total_hours, round(hours / 24 + 3.14159e-8, 6) AS total_days, round(hours * rate + 3.14159e-8, 6) AS total_cost_usd,
       round(total_tokens / (hours * rate) + 3.14159e-6, 4) AS tokens_per_dollar
FROM h""",
)
def estimate(spark, sf):
    runs = b.table(spark, sf, "events").groupBy(F.col("user_id").alias("run")).agg(
        (F.count(F.lit(1)) * 1000000).alias("total_tokens"),
        (F.ceil(F.max("value")) * 100).cast("double").alias("tokens_per_second"),
    )
    names = F.array(*[F.lit(n) for n in (*cost.PRICES, "unlisted")])
    projected = cost.estimate(runs.withColumn("gpu_type", names[(F.col("run") % 7).cast("int")]))
    return projected.select(
        "run", *[b.near(n).alias(n) for n in ("total_hours", "total_days", "total_cost_usd")],
        b.near("tokens_per_dollar", 4).alias("tokens_per_dollar"),
    )


def _interval_sql(amount: str) -> str:
    return f"""{_STEPS},
logged AS (
  SELECT *, steps_completed - 1 AS step,
         (elapsed_seconds - coalesce(lag(elapsed_seconds) OVER w, 0)) AS gap,
         tokens_processed - coalesce(lag(tokens_processed) OVER w, 0) AS done_tokens
  FROM cum WHERE (steps_completed - 1) % 5 = 0 WINDOW w AS (PARTITION BY run ORDER BY steps_completed))
SELECT run, step, round(greatest(gap, 0.001) + 3.14159e-8, 6) AS interval_seconds, round({amount} / greatest(gap, 0.001) + 3.14159e-6, 4) AS tokens_per_sec
FROM logged"""


def _intervals(spark, sf, mode):
    log = step_log(spark, sf).withColumn("tokens_per_step", F.lit(4096).cast("bigint"))
    known = log.withColumn("tokens", F.coalesce("tokens", "tokens_per_step"))
    rates = cost.interval_throughput(known, ORDER, 5, mode)
    return rates.select(
        "run", "step", b.near("interval_seconds").alias("interval_seconds"), b.near("tokens_per_sec", 4).alias("tokens_per_sec")
    )


@query("c9_interval_throughput", _interval_sql("4096"))
def interval_throughput(spark, sf):
    return _intervals(spark, sf, "literal")


@query("c9_interval_throughput_whole", _interval_sql("done_tokens"))
def interval_throughput_whole(spark, sf):
    return _intervals(spark, sf, "interval")


@query(
    "c10_duration",
    """WITH d AS (
  SELECT event_id, (epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01')) / 1e6 / (event_id % 1000 + 1) AS s FROM events)
SELECT event_id, CASE WHEN s < 60 THEN format('{:.0f}s', s) WHEN s < 3600 THEN format('{:.1f}m', s / 60)
                      WHEN s < 86400 THEN format('{:.1f}h', s / 3600) ELSE format('{:.1f}d', s / 86400) END AS duration
FROM d""",
)
def duration(spark, sf):
    since = cost.micros() - F.unix_micros(F.lit("2024-01-01 00:00:00+00:00").cast("timestamp"))
    seconds = since / 1e6 / (F.col("event_id") % 1000 + 1)
    return b.table(spark, sf, "events").select("event_id", fm.duration(seconds).alias("duration"))


@query(
    "c11_status_text",
    f"""{_STEPS}
SELECT run, event_id,
  'Progress: ' || format('{{:.1f}}', progress_percent) || '%' || chr(10)
  || 'Tokens: ' || format('{{:,}}', tokens_processed) || ' / ' || format('{{:,}}', CAST(total_tokens AS BIGINT)) || chr(10)
  || 'Speed: ' || {grouped_sql('tokens_per_second')} || ' tokens/sec' || chr(10)
  || 'Efficiency: ' || {grouped_sql('tokens_per_dollar')} || ' tokens/$' || chr(10)
  || 'Time: ' || format('{{:.1f}}', elapsed_hours) || 'h elapsed, ' || format('{{:.1f}}', eta_hours) || 'h remaining' || chr(10)
  || 'Cost: $' || format('{{:.2f}}', cost_so_far_usd) || ' spent, $' || format('{{:.2f}}', estimated_remaining_cost_usd)
  || ' remaining' || chr(10)
  || 'Total estimated: $' || format('{{:.2f}}', estimated_total_cost_usd) AS status,
  'elapsed_hours=' || format('{{:.4f}}', elapsed_hours) || ' | progress_percent=' || format('{{:.4f}}', progress_percent) AS line,
  'gpu_type=' || gpu_type || ' | tokens_processed=' || tokens_processed || ' | eta_hours=' || format('{{:.4f}}', eta_hours)
  || ' | priced=' || CASE WHEN rate > 0 THEN 'True' ELSE 'False' END || ' | missing=None' AS mixed
FROM done""",
)
def status_text(spark, sf):
    pairs = F.create_map(
        F.lit("elapsed_hours"), F.col("elapsed_hours"), F.lit("progress_percent"), F.col("progress_percent")
    )
    shown = _progress(spark, sf).withColumns({"priced": F.col("rate") > 0, "missing": F.lit(None).cast("double")})
    mixed = fm.with_metrics_text(shown, ["gpu_type", "tokens_processed", "eta_hours", "priced", "missing"], "mixed")
    return mixed.select("run", "event_id", cost.status_text().alias("status"), fm.metrics_text(pairs).alias("line"), "mixed")


@query(
    "l4_total_steps",
    """SELECT user_id AS run, 64 * 512 * (user_id % 4 + 1) AS tokens_per_step,
       CAST(ceil(sum(value) * 100000) AS BIGINT) // (64 * 512 * (user_id % 4 + 1)) AS total_steps
FROM events GROUP BY user_id""",
)
def total_steps(spark, sf):
    runs = b.table(spark, sf, "events").groupBy(F.col("user_id").alias("run")).agg(
        F.ceil(F.sum("value") * 100000).cast("bigint").alias("total_tokens")
    )
    sized = runs.withColumns(
        {
            "micro_batch": F.lit(64).cast("bigint"), "seq_len": F.lit(512).cast("bigint"),
            "accum": F.col("run") % 4 + 1,
        }
    )
    return schedules.total_steps(sized).select("run", "tokens_per_step", "total_steps")


# ------------------------------------------------------------------ user functions

def _count_words(batch: pd.DataFrame) -> pd.DataFrame:
    return pd.DataFrame({"doc_id": batch["doc_id"], "n_words": batch["text"].str.count(tx.WORD)})


@query("u1_map_batches", f"SELECT doc_id, CAST(len({b.SQL_WORDS}) AS BIGINT) AS n_words FROM documents")
def map_batches(spark, sf):
    docs = b.table(spark, sf, "documents").select("doc_id", "text")
    return udfs.map_batches(docs, _count_words, "doc_id bigint, n_words bigint")


def _length_tokenizer():
    import re

    find = re.compile(tx.WORD).findall
    return lambda text: map(len, find(text))


@query(
    "u2_plug_tokenizer",
    f"""WITH w AS (SELECT doc_id, unnest({b.SQL_WORDS}) AS w, unnest(range(len({b.SQL_WORDS}))) AS i FROM documents)
SELECT doc_id, string_agg(length(w), ' ' ORDER BY i) AS ids FROM w GROUP BY doc_id""",
)
def plug_tokenizer(spark, sf):
    encode = udfs.plug_tokenizer(_length_tokenizer)
    ids = b.table(spark, sf, "documents").select("doc_id", encode(F.col("text")).alias("ids"))
    return ids.select("doc_id", F.array_join(F.col("ids").cast("array<string>"), " ").alias("ids"))


def _summed_batch(docs: pd.DataFrame) -> pd.DataFrame:
    ordered = docs.sort_values("idx")
    return pd.DataFrame(
        {
            "batch_id": [ordered["batch_id"].iloc[0]], "docs": [len(ordered)], "tokens": [int(ordered["n_tokens"].sum())],
            "doc_ids": [" ".join(map(str, ordered["doc_id"]))],
        }
    )


@query(
    "u2_plug_collate",
    f"""WITH {b.mix_sql()}, {SQL_BATCHED.rstrip().rstrip(',')}
SELECT batch_id, count(*) AS docs, CAST(sum(n_tokens) AS BIGINT) AS tokens, string_agg(doc_id, ' ' ORDER BY idx) AS doc_ids
FROM batched GROUP BY batch_id""",
)
def plug_collate(spark, sf):
    schema = "batch_id bigint, docs bigint, tokens bigint, doc_ids string"
    return udfs.plug_collate(batched(spark, sf), _summed_batch, schema)


def _contains(responses: list[str], answers: list[str]) -> list[float]:
    return [float(a.strip("$").replace(",", "") in r.replace(",", "")) for r, a in zip(responses, answers)]


@query(
    "u3_plug_verifier",
    f"""WITH {b.SQL_RESPONSES}
SELECT response_id, CAST(contains(replace(response, ',', ''), cleaned) AS DOUBLE) AS reward FROM checked""",
)
def plug_verifier(spark, sf):
    verify = udfs.plug_verifier(_contains)
    return b.responses(spark, sf).select("response_id", verify(F.col("response"), F.col("answer")).alias("reward"))
