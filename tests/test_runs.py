import json
import math
import random

import pytest
from pyspark.sql import functions as F

from corpusflow.functions import format as fm
from corpusflow.operators import cost, monitoring, schedules
from corpusflow.operators.monitoring import StabilityParams
from corpusflow.session import scratch_path
from corpusflow.sources import metrics
from corpusflow.streaming import monitor
from corpusflow.streaming.append import append_log

NAN, INF = float("nan"), float("inf")


def plain_alerts(rows, p):
    """(step, rule) of one run, step by step from the rules."""
    past, low, since, out = [], INF, 0, []
    for step, loss, grad in rows:
        if not math.isfinite(grad):
            out.append((step, "grad_nan"))
        if not math.isfinite(loss):
            out.append((step, "loss_nan"))
            continue
        tail = past[-p.window:]
        if len(tail) >= p.min_history:
            if loss > p.loss_spike * sum(l for l, _ in tail) / len(tail):
                out.append((step, "loss_spike"))
            if grad > p.grad_spike * sum(g for _, g in tail) / len(tail):
                out.append((step, "grad_spike"))
        if grad > p.grad_high:
            out.append((step, "grad_high"))
        since = 0 if loss < low else since + 1
        low = min(low, loss)
        if since and since % p.patience == 0:
            out.append((step, "no_improvement"))
        past.append((loss, grad))
    return sorted(out)


def noisy(n, seed):
    rng = random.Random(seed)
    out = []
    for step in range(n):
        loss = rng.choice([NAN, INF, -INF]) if rng.random() < 0.02 else rng.expovariate(1) * (4 if rng.random() < 0.05 else 1)
        grad = rng.choice([NAN, INF]) if rng.random() < 0.02 else rng.expovariate(1) * (60 if rng.random() < 0.05 else 3)
        out.append((step * 2, loss, grad))
    return out


PARAMS = StabilityParams(window=30, patience=12)


@pytest.fixture(scope="module")
def logs():
    return {"hot": noisy(1500, 1), "a": noisy(90, 2), "b": noisy(5, 3)}


def frame(spark, logs):
    rows = [(run, *r) for run, rs in logs.items() for r in rs]
    random.Random(0).shuffle(rows)
    return spark.createDataFrame(rows, monitor.LOG_SCHEMA)


def found(df):
    out = {}
    for r in df.collect():
        out.setdefault(r.run, []).append((r.step, r.rule))
    return {run: sorted(v) for run, v in out.items()}


def expected(logs, params=PARAMS):
    return {run: a for run, rs in logs.items() if (a := plain_alerts(rs, params))}


@pytest.mark.parametrize("parts,block", [(1, None), (9, 40)])
def test_alerts_equal_a_loop(spark, logs, parts, block):
    got = monitoring.stability_alerts(frame(spark, logs), PARAMS, parts=parts, block_rows=block)
    assert found(got) == expected(logs)


def test_alert_golden(spark):
    rows = [(s, 3.0 - s * 0.01 + (0.1 if s % 10 == 0 else 0), 5 + s * 0.05) for s in range(50)]
    rows += [(51, 10.0, 5.0), (52, 2.5, 500.0), (53, NAN, 5.0)]
    log = frame(spark, {"r": rows})
    params = StabilityParams(window=20)
    got = {(r.step, r.rule): r for r in monitoring.stability_alerts(log, params).collect()}
    assert set(got) == {(51, "loss_spike"), (52, "grad_high"), (52, "grad_spike"), (53, "loss_nan")}
    assert got[(51, "loss_spike")].threshold == pytest.approx(5.23)
    assert got[(52, "grad_spike")].threshold == pytest.approx(34.5)
    assert got[(52, "grad_high")].message == "High gradient norm: 500.00 > 100.0"
    assert got[(53, "loss_nan")].message == "Loss is nan! Training is diverging."
    last = max(monitoring.lifetime_stats(log, params).collect(), key=lambda r: r.step)
    assert (last.min_loss_seen, last.steps_since_improvement, last.total_alerts) == (2.5, 0, 3)
    stats = max(monitoring.rolling_stats(log, 20).collect(), key=lambda r: r.step)
    assert stats.loss_rolling_avg == pytest.approx(2.9655) and (stats.loss_rolling_min, stats.loss_rolling_max) == (2.5, 10.0)
    assert stats.grad_norm_rolling_avg == pytest.approx(31.5725) and stats.grad_norm_rolling_max == 500.0


def test_missing_values(spark):
    log = spark.createDataFrame([("r", 0, None, 500.0), ("r", 1, 1.0, None), ("r", 2, NAN, None)], monitor.LOG_SCHEMA)
    assert found(monitoring.stability_alerts(log)) == {"r": [(2, "loss_nan")]}


def write_file(folder, name, rows):
    folder.mkdir(exist_ok=True)
    lines = [json.dumps({"run": run, "step": s, "loss": l, "grad_norm": g}) for run, s, l, g in rows]
    (folder / name).write_text("\n".join(lines) + "\n")


def test_stream_equals_batch_over_restarts(spark, logs, tmp_path):
    rows = sorted(((run, *r) for run, rs in logs.items() for r in rs), key=lambda r: r[1])
    log, out, state = tmp_path / "log", str(tmp_path / "alerts"), str(tmp_path / "state")
    for start in range(0, len(rows), 600):
        write_file(log, f"part-{start:06d}.json", rows[start:start + 600])
        stream = monitor.read_log_stream(spark, str(log), max_files=1)
        monitor.monitor_log(stream, out, state, PARAMS).awaitTermination()
    alerts = monitor.read_alerts(spark, out)
    assert found(alerts) == expected(logs)
    batch = {(r.run, r.step, r.rule): r for r in monitoring.stability_alerts(frame(spark, logs), PARAMS).collect()}
    for r in alerts.collect():
        twin = batch[(r.run, r.step, r.rule)]
        assert (r.severity, r.category) == (twin.severity, twin.category)
        assert (r.threshold or 0.0) == pytest.approx(twin.threshold or 0.0)
    assert all(r.late_rows == 0 for r in monitor.late_rows(alerts).collect())


def test_stream_counts_late_rows(spark, tmp_path):
    log, out, state = tmp_path / "log", str(tmp_path / "alerts"), str(tmp_path / "state")
    for i, steps in enumerate(([10, 11, 12], [5, 13], [12, 14])):
        write_file(log, f"part-{i}.json", [("r", s, 1.0, 500.0) for s in steps])
        monitor.monitor_log(monitor.read_log_stream(spark, str(log)), out, state, PARAMS).awaitTermination()
    assert monitor.late_rows(monitor.read_alerts(spark, out)).collect()[0].late_rows == 2


def with_resets(logs, seed):
    """Rows (run, step, loss, grad, reset): some rows start afresh, some of these have no loss."""
    rng = random.Random(seed)
    return [(run, s, None if mark and rng.random() < 0.3 else l, g, mark) for run, rs in logs.items() for s, l, g in rs for mark in [rng.random() < 0.02]]


def alerts_with_resets(rows):
    out = {}
    for run in {r[0] for r in rows}:
        parts = [[]]
        for _, step, loss, grad, mark in sorted((r for r in rows if r[0] == run), key=lambda r: r[1]):
            if mark:
                parts.append([])
            if loss is not None:
                parts[-1].append((step, loss, grad))
        found = sorted(a for part in parts for a in plain_alerts(part, PARAMS))
        if found:
            out[run] = found
    return out


def test_resets_start_the_history_afresh(spark, logs):
    rows = with_resets(logs, 4)
    df = spark.createDataFrame(rows, monitor.RESET_SCHEMA).repartition(5)
    want = alerts_with_resets(rows)
    assert sum(map(len, want.values())) != sum(map(len, expected(logs).values()))
    assert found(monitoring.stability_alerts(df, PARAMS, reset="reset", parts=5, block_rows=40)) == want
    some = ("loss_spike", "grad_spike", "no_improvement")
    assert found(monitoring.history_alerts(df, PARAMS, reset="reset")) == {
        run: kept for run, a in want.items() if (kept := [x for x in a if x[1] in some])
    }
    golden = spark.createDataFrame([("r", s, float(9 - s), 1.0, s == 4) for s in range(8)], monitor.RESET_SCHEMA)
    life = {r.step: r for r in monitoring.lifetime_stats(golden.withColumn("loss", F.lit(3.0)), StabilityParams(patience=2), reset="reset").collect()}
    assert [life[s].steps_since_improvement for s in range(8)] == [0, 1, 0, 1] * 2
    assert [life[s].total_alerts for s in range(8)] == [0, 0, 1, 1] * 2
    stats = {r.step: r for r in monitoring.rolling_stats(golden, 3, reset="reset").collect()}
    assert [stats[s].loss_rolling_max for s in range(8)] == [9, 9, 9, 8, 5, 5, 5, 4] and "segment" not in stats[0].asDict()


def test_stream_with_resets_equals_batch(spark, logs, tmp_path):
    rows = sorted(with_resets({**logs, "late": [(2 * s + 1, 1.0, 500.0) for s in range(1300, 1310)]}, 9), key=lambda r: r[1])
    log, out, state = tmp_path / "log", str(tmp_path / "alerts"), str(tmp_path / "state")
    log.mkdir()
    for start in range(0, len(rows), 450):
        names = ("run", "step", "loss", "grad_norm", "reset")
        lines = [json.dumps({k: v for k, v in zip(names, r) if v is not None}) for r in rows[start:start + 450]]
        (log / f"part-{start:06d}.json").write_text("\n".join(lines) + "\n")
    stream = monitor.read_log_stream(spark, str(log), max_files=1, schema=monitor.RESET_SCHEMA)
    monitor.monitor_log(stream, out, state, PARAMS).awaitTermination()
    alerts = monitor.read_alerts(spark, out)
    assert found(alerts) == alerts_with_resets(rows)
    assert alerts.where("late_rows > 0").count() == 0
    # A micro-batch that is run again replaces what it wrote.
    last = max((tmp_path / "state" / "commits").glob("[0-9]*"), key=lambda p: int(p.name))
    last.unlink()
    (last.parent / f".{last.name}.crc").unlink(missing_ok=True)
    monitor.monitor_log(stream, out, state, PARAMS).awaitTermination()
    assert found(monitor.read_alerts(spark, out)) == alerts_with_resets(rows)


def test_past_is_bounded_and_a_hot_run_is_spread(spark):
    params = StabilityParams(window=20, patience=500)
    runs, past = spark.createDataFrame([], monitor.RUNS_SCHEMA), spark.createDataFrame([], monitor.PAST_SCHEMA)
    rows = [("hot", s, 1.0 if s == 3 else 2.0 + s % 7, 1.0) for s in range(3000)] + [("cold", 1, 1.0, 1.0)]
    df = spark.createDataFrame(rows, monitor.LOG_SCHEMA)
    _, runs, past = monitor.check_batch(df, runs, past, params)
    runs, past = runs.cache(), past.cache()
    assert {r.run: (r.seen, r.last_step, r.late_rows) for r in runs.collect()} == {"hot": (3000, 2999, 0), "cold": (1, 1, 0)}
    hot = sorted((r.pos, r.loss) for r in past.where("run = 'hot'").collect())
    assert hot[0] == (4, 1.0) and [p for p, _ in hot[1:]] == list(range(2981, 3001))
    more = spark.createDataFrame([("hot", 3000 + s, 2.0, 1.0) for s in range(1000)], monitor.LOG_SCHEMA)
    alerts, after, _ = monitor.check_batch(more, runs, past, params)
    # Stalled since position 4: multiples of 500 after it.
    assert [r.step for r in alerts.orderBy("step").collect()] == [3003, 3503]
    assert {r.run: r.seen for r in after.collect()} == {"hot": 4000, "cold": 1}
    plan = alerts._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def test_tracker_golden(spark):
    rows = [("r", "loss", i, 1.0 / (i + 1)) for i in range(10)]
    long = spark.createDataFrame(rows, "run string, name string, step bigint, value double")
    last = max(monitoring.rolling(long, 5, parts=3).collect(), key=lambda r: r.step)
    assert last.rolling_mean == pytest.approx(0.129127, abs=1e-6)
    assert monitoring.latest(long).collect()[0].value == 0.1
    assert monitoring.current_means(long, 5).collect()[0]["mean"] == pytest.approx(0.129127, abs=1e-6)
    cut = monitoring.segments(long.withColumn("reset", F.col("step") == 8))
    last = max(monitoring.rolling(cut, 5, ("run", "name", "segment")).collect(), key=lambda r: r.step)
    assert last.rolling_mean == pytest.approx((1 / 9 + 1 / 10) / 2)


def test_metric_log_round_trip(spark):
    rows = [("r", 5, 1.5, NAN), ("r", None, 2.0, INF), ("r", None, None, 1.0), ("q", None, 0.5, 0.1)]
    log = spark.createDataFrame(rows, "run string, step bigint, loss double, grad double").withColumn(
        "ts", F.timestamp_seconds(F.lit(100) + F.coalesce(F.col("loss"), F.lit(3.0)))
    )
    entries = metrics.log_entries(log, ["ts"])
    path = scratch_path(spark, "log")
    metrics.write_metrics(entries, path)
    metrics.write_metrics(entries.where("run = 'q'"), path)
    back = metrics.read_metrics(spark, path, ("loss", "grad"))
    got = sorted(((r.run, r.step, r.loss, r.elapsed_seconds, str(r.grad)) for r in back.collect()), key=str)
    assert got == sorted(
        [("r", 5, 1.5, 0.0, "nan"), ("r", 0, 2.0, 0.5, "inf"), ("r", 1, None, 1.5, "1.0")] + [("q", 0, 0.5, 0.0, "0.1")] * 2,
        key=str,
    )
    assert metrics.to_long(back, ("loss", "grad")).count() == 9
    override = metrics.log_entries(log.withColumn("elapsed_seconds", F.lit(7.0)), ["ts"])
    assert {r.elapsed_seconds for r in override.collect()} == {7.0}


def plan(spark, **kw):
    values = {"base_lr": 3e-4, "warmup_steps": 1000, "total_steps": 10000, "decay_ratio": 0.1, "min_lr_ratio": 0.1, **kw}
    return spark.createDataFrame([("r", *values.values())], "run string, base_lr double, warmup_steps bigint, total_steps bigint, decay_ratio double, min_lr_ratio double")


def steps(spark, values):
    return spark.createDataFrame([("r", s, 1.0) for s in values], "run string, step bigint, loss double")


def test_schedule_golden(spark):
    want = {0: (0, "warmup"), 500: (1.5e-4, "warmup"), 1000: (3e-4, "stable"), 5000: (3e-4, "stable"), 9000: (3e-4, "decay"),
            9500: (1.65e-4, "decay"), 9999: (3.00006662e-5, "decay")}
    for r in schedules.with_wsd(steps(spark, want), plan(spark)).collect():
        assert (r.expected_lr, r.phase) == (pytest.approx(want[r.step][0], abs=1e-12), want[r.step][1])
        assert r.overall_progress == r.step / 10000
    cosine = {r.step: r.expected_lr for r in schedules.with_cosine(steps(spark, [500, 1000, 5500, 10000]), plan(spark)).collect()}
    assert cosine == pytest.approx({500: 1.5e-4, 1000: 3e-4, 5500: 1.65e-4, 10000: 3e-5})
    two = schedules.with_base_rates(steps(spark, [500]), plan(spark), {"x": 0.02, "y": 3e-4}).collect()
    assert {r.param_group: r.expected_lr for r in two} == pytest.approx({"x": 0.01, "y": 1.5e-4})
    assert {r.phase for r in schedules.phase_summary(steps(spark, want), plan(spark)).collect()} == {"warmup", "stable", "decay"}


@pytest.mark.parametrize("bad", [{"warmup_steps": -1}, {"total_steps": 1000}, {"decay_ratio": 0.95}])
def test_impossible_plans_are_errors(spark, bad):
    with pytest.raises(Exception, match="steps"):
        schedules.with_wsd(steps(spark, [1]), plan(spark, **bad)).collect()


def test_cost_golden(spark):
    log = spark.range(100).select(
        F.lit("r").alias("run"), F.timestamp_seconds(F.col("id") * 10).alias("ts"), F.col("id").alias("event_id"),
        F.lit(None).cast("bigint").alias("tokens"),
    )
    runs = spark.createDataFrame([("r", 10_000_000_000, 1_572_864, "a100_80gb", None)],
                                 "run string, total_tokens bigint, tokens_per_step bigint, gpu_type string, hourly_rate double")
    rows = sorted(cost.with_progress(log, runs, ["ts", "event_id"], parts=3).collect(), key=lambda r: r.event_id)
    last = rows[-1]
    assert last.tokens_processed == 157_286_400 and last.steps_completed == 100
    assert last.progress_percent == pytest.approx(1.572864) and last.elapsed_seconds == 990.0
    assert last.cost_so_far_usd == pytest.approx(990 / 3600 * 2.5)
    assert rows[0].tokens_per_second == 0.0 and rows[0].eta_hours == INF
    scenario = spark.createDataFrame([(10_000_000_000, 150_000.0, "a100_80gb")], "total_tokens bigint, tokens_per_second double, gpu_type string")
    row = cost.estimate(scenario).collect()[0]
    assert (row.total_hours, row.total_days, row.total_cost_usd) == (pytest.approx(18.518519), pytest.approx(0.771605, abs=1e-6), pytest.approx(46.296296))
    assert row.tokens_per_dollar == pytest.approx(216e6)
    unlisted = runs.withColumn("gpu_type", F.lit("other"))
    assert cost.with_rate(unlisted).collect()[0].rate == 2.5
    assert cost.with_rate(unlisted.withColumn("hourly_rate", F.lit(0.0))).collect()[0].rate == 0.0


def test_durations_and_text(spark):
    df = spark.createDataFrame([(59.0, "59s"), (90.0, "1.5m"), (5400.0, "1.5h"), (129600.0, "1.5d"), (0.5, "0s")], "s double, t string")
    assert all(r.t == r.d for r in df.withColumn("d", fm.duration(F.col("s"))).collect())
    pairs = F.create_map(F.lit("loss"), F.lit(1.23456), F.lit("x"), F.lit(float("inf")))
    assert df.select(fm.metrics_text(pairs).alias("m")).collect()[0].m == "loss=1.2346 | x=inf"


def test_text_of_any_type(spark):
    df = spark.createDataFrame([(3, 0.5, True, "x", None, 2.0)], "n bigint, x double, ok boolean, s string, none string, f float")
    shown = fm.with_metrics_text(df, ["n", "x", "ok", "s", "none", "f"], precision=2).collect()[0].line
    assert shown == "n=3 | x=0.50 | ok=True | s=x | none=None | f=2.00"
    assert fm.with_metrics_text(df.limit(0), ["n"]).collect() == []


def log_rows(seed, runs=3, n=40):
    rng = random.Random(seed)
    return [
        (f"r{rng.randrange(runs)}", rng.choice([None, None, 100 + i]), 1_000 + 7 * i, i, rng.random() if rng.random() < 0.9 else None)
        for i in range(n)
    ]


APPENDED = "run string, step bigint, at bigint, i bigint, loss double"


def appended(spark, rows):
    return spark.createDataFrame(rows, APPENDED).withColumn("ts", F.timestamp_seconds("at")).drop("at")


def logged(df):
    return sorted((r.run, r.step, r.timestamp, r.elapsed_seconds, r.loss or -1.0) for r in df.collect())


def test_two_appends_give_the_rows_of_one(spark):
    rows = log_rows(1)
    whole = logged(metrics.log_entries(appended(spark, rows), ["i"]).drop("i"))
    known, parts = spark.createDataFrame([], metrics.LOG_STATE_SCHEMA), []
    for part in (rows[:11], rows[11:12], rows[12:]):
        df = appended(spark, part)
        parts += logged(metrics.log_entries(df, ["i"], known=known).drop("i"))
        known = metrics.log_state(df, known).cache()
    assert sorted(parts) == whole
    counts = {r.run: r.counted for r in known.collect()}
    assert counts == {run: sum(r[0] == run and r[1] is None for r in rows) for run in {r[0] for r in rows}}
    # Without a step column every row is counted.
    a, b = (appended(spark, part).drop("step") for part in (rows[:20], rows[20:]))
    first = metrics.log_state(a, spark.createDataFrame([], metrics.LOG_STATE_SCHEMA))
    both = logged(metrics.log_entries(a, ["i"]).drop("i")) + logged(metrics.log_entries(b, ["i"], known=first).drop("i"))
    assert sorted(both) == logged(metrics.log_entries(appended(spark, rows).drop("step"), ["i"]).drop("i"))


def test_a_streaming_append_gives_the_rows_of_one(spark, tmp_path):
    rows = log_rows(2)
    source, path, state = str(tmp_path / "arriving"), str(tmp_path / "log"), tmp_path / "state"
    for part in (rows[:9], rows[9:30], rows[30:]):
        appended(spark, part).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(appended(spark, rows).schema).parquet(source)
        append_log(stream, path, str(state), ["i"], drop=["i"]).awaitTermination()
    want = logged(metrics.log_entries(appended(spark, rows), ["i"]).drop("i"))
    assert logged(metrics.read_metrics(spark, path, ["loss"])) == want
    # The last micro-batch once more: its commit is lost, its rows are replaced.
    last = max((state / "commits").glob("[0-9]*"), key=lambda p: int(p.name))
    last.unlink()
    (last.parent / f".{last.name}.crc").unlink(missing_ok=True)
    append_log(spark.readStream.schema(appended(spark, rows).schema).parquet(source), path, str(state), ["i"], drop=["i"]).awaitTermination()
    assert logged(metrics.read_metrics(spark, path, ["loss"])) == want


def test_total_steps(spark):
    runs = spark.createDataFrame([("r", 10_000_000_000, 48, 2048, 16)], "run string, total_tokens bigint, micro_batch bigint, seq_len bigint, accum bigint")
    row = schedules.total_steps(runs).collect()[0]
    assert (row.tokens_per_step, row.total_steps) == (1_572_864, 6357)
