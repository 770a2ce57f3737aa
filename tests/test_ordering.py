import math
import random

import pytest
from pyspark.sql import functions as F

from corpusflow.operators import joins
from corpusflow.operators.joins import spread_join
from corpusflow.operators.ordering import (
    CHUNK, Running, chunk_by_hash, ordered_position, range_chunks, row_count, running, trailing,
)
from corpusflow.functions.hashing import hash_bits, int_div


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(1)
    # One group holds most rows.
    data = [("hot" if rng.random() < 0.7 else f"g{rng.randint(0, 9)}", i, rng.randint(-50, 50)) for i in range(3000)]
    rng.shuffle(data)
    return data


def frame(spark, rows, parts=5):
    return spark.createDataFrame(rows, "g string, k bigint, v bigint").repartition(parts)


def plain(rows):
    out, state = {}, {}
    for g, k, v in sorted(rows, key=lambda r: r[1]):
        n, total, low = state.get(g, (0, 0, None))
        out[(g, k)] = (n + 1, total + v, total, low)
        state[g] = (n + 1, total + v, v if low is None else min(low, v))
    return out, {g: s[1] for g, s in state.items()}


def outs():
    v = F.col("v")
    return {
        "pos": row_count(), "upto": Running("sum", v), "before": Running("sum", v, exclusive=True),
        "low": Running("min", v, exclusive=True), "total": Running("sum", v, whole=True),
    }


@pytest.mark.parametrize("parts", [1, 4, 32])
def test_running_equals_a_loop_for_any_chunks(spark, rows, parts):
    want, totals = plain(rows)
    got = running(frame(spark, rows, parts + 1), ["g"], ["k"], outs(), parts=parts).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r.pos, r.upto, r.before, r.low) == want[(r.g, r.k)]
        assert r.total == totals[r.g]


@pytest.mark.parametrize("stage", [True, False])
def test_running_with_chunks_from_the_order(spark, rows, stage):
    want, _ = plain(rows)
    df = frame(spark, rows)
    got = running(df, ["g"], ["k"], outs(), chunk=int_div(F.col("k"), 100), stage=stage).collect()
    assert {(r.g, r.k): (r.pos, r.upto, r.before, r.low) for r in got} == want


def test_null_groups_are_an_error(spark):
    df = spark.createDataFrame([(None, i, 1) for i in range(50)], "g string, k bigint, v bigint")
    for chunk in (None, int_div(F.col("k"), 7)):
        with pytest.raises(Exception, match="g is null"):
            ordered_position(df, ["g"], ["k"], chunk=chunk).collect()


def test_carrying_totals_moves_no_rows(spark, rows):
    """The rows are shuffled once for the window; chained scans over the same chunks stay in place."""
    chunked = range_chunks(frame(spark, rows), ["g", "k"], 4)
    once = running(chunked, ["g"], ["k"], {"pos": row_count()}, chunk=F.col(CHUNK), stage=False)
    twice = running(once, ["g"], ["k"], {"low": Running("min", F.col("v"))}, chunk=F.col(CHUNK), stage=False)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = twice._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "coalesce(g" not in plan
    left = plan.split("SortMergeJoin")[1]
    assert "SortMergeJoin" in plan and "Exchange" not in left.split("Window")[0]


def test_hash_chunks_follow_the_hash_order(spark, rows):
    df = frame(spark, rows).withColumn("h", hash_bits(7, "t", F.col("k")))
    placed = ordered_position(df, [], ["h", "k"], chunk=chunk_by_hash(df, F.col("h"))).collect()
    assert [r.k for r in sorted(placed, key=lambda r: r.pos)] == [r.k for r in sorted(placed, key=lambda r: (r.h, r.k))]
    assert sorted(r.pos for r in placed) == list(range(1, len(rows) + 1))


@pytest.mark.parametrize("low,high", [(-9, 0), (-10, -1), (-1, -1), (0, 0)])
@pytest.mark.parametrize("block", [1, 16, 10_000])
def test_trailing_equals_a_loop(spark, rows, low, high, block):
    placed = ordered_position(frame(spark, rows), ["g"], ["k"], "pos", parts=6)
    got = trailing(placed, ["g"], "pos", (low, high), {"m": F.avg("v"), "n": F.count("v")}, block).collect()
    groups = {}
    for g, k, v in sorted(rows, key=lambda r: r[1]):
        groups.setdefault(g, []).append(v)
    assert len(got) == len(rows)
    for r in got:
        i = r.pos - 1
        window = groups[r.g][max(0, i + low): max(0, i + high + 1)]
        assert r.n == len(window)
        assert (r.m is None and not window) or math.isclose(r.m, sum(window) / len(window))


def test_row_data_never_meets_an_unpartitioned_window(spark, rows):
    placed = running(frame(spark, rows), [], ["k"], {"pos": row_count()}, chunk=int_div(F.col("k"), 100))
    plan = placed._jdf.queryExecution().executedPlan().toString()
    single = [line for line in plan.splitlines() if "SinglePartition" in line]
    # Only the chunk totals, never the rows, pass through one task.
    assert len(single) <= 1
    with pytest.raises(ValueError):
        trailing(placed, [], "pos", (-1, 1), {"m": F.avg("v")})


def test_spread_join_equals_a_join(spark, rows):
    facts = frame(spark, rows)
    dim = spark.createDataFrame([("hot", 1), ("g1", 2), ("other", 3)], "g string, x int")
    for how in ("inner", "left"):
        got = spread_join(facts, dim, "g", ["k"], how, salts=3)
        assert sorted(map(str, got.collect())) == sorted(map(str, facts.join(dim, "g", how).collect()))
    with pytest.raises(ValueError):
        spread_join(facts, dim, "g", ["k"], "full")


def test_a_heavy_key_is_spread_by_its_share(spark):
    rows = [("half" if i % 2 else f"k{i % 40}", i) for i in range(4000)] + [(None, -1)]
    facts = spark.createDataFrame(rows, "run string, i long").repartition(5)
    runs = spark.createDataFrame([("half", 1)] + [(f"k{i}", 2) for i in range(0, 38)] + [("absent", 3)], "run string, x int")
    heavy = {r.run: r._salts for r in joins.heavy_keys(facts, "run", 12).collect()}
    # Half of all rows gets half of the partitions; no other key is repeated.
    assert heavy == {"half": 6}
    spread = facts.sparkSession.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        inner = joins.spread_join(facts, runs, "run", ["i"])
        assert sorted(inner.collect()) == sorted(facts.join(runs, "run").collect())
        left = joins.spread_join(facts, runs, "run", ["i"], "left", weigh=facts.select("run"))
        key = lambda r: (str(r.run), r.i)
        assert sorted(left.collect(), key=key) == sorted(facts.join(runs, "run", "left").collect(), key=key)
        plan = joins.spread_join(facts, runs, "run", ["i"])._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and plan.count("BroadcastHashJoin") == 2
        assert joins.spread_join(facts.limit(0), runs, "run", ["i"]).collect() == []
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert spread == spark.conf.get("spark.sql.shuffle.partitions")
    with pytest.raises(ValueError):
        joins.spread_join(facts, runs, "run", ["i"], "full")
