import math
import random

import pytest
from pyspark.sql import functions as F

from corpusflow.functions import rewards as rw
from corpusflow.operators import candidates, evaluation, rewards, selection

# (response, answer, reward)
CASES = [
    ("so #### -1,000.5", "-1000.50", 1.0), ("first 3, then 42.", "42", 1.0), ("no idea", "42", 0.0), ("3-4", "-4", 1.0),
    ("#### 5", "2+3=5 #### 5", 0.0), ("#### 5", "1-2", 0.0), ("#### 5", "", 0.0), ("#### 5", "5.", 1.0),
    ("#### x, then 7", "7", 1.0), ("#### 5 or #### 6", "5", 1.0), ("1,234,567", "$1,234,567", 1.0), ("", "1", 0.0),
]


def test_rewards_golden(spark):
    df = spark.createDataFrame(CASES, "response string, answer string, want double")
    got = df.withColumn("got", rw.math_reward(F.col("response"), F.col("answer"))).collect()
    assert [(r.response, r.got) for r in got] == [(r.response, r.want) for r in got]
    fixed = df.where("answer like '2+3%'").select(rw.math_reward(F.col("response"), F.col("answer"), marked_first=True).alias("r"))
    assert fixed.collect()[0].r == 1.0


def test_strip_prompt(spark):
    df = spark.createDataFrame([("Q: 7? it is 8 \n", "Q: 7?")], "completion string, prompt string")
    row = df.select(rw.strip_prompt(F.col("completion"), F.col("prompt")).alias("s")).collect()[0]
    assert row.s == "it is 8"
    assert df.select(rw.prediction(F.lit("Q: 7?")).alias("p")).collect()[0].p == "7"


def test_prompt_averages(spark):
    rows = [(p, float((p * 7 + i) % 3 == 0)) for p in range(250) for i in range(4)]
    df = spark.createDataFrame(rows, "prompt_id bigint, reward double").repartition(3)
    prompts = rewards.prompt_rewards(df)
    means = {r.prompt_id: r.avg_reward for r in prompts.collect()}
    for r in rewards.trailing_reward(prompts, 100).collect():
        window = [means[p] for p in range(max(0, r.prompt_id - 99), r.prompt_id + 1)]
        assert r.avg_reward_recent == pytest.approx(sum(window) / len(window))
    assert rewards.overall_reward(prompts).collect()[0].avg_reward == pytest.approx(sum(means.values()) / 250)
    assert rewards.overall_reward(prompts.where("false")).collect()[0].avg_reward == 0.0
    assert {r.weight for r in rewards.positive_weights(df).collect()} == {0.5}


def test_losses(spark):
    rows = [
        ("a", 0, 0, 0, 5, -1.0), ("a", 0, 0, 1, 6, -2.0), ("a", 0, 0, 2, -100, -9.0),
        ("a", 1, 1, 0, 5, -1.0), ("a", 1, 1, 1, 6, -4.0), ("a", 1, 1, 2, 7, -6.0),
        ("b", 0, 2, 0, 5, -1.0), ("b", 0, 2, 1, 5, -3.0), ("c", 0, 3, 0, -100, -1.0), ("d", 0, 4, 1, -100, -1.0),
    ]
    df = spark.createDataFrame(rows, "domain string, batch_id int, seq_id int, pos int, label int, logp double")
    batches = evaluation.batch_loss(df.where("domain in ('a', 'b')"))
    got = {r.domain: r for r in evaluation.domain_loss(batches).collect()}
    assert got["a"].loss == pytest.approx((2.0 * 2 + 5.0 * 3) / 5) and got["a"].ppl == pytest.approx(math.exp(3.8))
    assert got["*"].loss == pytest.approx((19 + 6) / 7) and got["*"].n_labels == 7
    names = {r.name for r in evaluation.result_metrics(evaluation.domain_loss(batches)).collect()}
    assert names == {"a_val_loss", "a_val_ppl", "b_val_loss", "b_val_ppl", "val_loss", "val_ppl"}
    only_empty = evaluation.batch_loss(df.where("domain = 'c'")).collect()[0]
    assert math.isnan(only_empty.loss) and only_empty.n_labels == 0
    assert evaluation.domain_loss(evaluation.batch_loss(df.where("domain = 'c'"))).count() == 0


def test_head_sample(spark):
    rows = [(i, "web" if i % 2 else "code") for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id bigint, domain string").repartition(3)
    samples = {"web": selection.HeadSample(100, 25), "code": selection.HeadSample(1000, 90)}
    got = {(r.domain, r.doc_id, r.row_index) for r in selection.head_sample(df, samples).collect()}
    assert got == {("web", 2 * i + 1, i) for i in (0, 25, 50, 75)} | {("code", 2 * i, i) for i in (0, 90, 180)}
    plan = selection.heads(df, samples, "doc_id", "domain")._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
    assert selection.first_per_domain(df, 3, "doc_id").count() == 6
    assert selection.first_per_domain(df, 0, "doc_id").count() == 400
    steps = spark.range(0, 100).withColumnRenamed("id", "step")
    assert selection.cadence(steps, 25).count() == 4 and selection.cadence(steps, 25, skip_zero=True).count() == 3


def test_first_rows_of_a_hot_domain(spark):
    rows = [(i * 7 % 5000, "hot") for i in range(5000)] + [(i, "cold") for i in range(3)] + [(9, None)]
    df = spark.createDataFrame(rows, "doc_id bigint, domain string").repartition(6)
    got = selection.first_per_domain(df, 40, "doc_id").collect()
    assert sorted(r.doc_id for r in got if r.domain == "hot") == list(range(40))
    assert sorted(r.doc_id for r in got if r.domain == "cold") == [0, 1, 2] and len(got) == 43
    assert selection.first_per_domain(df.limit(0), 4, "doc_id").collect() == []
    # Parts of a domain are cut before and after their own shuffle, and before the domain's.
    plan = selection.firsts(df, 40, "doc_id", "domain")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 3 and plan.count("Exchange hashpartitioning(domain") == 2


def plain_truncate(logits, temperature, k, p):
    """(token -> prob) from the rules, as a loop."""
    rows = sorted(((l / temperature, -t) for t, l in enumerate(logits)), reverse=True)
    if k > 0:
        cut = rows[min(k, len(rows)) - 1][0]
        rows = [r for r in rows if r[0] >= cut]
    peak = rows[0][0]
    weights = [math.exp(z - peak) for z, _ in rows]
    if p < 1:
        kept, before = [], 0.0
        for row, w in zip(rows, weights):
            if kept and before / sum(weights) > p:
                break
            kept.append((row, w))
            before += w
        rows, weights = [r for r, _ in kept], [w for _, w in kept]
    return {-t: w / sum(weights) for (_, t), w in zip(rows, weights)}


@pytest.fixture(scope="module")
def scored(spark):
    rng = random.Random(4)
    sizes = {q: (400 if q == 0 else rng.randint(1, 12)) for q in range(25)}
    table = {q: [round(rng.uniform(-3, 3), 1) for _ in range(n)] for q, n in sizes.items()}
    rows = [(q, t, l) for q, ls in table.items() for t, l in enumerate(ls)]
    rng.shuffle(rows)
    return table, spark.createDataFrame(rows, "query_id bigint, token_id bigint, logit double")


@pytest.mark.parametrize("temperature,k,p,parts", [(1.0, 50, 0.9, 1), (0.7, 3, 0.8, 7), (1.0, 0, 0.35, 7), (2.0, 5, 1.0, 7), (1.0, 0, 1.0, 3)])
def test_truncate_equals_a_loop(scored, temperature, k, p, parts):
    table, df = scored
    got = {}
    for r in candidates.truncate(df, temperature, k, p, parts).collect():
        got.setdefault(r.query_id, {})[r.token_id] = r.prob
    for q, logits in table.items():
        assert got[q] == pytest.approx(plain_truncate(logits, temperature, k, p))


@pytest.mark.parametrize("p", [0.0, 0.2, 0.6, 0.95, 0.999999])
def test_nucleus_of_bins_equals_a_loop(spark, monkeypatch, p):
    rng = random.Random(6)
    monkeypatch.setattr(candidates, "LAST_BIN", 40)
    # Ties over a whole query, far tails beyond the last bin, one candidate.
    table = {0: [1.5] * 60, 1: [rng.choice([0.0, -1.0, -90.0]) for _ in range(50)], 2: [2.0], 3: [rng.gauss(0, 2) for _ in range(300)]}
    df = spark.createDataFrame([(q, t, l) for q, ls in table.items() for t, l in enumerate(ls)], "query_id bigint, token_id bigint, logit double")
    got = {}
    for r in candidates.top_p(df.repartition(5), p, parts=6).collect():
        got.setdefault(r.query_id, set()).add(r.token_id)
    probs = {}
    for r in candidates.truncate(df, 1.0, 0, p).collect():
        probs.setdefault(r.query_id, {})[r.token_id] = r.prob
    for q, logits in table.items():
        want = plain_truncate(logits, 1.0, 0, p)
        assert got[q] == set(want) and probs[q] == pytest.approx(want)
    assert candidates.top_p(df.limit(0), p).collect() == []


def test_a_nucleus_orders_candidates_near_its_cut_alone(spark, scored, monkeypatch):
    seen = []
    real = candidates.range_chunks
    monkeypatch.setattr(candidates, "range_chunks", lambda df, *a: seen.append(df.count()) or real(df, *a))
    table, df = scored
    assert candidates.top_p(df, 0.35, 7).count() > 0
    assert 0 < seen[0] < df.count() / 3


def test_candidate_golden(spark):
    df = spark.createDataFrame([(1, i, l) for i, l in enumerate([5.0, 4.0, 4.0, 1.0, 0.0])], "query_id int, token_id int, logit double")
    assert sorted(r.token_id for r in candidates.top_k(df, 2).collect()) == [0, 1, 2]
    three = candidates.top_k(df, 2)
    probs = {r.token_id: r.prob for r in candidates.softmax(three).collect()}
    assert probs == pytest.approx({0: 0.576117, 1: 0.211942, 2: 0.211942}, abs=1e-6)
    assert sorted(r.token_id for r in candidates.top_p(three, 0.6).collect()) == [0, 1]
    assert candidates.top_k(df, 0).count() == 5 and candidates.top_p(df, 1.0).count() == 5
    assert candidates.top_p(df, 0.0).collect()[0].token_id == 0
    assert candidates.greedy(df.where("token_id > 0")).collect()[0].token_id == 1
    with pytest.raises(ValueError):
        candidates.ranked(df, 0.0)


def test_sampling_follows_the_probabilities(spark):
    df = spark.range(3000).select(
        F.col("id").alias("query_id"), F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))).alias("token_id")
    ).withColumn("prob", F.element_at(F.array(F.lit(0.6), F.lit(0.3), F.lit(0.1)), F.col("token_id") + 1))
    counts = {r.token_id: r["count"] for r in candidates.sample(df, 42).groupBy("token_id").count().collect()}
    assert abs(counts[0] - 1800) < 120 and abs(counts[1] - 900) < 120 and abs(counts[2] - 300) < 80


def test_candidates_without_a_logit_are_left_out(spark):
    rows = spark.createDataFrame([(1, 1, 2.0), (1, 2, None), (1, 3, 1.0), (1, 4, 0.0)], "query_id long, token_id long, logit double")
    assert sorted(r[1] for r in candidates.top_k(rows, 2).collect()) == [1, 3]


def test_the_limit_on_candidates_stands_before_the_shuffle(spark, scored):
    plan = candidates.top_k(scored[1], 3)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2 and plan.count("Exchange hashpartitioning") == 1
    assert plan.rindex("WindowGroupLimit") > plan.index("Exchange hashpartitioning")
