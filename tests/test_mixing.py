import random

import pytest
from pyspark.sql import functions as F

from corpusflow.operators import mixing
from corpusflow.operators.mixing import Domain

SCHEMA = "doc_id bigint, domain string, source string, n_tokens bigint, has_text boolean"
DOMAINS = (Domain("web", 0.87, (("w1", 2.0), ("w2", 1.0))), Domain("code", 0.10, (("c1", 1.0),)), Domain("math", 0.03, (("m1", 5.0),)))
SOURCE_DOMAIN = {"w1": "web", "w2": "web", "c1": "code", "m1": "math"}


def make(n, seed=5):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        source = rng.choice(["w1", "w1", "w2", "w2", "c1", "m1"])
        out.append((i, SOURCE_DOMAIN[source], source, rng.randint(1, 30), rng.random() > 0.05))
    return out


def order(df, column="mix_pos"):
    return [r.doc_id for r in sorted(df.collect(), key=lambda r: r[column])]


@pytest.fixture(scope="module")
def docs():
    return make(1500)


def mixed(spark, docs, parts, chunk_rows=64, **kwargs):
    df = spark.createDataFrame(docs, SCHEMA).repartition(parts)
    return mixing.mix(df, mixing.mix_config(spark, kwargs.pop("domains", DOMAINS)), 42, 50, chunk_rows=chunk_rows, **kwargs)


def test_order_does_not_depend_on_partitions_or_input_order(spark, docs):
    first = order(mixed(spark, docs, 1, chunk_rows=1 << 20))
    assert first == order(mixed(spark, list(reversed(docs)), 4)) == order(mixed(spark, docs, 32, chunk_rows=7))
    assert len(first) == sum(d[4] for d in docs)


def test_other_seed_other_order(spark, docs):
    df = spark.createDataFrame(docs, SCHEMA)
    config = mixing.mix_config(spark, DOMAINS)
    assert order(mixing.mix(df, config, 1, 50)) != order(mixing.mix(df, config, 2, 50))


def test_shares_follow_the_weights(spark):
    docs = [(i, "web" if i % 3 == 0 else "code" if i % 3 == 1 else "math", {0: "w1", 1: "c1", 2: "m1"}[i % 3], 1, True)
            for i in range(9000)]
    domains = (Domain("web", 60, (("w1", 1.0),)), Domain("code", 30, (("c1", 1.0),)), Domain("math", 10, (("m1", 1.0),)))
    df = mixing.mix(spark.createDataFrame(docs, SCHEMA), mixing.mix_config(spark, domains), 42, 100, total_tokens=4000)
    shares = {r.domain: r.n for r in df.groupBy("domain").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert sum(shares.values()) == 4000
    assert abs(shares["web"] - 2400) < 150 and abs(shares["code"] - 1200) < 150 and abs(shares["math"] - 400) < 100


def test_exhausted_domains_drop_out(spark, docs):
    everything = mixed(spark, docs, 3).collect()
    assert {r.domain for r in everything} == {"web", "code", "math"}
    assert sorted(r.mix_pos for r in everything) == list(range(1, len(everything) + 1))


def test_weight_zero_is_never_drawn(spark, docs):
    domains = (Domain("web", 1.0, (("w1", 1.0), ("w2", 0.0))), Domain("code", 0.0, (("c1", 1.0),)))
    got = mixed(spark, docs, 3, domains=domains).collect()
    assert {r.source for r in got} == {"w1"}


@pytest.mark.parametrize("budget,kept", [(8, 2), (9, 3), (0, 3), (None, 3), (1, 1), (4, 1), (5, 2)])
def test_budget_edges(spark, budget, kept):
    docs = [(i, "web", "w1", 4, True) for i in range(3)]
    domain = (Domain("web", 1.0, (("w1", 1.0),), max_tokens=budget),)
    df = spark.createDataFrame(docs, SCHEMA)
    assert mixing.mix(df, mixing.mix_config(spark, domain), 42, 10).count() == kept
    plain = (Domain("web", 1.0, (("w1", 1.0),)),)
    assert mixing.mix(df, mixing.mix_config(spark, plain), 42, 10, total_tokens=budget).count() == kept
    raced = mixing.interleave_sources(df, mixing.mix_config(spark, domain), 42)
    assert mixing.domain_budget(raced, chunk_rows=1).count() == kept


def test_budgets_equal_a_loop(spark, docs):
    domains = (Domain("web", 0.87, DOMAINS[0].sources, max_tokens=4000), *DOMAINS[1:])
    free = [(r.doc_id, r.domain, r.n_tokens) for r in sorted(mixed(spark, docs, 3).collect(), key=lambda r: r.mix_pos)]
    want, spent, total = [], {}, 0
    for doc, domain, n in free:
        if domain == "web" and spent.get("web", 0) >= 4000:
            continue
        if total >= 6000:
            break
        spent[domain] = spent.get(domain, 0) + n
        total += n
        want.append(doc)
    assert order(mixed(spark, docs, 5, domains=domains, total_tokens=6000)) == want


def test_resume_is_the_rest_of_the_uninterrupted_order(spark, docs):
    whole = mixed(spark, docs, 3)
    full = order(whole)
    ledger = mixing.mix_ledger(mixing.total_budget(whole, 5000))
    rest = order(mixing.resume_after(whole, ledger))
    assert 0 < len(rest) < len(full) and full[-len(rest):] == rest
    empty = ledger.where("false")
    assert order(mixing.resume_after(whole, empty)) == full


def test_block_shuffle_stays_in_its_block(spark, docs):
    df = spark.createDataFrame(docs, SCHEMA)
    raced = mixing.interleave_sources(df, mixing.mix_config(spark, DOMAINS), 42, chunk_rows=32)
    before = {r.doc_id: r.pos for r in raced.collect()}
    after = {r.doc_id: (r.domain, r.pos) for r in mixing.block_shuffle(raced, 50, 42).collect()}
    assert all((before[d] - 1) // 50 == (p - 1) // 50 for d, (_, p) in after.items())
    assert any(before[d] != p for d, (_, p) in after.items())
    by_domain = {}
    for domain, p in after.values():
        by_domain.setdefault(domain, []).append(p)
    assert all(sorted(ps) == list(range(1, len(ps) + 1)) for ps in by_domain.values())


def test_epochs_and_draws(spark):
    df = spark.range(200).withColumnRenamed("id", "doc_id")
    shuffled = mixing.epochs(df, 3, 42, "doc_id").collect()
    orders = [[r.doc_id for r in sorted((r for r in shuffled if r.epoch == e), key=lambda r: r.epoch_pos)] for e in range(3)]
    assert all(sorted(o) == list(range(200)) for o in orders) and orders[0] != orders[1] != orders[2]
    drawn = mixing.categorical_draw([("a", 3.0), ("b", 1.0)], 42, F.col("doc_id"))
    counts = {r.d: r["count"] for r in spark.range(4000).withColumnRenamed("id", "doc_id").select(drawn.alias("d")).groupBy("d").count().collect()}
    assert abs(counts["a"] - 3000) < 150 and counts["a"] + counts["b"] == 4000


def test_normalised_weights(spark):
    got = {(r.domain, r.source): r.source_weight for r in mixing.normalize_weights(mixing.mix_config(spark, DOMAINS)).collect()}
    assert got[("web", "w1")] == pytest.approx(2 / 3) and got[("math", "m1")] == 1.0
