"""Queries over responses, token scores and candidates."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusflow.functions import rewards as rw
from corpusflow.functions import text as tx
from corpusflow.operators import candidates, evaluation, rewards, selection, tokens
from corpusflow.plans import bindings as b
from corpusflow.plans.corpus import _HEADS
from corpusflow.plans.registry import query
from corpusflow.plans.sequences import SQL_SLOTS, joined, spans_sql

_RESPONSES = f"WITH {b.SQL_RESPONSES}"


@query(
    "v1_question_prompt",
    rf"""{_RESPONSES}
SELECT response_id, 'Question: ' || question || E'\n\nAnswer: Let me solve this step by step.\n' AS prompt FROM responses""",
)
def question_prompt(spark, sf):
    return b.responses(spark, sf).select("response_id", tx.question_prompt(F.col("question")).alias("prompt"))


@query("v2_marked_answer", f"{_RESPONSES} SELECT response_id, marked FROM checked")
def marked_answer(spark, sf):
    return b.responses(spark, sf).select("response_id", rw.marked_answer(F.col("response")).alias("marked"))


@query("v3_last_number", f"{_RESPONSES} SELECT response_id, last_seen, coalesce(marked, last_seen) AS predicted FROM checked")
def last_number(spark, sf):
    return b.responses(spark, sf).select(
        "response_id", rw.last_number(F.col("response")).alias("last_seen"),
        rw.prediction(F.col("response")).alias("predicted"),
    )


@query("v4_clean_answer", f"{_RESPONSES} SELECT response_id, cleaned FROM checked")
def clean_answer(spark, sf):
    return b.responses(spark, sf).select("response_id", rw.clean_answer(F.col("answer")).alias("cleaned"))


def _rewarded(spark, sf):
    return b.responses(spark, sf).withColumn("reward", rw.math_reward(F.col("response"), F.col("answer")))


@query("v5_math_reward", f"{_RESPONSES} SELECT response_id, reward FROM rewarded")
def math_reward(spark, sf):
    return _rewarded(spark, sf).select("response_id", "reward")


_PROMPTS = f"""{_RESPONSES},
prompts AS (
  SELECT prompt_id, avg(reward) AS avg_reward, count(*) FILTER (reward > 0) AS num_correct, count(*) AS responses
  FROM rewarded GROUP BY prompt_id)"""


@query("v6_prompt_rewards", f"{_PROMPTS} SELECT * FROM prompts")
def prompt_rewards(spark, sf):
    return rewards.prompt_rewards(_rewarded(spark, sf))


@query(
    "v7_trailing_reward",
    f"""{_PROMPTS}
SELECT prompt_id, round(avg(avg_reward) OVER (ORDER BY prompt_id ROWS 99 PRECEDING) + 3.14159e-8, 6) AS avg_reward_recent FROM prompts""",
)
def trailing_reward(spark, sf):
    recent = rewards.trailing_reward(rewards.prompt_rewards(_rewarded(spark, sf)))
    return recent.select("prompt_id", b.near("avg_reward_recent").alias("avg_reward_recent"))


@query("v8_positive_weights", f"{_RESPONSES} SELECT response_id, reward - 0.5::DOUBLE AS weight FROM rewarded WHERE reward > 0")
def positive_weights(spark, sf):
    return rewards.positive_weights(_rewarded(spark, sf)).select("response_id", "weight")


@query("v9_overall_reward", f"{_PROMPTS} SELECT round(coalesce(avg(avg_reward), 0.0) + 3.14159e-8, 6) AS avg_reward FROM prompts")
def overall_reward(spark, sf):
    overall = rewards.overall_reward(rewards.prompt_rewards(_rewarded(spark, sf)))
    return overall.select(b.near("avg_reward").alias("avg_reward"))


@query(
    "v10_strip_prompt",
    f"{_RESPONSES} SELECT response_id, response AS stripped, coalesce(marked, last_seen) AS predicted FROM checked",
)
def strip_prompt(spark, sf):
    whole = b.responses(spark, sf)
    stripped = rw.strip_prompt(F.col("completion"), tx.question_prompt(F.col("question")))
    return whole.select("response_id", stripped.alias("stripped"), rw.prediction(stripped).alias("predicted"))


# ------------------------------------------------------------------ evaluation

_LOSSES = f"""WITH {b.SQL_LINES},
batches AS (
  SELECT domain, batch_id, -avg(logp) FILTER (label <> -100 AND pos > 0) AS loss, count(*) FILTER (label <> -100) AS n_labels
  FROM logps GROUP BY domain, batch_id)"""
_DOMAINS = f"""{_LOSSES},
domains AS (
  SELECT coalesce(domain, '*') AS domain, CAST(sum(n_labels) AS BIGINT) AS n_labels, sum(loss * n_labels) / sum(n_labels) AS loss
  FROM batches GROUP BY ROLLUP (domain))"""


def _domains(spark, sf):
    return evaluation.domain_loss(evaluation.batch_loss(b.token_logps(spark, sf)))


@query("e1_batch_loss", f"{_LOSSES} SELECT domain, batch_id, round(loss + 3.14159e-8, 6) AS loss, n_labels FROM batches")
def batch_loss(spark, sf):
    return evaluation.batch_loss(b.token_logps(spark, sf)).withColumn("loss", b.near("loss"))


@query("e2_domain_loss", f"{_DOMAINS} SELECT domain, n_labels, round(loss + 3.14159e-8, 6) AS loss FROM domains WHERE domain <> '*'")
def domain_loss(spark, sf):
    losses = _domains(spark, sf).where(F.col("domain") != evaluation.OVERALL)
    return losses.select("domain", "n_labels", b.near("loss").alias("loss"))


@query("e3_perplexity", f"{_DOMAINS} SELECT domain, round(exp(loss) + 3.14159e-8, 6) AS ppl FROM domains WHERE domain <> '*'")
def perplexity(spark, sf):
    losses = _domains(spark, sf).where(F.col("domain") != evaluation.OVERALL)
    return losses.select("domain", b.near("ppl").alias("ppl"))


@query(
    "e4_overall",
    f"{_DOMAINS} SELECT domain, n_labels, round(loss + 3.14159e-8, 6) AS loss, round(exp(loss) + 3.14159e-8, 6) AS ppl FROM domains",
)
def overall(spark, sf):
    return _domains(spark, sf).withColumns({"loss": b.near("loss"), "ppl": b.near("ppl")})


@query(
    "e5_domain_cap",
    f"""WITH {b.SQL_CORPUS}
SELECT domain, doc_id FROM (SELECT *, row_number() OVER (PARTITION BY domain ORDER BY doc_id) AS r FROM counted) WHERE r <= 50""",
)
def domain_cap(spark, sf):
    return selection.first_per_domain(b.corpus(spark, sf), 50, "doc_id").select("domain", "doc_id")


_EVAL_BATCHED = f"""
batched AS MATERIALIZED (
  SELECT doc_id, n_tokens, domain || ':' || (i // 4) AS batch_id, i % 4 AS idx FROM (
    SELECT c.doc_id, c.domain, least(c.n_tokens, 2048) AS n_tokens,
           row_number() OVER (PARTITION BY c.domain ORDER BY c.doc_id) - 1 AS i
    FROM heads h JOIN counted c ON h.doc_id = c.doc_id WHERE c.has_text AND least(c.n_tokens, 2048) > 100)),"""


@query(
    "e6_eval_batches",
    f"""WITH RECURSIVE {_HEADS.split('WITH', 1)[1]}, {b.SQL_IDS}, {spans_sql(_EVAL_BATCHED)}, {SQL_SLOTS}
SELECT batch_id, seq_idx, string_agg(input_id, ' ' ORDER BY p) AS input_ids, string_agg(label, ' ' ORDER BY p) AS labels
FROM slots GROUP BY batch_id, seq_idx""",
)
def eval_batches(spark, sf):
    sample = selection.head_sample(b.corpus(spark, sf)).where(tx.non_empty(F.col("text")))
    ids = tokens.encode(sample, b.vocabulary(spark, sf), max_length=2048)
    long = selection.longer_than(ids.withColumn("n_tokens", F.size("ids")))
    packed = evaluation.eval_batches(long, b.SEQ_LEN, tokens.EOS_ID, tokens.PAD_ID)
    return packed.select("batch_id", "seq_idx", joined("input_ids"), joined("labels"))


@query(
    "e7_result_metrics",
    f"""{_DOMAINS}
SELECT CASE WHEN domain = '*' THEN '' ELSE domain || '_' END || 'val_loss' AS name, round(loss + 3.14159e-8, 6) AS value FROM domains
UNION ALL
SELECT CASE WHEN domain = '*' THEN '' ELSE domain || '_' END || 'val_ppl', round(exp(loss) + 3.14159e-8, 6) FROM domains""",
)
def result_metrics(spark, sf):
    return evaluation.result_metrics(_domains(spark, sf)).withColumn("value", b.near("value"))


# ------------------------------------------------------------------ candidates

_CAND = f"WITH {b.SQL_LINES}"
_SOFT = """
soft AS (
  SELECT query_id, token_id, logit, exp(logit / 0.7 - max(logit / 0.7) OVER (PARTITION BY query_id)) AS e FROM cand)"""


@query(
    "g1_softmax",
    f"{_CAND}, {_SOFT} SELECT query_id, token_id, round(e / sum(e) OVER (PARTITION BY query_id) + 3.14159e-8, 6) AS prob FROM soft",
)
def softmax(spark, sf):
    probs = candidates.softmax(b.candidates(spark, sf), 0.7)
    return probs.select("query_id", "token_id", b.near("prob").alias("prob"))


@query(
    "g2_top_k",
    f"""{_CAND}
SELECT query_id, token_id FROM (SELECT *, rank() OVER (PARTITION BY query_id ORDER BY logit DESC) AS r FROM cand) WHERE r <= 3""",
)
def top_k(spark, sf):
    return candidates.top_k(b.candidates(spark, sf), 3).select("query_id", "token_id")


@query(
    "g3_top_p",
    f"""{_CAND},
e AS (SELECT *, exp(logit - max(logit) OVER (PARTITION BY query_id)) AS e FROM cand),
c AS (
  SELECT *, coalesce(sum(e) OVER (PARTITION BY query_id ORDER BY logit DESC, token_id
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
         sum(e) OVER (PARTITION BY query_id) AS mass
  FROM e)
SELECT query_id, token_id FROM c WHERE before / mass <= 0.9""",
)
def top_p(spark, sf):
    return candidates.top_p(b.candidates(spark, sf), 0.9).select("query_id", "token_id")


_TRUNCATED = f"""{_CAND}, {_SOFT},
ranked AS (SELECT *, rank() OVER (PARTITION BY query_id ORDER BY logit DESC) AS r FROM soft),
k AS (
  SELECT *, coalesce(sum(e) OVER (PARTITION BY query_id ORDER BY logit DESC, token_id
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
         sum(e) OVER (PARTITION BY query_id) AS mass
  FROM ranked WHERE r <= 5),
kept AS (
  SELECT query_id, token_id, e / sum(e) OVER (PARTITION BY query_id) AS prob FROM k WHERE before / mass <= 0.8)"""


@query("g3_truncate", f"{_TRUNCATED} SELECT query_id, token_id, round(prob + 3.14159e-8, 6) AS prob FROM kept")
def truncate(spark, sf):
    kept = candidates.truncate(b.candidates(spark, sf), 0.7, 5, 0.8)
    return kept.select("query_id", "token_id", b.near("prob").alias("prob"))


@query(
    "g4_greedy",
    f"""{_CAND}
SELECT query_id, token_id FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY logit DESC, token_id) AS r FROM cand) WHERE r = 1""",
)
def greedy(spark, sf):
    return candidates.greedy(b.candidates(spark, sf))


@query(
    "g5_sample",
    f"""{_TRUNCATED}
SELECT query_id, token_id FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id
            ORDER BY ln(prob) - ln(-ln({b.hu('gumbel', 'query_id', 'token_id')})) DESC, token_id) AS r
  FROM kept) WHERE r = 1""",
)
def sample(spark, sf):
    kept = candidates.truncate(b.candidates(spark, sf), 0.7, 5, 0.8)
    return candidates.sample(kept, b.SEED)
