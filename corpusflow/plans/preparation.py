"""Queries over conversations: fine-tuning and preference data."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusflow.functions import text as tx
from corpusflow.operators import preference, sft, tokens
from corpusflow.plans import bindings as b
from corpusflow.plans.registry import query
from corpusflow.plans.sequences import joined


def _messages(turns):
    said = F.struct("turn", "role", F.col("text").alias("content"))
    listed = F.array_sort(F.collect_list(said))
    return turns.groupBy("conv_id").agg(
        F.transform(listed, lambda m: F.struct(m["role"].alias("role"), m["content"].alias("content"))).alias("messages")
    )


_INSTRUCTION = r"'### Instruction:' || E'\n' || prompt || E'\n\n' || '### Response:' || E'\n' || first_reply"


@query(
    "f1_format_dispatch",
    f"""WITH {b.SQL_TURNS}, {b.SQL_CHATS}
SELECT 'text' AS format, conv_id, md5(prompt) AS text_md5 FROM turns
UNION ALL SELECT 'messages', conv_id, md5(text) FROM chats
UNION ALL SELECT 'instruction', conv_id, md5({_INSTRUCTION}) FROM turns
UNION ALL SELECT 'other', conv_id, md5(CAST(conv_id AS VARCHAR)) FROM turns""",
)
def format_dispatch(spark, sf):
    turns = b.first_turns(spark, sf)
    frames = {
        "text": turns.select("conv_id", F.col("prompt").alias("text")),
        "messages": _messages(b.table(spark, sf, "conversations")),
        "instruction": turns.select(
            "conv_id", F.col("prompt").alias("instruction"), F.col("first_reply").alias("response")
        ),
        "other": turns.select("conv_id", "last_reply"),
    }
    out = None
    for name, frame in frames.items():
        part = sft.format_examples(frame).select(F.lit(name).alias("format"), "conv_id", F.md5("text").alias("text_md5"))
        out = part if out is None else out.unionByName(part)
    return out


@query("f2_chat_template", f"WITH {b.SQL_CHATS} SELECT conv_id, text FROM chats")
def chat_template(spark, sf):
    return sft.chat_template(b.table(spark, sf, "conversations"))


@query("f3_instruction", f"WITH {b.SQL_TURNS} SELECT conv_id, {_INSTRUCTION} AS text FROM turns")
def instruction(spark, sf):
    turns = b.first_turns(spark, sf).select(
        "conv_id", F.col("prompt").alias("instruction"), F.col("first_reply").alias("response")
    )
    return sft.format_examples(turns).select("conv_id", "text")


@query("f4_fallback", "SELECT DISTINCT conv_id, CAST(conv_id AS VARCHAR) AS text FROM conversations")
def fallback(spark, sf):
    return sft.format_examples(b.first_turns(spark, sf).select("conv_id", "last_reply")).select("conv_id", "text")


@query(
    "f5_masked_labels",
    f"""WITH {b.SQL_CHATS}, {b.padded_sql('chats', 'conv_id')}
SELECT conv_id, string_agg(id, ' ' ORDER BY idx) AS input_ids, string_agg(m, ' ' ORDER BY idx) AS attention_mask,
       string_agg(CASE WHEN m = 0 THEN -100 ELSE id END, ' ' ORDER BY idx) AS labels
FROM filled GROUP BY conv_id""",
)
def masked_labels(spark, sf):
    turns = b.table(spark, sf, "conversations")
    lines = turns.select(tx.chat_line(F.col("role"), F.col("text")).alias("text"))
    ready = sft.prepare_chats(turns, tokens.build_vocab(lines, b.VOCAB_SIZE), b.SEQ_LEN)
    return ready.select("conv_id", joined("input_ids"), joined("attention_mask"), joined("labels"))


@query(
    "f6_step_budget",
    """WITH n AS (SELECT count(DISTINCT conv_id) AS examples FROM conversations),
s AS (SELECT examples, CAST(ceil(examples / 4) AS BIGINT) AS batches FROM n)
SELECT examples, batches, batches * 3 // 4 AS total_steps, CAST(floor((batches * 3 // 4) * 0.03::DOUBLE) AS BIGINT) AS warmup_steps
FROM s""",
)
def step_budget(spark, sf):
    chats = b.table(spark, sf, "conversations").select("conv_id").distinct()
    return sft.step_budget(chats, batch_size=4, epochs=3, accum=4, warmup_ratio=0.03)


@query(
    "r1_pair_formats",
    f"""WITH {b.SQL_TURNS}
SELECT 'pair' AS format, conv_id, md5(first_reply) AS chosen_md5, md5(last_reply) AS rejected_md5 FROM turns
UNION ALL SELECT 'prompted', conv_id, md5(prompt || first_reply), md5(prompt || last_reply) FROM turns
UNION ALL SELECT 'unprompted', conv_id, md5(first_reply), md5(last_reply) FROM turns""",
)
def pair_formats(spark, sf):
    turns = b.first_turns(spark, sf)
    chosen, rejected = F.col("first_reply"), F.col("last_reply")
    frames = {
        "pair": turns.select("conv_id", chosen.alias("chosen"), rejected.alias("rejected")),
        "prompted": turns.select(
            "conv_id", "prompt", chosen.alias("chosen_response"), rejected.alias("rejected_response")
        ),
        "unprompted": turns.select("conv_id", chosen.alias("chosen_response"), rejected.alias("rejected_response")),
    }
    out = None
    for name, frame in frames.items():
        part = preference.format_pairs(frame).select(
            F.lit(name).alias("format"), "conv_id", F.md5("chosen").alias("chosen_md5"),
            F.md5("rejected").alias("rejected_md5"),
        )
        out = part if out is None else out.unionByName(part)
    return out


def _chat_pairs(spark, sf):
    message = lambda role, text: F.struct(F.lit(role).alias("role"), F.col(text).alias("content"))
    return b.first_turns(spark, sf).select(
        "conv_id",
        F.array(message("user", "prompt"), message("assistant", "first_reply")).alias("chosen"),
        F.array(message("user", "prompt"), message("assistant", "last_reply")).alias("rejected"),
    )


@query(
    "r2_chat_pairs",
    f"""WITH {b.SQL_TURNS}
SELECT conv_id, prompt || ' ' || first_reply AS chosen, prompt || ' ' || last_reply AS rejected FROM turns""",
)
def chat_pairs(spark, sf):
    return preference.format_pairs(_chat_pairs(spark, sf))


_SIDES = f"""{b.SQL_TURNS},
sides AS (
  SELECT conv_id * 2 AS side_id, prompt || ' ' || first_reply AS text FROM turns
  UNION ALL SELECT conv_id * 2 + 1, prompt || ' ' || last_reply FROM turns)"""


@query(
    "r3_tokenized_pairs",
    f"""WITH {_SIDES}, {b.padded_sql('sides', 'side_id')},
flat AS (
  SELECT side_id, string_agg(id, ' ' ORDER BY idx) AS input_ids, string_agg(m, ' ' ORDER BY idx) AS attention_mask
  FROM filled GROUP BY side_id)
SELECT c.side_id // 2 AS conv_id, c.input_ids AS chosen_input_ids, c.attention_mask AS chosen_attention_mask,
       r.input_ids AS rejected_input_ids, r.attention_mask AS rejected_attention_mask
FROM flat c JOIN flat r ON r.side_id = c.side_id + 1 WHERE c.side_id % 2 = 0""",
)
def tokenized_pairs(spark, sf):
    pairs = preference.format_pairs(_chat_pairs(spark, sf))
    sides = pairs.select(F.explode(F.array("chosen", "rejected")).alias("text"))
    ready = preference.tokenize_pairs(pairs, tokens.build_vocab(sides, b.VOCAB_SIZE), b.SEQ_LEN)
    names = [f"{s}_{c}" for s in ("chosen", "rejected") for c in ("input_ids", "attention_mask")]
    return ready.select("conv_id", *[joined(n) for n in names])


@query(
    "r4_sequence_logp",
    f"""WITH {b.SQL_LINES}
SELECT seq_id, round(sum(CASE WHEN pos > 0 AND label <> -100 AND label <> 1000 THEN logp ELSE 0.0 END) + 3.14159e-8, 6) AS logp,
       round(sum(CASE WHEN pos > 0 AND label <> -100 AND label <> 1000 AND label <> 3 THEN logp ELSE 0.0 END) + 3.14159e-8, 6) AS logp_unpadded
FROM logps GROUP BY seq_id""",
)
def sequence_logp(spark, sf):
    scored = b.token_logps(spark, sf)
    both = scored.groupBy("seq_id").agg(
        preference.summed_logp(1000).alias("logp"),
        preference.summed_logp(1000, exclude_padding=True).alias("logp_unpadded"),
    )
    return both.select("seq_id", b.near("logp").alias("logp"), b.near("logp_unpadded").alias("logp_unpadded"))


_MARGIN = "(policy_chosen - policy_rejected) - (ref_chosen - ref_rejected)"


def _softplus(x: str) -> str:
    """SQL of -log(sigmoid(x))."""
    return f"(CASE WHEN {x} >= 0 THEN ln(1 + exp(-({x}))) ELSE ln(1 + exp({x})) - ({x}) END)"


@query(
    "r5_sigmoid_loss",
    f"""WITH {b.SQL_PAIRS}, x AS (SELECT pair_id, 0.1::DOUBLE * ({_MARGIN}) AS x FROM pairs)
SELECT pair_id, round({_softplus('x')} * 0.9 + {_softplus('-x')} * 0.1 + 3.14159e-8, 6) AS loss FROM x""",
)
def sigmoid_loss(spark, sf):
    pairs = preference.join_reference(*b.pair_logps(spark, sf))
    return preference.preference_loss(pairs, 0.1, 0.1).select("pair_id", b.near("loss").alias("loss"))


@query(
    "r6_hinge_loss",
    f"WITH {b.SQL_PAIRS} SELECT pair_id, round(greatest(0.0::DOUBLE, 1 - 0.1::DOUBLE * ({_MARGIN})) + 3.14159e-8, 6) AS loss FROM pairs",
)
def hinge_loss(spark, sf):
    pairs = preference.join_reference(*b.pair_logps(spark, sf))
    return preference.preference_loss(pairs, loss_type="hinge").select("pair_id", b.near("loss").alias("loss"))


def _metrics_sql(chosen: str, rejected: str) -> str:
    return f"""
r AS (
  SELECT pair_id // 8 AS batch_id, 0.1::DOUBLE * ({chosen}) AS c, 0.1::DOUBLE * ({rejected}) AS r FROM pairs),
x AS (SELECT *, c - r AS x FROM r)
SELECT batch_id, round(avg({_softplus('x')}) + 3.14159e-8, 6) AS loss, round(avg(x) + 3.14159e-8, 6) AS reward_margin,
       round(avg(CASE WHEN c > r THEN 1.0 ELSE 0.0 END) + 3.14159e-8, 6) AS reward_accuracy,
       round(avg(c) + 3.14159e-8, 6) AS chosen_reward, round(avg(r) + 3.14159e-8, 6) AS rejected_reward
FROM x GROUP BY batch_id"""


def _metrics(pairs):
    batched = preference.preference_loss(pairs).withColumn("batch_id", F.floor(F.col("pair_id") / 8).cast("bigint"))
    means = preference.preference_metrics(batched)
    return means.select("batch_id", *[b.near(c).alias(c) for c in means.columns if c != "batch_id"])


@query(
    "r7_batch_metrics",
    f"WITH {b.SQL_PAIRS}, {_metrics_sql('policy_chosen - ref_chosen', 'policy_rejected - ref_rejected')}",
)
def batch_metrics(spark, sf):
    return _metrics(preference.join_reference(*b.pair_logps(spark, sf)))


@query("r8_reference_free", f"WITH {b.SQL_PAIRS}, {_metrics_sql('policy_chosen', 'policy_rejected')}")
def reference_free(spark, sf):
    policy, _ = b.pair_logps(spark, sf)
    return _metrics(preference.join_reference(policy, None))
