"""Preference pairs: formats, log-probabilities, losses and reward metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from corpusflow.functions.text import joined_contents
from corpusflow.operators.packing import IGNORE
from corpusflow.operators.tokens import PAD_ID, attention_mask, encode, padded


def _side(df: DataFrame, column: str) -> Column:
    if isinstance(df.schema[column].dataType, T.ArrayType):
        return joined_contents(F.col(column))
    return F.col(column)


def format_pairs(df: DataFrame) -> DataFrame:
    """``chosen`` and ``rejected`` as text, chosen once from the columns of the frame."""
    columns = df.columns
    if "chosen" in columns and "rejected" in columns:
        return df.withColumns({c: _side(df, c) for c in ("chosen", "rejected")})
    if "chosen_response" in columns:
        prompt = F.coalesce(F.col("prompt"), F.lit("")) if "prompt" in columns else F.lit("")
        return df.withColumns(
            {"chosen": F.concat(prompt, "chosen_response"), "rejected": F.concat(prompt, "rejected_response")}
        )
    raise ValueError(f"unknown pair format, columns: {columns}")


def tokenize_pairs(df: DataFrame, vocab: DataFrame, seq_len: int, pad_id: int = PAD_ID) -> DataFrame:
    """Both sides cut and padded to ``seq_len`` with their attention masks."""
    out = df
    for side in ("chosen", "rejected"):
        out = encode(out, vocab, max_length=seq_len, text=side, out=f"_{side}")
        out = out.withColumns(
            {
                f"{side}_input_ids": padded(F.col(f"_{side}"), seq_len, pad_id),
                f"{side}_attention_mask": attention_mask(F.col(f"_{side}"), seq_len),
            }
        ).drop(f"_{side}")
    return out


def summed_logp(vocab_size: int, exclude_padding: bool = False, pad_id: int = PAD_ID) -> Column:
    """Sum of the log-probabilities of the labels, for an aggregation of (pos, label, logp) rows.

    The first position is never predicted. Labels -100 and ``vocab_size`` do not count; padding does,
    unless it is excluded.
    """
    counts = (F.col("pos") > 0) & (F.col("label") != IGNORE) & (F.col("label") != vocab_size)
    if exclude_padding:
        counts = counts & (F.col("label") != pad_id)
    return F.sum(F.when(counts, F.col("logp")).otherwise(F.lit(0.0)))


def sequence_logp(
    df: DataFrame, vocab_size: int, exclude_padding: bool = False, pad_id: int = PAD_ID, seq: str = "seq_id"
) -> DataFrame:
    """``summed_logp`` of each sequence, from (seq, pos, label, logp)."""
    return df.groupBy(seq).agg(summed_logp(vocab_size, exclude_padding, pad_id).alias("logp"))


def neg_log_sigmoid(x: Column) -> Column:
    """-log(sigmoid(x)) without overflow."""
    return F.when(x >= 0, F.log1p(F.exp(-x))).otherwise(F.log1p(F.exp(x)) - x)


def join_reference(policy: DataFrame, reference: DataFrame | None, key: str = "pair_id") -> DataFrame:
    """Policy log-probabilities with those of the reference; zeros where there is none."""
    names = ("ref_chosen", "ref_rejected")
    if reference is None:
        return policy.withColumns({n: F.lit(0.0) for n in names})
    joined = policy.join(reference.select(key, *names), key, "left")
    return joined.withColumns({n: F.coalesce(n, F.lit(0.0)) for n in names})


def preference_loss(
    df: DataFrame, beta: float = 0.1, label_smoothing: float = 0.0, loss_type: str = "sigmoid"
) -> DataFrame:
    """Adds loss, chosen_reward, rejected_reward, reward_margin and reward_accuracy to each pair."""
    margin = (F.col("policy_chosen") - F.col("policy_rejected")) - (F.col("ref_chosen") - F.col("ref_rejected"))
    x = F.lit(beta) * margin
    if loss_type == "sigmoid":
        loss = neg_log_sigmoid(x) * (1 - label_smoothing) + neg_log_sigmoid(-x) * label_smoothing
    elif loss_type == "hinge":
        loss = F.greatest(F.lit(0.0), 1 - x)
    else:
        raise ValueError(f"unknown loss type: {loss_type}")
    chosen = F.lit(beta) * (F.col("policy_chosen") - F.col("ref_chosen"))
    rejected = F.lit(beta) * (F.col("policy_rejected") - F.col("ref_rejected"))
    return df.withColumns(
        {
            "loss": loss, "chosen_reward": chosen, "rejected_reward": rejected, "reward_margin": chosen - rejected,
            "reward_accuracy": (chosen > rejected).cast("double"),
        }
    )


def preference_metrics(losses: DataFrame, by: str = "batch_id") -> DataFrame:
    """Means per batch."""
    names = ("loss", "reward_margin", "reward_accuracy", "chosen_reward", "rejected_reward")
    return losses.groupBy(by).agg(*[F.avg(n).alias(n) for n in names])
