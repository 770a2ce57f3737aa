"""Validation losses per batch, per domain and overall."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from corpusflow.functions.hashing import int_div
from corpusflow.operators.ordering import ordered_position
from corpusflow.operators.packing import IGNORE, pack
from corpusflow.operators.selection import first_per_domain

EVAL_BATCH = 4
OVERALL = "*"


def batch_loss(df: DataFrame) -> DataFrame:
    """Mean next-token loss per (domain, batch_id) from (domain, batch_id, seq_id, pos, label, logp).

    The first position of a sequence is not predicted, so it does not enter the mean, but its label
    counts in ``n_labels``, the weight used later. A batch that predicts nothing has loss NaN.
    """
    valid = F.col("label") != IGNORE
    return df.groupBy("domain", "batch_id").agg(
        F.coalesce(-F.avg(F.when(valid & (F.col("pos") > 0), F.col("logp"))), F.lit(float("nan"))).alias("loss"),
        F.sum(valid.cast("bigint")).alias("n_labels"),
    )


def domain_loss(batches: DataFrame) -> DataFrame:
    """Label-weighted loss and perplexity per domain, and over all domains in the row ``*``.

    Domains without labels are left out.
    """
    sums = batches.rollup("domain").agg(
        F.sum(F.col("loss") * F.col("n_labels")).alias("_loss"), F.sum("n_labels").alias("n_labels"),
        F.grouping("domain").alias("_all"),
    ).where(F.col("n_labels") > 0)
    loss = F.col("_loss") / F.col("n_labels")
    return sums.select(
        F.when(F.col("_all") == 1, F.lit(OVERALL)).otherwise(F.col("domain")).alias("domain"), "n_labels",
        loss.alias("loss"), F.exp(loss).alias("ppl"),
    )


def result_metrics(domains: DataFrame) -> DataFrame:
    """One row per metric: <domain>_val_loss, <domain>_val_ppl, val_loss and val_ppl."""
    prefix = F.when(F.col("domain") == OVERALL, F.lit("")).otherwise(F.concat("domain", F.lit("_")))
    return domains.select(
        prefix.alias("_p"), F.col("loss").alias("val_loss"), F.col("ppl").alias("val_ppl")
    ).unpivot("_p", ["val_loss", "val_ppl"], "_name", "value").select(
        F.concat("_p", "_name").alias("name"), "value"
    )


def eval_batches(
    sample: DataFrame, seq_len: int, eos_id: int | None, pad_id: int, max_samples: int | None = None,
    batch_size: int = EVAL_BATCH, order: str = "doc_id", docs_per_sequence: int = 4,
) -> DataFrame:
    """Pack the sampled documents of each domain in batches of four."""
    kept = first_per_domain(sample, max_samples, order)
    placed = ordered_position(kept, ["domain"], [order], "_pos")
    at = F.col("_pos") - 1
    numbered = placed.withColumns(
        {
            "batch_id": F.concat_ws(":", "domain", int_div(at, batch_size).cast("string")),
            "idx": (at % batch_size).cast("int"),
        }
    )
    return pack(numbered, seq_len, docs_per_sequence, eos_id=eos_id, pad_id=pad_id, key=order)
