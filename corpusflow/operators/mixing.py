"""Weighted, budgeted, resumable mixing of corpora.

Drawing the next stream again and again with probability proportional to its weight is sequential.
Giving item i of stream s the arrival time sum_{j<=i} -ln(u_j)/w_s and sorting by arrival has the same
distribution, also after streams run dry, and needs only running sums. The u_j come from the row keys,
so the order is a pure function of (seed, data): resuming is a filter on the position.

The frames mixed here are narrow (key, domain, source, n_tokens, has_text); join the texts back by key.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from corpusflow.functions.hashing import GAP_SCALE, hash_bits, hash_uniform, int_div, race_gap
from corpusflow.operators.ordering import CHUNK_ROWS, Running, chunk_by_hash, ordered_position, row_count, running


@dataclass(frozen=True)
class Domain:
    """One domain of a mix: its weight, its weighted sources, an optional token budget."""

    name: str
    weight: float
    sources: tuple[tuple[str, float], ...]
    max_tokens: int | None = None
    text_field: str | None = None


# The default mix of domains.
DEFAULT_WEIGHTS = {"web": 0.87, "code": 0.10, "math": 0.03}
DEFAULT_BUFFER = 10_000

CONFIG_SCHEMA = (
    "domain string, domain_weight double, source string, source_weight double, "
    "max_tokens bigint, text_field string"
)


def mix_config(spark: SparkSession, domains: Sequence[Domain]) -> DataFrame:
    """The configuration as a DataFrame, one row per (domain, source); domain weights sum to one."""
    total = sum(d.weight for d in domains if d.weight > 0) or 1.0
    rows = [
        (d.name, d.weight / total, source, float(weight), d.max_tokens, d.text_field or "text")
        for d in domains
        for source, weight in d.sources
    ]
    return spark.createDataFrame(rows, CONFIG_SCHEMA)


def normalize_weights(config: DataFrame) -> DataFrame:
    """Source weights that sum to one within each domain."""
    total = F.sum("source_weight").over(Window.partitionBy("domain"))
    return config.withColumn("source_weight", F.col("source_weight") / total)


def _with_config(df: DataFrame, config: DataFrame) -> DataFrame:
    # The configuration holds one literal row per source, so it is small by construction.
    small = normalize_weights(config).select("domain", "source", "domain_weight", "source_weight", "max_tokens")
    return df.join(F.broadcast(small), ["domain", "source"])


def _arrival_chunk(arrival: str, chunk_rows: int) -> Column:
    # While every stream is active, one row arrives per GAP_SCALE units; later fewer do.
    return int_div(F.col(arrival), GAP_SCALE * chunk_rows)


def source_shuffle(df: DataFrame, seed: int, key: str = "doc_id") -> DataFrame:
    """Seeded full shuffle inside every source: adds the sort key and the position ``source_pos``."""
    hashed = df.withColumn("_h", hash_bits(seed, "shuffle", F.col("source"), F.col(key)))
    placed = ordered_position(
        hashed, ["domain", "source"], ["_h", key], "source_pos", chunk=chunk_by_hash(df, F.col("_h"))
    )
    return placed.withColumnRenamed("_h", "shuffle_key")


def interleave_sources(
    df: DataFrame, config: DataFrame, seed: int, key: str = "doc_id", chunk_rows: int = CHUNK_ROWS
) -> DataFrame:
    """Weighted interleave of the sources of each domain; then empty texts are dropped.

    Adds ``arrival`` and ``pos``, the position among the non-empty rows of the domain. An empty row
    uses up a draw before it is dropped.
    """
    weighted = _with_config(df, config).where(F.col("source_weight") > 0)
    prepared = weighted.withColumns(
        {
            "_h": hash_bits(seed, "shuffle", F.col("source"), F.col(key)),
            "_gap": race_gap(hash_uniform(seed, "source", F.col(key)), F.col("source_weight")),
        }
    )
    raced = running(
        prepared, ["domain", "source"], ["_h", key], {"arrival": Running("sum", F.col("_gap"))},
        chunk=chunk_by_hash(df, F.col("_h")),
    )
    kept = raced.where("has_text").drop("_gap", "source_weight")
    return ordered_position(
        kept, ["domain"], ["arrival", "_h", key], "pos", chunk=_arrival_chunk("arrival", chunk_rows), stage=False
    ).drop("_h")


def block_shuffle(
    df: DataFrame, buffer_size: int | None, seed: int, group: Sequence[str] = ("domain",), key: str = "doc_id",
    pos: str = "pos",
) -> DataFrame:
    """Shuffle inside consecutive blocks of ``buffer_size`` rows; None or 0 shuffles each group fully."""
    keyed = df.withColumn("_b", hash_bits(seed, "block", F.col(key)))
    if not buffer_size:
        return ordered_position(
            keyed.drop(pos), group, ["_b", key], pos, chunk=chunk_by_hash(df, F.col("_b"))
        ).drop("_b")
    block = int_div(F.col(pos) - 1, buffer_size)
    inside = Window.partitionBy(*group, "_block").orderBy("_b", key)
    placed = keyed.withColumn("_block", block).withColumn(
        pos, F.col("_block") * F.lit(buffer_size) + F.row_number().over(inside)
    )
    return placed.drop("_b", "_block")


def domain_budget(df: DataFrame, pos: str = "pos", chunk_rows: int = CHUNK_ROWS, stage: bool = True) -> DataFrame:
    """Keep a document while the tokens emitted before it in its domain are below ``max_tokens``.

    The last kept document may overshoot; a missing or zero budget keeps everything.
    """
    totalled = running(
        df, ["domain"], [pos], {"tokens_before": Running("sum", F.col("n_tokens"), exclusive=True)},
        chunk=int_div(F.col(pos) - 1, chunk_rows), stage=stage,
    )
    return totalled.where(
        (F.coalesce(F.col("max_tokens"), F.lit(0)) == 0) | (F.col("tokens_before") < F.col("max_tokens"))
    )


def domain_race(
    df: DataFrame, seed: int, total_tokens: int | None = None, key: str = "doc_id", pos: str = "pos",
    chunk_rows: int = CHUNK_ROWS, stage: bool = True,
) -> DataFrame:
    """Weighted mix of the domains under their budgets and a total budget.

    Adds ``mix_pos`` (1-based) and ``mixed_before``, the tokens emitted before the document.
    """
    gap = race_gap(hash_uniform(seed, "domain", F.col(key)), F.col("domain_weight"))
    raced = running(
        df.where(F.col("domain_weight") > 0), ["domain"], [pos],
        {
            "tokens_before": Running("sum", F.col("n_tokens"), exclusive=True),
            "mix_arrival": Running("sum", gap),
        },
        chunk=int_div(F.col(pos) - 1, chunk_rows), stage=stage,
    )
    affordable = raced.where(
        (F.coalesce(F.col("max_tokens"), F.lit(0)) == 0) | (F.col("tokens_before") < F.col("max_tokens"))
    ).withColumn("_tie", hash_bits(seed, "tie", F.col(key)))
    mixed = running(
        affordable, [], ["mix_arrival", "_tie", key],
        {"mix_pos": row_count(), "mixed_before": Running("sum", F.col("n_tokens"), exclusive=True)},
        chunk=_arrival_chunk("mix_arrival", chunk_rows), stage=False,
    ).drop("_tie")
    return total_budget(mixed, total_tokens)


def total_budget(mixed: DataFrame, total_tokens: int | None) -> DataFrame:
    """Keep documents that start before ``total_tokens`` tokens were emitted; None or 0 keeps all."""
    return mixed.where(F.col("mixed_before") < total_tokens) if total_tokens else mixed


def mix(
    df: DataFrame, config: DataFrame, seed: int = 42, buffer_size: int | None = DEFAULT_BUFFER,
    total_tokens: int | None = None, key: str = "doc_id", chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """The whole chain: shuffle, interleave, drop empties, block shuffle, budgets, domain race."""
    interleaved = interleave_sources(df, config, seed, key, chunk_rows)
    shuffled = block_shuffle(interleaved, buffer_size, seed, key=key)
    return domain_race(shuffled, seed, total_tokens, key, chunk_rows=chunk_rows)


def categorical_draw(weights: Sequence[tuple[str, float]], seed: int, key: Column) -> Column:
    """One draw per row with fixed weights: the first name whose cumulative weight covers u."""
    total = sum(w for _, w in weights)
    u = hash_uniform(seed, "draw", key)
    names = [n for n, _ in weights]
    upper = [sum(w for _, w in weights[: i + 1]) / total for i in range(len(weights))]
    choice = F.lit(names[-1])
    for name, bound in reversed(list(zip(names, upper))[:-1]):
        choice = F.when(u <= F.lit(bound), F.lit(name)).otherwise(choice)
    return choice


def mix_ledger(mixed: DataFrame) -> DataFrame:
    """Documents, tokens and last position per source, per domain and in total."""
    return mixed.rollup("domain", "source").agg(
        F.count(F.lit(1)).alias("docs"),
        F.sum("n_tokens").alias("tokens_yielded"),
        F.max("mix_pos").alias("last_pos"),
    ).select(
        F.coalesce("domain", F.lit("*")).alias("domain"),
        F.coalesce("source", F.lit("*")).alias("source"),
        "docs", "tokens_yielded", "last_pos",
    )


def resume_after(mixed: DataFrame, ledger: DataFrame) -> DataFrame:
    """The rest of a mix after the total row of a saved ledger."""
    done = ledger.where((F.col("domain") == "*") & (F.col("source") == "*")).agg(F.max("last_pos"))
    return mixed.where(F.col("mix_pos") > F.coalesce(done.scalar(), F.lit(0)))


def epochs(df: DataFrame, count: int, seed: int, key: str) -> DataFrame:
    """Every row once per epoch, each epoch in its own seeded order (``epoch_pos``)."""
    repeated = df.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(count - 1)))) \
        .withColumn("_e", hash_bits(seed, "epoch", F.col("epoch"), F.col(key)))
    return ordered_position(
        repeated, ["epoch"], ["_e", key], "epoch_pos", chunk=chunk_by_hash(df, F.col("_e"))
    ).drop("_e")
