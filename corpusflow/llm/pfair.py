"""Mixing sources to target weights by Pfair scheduling.

Each source's documents are put into a seeded random order and cut into blocks. With share s of P in
total, block j (from 0) of a source is released at slot floor(j * P / s) and due by slot
ceil((j + 1) * P / s); every slot takes the released block with the earliest deadline. All deadlines
are met, so after any number of slots each source is less than one block off its target.

The schedule repeats after P slots, P being the sum of the shares. So only one period, a table of P rows
that depends on the configuration alone, is worked out on the driver; the slot of any block follows from
the block's number by arithmetic. Documents are numbered within their source in chunks of a hash range,
so a source that holds most documents is spread over many tasks.
"""

from __future__ import annotations

import heapq
from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from corpusflow.functions.hashing import HASH_SPAN, hash_bits, int_div
from corpusflow.operators.ordering import Running, running

#: Name of the pool of all sources without a share of their own, null ones included.
POOL = "<other>"
#: Slices of the hash range that a source's documents are numbered in.
SLICES = 1024
MAX_SHARES = 10_000


def period(shares: Mapping[str, int]) -> list[tuple[str, int, int]]:
    """(source, number of the block in the period, slot) of every slot of one period."""
    total = sum(shares.values())
    if not shares or min(shares.values()) < 1 or total > MAX_SHARES:
        raise ValueError(f"shares must be whole numbers from 1 whose sum is {MAX_SHARES} at most")
    names = sorted(shares)
    waiting = [(0, name, 0) for name in names]
    heapq.heapify(waiting)
    ready: list[tuple[int, str, int]] = []
    slots = []
    for slot in range(total):
        while waiting and waiting[0][0] <= slot:
            _, name, j = heapq.heappop(waiting)
            heapq.heappush(ready, (-(-(j + 1) * total // shares[name]), name, j))
        due, name, j = heapq.heappop(ready)
        assert slot < due, "a deadline was missed"
        slots.append((name, j, slot))
        if j + 1 < shares[name]:
            heapq.heappush(waiting, ((j + 1) * total // shares[name], name, j + 1))
    return slots


def mix(docs: DataFrame, shares: Mapping[str, int], other: int = 1, block_docs: int = 8, seed: int = 42,
        id_col: str = "doc_id", source_col: str = "source") -> DataFrame:
    """All rows of ``docs`` with their place in the mix.

    Added columns: ``mix_block`` (number of the block within its source), ``mix_slot`` (slot of the
    block), ``mix_order`` (slot * block_docs + place in the block; sorting by it gives the mix) and
    ``on_target`` (no source has run out before this slot; up to there every source is less than one
    block off its weight. Later rows are kept and interleave what is left). Sources without a share,
    null ones included, form one pool with the share ``other``. Rows with equal or null ids are placed one
    after the other. Columns of these names are replaced and all others passed on; an empty table gives an empty mix.
    """
    every = {**shares, POOL: other}
    total = sum(every.values())
    spark = docs.sparkSession
    added = ("mix_block", "mix_slot", "mix_order", "on_target")
    named = F.when(F.col(source_col).isin(list(shares)), F.col(source_col)).otherwise(POOL)
    bits = hash_bits(seed, "pfair", F.coalesce(F.col(id_col).cast("string"), F.lit("null")))
    # The rows travel as one struct, so that no column of theirs can clash with those used here.
    passed = [c for c in docs.columns if c not in added]
    whole = F.struct(*[F.col(f"`{c}`") for c in passed]).alias("_doc")
    base = docs.select(whole, F.col(f"`{id_col}`").alias("_id"), named.alias("_source"), bits.alias("_bits"))
    chunk = F.floor(F.col("_bits") / F.lit(HASH_SPAN / SLICES)).cast("bigint")
    ordered = running(base, ["_source"], ["_bits", "_id"], {"_place": Running("sum", F.lit(1).cast("bigint"))}, chunk=chunk, stage=False)
    # As many rows as the shares sum up to, MAX_SHARES at most.
    slots = F.broadcast(spark.createDataFrame([(n, j, s, every[n]) for n, j, s in period(every)], "_source string, _in_period bigint, _slot bigint, _share bigint"))
    sizes = F.broadcast(spark.createDataFrame(list(every.items()), "_source string, _share bigint"))
    # The first slot that a source cannot fill: one row per source of the configuration.
    counted = sizes.join(base.groupBy("_source").agg(F.count(F.lit(1)).alias("_n")), "_source", "left")
    missing = counted.select("_source", F.floor((F.coalesce("_n", F.lit(0)) + block_docs - 1) / block_docs).cast("bigint").alias("_next"), F.col("_share").alias("_s"))
    gaps = missing.join(slots, "_source").where(F.col("_next") % F.col("_s") == F.col("_in_period"))
    horizon = gaps.agg(F.min(F.floor(F.col("_next") / F.col("_s")) * total + F.col("_slot"))).scalar()
    block = int_div(F.col("_place") - 1, block_docs)
    placed = ordered.withColumn("mix_block", block).join(sizes, "_source")
    placed = placed.withColumn("_in_period", F.col("mix_block") % F.col("_share")).join(slots.drop("_share"), ["_source", "_in_period"])
    slot = F.floor((F.col("mix_block") - F.col("_in_period")) / F.col("_share")).cast("bigint") * total + F.col("_slot")
    placed = placed.withColumn("mix_slot", slot)
    return placed.select(
        *[F.col("_doc")[c].alias(c) for c in passed], "mix_block", "mix_slot",
        (F.col("mix_slot") * block_docs + (F.col("_place") - 1) % block_docs).alias("mix_order"),
        (F.col("mix_slot") < horizon).alias("on_target"),
    )


def mix_sql(table: str, shares: Mapping[str, int], other: int = 1, block_docs: int = 8, seed: int = 42) -> str:
    """The rows (doc_id, source, mix_block, mix_slot, mix_order, on_target) of :func:`mix` as DuckDB SQL."""
    every = {**shares, POOL: other}
    total = sum(every.values())
    slots = ", ".join(f"('{n}', {j}, {s}, {every[n]})" for n, j, s in period(every))
    names = ", ".join(f"'{n}'" for n in shares)
    return f"""
WITH slots(src, in_period, slot, share) AS (VALUES {slots}),
named AS (SELECT doc_id, source, CASE WHEN source IN ({names}) THEN source ELSE '{POOL}' END AS src FROM {table}),
placed AS (SELECT *, row_number() OVER (PARTITION BY src ORDER BY substr(md5('{seed}:pfair:' || coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 12), doc_id) - 1 AS place FROM named),
counted AS (SELECT s.src, s.share, (count(n.src) + {block_docs - 1}) // {block_docs} AS next
    FROM (SELECT DISTINCT src, share FROM slots) s LEFT JOIN named n ON n.src = s.src GROUP BY 1, 2),
horizon AS (SELECT min((c.next // c.share) * {total} + s.slot) AS until FROM counted c JOIN slots s ON s.src = c.src AND s.in_period = c.next % c.share),
blocks AS (SELECT p.doc_id, p.source, p.place // {block_docs} AS mix_block, p.place % {block_docs} AS in_block,
    ((p.place // {block_docs}) // s.share) * {total} + s.slot AS mix_slot
    FROM placed p JOIN slots s ON s.src = p.src AND s.in_period = (p.place // {block_docs}) % s.share)
SELECT doc_id, source, mix_block, mix_slot, mix_slot * {block_docs} + in_block AS mix_order, mix_slot < until AS on_target
FROM blocks, horizon"""
