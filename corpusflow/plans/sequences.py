"""Queries over packed sequences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from corpusflow.operators import packing, tokens
from corpusflow.plans import bindings as b
from corpusflow.plans.registry import query
from corpusflow.session import materialise, scratch_path
from corpusflow.sources.packed import read_packed, step_slice, write_packed

STEPS_PER_BUCKET = 4
ACCUM = 2


def batched(spark, sf) -> DataFrame:
    """(doc_id, batch_id, idx, n_tokens) in mix order."""
    return packing.assign_batches(b.mixed(spark, sf), b.BATCH).select("doc_id", "batch_id", "idx", "n_tokens")


def packed(spark, sf, **options) -> DataFrame:
    # No document fills more than one sequence, so nothing beyond it has to be looked up or moved.
    docs = batched(spark, sf).join(b.encoded(spark, sf, b.SEQ_LEN), "doc_id")
    slices = docs.withColumn("slice", step_slice(F.col("batch_id"), ACCUM, STEPS_PER_BUCKET))
    return packing.pack(
        slices, b.SEQ_LEN, b.DOCS_PER_SEQUENCE, eos_id=tokens.EOS_ID, pad_id=tokens.PAD_ID, together="slice", **options
    )


def placed(spark, sf) -> DataFrame:
    """Where every document lies, from lengths alone."""
    return packing.layout(batched(spark, sf), b.SEQ_LEN, b.DOCS_PER_SEQUENCE, with_eos=True)


def joined(column: str) -> Column:
    return F.array_join(F.col(column).cast("array<string>"), " ").alias(column)


L = b.SEQ_LEN

SQL_BATCHED = f"""
batched AS MATERIALIZED (
  SELECT doc_id, n_tokens, (mix_pos - 1) // {b.BATCH} AS batch_id, (mix_pos - 1) % {b.BATCH} AS idx FROM mixed),"""

#: next_fit(batch_id, idx, seq_idx) by a recursive walk over each batch
SQL_NEXT_FIT = f"""
next_fit(batch_id, idx, seq_idx, used, docs) AS (
  SELECT batch_id, idx, 0, n_tokens + 1, 1 FROM batched WHERE idx = 0
  UNION ALL
  SELECT d.batch_id, d.idx,
         CASE WHEN f.used + d.n_tokens + 1 > {L} OR f.docs >= {b.DOCS_PER_SEQUENCE} THEN f.seq_idx + 1 ELSE f.seq_idx END,
         CASE WHEN f.used + d.n_tokens + 1 > {L} OR f.docs >= {b.DOCS_PER_SEQUENCE} THEN d.n_tokens + 1
              ELSE f.used + d.n_tokens + 1 END,
         CASE WHEN f.used + d.n_tokens + 1 > {L} OR f.docs >= {b.DOCS_PER_SEQUENCE} THEN 1 ELSE f.docs + 1 END
  FROM next_fit f JOIN batched d ON d.batch_id = f.batch_id AND d.idx = f.idx + 1)"""


def spans_sql(batched: str = SQL_BATCHED) -> str:
    """next_fit and spans: documents with start, stop and whether they are the last of their sequence."""
    return f"""{batched} {SQL_NEXT_FIT},
offsets AS (
  SELECT d.doc_id, d.batch_id, d.idx, f.seq_idx, d.n_tokens,
         CAST(coalesce(sum(d.n_tokens + 1) OVER (PARTITION BY d.batch_id, f.seq_idx ORDER BY d.idx
                       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start
  FROM batched d JOIN next_fit f ON d.batch_id = f.batch_id AND d.idx = f.idx),
spans AS MATERIALIZED (
  SELECT *, least(start + n_tokens + 1, {L}) AS stop,
         row_number() OVER (PARTITION BY batch_id, seq_idx ORDER BY idx DESC) = 1 AS is_last
  FROM offsets WHERE start < {L}),
seqs AS (SELECT batch_id, seq_idx, max(stop) AS used FROM spans GROUP BY ALL)"""


#: slots: one row per place of every sequence
SQL_SLOTS = f"""
grid AS (SELECT batch_id, seq_idx, unnest(range({L})) AS p FROM seqs),
placed AS (SELECT s.*, unnest(range(s.start, s.stop)) AS p FROM spans s),
slots AS (
  SELECT g.batch_id, g.seq_idx, g.p,
         CASE WHEN t.doc_id IS NULL THEN 3 WHEN g.p - t.start = t.n_tokens THEN 2 ELSE i.id END AS input_id,
         CASE WHEN t.doc_id IS NULL THEN -100 WHEN g.p = t.stop - 1 AND NOT t.is_last THEN -100
              WHEN g.p - t.start = t.n_tokens THEN 2 ELSE i.id END AS label,
         CASE WHEN t.doc_id IS NULL THEN 0 ELSE g.p - t.start END AS position_id,
         CASE WHEN t.doc_id IS NULL THEN -1 ELSE t.start END AS allowed
  FROM grid g
  LEFT JOIN placed t ON g.batch_id = t.batch_id AND g.seq_idx = t.seq_idx AND g.p = t.p
  LEFT JOIN ids i ON i.doc_id = t.doc_id AND i.idx = g.p - t.start)"""

SQL_LIGHT = f"WITH RECURSIVE {b.mix_sql()}, {spans_sql()}"
SQL_FULL = f"WITH RECURSIVE {b.mix_sql()}, {b.SQL_IDS}, {spans_sql()}, {SQL_SLOTS}"


def per_slot(column: str, alias: str) -> str:
    return (
        f"{SQL_FULL} SELECT batch_id, seq_idx, string_agg(CAST({column} AS BIGINT), ' ' ORDER BY p) AS {alias} "
        "FROM slots GROUP BY batch_id, seq_idx"
    )


@query(
    "k1_next_fit",
    f"WITH RECURSIVE {b.mix_sql()}, {SQL_BATCHED} {SQL_NEXT_FIT} SELECT batch_id, idx, seq_idx FROM next_fit",
)
def next_fit(spark, sf):
    return packing.next_fit(batched(spark, sf), b.SEQ_LEN, b.DOCS_PER_SEQUENCE)


@query("k2_input_ids", per_slot("input_id", "input_ids"))
def input_ids(spark, sf):
    return packed(spark, sf).select("batch_id", "seq_idx", joined("input_ids"))


@query(
    "k3_boundaries",
    f"""{SQL_LIGHT}
SELECT batch_id, seq_idx, string_agg(CAST(stop AS BIGINT), ' ' ORDER BY idx) AS boundaries,
       string_agg(doc_id, ' ' ORDER BY idx) AS doc_ids
FROM spans GROUP BY batch_id, seq_idx""",
)
def boundaries(spark, sf):
    return packing.layout_boundaries(placed(spark, sf)).select("batch_id", "seq_idx", joined("boundaries"), joined("doc_ids"))


@query("k4_position_ids", per_slot("position_id", "position_ids"))
def position_ids(spark, sf):
    rows = packing.layout_boundaries(placed(spark, sf))
    return rows.withColumn("position_ids", packing.position_ids(F.col("boundaries"), b.SEQ_LEN)).select(
        "batch_id", "seq_idx", joined("position_ids")
    )


@query("k5_labels", per_slot("label", "labels"))
def labels(spark, sf):
    return packed(spark, sf).select("batch_id", "seq_idx", joined("labels"))


@query("k6_document_mask", per_slot("allowed", "allowed_start"))
def document_mask(spark, sf):
    rows = packing.layout_boundaries(placed(spark, sf))
    return rows.withColumn("allowed_start", packing.allowed_start(F.col("boundaries"), b.SEQ_LEN)).select(
        "batch_id", "seq_idx", joined("allowed_start")
    )


_OFFSETS = """
ends AS (
  SELECT batch_id, seq_idx, idx, stop - start AS n,
         sum(stop - start) OVER (PARTITION BY batch_id ORDER BY seq_idx, idx ROWS UNBOUNDED PRECEDING) AS cu
  FROM spans),
offs AS (
  SELECT batch_id, '0 ' || string_agg(CAST(cu AS BIGINT), ' ' ORDER BY seq_idx, idx) AS cu_seqlens, CAST(max(n) AS INT) AS max_seqlen
  FROM ends GROUP BY batch_id)"""


@query("k7_batch_offsets", f"{SQL_LIGHT}, {_OFFSETS} SELECT batch_id, cu_seqlens, max_seqlen FROM offs")
def batch_offsets(spark, sf):
    return packing.layout_offsets(placed(spark, sf)).select("batch_id", joined("cu_seqlens"), "max_seqlen")


@query(
    "k8_flatten",
    f"""{SQL_FULL}, {_OFFSETS},
flat AS (
  SELECT batch_id, string_agg(input_id, ' ' ORDER BY seq_idx, p) AS input_ids,
         string_agg(label, ' ' ORDER BY seq_idx, p) AS labels
  FROM slots GROUP BY batch_id)
SELECT flat.batch_id, input_ids, labels, cu_seqlens, max_seqlen FROM flat JOIN offs ON flat.batch_id = offs.batch_id""",
)
def flatten(spark, sf):
    rows = materialise(packed(spark, sf, include_mask=False), "packed")
    return packing.flatten_batch(rows).select(
        "batch_id", joined("input_ids"), joined("labels"), joined("cu_seqlens"), "max_seqlen"
    )


@query(
    "k9_collate",
    f"""{SQL_FULL},
text AS (
  SELECT batch_id, seq_idx, string_agg(input_id, ' ' ORDER BY p) AS input_ids, string_agg(label, ' ' ORDER BY p) AS labels,
         string_agg(CAST(position_id AS BIGINT), ' ' ORDER BY p) AS position_ids,
         string_agg(CAST(allowed AS BIGINT), ' ' ORDER BY p) AS allowed_start,
         CAST(count(*) FILTER (label <> -100) AS INT) AS n_valid
  FROM slots GROUP BY batch_id, seq_idx),
docs AS (
  SELECT batch_id, seq_idx, string_agg(CAST(stop AS BIGINT), ' ' ORDER BY idx) AS boundaries,
         string_agg(doc_id, ' ' ORDER BY idx) AS doc_ids
  FROM spans GROUP BY batch_id, seq_idx)
SELECT text.*, boundaries, doc_ids FROM text JOIN docs ON text.batch_id = docs.batch_id AND text.seq_idx = docs.seq_idx""",
)
def collate(spark, sf):
    arrays = ("doc_ids", "input_ids", "labels", "position_ids", "boundaries", "allowed_start")
    return packed(spark, sf).select("batch_id", "seq_idx", *[joined(c) for c in arrays], "n_valid")


@query(
    "k10_fill",
    f"""{SQL_FULL}
SELECT batch_id, count(DISTINCT seq_idx) AS sequences, count(*) FILTER (label <> -100) AS valid_labels,
       round(count(*) FILTER (label <> -100) / count(*), 9) AS fill
FROM slots GROUP BY batch_id""",
)
def fill(spark, sf):
    return packing.layout_fill(placed(spark, sf), b.SEQ_LEN).withColumn("fill", F.round("fill", 9))


@query(
    "s7_packed_sink",
    f"""{SQL_FULL}
SELECT batch_id // {ACCUM} // {STEPS_PER_BUCKET} AS step_bucket, batch_id // {ACCUM} AS step,
       count(DISTINCT batch_id * 1000 + seq_idx) AS sequences, count(*) FILTER (label <> -100) AS valid_labels
FROM slots WHERE batch_id // {ACCUM} >= 1 GROUP BY batch_id // {ACCUM}""",
)
def packed_sink(spark, sf):
    path = scratch_path(spark, "sink")
    stepped = packed(spark, sf, include_mask=False).withColumn("step", F.floor(F.col("batch_id") / ACCUM).cast("bigint"))
    write_packed(stepped, path, STEPS_PER_BUCKET)
    back = read_packed(spark, path, first_step=1, steps_per_bucket=STEPS_PER_BUCKET)
    return back.groupBy("step_bucket", "step").agg(
        F.count(F.lit(1)).alias("sequences"), F.sum("n_valid").alias("valid_labels")
    ).withColumn("step_bucket", F.col("step_bucket").cast("bigint"))
