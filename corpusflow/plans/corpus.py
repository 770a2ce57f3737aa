"""Queries over documents: sources, selection, order, mixing, tokens."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusflow.functions import text as tx
from corpusflow.functions.hashing import hash_bits
from corpusflow.operators import mixing, packing, selection, tokens
from corpusflow.operators.ordering import Running, chunk_by_hash, row_count, running
from corpusflow.plans import bindings as b
from corpusflow.plans.registry import query
from corpusflow.session import materialise
from corpusflow.sources import domains


def _sources(sf: str):
    return (
        domains.Source("documents", "web", f"{sf}/documents.parquet"),
        domains.Source("pages", "web", f"{sf}/pages.parquet", key=("page_id",), text_field="html"),
        domains.Source("conversations", "code", f"{sf}/conversations.parquet", key=("conv_id", "turn")),
        domains.Source("benchmark", "math", f"{sf}/benchmark.parquet", key=("item_id",)),
        domains.Source("absent", "math", f"{sf}/absent.parquet"),
    )


_UNION = """
WITH u AS (
  SELECT 'web' AS domain, 'documents' AS source, CAST(doc_id AS VARCHAR) AS key, text FROM documents
  UNION ALL SELECT 'web', 'pages', CAST(page_id AS VARCHAR), html FROM pages
  UNION ALL SELECT 'code', 'conversations', CAST(conv_id AS VARCHAR) || ':' || CAST(turn AS VARCHAR), text FROM conversations
  UNION ALL SELECT 'math', 'benchmark', CAST(item_id AS VARCHAR), text FROM benchmark)
"""


@query("s1_domain_scan", _UNION + "SELECT domain, source, key, CAST(length(text) AS BIGINT) AS chars FROM u")
def domain_scan(spark, sf):
    scanned = domains.scan_domains(spark, _sources(sf), on_missing="skip")
    return scanned.select("domain", "source", "key", F.length("text").cast("bigint").alias("chars"))


@query("s2_split", "SELECT doc_id, source FROM documents WHERE lang = 'en'")
def split(spark, sf):
    return domains.select_split(b.table(spark, sf, "documents"), "en", "lang").select("doc_id", "source")


@query("s3_text_field", "SELECT page_id, md5(coalesce(html, '')) AS text_md5, md5('') AS missing_md5 FROM pages")
def text_field(spark, sf):
    pages = b.table(spark, sf, "pages")
    chosen = domains.select_text(domains.select_text(pages, "html"), None, "body", out="missing")
    return chosen.select("page_id", F.md5("text").alias("text_md5"), F.md5("missing").alias("missing_md5"))


@query("s4_first_rows", "SELECT doc_id, lang FROM documents ORDER BY doc_id LIMIT 100")
def first_rows(spark, sf):
    return domains.head(b.table(spark, sf, "documents"), 100, ["doc_id"]).select("doc_id", "lang")


@query(
    "p1_drop_empty",
    "SELECT doc_id, lang FROM documents WHERE coalesce(text, '') <> ''",
)
def drop_empty(spark, sf):
    return domains.drop_empty(b.table(spark, sf, "documents")).select("doc_id", "lang")


@query("p2_min_tokens", f"WITH {b.SQL_CORPUS} SELECT doc_id, domain, n_tokens FROM counted WHERE n_tokens > 100")
def min_tokens(spark, sf):
    return selection.longer_than(b.counted(spark, sf)).select("doc_id", "domain", "n_tokens")


_HEADS = f"""
WITH {b.SQL_CORPUS},
plan(domain, n, k) AS (VALUES ('web', 5000, 100), ('code', 2000, 50), ('math', 1000, 20)),
heads AS (
  SELECT c.doc_id, c.domain, c.text, c.row_index FROM (
    SELECT *, row_number() OVER (PARTITION BY domain ORDER BY doc_id) - 1 AS row_index FROM corpus) c
  JOIN plan USING (domain) WHERE c.row_index < plan.n AND c.row_index % plan.k = 0)
"""


@query("p3_head_sample", _HEADS + "SELECT domain, doc_id, row_index FROM heads")
def head_sample(spark, sf):
    return selection.head_sample(b.corpus(spark, sf)).select("domain", "doc_id", "row_index")


@query("p5_column_pruning", "SELECT doc_id, md5(text) AS text_md5 FROM documents")
def column_pruning(spark, sf):
    mapped = b.table(spark, sf, "documents").withColumn("text_md5", F.md5("text"))
    return mapped.select("doc_id", "text_md5")


@query(
    "p6_micro_batches",
    f"WITH {b.mix_sql()} SELECT doc_id, (mix_pos - 1) // {b.BATCH} AS batch_id, (mix_pos - 1) % {b.BATCH} AS idx FROM mixed",
)
def micro_batches(spark, sf):
    return packing.assign_batches(b.mixed(spark, sf), b.BATCH).select("doc_id", "batch_id", "idx")


@query(
    "p7_optimizer_steps",
    f"""WITH {b.mix_sql()}, s AS (
  SELECT doc_id, (mix_pos - 1) // {b.BATCH} AS batch_id, (mix_pos - 1) // {b.BATCH} // 3 AS step,
         (count(*) OVER () - 1) // {b.BATCH} + 1 AS batches FROM mixed)
SELECT doc_id, batch_id, step FROM s WHERE (step + 1) * 3 <= batches""",
)
def optimizer_steps(spark, sf):
    batched = materialise(packing.assign_batches(b.mixed(spark, sf), b.BATCH), "batches")
    return packing.assign_steps(batched, 3).select("doc_id", "batch_id", "step")


@query(
    "o1_global_position",
    f"""WITH {b.SQL_CORPUS}
SELECT doc_id, row_number() OVER w AS pos, CAST(sum(n_tokens) OVER (w ROWS UNBOUNDED PRECEDING) AS BIGINT) AS tokens_upto,
       CAST(coalesce(sum(n_tokens) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS tokens_before
FROM counted WINDOW w AS (ORDER BY {b.hb('order', 'doc_id')}, doc_id)""",
)
def global_position(spark, sf):
    keyed = b.counted(spark, sf).withColumn("h", hash_bits(b.SEED, "order", F.col("doc_id")))
    placed = running(
        keyed, [], ["h", "doc_id"],
        {
            "pos": row_count(),
            "tokens_upto": Running("sum", F.col("n_tokens")),
            "tokens_before": Running("sum", F.col("n_tokens"), exclusive=True),
        },
        chunk=chunk_by_hash(keyed, F.col("h")),
    )
    return placed.select("doc_id", "pos", "tokens_upto", "tokens_before")


@query(
    "m1_source_weights",
    f"""WITH {b.SQL_CORPUS}, {b.config_sql(b.DOMAINS)}
SELECT cfg.domain, cfg.source, round(source_weight, 9) AS source_weight, docs
FROM cfg JOIN (SELECT domain, source, count(*) AS docs FROM counted GROUP BY ALL) d
  ON cfg.domain = d.domain AND cfg.source = d.source""",
)
def source_weights(spark, sf):
    config = mixing.normalize_weights(mixing.mix_config(spark, b.DOMAINS))
    docs = b.corpus(spark, sf).groupBy("domain", "source").agg(F.count(F.lit(1)).alias("docs"))
    joined = docs.join(F.broadcast(config), ["domain", "source"])
    return joined.select("domain", "source", F.round("source_weight", 9).alias("source_weight"), "docs")


@query(
    "m11_source_shuffle",
    f"""WITH {b.SQL_CORPUS}
SELECT doc_id, source, row_number() OVER (PARTITION BY domain, source ORDER BY {b.hb('shuffle', 'source', 'doc_id')}, doc_id)
       AS source_pos FROM counted""",
)
def source_shuffle(spark, sf):
    return mixing.source_shuffle(b.counted(spark, sf), b.SEED).select("doc_id", "source", "source_pos")


@query("m2_source_interleave", f"WITH {b.mix_sql()} SELECT doc_id, domain, source, arrival, pos FROM interleaved")
def source_interleave(spark, sf):
    raced = mixing.interleave_sources(b.counted(spark, sf), mixing.mix_config(spark, b.DOMAINS), b.SEED)
    return raced.select("doc_id", "domain", "source", "arrival", "pos")


@query("m3_block_shuffle", f"WITH {b.mix_sql()} SELECT doc_id, domain, pos FROM shuffled")
def block_shuffle(spark, sf):
    raced = mixing.interleave_sources(b.counted(spark, sf), mixing.mix_config(spark, b.DOMAINS), b.SEED)
    return mixing.block_shuffle(raced, b.BUFFER, b.SEED).select("doc_id", "domain", "pos")


@query(
    "m3_full_shuffle",
    f"""WITH {b.SQL_CORPUS}
SELECT doc_id, domain, row_number() OVER (PARTITION BY domain ORDER BY {b.hb('block', 'doc_id')}, doc_id) AS pos FROM counted""",
)
def full_shuffle(spark, sf):
    return mixing.block_shuffle(b.counted(spark, sf), None, b.SEED).select("doc_id", "domain", "pos")


@query(
    "m4_domain_budget",
    f"WITH {b.mix_sql(b.BUDGETED)} SELECT doc_id, domain, pos, n_tokens, tokens_before FROM budgeted",
)
def domain_budget(spark, sf):
    raced = mixing.interleave_sources(b.counted(spark, sf), mixing.mix_config(spark, b.BUDGETED), b.SEED)
    kept = mixing.domain_budget(mixing.block_shuffle(raced, b.BUFFER, b.SEED))
    return kept.select("doc_id", "domain", "pos", "n_tokens", "tokens_before")


@query("m5_domain_mix", f"WITH {b.mix_sql()} SELECT doc_id, domain, source, mix_pos, mixed_before FROM mixed")
def domain_mix(spark, sf):
    return b.mixed(spark, sf).select("doc_id", "domain", "source", "mix_pos", "mixed_before")


_DRAW = f"""
CASE WHEN {b.hu('draw', 'doc_id')} <= 0.87 THEN 'web' WHEN {b.hu('draw', 'doc_id')} <= 0.97 THEN 'code' ELSE 'math' END
"""


@query("m6_domain_draw", f"SELECT doc_id, {_DRAW} AS drawn FROM documents")
def domain_draw(spark, sf):
    drawn = mixing.categorical_draw(list(mixing.DEFAULT_WEIGHTS.items()), b.SEED, F.col("doc_id"))
    return b.table(spark, sf, "documents").select("doc_id", drawn.alias("drawn"))


def _budgeted_mix(spark, sf):
    return mixing.mix(
        b.counted(spark, sf), mixing.mix_config(spark, b.BUDGETED), b.SEED, b.BUFFER, total_tokens=b.TOTAL_BUDGET
    )


@query(
    "m7_total_budget",
    f"WITH {b.mix_sql(b.BUDGETED, b.TOTAL_BUDGET)} SELECT doc_id, domain, mix_pos, n_tokens, mixed_before FROM mixed",
)
def total_budget(spark, sf):
    return _budgeted_mix(spark, sf).select("doc_id", "domain", "mix_pos", "n_tokens", "mixed_before")


_LEDGER = """
SELECT coalesce(domain, '*') AS domain, coalesce(source, '*') AS source, count(*) AS docs,
       CAST(sum(n_tokens) AS BIGINT) AS tokens_yielded, max(mix_pos) AS last_pos
FROM mixed GROUP BY ROLLUP (domain, source)
"""


@query("m8_mix_ledger", f"WITH {b.mix_sql()} {_LEDGER}")
def mix_ledger(spark, sf):
    return mixing.mix_ledger(b.mixed(spark, sf))


@query(
    "m9_resume",
    f"WITH {b.mix_sql()} SELECT doc_id, domain, mix_pos FROM mixed WHERE mixed_before >= {b.TOTAL_BUDGET}",
)
def resume(spark, sf):
    whole = materialise(b.mixed(spark, sf), "mix")
    ledger = mixing.mix_ledger(mixing.total_budget(whole, b.TOTAL_BUDGET))
    return mixing.resume_after(whole, ledger).select("doc_id", "domain", "mix_pos")


@query(
    "m10_epoch_shuffle",
    f"""SELECT doc_id, epoch, row_number() OVER (PARTITION BY epoch ORDER BY {b.hb('epoch', 'epoch', 'doc_id')}, doc_id) AS epoch_pos
FROM (SELECT doc_id, unnest(range({b.EPOCHS})) AS epoch FROM documents)""",
)
def epoch_shuffle(spark, sf):
    docs = b.table(spark, sf, "documents").select("doc_id")
    return mixing.epochs(docs, b.EPOCHS, b.SEED, "doc_id").select("doc_id", "epoch", "epoch_pos")


@query("t1_vocabulary", f"WITH {b.SQL_VOCAB} SELECT token, n, id FROM vocab")
def vocabulary(spark, sf):
    return b.vocabulary(spark, sf)


@query(
    "t2_vocab_size",
    f"WITH {b.SQL_VOCAB} SELECT count(*) AS vocab_size, 1 AS bos_id, 2 AS eos_id, 3 AS pad_id FROM vocab",
)
def vocab_size(spark, sf):
    return tokens.vocab_size(b.vocabulary(spark, sf))


def _ids_text(column="ids"):
    return F.array_join(F.col(column).cast("array<string>"), " ")


@query(
    "t3_encode",
    f"WITH {b.SQL_IDS} SELECT doc_id, string_agg(id, ' ' ORDER BY idx) AS ids FROM ids GROUP BY doc_id",
)
def encode(spark, sf):
    return b.encoded(spark, sf).select("doc_id", _ids_text().alias("ids"))


@query(
    "t3_encode_any",
    f"WITH {b.SQL_IDS} SELECT doc_id, string_agg(id, ' ' ORDER BY idx) AS ids FROM ids GROUP BY doc_id",
)
def encode_any(spark, sf):
    coded = tokens.encode_any(b.corpus(spark, sf).select("doc_id", "text"), b.vocabulary(spark, sf), "doc_id")
    return coded.select("doc_id", _ids_text().alias("ids"))


@query(
    "t4_encode_specials",
    f"""WITH {b.SQL_IDS}
SELECT doc_id, '1 ' || string_agg(id, ' ' ORDER BY idx) || ' 2' AS ids FROM ids GROUP BY doc_id""",
)
def encode_specials(spark, sf):
    framed = tokens.encode(b.corpus(spark, sf), b.vocabulary(spark, sf), add_bos=True, add_eos=True)
    return framed.select("doc_id", _ids_text().alias("ids"))


_PAD_SQL = f"WITH {b.padded_sql('documents', 'doc_id')} "


@query(
    "t5_pad",
    _PAD_SQL + """SELECT doc_id, string_agg(id, ' ' ORDER BY idx) AS input_ids, string_agg(m, ' ' ORDER BY idx) AS attention_mask
FROM filled GROUP BY doc_id""",
)
def pad(spark, sf):
    full = tokens.pad(b.encoded(spark, sf), b.SEQ_LEN)
    return full.select("doc_id", _ids_text("input_ids").alias("input_ids"), _ids_text("attention_mask").alias("attention_mask"))


@query(
    "t6_decode",
    f"""WITH {b.SQL_IDS}
SELECT d.doc_id, coalesce(t.text, '') AS text FROM documents d LEFT JOIN (
  SELECT i.doc_id, string_agg(v.token, ' ' ORDER BY i.idx) AS text FROM ids i JOIN vocab v ON i.id = v.id AND v.id > 3
  GROUP BY i.doc_id) t ON d.doc_id = t.doc_id""",
)
def decode(spark, sf):
    vocab = b.vocabulary(spark, sf)
    ids = tokens.encode(b.corpus(spark, sf), vocab).select("doc_id", "ids")
    return tokens.decode(ids, vocab).select("doc_id", "text")


@query(
    "t6_decode_any",
    f"""WITH {b.SQL_IDS}
SELECT d.doc_id, coalesce(t.text, '') AS text FROM documents d LEFT JOIN (
  SELECT i.doc_id, string_agg(v.token, ' ' ORDER BY i.idx) AS text FROM ids i JOIN vocab v ON i.id = v.id AND v.id > 3
  GROUP BY i.doc_id) t ON d.doc_id = t.doc_id""",
)
def decode_any(spark, sf):
    ids = b.encoded(spark, sf)
    return tokens.decode_any(ids, b.vocabulary(spark, sf), "doc_id").select("doc_id", "text")


@query(
    "t7_token_counts",
    f"WITH {b.SQL_CORPUS} SELECT domain, count(*) AS docs, CAST(sum(n_tokens) AS BIGINT) AS tokens FROM counted GROUP BY domain",
)
def token_counts(spark, sf):
    worded = b.corpus(spark, sf).withColumn("words", tx.words(F.col("text")))
    return tokens.token_totals(worded, "domain", "words")
