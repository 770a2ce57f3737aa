"""How the test tables stand in for corpora, conversations, logs and scores.

Each role exists twice: as a DataFrame here, and as SQL common table expressions for the checks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from corpusflow.functions import text as tx
from corpusflow.functions.hashing import hash_uniform, int_div
from corpusflow.operators import mixing, tokens
from corpusflow.operators.ordering import ordered_position

SEED = 42
BUFFER = 256
VOCAB_SIZE = 5000
SEQ_LEN = 512
BATCH = 32
DOCS_PER_SEQUENCE = 4
EPOCHS = 3
WEB_BUDGET = 150_000
TOTAL_BUDGET = 160_000

DOMAINS = (
    mixing.Domain("web", 0.87, (("web_a", 2.0), ("web_b", 1.0))),
    mixing.Domain("code", 0.10, (("code_a", 1.0), ("code_b", 1.0))),
    mixing.Domain("math", 0.03, (("math_a", 3.0), ("math_b", 1.0))),
)
BUDGETED = (
    mixing.Domain("web", 0.87, (("web_a", 2.0), ("web_b", 1.0)), max_tokens=WEB_BUDGET),
    mixing.Domain("code", 0.10, (("code_a", 1.0), ("code_b", 1.0))),
    mixing.Domain("math", 0.03, (("math_a", 3.0), ("math_b", 1.0)), max_tokens=0),
)


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def near(column: Column | str, digits: int = 6) -> Column:
    """Round for comparison. Many values here are short decimals ending in a 5 just behind the compared
    digits; a tiny shift takes them off that edge, where engines round the same value differently."""
    value = F.col(column) if isinstance(column, str) else column
    return F.round(value + F.lit(float(f"3.14159e-{digits + 2}")), digits)


def near_sql(expression: str, digits: int = 6) -> str:
    """SQL of near."""
    return f"round({expression} + 3.14159e-{digits + 2}, {digits})"


# ------------------------------------------------------------------ corpus

def corpus(spark: SparkSession, sf: str) -> DataFrame:
    """documents with a domain from the language and a source from the parity of its number."""
    domain = F.when(F.col("lang") == "en", "web").when(F.col("lang") == "de", "code").otherwise("math")
    parity = F.when(F.substring("source", 4, 10).cast("int") % 2 == 0, "_a").otherwise("_b")
    return table(spark, sf, "documents").select(
        "doc_id", "text", domain.alias("domain"), F.concat(domain, parity).alias("source")
    )


def counted(spark: SparkSession, sf: str) -> DataFrame:
    """The narrow frame that mixing works on."""
    return corpus(spark, sf).select(
        "doc_id", "domain", "source",
        tx.word_count(F.col("text")).cast("bigint").alias("n_tokens"),
        tx.non_empty(F.col("text")).alias("has_text"),
    )


def mixed(spark: SparkSession, sf: str) -> DataFrame:
    """The whole corpus in mix order, no budgets."""
    return mixing.mix(counted(spark, sf), mixing.mix_config(spark, DOMAINS), SEED, BUFFER)


def vocabulary(spark: SparkSession, sf: str) -> DataFrame:
    return tokens.build_vocab(corpus(spark, sf).select("text"), VOCAB_SIZE)


def encoded(spark: SparkSession, sf: str, max_length: int | None = None) -> DataFrame:
    """(doc_id, ids) without special tokens, cut to ``max_length`` where one is given."""
    return tokens.encode(corpus(spark, sf), vocabulary(spark, sf), max_length).select("doc_id", "ids")


def hb(salt: str, *keys: str) -> str:
    """SQL of hashing.hash_bits."""
    return f"('0x' || substr(md5('{SEED}:{salt}:' || {' || chr(58) || '.join(keys)}), 1, 12))::BIGINT"


def hu(salt: str, *keys: str) -> str:
    """SQL of hashing.hash_uniform."""
    return f"(({hb(salt, *keys)} + 0.5) / 281474976710656.0::DOUBLE)"


SQL_WORDS = r"regexp_extract_all(text, '[^ \t\n\r\f]+')"

SQL_CORPUS = f"""
corpus AS (
  SELECT doc_id, text,
         CASE WHEN lang = 'en' THEN 'web' WHEN lang = 'de' THEN 'code' ELSE 'math' END AS domain,
         CASE WHEN lang = 'en' THEN 'web' WHEN lang = 'de' THEN 'code' ELSE 'math' END
           || CASE WHEN CAST(substr(source, 4) AS INT) % 2 = 0 THEN '_a' ELSE '_b' END AS source
  FROM documents),
counted AS (
  SELECT doc_id, domain, source, CAST(len({SQL_WORDS}) AS BIGINT) AS n_tokens, text <> '' AS has_text FROM corpus)
"""


def config_sql(domains: tuple[mixing.Domain, ...]) -> str:
    rows = ", ".join(
        f"('{d.name}', CAST({d.weight} AS DOUBLE), '{s}', CAST({w} AS DOUBLE), CAST({d.max_tokens or 0} AS BIGINT))"
        for d in domains for s, w in d.sources
    )
    return f"""
cfg0(domain, domain_weight, source, source_weight, max_tokens) AS (VALUES {rows}),
cfg AS (
  SELECT domain, domain_weight, source, source_weight / sum(source_weight) OVER (PARTITION BY domain) AS source_weight,
         max_tokens
  FROM cfg0)"""


def mix_sql(domains: tuple[mixing.Domain, ...] = DOMAINS, total: int | None = None) -> str:
    """CTEs corpus, counted, cfg, interleaved (pos), shuffled (pos), budgeted and mixed (mix_pos)."""
    keep = f"WHERE mixed_before < {total}" if total else ""
    return f"""{SQL_CORPUS}, {config_sql(domains)},
gaps AS (
  SELECT c.*, cfg.domain_weight, cfg.max_tokens, {hb('shuffle', 'c.source', 'c.doc_id')} AS h,
         CAST(floor(-ln({hu('source', 'c.doc_id')}) / cfg.source_weight * 65536) AS BIGINT) AS gap
  FROM counted c JOIN cfg ON c.domain = cfg.domain AND c.source = cfg.source),
raced AS (
  SELECT *, CAST(sum(gap) OVER (PARTITION BY domain, source ORDER BY h, doc_id ROWS UNBOUNDED PRECEDING) AS BIGINT)
         AS arrival
  FROM gaps),
interleaved AS (
  SELECT *, row_number() OVER (PARTITION BY domain ORDER BY arrival, h, doc_id) AS pos FROM raced WHERE has_text),
shuffled AS (
  SELECT * REPLACE ((pos - 1) // {BUFFER} * {BUFFER} + row_number() OVER (
           PARTITION BY domain, (pos - 1) // {BUFFER} ORDER BY {hb('block', 'doc_id')}, doc_id) AS pos)
  FROM interleaved),
priced AS (
  SELECT *, CAST(coalesce(sum(n_tokens) OVER (PARTITION BY domain ORDER BY pos
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS tokens_before,
         CAST(sum(CAST(floor(-ln({hu('domain', 'doc_id')}) / domain_weight * 65536) AS BIGINT))
              OVER (PARTITION BY domain ORDER BY pos ROWS UNBOUNDED PRECEDING) AS BIGINT) AS mix_arrival
  FROM shuffled),
budgeted AS (SELECT * FROM priced WHERE max_tokens = 0 OR tokens_before < max_tokens),
unbounded AS (
  SELECT *, row_number() OVER w AS mix_pos,
         CAST(coalesce(sum(n_tokens) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT)
           AS mixed_before
  FROM budgeted WINDOW w AS (ORDER BY mix_arrival, {hb('tie', 'doc_id')}, doc_id)),
mixed AS (SELECT * FROM unbounded {keep})"""


def vocab_sql(source: str = "documents") -> str:
    """CTEs freq and vocab over the texts of ``source``."""
    return f"""
freq AS (SELECT token, count(*) AS n FROM (SELECT unnest({SQL_WORDS}) AS token FROM {source}) GROUP BY token),
vocab AS (
  SELECT token, n, id FROM (
    SELECT token, n, CAST(row_number() OVER (ORDER BY n DESC, token) + 3 AS INT) AS id FROM freq)
  WHERE id < {VOCAB_SIZE}
  UNION ALL SELECT * FROM (VALUES ('<unk>', CAST(0 AS BIGINT), 0), ('<s>', CAST(0 AS BIGINT), 1),
                                  ('</s>', CAST(0 AS BIGINT), 2), ('<pad>', CAST(0 AS BIGINT), 3)))"""


def ids_sql(source: str = "documents", key: str = "doc_id") -> str:
    """vocab_sql and ids: one row per (key, idx), the id of the token at offset idx (0-based)."""
    return f"""{vocab_sql(source)},
spread AS (
  SELECT {key}, unnest({SQL_WORDS}) AS token, unnest(range(len({SQL_WORDS}))) AS idx FROM {source}),
ids AS (
  SELECT s.{key}, s.idx, coalesce(v.id, 0) AS id FROM spread s LEFT JOIN vocab v ON s.token = v.token AND v.id > 3)"""


def padded_sql(source: str, key: str, length: int = SEQ_LEN) -> str:
    """ids_sql and filled: (key, idx, id, m) on every place up to ``length``, m = 0 on padding."""
    return f"""{ids_sql(source, key)},
grid AS (SELECT {key}, unnest(range({length})) AS idx FROM {source}),
filled AS (
  SELECT g.{key}, g.idx, coalesce(i.id, 3) AS id, CASE WHEN i.idx IS NULL THEN 0 ELSE 1 END AS m
  FROM grid g LEFT JOIN ids i ON g.{key} = i.{key} AND g.idx = i.idx)"""


SQL_VOCAB = vocab_sql()
SQL_IDS = ids_sql()

# ------------------------------------------------------------------ conversations


def first_turns(spark: SparkSession, sf: str) -> DataFrame:
    """Per conversation: the first user turn and the first and last assistant turns."""
    said = lambda role: F.when(F.col("role") == role, F.col("turn"))
    return table(spark, sf, "conversations").groupBy("conv_id").agg(
        F.coalesce(F.min_by("text", said("user")), F.lit("")).alias("prompt"),
        F.coalesce(F.min_by("text", said("assistant")), F.lit("")).alias("first_reply"),
        F.coalesce(F.max_by("text", said("assistant")), F.lit("")).alias("last_reply"),
    )


def pair_logps(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Policy and reference log-probabilities per conversation; the reference misses every fifth."""
    ids = table(spark, sf, "conversations").select(F.col("conv_id").alias("pair_id")).distinct()
    score = lambda name: (F.lit(-100.0) * hash_uniform(SEED, name, F.col("pair_id"))).alias(name)
    policy = ids.select("pair_id", score("policy_chosen"), score("policy_rejected"))
    reference = ids.where(F.col("pair_id") % 5 != 0).select("pair_id", score("ref_chosen"), score("ref_rejected"))
    return policy, reference


SQL_TURNS = """
turns AS (
  SELECT conv_id, coalesce(arg_min(text, turn) FILTER (role = 'user'), '') AS prompt,
         coalesce(arg_min(text, turn) FILTER (role = 'assistant'), '') AS first_reply,
         coalesce(arg_max(text, turn) FILTER (role = 'assistant'), '') AS last_reply
  FROM conversations GROUP BY conv_id)"""

SQL_CHATS = r"""
chats AS (
  SELECT conv_id, string_agg('<|' || coalesce(role, 'user') || E'|>\n' || coalesce(text, '') || E'\n', '' ORDER BY turn) AS text
  FROM conversations GROUP BY conv_id)"""

SQL_PAIRS = f"""
pairs AS (
  SELECT pair_id, -100.0::DOUBLE * {hu('policy_chosen', 'pair_id')} AS policy_chosen,
         -100.0::DOUBLE * {hu('policy_rejected', 'pair_id')} AS policy_rejected,
         CASE WHEN pair_id % 5 = 0 THEN 0.0 ELSE -100.0::DOUBLE * {hu('ref_chosen', 'pair_id')} END AS ref_chosen,
         CASE WHEN pair_id % 5 = 0 THEN 0.0 ELSE -100.0::DOUBLE * {hu('ref_rejected', 'pair_id')} END AS ref_rejected
  FROM (SELECT DISTINCT conv_id AS pair_id FROM conversations))"""

# ------------------------------------------------------------------ token scores and candidates

_LINE_ORDER = (
    "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_discount", "l_tax", "l_returnflag",
    "l_linestatus",
)


def _placed_lines(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem").select("l_orderkey", *_LINE_ORDER)
    return ordered_position(lines, ["l_orderkey"], _LINE_ORDER, "pos").withColumn("pos", F.col("pos") - 1)


def token_logps(spark: SparkSession, sf: str) -> DataFrame:
    """lineitem as (domain, batch_id, seq_id, pos, label, logp)."""
    return _placed_lines(spark, sf).select(
        F.col("l_linestatus").alias("domain"), int_div(F.col("l_orderkey"), 64).alias("batch_id"),
        F.col("l_orderkey").alias("seq_id"), "pos",
        F.when(F.col("l_returnflag") == "A", F.lit(-100)).otherwise(F.col("l_partkey")).alias("label"),
        (F.lit(-10.0) * F.col("l_discount") - F.lit(0.1)).alias("logp"),
    )


def candidates(spark: SparkSession, sf: str) -> DataFrame:
    """lineitem as (query_id, token_id, logit)."""
    return _placed_lines(spark, sf).select(
        F.col("l_orderkey").alias("query_id"), F.col("pos").alias("token_id"),
        (F.col("l_extendedprice") / 10000).alias("logit"),
    )


SQL_LINES = f"""
lines AS (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY {', '.join(_LINE_ORDER)}) - 1 AS pos FROM lineitem),
logps AS (
  SELECT l_linestatus AS domain, l_orderkey // 64 AS batch_id, l_orderkey AS seq_id, pos,
         CASE WHEN l_returnflag = 'A' THEN -100 ELSE l_partkey END AS label, -10.0::DOUBLE * l_discount - 0.1::DOUBLE AS logp
  FROM lines),
cand AS (SELECT l_orderkey AS query_id, pos AS token_id, l_extendedprice / 10000 AS logit FROM lines)"""

# ------------------------------------------------------------------ responses


def responses(spark: SparkSession, sf: str) -> DataFrame:
    """orders as (response_id, prompt_id, question, completion, response, answer).

    The response shows the order's total after ####, as its last number, not at all, or wrong.
    """
    total = F.floor("o_totalprice").cast("bigint")
    kind = F.col("o_orderkey") % 4
    said = (
        F.when(kind == 0, F.concat(F.lit("so the sum is #### "), F.format_number(total, 0)))
        .when(kind == 1, F.concat(F.lit("first 3, then "), F.format_number(total, 0), F.lit(".")))
        .when(kind == 2, F.lit("no idea"))
        .otherwise(F.concat(F.lit("####  "), F.format_number(total + 1, 0)))
    )
    question = F.concat(F.lit("What did customer "), F.col("o_custkey").cast("string"), F.lit(" pay?"))
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("response_id"), int_div(F.col("o_orderkey"), 4).alias("prompt_id"),
        question.alias("question"), said.alias("response"),
        F.concat(tx.question_prompt(question), F.lit(" "), said, F.lit(" \n")).alias("completion"),
        F.concat(F.lit("$"), F.format_number(total, 0)).alias("answer"),
    )


SQL_RESPONSES = r"""
totals AS (
  SELECT o_orderkey, o_custkey, CAST(floor(o_totalprice) AS BIGINT) AS total FROM orders),
responses AS (
  SELECT o_orderkey AS response_id, o_orderkey // 4 AS prompt_id,
         'What did customer ' || o_custkey || ' pay?' AS question,
         CASE o_orderkey % 4 WHEN 0 THEN 'so the sum is #### ' || format('{:,}', total)
              WHEN 1 THEN 'first 3, then ' || format('{:,}', total) || '.'
              WHEN 2 THEN 'no idea' ELSE '####  ' || format('{:,}', total + 1) END AS response,
         '$' || format('{:,}', total) AS answer
  FROM totals),
checked AS (
  SELECT *, replace(nullif(regexp_extract(response, '####\s*([+-]?\d+(?:,\d{3})*(?:\.\d+)?)', 1), ''), ',', '') AS marked,
         replace(regexp_extract_all(response, '[+-]?\d+(?:,\d{3})*(?:\.\d+)?')[-1], ',', '') AS last_seen,
         regexp_replace(answer, '[^\d.-]', '', 'g') AS cleaned
  FROM responses),
rewarded AS (
  SELECT *, CAST(coalesce(try_cast(coalesce(marked, last_seen) AS DOUBLE) = try_cast(cleaned AS DOUBLE), false) AS DOUBLE)
         AS reward
  FROM checked)"""
