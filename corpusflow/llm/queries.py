"""The named queries of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from corpusflow.llm import (
    decontaminate, language, lines, paragraphs, pfair, pii, quality, search, simhash, suffixes, toxicity, turntrie, warc,
)
from corpusflow.llm.tables import table

Build = Callable[[SparkSession, str], DataFrame]

#: Target shares of the sources: one to four parts by the number of the source, one for all others.
SHARES = {f"src{i}": 1 + i % 4 for i in range(20)}


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of every document, how many of them repeat others, and a digest of what is left."""
    cut = lines.dedupe_lines(table(spark, sf_dir, "documents").select("doc_id", "text"), exact_words=1)
    return cut.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op2_weak_supervision(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, votes and quality of every document."""
    return quality.weak_supervision(table(spark, sf_dir, "documents"))


def op3_pfair_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place of every document in a mix of the sources by target shares."""
    return pfair.mix(table(spark, sf_dir, "documents").select("doc_id", "source"), SHARES)


def op5_cgk_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items found in every document."""
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_simhash_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), width=3, distance=3)


def op6_toxicity_nbsvm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document, learnt from four fifths of the labels."""
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_paragraph_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many paragraphs and passages of every document repeat others, the words of those of over 50 words, and a digest of what is left."""
    cut = paragraphs.dedupe_paragraphs(table(spark, sf_dir, "documents").select("doc_id", "text"), passage_words=51)
    return cut.select("doc_id", "n_removed", "n_passage_words", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op8_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entities of every document, and its text with surrogates in their place."""
    return pii.replace_entities(table(spark, sf_dir, "documents").select("doc_id", "text"), key="corpus key")


def op9_warc_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the archive of all pages says of each page."""
    return warc.archived(table(spark, sf_dir, "pages"))


def op10_suffix_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of every document that an earlier document holds in strings of 50 bytes."""
    return suffixes.remove_repeats(table(spark, sf_dir, "documents"), length=50).drop("kept")


def op11_turn_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes of the prefix trie of all rebuilt conversations."""
    return turntrie.prefix_trie(table(spark, sf_dir, "conversations"))


def op12_byte_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learnt from three quarters of those that name theirs."""
    return language.language_id(table(spark, sf_dir, "documents"))


def op13_fp_tree_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents for every benchmark item."""
    return search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=10)


QUERIES: dict[str, Build] = {
    "op1_line_dedup": op1_line_dedup,
    "op2_weak_supervision": op2_weak_supervision,
    "op3_pfair_mix": op3_pfair_mix,
    "op4_simhash_anchors": op4_simhash_anchors,
    "op5_cgk_decontamination": op5_cgk_decontamination,
    "op6_toxicity_nbsvm": op6_toxicity_nbsvm,
    "op7_paragraph_minhash": op7_paragraph_minhash,
    "op8_pii_surrogates": op8_pii_surrogates,
    "op9_warc_chain": op9_warc_chain,
    "op10_suffix_repeats": op10_suffix_repeats,
    "op11_turn_trie": op11_turn_trie,
    "op12_byte_cnn": op12_byte_cnn,
    "op13_fp_tree_search": op13_fp_tree_search,
}

OP9_SQL = """
WITH sized AS (
    SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
    FROM pages),
firsts AS (SELECT payload_digest, min(page_id) AS first FROM sized WHERE payload_bytes >= 100 GROUP BY 1)
SELECT s.page_id, s.payload_bytes, s.payload_digest,
    CASE WHEN f.first IS NOT NULL AND s.page_id IS DISTINCT FROM f.first THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN s.page_id IS DISTINCT FROM f.first THEN f.first END AS refers_to
FROM sized s LEFT JOIN firsts f ON f.payload_digest = s.payload_digest AND s.payload_bytes >= 100"""

CHECKS: dict[str, str] = {
    "op3_pfair_mix": pfair.mix_sql("documents", SHARES), "op9_warc_chain": OP9_SQL,
    "op11_turn_trie": turntrie.trie_sql(), "op13_fp_tree_search": search.search_sql(),
}
