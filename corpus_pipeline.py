"""From raw documents to a mix for training: five stages, each written as Parquet and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from corpusflow.llm import decontaminate, lines, pfair, simhash, toxicity
from corpusflow.llm.queries import SHARES
from corpusflow.llm.tables import table
from corpusflow.session import materialise


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learnt from the labels of ``sf_dir``, scores below one half."""
    model = toxicity.learn(docs, table(spark, sf_dir, "labels"))
    return toxicity.scored(docs, model, out="_toxic").where(F.col("_toxic") < 0.5).drop("_toxic")


def dedupe_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that repeat others; ``n_chars`` follows. Those that lose their last line go."""
    cut = lines.dedupe_lines(docs)
    left = cut.where((F.col("n_removed") == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    chars = F.when(F.col("n_removed") > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    return left.withColumn("n_chars", chars).select(docs.columns)


def dedupe_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates (five-word shingles, similarity 0.8) the row with the smallest id, and of rows
    that share it the one with the smallest hash; rows without an id stay as they are. Rows equal in all columns are one."""
    place = F.struct("id", "row")
    groups = simhash.near_texts(docs).where("id is not null")
    first = groups.groupBy("group").agg(F.min(place).alias("first")).select("first.row", F.col("first.id").alias("id"))
    named = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"), F.col("doc_id").cast("bigint").alias("_id"), simhash.row_hash(docs).alias("_row"))
    kept = named.join(first.select(F.col("id").alias("_id"), F.col("row").alias("_row")), ["_id", "_row"], "left_semi")
    once = kept.dropDuplicates(["_id", "_row"]).unionByName(named.where("_id is null"))
    return once.select("_doc.*")


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item of ``sf_dir`` is found."""
    found = decontaminate.contamination(docs, table(spark, sf_dir, "benchmark"), columns=docs.columns)
    return found.where("not contaminated").select(docs.columns)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their place in the mix of the sources."""
    return pfair.mix(docs, SHARES)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", dedupe_lines),
    ("simhash_dedup", dedupe_documents),
    ("decontamination", decontaminated),
    ("mixing", mixed),
]

#: A trained classifier, SimHash links and edit distances are beyond SQL; tests hold stages against plain loops.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents of ``sf_dir`` through all stages. An empty table gives an empty mix."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return docs
