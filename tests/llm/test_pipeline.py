"""The pipeline stage by stage: what each drops and what it must keep."""

from pyspark.sql import functions as F

import corpus_pipeline
from corpusflow.llm import decontaminate, lines, simhash, toxicity
from corpusflow.llm.tables import table


def test_stages_apply_their_operators(spark, sf):
    docs, seen = table(spark, sf, "documents"), {}
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, docs, sf)
        seen[name] = (docs, after)
        if name != "mixing":
            assert after.columns == docs.columns
        docs = spark.createDataFrame(after.collect(), after.schema)
    ids = lambda df: {r.doc_id for r in df.select("doc_id").collect()}
    before, after = seen["toxicity"]
    model = toxicity.learn(before, table(spark, sf, "labels"))
    assert ids(after) == {r.doc_id for r in toxicity.score(before, model).collect() if r.score < 0.5}
    before, after = seen["line_dedup"]
    cut = {r.doc_id: r.text for r in lines.dedupe_lines(before).collect()}
    assert {r.doc_id: r.text for r in after.collect()} == {i: t for i, t in cut.items() if t.strip()}
    assert all(r.n_chars == len(r.text) for r in after.collect())
    before, after = seen["simhash_dedup"]
    groups = {}
    for r in simhash.near_texts(before).collect():
        groups.setdefault(r.group, []).append(r.id)
    assert ids(after) == {min(members) for members in groups.values()} and after.count() == len(groups)
    before, after = seen["decontamination"]
    found = decontaminate.contamination(before, table(spark, sf, "benchmark")).collect()
    assert ids(after) == {r.doc_id for r in found if not r.contaminated}
    before, after = seen["mixing"]
    assert ids(after) == ids(before) and after.count() == before.count()


def test_empty_documents(spark, sf, tmp_path):
    for name in ("documents", "labels", "benchmark"):
        table(spark, sf, name).limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_document_stage_edges(spark):
    rows = [(3, "one two three four five six", "a"), (1, "One  two three four five six", "b"), (None, "one two three four five six", "c"),
            (7, None, "d"), (8, "", "e"), (9, "other words stand here alone", "f"), (9, "a text that shares the id alone", "g"),
            (9, "a text that shares the id alone", "g"), (None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, `_id` string").withColumn("group", F.lit("x")).withColumn("row", F.lit(1))
    kept = corpus_pipeline.dedupe_documents(spark, docs, "")
    assert kept.columns == docs.columns
    got = sorted(((r.doc_id, r.text, r._id) for r in kept.collect()), key=str)
    assert got == sorted([rows[1], rows[2], rows[3], rows[5], rows[6], rows[8]], key=str)
    assert all(r.group == "x" and r.row == 1 for r in kept.collect())
    assert corpus_pipeline.dedupe_documents(spark, docs.limit(0), "").count() == 0
