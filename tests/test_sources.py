import pandas as pd
import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from corpusflow import session
from corpusflow.operators import packing, udfs
from corpusflow.plans import load
from corpusflow.sources import domains
from corpusflow.sources.packed import read_packed, step_slice, write_packed


def sources(sf):
    return (
        domains.Source("docs", "web", f"{sf}/documents.parquet"),
        domains.Source("turns", "code", f"{sf}/conversations.parquet", key=("conv_id", "turn")),
        domains.Source("gone", "math", f"{sf}/gone.parquet"),
    )


def test_missing_sources(spark, sf):
    with pytest.raises(AnalysisException):
        domains.scan_domains(spark, sources(sf))
    with pytest.warns(UserWarning, match="gone"):
        scanned = domains.scan_domains(spark, sources(sf), on_missing="skip")
    assert {r.source for r in scanned.select("source").distinct().collect()} == {"docs", "turns"}
    with pytest.warns(UserWarning):
        assert domains.scan_domains(spark, sources(sf)[2:], on_missing="skip").count() == 0
    with pytest.raises(ValueError):
        domains.scan_domains(spark, sources(sf), on_missing="other")


def test_text_field_and_empties(spark):
    df = spark.createDataFrame([(1, "x"), (2, ""), (3, None)], "id int, content string")
    chosen = domains.select_text(df, "content")
    assert [r.text for r in chosen.orderBy("id").collect()] == ["x", "", ""]
    assert domains.drop_empty(chosen).count() == 1
    assert domains.drop_empty(domains.select_text(df)).count() == 0
    assert domains.head(df, 2, ["id"]).count() == 2 and domains.head(df, 0, ["id"]).count() == 3


def test_split_prunes_partitions(spark):
    path = session.scratch_path(spark, "split")
    df = spark.range(100).withColumn("split", F.when(F.col("id") % 4 == 0, "test").otherwise("train"))
    df.write.partitionBy("split").parquet(path)
    chosen = domains.select_split(spark.read.parquet(path), "train")
    assert chosen.count() == 75
    assert "PartitionFilters: [isnotnull(split" in chosen._jdf.queryExecution().executedPlan().toString()


def test_pushdown_reaches_the_scan(spark, sf):
    plan = domains.select_split(spark.read.parquet(f"{sf}/documents.parquet"), "en", "lang").select("doc_id")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(lang,en)" in text and "ReadSchema: struct<doc_id:bigint,lang:string>" in text


def test_packed_sink_prunes_by_step(spark):
    docs = spark.range(200).select(
        F.col("id").alias("doc_id"), (F.col("id") + 1).alias("mix_pos"), F.array(F.lit(1), F.lit(2)).alias("ids")
    )
    batched = packing.assign_batches(docs, 5).withColumn("slice", step_slice(F.col("batch_id"), 2, 2))
    packed = packing.pack(batched, 8, 4, eos_id=9, together="slice").withColumn("step", F.floor(F.col("batch_id") / 2).cast("bigint"))
    # One shuffle in all: packing by slice. Writing adds none.
    assert packed._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    path = session.scratch_path(spark, "packed")
    write_packed(packed, path, steps_per_bucket=4)
    part = read_packed(spark, path, 5, 9, steps_per_bucket=4)
    assert sorted({r.step for r in part.select("step").collect()}) == [5, 6, 7, 8, 9]
    assert "PartitionFilters: [isnotnull(step_bucket" in part._jdf.queryExecution().executedPlan().toString()
    assert read_packed(spark, path).count() == packed.count()


def test_shared_folder_comes_from_the_session(spark):
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    assert session.scratch_path(spark, "x").startswith(named)
    assert session.scratch_path(spark, "x") != session.scratch_path(spark, "x")


def test_user_functions(spark):
    df = spark.createDataFrame([(1, "a bb"), (2, None), (3, "ccc")], "id int, text string").repartition(2)
    tokenizer = udfs.plug_tokenizer(lambda: lambda text: [len(w) for w in text.split()])
    assert {r.id: r.t for r in df.select("id", tokenizer(F.col("text")).alias("t")).collect()} == {1: [1, 2], 2: [], 3: [3]}
    mapped = udfs.map_batches(df, lambda b: pd.DataFrame({"twice": b["id"] * 2}), "twice int")
    assert sorted(r.twice for r in mapped.collect()) == [2, 4, 6]
    verify = udfs.plug_verifier(lambda rs, ans: [float(a in r) for r, a in zip(rs, ans)])
    checked = spark.createDataFrame([("it is 5", "5"), ("no", "5")], "r string, a string")
    assert [r.x for r in checked.select(verify(F.col("r"), F.col("a")).alias("x")).collect()] == [1.0, 0.0]
    batched = df.withColumn("batch_id", F.lit(0))
    packed = udfs.plug_collate(batched, lambda b: pd.DataFrame({"batch_id": [0], "n": [len(b)]}), "batch_id int, n bigint")
    assert packed.collect()[0].n == 3


def test_registry_covers_the_inventory():
    registry = load()
    wanted = {
        "s": 7, "p": 7, "o": 1, "m": 11, "t": 7, "k": 10, "f": 6, "r": 8, "v": 10, "e": 7, "g": 5, "w": 14, "c": 11, "l": 5, "u": 3,
    }
    have = {name.split("_")[0] for name in registry.QUERIES}
    missing = [f"{letter}{i}" for letter, n in wanted.items() for i in range(1, n + 1) if f"{letter}{i}" not in have]
    assert missing == []
    assert set(registry.CHECKS) <= set(registry.QUERIES)


def test_entry(spark):
    import __spark_entry__

    rows = __spark_entry__.entry(spark).collect()
    assert {r.domain for r in rows} <= {"web", "code", "math"} and sum(r.share for r in rows) == pytest.approx(1.0)


def test_skip_does_not_hide_an_unknown_key(spark, sf):
    source = domains.Source("web", "docs", f"{sf}/documents.parquet", key=("no_such_key",))
    with pytest.raises(AnalysisException):
        domains.scan_domains(spark, [source], on_missing="skip").count()
