"""Where intermediate tables go.

A few operators need the same rows twice (once for per-chunk totals, once for the rows themselves).
They write the narrow columns they need as Parquet into the shared folder the cluster names in
``spark.checkpoint.dir`` and read them back, which cuts the lineage and survives lost executors.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_PREFIX = "corpusflow-"


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder of the session; a temporary one only for local masters that name none."""
    context = spark.sparkContext
    named = context.getConf().get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if named:
        return named
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    context.setCheckpointDir(tempfile.mkdtemp(prefix=_PREFIX))
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path nobody used before, below the shared folder."""
    app = spark.sparkContext.applicationId
    return f"{checkpoint_dir(spark).rstrip('/')}/{_PREFIX}{app}/{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and return a scan of it."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
