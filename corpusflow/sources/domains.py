"""Reading the sources of a mix as one frame of (domain, source, key, text)."""

from __future__ import annotations

import warnings
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from corpusflow.functions.text import non_empty

DEFAULT_TEXT_FIELD = "text"
SCHEMA = "domain string, source string, key string, text string"


@dataclass(frozen=True)
class Source:
    """One source: where it lies, its domain, the columns of its text and its key."""

    name: str
    domain: str
    path: str
    key: tuple[str, ...] = ("doc_id",)
    text_field: str | None = None
    format: str = "parquet"


def text_column(df: DataFrame, field: str | None, default: str | None = None) -> Column:
    """The chosen text column, null and missing columns as empty text."""
    name = field or default or DEFAULT_TEXT_FIELD
    return F.coalesce(F.col(name).cast("string"), F.lit("")) if name in df.columns else F.lit("")


def select_text(df: DataFrame, field: str | None = None, default: str | None = None, out: str = "text") -> DataFrame:
    return df.withColumn(out, text_column(df, field, default))


def select_split(df: DataFrame, split: str, column: str = "split") -> DataFrame:
    """Rows of one split; prunes files where the split is a partition column."""
    return df.where(F.col(column) == split)


def head(df: DataFrame, n: int | None, order: Sequence[str | Column]) -> DataFrame:
    """The first n rows in the given order; None or 0 keeps all."""
    return df.orderBy(*order).limit(n) if n else df


def drop_empty(df: DataFrame, text: str = "text") -> DataFrame:
    return df.where(non_empty(F.col(text)))


def _open(spark: SparkSession, source: Source, text_field: str | None) -> DataFrame:
    raw = spark.read.format(source.format).load(source.path)
    return raw.select(
        F.lit(source.domain).alias("domain"), F.lit(source.name).alias("source"),
        F.concat_ws(":", *[F.col(k).cast("string") for k in source.key]).alias("key"),
        text_column(raw, source.text_field, text_field).alias("text"),
    )


def scan_domains(
    spark: SparkSession, sources: Sequence[Source], on_missing: str = "fail", text_field: str | None = None
) -> DataFrame:
    """All sources as one frame. ``on_missing='skip'`` warns about a source whose path is missing; other faults
    of a source, such as an unknown key column, are errors."""
    if on_missing not in ("fail", "skip"):
        raise ValueError(f"on_missing must be fail or skip, got {on_missing}")
    frames = []
    for source in sources:
        try:
            frames.append(_open(spark, source, text_field))
        except AnalysisException as error:
            if on_missing == "fail" or error.getCondition() != "PATH_NOT_FOUND":
                raise
            warnings.warn(f"skipping source {source.name}: {error.getCondition()}", stacklevel=2)
    if not frames:
        return spark.createDataFrame([], SCHEMA)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
