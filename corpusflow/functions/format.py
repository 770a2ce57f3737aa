"""Numbers and durations as text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

INF = float("inf")


def grouped(value: Column, digits: int = 0) -> Column:
    """Fixed-point with thousands separators; rounds half to even on the exact value."""
    return (
        F.when(F.isnan(value), F.lit("nan"))
        .when(value == F.lit(INF), F.lit("inf"))
        .when(value == F.lit(-INF), F.lit("-inf"))
        .otherwise(F.format_number(value, digits))
    )


def fixed(value: Column, digits: int) -> Column:
    """Fixed-point without separators."""
    return F.replace(grouped(value, digits), F.lit(","), F.lit(""))


def duration(seconds: Column) -> Column:
    """Seconds as 59s, 1.5m, 1.5h or 1.5d."""
    return (
        F.when(seconds < 60, F.concat(fixed(seconds, 0), F.lit("s")))
        .when(seconds < 3600, F.concat(fixed(seconds / 60, 1), F.lit("m")))
        .when(seconds < 86400, F.concat(fixed(seconds / 3600, 1), F.lit("h")))
        .otherwise(F.concat(fixed(seconds / 86400, 1), F.lit("d")))
    )


def metrics_text(metrics: Column, precision: int = 4) -> Column:
    """A map<string, double> as ``k=v | k=v`` in map order."""
    parts = F.transform(
        F.map_entries(metrics), lambda e: F.concat(e["key"], F.lit("="), fixed(e["value"], precision))
    )
    return F.array_join(parts, " | ")


def value_text(value: Column, kind: T.DataType, precision: int = 4) -> Column:
    """One value as a log shows it: fixed-point if it is a float, otherwise as it is."""
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        shown = fixed(value.cast("double"), precision)
    elif isinstance(kind, T.BooleanType):
        shown = F.when(value, F.lit("True")).when(~value, F.lit("False"))
    else:
        shown = value.cast("string")
    return F.coalesce(shown, F.lit("None"))


def with_metrics_text(df: DataFrame, metrics: Sequence[str], out: str = "line", precision: int = 4) -> DataFrame:
    """Adds the columns ``metrics`` of any type as ``k=v | k=v``."""
    parts = [F.concat(F.lit(f"{m}="), value_text(F.col(m), df.schema[m].dataType, precision)) for m in metrics]
    return df.withColumn(out, F.concat_ws(" | ", *parts))
