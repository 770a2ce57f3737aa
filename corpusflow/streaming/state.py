"""State of micro-batches as tables, in two slots that take turns.

Micro-batch k reads what k - 1 left and writes the other slot, so a batch that is run again after a failure
finds the same state, and no more than two versions are kept.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Slots:
    """Tables below ``path``, which belongs to one streaming query as its checkpoint does."""

    path: str

    def read(self, spark: SparkSession, batch_id: int, name: str, schema: str) -> DataFrame:
        """The table as the micro-batch before ``batch_id`` left it; empty before the first."""
        if batch_id == 0:
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema).parquet(f"{self.path}/{name}-{(batch_id - 1) % 2}")

    def write(self, batch_id: int, name: str, rows: DataFrame) -> None:
        rows.write.mode("overwrite").parquet(f"{self.path}/{name}-{batch_id % 2}")


def batch_folder(path: str, column: str, batch_id: int) -> str:
    """Where a micro-batch puts its rows: run again, it replaces them."""
    return f"{path.rstrip('/')}/{column}={batch_id}"
