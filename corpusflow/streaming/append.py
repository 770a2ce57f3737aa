"""Appending an arriving stream of metrics to a log.

Each micro-batch gets the steps and the elapsed seconds that it would have had in one append of all rows:
the number of steps counted and the start of every run are the state. A micro-batch writes a folder
of its own and replaces it if it is run again, so every row is there exactly once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from corpusflow.session import materialise
from corpusflow.sources.metrics import APPEND_BATCH, LOG_STATE_SCHEMA, log_entries, log_state
from corpusflow.streaming.state import Slots, batch_folder


def append_log(
    rows: DataFrame, path: str, checkpoint: str, order: Sequence[str], ts: str = "ts", drop: Sequence[str] = (),
    interval: str | None = None,
) -> StreamingQuery:
    """Append a stream of (run, ts, metrics and perhaps step) to the JSON lines below ``path``.

    ``order`` is a total order of a run's rows within a micro-batch; micro-batches follow each other as they
    arrive. Columns of ``drop`` serve the order only and are not logged. Everything there is now,
    then stop; with an ``interval`` ("10 seconds") the query stays live.
    """
    slots = Slots(f"{checkpoint.rstrip('/')}/append")

    def append(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        arrived = materialise(batch, "arrived")
        known = slots.read(spark, batch_id, "runs", LOG_STATE_SCHEMA)
        log_entries(arrived, order, ts, known=known).drop(*drop).write.mode("overwrite").json(batch_folder(path, APPEND_BATCH, batch_id))
        slots.write(batch_id, "runs", log_state(arrived, known, ts))

    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    return rows.writeStream.foreachBatch(append).option("checkpointLocation", checkpoint).trigger(**trigger).start()
