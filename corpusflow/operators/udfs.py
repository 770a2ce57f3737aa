"""Where users plug in their own Python: all of it runs on Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F


def map_batches(df: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """Apply ``fn`` to batches of rows; its result replaces the columns."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield fn(batch)

    return df.mapInPandas(run, schema)


def plug_tokenizer(load: Callable[[], Callable[[str], Iterable[int]]]) -> Callable[[Column], Column]:
    """A text -> array<int> column function around any tokenizer; ``load`` runs once per task."""

    @F.pandas_udf("array<int>")
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        tokenizer = load()
        for texts in batches:
            yield texts.map(lambda t: list(tokenizer(t or "")))

    return encode


def plug_collate(df: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], schema: str,
                 batch: str = "batch_id") -> DataFrame:
    """Apply a packer of the user's to each micro-batch, which holds at most batch_size documents."""
    return df.groupBy(batch).applyInPandas(fn, schema)


def plug_verifier(verify: Callable[[list[str], list[str]], list[float]]) -> Callable[[Column, Column], Column]:
    """A (response, answer) -> reward column function around a batch verifier."""

    @F.pandas_udf("double")
    def reward(responses: pd.Series, answers: pd.Series) -> pd.Series:
        return pd.Series(verify(responses.tolist(), answers.tolist()), dtype="float64")

    return reward
