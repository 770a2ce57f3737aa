"""The list of named queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Build = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Build] = {}
CHECKS: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Build], Build]:
    """Register a query under ``name``, with the SQL that gives the same rows where there is one."""

    def add(build: Build) -> Build:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = build
        if sql is not None:
            CHECKS[name] = sql
        return build

    return add
