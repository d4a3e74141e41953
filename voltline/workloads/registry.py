"""Named workloads over the test tables, each next to the SQL that defines its result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Workload = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Workload] = {}
ORACLES: dict[str, str] = {}


def workload(sql: str | None = None) -> Callable[[Workload], Workload]:
    """Register the function under its own name; `sql` is the expected result."""

    def register(fn: Workload) -> Workload:
        if fn.__name__ in QUERIES:
            raise ValueError(f"workload {fn.__name__} registered twice")
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")
