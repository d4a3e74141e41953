"""Gridded weather, one part per month."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import fixed_values as fixed
from ..schemas import WEATHER_GRID, conform, struct
from .sinks import exists

_KEYS = ["cell_lon", "cell_lat", "valid_time"]
_ALIASES = {"longitude": "cell_lon", "latitude": "cell_lat", "time": "valid_time", **fixed.GRID_RENAME}


def merge_grids(instant: DataFrame, accumulated: DataFrame) -> DataFrame:
    """Instantaneous and accumulated fields on common coordinates; either may lack a cell."""
    left, right = [
        df.withColumnsRenamed({k: v for k, v in _ALIASES.items() if k in df.columns}) for df in (instant, accumulated)
    ]
    shared = [c for c in right.columns if c in left.columns and c not in _KEYS]
    return conform(left.join(right.drop(*shared), _KEYS, "full_outer"), WEATHER_GRID)


def with_month(grid: DataFrame) -> DataFrame:
    """Add the part key, `yyyy-MM`."""
    return grid.withColumn("month", F.date_format("valid_time", "yyyy-MM"))


def sort_part(grid: DataFrame) -> DataFrame:
    """Cluster by part and order cells inside, which makes the stored columns compress well."""
    return with_month(grid).hint("rebalance", "month").sortWithinPartitions("month", "cell_lat", "cell_lon", "valid_time")


def read_grid(spark: SparkSession, root: str, first_month: str | None = None, last_month: str | None = None) -> DataFrame:
    """Stored months in `[first, last]`; months that are absent are simply not there."""
    if not exists(spark, root):
        return spark.createDataFrame([], WEATHER_GRID)
    df = spark.read.schema(f"{WEATHER_GRID}, month STRING").parquet(root)
    if first_month is not None:
        df = df.filter(F.col("month") >= first_month)
    if last_month is not None:
        df = df.filter(F.col("month") <= last_month)
    return df.select(struct(WEATHER_GRID).fieldNames())


def months_between(spark: SparkSession, first: Column, last: Column) -> DataFrame:
    """Every month from `first` to `last` as `(year, month)`."""
    months = F.explode(F.sequence(F.trunc(first, "MM"), F.trunc(last, "MM"), F.expr("INTERVAL 1 MONTH")))
    return spark.range(1).select(months.alias("m")).select(F.year("m").alias("year"), F.month("m").alias("month"))
