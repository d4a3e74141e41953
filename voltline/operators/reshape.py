"""Pivot and unpivot with explicit rules for duplicates and gaps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def unpivot_dropna(df: DataFrame, ids: list[str], values: list[str], name: str, value: str) -> DataFrame:
    """Wide -> long, without the NULL cells."""
    return df.unpivot(ids, values, name, value).filter(F.col(value).isNotNull())


def pivot_strict(df: DataFrame, ids: list[str], name: str, names: list[str], value: str) -> DataFrame:
    """Long -> wide over a fixed list of names; two rows for one cell and a name that isn't listed raise.

    Every column is a conditional aggregate of one grouping, so there is a single
    shuffle and no job to find the distinct names.
    """
    def cell(label: str):
        here = F.col(name) == label
        duplicate = F.concat(F.lit("duplicate rows for cell "), F.lit(label))
        return (
            F.when(F.count_if(here) > 1, F.raise_error(duplicate).cast(df.schema[value].dataType))
            .otherwise(F.max(F.when(here, F.col(value))))
            .alias(label)
        )

    return _listed(df, ids, name, names, [cell(label) for label in names])


def pivot_mean(df: DataFrame, ids: list[str], name: str, names: list[str], value: str, fill: float = 0.0) -> DataFrame:
    """Long -> wide over a fixed list of names; duplicates are averaged, absent cells filled, a name that isn't listed raises."""
    cells = [F.coalesce(F.avg(F.when(F.col(name) == label, F.col(value))), F.lit(fill)).alias(label) for label in names]
    return _listed(df, ids, name, names, cells)


def _listed(df: DataFrame, ids: list[str], name: str, names: list[str], cells: list[Column]) -> DataFrame:
    """The cells by `ids`; a row with another name (or none) would have no cell, so it raises in the same grouping."""
    other = F.when(~F.coalesce(F.col(name).isin(*names), F.lit(False)), F.coalesce(F.col(name).cast("string"), F.lit("NULL")))
    grouped = df.groupBy(*ids).agg(*cells, F.max(other).alias("_other"))
    unlisted = F.raise_error(F.concat(F.lit("name that is not listed: "), F.col("_other"))).cast("boolean")
    return grouped.filter(F.when(F.col("_other").isNotNull(), unlisted).otherwise(F.lit(True))).drop("_other")
