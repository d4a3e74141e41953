"""Order-stable de-duplication and trailing-null trimming."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


_FIXED_WIDTH = (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)


def _order_column(order: str | list[str]) -> Column:
    names = [order] if isinstance(order, str) else list(order)
    return F.col(names[0]) if len(names) == 1 else F.struct(*names)


def _pick(df: DataFrame, keys: list[str], order: str | list[str], latest: bool) -> DataFrame:
    # An aggregate, not row_number(): duplicates of a hot key collapse on the map
    # side, so no single task ever holds them all. Fixed-width values keep their
    # own max_by each, which lets Spark use the hash aggregate; anything else
    # travels as one struct through the sort aggregate.
    choose = F.max_by if latest else F.min_by
    by = _order_column(order)
    values = [f for f in df.schema.fields if f.name not in keys]
    if isinstance(order, str) and all(isinstance(f.dataType, _FIXED_WIDTH) for f in values):
        picked = [
            (F.max(f.name) if latest else F.min(f.name)).alias(f.name)
            if f.name == order
            else choose(f.name, by).alias(f.name)
            for f in values
        ]
        return df.groupBy(*keys).agg(*picked).select(*df.columns)
    row = choose(F.struct(*[f.name for f in values]), by).alias("_row")
    return df.groupBy(*keys).agg(row).select(*keys, "_row.*").select(*df.columns)


def keep_last(df: DataFrame, keys: list[str], order: str | list[str]) -> DataFrame:
    """One row per key: the one latest in `order`, which must be unique per key.

    A NULL value in the latest row is kept; it replaces an older value.
    """
    return _pick(df, keys, order, latest=True)


def keep_first(df: DataFrame, keys: list[str], order: str | list[str]) -> DataFrame:
    """One row per key: the one earliest in `order`, which must be unique per key."""
    return _pick(df, keys, order, latest=False)


def last_valid(df: DataFrame, keys: list[str], ts: str, value: str) -> DataFrame:
    """Latest `ts` with a non-NULL `value`, per key, as `last_valid`."""
    return df.filter(F.col(value).isNotNull()).groupBy(*keys).agg(F.max(ts).alias("last_valid"))


def trim_trailing_nulls(df: DataFrame, keys: list[str], ts: str, value: str) -> DataFrame:
    """Drop rows after the last non-NULL `value`; inner NULLs stay, an all-NULL key goes."""
    if not keys:
        bound = last_valid(df, [], ts, value).select("last_valid").scalar()
        return df.filter(F.col(ts) <= bound)
    return (
        df.join(last_valid(df, keys, ts, value), keys, "inner")
        .filter(F.col(ts) <= F.col("last_valid"))
        .select(*df.columns)
    )
