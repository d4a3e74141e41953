"""Capacity over time: snapshots, monthly and annual panels.

Panels are built from deltas: each unit contributes a plus at its start and a
minus at its end, the deltas are summed per group and period (map-side combined),
and a running total per group turns them into a state. Cost is units plus
groups x periods, never units x periods, and a group's window holds at most one
row per period however many units the group has.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.timeutil import active_at, month_of


def _drop_null_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.dropna(subset=keys) if keys else df


def capacity_snapshot(
    units: DataFrame, keys: list[str], as_of: Column, capacity: str = "capacity_mw",
    start: str = "commissioning_date", end: str = "final_shutdown_date",
) -> DataFrame:
    """Installed capacity per group at one date; groups with a NULL key are left out."""
    active = _drop_null_keys(units.filter(active_at(start, end, as_of)), keys)
    return active.groupBy(*keys).agg(F.sum(capacity).alias("capacity_mw"))


def month_range(frames: list[DataFrame], today: dt.date, start: str = "commissioning_date") -> tuple[dt.date, dt.date]:
    """(earliest start month over all frames, month of `today`)."""
    firsts = frames[0].select(F.col(start).cast("date").alias("d"))
    for frame in frames[1:]:
        firsts = firsts.unionByName(frame.select(F.col(start).cast("date").alias("d")))
    first = firsts.agg(F.min("d")).first()[0] or today
    return first.replace(day=1), today.replace(day=1)


def monthly_capacity_panel(
    units: DataFrame, keys: list[str], first_month: Column, last_month: Column,
    export_from: Column | None = None, capacity: str | list[str] = "capacity_mw",
    start: str = "commissioning_date", end: str = "final_shutdown_date",
) -> DataFrame:
    """Installed capacity per group for every month, labelled by month end.

    A unit counts from its start month and no longer in its shutdown month.
    Deltas outside `[first_month, last_month]` are dropped, yet their group still
    appears (with zeros). Months before `export_from` feed the running total but
    are not returned. Several `capacity` columns give a panel of several totals under
    their own names, at the cost of one; a single one is called `capacity_mw`.
    """
    names = ["capacity_mw"] if isinstance(capacity, str) else list(capacity)
    amounts = [F.col(c).cast("double") for c in ([capacity] if isinstance(capacity, str) else capacity)]

    def delta(month: Column, changes: list[Column]) -> Column:
        return F.struct(month.alias("month"), *[c.alias(n) for c, n in zip(changes, names, strict=True)])

    deltas = (
        _drop_null_keys(units, keys)
        .select(
            *keys,
            F.inline(
                F.array(
                    delta(first_month, [F.lit(0.0) for _ in names]),  # makes every group start at the first month
                    delta(month_of(start), amounts),
                    delta(month_of(end), [-a for a in amounts]),
                )
            ),
        )
        .filter(F.col("month").between(first_month, last_month))
        .groupBy(*keys, "month")
        .agg(*[F.coalesce(F.sum(n), F.lit(0.0)).alias(n) for n in names])
    )
    ordered = Window.partitionBy(*keys).orderBy("month")
    so_far = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    until = F.coalesce(F.add_months(F.lead("month").over(ordered), -1), last_month)
    # Each total holds until the next change: the dense grid needs no spine join.
    dense = deltas.select(*keys, F.col("month").alias("_from"), until.alias("_until"), *[F.sum(n).over(so_far).alias(n) for n in names])
    if export_from is not None:
        dense = dense.withColumn("_from", F.greatest("_from", F.trunc(export_from, "MM"))).filter("_from <= _until")
    months = F.explode(F.sequence(F.col("_from"), F.col("_until"), F.expr("INTERVAL 1 MONTH")))
    return dense.withColumn("_month", months).select(*keys, F.last_day("_month").alias("month"), *names)


def annual_capacity_panel(
    units: DataFrame, keys: list[str], last_year: Column, capacity: str = "capacity_mw", unit_id: str = "unit_id",
    start: str = "commissioning_date", end: str = "final_shutdown_date",
) -> DataFrame:
    """Installed capacity and unit count per group at each 31 December.

    Only (group, year) pairs with at least one active unit appear. The unit count
    is of non-NULL ids.
    """
    amount = F.coalesce(F.col(capacity).cast("double"), F.lit(0.0))
    has_id = F.col(unit_id).isNotNull().cast("bigint")
    # A DATE is active at 31 Dec of its start year; it is gone at 31 Dec of its end year.
    first, gone = F.year(start), F.year(end)

    def delta(year: Column, sign: int) -> Column:
        return F.struct(
            year.alias("year"),
            (amount * sign).alias("capacity"),
            (has_id * sign).alias("ids"),
            F.lit(sign).cast("bigint").alias("rows"),
        )

    deltas = (
        _drop_null_keys(units, keys)
        .filter(F.col(start).isNotNull() & (F.col(end).isNull() | (gone > first)))
        .select(*keys, F.inline(F.array(delta(first, 1), delta(gone, -1))))
        .filter(F.col("year") <= last_year)
        .groupBy(*keys, "year")
        .agg(F.sum("capacity").alias("capacity"), F.sum("ids").alias("ids"), F.sum("rows").alias("rows"))
    )
    ordered = Window.partitionBy(*keys).orderBy("year")
    so_far = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        deltas.select(
            *keys,
            F.col("year").alias("_from"),
            F.coalesce(F.lead("year").over(ordered) - 1, last_year).alias("_until"),
            F.sum("capacity").over(so_far).alias("capacity_mw"),
            F.sum("ids").over(so_far).alias("unit_count"),
            F.sum("rows").over(so_far).alias("_rows"),
        )
        .filter(F.col("_rows") > 0)
        .withColumn("year", F.explode(F.sequence("_from", "_until")))
        .select(*keys, "capacity_mw", "unit_count", "year")
    )
