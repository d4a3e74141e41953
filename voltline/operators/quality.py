"""Completeness checks; each result is one row per series."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.timeutil import STEP_INTERVALS, epoch_micros, seconds_between

_STEP_SECONDS = {"hour": 3600.0, "quarter_hour": 900.0, "day": 86400.0}


def grid_gap_check(
    df: DataFrame, series: str, ts: str, step: str, allowlist: DataFrame | None = None, severity: Column | None = None,
) -> DataFrame:
    """Is every step between a series' first and last time stamp present?

    Missing steps on the allowlist (`series, ts, reason`) are known; any other
    missing step fails the check. Stamps between two steps are counted in `actual`
    only. All series are checked in one job.

    The expected grid is never built: what is missing follows from the distance
    between neighbouring stamps. The source is scanned once into (series, ts) counts,
    hashed on both, so that a dominant series spreads over all tasks; they give the
    bounds and, reduced to the grid, the neighbours. A series' window therefore holds
    at most one row per step, however many rows the series has.
    """
    micros = F.lit(int(_STEP_SECONDS[step]) * 1_000_000).cast("bigint")
    # Both keys are filtered here, as the join below would otherwise filter one of the
    # two uses and Spark could no longer share their shuffle.
    stamps = (
        df.filter(F.col(series).isNotNull() & F.col(ts).isNotNull())
        .groupBy(F.col(series).alias("series"), F.col(ts).alias("ts"))
        .agg(F.count("*").alias("n"))
    )
    bounds = stamps.groupBy("series").agg(F.min("ts").alias("lo"), F.max("ts").alias("hi"), F.sum("n").alias("actual"))
    covered = stamps
    if allowlist is not None:  # allowed steps count as covered, with no row of their own
        allowed = allowlist.select("series", "ts", F.lit(0).cast("bigint").alias("n"))
        covered = stamps.unionByName(allowed).groupBy("series", "ts").agg(F.sum("n").alias("n"))
    from_start = epoch_micros("ts") - epoch_micros("lo")
    on_grid = covered.join(bounds, "series").filter(
        F.col("ts").between(F.col("lo"), F.col("hi")) & (F.pmod(from_start, micros) == 0)
    )
    step_no = (from_start / micros).cast("bigint")
    previous = F.lag("_step", 1, -1).over(Window.partitionBy("series").orderBy("ts"))
    unexpected = F.coalesce(F.sum("_skipped"), F.lit(0)).cast("bigint")
    width = F.expr(STEP_INTERVALS[step])
    return (
        on_grid.withColumn("_step", step_no)
        .withColumn("_skipped", F.col("_step") - previous - 1)
        .groupBy("series")
        .agg(
            unexpected.alias("unexpected"),
            F.count_if(F.col("n") == 0).alias("known"),
            (F.max("_step") + 1).alias("expected"),
            F.max("actual").alias("actual"),
            F.min(F.when(F.col("_skipped") > 0, F.col("ts") - width * F.col("_skipped"))).alias("first_unexpected"),
            F.max(F.when(F.col("_skipped") > 0, F.col("ts") - width)).alias("last_unexpected"),
        )
        .select(
            "series",
            (F.col("unexpected") == 0).alias("passed"),
            (severity if severity is not None else F.lit("ERROR")).alias("severity"),
            "unexpected",
            "known",
            "expected",
            "actual",
            "first_unexpected",
            "last_unexpected",
        )
    )


def missing_steps(df: DataFrame, series: str, ts: str, step: str) -> DataFrame:
    """The missing `(series, ts)` themselves, counted in steps from each series' first stamp.

    Only they become rows: they lie between neighbouring steps, or between the last step and a
    later stamp that is on none.
    """
    present = F.col(series).isNotNull() & F.col(ts).isNotNull()
    stamps = df.filter(present).select(F.col(series).alias("series"), F.col(ts).alias("ts")).distinct()
    bounds = stamps.groupBy("series").agg(F.min("ts").alias("lo"), F.max("ts").alias("hi"))
    micros, width = F.lit(int(_STEP_SECONDS[step]) * 1_000_000).cast("bigint"), F.expr(STEP_INTERVALS[step])
    on_grid = stamps.join(bounds, "series").filter(F.pmod(epoch_micros("ts") - epoch_micros("lo"), micros) == 0)
    following = F.lead("ts").over(Window.partitionBy("series").orderBy("ts"))
    gaps = on_grid.select("series", (F.col("ts") + width).alias("_from"), F.coalesce(following - width, "hi").alias("_to"))
    return gaps.filter("_from <= _to").select("series", F.explode(F.sequence("_from", "_to", width)).alias("ts"))


def never_loaded(expected_series: DataFrame, present: DataFrame, series: str) -> DataFrame:
    """Expected series without a single row: not passed, but only a warning."""
    return (
        expected_series.select(F.col(series).alias("series"))
        .join(present.select(F.col(series).alias("series")).distinct(), "series", "left_anti")
        .select("series", F.lit(False).alias("passed"), F.lit("WARN").alias("severity"))
    )


def max_gap_check(df: DataFrame, series: str, day: str, limit_days: int = 5) -> DataFrame:
    """Does any stretch between neighbouring days of a series exceed `limit_days`?

    Days are made distinct first, so a series' window holds at most one row per
    calendar day. A single day passes with gap 0.
    """
    days = df.filter(F.col(day).isNotNull()).select(F.col(series).alias("series"), F.col(day).cast("date").alias("day")).distinct()
    ordered = Window.partitionBy("series").orderBy("day")
    gap = F.date_diff("day", F.lag("day").over(ordered))
    large = F.col("_gap") > limit_days
    return (
        days.withColumn("_gap", gap)
        .groupBy("series")
        .agg(
            F.coalesce(F.max("_gap"), F.lit(0)).cast("bigint").alias("max_gap_days"),
            F.count_if(large).alias("large_gap_count"),
            F.min(F.when(large, F.col("day"))).alias("first_large_gap_end"),
        )
        .select(
            "series", (F.col("large_gap_count") == 0).alias("passed"), F.lit("ERROR").alias("severity"),
            "max_gap_days", "large_gap_count", "first_large_gap_end",
        )
    )


def null_runs(df: DataFrame, series: str, ts: str, value: str, step: str) -> DataFrame:
    """Runs of NULL values in present rows: `(series, run_start, run_end, run_length)`.

    One row per (series, ts) is expected. Only the NULL rows are shuffled.
    """
    gaps = df.filter(F.col(value).isNull()).select(F.col(series).alias("series"), F.col(ts).alias("ts"))
    ordered = Window.partitionBy("series").orderBy("ts")
    starts = F.col("_prev").isNull() | (seconds_between("_prev", "ts") > _STEP_SECONDS[step])
    so_far = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        gaps.withColumn("_prev", F.lag("ts").over(ordered))
        .withColumn("_run", F.sum(starts.cast("int")).over(so_far))
        .groupBy("series", "_run")
        .agg(F.min("ts").alias("run_start"), F.max("ts").alias("run_end"), F.count("*").alias("run_length"))
        .drop("_run")
    )


def run_report(df: DataFrame, ts: str, new_since: Column | None = None, is_new: Column | None = None) -> DataFrame:
    """One row: rows, new rows, first and last time stamp.

    New is what `is_new` says, or is newer than `new_since`; where that is NULL or
    nothing is given, everything is.
    """
    if is_new is None:
        is_new = F.coalesce(F.col(ts) > new_since, F.lit(True)) if new_since is not None else F.lit(True)
    new = F.count_if(is_new)
    return df.agg(
        F.count("*").alias("row_count"), new.alias("new_rows"), F.min(ts).alias("min_ts"), F.max(ts).alias("max_ts")
    )


def tail_preview(df: DataFrame, order: list[str], n: int = 5) -> DataFrame:
    """The last `n` rows in `order`: a top-n per task and one merge, not a full sort."""
    return df.orderBy(*[F.col(c).desc() for c in order]).limit(n)


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count per table, as `(table, row_count)`."""
    counts = [df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table"), "row_count") for name, df in tables.items()]
    result = counts[0]
    for other in counts[1:]:
        result = result.unionByName(other)
    return result
