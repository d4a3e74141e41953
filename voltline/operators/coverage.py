"""Checks on covered runs: stretches of neighbouring stamps in place of the stamps themselves.

Runs of parts of a table (months) are found once and kept; whatever the number of stamps, a
check then orders a few runs per series, and joins those that touch across parts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.timeutil import STEP_INTERVALS, epoch_micros

_STEP_MICROS = {"hour": 3_600_000_000, "quarter_hour": 900_000_000, "day": 86_400_000_000}


def _micros(step: str) -> Column:
    return F.lit(_STEP_MICROS[step]).cast("bigint")


def covered_runs(df: DataFrame, keys: list[str], ts: str, step: str) -> DataFrame:
    """`(keys, run_start, run_end, row_count)`: maximal stretches of stamps one step apart, with the rows in them.

    With a part (a month) among the keys, runs end at its borders and a window holds no more
    than the stamps of one series in one part. Rows without a stamp are left out; a stamp
    between the steps of its neighbours begins a run of its own.
    """
    stamps = df.filter(F.col(ts).isNotNull()).groupBy(*keys, F.col(ts).cast("timestamp_ntz").alias("_ts")).agg(F.count("*").alias("_n"))
    phase = F.pmod(epoch_micros("_ts"), _micros(step))
    numbered = stamps.withColumn("_phase", phase).withColumn("_number", ((epoch_micros("_ts") - F.col("_phase")) / _micros(step)).cast("bigint"))
    order = F.row_number().over(Window.partitionBy(*keys, "_phase").orderBy("_number"))
    # along a run the number of the step and that of the row grow alike
    return (
        numbered.withColumn("_run", F.col("_number") - order).groupBy(*keys, "_phase", "_run")
        .agg(F.min("_ts").alias("run_start"), F.max("_ts").alias("run_end"), F.sum("_n").alias("row_count")).drop("_phase", "_run")
    )


def gap_check_of_runs(runs: DataFrame, series: str, step: str, allowlist: DataFrame | None = None, severity: Column | None = None) -> DataFrame:
    """The result of `grid_gap_check` from the runs of any parts of the series: `(series, run_start, run_end, row_count)`.

    A part's runs may be cut anywhere, but no stamp may be in two of them.
    """
    known_runs = runs.filter(F.col(series).isNotNull()).select(F.col(series).alias("series"), "run_start", "run_end", "row_count")
    bounds = known_runs.groupBy("series").agg(F.min("run_start").alias("lo"), F.max("run_end").alias("hi"), F.sum("row_count").alias("actual"))
    covered = known_runs.select("series", "run_start", "run_end", F.lit(0).alias("allowed"))
    if allowlist is not None:  # an allowed step is a run of one, of no rows
        covered = covered.unionByName(allowlist.select("series", F.col("ts").alias("run_start"), F.col("ts").alias("run_end"), F.lit(1).alias("allowed")))
    micros = _micros(step)
    on_grid = covered.join(bounds, "series").filter(
        (F.pmod(epoch_micros("run_start") - epoch_micros("lo"), micros) == 0) & (F.col("run_start") >= F.col("lo")) & (F.col("run_end") <= F.col("hi"))
    )
    # an allowed step inside a run comes after the run's start and not after what is covered so far
    so_far = Window.partitionBy("series").orderBy("run_start", "allowed").rowsBetween(Window.unboundedPreceding, -1)
    skipped = F.greatest((epoch_micros("run_start") - epoch_micros("_reached")) / micros - 1, F.lit(0)).cast("bigint")
    width = F.expr(STEP_INTERVALS[step])
    open_step = F.col("_skipped") > 0
    unexpected = F.coalesce(F.sum("_skipped"), F.lit(0)).cast("bigint")
    return (
        on_grid.withColumn("_reached", F.max("run_end").over(so_far)).withColumn("_skipped", skipped)
        .groupBy("series")
        .agg(
            unexpected.alias("unexpected"),
            F.count_if((F.col("allowed") == 1) & (F.col("run_start") > F.col("_reached"))).alias("known"),
            ((F.max(epoch_micros("run_end")) - F.max(epoch_micros("lo"))) / micros).cast("bigint").alias("_last"),
            F.max("actual").alias("actual"),
            F.min(F.when(open_step, F.col("run_start") - width * F.col("_skipped"))).alias("first_unexpected"),
            F.max(F.when(open_step, F.col("run_start") - width)).alias("last_unexpected"),
        )
        .select(
            "series", (F.col("unexpected") == 0).alias("passed"), (severity if severity is not None else F.lit("ERROR")).alias("severity"),
            "unexpected", "known", (F.col("_last") + 1).alias("expected"), "actual", "first_unexpected", "last_unexpected",
        )
    )


def max_gap_of_runs(runs: DataFrame, series: str, limit_days: int = 5) -> DataFrame:
    """The result of `max_gap_check` from runs of days: `(series, run_start, run_end)`, of any parts of the series."""
    days = runs.select(F.col(series).alias("series"), F.col("run_start").cast("date").alias("first"), F.col("run_end").cast("date").alias("last"))
    so_far = Window.partitionBy("series").orderBy("first", "last").rowsBetween(Window.unboundedPreceding, -1)
    gap = F.date_diff("first", F.max("last").over(so_far))
    large = F.col("_gap") > limit_days
    inside = F.when(F.col("last") > F.col("first"), 1)
    return (
        days.withColumn("_gap", gap).groupBy("series")
        .agg(
            F.coalesce(F.greatest(F.max("_gap"), F.max(inside)), F.lit(0)).cast("bigint").alias("max_gap_days"),
            F.count_if(large).alias("large_gap_count"), F.min(F.when(large, F.col("first"))).alias("first_large_gap_end"),
        )
        .select("series", (F.col("large_gap_count") == 0).alias("passed"), F.lit("ERROR").alias("severity"), "max_gap_days", "large_gap_count", "first_large_gap_end")
    )
