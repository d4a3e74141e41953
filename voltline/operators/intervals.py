"""Spreading interval facts over a regular hour grid."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.timeutil import epoch_hour_to_utc, epoch_micros

_SECOND = 1_000_000
_HOUR = 3600 * _SECOND
_STRETCH = 1024


def distribute_to_hours(df: DataFrame, start: str, end: str, value: str, keys: list[str] | None = None) -> DataFrame:
    """Total `value` per hour, each interval split by how much of it falls in the hour.

    Intervals without a positive length are skipped, totals are conserved (stamps
    are taken to be whole seconds: the last hour is that of `end` - 1 s), and only
    hours that some interval touches come out, as `(keys, hour, value)`.

    The whole hours of an interval are cut into dyadic blocks: 2^k hours that begin at
    a multiple of 2^k, at most two of a size, so an interval of n hours is about
    2 log2(n) rows, however long it is. Blocks are summed after a map-side combine;
    what is left is bounded by the hours of the result and the number of sizes, and
    only then becomes hours. All is DOUBLE, no running total is kept, and no task
    needs an order.
    """
    keys = list(keys or [])
    # Everything in between is BIGINT microseconds and hour numbers: small expressions
    # that stay well inside one compiled method, and time stamps only at the ends.
    intervals = (
        df.filter((F.col(end) > F.col(start)) & F.col(value).isNotNull())
        .select(*keys, epoch_micros(start).alias("_start"), epoch_micros(end).alias("_end"), F.col(value).cast("double").alias("_value"))
        .withColumn("_first", _hour_number(F.col("_start")))
        .withColumn("_last", _hour_number(F.col("_end") - _SECOND))
        .filter(F.col("_last") >= F.col("_first"))
        # whole hours are those from _open up to _close; none if the one isn't before the other
        .withColumn("_open", -_hour_number(-F.col("_start")))
        .withColumn("_close", _hour_number(F.col("_end")))
    )
    # Two rows for each size: the block at the left end (side 0) and the one at the right end,
    # of which about half exist. Size -1 stands for the hours that are covered in part.
    sizes = F.when(F.col("_open") < F.col("_close"), F.floor(F.log2(F.col("_close") - F.col("_open"))).cast("int") + 1).otherwise(-1)
    coded = intervals.withColumn("_code", F.explode_outer(F.sequence(F.lit(-2), 2 * sizes + 1)))
    ends = coded.withColumn("_size", F.shiftright("_code", 1)).withColumn("_side", F.col("_code").bitwiseAND(1))
    edge, left, length = F.col("_size") < 0, F.col("_side") == 0, F.col("_end") - F.col("_start")
    inside_first = F.col("_start") < F.col("_open") * _HOUR
    # numbers of the blocks at both ends; between even numbers a larger size covers all
    low, high = F.expr("-shiftright(-_open, _size)"), F.expr("shiftright(_close, _size)")
    number = F.when(left, low).otherwise(high - 1)
    exists = F.when(edge & left, inside_first).when(
        edge, (F.col("_last") >= F.col("_close")) & ((F.col("_last") > F.col("_first")) | ~inside_first)
    ).otherwise((low < high) & ((number + F.col("_side")).bitwiseAND(F.lit(1)) == 1))
    time = F.when(~edge, F.lit(_HOUR).cast("bigint")).when(left, F.least(F.col("_end"), F.col("_open") * _HOUR) - F.col("_start")).otherwise(F.col("_end") - F.col("_last") * _HOUR)
    begins = F.when(~edge, number * F.expr("shiftleft(1L, _size)")).when(left, F.col("_first")).otherwise(F.col("_last"))
    pieces = ends.filter(exists).select(*keys, F.greatest("_size", F.lit(0)).alias("_size"), begins.alias("_from"), (F.col("_value") * time / length).alias("value"))
    blocks = pieces.groupBy(*keys, "_size", "_from").agg(F.sum("value").alias("value"))
    # hours in stretches, so that no array is long
    last = F.col("_from") + F.expr("shiftleft(1L, _size)") - 1
    stretches = blocks.withColumn("_last", last).withColumn("_at", F.explode_outer(F.sequence("_from", "_last", F.lit(_STRETCH).cast("bigint"))))
    hours = stretches.withColumn("_hour", F.explode_outer(F.sequence("_at", F.least("_last", F.col("_at") + (_STRETCH - 1)))))
    hourly = hours.groupBy(*keys, "_hour").agg(F.sum("value").alias("value"))
    return hourly.select(*keys, epoch_hour_to_utc("_hour").alias("hour"), "value")


def _hour_number(micros: Column) -> Column:
    """Hours since 1970, rounded down before 1970 too."""
    hour = F.lit(_HOUR).cast("bigint")
    return ((micros - F.pmod(micros, hour)) / hour).cast("bigint")
