"""Time expressions on TIMESTAMP_NTZ columns that hold true UTC.

Nothing here depends on the session time zone: slots and durations are taken
from calendar fields and intervals, never by way of TIMESTAMP WITH LOCAL TIME
ZONE.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

STEP_INTERVALS = {
    "hour": "INTERVAL 1 HOUR",
    "quarter_hour": "INTERVAL 15 MINUTES",
    "day": "INTERVAL 1 DAY",
}
_STEP_MINUTES = {"hour": 60, "quarter_hour": 15, "day": 1440}

# Hours ahead of UTC for the zone labels in German market files.
ZONE_LABEL_HOURS = {"CET": 1, "CEST": 2}


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ntz(value: dt.datetime | dt.date | str) -> Column:
    """A TIMESTAMP_NTZ literal."""
    text = value.isoformat(sep=" ") if isinstance(value, dt.datetime) else str(value)
    return F.lit(text).cast("timestamp_ntz")


def floor_to(ts: Column | str, step: str) -> Column:
    """Start of the hour, quarter hour or day that `ts` falls in."""
    ts = _col(ts)
    midnight = ts.cast("date").cast("timestamp_ntz")
    if step == "day":
        return midnight
    if step == "hour":
        return midnight + F.make_dt_interval(F.lit(0), F.hour(ts))
    width = _STEP_MINUTES[step]
    minutes = F.floor((F.hour(ts) * 60 + F.minute(ts)) / width) * width
    return midnight + F.make_dt_interval(F.lit(0), F.lit(0), minutes.cast("int"))


def month_of(ts: Column | str) -> Column:
    """First day of the month, as DATE."""
    return F.trunc(_col(ts).cast("date"), "MM")


def epoch_micros(ts: Column | str) -> Column:
    """Microseconds since 1970 as BIGINT.

    Whole seconds and the rest are taken apart: both stay in long arithmetic, where
    a cast of the interval to DECIMAL would build an object per row.
    """
    since = _col(ts) - ntz("1970-01-01 00:00:00")
    whole = since.cast("interval second").cast("bigint")
    rest = ((since - F.expr("INTERVAL '1' SECOND") * whole) * F.lit(1_000_000)).cast("interval second").cast("bigint")
    return whole * F.lit(1_000_000).cast("bigint") + rest


def epoch_hour_to_utc(hour: Column | str) -> Column:
    """Hours since 1970 -> TIMESTAMP_NTZ."""
    return ntz("1970-01-01 00:00:00") + F.make_dt_interval(F.lit(0), _col(hour).cast("int"))


def seconds_between(start: Column | str, end: Column | str) -> Column:
    """Exact elapsed seconds `end - start` as DOUBLE (microsecond resolution)."""
    return (epoch_micros(end) - epoch_micros(start)).cast("double") / 1e6


def wall_clock_to_utc(local: Column | str, label: Column | str, on_unknown: str = "raise") -> Column:
    """Local wall clock plus its CET/CEST label -> UTC.

    The label makes the repeated autumn hour exact, which a zone-rule conversion
    cannot. An unknown label raises, or gives NULL with `on_unknown="null"`.
    A NULL label counts as unknown.
    """
    local, label = _col(local), _col(label)
    shifted = F.lit(None).cast("timestamp_ntz")
    if on_unknown == "raise":
        message = F.concat(F.lit("unknown time zone label: "), F.coalesce(label, F.lit("NULL")))
        shifted = F.raise_error(message).cast("timestamp_ntz")
    for name, hours in ZONE_LABEL_HOURS.items():
        shifted = F.when(label == name, local - F.make_dt_interval(F.lit(0), F.lit(hours))).otherwise(shifted)
    return shifted


def german_stamp(day: Column | str, clock: Column | str) -> Column:
    """`dd.MM.yyyy` + `HH:mm` text -> wall-clock TIMESTAMP_NTZ (bad text raises)."""
    return F.to_timestamp_ntz(F.concat(_col(day), F.lit(" "), _col(clock)), F.lit("dd.MM.yyyy HH:mm"))


def lenient_date(text: Column | str) -> Column:
    """DATE, or NULL where the value cannot be read as one."""
    return _col(text).cast("string").try_cast("timestamp_ntz").cast("date")


def epoch_millis_to_utc(ms: Column | str) -> Column:
    """Epoch milliseconds -> TIMESTAMP_NTZ in UTC."""
    seconds = (_col(ms).cast("decimal(18,0)") / F.lit(1000).cast("decimal(4,0)")).cast("decimal(18,6)")
    return ntz("1970-01-01 00:00:00") + F.make_dt_interval(secs=seconds)


def shift_hours(ts: Column | str, hours: int) -> Column:
    """Constant shift; solar capacity factors need -1 h, wind none."""
    return _col(ts) + F.make_dt_interval(F.lit(0), F.lit(hours))


def in_half_open(ts: Column | str, start: Column, end: Column) -> Column:
    """`start <= ts < end`."""
    return (_col(ts) >= start) & (_col(ts) < end)


def active_at(start: Column | str, end: Column | str, as_of: Column) -> Column:
    """Started on or before `as_of` and not ended by then (NULL end = open)."""
    return (_col(start) <= as_of) & (_col(end).isNull() | (_col(end) > as_of))


def year_windows(bounds: DataFrame, start: str, end: str) -> DataFrame:
    """Half-open `[start, end)` split at each 1 January, clipped to the bounds."""
    years = F.explode(
        F.sequence(F.trunc(F.col(start), "year"), F.date_sub(F.col(end), 1), F.expr("INTERVAL 1 YEAR"))
    )
    return (
        bounds.filter(F.col(start) < F.col(end))
        .withColumn("_year", years)
        .select(
            *[c for c in bounds.columns if c not in (start, end)],
            F.greatest(F.col(start), F.col("_year")).alias("window_from"),
            F.least(F.col(end), F.add_months("_year", 12)).alias("window_to"),
        )
    )


def month_windows(bounds: DataFrame, start: str, end: str) -> DataFrame:
    """Inclusive `[start, end]` split into calendar months, clipped to the bounds."""
    months = F.explode(F.sequence(F.trunc(F.col(start), "MM"), F.col(end), F.expr("INTERVAL 1 MONTH")))
    return (
        bounds.filter(F.col(start) <= F.col(end))
        .withColumn("_month", months)
        .select(
            *[c for c in bounds.columns if c not in (start, end)],
            F.greatest(F.col(start), F.col("_month")).alias("window_from"),
            F.least(F.col(end), F.last_day("_month")).alias("window_to"),
        )
    )


def month_spine(spark: SparkSession, first: dt.date, last: dt.date) -> DataFrame:
    """Every calendar month from `first` to `last`, as its first day."""
    span = (last.year - first.year) * 12 + last.month - first.month + 1
    origin = F.lit(first.replace(day=1))
    return spark.range(span).select(F.add_months(origin, F.col("id").cast("int")).alias("month"))
