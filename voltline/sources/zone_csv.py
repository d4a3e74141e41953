"""CSV files with a preamble: zone time series, site meters, turbine telemetry."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import fixed_values as fixed
from ..functions.timeutil import shift_hours
from ..functions.values import blank_to_null_double
from ..operators.dedup import keep_first
from .lines import body_with_header, field, read_lines
from .sinks import exists


def parse_zone_series(lines: DataFrame, zone_prefix: str = "", marker: str = "Date,") -> DataFrame:
    """Wide hour x zone files -> `(ts, zone_id, cf)`; only zones with the prefix.

    Blank cells stay as NULL rows: a zone that is NULL throughout must remain
    visible. Where two files carry the same hour the first line (by file name and
    position) wins, also if the files list different zones. That is settled on whole
    lines, already cut down to the wanted zones, so one row per hour is shuffled and
    not one per cell.
    """
    body = body_with_header(lines, marker)
    cells = F.filter(
        F.transform("header", lambda h, i: F.struct(h.alias("zone_id"), F.get("fields", i).alias("text"))),
        lambda c: c["zone_id"].startswith(zone_prefix) & (c["zone_id"] != "Date"),
    )
    hours = body.select(
        F.get("fields", F.lit(0)).try_cast("timestamp_ntz").alias("ts"),
        cells.alias("_cells"),
        F.struct("file", "pos").alias("_order"),
    )
    first = keep_first(hours, ["ts"], ["_order"])
    return first.select("ts", F.inline("_cells")).select("ts", "zone_id", blank_to_null_double("text").alias("cf"))


def read_zone_series(spark: SparkSession, paths: str | list[str], zone_prefix: str = "") -> DataFrame:
    return parse_zone_series(read_lines(spark, paths), zone_prefix)


def stack_technologies(parts: dict[str, DataFrame], shift: int = 0) -> DataFrame:
    """One long table with a `technology` key; `shift` hours are added (solar: -1)."""
    stacked = None
    for technology, df in parts.items():
        part = df.withColumn("technology", F.lit(technology)).withColumn("ts", shift_hours("ts", shift) if shift else F.col("ts"))
        stacked = part if stacked is None else stacked.unionByName(part)
    return stacked


def read_factor_parts(spark: SparkSession, root: str, kind: str, technology: str | None = None, decades: list[str] | None = None) -> DataFrame:
    """Stored factors under `root/kind=/technology=/decade=`; absent parts are simply not there.

    The three keys are partition columns, so the filters skip folders.
    """
    schema = "ts TIMESTAMP_NTZ, zone_id STRING, cf DOUBLE, kind STRING, technology STRING, decade STRING"
    if not exists(spark, root):
        return spark.createDataFrame([], schema).select("ts", "technology", "zone_id", "cf")
    df = spark.read.schema(schema).parquet(root).filter(F.col("kind") == kind)
    if technology is not None:
        df = df.filter(F.col("technology") == technology)
    if decades is not None:
        df = df.filter(F.col("decade").isin(*decades))
    return df.select("ts", "technology", "zone_id", "cf")


def decade_of(ts: Column | str) -> Column:
    """Label of the stored part a time stamp belongs to; the last part is open-ended."""
    year = F.year(ts)
    first = F.floor(year / 10) * 10
    label = F.concat(first.cast("string"), F.lit("-"), (first + 9).cast("string"))
    return F.when(year >= 2020, F.lit(fixed.DECADES[-1])).otherwise(label)


def parse_meter(lines: DataFrame, columns: list[str] = fixed.METER_COLUMNS) -> DataFrame:
    """Site meter file -> one row per time with the wanted columns."""
    return body_with_header(lines, "# Date and time").select(*_wanted(columns))


def parse_meter_long(lines: DataFrame) -> DataFrame:
    """Site meter file with whatever columns it has -> `(ts, quantity, value)`."""
    body = body_with_header(lines, "# Date and time")
    cells = F.filter(
        F.transform("header", lambda h, i: F.struct(h.alias("quantity"), F.get("fields", i).alias("text"), i.alias("i"))),
        lambda c: c["i"] > 0,
    )
    return body.select(F.get("fields", F.lit(0)).try_cast("timestamp_ntz").alias("ts"), F.inline(cells)).select(
        "ts", "quantity", blank_to_null_double("text").alias("value")
    )


def parse_turbines(lines: DataFrame, columns: list[str] = fixed.SCADA_COLUMNS) -> DataFrame:
    """Telemetry files -> one row per turbine and time, only the wanted columns.

    The turbine's name stands in a comment line of its own file. Columns are
    picked by position in the split line, so the other 250 are never built.
    """
    names = (
        lines.filter(F.col("value").startswith("# Turbine:"))
        .groupBy("file")
        .agg(F.min_by(F.trim(F.regexp_replace("value", "^# Turbine:", "")), "pos").alias("turbine"))
    )
    body = body_with_header(lines, "# Date and time").join(names, "file")
    return body.select("turbine", *_wanted(columns))


def _wanted(columns: list[str]) -> list[Column]:
    stamp = F.get("fields", F.lit(0)).try_cast("timestamp_ntz").alias("ts")
    return [stamp, *[blank_to_null_double(field(c)).alias(c) for c in columns]]


def read_meter(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    return parse_meter(read_lines(spark, paths))


def read_turbines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    return parse_turbines(read_lines(spark, paths))


def read_static_table(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Plain CSV with a header; every column is text."""
    return spark.read.option("header", True).csv(paths)
