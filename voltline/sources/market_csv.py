"""CSV layouts of the German market and grid platforms, and daily price bars."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import fixed_values as fixed
from ..functions import classify
from ..functions.timeutil import german_stamp, in_half_open, lenient_date, month_of, wall_clock_to_utc
from ..functions.values import NOT_AVAILABLE, NOT_AVAILABLE_OR_INACTIVE, blank_to_null_double, decimal_comma, null_tokens, zero_to_null
from ..operators.dedup import keep_first
from ..operators.reshape import unpivot_dropna
from ..schemas import OHLCV, conform
from .lines import BOM, read_lines, require_first_line, split_fields


# --- one file, many charts ---------------------------------------------------

def parse_chart(lines: DataFrame, chart_id: str, names: list[str]) -> DataFrame:
    """Rows of one chart out of a `;` file that mixes many charts of different width.

    A line counts only with exactly `len(names) + 2` fields. Blank cells are NULL,
    not 0. Dates are `yyyy-MM-dd` or a bare year.
    """
    fields = lines.select(split_fields("value", ";").alias("f")).filter(
        (F.get("f", F.lit(0)) == chart_id) & (F.size("f") == len(names) + 2)
    )
    return fields.select(
        lenient_date(F.get("f", F.lit(1))).alias("date"),
        *[blank_to_null_double(F.get("f", F.lit(i + 2))).alias(name) for i, name in enumerate(names)],
    )


def redispatch_by_source(lines: DataFrame) -> DataFrame:
    """Monthly redispatch volume: `(month, direction, energy_source, gwh)`, ordered."""
    tidy = None
    for chart_id, direction in fixed.REDISPATCH_CHARTS.items():
        wide = parse_chart(lines, chart_id, fixed.REDISPATCH_SOURCES).withColumnRenamed("date", "month")
        part = unpivot_dropna(wide, ["month"], fixed.REDISPATCH_SOURCES, "energy_source", "gwh").select(
            "month", F.lit(direction).alias("direction"), "energy_source", "gwh"
        )
        tidy = part if tidy is None else tidy.unionByName(part)
    return tidy.orderBy("direction", "energy_source", "month")


# --- single redispatch measures ----------------------------------------------

def parse_measures(raw: DataFrame) -> DataFrame:
    """Raw measure rows (all text) -> UTC intervals with direction and technology."""
    raw = raw.toDF(*[c.replace(BOM, "").strip() for c in raw.columns])
    start = wall_clock_to_utc(german_stamp("BEGINN_DATUM", "BEGINN_UHRZEIT"), "ZEITZONE_VON", on_unknown="null")
    end = wall_clock_to_utc(german_stamp("ENDE_DATUM", "ENDE_UHRZEIT"), "ZEITZONE_BIS", on_unknown="null")
    # The start is parsed once, in its own step; the month is then taken from the result.
    return raw.withColumn("start", start).select(
        "start",
        end.alias("end"),
        month_of("start").alias("month"),
        classify.measure_direction("RICHTUNG").alias("direction"),
        decimal_comma("GESAMTE_ARBEIT_MWH").alias("mwh"),
        decimal_comma("MITTLERE_LEISTUNG_MW").alias("avg_mw"),
        decimal_comma("MAXIMALE_LEISTUNG_MW").alias("max_mw"),
        F.col("GRUND_DER_MASSNAHME").alias("reason"),
        F.col("ANWEISENDER_UENB").alias("instructing_tso"),
        F.col("BETROFFENE_ANLAGE").alias("entity"),
        F.col("PRIMAERENERGIEART").alias("primary_energy_type"),
        classify.entity_technology("BETROFFENE_ANLAGE").alias("tech"),
    )


def read_measures(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    raw = spark.read.option("sep", ";").option("header", True).option("inferSchema", False).csv(paths)
    return parse_measures(raw)


# --- quarter-hour series -----------------------------------------------------

@dataclass(frozen=True)
class QuarterHourLayout:
    """Positions are explicit because one layout repeats a header name."""

    first_line: str
    columns: tuple[str, ...]
    values: dict[str, str]
    null_tokens: tuple[str, ...] = NOT_AVAILABLE
    zero_is_null: tuple[str, ...] = ()


_DAY_FIRST = ("day", "label", "from", "to")
LAYOUTS = {
    "rebap_price": QuarterHourLayout(
        "Datum;", (*_DAY_FIRST, "short", "long"), {"short": "rebap_eur_mwh", "long": "rebap_ueberdeckt_eur_mwh"}
    ),
    "nrv_saldo": QuarterHourLayout("Datum;", (*_DAY_FIRST, "v"), {"v": "nrv_saldo_mw"}),
    "id_aep": QuarterHourLayout("Datum von;", ("day", "from", "label", "to", "label_to", "v"), {"v": "id_aep_eur_mwh"}),
    "aep_modules": QuarterHourLayout(
        "Datum;",
        (*_DAY_FIRST, "m1", "m2", "m3"),
        {"m1": "aep_module1_eur_mwh", "m2": "aep_module2_eur_mwh", "m3": "aep_module3_eur_mwh"},
        NOT_AVAILABLE_OR_INACTIVE,
        ("m3",),
    ),
}


def parse_quarter_hours(lines: DataFrame, layout: QuarterHourLayout) -> DataFrame:
    """Text lines -> one row per UTC quarter hour; an unknown zone label raises.

    Files of neighbouring years may overlap by a row; the first occurrence wins.
    """
    rows = lines.filter(~F.ltrim("value").startswith(layout.first_line)).select(
        "file", "pos", F.from_csv("value", ", ".join(f"`{c}` STRING" for c in layout.columns), {"sep": ";"}).alias("r")
    )

    def value(column: str) -> Column:
        number = decimal_comma(null_tokens(F.col(f"r.{column}"), layout.null_tokens))
        return zero_to_null(number) if column in layout.zero_is_null else number

    parsed = rows.select(
        wall_clock_to_utc(german_stamp("r.day", "r.from"), "r.label").alias("ts"),
        *[value(column).alias(name) for column, name in layout.values.items()],
        F.struct("file", "pos").alias("_order"),
    )
    return keep_first(parsed, ["ts"], ["_order"]).drop("_order")


def read_quarter_hours(
    spark: SparkSession, paths: str | list[str], name: str, start: Column | None = None, end: Column | None = None
) -> DataFrame:
    """One of `LAYOUTS`, cut to the half-open UTC window `[start, end)` if given."""
    lines = read_lines(spark, paths)
    require_first_line(lines, LAYOUTS[name].first_line)
    parsed = parse_quarter_hours(lines, LAYOUTS[name])
    return parsed if start is None else parsed.filter(in_half_open("ts", start, end))


# --- daily price bars --------------------------------------------------------

def parse_price_bars(raw: DataFrame) -> DataFrame:
    """Open/high/low/close/volume per calendar date; zone offsets in the stamp are cut off."""
    raw = raw.toDF(*[c.lower() for c in raw.columns])
    day = F.substring(F.col("date").cast("string"), 1, 10)
    return conform(raw.withColumn("date", lenient_date(day)), OHLCV)


def read_price_bars(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    return parse_price_bars(spark.read.option("header", True).csv(paths))
