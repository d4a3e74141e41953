"""One job per group of output tables: landed files in, Parquet tables out.

Every job reads landed files (fetching them is not Spark's business), applies the
group's load pattern and returns a one-row run report. `today` is always given, so
a run can be repeated.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import catalog, fixed_values as fixed
from ..functions import values
from ..functions.timeutil import in_half_open, ntz, seconds_between, shift_hours
from ..operators.panels import annual_capacity_panel
from ..operators.coverage import gap_check_of_runs, max_gap_of_runs
from ..operators.quality import never_loaded
from ..operators.hulls import footprint_hulls
from ..operators.zones import grid_summary, spatial_mean
from ..schemas import SERIES, ZONE_MASK, conform, struct
from ..sources import market_csv, regions, series_json, sinks, tenders, weather, zone_csv
from ..sources import registry as extracts
from ..sources.lines import read_lines
from . import country, fleet
from . import incremental as inc
from . import registry


# --- hourly market series -----------------------------------------------------------

def landed_blocks(spark: SparkSession, root: str) -> DataFrame:
    """`(name, block_ts)` of the landed block folders, as a scan of the files' paths: Spark lists the folders, no file is opened."""
    if not sinks.exists(spark, root):
        return spark.createDataFrame([], "name STRING, block_ts BIGINT")
    files = spark.read.format("binaryFile").load(root)  # without `content`, only the listing is read
    return files.select(F.col("name").cast("string").alias("name"), F.col("block_ts").cast("bigint").alias("block_ts")).distinct()


def market_table(spark: SparkSession, path: str) -> inc.PartitionedTable:
    return inc.PartitionedTable(spark, path, struct(SERIES), ["series"], step="hour")


def load_market_series(spark: SparkSession, landing: str, path: str) -> DataFrame:
    """All hourly series into one long table, each continued from its own last hour.

    Only blocks that can hold newer hours are read: the choice per series becomes a
    partition filter, so older block folders are not even listed as input. Whole
    blocks are merged, since their values may have been restated.
    """
    table = market_table(spark, path)
    # read once before the table changes: one row per series of the catalogue
    marks = spark.createDataFrame(table.watermarks().toArrow(), "series STRING, mark TIMESTAMP_NTZ")
    next_start = marks.select(
        F.col("series").alias("name"),
        (seconds_between(ntz("1970-01-01 00:00:00"), inc.next_hour(F.col("mark"))) * 1000).cast("bigint").alias("start_ms"),
    )
    table.merge(series_json.read_blocks(spark, landing, blocks=series_json.prune_blocks(landed_blocks(spark, landing), next_start)))
    return table.report(marks)


def check_market_series(spark: SparkSession, path: str, expected: DataFrame | None = None) -> DataFrame:
    """Hourly gap check of every series, from the runs kept with each month; known gaps do not fail it.

    A series of `expected` (by default of the catalogue) without a row was never
    loaded: it doesn't pass, as a warning.
    """
    stored = market_table(spark, path).runs()
    checked = gap_check_of_runs(stored, "series", "hour", catalog.known_gaps(spark), catalog.gap_severity())
    wanted = (catalog.series_ids(spark) if expected is None else expected).select("series").distinct()
    return checked.unionByName(never_loaded(wanted, stored, "series"), allowMissingColumns=True)


# --- quarter-hour balancing series ------------------------------------------------------

def quarter_hour_table(spark: SparkSession, name: str, path: str) -> inc.PartitionedTable:
    columns = ", ".join(f"{c} DOUBLE" for c in market_csv.LAYOUTS[name].values.values())
    return inc.PartitionedTable(spark, path, struct(f"ts TIMESTAMP_NTZ, {columns}"), step="quarter_hour")


def load_quarter_hours(spark: SparkSession, name: str, files: str | list[str], path: str, today: dt.date, details: bool = False) -> DataFrame:
    """One quarter-hour series: refetch its last days, corrections win, unpublished tail cut.

    `details` adds the rows cut and the months stored to the report.
    """
    table = quarter_hour_table(spark, name, path)
    start = dt.date.fromisoformat(fixed.SOURCE_STARTS[name])
    rule = inc.lookback(fixed.REFRESH_DAYS[name], ntz(start))
    source = market_csv.read_quarter_hours(spark, files, name).filter(
        in_half_open("ts", ntz(start), ntz(today + dt.timedelta(days=1)))
    )
    trim = next(iter(market_csv.LAYOUTS[name].values.values()))
    mark = table.watermark()
    table.load(source, rule, start, trim=trim)
    return table.report(mark=ntz(mark) if mark is not None else None, details=details)


def check_quarter_hours(spark: SparkSession, name: str, path: str) -> DataFrame:
    """Gap check of one table; one that was never written doesn't pass, as a warning, one without rows does."""
    table = quarter_hour_table(spark, name, path)
    checked = gap_check_of_runs(table.runs().withColumn("series", F.lit(name)), "series", "quarter_hour", severity=catalog.gap_severity())
    if table.months():
        return checked
    there = sinks.exists(spark, path)
    row = spark.range(1).select(
        F.lit(name).alias("series"), F.lit(there).alias("passed"), F.lit("ERROR" if there else "WARN").alias("severity"),
        *[F.lit(0).cast("bigint").alias(c) for c in ("unexpected", "known", "expected", "actual")],
    )
    return checked.unionByName(row, allowMissingColumns=True)


# --- capacity tenders, gas ---------------------------------------------------------------

_TENDERS = {"FCR": ("fcr_capacity_price", tenders.FCR_COLUMNS), "aFRR": ("afrr_capacity_price", tenders.AFRR_COLUMNS)}


def tender_table(spark: SparkSession, product: str, path: str) -> inc.PartitionedTable:
    columns = ", ".join(f"{c} DOUBLE" for c in _TENDERS[product][1])
    return inc.PartitionedTable(spark, path, struct(f"delivery_date DATE, {columns}"), ts="delivery_date", step="day")


def load_tenders(spark: SparkSession, product: str, files: list[str], path: str, today: dt.date) -> DataFrame:
    """Daily block prices: the running month is always loaded again in full."""
    name = _TENDERS[product][0]
    table = tender_table(spark, product, path)
    start = dt.date.fromisoformat(fixed.SOURCE_STARTS[name])
    source = tenders.in_days(tenders.read_tenders(spark, files, product), str(start), str(today))
    mark = table.watermark()
    table.load(source, inc.month_restart, start)
    return table.report(mark=F.lit(mark).cast("date"))


def check_tenders(spark: SparkSession, product: str, path: str) -> DataFrame:
    name = _TENDERS[product][0]
    runs = tender_table(spark, product, path).runs().withColumn("series", F.lit(name))
    return gap_check_of_runs(runs, "series", "day", catalog.known_gaps(spark))


def gas_table(spark: SparkSession, path: str) -> inc.PartitionedTable:
    return inc.PartitionedTable(spark, path, struct(market_csv.OHLCV), ts="date", step="day")


def load_gas(spark: SparkSession, files: str | list[str], path: str) -> DataFrame:
    """Daily bars from the day after the last stored one."""
    table = gas_table(spark, path)
    mark = table.watermark()
    table.load(market_csv.read_price_bars(spark, files), inc.next_day, dt.date(1900, 1, 1))
    return table.report(mark=F.lit(mark).cast("date"))


def check_gas(spark: SparkSession, path: str) -> DataFrame:
    return max_gap_of_runs(gas_table(spark, path).runs().withColumn("series", F.lit("ttf_gas_price")), "series")


def _store(df: DataFrame, root: str, table: str) -> None:
    """Replace a table of the catalogue; its catalogue row goes with its columns, as metadata."""
    sinks.replace_table(catalog.describe(df, table), f"{root.rstrip('/')}/{table}")


# --- full refreshes ------------------------------------------------------------------------

def refresh_redispatch(spark: SparkSession, chart_file: str, measure_files: str | list[str], root: str) -> None:
    """Both redispatch tables are restated by their sources, so they are replaced as a whole."""
    _store(market_csv.redispatch_by_source(read_lines(spark, chart_file)), root, "smard_redispatch_by_source")
    _store(market_csv.read_measures(spark, measure_files), root, "redispatch_measures")


def refresh_capacity(spark: SparkSession, wind: DataFrame, solar: DataFrame, crosswalk: DataFrame, storage: DataFrame, root: str, this_year: int) -> DataFrame:
    """Located units and the two annual panels; the panels read the written units."""
    events_path = f"{root}/mastr_capacity_events"
    _store(registry.capacity_events(wind, solar, crosswalk, storage), root, "mastr_capacity_events")
    events = spark.read.parquet(events_path)
    last = F.lit(this_year)
    _store(annual_capacity_panel(events, ["region_code", "technology"], last), root, "mastr_capacity_by_region_year")
    by_category = annual_capacity_panel(events.filter(F.col("technology") == "solar"), ["region_code", "pv_category"], last)
    _store(by_category, root, "mastr_capacity_by_region_year_pv_category")
    return registry.capacity_by(events, ["technology"])


def weather_means(grid: DataFrame, weight: Column | None = None) -> dict[str, DataFrame]:
    """National hourly temperature (deg C) and wind speed (m/s) from the stored weather grid."""
    means = {
        "avg_de_2m_temp": values.kelvin_to_celsius("t2m"),
        "avg_de_wind_speed_10m": values.wind_speed("u10", "v10"),
    }
    return {
        name: spatial_mean(grid, column, "valid_time", weight).select(F.col("valid_time").alias("ts"), F.col("value").alias(name))
        for name, column in means.items()
    }


def precipitation_mean(grid: DataFrame, band: str = "tp", weight: Column | None = None) -> DataFrame:
    """National hourly precipitation (mm) from a band in metres."""
    mean = spatial_mean(grid, values.metres_to_mm(band), "valid_time", weight)
    return mean.select(F.col("valid_time").alias("ts"), F.col("value").alias("avg_de_precipitation_mm"))


# --- capacity factors, potential, fleet ------------------------------------------------------

def load_factor_parts(factors: DataFrame, root: str, kind: str, technology: str) -> list[str]:
    """Factors `(ts, zone_id, cf)` by decade; a stored decade is final. Returns the new ones."""
    parts = factors.withColumn("decade", zone_csv.decade_of("ts"))
    return sinks.write_missing_parts(parts, f"{root.rstrip('/')}/kind={kind}/technology={technology}", "decade")


def refresh_country_factors(spark: SparkSession, parts: str, mask: DataFrame, weights: DataFrame, root: str) -> None:
    """Country product from the stored parts (solar an hour back, to true UTC) and its German slice."""
    solar = zone_csv.read_factor_parts(spark, parts, "solar").select(shift_hours("ts", -1).alias("ts"), F.col("zone_id").alias("country"), "technology", "cf")
    onshore, offshore = (zone_csv.read_factor_parts(spark, parts, kind).select("ts", "zone_id", "cf") for kind in ("wind_onshore", "wind_offshore"))
    path = f"{root}/pecd_country_capacity_factors_simple"
    _store(country.country_product(solar, onshore, offshore, mask, weights), root, "pecd_country_capacity_factors_simple")
    _store(country.country_slice(spark.read.parquet(path), "DE"), root, "pecd_country_capacity_factors_simple_de")


def refresh_fleet(
    spark: SparkSession, families: list[fleet.Family], solar: DataFrame, wind: DataFrame, base: DataFrame, root: str,
    first_month: Column, last_month: Column, export_from: Column, as_of: Column,
) -> None:
    """Historic potential, current-fleet factors, fleet snapshot, technology base and fleet-weighted factors."""
    _store(fleet.historic_potential(families, first_month, last_month, export_from), root, "de_potential_historic")
    _store(fleet.current_fleet_factors(families, as_of), root, "de_capacity_factor_current_fleet")
    _store(base, root, "de_technology_capacity_factors")
    snapshot = fleet.fleet_snapshot(solar, wind, as_of)
    _store(fleet.snapshot_table(snapshot), root, "de_fleet_weights_snapshot")
    stored = spark.read.parquet(f"{root}/de_technology_capacity_factors")
    _store(fleet.fleet_weighted(stored, snapshot), root, "de_capacity_factors_fleet_weighted")


# --- registry extracts -----------------------------------------------------------------------

def refresh_registry(wind: DataFrame, solar: DataFrame, detail: DataFrame, storage: DataFrame, crosswalk: DataFrame, root: str) -> None:
    """Harmonised units, solar detail, storage locations and the municipality crosswalk from landed extracts."""
    tables = {
        "mastr_units_wind": extracts.unit_extract(wind, "wind"),
        "mastr_units_solar": extracts.unit_extract(solar, "solar"),
        "mastr_solar_technical_detail": extracts.solar_detail_extract(detail),
        "mastr_storage_location_ids": extracts.storage_location_extract(storage),
        "lau_nuts_correspondence": extracts.crosswalk(crosswalk),
    }
    for name, df in tables.items():
        _store(df, root, name)


# --- weather grid, masks, outlines, site records -----------------------------------------------

def load_weather_grid(instant: DataFrame, accumulated: DataFrame, root: str) -> list[str]:
    """Months that the stored grid lacks, from landed instantaneous and accumulated fields; a stored month is final."""
    grid = weather.with_month(weather.merge_grids(instant, accumulated))
    return sinks.write_missing_parts(grid, f"{root.rstrip('/')}/era5_grid_de", "month", ["cell_lat", "cell_lon", "valid_time"])


def report_weather_grid(spark: SparkSession, root: str) -> DataFrame:
    """Rows, cells and months of the stored grid."""
    return grid_summary(weather.read_grid(spark, f"{root.rstrip('/')}/era5_grid_de"))


def refresh_weather_means(spark: SparkSession, root: str, precipitation: DataFrame, weight: Column | None = None) -> None:
    """The three national hourly means: two from the stored grid, precipitation from a landed grid of its own (`valid_time`, `tp` in metres)."""
    grid = weather.read_grid(spark, f"{root.rstrip('/')}/era5_grid_de")
    means = weather_means(grid, weight)
    _store(means["avg_de_2m_temp"], root, "era5_de_temperature_hourly")
    _store(means["avg_de_wind_speed_10m"], root, "era5_de_wind_speed_hourly")
    _store(precipitation_mean(precipitation, "tp", weight), root, "era5_de_precipitation_hourly")


def load_mask(spark: SparkSession, landed: DataFrame, root: str, scheme: str) -> DataFrame:
    """The zone mask of a scheme (`peon`, `peof`), stored once without empty cells, and read back; a stored mask is final."""
    path = f"{root.rstrip('/')}/{scheme}_region_mask"
    if not sinks.exists(spark, path):
        _store(conform(landed, ZONE_MASK).filter("coverage > 0").orderBy("zone_id", "cell_lat", "cell_lon"), root, f"{scheme}_region_mask")
    return regions.read_mask(spark, path)


def refresh_regions(spark: SparkSession, features_file: str, root: str) -> None:
    """German regions of all levels and the neighbours' outlines, each as one GeoJSON collection."""
    features = regions.read_features(spark, features_file)
    sinks.write_feature_collection(regions.country_regions(features), f"{root}/nuts_regions.geojson", "geometry", ["NUTS_ID", "LEVL_CODE", "NUTS_NAME", "NAME_LATN"])
    sinks.write_feature_collection(regions.neighbour_outlines(features), f"{root}/country_borders.geojson", "geometry", ["CNTR_CODE", "NAME_LATN"])


def refresh_offshore_regions(spark: SparkSession, root: str, as_of: Column) -> None:
    """Hulls of the units at sea that are active at `as_of`, from the stored capacity events, as one GeoJSON collection."""
    now = registry.offshore_now(spark.read.parquet(f"{root.rstrip('/')}/mastr_capacity_events"), as_of)
    hulls = footprint_hulls(now, "region_code", "longitude", "latitude", "capacity_mw")
    sinks.write_feature_collection(hulls.withColumnRenamed("region", "region_code"), f"{root}/offshore_regions.geojson", "geojson", ["region_code", "capacity_mw", "unit_count"])


def refresh_site(spark: SparkSession, static_file: str, meter_files: str | list[str], turbine_files: str | list[str], root: str) -> None:
    """A wind farm's static table, grid meter and turbine telemetry."""
    _store(zone_csv.read_static_table(spark, static_file), root, "kelmarsh_wt_static")
    _store(zone_csv.read_meter(spark, meter_files).orderBy("ts"), root, "kelmarsh_grid_meter")
    _store(zone_csv.read_turbines(spark, turbine_files).orderBy("turbine", "ts"), root, "kelmarsh_turbine_scada")
