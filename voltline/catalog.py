"""The table catalogue: every output table with the metadata it must state."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import fixed_values as fixed

COLUMNS = ["table", "group", "source", "region", "resolution", "unit", "time_zone", "load_pattern", "description"]
REQUIRED = ["source", "region", "resolution", "unit", "time_zone", "load_pattern"]
LOAD_PATTERNS = ["full_refresh", "watermark", "missing_parts"]

# The table names below are the ones users of these data already query by.
_UTC = "naive, true UTC"
_DATE = "calendar date, no time of day"
_NONE = "n/a"


def _smard() -> list[tuple]:
    groups = [
        ("smard_generation", fixed.GENERATION, "DE-LU", "MW"),
        ("smard_consumption", fixed.CONSUMPTION, "DE-LU", "MW"),
        ("smard_price", fixed.PRICES, "DE-LU", "EUR/MWh"),
        ("smard_forecast", fixed.FORECASTS, "DE-LU", "MW"),
        ("smard_capacity", fixed.CAPACITIES, "DE", "MW"),
    ]
    return [
        (series, group, "SMARD", region, "hourly", unit, _UTC, "watermark", description)
        for group, members, region, unit in groups
        for series, _, description in members
    ]


def _rows() -> list[tuple]:
    registry = [
        (f"{technology}_{part}", "registry_raw", "Marktstammdatenregister", "DE", "per unit", _NONE, _NONE, "full_refresh", f"Raw {part} table, {technology}")
        for technology in ("wind", "solar", "storage")
        for part in ("extended", "eeg")
    ]
    extracts = [
        ("mastr_units_wind", "Harmonised wind units"),
        ("mastr_units_solar", "Harmonised solar units"),
        ("mastr_solar_technical_detail", "Solar orientation and tilt"),
        ("mastr_storage_location_ids", "Locations that have storage"),
    ]
    factors = [
        ("pecd_solar_capacity_factors", "DE", "hourly by technology and NUTS2", "full_refresh"),
        ("pecd_solar_country_capacity_factors", "DE", "hourly by technology", "full_refresh"),
        ("pecd_wind_onshore_capacity_factors", "DE", "hourly by zone", "full_refresh"),
        ("pecd_wind_offshore_capacity_factors", "DE", "hourly by zone", "full_refresh"),
        ("pecd_wind_onshore_europe_capacity_factors", "Europe", "hourly by zone", "missing_parts"),
        ("pecd_wind_offshore_europe_capacity_factors", "Europe", "hourly by zone", "missing_parts"),
        ("pecd_solar_europe_capacity_factors", "Europe", "hourly by technology and country", "missing_parts"),
        ("pecd_country_capacity_factors_simple", "Europe", "hourly by technology and country", "full_refresh"),
        ("pecd_country_capacity_factors_simple_de", "DE", "hourly by technology", "full_refresh"),
        ("de_capacity_factor_current_fleet", "DE", "hourly by family", "full_refresh"),
        ("de_technology_capacity_factors", "DE", "hourly by technology", "full_refresh"),
        ("de_capacity_factors_fleet_weighted", "DE", "hourly by family", "full_refresh"),
    ]
    market = [
        ("rebap_price", "netztransparenz.de", "15 min", "EUR/MWh", _UTC),
        ("nrv_saldo", "netztransparenz.de", "15 min", "MW", _UTC),
        ("id_aep", "netztransparenz.de", "15 min", "EUR/MWh", _UTC),
        ("aep_modules", "netztransparenz.de", "15 min", "EUR/MWh", _UTC),
        ("fcr_capacity_price", "regelleistung.net", "daily by 4-hour block", "EUR/MW/h", "date; block columns are German wall clock"),
        ("afrr_capacity_price", "regelleistung.net", "daily by 4-hour block", "EUR/MW/h", "date; block columns are German wall clock"),
    ]
    weather = [
        ("era5_de_temperature_hourly", "deg C"),
        ("era5_de_wind_speed_hourly", "m/s"),
        ("era5_de_precipitation_hourly", "mm"),
    ]
    capacity = [
        ("nuts_regions", "Eurostat/GISCO", "DE", "static", _NONE, "Region outlines"),
        ("country_borders", "Eurostat/GISCO", "DE and neighbours", "static", _NONE, "Country outlines"),
        ("mastr_capacity_events", "Marktstammdatenregister", "DE", "per unit", "MW", "Located wind and solar units"),
        ("mastr_capacity_by_region_year", "Marktstammdatenregister", "DE", "annual", "MW", "Year-end capacity by region and technology"),
        ("mastr_capacity_by_region_year_pv_category", "Marktstammdatenregister", "DE", "annual", "MW", "Year-end solar capacity by region and category"),
        ("offshore_regions", "Marktstammdatenregister", "DE", "current", "MW", "Offshore footprints"),
    ]
    reference = [
        ("lau_nuts_correspondence", "Eurostat", "Municipality to NUTS3"),
        ("peon_region_mask", "PECD", "Onshore zone mask"),
        ("peof_region_mask", "PECD", "Offshore zone mask"),
    ]
    turbines = [
        ("kelmarsh_wt_static", "per turbine", "kW, m", _NONE),
        ("kelmarsh_grid_meter", "10 min", "kWh", _UTC),
        ("kelmarsh_turbine_scada", "10 min", "m/s, kW", _UTC),
    ]
    return [
        *_smard(),
        ("smard_redispatch_by_source", "redispatch", "SMARD", "DE", "monthly", "GWh", _DATE, "full_refresh", "Redispatch by energy source"),
        ("redispatch_measures", "redispatch", "netztransparenz.de", "DE", "irregular", "MWh, MW", _UTC, "full_refresh", "Single redispatch measures"),
        *registry,
        *[(t, "registry", "Marktstammdatenregister", "DE", "per unit", "kW", _NONE, "full_refresh", d) for t, d in extracts],
        *[(t, "reference", s, "DE", "static", "share 0-1" if "mask" in t else _NONE, _NONE, "full_refresh", d) for t, s, d in reference],
        *[(t, "capacity_factors", "PECD", r, res, "capacity factor 0-1", _UTC, p, "Capacity factors") for t, r, res, p in factors],
        ("de_potential_historic", "capacity_factors", "PECD, Marktstammdatenregister", "DE", "hourly by family", "MW", _UTC, "full_refresh", "Potential of each month's fleet"),
        ("de_fleet_weights_snapshot", "capacity_factors", "Marktstammdatenregister", "DE", "snapshot", "share 0-1, MW", _DATE, "full_refresh", "Solar mix and totals"),
        *[(t, "capacity", s, r, res, u, _DATE, "full_refresh", d) for t, s, r, res, u, d in capacity],
        ("ttf_gas_price", "gas", "Yahoo Finance", "NL", "daily, trading days", "EUR/MWh", _DATE, "watermark", "Front-month gas future"),
        *[(t, "turbines", "Zenodo 5841834", "UK", r, u, z, "full_refresh", "Wind farm record") for t, r, u, z in turbines],
        *[(t, "balancing", s, "DE", r, u, z, "watermark", "Balancing market") for t, s, r, u, z in market],
        *[(t, "weather", "ERA5-Land", "DE", "hourly", u, _UTC, "full_refresh", "Spatial mean") for t, u in weather],
        ("era5_grid_de", "weather", "ERA5", "DE and sea", "hourly, 0.25 deg", "m/s, K, J/m2", _UTC, "missing_parts", "Full weather grid"),
    ]


def catalogue(spark: SparkSession) -> DataFrame:
    """One row per output table."""
    return spark.createDataFrame(_rows(), ", ".join(f"`{c}` STRING" for c in COLUMNS))


def series_ids(spark: SparkSession) -> DataFrame:
    """`(series, variable_id)` of the hourly market series."""
    members = fixed.GENERATION + fixed.CONSUMPTION + fixed.PRICES + fixed.FORECASTS + fixed.CAPACITIES
    return spark.createDataFrame([(s, i) for s, i, _ in members], "series STRING, variable_id INT")


def incomplete_entries(df: DataFrame) -> DataFrame:
    """Tables that lack a required field or name an unknown load pattern."""
    missing = F.array_compact(F.array(*[F.when(F.coalesce(F.trim(c), F.lit("")) == "", F.lit(c)) for c in REQUIRED]))
    return (
        df.withColumn("missing", missing)
        .filter((F.size("missing") > 0) | ~F.coalesce(F.col("load_pattern").isin(*LOAD_PATTERNS), F.lit(False)))
        .select("table", "missing", "load_pattern")
    )


def known_gaps(spark: SparkSession) -> DataFrame:
    """The allowlist: `(series, ts, reason)`."""
    rows = fixed.KNOWN_HOURLY_GAPS + fixed.KNOWN_DAILY_GAPS
    return spark.createDataFrame(rows, "series STRING, ts STRING, reason STRING").withColumn("ts", F.col("ts").cast("timestamp_ntz"))


def gap_severity(series: str = "series"):
    """ERROR, or WARN for series whose gaps are a trait of the source."""
    return F.when(F.col(series).isin(*fixed.WARN_ONLY_SERIES), "WARN").otherwise("ERROR")


def describe(df: DataFrame, table: str) -> DataFrame:
    """Attach a table's catalogue row to its columns as field metadata."""
    entry = next(dict(zip(COLUMNS, row)) for row in _rows() if row[0] == table)
    return df.select(*[F.col(c).alias(c, metadata=entry) for c in df.columns])
