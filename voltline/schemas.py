"""Column schemas of the normalised tables (DDL text), and one helper to reach them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SERIES = "series STRING, ts TIMESTAMP_NTZ, value DOUBLE"
INTERVALS = "start TIMESTAMP_NTZ, end TIMESTAMP_NTZ, value DOUBLE"
CAPACITY_FACTORS = "ts TIMESTAMP_NTZ, technology STRING, region STRING, cf DOUBLE"
ZONE_FACTORS = "ts TIMESTAMP_NTZ, zone_id STRING, cf DOUBLE"
CAPACITY_PANEL = "region STRING, month DATE, capacity_mw DOUBLE"
WEIGHTS = "country STRING, technology STRING, weight DOUBLE"
ALLOWLIST = "series STRING, ts TIMESTAMP_NTZ, reason STRING"
ZONE_MASK = "zone_id STRING, cell_lat DOUBLE, cell_lon DOUBLE, coverage DOUBLE"
MEASURES = (
    "start TIMESTAMP_NTZ, end TIMESTAMP_NTZ, month DATE, direction STRING, mwh DOUBLE, avg_mw DOUBLE, max_mw DOUBLE, "
    "reason STRING, instructing_tso STRING, entity STRING, primary_energy_type STRING, tech STRING"
)
OHLCV = "date DATE, open DOUBLE, high DOUBLE, low DOUBLE, close DOUBLE, volume BIGINT"
WEATHER_GRID = (
    "cell_lon DOUBLE, cell_lat DOUBLE, valid_time TIMESTAMP_NTZ, u100 DOUBLE, v100 DOUBLE, u10 DOUBLE, v10 DOUBLE, "
    "t2m DOUBLE, ssrd DOUBLE"
)
REGISTRY_UNITS = (
    "unit_id STRING, energy_source STRING, state STRING, district STRING, municipality_key STRING, postal_code STRING, "
    "longitude FLOAT, latitude FLOAT, net_capacity_kw FLOAT, gross_capacity_kw FLOAT, commissioning_date STRING, "
    "planned_commissioning_date STRING, final_shutdown_date STRING, temporary_shutdown_start_date STRING, "
    "resumption_of_operation_date STRING, unit_operational_status STRING, unit_system_status STRING"
)
REGISTRY_WIND = f"{REGISTRY_UNITS}, wind_onshore_or_offshore STRING, sea_location STRING, technology STRING"
REGISTRY_SOLAR = (
    f"{REGISTRY_UNITS}, feed_in_type STRING, location_id STRING, usage_sector STRING, installation_type STRING, technology STRING"
)
REGISTRY_SOLAR_DETAIL = "unit_id STRING, main_orientation STRING, main_orientation_tilt_bucket STRING"
REGISTRY_STORAGE_LOCATION = "unit_id STRING, location_id STRING"
CROSSWALK = "municipality_key STRING, nuts3_code STRING"
CAPACITY_EVENTS = (
    "unit_id STRING, technology STRING, region_code STRING, state STRING, capacity_mw DOUBLE, commissioning_date DATE, "
    "final_shutdown_date DATE, longitude DOUBLE, latitude DOUBLE, pv_category STRING, usage_sector STRING, "
    "installation_type STRING"
)


def struct(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)


def empty(spark: SparkSession, ddl: str) -> DataFrame:
    """A well-typed table without rows."""
    return spark.createDataFrame([], struct(ddl))


def conform(df: DataFrame, ddl: str, aliases: dict[str, str] | None = None) -> DataFrame:
    """Select the schema's columns in order, cast; absent ones become NULL.

    `aliases` maps a source name to a schema name; if several source names lead to
    one schema name, the first that exists is taken. NaN becomes NULL.
    """
    sources: dict[str, str] = {}
    for source, target in (aliases or {}).items():
        if source in df.columns:
            sources.setdefault(target, source)
    columns = []
    for field in struct(ddl).fields:
        name = sources.get(field.name, field.name)
        if name not in df.columns:
            columns.append(F.lit(None).cast(field.dataType).alias(field.name))
            continue
        column = F.col(f"`{name}`")
        if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
            column = F.when(~F.isnan(column), column)
        if isinstance(df.schema[name].dataType, T.StringType) and isinstance(field.dataType, T.NumericType):
            column = F.nullif(F.trim(column), F.lit("")).try_cast(field.dataType)
        columns.append(column.cast(field.dataType).alias(field.name))
    return df.select(*columns)
