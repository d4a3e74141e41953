"""Plant registry extracts and the municipality crosswalk."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import fixed_values as fixed
from ..functions.values import pad_key
from ..schemas import CROSSWALK, REGISTRY_SOLAR, REGISTRY_SOLAR_DETAIL, REGISTRY_STORAGE_LOCATION, REGISTRY_WIND, conform


def read_registry(spark: SparkSession, path: str, format: str = "parquet", **options: str) -> DataFrame:
    """Raw registry table: `parquet`, `xml` (with `rowTag`) or `jdbc` (with `partitionColumn`)."""
    return spark.read.format(format).options(**options).load(path)


def unit_extract(raw: DataFrame, technology: str) -> DataFrame:
    """Harmonised units: known columns only, absent ones NULL, names translated."""
    schema = {"wind": REGISTRY_WIND, "solar": REGISTRY_SOLAR}[technology]
    names = fixed.REGISTRY_COMMON | fixed.REGISTRY_EXTRA[technology]
    return conform(raw.withColumn("technology", F.lit(technology)), schema, names)


def solar_detail_extract(raw: DataFrame) -> DataFrame:
    return conform(raw, REGISTRY_SOLAR_DETAIL, fixed.REGISTRY_SOLAR_DETAIL)


def storage_location_extract(raw: DataFrame) -> DataFrame:
    return conform(raw, REGISTRY_STORAGE_LOCATION, fixed.REGISTRY_STORAGE_LOCATION)


def crosswalk(raw: DataFrame) -> DataFrame:
    """Municipality key (8 digits) -> NUTS3 region."""
    named = conform(raw, CROSSWALK, {"LAU CODE": "municipality_key", "NUTS3": "nuts3_code"})
    return named.withColumn("municipality_key", pad_key("municipality_key"))


def read_crosswalk(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    return crosswalk(spark.read.option("header", True).csv(paths))
