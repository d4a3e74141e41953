"""Region features and zone masks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import fixed_values as fixed
from ..schemas import ZONE_MASK, struct

_FEATURES = (
    "features ARRAY<STRUCT<properties: STRUCT<CNTR_CODE: STRING, LEVL_CODE: INT, NUTS_ID: STRING, NUTS_NAME: STRING, "
    "NAME_LATN: STRING>, geometry: STRING>>"
)


def read_features(spark: SparkSession, path: str) -> DataFrame:
    """Features of a GeoJSON collection: property columns plus the geometry as JSON text."""
    collection = spark.read.schema(_FEATURES).option("multiLine", True).json(path)
    return collection.select(F.explode("features").alias("f")).select("f.properties.*", "f.geometry")


def country_regions(features: DataFrame, country: str = "DE") -> DataFrame:
    """All levels of one country."""
    return features.filter(F.col("CNTR_CODE") == country).select("NUTS_ID", "LEVL_CODE", "NUTS_NAME", "NAME_LATN", "geometry")


def neighbour_outlines(features: DataFrame, countries: list[str] = fixed.NEIGHBOUR_COUNTRIES) -> DataFrame:
    """Country outlines (level 0) of the neighbours."""
    wanted = (F.col("LEVL_CODE") == 0) & F.col("CNTR_CODE").isin(*countries)
    return features.filter(wanted).select("CNTR_CODE", "NAME_LATN", "geometry")


def read_mask(spark: SparkSession, path: str, zone_prefix: str = "") -> DataFrame:
    """Zone mask; the prefix filter reaches the Parquet scan."""
    return spark.read.schema(struct(ZONE_MASK)).parquet(path).filter(F.col("zone_id").startswith(zone_prefix))
