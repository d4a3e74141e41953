"""Plant registry -> region-assigned units and capacity events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import classify
from ..functions.timeutil import active_at, lenient_date
from ..functions.values import kw_to_mw, normalise_key
from ..operators.joins import left_join_spreading_nulls
from ..schemas import CAPACITY_EVENTS, conform


def dated_units(units: DataFrame) -> DataFrame:
    """Capacity in MW and real dates; units never commissioned or without capacity go."""
    return (
        units.withColumn("capacity_mw", kw_to_mw("net_capacity_kw"))
        .withColumn("commissioning_date", lenient_date("commissioning_date"))
        .withColumn("final_shutdown_date", lenient_date("final_shutdown_date"))
        .filter(F.col("commissioning_date").isNotNull() & (F.col("capacity_mw") > 0))
    )


def with_nuts3(units: DataFrame, crosswalk: DataFrame) -> DataFrame:
    """Look up the municipality; no broadcast is forced, Spark sizes the crosswalk itself."""
    return units.withColumn("municipality_key", normalise_key("municipality_key")).join(crosswalk, "municipality_key", "left")


def assign_region(units: DataFrame, crosswalk: DataFrame) -> DataFrame:
    """`region_code`: the NUTS3 region, or the pseudo-region at sea; unresolved units go."""
    located = with_nuts3(units, crosswalk)
    region = classify.region_or_sea("nuts3_code", "sea_location") if "sea_location" in units.columns else F.col("nuts3_code")
    return located.withColumn("region_code", region).filter(F.col("region_code").isNotNull())


def flag_storage(units: DataFrame, storage: DataFrame, unit_id: str = "unit_id") -> DataFrame:
    """`has_storage`: does a storage unit share the location? A NULL location has none."""
    locations = storage.filter(F.col("location_id").isNotNull()).select("location_id").distinct()
    flagged = left_join_spreading_nulls(units, locations.withColumn("has_storage", F.lit(True)), "location_id", unit_id)
    return flagged.withColumn("has_storage", F.coalesce("has_storage", F.lit(False)))


def capacity_events(wind: DataFrame, solar: DataFrame, crosswalk: DataFrame, storage: DataFrame) -> DataFrame:
    """One row per located wind or solar unit, solar with its behind-the-meter class."""
    wind_units = dated_units(assign_region(wind, crosswalk)).withColumn("technology", F.lit("wind"))
    solar_units = (
        flag_storage(dated_units(assign_region(solar, crosswalk)), storage)
        .withColumn("technology", F.lit("solar"))
        .withColumn("pv_category", classify.feed_in_category("feed_in_type", "has_storage"))
    )
    return conform(wind_units, CAPACITY_EVENTS).unionByName(conform(solar_units, CAPACITY_EVENTS))


def solar_units(units: DataFrame, detail: DataFrame, crosswalk: DataFrame) -> DataFrame:
    """Solar units with climate-database technology and NUTS2 region.

    `units` and `detail` are both registry-sized: the join is on the unit id, after
    the units have been filtered and cut down to the columns in use.
    """
    slim = units.select(
        "unit_id", "municipality_key", "net_capacity_kw", "commissioning_date", "final_shutdown_date",
        "usage_sector", "installation_type",
    )
    located = with_nuts3(dated_units(slim), crosswalk).filter(F.col("nuts3_code").isNotNull())
    tracked = classify.is_tracked("main_orientation", "main_orientation_tilt_bucket")
    return located.join(detail, "unit_id", "left").select(
        "unit_id",
        "capacity_mw",
        F.substring("nuts3_code", 1, 4).alias("nuts2_region"),
        classify.solar_technology("installation_type", "usage_sector", tracked).alias("technology"),
        "commissioning_date",
        "final_shutdown_date",
    )


def wind_units(units: DataFrame) -> DataFrame:
    """Wind units with coordinates, tagged onshore or offshore; other sitings go."""
    return (
        dated_units(units)
        .withColumn("siting", classify.wind_siting("wind_onshore_or_offshore"))
        .filter(F.col("siting").isNotNull() & F.col("longitude").isNotNull() & F.col("latitude").isNotNull())
        .select("unit_id", "siting", "capacity_mw", "longitude", "latitude", "commissioning_date", "final_shutdown_date")
    )


def capacity_by(df: DataFrame, keys: list[str], capacity: str = "capacity_mw", digits: int = 0) -> DataFrame:
    """Rounded capacity per key (halves to even), for reports."""
    return df.groupBy(*keys).agg(F.bround(F.sum(capacity), digits).alias(capacity))


def offshore_now(events: DataFrame, as_of: Column, prefix: str = "DEZZ") -> DataFrame:
    """Located units at sea that are active at `as_of`."""
    return events.filter(
        F.col("region_code").startswith(prefix)
        & active_at("commissioning_date", "final_shutdown_date", as_of)
        & F.col("longitude").isNotNull()
        & F.col("latitude").isNotNull()
    )
