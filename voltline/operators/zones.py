"""Raster zones: nearest cells, fractional weights, areas and centroids.

A mask is long: `(zone_id, cell_lat, cell_lon, coverage)` with coverage in (0, 1].
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.values import area_weight, grid_index
from .nearest import nearest_place


@dataclass(frozen=True)
class Axis:
    """A regularly spaced axis; `step` may be negative."""

    origin: float
    step: float
    size: int

    def index(self, value: Column | str) -> Column:
        return grid_index(value, self.origin, self.step, self.size)


def zone_centroids(mask: DataFrame) -> DataFrame:
    """Coverage-weighted mean position per zone."""
    total = F.sum("coverage")
    return mask.groupBy("zone_id").agg(
        (F.sum(F.col("coverage") * F.col("cell_lat")) / total).alias("centroid_lat"),
        (F.sum(F.col("coverage") * F.col("cell_lon")) / total).alias("centroid_lon"),
    )


def zone_areas(mask: DataFrame) -> DataFrame:
    """Relative area per zone: coverage times the cosine of the latitude."""
    return mask.groupBy("zone_id").agg(F.sum(F.col("coverage") * area_weight("cell_lat")).alias("area"))


def country_area_shares(mask: DataFrame, modelled_zones: DataFrame) -> DataFrame:
    """Share of each zone in its country's area, over zones known to both inputs.

    Country = first two letters of the zone. Returns `(zone_id, country, weight)`.
    """
    areas = (
        zone_areas(mask)
        .join(modelled_zones.select("zone_id").distinct(), "zone_id", "left_semi")
        .withColumn("country", F.substring("zone_id", 1, 2))
    )
    # One row per zone of a country: small by nature, hence a window rather than a second pass.
    total = F.sum("area").over(Window.partitionBy("country"))
    return areas.select("zone_id", "country", (F.col("area") / total).alias("weight"))


def fractional_zone_weights(
    units: DataFrame, mask: DataFrame, lat_axis: Axis, lon_axis: Axis, zone_prefix: str = "",
    unit_id: str = "unit_id", latitude: str = "latitude", longitude: str = "longitude",
) -> DataFrame:
    """Split each unit over the zones that cover its nearest grid cell.

    Weights are the coverages, scaled to 1 over the zones with `zone_prefix`. A
    cell with no coverage falls back to the nearest zone centroid (squared degree
    distance; ties go to the first zone id).

    Weights depend on the cell alone, so they are settled once per cell and the
    units only look them up: no shuffle per unit, and a crowded cell is harmless
    while the cell table is small enough for Spark to broadcast (otherwise AQE
    splits it). Units on uncovered cells find their centroid through an index of
    cells (`nearest_place`), never by comparing all. A unit without a position gets
    no zone.
    """
    covered = mask.filter(F.col("zone_id").startswith(zone_prefix) & (F.col("coverage") > 0))
    cells = (
        covered.withColumn("_lat_idx", lat_axis.index("cell_lat"))
        .withColumn("_lon_idx", lon_axis.index("cell_lon"))
        .groupBy("_lat_idx", "_lon_idx")
        .agg(F.collect_list(F.struct("zone_id", "coverage")).alias("_zones"), F.sum("coverage").alias("_total"))
        .withColumn(
            "_zones",
            F.transform("_zones", lambda z: F.struct(z["zone_id"].alias("zone_id"), (z["coverage"] / F.col("_total")).alias("weight"))),
        )
        .select("_lat_idx", "_lon_idx", "_zones")
    )
    looked_up = (
        units.select(unit_id, F.col(latitude).alias("_latitude"), F.col(longitude).alias("_longitude"))
        .withColumn("_lat_idx", lat_axis.index("_latitude"))
        .withColumn("_lon_idx", lon_axis.index("_longitude"))
        .join(cells, ["_lat_idx", "_lon_idx"], "left")
    )
    # only units on uncovered cells ask for a centroid; the others have no position there
    asks = F.col("_zones").isNull() & F.col("_lat_idx").isNotNull() & F.col("_lon_idx").isNotNull()
    asking = looked_up.select(unit_id, "_zones", F.when(asks, F.col("_latitude")).alias("_latitude"), F.when(asks, F.col("_longitude")).alias("_longitude"))
    placed = nearest_place(asking, zone_centroids(covered), "zone_id", "_latitude", "_longitude", "centroid_lat", "centroid_lon")
    fallback = F.when(F.col("zone_id").isNotNull(), F.array(F.struct("zone_id", F.lit(1.0).alias("weight"))))
    return placed.select(unit_id, F.inline(F.coalesce("_zones", fallback))).filter(F.col("weight") > 0)


def presplit_capacity(
    units: DataFrame, mask: DataFrame, lat_axis: Axis, lon_axis: Axis, zone_prefix: str = "",
    unit_id: str = "unit_id", capacity: str = "capacity_mw", latitude: str = "latitude", longitude: str = "longitude",
) -> DataFrame:
    """One row per unit and zone, capacity already multiplied by the zone weight.

    The split is looked up for each unit row itself, so nothing is joined back by id.
    """
    carried = F.struct(*units.columns)
    tagged = units.select(carried.alias("_unit"), latitude, longitude)
    split = fractional_zone_weights(
        tagged, mask, lat_axis, lon_axis, zone_prefix, unit_id="_unit", latitude=latitude, longitude=longitude
    )
    return split.select("_unit.*", "zone_id", "weight").withColumn(capacity, F.col(capacity) * F.col("weight"))


def spatial_mean(grid: DataFrame, value: Column, ts: str = "valid_time", weight: Column | None = None) -> DataFrame:
    """Mean over all cells per time step, optionally cell-weighted; NULL cells are left out."""
    if weight is None:
        return grid.groupBy(ts).agg(F.avg(value).alias("value"))
    w = F.when(value.isNotNull(), weight)
    return grid.groupBy(ts).agg((F.sum(value * w) / F.sum(w)).alias("value"))


def grid_summary(grid: DataFrame) -> DataFrame:
    """Rows, distinct cells and months present, as one row.

    Distinct cells are counted from a first grouping by cell and month, so the
    wide distinct aggregate runs on that small result.
    """
    cells = grid.groupBy("cell_lon", "cell_lat", F.trunc(F.col("valid_time").cast("date"), "MM").alias("month")).agg(
        F.count("*").alias("n")
    )
    return cells.agg(
        F.sum("n").alias("row_count"),
        F.count_distinct(F.struct("cell_lon", "cell_lat")).alias("cell_count"),
        F.count_distinct("month").alias("month_count"),
        F.min("month").alias("first_month"),
        F.max("month").alias("last_month"),
    )
