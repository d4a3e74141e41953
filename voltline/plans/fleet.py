"""National potential and fleet-weighted factors: registry units x capacity factors."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import fixed_values as fixed
from ..functions.timeutil import active_at
from ..operators.panels import capacity_snapshot, monthly_capacity_panel
from ..operators.zones import Axis, presplit_capacity
from ..operators.weighting import fleet_blend, fleet_capacity_factors, fleet_mix_snapshot, potentials, unmodelled_capacity
from . import registry


@dataclass(frozen=True)
class Family:
    """Units and factors of one technology family, sharing their key columns.

    `member` says which of `units` belong to the family (default: all). Families that hold the
    same `units` and `cf` objects and keys are computed together: both tables are read once.
    """

    name: str
    units: DataFrame
    cf: DataFrame
    keys: list[str]
    member: Column | None = None


def _together(families: list[Family]) -> list[list[Family]]:
    groups: dict[tuple, list[Family]] = {}
    for f in families:
        groups.setdefault((id(f.units), id(f.cf), *f.keys), []).append(f)
    return list(groups.values())


def _side_by_side(group: list[Family]) -> tuple[DataFrame, list[str]]:
    """The group's units with one capacity column per family: NULL where a unit isn't in it."""
    columns = {f"_{f.name}": F.col("capacity_mw") if f.member is None else F.when(f.member, F.col("capacity_mw")) for f in group}
    return group[0].units.withColumns(columns), list(columns)


def _aligned(parts: list[DataFrame], names: list[str], ts: str = "ts") -> DataFrame:
    """Parts with columns of their own on every hour that any of them has."""
    if len(parts) == 1:
        return parts[0].select(ts, *names)
    stacked = parts[0]
    for part in parts[1:]:
        stacked = stacked.unionByName(part, allowMissingColumns=True)
    return stacked.groupBy(ts).agg(*[F.max(n).alias(n) for n in names])


def prepare_families(
    wind: DataFrame, solar: DataFrame, solar_detail: DataFrame, crosswalk: DataFrame,
    onshore_mask: DataFrame, offshore_mask: DataFrame, latitudes: Axis, longitudes: Axis,
    cf_solar: DataFrame, cf_onshore: DataFrame, cf_offshore: DataFrame, zone_prefix: str = "DE",
) -> list[Family]:
    """Registry units matched to the key columns of their capacity factors.

    Solar goes by technology and region (`cf_solar`: `ts, technology, region, cf`),
    wind by zone, each unit split over the zones of its grid cell
    (`ts, zone_id, cf`).
    """
    placed = registry.wind_units(wind)

    def by_zone(siting: str, mask: DataFrame) -> DataFrame:
        return presplit_capacity(placed.filter(F.col("siting") == siting), mask, latitudes, longitudes, zone_prefix)

    panels = registry.solar_units(solar, solar_detail, crosswalk).withColumnRenamed("nuts2_region", "region")
    return [
        Family("solar", panels, cf_solar, ["technology", "region"]),
        Family("wind_onshore", by_zone("onshore", onshore_mask), cf_onshore, ["zone_id"]),
        Family("wind_offshore", by_zone("offshore", offshore_mask), cf_offshore, ["zone_id"]),
    ]


def historic_potential(families: list[Family], first_month: Column, last_month: Column, export_from: Column) -> DataFrame:
    """Hourly potential per family with the fleet of each month, aligned on every hour.

    The monthly capacities of families that share units and factors stand side by side
    in one panel, which meets the factors once. Families with factors of their own are
    aligned by one grouping of already summed hours instead of a chain of full joins.
    """
    parts = []
    for group in _together(families):
        units, columns = _side_by_side(group)
        panel = monthly_capacity_panel(units, group[0].keys, first_month, last_month, export_from, capacity=columns)
        parts.append(potentials(group[0].cf, panel, group[0].keys, columns, month="month"))
    wide = _aligned(parts, [f"_{f.name}" for f in families])
    return wide.withColumnsRenamed({f"_{f.name}": f"potential_{f.name}_mw" for f in families})


def current_fleet_factors(families: list[Family], as_of: Column) -> DataFrame:
    """Hourly capacity factor per family if the fleet of `as_of` had always stood."""
    parts = []
    for group in _together(families):
        units, columns = _side_by_side(group)
        active = units.filter(active_at("commissioning_date", "final_shutdown_date", as_of)).dropna(subset=group[0].keys)
        fleets = active.groupBy(*group[0].keys).agg(*[F.sum(c).alias(c) for c in columns])
        parts.append(fleet_capacity_factors(group[0].cf, fleets, group[0].keys, columns))
    wide = _aligned(parts, [f"_{f.name}" for f in families])
    return wide.withColumnsRenamed({f"_{f.name}": f"capacity_factor_{f.name}" for f in families})


def unmodelled(family: Family, as_of: Column) -> DataFrame:
    """Active capacity where the family has no factors at all."""
    units = family.units if family.member is None else family.units.filter(family.member)
    return unmodelled_capacity(family.cf, capacity_snapshot(units, family.keys, as_of), family.keys)


def fleet_snapshot(solar: DataFrame, wind: DataFrame, as_of: Column) -> DataFrame:
    """One row: solar technology mix and the three installed totals at `as_of`.

    `solar` has `technology`, `wind` has `siting` (onshore / offshore).
    """
    stacked = solar.select(
        F.lit("solar").alias("family"), "technology", "capacity_mw", "commissioning_date", "final_shutdown_date"
    ).unionByName(
        wind.select(
            F.concat(F.lit("wind_"), F.col("siting")).alias("family"), F.lit(None).cast("string").alias("technology"),
            "capacity_mw", "commissioning_date", "final_shutdown_date",
        )
    )
    active = stacked.filter(active_at("commissioning_date", "final_shutdown_date", as_of))
    totals = {name: F.col("family") == name for name in ("solar", "wind_onshore", "wind_offshore")}
    return fleet_mix_snapshot(active, fixed.SOLAR_TECHNOLOGIES, as_of, totals)


def snapshot_table(snapshot: DataFrame) -> DataFrame:
    """The snapshot under the column names of its stored table."""
    names = {c: f"solar_{c}" for c in snapshot.columns if c.startswith("weight_")} | {c: f"{c.removesuffix('_mw')}_total_mw" for c in snapshot.columns if c.endswith("_mw")}
    return snapshot.withColumnsRenamed(names)


def fleet_weighted(base: DataFrame, snapshot: DataFrame) -> DataFrame:
    """Technology base x one fleet vintage; another vintage needs no new base."""
    return fleet_blend(base, snapshot, fixed.SOLAR_TECHNOLOGIES)
