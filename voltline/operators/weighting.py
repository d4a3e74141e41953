"""Capacity-factor x capacity weighting and country blends.

NULL rules differ on purpose and are part of each operator's contract:

=====================  =====================================================
blend_technologies     a NULL (or absent) hour of a modelled technology -> NULL
area_weighted_mean     a NULL hour counts as 0; a zone NULL throughout is left out
plain_mean             NULLs are skipped; all NULL -> NULL
potential_*            a NULL product counts as 0; every hour is kept
=====================  =====================================================
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.timeutil import month_of
from .dedup import keep_last


def modelled(cf: DataFrame, keys: list[str], value: str = "cf") -> DataFrame:
    """Keys with at least one non-NULL value."""
    return cf.filter(F.col(value).isNotNull()).select(*keys).distinct()


def technology_weights(pairs: DataFrame, weights: DataFrame, default_country: str = "*") -> DataFrame:
    """Weights per (country, technology), scaled to 1 over the technologies present in `pairs`.

    `weights` is `(country, technology, weight)`. A country with rows of its own
    uses only those; any other takes the rows of `default_country`.
    """
    own = weights.select("country").distinct().withColumn("_own", F.lit(True))
    chosen = (
        pairs.join(own, "country", "left")
        .withColumn("_source", F.when(F.col("_own"), F.col("country")).otherwise(F.lit(default_country)))
        .join(weights.withColumnRenamed("country", "_source"), ["_source", "technology"])
        .select("country", "technology", "weight")
    )
    # A country has a handful of technologies, so this window is small by nature.
    country = Window.partitionBy("country")
    return chosen.select(
        "country",
        "technology",
        (F.col("weight") / F.sum("weight").over(country)).alias("weight"),
        F.count("*").over(country).alias("n_technologies"),
    )


def blend_technologies(cf: DataFrame, weights: DataFrame, default_country: str = "*", ts: str = "ts") -> DataFrame:
    """One series per country from its technologies: `cf` is `(ts, country, technology, cf)`.

    A technology that is NULL throughout for a country is left out and the other
    weights are scaled up; an hour in which a remaining one is missing is NULL.
    """
    shares = technology_weights(modelled(cf, ["country", "technology"]), weights, default_country)
    return (
        cf.join(shares, ["country", "technology"])
        .groupBy(ts, "country")
        .agg(
            F.sum(F.col("cf") * F.col("weight")).alias("_cf"),
            F.count("cf").alias("_n"),
            F.max("n_technologies").alias("_expected"),
        )
        .select(ts, "country", F.when(F.col("_n") == F.col("_expected"), F.col("_cf")).alias("cf"))
    )


def area_weighted_mean(cf: DataFrame, shares: DataFrame, ts: str = "ts") -> DataFrame:
    """Country mean of zone factors; `shares` is `(zone_id, country, weight)`."""
    return (
        cf.join(shares, "zone_id")
        .groupBy(ts, "country")
        .agg(F.coalesce(F.sum(F.col("cf") * F.col("weight")), F.lit(0.0)).alias("cf"))
    )


def plain_mean(cf: DataFrame, ts: str = "ts") -> DataFrame:
    """Country mean of zone factors, unweighted; country = first two letters of the zone."""
    return cf.groupBy(ts, F.substring("zone_id", 1, 2).alias("country")).agg(F.avg("cf").alias("cf"))


def in_all_series(df: DataFrame, series: str, names: list[str], ts: str = "ts", compact: bool = False) -> DataFrame:
    """Rows whose time step occurs in every one of `names` (inner alignment of long series).

    Different names are counted per time step and semi-joined, which also holds
    when one step has very many rows. `compact` is for already aggregated input
    (few rows per step): a window then avoids computing `df` twice.
    """
    everywhere = F.col("_seen") == len(set(names))
    wanted = df.filter(F.col(series).isin(*names))
    if compact:
        seen = F.size(F.collect_set(series).over(Window.partitionBy(ts)))
        return wanted.withColumn("_seen", seen).filter(everywhere).drop("_seen")
    complete = wanted.groupBy(ts).agg(F.count_distinct(series).alias("_seen")).filter(everywhere)
    return wanted.join(complete.select(ts), ts, "left_semi")


def pivot_series(df: DataFrame, series: str, names: list[str], value: str, ts: str = "ts", prefix: str = "") -> DataFrame:
    """Long -> wide for a fixed list of series: the full outer alignment on `ts`."""
    columns = [F.max(F.when(F.col(series) == name, F.col(value))).alias(f"{prefix}{name}") for name in names]
    return df.groupBy(ts).agg(*columns)


def month_to_hour(hours: DataFrame, monthly: DataFrame, keys: list[str], ts: str = "ts", month: str = "month") -> DataFrame:
    """Give every hour the row of its calendar month; no row for the month -> NULL.

    `monthly` may hold several dates of one month; the latest wins.
    """
    by_month = keep_last(monthly.withColumn("_month", month_of(month)), [*keys, "_month"], month).drop(month)
    return hours.withColumn("_month", month_of(ts)).join(by_month, [*keys, "_month"], "left").drop("_month")


def potential_monthly(cf: DataFrame, monthly: DataFrame, keys: list[str], ts: str = "ts", capacity: str = "capacity_mw") -> DataFrame:
    """Hourly potential (MW) of a fleet that changes month by month."""
    return _potential(month_to_hour(cf, monthly, keys, ts), ts, capacity)


def potential_fixed(cf: DataFrame, fleet: DataFrame, keys: list[str], ts: str = "ts", capacity: str = "capacity_mw") -> DataFrame:
    """Hourly potential (MW) of one fixed fleet."""
    return _potential(cf.join(fleet, keys, "left"), ts, capacity)


def _potential(joined: DataFrame, ts: str, capacity: str) -> DataFrame:
    product = F.col("cf") * F.col(capacity)
    return joined.groupBy(ts).agg(F.coalesce(F.sum(product), F.lit(0.0)).alias("potential_mw"))


def potentials(cf: DataFrame, capacities: DataFrame, keys: list[str], names: list[str], ts: str = "ts", month: str | None = None) -> DataFrame:
    """Hourly potential (MW) of several fleets at once, each under the name of its capacity column.

    `capacities` has one row per key (and per `month`, if that is given) with all fleets'
    capacities side by side, so the factors are read and joined once for all of them.
    """
    if month is not None:
        cf, capacities, keys = cf.withColumn("_month", month_of(ts)), capacities.withColumn("_month", month_of(month)).drop(month), [*keys, "_month"]
    sums = [F.coalesce(F.sum(F.col("cf") * F.col(n)), F.lit(0.0)).alias(n) for n in names]
    return cf.join(capacities, keys, "left").groupBy(ts).agg(*sums)


def fleet_capacity_factors(cf: DataFrame, fleets: DataFrame, keys: list[str], names: list[str], ts: str = "ts") -> DataFrame:
    """Potential of several fixed fleets over their whole capacities (unmodelled zones included); no capacity -> NULL."""
    totals = fleets.agg(F.struct(*[F.sum(n).alias(n) for n in names]).alias("t")).scalar()
    of_fleets = potentials(cf, fleets, keys, names, ts).withColumn("_total", totals)
    return of_fleets.select(ts, *[F.try_divide(F.col(n), F.col(f"_total.{n}")).alias(n) for n in names])


def fleet_capacity_factor(cf: DataFrame, fleet: DataFrame, keys: list[str], ts: str = "ts", capacity: str = "capacity_mw") -> DataFrame:
    """Potential of a fixed fleet over its whole capacity (unmodelled zones included); no capacity -> NULL."""
    return fleet_capacity_factors(cf, fleet, keys, [capacity], ts).withColumnRenamed(capacity, "capacity_factor")


def unmodelled_capacity(cf: DataFrame, fleet: DataFrame, keys: list[str], capacity: str = "capacity_mw") -> DataFrame:
    """Capacity in key columns whose factor is NULL throughout (0 where no unit stands there)."""
    empty = cf.groupBy(*keys).agg(F.count("cf").alias("_n")).filter(F.col("_n") == 0).select(*keys)
    return empty.join(fleet, keys, "left").select(*keys, F.coalesce(F.col(capacity), F.lit(0.0)).alias(capacity))


def share_of_total(df: DataFrame, keys: list[str], value: str, within: list[str] | None = None, share: str = "share") -> DataFrame:
    """Sum per key and its share of the total within `within` (of everything if empty)."""
    sums = df.groupBy(*keys).agg(F.sum(value).alias(value))
    if not within:
        return sums.withColumn(share, F.try_divide(F.col(value), sums.agg(F.sum(value).alias("t")).scalar()))
    totals = sums.groupBy(*within).agg(F.sum(value).alias("_total"))
    return sums.join(totals, within).withColumn(share, F.try_divide(F.col(value), F.col("_total"))).drop("_total")


def fleet_mix_snapshot(units: DataFrame, technologies: list[str], as_of: Column, totals: dict[str, Column], capacity: str = "capacity_mw", technology: str = "technology") -> DataFrame:
    """One row: mix share of each technology (0 if absent) and the capacity of each named total.

    `totals` maps an output name to the condition its units meet; the first one is
    the base of the shares. `units` holds active units only.
    """
    base_name = next(iter(totals))
    amount = F.col(capacity)
    base = F.sum(F.when(totals[base_name], amount))
    shares = [
        F.coalesce(
            F.try_divide(F.sum(F.when(totals[base_name] & (F.col(technology) == t), amount)), base), F.lit(0.0)
        ).alias(f"weight_{t}")
        for t in technologies
    ]
    sums = [F.coalesce(F.sum(F.when(condition, amount)), F.lit(0.0)).alias(f"{name}_mw") for name, condition in totals.items()]
    return units.agg(*shares, *sums).withColumn("as_of", as_of)


def fleet_blend(base: DataFrame, snapshot: DataFrame, technologies: list[str], prefix: str = "solar_", ts: str = "ts") -> DataFrame:
    """Technology series x one fleet snapshot: three factors, three powers and their sum.

    `base` is wide: `prefix + technology` columns plus `wind_onshore` and
    `wind_offshore`. The one-row snapshot enters as a scalar subquery.
    """
    snap = snapshot.select(F.struct(*snapshot.columns).alias("s")).scalar()
    joined = base.withColumn("_s", snap)
    solar = F.lit(0.0)
    for t in technologies:
        solar = solar + F.col(f"{prefix}{t}") * F.col(f"_s.weight_{t}")
    factors = joined.select(
        ts,
        solar.alias("capacity_factor_solar"),
        F.col("wind_onshore").alias("capacity_factor_wind_onshore"),
        F.col("wind_offshore").alias("capacity_factor_wind_offshore"),
        "_s",
    )
    powers = {name: F.col(f"capacity_factor_{name}") * F.col(f"_s.{name}_mw") for name in ("solar", "wind_onshore", "wind_offshore")}
    total = powers["solar"] + powers["wind_onshore"] + powers["wind_offshore"]
    return factors.select(
        ts,
        *[f"capacity_factor_{name}" for name in powers],
        *[column.alias(f"power_mw_{name}") for name, column in powers.items()],
        total.alias("power_mw_total"),
    )


def imbalance_price(balance: Column, *modules: Column) -> Column:
    """Highest module where the area is short, lowest where it is long; NULL modules are out.

    A balance of exactly 0 has no defined price.
    """
    return F.when(balance > 0, F.greatest(*modules)).when(balance < 0, F.least(*modules))
