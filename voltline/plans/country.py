"""Country-level capacity factors without any plant registry."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import fixed_values as fixed
from ..operators.weighting import area_weighted_mean, blend_technologies, in_all_series, modelled, pivot_series, plain_mean
from ..operators.zones import country_area_shares

FAMILIES = ["wind_onshore", "wind_offshore", "solar"]


def default_solar_weights(spark: SparkSession, overrides: dict[str, dict[str, float]] | None = None) -> DataFrame:
    """`(country, technology, weight)`: the default mix under `*`, plus sourced country mixes."""
    mixes = {"*": fixed.DEFAULT_SOLAR_WEIGHTS} | (overrides or {})
    rows = [(country, technology, weight) for country, mix in mixes.items() for technology, weight in mix.items()]
    return spark.createDataFrame(rows, "country STRING, technology STRING, weight DOUBLE")


def zone_weighted_wind(cf: DataFrame, mask: DataFrame) -> DataFrame:
    """Area-weighted country factors; zones outside the mask or NULL throughout are left out."""
    return area_weighted_mean(cf, country_area_shares(mask, modelled(cf, ["zone_id"])))


def country_product(solar: DataFrame, onshore: DataFrame, offshore: DataFrame, mask: DataFrame, weights: DataFrame) -> DataFrame:
    """`(ts, technology, country, cf)` for hours that all three families cover.

    `solar` is `(ts, country, technology, cf)`, already shifted to true UTC;
    onshore and offshore are `(ts, zone_id, cf)`.
    """
    parts = {
        "wind_onshore": zone_weighted_wind(onshore, mask),
        "wind_offshore": plain_mean(offshore),
        "solar": blend_technologies(solar, weights),
    }
    stacked = None
    for family, df in parts.items():
        part = df.select("ts", F.lit(family).alias("technology"), "country", "cf")
        stacked = part if stacked is None else stacked.unionByName(part)
    return in_all_series(stacked, "technology", FAMILIES, compact=True)


def country_slice(product: DataFrame, country: str) -> DataFrame:
    """One country's hours, one column per family."""
    return pivot_series(product.filter(F.col("country") == country), "technology", FAMILIES, "cf")


def technology_base(solar: DataFrame, onshore: DataFrame, offshore: DataFrame, onshore_mask: DataFrame, offshore_mask: DataFrame, country: str = "DE") -> DataFrame:
    """Wide hourly base of one country: four solar technologies, onshore and offshore wind.

    Only hours present in every part. Each wind family needs a mask of its own
    zone scheme; a mask that knows none of the zones raises.
    """
    def wind(cf: DataFrame, mask: DataFrame, name: str) -> DataFrame:
        own = cf.filter(F.col("zone_id").startswith(country))
        shares = country_area_shares(mask, modelled(own, ["zone_id"]))
        zones = shares.agg(F.count("*").alias("n")).scalar()
        checked = F.when(zones > 0, F.col("cf")).otherwise(F.raise_error(F.lit(f"mask has no zone of {name}")).cast("double"))
        # left join: without any share the hours must survive to meet the check
        return (
            own.join(shares, "zone_id", "left")
            .groupBy("ts")
            .agg(F.coalesce(F.sum(F.col("cf") * F.col("weight")), F.lit(0.0)).alias("cf"))
            .select("ts", F.lit(name).alias("series"), checked.alias("cf"))
        )

    solar_part = solar.filter(F.col("country") == country).select(
        "ts", F.concat(F.lit("solar_"), F.col("technology")).alias("series"), "cf"
    )
    names = [f"solar_{t}" for t in fixed.SOLAR_TECHNOLOGIES] + ["wind_onshore", "wind_offshore"]
    stacked = solar_part.unionByName(wind(onshore, onshore_mask, "wind_onshore")).unionByName(
        wind(offshore, offshore_mask, "wind_offshore")
    )
    wide = stacked.groupBy("ts").agg(
        *[F.max(F.when(F.col("series") == n, F.col("cf"))).alias(n) for n in names],
        F.count_if(F.col("series").startswith("solar_")).alias("_solar"),
        F.count_if(F.col("series") == "wind_onshore").alias("_on"),
        F.count_if(F.col("series") == "wind_offshore").alias("_off"),
    )
    return wide.filter("_solar > 0 AND _on > 0 AND _off > 0").select("ts", *names)
