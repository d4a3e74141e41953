"""Rule-based classification expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .timeutil import _col

# Labels and codes of the public registry and market files.
RENAMED_OFFSHORE_SUBSTATIONS = ("UW BÜTTEL", "UW DIELE", "UW DÖRPEN-WEST", "UW EMDEN-OST")
REDUCTION_PREFIX = "Wirkleistungseinspeisung reduz"
FULL_FEED_IN = "Volleinspeisung"
PARTIAL_FEED_IN_PREFIX = "Teileinspeisung"
GROUND_MOUNTED = "Freiflächensolaranlage"
HOUSEHOLD = "Haushalt"
ONSHORE = "Windkraft an Land"
OFFSHORE = "Windkraft auf See"
SEA_REGIONS = {"Nordsee": "DEZZ-NORDSEE", "Ostsee": "DEZZ-OSTSEE"}
TRACKED_ORIENTATION = "nachgeführt"
TRACKED_TILT = "Nachgeführt"
ROOFTOP_INDUSTRIAL, ROOFTOP_RESIDENTIAL, GROUND_FIXED, GROUND_TRACKED = "60", "61", "62", "63"


def measure_direction(text: Column | str, reduction_prefix: str = REDUCTION_PREFIX) -> Column:
    """"reduction" by prefix, else "increase"; a blank cell counts as a reduction."""
    is_reduction = F.coalesce(_col(text).startswith(reduction_prefix), F.lit(True))
    return F.when(is_reduction, "reduction").otherwise("increase")


def entity_technology(name: Column | str) -> Column:
    """Technology that a plant or substation name gives away; the order of rules matters."""
    upper = F.upper(_col(name))
    padded = F.concat(F.lit(" "), upper, F.lit(" "))

    def named(abbreviation: str, word: str) -> Column:
        return padded.contains(f" {abbreviation} ") | upper.contains(word)

    offshore = upper.contains("OWP") | upper.contains("OFFSHORE") | upper.isin(*RENAMED_OFFSHORE_SUBSTATIONS)
    return (
        F.when(offshore, "offshore_wind")
        .when(named("PV", "PHOTOVOLTA"), "pv")
        .when(named("WP", "WINDPARK"), "onshore_wind_named")
        .otherwise("ambiguous")
    )


def feed_in_category(feed_in_type: Column | str, has_storage: Column | str) -> Column:
    """Behind-the-meter class of a solar unit."""
    feed_in_type, has_storage = _col(feed_in_type), F.coalesce(_col(has_storage), F.lit(False))
    return (
        F.when(feed_in_type == FULL_FEED_IN, "full_feed_in")
        .when(feed_in_type.startswith(PARTIAL_FEED_IN_PREFIX) & has_storage, "self_consumption_with_storage")
        .when(feed_in_type.startswith(PARTIAL_FEED_IN_PREFIX), "self_consumption_no_storage")
        .otherwise("unknown")
    )


def is_tracked(orientation: Column | str, tilt: Column | str) -> Column:
    """Sun-tracking mount; the two source columns differ in capitalisation."""
    return _col(orientation).eqNullSafe(TRACKED_ORIENTATION) | _col(tilt).eqNullSafe(TRACKED_TILT)


def solar_technology(
    installation: Column | str,
    sector: Column | str,
    tracked: Column | str,
    ground_label: str = GROUND_MOUNTED,
    household_label: str = HOUSEHOLD,
) -> Column:
    """Four-way climate-database class: 60/61 rooftop, 62/63 ground-mounted.

    A missing sector counts as residential.
    """
    ground = F.coalesce(_col(installation) == ground_label, F.lit(False))
    residential = F.coalesce(_col(sector) == household_label, F.lit(True))
    return (
        F.when(ground & F.coalesce(_col(tracked), F.lit(False)), GROUND_TRACKED)
        .when(ground, GROUND_FIXED)
        .when(residential, ROOFTOP_RESIDENTIAL)
        .otherwise(ROOFTOP_INDUSTRIAL)
    )


def region_or_sea(region: Column | str, sea: Column | str) -> Column:
    """Land region, overridden by the pseudo-region of the sea a turbine stands in."""
    code = _col(region)
    for label, pseudo in SEA_REGIONS.items():
        code = F.when(_col(sea) == label, pseudo).otherwise(code)
    return code


def wind_siting(label: Column | str) -> Column:
    """"onshore" / "offshore", NULL for any other label."""
    return F.when(_col(label) == ONSHORE, "onshore").when(_col(label) == OFFSHORE, "offshore")
