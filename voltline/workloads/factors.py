"""Capacity-factor weighting, zone geometry and country blends.

The test tables stand in for the energy ones: order days are the time steps,
nations the zones (named after their region, so that two letters give the
"country"), suppliers the mask cells, customers the located units.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import values
from ..functions.timeutil import floor_to, month_of, ntz, shift_hours
from ..operators import weighting as w
from ..operators.panels import monthly_capacity_panel
from ..operators.reshape import pivot_mean
from ..operators.zones import Axis, country_area_shares, fractional_zone_weights, presplit_capacity, spatial_mean, zone_areas, zone_centroids
from ..plans import country as country_plan
from ..plans import fleet as fleet_plan
from .panels import UNITS_SQL, order_units
from .registry import table, workload

LAT = Axis(50.0, -0.25, 41)
LON = Axis(5.0, 0.25, 41)

# --- stand-in tables -----------------------------------------------------------

ZONES_SQL = """SELECT n_nationkey, n_name, upper(substr(r_name, 1, 2)) || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS zone_id
FROM nation JOIN region ON r_regionkey = n_regionkey"""

CF_SQL = f"""SELECT o_orderdate AS ts, z.zone_id,
  CASE WHEN z.n_nationkey % 10 <> 7 AND count(*) % 4 <> 0 THEN avg(o_totalprice) / 600011 END AS cf
FROM orders JOIN customer ON c_custkey = o_custkey JOIN ({ZONES_SQL}) z ON z.n_nationkey = c_nationkey
GROUP BY o_orderdate, z.zone_id, z.n_nationkey"""

MASK_SQL = f"""SELECT z.zone_id, 40 + (s_suppkey % 40) * 0.25 AS cell_lat, 5 + (CAST(floor(s_acctbal) AS BIGINT) + 1000) % 40 * 0.25 AS cell_lon,
  max((s_suppkey % 4 + 1) * 0.25) AS coverage
FROM supplier JOIN ({ZONES_SQL}) z ON z.n_nationkey = s_nationkey GROUP BY ALL"""

FLEET_SQL = f"SELECT z.zone_id, sum(s_acctbal) AS capacity_mw FROM supplier JOIN ({ZONES_SQL}) z ON z.n_nationkey = s_nationkey WHERE s_acctbal > 0 GROUP BY 1"


def zones(spark, d):
    """Nation -> zone id; 25 rows."""
    region = table(spark, d, "region").withColumnRenamed("r_regionkey", "n_regionkey")
    zone = F.concat(F.upper(F.substring("r_name", 1, 2)), F.lpad(F.col("n_nationkey").cast("string"), 2, "0"))
    return table(spark, d, "nation").join(region, "n_regionkey").select("n_nationkey", zone.alias("zone_id"))


def zone_factors(spark, d):
    customer = table(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("n_nationkey"))
    cf = F.when((F.col("n_nationkey") % 10 != 7) & (F.col("_n") % 4 != 0), F.col("_price") / 600011)
    return (
        table(spark, d, "orders")
        .join(customer, "o_custkey")
        .groupBy(F.col("o_orderdate").alias("ts"), "n_nationkey")
        .agg(F.avg("o_totalprice").alias("_price"), F.count("*").alias("_n"))
        .join(zones(spark, d), "n_nationkey")
        .select("ts", "zone_id", cf.alias("cf"))
    )


def mask(spark, d):
    lat = F.lit(40.0) + (F.col("s_suppkey") % 40) * 0.25
    lon = F.lit(5.0) + (F.floor("s_acctbal") + 1000) % 40 * 0.25
    return (
        table(spark, d, "supplier")
        .withColumnRenamed("s_nationkey", "n_nationkey")
        .join(zones(spark, d), "n_nationkey")
        .groupBy("zone_id", lat.alias("cell_lat"), lon.alias("cell_lon"))
        .agg(F.max((F.col("s_suppkey") % 4 + 1) * 0.25).alias("coverage"))
    )


def located_units(spark, d):
    return table(spark, d, "customer").select(
        F.col("c_custkey").alias("unit_id"),
        F.col("c_acctbal").alias("capacity_mw"),
        (F.lit(38.0) + (F.col("c_custkey") % 1000) * 0.013).alias("latitude"),
        (F.lit(4.0) + (F.col("c_acctbal") + 1000) / 11000 * 12).alias("longitude"),
    )


def fleet(spark, d):
    return (
        table(spark, d, "supplier")
        .filter(F.col("s_acctbal") > 0)
        .withColumnRenamed("s_nationkey", "n_nationkey")
        .join(zones(spark, d), "n_nationkey")
        .groupBy("zone_id")
        .agg(F.sum("s_acctbal").alias("capacity_mw"))
    )


def monthly_capacity(spark, d):
    """Capacity per zone and ship month, dated at several days of the month."""
    part = table(spark, d, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("n_nationkey"))
    return (
        table(spark, d, "lineitem")
        .join(part, "l_suppkey")
        .join(zones(spark, d), "n_nationkey")
        .groupBy("zone_id", F.col("l_shipdate").cast("date").alias("month"))
        .agg(F.sum("l_quantity").alias("capacity_mw"))
    )


MONTHLY_SQL = f"""SELECT z.zone_id, CAST(l_shipdate AS DATE) AS month, sum(l_quantity) AS capacity_mw
FROM lineitem JOIN supplier ON s_suppkey = l_suppkey JOIN ({ZONES_SQL}) z ON z.n_nationkey = s_nationkey GROUP BY ALL"""

_LAST_OF_MONTH_SQL = """SELECT zone_id, date_trunc('month', month) AS m, capacity_mw FROM (
  SELECT *, row_number() OVER (PARTITION BY zone_id, date_trunc('month', month) ORDER BY month DESC) AS rn FROM mc) WHERE rn = 1"""


# --- months to hours, potentials -------------------------------------------------

@workload(f"""
WITH cf AS ({CF_SQL}), mc AS ({MONTHLY_SQL}), k AS ({_LAST_OF_MONTH_SQL})
SELECT cf.ts, cf.zone_id, round(cf.cf, 8) AS cf, k.capacity_mw FROM cf LEFT JOIN k ON k.zone_id = cf.zone_id AND k.m = date_trunc('month', cf.ts)""")
def month_to_hour(spark, d):
    """Every time step takes the last capacity of its month."""
    return w.month_to_hour(zone_factors(spark, d), monthly_capacity(spark, d), ["zone_id"]).withColumn("cf", F.round("cf", 8))


@workload(f"""
WITH cf AS ({CF_SQL}), mc AS ({MONTHLY_SQL}), k AS ({_LAST_OF_MONTH_SQL})
SELECT cf.ts, round(coalesce(sum(cf.cf * k.capacity_mw), 0), 4) AS potential_mw
FROM cf LEFT JOIN k ON k.zone_id = cf.zone_id AND k.m = date_trunc('month', cf.ts) GROUP BY cf.ts""")
def potential_monthly(spark, d):
    result = w.potential_monthly(zone_factors(spark, d), monthly_capacity(spark, d), ["zone_id"])
    return result.withColumn("potential_mw", F.round("potential_mw", 4))


@workload(f"""
WITH cf AS ({CF_SQL}), f AS ({FLEET_SQL})
SELECT cf.ts, round(coalesce(sum(cf.cf * f.capacity_mw), 0), 4) AS potential_mw FROM cf LEFT JOIN f USING (zone_id) GROUP BY cf.ts""")
def potential_fixed(spark, d):
    result = w.potential_fixed(zone_factors(spark, d), fleet(spark, d), ["zone_id"])
    return result.withColumn("potential_mw", F.round("potential_mw", 4))


@workload(f"""
WITH cf AS ({CF_SQL}), f AS ({FLEET_SQL}), t AS (SELECT sum(capacity_mw) AS total FROM f)
SELECT cf.ts, round(coalesce(sum(cf.cf * f.capacity_mw), 0) / max(t.total), 8) AS capacity_factor
FROM cf LEFT JOIN f USING (zone_id), t GROUP BY cf.ts""")
def fleet_capacity_factor(spark, d):
    result = w.fleet_capacity_factor(zone_factors(spark, d), fleet(spark, d), ["zone_id"])
    return result.withColumn("capacity_factor", F.round("capacity_factor", 8))


@workload(f"""
WITH cf AS ({CF_SQL}), f AS ({FLEET_SQL}), e AS (SELECT zone_id FROM cf GROUP BY zone_id HAVING count(cf) = 0)
SELECT zone_id, round(coalesce(f.capacity_mw, 0), 2) AS capacity_mw FROM e LEFT JOIN f USING (zone_id)""")
def unmodelled_capacity(spark, d):
    """Capacity in zones that never have a factor."""
    result = w.unmodelled_capacity(zone_factors(spark, d), fleet(spark, d), ["zone_id"])
    return result.withColumn("capacity_mw", F.round("capacity_mw", 2))


# --- zones -------------------------------------------------------------------------

_WEIGHTS_SQL = f"""
m AS ({MASK_SQL}),
cells AS (SELECT *, greatest(0, least(40, CAST(round_even((cell_lat - 50.0) / -0.25, 0) AS INTEGER))) AS la,
                 greatest(0, least(40, CAST(round_even((cell_lon - 5.0) / 0.25, 0) AS INTEGER))) AS lo FROM m),
u AS (SELECT c_custkey AS unit_id, c_acctbal AS capacity_mw, 38.0 + (c_custkey % 1000) * 0.013::DOUBLE AS lat, 4.0 + (c_acctbal + 1000) / 11000 * 12 AS lon FROM customer),
ui AS (SELECT *, greatest(0, least(40, CAST(round_even((lat - 50.0) / -0.25, 0) AS INTEGER))) AS la,
              greatest(0, least(40, CAST(round_even((lon - 5.0) / 0.25, 0) AS INTEGER))) AS lo FROM u),
hit AS (SELECT ui.unit_id, cells.zone_id, cells.coverage / sum(cells.coverage) OVER (PARTITION BY ui.unit_id) AS weight FROM ui JOIN cells USING (la, lo)),
cen AS (SELECT zone_id, sum(coverage * cell_lat) / sum(coverage) AS clat, sum(coverage * cell_lon) / sum(coverage) AS clon FROM m GROUP BY zone_id),
far AS (SELECT unit_id, arg_min(zone_id, (lat - clat) * (lat - clat) + (lon - clon) * (lon - clon)) AS zone_id, 1.0::DOUBLE AS weight
        FROM ui, cen WHERE unit_id NOT IN (SELECT unit_id FROM hit) GROUP BY unit_id),
wt AS (SELECT * FROM hit UNION ALL SELECT * FROM far)"""


@workload(f"WITH {_WEIGHTS_SQL} SELECT unit_id, zone_id, round(weight, 9) AS weight FROM wt")
def nearest_cell_weights(spark, d):
    """Units split over the zones of their nearest cell, else the nearest zone centre."""
    weights = fractional_zone_weights(located_units(spark, d), mask(spark, d), LAT, LON)
    return weights.select("unit_id", "zone_id", F.round("weight", 9).alias("weight"))


@workload(f"""WITH {_WEIGHTS_SQL}
SELECT zone_id, round(sum(u.capacity_mw * weight), 4) AS capacity_mw, count(*) AS parts FROM wt JOIN u USING (unit_id) GROUP BY zone_id""")
def presplit_zone_capacity(spark, d):
    """Capacity per zone after the fractional split."""
    split = presplit_capacity(located_units(spark, d), mask(spark, d), LAT, LON)
    return split.groupBy("zone_id").agg(F.round(F.sum("capacity_mw"), 4).alias("capacity_mw"), F.count("*").alias("parts"))


@workload(f"""WITH m AS ({MASK_SQL}) SELECT zone_id, round(sum(coverage * cell_lat) / sum(coverage), 8) AS centroid_lat,
  round(sum(coverage * cell_lon) / sum(coverage), 8) AS centroid_lon FROM m GROUP BY zone_id""")
def mask_centroids(spark, d):
    c = zone_centroids(mask(spark, d))
    return c.select("zone_id", F.round("centroid_lat", 8).alias("centroid_lat"), F.round("centroid_lon", 8).alias("centroid_lon"))


@workload(f"WITH m AS ({MASK_SQL}) SELECT zone_id, round(sum(coverage * cos(radians(cell_lat))), 8) AS area FROM m GROUP BY zone_id")
def mask_areas(spark, d):
    return zone_areas(mask(spark, d)).withColumn("area", F.round("area", 8))


_SHARES_SQL = f"""m AS ({MASK_SQL}),
a AS (SELECT zone_id, substr(zone_id, 1, 2) AS country, sum(coverage * cos(radians(cell_lat))) AS area FROM m
      WHERE zone_id IN (SELECT zone_id FROM cf WHERE cf IS NOT NULL) GROUP BY zone_id),
s AS (SELECT zone_id, country, area / sum(area) OVER (PARTITION BY country) AS weight FROM a)"""


@workload(f"WITH cf AS ({CF_SQL}), {_SHARES_SQL} SELECT zone_id, country, round(weight, 9) AS weight FROM s")
def zone_area_shares(spark, d):
    shares = country_area_shares(mask(spark, d), w.modelled(zone_factors(spark, d), ["zone_id"]))
    return shares.withColumn("weight", F.round("weight", 9))


@workload(f"""WITH cf AS ({CF_SQL}), {_SHARES_SQL}
SELECT cf.ts, s.country, round(coalesce(sum(cf.cf * s.weight), 0), 8) AS cf FROM cf JOIN s USING (zone_id) GROUP BY cf.ts, s.country""")
def country_area_weighted(spark, d):
    result = country_plan.zone_weighted_wind(zone_factors(spark, d), mask(spark, d))
    return result.withColumn("cf", F.round("cf", 8))


@workload(f"WITH cf AS ({CF_SQL}) SELECT ts, substr(zone_id, 1, 2) AS country, round(avg(cf), 8) AS cf FROM cf GROUP BY ALL")
def country_mean(spark, d):
    return w.plain_mean(zone_factors(spark, d)).withColumn("cf", F.round("cf", 8))


# --- technology blends ----------------------------------------------------------------

SOLAR_SQL = """SELECT date_trunc('month', o_orderdate) AS ts, n_name AS country, CAST(59 + CAST(least(substr(o_orderpriority, 1, 1), '4') AS INTEGER) AS VARCHAR) AS technology,
  CASE WHEN NOT (n_nationkey % 5 = 0 AND least(substr(o_orderpriority, 1, 1), '4') = '4') THEN avg(o_totalprice) / 600011 END AS cf
FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey
GROUP BY date_trunc('month', o_orderdate), n_name, n_nationkey, least(substr(o_orderpriority, 1, 1), '4')"""

MIX_SQL = """SELECT * FROM (VALUES ('*', '60', 0.28), ('*', '61', 0.39), ('*', '62', 0.31), ('*', '63', 0.02),
  ('NATION_3', '60', 0.5), ('NATION_3', '62', 0.5)) AS t(country, technology, weight)"""


def solar_factors(spark, d):
    digit = F.least(F.substring("o_orderpriority", 1, 1), F.lit("4"))
    customer = table(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("n_nationkey"))
    monthly = (
        table(spark, d, "orders")
        .join(customer, "o_custkey")
        .groupBy(month_of("o_orderdate").cast("timestamp_ntz").alias("ts"), "n_nationkey", digit.alias("digit"))
        .agg((F.avg("o_totalprice") / 600011).alias("_cf"))
    )
    cf = F.when(~((F.col("n_nationkey") % 5 == 0) & (F.col("digit") == "4")), F.col("_cf"))
    return monthly.join(table(spark, d, "nation"), "n_nationkey").select(
        "ts", F.col("n_name").alias("country"), (F.lit(59) + F.col("digit").cast("int")).cast("string").alias("technology"), cf.alias("cf")
    )


@workload(f"""
WITH cf AS ({SOLAR_SQL}), mix AS ({MIX_SQL}),
p AS (SELECT DISTINCT country, technology FROM cf WHERE cf IS NOT NULL),
c AS (SELECT p.country, p.technology, mix.weight FROM p JOIN mix ON mix.technology = p.technology
      AND mix.country = CASE WHEN p.country IN (SELECT country FROM mix) THEN p.country ELSE '*' END),
s AS (SELECT country, technology, weight / sum(weight) OVER (PARTITION BY country) AS weight, count(*) OVER (PARTITION BY country) AS n FROM c)
SELECT cf.ts, cf.country, CASE WHEN count(cf.cf) = max(s.n) THEN round(sum(cf.cf * s.weight), 8) END AS cf
FROM cf JOIN s USING (country, technology) GROUP BY cf.ts, cf.country""")
def technology_blend(spark, d):
    """Four technologies per country; absent ones are left out, a missing month makes the blend NULL."""
    weights = country_plan.default_solar_weights(spark, {"NATION_3": {"60": 0.5, "62": 0.5}})
    return w.blend_technologies(solar_factors(spark, d), weights).withColumn("cf", F.round("cf", 8))


# Hourly events: four event types are the solar technologies, users fall into ten zones of two countries.
EVENT_CF_SQL = """SELECT date_trunc('hour', ts) AS ts, event_type, CASE WHEN user_id % 10 < 6 THEN 'DE' ELSE 'FR' END AS country,
  CASE WHEN user_id % 10 < 6 THEN 'DE' ELSE 'FR' END || lpad(CAST(user_id % 10 AS VARCHAR), 2, '0') AS zone_id, avg(value) / 503 AS cf
FROM events GROUP BY ALL"""

PRODUCT_SQL = f"""
WITH e AS ({EVENT_CF_SQL}),
m AS (SELECT CASE WHEN s_suppkey % 10 < 6 THEN 'DE' ELSE 'FR' END || lpad(CAST(s_suppkey % 10 AS VARCHAR), 2, '0') AS zone_id,
             40 + (s_suppkey % 40) * 0.25 AS cell_lat, s_suppkey AS cell_lon, 0.5 AS coverage FROM supplier),
sol AS (SELECT ts - INTERVAL 1 HOUR AS ts, country, technology, avg(cf) AS cf FROM (
   SELECT *, CASE event_type WHEN 'click' THEN '60' WHEN 'view' THEN '61' WHEN 'purchase' THEN '62' WHEN 'signup' THEN '63' END AS technology FROM e)
   WHERE technology IS NOT NULL GROUP BY ALL),
mix AS (SELECT * FROM (VALUES ('60', 0.28), ('61', 0.39), ('62', 0.31), ('63', 0.02)) AS t(technology, weight)),
solc AS (SELECT ts, country, CASE WHEN count(*) = 4 THEN sum(cf * weight) END AS cf FROM sol JOIN mix USING (technology) GROUP BY ts, country),
ons AS (SELECT ts, zone_id, cf FROM e WHERE event_type = 'error'),
ar AS (SELECT zone_id, sum(coverage * cos(radians(cell_lat))) AS area FROM m WHERE zone_id IN (SELECT zone_id FROM ons) GROUP BY zone_id),
sh AS (SELECT zone_id, substr(zone_id, 1, 2) AS country, area / sum(area) OVER (PARTITION BY substr(zone_id, 1, 2)) AS weight FROM ar),
onc AS (SELECT ts, country, coalesce(sum(cf * weight), 0) AS cf FROM ons JOIN sh USING (zone_id) GROUP BY ts, country),
offc AS (SELECT ts, country, avg(cf) AS cf FROM e WHERE event_type = 'view' GROUP BY ts, country),
allp AS (SELECT ts, 'solar' AS technology, country, cf FROM solc UNION ALL SELECT ts, 'wind_onshore', country, cf FROM onc
         UNION ALL SELECT ts, 'wind_offshore', country, cf FROM offc),
p AS (SELECT * FROM allp WHERE ts IN (SELECT ts FROM allp GROUP BY ts HAVING count(DISTINCT technology) = 3))"""


def _event_inputs(spark, d):
    """Solar, onshore and offshore factors plus a zone mask, all from hourly events."""
    country = F.when(F.col("user_id") % 10 < 6, "DE").otherwise("FR")
    e = (
        table(spark, d, "events")
        .withColumn("country", country)
        .withColumn("zone_id", F.concat("country", F.lpad((F.col("user_id") % 10).cast("string"), 2, "0")))
        .groupBy(floor_to("ts", "hour").alias("ts"), "event_type", "country", "zone_id")
        .agg((F.avg("value") / 503).alias("cf"))
    )
    codes = {"click": "60", "view": "61", "purchase": "62", "signup": "63"}
    technology = F.lit(None).cast("string")
    for name, code in codes.items():
        technology = F.when(F.col("event_type") == name, code).otherwise(technology)
    solar = (
        e.filter(F.col("event_type").isin(*codes))
        .groupBy(shift_hours("ts", -1).alias("ts"), "country", technology.alias("technology"))
        .agg(F.avg("cf").alias("cf"))
    )
    onshore = e.filter(F.col("event_type") == "error").select("ts", "zone_id", "cf")
    offshore = e.filter(F.col("event_type") == "view").select("ts", "zone_id", "cf")
    key = F.col("s_suppkey") % 10
    zone_mask = table(spark, d, "supplier").select(
        F.concat(F.when(key < 6, "DE").otherwise("FR"), F.lpad(key.cast("string"), 2, "0")).alias("zone_id"),
        (F.lit(40.0) + (F.col("s_suppkey") % 40) * 0.25).alias("cell_lat"),
        F.col("s_suppkey").alias("cell_lon"),
        F.lit(0.5).alias("coverage"),
    )
    return solar, onshore, offshore, zone_mask


def _event_product(spark, d):
    return country_plan.country_product(*_event_inputs(spark, d), country_plan.default_solar_weights(spark))


@workload(PRODUCT_SQL + " SELECT ts, technology, country, round(cf, 8) AS cf FROM p")
def country_product(spark, d):
    """Solar blend, area-weighted onshore and plain-mean offshore, on hours all three cover."""
    return _event_product(spark, d).withColumn("cf", F.round("cf", 8))


@workload(PRODUCT_SQL + """ SELECT ts, round(max(cf) FILTER (technology = 'wind_onshore'), 8) AS wind_onshore,
  round(max(cf) FILTER (technology = 'wind_offshore'), 8) AS wind_offshore, round(max(cf) FILTER (technology = 'solar'), 8) AS solar
FROM p WHERE country = 'DE' GROUP BY ts""")
def country_slice(spark, d):
    wide = country_plan.country_slice(_event_product(spark, d), "DE")
    return wide.select("ts", *[F.round(c, 8).alias(c) for c in ("wind_onshore", "wind_offshore", "solar")])


@workload(PRODUCT_SQL + """,
sv AS (SELECT DISTINCT zone_id FROM e WHERE event_type = 'view'),
av AS (SELECT m.zone_id, sum(coverage * cos(radians(cell_lat))) AS area FROM m JOIN sv USING (zone_id) WHERE m.zone_id LIKE 'DE%' GROUP BY 1),
w AS (SELECT e.ts, sum(e.cf * av.area / (SELECT sum(area) FROM av)) AS cf FROM e JOIN av USING (zone_id) WHERE e.event_type = 'view' GROUP BY e.ts)
SELECT s.ts, round(max(s.cf) FILTER (technology = '60'), 8) AS solar_60, round(max(s.cf) FILTER (technology = '61'), 8) AS solar_61,
  round(max(s.cf) FILTER (technology = '62'), 8) AS solar_62, round(max(s.cf) FILTER (technology = '63'), 8) AS solar_63,
  round(max(o.cf), 8) AS wind_onshore, round(max(w.cf), 8) AS wind_offshore
FROM sol s JOIN onc o ON o.ts = s.ts AND o.country = 'DE' JOIN w ON w.ts = s.ts WHERE s.country = 'DE' GROUP BY s.ts""")
def technology_base(spark, d):
    """Six series of one country, unblended, on hours every part covers."""
    solar, onshore, offshore, zone_mask = _event_inputs(spark, d)
    base = country_plan.technology_base(solar, onshore, offshore, zone_mask, zone_mask)
    return base.select("ts", *[F.round(c, 8).alias(c) for c in base.columns[1:]])


_HOURLY_SQL = "SELECT date_trunc('hour', ts) AS ts, event_type, round(sum(value), 2) AS value FROM events GROUP BY 1, 2"


def _hourly_types(spark, d):
    return table(spark, d, "events").groupBy(floor_to("ts", "hour").alias("ts"), "event_type").agg(F.round(F.sum("value"), 2).alias("value"))


@workload(f"""WITH h AS ({_HOURLY_SQL} HAVING event_type IN ('click', 'view', 'error'))
SELECT a.ts, a.value AS click, b.value AS view, c.value AS error FROM h a JOIN h b USING (ts) JOIN h c USING (ts)
WHERE a.event_type = 'click' AND b.event_type = 'view' AND c.event_type = 'error'""")
def inner_align_series(spark, d):
    """Three series side by side on the hours they share."""
    names = ["click", "view", "error"]
    return w.pivot_series(w.in_all_series(_hourly_types(spark, d), "event_type", names), "event_type", names, "value")


@workload(f"""WITH h AS ({_HOURLY_SQL})
SELECT ts, max(value) FILTER (event_type = 'click') AS click, max(value) FILTER (event_type = 'view') AS view, max(value) FILTER (event_type = 'error') AS error,
  max(value) FILTER (event_type = 'purchase') AS purchase, max(value) FILTER (event_type = 'signup') AS signup FROM h GROUP BY ts""")
def outer_align_series(spark, d):
    return w.pivot_series(_hourly_types(spark, d), "event_type", ["click", "view", "error", "purchase", "signup"], "value")


# --- fleets ----------------------------------------------------------------------------

_FLEET_UNITS_SQL = f"""
u AS (SELECT u.*, substr(o.o_orderpriority, 1, 1) AS p FROM ({UNITS_SQL}) u JOIN orders o ON CAST(o.o_orderkey AS VARCHAR) = u.unit_id),
f AS (SELECT *, CASE WHEN p < '5' THEN 'solar' WHEN technology = 'F' THEN 'wind_offshore' ELSE 'wind_onshore' END AS family, CAST(59 + CAST(p AS INTEGER) AS VARCHAR) AS tech FROM u),
act AS (SELECT * FROM f WHERE start <= DATE '1999-06-30' AND (stop IS NULL OR stop > DATE '1999-06-30')),
snap AS (SELECT
  sum(capacity_mw) FILTER (family = 'solar' AND tech = '60') / sum(capacity_mw) FILTER (family = 'solar') AS weight_60,
  sum(capacity_mw) FILTER (family = 'solar' AND tech = '61') / sum(capacity_mw) FILTER (family = 'solar') AS weight_61,
  sum(capacity_mw) FILTER (family = 'solar' AND tech = '62') / sum(capacity_mw) FILTER (family = 'solar') AS weight_62,
  sum(capacity_mw) FILTER (family = 'solar' AND tech = '63') / sum(capacity_mw) FILTER (family = 'solar') AS weight_63,
  sum(capacity_mw) FILTER (family = 'solar') AS solar_mw, sum(capacity_mw) FILTER (family = 'wind_onshore') AS wind_onshore_mw,
  sum(capacity_mw) FILTER (family = 'wind_offshore') AS wind_offshore_mw, DATE '1999-06-30' AS as_of FROM act)"""


def _fleet_snapshot(spark, d):
    priority = table(spark, d, "orders").select(
        F.col("o_orderkey").cast("string").alias("unit_id"), F.substring("o_orderpriority", 1, 1).alias("p")
    )
    units = order_units(spark, d).join(priority, "unit_id")
    solar = units.filter(F.col("p") < "5").withColumn("technology", (F.lit(59) + F.col("p").cast("int")).cast("string"))
    wind = units.filter(F.col("p") >= "5").withColumn("siting", F.when(F.col("technology") == "F", "offshore").otherwise("onshore"))
    return fleet_plan.fleet_snapshot(solar, wind, F.lit("1999-06-30").cast("date"))


@workload(f"""WITH {_FLEET_UNITS_SQL} SELECT round(weight_60, 9) AS weight_60, round(weight_61, 9) AS weight_61, round(weight_62, 9) AS weight_62,
  round(weight_63, 9) AS weight_63, round(solar_mw, 2) AS solar_mw, round(wind_onshore_mw, 2) AS wind_onshore_mw,
  round(wind_offshore_mw, 2) AS wind_offshore_mw, as_of FROM snap""")
def fleet_mix_snapshot(spark, d):
    """One row: technology mix and totals of the units active at a date."""
    s = _fleet_snapshot(spark, d)
    return s.select(
        *[F.round(c, 9).alias(c) for c in s.columns if c.startswith("weight_")],
        *[F.round(c, 2).alias(c) for c in s.columns if c.endswith("_mw")],
        "as_of",
    )


_BASE_SQL = """base AS (SELECT date_trunc('month', o_orderdate) AS ts,
  avg(o_totalprice) FILTER (o_orderpriority LIKE '1%') / 600011 AS solar_60, avg(o_totalprice) FILTER (o_orderpriority LIKE '2%') / 600011 AS solar_61,
  avg(o_totalprice) FILTER (o_orderpriority LIKE '3%') / 600011 AS solar_62, avg(o_totalprice) FILTER (o_orderpriority LIKE '4%') / 600011 AS solar_63,
  avg(o_totalprice) FILTER (o_orderpriority LIKE '5%' AND o_orderstatus <> 'F') / 600011 AS wind_onshore,
  avg(o_totalprice) FILTER (o_orderpriority LIKE '5%' AND o_orderstatus = 'F') / 600011 AS wind_offshore FROM orders GROUP BY 1)"""


@workload(f"""WITH {_FLEET_UNITS_SQL}, {_BASE_SQL},
b AS (SELECT ts, solar_60 * weight_60 + solar_61 * weight_61 + solar_62 * weight_62 + solar_63 * weight_63 AS s, wind_onshore AS n, wind_offshore AS f, snap.* FROM base, snap)
SELECT ts, round(s, 8) AS capacity_factor_solar, round(n, 8) AS capacity_factor_wind_onshore, round(f, 8) AS capacity_factor_wind_offshore,
  round(s * solar_mw, 2) AS power_mw_solar, round(n * wind_onshore_mw, 2) AS power_mw_wind_onshore, round(f * wind_offshore_mw, 2) AS power_mw_wind_offshore,
  round(s * solar_mw + n * wind_onshore_mw + f * wind_offshore_mw, 2) AS power_mw_total FROM b""")
def fleet_blend(spark, d):
    """Six technology series x one fleet snapshot."""
    price = F.col("o_totalprice")
    first = F.substring("o_orderpriority", 1, 1)
    offshore = F.col("o_orderstatus") == "F"
    conditions = {f"solar_{59 + i}": first == str(i) for i in range(1, 5)}
    conditions |= {"wind_onshore": (first == "5") & ~offshore, "wind_offshore": (first == "5") & offshore}
    base = (
        table(spark, d, "orders")
        .groupBy(month_of("o_orderdate").cast("timestamp_ntz").alias("ts"))
        .agg(*[(F.avg(F.when(c, price)) / 600011).alias(n) for n, c in conditions.items()])
    )
    blend = fleet_plan.fleet_weighted(base, _fleet_snapshot(spark, d))
    return blend.select("ts", *[F.round(c, 8 if c.startswith("capacity") else 2).alias(c) for c in blend.columns[1:]])


_ZONE_UNITS_SQL = f"""zu AS (SELECT u.*, z.zone_id FROM ({UNITS_SQL}) u JOIN ({ZONES_SQL}) z ON z.n_name = u.region)"""


def _potential_sql(status: str) -> str:
    return f"""
x_{status} AS (SELECT zone_id, date_trunc('month', start) AS m, capacity_mw AS c FROM zu WHERE technology = '{status}'
      UNION ALL SELECT zone_id, date_trunc('month', stop), -capacity_mw FROM zu WHERE stop IS NOT NULL AND technology = '{status}'),
g_{status} AS (SELECT zone_id, CAST(unnest(generate_series(TIMESTAMP '1995-01-01', TIMESTAMP '2001-08-01', INTERVAL 1 MONTH)) AS DATE) AS m FROM (SELECT DISTINCT zone_id FROM zu)),
t_{status} AS (SELECT zone_id, m, sum(c) AS c FROM x_{status} GROUP BY zone_id, m),
p_{status} AS (SELECT g.zone_id, g.m, sum(coalesce(t.c, 0)) OVER (PARTITION BY g.zone_id ORDER BY g.m) AS c FROM g_{status} g LEFT JOIN t_{status} t ON t.zone_id = g.zone_id AND t.m = g.m),
r_{status} AS (SELECT cf.ts, coalesce(sum(cf.cf * p.c), 0) AS v FROM cf LEFT JOIN p_{status} p ON p.zone_id = cf.zone_id AND p.m = date_trunc('month', cf.ts) AND p.m >= DATE '1996-01-01' GROUP BY cf.ts)"""


@workload(f"""WITH cf AS ({CF_SQL}), {_ZONE_UNITS_SQL}, {_potential_sql('F')}, {_potential_sql('P')}, {_potential_sql('O')}
SELECT ts, round(r_F.v, 2) AS potential_closed_mw, round(r_P.v, 2) AS potential_partial_mw, round(r_O.v, 2) AS potential_open_mw
FROM r_F FULL JOIN r_P USING (ts) FULL JOIN r_O USING (ts)""")
def historic_potential(spark, d):
    """Units -> monthly panels -> potential, three families aligned on every time step."""
    families, first, last, export = _families(spark, d)
    panel = fleet_plan.historic_potential(families, first, last, export)
    return panel.select("ts", *[F.round(c, 2).alias(c) for c in panel.columns[1:]])


def _families(spark, d):
    names = table(spark, d, "nation").join(zones(spark, d), "n_nationkey").select(F.col("n_name").alias("region"), "zone_id")
    units = order_units(spark, d).join(names, "region")
    cf = zone_factors(spark, d)
    families = [
        fleet_plan.Family("closed", units, cf, ["zone_id"], F.col("technology") == "F"),
        fleet_plan.Family("partial", units, cf, ["zone_id"], F.col("technology") == "P"),
        fleet_plan.Family("open", units, cf, ["zone_id"], F.col("technology") == "O"),
    ]
    first, last, export = (F.lit(x).cast("date") for x in ("1995-01-01", "2001-08-01", "1996-01-01"))
    return families, first, last, export


@workload(f"""WITH cf AS ({CF_SQL}), {_ZONE_UNITS_SQL},
n AS (SELECT zone_id, technology, sum(capacity_mw) AS c FROM zu WHERE start <= DATE '1999-06-30' AND (stop IS NULL OR stop > DATE '1999-06-30') GROUP BY ALL),
tot AS (SELECT technology, sum(c) AS total FROM n GROUP BY 1)
SELECT cf.ts, round(coalesce(sum(cf.cf * f.c), 0) / (SELECT total FROM tot WHERE technology = 'F'), 8) AS capacity_factor_closed,
  round(coalesce(sum(cf.cf * p.c), 0) / (SELECT total FROM tot WHERE technology = 'P'), 8) AS capacity_factor_partial,
  round(coalesce(sum(cf.cf * o.c), 0) / (SELECT total FROM tot WHERE technology = 'O'), 8) AS capacity_factor_open
FROM cf LEFT JOIN n f ON f.zone_id = cf.zone_id AND f.technology = 'F' LEFT JOIN n p ON p.zone_id = cf.zone_id AND p.technology = 'P'
  LEFT JOIN n o ON o.zone_id = cf.zone_id AND o.technology = 'O' GROUP BY cf.ts""")
def current_fleet_factors(spark, d):
    """The fleet of one date under all past time steps."""
    families, *_ = _families(spark, d)
    result = fleet_plan.current_fleet_factors(families, F.lit("1999-06-30").cast("date"))
    return result.select("ts", *[F.round(c, 8).alias(c) for c in result.columns[1:]])


# --- means, shares, prices ------------------------------------------------------------------

@workload("""SELECT date_trunc('hour', ts) AS ts, round(avg(sqrt(value * value + k * k)), 6) AS value FROM (
  SELECT ts, value, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k FROM events) GROUP BY 1""")
def hourly_mean_speed(spark, d):
    """Speed per cell first, mean second."""
    k = F.get_json_object("props", "$.k").cast("double")
    grid = table(spark, d, "events").select(floor_to("ts", "hour").alias("ts"), "value", k.alias("k"))
    return spatial_mean(grid, values.wind_speed("value", "k"), "ts").withColumn("value", F.round("value", 6))


@workload("""WITH e AS (SELECT date_trunc('hour', ts) AS ts, value - 273.15 AS v, cos(radians(user_id % 90)) AS w FROM events)
SELECT ts, round(sum(v * w) / sum(w), 6) AS value FROM e GROUP BY ts""")
def hourly_weighted_mean(spark, d):
    """Cell-weighted mean after a unit conversion."""
    grid = table(spark, d, "events").select(floor_to("ts", "hour").alias("ts"), "value", (F.col("user_id") % 90).alias("lat"))
    mean = spatial_mean(grid, values.kelvin_to_celsius("value"), "ts", values.area_weight("lat"))
    return mean.withColumn("value", F.round("value", 6))


@workload("""WITH s AS (SELECT o_orderstatus, o_orderpriority, sum(o_totalprice) AS value FROM orders GROUP BY 1, 2)
SELECT o_orderstatus, o_orderpriority, round(value, 2) AS value, round(value / sum(value) OVER (PARTITION BY o_orderstatus), 9) AS share FROM s""")
def share_within_group(spark, d):
    rows = table(spark, d, "orders").withColumnRenamed("o_totalprice", "value")
    s = w.share_of_total(rows, ["o_orderstatus", "o_orderpriority"], "value", within=["o_orderstatus"])
    return s.select("o_orderstatus", "o_orderpriority", F.round("value", 2).alias("value"), F.round("share", 9).alias("share"))


@workload("""WITH m AS (SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice - 50000 AS balance, l_tax * 100 AS m1, l_discount * 100 AS m2,
  CASE WHEN l_quantity % 3 <> 0 THEN l_quantity END AS m3 FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, round(CASE WHEN balance > 0 THEN greatest(m1, m2, m3) WHEN balance < 0 THEN least(m1, m2, m3) END, 6) AS price FROM m""")
def imbalance_price(spark, d):
    """Highest component when short, lowest when long; an inactive component is out."""
    inactive = values.zero_to_null(F.when(F.col("l_quantity") % 3 == 0, F.lit(0.0)).otherwise(F.col("l_quantity")))
    price = w.imbalance_price(F.col("l_extendedprice") - 50000, F.col("l_tax") * 100, F.col("l_discount") * 100, inactive)
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.round(price, 6).alias("price"))


@workload(f"""WITH mc AS ({MONTHLY_SQL}) SELECT CAST(date_trunc('year', month) AS DATE) AS year, round(coalesce(avg(capacity_mw) FILTER (zone_id LIKE 'AF%'), 0), 6) AS "AF",
  round(coalesce(avg(capacity_mw) FILTER (zone_id LIKE 'EU%'), 0), 6) AS "EU", round(coalesce(avg(capacity_mw) FILTER (zone_id LIKE 'AM%'), 0), 6) AS "AM",
  round(coalesce(avg(capacity_mw) FILTER (zone_id LIKE 'AS%'), 0), 6) AS "AS", round(coalesce(avg(capacity_mw) FILTER (zone_id LIKE 'MI%'), 0), 6) AS "MI",
  round(coalesce(avg(capacity_mw) FILTER (zone_id LIKE 'XX%'), 0), 6) AS "XX" FROM mc GROUP BY 1""")
def pivot_mean_fill(spark, d):
    """Duplicates averaged, absent cells 0."""
    rows = monthly_capacity(spark, d).select(F.trunc("month", "year").alias("year"), F.substring("zone_id", 1, 2).alias("c"), "capacity_mw")
    names = ["AF", "AM", "AS", "EU", "MI", "XX"]  # no zone begins with XX: its cells are filled
    wide = pivot_mean(rows, ["year"], "c", names, "capacity_mw")
    return wide.select("year", *[F.round(c, 6).alias(c) for c in names])
