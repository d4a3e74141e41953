"""Registry classification, joins on cleaned keys, reshaping, local time."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import classify, values
from ..functions.timeutil import wall_clock_to_utc
from ..operators.hulls import footprint_hulls
from ..operators.reshape import pivot_strict, unpivot_dropna
from ..plans import registry as plan
from ..sources.registry import crosswalk
from ..sources.tenders import delivery_block_hours
from .registry import table, workload


@workload("""
SELECT c_custkey, CASE WHEN f = 'Volleinspeisung' THEN 'full_feed_in' WHEN f LIKE 'Teileinspeisung%' AND s THEN 'self_consumption_with_storage'
  WHEN f LIKE 'Teileinspeisung%' THEN 'self_consumption_no_storage' ELSE 'unknown' END AS category
FROM (SELECT c_custkey, CASE c_mktsegment WHEN 'HOUSEHOLD' THEN 'Volleinspeisung' WHEN 'MACHINERY' THEN NULL WHEN 'BUILDING' THEN 'Sonstige'
        ELSE 'Teileinspeisung (' || c_mktsegment || ')' END AS f,
      EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 400000) AS s FROM customer)""")
def semi_flag_category(spark, d):
    """Behind-the-meter class from a feed-in text and a semi-join flag."""
    segment = F.col("c_mktsegment")
    feed_in = (
        F.when(segment == "HOUSEHOLD", "Volleinspeisung")
        .when(segment == "MACHINERY", F.lit(None).cast("string"))
        .when(segment == "BUILDING", "Sonstige")
        .otherwise(F.concat(F.lit("Teileinspeisung ("), segment, F.lit(")")))
    )
    storage = table(spark, d, "orders").filter("o_totalprice > 400000").select(F.col("o_custkey").alias("location_id"))
    units = table(spark, d, "customer").select("c_custkey", F.col("c_custkey").alias("location_id"), feed_in.alias("feed_in_type"))
    return plan.flag_storage(units, storage, "c_custkey").select(
        "c_custkey", classify.feed_in_category("feed_in_type", "has_storage").alias("category")
    )


@workload("""
SELECT c_custkey, lpad(CAST(c_custkey AS VARCHAR), 8, '0') AS municipality_key, 'N' || CAST(s_nationkey AS VARCHAR) AS nuts3_code
FROM customer LEFT JOIN supplier ON s_suppkey = c_custkey""")
def key_normalise_join(spark, d):
    """Keys like "DE 12/a" and bare numbers meet on eight padded digits."""
    units = table(spark, d, "customer").select(
        "c_custkey", F.concat(F.lit("DE "), F.col("c_custkey").cast("string"), F.lit("/a")).alias("municipality_key")
    )
    lau = table(spark, d, "supplier").select(
        F.col("s_suppkey").cast("string").alias("LAU CODE"), F.concat(F.lit("N"), F.col("s_nationkey").cast("string")).alias("NUTS3")
    )
    return plan.with_nuts3(units, crosswalk(lau)).select("c_custkey", "municipality_key", "nuts3_code")


_ENTITY = """CASE p_size % 8 WHEN 0 THEN 'OWP ' || p_name WHEN 1 THEN 'UW Büttel' WHEN 2 THEN 'Anlage PV ' || p_name WHEN 3 THEN 'Photovoltaik ' || p_name
  WHEN 4 THEN 'WP ' || p_name WHEN 5 THEN 'windpark' || p_name WHEN 6 THEN 'PVX ' || p_name END"""


@workload(f"""
WITH e AS (SELECT p_partkey, upper({_ENTITY}) AS n FROM part)
SELECT p_partkey, CASE WHEN n LIKE '%OWP%' OR n LIKE '%OFFSHORE%' OR n IN ('UW BÜTTEL', 'UW DIELE', 'UW DÖRPEN-WEST', 'UW EMDEN-OST') THEN 'offshore_wind'
  WHEN n LIKE 'PV %' OR ' ' || n || ' ' LIKE '% PV %' OR n LIKE '%PHOTOVOLTA%' THEN 'pv'
  WHEN n LIKE 'WP %' OR ' ' || n || ' ' LIKE '% WP %' OR n LIKE '%WINDPARK%' THEN 'onshore_wind_named' ELSE 'ambiguous' END AS tech FROM e""")
def name_classifier(spark, d):
    """Technology by entity name; a NULL name is ambiguous."""
    name = F.col("p_name")
    kind = F.col("p_size") % 8
    entity = (
        F.when(kind == 0, F.concat(F.lit("OWP "), name))
        .when(kind == 1, F.lit("UW Büttel"))
        .when(kind == 2, F.concat(F.lit("Anlage PV "), name))
        .when(kind == 3, F.concat(F.lit("Photovoltaik "), name))
        .when(kind == 4, F.concat(F.lit("WP "), name))
        .when(kind == 5, F.concat(F.lit("windpark"), name))
        .when(kind == 6, F.concat(F.lit("PVX "), name))
    )
    return table(spark, d, "part").select("p_partkey", classify.entity_technology(entity).alias("tech"))


# --- registry chains ----------------------------------------------------------------

_SOLAR_SQL = """
raw AS (SELECT o_orderkey AS id, o_custkey, o_totalprice / 1000 AS kw, o_orderdate, o_orderstatus, o_orderpriority,
  CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'Haushalt' WHEN '2' THEN 'Industrie' WHEN '3' THEN NULL ELSE 'Handel' END AS sector,
  o_totalprice > 300000 AS ground FROM orders WHERE o_orderpriority <> '5-LOW'),
det AS (SELECT l_orderkey AS id, max(l_quantity) > 40 AS tracked FROM lineitem GROUP BY 1),
lau AS (SELECT c_custkey, 'DE' || lpad(CAST(c_nationkey AS VARCHAR), 3, '0') AS nuts3 FROM customer WHERE c_mktsegment <> 'FURNITURE')"""


def _solar_registry(spark, d):
    """Registry-shaped tables: orders are solar units, order lines their technical detail, customers the municipalities."""
    first = F.substring("o_orderpriority", 1, 1)
    sector = F.when(first == "1", "Haushalt").when(first == "2", "Industrie").when(first == "3", F.lit(None).cast("string")).otherwise("Handel")
    units = table(spark, d, "orders").select(
        F.col("o_orderkey").cast("string").alias("unit_id"),
        F.concat(F.lit("DE "), F.col("o_custkey").cast("string")).alias("municipality_key"),
        (F.col("o_totalprice") / 1000).alias("net_capacity_kw"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.date_format("o_orderdate", "yyyy-MM-dd")).otherwise("unknown").alias("commissioning_date"),
        F.lit(None).cast("string").alias("final_shutdown_date"),
        sector.alias("usage_sector"),
        F.when(F.col("o_totalprice") > 300000, classify.GROUND_MOUNTED).otherwise("Hausdach").alias("installation_type"),
    )
    detail = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").cast("string").alias("unit_id")).agg(
        F.when(F.max("l_quantity") > 40, "nachgeführt").otherwise("Süd").alias("main_orientation"),
        F.lit(None).cast("string").alias("main_orientation_tilt_bucket"),
    )
    lau = crosswalk(
        table(spark, d, "customer").filter("c_mktsegment <> 'FURNITURE'").select(
            F.col("c_custkey").cast("string").alias("LAU CODE"),
            F.concat(F.lit("DE"), F.lpad(F.col("c_nationkey").cast("string"), 3, "0")).alias("NUTS3"),
        )
    )
    return units, detail, lau


@workload(f"""WITH {_SOLAR_SQL}
SELECT CAST(raw.id AS VARCHAR) AS unit_id, round(kw / 1000, 8) AS capacity_mw, substr(nuts3, 1, 4) AS nuts2_region,
  CASE WHEN ground AND coalesce(tracked, false) THEN '63' WHEN ground THEN '62' WHEN sector IS NULL OR sector = 'Haushalt' THEN '61' ELSE '60' END AS technology,
  CAST(o_orderdate AS DATE) AS commissioning_date
FROM raw JOIN lau ON lau.c_custkey = raw.o_custkey LEFT JOIN det USING (id)""")
def solar_unit_preparation(spark, d):
    """Units x technical detail x crosswalk -> technology and NUTS2 region."""
    prepared = plan.solar_units(*_solar_registry(spark, d))
    return prepared.select("unit_id", F.round("capacity_mw", 8).alias("capacity_mw"), "nuts2_region", "technology", "commissioning_date")


@workload("""
SELECT CAST(c_custkey AS VARCHAR) AS unit_id, CASE c_mktsegment WHEN 'HOUSEHOLD' THEN 'offshore' ELSE 'onshore' END AS siting,
  round(c_acctbal / 1000, 8) AS capacity_mw FROM customer
WHERE c_mktsegment IN ('HOUSEHOLD', 'MACHINERY', 'BUILDING') AND c_acctbal > 0 AND c_nationkey <> 3""")
def wind_unit_preparation(spark, d):
    """Only dated units with capacity, coordinates and a known siting stay."""
    segment = F.col("c_mktsegment")
    label = F.when(segment == "HOUSEHOLD", classify.OFFSHORE).when(segment.isin("MACHINERY", "BUILDING"), classify.ONSHORE).otherwise("Windkraft")
    units = table(spark, d, "customer").select(
        F.col("c_custkey").cast("string").alias("unit_id"),
        F.col("c_acctbal").alias("net_capacity_kw"),
        F.lit("2010-05-01").alias("commissioning_date"),
        F.lit(None).cast("string").alias("final_shutdown_date"),
        F.when(F.col("c_nationkey") != 3, F.lit(8.5)).alias("longitude"),
        F.lit(53.5).alias("latitude"),
        label.alias("wind_onshore_or_offshore"),
    )
    return plan.wind_units(units).select("unit_id", "siting", F.round("capacity_mw", 8).alias("capacity_mw"))


@workload(f"""WITH {_SOLAR_SQL},
w AS (SELECT c_custkey AS id, c_acctbal / 1000 AS mw, CASE WHEN c_custkey % 4 = 0 THEN 'DEZZ-NORDSEE' WHEN c_custkey % 4 = 1 THEN 'DEZZ-OSTSEE' ELSE nuts3 END AS region
      FROM customer LEFT JOIN lau USING (c_custkey) WHERE c_acctbal > 0)
SELECT 'W' || CAST(id AS VARCHAR) AS unit_id, 'wind' AS technology, region AS region_code, round(mw, 8) AS capacity_mw, NULL::VARCHAR AS pv_category, NULL::VARCHAR AS usage_sector FROM w WHERE region IS NOT NULL
UNION ALL
SELECT CAST(raw.id AS VARCHAR), 'solar', nuts3, round(kw / 1000, 8),
  CASE WHEN o_orderstatus = 'F' THEN 'full_feed_in' WHEN o_orderstatus = 'P' THEN 'unknown'
       WHEN o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > 5000) THEN 'self_consumption_with_storage' ELSE 'self_consumption_no_storage' END, sector
FROM raw JOIN lau ON lau.c_custkey = raw.o_custkey""")
def capacity_events(spark, d):
    """Wind and solar units in one located table, sea regions and storage flags included."""
    solar, _, lau = _solar_registry(spark, d)
    status = table(spark, d, "orders").select(
        F.col("o_orderkey").cast("string").alias("unit_id"),
        F.col("o_custkey").cast("string").alias("location_id"),
        F.when(F.col("o_orderstatus") == "F", "Volleinspeisung").when(F.col("o_orderstatus") == "O", "Teileinspeisung").alias("feed_in_type"),
    )
    storage = table(spark, d, "customer").filter("c_acctbal > 5000").select(F.col("c_custkey").cast("string").alias("location_id"))
    wind = table(spark, d, "customer").select(
        F.concat(F.lit("W"), F.col("c_custkey").cast("string")).alias("unit_id"),
        F.col("c_custkey").cast("string").alias("municipality_key"),
        F.col("c_acctbal").alias("net_capacity_kw"),
        F.lit("2010-05-01").alias("commissioning_date"),
        F.lit(None).cast("string").alias("final_shutdown_date"),
        F.when(F.col("c_custkey") % 4 == 0, "Nordsee").when(F.col("c_custkey") % 4 == 1, "Ostsee").alias("sea_location"),
    )
    events = plan.capacity_events(wind, solar.join(status, "unit_id"), lau, storage)
    return events.select("unit_id", "technology", "region_code", F.round("capacity_mw", 8).alias("capacity_mw"), "pv_category", "usage_sector")


# --- reshaping ------------------------------------------------------------------------

@workload("""
WITH w AS (SELECT l_shipdate AS day, sum(l_quantity) FILTER (l_returnflag = 'A') AS a, sum(l_quantity) FILTER (l_returnflag = 'N') AS n,
  sum(l_quantity) FILTER (l_returnflag = 'R') AS r FROM lineitem GROUP BY 1)
SELECT day, source, gwh FROM w UNPIVOT (gwh FOR source IN (a, n, r))""")
def unpivot_dropna_sources(spark, d):
    """Wide day table -> one row per existing value."""
    cells = {c.lower(): F.sum(F.when(F.col("l_returnflag") == c, F.col("l_quantity"))).alias(c.lower()) for c in "ANR"}
    wide = table(spark, d, "lineitem").groupBy(F.col("l_shipdate").alias("day")).agg(*cells.values())
    return unpivot_dropna(wide, ["day"], list(cells), "source", "gwh")


_BLOCK_PRICE = """SELECT CAST(o_orderdate AS DATE) AS delivery_date, CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'negpos_00_04' WHEN '2' THEN 'negpos_04_08'
  WHEN '3' THEN 'negpos_08_12' WHEN '4' THEN 'negpos_16_20' ELSE 'negpos_20_24' END AS block, max(o_totalprice) AS price FROM orders GROUP BY 1, 2"""


def _block_prices(spark, d):
    first = F.substring("o_orderpriority", 1, 1)
    block = (
        F.when(first == "1", "negpos_00_04").when(first == "2", "negpos_04_08").when(first == "3", "negpos_08_12")
        .when(first == "4", "negpos_16_20").otherwise("negpos_20_24")
    )
    return (
        table(spark, d, "orders")
        .groupBy(F.col("o_orderdate").cast("date").alias("delivery_date"), block.alias("block"))
        .agg(F.max("o_totalprice").alias("price"))
    )


@workload(f"""WITH b AS ({_BLOCK_PRICE})
SELECT delivery_date, max(price) FILTER (block = 'negpos_00_04') AS negpos_00_04, max(price) FILTER (block = 'negpos_04_08') AS negpos_04_08,
  max(price) FILTER (block = 'negpos_08_12') AS negpos_08_12, max(price) FILTER (block = 'negpos_16_20') AS negpos_16_20, max(price) FILTER (block = 'negpos_20_24') AS negpos_20_24 FROM b GROUP BY 1""")
def pivot_blocks(spark, d):
    """Day x block table over a fixed block list; duplicates would raise."""
    return pivot_strict(_block_prices(spark, d), ["delivery_date"], "block", ["negpos_00_04", "negpos_04_08", "negpos_08_12", "negpos_16_20", "negpos_20_24"], "price")


# Summer time by calendar arithmetic: last Sunday of March 02:00 to last Sunday of October 03:00 local (September until 1995).
@workload(f"""WITH b AS ({_BLOCK_PRICE}),
e AS (SELECT *, CAST(right(block, 5)[1:2] AS INTEGER) AS h1, CAST(right(block, 2) AS INTEGER) AS h2, make_date(year(delivery_date), 3, 31) AS m0,
        CASE WHEN year(delivery_date) < 1996 THEN make_date(year(delivery_date), 9, 30) ELSE make_date(year(delivery_date), 10, 31) END AS o0 FROM b),
f AS (SELECT *, CAST(delivery_date AS TIMESTAMP) + INTERVAL 1 HOUR * h1 AS a, CAST(delivery_date AS TIMESTAMP) + INTERVAL 1 HOUR * h2 AS z,
        CAST(m0 AS TIMESTAMP) - INTERVAL 1 DAY * (isodow(m0) % 7) + INTERVAL 2 HOUR AS summer, CAST(o0 AS TIMESTAMP) - INTERVAL 1 DAY * (isodow(o0) % 7) + INTERVAL 3 HOUR AS winter FROM e)
SELECT delivery_date, block, unnest(generate_series(a - INTERVAL 1 HOUR * CASE WHEN a >= summer AND a < winter THEN 2 ELSE 1 END,
  z - INTERVAL 1 HOUR * CASE WHEN z >= summer AND z < winter THEN 3 ELSE 2 END, INTERVAL 1 HOUR)) AS ts, price FROM f""")
def delivery_blocks_to_utc(spark, d):
    """Local four-hour blocks -> the UTC hours they really cover."""
    return delivery_block_hours(_block_prices(spark, d))


# --- local time --------------------------------------------------------------------------

@workload("""
SELECT l_orderkey, l_linenumber, l_partkey,
  l_shipdate + INTERVAL 150 MINUTE - INTERVAL 1 HOUR * CASE WHEN month(l_shipdate) BETWEEN 4 AND 10 THEN 2 ELSE 1 END AS ts FROM lineitem""")
def local_to_utc(spark, d):
    """Wall clock + CET/CEST label -> UTC, exact in the repeated hour."""
    local = F.col("l_shipdate") + F.expr("INTERVAL 150 MINUTES")
    label = F.when(F.month("l_shipdate").between(4, 10), "CEST").otherwise("CET")
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", wall_clock_to_utc(local, label).alias("ts"))


@workload("""
SELECT event_id, CAST(replace(replace(CAST(value AS VARCHAR), '.', ','), ',', '.') AS DOUBLE) AS parsed, CASE WHEN event_type = 'error' THEN NULL ELSE value * 1000 END AS mm,
  CASE WHEN event_type LIKE 'c%' OR event_type = 'error' THEN 'reduction' ELSE 'increase' END AS direction FROM events""")
def value_cleaning(spark, d):
    """Decimal commas, NA tokens, unit conversion, direction by prefix (blank = reduction)."""
    comma = F.translate(F.col("value").cast("string"), ".", ",")
    token = F.when(F.col("event_type") == "error", "N.A.").otherwise(comma)
    text = F.when(F.col("event_type") != "error", F.col("event_type"))
    return table(spark, d, "events").select(
        "event_id",
        values.decimal_comma(comma).alias("parsed"),
        values.metres_to_mm(values.decimal_comma(values.null_tokens(token, values.NOT_AVAILABLE))).alias("mm"),
        classify.measure_direction(text, "c").alias("direction"),
    )


# --- hulls ---------------------------------------------------------------------------------

# A directed pair of points is an edge of its region's hull if no point of the region lies to the right of it.
@workload("""
WITH p AS (SELECT CAST(label AS VARCHAR) AS region, CAST(embedding[1] AS DOUBLE) AS x, CAST(embedding[2] AS DOUBLE) AS y FROM embeddings),
u AS (SELECT DISTINCT region, x, y FROM p WHERE x IS NOT NULL AND y IS NOT NULL),
e AS (SELECT a.region, a.x AS ax, a.y AS ay, b.x AS bx, b.y AS bz FROM u a JOIN u b ON a.region = b.region AND (a.x <> b.x OR a.y <> b.y)),
r AS (SELECT DISTINCT e.* FROM e JOIN u q ON q.region = e.region WHERE (bx - ax) * (q.y - ay) - (bz - ay) * (q.x - ax) < 0),
h AS (SELECT * FROM e EXCEPT SELECT * FROM r)
SELECT h.region, count(*) AS vertex_count, round(sum(ax * bz - bx * ay) / 2, 6) AS area, round(min(ax), 6) AS west, round(max(ax), 6) AS east,
  max(t.capacity_mw) AS capacity_mw, max(t.unit_count) AS unit_count
FROM h JOIN (SELECT region, CAST(count(*) AS DOUBLE) AS capacity_mw, count(*) AS unit_count FROM p GROUP BY region) t ON t.region = h.region GROUP BY h.region""")
def footprint_hull(spark, d):
    """Convex hull of the first two embedding dimensions per label: vertices, area (from the printed ring) and extent."""
    points = table(spark, d, "embeddings").select(
        F.col("label").cast("string").alias("region"), F.get("embedding", F.lit(0)).alias("x"), F.get("embedding", F.lit(1)).alias("y"),
        F.lit(1.0).alias("mw"),
    )
    hulls = footprint_hulls(points, "region", "x", "y", "mw")
    ring = F.from_json(F.get_json_object("geojson", "$.coordinates[0]"), "array<array<double>>")
    cross = F.transform(F.sequence(F.lit(0), F.size("ring") - 2), lambda i: F.get("ring", i)[0] * F.get("ring", i + 1)[1] - F.get("ring", i + 1)[0] * F.get("ring", i)[1])
    area = F.aggregate(cross, F.lit(0.0), lambda a, x: a + x) / 2
    xs = F.transform("ring", lambda p: p[0])
    return hulls.withColumn("ring", ring).select(
        "region", "vertex_count", F.round(area, 6).alias("area"), F.round(F.array_min(xs), 6).alias("west"), F.round(F.array_max(xs), 6).alias("east"), "capacity_mw", "unit_count"
    )
