"""Tables and files that are written and read back: loads into stored months, parts, masks, collections.

Each workload writes what Spark derives from the test tables to a new folder and lets the
library's readers, loads and checks work on that.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from .. import fixed_values as fixed
from ..functions.timeutil import floor_to, ntz
from ..operators.coverage import gap_check_of_runs, max_gap_of_runs
from ..plans import incremental as inc
from ..plans import jobs
from ..schemas import SERIES, struct
from ..session import scratch_folder
from ..sources import regions, registry, sinks, zone_csv
from .completeness import _gap_sql
from .factors import MASK_SQL, SOLAR_SQL, mask, solar_factors
from .registry import table, workload

# --- months behind a pointer ------------------------------------------------------------

_DAYS = "SELECT o_orderstatus AS series, o_orderdate AS ts, round(sum(o_totalprice), 2) AS value FROM orders GROUP BY 1, 2"


def _daily(spark, d):
    daily = table(spark, d, "orders").groupBy(F.col("o_orderstatus").alias("series"), F.col("o_orderdate").cast("timestamp_ntz").alias("ts"))
    return daily.agg(F.round(F.sum("o_totalprice"), 2).alias("value"))


def _loaded(spark, d, cut: str):
    """Months before `cut`, then a load of everything since the last day, with other values."""
    stored = inc.PartitionedTable(spark, scratch_folder(spark), struct(SERIES), ["series"], step="day")
    daily = _daily(spark, d)
    stored.merge(daily.filter(F.col("ts") < ntz(cut)))
    marks = spark.createDataFrame(stored.watermarks().toArrow(), "series STRING, mark TIMESTAMP_NTZ")
    stored.load(daily.withColumn("value", -F.col("value")), inc.next_day, dt.date.fromisoformat("1990-01-01"))
    return stored, marks


_CUT = "1998-06-18"


@workload(f"""
WITH s AS ({_DAYS}), mark AS (SELECT max(ts) AS mark FROM s WHERE ts < TIMESTAMP '{_CUT}')
SELECT series, ts, CASE WHEN ts < TIMESTAMP '{_CUT}' THEN value ELSE -value END AS value FROM s, mark
WHERE ts < TIMESTAMP '{_CUT}' OR ts >= mark.mark + INTERVAL 1 DAY""")
def stored_load(spark, d):
    """A table of months after two loads, the second from the day after the table's last."""
    return _loaded(spark, d, _CUT)[0].read()


@workload(f"""
WITH s AS ({_DAYS}), mark AS (SELECT series, max(ts) AS mark FROM s WHERE ts < TIMESTAMP '{_CUT}' GROUP BY 1)
SELECT count(*) AS row_count, count(*) FILTER (mark IS NULL OR ts > mark) AS new_rows, min(ts) AS min_ts, max(ts) AS max_ts,
  CAST(0 AS BIGINT) AS trimmed_rows, count(DISTINCT date_trunc('month', ts)) AS month_count FROM s LEFT JOIN mark USING (series)""")
def stored_load_report(spark, d):
    """The report of that load, from the months' summaries."""
    stored, marks = _loaded(spark, d, _CUT)
    return stored.report(marks, details=True)


_REFETCH = """
s AS (SELECT date_trunc('hour', ts) AS ts, round(sum(value), 2) AS value, count(*) AS n FROM events GROUP BY 1),
old AS (SELECT ts, value FROM s WHERE ts < TIMESTAMP '2024-01-25'),
mark AS (SELECT greatest(date_trunc('day', max(ts)) - INTERVAL 14 DAY, TIMESTAMP '2024-01-05') AS since FROM old),
new AS (SELECT ts, CASE WHEN ts < TIMESTAMP '2024-01-29 06:00:00' AND n % 7 <> 0 THEN value * 2 END AS value FROM s, mark WHERE ts >= since),
m AS (SELECT * FROM new UNION ALL SELECT * FROM old WHERE ts NOT IN (SELECT ts FROM new)),
v AS (SELECT max(ts) AS last FROM m WHERE value IS NOT NULL)"""


def _refetched(spark, d):
    stored = inc.PartitionedTable(spark, scratch_folder(spark), struct("ts TIMESTAMP_NTZ, value DOUBLE"), step="hour")
    hourly = table(spark, d, "events").groupBy(floor_to("ts", "hour").alias("ts")).agg(F.round(F.sum("value"), 2).alias("value"), F.count("*").alias("n"))
    stored.merge(hourly.filter(F.col("ts") < ntz("2024-01-25")).select("ts", "value"))
    corrected = F.when((F.col("ts") < ntz("2024-01-29 06:00:00")) & (F.col("n") % 7 != 0), F.col("value") * 2)
    stored.load(hourly.select("ts", corrected.alias("value")), inc.lookback(14, ntz("2024-01-05")), dt.date.fromisoformat("2024-01-05"), trim="value")
    return stored


@workload(f"WITH {_REFETCH} SELECT m.ts, m.value FROM m, v WHERE m.ts <= v.last")
def stored_refetch(spark, d):
    """A stored series after a rolling refetch: corrections win, the tail without values is cut."""
    return _refetched(spark, d).read()


@workload(f"""WITH {_REFETCH} SELECT count(*) FILTER (ts <= last) AS row_count, count(*) FILTER (ts <= last) AS new_rows, min(ts) AS min_ts,
  max(last) AS max_ts, count(*) FILTER (ts > last) AS trimmed_rows, count(DISTINCT date_trunc('month', ts)) FILTER (ts <= last) AS month_count FROM m, v""")
def stored_refetch_report(spark, d):
    """Its report, with the rows cut."""
    return _refetched(spark, d).report(details=True)


# --- checks on the runs kept with months ---------------------------------------------------

@workload(_gap_sql("SELECT DISTINCT o_orderstatus AS series, o_orderdate AS ts FROM orders", "1 DAY"))
def stored_gap_check(spark, d):
    """Daily completeness from the runs that each stored month keeps."""
    return gap_check_of_runs(_loaded(spark, d, _CUT)[0].runs(), "series", "day")


@workload(f"""
WITH days AS (SELECT DISTINCT o_orderstatus AS series, CAST(o_orderdate AS DATE) AS day FROM orders WHERE o_orderpriority = '1-URGENT' AND o_custkey % 40 = 7),
g AS (SELECT series, day, day - lag(day) OVER (PARTITION BY series ORDER BY day) AS gap FROM days)
SELECT series, count(*) FILTER (gap > 5) = 0 AS passed, 'ERROR' AS severity, CAST(coalesce(max(gap), 0) AS BIGINT) AS max_gap_days,
  count(*) FILTER (gap > 5) AS large_gap_count, min(day) FILTER (gap > 5) AS first_large_gap_end FROM g GROUP BY series""")
def stored_max_gap(spark, d):
    """Longest pause of a thin daily series, from the runs of its stored months."""
    stored = inc.PartitionedTable(spark, scratch_folder(spark), struct(SERIES), ["series"], step="day")
    thin = table(spark, d, "orders").filter("o_orderpriority = '1-URGENT' AND o_custkey % 40 = 7")
    stored.merge(thin.groupBy(F.col("o_orderstatus").alias("series"), F.col("o_orderdate").cast("timestamp_ntz").alias("ts")).agg(F.max("o_totalprice").alias("value")))
    return max_gap_of_runs(stored.runs(), "series")


# --- parts, listings ---------------------------------------------------------------------------

@workload(f"""WITH s AS ({SOLAR_SQL})
SELECT ts - INTERVAL 1 HOUR AS ts, technology, country AS zone_id, cf FROM s WHERE year(ts) >= 1990""")
def stored_factor_parts(spark, d):
    """Factors written by technology and decade, twice (a part on disk is final), then stacked an hour back."""
    root, cf = scratch_folder(spark), solar_factors(spark, d).withColumnRenamed("country", "zone_id")
    for factor in (1, 100):
        for technology in fixed.SOLAR_TECHNOLOGIES:
            part = cf.filter(F.col("technology") == technology).select("ts", "zone_id", (F.col("cf") * factor).alias("cf"))
            jobs.load_factor_parts(part, root, "solar", technology)
    parts = {t: zone_csv.read_factor_parts(spark, root, "solar", t, ["1990-1999", "2000-2009"]).drop("technology") for t in fixed.SOLAR_TECHNOLOGIES}
    return zone_csv.stack_technologies(parts, -1).select("ts", "technology", "zone_id", "cf")


@workload("SELECT DISTINCT event_type AS name, CAST(epoch_ms(date_trunc('day', ts)) AS BIGINT) AS block_ts FROM events")
def stored_block_listing(spark, d):
    """Block folders found by listing them."""
    root = scratch_folder(spark)
    day = F.unix_date(F.col("ts").cast("date")).cast("bigint") * 86_400_000
    blocks = table(spark, d, "events").select(F.col("event_type").alias("name"), day.alias("block_ts")).distinct()
    blocks.withColumn("value", F.lit("{}")).repartition("name").write.partitionBy("name", "block_ts").text(root)
    return jobs.landed_blocks(spark, root)


# --- masks, registry, files ------------------------------------------------------------------

@workload(f"SELECT zone_id, CAST(cell_lat AS DOUBLE) AS cell_lat, CAST(cell_lon AS DOUBLE) AS cell_lon, CAST(coverage AS DOUBLE) AS coverage FROM ({MASK_SQL}) WHERE zone_id LIKE 'E%'")
def zone_mask_scan(spark, d):
    """A stored mask read for the zones of one prefix."""
    root = scratch_folder(spark)
    mask(spark, d).select("zone_id", "cell_lat", "cell_lon", "coverage").write.parquet(f"{root}/mask")
    return regions.read_mask(spark, f"{root}/mask", "E")


@workload("""SELECT c_name AS unit_id, CASE WHEN c_nationkey % 3 <> 0 THEN c_mktsegment END AS main_orientation, CAST(c_nationkey AS VARCHAR) AS main_orientation_tilt_bucket FROM customer""")
def solar_detail(spark, d):
    """Solar detail extract: three of many columns, translated."""
    raw = table(spark, d, "customer").select(
        F.col("c_name").alias("EinheitMastrNummer"), F.when(F.col("c_nationkey") % 3 != 0, F.col("c_mktsegment")).alias("Hauptausrichtung"),
        F.col("c_nationkey").cast("string").alias("HauptausrichtungNeigungswinkel"), F.lit("x").alias("Unbekannt"),
    )
    return registry.solar_detail_extract(raw)


@workload("SELECT c_name AS unit_id, CASE WHEN c_nationkey % 4 <> 0 THEN 'SEL' || CAST(c_nationkey AS VARCHAR) END AS location_id FROM customer")
def storage_locations(spark, d):
    """Storage location extract; some units have none."""
    location = F.when(F.col("c_nationkey") % 4 != 0, F.concat(F.lit("SEL"), F.col("c_nationkey").cast("string")))
    raw = table(spark, d, "customer").select(F.col("c_name").alias("EinheitMastrNummer"), location.alias("LokationMastrNummer"), F.lit(1).alias("Leistung"))
    return registry.storage_location_extract(raw)


@workload("SELECT c_name AS \"Title\", CAST(c_nationkey AS VARCHAR) AS \"Identity\", c_mktsegment AS \"Manufacturer\" FROM customer")
def static_table(spark, d):
    """A plain CSV table, written and read back as text."""
    root = scratch_folder(spark)
    rows = table(spark, d, "customer").select(F.col("c_name").alias("Title"), F.col("c_nationkey").alias("Identity"), F.col("c_mktsegment").alias("Manufacturer"))
    rows.write.option("header", True).csv(f"{root}/static")
    return zone_csv.read_static_table(spark, f"{root}/static")


def _meter_lines(spark, d):
    """Site meter files, one per event type: a preamble, a header, and a line per event."""
    events = table(spark, d, "events")
    a, b, c = fixed.METER_COLUMNS
    second = F.when(F.col("user_id") % 3 == 0, "").otherwise(F.col("user_id").cast("string"))
    line = F.concat_ws(",", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"), F.format_string("%.2f", F.col("value")), second, F.lit("x"))
    body = events.select(F.col("event_type").alias("file"), (F.col("event_id") + 10).alias("pos"), line.alias("value"))
    head = F.array(F.lit("# Site export"), F.lit("# Time zone: UTC"), F.lit(f"# Date and time,{a},{b},Other"))
    return events.select(F.col("event_type").alias("file")).distinct().select("file", F.posexplode(head).alias("pos", "value")).unionByName(body)


@workload(f"""SELECT ts, round(value, 2) AS "{fixed.METER_COLUMNS[0]}", CASE WHEN user_id % 3 <> 0 THEN CAST(user_id AS DOUBLE) END AS "{fixed.METER_COLUMNS[1]}",
  CAST(NULL AS DOUBLE) AS "{fixed.METER_COLUMNS[2]}" FROM events""")
def meter_csv(spark, d):
    """Meter files: wanted columns by name, one of them absent, blank cells as NULL."""
    return zone_csv.parse_meter(_meter_lines(spark, d))


@workload(f"""SELECT ts, '{fixed.METER_COLUMNS[0]}' AS quantity, round(value, 2) AS value FROM events
UNION ALL SELECT ts, '{fixed.METER_COLUMNS[1]}', CASE WHEN user_id % 3 <> 0 THEN CAST(user_id AS DOUBLE) END FROM events
UNION ALL SELECT ts, 'Other', NULL FROM events""")
def meter_csv_long(spark, d):
    """The same files with all their columns, long."""
    return zone_csv.parse_meter_long(_meter_lines(spark, d))


@workload("""SELECT substr(n_name, 1, 2) AS "CNTR_CODE", CAST(n_regionkey AS INTEGER) AS "LEVL_CODE", n_name AS "NUTS_ID", n_name AS "NUTS_NAME", NULL::VARCHAR AS "NAME_LATN",
  '{"type":"Point","coordinates":[' || CAST(n_nationkey AS VARCHAR) || ',50]}' AS geometry FROM nation WHERE n_nationkey >= 0
UNION ALL SELECT 'C', CAST(c_nationkey AS INTEGER), c_name, c_mktsegment, NULL, NULL FROM customer""")
def feature_collection(spark, d):
    """A GeoJSON FeatureCollection, written in parallel parts and read back."""
    point = F.concat(F.lit('{"type":"Point","coordinates":['), F.col("n_nationkey").cast("string"), F.lit(",50]}"))
    nations = table(spark, d, "nation").select(
        F.substring("n_name", 1, 2).alias("CNTR_CODE"), F.col("n_regionkey").cast("int").alias("LEVL_CODE"), F.col("n_name").alias("NUTS_ID"), F.col("n_name").alias("NUTS_NAME"), point.alias("geometry"))
    customers = table(spark, d, "customer").select(
        F.lit("C").alias("CNTR_CODE"), F.col("c_nationkey").cast("int").alias("LEVL_CODE"), F.col("c_name").alias("NUTS_ID"), F.col("c_mktsegment").alias("NUTS_NAME"), F.lit(None).cast("string").alias("geometry"))
    path = f"{scratch_folder(spark)}/regions.geojson"
    rows = nations.unionByName(customers).withColumn("NAME_LATN", F.lit(None).cast("string"))
    sinks.write_feature_collection(rows.repartition(5), path, "geometry", ["CNTR_CODE", "LEVL_CODE", "NUTS_ID", "NUTS_NAME", "NAME_LATN"])
    return regions.read_features(spark, path)
