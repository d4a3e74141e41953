"""Source parsers, fed with text that Spark derives from the test tables.

Each workload first prints a table in a source's own layout (decimal commas, NA
tokens, preambles, nested JSON) and then lets the reader's parser recover it.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import fixed_values as fixed
from ..functions.timeutil import floor_to
from ..sources import market_csv, series_json, tenders, weather, zone_csv
from ..sources.registry import unit_extract
from ..sources.sinks import feature
from .factors import CF_SQL, zone_factors
from .registry import table, workload


def _epoch_ms(day):
    return (F.unix_date(day).cast("bigint") * 86_400_000)


# --- JSON blocks ---------------------------------------------------------------------

_BLOCK_ROWS = """
h AS (SELECT event_type AS series, date_trunc('hour', ts) AS ts, CASE WHEN count(*) % 5 <> 0 THEN round(sum(value), 2) END AS v, CAST(count(*) AS DOUBLE) AS n FROM events GROUP BY 1, 2),
x AS (SELECT series, ts, v, 1 AS later FROM h UNION ALL SELECT series, ts, n, 0 FROM h WHERE hour(ts) = 0)"""


@workload(f"""WITH {_BLOCK_ROWS}, r AS (SELECT *, row_number() OVER (PARTITION BY series, ts ORDER BY later DESC) AS rn FROM x WHERE v IS NOT NULL)
SELECT series, ts, v AS value FROM r WHERE rn = 1""")
def json_block_series(spark, d):
    """Daily JSON blocks; each also carries a first guess for the next midnight, which the next block replaces."""
    hourly = (
        table(spark, d, "events")
        .groupBy(F.col("event_type").alias("name"), floor_to("ts", "hour").alias("ts"))
        .agg(F.round(F.sum("value"), 2).alias("sum"), F.count("*").alias("n"))
    )
    day = F.col("ts").cast("date")
    own = hourly.select("name", "ts", F.when(F.col("n") % 5 != 0, F.col("sum")).alias("v"), day.alias("day"))
    guess = hourly.filter(F.hour("ts") == 0).select("name", "ts", F.col("n").cast("double").alias("v"), F.date_sub(day, 1).alias("day"))
    ms = _epoch_ms(F.col("ts").cast("date")) + F.hour("ts") * 3_600_000
    point = F.array(ms.cast("double"), F.col("v"))
    text = (
        own.unionByName(guess)
        .groupBy("name", _epoch_ms(F.col("day")).alias("block_ts"))
        .agg(F.to_json(F.struct(F.sort_array(F.collect_list(point)).alias("series"))).alias("text"))
    )
    blocks = text.select("name", "block_ts", F.from_json("text", "series ARRAY<ARRAY<DOUBLE>>")["series"].alias("series"))
    return series_json.parse_blocks(blocks)


@workload("""
WITH l AS (SELECT DISTINCT event_type AS name, CAST(epoch_ms(date_trunc('day', ts)) AS BIGINT) AS block_ts FROM events),
s AS (SELECT DISTINCT event_type AS name, CASE WHEN event_type = 'error' THEN 1600000000000 ELSE 1704067200000 + length(event_type) * 216000000 END AS start_ms FROM events WHERE event_type <> 'signup'),
f AS (SELECT l.name, coalesce(max(block_ts) FILTER (block_ts <= start_ms), min(block_ts)) AS lo FROM l LEFT JOIN s USING (name) GROUP BY l.name)
SELECT l.name, l.block_ts FROM l JOIN f USING (name) WHERE block_ts >= lo""")
def block_pruning(spark, d):
    """Blocks needed to continue from each series' start."""
    events = table(spark, d, "events")
    listing = events.select(
        F.col("event_type").alias("name"), _epoch_ms(F.col("ts").cast("date")).alias("block_ts")
    ).distinct()
    start = F.when(F.col("event_type") == "error", F.lit(1_600_000_000_000)).otherwise(
        F.lit(1_704_067_200_000) + F.length("event_type") * 216_000_000
    )
    starts = events.filter("event_type <> 'signup'").select(F.col("event_type").alias("name"), start.alias("start_ms")).distinct()
    return series_json.prune_blocks(listing, starts)


# --- delimited text ------------------------------------------------------------------

@workload("""
SELECT CAST(o_orderdate AS DATE) AS date, CASE WHEN count(*) FILTER (o_orderstatus = 'P') > 0 THEN round(sum(o_totalprice) FILTER (o_orderstatus = 'P'), 2) END AS a,
  CAST(count(*) AS DOUBLE) AS b FROM orders GROUP BY o_orderdate HAVING count(*) % 3 <> 0""")
def multiplexed_csv(spark, d):
    """One chart out of a file that mixes charts and row widths."""
    daily = table(spark, d, "orders").groupBy(F.col("o_orderdate").cast("date").alias("day")).agg(
        F.round(F.sum(F.when(F.col("o_orderstatus") == "P", F.col("o_totalprice"))), 2).alias("a"), F.count("*").alias("n")
    )
    a, n, day = F.coalesce(F.col("a").cast("string"), F.lit("")), F.col("n").cast("string"), F.col("day").cast("string")
    wanted = F.concat_ws(";", F.lit("chart-1"), day, a, n)
    wide = F.concat_ws(";", F.lit("chart-1"), day, a, n, n)
    other = F.concat_ws(";", F.lit("chart-2"), day, n, n)
    texts = F.array(F.when(F.col("n") % 3 == 0, wide).otherwise(wanted), other)
    return market_csv.parse_chart(daily.select(F.explode(texts).alias("value")), "chart-1", ["a", "b"])


@workload("""
WITH r AS (SELECT l_orderkey, l_linenumber, l_partkey, o_orderdate + INTERVAL 1 MINUTE * (l_linenumber * 75) AS s, l_shipdate + INTERVAL 1 MINUTE * (l_linenumber * 75 + 30) AS e,
   l_quantity, l_extendedprice, l_tax, l_returnflag, l_linestatus FROM lineitem JOIN orders ON o_orderkey = l_orderkey),
u AS (SELECT *, s - INTERVAL 1 HOUR * CASE WHEN month(s) BETWEEN 4 AND 10 THEN 2 ELSE 1 END AS start, CASE WHEN l_linestatus = 'F' THEN e - INTERVAL 1 HOUR * CASE WHEN month(e) BETWEEN 4 AND 10 THEN 2 ELSE 1 END END AS stop FROM r)
SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) || '-' || CAST(l_partkey AS VARCHAR) AS reason, start, stop AS "end",
  CAST(date_trunc('month', start) AS DATE) AS month, CASE l_returnflag WHEN 'A' THEN 'reduction' WHEN 'N' THEN 'increase' ELSE 'reduction' END AS direction,
  l_quantity AS mwh, l_extendedprice AS avg_mw, l_tax AS max_mw, CASE l_returnflag WHEN 'A' THEN 'pv' WHEN 'N' THEN 'offshore_wind' ELSE 'ambiguous' END AS tech FROM u""")
def measure_csv(spark, d):
    """Redispatch measure rows: German dates, decimal commas, zone labels, classified names."""
    orders = table(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate")
    rows = table(spark, d, "lineitem").join(orders, "l_orderkey")

    def stamp(day, extra):
        minutes = (F.col("l_linenumber") * 75 + extra).cast("int")
        return F.col(day) + F.make_dt_interval(F.lit(0), F.lit(0), minutes)

    def german_day(ts):
        iso = ts.cast("string")
        return F.concat_ws(".", F.substring(iso, 9, 2), F.substring(iso, 6, 2), F.substring(iso, 1, 4))

    def clock(ts):
        return F.substring(ts.cast("string"), 12, 5)

    def label(ts):
        return F.when(F.month(ts).between(4, 10), "CEST").otherwise("CET")

    def comma(column):
        return F.translate(F.col(column).cast("string"), ".", ",")

    start, end = stamp("o_orderdate", 0), stamp("l_shipdate", 30)
    direction = F.when(F.col("l_returnflag") == "A", "Wirkleistungseinspeisung reduzieren").when(
        F.col("l_returnflag") == "N", "Wirkleistungseinspeisung erh¿hen"
    )
    entity = F.when(F.col("l_returnflag") == "A", "Park PV Nord").when(F.col("l_returnflag") == "N", "UW Dörpen-West").otherwise("Cluster 7")
    raw = rows.select(
        german_day(start).alias("BEGINN_DATUM"), clock(start).alias("BEGINN_UHRZEIT"),
        label(start).alias("ZEITZONE_VON"), german_day(end).alias("ENDE_DATUM"),
        clock(end).alias(" ENDE_UHRZEIT "),
        F.when(F.col("l_linestatus") == "F", label(end)).otherwise("XYZ").alias("ZEITZONE_BIS"),
        direction.alias("RICHTUNG"), comma("l_quantity").alias("GESAMTE_ARBEIT_MWH"), comma("l_extendedprice").alias("MITTLERE_LEISTUNG_MW"),
        comma("l_tax").alias("MAXIMALE_LEISTUNG_MW"), F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey").alias("GRUND_DER_MASSNAHME"),
        F.lit("TSO").alias("ANWEISENDER_UENB"), entity.alias("BETROFFENE_ANLAGE"), F.lit("Sonstiges").alias("PRIMAERENERGIEART"),
    )
    return market_csv.parse_measures(raw).select("reason", "start", "end", "month", "direction", "mwh", "avg_mw", "max_mw", "tech")


@workload("""
WITH q AS (SELECT *, date_trunc('hour', ts) + INTERVAL 15 MINUTE * CAST(floor(minute(ts) / 15) AS INTEGER) - INTERVAL 1 HOUR AS slot FROM events),
r AS (SELECT *, row_number() OVER (PARTITION BY slot ORDER BY event_id) AS rn FROM q)
SELECT slot AS ts, value AS aep_module1_eur_mwh, CASE WHEN event_type <> 'error' THEN CAST(user_id AS DOUBLE) END AS aep_module2_eur_mwh,
  CASE WHEN user_id % 3 = 1 THEN CAST(user_id % 3 AS DOUBLE) END AS aep_module3_eur_mwh FROM r WHERE rn = 1""")
def quarter_hour_csv(spark, d):
    """Quarter-hour price lines: NA tokens, zero as inactive, first occurrence wins."""
    slot = floor_to("ts", "quarter_hour")
    m2 = F.when(F.col("event_type") == "error", "N.A.").otherwise(F.col("user_id").cast("string"))
    m3 = F.when(F.col("user_id") % 3 == 2, "N.E.").otherwise(F.format_string("%d,0", F.col("user_id") % 3))
    line = F.concat_ws(
        ";", F.date_format(slot, "dd.MM.yyyy"), F.lit("CET"), F.date_format(slot, "HH:mm"), F.lit(""),
        F.translate(F.col("value").cast("string"), ".", ","), m2, m3,
    )
    header = F.lit("Datum;Zeitzone;von;bis;AEP Modul 1;AEP Modul 2;AEP Modul 3")
    texts = F.when(F.col("event_id") == 0, F.array(header, line)).otherwise(F.array(line))
    lines = table(spark, d, "events").select(F.lit("f").alias("file"), F.col("event_id").alias("pos"), F.explode(texts).alias("value"))
    return market_csv.parse_quarter_hours(lines, market_csv.LAYOUTS["aep_modules"])


@workload("""
SELECT CAST(o_orderdate AS DATE) AS date, min(o_totalprice) AS open, max(o_totalprice) AS high, min(o_totalprice) AS low, max(o_totalprice) AS close,
  count(*) AS volume FROM orders GROUP BY 1""")
def price_bars(spark, d):
    """Daily bars with a zone offset in the stamp."""
    price = F.col("o_totalprice")
    bars = table(spark, d, "orders").groupBy(F.concat(F.col("o_orderdate").cast("string"), F.lit("+01:00")).alias("Date")).agg(
        F.min(price).alias("Open"), F.max(price).alias("High"), F.min(price).alias("Low"), F.max(price).alias("Close"),
        F.count("*").cast("string").alias("Volume"),
    )
    return market_csv.parse_price_bars(bars)


# --- tenders --------------------------------------------------------------------------

_BLOCK_OF_CUSTOMER = "['00_04', '04_08', '08_12', '12_16', '16_20', '20_24'][o_custkey % 6 + 1]"


@workload(f"""
WITH t AS (SELECT CAST(o_orderdate AS DATE) AS delivery_date, year(o_orderdate) AS file, {_BLOCK_OF_CUSTOMER} AS b, max(o_totalprice) AS p FROM orders
  WHERE o_orderstatus <> 'P' GROUP BY ALL),
k AS (SELECT * FROM t WHERE file <> 1997)
SELECT delivery_date, max(p / 4) FILTER (b = '00_04') AS negpos_00_04, max(p / 4) FILTER (b = '04_08') AS negpos_04_08, max(p / 4) FILTER (b = '08_12') AS negpos_08_12,
  max(p / 4) FILTER (b = '12_16') AS negpos_12_16, max(p / 4) FILTER (b = '16_20') AS negpos_16_20, max(p / 4) FILTER (b = '20_24') AS negpos_20_24 FROM k GROUP BY 1""")
def tender_fcr(spark, d):
    """Reserve tender rows -> day x block prices per hour; a file without block products is empty."""
    raw = _tender_rows(spark, d, "NEGPOS")
    old_product = (F.col("file") == "1997") & (F.col("PRODUCTNAME") == "NEGPOS_00_04")
    raw = raw.withColumn("PRODUCTNAME", F.when(old_product, "NEGPOS_00_24").otherwise(F.col("PRODUCTNAME")))
    return tenders.block_table(tenders.fcr_prices(raw), tenders.FCR_COLUMNS)


def _tender_rows(spark, d, direction):
    block = F.element_at(F.array(*[F.lit(b) for b in fixed.BLOCKS]), (F.col("o_custkey") % 6 + 1).cast("int"))
    tender = F.when(F.col("o_orderstatus") == "P", 2).otherwise(1)
    return (
        table(spark, d, "orders")
        .groupBy(
            F.year("o_orderdate").cast("string").alias("file"),
            F.date_format("o_orderdate", "yyyy-MM-dd").alias("DATE_FROM"),
            tender.alias("TENDER_NUMBER"),
            F.concat(F.lit(direction + "_"), block).alias("PRODUCTNAME"),
        )
        .agg(F.max("o_totalprice").cast("string").alias(fixed.FCR_PRICE_COLUMNS[1]))
    )


@workload(f"""
WITH t AS (SELECT CAST(o_orderdate AS DATE) AS delivery_date, CASE WHEN o_orderstatus = 'F' THEN 'neg' ELSE 'pos' END || '_' || {_BLOCK_OF_CUSTOMER} AS b, max(o_totalprice) AS p FROM orders GROUP BY ALL),
u AS (SELECT delivery_date, b, CASE WHEN delivery_date >= DATE '2000-01-01' THEN p ELSE p / 4 END AS p FROM t)
SELECT delivery_date, {', '.join(f"max(p) FILTER (b = '{s}_{b}') AS {s}_{b}" for s in ('neg', 'pos') for b in fixed.BLOCKS)} FROM u GROUP BY 1""")
def tender_afrr(spark, d):
    """Two price units in two files; days in both come from the later file."""
    block = F.element_at(F.array(*[F.lit(b) for b in fixed.BLOCKS]), (F.col("o_custkey") % 6 + 1).cast("int"))
    side = F.when(F.col("o_orderstatus") == "F", "NEG").otherwise("POS")
    rows = (
        table(spark, d, "orders")
        .groupBy(F.date_format("o_orderdate", "yyyy-MM-dd").alias("DATE_FROM"), F.concat_ws("_", side, block).alias("PRODUCT"))
        .agg(F.max("o_totalprice").cast("string").alias("price"))
    )
    old = rows.withColumnRenamed("price", fixed.AFRR_PRICE_PER_BLOCK).withColumn("file", F.lit("a"))
    new = rows.filter("DATE_FROM >= '2000-01-01'").withColumnRenamed("price", fixed.AFRR_PRICE_PER_HOUR).withColumn("file", F.lit("b"))
    return tenders.block_table(tenders.afrr_prices(old).unionByName(tenders.afrr_prices(new)), tenders.AFRR_COLUMNS)


# --- files with a preamble ---------------------------------------------------------------

@workload(f"""
WITH cf AS ({CF_SQL}), k AS (SELECT ts, zone_id, round(cf, 6) AS cf, substr(zone_id, 1, 2) AS f FROM cf), z AS (SELECT DISTINCT f, zone_id FROM k), t AS (SELECT min(f) AS f, ts FROM k GROUP BY ts)
SELECT t.ts, z.zone_id, k.cf FROM t JOIN z USING (f) LEFT JOIN k ON k.ts = t.ts AND k.zone_id = z.zone_id""")
def zone_csv_series(spark, d):
    """Wide zone files with a preamble -> long rows; blank cells stay as NULL."""
    cells = zone_factors(spark, d).select(F.substring("zone_id", 1, 2).alias("file"), "ts", "zone_id", F.format_string("%.6f", F.col("cf")).alias("text"), "cf")
    headers = cells.groupBy("file").agg(F.sort_array(F.collect_set("zone_id")).alias("zones"))
    rows = cells.groupBy("file", "ts").agg(
        F.map_from_entries(F.collect_list(F.struct("zone_id", F.when(F.col("cf").isNotNull(), F.col("text"))))).alias("row")
    )
    body = rows.join(headers, "file").select(
        "file",
        (F.unix_date(F.col("ts").cast("date")) + 10).alias("pos"),
        F.concat_ws(
            ",", F.date_format("ts", "yyyy-MM-dd HH:mm:ss"),
            F.array_join(F.transform("zones", lambda z: F.coalesce(F.try_element_at("row", z), F.lit(""))), ","),
        ).alias("value"),
    )
    top = headers.select(
        "file", F.posexplode(F.array(F.lit("# unit,share"), F.lit("# version 4"), F.concat(F.lit("Date,"), F.array_join("zones", ",")))).alias("pos", "value")
    )
    return zone_csv.parse_zone_series(top.unionByName(body))


@workload("""
SELECT event_type AS turbine, ts, round(value, 2) AS "Power (kW)", CASE WHEN event_type <> 'click' THEN CAST(user_id AS DOUBLE) END AS "Wind speed (m/s)" FROM events""")
def turbine_csv(spark, d):
    """Telemetry files: turbine name in a comment, one file without a wanted column."""
    event = F.col("event_type")
    stamp = F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    number = F.format_string("%.2f", F.col("value"))
    full = F.concat_ws(",", stamp, F.lit("x"), number, F.col("user_id").cast("string"))
    short = F.concat_ws(",", stamp, F.lit("x"), number)
    body = table(spark, d, "events").select(
        event.alias("file"), (F.col("event_id") + 10).alias("pos"), F.when(event == "click", short).otherwise(full).alias("value")
    )
    names = table(spark, d, "events").select(event.alias("file")).distinct()
    header = F.when(F.col("file") == "click", "# Date and time,Extra,Power (kW)").otherwise("# Date and time,Extra,Power (kW),Wind speed (m/s)")
    top = names.select(
        "file", F.posexplode(F.array(F.lit("# Site export"), F.concat(F.lit("# Turbine: "), F.col("file")), header)).alias("pos", "value")
    )
    return zone_csv.parse_turbines(top.unionByName(body), ["Power (kW)", "Wind speed (m/s)"])


# --- weather, registry, GeoJSON ------------------------------------------------------------

@workload("""
WITH i AS (SELECT l_suppkey AS x, l_linenumber AS y, l_shipdate AS t, avg(l_quantity) AS t2m FROM lineitem WHERE l_returnflag <> 'R' GROUP BY ALL),
a AS (SELECT l_suppkey AS x, l_linenumber AS y, l_shipdate AS t, max(l_extendedprice) AS ssrd FROM lineitem WHERE l_returnflag <> 'A' GROUP BY ALL)
SELECT CAST(x AS DOUBLE) AS cell_lon, CAST(y AS DOUBLE) AS cell_lat, t AS valid_time, round(t2m, 8) AS t2m, ssrd FROM i FULL JOIN a USING (x, y, t)""")
def grid_month_import(spark, d):
    """Instantaneous and accumulated fields merged on cell and time."""
    lines = table(spark, d, "lineitem")
    keys = [F.col("l_suppkey").alias("longitude"), F.col("l_linenumber").alias("latitude"), F.col("l_shipdate").alias("time")]
    instant = lines.filter("l_returnflag <> 'R'").groupBy(*keys).agg(F.avg("l_quantity").alias("2m_temperature"))
    accumulated = lines.filter("l_returnflag <> 'A'").groupBy(*keys).agg(F.max("l_extendedprice").alias("surface_solar_radiation_downwards"))
    grid = weather.merge_grids(instant, accumulated)
    return grid.select("cell_lon", "cell_lat", "valid_time", F.round("t2m", 8).alias("t2m"), "ssrd")


@workload("""
SELECT c_name AS unit_id, c_mktsegment AS state, CAST(c_nationkey AS VARCHAR) AS municipality_key, round(CAST(CAST(c_acctbal AS FLOAT) AS DOUBLE), 3) AS net_capacity_kw,
  NULL::VARCHAR AS district, 'wind' AS technology FROM customer""")
def registry_extract(spark, d):
    """Known registry columns, translated; absent ones NULL; the rest dropped."""
    raw = table(spark, d, "customer").select(
        F.col("c_name").alias("EinheitMastrNummer"), F.col("c_mktsegment").alias("Bundesland"),
        F.col("c_nationkey").cast("string").alias("Gemeindeschluessel"), F.col("c_acctbal").cast("string").alias("Nettonennleistung"),
        F.lit("x").alias("Unbekannt"),
    )
    units = unit_extract(raw, "wind")
    return units.select(
        "unit_id", "state", "municipality_key", F.round(F.col("net_capacity_kw").cast("double"), 3).alias("net_capacity_kw"), "district", "technology"
    )


@workload("""
SELECT '{"type":"Feature","properties":{"c_custkey":' || CAST(c_custkey AS VARCHAR) || ',"c_mktsegment":"' || c_mktsegment || '"},"geometry":{"type":"Point","coordinates":['
  || CAST(c_nationkey AS VARCHAR) || ',50]}}' AS value FROM customer""")
def geojson_features(spark, d):
    """One GeoJSON Feature per row, as the polygon sink writes them."""
    point = F.concat(F.lit('{"type":"Point","coordinates":['), F.col("c_nationkey").cast("string"), F.lit(",50]}"))
    return table(spark, d, "customer").select(feature(point, ["c_custkey", "c_mktsegment"]).alias("value"))
