"""Windows on days and times, region features, listings and multi-chart files over the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import fixed_values as fixed
from ..functions.timeutil import in_half_open
from ..sources import market_csv, regions, tenders
from .registry import table, workload


@workload("""SELECT event_id, ts, value FROM events
WHERE ts >= (SELECT date_trunc('day', min(ts)) + INTERVAL 1 DAY FROM events) AND ts < (SELECT date_trunc('day', max(ts)) FROM events)""")
def half_open_window(spark, d):
    """All but the first and the last day: the start counts, the end doesn't."""
    events = table(spark, d, "events")
    start = events.agg((F.date_trunc("day", F.min("ts")) + F.expr("INTERVAL 1 DAY")).alias("t")).scalar()
    end = events.agg(F.date_trunc("day", F.max("ts")).alias("t")).scalar()
    return events.filter(in_half_open("ts", start, end)).select("event_id", "ts", "value")


@workload("SELECT o_orderkey, CAST(o_orderdate AS DATE) AS delivery_date FROM orders WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1995-02-28' AND DATE '1997-12-31'")
def inclusive_days(spark, d):
    """Both ends of a slice of days count."""
    days = table(spark, d, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("delivery_date"))
    return tenders.in_days(days, "1995-02-28", "1997-12-31")


_COUNTRIES = [*fixed.NEIGHBOUR_COUNTRIES, "ES"]  # DE is one of them
_FEATURE_SQL = f"""SELECT CAST(c_custkey AS VARCHAR) AS NUTS_ID, CAST(c_nationkey % 4 AS INTEGER) AS LEVL_CODE, c_name AS NUTS_NAME, c_mktsegment AS NAME_LATN,
  CAST({_COUNTRIES!r} AS VARCHAR[])[CAST(c_custkey % {len(_COUNTRIES)} AS INTEGER) + 1] AS CNTR_CODE FROM customer"""


def _features(spark, d):
    country = F.get(F.array(*[F.lit(c) for c in _COUNTRIES]), (F.col("c_custkey") % len(_COUNTRIES)).cast("int"))
    return table(spark, d, "customer").select(
        F.col("c_custkey").cast("string").alias("NUTS_ID"), (F.col("c_nationkey") % 4).cast("int").alias("LEVL_CODE"), F.col("c_name").alias("NUTS_NAME"),
        F.col("c_mktsegment").alias("NAME_LATN"), country.alias("CNTR_CODE"), F.lit(None).cast("string").alias("geometry"),
    )


@workload(f"""WITH f AS ({_FEATURE_SQL})
SELECT NUTS_ID AS id, LEVL_CODE AS level, NUTS_NAME AS name FROM f WHERE CNTR_CODE = 'DE'
UNION ALL SELECT CNTR_CODE, 0, NAME_LATN FROM f WHERE LEVL_CODE = 0 AND CNTR_CODE <> 'ES'""")
def region_features(spark, d):
    """One country's regions of all levels and its neighbours' outlines."""
    features = _features(spark, d)
    own = regions.country_regions(features).select(F.col("NUTS_ID").alias("id"), F.col("LEVL_CODE").alias("level"), F.col("NUTS_NAME").alias("name"))
    return own.unionByName(regions.neighbour_outlines(features).select(F.col("CNTR_CODE").alias("id"), F.lit(0).alias("level"), F.col("NAME_LATN").alias("name")))


@workload("""SELECT CAST(l_orderkey AS VARCHAR) AS file_name, min(CAST(l_shipdate AS DATE)) AS date_range FROM lineitem GROUP BY 1""")
def latest_result_files(spark, d):
    """A listing in which files occur again: each once, the first in order."""
    listing = table(spark, d, "lineitem").select(F.col("l_orderkey").cast("string").alias("file_name"), F.col("l_shipdate").cast("date").alias("date_range"))
    return tenders.latest_files(listing)


_SOURCES = len(fixed.REDISPATCH_SOURCES)
_CHARTS = list(fixed.REDISPATCH_CHARTS)


@workload(f"""WITH o AS (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, CASE WHEN o_orderstatus = 'F' THEN '{fixed.REDISPATCH_CHARTS[_CHARTS[0]]}' ELSE '{fixed.REDISPATCH_CHARTS[_CHARTS[1]]}' END AS direction,
  CAST({fixed.REDISPATCH_SOURCES!r} AS VARCHAR[])[CAST(o_custkey % {_SOURCES} AS INTEGER) + 1] AS energy_source, round(sum(o_totalprice), 2) AS gwh FROM orders GROUP BY ALL)
SELECT * FROM o""")
def redispatch_sources(spark, d):
    """Two charts of one `;` file, mixed with lines of another width, long and without blank cells."""
    slot = (F.col("o_custkey") % _SOURCES).cast("int")
    cells = [F.format_string("%.2f", F.sum(F.when(slot == i, F.col("o_totalprice")))).alias(f"_c{i}") for i in range(_SOURCES)]
    chart = F.when(F.col("o_orderstatus") == "F", _CHARTS[0]).otherwise(_CHARTS[1])
    months = table(spark, d, "orders").groupBy(chart.alias("chart"), F.date_format(F.trunc(F.col("o_orderdate").cast("date"), "month"), "yyyy-MM-dd").alias("month")).agg(*cells)
    line = F.concat_ws(";", "chart", "month", *[F.when(F.col(f"_c{i}") != "null", F.col(f"_c{i}")).otherwise("") for i in range(_SOURCES)])
    lines = months.select(line.alias("value")).union(months.select(F.concat_ws(";", "chart", "month", F.lit("1")).alias("value")))
    return market_csv.redispatch_by_source(lines)
