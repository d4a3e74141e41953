"""Gap checks, null runs, reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.timeutil import floor_to
from ..operators import quality
from ..operators.zones import grid_summary
from .registry import table, workload

_GAP_COLUMNS = """
SELECT series, count(*) FILTER (miss AND NOT ok) = 0 AS passed, 'ERROR' AS severity,
       count(*) FILTER (miss AND NOT ok) AS unexpected, count(*) FILTER (miss AND ok) AS known,
       count(*) AS expected, CAST(max(actual) AS BIGINT) AS actual,
       min(ts) FILTER (miss AND NOT ok) AS first_unexpected, max(ts) FILTER (miss AND NOT ok) AS last_unexpected
FROM c GROUP BY series
"""


def _gap_sql(source: str, step: str, allow: str = "SELECT NULL::VARCHAR AS series, NULL::TIMESTAMP AS ts WHERE false") -> str:
    return f"""
WITH p AS (SELECT series, ts, count(*) AS n FROM ({source}) GROUP BY series, ts),
b AS (SELECT series, min(ts) AS lo, max(ts) AS hi, sum(n) AS actual FROM p GROUP BY series),
g AS (SELECT series, actual, unnest(generate_series(lo, hi, INTERVAL {step})) AS ts FROM b),
a AS ({allow}),
c AS (SELECT g.series, g.ts, g.actual,
             NOT EXISTS (SELECT 1 FROM p WHERE p.series = g.series AND p.ts = g.ts) AS miss,
             EXISTS (SELECT 1 FROM a WHERE a.series = g.series AND a.ts = g.ts) AS ok FROM g)
{_GAP_COLUMNS}"""


_QUARTER = "date_trunc('hour', ts) + INTERVAL 15 MINUTE * CAST(floor(date_part('minute', ts) / 15) AS INTEGER)"


@workload(
    _gap_sql(
        "SELECT event_type AS series, date_trunc('hour', ts) AS ts FROM events",
        "1 HOUR",
        """SELECT t.series, h.ts FROM (SELECT DISTINCT event_type AS series FROM events) t,
           (SELECT unnest(generate_series(TIMESTAMP '2024-01-07', TIMESTAMP '2024-01-07 23:00:00', INTERVAL 1 HOUR)) AS ts) h""",
    )
)
def gap_check_hourly(spark, d):
    """Hourly completeness per event type; one Sunday is an allowed outage."""
    events = table(spark, d, "events").select("event_type", floor_to("ts", "hour").alias("ts"))
    outage = F.sequence(
        F.lit("2024-01-07 00:00:00").cast("timestamp_ntz"), F.lit("2024-01-07 23:00:00").cast("timestamp_ntz"),
        F.expr("INTERVAL 1 HOUR"),
    )
    allowlist = events.select(F.col("event_type").alias("series")).distinct().select(
        "series", F.explode(outage).alias("ts"), F.lit("maintenance").alias("reason")
    )
    return quality.grid_gap_check(events, "event_type", "ts", "hour", allowlist)


@workload(_gap_sql(f"SELECT event_type AS series, {_QUARTER} AS ts FROM events", "15 MINUTE"))
def gap_check_quarter_hour(spark, d):
    events = table(spark, d, "events").select("event_type", floor_to("ts", "quarter_hour").alias("ts"))
    return quality.grid_gap_check(events, "event_type", "ts", "quarter_hour")


@workload(_gap_sql("SELECT CAST(user_id AS VARCHAR) AS series, date_trunc('hour', ts) AS ts FROM events", "1 HOUR"))
def gap_check_many_series(spark, d):
    """The same check with one series per user."""
    events = table(spark, d, "events").select(F.col("user_id").cast("string").alias("user"), floor_to("ts", "hour").alias("ts"))
    return quality.grid_gap_check(events, "user", "ts", "hour")


@workload(_gap_sql("SELECT o_orderstatus || '-' || o_orderpriority AS series, o_orderdate AS ts FROM orders", "1 DAY"))
def gap_check_daily(spark, d):
    orders = table(spark, d, "orders").select(
        F.concat_ws("-", "o_orderstatus", "o_orderpriority").alias("series"), F.col("o_orderdate").alias("ts")
    )
    return quality.grid_gap_check(orders, "series", "ts", "day")


@workload("""
WITH d AS (SELECT DISTINCT o_custkey AS series, CAST(o_orderdate AS DATE) AS day FROM orders),
g AS (SELECT series, day, date_diff('day', lag(day) OVER (PARTITION BY series ORDER BY day), day) AS gap FROM d)
SELECT series, count(*) FILTER (gap > 365) = 0 AS passed, 'ERROR' AS severity, coalesce(max(gap), 0) AS max_gap_days,
       count(*) FILTER (gap > 365) AS large_gap_count, min(day) FILTER (gap > 365) AS first_large_gap_end
FROM g GROUP BY series""")
def max_gap_check(spark, d):
    """Longest pause between order days per customer; over a year is too long."""
    return quality.max_gap_check(table(spark, d, "orders"), "o_custkey", "o_orderdate", limit_days=365)


@workload("""
WITH h AS (SELECT event_type AS series, date_trunc('hour', ts) AS ts, CASE WHEN count(*) % 3 <> 0 THEN sum(value) END AS value
           FROM events GROUP BY 1, 2),
n AS (SELECT series, ts, ts - INTERVAL 1 HOUR * row_number() OVER (PARTITION BY series ORDER BY ts) AS island FROM h WHERE value IS NULL)
SELECT series, min(ts) AS run_start, max(ts) AS run_end, count(*) AS run_length FROM n GROUP BY series, island""")
def null_run_gaps(spark, d):
    """Runs of missing values in present hourly rows."""
    hourly = (
        table(spark, d, "events")
        .groupBy("event_type", floor_to("ts", "hour").alias("ts"))
        .agg(F.when(F.count("*") % 3 != 0, F.sum("value")).alias("value"))
    )
    return quality.null_runs(hourly, "event_type", "ts", "value", "hour")


@workload("""
SELECT c.c_custkey AS series, false AS passed, 'WARN' AS severity FROM customer c
WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_totalprice > 400000)""")
def never_loaded_series(spark, d):
    """Customers without a single large order."""
    orders = table(spark, d, "orders").filter("o_totalprice > 400000").select(F.col("o_custkey").alias("c_custkey"))
    return quality.never_loaded(table(spark, d, "customer"), orders, "c_custkey")


@workload("""
SELECT count(*) AS row_count, count(*) FILTER (ts > TIMESTAMP '2024-01-20') AS new_rows, min(ts) AS min_ts, max(ts) AS max_ts FROM events""")
def run_report(spark, d):
    return quality.run_report(table(spark, d, "events"), "ts", F.lit("2024-01-20").cast("timestamp_ntz"))


@workload("SELECT event_id, ts, event_type, value FROM events ORDER BY ts DESC, event_id DESC LIMIT 5")
def tail_preview(spark, d):
    """The five latest rows: the preview that ends a run report."""
    return quality.tail_preview(table(spark, d, "events").select("event_id", "ts", "event_type", "value"), ["ts", "event_id"])


@workload("""
SELECT 'orders' AS "table", count(*) AS row_count FROM orders UNION ALL SELECT 'lineitem', count(*) FROM lineitem
UNION ALL SELECT 'customer', count(*) FROM customer""")
def table_row_counts(spark, d):
    return quality.table_counts({name: table(spark, d, name) for name in ("orders", "lineitem", "customer")})


@workload("""
SELECT count(*) AS row_count, count(DISTINCT (l_suppkey, l_linenumber)) AS cell_count,
       count(DISTINCT date_trunc('month', l_shipdate)) AS month_count,
       CAST(min(date_trunc('month', l_shipdate)) AS DATE) AS first_month, CAST(max(date_trunc('month', l_shipdate)) AS DATE) AS last_month
FROM lineitem""")
def grid_part_summary(spark, d):
    """Rows, distinct cells and months present of a (supplier, line) grid."""
    grid = table(spark, d, "lineitem").select(
        F.col("l_suppkey").alias("cell_lon"), F.col("l_linenumber").alias("cell_lat"), F.col("l_shipdate").alias("valid_time")
    )
    return grid_summary(grid)


@workload("""
WITH p AS (SELECT DISTINCT CAST(user_id AS VARCHAR) AS series, date_trunc('hour', ts) AS ts FROM events),
b AS (SELECT series, min(ts) AS lo, max(ts) AS hi FROM p GROUP BY series),
g AS (SELECT series, unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS ts FROM b)
SELECT g.series, g.ts FROM g ANTI JOIN p ON p.series = g.series AND p.ts = g.ts""")
def missing_steps(spark, d):
    """The missing hours of every user themselves."""
    events = table(spark, d, "events").select(F.col("user_id").cast("string").alias("user"), floor_to("ts", "hour").alias("ts"))
    return quality.missing_steps(events, "user", "ts", "hour")
