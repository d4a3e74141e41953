"""Intervals to hours, capacity panels, snapshots."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.timeutil import seconds_between
from ..operators.intervals import distribute_to_hours
from ..operators.panels import annual_capacity_panel, capacity_snapshot, monthly_capacity_panel
from ..plans.registry import capacity_by
from .registry import table, workload

# Units: one per order, from its order date to its last shipment (sometimes earlier than the start).
UNITS_SQL = """
SELECT CAST(o.o_orderkey AS VARCHAR) AS unit_id, n.n_name AS region, o.o_orderstatus AS technology, o.o_totalprice AS capacity_mw,
       CAST(o.o_orderdate AS DATE) AS start, CASE WHEN o.o_orderstatus <> 'O' THEN CAST(l.shipped AS DATE) END AS stop
FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey JOIN nation n ON n.n_nationkey = c.c_nationkey
LEFT JOIN (SELECT l_orderkey, max(l_shipdate) AS shipped FROM lineitem GROUP BY 1) l ON l.l_orderkey = o.o_orderkey"""


def order_units(spark, d):
    shipped = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.max("l_shipdate").alias("shipped"))
    customer = table(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("n_nationkey"))
    return (
        table(spark, d, "orders")
        .join(shipped, "o_orderkey", "left")
        .join(customer, "o_custkey")
        .join(table(spark, d, "nation"), "n_nationkey")
        .select(
            F.col("o_orderkey").cast("string").alias("unit_id"),
            F.col("n_name").alias("region"),
            F.col("o_orderstatus").alias("technology"),
            F.col("o_totalprice").alias("capacity_mw"),
            F.col("o_orderdate").cast("date").alias("commissioning_date"),
            F.when(F.col("o_orderstatus") != "O", F.col("shipped").cast("date")).alias("final_shutdown_date"),
        )
    )


@workload("""
WITH i AS (SELECT event_type AS series, ts AS s, ts + to_microseconds(CAST(round((value - 20) * 600) AS BIGINT) * 1000000) AS e, value FROM events),
h AS (SELECT *, unnest(generate_series(date_trunc('hour', s), date_trunc('hour', e - INTERVAL 1 SECOND), INTERVAL 1 HOUR)) AS hour FROM i WHERE e > s)
SELECT series, hour, round(sum(value * (epoch_us(least(e, hour + INTERVAL 1 HOUR)) - epoch_us(greatest(s, hour))) / (epoch_us(e) - epoch_us(s))), 4) AS value
FROM h GROUP BY series, hour""")
def interval_to_hourly(spark, d):
    """Events with a length that grows with their value (zero or negative below 20), spread over hours."""
    length = F.make_dt_interval(secs=F.round((F.col("value") - 20) * 600).cast("decimal(18,6)"))
    intervals = table(spark, d, "events").select("event_type", "ts", (F.col("ts") + length).alias("until"), "value")
    spread = distribute_to_hours(intervals, "ts", "until", "value", ["event_type"])
    return spread.select(F.col("event_type").alias("series"), "hour", F.round("value", 4).alias("value"))


@workload("""
WITH i AS (SELECT o.o_orderdate AS s, l.l_shipdate AS e, l.l_quantity AS v, date_diff('hour', o.o_orderdate, l.l_shipdate) AS hours
           FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey WHERE l.l_shipdate > o.o_orderdate),
x AS (SELECT s AS ts, CAST(v / hours AS DECIMAL(38, 18)) AS rate, 1 AS n FROM i
      UNION ALL SELECT e, -CAST(v / hours AS DECIMAL(38, 18)), -1 FROM i),
t AS (SELECT ts, sum(rate) AS rate, sum(n) AS n FROM x GROUP BY ts),
r AS (SELECT ts, sum(rate) OVER (ORDER BY ts) AS rate, sum(n) OVER (ORDER BY ts) AS n, lead(ts) OVER (ORDER BY ts) AS nxt FROM t)
SELECT unnest(generate_series(ts, nxt - INTERVAL 1 HOUR, INTERVAL 1 HOUR)) AS hour, round(CAST(rate AS DOUBLE), 4) AS value FROM r WHERE n > 0""")
def interval_to_hourly_long(spark, d):
    """Quantity under way between order and shipment: intervals of weeks to years."""
    orders = table(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate")
    transit = table(spark, d, "lineitem").select("l_orderkey", "l_shipdate", "l_quantity").join(orders, "l_orderkey")
    spread = distribute_to_hours(transit, "o_orderdate", "l_shipdate", "l_quantity")
    return spread.select("hour", F.round("value", 4).alias("value"))


@workload(f"""
WITH u AS ({UNITS_SQL}),
x AS (SELECT region, date_trunc('month', start) AS m, capacity_mw AS c FROM u
      UNION ALL SELECT region, date_trunc('month', stop), -capacity_mw FROM u WHERE stop IS NOT NULL),
g AS (SELECT region, CAST(unnest(generate_series(TIMESTAMP '1995-01-01', TIMESTAMP '2001-08-01', INTERVAL 1 MONTH)) AS DATE) AS m FROM (SELECT DISTINCT region FROM u)),
t AS (SELECT region, m, sum(c) AS c FROM x GROUP BY region, m),
p AS (SELECT g.region, g.m, sum(coalesce(t.c, 0)) OVER (PARTITION BY g.region ORDER BY g.m) AS c FROM g LEFT JOIN t ON t.region = g.region AND t.m = g.m)
SELECT region, last_day(m) AS month, round(c, 2) AS capacity_mw FROM p WHERE m >= DATE '1996-01-01'""")
def monthly_capacity(spark, d):
    """Monthly installed capacity per nation; a shutdown month already counts as off."""
    panel = monthly_capacity_panel(
        order_units(spark, d), ["region"], F.lit("1995-01-01").cast("date"), F.lit("2001-08-01").cast("date"),
        F.lit("1996-01-01").cast("date"),
    )
    return panel.select("region", "month", F.round("capacity_mw", 2).alias("capacity_mw"))


@workload(f"""
WITH u AS ({UNITS_SQL}), y AS (SELECT unnest(generate_series(1995, 2001)) AS year)
SELECT u.region, u.technology, round(sum(u.capacity_mw), 2) AS capacity_mw, count(u.unit_id) AS unit_count, CAST(y.year AS INTEGER) AS year
FROM u, y WHERE u.start <= make_date(y.year, 12, 31) AND (u.stop IS NULL OR u.stop > make_date(y.year, 12, 31)) GROUP BY ALL""")
def annual_capacity(spark, d):
    """Year-end capacity and unit count per nation and status."""
    panel = annual_capacity_panel(order_units(spark, d), ["region", "technology"], F.lit(2001))
    return panel.withColumn("capacity_mw", F.round("capacity_mw", 2))


@workload(f"""
WITH u AS ({UNITS_SQL})
SELECT region, technology, round(sum(capacity_mw), 2) AS capacity_mw FROM u
WHERE start <= DATE '1999-06-30' AND (stop IS NULL OR stop > DATE '1999-06-30') GROUP BY ALL""")
def capacity_at_date(spark, d):
    snapshot = capacity_snapshot(order_units(spark, d), ["region", "technology"], F.lit("1999-06-30").cast("date"))
    return snapshot.withColumn("capacity_mw", F.round("capacity_mw", 2))


@workload(f"WITH u AS ({UNITS_SQL}) SELECT technology, round(sum(capacity_mw), 0) AS capacity_mw FROM u GROUP BY technology")
def capacity_by_technology(spark, d):
    """The capacity report that goes with the events table."""
    return capacity_by(order_units(spark, d), ["technology"])


@workload("""
SELECT l_orderkey, l_linenumber, l_partkey, CAST(epoch_us(l_shipdate) - epoch_us(o_orderdate) AS DOUBLE) / 1e6 AS seconds
FROM lineitem JOIN orders ON o_orderkey = l_orderkey""")
def elapsed_seconds(spark, d):
    orders = table(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate")
    return table(spark, d, "lineitem").join(orders, "l_orderkey").select(
        "l_orderkey", "l_linenumber", "l_partkey", seconds_between("o_orderdate", "l_shipdate").alias("seconds")
    )
