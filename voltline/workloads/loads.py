"""Incremental loads, de-duplication, missing parts."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.timeutil import floor_to, month_windows, ntz, year_windows
from ..operators.dedup import keep_first, keep_last, trim_trailing_nulls
from ..plans import incremental as inc
from ..sources.sinks import missing_parts as lacking_parts
from .registry import table, workload

_HOURLY = "SELECT event_type AS series, date_trunc('hour', ts) AS ts, round(sum(value), 2) AS value, count(*) AS n FROM events GROUP BY 1, 2"
_DAILY = "SELECT o_orderstatus AS series, o_orderdate AS ts, round(sum(o_totalprice), 2) AS value FROM orders GROUP BY 1, 2"


def _hourly(spark, d):
    return (
        table(spark, d, "events")
        .groupBy(F.col("event_type").alias("series"), floor_to("ts", "hour").alias("ts"))
        .agg(F.round(F.sum("value"), 2).alias("value"), F.count("*").alias("n"))
    )


def _daily(spark, d):
    return (
        table(spark, d, "orders")
        .groupBy(F.col("o_orderstatus").alias("series"), F.col("o_orderdate").alias("ts"))
        .agg(F.round(F.sum("o_totalprice"), 2).alias("value"))
    )


def _merge_sql(base: str, cut: str, since: str, value: str, trim: bool = False) -> str:
    """Existing = rows before `cut`; incoming = all rows with `value`, from `since` on; incoming wins."""
    body = f"""
WITH s AS ({base}),
old AS (SELECT series, ts, value FROM s WHERE ts < TIMESTAMP '{cut}'),
mark AS (SELECT series, max(ts) AS mark FROM old GROUP BY series),
new AS (SELECT s.series, s.ts, {value} AS value FROM s JOIN mark USING (series) WHERE s.ts >= {since}),
r AS (SELECT *, row_number() OVER (PARTITION BY series, ts ORDER BY seq DESC) AS rn
      FROM (SELECT *, 0 AS seq FROM old UNION ALL SELECT *, 1 AS seq FROM new)),
m AS (SELECT series, ts, value FROM r WHERE rn = 1)"""
    if not trim:
        return body + " SELECT series, ts, value FROM m"
    return body + """,
v AS (SELECT series, max(ts) AS last FROM m WHERE value IS NOT NULL GROUP BY series)
SELECT m.series, m.ts, m.value FROM m JOIN v USING (series) WHERE m.ts <= v.last"""


def _run(base, cut, value, rule, start, trim=None):
    rows = base.select("series", "ts", "value")
    existing = rows.filter(F.col("ts") < ntz(cut))
    incoming = base.withColumn("value", value).select("series", "ts", "value")
    return inc.load_since_watermark(existing, incoming, ["series"], "ts", rule, ntz(start), trim=trim)


@workload(_merge_sql(_HOURLY, "2024-01-20", "mark.mark + INTERVAL 1 HOUR", "s.value + 1000"))
def watermark_append(spark, d):
    """Continue one hour after each series' last row; the altered overlap must not come in."""
    return _run(_hourly(spark, d), "2024-01-20", F.col("value") + 1000, inc.next_hour, "2015-01-01")


@workload(_merge_sql(_DAILY, "2000-06-01", "mark.mark + INTERVAL 1 DAY", "s.value + 1000"))
def watermark_append_daily(spark, d):
    return _run(_daily(spark, d), "2000-06-01", F.col("value") + 1000, inc.next_day, "1995-01-01")


_REFETCHED = "CASE WHEN s.ts < TIMESTAMP '2024-01-29 06:00:00' AND s.n % 7 <> 0 THEN s.value * 2 END"


@workload(
    _merge_sql(
        _HOURLY, "2024-01-25", "greatest(date_trunc('day', mark.mark) - INTERVAL 14 DAY, TIMESTAMP '2024-01-05')", _REFETCHED, trim=True
    )
)
def rolling_refetch_merge(spark, d):
    """Fetch 14 days again; corrections win even as NULL, and the unpublished tail is cut."""
    corrected = F.when((F.col("ts") < ntz("2024-01-29 06:00:00")) & (F.col("n") % 7 != 0), F.col("value") * 2)
    rule = inc.lookback(14, ntz("2024-01-05"))
    return _run(_hourly(spark, d), "2024-01-25", corrected, rule, "2024-01-05", trim="value")


@workload(_merge_sql(_DAILY, "2000-06-18", "date_trunc('month', mark.mark)", "-s.value"))
def month_restart_merge(spark, d):
    """Fetch the running month again from its first day."""
    return _run(_daily(spark, d), "2000-06-18", -F.col("value"), inc.month_restart, "1995-01-01")


@workload("""
SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_extendedprice) AS rn FROM lineitem) WHERE rn = 1""")
def dedup_keep_first(spark, d):
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
    return keep_first(lines, ["l_orderkey"], ["l_linenumber", "l_partkey", "l_extendedprice"])


@workload("""
SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber DESC, l_partkey DESC, l_extendedprice DESC) AS rn FROM lineitem) WHERE rn = 1""")
def dedup_keep_last(spark, d):
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
    return keep_last(lines, ["l_orderkey"], ["l_linenumber", "l_partkey", "l_extendedprice"])


@workload("""
WITH u AS (SELECT user_id, ts, event_id, CASE WHEN event_type <> 'error' THEN value END AS value FROM events),
v AS (SELECT user_id, max(ts) AS last FROM u WHERE value IS NOT NULL GROUP BY user_id)
SELECT u.user_id, u.ts, u.event_id, u.value FROM u JOIN v USING (user_id) WHERE u.ts <= v.last""")
def trailing_null_trim(spark, d):
    """Per user: drop what follows the last real value, keep inner NULLs."""
    events = table(spark, d, "events").select(
        "user_id", "ts", "event_id", F.when(F.col("event_type") != "error", F.col("value")).alias("value")
    )
    return trim_trailing_nulls(events, ["user_id"], "ts", "value")


@workload("""
WITH y AS (SELECT unnest(generate_series(1995, 2001)) AS year),
e AS (SELECT c_custkey AS custkey, CAST(year AS INTEGER) AS year FROM customer, y)
SELECT e.custkey, e.year FROM e
WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = e.custkey AND year(o.o_orderdate) = e.year)""")
def missing_parts(spark, d):
    """Which (customer, year) parts does the order table not hold yet?"""
    expected = table(spark, d, "customer").select(
        F.col("c_custkey").alias("custkey"), F.explode(F.sequence(F.lit(1995), F.lit(2001))).alias("year")
    )
    stored = table(spark, d, "orders").select(F.col("o_custkey").alias("custkey"), F.year("o_orderdate").alias("year"))
    return lacking_parts(expected, stored, ["custkey", "year"])


@workload("""
WITH b AS (SELECT o_custkey AS custkey, CAST(min(o_orderdate) AS DATE) AS lo, CAST(max(o_orderdate) AS DATE) AS hi FROM orders GROUP BY 1),
y AS (SELECT custkey, lo, hi, unnest(generate_series(date_trunc('year', lo), hi - INTERVAL 1 DAY, INTERVAL 1 YEAR)) AS y FROM b WHERE lo < hi)
SELECT custkey, greatest(lo, CAST(y AS DATE)) AS window_from, least(hi, CAST(y + INTERVAL 1 YEAR AS DATE)) AS window_to FROM y""")
def year_windows_by_customer(spark, d):
    """Each customer's active range cut at New Year (half-open)."""
    return year_windows(_ranges(spark, d), "lo", "hi")


@workload("""
WITH b AS (SELECT o_custkey AS custkey, CAST(min(o_orderdate) AS DATE) AS lo, CAST(max(o_orderdate) AS DATE) AS hi FROM orders GROUP BY 1),
m AS (SELECT custkey, lo, hi, unnest(generate_series(date_trunc('month', lo), hi, INTERVAL 1 MONTH)) AS m FROM b)
SELECT custkey, greatest(lo, CAST(m AS DATE)) AS window_from, least(hi, CAST(m + INTERVAL 1 MONTH - INTERVAL 1 DAY AS DATE)) AS window_to FROM m""")
def month_windows_by_customer(spark, d):
    """The same ranges cut into calendar months (both ends included)."""
    return month_windows(_ranges(spark, d), "lo", "hi")


def _ranges(spark, d):
    day = F.col("o_orderdate").cast("date")
    return (
        table(spark, d, "orders").groupBy(F.col("o_custkey").alias("custkey")).agg(F.min(day).alias("lo"), F.max(day).alias("hi"))
    )
