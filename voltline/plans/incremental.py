"""Loads whose progress mark is read off the target itself.

No side table records how far a load has come: every run asks the target for its
latest time stamp, fetches what that implies, and merges last-write-wins. A
failed, repeated or skipped run therefore heals by itself, and a second run over
the same input changes nothing.

The functions come in two layers. `merge_*` and the rules are lazy
DataFrame -> DataFrame. `PartitionedTable` applies them to a Parquet target
partitioned by month and touches only the partitions the new rows fall in. What
it has to know of other months is in summaries that are written with each month,
so a run costs what it brings, not what the table holds.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.timeutil import month_of, ntz
from ..operators.coverage import covered_runs
from ..operators.dedup import keep_last, trim_trailing_nulls
from ..sources import sinks

Rule = Callable[[Column], Column]


# --- rules: from a watermark to the start of the next fetch -----------------

def next_hour(watermark: Column) -> Column:
    """Hourly series: continue one hour after the last row."""
    return watermark + F.expr("INTERVAL 1 HOUR")


def next_day(watermark: Column) -> Column:
    """Daily series: continue the day after the last row."""
    return watermark + F.expr("INTERVAL 1 DAY")


def lookback(days: int, floor: Column) -> Rule:
    """Fetch the last `days` days again, since late values arrive out of order."""
    return lambda watermark: F.greatest(F.date_sub(watermark.cast("date"), days), floor.cast("date")).cast("timestamp_ntz")


def month_restart(watermark: Column) -> Column:
    """Fetch the month of the last row again from its first day."""
    return month_of(watermark).cast("timestamp_ntz")


# --- lazy merges -------------------------------------------------------------

def merge_last_wins(
    existing: DataFrame, incoming: DataFrame, keys: list[str], arrival: str | None = None, prefer_non_null: list[str] = (),
) -> DataFrame:
    """Existing rows, then incoming ones; the last arrival per key stays.

    An incoming NULL replaces an older value, except in `prefer_non_null` columns.
    `arrival` orders duplicates inside `incoming`; without it they must not occur.
    """
    columns = existing.columns
    rank = F.col(arrival).cast("bigint") if arrival else F.lit(0).cast("bigint")
    old = existing.select(*columns, F.lit(-1).cast("bigint").alias("_seq"))
    new = incoming.select(*columns, rank.alias("_seq"))
    rows = old.unionByName(new)
    if not prefer_non_null:
        return keep_last(rows, keys, "_seq").select(*columns)
    values = [c for c in columns if c not in keys]
    picked = [
        F.max_by(c, F.when(F.col(c).isNotNull(), F.col("_seq")) if c in prefer_non_null else F.col("_seq")).alias(c)
        for c in values
    ]
    return rows.groupBy(*keys).agg(*picked).select(*columns)


def load_since_watermark(
    existing: DataFrame, source: DataFrame, series: list[str], ts: str, rule: Rule, default_start: Column,
    arrival: str | None = None, trim: str | None = None, prefer_non_null: list[str] = (),
) -> DataFrame:
    """One incremental run over all series: watermark, fetch, merge, trim.

    The start is `rule(max(ts))` per series, or `default_start` for a new series.
    Rows before the start cannot change, so they bypass the merge; only the slice
    that the fetch overlaps is shuffled by key.
    """
    marks = existing.groupBy(*series).agg(F.max(ts).alias("_mark")).select(*series, rule(F.col("_mark")).alias("_since"))
    if series:
        since = F.coalesce("_since", default_start)
        tagged_old = existing.join(marks, series, "left")
        tagged_new = source.join(marks, series, "left")
    else:
        tagged_old, tagged_new = existing, source
        since = F.coalesce(marks.select("_since").scalar(), default_start)
    columns = existing.columns
    untouched = tagged_old.filter(F.col(ts) < since).select(*columns)
    overlapping = tagged_old.filter(F.col(ts) >= since).select(*columns)
    fetched = tagged_new.filter(F.col(ts) >= since).select(*columns, *([arrival] if arrival else []))
    merged = untouched.unionByName(
        merge_last_wins(overlapping, fetched, [*series, ts], arrival, prefer_non_null)
    )
    return trim_trailing_nulls(merged, series, ts, trim) if trim else merged


# --- a Parquet target ----------------------------------------------------------

@dataclass
class PartitionedTable:
    """A Parquet table of series in months; only touched months are rewritten.

    A run writes months into new folders and then makes them the table's state by
    publishing one small pointer file (`sources/sinks.py`): readers see all of a run or
    nothing, and a run that breaks off changes nothing. With each month goes a summary
    per series (first and last stamp, rows, and for each value column the last stamp with
    a value), which watermarks, trims and reports read in place of the data; tables with a
    `step` keep covered runs for the checks in the same way.
    """

    spark: SparkSession
    path: str
    schema: T.StructType
    series: list[str] = field(default_factory=list)
    ts: str = "ts"
    #: With a step, each month also keeps the runs of steps that its rows cover.
    step: str | None = None
    #: Rows that the last merge cut off as trailing NULLs.
    trimmed: int = field(default=0, init=False)

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()

    @property
    def _summary_schema(self) -> T.StructType:
        stamp = self.schema[self.ts].dataType
        keys = [self.schema[c] for c in self.series]
        valid = [T.StructField(f"valid_{c}", stamp) for c in self.columns if c not in (*self.series, self.ts)]
        return T.StructType([*keys, T.StructField("first_ts", stamp), T.StructField("last_ts", stamp), T.StructField("row_count", T.LongType()), *valid])

    def parts(self) -> dict[str, str]:
        """The folder of each month, as published."""
        return sinks.pointer(self.spark, self.path).parts

    def months(self) -> list[str]:
        return sorted(self.parts())

    def _folders(self, root: str, schema: T.StructType, parts: dict[str, str]) -> DataFrame:
        stored = T.StructType([*schema.fields, T.StructField("month", T.StringType()), T.StructField("run", T.StringType())])
        if not parts:
            return self.spark.createDataFrame([], stored)
        folders = [sinks.part_folder(root, "month", m, run) for m, run in sorted(parts.items())]
        return self.spark.read.schema(stored).option("basePath", root).parquet(*folders)

    def read(self, from_month: str | None = None, months: set[str] | None = None, parts: dict[str, str] | None = None) -> DataFrame:
        """The table, or its months from `from_month` on, or just `months`: other months' folders are not even listed."""
        parts = self.parts() if parts is None else parts
        wanted = {m: run for m, run in parts.items() if (from_month is None or m >= from_month) and (months is None or m in months)}
        return self._folders(self.path, self.schema, wanted).select(*self.columns)

    def summaries(self, parts: dict[str, str] | None = None) -> DataFrame:
        """`(<series>, first_ts, last_ts, row_count, valid_<column>..., month)`, one row per series and month."""
        parts = self.parts() if parts is None else parts
        return self._folders(f"{self.path.rstrip('/')}/_summary", self._summary_schema, parts).drop("run")

    def runs(self) -> DataFrame:
        """`(<series>, run_start, run_end, row_count, month)`: the covered runs of all months, as kept with them; needs a step."""
        stamps = [T.StructField(n, T.TimestampNTZType()) for n in ("run_start", "run_end")]
        schema = T.StructType([*[self.schema[c] for c in self.series], *stamps, T.StructField("row_count", T.LongType())])
        return self._folders(f"{self.path.rstrip('/')}/_runs", schema, self.parts()).drop("run")

    def watermark(self) -> dt.datetime | dt.date | None:
        """Latest time stamp, from the newest month's summary."""
        parts = self.parts()
        newest = dict([max(parts.items())]) if parts else {}
        return self.summaries(newest).agg(F.max("last_ts")).first()[0]

    def watermarks(self) -> DataFrame:
        """Latest time stamp per series, as `(<series>, mark)`, from the summaries."""
        return self.summaries().groupBy(*self.series).agg(F.max("last_ts").alias("mark"))

    def report(self, marks: DataFrame | None = None, mark: Column | None = None, details: bool = False) -> DataFrame:
        """One row: rows, rows newer than the mark (of their series, if `marks` are given), first and last time stamp.

        Without a mark all rows are new. The figures come from the summaries; data are read only
        for months in which a series has rows on both sides of its mark. `details` adds the rows
        that the last merge trimmed and the number of months.
        """
        parts = self.parts()
        known = self.summaries(parts)
        known = known.join(marks, self.series, "left") if marks is not None else known.withColumn("mark", mark if mark is not None else F.lit(None))
        split = (F.col("first_ts") <= F.col("mark")) & (F.col("last_ts") > F.col("mark"))
        opened = {r["month"] for r in known.filter(split).select("month").distinct().collect()}  # month names
        inside = F.lit(0).cast("bigint")
        if opened:
            rows = self.read(months=opened, parts=parts)
            rows = rows.join(marks, self.series) if marks is not None else rows.withColumn("mark", mark)
            same_month = F.date_format(self.ts, "yyyy-MM") == F.date_format("mark", "yyyy-MM")
            inside = rows.filter((F.col(self.ts) > F.col("mark")) & same_month).agg(F.count("*").alias("n")).scalar()
        whole = F.sum(F.when(F.col("mark").isNull() | (F.col("first_ts") > F.col("mark")), F.col("row_count")))
        row = known.agg(
            F.coalesce(F.sum("row_count"), F.lit(0)).alias("row_count"), F.coalesce(whole, F.lit(0)).alias("whole"),
            F.min("first_ts").alias("min_ts"), F.max("last_ts").alias("max_ts"), F.count_distinct("month").alias("month_count"),
        ).withColumn("new_rows", F.col("whole") + inside)
        more = [F.lit(self.trimmed).cast("bigint").alias("trimmed_rows"), F.col("month_count")] if details else []
        return row.select("row_count", "new_rows", "min_ts", "max_ts", *more)

    def load(
        self, source: DataFrame, rule: Rule, default_start: dt.date | dt.datetime, arrival: str | None = None,
        trim: str | None = None, prefer_non_null: list[str] = (), whole_block: bool = False,
    ) -> dt.datetime:
        """Run one incremental load; returns the start that was used.

        `whole_block` also merges source rows older than the start (sources that
        deliver whole blocks); otherwise they are filtered out.
        """
        mark = self.watermark()
        start = _evaluate(self.spark, rule, mark) if mark is not None else _midnight(default_start)
        fetched = source if whole_block else source.filter(F.col(self.ts) >= ntz(start))
        self.merge(fetched, arrival, trim, prefer_non_null)
        return start

    def merge(self, incoming: DataFrame, arrival: str | None = None, trim: str | None = None, prefer_non_null: list[str] = ()) -> set[str]:
        """Last-write-wins merge of `incoming` into the months its rows fall in; returns the months that were rewritten.

        `incoming` is computed once, into a hidden folder by month, whose listing says
        which months are touched. Rows without a time stamp raise. With `trim`, rows
        after a series' last value go, which the summaries show; only if a correction
        has blanked that value are older months rewritten too.
        """
        before = sinks.pointer(self.spark, self.path)
        landed = f"{self.path.rstrip('/')}/_incoming_{uuid.uuid4().hex}"
        incoming.withColumn("month", F.date_format(self.ts, "yyyy-MM")).write.partitionBy("month").parquet(landed)
        self.trimmed = 0
        try:
            touched = sinks.partitions(self.spark, landed, "month")
            if sinks.NULL_PART in touched:
                raise ValueError(f"rows without {self.ts} can't be stored")
            if touched:
                stored = T.StructType([*incoming.schema.fields, T.StructField("month", T.StringType())])
                fresh = self.spark.read.schema(stored).parquet(landed).drop("month")
                merged = merge_last_wins(self.read(months=touched, parts=before.parts), fresh, [*self.series, self.ts], arrival, prefer_non_null)
                parts = self._written(merged, before.parts, touched)
                if trim:
                    parts, cut = self._trimmed(parts, trim)
                    touched = touched | cut
                sinks.publish(self.spark, self.path, before, parts)
                sinks.clean_parts(self.spark, self.path, "month", touched)
            return touched
        finally:
            sinks.remove(self.spark, landed)

    def _written(self, rows: DataFrame, parts: dict[str, str], months: set[str]) -> dict[str, str]:
        """Write `months` as `rows` have them, with their summaries; returns `parts` with the new folders."""
        # rebalance, not repartition: AQE splits a month that a dominant series makes too big
        rows = rows.withColumn("month", F.date_format(self.ts, "yyyy-MM")).hint("rebalance", "month")
        fresh = sinks.write_parts(rows, self.path, "month", months, [*self.series, self.ts])
        values = [c for c in self.columns if c not in (*self.series, self.ts)]
        summary = self._folders(self.path, self.schema, fresh).groupBy(*self.series, "month", "run").agg(
            F.min(self.ts).alias("first_ts"), F.max(self.ts).alias("last_ts"), F.count("*").alias("row_count"),
            *[F.max(F.when(F.col(c).isNotNull(), F.col(self.ts))).alias(f"valid_{c}") for c in values],
        )
        summary.hint("rebalance", "month").write.mode("append").partitionBy("month", "run").parquet(f"{self.path.rstrip('/')}/_summary")
        if self.step:
            runs = covered_runs(self._folders(self.path, self.schema, fresh), [*self.series, "month", "run"], self.ts, self.step)
            runs.hint("rebalance", "month").write.mode("append").partitionBy("month", "run").parquet(f"{self.path.rstrip('/')}/_runs")
        return {m: run for m, run in parts.items() if m not in months} | fresh

    def _trimmed(self, parts: dict[str, str], trim: str) -> tuple[dict[str, str], set[str]]:
        """Without rows after each series' last value; returns the new folders and the months that held such rows."""
        known = self.summaries(parts)
        valid = known.groupBy(*self.series).agg(F.max(f"valid_{trim}").alias("_valid"))

        def beside(rows: DataFrame) -> DataFrame:
            return rows.join(valid, self.series) if self.series else rows.withColumn("_valid", valid.select("_valid").scalar())

        late = beside(known).filter(F.col("_valid").isNull() | (F.col("last_ts") > F.col("_valid")))
        cut = {r["month"] for r in late.select("month").distinct().collect()}  # month names
        if not cut:
            return parts, cut
        kept = beside(self.read(months=cut, parts=parts)).filter(F.col(self.ts) <= F.col("_valid")).select(*self.columns)
        after = self._written(kept, parts, cut)
        counts = [self.summaries({m: p[m] for m in cut if m in p}).agg(F.sum("row_count")).first()[0] or 0 for p in (parts, after)]
        self.trimmed = counts[0] - counts[1]
        return after, cut


def _midnight(value: dt.date | dt.datetime) -> dt.datetime:
    return value if isinstance(value, dt.datetime) else dt.datetime.combine(value, dt.time())


def _evaluate(spark: SparkSession, rule: Rule, mark: dt.date | dt.datetime) -> dt.datetime:
    """The rule applied to one literal; Spark folds it, no data is read."""
    return spark.range(1).select(rule(ntz(_midnight(mark))).cast("timestamp_ntz")).first()[0]
