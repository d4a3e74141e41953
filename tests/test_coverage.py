"""Checks on covered runs equal the checks on stamps, and need no data of stored months."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from voltline.operators.coverage import covered_runs, gap_check_of_runs, max_gap_of_runs
from voltline.operators.quality import grid_gap_check, max_gap_check
from voltline.plans import incremental as inc
from voltline.plans import jobs
from voltline.schemas import SERIES, struct

from .conftest import rows, ts
from .test_dedup_and_loads import spoil

STEPS = {"hour": dt.timedelta(hours=1), "quarter_hour": dt.timedelta(minutes=15), "day": dt.timedelta(days=1)}


def stamps(step, seed):
    """Series with random gaps over month borders, stamps off the grid, repeated rows, and a single one."""
    rng, out = random.Random(seed), []
    for name in ("a", "b", "c"):
        start = ts("2023-01-29 00:00") + rng.randrange(50) * STEPS[step]
        gone = {rng.randrange(1, 400) for _ in range(rng.choice([0, 5, 60]))} | set(range(90, 90 + rng.randrange(40)))
        out += [(name, start + i * STEPS[step]) for i in range(400) if i not in gone]
        out += [(name, start + i * STEPS[step] + dt.timedelta(minutes=7)) for i in rng.sample(range(400), rng.choice([0, 3]))]
    return [*out, out[3], ("one", ts("2023-02-01 00:00")), ("a", None), (None, ts("2023-02-01 00:00"))]


@pytest.mark.parametrize("step", STEPS)
@pytest.mark.parametrize("seed", range(3))
def test_gap_check_equals_that_of_stamps(spark, step, seed):
    data = stamps(step, seed)
    df = spark.createDataFrame(data, "series string, ts timestamp_ntz")
    rng = random.Random(seed)
    allowed = [(s, t + k * STEPS[step], "why") for s, t in rng.sample([d for d in data if d[0] and d[1]], 25) for k in (-1, 0, 1)] + [("a", ts("2020-01-01 00:00"), "early"), ("z", ts("2023-02-01 00:00"), "none")]
    allowlist = spark.createDataFrame(list(dict.fromkeys(allowed)), "series string, ts timestamp_ntz, reason string")
    months = covered_runs(df.withColumn("month", F.date_format("ts", "yyyy-MM")), ["series", "month"], "ts", step)
    whole = covered_runs(df, ["series"], "ts", step)
    assert months.count() >= whole.count()
    for listed in (None, allowlist):
        want = rows(grid_gap_check(df, "series", "ts", step, listed))
        assert rows(gap_check_of_runs(months, "series", step, listed)) == want == rows(gap_check_of_runs(whole, "series", step, listed))
    if step == "day":
        days = spark.createDataFrame([(s, t.date() if t else None) for s, t in data if s], "series string, day date")
        parts = covered_runs(days.withColumn("month", F.date_format("day", "yyyy-MM")), ["series", "month"], "day", "day")
        assert rows(max_gap_of_runs(parts, "series")) == rows(max_gap_check(days, "series", "day"))


def test_checks_read_no_data(spark, folder):
    """After a second load the check gives what a check of all stamps gives, with every data file unreadable."""
    data = [(s, t, 1.0) for s, t in dict.fromkeys(stamps("hour", 5)) if s and t]
    table = inc.PartitionedTable(spark, folder, struct(SERIES), ["series"], step="hour")
    late = ts("2023-02-10 00:00")
    table.merge(spark.createDataFrame([d for d in data if d[1] < late], SERIES))
    old = dict(table.parts())
    table.merge(spark.createDataFrame([d for d in data if d[1] >= late], SERIES))
    assert [m for m, run in table.parts().items() if old.get(m) == run] == ["2023-01"]
    want = {r[0]: r for r in rows(grid_gap_check(table.read(), "series", "ts", "hour"))}
    spoil(spark, table, set())
    got = {r[0]: tuple(r) for r in jobs.check_market_series(spark, folder, spark.createDataFrame([(n,) for n in want], "series string")).collect()}
    assert {n: (r[1], *r[3:]) for n, r in got.items()} == {n: (r[1], *r[3:]) for n, r in want.items()}
