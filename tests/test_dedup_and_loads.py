import datetime as dt

import pytest
from pyspark.sql import functions as F

from voltline.functions.timeutil import ntz
from voltline.operators.dedup import keep_first, keep_last, trim_trailing_nulls
from voltline.plans import incremental as inc
from voltline.schemas import SERIES, struct
from voltline.sources import sinks

from .conftest import day, rows, ts

H = dt.timedelta(hours=1)


def series(spark, data):
    return spark.createDataFrame([(s, ts(t), v) for s, t, v in data], SERIES)


@pytest.mark.parametrize("partitions", [1, 7])
def test_keep_first_and_last_ignore_physical_order(spark, partitions):
    data = [("a", 1, 1.0, "x"), ("a", 3, None, "z"), ("a", 2, 2.0, "y"), ("b", 5, 5.0, "q")]
    df = spark.createDataFrame(data, "k string, n int, v double, t string").repartition(partitions)
    assert rows(keep_last(df, ["k"], "n")) == [("a", 3, None, "z"), ("b", 5, 5.0, "q")]
    assert rows(keep_first(df, ["k"], ["n"])) == [("a", 1, 1.0, "x"), ("b", 5, 5.0, "q")]
    assert rows(keep_last(df.drop("t"), ["k"], "n")) == [("a", 3, None), ("b", 5, 5.0)]


def test_trailing_nulls(spark):
    df = series(spark, [
        ("a", "2024-01-01 00:00", 1.0), ("a", "2024-01-01 01:00", None), ("a", "2024-01-01 02:00", 2.0), ("a", "2024-01-01 03:00", None),
        ("b", "2024-01-01 00:00", None),
    ])
    kept = trim_trailing_nulls(df, ["series"], "ts", "value")
    assert [r["ts"].hour for r in kept.orderBy("ts").collect()] == [0, 1, 2]
    assert trim_trailing_nulls(df.filter("series = 'b'"), [], "ts", "value").count() == 0


def test_new_null_overwrites_unless_told_otherwise(spark):
    old = series(spark, [("a", "2024-01-01 00:00", 1.0), ("a", "2024-01-01 01:00", 2.0)])
    new = series(spark, [("a", "2024-01-01 01:00", None), ("a", "2024-01-01 02:00", 3.0)])
    merged = inc.merge_last_wins(old, new, ["series", "ts"])
    assert [r["value"] for r in merged.orderBy("ts").collect()] == [1.0, None, 3.0]
    kept = inc.merge_last_wins(old, new, ["series", "ts"], prefer_non_null=["value"])
    assert [r["value"] for r in kept.orderBy("ts").collect()] == [1.0, 2.0, 3.0]


def test_arrival_orders_duplicates_inside_a_batch(spark):
    old = series(spark, [("a", "2024-01-01 00:00", 1.0)])
    new = series(spark, [("a", "2024-01-01 00:00", 8.0), ("a", "2024-01-01 00:00", 9.0)]).withColumn("n", F.col("value").cast("int"))
    assert inc.merge_last_wins(old, new, ["series", "ts"], arrival="n").first()["value"] == 9.0


def test_new_series_starts_at_the_default(spark):
    old = series(spark, [("a", "2024-01-02 00:00", 1.0)])
    src = series(spark, [("a", "2024-01-01 00:00", 7.0), ("a", "2024-01-02 01:00", 2.0), ("b", "2023-12-31 00:00", 5.0), ("b", "2024-01-01 00:00", 6.0)])
    got = inc.load_since_watermark(old, src, ["series"], "ts", inc.next_hour, ntz("2024-01-01"))
    assert rows(got) == [("a", ts("2024-01-02 00:00"), 1.0), ("a", ts("2024-01-02 01:00"), 2.0), ("b", ts("2024-01-01 00:00"), 6.0)]


def test_rules(spark):
    mark = ntz("2024-03-15 07:30:00")
    got = spark.range(1).select(inc.next_hour(mark), inc.next_day(mark), inc.lookback(14, ntz("2014-01-01"))(mark), inc.lookback(14, ntz("2024-03-10"))(mark), inc.month_restart(mark)).first()
    assert list(got) == [ts("2024-03-15 08:30"), ts("2024-03-16 07:30"), ts("2024-03-01 00:00"), ts("2024-03-10 00:00"), ts("2024-03-01 00:00")]


def hourly(spark, start, n, value=lambda i: float(i), name="a"):
    t = ts(start)
    return spark.createDataFrame([(name, t + i * H, value(i)) for i in range(n)], SERIES)


def table_of(spark, folder):
    return inc.PartitionedTable(spark, f"{folder}/t", struct(SERIES), ["series"])


def test_table_load_is_idempotent_and_touches_only_new_months(spark, folder):
    table = table_of(spark, folder)
    source = hourly(spark, "2024-01-30 00:00", 24 * 5)
    table.load(source.filter("ts < timestamp_ntz'2024-02-01 12:00:00'"), inc.next_hour, day("2015-01-01"))
    assert table.months() == ["2024-01", "2024-02"] and table.watermark() == ts("2024-02-01 11:00")
    january = {f["path"] for f in _files(spark, table.path, "2024-01")}
    assert table.load(source, inc.next_hour, day("2015-01-01")) == ts("2024-02-01 12:00")
    first = rows(table.read())
    assert len(first) == 120
    table.load(source, inc.next_hour, day("2015-01-01"))
    assert rows(table.read()) == first
    assert {f["path"] for f in _files(spark, table.path, "2024-01")} == january


def _files(spark, path, month):
    return spark.read.format("binaryFile").load(f"{path}/month={month}").select("path").collect()


def test_rolling_refetch_heals_inner_gaps_and_trims_the_tail(spark, folder):
    table = table_of(spark, folder)
    first = hourly(spark, "2024-01-01 00:00", 24 * 20, lambda i: None if 240 <= i < 264 or i >= 460 else float(i))
    rule = inc.lookback(14, ntz("2014-01-01"))
    table.load(first, rule, day("2014-01-01"), trim="value")
    assert table.watermark() == ts("2024-01-01 00:00") + 459 * H
    second = hourly(spark, "2024-01-01 00:00", 24 * 20, lambda i: -1.0 if i < 240 else (None if i >= 470 else float(i)))
    start = table.load(second, rule, day("2014-01-01"), trim="value")
    assert start == ts("2024-01-06 00:00")
    got = {r["ts"]: r["value"] for r in table.read().collect()}
    assert len(got) == 470 and got[ts("2024-01-01 05:00")] == 5.0 and got[ts("2024-01-06 00:00")] == -1.0 and got[ts("2024-01-11 03:00")] == 243.0


def test_month_that_turns_blank_disappears(spark, folder):
    table = table_of(spark, folder)
    table.merge(hourly(spark, "2024-01-30 00:00", 24 * 4), trim="value")
    assert table.months() == ["2024-01", "2024-02"]
    table.merge(hourly(spark, "2024-02-01 00:00", 24 * 2, lambda i: None), trim="value")
    assert table.months() == ["2024-01"] and table.watermark() == ts("2024-01-31 23:00")


def test_blank_slice_is_trimmed_into_older_months(spark, folder):
    table = table_of(spark, folder)
    table.merge(hourly(spark, "2024-01-31 20:00", 6, lambda i: None if i in (2, 3) else float(i)))
    table.merge(hourly(spark, "2024-02-01 00:00", 2, lambda i: None), trim="value")
    assert table.watermark() == ts("2024-01-31 21:00")


def test_replace_table_may_read_what_it_replaces(spark, folder):
    path = f"{folder}/r"
    sinks.replace_table(hourly(spark, "2024-01-01 00:00", 5), path)
    sinks.replace_table(spark.read.parquet(path).filter("value > 2"), path)
    assert sorted(r["value"] for r in spark.read.parquet(path).collect()) == [3.0, 4.0]


def test_parts_are_final_once_written(spark, folder):
    path = f"{folder}/p"
    data = spark.createDataFrame([("1980-1989", 1), ("1990-1999", 2)], "decade string, v int")
    assert sinks.write_missing_parts(data.limit(1), path, "decade") == ["1980-1989"]
    assert sinks.write_missing_parts(data.withColumn("v", F.col("v") * 10), path, "decade") == ["1990-1999"]
    assert rows(spark.read.parquet(path).select("decade", "v")) == [("1980-1989", 1), ("1990-1999", 20)]
    assert sinks.write_missing_parts(data, path, "decade") == []
    stored = spark.read.parquet(path)
    expected = spark.createDataFrame([("1980-1989",), ("2000-2009",)], "decade string")
    assert rows(sinks.missing_parts(expected, stored, ["decade"])) == [("2000-2009",)]


def test_late_row_rewrites_one_month(spark, folder):
    table = table_of(spark, folder)
    table.merge(hourly(spark, "2023-01-01 00:00", 24 * 150, name="a"))
    before = {m: {f["path"] for f in _files(spark, table.path, m)} for m in table.months()}
    late = spark.createDataFrame([("b", ts("2023-02-10 00:00"), 1.0)], SERIES)
    assert table.merge(late) == {"2023-02"} and table.merge(late.limit(0)) == set()
    after = {m: {f["path"] for f in _files(spark, table.path, m)} for m in table.months()}
    assert [m for m in before if before[m] != after[m]] == ["2023-02"]
    assert table.read().count() == 24 * 150 + 1


def test_rows_without_time_are_refused(spark, folder):
    table = table_of(spark, folder)
    table.merge(hourly(spark, "2023-01-01 00:00", 5))
    with pytest.raises(ValueError, match="without ts"):
        table.merge(spark.createDataFrame([("a", None, 1.0)], SERIES))
    assert table.months() == ["2023-01"] and table.read().count() == 5
    parts = spark.createDataFrame([("x", 1), (None, 2)], "p string, v int")
    for _ in range(2):
        with pytest.raises(ValueError, match="without p"):
            sinks.write_missing_parts(parts, f"{folder}/q", "p")
        sinks.write_missing_parts(parts.filter("p IS NOT NULL"), f"{folder}/q", "p")


def test_swap_that_broke_off_loses_nothing(spark, folder, monkeypatch):
    table = table_of(spark, folder)
    table.merge(hourly(spark, "2023-01-01 00:00", 24 * 80))
    stored = rows(table.read())
    for stop in range(1, 7):
        moves, move = [], sinks._move

        def broken(fs, source, target):
            if len(moves) == stop:
                raise OSError("power cut")
            moves.append(source)
            move(fs, source, target)

        with monkeypatch.context() as m:
            m.setattr(sinks, "_move", broken)
            try:
                table.merge(hourly(spark, "2023-01-01 00:00", 24 * 80, lambda i: float(i)))
            except OSError:
                pass
        sinks.recover_partitions(spark, table.path)
        assert rows(table.read()) == stored
    path = f"{folder}/whole"
    sinks.replace_table(hourly(spark, "2024-01-01 00:00", 5), path)

    def second(fs, source, target, seen=[]):
        seen.append(source)
        if len(seen) == 2:
            raise OSError("power cut")
        move(fs, source, target)

    with monkeypatch.context() as m:
        m.setattr(sinks, "_move", second)
        with pytest.raises(OSError):
            sinks.replace_table(hourly(spark, "2024-01-01 00:00", 9), path)
    sinks.recover_table(spark, path)
    assert spark.read.parquet(path).count() == 5


# --- pointer and summaries ------------------------------------------------------------


def test_a_run_is_seen_whole_or_not_at_all(spark, folder, monkeypatch):
    """Whatever step a run over several months breaks off at, readers see the state before it or the one after."""
    table = table_of(spark, folder)
    table.merge(hourly(spark, "2023-01-01 00:00", 24 * 80))
    old = rows(table.read())
    new = [(s, t, v + 1000) for s, t, v in old]
    steps = ["write_parts", "part_folder", "publish", "_move", "clean_parts"]
    for name in steps:
        for after in (False, True):
            real, calls = getattr(sinks, name), []

            def broken(*args, real=real, calls=calls, after=after, **options):
                if after:
                    real(*args, **options)
                calls.append(args)
                raise OSError("power cut")

            with monkeypatch.context() as m:
                m.setattr(sinks, name, broken)
                with pytest.raises(OSError, match="power cut"):
                    table.merge(hourly(spark, "2023-01-01 00:00", 24 * 80, lambda i: i + 1000.0))
            published = (name, after) in (("publish", True), ("_move", True), ("clean_parts", False), ("clean_parts", True))
            assert rows(table.read()) == (new if published else old), (name, after)
            assert table.summaries().agg(F.sum("row_count")).first()[0] == 24 * 80
            if published:
                table.merge(hourly(spark, "2023-01-01 00:00", 24 * 80))
    sinks.recover_partitions(spark, table.path)
    assert rows(table.read()) == old
    assert not [f for f in sinks.pointer(spark, table.path).parts if len(sinks.partitions(spark, f"{table.path}/month={f}", "run")) > 2]


def test_a_part_removed_on_purpose_stays_away(spark, folder):
    table = table_of(spark, folder)
    table.merge(hourly(spark, "2023-01-01 00:00", 24 * 40))
    state = sinks.pointer(spark, table.path)
    sinks.publish(spark, table.path, state, {m: r for m, r in state.parts.items() if m != "2023-01"})
    sinks.recover_partitions(spark, table.path)
    assert table.months() == ["2023-02"] and table.watermark() == ts("2023-02-09 23:00")


def test_two_writers(spark, folder):
    table = table_of(spark, folder)
    table.merge(hourly(spark, "2023-01-01 00:00", 5))
    state = sinks.pointer(spark, table.path)
    table.merge(hourly(spark, "2023-01-02 00:00", 5))
    with pytest.raises(OSError, match="another run"):
        sinks.publish(spark, table.path, state, {})
    assert table.read().count() == 10


def test_readers_of_the_state_before_go_on(spark, folder):
    table = table_of(spark, folder)
    table.merge(hourly(spark, "2023-01-01 00:00", 5))
    reader = table.read()
    table.merge(hourly(spark, "2023-01-01 00:00", 5, lambda i: -1.0))
    assert [r["value"] for r in reader.orderBy("ts").collect()] == [0.0, 1.0, 2.0, 3.0, 4.0]


def spoil(spark, table, keep):
    """Put garbage in place of all data files but those of the months in `keep`."""
    import glob

    for path in glob.glob(f"{table.path}/month=*/run=*/*.parquet"):
        if not any(f"month={m}/" in path for m in keep):
            with open(path, "wb") as f:
                f.write(b"not a table")


def test_a_load_opens_no_other_months_data(spark, folder):
    """Loads, watermarks, trims and reports work where the data files of all other months are unreadable."""
    table = table_of(spark, folder)
    both = hourly(spark, "2023-01-01 00:00", 24 * 150).unionByName(hourly(spark, "2023-02-01 00:00", 24 * 10, name="b"))
    table.merge(both)
    marks = spark.createDataFrame(table.watermarks().toArrow(), "series STRING, mark TIMESTAMP_NTZ")
    spoil(spark, table, {"2023-05"})
    with pytest.raises(Exception):
        table.read().collect()
    assert table.watermark() == ts("2023-05-30 23:00")
    assert rows(table.watermarks()) == [("a", ts("2023-05-30 23:00")), ("b", ts("2023-02-10 23:00"))]
    # a goes on within its month; b after a pause; the tail without values is cut
    source = hourly(spark, "2023-05-30 12:00", 24 * 20, lambda i: None if i >= 24 * 15 else float(i)).unionByName(hourly(spark, "2023-05-01 00:00", 30, name="b"))
    start = table.load(source, inc.next_hour, day("2015-01-01"), trim="value", whole_block=True)
    assert start == ts("2023-05-31 00:00") and table.months() == [f"2023-0{i}" for i in range(1, 7)]
    assert table.trimmed == 24 * 5
    report = table.report(marks, details=True)
    assert report.columns == ["row_count", "new_rows", "min_ts", "max_ts", "trimmed_rows", "month_count"]
    assert rows(report) == [(24 * 160 + 24 * 15 - 12 + 30, 24 * 15 - 12 + 30, ts("2023-01-01 00:00"), ts("2023-06-14 11:00"), 24 * 5, 6)]


def test_reports_from_summaries_equal_counts_of_rows(spark, folder):
    from voltline.operators.quality import run_report

    table = table_of(spark, folder)
    table.merge(hourly(spark, "2023-01-10 00:00", 24 * 60).unionByName(hourly(spark, "2023-02-01 05:00", 24 * 20, name="b")))
    for mark in ("2022-01-01 00:00", "2023-01-10 00:00", "2023-02-10 07:00", "2023-03-10 23:00", "2024-01-01 00:00"):
        assert rows(table.report(mark=ntz(mark))) == rows(run_report(table.read(), "ts", ntz(mark))), mark
    assert rows(table.report()) == rows(run_report(table.read(), "ts"))
    empty = inc.PartitionedTable(spark, f"{folder}/none", struct(SERIES), ["series"])
    assert rows(empty.report()) == [(0, 0, None, None)] and empty.watermark() is None and empty.watermarks().count() == 0


def test_stored_months_are_sorted(spark, folder):
    table = table_of(spark, folder)
    table.merge(hourly(spark, "2023-01-01 00:00", 24 * 40).unionByName(hourly(spark, "2023-01-05 00:00", 50, name="b")).repartition(7))
    for month, run in table.parts().items():
        files = spark.read.format("binaryFile").load(sinks.part_folder(table.path, "month", month, run)).select("path").collect()
        for f in files:
            stored = [(r["series"], r["ts"]) for r in spark.read.parquet(f["path"]).collect()]
            assert stored == sorted(stored)
