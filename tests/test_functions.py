import pytest
from pyspark.sql import functions as F

from voltline.functions import classify, values
from voltline.functions import timeutil as tu

from .conftest import day, rows, ts


def one(spark, *columns):
    return tuple(spark.range(1).select(*columns).first())


def column(spark, data, ddl, *columns):
    return [tuple(r) for r in spark.createDataFrame(data, ddl).select(*columns).collect()]


def test_floor_does_not_depend_on_the_session_zone(spark):
    stamp = tu.ntz("2023-03-26 02:37:11")  # a wall clock time that does not exist in Berlin
    try:
        spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
        got = one(spark, tu.floor_to(stamp, "hour"), tu.floor_to(stamp, "quarter_hour"), tu.floor_to(stamp, "day"))
        gap = one(spark, tu.seconds_between(tu.ntz("2023-03-26 00:00:00"), tu.ntz("2023-03-26 12:00:00.5")))[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == (ts("2023-03-26 02:00:00"), ts("2023-03-26 02:30:00"), ts("2023-03-26 00:00:00"))
    assert gap == 43200.5


def test_repeated_autumn_hour_is_exact(spark):
    data = [("29.10.2023", "02:30", "CEST"), ("29.10.2023", "02:30", "CET"), ("26.03.2023", "01:45", "CET"), ("26.03.2023", "03:00", "CEST")]
    got = column(spark, data, "d string, c string, z string", tu.wall_clock_to_utc(tu.german_stamp("d", "c"), "z"))
    assert [r[0] for r in got] == [ts("2023-10-29 00:30"), ts("2023-10-29 01:30"), ts("2023-03-26 00:45"), ts("2023-03-26 01:00")]


def test_unknown_label_raises_or_becomes_null(spark):
    df = spark.createDataFrame([("XYZ",), (None,)], "z string")
    local = tu.ntz("2023-01-01 00:00:00")
    assert rows(df.select(tu.wall_clock_to_utc(local, "z", on_unknown="null"))) == [(None,), (None,)]
    with pytest.raises(Exception, match="unknown time zone label: XYZ"):
        df.filter("z is not null").select(tu.wall_clock_to_utc(local, "z")).collect()


def test_dates_and_epochs(spark):
    got = column(spark, [("2015",), ("2022-07-01",), ("kaputt",), (None,)], "t string", tu.lenient_date("t"))
    assert [r[0] for r in got] == [day("2015-01-01"), day("2022-07-01"), None, None]
    assert one(spark, tu.epoch_millis_to_utc(F.lit(1679797800123)))[0] == ts("2023-03-26 02:30:00.123000")
    assert one(spark, tu.shift_hours(tu.ntz("2020-01-01 00:00:00"), -1))[0] == ts("2019-12-31 23:00")


def test_windows(spark):
    bounds = spark.createDataFrame([(day("2019-06-15"), day("2021-01-01")), (day("2020-01-01"), day("2020-01-01"))], "lo date, hi date")
    assert rows(tu.year_windows(bounds, "lo", "hi")) == [
        (day("2019-06-15"), day("2020-01-01")), (day("2020-01-01"), day("2021-01-01")),
    ]
    months = tu.month_windows(bounds.limit(1).withColumn("hi", F.lit("2019-08-03").cast("date")), "lo", "hi")
    assert rows(months) == [
        (day("2019-06-15"), day("2019-06-30")), (day("2019-07-01"), day("2019-07-31")), (day("2019-08-01"), day("2019-08-03")),
    ]
    assert [r[0] for r in tu.month_spine(spark, day("2019-11-20"), day("2020-02-01")).collect()] == [
        day("2019-11-01"), day("2019-12-01"), day("2020-01-01"), day("2020-02-01"),
    ]


def test_values(spark):
    data = [("1,5", "DE 1234567", 0.0), (" -2 ", "123456789", float("nan")), ("N.A.", "x", 3.0), ("", None, None)]
    df = spark.createDataFrame(data, "t string, k string, v double")
    got = df.select(values.decimal_comma("t"), values.normalise_key("k"), values.zero_to_null("v"), values.nan_to_null("v")).collect()
    assert [tuple(r)[:2] for r in got] == [(1.5, "01234567"), (-2.0, "123456789"), (None, None), (None, None)]
    assert got[0][2] is None and got[2][2] == 3.0 and got[1][3] is None and got[3][3] is None
    assert one(spark, values.kw_to_mw(F.lit(1500)), values.kelvin_to_celsius(F.lit(273.15)), values.metres_to_mm(F.lit(0.002)), values.per_block_to_per_hour(F.lit(8)), values.wind_speed(F.lit(3.0), F.lit(4.0))) == (1.5, 0.0, 2.0, 2.0, 5.0)
    assert one(spark, values.pad_key(F.lit("42")), values.pad_key(F.lit("123456789"))) == ("00000042", "123456789")


def test_grid_index_rounds_half_to_even_and_clips(spark):
    points = [0.5, 1.5, 2.5, -9.0, 99.0]
    got = column(spark, [(p,) for p in points], "v double", values.grid_index("v", 0.0, 1.0, 5), values.grid_index("v", 4.0, -1.0, 5))
    assert [r[0] for r in got] == [0, 2, 2, 0, 4]
    assert [r[1] for r in got] == [4, 2, 2, 4, 0]
    with pytest.raises(ValueError):
        values.grid_index("v", 0.0, 0.0, 5)


@pytest.mark.parametrize(
    "name, expected",
    [
        ("OWP Alpha", "offshore_wind"), ("Borkum Offshore", "offshore_wind"), ("UW Büttel", "offshore_wind"), ("UW Büttel 2", "ambiguous"),
        ("PV Nord", "pv"), ("Park PV Süd", "pv"), ("Photovoltaik X", "pv"), ("PVX", "ambiguous"), ("WP West", "onshore_wind_named"),
        ("Park WP", "onshore_wind_named"), ("Windpark 7", "onshore_wind_named"), ("PV WP Mix", "pv"), (None, "ambiguous"),
    ],
)
def test_entity_names(spark, name, expected):
    assert one(spark, classify.entity_technology(F.lit(name).cast("string")))[0] == expected


def test_directions(spark):
    data = [("Wirkleistungseinspeisung reduzieren",), ("Wirkleistungseinspeisung erh¿hen",), (None,)]
    got = column(spark, data, "d string", classify.measure_direction("d"))
    assert [r[0] for r in got] == ["reduction", "increase", "reduction"]


def test_solar_classes(spark):
    ground = classify.GROUND_MOUNTED
    data = [
        (ground, "Haushalt", "nachgeführt", None, "63"), (ground, None, None, "Nachgeführt", "63"), (ground, None, "Nachgeführt", "nachgeführt", "62"),
        ("Dach", "Haushalt", "nachgeführt", None, "61"), ("Dach", None, None, None, "61"), (None, "Gewerbe", None, None, "60"),
    ]
    df = spark.createDataFrame(data, "i string, s string, o string, t string, want string")
    got = df.select(classify.solar_technology("i", "s", classify.is_tracked("o", "t")).alias("got"), "want").collect()
    assert all(r["got"] == r["want"] for r in got)


def test_feed_in_and_sea(spark):
    data = [("Volleinspeisung", True, "full_feed_in"), ("Teileinspeisung (x)", True, "self_consumption_with_storage"), ("Teileinspeisung", None, "self_consumption_no_storage"), (None, True, "unknown")]
    df = spark.createDataFrame(data, "f string, s boolean, want string")
    assert all(r[0] == r[1] for r in df.select(classify.feed_in_category("f", "s"), "want").collect())
    seas = column(spark, [("DE123", "Nordsee"), (None, "Ostsee"), ("DE9", None)], "n string, s string", classify.region_or_sea("n", "s"))
    assert [r[0] for r in seas] == ["DEZZ-NORDSEE", "DEZZ-OSTSEE", "DE9"]
