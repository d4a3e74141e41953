import datetime as dt

import pytest
from pyspark.sql import functions as F

from voltline.plans import country, fleet, incremental, registry
from voltline.schemas import CAPACITY_EVENTS, SERIES, struct
from voltline.streaming.landing import start_landing

from .conftest import day, rows, ts

T0, T1 = ts("2020-06-01 00:00"), ts("2020-06-01 01:00")


def as_of():
    return F.lit("2020-06-01").cast("date")


def crosswalk(spark):
    return spark.createDataFrame([("01001000", "DEF01"), ("00000012", "DE212")], "municipality_key string, nuts3_code string")


def wind(spark):
    land, sea = "Windkraft an Land", "Windkraft auf See"
    data = [
        ("w1", "01001000", None, 2000.0, "2010-01-01", None, land, 9.0, 54.0),
        ("w2", None, "Nordsee", 6000.0, "2015-01-01", "2019-01-01", sea, 7.0, 54.5),
        ("w3", None, "Ostsee", 6000.0, "2015-01-01", None, sea, 13.0, 54.5),
        ("w4", "99", None, 1000.0, "2010-01-01", None, land, 9.0, 54.0),
        ("w5", "DE 12", None, 0.0, "2010-01-01", None, land, 9.0, 54.0),
        ("w6", "DE 12", None, 500.0, "soon", None, "unknown", None, 54.0),
        ("w7", "DE 12", None, 500.0, "2010-01-01", None, land, None, 54.0),
    ]
    return spark.createDataFrame(data, "unit_id string, municipality_key string, sea_location string, net_capacity_kw double, commissioning_date string, final_shutdown_date string, wind_onshore_or_offshore string, longitude double, latitude double").withColumn("state", F.lit("SH"))


def solar(spark):
    data = [
        ("s1", "01001000", 10.0, "2012-05-05", "Volleinspeisung", "L1", "Haushalt", "Dach"),
        ("s2", "12", 20.0, "2013-05-05", "Teileinspeisung (x)", "L2", "Gewerbe", "Dach"),
        ("s3", "12", 30.0, "2014-05-05", "Teileinspeisung (x)", None, None, "Freiflächensolaranlage"),
    ]
    df = spark.createDataFrame(data, "unit_id string, municipality_key string, net_capacity_kw double, commissioning_date string, feed_in_type string, location_id string, usage_sector string, installation_type string")
    return df.select("*", F.lit(None).cast("string").alias("final_shutdown_date"), F.lit("SH").alias("state"), F.lit(None).cast("double").alias("longitude"), F.lit(None).cast("double").alias("latitude"))


def storage(spark):
    return spark.createDataFrame([("L2",), ("L2",), (None,)], "location_id string")


def test_capacity_events(spark):
    events = registry.capacity_events(wind(spark), solar(spark), crosswalk(spark), storage(spark))
    assert events.columns == struct(CAPACITY_EVENTS).fieldNames()
    got = {r["unit_id"]: (r["region_code"], r["pv_category"], r["capacity_mw"]) for r in events.collect()}
    assert got == {
        "w1": ("DEF01", None, 2.0), "w2": ("DEZZ-NORDSEE", None, 6.0), "w3": ("DEZZ-OSTSEE", None, 6.0), "w7": ("DE212", None, 0.5),
        "s1": ("DEF01", "full_feed_in", 0.01), "s2": ("DE212", "self_consumption_with_storage", 0.02), "s3": ("DE212", "self_consumption_no_storage", 0.03),
    }
    assert rows(registry.offshore_now(events, as_of()), "unit_id") == [("w3",)]
    assert rows(registry.capacity_by(events, ["technology"], digits=2)) == [("solar", 0.06), ("wind", 14.5)]


def test_unit_preparation(spark):
    detail = spark.createDataFrame([("s3", "nachgeführt", None)], "unit_id string, main_orientation string, main_orientation_tilt_bucket string")
    got = registry.solar_units(solar(spark), detail, crosswalk(spark))
    assert rows(got, "unit_id", "nuts2_region", "technology") == [("s1", "DEF0", "61"), ("s2", "DE21", "60"), ("s3", "DE21", "63")]
    assert rows(registry.wind_units(wind(spark)), "unit_id", "siting") == [("w1", "onshore"), ("w2", "offshore"), ("w3", "offshore"), ("w4", "onshore")]


def test_fleet_snapshot_and_blend(spark):
    solar_units = spark.createDataFrame([("60", 1.0), ("61", 3.0)], "technology string, capacity_mw double").select("*", F.lit("2010-01-01").cast("date").alias("commissioning_date"), F.lit(None).cast("date").alias("final_shutdown_date"))
    snapshot = fleet.fleet_snapshot(solar_units, registry.wind_units(wind(spark)), as_of())
    row = snapshot.first().asDict()
    assert [row[f"weight_{t}"] for t in ("60", "61", "62", "63")] == [0.25, 0.75, 0.0, 0.0]
    assert (row["solar_mw"], row["wind_onshore_mw"], row["wind_offshore_mw"], row["as_of"]) == (4.0, 3.0, 6.0, day("2020-06-01"))
    base = spark.createDataFrame([(T0, 0.4, 0.8, 0.1, 0.1, 0.5, 1.0)], "ts timestamp_ntz, solar_60 double, solar_61 double, solar_62 double, solar_63 double, wind_onshore double, wind_offshore double")
    blend = fleet.fleet_weighted(base, snapshot).first()
    assert [round(v, 12) for v in blend[1:]] == [0.7, 0.5, 1.0, 2.8, 1.5, 6.0, 10.3]


def families(spark):
    units = spark.createDataFrame([("a", 10.0, "2020-05-03", None), ("b", 4.0, "2020-01-01", "2020-06-15")], "z string, capacity_mw double, s string, e string").select("z", "capacity_mw", F.col("s").cast("date").alias("commissioning_date"), F.col("e").cast("date").alias("final_shutdown_date"))
    cf = spark.createDataFrame([(ts("2020-05-31 23:00"), "a", 0.5), (ts("2020-05-31 23:00"), "b", 0.5), (T0, "a", 0.5), (T0, "b", 0.5), (T0, "c", None)], "ts timestamp_ntz, z string, cf double")
    other = cf.filter("z = 'a'").withColumn("ts", F.col("ts") + F.expr("INTERVAL 1 HOUR"))
    return [fleet.Family("solar", units, cf, ["z"]), fleet.Family("wind", units, other, ["z"])]


def test_historic_potential_and_current_fleet(spark):
    first, last = F.lit("2020-01-01").cast("date"), F.lit("2020-07-01").cast("date")
    got = rows(fleet.historic_potential(families(spark), first, last, first), "ts", "potential_solar_mw", "potential_wind_mw")
    assert got == [(ts("2020-05-31 23:00"), 7.0, None), (T0, 5.0, 5.0), (T1, None, 5.0)]
    now = rows(fleet.current_fleet_factors(families(spark), as_of()), "ts", "capacity_factor_solar", "capacity_factor_wind")
    assert [(r[1], r[2] and round(r[2], 6)) for r in now] == [(0.5, None), (0.5, round(5 / 14, 6)), (None, round(5 / 14, 6))]
    assert rows(fleet.unmodelled(families(spark)[0], as_of())) == [("c", 0.0)]


def zone(spark, data):
    return spark.createDataFrame(data, "ts timestamp_ntz, zone_id string, cf double")


def test_country_product_has_no_dangling_hours(spark):
    sun = spark.createDataFrame([(T0 - dt.timedelta(hours=1), "DE", "60", 0.1), (T0, "DE", "60", 0.2)], "ts timestamp_ntz, country string, technology string, cf double")
    onshore, offshore = zone(spark, [(T0, "DE01", 0.5), (T1, "DE01", 0.6)]), zone(spark, [(T0, "DE11", 0.7), (T1, "DE11", 0.8), (T0, "FR11", 0.9)])
    mask = spark.createDataFrame([("DE01", 50.0, 5.0, 1.0)], "zone_id string, cell_lat double, cell_lon double, coverage double")
    product = country.country_product(sun, onshore, offshore, mask, country.default_solar_weights(spark))
    assert rows(product) == [(T0, "solar", "DE", 0.2), (T0, "wind_offshore", "DE", 0.7), (T0, "wind_offshore", "FR", 0.9), (T0, "wind_onshore", "DE", 0.5)]
    assert rows(country.country_slice(product, "DE")) == [(T0, 0.5, 0.7, 0.2)]
    with pytest.raises(Exception, match="mask has no zone of wind_offshore"):
        country.technology_base(sun, onshore, offshore, mask, mask).collect()


def test_landing_is_exactly_once_in_effect(spark, folder):
    table = incremental.PartitionedTable(spark, f"{folder}/t", struct(SERIES), ["series"])

    def land(name, data):
        spark.createDataFrame([("a", ts(t), v) for t, v in data], SERIES).coalesce(1).write.mode("append").parquet(f"{folder}/in")

    def run(checkpoint):
        start_landing(spark, f"{folder}/in", struct(SERIES), table, f"{folder}/{checkpoint}").awaitTermination()

    land("1", [("2024-01-01 00:00", 1.0), ("2024-02-01 00:00", 2.0)])
    run("c")
    land("2", [("2024-02-01 00:00", 5.0), ("2024-02-01 01:00", 6.0)])
    run("c")
    want = [("a", ts("2024-01-01 00:00"), 1.0), ("a", ts("2024-02-01 00:00"), 5.0), ("a", ts("2024-02-01 01:00"), 6.0)]
    assert rows(table.read()) == want
    run("c")
    assert rows(table.read()) == want


def test_families_together_equal_families_apart(spark):
    """Shared units and factors are read once; the result is that of separate families, hour by hour."""
    from voltline.plans import fleet

    stamps = [ts(f"2020-0{m}-15 0{h}:00") for m in range(1, 7) for h in range(3)]
    cf = spark.createDataFrame([(t, z, None if z == "z3" or (i + k) % 5 == 0 else 0.1 * (i % 7 + k)) for i, t in enumerate(stamps) for k, z in enumerate(("z1", "z2", "z3"))], "ts timestamp_ntz, z string, cf double")
    units = spark.createDataFrame([("z1", 10.0, "a", "2020-02-01", None), ("z1", 4.0, "b", "2019-01-01", "2020-05-20"), ("z2", 7.0, "a", "2018-01-01", None), ("z9", 5.0, "b", "2018-01-01", None), (None, 3.0, "a", "2018-01-01", None), ("z3", 2.0, "b", "2018-01-01", None)], "z string, capacity_mw double, kind string, s string, e string")
    units = units.select("z", "capacity_mw", "kind", F.col("s").cast("date").alias("commissioning_date"), F.col("e").cast("date").alias("final_shutdown_date"))
    together = [fleet.Family(k, units, cf, ["z"], F.col("kind") == k) for k in "ab"] + [fleet.Family("none", units, cf, ["z"], F.col("kind") == "x")]
    apart = [fleet.Family(f.name, units.filter(f.member), cf.select("*"), ["z"]) for f in together]
    months = [F.lit(x).cast("date") for x in ("2018-01-01", "2020-06-01", "2018-06-01")]
    one, two = (fleet.historic_potential(f, *months) for f in (together, apart))
    assert one.columns == two.columns and rows(one) == rows(two) and one.count() == len(stamps)
    as_of = F.lit("2020-06-01").cast("date")
    one, two = (fleet.current_fleet_factors(f, as_of) for f in (together, apart))
    assert rows(one) == rows(two)
    assert {r["capacity_factor_none"] for r in one.collect()} == {None}


def test_factors_are_scanned_once_for_all_families(spark, folder):
    from voltline.plans import fleet

    spark.createDataFrame([(ts("2020-01-01 00:00"), "z", 0.5)], "ts timestamp_ntz, z string, cf double").write.parquet(f"{folder}/factors")
    spark.createDataFrame([("z", 1.0, "a")], "z string, capacity_mw double, kind string").select("*", F.lit("2018-01-01").cast("date").alias("commissioning_date"), F.lit(None).cast("date").alias("final_shutdown_date")).write.parquet(f"{folder}/units")
    cf, units = spark.read.parquet(f"{folder}/factors"), spark.read.parquet(f"{folder}/units")
    families = [fleet.Family(k, units, cf, ["z"], F.col("kind") == k) for k in "abc"]
    plan = fleet.historic_potential(families, *[F.lit(x).cast("date") for x in ("2018-01-01", "2020-06-01", "2018-06-01")])._jdf.queryExecution().executedPlan().toString()
    assert plan.split("== Initial Plan ==")[0].count("/factors") == 1 and plan.count("FileScan") == 2
