import datetime as dt

import pytest
from pyspark.sql import functions as F

from voltline import catalog, fixed_values as fixed
from voltline.operators.zones import Axis
from voltline.plans import fleet, jobs

from .conftest import day, rows, ts
from .test_plans import crosswalk, solar, storage, wind
from .test_sources import put

HOUR_MS = 3_600_000
JAN = 1_704_067_200_000  # 2024-01-01 00:00


def block(folder, name, start_hour, values):
    start = JAN + start_hour * HOUR_MS
    points = ",".join(f"[{start + i * HOUR_MS},{'null' if v is None else v}]" for i, v in enumerate(values))
    put(folder, f"landing/name={name}/block_ts={start}/b.json", '{"series": [' + points + "]}")


def test_market_series_catch_up_series_by_series(spark, folder):
    block(folder, "smard_load", 0, [1, 2, 3, 4])
    block(folder, "smard_price_at", 0, [10, 20])
    landing, path = f"{folder}/landing", f"{folder}/table"
    assert rows(jobs.load_market_series(spark, landing, path)) == [(6, 6, ts("2024-01-01 00:00"), ts("2024-01-01 03:00"))]
    block(folder, "smard_load", 3, [44, None, 66])
    jobs.load_market_series(spark, landing, path)
    stored = rows(jobs.market_table(spark, path).read().filter("series = 'smard_load'"), "ts", "value")
    assert [(r[0].hour, r[1]) for r in stored] == [(0, 1.0), (1, 2.0), (2, 3.0), (3, 44.0), (5, 66.0)]
    again = rows(jobs.load_market_series(spark, landing, path))
    assert again[0][0] == 7
    check = {r["series"]: (r["passed"], r["unexpected"], r["severity"]) for r in jobs.check_market_series(spark, path).collect()}
    assert check.pop("smard_load") == (False, 1, "ERROR") and check.pop("smard_price_at") == (True, 0, "ERROR")
    # every other series of the catalogue was never loaded
    assert len(check) == catalog.series_ids(spark).count() - 2 and set(check.values()) == {(False, None, "WARN")}


def quarter_file(folder, name, first, values):
    lines = ["Datum;Zeitzone;von;bis;Deutschland"]
    start = dt.datetime.fromisoformat(first)
    for i, v in enumerate(values):
        at = start + dt.timedelta(minutes=15 * i)
        lines.append(f"{at:%d.%m.%Y};CET;{at:%H:%M};x;{'N.A.' if v is None else str(v).replace('.', ',')}")
    return put(folder, name, "\n".join(lines) + "\n")


def test_quarter_hours_heal_and_wait_for_publication(spark, folder):
    path = f"{folder}/t"
    first = quarter_file(folder, "1.csv", "2024-01-20 01:00", [1.5, None, 3.5, None, None])
    assert rows(jobs.load_quarter_hours(spark, "nrv_saldo", first, path, day("2024-01-20"))) == [(3, 3, ts("2024-01-20 00:00"), ts("2024-01-20 00:30"))]
    second = quarter_file(folder, "2.csv", "2024-01-20 01:00", [1.5, 2.5, 3.5, 4.5, None])
    jobs.load_quarter_hours(spark, "nrv_saldo", second, path, day("2024-01-20"))
    stored = rows(jobs.quarter_hour_table(spark, "nrv_saldo", path).read())
    assert [r[1] for r in stored] == [1.5, 2.5, 3.5, 4.5]
    check = jobs.check_quarter_hours(spark, "nrv_saldo", path).first()
    assert (check["passed"], check["severity"], check["expected"]) == (True, "WARN", 4)


def test_tenders_restart_the_month(spark, folder):
    column = fixed.AFRR_PRICE_PER_HOUR
    path = f"{folder}/t"

    def load(name, data):
        file = put(folder, name, f"DATE_FROM,PRODUCT,{column}\n" + "".join(f"{d},NEG_00_04,{p}\n" for d, p in data))
        return jobs.load_tenders(spark, "aFRR", [file], path, day("2024-03-31"))

    load("a.csv", [("2024-01-31", 1), ("2024-02-01", 2), ("2024-02-02", 3), ("2018-09-30", 99)])
    load("b.csv", [("2024-01-31", 9), ("2024-02-01", 20), ("2024-02-04", 40), ("2024-04-01", 99)])
    assert rows(jobs.tender_table(spark, "aFRR", path).read(), "delivery_date", "neg_00_04") == [
        (day("2024-01-31"), 1.0), (day("2024-02-01"), 20.0), (day("2024-02-02"), 3.0), (day("2024-02-04"), 40.0),
    ]
    check = jobs.check_tenders(spark, "aFRR", path).first()
    assert (check["passed"], check["unexpected"], check["first_unexpected"]) == (False, 1, ts("2024-02-03 00:00"))


def test_gas(spark, folder):
    path = f"{folder}/t"
    header = "Date,Open,High,Low,Close,Volume\n"
    jobs.load_gas(spark, put(folder, "a.csv", header + "2024-01-02,1,1,1,1,5\n2024-01-03,2,2,2,2,5\n"), path)
    report = jobs.load_gas(spark, put(folder, "b.csv", header + "2024-01-03,9,9,9,9,9\n2024-01-10,3,3,3,3,5\n"), path)
    assert rows(report) == [(3, 1, day("2024-01-02"), day("2024-01-10"))]
    assert [r["open"] for r in jobs.gas_table(spark, path).read().orderBy("date").collect()] == [1.0, 2.0, 3.0]
    assert tuple(jobs.check_gas(spark, path).first())[1:] == (False, "ERROR", 7, 1, day("2024-01-10"))


def test_refreshes(spark, folder):
    n = len(fixed.REDISPATCH_SOURCES)
    chart = put(folder, "c.csv", "s-nepm_re_et-1-1;2022-07-01;" + ";".join(["1"] * n) + "\n")
    measures = put(folder, "m.csv", "BEGINN_DATUM;BEGINN_UHRZEIT;ZEITZONE_VON;ENDE_DATUM;ENDE_UHRZEIT;ZEITZONE_BIS;RICHTUNG;GESAMTE_ARBEIT_MWH;MITTLERE_LEISTUNG_MW;MAXIMALE_LEISTUNG_MW;GRUND_DER_MASSNAHME;ANWEISENDER_UENB;BETROFFENE_ANLAGE;PRIMAERENERGIEART\n29.10.2023;01:00;CEST;29.10.2023;02:30;CET;x;1,5;2;3;a;b;c;d\n")
    for _ in range(2):
        jobs.refresh_redispatch(spark, chart, measures, f"{folder}/out")
    assert spark.read.parquet(f"{folder}/out/smard_redispatch_by_source").count() == n
    assert spark.read.parquet(f"{folder}/out/redispatch_measures").count() == 1
    report = jobs.refresh_capacity(spark, wind(spark), solar(spark), crosswalk(spark), storage(spark), f"{folder}/cap", 2020)
    assert rows(report) == [("solar", 0.0), ("wind", 14.0)]  # 14.5 MW, halves to even
    panel = spark.read.parquet(f"{folder}/cap/mastr_capacity_by_region_year")
    assert panel.filter("year = 2018 and region_code = 'DEZZ-NORDSEE'").first()["capacity_mw"] == 6.0
    assert panel.filter("year = 2019 and region_code = 'DEZZ-NORDSEE'").count() == 0
    by_category = spark.read.parquet(f"{folder}/cap/mastr_capacity_by_region_year_pv_category")
    assert rows(by_category.filter("year = 2014"), "region_code", "pv_category", "unit_count") == [
        ("DE212", "self_consumption_no_storage", 1), ("DE212", "self_consumption_with_storage", 1), ("DEF01", "full_feed_in", 1),
    ]


def test_weather_means(spark):
    grid = spark.createDataFrame([(ts("2020-01-01 00:00"), 273.15, 3.0, 4.0, 0.001), (ts("2020-01-01 00:00"), 275.15, -3.0, -4.0, 0.003)], "valid_time timestamp_ntz, t2m double, u10 double, v10 double, tp double")
    means = {name: rows(df)[0][1] for name, df in jobs.weather_means(grid).items()}
    assert means["avg_de_2m_temp"] == pytest.approx(1.0) and means["avg_de_wind_speed_10m"] == 5.0  # not 0: speed before mean
    assert rows(jobs.precipitation_mean(grid))[0][1] == pytest.approx(2.0)


def test_prepared_families_from_registry_to_potential(spark):
    mask = spark.createDataFrame([("DE01", 54.0, 9.0, 0.5), ("DE02", 54.0, 9.0, 0.5), ("DE09", 54.5, 13.0, 1.0)], "zone_id string, cell_lat double, cell_lon double, coverage double")
    detail = spark.createDataFrame([("s3", "nachgeführt", None)], "unit_id string, main_orientation string, main_orientation_tilt_bucket string")
    at = ts("2020-06-01 00:00")
    cf_solar = spark.createDataFrame([(at, "61", "DEF0", 0.5), (at, "63", "DE21", 1.0), (at, "60", "DE21", None)], "ts timestamp_ntz, technology string, region string, cf double")
    cf_wind = spark.createDataFrame([(at, "DE01", 0.2), (at, "DE02", 0.4), (at, "DE09", 0.5)], "ts timestamp_ntz, zone_id string, cf double")
    families = fleet.prepare_families(
        wind(spark), solar(spark), detail, crosswalk(spark), mask, mask, Axis(54.5, -0.5, 2), Axis(9.0, 4.0, 2), cf_solar, cf_wind, cf_wind
    )
    first, last = F.lit("2010-01-01").cast("date"), F.lit("2020-06-01").cast("date")
    panel = fleet.historic_potential(families, first, last, F.lit("2015-01-01").cast("date")).first()
    assert panel["potential_solar_mw"] == pytest.approx(0.01 * 0.5 + 0.03 * 1.0)
    assert panel["potential_wind_onshore_mw"] == pytest.approx(3.0 * 0.3)
    assert panel["potential_wind_offshore_mw"] == pytest.approx(6.0 * 0.5)
    assert rows(fleet.unmodelled(families[0], F.lit("2020-06-01").cast("date"))) == [("60", "DE21", 0.02)]


def test_fleet_tables_are_the_same_twice(spark, folder):
    at = ts("2020-06-01 00:00")
    cf = spark.createDataFrame([(at, "a", 0.5)], "ts timestamp_ntz, z string, cf double")
    units = spark.createDataFrame([("a", 10.0, "60", "onshore")], "z string, capacity_mw double, technology string, siting string").select(
        "*", F.lit("2010-01-01").cast("date").alias("commissioning_date"), F.lit(None).cast("date").alias("final_shutdown_date"))
    base = spark.createDataFrame([(at, 0.4, 0.8, 0.1, 0.1, 0.5, 1.0)], "ts timestamp_ntz, solar_60 double, solar_61 double, solar_62 double, solar_63 double, wind_onshore double, wind_offshore double")
    months = [F.lit(x).cast("date") for x in ("2010-01-01", "2020-12-01", "2020-01-01", "2020-06-01")]
    states = []
    for _ in range(2):
        jobs.refresh_fleet(spark, [fleet.Family("solar", units, cf, ["z"])], units, units, base, folder, *months)
        states.append({n: rows(spark.read.parquet(f"{folder}/{n}")) for n in ("de_potential_historic", "de_capacity_factor_current_fleet", "de_fleet_weights_snapshot", "de_capacity_factors_fleet_weighted")})
    assert states[0] == states[1] and states[0]["de_potential_historic"] == [(at, 5.0)]
    assert {"solar_weight_60", "solar_total_mw", "wind_onshore_total_mw"} <= set(spark.read.parquet(f"{folder}/de_fleet_weights_snapshot").columns)


def test_country_factors_from_parts(spark, folder):
    at = ts("2020-06-01 01:00")
    mask = spark.createDataFrame([("DE01", 54.0, 9.0, 0.5)], "zone_id string, cell_lat double, cell_lon double, coverage double")
    weights = spark.createDataFrame([("*", "60", 1.0)], "country string, technology string, weight double")
    for _ in range(2):
        for kind, technology, zone, stamp in (("solar", "60", "DE", at), ("wind_onshore", "on", "DE01", at - dt.timedelta(hours=1)), ("wind_offshore", "off", "DE09", at - dt.timedelta(hours=1))):
            new = jobs.load_factor_parts(spark.createDataFrame([(stamp, zone, 0.5)], "ts timestamp_ntz, zone_id string, cf double"), f"{folder}/parts", kind, technology)
        jobs.refresh_country_factors(spark, f"{folder}/parts", mask, weights, folder)
        assert spark.read.parquet(f"{folder}/pecd_country_capacity_factors_simple").count() == 3
    assert new == []
    assert rows(spark.read.parquet(f"{folder}/pecd_country_capacity_factors_simple_de")) == [(ts("2020-06-01 00:00"), 0.5, 0.5, 0.5)]


def test_feature_collections(spark, folder):
    """Any number of parts, empty ones and none at all make one valid document."""
    import json

    from voltline.sources import regions, sinks

    rows_in = [(f"DE{i}", i % 4, f'na"me {i}', '{"type":"Point","coordinates":[1,2]}' if i % 5 else None) for i in range(23)]
    df = spark.createDataFrame(rows_in, "NUTS_ID string, LEVL_CODE int, NUTS_NAME string, geometry string").selectExpr("'DE' AS CNTR_CODE", "*", "NUTS_NAME AS NAME_LATN")
    properties = ["CNTR_CODE", "LEVL_CODE", "NUTS_ID", "NUTS_NAME", "NAME_LATN"]
    for n, some in ((1, df), (7, df), (40, df), (2, df.limit(0))):
        path = f"{folder}/out.geojson"
        sinks.write_feature_collection(some.repartition(n), path, "geometry", properties)
        with open(path, encoding="utf-8") as f:
            assert len(json.load(f)["features"]) == some.count()
        assert rows(regions.read_features(spark, path)) == rows(some.select("CNTR_CODE", "LEVL_CODE", "NUTS_ID", "NUTS_NAME", "NAME_LATN", "geometry"))


def test_bucketed_registry_joins_without_shuffle(spark, folder):
    """Units and detail in equal buckets of the unit id: the join moves neither, and gives what the plain one gives."""
    from voltline.plans import registry
    from voltline.sources.sinks import write_bucketed

    detail = spark.createDataFrame([("s3", "nachgeführt", None), ("s1", None, "x"), ("zz", None, None)], "unit_id string, main_orientation string, main_orientation_tilt_bucket string")
    plain = registry.solar_units(solar(spark), detail, crosswalk(spark))
    stored = [write_bucketed(df, f"bucketed_{n}", ["unit_id"], 4, f"{folder}/{n}") for n, df in (("units", solar(spark)), ("detail", detail))]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = registry.solar_units(*stored, crosswalk(spark).hint("broadcast"))
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin [unit_id" in plan and "Exchange hashpartitioning" not in plan and plan.count("Bucketed: true") == 2
        assert rows(joined) == rows(plain) and plain.count() > 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        for n in ("units", "detail"):
            spark.sql(f"DROP TABLE bucketed_{n}")


def test_block_listing_opens_no_file(spark, folder):
    block(folder, "a", 0, [1])
    block(folder, "b", 5, [1])
    block(folder, "b", 7, [1])
    found = jobs.landed_blocks(spark, f"{folder}/landing")
    assert rows(found) == [("a", JAN), ("b", JAN + 5 * HOUR_MS), ("b", JAN + 7 * HOUR_MS)]
    assert "content" not in found._jdf.queryExecution().executedPlan().toString().split("ReadSchema")[1].split("\n")[0]
    assert jobs.landed_blocks(spark, f"{folder}/nothing").count() == 0


def test_weather_grid_jobs(spark, folder):
    """Twice the same: a stored month is final, a new one is added, means follow."""
    def landed(months, t):
        stamps = [(12.0 + x, 50.0 + y, ts(f"2020-{m:02d}-01 0{h}:00"), t + h) for m in months for h in range(2) for x in (0, 1) for y in (1, 0)]
        instant = spark.createDataFrame([(x, y, at, v, 3.0, 4.0) for x, y, at, v in stamps], "longitude double, latitude double, time timestamp_ntz, t2m double, u10 double, v10 double")
        return instant, spark.createDataFrame([(x, y, at, 7.0) for x, y, at, _ in stamps], "longitude double, latitude double, time timestamp_ntz, ssrd double")

    rain = spark.createDataFrame([(ts("2020-01-01 00:00"), 0.002), (ts("2020-01-01 00:00"), 0.004)], "valid_time timestamp_ntz, tp double")
    assert jobs.load_weather_grid(*landed([1, 2], 273.15), folder) == ["2020-01", "2020-02"]
    assert jobs.load_weather_grid(*landed([1, 2, 3], 300.0), folder) == ["2020-03"]
    assert jobs.load_weather_grid(*landed([1, 2, 3], 300.0), folder) == []
    assert rows(jobs.report_weather_grid(spark, folder))[0][:3] == (24, 4, 3)
    for _ in range(2):
        jobs.refresh_weather_means(spark, folder, rain)
        temperature = rows(spark.read.parquet(f"{folder}/era5_de_temperature_hourly"))
        assert len(temperature) == 6 and temperature[0] == (ts("2020-01-01 00:00"), pytest.approx(0.0)) and temperature[-1][1] == pytest.approx(27.85)
        assert {r[1] for r in rows(spark.read.parquet(f"{folder}/era5_de_wind_speed_hourly"))} == {5.0}
        assert rows(spark.read.parquet(f"{folder}/era5_de_precipitation_hourly"))[0][1] == pytest.approx(3.0)


def test_masks_regions_and_hulls(spark, folder):
    import json

    from voltline.sources import regions

    landed = spark.createDataFrame([("DE02", 54.0, 9.0, 0.5), ("DE01", 54.0, 9.0, 0.0), ("DE01", 54.5, 9.0, 1.0)], "zone_id string, cell_lat double, cell_lon double, coverage double")
    kept = [("DE01", 54.5, 9.0, 1.0), ("DE02", 54.0, 9.0, 0.5)]
    assert rows(jobs.load_mask(spark, landed, folder, "peon")) == kept == rows(jobs.load_mask(spark, landed.limit(0), folder, "peon"))
    shape = {"type": "Point", "coordinates": [1, 2]}
    found = [("DE", 0, "DE"), ("DE", 3, "DE212"), ("FR", 0, "FR"), ("FR", 1, "FR1"), ("XX", 0, "XX")]
    text = json.dumps({"type": "FeatureCollection", "features": [{"type": "Feature", "properties": {"CNTR_CODE": c, "LEVL_CODE": n, "NUTS_ID": i, "NUTS_NAME": i, "NAME_LATN": i}, "geometry": shape} for c, n, i in found]})
    file = put(folder, "features.geojson", text)
    jobs.refresh_capacity(spark, wind(spark), solar(spark), crosswalk(spark), storage(spark), folder, 2020)
    for _ in range(2):
        jobs.refresh_regions(spark, file, folder)
        jobs.refresh_offshore_regions(spark, folder, F.lit("2018-06-01").cast("date"))
        nuts = regions.read_features(spark, f"{folder}/nuts_regions.geojson")
        assert rows(nuts, "NUTS_ID", "LEVL_CODE") == [("DE", 0), ("DE212", 3)] and json.loads(nuts.first()["geometry"]) == shape
        assert rows(regions.read_features(spark, f"{folder}/country_borders.geojson"), "CNTR_CODE") == [(c,) for c in ("DE", "FR", "XX") if c in fixed.NEIGHBOUR_COUNTRIES]
        with open(f"{folder}/offshore_regions.geojson", encoding="utf-8") as f:
            sea = sorted(json.load(f)["features"], key=lambda f: f["properties"]["region_code"])
        assert [(f["properties"]["region_code"], f["properties"]["capacity_mw"], f["geometry"]["type"]) for f in sea] == [("DEZZ-NORDSEE", 6.0, "Point"), ("DEZZ-OSTSEE", 6.0, "Point")]


def test_site_records_and_metadata(spark, folder):
    static = put(folder, "in/static.csv", "Title,Rated power (kW)\nK1,2050\nK2,2050\n")
    meter = put(folder, "in/meter.csv", "# Site\n# Date and time," + ",".join(fixed.METER_COLUMNS) + ",Other\n2020-01-01 00:10:00,2.5,1,,9\n2020-01-01 00:00:00,1.5,,1,9\n")
    turbine = put(folder, "in/t1.csv", "# Turbine: K1\n# Date and time,Power (kW),Wind speed (m/s)\n2020-01-01 00:00:00,100,7.5\n")
    for _ in range(2):
        jobs.refresh_site(spark, static, meter, turbine, f"{folder}/out")
        assert spark.read.parquet(f"{folder}/out/kelmarsh_wt_static").count() == 2
        grid_meter = spark.read.parquet(f"{folder}/out/kelmarsh_grid_meter")
        assert rows(grid_meter) == [(ts("2020-01-01 00:00"), 1.5, None, 1.0), (ts("2020-01-01 00:10"), 2.5, 1.0, None)]
        scada = spark.read.parquet(f"{folder}/out/kelmarsh_turbine_scada")
        assert rows(scada, "turbine", "Power (kW)", "Wind speed (m/s)", "Data Availability") == [("K1", 100.0, 7.5, None)]
    assert grid_meter.schema["ts"].metadata["unit"] == "kWh" and scada.schema["turbine"].metadata["table"] == "kelmarsh_turbine_scada"
