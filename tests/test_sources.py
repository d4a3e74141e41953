import json
import os

import pytest
from pyspark.sql import functions as F

from voltline import catalog, fixed_values as fixed
from voltline.functions.timeutil import ntz
from voltline.schemas import SERIES, WEATHER_GRID, conform, empty, struct
from voltline.sources import lines as text
from voltline.sources import market_csv, regions, registry, series_json, sinks, tenders, weather, zone_csv
from voltline.sources.lines import read_lines

from .conftest import day, rows, ts


def put(folder, name, content, encoding="utf-8"):
    path = os.path.join(folder, name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding=encoding, newline="") as f:
        f.write(content)
    return path


# --- JSON blocks ----------------------------------------------------------------------

HOUR = 3_600_000
B0, B1 = 1_704_067_200_000, 1_704_070_800_000  # 2024-01-01 00:00 and 01:00


def blocks(folder):
    first = {"meta_data": {"v": 1}, "series": [[B0, 1.0], [B0 + HOUR, 2.0], [B0 + 2 * HOUR, None]]}
    second = {"series": [[B1, 20], [B1 + 2 * HOUR, 4.5]]}
    put(folder, f"name=load/block_ts={B0}/d.json", json.dumps(first, indent=1))
    put(folder, f"name=load/block_ts={B1}/d.json", json.dumps(second))
    return folder


def test_json_blocks(spark, folder):
    got = rows(series_json.read_blocks(spark, blocks(folder)))
    assert got == [("load", ts("2024-01-01 00:00"), 1.0), ("load", ts("2024-01-01 01:00"), 20.0), ("load", ts("2024-01-01 03:00"), 4.5)]
    pruned = series_json.read_blocks(spark, folder, from_block=B1)
    assert pruned.count() == 2
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(block_ts" in plan


def test_block_choice(spark):
    listing = spark.createDataFrame([(s, b) for s in "abcd" for b in (10, 20, 30)], "name string, block_ts bigint")
    starts = spark.createDataFrame([("a", 25), ("b", 5), ("c", 30)], "name string, start_ms bigint")
    got = {}
    for name, block in rows(series_json.prune_blocks(listing, starts)):
        got.setdefault(name, []).append(block)
    assert got == {"a": [20, 30], "b": [10, 20, 30], "c": [30], "d": [10, 20, 30]}


# --- market files ------------------------------------------------------------------------

def test_chart_selection(spark, folder):
    path = put(folder, "m.csv", "x-1;2015;1.5;\r\nx-1;2022-07-01;0;2\r\nx-1;2022-07-01;1;2;3\r\nx-2;2022-07-01;9;9\r\n")
    got = rows(market_csv.parse_chart(read_lines(spark, path), "x-1", ["a", "b"]))
    assert got == [(day("2015-01-01"), 1.5, None), (day("2022-07-01"), 0.0, 2.0)]


def test_redispatch_by_source(spark, folder):
    n = len(fixed.REDISPATCH_SOURCES)
    full = ";".join(str(i) for i in range(n))
    content = f"s-nepm_re_et-1-2;2022-08-01;{full}\ns-nepm_re_et-1-1;2022-07-01;{';' * (n - 1)}\ns-nepm_re_et-1-1;2022-09-01;{full}\n"
    got = market_csv.redispatch_by_source(read_lines(spark, put(folder, "r.csv", content))).collect()
    assert len(got) == 2 * n and [r["direction"] for r in got] == ["increase"] * n + ["reduction"] * n
    assert [r["energy_source"] for r in got[:n]] == sorted(fixed.REDISPATCH_SOURCES)
    assert {r["month"] for r in got if r["direction"] == "reduction"} == {day("2022-09-01")}


def test_measures(spark, folder):
    header = "BEGINN_DATUM;BEGINN_UHRZEIT;ZEITZONE_VON;ENDE_DATUM;ENDE_UHRZEIT;ZEITZONE_BIS;RICHTUNG;GESAMTE_ARBEIT_MWH;MITTLERE_LEISTUNG_MW;MAXIMALE_LEISTUNG_MW;GRUND_DER_MASSNAHME;ANWEISENDER_UENB;BETROFFENE_ANLAGE;PRIMAERENERGIEART \n"
    body = (
        "29.10.2023;01:00;CEST;29.10.2023;02:30;CET;Wirkleistungseinspeisung reduzieren;1,5;2,25;3;Strom;T;OWP Nord;Erneuerbar\n"
        "31.12.2023;23:30;CET;01.01.2024;01:00;CET;Wirkleistungseinspeisung erh¿hen;7;1;1;Strom;T;Cluster;Sonstiges\n"
        "01.02.2024;00:00;XXX;01.02.2024;01:00;CET;;7;1;1;Strom;T;UW Emden-Ost;Sonstiges\n"
    )
    got = market_csv.read_measures(spark, put(folder, "m.csv", "﻿" + header + body)).collect()
    assert (got[0]["start"], got[0]["end"]) == (ts("2023-10-28 23:00"), ts("2023-10-29 01:30"))
    assert (got[0]["mwh"], got[0]["avg_mw"], got[0]["direction"], got[0]["tech"]) == (1.5, 2.25, "reduction", "offshore_wind")
    assert (got[1]["month"], got[1]["direction"], got[1]["tech"]) == (day("2023-12-01"), "increase", "ambiguous")
    assert (got[2]["start"], got[2]["month"], got[2]["direction"], got[2]["tech"]) == (None, None, "reduction", "offshore_wind")


def test_quarter_hours(spark, folder):
    a = put(folder, "a.csv", "﻿Datum;Zeitzone;von;bis;AEP Modul 1;AEP Modul 2;AEP Modul 3\n29.10.2023;CEST;02:00;02:15;1,5;N.A.;0,0\n29.10.2023;CET;02:00;02:15;-2,5;3;N.E.\n")
    b = put(folder, "b.csv", "Datum;Zeitzone;von;bis;AEP Modul 1;AEP Modul 2;AEP Modul 3\n29.10.2023;CET;02:00;02:15;9;9;9\n29.10.2023;CET;02:15;02:30;4;0,0;5\n")
    got = rows(market_csv.read_quarter_hours(spark, [a, b], "aep_modules"))
    assert got == [
        (ts("2023-10-29 00:00"), 1.5, None, None), (ts("2023-10-29 01:00"), -2.5, 3.0, None), (ts("2023-10-29 01:15"), 4.0, 0.0, 5.0),
    ]
    cut = market_csv.read_quarter_hours(spark, [a, b], "aep_modules", ntz("2023-10-29 01:00:00"), ntz("2023-10-29 01:15:00"))
    assert rows(cut, "ts") == [(ts("2023-10-29 01:00"),)]


def test_quarter_hours_index_layout_with_repeated_header(spark, folder):
    path = put(folder, "i.csv", "Datum von;(Uhrzeit) von;Zeitzone;(Uhrzeit) bis;Zeitzone;ID AEP in EUR/MWh\n01.07.2020;00:00;CEST;00:15;CEST;38,7\n01.07.2020;00:15;CEST;00:30;CEST;N.A.\n")
    assert rows(market_csv.read_quarter_hours(spark, path, "id_aep")) == [(ts("2020-06-30 22:00"), 38.7), (ts("2020-06-30 22:15"), None)]


def test_quarter_hours_two_prices_and_balance(spark, folder):
    price = put(folder, "p.csv", "Datum;Zeitzone;von;bis;reBAP unterdeckt;reBAP ueberdeckt\n01.01.2024;CET;00:00;00:15;10,5;11\n")
    assert rows(market_csv.read_quarter_hours(spark, price, "rebap_price")) == [(ts("2023-12-31 23:00"), 10.5, 11.0)]
    balance = put(folder, "n.csv", "Datum;Zeitzone;von;bis;Deutschland\n01.01.2024;CET;00:00;00:15;-100,25\n")
    assert rows(market_csv.read_quarter_hours(spark, balance, "nrv_saldo")) == [(ts("2023-12-31 23:00"), -100.25)]


def test_guards(spark, folder):
    page = put(folder, "e.csv", "<html>internal error</html>\n")
    with pytest.raises(ValueError, match="unexpected content"):
        market_csv.read_quarter_hours(spark, page, "nrv_saldo")
    label = put(folder, "l.csv", "Datum;Zeitzone;von;bis;Deutschland\n01.01.2024;MEZ;00:00;00:15;1\n")
    with pytest.raises(Exception, match="unknown time zone label: MEZ"):
        market_csv.read_quarter_hours(spark, label, "nrv_saldo").collect()
    with pytest.raises(ValueError, match="price column"):
        tenders.fcr_prices(spark.createDataFrame([("1",)], "TENDER_NUMBER string"))
    with pytest.raises(ValueError, match="price column"):
        tenders.afrr_prices(spark.createDataFrame([("1",)], "PRODUCT string"))
    headless = put(folder, "h.csv", "2020-01-01,1\n")
    with pytest.raises(Exception, match="no header line"):
        zone_csv.read_zone_series(spark, headless).collect()


def test_price_bars(spark, folder):
    path = put(folder, "g.csv", "Date,Open,High,Low,Close,Volume,Dividends\n2024-01-03 00:00:00-05:00,1,2,0.5,1.5,100,0\n2024-01-02 00:00:00-05:00,3,4,2.5,3.5,,0\n")
    assert rows(market_csv.read_price_bars(spark, path)) == [(day("2024-01-02"), 3.0, 4.0, 2.5, 3.5, None), (day("2024-01-03"), 1.0, 2.0, 0.5, 1.5, 100)]


# --- tenders ----------------------------------------------------------------------------------

def test_fcr_tenders(spark, folder):
    new, old = fixed.FCR_PRICE_COLUMNS
    paths = [
        put(folder, "R_2020-12.csv", f"DATE_FROM,TENDER_NUMBER,PRODUCTNAME,{old}\n2020-12-31,1,NEGPOS_00_24,999\n"),
        put(folder, "R_2022-08.csv", f"DATE_FROM,TENDER_NUMBER,PRODUCTNAME,{old}\n2022-08-31,1,NEGPOS_00_04,40\n2022-08-31,2,NEGPOS_04_08,80\n2022-08-31,1,NEGPOS_20_24,-\n"),
        put(folder, "R_2022-09.csv", f"DATE_FROM,TENDER_NUMBER,PRODUCTNAME,{new}\n2022-09-01,1,NEGPOS_00_04,44\n2022-08-31,1,NEGPOS_00_04,48\n"),
    ]
    got = rows(tenders.read_tenders(spark, paths + paths[:1], "FCR"))
    assert got == [(day("2022-08-31"), 12.0) + (None,) * 5, (day("2022-09-01"), 11.0) + (None,) * 5]
    assert rows(tenders.in_days(tenders.read_tenders(spark, paths, "FCR"), "2022-09-01", "2022-09-01"), "negpos_00_04") == [(11.0,)]


def test_duplicate_tender_cell_raises(spark, folder):
    path = put(folder, "R.csv", f"DATE_FROM,PRODUCT,{fixed.AFRR_PRICE_PER_HOUR}\n2024-01-01,NEG_00_04,1\n2024-01-01,NEG_00_04,2\n")
    with pytest.raises(Exception, match="duplicate rows"):
        tenders.read_tenders(spark, [path], "aFRR").collect()


def test_afrr_units(spark, folder):
    per_block = put(folder, "a.csv", f"DATE_FROM,PRODUCT,{fixed.AFRR_PRICE_PER_BLOCK}\n2021-12-31,POS_20_24,8\n")
    per_hour = put(folder, "b.csv", f"DATE_FROM,PRODUCT,{fixed.AFRR_PRICE_PER_HOUR}\n2022-01-01,POS_20_24,8\n")
    assert rows(tenders.read_tenders(spark, [per_block, per_hour], "aFRR"), "delivery_date", "pos_20_24") == [(day("2021-12-31"), 2.0), (day("2022-01-01"), 8.0)]


def test_delivery_blocks_on_clock_change_days(spark):
    data = [("2023-03-26", "neg_00_04"), ("2023-10-29", "neg_00_04"), ("2023-07-01", "neg_20_24")]
    df = spark.createDataFrame([(day(d), b, 1.0) for d, b in data], "delivery_date date, block string, price double")
    hours = {}
    for r in tenders.delivery_block_hours(df).orderBy("ts").collect():
        hours.setdefault(str(r["delivery_date"]), []).append(r["ts"].strftime("%d %H"))
    assert hours == {"2023-03-26": ["25 23", "26 00", "26 01"], "2023-10-29": ["28 22", "28 23", "29 00", "29 01", "29 02"], "2023-07-01": ["01 18", "01 19", "01 20", "01 21"]}


def test_file_listing(spark):
    df = spark.createDataFrame([("b", "2021-02"), ("a", "2021-01"), ("b", "2021-02")], "file_name string, date_range string")
    assert [r["file_name"] for r in tenders.latest_files(df).collect()] == ["a", "b"]


# --- preamble files ------------------------------------------------------------------------------

def test_zone_series(spark, folder):
    put(folder, "z/1.csv", "# PECD\nunits,none\nDate,DE01,FR01,DE02\n2020-01-01 00:00:00,0.1,0.9,\n2020-01-01 01:00:00,0.2,0.9,\n")
    put(folder, "z/2.csv", "Date,DE01,FR01,DE02\n2020-01-01 01:00:00,0.7,0.9,0.8\n2020-01-01 02:00:00,0.3,0.9,\n")
    got = rows(zone_csv.read_zone_series(spark, f"{folder}/z", "DE"))
    t = [ts(f"2020-01-01 0{h}:00") for h in range(3)]
    assert got == [(t[0], "DE01", 0.1), (t[0], "DE02", None), (t[1], "DE01", 0.2), (t[1], "DE02", None), (t[2], "DE01", 0.3), (t[2], "DE02", None)]
    assert zone_csv.read_zone_series(spark, f"{folder}/z").count() == 9


def test_stacked_parts_and_pruned_reads(spark, folder):
    cf = spark.createDataFrame([(ts("1989-12-31 23:00"), "DE", 0.5), (ts("2024-05-01 00:00"), "DE", 0.7)], "ts timestamp_ntz, zone_id string, cf double")
    stacked = zone_csv.stack_technologies({"60": cf, "61": cf}, shift=-1)
    assert rows(stacked, "technology", "ts")[0] == ("60", ts("1989-12-31 22:00"))
    labelled = stacked.withColumn("kind", F.lit("solar_country")).withColumn("decade", zone_csv.decade_of("ts"))
    labelled.write.partitionBy("kind", "technology", "decade").parquet(f"{folder}/cf")
    part = zone_csv.read_factor_parts(spark, f"{folder}/cf", "solar_country", "61", ["2020-2025", "2010-2019"])
    assert rows(part) == [(ts("2024-04-30 23:00"), "61", "DE", 0.7)]
    assert zone_csv.read_factor_parts(spark, f"{folder}/cf", "wind_onshore").count() == 0


def test_meter_and_turbines(spark, folder):
    meter = put(folder, "m.csv", "# Site: K\n# Date and time,Energy (kWh),Availability\n2016-01-01 00:00:00,12.5,1\n2016-01-01 00:10:00,,0\n")
    assert rows(zone_csv.parse_meter(read_lines(spark, meter), ["Availability"])) == [(ts("2016-01-01 00:00"), 1.0), (ts("2016-01-01 00:10"), 0.0)]
    assert set(zone_csv.read_meter(spark, meter).columns) == {"ts", *fixed.METER_COLUMNS}
    assert rows(zone_csv.parse_meter_long(read_lines(spark, meter))) == [
        (ts("2016-01-01 00:00"), "Availability", 1.0), (ts("2016-01-01 00:00"), "Energy (kWh)", 12.5),
        (ts("2016-01-01 00:10"), "Availability", 0.0), (ts("2016-01-01 00:10"), "Energy (kWh)", None),
    ]
    put(folder, "t/1.csv", "# Turbine: Kelmarsh 1\n#\n# Date and time,Power (kW),Noise,Wind speed (m/s)\n2016-01-03 00:00:00,100,7,5.5\n")
    put(folder, "t/2.csv", "# Turbine: Kelmarsh 2\n# Date and time,Noise,Power (kW),Data Availability\n2016-01-03 00:00:00,7,200,1\n")
    got = zone_csv.read_turbines(spark, f"{folder}/t").orderBy("turbine").collect()
    assert [(r["turbine"], r["Power (kW)"], r["Wind speed (m/s)"], r["Data Availability"]) for r in got] == [("Kelmarsh 1", 100.0, 5.5, None), ("Kelmarsh 2", 200.0, None, 1.0)]
    static = put(folder, "s.csv", "Title,Rated power (kW)\nKelmarsh 1,2050\n")
    assert rows(zone_csv.read_static_table(spark, static)) == [("Kelmarsh 1", "2050")]


def test_line_order_and_bom(spark, folder):
    path = put(folder, "l.txt", "﻿one\n\ntwo\nthree\n")
    got = [r["value"] for r in read_lines(spark, path).orderBy("pos").collect()]
    assert got == ["one", "two", "three"] and text.files_not_starting_with(read_lines(spark, path), "one").count() == 0


# --- registry, regions, weather ---------------------------------------------------------------------

def test_registry_extracts(spark, folder):
    raw = spark.createDataFrame([("S1", "09162000", "12.5", "nachgeführt", "L1", "x")], "EinheitMastrNummer string, Gemeindeschluessel string, Nettonennleistung string, Hauptausrichtung string, LokationMastrNummer string, Foo string")
    raw.write.parquet(f"{folder}/raw")
    raw = registry.read_registry(spark, f"{folder}/raw")
    units = registry.unit_extract(raw, "solar")
    assert units.columns == struct(registry.REGISTRY_SOLAR).fieldNames() and units.schema["net_capacity_kw"].dataType.simpleString() == "float"
    row = units.first()
    assert (row["unit_id"], row["location_id"], row["net_capacity_kw"], row["state"], row["technology"]) == ("S1", "L1", 12.5, None, "solar")
    assert rows(registry.solar_detail_extract(raw)) == [("S1", "nachgeführt", None)] and rows(registry.storage_location_extract(raw)) == [("S1", "L1")]
    lau = put(folder, "lau.csv", "LAU CODE,NUTS3,LAU NAME\n1001000,DEF01,Flensburg\n123456789,DE999,Lang\n")
    assert rows(registry.read_crosswalk(spark, lau)) == [("01001000", "DEF01"), ("123456789", "DE999")]


def test_registry_xml(spark, folder):
    path = put(folder, "u.xml", "<Units><Unit><EinheitMastrNummer>W1</EinheitMastrNummer><Seelage>Nordsee</Seelage></Unit><Unit><EinheitMastrNummer>W2</EinheitMastrNummer></Unit></Units>")
    units = registry.unit_extract(registry.read_registry(spark, path, "xml", rowTag="Unit"), "wind")
    assert rows(units, "unit_id", "sea_location") == [("W1", "Nordsee"), ("W2", None)]


def test_region_features_and_geojson(spark, folder):
    def feature(country, level, code):
        return {"type": "Feature", "properties": {"CNTR_CODE": country, "LEVL_CODE": level, "NUTS_ID": code, "NUTS_NAME": "Ü", "NAME_LATN": "U"}, "geometry": {"type": "Point", "coordinates": [1.5, 2]}}

    path = put(folder, "n.geojson", json.dumps({"type": "FeatureCollection", "features": [feature("DE", 0, "DE"), feature("DE", 3, "DE300"), feature("NL", 0, "NL"), feature("NL", 1, "NL1"), feature("FR", 0, "FR")]}))
    features = regions.read_features(spark, path)
    own = regions.country_regions(features)
    assert rows(own, "NUTS_ID") == [("DE",), ("DE300",)] and rows(regions.neighbour_outlines(features), "CNTR_CODE") == [("DE",), ("NL",)]
    assert json.loads(own.first()["geometry"]) == {"type": "Point", "coordinates": [1.5, 2]}
    sinks.write_features(own, f"{folder}/out", "geometry", ["NUTS_ID", "LEVL_CODE"])
    lines = [json.loads(r["value"]) for r in spark.read.text(f"{folder}/out").collect()]
    assert {f["properties"]["NUTS_ID"] for f in lines} == {"DE", "DE300"} and lines[0]["geometry"]["type"] == "Point"


def test_mask_prefix_is_pushed_down(spark, folder):
    spark.createDataFrame([("DE01", 50.0, 5.0, 1.0), ("FR01", 50.0, 5.0, 1.0)], "zone_id string, cell_lat double, cell_lon double, coverage double").write.parquet(f"{folder}/mask")
    df = regions.read_mask(spark, f"{folder}/mask", "DE")
    assert df.count() == 1 and "StringStartsWith(zone_id,DE)" in df._jdf.queryExecution().executedPlan().toString()


def test_weather_grid(spark, folder):
    instant = spark.createDataFrame([(5.0, 50.0, ts("2020-01-31 23:00"), 280.0), (5.25, 50.0, ts("2020-02-01 00:00"), 281.0)], "longitude double, latitude double, valid_time timestamp_ntz, `2m_temperature` double")
    accumulated = spark.createDataFrame([(5.0, 50.0, ts("2020-01-31 23:00"), 7.0), (9.0, 50.0, ts("2020-02-01 00:00"), 8.0)], "longitude double, latitude double, time timestamp_ntz, ssrd double")
    grid = weather.merge_grids(instant, accumulated)
    assert grid.columns == struct(WEATHER_GRID).fieldNames() and grid.count() == 3
    new = sinks.write_missing_parts(weather.sort_part(grid), f"{folder}/g", "month")
    assert new == ["2020-01", "2020-02"]
    assert rows(weather.read_grid(spark, f"{folder}/g", first_month="2020-02"), "cell_lon", "t2m", "ssrd") == [(5.25, 281.0, None), (9.0, None, 8.0)]
    assert weather.read_grid(spark, f"{folder}/g", "2021-01", "2021-02").count() == 0
    months = rows(weather.months_between(spark, F.lit("2018-11-15").cast("date"), F.lit("2019-01-01").cast("date")))
    assert months == [(2018, 11), (2018, 12), (2019, 1)]


# --- schemas and catalogue ---------------------------------------------------------------------------

def test_conform(spark):
    df = spark.createDataFrame([("1.5", float("nan"))], "old string, value double")
    got = conform(df, "new double, value double, extra int", {"newer": "new", "old": "new"})
    assert rows(got) == [(1.5, None, None)] and empty(spark, SERIES).columns == ["series", "ts", "value"]


def test_catalogue(spark):
    df = catalog.catalogue(spark)
    assert df.count() == 96 and df.select("table").distinct().count() == 96 and catalog.incomplete_entries(df).count() == 0
    assert df.filter("group like 'smard_%'").groupBy("group").count().orderBy("count").agg(F.sum("count")).first()[0] == 47
    broken = df.limit(1).withColumn("unit", F.lit(" ")).withColumn("load_pattern", F.lit("now and then"))
    assert catalog.incomplete_entries(broken).first()["missing"] == ["unit"]
    assert catalog.series_ids(spark).select("variable_id").distinct().count() == 47
    gaps = catalog.known_gaps(spark)
    assert gaps.count() == 31 and gaps.select("series").distinct().count() == 12
    described = catalog.describe(empty(spark, SERIES), "nrv_saldo")
    assert described.schema["value"].metadata["unit"] == "MW"
    severities = spark.createDataFrame([("nrv_saldo",), ("id_aep",)], "series string").select(catalog.gap_severity())
    assert [r[0] for r in severities.collect()] == ["WARN", "ERROR"]


def test_tenders_are_read_in_one_scan(spark, folder):
    """Whatever their columns and quoting; a table without a known price column raises."""
    new, old = fixed.FCR_PRICE_COLUMNS
    paths = [
        put(folder, "R_1.csv", f'PRODUCTNAME,"{old}",TENDER_NUMBER,DATE_FROM\n"NEGPOS_00_04","40",1,2022-08-30\n'),
        put(folder, "R_2.csv", f'DATE_FROM,TENDER_NUMBER,PRODUCTNAME,NOTE,{new}\n2022-08-31,1,NEGPOS_00_04,"a, b",44\n2022-08-31,x,NEGPOS_04_08,,44\n'),
    ]
    table = tenders.read_tenders(spark, paths, "FCR")
    assert rows(table, "delivery_date", "negpos_00_04", "negpos_04_08") == [(day("2022-08-30"), 10.0, None), (day("2022-08-31"), 11.0, None)]
    assert "ExistingRDD" not in table._jdf.queryExecution().executedPlan().toString()
    bad = put(folder, "R_3.csv", "DATE_FROM,TENDER_NUMBER,PRODUCTNAME\n2022-09-01,1,NEGPOS_00_04\n")
    with pytest.raises(Exception, match="no known FCR price column in R_3.csv"):
        tenders.read_tenders(spark, [*paths, bad], "FCR").collect()
