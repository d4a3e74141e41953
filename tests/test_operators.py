import datetime as dt
import math
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from voltline.functions.timeutil import ntz
from voltline.operators import quality, reshape, weighting
from voltline.operators.hulls import footprint_hulls, hull_vertices
from voltline.operators.intervals import distribute_to_hours
from voltline.operators.joins import left_join_spreading_nulls
from voltline.operators.panels import annual_capacity_panel, capacity_snapshot, month_range, monthly_capacity_panel
from voltline.operators.zones import Axis, country_area_shares, fractional_zone_weights, grid_summary, presplit_capacity, spatial_mean, zone_centroids

from .conftest import day, rows, ts

H = dt.timedelta(hours=1)


# --- intervals ---------------------------------------------------------------------

def brute_hours(intervals):
    hourly = defaultdict(float)
    for start, end, value in intervals:
        length = (end - start).total_seconds()
        if length <= 0:
            continue
        hour = start.replace(minute=0, second=0, microsecond=0)
        last = (end - dt.timedelta(seconds=1)).replace(minute=0, second=0, microsecond=0)
        while hour <= last:
            overlap = (min(end, hour + H) - max(start, hour)).total_seconds()
            hourly[hour] += value * overlap / length
            hour += H
    return dict(hourly)


def test_intervals_match_brute_force_at_every_length(spark):
    rng = random.Random(7)
    base = ts("2023-03-25 20:00:00")
    data = [(base + dt.timedelta(minutes=15 * rng.randrange(400)), dt.timedelta(minutes=15 * rng.randrange(-4, 200)), rng.uniform(-5, 50)) for _ in range(120)]
    intervals = [(s, s + d, v) for s, d, v in data] + [(base, base + H, 3.0), (base, base, 9.0), (base + 90 * H, base + 900 * H, 10.0)]
    df = spark.createDataFrame(intervals, "s timestamp_ntz, e timestamp_ntz, v double")
    got = {r["hour"]: r["value"] for r in distribute_to_hours(df, "s", "e", "v").collect()}
    want = brute_hours(intervals)
    assert set(got) == set(want)
    assert all(math.isclose(got[h], want[h], rel_tol=1e-9, abs_tol=1e-9) for h in want)
    total = sum(v for s, e, v in intervals if e > s)
    assert math.isclose(sum(got.values()), total, rel_tol=1e-9)


def test_intervals_keep_keys_apart_and_survive_repartitioning(spark):
    data = [("a", ts("2024-01-01 00:30"), ts("2024-01-01 02:00"), 3.0), ("b", ts("2024-01-01 00:00"), ts("2024-01-09 00:00"), 192.0), (None, ts("2024-01-01 00:00"), ts("2024-01-01 01:00"), 1.0)]
    df = spark.createDataFrame(data, "k string, s timestamp_ntz, e timestamp_ntz, v double")
    one = rows(distribute_to_hours(df, "s", "e", "v", ["k"]))
    assert one == rows(distribute_to_hours(df.repartition(9), "s", "e", "v", ["k"]))
    assert [r for r in one if r[0] == "a"] == [("a", ts("2024-01-01 00:00"), 1.0), ("a", ts("2024-01-01 01:00"), 2.0)]
    assert len([r for r in one if r[0] == "b"]) == 192 and len(one) == 195


# --- panels -------------------------------------------------------------------------

UNITS = [
    ("u1", "A", 10.0, "2015-03-10", None), ("u2", "A", 5.0, "2015-03-20", "2015-03-25"), ("u3", "A", 7.0, "2014-01-01", "2016-12-31"),
    ("u4", "B", 2.0, "2016-05-01", "2015-02-01"), ("u5", "B", 4.0, "2015-12-31", None), ("u6", None, 9.0, "2015-01-01", None), ("u7", "C", 1.0, "2031-01-01", None),
]


def units(spark):
    data = [(u, g, c, day(s), day(e) if e else None) for u, g, c, s, e in UNITS]
    return spark.createDataFrame(data, "unit_id string, g string, capacity_mw double, commissioning_date date, final_shutdown_date date")


def months(first, last):
    d = day(first)
    while d <= day(last):
        yield d
        d = (d.replace(day=28) + dt.timedelta(days=4)).replace(day=1)


def test_monthly_panel_matches_brute_force(spark):
    first, last, export = "2014-01-01", "2017-06-01", "2015-01-01"
    panel = monthly_capacity_panel(units(spark), ["g"], *(F.lit(x).cast("date") for x in (first, last, export)))
    got = {(r["g"], r["month"]): r["capacity_mw"] for r in panel.collect()}
    want = {}
    for g in "ABC":
        for m in months(first, last):
            total = sum(
                (c if m >= day(s).replace(day=1) and day(s) < day("2017-07-01") else 0.0) - (c if e and m >= day(e).replace(day=1) else 0.0)
                for _, k, c, s, e in UNITS if k == g
            )
            if m >= day(export):
                want[g, (m.replace(day=28) + dt.timedelta(days=4)).replace(day=1) - dt.timedelta(days=1)] = total
    assert got == want
    assert got["B", day("2015-02-28")] == -2.0  # shut down before it started: a negative stretch
    assert got["C", day("2017-06-30")] == 0.0  # a group whose changes all lie outside the grid


def test_annual_panel_matches_brute_force(spark):
    got = rows(annual_capacity_panel(units(spark), ["g"], F.lit(2017)))
    want = []
    for year in range(2014, 2018):
        at = dt.date(year, 12, 31)
        for g in "ABC":
            active = [c for _, k, c, s, e in UNITS if k == g and day(s) <= at and (e is None or day(e) > at)]
            if active:
                want.append((g, sum(active), len(active), year))
    assert got == sorted(want, key=repr)


def test_snapshot_and_range(spark):
    assert rows(capacity_snapshot(units(spark), ["g"], F.lit("2016-12-31").cast("date"))) == [("A", 10.0), ("B", 4.0)]
    assert month_range([units(spark)], day("2020-05-17")) == (day("2014-01-01"), day("2020-05-01"))


# --- zones ---------------------------------------------------------------------------

MASK = [("DE01", 50.0, 5.0, 0.6), ("DE02", 50.0, 5.0, 0.2), ("NL01", 50.0, 5.0, 0.2), ("DE01", 49.75, 5.0, 1.0), ("DE02", 49.75, 5.25, 0.5), ("NL01", 49.5, 5.5, 1.0)]
LAT, LON = Axis(50.0, -0.25, 3), Axis(5.0, 0.25, 3)


def mask(spark):
    return spark.createDataFrame(MASK, "zone_id string, cell_lat double, cell_lon double, coverage double")


def test_zone_weights(spark):
    located = spark.createDataFrame([("a", 50.01, 5.02), ("b", 49.74, 5.0), ("c", 49.5, 5.5), ("d", 60.0, 4.0)], "unit_id string, latitude double, longitude double")
    weights = fractional_zone_weights(located, mask(spark), LAT, LON, "DE")
    got = defaultdict(dict)
    for r in weights.collect():
        got[r["unit_id"]][r["zone_id"]] = round(r["weight"], 12)
    assert got["a"] == {"DE01": 0.75, "DE02": 0.25}  # the foreign share is scaled away
    assert got["b"] == {"DE01": 1.0}
    assert got["c"] == {"DE02": 1.0}  # covered by a foreign zone only: nearest own centre
    assert got["d"] == {"DE01": 0.75, "DE02": 0.25}  # clipped onto the corner cell
    assert all(math.isclose(sum(w.values()), 1.0) for w in got.values())


def test_nearest_centre_breaks_ties_by_zone(spark):
    grid = [("Z2", 0.0, 2.0, 1.0), ("Z1", 0.0, 0.0, 1.0)]
    m = spark.createDataFrame(grid, "zone_id string, cell_lat double, cell_lon double, coverage double")
    u = spark.createDataFrame([("u", 0.0, 1.0)], "unit_id string, latitude double, longitude double")
    assert rows(fractional_zone_weights(u, m, Axis(0, 1, 2), Axis(0, 1, 3))) == [("u", "Z1", 1.0)]


def test_presplit_keeps_unit_columns_and_total(spark):
    u = spark.createDataFrame([("a", 8.0, 50.0, 5.0, "x")], "unit_id string, capacity_mw double, latitude double, longitude double, note string")
    split = presplit_capacity(u, mask(spark), LAT, LON, "DE")
    assert rows(split, "unit_id", "zone_id", "note") == [("a", "DE01", "x"), ("a", "DE02", "x")]
    assert math.isclose(sum(r["capacity_mw"] for r in split.collect()), 8.0)


def test_zone_geometry(spark):
    c = {r["zone_id"]: r for r in zone_centroids(mask(spark)).collect()}
    assert math.isclose(c["DE01"]["centroid_lat"], (0.6 * 50 + 49.75) / 1.6)
    known = spark.createDataFrame([("DE01",), ("DE02",), ("FR99",)], "zone_id string")
    shares = {r["zone_id"]: r["weight"] for r in country_area_shares(mask(spark), known).collect()}
    assert set(shares) == {"DE01", "DE02"} and math.isclose(sum(shares.values()), 1.0)


def test_spatial_mean_and_summary(spark):
    grid = spark.createDataFrame([(1.0, 1.0, ts("2024-01-01 00:00"), 2.0), (2.0, 1.0, ts("2024-01-01 00:00"), 4.0), (1.0, 1.0, ts("2024-02-01 00:00"), None)], "cell_lon double, cell_lat double, valid_time timestamp_ntz, v double")
    assert rows(spatial_mean(grid, F.col("v"))) == [(ts("2024-01-01 00:00"), 3.0), (ts("2024-02-01 00:00"), None)]
    assert rows(spatial_mean(grid, F.col("v"), weight=F.col("cell_lon")))[0][1] == pytest.approx(10 / 3)
    assert rows(grid_summary(grid)) == [(3, 2, 2, day("2024-01-01"), day("2024-02-01"))]


# --- weighting: the NULL rules differ -----------------------------------------------------

T0, T1 = ts("2024-01-01 00:00"), ts("2024-01-01 01:00")


def test_blend_propagates_null_but_drops_absent_technologies(spark):
    data = [(T0, "X", "60", 0.2), (T0, "X", "61", 0.4), (T1, "X", "60", 0.2), (T1, "X", "61", None), (T0, "X", "62", None), (T1, "X", "62", None), (T0, "Y", "60", 1.0)]
    cf = spark.createDataFrame(data, "ts timestamp_ntz, country string, technology string, cf double")
    mix = spark.createDataFrame([("*", "60", 0.5), ("*", "61", 0.25), ("*", "62", 0.25), ("Y", "60", 3.0)], "country string, technology string, weight double")
    got = rows(weighting.blend_technologies(cf, mix))
    assert got[0][:2] == (T0, "X") and math.isclose(got[0][2], (0.2 * 2 + 0.4) / 3)
    assert got[1:] == [(T0, "Y", 1.0), (T1, "X", None)]


def test_area_mean_counts_null_as_zero_and_plain_mean_skips_it(spark):
    data = [(T0, "DE01", 0.5), (T0, "DE02", None), (T1, "DE01", None), (T1, "DE02", None), (ts("2024-01-01 02:00"), "DE02", 0.1)]
    cf = spark.createDataFrame(data, "ts timestamp_ntz, zone_id string, cf double")
    shares = spark.createDataFrame([("DE01", "DE", 0.4), ("DE02", "DE", 0.6)], "zone_id string, country string, weight double")
    assert [round(r[2], 12) for r in rows(weighting.area_weighted_mean(cf, shares))] == [0.2, 0.0, 0.06]
    assert [r[2] for r in rows(weighting.plain_mean(cf))] == [0.5, None, 0.1]


def test_potentials_and_factor(spark):
    cf = spark.createDataFrame([(T0, "a", 0.5), (T0, "b", None), (T1, "a", None), (T1, "b", None)], "ts timestamp_ntz, z string, cf double")
    fleet = spark.createDataFrame([("a", 10.0), ("b", 30.0), ("c", 60.0)], "z string, capacity_mw double")
    assert rows(weighting.potential_fixed(cf, fleet, ["z"])) == [(T0, 5.0), (T1, 0.0)]
    assert rows(weighting.fleet_capacity_factor(cf, fleet, ["z"])) == [(T0, 0.05), (T1, 0.0)]
    assert rows(weighting.fleet_capacity_factor(cf, fleet.limit(0), ["z"])) == [(T0, None), (T1, None)]
    assert rows(weighting.unmodelled_capacity(cf, fleet, ["z"])) == [("b", 30.0)]
    monthly = spark.createDataFrame([("a", day("2024-01-01"), 1.0), ("a", day("2024-01-31"), 4.0), ("a", day("2024-02-29"), 9.0)], "z string, month date, capacity_mw double")
    assert rows(weighting.potential_monthly(cf, monthly, ["z"])) == [(T0, 2.0), (T1, 0.0)]


@pytest.mark.parametrize("compact", [False, True])
def test_inner_alignment(spark, compact):
    df = spark.createDataFrame([(T0, "a", 1), (T0, "b", 2), (T1, "a", 3), (T1, "c", 4)], "ts timestamp_ntz, s string, v int")
    assert rows(weighting.in_all_series(df, "s", ["a", "b"], compact=compact), "s", "v") == [("a", 1), ("b", 2)]


def test_imbalance_price(spark):
    data = [(1.0, 5.0, 7.0, None), (-1.0, 5.0, 7.0, None), (0.0, 5.0, 7.0, 9.0), (2.0, None, None, None)]
    df = spark.createDataFrame(data, "b double, m1 double, m2 double, m3 double")
    got = df.select(weighting.imbalance_price(F.col("b"), F.col("m1"), F.col("m2"), F.col("m3"))).collect()
    assert [r[0] for r in got] == [7.0, 5.0, None, None]


def test_shares(spark):
    df = spark.createDataFrame([("a", "x", 1.0), ("a", "y", 3.0), ("b", "x", 4.0)], "g string, t string, v double")
    assert [r[-1] for r in rows(weighting.share_of_total(df, ["g", "t"], "v", ["g"]))] == [0.25, 0.75, 1.0]
    assert [r[-1] for r in rows(weighting.share_of_total(df, ["g"], "v"))] == [0.5, 0.5]


# --- quality ---------------------------------------------------------------------------------

def test_gap_check(spark):
    stamps = [("a", "2024-01-01 00:00"), ("a", "2024-01-01 03:00"), ("a", "2024-01-01 03:00"), ("b", "2024-01-01 05:00"), (None, "2024-01-01 05:00")]
    df = spark.createDataFrame([(s, ts(t)) for s, t in stamps], "s string, t timestamp_ntz")
    allow = spark.createDataFrame([("a", ts("2024-01-01 01:00"), "known"), ("b", ts("2024-01-01 01:00"), "elsewhere")], "series string, ts timestamp_ntz, reason string")
    warn = F.when(F.col("series") == "b", "WARN").otherwise("ERROR")
    got = rows(quality.grid_gap_check(df, "s", "t", "hour", allow, warn))
    two = ts("2024-01-01 02:00")
    assert got == [("a", False, "ERROR", 1, 1, 4, 3, two, two), ("b", True, "WARN", 0, 0, 1, 1, None, None)]
    assert rows(quality.missing_steps(df, "s", "t", "hour")) == [("a", ts("2024-01-01 01:00")), ("a", two)]
    assert quality.grid_gap_check(df.limit(0), "s", "t", "hour").count() == 0  # empty passes vacuously
    assert len(rows(quality.missing_steps(df.filter("s = 'a'"), "s", "t", "quarter_hour"))) == 11


def test_max_gap(spark):
    def check(*days):
        df = spark.createDataFrame([("g", day(d)) for d in days], "s string, d date")
        return rows(quality.max_gap_check(df, "s", "d"))[0][1:]

    assert check("2024-01-01", "2024-01-06") == (True, "ERROR", 5, 0, None)
    assert check("2024-01-01", "2024-01-07", "2024-01-08") == (False, "ERROR", 6, 1, day("2024-01-07"))
    assert check("2024-01-01") == (True, "ERROR", 0, 0, None)


def test_null_runs(spark):
    values = [1.0, None, None, 2.0, None]
    data = [("a", ts("2024-01-01 00:00") + i * H, v) for i, v in enumerate(values)] + [("a", ts("2024-01-01 07:00"), None)]
    df = spark.createDataFrame(data, "s string, t timestamp_ntz, v double")
    got = rows(quality.null_runs(df, "s", "t", "v", "hour"))
    assert [(r[1].hour, r[2].hour, r[3]) for r in got] == [(1, 2, 2), (4, 4, 1), (7, 7, 1)]


def test_reports(spark):
    df = spark.createDataFrame([(ts("2024-01-01 00:00"), 1), (ts("2024-01-02 00:00"), 2)], "ts timestamp_ntz, v int")
    assert rows(quality.run_report(df, "ts", ntz("2024-01-01 12:00:00"))) == [(2, 1, ts("2024-01-01 00:00"), ts("2024-01-02 00:00"))]
    assert [r["v"] for r in quality.tail_preview(df, ["ts"], 1).collect()] == [2]


# --- reshape, joins ------------------------------------------------------------------------------

def test_reshape(spark):
    df = spark.createDataFrame([(1, "a", 1.0), (1, "b", 2.0), (2, "a", 3.0)], "i int, n string, v double")
    assert rows(reshape.pivot_strict(df, ["i"], "n", ["a", "b"], "v")) == [(1, 1.0, 2.0), (2, 3.0, None)]
    twice = df.unionByName(df)
    with pytest.raises(Exception, match="duplicate rows for cell a"):
        reshape.pivot_strict(twice, ["i"], "n", ["a", "b"], "v").collect()
    assert rows(reshape.pivot_mean(twice, ["i"], "n", ["a", "b"], "v")) == [(1, 1.0, 2.0), (2, 3.0, 0.0)]
    wide = reshape.pivot_strict(df, ["i"], "n", ["a", "b"], "v")
    assert rows(reshape.unpivot_dropna(wide, ["i"], ["a", "b"], "n", "v")) == rows(df)


def test_null_keys_are_spread_and_kept(spark):
    left = spark.createDataFrame([(i, None if i % 2 else "k") for i in range(50)], "id int, key string")
    right = spark.createDataFrame([("k", 1), (None, 9)], "key string, hit int")
    got = left_join_spreading_nulls(left, right, "key", "id")
    assert got.count() == 50 and got.filter("hit = 1").count() == 25 and got.filter("hit = 9").count() == 0


# --- hulls --------------------------------------------------------------------------------------

def brute_hull(points):
    """A point is a vertex if all others lie within a half turn seen from it, strictly."""
    unique = sorted(set(points))
    vertices = []
    for p in unique:
        angles = sorted(math.atan2(q[1] - p[1], q[0] - p[0]) for q in unique if q != p)
        widest = max([b - a for a, b in zip(angles, angles[1:])] + [angles[0] + 2 * math.pi - angles[-1]])
        if widest > math.pi + 1e-12:
            vertices.append(p)
    return sorted(vertices)


@pytest.mark.parametrize("seed", range(4))
def test_hull_vertices_match_brute_force(seed):
    rng = np.random.default_rng(seed)
    points = rng.integers(0, 12, size=(90, 2)).astype(float) if seed % 2 else rng.normal(size=(200, 2))
    got = sorted(map(tuple, hull_vertices(points).tolist()))
    assert got == brute_hull([tuple(p) for p in points.tolist()])


def test_footprints(spark):
    square = [("sq", float(x), float(y)) for x in range(5) for y in range(5)]
    data = square + [("pt", 1.0, 2.0), ("pt", 1.0, 2.0), ("ln", 0.0, 0.0), ("ln", 1.0, 1.0), ("ln", 2.0, 2.0), ("sq", None, 1.0), (None, 1.0, 1.0)]
    df = spark.createDataFrame(data, "r string, x double, y double").withColumn("mw", F.lit(2.0)).repartition(6)
    got = {r["region"]: r for r in footprint_hulls(df, "r", "x", "y", "mw").collect()}
    assert set(got) == {"sq", "pt", "ln"}
    assert got["sq"]["wkt"] == "POLYGON ((0 0, 4 0, 4 4, 0 4, 0 0))" and (got["sq"]["capacity_mw"], got["sq"]["unit_count"]) == (50.0, 25)
    assert got["pt"]["wkt"] == "POINT (1 2)" and got["pt"]["unit_count"] == 2
    assert got["ln"]["wkt"] == "LINESTRING (0 0, 2 2)" and got["ln"]["geojson"] == '{"type":"LineString","coordinates":[[0,0],[2,2]]}'


@pytest.mark.parametrize("value", [1e13, 1e-15])
@pytest.mark.parametrize("hours", [3, 40, 60, 9_000])
def test_intervals_conserve_totals_at_extreme_rates(spark, value, hours):
    start = ts("2023-01-01 05:20:00")
    df = spark.createDataFrame([(start, start + hours * H, value)], "s timestamp_ntz, e timestamp_ntz, v double")
    out = distribute_to_hours(df, "s", "e", "v")
    assert "SinglePartition" not in out._jdf.queryExecution().executedPlan().toString()
    got = [r["value"] for r in out.collect()]
    assert len(got) == hours + 1 and math.isclose(sum(got), value, rel_tol=1e-12)


def test_pivots_refuse_unlisted_names(spark):
    df = spark.createDataFrame([(1, "a", 1.0), (1, "new", 2.0)], "i int, n string, v double")
    for pivot in (reshape.pivot_strict, reshape.pivot_mean):
        with pytest.raises(Exception, match="not listed: new"):
            pivot(df, ["i"], "n", ["a"], "v").collect()


def test_grid_index_of_missing_and_far_values(spark):
    from voltline.functions.values import grid_index

    df = spark.createDataFrame([(None,), (float("nan"),), (1e300,), (-1e300,), (2.4,)], "v double")
    assert [r[0] for r in df.select(grid_index("v", 0.0, 1.0, 5)).collect()] == [None, None, 4, 0, 2]


def test_intervals_of_thirty_years_conserve_totals(spark):
    rng = random.Random(11)
    start = ts("1965-03-01 00:00:00")  # hours before 1970 too
    data = [(start + dt.timedelta(seconds=rng.randrange(10**9)), rng.randrange(1, 30 * 365 * 86_400), rng.uniform(-5, 50)) for _ in range(60)]
    intervals = [("a", s, s + dt.timedelta(seconds=n), v) for s, n, v in data]
    df = spark.createDataFrame(intervals, "k string, s timestamp_ntz, e timestamp_ntz, v double")
    out = distribute_to_hours(df, "s", "e", "v", ["k"])
    got = {r["hour"]: r["value"] for r in out.collect()}
    want = brute_hours([i[1:] for i in rng.sample(intervals, 60)])
    assert set(got) == set(want) and all(math.isclose(got[h], want[h], rel_tol=1e-9, abs_tol=1e-9) for h in want)
    assert math.isclose(sum(got.values()), sum(v for *_, v in data), rel_tol=1e-9)


def test_long_intervals_are_few_rows(spark):
    """An interval of n hours becomes at most 2 log2(n) + 4 rows before they are summed."""
    start = ts("1990-01-01 00:30:00")
    df = spark.createDataFrame([(start + i * H, start + (i + 150_000) * H, 1.0) for i in range(200)], "s timestamp_ntz, e timestamp_ntz, v double")
    out = distribute_to_hours(df, "s", "e", "v")
    out.write.format("noop").mode("overwrite").save()
    assert out.count() == 150_200
    plan = out.select("hour")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Generate explode") == 3 and "Window" not in plan and plan.count("LogicalRDD") == 1


@pytest.mark.parametrize("spread", [1.0, 40.0])
def test_nearest_place_equals_a_scan_of_all(spark, spread):
    """10,000 points, with ties, places in a far cluster, duplicates, and positions that are none."""
    import numpy as np

    from voltline.operators.nearest import nearest_place

    rng = np.random.default_rng(3)
    places = np.round(np.concatenate([rng.normal([50, 10], spread, (300, 2)), rng.normal([-60, 170], 0.3, (200, 2)), [[0, 0], [0, 2], [2, 0], [2, 2]]]), 2)
    points = np.concatenate([rng.uniform([-90, -180], [90, 360], (3000, 2)), rng.normal([50, 10], spread, (6900, 2)), np.full((50, 2), 1.0), np.round(rng.uniform(0, 2, (50, 2)))])
    names = [f"z{i:03d}" for i in rng.permutation(len(places))]
    d = ((points[:, None, :] - places[None]) ** 2).sum(axis=2)
    order = np.array(sorted(range(len(names)), key=names.__getitem__))
    want = {i: names[order[k]] for i, k in enumerate(d[:, order].argmin(axis=1).tolist())} | {-1: None, -2: None, -3: None}
    data = [(i, *p) for i, p in enumerate(points.tolist())] + [(-1, None, 1.0), (-2, float("nan"), 1.0), (-3, 1e9, 1.0)]
    df = spark.createDataFrame(data, "id long, lat double, lon double")
    centres = spark.createDataFrame([(n, *p) for n, p in zip(names, places.tolist(), strict=True)] + [("a", None, 0.0), ("b", 1e9, 0.0)], "zone string, clat double, clon double")
    out = nearest_place(df, centres, "zone", "lat", "lon", "clat", "clon")
    got = {r["id"]: r["zone"] for r in out.collect()}
    assert got == want
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan and "Subquery" not in plan
    none = nearest_place(df, centres.limit(0), "zone", "lat", "lon", "clat", "clon")
    assert none.filter("zone IS NOT NULL").count() == 0 and none.count() == len(data)


@pytest.mark.parametrize("shape", ["disk", "ring", "grid", "line", "square"])
def test_hulls_of_many_points(spark, shape):
    """Few points reach Python, and none that matters is lost."""
    from voltline.operators import hulls

    rng = np.random.default_rng(8)
    n = 20_000
    angle, radius = rng.uniform(0, 2 * math.pi, n), np.sqrt(rng.uniform(0, 1, n))
    points = {
        "disk": np.stack([radius * np.cos(angle), radius * np.sin(angle)], axis=1),
        "ring": np.stack([np.cos(angle[:400]), np.sin(angle[:400])], axis=1),  # every point a vertex
        "grid": rng.integers(-30, 30, (n, 2)).astype(float),
        "line": np.repeat(rng.integers(0, 500, n), 2).reshape(-1, 2).astype(float),
        "square": rng.uniform(-1, 1, (n, 2)),
    }[shape]
    data = [("a" if i % 3 else "b", *p) for i, p in enumerate(points.tolist())]
    df = spark.createDataFrame(data, "region string, x double, y double").repartition(5)
    got = {r["region"]: r["wkt"] for r in footprint_hulls(df.withColumn("mw", F.lit(1.0)), "region", "x", "y", "mw").collect()}
    for region in "ab":
        want = hull_vertices(np.array([p[1:] for p in data if p[0] == region]))
        numbers = [float(x) for x in got[region].replace("(", " ").replace(")", " ").replace(",", " ").split()[1:]]
        ring = np.array(numbers).reshape(-1, 2)
        assert np.array_equal(ring[:-1] if len(want) > 2 else ring, want)
    sent = hulls.outside_corners(df, hulls.corners(df)).count()
    if shape != "ring":
        assert sent < 0.05 * n
