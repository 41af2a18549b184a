import hashlib
import json
import os
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from cumulo import config
from cumulo.functions import geo, names, rank
from cumulo.operators import bbox, build, grid, grid_store, linking, polar, robust, sessions, sites, summary
from cumulo.sources import outputs, reports, schema, tracks, volumes
from cumulo.streaming import sessions as stream

T0 = datetime(2017, 1, 4)


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def test_geometry(spark):
    assert one(spark, geo.haversine_km(0, 0, 1, 0)) == pytest.approx(111.195, abs=0.01)
    assert one(spark, geo.wrap_lon(F.lit(-190.0))) == 170
    assert one(spark, geo.wrap_around(F.lit(179.9), -179.8)) == pytest.approx(-180.1)
    lat, lon = geo.box_centre(10, 20, 170, -170)
    assert (one(spark, lat), one(spark, lon)) == (15, -180)
    low, high = geo.ray_window(F.lit(90.0), 10.0, 20.0, -1.0, 1.0)
    assert (one(spark, low), one(spark, high)) == (pytest.approx(10), pytest.approx(20))


def test_ellipsoid(spark):
    """Published geodesics, then the way back; a place itself, the date line, a pole, an opposite place and nulls."""
    dms = lambda d, m, s: d + m / 60 + s / 3600
    # the equator's and the first meridian's degree, a long line of a geodesic library's manual, and a survey manual's line
    known = [(0.0, 0.0, 0.0, 1.0, 111319.491, 90.0), (0.0, 0.0, 1.0, 0.0, 110574.389, 0.0), (40.6, -73.8, 51.6, -0.5, 5551759.400, 51.19888285),
             (-dms(37, 57, 3.7203), dms(144, 25, 29.5244), -dms(37, 39, 10.1561), dms(143, 55, 35.3839), 54972.271, dms(306, 52, 5.37))]
    odd = [(35.0, -97.0, 35.0, -97.0), (35.0, 179.9, 36.0, -179.9), (90.0, 0.0, 89.0, 50.0), (0.0, 0.0, 0.5, 179.7), (None, 0.0, 1.0, 1.0), (1.0, 0.0, None, 1.0)]
    rng = np.random.default_rng(5)
    near = [(float(a), float(o), float(a + da), float(o + do)) for a, o, da, do in zip(rng.uniform(-65, 65, 50), rng.uniform(-180, 180, 50), rng.uniform(-4, 4, 50), rng.uniform(-4, 4, 50))]
    rows = [(k, *r[:4]) for k, r in enumerate([*known, *odd, *near])]
    df = geo.project(spark.createDataFrame(rows, "k int, a double, b double, c double, d double"), {"at": ("c", "d")}, "a", "b")
    got = {r.k: r for r in geo.unproject(df, {"back": ("at.x", "at.y"), "origin": (F.lit(0.0), F.lit(0.0))}, "a", "b").collect()}
    for k, (*_, metres, azimuth) in enumerate(known):
        assert np.hypot(got[k]["at"].x, got[k]["at"].y) == pytest.approx(metres, abs=1e-3)
        assert np.degrees(np.arctan2(got[k]["at"].x, got[k]["at"].y)) % 360 == pytest.approx(azimuth, abs=2e-6)
    assert tuple(got[4]["at"]) == (0.0, 0.0) and all(got[k]["at"] is None and got[k].back is None for k in (7, 8, 9))
    for k in set(got) - {7, 8, 9}:
        r = got[k]
        # a tenth of a millimetre
        assert r.back.lat == pytest.approx(r.c, abs=1e-9) and (r.back.lon - r.d + 180) % 360 - 180 == pytest.approx(0, abs=1e-9), r
        assert r.origin.lat == pytest.approx(r.a, abs=1e-9)


def test_rays_in_a_box_equal_gates_in_it(spark):
    boxes = [(3000.0, 9000.0, -4000.0, 6000.0), (-2000.0, 2000.0, -1500.0, 900.0), (-9000.0, -2500.0, 1000.0, 7000.0)]
    rays = [(b, r, 7.5 * r, 19.5, [float(g) for g in range(12)], *box) for b, box in enumerate(boxes) for r in range(48)] + [(9, 0, None, 0.5, [1.0], 0.0, 1.0, 0.0, 1.0), (9, 1, 3.0, 0.5, None, 0.0, 1.0, 0.0, 1.0)]
    df = spark.createDataFrame(rays, "b int, ray int, azimuth double, elevation double, values array<double>, x0 double, x1 double, y0 double, y1 double")
    got = {(r.b, r.ray): r["values"] for r in polar.crop_rays(df, ["x0", "x1", "y0", "y1"], 500.0, 1000.0).collect()}
    kept = 0
    for b, (x0, x1, y0, y1) in enumerate(boxes):
        for r in range(48):
            for g in range(12):
                far, z = (500 + 1000 * g) * np.cos(np.radians(19.5)), np.radians(7.5 * r)
                inside = x0 <= far * np.sin(z) <= x1 and y0 <= far * np.cos(z) <= y1
                kept += inside
                assert got[b, r][g] == (g if inside else None)
    assert kept > 100 and got[9, 0] == [None] and got[9, 1] is None


def test_names(spark):
    assert names.canonical_fields([" Refl", None, "zdr", "ref", "My field-2"]) == ["reflectivity", "differential_reflectivity", "my_field_2"]
    assert names.choose_field("vel", ["reflectivity", "velocity"]) == "velocity"
    assert names.choose_field("nothing", ["a", "b"]) == "a"
    assert [names.bytes_text(n) for n in (0, 1023, 1024, 1 << 20)] == ["0 B", "1023 B", "1.00 KB", "1.00 MB"]
    rows = spark.createDataFrame([("2017/06/14/KDLH/KDLH20170614_044958_V06",), ("KDLH20170614_044958_V06_MDM",), ("KDLH20170614_044958_V08",)], "volume_key string")
    assert [r.volume_key for r in volumes.listing(rows).collect()] == ["KDLH20170614_044958_V08"]


def test_active_ranges_and_reach(spark):
    day = lambda d: datetime(2017, 1, d)
    s = spark.createDataFrame([("A", 0.0, 0.0, [(day(1), day(10))]), ("B", 0.0, 1.0, [(day(5), day(6))]), ("KBAD", None, None, None)], "site string, lat double, lon double, active_ranges array<struct<start:timestamp,end:timestamp>>")
    p = spark.createDataFrame([(1, 0.0, 0.9, day(4)), (2, 0.0, 0.9, day(5)), (3, 0.0, 0.9, day(12)), (4, 0.0, 50.0, day(5))], "point_id long, latitude double, longitude double, time timestamp")
    assert {r.point_id: r.radar_site for r in sites.nearest_active_site(p, s).collect()} == {1: "A", 2: "B"}


def tracks_of(spark, cases):
    rows = [(k, n, T0 + timedelta(seconds=s)) for k, times in cases.items() for n, s in enumerate(times)]
    return spark.createDataFrame(rows, "storm_id long, n int, time timestamp")


def test_majority_rule(spark):
    h = 3600
    df = tracks_of(spark, {1: [0, 6 * h, 12 * h], 2: [0, 6 * h, 12 * h + 1], 3: [0, h, 20 * h, 21 * h], 4: [0, h, 20 * h, 21 * h, 40 * h, 41 * h], 5: [0]})
    kept = sessions.majority_filter(df, 6 * h, 2).groupBy("storm_id").count().collect()
    assert {r["storm_id"]: r["count"] for r in kept} == {1: 3, 2: 2, 3: 2, 5: 2}  # 3's second half is the new storm 5


def test_two_sites_get_new_numbers(spark):
    df = spark.createDataFrame([(1, "A", T0), (1, "B", T0 + timedelta(1)), (2, "A", T0)], "storm_number long, radar_site string, time timestamp")
    assert sorted((r.storm_number, r.radar_site, r.storm_id) for r in sessions.split_by_site(df).collect()) == [(1, "A", 3), (1, "B", 4), (2, "A", 2)]


def test_asof_edges(spark):
    t = datetime(2017, 6, 14, 12)
    at = lambda s: t + timedelta(seconds=s)
    left = spark.createDataFrame([(1, "K", t), (2, "L", t), (3, "M", t), (4, "N", datetime(2017, 6, 14, 0, 0, 5)), (5, "K", t)], "row_id long, radar_site string, time timestamp")
    right = spark.createDataFrame([("a", "K", at(29)), ("b", "L", at(30)), ("c", "M", at(10)), ("d", "M", at(-10)), ("e", "N", datetime(2017, 6, 13, 23, 59, 55))], "volume_key string, site string, volume_time timestamp")
    assert {r.row_id: r.volume_key for r in linking.asof_nearest(left, right, 29).collect()} == {1: "a", 3: "d", 5: "a"}


def test_reports(spark):
    t = datetime(2017, 5, 1, 12)
    raw = spark.createDataFrame([("2017-05-01", "12:00:00", "30.0", "30.02", "-95.0", None, "70"), ("bad", "x", "1", "1", "1", "1", "1")], "date string, time string, slat string, elat string, slon string, elon string, mag string")
    r = reports.feed_b(raw).collect()
    assert len(r) == 1 and r[0].lat == pytest.approx(30.01) and r[0].lon == -95
    a = spark.createDataFrame([(t, "30.01", "-95.01", "55", "TSTM WIND"), (t, "1", "1", "1", "HAIL")], "VALID timestamp, LAT string, LON string, MAG string, TYPETEXT string")
    cells = spark.createDataFrame([(1, t, 30.0, -95.0, 29.9, 30.1, -95.1, -94.9)], "cell_id int, time timestamp, latitude double, longitude double, min_lat double, max_lat double, min_lon double, max_lon double")
    both = reports.union(reports.feed_a(a), reports.feed_b(raw))
    assert both.count() == 2 and linking.reports_near_cells(both, cells, 5).count() == 2
    body = '{"STATION":[{"STID":"X","LATITUDE":"30","LONGITUDE":"-95","OBSERVATIONS":{"date_time":["2017-05-01T12:00:00Z","2017-05-01T12:01:00Z"],"wind_gust_set_1":[5.0,null]}}]}'
    assert [r.source for r in reports.feed_stations(spark.createDataFrame([("1", body)], "network string, body string")).collect()] == ["synoptic_1"]


def test_robust(spark):
    df = spark.createDataFrame([(1, float(v), 1.0) for v in (0, 0, 0, 1, 1, 10, 10, 10, 10)] + [(2, 5.0, 5.0)] * 4 + [(3, None, None)], "k int, width_m double, height_m double")
    got = {r.k: r for r in robust.centre_and_scale(df, ["k"], ["width_m"]).collect()}
    assert got[1].width_m_centre < 5 and got[2].width_m_scale == 1 and got[3].width_m_centre is None


def test_angular_match_and_composite(spark):
    src = spark.createDataFrame([(1, 0, r, float(a)) for r, a in enumerate((359.0, 1.0, 90.0, 180.0, 270.0))], "v int, source_sweep int, source_ray int, source_azimuth double")
    hosts = spark.createDataFrame([(1, 0, 0.0), (1, 1, 91.0), (1, 2, 225.0)], "v int, host_ray int, host_azimuth double")
    assert {r.host_ray: r.source_ray for r in polar.angular_match(hosts, src, ["v"]).collect()} == {0: 0, 1: 2, 2: 3}
    rays = [(1, s, 0.5 + s, r, r * 60.0, 0.5, [float(s), None if s else 2.0, 1.0]) for s in (0, 1) for r in range(6)]
    out = polar.composite(spark.createDataFrame(rays, "v int, sweep int, fixed_angle double, ray int, azimuth double, elevation double, values array<double>"), ["v"], 90.0).collect()
    assert len(out) == 6 and all(r["values"] == [1.0, 2.0, 1.0] and r.winner_sweep == [1, 0, 0] for r in out)


def test_frames_pad_with_null(spark):
    rays = [(1, 0, 0, 0.5, 0, 0.0, 0.5, [1.0, 2.0]), (1, 1, 0, 0.5, 0, 0.0, 0.5, [3.0]), (1, 1, 0, 0.5, 1, 9.0, 0.5, [4.0])]
    out = polar.frames(spark.createDataFrame(rays, "storm int, t int, sweep int, fixed_angle double, ray int, azimuth double, elevation double, values array<double>"), ["storm", "t"]).orderBy("t").collect()
    assert [r.data for r in out] == [[1.0, 2.0, None, None], [3.0, None, 4.0, None]] and out[0]["shape"] == [2, 2, 1]


def test_regions():
    mask = np.zeros((6, 6), bool)
    mask[0, 0] = mask[0, 1] = mask[2, 2] = mask[3, 3] = True
    labels = grid.label_regions(mask)
    assert len(set(labels[mask])) == 3 and labels[0, 0] == labels[0, 1] == 1
    found = grid.regions(mask, 1)
    assert grid.merge_near(found, 0, 0.5) == [0] and len(grid.merge_near(found, 0, 2.0)) == 3
    assert not grid.close_mask(np.ones((3, 3), bool))[0, 0] and grid.close_mask(np.ones((3, 3), bool))[1, 1]
    filled = grid.mean_of_nearest(np.array([[1.0, np.nan], [3.0, 5.0]]))
    assert filled[0, 1] == 3.0


def test_grid_plan_equals_brute_force(spark):
    az = [0.0, 37.0, 90.0, 160.0, 200.0, 300.0]
    rays = spark.createDataFrame([(1, r, a) for r, a in enumerate(az)], "v int, ray int, azimuth double")
    plan = grid.grid_plan(rays, ["v"], 1000.0, 250.0, 250.0, 250.0, 5).collect()
    r, g = np.meshgrid(range(6), range(5), indexing="ij")
    rad, rng = np.radians(np.array(az)[r]), 250.0 + 250.0 * g
    gx, gy = rng * np.sin(rad), rng * np.cos(rad)
    far = 0
    for c in plan:
        d = np.hypot(gx - (c.x * 250.0 - 1000), gy - (c.y * 250.0 - 1000))
        far += d[c.ray, c.gate] > d.min() + 1e-6
    assert len(plan) == 81 and far == 0
    # the same rule on whole scans
    values = np.arange(30.0).reshape(6, 5)
    cells = grid.from_polar(np.array(az), values, 1000.0, 250.0, 250.0, 250.0)
    assert all(cells[c.y, c.x] == values[c.ray, c.gate] for c in plan)


def test_grid_plans_are_stored_by_geometry(spark, tmp_path):
    """Three volumes of two geometries, one with a ray without azimuth; against whole scans."""
    folder, of = str(tmp_path / "plans"), grid_store.Grid(250.0, 250.0, 250.0, 250.0, 5)
    assert of.half_m == 1500 and of.side == 13
    az = {1: [30.0, 100.0, 200.0, 300.0], 2: [200.0, 300.0, 390.0, 100.0], 3: [10.0, 20.0, 250.0, None]}
    rows = [(v, r, a, [float(100 * v + 10 * r + g) for g in range(5)]) for v, some in az.items() for r, a in enumerate(some)]
    rays = spark.createDataFrame(rows, "v int, ray int, azimuth double, values array<double>")
    placed = grid_store.lines(rays, ["v"]).cache()
    assert placed.select("geometry").distinct().count() == 2 and placed.where("v = 3").count() == 3
    grid_store.extend(folder, placed.where("v = 2"), ["v"], of)
    assert [r.v for r in grid_store.grids(folder, placed, ["v"], of).orderBy("v").collect()] == [1, 2]
    grid_store.extend(folder, placed, ["v"], of)
    stored = lambda: sorted((r.geometry, r.line, len(r.cells)) for r in spark.read.parquet(folder).collect())
    whole = stored()
    assert len(whole) == 7 and sum(n for *_, n in whole) == 2 * 13 * 13
    files = {p for p in (tmp_path / "plans").rglob("*.parquet")}
    grid_store.extend(folder, placed, ["v"], of)
    assert stored() == whole and {p for p in (tmp_path / "plans").rglob("*.parquet")} == files
    # a plan that lacks lines, as after a call that was broken off, is made again
    part = next((tmp_path / "plans").glob("grid=*/geometry=*"))
    two = spark.read.parquet(str(part)).limit(2).collect()
    spark.createDataFrame(two, "line int, cells array<struct<y:int,x:int,gate:int>>").write.mode("overwrite").parquet(str(part))
    grid_store.extend(folder, placed, ["v"], of)
    assert stored() == whole
    for r in grid_store.grids(folder, placed, ["v"], of).collect():
        mine = sorted((a % 360, values) for v, _, a, values in rows if v == r.v and a is not None)
        want = grid.from_polar(np.array([a for a, _ in mine]), np.array([values for _, values in mine]), of.half_m, of.step_m, of.first_range_m, of.gate_m)
        assert r["values"] == want.reshape(-1).tolist() and r.height == r.width == 13
    # jittered azimuths share the plan of even sectors, others do not
    jitter = [(v, r, (45.0 + 90 * r + (v - 1) * 0.3) % 360, [1.0] * 5) for v in (1, 2, 9) for r in range(4)]
    near = grid_store.lines(spark.createDataFrame(jitter, rays.schema), ["v"], 0.5)
    assert len({r.geometry for r in near.where("v < 9").collect()}) == 1 and near.select("geometry").distinct().count() == 2
    empty = rays.where("false")
    grid_store.extend(folder, grid_store.lines(empty, ["v"]), ["v"], of)
    assert stored() == whole and grid_store.grids(folder, grid_store.lines(empty, ["v"]), ["v"], of).count() == 0


def test_report_feeds_keep_snapshots(spark, tmp_path):
    """A snapshot serves later reads; it is made anew if forced, if a column lacks, and for other parameters."""
    cache, a = str(tmp_path / "cache"), tmp_path / "a.csv"
    line = "2017-01-04 0{h}:00:00,35.0,-97.0,{g},{kind}"
    write = lambda *g: a.write_text("\n".join(["VALID,LAT,LON,MAG,TYPETEXT", *[line.format(h=h, g=x, kind="TSTM WND GST" if h else "HAIL") for h, x in enumerate(g)]]))
    gusts = lambda **more: sorted(r.gust for r in reports.read_feed_a(spark, str(a), cache=cache, **more).collect())
    write(50, 60, 70)
    assert gusts() == [60, 70]
    write(50, 61, 71)
    assert gusts() == [60, 70] and gusts(types=("hail",)) == [50] and gusts(force=True) == [61, 71]
    snapshots = list((tmp_path / "cache").iterdir())
    assert len(snapshots) == 2
    for path in snapshots:
        spark.range(3).write.mode("overwrite").parquet(str(path))
    assert gusts() == [61, 71]
    for year in (2016, 2017):
        (tmp_path / f"{year}_wind.csv").write_text(f"date,time,slat,elat,slon,elon,mag\n{year}-05-01,12:00:00,35,37,-97,,55")
        rows = reports.read_feed_b(spark, str(tmp_path), [2016, 2017], cache).collect()
        assert {(r.time.year, r.lat, r.lon) for r in rows} == {(y, 36.0, -97.0) for y in range(2016, year + 1)}
    with pytest.raises(FileNotFoundError):
        reports.read_feed_b(spark, str(tmp_path), [1999], cache)


def test_impute_nearest(spark):
    cells = [(g, y, x, None if g == 2 or (y, x) == (0, 1) else float(3 * y + x)) for g in (1, 2) for y in range(3) for x in range(3)]
    grids = grid.pack(spark.createDataFrame(cells, "g int, y int, x int, value double"), ["g"])
    got = {(r.g, r.y, r.x): r.value for r in grid.unpack(grid.impute_nearest(grids, ["g"]), ["g"]).collect()}
    assert got[1, 0, 1] == (0 + 2 + 4 + 3) / 4 and got[1, 2, 2] == 8 and got[2, 1, 1] is None and len(got) == 18


def test_boxes(spark):
    pts = spark.createDataFrame([(1, 3.0, 3.0, True), (1, 3.5, 3.0, True), (1, -9.0, 0.0, True), (1, 0.0, 0.0, False)], "k int, x double, y double, hit boolean")
    best = bbox.box_fit(pts, ["k"], 1.0, 1.0, 10.0, 1.0).first()
    assert best.hits == 2 and abs(best.centre_x - 3) <= 1
    boxes = spark.createDataFrame([(1, T0, True, 1.0, 2.0, 1.0, 2.0), (1, T0 + timedelta(1), False, 0.0, 9.0, 0.0, 9.0), (1, T0 + timedelta(2), True, 1.5, 3.0, 1.0, 2.5)], "k int, time timestamp, fitted boolean, min_lat double, max_lat double, min_lon double, max_lon double")
    s = bbox.stationary_box(boxes, ["k"]).first()
    assert (s.min_lat, s.max_lat, s.min_lon, s.max_lon) == (1.0, 3.0, 1.0, 2.5)
    gates = spark.createDataFrame([(1, 2.0, 1.5, 7.0), (1, 8.0, 1.5, 7.0)], "k int, lat double, lon double, value double")
    assert sorted((r.lat, r.value) for r in bbox.crop_gates(gates, bbox.stationary_box(boxes, ["k"]), ["k"]).collect()) == [(2.0, 7.0), (8.0, None)]


def test_track_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Storm Number,Time,Longitude,Latitude,Max dBZ\n1,2017-01-01 00:00:00,-97,35,60\nx,bad,,,\n")
    (tmp_path / "b.csv").write_text("storm\ttime\tlon\tlat\n2\t2017-01-01 00:05:00\t-97\t35\n")
    df = tracks.read(spark, [str(tmp_path / "a.csv"), str(tmp_path / "b.csv")])
    assert df.count() == 2 and "max_dbz" in df.columns
    # a missing day, an empty one and one with a header only
    days = tmp_path / "2017"
    days.mkdir()
    (days / "20170101.csv").write_text("storm,time,lon,lat\n1,2017-01-01 00:00:00,-97,35\n")
    (days / "20170103.csv").write_text("")
    (days / "20170104.csv").write_text("storm,time,lon,lat\n")
    wanted = ["2017-01-01", "2017-01-02", "2017-01-03", "2017-01-04"]
    assert tracks.read_days(spark, str(tmp_path), 2017, wanted).count() == 1
    assert tracks.read_days(spark, str(tmp_path), 2017, wanted[1:3]).count() == 0
    assert tracks.read_days(spark, str(tmp_path / "nowhere"), 2017, wanted).count() == 0
    # snapshots are by what was asked
    cache = str(tmp_path / "cache")
    assert tracks.read_days(spark, str(tmp_path), 2017, wanted, cache).count() == 1
    (days / "20170101.csv").write_text("storm,time,lon,lat\n1,2017-01-01 00:00:00,-97,35\n2,2017-01-01 00:00:00,-97,35\n")
    assert tracks.read_days(spark, str(tmp_path), 2017, wanted, cache).count() == 1
    assert tracks.read_days(spark, str(tmp_path), 2017, wanted, cache, force=True).count() == 2
    assert tracks.read_days(spark, str(tmp_path), 2017, wanted[:1], cache).count() == 2
    with pytest.raises(KeyError):
        tracks.normalize(spark.createDataFrame([(1,)], "storm int"))
    assert len(tracks.day_list(2016)) == 366 and tracks.day_list(2017, ["2017-02-03", "2017-02-03"]) == [datetime(2017, 2, 3).date()]
    with pytest.raises(ValueError):
        tracks.day_list(2017, ["2016-01-01"])


def test_context_manifest_subset_bundle(spark, tmp_path):
    cols = "time timestamp, storm_id long, radar_site string, latitude double, longitude double, min_lat double, max_lat double, min_lon double, max_lon double, tor_endtime string, x_scan string"
    df = spark.createDataFrame([(T0, 1, "KTLX", 35.0, 190.0, 1.0, 2.0, 3.0, 4.0, "2017-01-04 01:00:00", "s"), (T0, 2, "KHGX", 35.0, 10.0, 1.0, 2.0, 3.0, 4.0, None, "s")], cols)
    rows = outputs.context_rows(df)
    assert "x_scan" not in rows.columns and rows.orderBy("storm_id").first().longitude == -170 and schema.problems(rows) == []
    outputs.write_context(df, str(tmp_path / "ctx"))
    outputs.subset_by_site(spark, str(tmp_path / "ctx"), str(tmp_path / "sub"), 2017, ["KTLX"])
    assert spark.read.parquet(str(tmp_path / "sub")).count() == 1
    outputs.subset_by_site(spark, str(tmp_path / "ctx"), str(tmp_path / "sub"), 2017, None, ["KTLX"])
    assert [r.radar_site for r in spark.read.csv(str(tmp_path / "sub-catalog"), header=True).collect()] == ["KHGX"]
    hashes = outputs.file_hashes(spark, str(tmp_path / "ctx"))
    sides = {r.applies_to: json.loads(r.sidecar) for r in outputs.sidecars(spark.read.parquet(str(tmp_path / "ctx")), hashes).collect()}
    assert len(sides) == 2
    for path, side in sides.items():
        assert side["applies_to"] == path and side["sha256"] == hashlib.sha256((tmp_path / path).read_bytes()).hexdigest()
        assert side["columns"]["time"] == {"type": "timestamp", "declared": True} and not side["columns"]["year"]["declared"]
    first, second = sorted(sides)
    listed = spark.createDataFrame([(first, None), (second, "ab"), ("ctx/gone", ""), (None, None)], "applies_to string, sha256 string")
    assert {r.applies_to: r.sha256 for r in outputs.backfill(listed, hashes).collect()} == {first: sides[first]["sha256"], second: "ab", "ctx/gone": None, None: None}
    with pytest.raises(ValueError):
        outputs.write_frames(df, str(tmp_path / "f"), {"radar_site": "KTLX"})
    frames = spark.createDataFrame([(2017, "KTLX", [1.0])], "year int, radar_site string, data array<double>")
    outputs.write_frames(frames, str(tmp_path / "f"), dict.fromkeys(schema.PRODUCT_ATTRIBUTES, "x"))
    assert json.loads(spark.read.parquet(str(tmp_path / "f")).first().attributes)["site_lat"] == "x"
    d = tmp_path / "tree/2022/KHGX/storm_1"
    d.mkdir(parents=True)
    ctx = "KHGX_1_context_T2_20220101T000000Z_20220101T000100Z.h5"
    for f in (ctx, "KHGX_1_reflectivity_T2_64x64x1ch_20220101T000000Z_20220101T000100Z.h5", "KHGX_1_velocity_T2_64x64x1ch_20220101T000000Z_20220101T000100Z.h5", "notes.txt", "stray.sha256"):
        (d / f).write_bytes(f.encode())
    (d / f"{ctx}.schema.json").write_text('{"applies_to": "%s", "sha256": "%s"}' % (ctx, "A" * 64))
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(str(tmp_path / "tree"))
    m = outputs.manifest(files, str(tmp_path / "tree"))
    assert m.where("type = 'context'").first().sha256 == "a" * 64
    c = outputs.catalog(m).first()
    assert (c.products, c.dims, c["T"]) == ("reflectivity,velocity", "reflectivity:64x64x1;velocity:64x64x1", 2)
    assert outputs.bundle(str(tmp_path / "tree"), str(tmp_path / "out.zip")).endswith("out.zip")
    index = linking.saved_index(files)
    assert [tuple(r) for r in index.collect()] == [(2022, "KHGX", 1)]
    with pytest.raises(ValueError):
        outputs.bundle(str(tmp_path / "tree"), str(tmp_path / "tree/x.zip"))


def test_config():
    c = config.load({"linking": {"min_rows": "5"}, "products": "velocity"})
    assert c.linking.min_rows == 5 and c.products == ("velocity",)
    for bad in ({"nothing": 1}, {"year": 5}):
        with pytest.raises(ValueError):
            config.load(bad)


def test_streamed_sessions_equal_batch(spark, tmp_path):
    df = tracks_of(spark, {1: [0, 6 * 3600, 12 * 3600 + 1], 2: [0]}).select("storm_id", "time")
    far = spark.createDataFrame([(9, T0 + timedelta(30))], "storm_id long, time timestamp")
    df.coalesce(1).write.parquet(str(tmp_path / "in"))
    far.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    read = stream.read_tracks(spark, str(tmp_path / "in"), "storm_id long, time timestamp", 1)
    q = stream.write(stream.sessions(read), str(tmp_path / "out"), str(tmp_path / "cp"))
    q.awaitTermination(120)
    got = sorted((r.storm_id, r.n) for r in spark.read.schema("storm_id long, start timestamp, last timestamp, n long").parquet(str(tmp_path / "out")).collect())
    want = sorted((r.storm_id, r.n) for r in stream.sessions(df).collect())
    assert want == [(1, 1), (1, 2), (2, 1)] and set(got) <= set(want + [(9, 1)]) and len(got) >= 2


def test_ranks_in_ranges_equal_one_window(spark):
    df = spark.range(500).select((F.col("id") * 37 % 101).alias("a"), F.col("id").alias("b"))
    want = {(a, b): k for k, (a, b) in enumerate(sorted((i * 37 % 101, i) for i in range(500)), 1)}
    for rows in (1_000, 60, 1):
        got = rank.add_rank(df, F.col("a"), ["a", "b"], "k", rows).collect()
        assert {(r.a, r.b): r.k for r in got} == want
    plan = rank.add_rank(df, F.col("a"), ["a", "b"], "k", 60)._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan


def test_points_are_not_moved_for_their_site(spark):
    p = spark.createDataFrame([(1, 10.0, 179.9), (2, 89.5, 0.0), (3, -10.0, -179.95)], "point_id long, latitude double, longitude double")
    s = spark.createDataFrame([("E", 10.1, -179.9), ("N", 89.0, 170.0), ("S", -10.0, 179.0), ("T", -10.0, -178.5)], "site string, lat double, lon double")
    found = sites.nearest_active_site(p, s, 250.0)
    assert {r.point_id: r.radar_site for r in found.collect()} == {1: "E", 2: "N", 3: "S"}
    text = found._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text


def test_dense_sites_are_searched_near_first(spark):
    """A tile as high as the reach would list every site; the near distances are searched first, and the lists stay short."""
    rng = np.random.default_rng(7)
    t = datetime(2017, 6, 14)
    places = [(float(a), float(o)) for a, o in zip(rng.uniform(-1, 1, 400), rng.uniform(178.5, 181.5, 400))]
    rows = [(f"S{k:04}", *places[k % 400], [(t if k % 3 else None, None if k % 5 else t + timedelta(k % 4))] if k % 7 else None) for k in range(1200)] + [("FAR", 4.0, 180.0, None), (None, None, None, None)]
    s = spark.createDataFrame(rows, "site string, lat double, lon double, active_ranges array<struct<start:timestamp,end:timestamp>>")
    points = [(k, float(a), float((o + 180) % 360 - 180), t + timedelta(int(k % 6) - 1)) for k, (a, o) in enumerate(zip(rng.uniform(-4, 7, 300), rng.uniform(176, 184, 300)))] + [(300, None, 0.0, t)]
    p = spark.createDataFrame(points, "point_id int, latitude double, longitude double, time timestamp")
    assert len(sites._distances(s.where("lat is not null"), 250.0)) > 3 and sites._distances(s.where("site = 'FAR'"), 250.0) == [250.0]

    def km(a, b, c, d):
        a, b, c, d = map(np.radians, (a, b, c, d))
        return 2 * 6371 * np.arcsin(np.sqrt(np.sin((c - a) / 2) ** 2 + np.cos(a) * np.cos(c) * np.sin((d - b) / 2) ** 2))

    def want(ranged):
        on = lambda r, u: not (ranged and r[3]) or ((r[3][0][0] or u) <= u <= (r[3][0][1] or u))
        best = {k: min(((km(a, o, r[1], r[2]), r[0]) for r in rows if r[0] and on(r, u)), default=None) for k, a, o, u in points[:300]}
        return {k: site for k, (d, site) in best.items() if d <= 250}

    for ranged in (False, True):
        found = sites.nearest_active_site(p, s if ranged else s.drop("active_ranges"), 250.0)
        assert {r.point_id: r.radar_site for r in found.collect()} == want(ranged)
    assert 150 < len(want(False)) < 300 and want(True) != want(False)


def test_sites_are_written_by_several_tasks(spark, tmp_path, monkeypatch):
    """A year of a site is one file, the sites are dealt to tasks, and a busy site's storms lie together."""
    rows = spark.range(400).selectExpr("id as row_id", "concat('S', id % 20) as radar_site", "id % 100 as storm_id", "timestamp'2017-06-14' as time", *[f"1.5D as {c}" for c in ("latitude", "longitude", *bbox.SIDES)])
    once = str(tmp_path / "once")
    outputs.write_context(rows, once)
    files = [f for _, _, names in os.walk(once) for f in names if f.endswith(".parquet")]
    assert len(files) == 20 and len({f[:10] for f in files}) > 1
    monkeypatch.setattr(outputs, "SITE_ROWS", 5)
    busy = str(tmp_path / "busy")
    outputs.write_context(rows, busy)
    storms = spark.read.parquet(busy).selectExpr("storm_id", "_metadata.file_path as file").distinct()
    assert storms.count() == 100 and spark.read.parquet(busy).count() == 400
    assert storms.select("file").distinct().count() > 20


def test_reports_meet_cells_once(spark):
    t = datetime(2017, 5, 1, 12)
    rng = np.random.default_rng(2)
    cells = [(k, t + timedelta(minutes=int(m)), 0.0, 0.0, float(a), float(a + h), float(o), float(o + w)) for k, (m, a, o, h, w) in enumerate(zip(rng.integers(0, 60, 30), rng.uniform(-5, 5, 30), rng.uniform(-5, 5, 30), rng.uniform(0, 3, 30), rng.uniform(0, 3, 30)))]
    rows = [("s", t + timedelta(minutes=int(m)), float(a), float(o), float(k), "w") for k, (m, a, o) in enumerate(zip(rng.integers(0, 60, 200), rng.uniform(-5, 5, 200), rng.uniform(-5, 5, 200)))]
    want = sorted((c[0], int(r[4])) for c in cells for r in rows if abs((c[1] - r[1]).total_seconds()) <= 600 and c[4] <= r[2] <= c[5] and c[6] <= r[3] <= c[7])
    found = linking.reports_near_cells(spark.createDataFrame(rows, "source string, time timestamp, lat double, lon double, gust double, type string"), spark.createDataFrame(cells, "cell_id int, time timestamp, latitude double, longitude double, min_lat double, max_lat double, min_lon double, max_lon double"), 10)
    assert sorted((r.cell_id, int(r.gust)) for r in found.collect()) == want and len(want) > 20


def test_summaries(spark):
    df = spark.createDataFrame([("a", "1"), ("a", "x"), ("b", "2"), ("b", "-3"), ("c", "9"), (None, "1")], "net string, v string")
    assert [(r.network, r.stations, r.reporting, r.top) for r in summary.network_summary(df, "net", "v").orderBy("network").collect()] == [("a", 2, 1, 1.0), ("b", 2, 1, 2.0)]
    assert [(r.name, r.n) for r in summary.top_counts(df, "net", 2).collect()] == [("a", 2), ("b", 2)]
    rows = spark.createDataFrame([(1, k, v) for k, v in enumerate([3, 1, 3, 4, None, 2, 5])], "g int, k int, v int")
    assert [r.v for r in summary.running_max_guard(rows, ["g"], ["k"], "v").orderBy("k").collect()] == [3, 3, 3, 4, None, 4, 5]


def test_file_name_parts(spark):
    span = "_20220101T000000Z_20220101T000100Z"
    cases = {
        f"KHGX_12_my_field_T5_8x9x1ch{span}.h5": ("KHGX", 12, "my_field", 5, 8, 9, 1),
        f"KHGX_1_T5{span}.parquet": ("KHGX", 1, "T5", None, None, None, None),
        f"KHGX_1_context{span}.h5": ("KHGX", 1, "context", None, None, None, None),
        f"KHGX_1_8x9x1ch{span}.h5": ("KHGX", 1, "8x9x1ch", None, None, None, None),
        f"KHGX_1_a-b{span}.h5": (None,) * 7, f"KHGX_x_a{span}.h5": (None,) * 7, f"khgx_1_a{span}.h5": (None,) * 7, "KHGX_1.h5": (None,) * 7, f"KHGX_1_a{span}.txt": (None,) * 7, "": (None,) * 7,
    }
    rows = spark.createDataFrame([(n,) for n in cases], "name string").withColumns(names.dataset_file_parts(F.col("name")))
    assert {r["name"]: tuple(r[c] for c in ("site", "storm_id", "kind", "T", "H", "W", "C")) for r in rows.collect()} == cases


RAYS = "volume_key string, sweep int, ray int, azimuth double, elevation double, fixed_angle double, values array<double>"
TRACKS = "row_id long, storm_number long, time timestamp, latitude double, longitude double"


def minutes(k):
    return T0 + timedelta(minutes=5 * k)


def echo_rays(volume, rays, first, last, n_gates=20, step=5.0):
    """Two sweeps of a volume; in the second one, echo on some rays from gate ``first`` to ``last``."""
    return [(volume, sweep, r, step * r, 0.5, 0.5 + sweep, [40.0 if sweep == 1 and r in rays and first <= g <= last else 5.0 for g in range(n_gates)]) for sweep in (0, 1) for r in range(int(360 / step))]


def test_build_from_tracks_to_tensors(spark, tmp_path):
    """Three storms: one within a blob of its scans, one whose volumes hold none, one whose volume is broken."""
    config_ = config.load({"linking": {"min_rows": 2}, "blobs": {"min_pixels": 4, "grid_m": 1000.0, "nearby_km": 1.0, "buffer_km": 2.0}})
    geometry = build.Geometry(first_range_m=500.0, gate_m=1000.0, max_gap_degrees=6.0)
    lats = {1: 35.09, 2: 36.0, 3: 40.0}
    tracks_ = spark.createDataFrame([(10 * s + k, s, minutes(k), lats[s], -97.0) for s in lats for k in range(3)], TRACKS)
    radars = spark.createDataFrame([("KTLX", 35.0, -97.0, 370.0), ("KNUL", None, None, None), ("KHGX", 36.0, -96.99, None), ("KBAD", 40.0, -97.0, 1.0)], "site string, lat double, lon double, alt double")
    volumes_ = spark.createDataFrame([(f"{site}-{k}", site, minutes(k) + timedelta(seconds=10)) for site in ("KTLX", "KHGX", "KBAD") for k in range(3)], "volume_key string, site string, volume_time timestamp")
    # echo from 8 to 12 km within 10 degrees of north; KHGX sees nothing; of KBAD no ray can be read
    north = {0, 1, 2, 70, 71}
    rays = [x for k in range(3) for x in echo_rays(f"KTLX-{k}", north, 7, 11) + echo_rays(f"KHGX-{k}", set(), 0, 0)]
    rays += [("KBAD-0", 0, 0, None, 0.5, 0.5, [40.0]), ("KBAD-1", 0, 0, float("nan"), 0.5, 0.5, [40.0]), ("KBAD-2", 0, 0, 10.0, 0.5, 0.5, None)]
    out = build.build(tracks_, radars, volumes_, spark.createDataFrame(rays, RAYS), config_, geometry)
    assert sorted((r.row_id, r.volume_key) for r in out.links.collect()) == sorted((10 * s + k, f"{site}-{k}") for s, site in ((1, "KTLX"), (2, "KHGX"), (3, "KBAD")) for k in range(3))
    assert {r.storm_id: (r.tracked, r.linked, r.scanned, r.fitted, r.status) for r in out.status.collect()} == {1: (3, 3, 3, 3, "written"), 2: (3, 3, 3, 0, "no blob"), 3: (3, 3, 0, 0, "no readable scan")}
    boxes = {r.row_id: r for r in out.boxes.collect()}
    assert set(boxes) == {10, 11, 12}
    # the blob lies from 8 to 12 km north of the radar and some 2 km to either side
    b = boxes[10]
    assert 35 + 6.5 / 111.2 < b.min_lat < 35 + 8.5 / 111.2 and 35 + 11 / 111.2 < b.max_lat < 35 + 13 / 111.2
    assert 1 / 91 < b.max_lon + 97 < 3.5 / 91 and b.max_lon + 97 == pytest.approx(-(b.min_lon + 97), abs=1e-6)
    still = out.storm_boxes.first()
    assert still.fitted_box and still.min_lat < 35 + 9 / 111.2 and still.max_lat > 35 + 11 / 111.2
    catalog = {r.storm_id: r for r in out.catalog.collect()}
    assert {k: (r.radar_site, r["T"], r.t0) for k, r in catalog.items()} == {1: ("KTLX", 3, T0)}
    assert schema.problems(out.context) == [] and out.context.count() == 3
    build.write(out, str(tmp_path / "set"))
    frames = spark.read.parquet(str(tmp_path / "set/frames")).collect()
    assert len(frames) == 6 and all(f["shape"] == [72, 20, 2] and (f.year, f.radar_site, f["product"]) == (2017, "KTLX", "reflectivity") for f in frames)
    assert {(f.channel, f.elevation_deg, f.azimuth_host_sweep_index) for f in frames} == {(0, 0.5, 0), (1, 1.5, 0)}
    f = frames[0]
    assert f.azimuth_deg == [5.0 * r for r in range(72)] and f.range_m[:2] == [500.0, 1500.0] and f.source_key == f"KTLX-{round((f.time - T0).seconds / 300)}"
    side = json.loads(f.attributes)
    assert set(side) == set(schema.PRODUCT_ATTRIBUTES) and side["shape_T_H_W_C"] == [3, 72, 20, 2] and side["product_prefix"] == "KTLX_1_reflectivity" and (side["site_lat"], side["site_alt_m"]) == (35.0, 370.0)
    assert side["context_sha256"] == hashlib.sha256((tmp_path / "set" / side["context_relpath"]).read_bytes()).hexdigest()
    assert side["context_relpath"] in spark.read.text(str(tmp_path / "set" / side["context_schema_relpath"])).first()["value"]
    assert (f.bbox_min_lat, f.bbox_max_lon) == (still.min_lat, still.max_lon)
    inside = ~np.isnan(np.array(f.data, float).reshape(72, 20))
    assert inside[0, 8:11].all() and not inside[0, 0] and not inside[36].any()
    assert spark.read.parquet(str(tmp_path / "set/context")).count() == 3 and spark.read.parquet(str(tmp_path / "set/catalog")).first()["T"] == 3
    assert {r.status for r in spark.read.parquet(str(tmp_path / "set/status")).collect()} == {"written", "no blob", "no readable scan"}
    again = build.build(tracks_, radars, volumes_, spark.createDataFrame(rays, RAYS), config_, geometry, saved=out.catalog.select("storm_id", "radar_site"))
    assert again.catalog.count() == 0 and {r.storm_id for r in again.status.collect()} == {2, 3}


@pytest.mark.parametrize("lon", [-97.0, 179.97])
def test_a_storm_far_from_its_radar_that_grows(spark, lon):
    """Echo 100 km north of the radar that widens from scan to scan, also where it crosses the date line, and a last
    scan without any: its box has the robust mean size, placed on the first and last scan with a blob."""
    config_ = config.load({"linking": {"min_rows": 2}, "blobs": {"min_pixels": 4, "grid_m": 1000.0, "nearby_km": 1.0, "buffer_km": 0.0}})
    geometry = build.Geometry(first_range_m=500.0, gate_m=1000.0, max_gap_degrees=6.0)
    tracks_ = spark.createDataFrame([(k, 1, minutes(k), 35.9, (lon + 180) % 360 - 180) for k in range(4)], TRACKS)
    radars = spark.createDataFrame([("KTLX", 35.0, lon)], "site string, lat double, lon double")
    volumes_ = spark.createDataFrame([(f"v{k}", "KTLX", minutes(k)) for k in range(4)], "volume_key string, site string, volume_time timestamp")
    near = [{0}, {119, 0, 1}, {118, 119, 0, 1, 2}, set()]
    rays = [x for k in range(4) for x in echo_rays(f"v{k}", near[k], 95, 105, 120, 3.0)]
    out = build.build(tracks_, radars, volumes_, spark.createDataFrame(rays, RAYS), config_, geometry)
    assert {r.row_id for r in out.boxes.collect()} == {0, 1, 2} and {r.row_id for r in out.context.collect()} == {0, 1, 2}
    ends = {r.row_id: r for r in build.fit_ends(out.boxes, polar.composite(spark.createDataFrame(rays, RAYS), ["volume_key"]), config_, geometry).collect()}
    assert set(ends) == {0, 2} and all(r.n_ends == 2 for r in ends.values())
    sizes = np.array([(r.east_m - r.west_m, r.north_m - r.south_m) for r in sorted(out.boxes.collect(), key=lambda r: r.row_id)])
    assert (np.diff(sizes[:, 0]) > 0).all() and sizes[0, 0] < ends[0].avg_width < sizes[2, 0]
    # brute force: of all 41 x 41 places, the first that holds most gates
    for k, r in ends.items():
        box = next(b for b in out.boxes.collect() if b.row_id == k)
        hx, hy = (box.west_m + box.east_m) / 2, (box.south_m + box.north_m) / 2
        at = np.array([((500 + 1000 * g) * np.sin(np.radians(3.0 * q)), (500 + 1000 * g) * np.cos(np.radians(3.0 * q))) for q in near[k] for g in range(95, 106)])
        places = [(dx, dy, int((np.abs(at[:, 0] - hx - dx) <= r.avg_width / 2 + 1e-6).astype(int) @ (np.abs(at[:, 1] - hy - dy) <= r.avg_height / 2 + 1e-6))) for dx in np.arange(-20e3, 20001, 1e3) for dy in np.arange(-20e3, 20001, 1e3)]
        dx, dy, most = max(places, key=lambda p: p[2])
        assert r.hits == most
        corner = geo.unproject(spark.range(1), {"c": (F.lit(float(hx + dx - r.avg_width / 2)), F.lit(float(hy + dy - r.avg_height / 2)))}, 35.0, lon).first()["c"]
        assert r.min_lat == pytest.approx(corner.lat, abs=1e-9)
    still = out.storm_boxes.first()
    assert still.fitted_box and 35.8 < still.min_lat < still.max_lat < 36.1 and still.min_lon < lon < still.max_lon < still.min_lon + 1
    assert (still.min_lat, still.max_lon) == (min(r.min_lat for r in ends.values()), max(r.max_lon for r in ends.values()))
    assert all(-180 <= r.min_lon < 180 and -180 <= r.max_lon < 180 for r in out.context.collect())


def test_storm_box_falls_back_to_all_scans(spark):
    columns = "storm_id long, radar_site string, min_lat double, max_lat double, min_lon double, max_lon double"
    scans = spark.createDataFrame([(1, "A", 1.0, 2.0, 3.0, 4.0), (1, "A", 5.0, 6.0, 3.0, 9.0), (2, "A", 0.0, 1.0, 0.0, 1.0)], columns)
    fits = spark.createDataFrame([(1, "A", 7.0, 8.0, 3.0, 4.0, 2), (2, "A", 0.2, 0.8, 0.2, 0.8, 1)], columns + ", n_ends int")
    got = {r.storm_id: tuple(r)[2:] for r in bbox.storm_box(scans, fits, build.STORM).collect()}
    assert got == {1: (1.0, 6.0, 3.0, 9.0, False), 2: (0.2, 0.8, 0.2, 0.8, True)}


def plain_match(hosts, source, max_gap=None):
    """(host ray: source ray) by definition, over (ray, azimuth) lists."""
    apart = lambda a, b: round(min((a - b) % 360, (b - a) % 360), 9)
    order = sorted(source, key=lambda q: (q[1], q[0]))
    around = [order[-1][1] - 360, *[a for _, a in order], order[0][1] + 360]
    gap = {r: max(a - around[k], around[k + 2] - a) for k, (r, a) in enumerate(order)}
    found = {h: min(source, key=lambda q: (apart(a, q[1]), q[0]))[0] for h, a in hosts}
    return {h: r for h, r in found.items() if max_gap is None or gap[r] <= max_gap}


@pytest.mark.parametrize("max_gap", [None, 6.0])
def test_holes_reject_the_rays_beside_them(spark, max_gap):
    rng = np.random.default_rng(3)
    even = [5.0 * r for r in range(72)]
    sweeps = {"hole": [a for a in even if a not in (100.0, 105.0)], "north": [a for a in even if a not in (0.0, 355.0)], "half": even[:36], "one": [17.0], "odd": sorted(rng.uniform(0, 360, 90).tolist()), "twice": even + [50.0]}
    hosts = [(r, a) for r, a in enumerate([*even, 102.5, 359.9])]
    rows = [(1, k, r, a) for k, name in enumerate(sweeps) for r, a in enumerate(sweeps[name])]
    got = polar.angular_match(spark.createDataFrame([(1, *h) for h in hosts], "v int, host_ray int, host_azimuth double"), spark.createDataFrame(rows, "v int, source_sweep int, source_ray int, source_azimuth double"), ["v"], max_gap)
    found = {}
    for r in got.collect():
        found.setdefault(r.source_sweep, {})[r.host_ray] = r.source_ray
    for k, name in enumerate(sweeps):
        assert found.get(k, {}) == plain_match(hosts, list(enumerate(sweeps[name])), max_gap), name
    if max_gap:
        # beside a hole of two rays the two edges go, and the hole; all others stay
        assert len(found[0]) == 72 - 4 + 1 - 0 and 3 not in found


def test_composite_with_a_hole_and_masked_gates(spark):
    """The upper sweep lacks two rays: it wins but beside the hole, where the lower one fills in."""
    rays = [("v", s, 100 * s + r, 5.0 * r, 0.5, 0.5 + s, [10.0 * (s + 1), None, float("nan") if s else 3.0, 1.0][: 4 - s]) for s in (0, 1) for r in range(72) if not (s == 1 and r in (20, 21))]
    rays += [("w", 0, r, 90.0 * r, 0.5, 0.5, [1.0]) for r in range(4)]  # too sparse for itself
    got = polar.composite(spark.createDataFrame(rays, RAYS), ["volume_key"]).collect()
    v = {r.ray: r for r in got if r.volume_key == "v"}
    assert len(v) == 72 and all(r["values"][1:] == [None, 3.0] for r in v.values())
    assert {k for k, r in v.items() if r.winner_sweep[0] == 0} == {19, 20, 21, 22} and v[19]["values"][0] == 10.0 and v[18]["values"][0] == 20.0
    assert [r["values"] for r in got if r.volume_key == "w"] == [[None]] * 4


def test_frames_follow_the_host_rays(spark):
    """Sweeps of other azimuths, a frame with fewer sweeps and rays, gates of unlike number."""
    rays = [(1, 0, 0, r, 60.0 * r, 0.5, None, [float(r), 1.0]) for r in range(5)] + [(1, 0, 1, 10 + r, (60.0 * r + 50) % 360, 1.5, 1.4, [100.0 + r, 2.0, 3.0]) for r in range(6)] + [(1, 1, 4, r, 120.0 * r, 0.7, 0.6, [7.0]) for r in range(3)]
    out = polar.frames(spark.createDataFrame(rays, "storm int, t int, sweep int, ray int, azimuth double, elevation double, fixed_angle double, values array<double>"), ["storm", "t"], 100.0, 50.0)
    got = {(r.t, r.channel): r for r in out.collect()}
    assert set(got) == {(0, 0), (0, 1), (1, 0)} and all(r["shape"] == [6, 3, 2] for r in got.values())
    first = np.array(got[0, 0].data, float).reshape(6, 3)
    # hosts look to 50, 110, ... 350: the nearest of 0, 60, ... 240
    assert first[:, 0].tolist() == [1, 2, 3, 4, 4, 0] and np.isnan(first[:, 2]).all() and first[:, 1].tolist() == [1.0] * 6
    assert np.array(got[0, 1].data, float).reshape(6, 3)[:, 0].tolist() == [100.0 + r for r in range(6)]
    assert got[0, 0].azimuth_deg == got[0, 1].azimuth_deg == [50.0, 110.0, 170.0, 230.0, 290.0, 350.0] and got[1, 0].azimuth_deg == [0.0, 120.0, 240.0, None, None, None]
    assert [got[k].range_m for k in sorted(got)] == [[100.0, 150.0, None], [100.0, 150.0, 200.0], [100.0, None, None]]
    assert [got[k].elevation_deg for k in sorted(got)] == [0.5, 1.4, 0.6] and [got[k].azimuth_host_sweep_index for k in sorted(got)] == [1, 1, 0]


def test_regions_by_runs_equal_flood_fill():
    rng = np.random.default_rng(4)
    masks = [rng.random((rng.integers(1, 12), rng.integers(1, 12))) < p for p in (0.1, 0.5, 0.7, 1.0) for _ in range(60)]
    spiral = np.zeros((41, 41), bool)
    for k in range(0, 20, 2):
        spiral[k, k : 41 - k] = spiral[40 - k, k : 41 - k] = spiral[k : 41 - k, k] = spiral[k : 41 - k, 40 - k] = True
    for mask in [*masks, spiral, np.zeros((3, 4), bool)]:
        want, todo = np.zeros(mask.shape, int), sorted(map(tuple, np.argwhere(mask)))
        for at in todo:
            stack = [at] if not want[at] else []
            while stack:
                i, j = stack.pop()
                if 0 <= i < mask.shape[0] and 0 <= j < mask.shape[1] and mask[i, j] and not want[i, j]:
                    want[i, j] = at[0] * mask.shape[1] + at[1] + 1
                    stack += [(i + 1, j), (i - 1, j), (i, j + 1), (i, j - 1)]
        assert (grid.label_regions(mask) == want).all()
        found = grid.regions(mask, 1).set_index("region")
        for region in found.index:
            y, x = np.nonzero(want == region)
            r = found.loc[region]
            assert (r.pixels, r.min_y, r.max_y, r.min_x, r.max_x) == (len(y), y.min(), y.max(), x.min(), x.max())
            assert (r.centre_y, r.centre_x) == pytest.approx((y.mean(), x.mean()))
        assert set(found.index) == set(want[want > 0])


def test_box_fit_equals_brute_force(spark):
    rng = np.random.default_rng(6)
    rows = [(int(g), float(x), float(y), bool(h)) for g, x, y, h in zip(rng.integers(0, 4, 600), rng.normal(0, 9, 600).round(1), rng.normal(2, 9, 600).round(1), rng.random(600) < 0.7)]
    half = {g: (1.5 + g, 4.0 - g) for g in range(4)}
    points = spark.createDataFrame([(*r, *half[r[0]]) for r in rows], "g int, x double, y double, hit boolean, w double, h double")
    got = {r.g: (r.centre_x, r.centre_y, r.hits) for r in bbox.box_fit(points, ["g"], F.col("w"), F.col("h"), 10.0, 0.5).collect()}
    for g, (w, h) in half.items():
        mine = np.array([(x, y) for k, x, y, hit in rows if k == g and hit])
        places = [(-int(((np.abs(mine[:, 0] - cx) <= w + 1e-6) & (np.abs(mine[:, 1] - cy) <= h + 1e-6)).sum()), cx, cy) for cx in np.arange(-10, 10.01, 0.5) for cy in np.arange(-10, 10.01, 0.5)]
        n, cx, cy = min(places)
        assert got[g] == (cx, cy, -n)


def test_values_are_raised_to_their_running_maximum(spark):
    rows = spark.createDataFrame([(1, 0, 1.0), (1, 1, 3.0), (1, 2, 2.5), (1, 3, None), (1, 4, 4.0), (2, 0, -1.0)], "k int, i int, v double")
    assert [r.v for r in summary.running_max_guard(rows, ["k"], ["i"], "v").orderBy("k", "i").collect()] == [1.0, 3.0, 3.0, None, 4.0, -1.0]


def test_pack_fills_gaps(spark):
    cells = spark.createDataFrame([("g", 0, 1, 5.0), ("g", 2, 0, None), ("g", 1, 2, 7.0), ("h", 0, 0, 1.0)], "k string, y int, x int, value double")
    got = {r.k: (r.height, r.width, r["values"]) for r in grid.pack(cells, ["k"]).collect()}
    assert got == {"g": (3, 3, [None, 5.0, None, None, None, 7.0, None, None, None]), "h": (1, 1, [1.0])}


def test_scans_are_linked_once(spark, tmp_path, monkeypatch):
    columns = "volume_key string, cell_id long, time timestamp, latitude double, longitude double, min_lat double, max_lat double, min_lon double, max_lon double"
    cell = lambda scan, k, lat: (scan, k, T0, lat, -97.0, lat - 0.1, lat + 0.1, -97.1, -96.9)
    first = [cell("a", 1, 35.0), cell("a", 2, 36.0), cell("b", 3, 50.0)]  # no report is near b
    reports_ = spark.createDataFrame([("s", T0 + timedelta(minutes=m), lat, -97.0, 50.0 + m, "w") for m, lat in ((1, 35.0), (4, 35.05), (9, 35.0), (2, 36.0))], "source string, time timestamp, lat double, lon double, gust double, type string")
    path = str(tmp_path / "links")
    assert linking.add_scans(path, spark.createDataFrame(first, columns), reports_) == 2
    links = lambda: sorted((r.volume_key, r.cell_id, r.gust, r.run) for r in linking.scan_links(spark, path).collect())
    before = [("a", 1, 51.0, 0), ("a", 1, 54.0, 0), ("a", 2, 52.0, 0)]
    assert links() == before
    # again: no scan is computed; then one more scan, and only it
    assert linking.add_scans(path, spark.createDataFrame(first, columns), reports_) == 0 and links() == before
    assert linking.add_scans(path, spark.createDataFrame([*first, cell("c", 4, 36.0)], columns), reports_) == 1
    assert links() == [*before, ("c", 4, 52.0, 1)]
    assert linking.add_scans(str(tmp_path / "none"), spark.createDataFrame([], columns), reports_) == 0


def test_links_of_dense_scans_are_not_written(spark, tmp_path):
    import pyarrow.parquet as pq

    columns = "volume_key string, cell_id long, time timestamp, latitude double, longitude double, min_lat double, max_lat double, min_lon double, max_lon double"
    cells = lambda scan, n: spark.createDataFrame([(scan, k, T0, 35.0, -97.0, 34.9, 35.1, -97.1, -96.9) for k in range(n)], columns)
    feed = lambda n, m: spark.createDataFrame([("s", T0 + timedelta(minutes=m), 35.0, -97.0, float(k), "w") for k in range(n)] + [("s", T0, 60.0, 20.0, -1.0, "far")], "source string, time timestamp, lat double, lon double, gust double, type string")
    path = tmp_path / "links"
    assert linking.add_scans(str(path), cells("a", 30), feed(40, 4)) == 1
    # a run keeps its own reports and window: these are more, and too late for the first one's
    assert linking.add_scans(str(path), cells("a", 30).unionByName(cells("b", 2)), feed(50, 20), 60) == 1
    counts = {(r.volume_key, r.run): r["count"] for r in linking.scan_links(spark, str(path)).groupBy("volume_key", "run").count().collect()}
    assert counts == {("a", 0): 30 * 40, ("b", 1): 2 * 50}
    assert sum(pq.ParquetFile(f).metadata.num_rows for f in path.rglob("*.parquet")) == 30 + 40 + 2 + 50


def test_field_parts_join_without_a_shuffle(spark, tmp_path):
    ray = lambda v, r, field, values: (v, 0, 0.5, r, 10.0 * r, 0.5, field, values)
    rows = [ray(v, r, f, [1.0 * r, float("nan"), None]) for v in ("a", "b") for r in range(6) for f in ("ref", "VEL", "sw") if (v, f) != ("b", "VEL")]
    rays = spark.createDataFrame(rows, volumes.RAYS)
    assert volumes.write_parts(rays, str(tmp_path / "parts"), "test_parts", 4) == ["reflectivity", "spectrum_width", "velocity"]
    try:
        both = volumes.read_parts(spark, "test_parts", ["refl", "vr"])
        plan = both._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "SortMergeJoin" in plan and "spectrum_width" not in plan
        # b lacks a part that is asked; nothing is missing of what is asked of reflectivity alone
        assert sorted((r.volume_key, r.ray, r.azimuth, r.velocity) for r in both.collect()) == [("a", k, 10.0 * k, [1.0 * k, None, None]) for k in range(6)]
        assert volumes.read_parts(spark, "test_parts", ["refl"]).count() == 12
    finally:
        for name in ("geometry", "reflectivity", "velocity", "spectrum_width"):
            spark.sql(f"DROP TABLE test_parts_{name}")


def test_only_asked_folders_are_listed(spark, tmp_path):
    for day in ("2017/01/04", "2017/01/05"):
        for site in ("KTLX", "KHGX", "KAMA"):
            (tmp_path / day / site).mkdir(parents=True)
            for clock in ("000100", "000600"):
                (tmp_path / day / site / f"{site}{day.replace('/', '')}_{clock}_V06").write_bytes(b"x")
            (tmp_path / day / site / f"{site}{day.replace('/', '')}_000100_V06_MDM").write_bytes(b"x")
    broken = tmp_path / "2017/01/05/KAMA"
    broken.chmod(0)  # a folder that nobody asks for is not looked into
    try:
        wanted = spark.createDataFrame([("KTLX", T0), ("KTLX", T0 + timedelta(hours=3)), ("KHGX", T0 + timedelta(days=1)), ("KNUL", T0), ("KTLX", T0 + timedelta(days=300)), (None, T0)], "site string, time timestamp")
        found = volumes.list_volumes(spark, str(tmp_path), wanted)
        assert sorted({r.volume_key.rsplit("/", 1)[0][-15:] for r in found.collect()}) == ["2017/01/04/KTLX", "2017/01/05/KHGX"] and found.count() == 4
        assert found.inputFiles() and all("KAMA" not in f for f in found.inputFiles())
        assert volumes.list_volumes(spark, str(tmp_path), wanted.where("site = 'KNUL'")).count() == 0
    finally:
        broken.chmod(0o755)


def test_volumes_of_one_geometry_are_matched_once(spark, monkeypatch):
    """Twelve volumes of three geometries: three are matched, and every volume gets the match it has alone."""
    rays = [(v, s, r, (360.0 / 9 * r + 7.0 * (v % 3) + 11.0 * s) % 360, 0.5, 0.5 + s, [float(v + s + r)]) for v in range(12) for s in range(2) for r in range(9 - s)]
    df = spark.createDataFrame(rays, "volume_key int, sweep int, ray int, azimuth double, elevation double, fixed_angle double, values array<double>")
    own, seen = polar.angular_match, []
    monkeypatch.setattr(polar, "angular_match", lambda hosts, *more: seen.append(hosts.count()) or own(hosts, *more))
    got = {(r.volume_key, r.host_ray, r.source_sweep): (r.source_ray, r.host_azimuth) for r in polar.host_index(df, ["volume_key"]).collect()}
    assert seen == [27] and len(got) == 12 * 9 * 2
    hosts = df.where("sweep = 0").selectExpr("volume_key", "ray as host_ray", "azimuth as host_azimuth")
    sources = df.selectExpr("volume_key", "sweep as source_sweep", "ray as source_ray", "azimuth as source_azimuth")
    assert {k: v[0] for k, v in got.items()} == {(r.volume_key, r.host_ray, r.source_sweep): r.source_ray for r in own(hosts, sources, ["volume_key"]).collect()}


def test_a_ray_window_is_found_once_for_all_gates(spark):
    """The window stays out of the function that is run for every gate."""
    df = spark.createDataFrame([(10.0, 0.5, [1.0] * 8, -3e3, 3e3, -5e3, 5e3)], "azimuth double, elevation double, values array<double>, x0 double, x1 double, y0 double, y1 double")
    plan = polar.crop_rays(df, ["x0", "x1", "y0", "y1"], 500.0, 1000.0)._jdf.queryExecution().optimizedPlan().toString()
    of_gates = next(line for line in plan.split("\n") if "transform(" in line)
    assert "SIN(" not in of_gates.upper()


def test_frames_have_no_file_for_every_site(spark, tmp_path):
    rows = spark.range(300).selectExpr("id as row_id", "concat('S', id % 100) as radar_site", "id % 50 as storm_id", "2017 as year", "0 as channel", "array(1.0) as data")
    outputs.write_frames(outputs.deal_sites(rows, rows, 50), str(tmp_path / "f"))
    files = [f for _, _, names in os.walk(tmp_path / "f") for f in names if f.endswith(".parquet")]
    found = spark.read.parquet(str(tmp_path / "f"))
    assert 1 < len(files) < 20 and found.count() == 300 and found.select("radar_site", F.col("_metadata.file_path")).distinct().count() == 100


def test_scratch_tables_go(spark, tmp_path):
    from cumulo.session import cut_lineage, scratch

    with scratch(spark):
        kept = cut_lineage(spark.range(3), "t")
        at = kept.inputFiles()[0].removeprefix("file://")
        kept.write.parquet(str(tmp_path / "out"))
        assert os.path.exists(at)
    assert not os.path.exists(at) and spark.read.parquet(str(tmp_path / "out")).count() == 3
    assert os.path.exists(cut_lineage(spark.range(3), "t").inputFiles()[0].removeprefix("file://"))
