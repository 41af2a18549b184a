"""The engine's queries over the driver tables, each with equivalent SQL.

The tables hold no coordinates, so positions are derived from keys by integer arithmetic. Columns that
come from trigonometry or sums of doubles are rounded, so that two engines' last digits agree.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import geo, names
from ..functions.time import micros
from ..config import load as load_config
from ..session import cut_lineage, scratch, shared_folder, spread
from ..operators import bbox, build, grid, grid_store, linking, polar, robust, sessions, sites, summary
from ..sources import outputs, reports, tracks, volumes

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _lat(k, by: int = 37) -> Column:
    return F.lit(25.0) + (F.col(k) * by % 2500) / 100.0


def _lon(k, by: int = 91) -> Column:
    return F.lit(-125.0) + (F.col(k) * by % 5800) / 100.0


def _points(spark, sf_dir) -> DataFrame:
    return _t(spark, sf_dir, "events").withColumns({"latitude": _lat("event_id"), "longitude": _lon("event_id")})


def _sites(spark, sf_dir) -> DataFrame:
    s = _t(spark, sf_dir, "supplier")
    return s.select(F.col("s_suppkey").alias("site"), _lat("s_suppkey", 613).alias("lat"), _lon("s_suppkey", 377).alias("lon"), "s_nationkey")


def _r(c, digits: int = 4) -> Column:
    return F.round(c, digits)


P = "(SELECT *, 25e0 + (event_id * 37 % 2500) / 100e0 AS latitude, -125e0 + (event_id * 91 % 5800) / 100e0 AS longitude FROM events)"
S = "(SELECT s_suppkey AS site, 25e0 + (s_suppkey * 613 % 2500) / 100e0 AS lat, -125e0 + (s_suppkey * 377 % 5800) / 100e0 AS lon FROM supplier)"


def _km(a: str, b: str, c: str, d: str) -> str:
    return f"2 * 6371e0 * asin(sqrt(least(1e0, pow(sin(radians({c} - {a}) / 2), 2) + cos(radians({a})) * cos(radians({c})) * pow(sin(radians({d} - {b}) / 2), 2))))"


_NEAR = f"""near AS (SELECT * FROM (SELECT p.*, site, {_km('p.latitude', 'p.longitude', 's.lat', 's.lon')} AS d,
  row_number() OVER (PARTITION BY event_id ORDER BY {_km('p.latitude', 'p.longitude', 's.lat', 's.lon')}, site) AS k
  FROM {P} p JOIN {S} s ON {_km('p.latitude', 'p.longitude', 's.lat', 's.lon')} <= 250) WHERE k = 1)"""


@query(f"WITH {_NEAR} SELECT event_id, site AS radar_site, round(d, 4) AS distance_km FROM near")
def nearest_site(spark, sf_dir):
    near = sites.nearest_active_site(_points(spark, sf_dir), _sites(spark, sf_dir), 250.0)
    return near.select("event_id", "radar_site", _r("distance_to_site").alias("distance_km"))


@query(f"""WITH v AS (SELECT *, CASE WHEN site % 5 <> 0 THEN TIMESTAMP '2024-01-01' + to_days(CAST(site % 7 AS INTEGER)) END AS s0,
  CASE WHEN site % 3 <> 0 THEN TIMESTAMP '2024-01-01' + to_days(CAST(site % 7 + 5 + site % 11 AS INTEGER)) END AS s1 FROM {S}),
c AS (SELECT event_id, site, {_km('p.latitude', 'p.longitude', 'v.lat', 'v.lon')} AS d FROM {P} p JOIN v ON (s0 IS NULL OR ts >= s0) AND (s1 IS NULL OR ts <= s1))
SELECT event_id, site AS radar_site, round(d, 4) AS distance_km FROM (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY d, site) AS k FROM c WHERE d <= 250) WHERE k = 1""")
def nearest_active_site(spark, sf_dir):
    day = lambda n: F.lit("2024-01-01").cast("timestamp") + F.make_dt_interval(n)
    start = F.when(F.col("site") % 5 != 0, day(F.col("site") % 7))
    end = F.when(F.col("site") % 3 != 0, day(F.col("site") % 7 + 5 + F.col("site") % 11))
    s = _sites(spark, sf_dir).withColumn("active_ranges", F.array(F.struct(start.alias("start"), end.alias("end"))))
    found = sites.nearest_active_site(_points(spark, sf_dir), s, 250.0, "ts")
    return found.select("event_id", "radar_site", _r("distance_to_site").alias("distance_km"))


_CLUSTERS = """c AS (SELECT *, sum(f) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS cluster FROM
  (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) <= INTERVAL {gap} HOUR THEN 0 ELSE 1 END AS f FROM {rows}))"""


@query(f"WITH {_CLUSTERS.format(gap=6, rows='events')} SELECT event_id, user_id, CAST(cluster AS BIGINT) AS cluster FROM c")
def track_sessions(spark, sf_dir):
    found = sessions.gap_sessions(_t(spark, sf_dir, "events"), 6 * 3600, "user_id", "ts", ("event_id",))
    return found.select("event_id", "user_id", F.col("cluster").cast("long").alias("cluster"))


@query(f"""WITH {_NEAR}, {_CLUSTERS.format(gap=6, rows='near')}
SELECT user_id, count(*) AS n_points, count(DISTINCT cluster) AS n_sessions, count(DISTINCT site) AS n_sites, round(max(d), 4) AS farthest_km FROM c GROUP BY user_id""")
def nearest_site_sessions(spark, sf_dir):
    near = sites.nearest_active_site(_points(spark, sf_dir).select("event_id", "user_id", "ts", "latitude", "longitude"), _sites(spark, sf_dir), 250.0)
    found = sessions.gap_sessions(near, 6 * 3600, "user_id", "ts", ("event_id",))
    return found.groupBy("user_id").agg(F.count("*").alias("n_points"), F.countDistinct("cluster").alias("n_sessions"), F.countDistinct("radar_site").alias("n_sites"), _r(F.max("distance_to_site")).alias("farthest_km"))


@query(f"""WITH big AS (SELECT * FROM events WHERE user_id IN (SELECT user_id FROM events GROUP BY 1 HAVING count(*) >= 3)), {_CLUSTERS.format(gap=36, rows='big')},
z AS (SELECT user_id, cluster, count(*) AS n FROM c GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY n DESC, cluster) AS place, sum(n) OVER (PARTITION BY user_id) AS total, max(n) OVER (PARTITION BY user_id) AS best FROM z),
k AS (SELECT * FROM r WHERE best >= total * 0.5 AND best >= 3 AND n >= 3),
m AS (SELECT user_id, cluster, CASE WHEN place = 1 THEN user_id ELSE (SELECT max(user_id) FROM big) + row_number() OVER (PARTITION BY place = 1 ORDER BY user_id, cluster) END AS storm_id FROM k)
SELECT event_id, CAST(storm_id AS BIGINT) AS storm_id FROM c JOIN m USING (user_id, cluster)""")
def majority_track_filter(spark, sf_dir):
    rows = _t(spark, sf_dir, "events").select("event_id", "ts", F.col("user_id").alias("storm_id"))
    return sessions.majority_filter(rows, 36 * 3600, 3, 0.5, "storm_id", "ts", ("event_id",)).select("event_id", F.col("storm_id").cast("long").alias("storm_id"))


@query("""WITH e AS (SELECT *, CASE WHEN user_id % 2 = 0 THEN event_id % 2 ELSE 0 END AS site FROM events),
p AS (SELECT user_id, site, min(ts) AS t FROM e GROUP BY 1, 2), q AS (SELECT * FROM p WHERE user_id IN (SELECT user_id FROM p GROUP BY 1 HAVING count(*) > 1)),
n AS (SELECT user_id, site, (SELECT max(user_id) FROM events) + row_number() OVER (ORDER BY t, user_id, site) AS fresh FROM q)
SELECT event_id, CAST(coalesce(fresh, user_id) AS BIGINT) AS storm_id FROM e LEFT JOIN n USING (user_id, site)""")
def split_multi_group(spark, sf_dir):
    rows = _t(spark, sf_dir, "events").withColumn("site", F.when(F.col("user_id") % 2 == 0, F.col("event_id") % 2).otherwise(F.lit(0)))
    return sessions.split_by_site(rows, "user_id", "site", "ts").select("event_id", "storm_id")


@query("SELECT event_id, user_id FROM events WHERE user_id IN (SELECT user_id FROM events GROUP BY 1 HAVING count(*) >= 65)")
def min_rows_filter(spark, sf_dir):
    return sessions.min_rows(_t(spark, sf_dir, "events"), "user_id", 65).select("event_id", "user_id")


@query("""WITH l AS (SELECT event_id, user_id % 25 AS site, ts FROM events WHERE event_type = 'click'), r AS (SELECT event_id AS k, user_id % 25 AS site, ts AS vt FROM events WHERE event_type = 'view'),
c AS (SELECT event_id, k, vt, abs(epoch_us(ts) - epoch_us(vt)) AS gap FROM l JOIN r ON l.site = r.site AND CAST(ts AS DATE) = CAST(vt AS DATE))
SELECT event_id, k AS volume_key, gap AS gap_us FROM (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY gap, vt, k) AS n FROM c WHERE gap <= 1800000000) WHERE n = 1""")
def asof_link(spark, sf_dir):
    e = _t(spark, sf_dir, "events").withColumn("radar_site", F.col("user_id") % 25)
    left = e.where("event_type = 'click'").select("event_id", "radar_site", F.col("ts").alias("time"))
    right = e.where("event_type = 'view'").select(F.col("event_id").alias("volume_key"), F.col("radar_site").alias("site"), F.col("ts").alias("volume_time"))
    return linking.asof_nearest(left, right, 1800, "event_id").select("event_id", "volume_key", "gap_us")


@query(f"""WITH p AS (SELECT * FROM {P}), c AS (SELECT * FROM p WHERE event_type = 'purchase'), r AS (SELECT * FROM p WHERE event_type = 'error')
SELECT c.event_id AS cell_id, r.event_id AS report_id, round({_km('c.latitude', 'c.longitude', 'r.latitude', 'r.longitude')}, 4) AS obs_distance
FROM c JOIN r ON abs(epoch_us(c.ts) - epoch_us(r.ts)) <= 3600000000 AND r.latitude BETWEEN c.latitude - 1e0 AND c.latitude + 1e0 AND r.longitude BETWEEN c.longitude - 2e0 AND c.longitude + 2e0""")
def space_time_reports(spark, sf_dir):
    p = _points(spark, sf_dir)
    box = {"min_lat": F.col("latitude") - 1.0, "max_lat": F.col("latitude") + 1.0, "min_lon": F.col("longitude") - 2.0, "max_lon": F.col("longitude") + 2.0}
    cells = p.where("event_type = 'purchase'").select(F.col("event_id").alias("cell_id"), F.col("ts").alias("time"), "latitude", "longitude").withColumns(box)
    found = p.where("event_type = 'error'").select(F.lit("events").alias("source"), F.col("ts").alias("time"), F.col("latitude").alias("lat"), F.col("longitude").alias("lon"), F.col("event_id").alias("gust"), F.lit("").alias("type"))
    return linking.reports_near_cells(found, cells, 60).select("cell_id", F.col("gust").alias("report_id"), _r("obs_distance").alias("obs_distance"))


@query(f"""WITH p AS (SELECT * FROM {P}), c AS (SELECT * FROM p WHERE event_type = 'purchase'), r AS (SELECT * FROM p WHERE event_type = 'error')
SELECT c.event_id AS cell_id, c.event_id // 3 AS volume_key, r.event_id AS report_id, round({_km('c.latitude', 'c.longitude', 'r.latitude', 'r.longitude')}, 4) AS obs_distance, CAST(c.event_id // 3 % 2 AS INTEGER) AS run
FROM c JOIN r ON abs(epoch_us(c.ts) - epoch_us(r.ts)) <= 3600000000 AND r.latitude BETWEEN c.latitude - 1e0 AND c.latitude + 1e0 AND r.longitude BETWEEN c.longitude - 2e0 AND c.longitude + 2e0""")
def scan_links(spark, sf_dir):
    """The table after three runs: over every second scan, over all scans, and over all once more."""
    p = _points(spark, sf_dir)
    box = {"min_lat": F.col("latitude") - 1.0, "max_lat": F.col("latitude") + 1.0, "min_lon": F.col("longitude") - 2.0, "max_lon": F.col("longitude") + 2.0}
    cells = p.where("event_type = 'purchase'").select(F.col("event_id").alias("cell_id"), F.floor(F.col("event_id") / 3).alias("volume_key"), F.col("ts").alias("time"), "latitude", "longitude").withColumns(box)
    found = p.where("event_type = 'error'").select(F.lit("events").alias("source"), F.col("ts").alias("time"), F.col("latitude").alias("lat"), F.col("longitude").alias("lon"), F.col("event_id").alias("gust"), F.lit("").alias("type"))
    path = f"{shared_folder(spark)}/scan-links-{uuid.uuid4().hex}"
    for scans in (cells.where("volume_key % 2 = 0"), cells, cells):
        linking.add_scans(path, scans, found, 60)
    return linking.scan_links(spark, path).select("cell_id", "volume_key", F.col("gust").alias("report_id"), _r("obs_distance").alias("obs_distance"), "run")


@query(f"""SELECT source, count(*) AS n, round(sum(latitude), 4) AS lat_sum, min(event_id) AS first_id FROM (
SELECT 'a' AS source, * FROM {P} WHERE lower(event_type) IN ('click', 'view') UNION ALL SELECT 'b', * FROM {P} WHERE event_type = 'error' UNION ALL SELECT 'c', * FROM {P} WHERE value > 10) GROUP BY source""")
def union_reports(spark, sf_dir):
    p = _points(spark, sf_dir)
    feed = lambda name, rows: rows.select(F.lit(name).alias("source"), F.col("ts").alias("time"), F.col("latitude").alias("lat"), F.col("longitude").alias("lon"), F.col("event_id").alias("gust"), F.col("event_type").alias("type"))
    all_ = reports.union(feed("a", p.where(F.lower("event_type").isin("click", "view"))), feed("b", p.where("event_type = 'error'")), feed("c", p.where("value > 10")))
    return all_.groupBy("source").agg(F.count("*").alias("n"), _r(F.sum("lat")).alias("lat_sum"), F.min("gust").alias("first_id"))


@query("SELECT event_type, CAST(json_extract(props, '$.k') AS BIGINT) AS k, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY 1, 2")
def json_props(spark, sf_dir):
    e = _t(spark, sf_dir, "events").withColumn("k", F.from_json("props", "k bigint")["k"])
    return e.groupBy("event_type", "k").agg(F.count("*").alias("n"), _r(F.sum("value"), 2).alias("total"))


@query("""SELECT 'synoptic_' || event_type AS source, count(*) AS n, round(sum(value), 2) AS gusts, min(epoch_us(ts)) AS first_us FROM events GROUP BY 1""")
def station_json(spark, sf_dir):
    stamp = lambda c: F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    obs = F.struct(F.array(stamp("ts"), F.lit("beyond the gusts")).alias("date_time"), F.array("value").alias("wind_gust_set_1"))
    station = F.struct(F.col("user_id").cast("string").alias("STID"), F.col("latitude").cast("string").alias("LATITUDE"), F.col("longitude").cast("string").alias("LONGITUDE"), obs.alias("OBSERVATIONS"))
    bodies = _points(spark, sf_dir).select(F.col("event_type").alias("network"), F.to_json(F.struct(F.array(station).alias("STATION"))).alias("body"))
    found = reports.feed_stations(bodies)
    return found.groupBy("source").agg(F.count("*").alias("n"), _r(F.sum("gust"), 2).alias("gusts"), F.min(micros("time")).alias("first_us"))


@query("""SELECT CASE event_id % 4 WHEN 0 THEN ' TSTM WIND' ELSE 'Non-Tstm Wnd Gst' END AS type, count(*) AS n, round(sum(value), 2) AS gusts, max(epoch_us(ts)) // 1000000 AS last_s FROM events WHERE event_id % 4 IN (0, 1) GROUP BY 1""")
def wind_reports(spark, sf_dir):
    kinds = F.element_at(F.array(*map(F.lit, (" TSTM WIND", "Non-Tstm Wnd Gst", "HAIL", "tornado"))), (F.col("event_id") % 4 + 1).cast("int"))
    raw = _points(spark, sf_dir).select(F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("VALID"), F.col("latitude").cast("string").alias("LAT"), F.col("longitude").cast("string").alias("LON"), F.col("value").cast("string").alias("MAG"), kinds.alias("TYPETEXT"))
    found = reports.feed_a(raw)
    return found.groupBy("type").agg(F.count("*").alias("n"), _r(F.sum("gust"), 2).alias("gusts"), F.max(F.unix_seconds("time")).alias("last_s"))


@query("""WITH e AS (SELECT user_id, value AS w, CAST(event_id % 97 + 1 AS DOUBLE) AS h FROM events), m AS (SELECT user_id, median(w) AS mw, median(h) AS mh FROM e GROUP BY 1),
d AS (SELECT e.user_id, any_value(mw) AS mw, any_value(mh) AS mh, median(abs(w - mw)) AS dw, median(abs(h - mh)) AS dh FROM e JOIN m USING (user_id) GROUP BY 1),
c AS (SELECT user_id, avg(w) FILTER (abs(w - mw) <= 2.5 * CASE WHEN dw = 0 THEN 1 ELSE dw END) AS cw, avg(h) FILTER (abs(h - mh) <= 2.5 * CASE WHEN dh = 0 THEN 1 ELSE dh END) AS ch,
  greatest(any_value(dw), 1) AS sw, greatest(any_value(dh), 1) AS sh FROM e JOIN d USING (user_id) GROUP BY 1),
s AS (SELECT user_id, w, h, 1 / (1 + abs(w - cw) / (sw + 1e-12)) / (1 + abs(h - ch) / (sh + 1e-12)) AS q FROM e JOIN c USING (user_id))
SELECT user_id, round(sum(q * w) / sum(q), 4) AS avg_width, round(sum(q * h) / sum(q), 4) AS avg_height FROM s GROUP BY 1""")
def robust_weighted_mean(spark, sf_dir):
    e = _t(spark, sf_dir, "events").select("user_id", F.col("value").alias("width_m"), (F.col("event_id") % 97 + 1).cast("double").alias("height_m"))
    return robust.weighted_dimensions(e, ["user_id"]).select("user_id", _r("avg_width").alias("avg_width"), _r("avg_height").alias("avg_height"))


@query("""WITH e AS (SELECT l_returnflag AS f, min(l_extendedprice) AS lo, (max(l_extendedprice) - min(l_extendedprice)) / 20 AS step FROM lineitem GROUP BY 1),
b AS (SELECT l_returnflag AS f, lo, step, least(floor((l_extendedprice - lo) / step), 19) AS bin FROM lineitem JOIN e ON l_returnflag = f),
c AS (SELECT f, bin, count(*) AS n, any_value(lo) AS lo, any_value(step) AS step FROM b GROUP BY 1, 2)
SELECT f AS l_returnflag, CAST(bin AS BIGINT) AS bin, n, round(lo + (bin + 0.5) * step, 4) AS mode FROM (SELECT *, row_number() OVER (PARTITION BY f ORDER BY n DESC, bin) AS k FROM c) WHERE k = 1""")
def hist_mode(spark, sf_dir):
    found = robust.histogram_mode(_t(spark, sf_dir, "lineitem"), ["l_returnflag"], "l_extendedprice")
    return found.select("l_returnflag", F.col("bin").cast("long").alias("bin"), "n", _r("mode").alias("mode"))


@query("""SELECT CAST(least(floor((l_quantity - 1e0) * 10 / 49e0), 9) AS BIGINT) AS bx, CAST(least(floor((l_discount - 0e0) * 5 / 0.1e0), 4) AS BIGINT) AS by, count(l_extendedprice) AS n, round(avg(l_extendedprice), 4) AS mean
FROM lineitem WHERE l_quantity BETWEEN 1 AND 50 AND l_discount BETWEEN 0e0 AND 0.1e0 GROUP BY 1, 2""")
def hist_2d_mean(spark, sf_dir):
    found = robust.histogram_2d_mean(_t(spark, sf_dir, "lineitem"), "l_quantity", "l_discount", "l_extendedprice", (1.0, 50.0, 0.0, 0.1), (10, 5))
    return found.select(F.col("bx").cast("long").alias("bx"), F.col("by").cast("long").alias("by"), "n", _r("mean").alias("mean"))


_GATES = "(SELECT label, vec_id, unnest(embedding) AS v, generate_subscripts(embedding, 1) - 1 AS gate FROM embeddings)"


def _gates(spark, sf_dir) -> DataFrame:
    return volumes.gates(_t(spark, sf_dir, "embeddings").withColumnRenamed("embedding", "values"), 0.0, 1.0)


@query(f"SELECT label, CAST(gate AS INTEGER) AS gate, round(CAST(max(v) AS DOUBLE), 6) AS value FROM {_GATES} GROUP BY 1, 2")
def composite_max(spark, sf_dir):
    return polar.best_of_gates(_gates(spark, sf_dir), ["label", "gate"], "value", []).select("label", "gate", _r(F.col("value").cast("double"), 6).alias("value"))


@query(f"SELECT label, CAST(gate AS INTEGER) AS gate, vec_id AS winner FROM (SELECT *, row_number() OVER (PARTITION BY label, gate ORDER BY v DESC, vec_id) AS k FROM {_GATES}) WHERE k = 1")
def winner_index(spark, sf_dir):
    return polar.best_of_gates(_gates(spark, sf_dir), ["label", "gate"], "value", ["vec_id"]).select("label", "gate", F.col("vec_id").alias("winner"))


def _rays(spark, sf_dir) -> DataFrame:
    e = _t(spark, sf_dir, "embeddings")
    return e.select("label", F.col("vec_id").alias("ray"), ((F.col("vec_id") * 37 % 3600) / 10.0).alias("azimuth"), (F.col("vec_id") % 5).cast("int").alias("sweep"), ((F.col("vec_id") % 5) * 7 % 5).cast("double").alias("fixed_angle"), F.lit(0.5).alias("elevation"), F.col("embedding").alias("values"))


@query("""WITH s AS (SELECT label, CAST(vec_id % 5 AS INTEGER) AS sweep, vec_id % 5 * 7 % 5 AS a, count(*) AS n FROM embeddings GROUP BY 1, 2, 3)
SELECT label, sweep, n AS n_rays FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY n DESC, a, sweep) AS k FROM s) WHERE k = 1""")
def host_sweep(spark, sf_dir):
    return polar.host_sweep(_rays(spark, sf_dir), ["label"])


@query("""WITH r AS (SELECT label, vec_id, vec_id * 37 % 3600 AS a, row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS ray, count(*) OVER (PARTITION BY label) AS n FROM embeddings),
f AS (SELECT label, ray AS first FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY a, ray) AS k FROM r) WHERE k = 1)
SELECT label, vec_id, CAST((ray - first + n) % n AS INTEGER) AS rolled FROM r JOIN f USING (label)""")
def canonical_roll(spark, sf_dir):
    from pyspark.sql import Window

    r = _rays(spark, sf_dir).withColumnRenamed("ray", "vec_id").withColumn("ray", F.row_number().over(Window.partitionBy("label").orderBy("vec_id")) - 1)
    return polar.canonical_roll(r.select("label", "vec_id", "ray", "azimuth"), ["label"]).select("label", "vec_id", "rolled")


@query("""WITH r AS (SELECT label, vec_id, (vec_id * 37 % 3600) / 10e0 AS a FROM embeddings),
c AS (SELECT h.label, h.vec_id AS host_ray, s.vec_id AS source_ray, round(least((h.a - s.a + 360) % 360, 360 - (h.a - s.a + 360) % 360), 9) AS d FROM r h JOIN r s ON h.label = s.label AND h.vec_id % 2 = 0 AND s.vec_id % 2 = 1)
SELECT label, host_ray, source_ray, round(d, 6) AS angle FROM (SELECT *, row_number() OVER (PARTITION BY label, host_ray ORDER BY d, source_ray) AS k FROM c) WHERE k = 1""")
def angular_match(spark, sf_dir):
    r = _rays(spark, sf_dir)
    hosts = r.where("ray % 2 = 0").select("label", F.col("ray").alias("host_ray"), F.col("azimuth").alias("host_azimuth"))
    sources = r.where("ray % 2 = 1").select("label", F.lit(0).alias("source_sweep"), F.col("ray").alias("source_ray"), F.col("azimuth").alias("source_azimuth"))
    return polar.angular_match(hosts, sources, ["label"]).select("label", "host_ray", "source_ray", _r("angle", 6).alias("angle"))


@query(f"""SELECT vec_id, count(*) FILTER (coalesce(v, 0) >= 0.1) AS n_hits, count(v) FILTER (gate BETWEEN 8 AND 40) AS n_kept, round(sum(CAST(v AS DOUBLE)) FILTER (gate BETWEEN 8 AND 40), 4) AS kept_sum FROM {_GATES} GROUP BY 1""")
def threshold_crop(spark, sf_dir):
    e = _t(spark, sf_dir, "embeddings").withColumn("embedding", F.col("embedding").cast("array<double>"))
    hits = F.size(F.filter(polar.threshold_mask(F.col("embedding"), 0.1), lambda x: x))
    kept = F.filter(polar.crop(F.col("embedding"), F.transform("embedding", lambda v, i: i.between(8, 40))), lambda v: v.isNotNull())
    return e.select("vec_id", hits.cast("long").alias("n_hits"), F.size(kept).cast("long").alias("n_kept"), _r(F.aggregate(kept, F.lit(0.0), lambda s, v: s + v)).alias("kept_sum"))


def _cells(spark, sf_dir, side: int = 64) -> DataFrame:
    from pyspark.sql import Window

    row = F.row_number().over(Window.partitionBy("label").orderBy("vec_id")) - 1
    e = _t(spark, sf_dir, "embeddings").select("label", row.alias("row"), "embedding")
    # grids of a fixed size: vectors of a label, cut into squares
    cells = e.select("label", "row", F.posexplode("embedding").alias("place", "value"))
    block = F.floor(F.col("row") / side) * (64 // side) + F.floor(F.col("place") / side)
    return cells.select("label", block.cast("int").alias("block"), (F.col("row") % side).alias("y"), (F.col("place") % side).alias("x"), "value")


_CELLS16 = """e AS (SELECT label, (row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1) AS r, embedding FROM embeddings),
cell AS (SELECT label, r, generate_subscripts(embedding, 1) - 1 AS p, unnest(embedding) AS v FROM e),
g AS (SELECT label, CAST(r // 16 * 4 + p // 16 AS INTEGER) AS block, r % 16 AS y, p % 16 AS x, CAST(v AS DOUBLE) AS v FROM cell),
size AS (SELECT label, block, max(y) AS top, max(x) AS side FROM g GROUP BY 1, 2),
near AS (SELECT a.i AS dy, b.i AS dx FROM range(-1, 2) a(i), range(-1, 2) b(i)),
wide AS (SELECT DISTINCT g.label, g.block, y + dy AS y, x + dx AS x FROM g CROSS JOIN near JOIN size USING (label, block) WHERE v >= 0.05 AND y + dy BETWEEN 0 AND top AND x + dx BETWEEN 0 AND side),
closed AS (SELECT label, block, y - dy AS y, x - dx AS x FROM wide CROSS JOIN near GROUP BY ALL HAVING count(*) = 9),
cells AS (SELECT c.label, c.block, c.y, c.x, c.y * (side + 1) + c.x + 1 AS id FROM closed c JOIN size USING (label, block) WHERE c.y BETWEEN 0 AND top AND c.x BETWEEN 0 AND side),
reach AS (SELECT label, block, y, x, id AS seen FROM cells UNION SELECT c.label, c.block, c.y, c.x, r.seen FROM reach r JOIN cells c ON r.label = c.label AND r.block = c.block AND abs(r.y - c.y) + abs(r.x - c.x) = 1),
labelled AS (SELECT label, block, y, x, min(seen) AS region FROM reach GROUP BY 1, 2, 3, 4),
regions AS (SELECT label, block, region, count(*) AS pixels, avg(y) AS centre_y, avg(x) AS centre_x, min(y) AS min_y, max(y) AS max_y, min(x) AS min_x, max(x) AS max_x FROM labelled GROUP BY 1, 2, 3 HAVING count(*) >= 4)"""


@query(f"""WITH RECURSIVE {_CELLS16} SELECT label, block, CAST(region AS BIGINT) AS region, pixels, round(centre_y, 6) AS centre_y, round(centre_x, 6) AS centre_x,
CAST(min_y AS INTEGER) AS min_y, CAST(max_y AS INTEGER) AS max_y, CAST(min_x AS INTEGER) AS min_x, CAST(max_x AS INTEGER) AS max_x FROM regions""")
def region_stats(spark, sf_dir):
    found = grid.region_stats(grid.pack(_cells(spark, sf_dir, 16), ["label", "block"]), ["label", "block"], 0.05, 4)
    return found.withColumns({"centre_y": _r("centre_y", 6), "centre_x": _r("centre_x", 6)})


@query(f"""WITH RECURSIVE {_CELLS16},
point AS (SELECT label, block, top, side, least(5, top) AS py, least(7, side) AS px FROM size),
first AS (SELECT * FROM (SELECT r.*, row_number() OVER (PARTITION BY r.label, r.block ORDER BY l.region IS DISTINCT FROM r.region, sqrt((centre_y - 5e0) ** 2 + (centre_x - 7e0) ** 2), r.region) AS k
  FROM regions r JOIN point p ON r.label = p.label AND r.block = p.block LEFT JOIN labelled l ON l.label = p.label AND l.block = p.block AND l.y = p.py AND l.x = p.px) WHERE k = 1),
grown AS (SELECT label, block, min_y, max_y, min_x, max_x, 0 AS step FROM first UNION ALL
  SELECT g.label, g.block, least(any_value(g.min_y), min(r.min_y)), greatest(any_value(g.max_y), max(r.max_y)), least(any_value(g.min_x), min(r.min_x)), greatest(any_value(g.max_x), max(r.max_x)), any_value(g.step) + 1
  FROM grown g JOIN regions r ON g.label = r.label AND g.block = r.block AND sqrt(greatest(0, r.min_x - (g.max_x + 1), (g.min_x - 1) - r.max_x) ** 2 + greatest(0, r.min_y - (g.max_y + 1), (g.min_y - 1) - r.max_y) ** 2) <= 1
  WHERE g.step < 40 GROUP BY g.label, g.block),
box AS (SELECT * FROM grown WHERE step = 40)
SELECT b.label, b.block, CAST(sum(r.pixels) AS BIGINT) AS pixels, CAST(any_value(b.min_y) AS INTEGER) AS min_y, CAST(any_value(b.max_y) AS INTEGER) AS max_y, CAST(any_value(b.min_x) AS INTEGER) AS min_x, CAST(any_value(b.max_x) AS INTEGER) AS max_x, CAST(count(*) AS INTEGER) AS n_merged
FROM box b JOIN regions r ON b.label = r.label AND b.block = r.block AND sqrt(greatest(0, r.min_x - (b.max_x + 1), (b.min_x - 1) - r.max_x) ** 2 + greatest(0, r.min_y - (b.max_y + 1), (b.min_y - 1) - r.max_y) ** 2) <= 1 GROUP BY 1, 2""")
def blob_for_point(spark, sf_dir):
    grids = grid.pack(_cells(spark, sf_dir, 16), ["label", "block"]).withColumn("point_y", F.lit(5.0)).withColumn("point_x", F.lit(7.0))
    return grid.blob_for_point(grids, ["label", "block"], 0.05, 4, 1.0)


@query("""WITH e AS (SELECT label, (row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1) AS r, embedding FROM embeddings),
c AS (SELECT label, r // 64 AS block, r % 64 AS y, generate_subscripts(embedding, 1) - 1 AS x, unnest(embedding) AS v FROM e),
g AS (SELECT label, block, y, x, CASE WHEN (y * 64 + x) % 53 <> 0 THEN CAST(v AS DOUBLE) END AS v FROM c),
n AS (SELECT a.label, a.block, a.y, a.x, b.v, row_number() OVER (PARTITION BY a.label, a.block, a.y, a.x ORDER BY (a.y - b.y) * (a.y - b.y) + (a.x - b.x) * (a.x - b.x), b.y, b.x) AS k
  FROM g a JOIN g b ON a.label = b.label AND a.block = b.block AND a.v IS NULL AND b.v IS NOT NULL AND abs(a.y - b.y) <= 3 AND abs(a.x - b.x) <= 3)
SELECT label, CAST(block AS INTEGER) AS block, CAST(y AS INTEGER) AS y, CAST(x AS INTEGER) AS x, round(avg(v), 6) AS value FROM n WHERE k <= 4 GROUP BY ALL""")
def impute_nearest(spark, sf_dir):
    gone = (F.col("y") * 64 + F.col("x")) % 53 == 0
    grids = grid.pack(_cells(spark, sf_dir).withColumn("value", F.when(~gone, F.col("value"))), ["label", "block"])
    return grid.unpack(grid.impute_nearest(grids, ["label", "block"]), ["label", "block"]).where(gone & F.col("value").isNotNull()).select("label", "block", "y", "x", _r("value", 6).alias("value"))


# one volume of three sweeps: even spacing, except that the third covers half the circle and so fails the guard
_SWEEPS = """r AS (SELECT vec_id AS ray, CAST(vec_id % 3 AS INTEGER) AS sweep, vec_id % 3 * 2 % 3 + 0.5 AS angle, vec_id * CASE WHEN vec_id % 3 = 2 THEN 180e0 ELSE 360e0 END / (SELECT count(*) FROM embeddings) AS az, embedding FROM embeddings)"""


def _sweeps(spark, sf_dir) -> DataFrame:
    e = _t(spark, sf_dir, "embeddings")
    n, k = F.lit(e.count()), F.col("vec_id") % 3
    azimuth = F.col("vec_id") * F.when(k == 2, 180.0).otherwise(360.0) / n
    return e.select(F.lit(1).alias("volume"), F.col("vec_id").alias("ray"), azimuth.alias("azimuth"), k.cast("int").alias("sweep"), (k * 2 % 3 + 0.5).alias("fixed_angle"), F.lit(0.5).alias("elevation"), F.col("embedding").alias("values"))


# volumes of 256 rays in three sweeps of 4.2 degrees; the second has a hole of some rays, elsewhere in each volume, the third covers half the circle
_VOLUMES = """r AS (SELECT *, vec_id // 256 AS volume, vec_id AS ray, CAST(vec_id % 3 AS INTEGER) AS sweep, vec_id % 3 * 2 % 3 + 0.5e0 AS angle, (vec_id % 256) * CASE WHEN vec_id % 3 = 2 THEN 180e0 ELSE 360e0 END / 256 AS az
FROM embeddings WHERE vec_id % 3 <> 1 OR (vec_id % 256 + 17 * (vec_id // 256)) % 256 >= 9)"""


def _volumes(spark, sf_dir) -> DataFrame:
    i = F.col("vec_id")
    volume, k, place = F.floor(i / 256), i % 3, i % 256
    e = _t(spark, sf_dir, "embeddings").where((k != 1) | ((place + 17 * volume) % 256 >= 9))
    azimuth = place * F.when(k == 2, 180.0).otherwise(360.0) / 256
    return e.select(volume.alias("volume"), i.alias("ray"), azimuth.alias("azimuth"), k.cast("int").alias("sweep"), (k * 2 % 3 + 0.5).alias("fixed_angle"), F.lit(0.5).alias("elevation"), F.col("embedding").alias("values"))


# by definition: the nearest ray of every sweep to every host ray, rejected by the wider of its own two spacings
@query(f"""WITH {_VOLUMES},
w AS (SELECT volume, ray, sweep, angle, az, embedding, greatest(az - coalesce(lag(az) OVER o, max(az) OVER p - 360), coalesce(lead(az) OVER o, min(az) OVER p + 360) - az) AS gap FROM r WINDOW o AS (PARTITION BY volume, sweep ORDER BY az, ray), p AS (PARTITION BY volume, sweep)),
s AS (SELECT volume, sweep FROM (SELECT volume, sweep, row_number() OVER (PARTITION BY volume ORDER BY count(*) DESC, angle, sweep) AS k FROM r GROUP BY volume, sweep, angle) WHERE k = 1),
h AS (SELECT r.* FROM r JOIN s USING (volume, sweep)),
c AS (SELECT h.volume, h.ray, q.sweep, q.angle, q.embedding, q.gap, q.ray AS source, round(least((h.az - q.az + 360) % 360, 360 - (h.az - q.az + 360) % 360), 9) AS d FROM h JOIN w q USING (volume)),
m AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY ray, sweep ORDER BY d, source) AS k FROM c) WHERE k = 1 AND gap <= 6),
g AS (SELECT ray, sweep, angle, generate_subscripts(embedding, 1) - 1 AS gate, unnest(embedding) AS v FROM m),
b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY ray, gate ORDER BY v DESC, angle, sweep) AS k FROM g) WHERE k = 1)
SELECT h.volume, h.ray, count(v) AS n_valid, round(coalesce(sum(CAST(v AS DOUBLE) * (gate + 1)), 0), 4) AS checksum, CAST(coalesce(sum(b.sweep * (gate + 1)), 0) AS BIGINT) AS winners FROM h LEFT JOIN b USING (ray) GROUP BY 1, 2""")
def polar_composite(spark, sf_dir):
    found = polar.composite(_volumes(spark, sf_dir), ["volume"], 6.0)
    weighted = lambda c: F.aggregate(F.transform(c, lambda v, i: F.coalesce(v.cast("double"), F.lit(0.0)) * (i + 1)), F.lit(0.0), lambda a, v: a + v)
    valid = F.size(F.filter("values", lambda v: v.isNotNull()))
    return found.select("volume", "ray", valid.cast("long").alias("n_valid"), _r(weighted("values")).alias("checksum"), weighted("winner_sweep").cast("long").alias("winners"))


@query("""SELECT CAST(label AS VARCHAR) AS volume_key, CAST(vec_id % 5 AS INTEGER) AS sweep, vec_id AS ray, (vec_id * 37 % 3600) / 10e0 AS azimuth, list_sum(list_transform(embedding[1:32], lambda v: round(CAST(v AS DOUBLE) * 1000))) AS reflectivity, list_sum(list_transform(embedding[33:64], lambda v: round(CAST(v AS DOUBLE) * 1000))) AS velocity
FROM embeddings WHERE vec_id % 7 <> 0""")
def field_parts(spark, sf_dir):
    """Rays put together from a store of geometry and three fields, of which one is not asked and one lacks some rays."""
    base = _rays(spark, sf_dir).withColumn("volume_key", F.col("label").cast("string"))
    part = lambda name, first, rows: rows.select("volume_key", "sweep", "ray", "azimuth", "elevation", "fixed_angle", F.lit(name).alias("field"), F.slice("values", first, 32).alias("values"))
    rays = part("REF", 1, base).unionByName(part("vel", 33, base.where("ray % 7 <> 0"))).unionByName(part("SW", 9, base))
    name = uuid.uuid4().hex
    volumes.write_parts(rays, f"{shared_folder(spark)}/parts-{name}", f"parts_{name}", 8)
    total = lambda c: F.aggregate(F.transform(c, lambda v: F.round(v.cast("double") * 1000)), F.lit(0.0), lambda a, v: a + v).alias(c)
    return volumes.read_parts(spark, f"parts_{name}", ["Refl", "velocity"]).select("volume_key", "sweep", "ray", "azimuth", total("reflectivity"), total("velocity"))


# cells nearest to gates by definition: every cell with every gate
@query(f"""WITH {_SWEEPS}, u AS (SELECT * FROM r WHERE sweep = 0),
cell AS (SELECT a.i AS y, b.i AS x, (b.i - 6) * 4.7e0 AS cx, (a.i - 6) * 4.7e0 AS cy FROM range(13) a(i), range(13) b(i)),
polar AS (SELECT *, (degrees(atan2(cx, cy)) + 360) % 360 AS az FROM cell),
one AS (SELECT * FROM (SELECT y, x, cx, cy, ray, u.az, row_number() OVER (PARTITION BY y, x ORDER BY round(least((polar.az - u.az + 360) % 360, 360 - (polar.az - u.az + 360) % 360), 9), ray) AS k FROM polar, u) WHERE k = 1),
gate AS (SELECT y, x, o.ray, i AS gate, row_number() OVER (PARTITION BY y, x ORDER BY round((cx - (3 + i * 1.5e0) * sin(radians(o.az))) ** 2 + (cy - (3 + i * 1.5e0) * cos(radians(o.az))) ** 2, 7), i) AS k FROM one o, range(64) t(i))
SELECT CAST(y AS INTEGER) AS y, CAST(x AS INTEGER) AS x, g.ray, CAST(gate AS INTEGER) AS gate, round(CAST(embedding[gate + 1] AS DOUBLE), 6) AS value FROM gate g JOIN u ON g.ray = u.ray WHERE k = 1""")
def cell_gates(spark, sf_dir):
    r = _sweeps(spark, sf_dir).where("sweep = 0")
    plan = grid.grid_plan(r, ["volume"], 28.2, 4.7, 3.0, 1.5, 64)
    found = plan.join(grid.gather(plan, r, ["volume"]), ["volume", "y", "x"])
    return found.select("y", "x", "ray", "gate", _r(F.col("value").cast("double"), 6).alias("value"))


# every 64 rows are a volume, turned by one of three angles; by definition, every cell with every ray of its volume, then every gate
@query("""WITH r AS (SELECT vec_id // 64 AS volume, vec_id AS ray, (vec_id % 64) * 5.625e0 + vec_id // 64 % 3 * 0.7e0 AS az, embedding FROM embeddings),
cell AS (SELECT a.i AS y, b.i AS x, (b.i - 11) * 9e0 AS cx, (a.i - 11) * 9e0 AS cy FROM range(23) a(i), range(23) b(i)),
polar AS (SELECT *, (degrees(atan2(cx, cy)) + 360) % 360 AS az FROM cell),
one AS (SELECT * FROM (SELECT y, x, cx, cy, volume, ray, r.az, row_number() OVER (PARTITION BY volume, y, x ORDER BY round(least((polar.az - r.az + 360) % 360, 360 - (polar.az - r.az + 360) % 360), 9), r.az, ray) AS k FROM polar, r) WHERE k = 1),
gate AS (SELECT volume, y, x, o.ray, i AS gate, row_number() OVER (PARTITION BY volume, y, x ORDER BY round((cx - (3 + i * 1.5e0) * sin(radians(o.az))) ** 2 + (cy - (3 + i * 1.5e0) * cos(radians(o.az))) ** 2, 7), i) AS k FROM one o, range(64) t(i)),
n AS (SELECT volume, len(azimuths) AS plan_rows, count(*) OVER (PARTITION BY azimuths) AS n_sharing FROM (SELECT volume, list(az ORDER BY az) AS azimuths FROM r GROUP BY volume))
SELECT g.volume, count(*) AS n_cells, round(sum(CAST(embedding[gate + 1] AS DOUBLE) * (y * 23 + x + 1)), 4) AS checksum, any_value(n_sharing) AS n_sharing, any_value(plan_rows) AS plan_rows FROM gate g JOIN r ON g.ray = r.ray JOIN n ON g.volume = n.volume WHERE k = 1 GROUP BY 1""")
def stored_grids(spark, sf_dir):
    """Grids from a store that is filled with the even volumes first, then with those geometries that it has not."""
    i = F.col("vec_id")
    volume = F.floor(i / 64)
    azimuth = (i % 64) * 5.625 + volume % 3 * 0.7
    rays = _t(spark, sf_dir, "embeddings").select(volume.alias("volume"), i.alias("ray"), azimuth.alias("azimuth"), F.col("embedding").alias("values"))
    placed, of = grid_store.lines(rays, ["volume"]), grid_store.Grid(9.0, 1.5, 3.0, 1.5, 64)
    folder = f"{shared_folder(spark)}/plans-{uuid.uuid4().hex}"
    grid_store.extend(folder, placed.where("volume % 2 = 0"), ["volume"], of)
    grid_store.extend(folder, placed, ["volume"], of)
    total = F.aggregate(F.transform("values", lambda v, k: v * (k + 1)), F.lit(0.0), lambda a, v: a + v)
    rows = spark.read.parquet(folder).groupBy("geometry").agg(F.count("*").alias("plan_rows"))
    shared = placed.select("volume", "geometry").distinct().withColumn("n_sharing", F.count("*").over(Window.partitionBy("geometry"))).join(rows, "geometry")
    found = grid_store.grids(folder, placed, ["volume"], of).join(shared, "volume")
    return found.select("volume", F.size("values").cast("long").alias("n_cells"), _r(total).alias("checksum"), "n_sharing", "plan_rows")


# frames of three sweeps with azimuths of their own; by definition, every host ray with every ray of each sweep
@query("""WITH f AS (SELECT label, vec_id AS ray, CAST(vec_id % 4 AS INTEGER) AS t, CAST(vec_id % 3 AS INTEGER) AS sweep, (vec_id * 37 % 3600) / 10e0 AS az, embedding[1:CAST(20 + label AS INTEGER)] AS v FROM embeddings),
n AS (SELECT label, t, sweep, count(*) AS h, row_number() OVER (PARTITION BY label, t ORDER BY sweep) - 1 AS channel FROM f GROUP BY 1, 2, 3),
d AS (SELECT label, max(h) AS h, max(channel) + 1 AS c FROM n GROUP BY 1), host AS (SELECT label, t, arg_min(sweep, (-h, sweep)) AS sweep, arg_min(channel, (-h, sweep)) AS host FROM n GROUP BY 1, 2),
a AS (SELECT f.*, host, row_number() OVER (PARTITION BY label, t ORDER BY ray) - 1 AS line FROM f JOIN host USING (label, t, sweep)),
m AS (SELECT * FROM (SELECT a.label, a.t, a.line, a.az, a.host, s.sweep, s.v, row_number() OVER (PARTITION BY a.ray, s.sweep ORDER BY round(least((a.az - s.az + 360) % 360, 360 - (a.az - s.az + 360) % 360), 9), s.ray) AS k FROM a JOIN f s ON a.label = s.label AND a.t = s.t) WHERE k = 1),
v AS (SELECT label, t, sweep, line, generate_subscripts(v, 1) - 1 AS gate, unnest(v) AS value FROM m),
z AS (SELECT label, t, sweep, round(sum(az * (line + 1)), 3) AS azimuths, any_value(host) AS host FROM m GROUP BY 1, 2, 3)
SELECT label, t, CAST(channel AS INTEGER) AS channel, CAST(any_value(d.h) AS INTEGER) AS H, CAST(20 + label AS INTEGER) AS W, CAST(any_value(d.c) AS INTEGER) AS C, count(value) AS filled, round(sum(CAST(value AS DOUBLE) * (line * (20 + label) + gate + 1)), 3) AS checksum,
  any_value(azimuths) AS azimuths, CAST(any_value(host) AS INTEGER) AS host_index, CAST(max(sweep) AS DOUBLE) AS elevation_deg, CAST(1000 + 250 * (19 + label) AS DOUBLE) AS last_range_m FROM v JOIN n USING (label, t, sweep) JOIN z USING (label, t, sweep) JOIN d USING (label) GROUP BY 1, 2, 3""")
def tensor_frames(spark, sf_dir):
    e = _t(spark, sf_dir, "embeddings")
    i = F.col("vec_id")
    rays = e.select("label", (i % 4).cast("int").alias("t"), (i % 3).cast("int").alias("sweep"), (i % 3).cast("double").alias("fixed_angle"), i.alias("ray"), ((i * 37 % 3600) / 10.0).alias("azimuth"), F.lit(0.5).alias("elevation"), F.slice("embedding", F.lit(1), F.col("label") + 20).alias("values"))
    f = polar.frames(rays, ["label", "t"], 1000.0, 250.0)
    weighted = lambda c: F.aggregate(F.transform(c, lambda v, i: F.coalesce(v.cast("double"), F.lit(0.0)) * (i + 1)), F.lit(0.0), lambda a, v: a + v)
    shape = [F.get("shape", F.lit(k)).cast("int").alias(n) for k, n in enumerate("HWC")]
    return f.select("label", "t", "channel", *shape, F.size(F.filter("data", lambda v: v.isNotNull())).cast("long").alias("filled"), _r(weighted("data"), 3).alias("checksum"), _r(weighted("azimuth_deg"), 3).alias("azimuths"), F.col("azimuth_host_sweep_index").cast("int").alias("host_index"), "elevation_deg", F.array_max("range_m").alias("last_range_m"))


@query(f"""WITH b AS (SELECT user_id, min(latitude) AS a0, max(latitude) AS a1, min(longitude) AS o0, max(longitude) AS o1 FROM (SELECT * FROM {P} WHERE event_type = 'error') GROUP BY 1),
w AS (SELECT *, 5 / 110.574 AS da, 5 / (111.320 * greatest(cos(radians((a0 + a1) / 2)), 1e-6)) AS d FROM b)
SELECT event_id, CASE WHEN latitude BETWEEN a0 - da AND a1 + da AND longitude BETWEEN o0 - d AND o1 + d THEN value END AS value FROM {P} JOIN w USING (user_id)""")
def crop_gates(spark, sf_dir):
    p = _points(spark, sf_dir)
    around = p.where("event_type = 'error'").select("user_id", F.col("latitude").alias("min_lat"), F.col("latitude").alias("max_lat"), F.col("longitude").alias("min_lon"), F.col("longitude").alias("max_lon"))
    gates = p.select("event_id", "user_id", F.col("latitude").alias("lat"), F.col("longitude").alias("lon"), "value")
    return bbox.crop_gates(gates, bbox.union_box(around, ["user_id"]), ["user_id"], 5.0).select("event_id", "value")


@query("""WITH p AS (SELECT event_type, (event_id * 37 % 400) / 10e0 - 20 AS x, (event_id * 91 % 400) / 10e0 - 20 AS y FROM events WHERE value >= 10),
c AS (SELECT ix, iy, ix - 10e0 AS cx, iy - 10e0 AS cy FROM range(21) a(ix), range(21) b(iy)),
h AS (SELECT event_type, ix, iy, cx, cy, count(*) AS hits FROM p JOIN c ON abs(x - cx) <= 5 + 1e-9 AND abs(y - cy) <= 5 + 1e-9 GROUP BY ALL)
SELECT event_type, cx AS centre_x, cy AS centre_y, hits FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY hits DESC, ix, iy) AS k FROM h) WHERE k = 1""")
def box_fit(spark, sf_dir):
    e = _t(spark, sf_dir, "events").select("event_type", ((F.col("event_id") * 37 % 400) / 10.0 - 20).alias("x"), ((F.col("event_id") * 91 % 400) / 10.0 - 20).alias("y"), (F.col("value") >= 10).alias("hit"))
    return bbox.box_fit(e, ["event_type"], 5.0, 5.0, 10.0, 1.0)


@query(f"""WITH p AS (SELECT *, min(ts) OVER (PARTITION BY user_id) AS t0, max(ts) OVER (PARTITION BY user_id) AS t1, event_type IN ('click', 'view') AND ts IN (min(ts) OVER (PARTITION BY user_id), max(ts) OVER (PARTITION BY user_id)) AS fit FROM {P})
SELECT user_id, round(coalesce(min(latitude - 0.5) FILTER (fit), min(latitude - 0.5)), 6) AS min_lat, round(coalesce(max(latitude + 0.5) FILTER (fit), max(latitude + 0.5)), 6) AS max_lat,
  round(coalesce(min(longitude - 0.5) FILTER (fit), min(longitude - 0.5)), 6) AS min_lon, round(coalesce(max(longitude + 0.5) FILTER (fit), max(longitude + 0.5)), 6) AS max_lon FROM p GROUP BY 1""")
def stationary_bbox(spark, sf_dir):
    p = _points(spark, sf_dir).select("user_id", F.col("ts").alias("time"), F.col("event_type").isin("click", "view").alias("fitted"), "latitude", "longitude")
    found = bbox.stationary_box(bbox.default_box(p, "latitude", "longitude"), ["user_id"])
    return found.select("user_id", *[_r(s, 6).alias(s) for s in bbox.SIDES])


_FILES = """(SELECT doc_id, n_chars, 'K' || lpad(CAST(doc_id % 20 AS VARCHAR), 3, '0') || '_' || CAST(doc_id % 7 AS VARCHAR) || CASE WHEN doc_id % 3 = 0 THEN '_context_T' || CAST(doc_id % 50 AS VARCHAR) WHEN doc_id % 11 = 0 THEN '_bad-name'
  ELSE '_' || CASE WHEN doc_id % 2 = 0 THEN 'reflectivity' ELSE 'velocity' END || '_T' || CAST(doc_id % 50 AS VARCHAR) || '_64x' || CAST(doc_id % 9 + 1 AS VARCHAR) || 'x1ch' END || '_20220101T000000Z_20220101T000100Z.h5' AS name FROM documents)"""
# the names' pieces by position, as those above are built
_PIECE = "string_split(replace(name, '.h5', ''), '_')"
_SIDE = f"string_split(replace({_PIECE}[5], 'ch', ''), 'x')"
_SHAPED = f"len({_PIECE}) = 7"
_PIECES = {"site": f"{_PIECE}[1]", "storm": f"{_PIECE}[2]", "kind": f"{_PIECE}[3]", "t": f"replace({_PIECE}[4], 'T', '')", "h": f"CASE WHEN {_SHAPED} THEN {_SIDE}[1] END", "w": f"CASE WHEN {_SHAPED} THEN {_SIDE}[2] END", "c": f"CASE WHEN {_SHAPED} THEN {_SIDE}[3] END", "t0": f"{_PIECE}[-2]", "t1": f"{_PIECE}[-1]"}
_PARTS = ", ".join(f"CASE WHEN {_PIECE}[3] <> 'bad-name' THEN {sql} END AS {n}" for n, sql in _PIECES.items())


def _files(spark, sf_dir) -> DataFrame:
    text = lambda c: c.cast("string")
    i = F.col("doc_id")
    product = F.concat(F.lit("_"), F.when(i % 2 == 0, "reflectivity").otherwise("velocity"), F.lit("_T"), text(i % 50), F.lit("_64x"), text(i % 9 + 1), F.lit("x1ch"))
    middle = F.when(i % 3 == 0, F.concat(F.lit("_context_T"), text(i % 50))).when(i % 11 == 0, "_bad-name").otherwise(product)
    name = F.concat(F.lit("K"), F.lpad(text(i % 20), 3, "0"), F.lit("_"), text(i % 7), middle, F.lit("_20220101T000000Z_20220101T000100Z.h5"))
    return _t(spark, sf_dir, "documents").select("doc_id", F.col("n_chars").alias("size_bytes"), name.alias("name"))


@query(f"SELECT doc_id, site, coalesce(CAST(storm AS INTEGER), -1) AS storm_id, kind, coalesce(CAST(t AS INTEGER), -1) AS n_times, coalesce(CAST(w AS INTEGER), -1) AS width, t0 FROM (SELECT doc_id, {_PARTS} FROM {_FILES})")
def manifest_parse(spark, sf_dir):
    rows = _files(spark, sf_dir).withColumns(names.dataset_file_parts(F.col("name")))
    known = lambda c, n: F.coalesce(F.col(c), F.lit(-1)).alias(n)
    return rows.select("doc_id", "site", known("storm_id", "storm_id"), "kind", known("T", "n_times"), known("W", "width"), "t0")


@query(f"""WITH f AS (SELECT doc_id, n_chars, name, {_PARTS} FROM {_FILES})
SELECT site, CAST(storm AS INTEGER) AS storm_id, coalesce(max(CAST(t AS INTEGER)) FILTER (kind = 'context'), -1) AS n_times, coalesce(string_agg(DISTINCT kind, ',' ORDER BY kind) FILTER (kind <> 'context'), '') AS products,
  coalesce(string_agg(kind || ':' || h || 'x' || w || 'x' || c, ';' ORDER BY lpad(CAST(doc_id AS VARCHAR), 12, '0')) FILTER (kind <> 'context' AND h IS NOT NULL), '') AS dims, CAST(sum(n_chars) AS BIGINT) AS total_bytes
FROM f WHERE site IS NOT NULL GROUP BY 1, 2""")
def catalog_rollup(spark, sf_dir):
    rows = _files(spark, sf_dir).withColumns(names.dataset_file_parts(F.col("name"))).withColumn("relpath", F.lpad(F.col("doc_id").cast("string"), 12, "0"))
    found = outputs.catalog(rows.withColumn("type", F.when(F.col("kind") == "context", "context").otherwise("product")))
    return found.select("site", "storm_id", F.coalesce("T", F.lit(-1)).alias("n_times"), "products", "dims", "total_bytes")


_STORM = "'2022/K00' || CAST(page_id % 5 AS VARCHAR) || '/storm_' || CAST(page_id // 4 AS VARCHAR) || '/K00' || CAST(page_id % 5 AS VARCHAR) || '_' || CAST(page_id // 4 AS VARCHAR)"
_SPAN = "'_20220101T000000Z_20220101T000100Z.h5'"


@query(f"""WITH f AS (SELECT page_id // 4 AS storm, page_id % 4 AS part, {_STORM} || CASE page_id % 4 WHEN 0 THEN '_context_T7' ELSE '_reflectivity_T7_8x9x1ch' END || {_SPAN} AS relpath, html FROM pages WHERE page_id % 4 < 2)
SELECT relpath, CASE part WHEN 0 THEN 'context' ELSE 'product' END AS type, CAST(octet_length(encode(html)) AS BIGINT) AS size_bytes,
  CASE WHEN part = 0 AND EXISTS (SELECT 1 FROM pages p WHERE p.page_id = f.storm * 4 + 2) THEN sha256(CAST(storm AS VARCHAR)) ELSE sha256(html) END AS sha256, 7 AS n_times, CASE WHEN part = 1 THEN 9 ELSE -1 END AS width FROM f
UNION ALL SELECT 'storm_' || CAST(page_id AS VARCHAR) || '.schema.json', 'schema_json', -1, '', -1, -1 FROM pages WHERE page_id % 4 = 2""")
def file_manifest(spark, sf_dir):
    text = lambda c: c.cast("string")
    page, storm = F.col("page_id"), text(F.floor(F.col("page_id") / 4))
    site = lambda c: F.concat(F.lit("K00"), text(c % 5))
    stem = lambda of, kind: F.concat(site(of), F.lit("_"), storm, F.lit(kind + "_20220101T000000Z_20220101T000100Z.h5"))
    folder = F.concat(F.lit("/data/set/2022/"), site(page), F.lit("/storm_"), storm, F.lit("/"))
    kind = page % 4
    path = F.when(kind == 0, F.concat(folder, stem(page, "_context_T7"))).when(kind == 1, F.concat(folder, stem(page, "_reflectivity_T7_8x9x1ch"))).when(kind == 2, F.concat(F.lit("/data/set/storm_"), text(page), F.lit(".schema.json"))).otherwise(F.concat(folder, F.lit("stray.sha256")))
    side = F.concat(F.lit('{"applies_to": "x/'), stem(page - 2, "_context_T7"), F.lit('", "sha256": "'), F.upper(F.sha2(storm, 256)), F.lit('"}'))
    files = _t(spark, sf_dir, "pages").select(path.alias("path"), F.octet_length("html").cast("long").alias("length"), F.lit(None).cast("timestamp").alias("modificationTime"), F.when(kind == 2, side).otherwise(F.col("html")).cast("binary").alias("content"))
    found = outputs.manifest(files, "/data/set")
    known = lambda c, n, other=-1: F.when(F.col("type") != "schema_json", F.coalesce(F.col(c), F.lit(other))).otherwise(F.lit(other)).alias(n)
    return found.select("relpath", "type", known("size_bytes", "size_bytes"), known("sha256", "sha256", ""), known("T", "n_times"), known("W", "width"))


@query("SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_custkey IS NOT NULL AND o_orderpriority = '1-URGENT')")
def resume_skip(spark, sf_dir):
    saved = _t(spark, sf_dir, "orders").where("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("c_custkey"))
    return sessions.resume(_t(spark, sf_dir, "customer"), saved, ["c_custkey"]).select("c_custkey", "c_name")


@query("""SELECT event_id, 'K' || lpad(CAST(user_id % 30 AS VARCHAR), 3, '0') AS radar_site FROM events WHERE year(ts) = 2024 AND user_id % 30 IN (3, 4, 5) AND user_id % 30 <> 4""")
def subset_by_site(spark, sf_dir):
    rows = _t(spark, sf_dir, "events").select("event_id", F.year("ts").alias("year"), F.concat(F.lit("K"), F.lpad((F.col("user_id") % 30).cast("string"), 3, "0")).alias("radar_site"))
    return outputs.subset_rows(rows, 2024, ["K003", "K004", "K005"], ["K004"]).select("event_id", "radar_site")


@query("""SELECT event_id AS storm_id, epoch_us(ts) // 1000 AS time_unix_ms, 'K' || CAST(event_id % 7 AS VARCHAR) AS radar_site, round(((-125e0 + (event_id * 91 % 5800) / 100e0) * 3 + 180) - 360 * floor(((-125e0 + (event_id * 91 % 5800) / 100e0) * 3 + 180) / 360) - 180, 6) AS longitude,
CASE WHEN event_id % 3 = 0 THEN '' ELSE strftime(ts, '%Y-%m-%dT%H:%M:%SZ') END AS tor_endtime, 11 AS n_columns FROM events""")
def context_normalize(spark, sf_dir):
    p = _points(spark, sf_dir)
    raw = p.select(F.col("ts").alias("time"), F.col("event_id").cast("string").alias("storm_id"), F.concat(F.lit("K"), (F.col("event_id") % 7).cast("string")).alias("radar_site"), "latitude", (F.col("longitude") * 3).alias("longitude"), F.lit(1).alias("min_lat"), F.lit(2).alias("max_lat"), F.lit(3.0).alias("min_lon"), F.lit(4.0).alias("max_lon"), F.when(F.col("event_id") % 3 == 0, "unknown").otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).alias("tor_endtime"), F.lit("x").alias("velocity_scan"))
    rows = outputs.context_rows(raw)
    return rows.select("storm_id", "time_unix_ms", "radar_site", _r("longitude", 6).alias("longitude"), "tor_endtime", F.lit(len(rows.columns)).alias("n_columns"))


@query("""SELECT kind, name, n FROM (SELECT *, row_number() OVER (PARTITION BY kind ORDER BY n DESC, name) AS k FROM (
SELECT 'source' AS kind, source AS name, count(*) AS n FROM documents GROUP BY 2 UNION ALL SELECT 'event', event_type, count(*) FROM events GROUP BY 2)) WHERE k <= 5""")
def top_counts(spark, sf_dir):
    top = lambda name, kind, column: summary.top_counts(_t(spark, sf_dir, name), column).select(F.lit(kind).alias("kind"), "name", "n")
    return top("documents", "source", "source").unionByName(top("events", "event", "event_type"))


@query(f"""SELECT event_id % 2 AS part, user_id AS storm_number, count(*) AS n, round(sum(latitude), 2) AS latitude, count(peak) AS n_peaks, min(epoch_us(ts)) AS first_us
FROM (SELECT *, CASE WHEN event_id % 2 = 0 THEN value END AS peak FROM {P}) GROUP BY 1, 2""")
def scan_chain(spark, sf_dir):
    p, stamp = _points(spark, sf_dir), F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    text = lambda c: F.col(c).cast("string")
    day = lambda k, columns: tracks.normalize(p.where(F.col("event_id") % 2 == k).select(*[c.alias(n) for n, c in columns.items()], F.lit(k).alias("Part")))
    both = tracks.unite([
        day(0, {"Storm Number": text("user_id"), "Time (UTC)": stamp, "Longitude": text("longitude"), "Latitude": text("latitude"), "Peak dBZ": F.col("value")}),
        day(1, {" storm id": F.concat(text("user_id"), F.lit(".0")), "LAT": text("latitude"), "obs time": stamp, "lon": text("longitude")}),
    ])
    return both.groupBy(F.col("part").cast("long").alias("part"), "storm_number").agg(F.count("*").alias("n"), _r(F.sum("latitude"), 2).alias("latitude"), F.count("peak_dbz").alias("n_peaks"), F.min(micros("time")).alias("first_us"))


@query("""WITH k AS (SELECT 'K' || lpad(CAST(event_id % 40 AS VARCHAR), 3, '0') || strftime(ts, '%Y%m%d_%H%M%S') || CASE WHEN event_id % 4 = 0 THEN '_V06_MDM' ELSE '_V06' END AS key FROM events),
v AS (SELECT key, regexp_extract(key, '^([A-Z0-9]{4})(\\d{8})_(\\d{6})(?:_([A-Za-z0-9]+))?(?:\\.gz)?$', 1) AS site, substr(key, 5, 15) AS stamp FROM k)
SELECT site, max(key) AS volume_key, CAST(epoch_us(strptime(stamp, '%Y%m%d_%H%M%S')) AS BIGINT) AS time_us FROM v WHERE site <> '' GROUP BY site, stamp""")
def volume_listing(spark, sf_dir):
    e = _t(spark, sf_dir, "events")
    key = F.concat(F.lit("K"), F.lpad((F.col("event_id") % 40).cast("string"), 3, "0"), F.date_format("ts", "yyyyMMdd_HHmmss"), F.when(F.col("event_id") % 4 == 0, "_V06_MDM").otherwise("_V06"))
    return volumes.listing(e.select(key.alias("volume_key"))).select("site", "volume_key", micros("volume_time").alias("time_us"))


@query("""SELECT CASE event_id % 6 WHEN 0 THEN 'reflectivity' WHEN 1 THEN 'differential_reflectivity' WHEN 2 THEN 'velocity' WHEN 3 THEN 'cross_correlation_ratio' WHEN 4 THEN 'my_field_2' ELSE 'spectrum_width' END AS field, count(*) AS n FROM events GROUP BY 1""")
def field_alias(spark, sf_dir):
    raw = F.element_at(F.array(*map(F.lit, (" Refl", "ZDR", "vr", "rhohv", "My field-2", "SW "))), (F.col("event_id") % 6 + 1).cast("int"))
    return _t(spark, sf_dir, "events").select(names.canonical_field(raw).alias("field")).groupBy("field").agg(F.count("*").alias("n"))


@query(f"SELECT CAST((i % 512) // 32 AS INTEGER) AS i_lat, CAST(i % 32 AS INTEGER) AS i_lon, round(CAST(max(v) AS DOUBLE), 6) AS value FROM (SELECT vec_id * 64 + gate AS i, v FROM {_GATES}) GROUP BY 1, 2")
def vertical_composite(spark, sf_dir):
    cells = _gates(spark, sf_dir).select((F.col("vec_id") * 64 + F.col("gate")).alias("index"), "value")
    return polar.vertical_composite(cells, 16, 32).select("i_lat", "i_lon", _r(F.col("value").cast("double"), 6).alias("value"))


@query("""SELECT l_orderkey, l_linenumber, coalesce((a + b) / 2, a, b) AS position FROM (SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber % 3 <> 0 THEN l_quantity END AS a, CASE WHEN l_linenumber % 4 <> 0 THEN l_discount END AS b FROM lineitem) WHERE coalesce(a, b) IS NOT NULL""")
def report_positions(spark, sf_dir):
    n = F.col("l_linenumber")
    lat = {"slat": F.when(n % 3 != 0, F.col("l_quantity")), "elat": F.when(n % 4 != 0, F.col("l_discount"))}
    raw = _t(spark, sf_dir, "lineitem").withColumns({"date": F.lit("2017-05-01"), "time": F.lit("12:00:00"), **lat, "slon": F.lit(1.0), "elon": F.lit(1.0), "mag": F.col("l_orderkey").cast("double"), "type": n.cast("string")})
    return reports.feed_b(raw).select(F.col("gust").cast("long").alias("l_orderkey"), F.col("type").cast("int").alias("l_linenumber"), F.col("lat").alias("position"))


@query("SELECT n_name AS network, count(*) AS stations, count(*) FILTER (s_acctbal > 0) AS reporting, round(max(s_acctbal), 2) AS top FROM supplier JOIN nation ON s_nationkey = n_nationkey GROUP BY 1 HAVING count(*) >= 2")
def network_summary(spark, sf_dir):
    rows = _t(spark, sf_dir, "supplier").join(_t(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    found = summary.network_summary(rows.withColumn("balance", F.col("s_acctbal").cast("string")), "n_name", "balance")
    return found.withColumn("top", F.round("top", 2))


@query("SELECT event_id, user_id, max(value) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS value FROM events")
def running_max(spark, sf_dir):
    return summary.running_max_guard(_t(spark, sf_dir, "events"), ["user_id"], ["ts", "event_id"], "value").select("event_id", "user_id", "value")


def _sql_steps(given: dict[str, str], steps: list[dict[str, str]]) -> str:
    """A struct whose fields each step may compute from all before it, as p.name."""
    names, text = dict.fromkeys(given), "[{" + ", ".join(f"'{n}': {e}" for n, e in given.items()) + "}]"
    for step in steps:
        names |= dict.fromkeys(step)
        text = f"list_transform({text}, lambda p: {{{', '.join(f'{n!r}: {step.get(n, f"p.{n}")}' for n in names)}}})"
    return text + "[1]"


# Geodesics on WGS 84 by Helmert's parameter k1, with a = 6378137 and f = 1 / 298.257223563.
_FLAT, _POLAR = "(1 / 298.257223563e0)", "(6378137e0 * (1 - 1 / 298.257223563e0))"
_HELMERT = [{"w": f"sqrt(1 + p.q * ((6378137e0 / {_POLAR}) ** 2 - 1))"}, {"k1": "(p.w - 1) / (p.w + 1)"}, {"ha": "(1 + p.k1 ** 2 / 4) / (1 - p.k1)", "hb": "p.k1 * (1 - 3 * p.k1 ** 2 / 8)"}]
_DELTA = "p.hb * p.ss * (p.m + p.hb / 4 * (p.cs * (2 * p.m ** 2 - 1) - p.hb / 6 * p.m * (4 * p.ss ** 2 - 3) * (4 * p.m ** 2 - 3)))"
_EXCESS = f"(1 - p.k) * {_FLAT} * p.sa * (p.s + p.k * p.ss * (p.m + p.k * p.cs * (2 * p.m ** 2 - 1)))"
_K = f"{_FLAT} / 16 * p.q * (4 + {_FLAT} * (4 - 3 * p.q))"


def _forward(lat: str, lon: str, lat0: str, lon0: str) -> str:
    """struct(x, y) in metres about (lat0, lon0)."""
    arc = [
        {"e": "p.c2 * sin(p.l)", "n": "p.c1 * p.s2 - p.s1 * p.c2 * cos(p.l)", "cs": "p.s1 * p.s2 + p.c1 * p.c2 * cos(p.l)"}, {"ss": "sqrt(p.e ** 2 + p.n ** 2)"},
        {"s": "atan2(p.ss, p.cs)", "sa": "CASE WHEN p.ss = 0 THEN 0 ELSE p.c1 * p.e / p.ss END"}, {"q": "1 - p.sa ** 2"}, {"m": "p.cs - 2 * p.s1 * p.s2 / p.q", "k": _K},
    ]
    reduced = lambda c: f"atan((1 - {_FLAT}) * tan(radians({c})))"
    given = {"u1": reduced(lat0), "u2": reduced(lat), "t": f"radians({lon} - ({lon0}))"}
    first = {"s1": "sin(p.u1)", "c1": "cos(p.u1)", "s2": "sin(p.u2)", "c2": "cos(p.u2)", "l": "p.t"}
    return _sql_steps(given, [first, *[*arc, {"l": f"p.t + {_EXCESS}"}] * 5, *arc, *_HELMERT, {"d": f"{_POLAR} * p.ha * (p.s - {_DELTA})", "z": "atan2(p.e, p.n)"}, {"x": "p.d * sin(p.z)", "y": "p.d * cos(p.z)"}])


def _inverse(x: str, y: str, lat0: str, lon0: str) -> str:
    """struct(lat, lon) of a place x, y metres from (lat0, lon0)."""
    given = {"u1": f"atan((1 - {_FLAT}) * tan(radians({lat0})))", "z": f"atan2({x}, {y})", "d": f"sqrt(({x}) ** 2 + ({y}) ** 2)", "o": f"CAST({lon0} AS DOUBLE)"}
    bend = {"ss": "sin(p.s)", "cs": "cos(p.s)", "m": "cos(2 * p.g + p.s)"}
    steps = [{"s1": "sin(p.u1)", "c1": "cos(p.u1)", "sz": "sin(p.z)", "cz": "cos(p.z)"}, {"sa": "p.c1 * p.sz", "g": "atan2(p.s1, p.c1 * p.cz)"}, {"q": "1 - p.sa ** 2"}, {"k": _K}, *_HELMERT, {"v": f"p.d / ({_POLAR} * p.ha)", "s": f"p.d / ({_POLAR} * p.ha)"}]
    end = {"lat": f"degrees(atan2(p.s1 * p.cs + p.c1 * p.ss * p.cz, (1 - {_FLAT}) * sqrt(p.sa ** 2 + (p.s1 * p.ss - p.c1 * p.cs * p.cz) ** 2)))", "lon": f"p.o + degrees(atan2(p.ss * p.sz, p.c1 * p.cs - p.s1 * p.ss * p.cz) - {_EXCESS})"}
    return _sql_steps(given, [*steps, *[bend, {"s": f"p.v + {_DELTA}"}] * 5, bend, end])


# every sighting seen from one of the sites, anywhere: offsets in metres, and back
@query(f"""WITH n AS (SELECT count(*) AS n FROM {S}), o AS (SELECT event_id, site, lat, lon, {_forward('latitude', 'longitude', 'lat', 'lon')} AS a FROM {P} p JOIN {S} s ON s.site = p.event_id % (SELECT n FROM n)),
b AS (SELECT event_id, site, a.x AS x, a.y AS y, {_inverse('a.x / 2', 'a.y / 2', 'lat', 'lon')} AS h FROM o)
SELECT event_id, CAST(site AS BIGINT) AS site, round(x, 2) AS x_m, round(y, 2) AS y_m, round(h.lat, 7) AS half_lat, round(h.lon, 7) AS half_lon FROM b""")
def site_offsets(spark, sf_dir):
    radars = _sites(spark, sf_dir).select("site", "lat", "lon")
    seen = _points(spark, sf_dir).select("event_id", "latitude", "longitude", (F.col("event_id") % F.lit(radars.count())).alias("site")).join(radars.withColumn("site", F.col("site").cast("long")), "site")
    seen = geo.project(seen, {"at": ("latitude", "longitude")}, "lat", "lon")
    seen = geo.unproject(seen, {"half": (F.col("at.x") / 2, F.col("at.y") / 2)}, "lat", "lon")
    return seen.select("event_id", "site", _r("at.x", 2).alias("x_m"), _r("at.y", 2).alias("y_m"), _r("half.lat", 7).alias("half_lat"), _r("half.lon", 7).alias("half_lon"))


# The whole build over tracks that stay near their storm's place. Every sighting of a kind is a volume of the site nearest to
# it: two sweeps of 16 rays with 12 gates, whose echo is taken from the vectors.
_TRACKS = "(SELECT *, 25e0 + (user_id * 377 % 2500) / 100e0 + (event_id % 20) / 50e0 AS latitude, -125e0 + (user_id * 591 % 5800) / 100e0 + (event_id % 13) / 50e0 AS longitude FROM events)"
_NEAR_TRACKS = _NEAR.replace(P, _TRACKS)
_GRID = 23700.0


def _spans(corners: list[str]) -> str:
    lats, lons = (", ".join(f"{c}.{k}" for c in corners) for k in ("lat", "lon"))
    return f"least({lats}) AS min_lat, greatest({lats}) AS max_lat, least({lons}) AS min_lon, greatest({lons}) AS max_lon"


_SCAN_PLACES = ", ".join(f"{_inverse(x, y, 'lat', 'lon')} AS {x[0]}{y[0]}" for x in ("west", "east") for y in ("south", "north"))
_FIT_PLACES = ", ".join(f"{_inverse(f'hx + cx {sign} aw / 2', f'hy + cy {sign} ah / 2', 'lat', 'lon')} AS {name}" for name, sign in (("sw", "-"), ("ne", "+")))
_BOX_PLACES = ", ".join(_forward(f"{a}_lat {i} da", f"{o}_lon {j} d_o", "lat", "lon") for a, i in (("min", "-"), ("max", "+")) for o, j in (("min", "-"), ("max", "+")))


@query(f"""WITH RECURSIVE {_NEAR_TRACKS}, p AS (SELECT user_id, site, min(ts) AS t FROM near GROUP BY 1, 2), q AS (SELECT * FROM p WHERE user_id IN (SELECT user_id FROM p GROUP BY 1 HAVING count(*) > 1)),
fresh AS (SELECT user_id, site, (SELECT max(user_id) FROM near) + row_number() OVER (ORDER BY t, user_id, site) AS id FROM q),
named AS (SELECT near.* EXCLUDE (k, user_id), coalesce(id, user_id) AS user_id FROM near LEFT JOIN fresh USING (user_id, site)),
big AS (SELECT * FROM named WHERE user_id IN (SELECT user_id FROM named GROUP BY 1 HAVING count(*) >= 3)), {_CLUSTERS.format(gap=72, rows='big')},
z AS (SELECT user_id, cluster, count(*) AS n FROM c GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY n DESC, cluster) AS place, sum(n) OVER (PARTITION BY user_id) AS total, max(n) OVER (PARTITION BY user_id) AS best FROM z),
m AS (SELECT user_id, cluster, CASE WHEN place = 1 THEN user_id ELSE (SELECT max(user_id) FROM big) + row_number() OVER (PARTITION BY place = 1 ORDER BY user_id, cluster) END AS storm_id FROM r WHERE best >= total * 0.3 AND best >= 3 AND n >= 3),
kept AS (SELECT event_id, ts, site, d, latitude, longitude, storm_id FROM c JOIN m USING (user_id, cluster)),
v AS (SELECT event_id AS vk, site, ts AS vt FROM near WHERE event_type = 'view'),
l AS (SELECT * EXCLUDE (k), {_forward('latitude', 'longitude', 's.lat', 's.lon')} AS pos FROM (SELECT kept.*, vk, row_number() OVER (PARTITION BY event_id ORDER BY abs(epoch_us(ts) - epoch_us(vt)), vt, vk) AS k FROM kept JOIN v ON kept.site = v.site AND CAST(ts AS DATE) = CAST(vt AS DATE) AND abs(epoch_us(ts) - epoch_us(vt)) <= 14400000000) JOIN {S} s USING (site) WHERE k = 1),
gates AS (SELECT vk, j, gate, max(100 * CAST(embedding[gate + 1] AS DOUBLE)) AS dbz FROM (SELECT DISTINCT vk FROM l), range(2) a(s), range(16) b(j), range(12) c(gate) JOIN embeddings ON vec_id = (vk * 7 + j * 31 + s * 13) % (SELECT count(*) FROM embeddings) GROUP BY ALL),
cell AS (SELECT y, x, (x - 10) * {_GRID} AS cx, (y - 10) * {_GRID} AS cy FROM range(21) a(y), range(21) b(x)),
ray AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY y, x ORDER BY away, j) AS k FROM (SELECT y, x, cx, cy, j, round(least((az - 22.5 * j + 360) % 360, 360 - (az - 22.5 * j + 360) % 360), 9) AS away FROM (SELECT *, (degrees(atan2(cx, cy)) + 360) % 360 AS az FROM cell), range(16) b(j))) WHERE k = 1),
plan AS (SELECT y, x, j, CAST(greatest(0, least(11, ceil((sqrt(cx ** 2 + cy ** 2) * cos(radians(away)) - 10000) / 20000 - 0.5))) AS BIGINT) AS gate FROM ray),
near9 AS (SELECT a.i AS dy, b.i AS dx FROM range(-1, 2) a(i), range(-1, 2) b(i)),
wide AS (SELECT DISTINCT vk, y + dy AS y, x + dx AS x FROM gates JOIN plan USING (j, gate), near9 WHERE dbz >= 20 AND y + dy BETWEEN 0 AND 20 AND x + dx BETWEEN 0 AND 20),
cells AS (SELECT vk, y - dy AS y, x - dx AS x, (y - dy) * 21 + x - dx + 1 AS id FROM wide, near9 WHERE y - dy BETWEEN 0 AND 20 AND x - dx BETWEEN 0 AND 20 GROUP BY ALL HAVING count(*) = 9),
reach AS (SELECT vk, y, x, id AS seen FROM cells UNION SELECT c.vk, c.y, c.x, r.seen FROM reach r JOIN cells c ON r.vk = c.vk AND abs(r.y - c.y) + abs(r.x - c.x) = 1),
labelled AS (SELECT vk, y, x, min(seen) AS region FROM reach GROUP BY 1, 2, 3),
regions AS (SELECT vk, region, count(*) AS pixels, avg(y) AS centre_y, avg(x) AS centre_x, min(y) AS min_y, max(y) AS max_y, min(x) AS min_x, max(x) AS max_x FROM labelled GROUP BY 1, 2 HAVING count(*) >= 3),
pt AS (SELECT event_id, vk, (l.pos.x + 10 * {_GRID}) / {_GRID} AS x, (l.pos.y + 10 * {_GRID}) / {_GRID} AS y FROM l),
first AS (SELECT * FROM (SELECT pt.event_id, r.*, row_number() OVER (PARTITION BY event_id ORDER BY b.region IS DISTINCT FROM r.region, sqrt((centre_y - pt.y) ** 2 + (centre_x - pt.x) ** 2), r.region) AS k
  FROM pt JOIN regions r USING (vk) LEFT JOIN labelled b ON b.vk = pt.vk AND b.y = greatest(0, least(20, round(pt.y))) AND b.x = greatest(0, least(20, round(pt.x)))) WHERE k = 1),
grown AS (SELECT event_id, vk, min_y, max_y, min_x, max_x, 0 AS step FROM first UNION ALL
  SELECT g.event_id, g.vk, least(any_value(g.min_y), min(r.min_y)), greatest(any_value(g.max_y), max(r.max_y)), least(any_value(g.min_x), min(r.min_x)), greatest(any_value(g.max_x), max(r.max_x)), any_value(g.step) + 1
  FROM grown g JOIN regions r ON g.vk = r.vk AND sqrt(greatest(0, r.min_x - (g.max_x + 24 / 23.7e0), (g.min_x - 24 / 23.7e0) - r.max_x) ** 2 + greatest(0, r.min_y - (g.max_y + 24 / 23.7e0), (g.min_y - 24 / 23.7e0) - r.max_y) ** 2) <= 24 / 23.7e0
  WHERE g.step < 30 GROUP BY g.event_id, g.vk),
blob AS (SELECT l.*, (min_x - 10) * {_GRID} AS west, (max_x - 10) * {_GRID} AS east, (min_y - 10) * {_GRID} AS south, (max_y - 10) * {_GRID} AS north FROM grown JOIN l USING (event_id, vk) WHERE step = 30),
scans AS (SELECT *, {_spans(['ws', 'wn', 'es', 'en'])} FROM (SELECT *, {_SCAN_PLACES} FROM blob)),
wh AS (SELECT storm_id, site, east - west AS w, north - south AS h FROM blob), md AS (SELECT storm_id, site, median(w) AS mw, median(h) AS mh FROM wh GROUP BY 1, 2),
sd AS (SELECT storm_id, site, any_value(mw) AS mw, any_value(mh) AS mh, median(abs(w - mw)) AS dw, median(abs(h - mh)) AS dh FROM wh JOIN md USING (storm_id, site) GROUP BY 1, 2),
ce AS (SELECT storm_id, site, avg(w) FILTER (abs(w - mw) <= 2.5 * CASE WHEN dw = 0 THEN 1 ELSE dw END) AS cw, avg(h) FILTER (abs(h - mh) <= 2.5 * CASE WHEN dh = 0 THEN 1 ELSE dh END) AS ch, greatest(any_value(dw), 1) AS sw, greatest(any_value(dh), 1) AS sh FROM wh JOIN sd USING (storm_id, site) GROUP BY 1, 2),
size AS (SELECT storm_id, site, sum(f * w) / sum(f) AS aw, sum(f * h) / sum(f) AS ah FROM (SELECT storm_id, site, w, h, 1 / (1 + abs(w - cw) / (sw + 1e-12)) / (1 + abs(h - ch) / (sh + 1e-12)) AS f FROM wh JOIN ce USING (storm_id, site)) GROUP BY 1, 2),
ends AS (SELECT event_id, vk, storm_id, site, lat, lon, (west + east) / 2 AS hx, (south + north) / 2 AS hy, aw, ah FROM (SELECT *, row_number() OVER (PARTITION BY storm_id, site ORDER BY ts, event_id) AS a, row_number() OVER (PARTITION BY storm_id, site ORDER BY ts DESC, event_id DESC) AS b FROM blob) JOIN size USING (storm_id, site) WHERE a = 1 OR b = 1),
tried AS (SELECT event_id, ix, iy, ix * 11850e0 - 60000 AS cx, iy * 11850e0 - 60000 AS cy, count(*) AS hits FROM ends JOIN gates USING (vk), range(11) a(ix), range(11) b(iy) WHERE dbz >= 20
  AND abs((10000 + 20000 * gate) * sin(radians(22.5 * j)) - hx - (ix * 11850e0 - 60000)) <= aw / 2 + 1e-5 AND abs((10000 + 20000 * gate) * cos(radians(22.5 * j)) - hy - (iy * 11850e0 - 60000)) <= ah / 2 + 1e-5 GROUP BY ALL),
fits AS (SELECT *, {_spans(['sw', 'ne'])} FROM (SELECT *, {_FIT_PLACES} FROM (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY hits DESC, ix, iy) AS k FROM tried) JOIN ends USING (event_id) WHERE k = 1)),
whole AS (SELECT storm_id, site, min(min_lat) AS a0, max(max_lat) AS a1, min(min_lon) AS o0, max(max_lon) AS o1, count(*) AS n_times FROM scans GROUP BY 1, 2),
fitted AS (SELECT storm_id, site, min(min_lat) AS min_lat, max(max_lat) AS max_lat, min(min_lon) AS min_lon, max(max_lon) AS max_lon FROM fits GROUP BY 1, 2 HAVING count(*) = (SELECT count(*) FROM ends e WHERE e.storm_id = fits.storm_id AND e.site = fits.site)),
box AS (SELECT storm_id, site, coalesce(min_lat, a0) AS min_lat, coalesce(max_lat, a1) AS max_lat, coalesce(min_lon, o0) AS min_lon, coalesce(max_lon, o1) AS max_lon, min_lat IS NOT NULL AS fitted_box, n_times FROM whole LEFT JOIN fitted USING (storm_id, site)),
room AS (SELECT *, 5 / 110.574 AS da, 5 / (111.320 * greatest(cos(radians((min_lat + max_lat) / 2)), 1e-6)) AS d_o FROM box),
metric AS (SELECT storm_id, site, list_transform(c, lambda q: q.x) AS xs, list_transform(c, lambda q: q.y) AS ys FROM (SELECT storm_id, site, [{_BOX_PLACES}] AS c FROM room JOIN {S} s USING (site))),
inside AS (SELECT storm_id, site, count(*) AS n FROM metric, (SELECT (10000 + 20000 * gate) * cos(radians(0.5)) AS far, radians(22.5 * j) AS z FROM range(16) a(j), range(12) b(gate)) g
  WHERE far * sin(z) BETWEEN list_min(xs) - 1e-6 AND list_max(xs) + 1e-6 AND far * cos(z) BETWEEN list_min(ys) - 1e-6 AND list_max(ys) + 1e-6 GROUP BY 1, 2)
SELECT event_id AS row_id, CAST(storm_id AS BIGINT) AS storm_id, CAST(site AS VARCHAR) AS radar_site, vk AS volume_key, epoch_us(ts) // 1000 AS time_unix_ms, round(d, 4) AS distance_km, round(box.min_lat, 6) AS min_lat, round(box.max_lat, 6) AS max_lat, round(box.min_lon, 6) AS min_lon, round(box.max_lon, 6) AS max_lon,
  fitted_box, n_times, CAST(2 AS BIGINT) AS n_channels, CAST(2 * coalesce(inside.n, 0) AS BIGINT) AS n_filled FROM blob JOIN box USING (storm_id, site) LEFT JOIN inside USING (storm_id, site)""")
def storm_build(spark, sf_dir):
    e, vectors = _t(spark, sf_dir, "events"), _t(spark, sf_dir, "embeddings")
    lat, lon = _lat("user_id", 377) + (F.col("event_id") % 20) / 50.0, _lon("user_id", 591) + (F.col("event_id") % 13) / 50.0
    rows = e.select(F.col("event_id").alias("row_id"), F.col("user_id").alias("storm_number"), F.col("ts").alias("time"), lat.alias("latitude"), lon.alias("longitude"), "event_type")
    radars = _sites(spark, sf_dir).select("site", "lat", "lon")
    config = load_config({
        "linking": {"min_rows": 3, "max_gap_hours": 72.0, "majority_ratio": 0.3, "time_tolerance_s": 14400.0},
        "blobs": {"min_pixels": 3, "grid_m": _GRID, "nearby_km": 24.0, "search_km": 60.0},
    })
    folder = f"{shared_folder(spark)}/storm-build-{uuid.uuid4().hex}"
    with scratch(spark):
        scans = sites.nearest_active_site(spread(rows.where("event_type = 'view'")), radars, config.linking.max_distance_km)
        scans = cut_lineage(scans.select(F.col("row_id").alias("volume_key"), F.col("radar_site").alias("site"), F.col("time").alias("volume_time")), "storm-build-volumes")
        rays = scans.select("volume_key").crossJoin(F.broadcast(vectors.agg(F.count("*").alias("n"))))  # one row
        rays = rays.withColumn("sweep", F.explode(F.sequence(F.lit(0), F.lit(1)))).withColumn("ray", F.explode(F.sequence(F.lit(0), F.lit(15))))
        rays = rays.withColumn("vec_id", (F.col("volume_key") * 7 + F.col("ray") * 31 + F.col("sweep") * 13) % F.col("n")).join(vectors, "vec_id")
        dbz = F.transform(F.slice("embedding", 1, 12), lambda v: v.cast("double") * 100)
        rays = rays.select("volume_key", "sweep", "ray", (F.col("ray") * 22.5).alias("azimuth"), F.lit(0.5).alias("elevation"), (F.col("sweep") + 0.5).cast("double").alias("fixed_angle"), dbz.alias("values"))
        build.write(build.build(rows.drop("event_type"), radars, scans, rays, config, build.Geometry(10_000.0, 20_000.0, 23.0)), folder)
    context, frames, catalog = (spark.read.parquet(f"{folder}/{t}").withColumn("radar_site", F.col("radar_site").cast("string")) for t in ("context", "frames", "catalog"))
    tensors = frames.groupBy("row_id").agg(F.count("*").alias("n_channels"), F.sum(F.size(F.filter("data", lambda v: v.isNotNull()))).alias("n_filled"))
    found = context.join(catalog.select("storm_id", "radar_site", F.col("T").alias("n_times")), ["storm_id", "radar_site"]).join(tensors, "row_id")
    return found.select("row_id", "storm_id", "radar_site", "volume_key", "time_unix_ms", _r("distance_to_site").alias("distance_km"), *[_r(s, 6).alias(s) for s in bbox.SIDES], "fitted_box", "n_times", "n_channels", "n_filled")
