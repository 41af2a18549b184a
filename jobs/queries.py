"""The jobs as queries: each runs twice into one new folder and returns its output as read back, with its SQL."""

from __future__ import annotations

import json
import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cumulo.plans.registry import _CLUSTERS, _km
from cumulo.session import shared_folder

from . import release_manifest, storm_archive

HERE = os.path.dirname(os.path.abspath(__file__))


def _config(name: str) -> dict:
    """The job's own config file, which lies beside its code."""
    with open(f"{HERE}/{name}.json", encoding="utf-8") as f:
        return json.load(f)


def job1_release_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every listed file beside its site's line of the catalog."""
    config, folder = _config("release_manifest"), f"{shared_folder(spark)}/job1-{uuid.uuid4().hex}"
    for _ in range(2):
        release_manifest.run(spark, {feed: f"{sf_dir}/{feed}.parquet" for feed in config["feeds"]}, f"{folder}/out", f"{folder}/mark", config)
    listed = spark.read.parquet(f"{folder}/out/manifest").drop("batch")
    sites = spark.read.parquet(f"{folder}/out/catalog").select("feed", "site", F.col("files").alias("site_files"), F.col("contents").alias("site_contents"), F.col("total_bytes").alias("site_bytes"), F.col("size").alias("site_size"))
    return listed.join(sites, ["feed", "site"])


def job2_storm_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The context beside its storm's line of the catalog."""
    folder = f"{shared_folder(spark)}/job2-{uuid.uuid4().hex}"
    events, suppliers = f"{sf_dir}/events.parquet", f"{sf_dir}/supplier.parquet"
    for _ in range(2):
        storm_archive.run(spark, events, suppliers, events, events, folder, _config("storm_archive"))
    context = spark.read.parquet(f"{folder}/context").withColumn("radar_site", F.col("radar_site").cast("string"))
    storms = spark.read.parquet(f"{folder}/catalog").select(F.col("radar_site").cast("string").alias("radar_site"), "storm_id", F.col("T").alias("n_times"), F.col("n_reports").alias("storm_reports"))
    r = lambda c, n=4: F.round(c, n).alias(c)
    return context.join(storms, ["radar_site", "storm_id"]).select(
        "row_id", "storm_id", "radar_site", "volume_key", "time_unix_ms", "year", F.round("distance_to_site", 4).alias("distance_km"), r("min_lat", 6), r("max_lon", 6), "n_reports", r("max_gust"), r("nearest_km"), "n_times", "storm_reports"
    )


QUERIES = {f.__name__: f for f in (job1_release_manifest, job2_storm_archive)}

_KEY = "regexp_replace(lower(site), '[^0-9a-z]+', '_', 'g')"
_UNIT = " ".join(f"WHEN b >= {1024**k} THEN printf('%.2f {unit}', floor(b / {1024**k}e0 * 100 + 0.5) / 100)" for k, unit in ((5, "PB"), (4, "TB"), (3, "GB"), (2, "MB"), (1, "KB")))
_PLACE = "25e0 + (user_id * 377 % 2500) / 100e0 + (event_id % {a}) / 50e0 AS latitude, -125e0 + (user_id * 591 % 5800) / 100e0 + (event_id % {b}) / 50e0 AS longitude"
_D = _km("p.latitude", "p.longitude", "s.lat", "s.lon")

ORACLE_SQL = {
    "job1_release_manifest": f"""WITH f AS (
        SELECT 'documents' AS feed, coalesce(source, 'unknown') AS site, coalesce(lang, 'unknown') AS product, CAST(doc_id AS VARCHAR) AS id, 'txt' AS suffix, coalesce(text, '') AS body FROM documents
        UNION ALL SELECT 'pages', coalesce(nullif(regexp_extract(url, '^[a-z]+://([^/:?#]+)', 1), ''), 'unknown'), 'page', CAST(page_id AS VARCHAR), 'html', coalesce(html, '') FROM pages
        UNION ALL SELECT 'conversations', coalesce(role, 'unknown'), 'turn', concat_ws('-', conv_id, turn), 'txt', coalesce(text, '') FROM conversations),
    m AS (SELECT DISTINCT feed, site, product, feed || '/' || {_KEY} || '/' || product || '/' || coalesce(id, 'unknown') || '.' || suffix AS relpath, CAST(octet_length(encode(body)) AS BIGINT) AS size_bytes, sha256(body) AS sha256 FROM f),
    c AS (SELECT feed, site, count(*) AS site_files, count(DISTINCT sha256) AS site_contents, CAST(sum(size_bytes) AS BIGINT) AS b FROM m GROUP BY 1, 2)
    SELECT feed, site, relpath, product, size_bytes, sha256, site_files, site_contents, b AS site_bytes, CASE {_UNIT} ELSE printf('%d B', b) END AS site_size FROM m JOIN c USING (feed, site)""",
    "job2_storm_archive": f"""WITH pts AS (SELECT *, {_PLACE.format(a=20, b=13)} FROM events),
    s AS (SELECT CAST(s_suppkey AS VARCHAR) AS site, 25e0 + (s_suppkey * 613 % 2500) / 100e0 AS lat, -125e0 + (s_suppkey * 377 % 5800) / 100e0 AS lon FROM supplier),
    near AS (SELECT * FROM (SELECT p.*, site, {_D} AS d, row_number() OVER (PARTITION BY event_id ORDER BY {_D}, site) AS place FROM pts p JOIN s ON {_D} <= 250) WHERE place = 1),
    g AS (SELECT user_id, site, min(ts) AS t FROM near GROUP BY 1, 2), q AS (SELECT * FROM g WHERE user_id IN (SELECT user_id FROM g GROUP BY 1 HAVING count(*) > 1)),
    fresh AS (SELECT user_id, site, (SELECT max(user_id) FROM near) + row_number() OVER (ORDER BY t, user_id, site) AS id FROM q),
    named AS (SELECT near.* EXCLUDE (place, user_id), coalesce(id, user_id) AS user_id FROM near LEFT JOIN fresh USING (user_id, site)),
    big AS (SELECT * FROM named WHERE user_id IN (SELECT user_id FROM named GROUP BY 1 HAVING count(*) >= 3)), {_CLUSTERS.format(gap=72, rows='big')},
    z AS (SELECT user_id, cluster, count(*) AS n FROM c GROUP BY 1, 2),
    r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY n DESC, cluster) AS place, sum(n) OVER (PARTITION BY user_id) AS total, max(n) OVER (PARTITION BY user_id) AS best FROM z),
    m AS (SELECT user_id, cluster, CASE WHEN place = 1 THEN user_id ELSE (SELECT max(user_id) FROM big) + row_number() OVER (PARTITION BY place = 1 ORDER BY user_id, cluster) END AS storm_id FROM r WHERE best >= total * 0.3 AND best >= 3 AND n >= 3),
    kept AS (SELECT event_id, ts, site, d, latitude, longitude, storm_id FROM c JOIN m USING (user_id, cluster)),
    v AS (SELECT event_id AS vk, site, ts AS vt FROM near WHERE event_type = 'view'),
    l AS (SELECT * FROM (SELECT kept.*, vk, row_number() OVER (PARTITION BY event_id ORDER BY abs(epoch_us(ts) - epoch_us(vt)), vt, vk) AS k
        FROM kept JOIN v ON kept.site = v.site AND CAST(ts AS DATE) = CAST(vt AS DATE) AND abs(epoch_us(ts) - epoch_us(vt)) <= 14400000000) JOIN s USING (site) WHERE k = 1),
    w AS (SELECT value AS gust, ts AS rt, {_PLACE.format(a=17, b=11)} FROM events WHERE event_type IN ('error', 'click')),
    o AS (SELECT event_id, count(*) AS n, max(gust) AS g, min({_km('l.latitude', 'l.longitude', 'w.latitude', 'w.longitude')}) AS km FROM l JOIN w
        ON abs(epoch_us(ts) - epoch_us(rt)) <= 3600000000 AND w.latitude BETWEEN lat - 0.5e0 AND lat + 0.5e0 AND w.longitude BETWEEN lon - 0.5e0 AND lon + 0.5e0 GROUP BY 1),
    n AS (SELECT storm_id, site, count(*) AS t, CAST(sum(coalesce(n, 0)) AS BIGINT) AS reported FROM l LEFT JOIN o USING (event_id) GROUP BY 1, 2)
    SELECT event_id AS row_id, CAST(storm_id AS BIGINT) AS storm_id, site AS radar_site, vk AS volume_key, epoch_us(ts) // 1000 AS time_unix_ms, CAST(year(ts) AS INTEGER) AS year, round(d, 4) AS distance_km,
        round(lat - 0.5, 6) AS min_lat, round(lon + 0.5, 6) AS max_lon, coalesce(o.n, 0) AS n_reports, round(g, 4) AS max_gust, round(km, 4) AS nearest_km, n.t AS n_times, reported AS storm_reports
    FROM l LEFT JOIN o USING (event_id) JOIN n USING (storm_id, site)""",
}
