"""Radar volumes: listings, rays and gates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.names import canonical_field, canonical_fields, volume_parts

RAY = ["volume_key", "sweep", "ray"]
RAYS = "volume_key string, sweep int, fixed_angle double, ray int, azimuth double, elevation double, field string, values array<float>"


def listing(keys: DataFrame, column: str = "volume_key") -> DataFrame:
    """volume_key, site, volume_time; names that do not fit go, and of equal times the last key stays."""
    rows = keys.select(F.col(column).alias("volume_key")).withColumns(volume_parts(F.col("volume_key"))).dropna(subset=["site", "volume_time"])
    return rows.groupBy("site", "volume_time").agg(F.max("volume_key").alias("volume_key")).select("volume_key", "site", "volume_time")


def list_volumes(spark: SparkSession, root: str, wanted: DataFrame) -> DataFrame:
    """The listing of the folders ``root/YYYY/MM/DD/SITE`` that ``wanted(site, time)`` asks for, and of no other: days
    are looked up once each, folders that exist are listed by Spark's reader (in tasks, if many), no content is read."""
    asked: dict[str, list[str]] = {}
    # sites times days at most
    for r in wanted.select(F.date_format("time", "yyyy/MM/dd").alias("day"), "site").dropna().distinct().collect():
        asked.setdefault(r["day"], []).append(r["site"])
    hadoop, conf = spark._jvm.org.apache.hadoop.fs, spark.sparkContext._jsc.hadoopConfiguration()
    found = []
    for day, sites in sorted(asked.items()):
        at = hadoop.Path(f"{root}/{day}")
        files = at.getFileSystem(conf)
        have = {f.getPath().getName() for f in files.listStatus(at) if f.isDirectory()} if files.exists(at) else set()
        found += [f"{root}/{day}/{site}" for site in sorted(have & set(sites))]
    if not found:
        return spark.createDataFrame([], "volume_key string, site string, volume_time timestamp")
    # a name that begins with a dot or an underscore is none of a volume
    paths = spark.read.format("binaryFile").load(found).select("path")
    return listing(paths, "path")


def write_parts(rays: DataFrame, folder: str, tables: str, buckets: int = 32) -> list[str]:
    """Geometry and fields of rays(volume_key, sweep, ray, azimuth, elevation, fixed_angle, field, values) as tables of
    their own, ``{tables}_geometry`` and ``{tables}_{field}`` with files under ``folder``, bucketed alike by ray; the fields."""
    fields = sorted(r["field"] for r in rays.select(canonical_field(F.col("field")).alias("field")).distinct().collect())  # some tens

    def save(rows: DataFrame, name: str) -> None:
        rows.repartition(buckets, *RAY).write.mode("overwrite").bucketBy(buckets, *RAY).sortBy(*RAY).option("path", f"{folder}/{name}").saveAsTable(f"{tables}_{name}")

    named = rays.withColumn("field", canonical_field(F.col("field")))
    save(named.select(*RAY, "azimuth", "elevation", "fixed_angle").dropDuplicates(RAY), "geometry")
    for field in fields:
        clean = F.transform(F.col("values").cast("array<float>"), lambda v: F.when(~F.isnan(v), v))
        save(named.where(F.col("field") == field).select(*RAY, clean.alias(field)), field)
    return fields


def read_parts(spark: SparkSession, tables: str, fields: list[str | None]) -> DataFrame:
    """Rays with their geometry and a column of gates for each asked field (aliases count). Only these tables are
    read, and nothing is shuffled, as all are bucketed alike. A ray counts only if it has all that is asked."""
    rows = spark.table(f"{tables}_geometry")
    for field in canonical_fields(fields):
        rows = rows.join(spark.table(f"{tables}_{field}").hint("merge"), RAY)
    return rows


def gates(rays: DataFrame, first_range_m: float, gate_m: float) -> DataFrame:
    """One row per gate; explode last, on the columns that remain."""
    rest = [c for c in rays.columns if c != "values"]
    return rays.select(*rest, F.posexplode("values").alias("gate", "value")).withColumn("range_m", F.lit(first_range_m) + F.col("gate") * F.lit(gate_m))
