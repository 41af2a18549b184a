"""Surface reports: three feeds that end in (source, time, lat, lon, gust, type)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tracks import cache_key, cached

COLUMNS = ["source", "time", "lat", "lon", "gust", "type"]
# Wind types of the first feed, and ids of the third feed's networks.
WIND_TYPES = ("tstm wind", "tstm wnd gst", "non-tstm wnd gst", "marine tstm wind")
NETWORKS = ("1", "65", "106", "2")

STATIONS = """struct<STATION:array<struct<STID:string,LATITUDE:string,LONGITUDE:string,
  OBSERVATIONS:struct<date_time:array<string>,time:array<string>,wind_gust_set_1:array<double>,wind_gust:array<double>>>>>"""


def _finish(df: DataFrame, source) -> DataFrame:
    rows = df.select(source.alias("source"), "time", "lat", "lon", "gust", F.col("type").cast("string").alias("type"))
    return rows.dropna(subset=["time", "lat", "lon", "gust"])


def feed_a(raw: DataFrame, types: tuple[str, ...] = WIND_TYPES, source: str = "iem") -> DataFrame:
    """Storm reports with a time, lat, lon, magnitude and type column (upper or lower case names);
    keeps the given types, case-insensitively."""
    names = {c.strip().lower(): c for c in raw.columns}
    pick = lambda *options: F.col(f"`{next(names[o] for o in options if o in names)}`")
    num = lambda c: c.cast("string").try_cast("double")
    kind = pick("typetext", "type")
    rows = raw.where(F.lower(F.trim(kind)).isin([t.lower() for t in types]))
    stamp = pick("valid", "valid2", "time").cast("string")
    time = F.coalesce(F.try_to_timestamp(stamp), F.try_to_timestamp(stamp, F.lit("yyyyMMddHHmm")))
    return _finish(rows.select(time.alias("time"), num(pick("lat")).alias("lat"), num(pick("lon")).alias("lon"), num(pick("mag", "gust")).alias("gust"), kind.alias("type")), F.lit(source))


def feed_b(raw: DataFrame, source: str = "spc") -> DataFrame:
    """Columns date, time, slat, elat, slon, elon, mag; the position is the mean of those present."""
    num = lambda c: F.expr(f"try_cast(`{c}` as double)")
    mean = lambda a, b: F.coalesce((num(a) + num(b)) / 2, num(a), num(b))
    when = F.try_to_timestamp(F.concat_ws(" ", F.col("date").cast("string"), F.col("time").cast("string")))
    kind = F.col("type") if "type" in raw.columns else F.lit("wind")
    return _finish(raw.select(when.alias("time"), mean("slat", "elat").alias("lat"), mean("slon", "elon").alias("lon"), num("mag").alias("gust"), kind.alias("type")), F.lit(source))


def feed_stations(raw: DataFrame, column: str = "body", network: str = "network") -> DataFrame:
    """JSON bodies, one per network: times and gusts are zipped to the shorter and exploded."""
    body = raw.select(F.col(network).alias("network"), F.explode(F.from_json(column, STATIONS.replace("\n", ""))["STATION"]).alias("s"))
    obs = F.col("s.OBSERVATIONS")
    times = F.coalesce(obs["date_time"], obs["time"])
    gusts = F.coalesce(obs["wind_gust_set_1"], obs["wind_gust"])
    n = F.least(F.size(times), F.size(gusts))
    zipped = F.when(n > 0, F.arrays_zip(F.slice(times, 1, n).alias("t"), F.slice(gusts, 1, n).alias("g")))
    rows = body.select("network", F.expr("try_cast(s.LATITUDE as double)").alias("lat"), F.expr("try_cast(s.LONGITUDE as double)").alias("lon"), F.explode(zipped).alias("z"))
    return _finish(rows.select("network", "lat", "lon", F.try_to_timestamp(F.col("z")["t"]).alias("time"), F.col("z")["g"].alias("gust"), F.lit("station").alias("type")), F.concat(F.lit("synoptic_"), F.lower("network")))


def read_feed_a(spark: SparkSession, path: str, types: tuple[str, ...] = WIND_TYPES, cache: str | None = None, force: bool = False) -> DataFrame:
    """The first feed's file, from a snapshot of just this reading if ``cache`` holds one with all columns."""
    read = lambda: feed_a(spark.read.csv(path, header=True, mode="DROPMALFORMED"), types)
    return read() if cache is None else cached(spark, cache, cache_key(feed="a", path=path, types=sorted(types)), read, COLUMNS, force)


def read_feed_b(spark: SparkSession, folder: str, years: list[int], cache: str | None = None, force: bool = False) -> DataFrame:
    """``{year}_wind.csv`` of each year that exists, an error if none does; snapshots as for the first feed, keyed by
    the files that exist, so that a year that arrives later is taken up."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    paths = [p for y in years if (h := jvm.org.apache.hadoop.fs.Path(p := f"{folder}/{y}_wind.csv")).getFileSystem(conf).exists(h)]
    if not paths:
        raise FileNotFoundError(f"no report file in {folder} for {years}")
    read = lambda: feed_b(spark.read.csv(paths, header=True))
    return read() if cache is None else cached(spark, cache, cache_key(feed="b", paths=paths), read, COLUMNS, force)


def union(*feeds: DataFrame) -> DataFrame:
    out = feeds[0].select(*COLUMNS)
    for f in feeds[1:]:
        out = out.unionByName(f.select(*COLUMNS))
    return out
