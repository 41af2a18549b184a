"""Track tables: daily delimited files with headers that vary."""

from __future__ import annotations

import hashlib
import json
from datetime import date, datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.names import leading, snake_columns

# Keywords by which core columns are found, in order of preference.
KEYWORDS = {"storm_number": (("storm", "number"), ("storm",)), "time": (("time",),), "longitude": (("long",), ("lon",)), "latitude": (("lat",),)}
CORE = ["storm_id", "time", "latitude", "longitude", "radar_site", "distance_to_site"]


def day_list(year: int, dates: list | None = None) -> list[date]:
    """The days to scan: those given (of that year, sorted, each once), or the whole year."""
    if dates is None:
        first = date(year, 1, 1).toordinal()
        return [date.fromordinal(d) for d in range(first, date(year + 1, 1, 1).toordinal())]
    days = set()
    for d in dates:
        d = datetime.fromisoformat(d) if isinstance(d, str) else d
        if not isinstance(d, date):
            raise TypeError(f"not a date: {d!r}")
        d = d.date() if isinstance(d, datetime) else d
        if d.year != year:
            raise ValueError(f"{d} is not in {year}")
        days.add(d)
    return sorted(days)


def day_paths(folder: str, year: int, dates: list | None = None) -> list[str]:
    return [f"{folder}/{year}/{d:%Y%m%d}.csv" for d in day_list(year, dates)]


def cache_key(**parameters) -> str:
    """Key of a cached result: a hash of every parameter, not of some."""
    return hashlib.sha1(json.dumps(parameters, sort_keys=True, default=str).encode()).hexdigest()[:10]


def sniff(header: str) -> str:
    """Comma, then tab, then the most frequent of other separators."""
    for sep in (",", "\t"):
        if sep in header:
            return sep
    return max(";| ", key=header.count)


def find_column(columns: list[str], name: str) -> str | None:
    low = [(c, c.strip().lower()) for c in columns]
    for words in KEYWORDS[name]:
        for original, c in low:
            if all(w in c for w in words):
                return original
    return None


def normalize(df: DataFrame) -> DataFrame:
    """Core columns under fixed names and types; other columns pass through, in snake case.

    Rows without a time, position or storm number go. Raises KeyError without a time or position.
    """
    found = {name: find_column(df.columns, name) for name in KEYWORDS}
    if missing := [n for n in ("longitude", "latitude", "time") if not found[n]]:
        raise KeyError(f"no column for {', '.join(missing)}")
    cell = lambda c: F.col(f"`{c}`")
    core = [
        F.try_to_timestamp(cell(found["time"]).cast("string")).alias("time"),
        F.expr(f"try_cast(`{found['latitude']}` as double)").alias("latitude"),
        F.expr(f"try_cast(`{found['longitude']}` as double)").alias("longitude"),
        (F.expr(f"try_cast(try_cast(`{found['storm_number']}` as double) as bigint)") if found["storm_number"] else F.lit(None).cast("bigint")).alias("storm_number"),
    ]
    rest = [c for c in df.columns if c not in found.values()]
    extra = snake_columns(df.select(*[cell(c) for c in rest])).columns if rest else []
    taken = {"time", "latitude", "longitude", "storm_number"}
    out = df.select(*core, *[cell(c).alias(n if n not in taken else f"{n}_1") for c, n in zip(rest, extra)])
    return out.dropna(subset=["time", "latitude", "longitude", "storm_number"])


def present(spark: SparkSession, paths: list[str]) -> list[str]:
    """Those of ``paths`` that exist and are not empty, by listing each folder once."""
    hadoop, conf = spark._jvm.org.apache.hadoop.fs, spark.sparkContext._jsc.hadoopConfiguration()
    found: set[str] = set()
    for folder in dict.fromkeys(p.rpartition("/")[0] for p in paths):
        at = hadoop.Path(folder)
        files = at.getFileSystem(conf)
        if files.exists(at):
            found.update(f"{folder}/{f.getPath().getName()}" for f in files.listStatus(at) if f.isFile() and f.getLen() > 0)
    return [p for p in paths if p in found]


def first_line(spark: SparkSession, path: str) -> str:
    """The first line of a file: an open and a read, no job."""
    java, conf = spark._jvm.java.io, spark.sparkContext._jsc.hadoopConfiguration()
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    reader = java.BufferedReader(java.InputStreamReader(at.getFileSystem(conf).open(at), "UTF-8"))
    try:
        return (reader.readLine() or "").lstrip("\ufeff")
    finally:
        reader.close()


def unite(scans: list[DataFrame]) -> DataFrame:
    """Scans united by column name, missing columns null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), scans)


def read(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Files of one separator and header are one scan; missing and empty files are left out."""
    groups: dict[tuple[str, str], list[str]] = {}
    for path in present(spark, paths):
        if (head := first_line(spark, path)).strip():
            groups.setdefault((sniff(head), head), []).append(path)
    if not groups:
        return spark.createDataFrame([], "time timestamp, latitude double, longitude double, storm_number bigint")
    return unite([normalize(spark.read.csv(ps, header=True, sep=sep)) for (sep, _), ps in groups.items()])


def read_days(spark: SparkSession, folder: str, year: int, dates: list | None = None, cache: str | None = None, force: bool = False) -> DataFrame:
    """The tracks of a year's days, from a snapshot of just these days if ``cache`` holds one."""
    paths = day_paths(folder, year, dates)
    if cache is None:
        return read(spark, paths)
    return cached(spark, cache, cache_key(folder=folder, paths=paths), lambda: read(spark, paths), ["time", "latitude", "longitude", "storm_number"], force)


def cached(spark: SparkSession, folder: str, key: str, build, needed: list[str] = (), force: bool = False) -> DataFrame:
    """A Parquet snapshot under ``folder/key``; rebuilt if absent, unreadable or without a needed column."""
    from pyspark.errors import AnalysisException

    path = f"{folder}/{key}.parquet"
    if not force:
        try:
            df = spark.read.parquet(path)
            if set(needed) <= set(df.columns):
                return df
        except AnalysisException:
            pass
    build().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def core_first(df: DataFrame) -> DataFrame:
    return leading(df, CORE)
