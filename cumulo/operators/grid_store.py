"""Grid plans kept as a Parquet table: one plan per geometry of rays, however many volumes have it.

A plan says which cells of a square grid each ray fills, and from which gate. It rests on the rays' azimuths and on
the grid alone, so volumes of one geometry share it. A stored row is a ray with all its cells: a volume's rays meet
their rows by (geometry, line), and no cell is shuffled.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import grid

STORED = "line int, cells array<struct<y:int,x:int,gate:int>>, grid string, geometry string"


@dataclass(frozen=True)
class Grid:
    """Cells ``step_m`` wide over all of ``n_gates`` gates and ``pad_m`` around them."""

    step_m: float
    pad_m: float
    first_range_m: float
    gate_m: float
    n_gates: int

    @property
    def half_m(self) -> float:
        return math.ceil((self.first_range_m + (self.n_gates - 1) * self.gate_m + self.pad_m) / self.step_m) * self.step_m

    @property
    def side(self) -> int:
        return int(round(2 * self.half_m / self.step_m)) + 1

    @property
    def name(self) -> str:
        return "_".join(f"{v:g}" for v in (self.step_m, self.pad_m, self.first_range_m, self.gate_m, self.n_gates))


def lines(rays: DataFrame, keys: list[str], snap_degrees: float = 0.0) -> DataFrame:
    """rays(keys, ray, azimuth, values) with their line, and their volume's geometry and planned azimuth.

    Lines count from 0 in order of (azimuth, ray, values) within a volume, so a volume that starts elsewhere on the
    circle has the same geometry. Rays without an azimuth (null, not a number) have no line and leave. A geometry is named by a
    hash of all planned azimuths: the rays' own, or, where every ray of a volume lies within ``snap_degrees`` of its
    place among as many even sectors, the sectors' middles (azimuths jitter, and such volumes then share a plan).
    """
    known = rays.where("azimuth is not null and not isnan(azimuth)").withColumn("azimuth", F.pmod(F.col("azimuth").cast("double"), F.lit(360.0)))
    volume = Window.partitionBy(*keys)
    rows = known.withColumns({"line": F.row_number().over(volume.orderBy("azimuth", "ray", "values")) - 1, "__n": F.count("*").over(volume)})
    even = (F.col("line") + 0.5) * 360.0 / F.col("__n")
    rows = rows.withColumn("__even", F.max(F.abs(F.col("azimuth") - even)).over(volume) <= F.lit(float(snap_degrees)))
    rows = rows.withColumn("planned_azimuth", F.when(F.col("__even"), even).otherwise(F.col("azimuth")))
    # a volume's azimuths are some hundreds of numbers
    named = rows.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("line", "planned_azimuth"))).alias("__a"))
    named = named.select(*keys, F.sha2(F.col("__a.planned_azimuth").cast("string"), 256).alias("geometry"))
    return rows.drop("__n", "__even").join(named, keys)


def _stored(spark: SparkSession, folder: str, of: Grid) -> DataFrame:
    at = spark._jvm.org.apache.hadoop.fs.Path(folder)
    if not at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at):
        return spark.createDataFrame([], STORED)
    return spark.read.schema(STORED).parquet(folder).where(F.col("grid") == of.name)


def extend(folder: str, placed: DataFrame, keys: list[str], of: Grid) -> None:
    """Add the plans that the volumes of ``placed`` (see ``lines``) need and the table has not.

    A geometry is a partition, taken as present only with all its lines, and written by overwriting just the
    partitions of this call: a call that was broken off is made good by the next, and a repeated one writes nothing.
    """
    spark = placed.sparkSession
    have = _stored(spark, folder, of).groupBy("geometry").agg(F.count("*").alias("__lines"))
    sizes = placed.groupBy("geometry", *keys).agg(F.count("*").alias("__lines"))
    # one volume speaks for all of its geometry
    first = sizes.groupBy("geometry").agg(F.min(F.struct("__lines", *keys)).alias("v")).select("geometry", "v.*").join(have, ["geometry", "__lines"], "left_anti")
    wanted = placed.join(first.drop("__lines"), ["geometry", *keys]).select("geometry", F.col("line").alias("ray"), F.col("planned_azimuth").alias("azimuth"))
    planned = grid.grid_plan(wanted, ["geometry"], of.half_m, of.step_m, of.first_range_m, of.gate_m, of.n_gates)
    filled = planned.groupBy("geometry", "ray").agg(F.array_sort(F.collect_list(F.struct("y", "x", "gate"))).alias("cells"))
    # a ray that is nearest to no cell has a row too, so that complete plans can be told
    rows = wanted.select("geometry", "ray").join(filled, ["geometry", "ray"], "left")
    nothing = F.array().cast("array<struct<y:int,x:int,gate:int>>")
    rows = rows.select(F.col("ray").cast("int").alias("line"), F.coalesce("cells", nothing).alias("cells"), F.lit(of.name).alias("grid"), "geometry")
    rows.repartition("geometry").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("grid", "geometry").parquet(folder)


def gather(folder: str, placed: DataFrame, keys: list[str], of: Grid) -> DataFrame:
    """(keys, line, cells of y, x, value): every ray of ``placed`` with the cells that it fills, values from its gates (null
    beyond them). Volumes whose plan the table has not are left out."""
    plan = _stored(placed.sparkSession, folder, of).select("geometry", "line", F.col("cells").alias("__cells"))
    cells = F.transform("__cells", lambda c: F.struct(c["y"].alias("y"), c["x"].alias("x"), F.get("values", c["gate"]).cast("double").alias("value")))
    return placed.select(*keys, "geometry", "line", "values").join(plan, ["geometry", "line"]).select(*keys, "line", cells.alias("cells"))


def grids(folder: str, placed: DataFrame, keys: list[str], of: Grid) -> DataFrame:
    """(keys, height, width, values): a row per volume, as the operators of ``grid`` take them."""
    met = gather(folder, placed, keys, of).groupBy(*keys).agg(F.array_sort(F.flatten(F.collect_list("cells"))).alias("c"))
    return met.select(*keys, F.lit(of.side).alias("height"), F.lit(of.side).alias("width"), F.col("c.value").alias("values"))
