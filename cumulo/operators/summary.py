"""Small reports over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def top_counts(df: DataFrame, column: str, n: int = 5) -> DataFrame:
    """(name, n) of the ``n`` most frequent values; ties by name. Counts are combined before they are ranked."""
    counted = df.groupBy(F.col(column).alias("name")).agg(F.count("*").alias("n"))
    return counted.orderBy(F.desc("n"), "name").limit(n)


def network_summary(stations: DataFrame, network: str, value: str, least: int = 2) -> DataFrame:
    """(network, stations, reporting, top): stations of each network, those whose value, coerced to a number, is
    positive, and the greatest; networks of fewer than ``least`` stations go."""
    number = F.col(value).cast("string").try_cast("double")
    found = stations.groupBy(F.col(network).alias("network")).agg(F.count("*").alias("stations"), F.count_if(number > 0).alias("reporting"), F.max(number).alias("top"))
    return found.where(F.col("stations") >= least)


def running_max_guard(df: DataFrame, keys: list[str], order: list[str], value: str) -> DataFrame:
    """Values that dip under an earlier one of their group are replaced by the greatest so far, so that they never
    fall; a null stays null."""
    so_far = F.max(value).over(Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    return df.withColumn(value, F.when(F.col(value).isNotNull(), so_far))
