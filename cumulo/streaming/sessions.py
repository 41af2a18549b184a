"""Track sessions over a stream: a file source, a watermark, session windows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_tracks(spark: SparkSession, folder: str, schema: str, per_trigger: int = 16) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", per_trigger).parquet(folder)


def sessions(points: DataFrame, gap: str = "6 hours", late: str = "1 day", key: str = "storm_id", time: str = "time") -> DataFrame:
    """start, last and n of each storm's sessions; a gap of exactly the limit still joins two rows.

    Works alike on a batch. State is one row per open session; the watermark bounds how many are open.
    """
    rows = points.withWatermark(time, late) if points.isStreaming else points
    found = rows.groupBy(F.session_window(time, f"{gap} 1 microsecond"), key)
    return found.agg(F.min(time).alias("start"), F.max(time).alias("last"), F.count("*").alias("n")).drop("session_window")


def write(stream: DataFrame, folder: str, checkpoint: str):
    return stream.writeStream.format("parquet").outputMode("append").option("path", folder).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
