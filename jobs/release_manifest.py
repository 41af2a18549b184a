"""Manifest and catalog of a text release, kept up as files arrive.

    python jobs/release_manifest.py --config jobs/release_manifest.json --output OUT --checkpoint MARK \
        --input documents=IN/documents.parquet --input pages=IN/pages.parquet

Every feed of the config is a folder of Parquet files (or one file) whose rows are the release's files. A file
stream with a checkpoint takes what arrived since the run before and stops (``availableNow``). Output:

* ``OUT/manifest`` (partitions feed, batch): relpath, site, product, size_bytes, sha256 of every file;
* ``OUT/counted`` (partitions feed, batch): what a batch added to each site, so old rows are not counted again;
* ``OUT/catalog`` (partition feed): a row per site: files, distinct contents, bytes.

A batch overwrites its own partitions only, so one that is run again after a failure leaves the same rows. A row
that was delivered before (same path, same checksum), in this batch or another, is not listed again; a
changed file is listed as a row more. Null bodies count as empty, null sites and products as ``unknown``.
"""

from __future__ import annotations

import argparse
import json
import logging
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from cumulo.functions.names import bytes_text_column  # noqa: E402

LOG = logging.getLogger("jobs.release_manifest")
MANIFEST = "relpath string, site string, product string, size_bytes long, sha256 string, feed string, batch long"
COUNTED = "site string, files long, contents long, total_bytes long, feed string, batch long"


def manifest_rows(arrived: DataFrame, feed: str, spec: dict) -> DataFrame:
    """relpath, site, product, size_bytes and sha256 of each arrived row, by the feed's expressions."""
    known = lambda name: F.coalesce(F.expr(spec[name]).cast("string"), F.lit("unknown"))
    body = F.coalesce(F.expr(spec["body"]).cast("string"), F.lit(""))
    rows = arrived.select(known("site").alias("site"), known("product").alias("product"), known("id").alias("id"), F.octet_length(body).cast("long").alias("size_bytes"), F.sha2(body, 256).alias("sha256"))
    key = F.regexp_replace(F.lower("site"), "[^0-9a-z]+", "_")
    path = F.concat(F.concat_ws("/", F.lit(feed), key, "product", "id"), F.lit("." + spec["suffix"]))
    return rows.select(path.alias("relpath"), "site", "product", "size_bytes", "sha256")


def _table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The table at ``path``, after making an empty one where none is."""
    spark.createDataFrame([], schema).write.mode("ignore").partitionBy("feed", "batch").parquet(path)
    return spark.read.schema(schema).parquet(path)


def _replace(rows: DataFrame, path: str, *parts: str) -> None:
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*parts).parquet(path)


def add_batch(arrived: DataFrame, batch: int, feed: str, spec: dict, output: str) -> None:
    """List a batch's new rows and count them by site; both go to the batch's own partitions."""
    spark = arrived.sparkSession
    before = _table(spark, f"{output}/manifest", MANIFEST).where((F.col("feed") == feed) & (F.col("batch") != batch))
    rows = manifest_rows(arrived, feed, spec).dropDuplicates(["relpath", "sha256"])
    new = rows.join(before.select("relpath", "sha256"), ["relpath", "sha256"], "left_anti")
    _replace(new.withColumns({"feed": F.lit(feed), "batch": F.lit(batch)}), f"{output}/manifest", "feed", "batch")
    _table(spark, f"{output}/counted", COUNTED)
    # from here on the listed rows are read, not the arrived ones
    listed = spark.read.schema(MANIFEST).parquet(f"{output}/manifest").where((F.col("feed") == feed) & (F.col("batch") == batch))
    sums = listed.groupBy("site").agg(F.count("*").alias("files"), F.sum("size_bytes").alias("total_bytes"))
    contents = listed.select("site", "sha256").distinct().join(before.select("site", "sha256"), ["site", "sha256"], "left_anti")
    counted = sums.join(contents.groupBy("site").agg(F.count("*").alias("contents")), "site", "left")
    counted = counted.select("site", "files", F.coalesce("contents", F.lit(0)).alias("contents"), "total_bytes", F.lit(feed).alias("feed"), F.lit(batch).cast("long").alias("batch"))
    _replace(counted, f"{output}/counted", "feed", "batch")
    added = spark.read.schema(COUNTED).parquet(f"{output}/counted").where((F.col("feed") == feed) & (F.col("batch") == batch))
    total = added.agg(F.coalesce(F.sum("files"), F.lit(0)).alias("files"), F.coalesce(F.sum("total_bytes"), F.lit(0)).alias("bytes")).first()
    LOG.info("%s, batch %d: wrote %d new files of %d bytes to %s/manifest", feed, batch, total["files"], total["bytes"], output)


def catalog_rows(spark: SparkSession, output: str) -> DataFrame:
    """A row per feed and site, from what the batches counted."""
    sums = _table(spark, f"{output}/counted", COUNTED).groupBy("feed", "site").agg(*[F.sum(c).alias(c) for c in ("files", "contents", "total_bytes")])
    return sums.withColumn("size", bytes_text_column(F.col("total_bytes")))


def as_pattern(path: str) -> str:
    """The path as a pattern that matches it alone: a file stream takes a folder or a pattern, but no single file."""
    path = path.rstrip("/")
    return path if set(path) & set("{}[]*?") else f"{path[:-1]}[{path[-1]}]"


def run(spark: SparkSession, inputs: dict[str, str], output: str, checkpoint: str, config: dict) -> dict[str, int]:
    """Take in what is new in every feed's input and bring the catalog up to date; the rows read, by feed."""
    if unknown := set(inputs) - set(config["feeds"]):
        raise ValueError(f"no such feed in the config: {', '.join(sorted(unknown))}")
    read = {}
    for feed, path in sorted(inputs.items()):
        spec = config["feeds"][feed]
        stream = spark.readStream.schema(spark.read.parquet(path).schema).option("maxFilesPerTrigger", config.get("files_per_trigger", 64)).parquet(as_pattern(path))
        writer = stream.writeStream.foreachBatch(lambda rows, k, feed=feed, spec=spec: add_batch(rows, k, feed, spec, output))
        query = writer.option("checkpointLocation", f"{checkpoint}/{feed}").trigger(availableNow=True).start()
        query.awaitTermination()
        read[feed] = sum(p["numInputRows"] for p in query.recentProgress)
        LOG.info("%s: read %d new rows of %s", feed, read[feed], path)
    _replace(catalog_rows(spark, output), f"{output}/catalog", "feed")
    LOG.info("wrote %s/catalog", output)
    return read


def read_config(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.text(path, wholetext=True).first()[0])


def main(args: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    parser.add_argument("--config", required=True)
    parser.add_argument("--output", required=True)
    parser.add_argument("--checkpoint", required=True)
    parser.add_argument("--input", action="append", required=True, metavar="FEED=PATH")
    given = parser.parse_args(args)
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(name)s %(message)s")
    from cumulo import session

    spark = session.create("release-manifest")
    try:
        run(spark, dict(x.split("=", 1) for x in given.input), given.output, given.checkpoint, read_config(spark, given.config))
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
