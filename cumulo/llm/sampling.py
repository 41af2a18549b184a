"""Bounded samples of labelled rows for fitting; the bounds are parameters of every caller."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, small_side


#: Characters of all texts of a class together that come to the driver.
TOTAL_CHARS = 20_000_000
#: Rows up to which a side is broadcast, after counting them.
BROADCAST_ROWS = 100_000


def labelled_sample(docs: DataFrame, labels: DataFrame, label_column: str, allowed, at_most: tuple[int, int], max_chars: int, total_chars: int = TOTAL_CHARS) -> tuple[list[str], list[int]]:
    """Texts and labels of at most ``at_most[y]`` labelled documents of either class y.

    ``allowed`` is a condition on doc_id that tells which rows may be learnt from. The choice goes by
    a hash of the id. Texts of over ``max_chars`` characters are left out of the fit (not of scoring).
    Only the chosen texts come to the driver: at most sum(at_most) rows, and ``total_chars`` characters of
    a class, in the order of the hashes. Of rows that repeat an id, one is kept.
    """
    rows = labels.where(F.col(label_column).isin(0, 1) & allowed).groupBy("doc_id").agg(F.max(label_column).alias("__y"))
    pick = lambda y: rows.where(F.col("__y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(at_most[y])
    chosen = pick(0).unionByName(pick(1))
    usable = docs.where(F.col("text").isNotNull() & (F.length("text") <= max_chars)).select("doc_id", "text")
    found = usable.join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.min("__y").alias("y"))
    found = materialize(found.withColumn("h", F.xxhash64("doc_id")), "labelled-sample")
    # the hashes up to which the characters are few enough, from sum(at_most) lengths
    sizes = found.select("y", "h", F.length("text").alias("n")).toPandas().sort_values(["y", "h"])
    last = {y: int(rows.h[rows.n.cumsum() <= total_chars].max()) for y, rows in sizes.groupby("y") if (rows.n.iloc[0] <= total_chars)}
    if not last:
        return [], []
    within = reduce(lambda a, b: a | b, [(F.col("y") == y) & (F.col("h") <= h) for y, h in last.items()])
    pdf = found.where(within).toPandas().sort_values("doc_id")
    return pdf["text"].tolist(), pdf["y"].astype(int).tolist()


def language_sample(docs: DataFrame, allowed, per_language: int, max_chars: int) -> dict[str, list[str]]:
    """At most ``per_language`` texts of at most ``max_chars`` characters for each non-null lang."""
    usable = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & allowed & (F.length("text") <= max_chars)).select("lang", "doc_id", "text", F.xxhash64("doc_id").alias("h"))
    least = _least_hashes(usable, per_language)
    found = usable.join(small_side(least, BROADCAST_ROWS), ["lang", "h"]).groupBy("lang", "h").agg(F.min("text").alias("text"))
    pdf = found.toPandas().sort_values(["lang", "h"])
    return {lang: rows["text"].tolist() for lang, rows in pdf.groupby("lang")}


def _least_hashes(usable: DataFrame, n: int) -> DataFrame:
    """(lang, h): the n smallest hashes of each language. Hashes are uniform, so a bound on h that
    leaves about 4 n rows per language comes from counts alone; the rank is taken among those."""
    counts = usable.groupBy("lang").agg(F.count("*").alias("n"))
    near = usable.select("lang", "h").join(small_side(counts, BROADCAST_ROWS), "lang")
    # share of the hash range to look at; everything where a language has few rows
    near = near.where((F.col("h").cast("double") / F.lit(2.0**64) + 0.5) <= F.lit(4.0 * n + 100) / F.col("n")).select("lang", "h").distinct()
    ranked = near.withColumn("k", F.row_number().over(Window.partitionBy("lang").orderBy("h")))
    return ranked.where(F.col("k") <= n).select("lang", "h")

