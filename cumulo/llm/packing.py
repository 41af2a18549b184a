"""Best-fit packing of token pieces into sequences, as a vector problem.

An item is a vector (tokens, documents, attention cost): its length, one, and its length squared. A
sequence has a capacity for each. All three follow from the length alone, so the state of the whole
corpus is a histogram over at most ``max_tokens`` lengths, however many documents there are. The
packing is solved exactly once, on that histogram: lengths are placed from longest to shortest, each
into the open bins (grouped by their residual vector, with a count) that fit under every constraint
and score best, by weighted dot product of residual and item or by the norm of the residual left.
Every selection rule in ``RULES`` is solved and the one with the fewest bins is used.

The solution is a table of intervals: the pieces of a length with rank in [first, last) go to bins
first_bin + (rank - first) div each, at place offset + (rank - first) mod each * length. Ranks within
a length are given in parallel: pieces are spread over hashed buckets, buckets are counted, and the
running counts added to a rank inside the bucket, so a length that a third of all pieces share is
never ranked by one task.

Defined cases: null or empty text -> one piece holding the end id; equal documents and repeated ids
-> a piece each; empty table -> no rows; extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import bound_batches, materialize
from .tokenize import encoded

#: Pieces that one bucket of a length holds on average; the number of buckets follows the input.
PIECES_PER_BUCKET = 2_000
LEAST_BUCKETS = 64
#: Buckets whose counts one task adds up.
BUCKETS_PER_GROUP = 1_000


@dataclass(frozen=True)
class Limits:
    """Capacities of a sequence. Documents and attention cost default to what the token limit allows
    anyway, so that they bind only when a caller lowers them."""

    tokens: int = 2048
    documents: int = 2048
    attention: int = 2048 * 2048


#: (name, weights of tokens, documents, attention) of the selection rules tried.
RULES = (("norm", 1.0, 0.0, 0.0), ("norm", 1.0, 0.2, 0.2), ("dot", 1.0, 0.0, 0.0), ("dot", 1.0, 0.5, 0.5))


def _score(rule, residual: np.ndarray, item: np.ndarray, capacity: np.ndarray) -> np.ndarray:
    """Lower is better, for bins with ``residual`` (rows) that are to take ``item``."""
    weights = np.array(rule[1:])
    if rule[0] == "dot":
        # a tight bin's residual points along the item: the smaller the product with the item, the better the fit
        return (weights * (residual / capacity) * (item / capacity)).sum(1)
    return (weights * ((residual - item) / capacity) ** 2).sum(1)


def solve(histogram: dict[int, int], limits: Limits, rule=RULES[0]) -> list[tuple[int, int, int, int, int, int]]:
    """Intervals (length, first, last, first_bin, each, offset) for a histogram of lengths.

    A bin group is (residual vector, number of bins, first bin number, fill). Groups split when only
    part of their bins take a length, so the work depends on the lengths, not on the pieces.
    """
    capacity = np.array([limits.tokens, limits.documents, limits.attention], dtype=float)
    residual = np.zeros((0, 3))
    meta: list[tuple[int, int]] = []  # bins, first bin
    out, bins = [], 0
    for length in sorted((n for n in histogram if histogram[n] > 0), reverse=True):
        item = np.array([length, 1, length * length], dtype=float)
        if (item > capacity).any():
            raise ValueError(f"a piece of {length} tokens exceeds the limits")
        left, rank = histogram[length], 0
        while left:
            fits = np.flatnonzero((residual >= item).all(1)) if len(residual) else np.empty(0, int)
            if len(fits):
                at = int(fits[np.argmin(_score(rule, residual[fits], item, capacity))])
                free, (count, first) = residual[at], meta[at]
            else:
                at, free, first = -1, capacity, bins
                count = -(-left // int(min(capacity // item)))
                bins += count
            each = int(min(free // item))
            used = min(count, left // each) if left >= each else 1
            each = min(each, left)
            offset = int(limits.tokens - free[0])
            out.append((length, rank, rank + used * each, first, each, offset))
            rank, left = rank + used * each, left - used * each
            rest = [(free - each * item, (used, first))]
            if used < count:
                rest.append((free, (count - used, first + used)))
            if at >= 0:
                residual = np.delete(residual, at, 0)
                meta.pop(at)
            rest = [r for r in rest if r[0][0] >= 1 and r[0][1] >= 1]
            if rest:
                residual = np.vstack([residual, [r[0] for r in rest]])
                meta += [r[1] for r in rest]
    return out


def solve_best(histogram: dict[int, int], limits: Limits) -> list[tuple[int, int, int, int, int, int]]:
    plans = [solve(histogram, limits, rule) for rule in RULES]
    return min(plans, key=lambda p: max((first_bin + -(-(last - first) // each) for _, first, last, first_bin, each, _ in p), default=0))


def tokenize_pieces(docs: DataFrame, tokenizer_path: str, end_id: int, max_tokens: int, keep_ids: bool = False, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Pieces of at most ``max_tokens`` ids: doc_id, piece, start, length, ids_crc32 (and ids as bytes)."""

    def cut(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        end, step = np.array([end_id], "<u4").tobytes(), 4 * max_tokens
        for ids, tokens in encoded(rows, tokenizer_path):
            doc, piece, start, length, crc, raw = [], [], [], [], [], []
            for doc_id, data in zip(ids, tokens):
                data += end
                for k, at in enumerate(range(0, len(data), step)):
                    part = data[at : at + step]
                    doc.append(doc_id)
                    piece.append(k)
                    start.append(at // 4)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
                    if keep_ids:
                        raw.append(part)
            arrays = [pa.array(doc, pa.int64()), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if keep_ids:
                arrays, names = [*arrays, pa.array(raw, pa.binary())], [*names, "ids"]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * keep_ids
    return bound_batches(docs).select(F.col(id_column).cast("bigint").alias("__id"), F.col(text_column).alias("__text")).mapInArrow(cut, schema)


def assign(pieces: DataFrame, limits: Limits) -> DataFrame:
    """Add sequence_id and offset to pieces that have a column ``length``; other columns stay."""
    spark = pieces.sparkSession
    total = pieces.count()
    buckets = max(LEAST_BUCKETS, -(-total // PIECES_PER_BUCKET))
    keyed = pieces.withColumn("__bucket", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(buckets)))
    counts = materialize(keyed.groupBy("length", "__bucket").agg(F.count("*").alias("__n")), "packing-counts")
    # at most max_tokens rows, whatever the input: the histogram
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("__n").alias("n")).collect()}
    plan = solve_best(histogram, limits)
    slots = spark.createDataFrame(plan, "length long, __first long, __last long, __bin long, __each long, __offset long")
    # running counts in two levels: over groups of buckets, then over the buckets of a group
    counts = counts.withColumn("__group", F.floor(F.col("__bucket") / BUCKETS_PER_GROUP))
    running = lambda key, *of: F.coalesce(F.sum("__n").over(Window.partitionBy(*of).orderBy(key).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    groups = counts.groupBy("length", "__group").agg(F.sum("__n").alias("__n")).select("length", "__group", running("__group", "length").alias("__before"))
    bases = counts.select("length", "__group", "__bucket", running("__bucket", "length", "__group").alias("__inside")).join(groups, ["length", "__group"])
    bases = bases.select("length", "__bucket", (F.col("__before") + F.col("__inside")).alias("__base"))
    inside = Window.partitionBy("length", "__bucket").orderBy("doc_id", "piece", "ids_crc32")
    ranked = keyed.withColumn("__k", F.row_number().over(inside) - 1).join(bases, ["length", "__bucket"]).withColumn("__rank", F.col("__base") + F.col("__k"))
    within = F.col("__rank") - F.col("__first")
    placed = ranked.join(F.broadcast(slots), (ranked["length"] == slots["length"]) & (F.col("__rank") >= F.col("__first")) & (F.col("__rank") < F.col("__last"))).drop(slots["length"])
    return placed.select(
        *[F.col(c) for c in pieces.columns],
        (F.col("__bin") + F.floor(within / F.col("__each"))).cast("long").alias("sequence_id"),
        (F.col("__offset") + within % F.col("__each") * F.col("length")).cast("long").alias("offset"),
    )


def pack_documents(docs: DataFrame, tokenizer_path: str, end_id: int = 0, limits: Limits | None = None, keep_ids: bool = False) -> DataFrame:
    limits = limits or Limits()
    pieces = materialize(tokenize_pieces(docs, tokenizer_path, end_id, limits.tokens, keep_ids), "packing-pieces")
    return assign(pieces, limits)
