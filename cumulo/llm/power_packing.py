"""Packing by power-of-two decomposition: sequences of equal, binary length, none across documents.

The number of a document's ids (its end id included), written in binary, names its pieces: one of
2**k ids for every bit k that is set, longest first, and as many of ``max_tokens`` as the part above
holds. Every piece is a sequence by itself, so no sequence crosses documents, none is padded and no
attention mask between documents is needed. Sequences of one length form a bucket, from which batches
of a constant number of tokens are drawn.

Sequences are numbered bucket by bucket, from the shortest length on, without a gap. A task counts its
own pieces of each length while it cuts them, so a piece's number is the count of its task so far, plus
what earlier tasks cut of that length, plus the shorter buckets. Only those totals, at most twelve
for a task, are ever added up; no document or piece is shuffled, and no key can be hot.

Defined cases: null or empty text -> one piece of one token, the end id; equal documents, repeated and
null ids -> pieces of their own each; empty table -> no rows; extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import bound_batches, materialize, small_side
from .tokenize import encoded

#: Totals (one for a task and a length) that a broadcast may hold; more are joined ordinarily.
BROADCAST_TOTALS = 200_000


def binary_lengths(n: int, max_tokens: int) -> list[int]:
    """Lengths of the pieces of ``n`` ids, longest first: powers of two up to ``max_tokens`` that add up to ``n``."""
    full, rest = divmod(n, max_tokens)
    return [max_tokens] * full + [1 << k for k in range(max_tokens.bit_length() - 2, -1, -1) if rest >> k & 1]


def cut_pieces(docs: DataFrame, tokenizer_path: str, end_id: int, max_tokens: int, keep_ids: bool = False, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Rows (doc_id, start, length, ids_crc32, doc_tokens, task, nth[, ids]): the pieces of every document. ``nth``
    counts the pieces of this length that this task cut before."""
    if max_tokens < 1 or max_tokens & (max_tokens - 1):
        raise ValueError("max_tokens must be a power of two")
    fields = [("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()), ("task", pa.int32()), ("nth", pa.int64())]
    fields += [("ids", pa.binary())] * keep_ids

    def cut(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, seen, end = TaskContext.get().partitionId(), Counter(), np.array([end_id], "<u4").tobytes()
        for ids, tokens in encoded(rows, tokenizer_path):
            found: list[tuple] = []
            for doc_id, data in zip(ids, tokens):
                data += end
                total, start = len(data) // 4, 0
                for length in binary_lengths(total, max_tokens):
                    part = data[4 * start : 4 * (start + length)]
                    found.append((doc_id, start, length, zlib.crc32(part), total, task, seen[length], part)[: len(fields)])
                    seen[length] += 1
                    start += length
            yield pa.RecordBatch.from_arrays([pa.array(values, kind) for values, (_, kind) in zip(zip(*found), fields)], names=[name for name, _ in fields])

    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, task int, nth long" + ", ids binary" * keep_ids
    return bound_batches(docs).select(F.col(id_column).cast("bigint").alias("__id"), F.col(text_column).alias("__text")).mapInArrow(cut, schema)


def number_sequences(pieces: DataFrame) -> DataFrame:
    """Add sequence_id, offset and bucket_rank (the number inside the sequence's bucket) to ``cut_pieces`` that were
    written before (``task`` and ``nth`` go)."""
    totals = pieces.groupBy("length", "task").agg((F.max("nth") + 1).alias("__n"))
    tasks = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    # a row for every length, twelve at most
    shorter = totals.groupBy("length").agg(F.sum("__n").alias("__all"))
    lengths = Window.orderBy("length").rowsBetween(Window.unboundedPreceding, -1)
    shorter = shorter.select("length", F.coalesce(F.sum("__all").over(lengths), F.lit(0)).alias("__bucket"))
    bases = totals.select("length", "task", F.coalesce(F.sum("__n").over(tasks), F.lit(0)).alias("__before")).join(shorter, "length")
    placed = pieces.join(small_side(materialize(bases, "power-bases"), BROADCAST_TOTALS), ["length", "task"])
    rank = F.col("__before") + F.col("nth")
    return placed.select(
        *[c for c in pieces.columns if c not in ("task", "nth")],
        (F.col("__bucket") + rank).cast("long").alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
        rank.cast("long").alias("bucket_rank"),
    )


def batch_number(tokens_per_batch: int) -> Column:
    """Number of a sequence's batch inside its bucket, for batches of ``tokens_per_batch`` tokens of one length."""
    return F.floor(F.col("bucket_rank") * F.col("length") / F.lit(tokens_per_batch)).cast("long")


def pack_documents(docs: DataFrame, tokenizer_path: str, end_id: int = 1, max_tokens: int = 2048, keep_ids: bool = False) -> DataFrame:
    return number_sequences(materialize(cut_pieces(docs, tokenizer_path, end_id, max_tokens, keep_ids), "power-pieces"))
