"""Nearest neighbours through a permutation index.

Pivots are a bounded sample of vectors. A vector is represented by its ``PLACES`` nearest pivots in
order. Pivot p's inverted file posts the vectors that have p in their order, with its place there. The
index is split by documents: a block of up to ``BLOCK_ROWS`` vectors holds the posting lists of its own
vectors, so it is built by one pass without a shuffle, and every row is indexed.

A query reads the lists of its own PLACES pivots only, in every block. The footrule distance of two
orders (the sum over pivots of the difference of places, PLACES standing for absence) is a constant less
2 (PLACES - the greater place) for every pivot they share, so it is added up from those lists alone.
Of each block, the ``SHARE`` of vectors with the smallest footrule (never fewer than
``LEAST_CANDIDATES``, and all that tie with the last of them) are reranked by exact Euclidean distance
in double precision. Queries come in groups of about ``QUERY_ROWS`` rows, each broadcast: that size is
fixed, and a group costs one pass over the index.

Vectors that are null, empty, zero, or hold a null or non-finite component take no part, nor do rows
without an id. Vectors of different dimensions have no distance: each is searched among its own kind, and
a dimension too rare for the pivots' sample is compared in full. Rows that repeat an id count as one
vector: as a query the smaller vector, as a candidate the nearer one. Ties go to the smaller id. Empty
table -> no rows. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize

PIVOTS, PLACES = 2_048, 128  # a place fits one byte
BLOCK_ROWS = 16_384  # a place in a block fits two bytes
QUERY_ROWS = 16_384
SHARE, LEAST_CANDIDATES = 0.03, 300
#: Sampled vectors per pivot: equal vectors serve once.
SAMPLE_PER_PIVOT = 4


def usable(vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """(vec_id, v): rows that take part."""
    v = F.col("v")
    rows = vectors.select(F.col(id_column).cast("bigint").alias("vec_id"), F.col(vector_column).cast("array<double>").alias("v"))
    finite = F.forall(v, lambda x: F.coalesce(F.abs(x) < F.lit(float("inf")), F.lit(False)))
    return rows.where(F.col("vec_id").isNotNull() & v.isNotNull() & finite & F.exists(v, lambda x: x != 0.0))


def choose_pivots(rows: DataFrame, pivots: int) -> dict[int, np.ndarray]:
    """At most ``pivots`` distinct vectors of each dimension, from a bounded sample by the hash of the id."""
    wanted, n = SAMPLE_PER_PIVOT * pivots, rows.count()
    # hashes are uniform, so a bound on them leaves few rows to sort
    near = rows.where((F.xxhash64("vec_id").cast("double") / F.lit(2.0**64) + 0.5) <= F.lit((2.0 * wanted + 100) / max(n, 1)))
    chosen: dict[int, dict[tuple, None]] = {}
    for r in near.orderBy(F.xxhash64("vec_id"), "vec_id", "v").limit(wanted).collect():
        kind = chosen.setdefault(len(r["v"]), {})
        if len(kind) < pivots:
            kind[tuple(r["v"])] = None
    return {d: np.array(list(kind), dtype=np.float64) for d, kind in chosen.items()}


def orders(vectors: np.ndarray, pivots: np.ndarray | None, places: int = PLACES) -> np.ndarray:
    """The nearest pivots of every vector (row), nearest first; ties go to the earlier pivot."""
    if pivots is None:
        return np.empty((len(vectors), 0), np.int64)
    out = []
    for a in range(0, len(vectors), 1024):
        d = (pivots**2).sum(1)[None, :] - 2.0 * vectors[a : a + 1024] @ pivots.T
        near = np.sort(np.argpartition(d, min(places, d.shape[1]) - 1, axis=1)[:, :places], axis=1)
        out.append(np.take_along_axis(near, np.argsort(np.take_along_axis(d, near, 1), axis=1, kind="stable"), 1))
    return np.concatenate(out)


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    return np.asarray(column.flatten().to_numpy(zero_copy_only=False), dtype=np.float64).reshape(len(column), d)


_BLOCK = pa.schema([("n", pa.int32()), ("d", pa.int32()), ("ids", pa.binary()), ("vectors", pa.binary()), ("members", pa.binary()), ("places", pa.binary()), ("starts", pa.binary())])


def build(rows: DataFrame, pivots: dict[int, np.ndarray]) -> DataFrame:
    """Index blocks of ``rows(vec_id, v)``: ids, vectors, and the posting lists end to end: members, their places,
    and where each pivot's list starts."""

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column(1).value_lengths().to_numpy(zero_copy_only=False)
            for d in np.unique(sizes).tolist():
                kind = batch.filter(pa.array(sizes == d))
                for a in range(0, kind.num_rows, BLOCK_ROWS):
                    yield block(np.asarray(kind.column(0)[a : a + BLOCK_ROWS], np.int64), _matrix(kind.column(1)[a : a + BLOCK_ROWS], d), d)

    def block(ids: np.ndarray, v: np.ndarray, d: int) -> pa.RecordBatch:
        order = orders(v, pivots.get(d))
        by_pivot = np.argsort(order.ravel(), kind="stable")
        starts = np.searchsorted(order.ravel()[by_pivot], np.arange(len(pivots.get(d, ())) + 1))
        member, place = by_pivot // max(1, order.shape[1]), by_pivot % max(1, order.shape[1])
        columns = [len(ids), d, ids.tobytes(), v.tobytes(), member.astype("<u2").tobytes(), place.astype("u1").tobytes(), starts.astype("<i4").tobytes()]
        return pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(columns, _BLOCK)], schema=_BLOCK)

    return rows.mapInArrow(index, "n int, d int, ids binary, vectors binary, members binary, places binary, starts binary")


def shared_places(n: int, order: np.ndarray, members: np.ndarray, places: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """For one query order, PLACES - the greater place, added up over the pivots that each of n vectors shares."""
    out = np.zeros(n)
    lists = [slice(starts[p], starts[p + 1]) for p in order.tolist()]
    if lists:
        gains = [PLACES - np.maximum(places[x], place).astype(np.int64) for place, x in enumerate(lists)]
        out += np.bincount(np.concatenate([members[x] for x in lists]), np.concatenate(gains), n)
    return out


def _best(ids: np.ndarray, d: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((ids, d))
    ids, d = ids[order], d[order]
    _, first = np.unique(ids, return_index=True)
    first.sort()
    return ids[first[:k]], d[first[:k]]


def search(vectors: DataFrame, query_condition, k: int = 10, pivots: int = PIVOTS, share: float = SHARE, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score of the ``k`` nearest found of every row that meets the condition."""
    spark = vectors.sparkSession
    rows = usable(vectors, id_column, vector_column)
    centres = choose_pivots(rows, pivots)
    schema = "query_id long, rank int, vec_id long, score double"
    if not centres:
        return spark.createDataFrame([], schema)
    index = materialize(build(rows, centres), "permutation-index")
    asked = rows.where(query_condition).groupBy("vec_id").agg(F.min("v").alias("v"))
    n = asked.count()
    if not n:
        return spark.createDataFrame([], schema)
    groups = -(-n // QUERY_ROWS)
    found = []
    for g in range(groups):
        # about QUERY_ROWS vectors: a block of the stated query set, of fixed size
        block = sorted(asked.where(F.pmod(F.xxhash64("vec_id"), F.lit(groups)) == g).collect(), key=lambda r: r["vec_id"])
        kinds = {}
        for d in {len(r["v"]) for r in block}:
            own = [r for r in block if len(r["v"]) == d]
            q = np.array([r["v"] for r in own])
            kinds[d] = (np.array([r["vec_id"] for r in own], np.int64), q, orders(q, centres.get(d)).astype(np.int16))
        if kinds:
            found.append(index.mapInArrow(_searcher(spark.sparkContext.broadcast(kinds), k, share), "query_id long, vec_id long, score double"))
    near = reduce(DataFrame.unionByName, found).groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _searcher(sent, k: int, share: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for row in range(batch.num_rows):
                n, d, *parts = (batch.column(i)[row] for i in range(7))
                ids, v, members, places, starts = (np.frombuffer(x.as_buffer(), t) for x, t in zip(parts, (np.int64, np.float64, "<u2", "u1", "<i4")))
                n, d = n.as_py(), d.as_py()
                if d not in sent.value:
                    continue
                qids, q, order = sent.value[d]
                wanted = min(n, max(LEAST_CANDIDATES, k + 1, int(np.ceil(share * n)))) if order.shape[1] else n
                v = v.reshape(n, d)
                for j, query in enumerate(qids.tolist()):
                    near = np.arange(n)
                    if wanted < n:
                        shared = shared_places(n, order[j], members, places, starts)
                        near = np.flatnonzero(shared >= np.partition(shared, n - wanted)[n - wanted])
                    near = near[ids[near] != query]
                    found, score = ids[near], np.sqrt(((v[near] - q[j]) ** 2).sum(1))
                    if query in kept:
                        found, score = np.concatenate([kept[query][0], found]), np.concatenate([kept[query][1], score])
                    kept[query] = _best(found, score, k)
        if kept:
            sizes = [len(x[0]) for x in kept.values()]
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(list(kept), sizes), pa.int64()), pa.array(np.concatenate([x[0] for x in kept.values()])), pa.array(np.concatenate([x[1] for x in kept.values()]))], names=["query_id", "vec_id", "score"])

    return run
