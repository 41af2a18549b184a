"""SimHash near-duplicate components through a byte-position inverted index.

Fingerprint: A-Z lower-cased, words are runs of anything but ASCII white space, shingles of
``shingle_words`` words (repeats count) joined by one space; a bit is set if set in over half of the
shingles' XXH64 values (UTF-8, seed 42). Fewer words make one shingle of all; no word gives zero.

Links: two 64-bit fingerprints that differ in at most ``max_bits`` bits agree in at least
8 - max_bits of their 8 positional bytes. That guaranteed minimum is the count filter. Lists of
single (position, byte) pairs would hold a 256th of the corpus each, and tallying them is quadratic;
so a posting key is a whole set of 8 - max_bits positions with their bytes, and two fingerprints meet
in a list exactly if their tally of shared positional bytes reaches the minimum. Members of a list
differ in max_bits bytes only, so a list has at most 256 ** max_bits distinct fingerprints: with two
bits, 65,536, however large the corpus. Inside a list, links are verified exactly and a spanning
forest of them is emitted, never all pairs. Equal fingerprints are one node from the start.

Defined cases: null or empty text -> fingerprint zero, linked as any other; null id -> takes part,
never names a component unless all ids are null; repeated ids and rows -> one output row each; empty
table -> no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bound_batches, materialize, release_memory, to_hex64
from .graph import connected_components

SEED = 42
#: Lists up to this size are compared as a whole; longer ones by flipping bits of each member.
SMALL_LIST = 256


def fingerprint(text: bytes, shingle_words: int = 3) -> int:
    import xxhash

    words = text.lower().split()
    if not words:
        return 0
    n = len(words)
    joined = b" ".join(words)
    if n <= shingle_words:
        return xxhash.xxh64_intdigest(joined, SEED)
    ends = list(accumulate(len(w) + 1 for w in words))
    starts, digest = [0, *ends], xxhash.xxh64_intdigest
    hashes = [digest(joined[s : e - 1], SEED) for s, e in zip(starts, ends[shingle_words - 1 :])]
    bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return int(np.packbits(2 * bits.sum(0, dtype=np.int64) > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle_words: int = 3, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id and fingerprint (fp, the 64 bits as a signed long) of every row."""

    def scan(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            values = [fingerprint(t or b"", shingle_words) for t in batch.column(1).cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.array(values, "<u8").view("<i8"))], names=["doc_id", "fp"])
        release_memory()

    return bound_batches(docs).select(F.col(id_column).cast("bigint").alias("doc_id"), F.col(text_column).alias("__text")).mapInArrow(scan, "doc_id long, fp long")


def _forest(values: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Star edges (member, smallest member) of the components that links form among ``values``."""
    n = len(values)
    label = np.arange(n)
    if n <= SMALL_LIST:
        near = np.bitwise_count(values[:, None] ^ values[None, :]) <= max_bits
        pairs = [np.nonzero(near[:, j])[0] for j in range(n)]
        neighbours = lambda: ((np.full(len(p), j), p) for j, p in enumerate(pairs))
    else:
        differing = [b for b in range(64) if len(np.unique((values >> np.uint64(b)) & np.uint64(1))) > 1]
        masks = [np.uint64(sum(1 << b for b in c)) for k in range(1, max_bits + 1) for c in combinations(differing, k)]

        def neighbours():
            for mask in masks:
                other = values ^ mask
                at = np.minimum(np.searchsorted(values, other), n - 1)
                hit = np.flatnonzero(values[at] == other)
                if len(hit):
                    yield hit, at[hit]

    while True:
        old = label.copy()
        for a, b in neighbours():
            low = np.minimum(label[a], label[b])
            np.minimum.at(label, a, low)
            np.minimum.at(label, b, low)
        while not np.array_equal(label, label[label]):
            label = label[label]
        if np.array_equal(old, label):
            break
    member = np.flatnonzero(label != np.arange(n))
    return member, label[member]


def links(distinct: DataFrame, max_bits: int = 2) -> DataFrame:
    """Edges (u, v) whose components are those of all links between the distinct values of ``fp``."""
    keep = 8 - max_bits
    masks = [sum(0xFF << (8 * p) for p in c) for c in combinations(range(8), keep)]
    signed = [m - (1 << 64) if m >= 1 << 63 else m for m in masks]
    keys = F.array(*[F.struct(F.lit(k).alias("positions"), F.col("fp").bitwiseAND(F.lit(m).cast("long")).alias("shared")) for k, m in enumerate(signed)])
    lists = distinct.select("fp", F.explode(keys).alias("key")).groupBy("key.positions", "key.shared").agg(F.count("*").alias("n"), F.collect_list("fp").alias("fps")).where("n > 1").select("fps")

    def verify(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            us, vs = [], []
            for fps in batch.column(0):
                values = np.sort(fps.values.to_numpy(zero_copy_only=False).view("<u8"))
                member, root = _forest(values, max_bits)
                us.append(values[member])
                vs.append(values[root])
            u, v = (np.concatenate([np.empty(0, "<u8"), *x]).astype("<u8").view("<i8") for x in (us, vs))
            yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])

    return lists.mapInArrow(verify, "u long, v long")


def components(prints: DataFrame, max_bits: int = 2) -> DataFrame:
    """For (doc_id, fp) rows: doc_id, fp, label (a fingerprint that names the component), component_id.
    ``prints`` should be cheap to read twice."""
    return prints.join(_resolve(prints, max_bits), "fp").select("doc_id", "fp", "label", "component_id")


def _resolve(prints: DataFrame, max_bits: int) -> DataFrame:
    nodes = materialize(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "fingerprints-distinct")
    labels = connected_components(links(nodes.select("fp"), max_bits))
    named = nodes.join(labels, nodes["fp"] == labels["node"], "left").select("fp", "least", F.coalesce("component", "fp").alias("label"))
    names = named.groupBy("label").agg(F.min("least").alias("component_id"))
    return materialize(named.join(names, "label").select("fp", "label", "component_id"), "fingerprint-components")


def near_duplicates(docs: DataFrame, shingle_words: int = 3, max_bits: int = 2) -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits), component_id (smallest doc_id reachable)."""
    prints = materialize(fingerprints(docs, shingle_words), "fingerprints")
    return components(prints, max_bits).select("doc_id", to_hex64(F.col("fp")).alias("fingerprint"), "component_id")
