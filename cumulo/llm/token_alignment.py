"""Alignment of two tokenizations of the same text, and counts of the token pairs that it links.

Vocabulary A is a byte-level BPE, B a SentencePiece one that writes a space before the text; both are
compared on the bytes of space+text. The tokens of a text are the nodes of a bipartite graph, with an
edge wherever a token of A and one of B share a byte. Union-find over those edges gives connected
components, which are exactly the minimal groups between byte offsets where tokens of both
vocabularies end. Inside a component, members whose byte ranges end together are linked: its last ones,
as two others that ended together would have cut it there.

Whole texts are encoded by the libraries, some megabytes at once, and union-find runs on arrays: in a
round every edge hooks the greater of its two roots below the lesser and all parents are followed to
their roots, until no edge joins two roots.

Pairs are counted over the corpus by an aggregate over each document's distinct pairs, each with its
number, so a frequent pair is added up before the shuffle. The counts come back to the documents
by a join that broadcasts them up to BROADCAST_PAIRS rows and deals every pair to parts beyond.

Defined cases: null or empty text, and a text whose joined bytes in A or B differ from space+text -> no
tokens, all numbers 0, groups '' (unhashed); equal documents, repeated and null ids -> a row each; empty
table -> no rows; extra columns are ignored; very long texts are treated whole, in linear space.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import bound_batches, hot_join, materialize, release_memory
from .tokenize import _BYTE_LETTERS, PieceEncoder

#: Distinct pairs that a broadcast may hold (about 40 bytes each).
BROADCAST_PAIRS = 1_000_000
#: Characters that are encoded and aligned together.
CHARACTERS_AT_ONCE = 2 << 20
#: Words of A kept per worker, in two generations. Bounds memory, changes no result.
KEPT_PIECES = 500_000

_NONE = np.empty(0, np.uint32)


def components(first: np.ndarray, second: np.ndarray, nodes: int) -> np.ndarray:
    """The least node of every node's connected component, by union-find over edges (first, second)."""
    parent = np.arange(nodes)
    while True:
        a, b = parent[first], parent[second]
        apart = a != b
        if not apart.any():
            return parent
        first, second, a, b = first[apart], second[apart], a[apart], b[apart]
        np.minimum.at(parent, np.maximum(a, b), np.minimum(a, b))
        while not np.array_equal(above := parent[parent], parent):
            parent = above


def overlap_groups(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the component, in text order, of every token of A and of B; tokens are given by their rising end
    offsets, both cover the same bytes."""
    stops = np.sort(np.concatenate([ends_a, ends_b]), kind="stable")
    stops = stops[np.r_[stops[1:] != stops[:-1], True][: len(stops)]]
    # between two neighbouring offsets lie just one token of A and one of B: an edge
    root = components(np.searchsorted(ends_a, stops), len(ends_a) + np.searchsorted(ends_b, stops), len(ends_a) + len(ends_b))
    number = lambda r: np.cumsum(np.r_[0, r[1:] != r[:-1]][: len(r)])
    return number(root[: len(ends_a)]), number(root[len(ends_a) :])


class Aligner:
    def __init__(self, path_a: str, path_b: str):
        from sentencepiece import SentencePieceProcessor

        self.words, self.b = PieceEncoder(path_a), SentencePieceProcessor(model_file=path_b)
        self.words.tokenizer.encode_special_tokens = True
        byte = {_BYTE_LETTERS.get(b, chr(b)): b for b in range(256)}
        entries = {number: entry for entry, number in self.words.tokenizer.get_vocab(with_added_tokens=True).items()}
        pieces = [self.b.id_to_piece(k) for k in range(self.b.get_piece_size())]
        self.bytes_a = [bytes(map(byte.__getitem__, entries[k])) if all(c in byte for c in entries.get(k, "")) and k in entries else b"" for k in range(max(entries) + 1)]
        # without a normalizer and with an entry for every byte, a byte-level vocabulary gives back what it was given
        self.exact = self.words.tokenizer.normalizer is None and {bytes([b]) for b in range(256)} <= set(self.bytes_a)
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(k) else p.replace("▁", " ").encode() for k, p in enumerate(pieces)]
        self.length_a, self.length_b = (np.array([len(t) for t in known]) for known in (self.bytes_a, self.bytes_b))
        # an id is written with what follows it: a comma, or the end of its side of the group
        self.written = [f"{k}{mark}" for known, end in ((self.bytes_a, "|"), (self.bytes_b, ";")) for k in range(len(known)) for mark in (",", end)]

    def _ids_a(self, text: str) -> bytes:
        """Ids of space+text, from those of its words where they are certain, as little-endian unsigned 32-bit bytes."""
        pieces = self.words._pieces(text)
        if pieces is None:
            return self.words._ids(" " + text)
        pieces[0] = " " + pieces[0]
        if len(self.words.known) >= KEPT_PIECES // 2:
            self.words.known.old = {}
            self.words.known = type(self.words.known)(self.words._learn, self.words.known)
        return b"".join(map(self.words.known.__getitem__, pieces))

    def encode(self, texts: list[str | None]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Ids of A and of B of every text; none where the bytes differ."""
        ids_a = [np.frombuffer(self._ids_a(t), "<u4") if t else _NONE for t in texts]
        ids_b = [np.array(x, np.uint32) for x in self.b.encode([t or "" for t in texts], num_threads=1)]
        for k, text in enumerate(texts):
            want = (" " + text).encode() if text else b""
            # the sum of lengths tells most that differ; A's bytes are the text's unless an entry is no byte string
            same = len(want) == self.length_a[ids_a[k]].sum() == self.length_b[ids_b[k]].sum() and b"".join(map(self.bytes_b.__getitem__, ids_b[k].tolist())) == want
            if not want or not same or not self.exact and b"".join(map(self.bytes_a.__getitem__, ids_a[k].tolist())) != want:
                ids_a[k] = ids_b[k] = _NONE
        return ids_a, ids_b

    def align(self, texts: list[str | None]) -> tuple[list[np.ndarray], list[str], list[np.ndarray], list[np.ndarray]]:
        """For every text: (its numbers of tokens of A, of B, of groups, of links), its groups as text, its distinct
        linked pairs, and the links of each."""
        ids_a, ids_b = self.encode(texts)
        n_a, n_b = (np.array([len(x) for x in ids], np.int64) for ids in (ids_a, ids_b))
        a, b = (np.concatenate([_NONE, *ids]).astype(np.int64) for ids in (ids_a, ids_b))
        # texts follow one another in either tokenization, so all texts are aligned at once
        ends_a, ends_b = np.cumsum(self.length_a[a]), np.cumsum(self.length_b[b])
        group_a, group_b = overlap_groups(ends_a, ends_b)
        last_a, last_b = (np.r_[g[1:] != g[:-1], True][: len(g)] for g in (group_a, group_b))
        texts_of = np.repeat(np.arange(len(texts)), n_a)[last_a]
        n_groups = np.bincount(texts_of, minlength=len(texts))
        # links of a component: its members that end together
        together = ends_a[last_a] == ends_b[last_b]
        pair, place = np.unique(a[last_a][together] << 32 | b[last_b][together], return_inverse=True)
        key, links = np.unique(texts_of[together] * max(1, len(pair)) + place, return_counts=True)
        cut = np.searchsorted(key, np.arange(1, len(texts)) * max(1, len(pair)))
        pairs, links = np.split(pair[key % max(1, len(pair))], cut), np.split(links.astype(np.int64), cut)
        # ids of A and B in written order: a group's B ids after its A ids
        order = np.empty(len(a) + len(b), np.int64)
        order[np.arange(len(a)) + np.searchsorted(group_b, group_a)] = 2 * a + last_a
        order[np.arange(len(b)) + np.searchsorted(group_a, group_b, "right")] = 2 * len(self.bytes_a) + 2 * b + last_b
        words = [self.written[k] for k in order.tolist()]
        stops = np.cumsum(n_a + n_b).tolist()
        groups = ["".join(words[i:j])[:-1] for i, j in zip([0, *stops], stops)]
        numbers = np.stack([n_a, n_b, n_groups, np.array([n.sum() for n in links], np.int64)], 1)
        return list(numbers), groups, pairs, links


_ALIGNERS: dict[tuple[str, str], Aligner] = {}


def aligner(path_a: str, path_b: str) -> Aligner:
    """The worker's aligner for two vocabularies; loaded once per Python worker."""
    if (path_a, path_b) not in _ALIGNERS:
        _ALIGNERS[path_a, path_b] = Aligner(path_a, path_b)
    return _ALIGNERS[path_a, path_b]


def align_documents(docs: DataFrame, path_a: str, path_b: str, keep_groups: bool = False, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Rows (doc_id, n_a, n_b, n_groups, n_links, groups_sha256, [groups,] pairs): the alignment of every document.
    ``pairs`` holds each linked pair (A's id times 2**32 plus B's) once, with its number of links."""

    def batch(ids: list, texts: list[str | None]) -> pa.RecordBatch:
        numbers, groups, pairs, links = aligner(path_a, path_b).align(texts)
        columns = {"doc_id": pa.array(ids, pa.int64())}
        columns |= {name: pa.array(values, pa.int64()) for name, values in zip(("n_a", "n_b", "n_groups", "n_links"), np.stack(numbers, 1))}
        columns["groups_sha256"] = pa.array([hashlib.sha256(g.encode()).hexdigest() if g else "" for g in groups], pa.string())
        if keep_groups:
            columns["groups"] = pa.array(groups, pa.string())
        linked = pa.StructArray.from_arrays([pa.array(np.concatenate(pairs)), pa.array(np.concatenate(links))], ["pair", "n"])
        columns["pairs"] = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, pairs)]), pa.int32()), linked)
        return pa.RecordBatch.from_pydict(columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, texts, size = [], [], 0
        for given in batches:
            for doc_id, text in zip(given.column(0), given.column(1)):
                ids.append(doc_id.as_py())
                texts.append(text.as_py())
                size += len(texts[-1] or "")
                if size >= CHARACTERS_AT_ONCE:
                    yield batch(ids, texts)
                    ids, texts, size = [], [], 0
        if ids:
            yield batch(ids, texts)
        release_memory()

    schema = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, " + "groups string, " * keep_groups + "pairs array<struct<pair:long,n:long>>"
    return bound_batches(docs).select(F.col(id_column).cast("bigint").alias("__id"), F.col(text_column).alias("__text")).mapInArrow(run, schema)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """Rows (pair, a_id, b_id, links, best): every linked id pair of the corpus with its number of links, and whether
    no pair of its B id has more (ties included)."""
    counts = aligned.select(F.explode("pairs").alias("p")).groupBy("p.pair").agg(F.sum("p.n").alias("links"))
    split = counts.select("pair", F.shiftright("pair", 32).alias("a_id"), F.col("pair").bitwiseAND(F.lit((1 << 32) - 1)).alias("b_id"), "links")
    # a B id has at most as many pairs as A has ids
    return split.withColumn("best", F.col("links") == F.max("links").over(Window.partitionBy("b_id")))


def score_documents(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Rows (doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256): a row per document."""
    aligned = align_documents(docs, path_a, path_b).withColumn("row", F.monotonically_increasing_id())
    aligned = materialize(aligned, "alignment")
    counts = materialize(pair_counts(aligned).select("pair", "links", "best"), "alignment-counts")
    links = aligned.select("row", F.explode("pairs").alias("p")).select("row", "p.pair", "p.n")
    weighed = hot_join(links, counts, "pair", BROADCAST_PAIRS)
    sums = weighed.groupBy("row").agg(F.sum(F.when(F.col("best"), F.col("n")).otherwise(0)).alias("n_best"), F.sum(F.col("n") * F.col("links")).alias("count_sum"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    return aligned.drop("pairs").join(sums, "row", "left").select("doc_id", "n_a", "n_b", "n_groups", "n_links", zero("n_best"), zero("count_sum"), "groups_sha256")
