"""Near duplicates by similarity: SimHash and min-hash position lists, verified exactly.

Two texts are near duplicates if the Jaccard index of their sets of ``SHINGLE``-word shingles is at
least ``SIMILARITY``. SimHash alone cannot find them: at that similarity fingerprints differ by 3 to 12
and more of 64 bits, and then no byte need agree. So candidates come from two inverted indexes:

* fingerprints: ``simhash_dedup`` as op7 runs it, by its fingerprints (three-word shingles), byte-position index, bit check
  and components. The texts of one of its components are a list, and a pair within ``MAX_BITS`` is worth verifying;
* the same idea over a signature whose positions agree with a probability equal to the similarity:
  ``BANDS`` x ``ROWS`` min-hashes of 16 bits. A posting key is a band of positions; texts that meet in
  a list have their equal positions tallied, and a pair that reaches ``LEAST_EQUAL`` is worth verifying.
  A pair at the threshold meets in a list with probability 1 - (1 - 0.8^5)^20 = 0.9996.

Texts with equal shingle sets and fingerprints are one node from the start. Pairs are verified on whole shingle sets, in two
passes. The first verifies a maximum spanning forest of the tallies of each list (lists longer than
``LIST_ROWS`` are dealt to parts for it), which links most of what belongs together. A tally is an estimate,
so an edge of the forest may be false and a true link may be left out. The second pass takes every pair of a
list worth verifying whose ends are still in different components: all members meet those outside the list's
largest component, in blocks, with their shingle sets, and every such pair is verified in its block (at the
first position where the two meet, so once). No pair is left out, and only links that join components leave a
block. The groups are then the components of all candidate pairs that are similar.

Defined cases: null or empty text -> an empty set, equal to other empty ones; texts of fewer words ->
one shingle; null id -> takes part as any other row, and stays only where its whole group has no id;
repeated ids -> rows are told apart by their texts: each takes part for itself, and of rows with the same
id and text one can stay; empty table -> no rows; extra columns are kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import simhash_dedup
from .common import bound_batches, grouped, hot_join, materialize, release_memory, small_side
from .graph import connected_components

SHINGLE, SIMILARITY = 5, 0.8
BANDS, ROWS = 20, 5
#: Equal positions, of BANDS * ROWS, that make a pair worth verifying; its mean at 0.8 is 80, deviation 4.
LEAST_EQUAL = 64
#: Fingerprints within so many of 64 bits are linked by ``simhash_dedup``, and make a pair worth verifying.
MAX_BITS = 2
#: Members of a list, or of a part of it, that the first pass looks at together; members of either side of a block.
LIST_ROWS, BLOCK_ROWS = 256, 256
#: Rows (of two or three numbers) up to which a side is broadcast, after counting them.
BROADCAST_ROWS = 300_000
SEED = 42

_rng = np.random.default_rng(SEED)
_A = (_rng.integers(1, 1 << 31, BANDS * ROWS, dtype=np.int64) * 2 + 1).astype(np.uint32)
_B = _rng.integers(0, 1 << 32, BANDS * ROWS, dtype=np.int64).astype(np.uint32)


def shingle_hashes(text: bytes, k: int = SHINGLE) -> np.ndarray:
    """XXH64 of every shingle, repeats included; none for a text without words."""
    import xxhash

    words = text.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    joined = b" ".join(words)
    if len(words) <= k:
        return np.array([xxhash.xxh64_intdigest(joined, SEED)], np.uint64)
    ends = list(accumulate(len(w) + 1 for w in words))
    digest = xxhash.xxh64_intdigest
    return np.array([digest(joined[s : e - 1], SEED) for s, e in zip([0, *ends], ends[k - 1 :])], np.uint64)


def _signature(distinct: np.ndarray) -> np.ndarray:
    """Min-hashes of a set, a block of shingles at a time."""
    low = (distinct ^ (distinct >> np.uint64(32))).astype(np.uint32)
    out = np.full(BANDS * ROWS, 0xFFFFFFFF, np.uint32)
    for a in range(0, len(low), 2048):
        mixed = low[a : a + 2048, None] * _A[None, :] + _B[None, :]
        mixed ^= mixed >> np.uint32(15)
        np.minimum(out, mixed.min(0), out=out)
    return out


def _read(text: bytes) -> tuple[np.ndarray, int, int]:
    """Shingle set, fingerprint and node of a text."""
    distinct, fp = np.unique(shingle_hashes(text)), simhash_dedup.fingerprint(text)
    return distinct, fp, _mix(np.array([distinct.sum(dtype=np.uint64), (distinct * (distinct | np.uint64(1))).sum(dtype=np.uint64), len(distinct), fp], np.uint64))


def node_of(text: str):
    """The node of a text, as a column."""

    @F.pandas_udf("long")
    def node(texts):
        import pandas as pd

        return pd.Series([_read((t or "").encode())[2] for t in texts], dtype="int64")

    return node(F.col(text))


def sketches(docs: DataFrame) -> DataFrame:
    """doc_id, node (of the shingle set and fp), fp (op7's), signature, bands of every row."""

    def scan(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            node, fp, signature, bands = [], [], [], []
            for text in batch.column(1).cast(pa.binary()).to_pylist():
                distinct, bits, name = _read(text or b"")
                node.append(name)
                fp.append(bits)
                sig = _signature(distinct)
                signature.append(sig.astype("<u2").tobytes())
                bands.append([_mix(b.astype(np.uint64)) for b in sig.reshape(BANDS, ROWS)])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(node, pa.int64()), pa.array(np.array(fp, "<u8").view("<i8")), pa.array(signature, pa.binary()), pa.array(bands, pa.list_(pa.int64()))], names=["doc_id", "node", "fp", "signature", "bands"])
        release_memory()

    return bound_batches(docs).select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").alias("__text")).mapInArrow(scan, "doc_id long, node long, fp long, signature binary, bands array<long>")


def _mix(values: np.ndarray) -> int:
    import xxhash

    x = xxhash.xxh64_intdigest(values.astype("<u8").tobytes(), SEED)
    return x - (1 << 64) if x >= 1 << 63 else x


def tallies(signatures: np.ndarray, prints: np.ndarray, signature: np.ndarray, fp: np.uint64) -> np.ndarray:
    """Equal positions of each text with another, -1 where the pair is not worth verifying."""
    equal = (signatures == signature).sum(1)
    return np.where((equal >= LEAST_EQUAL) | (np.bitwise_count(prints ^ fp) <= MAX_BITS), equal, -1)


def forest(signatures: np.ndarray, prints: np.ndarray) -> list[tuple[int, int]]:
    """Maximum spanning forest of the tallies, by Prim's method."""
    n = len(signatures)
    best, parent, left = np.full(n, -1), np.zeros(n, int), np.ones(n, bool)
    out, at = [], 0
    for _ in range(n):
        left[at] = False
        tally = tallies(signatures, prints, signatures[at], prints[at])
        closer = left & (tally > best)
        best[closer], parent[closer] = tally[closer], at
        if not left.any():
            break
        at = int(np.argmax(np.where(left, best, -2)))
        if best[at] >= 0:
            out.append((at, int(parent[at])))
    return out


def _dealt(rows: DataFrame, *keys: str) -> DataFrame:
    """Rows of a group one after another, in the order of their nodes."""
    return rows.repartition(*keys).sortWithinPartitions(*keys, "node")


class _Members:
    """The members of a list (or a part of one) as arrays."""

    def __init__(self, rows: pa.Table):
        self.rows = rows
        self.node = rows["node"].to_numpy()
        self.signature = np.frombuffer(b"".join(rows["signature"].to_pylist()), "<u2").reshape(len(rows), BANDS * ROWS)
        self.fp = rows["fp"].to_numpy().view(np.uint64)


def with_simhash_groups(nodes: DataFrame) -> DataFrame:
    """``nodes`` with the component that op7's links put each into, by the fingerprint that names it."""
    found = simhash_dedup.components(nodes.select(F.col("node").alias("doc_id"), "fp"), MAX_BITS)
    return nodes.join(found.select(F.col("doc_id").alias("node"), F.col("label").alias("simhash_group")), "node")


def list_members(nodes: DataFrame) -> DataFrame:
    """position, key, n, node: the nodes of each list of two and more. The last position is op7's component."""
    posted = nodes.select("node", F.posexplode(F.concat("bands", F.array("simhash_group"))).alias("position", "key"))
    lists = posted.groupBy("position", "key").agg(F.count("*").alias("n")).where("n > 1")
    lists = materialize(lists, "signature-lists")
    return materialize(posted.join(small_side(lists, BROADCAST_ROWS), ["position", "key"]).select("position", "key", "n", "node"), "list-members")


def candidates(nodes: DataFrame, members: DataFrame) -> DataFrame:
    """The pairs (u, v) of nodes that the first pass verifies, each once."""
    part = F.pmod(F.xxhash64("node", "position"), F.ceil(F.col("n") / LIST_ROWS))
    dealt = members.select("position", "key", part.alias("part"), "node").join(nodes.select("node", "signature", "fp"), "node")

    def tally(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        us, vs = [], []
        for group in grouped(rows, 3):
            m = _Members(group)
            for a, b in forest(m.signature, m.fp):
                us.append(max(m.node[a], m.node[b]))
                vs.append(min(m.node[a], m.node[b]))
            if len(us) > 50_000:
                yield pa.RecordBatch.from_arrays([pa.array(us, pa.int64()), pa.array(vs, pa.int64())], names=["u", "v"])
                us, vs = [], []
        yield pa.RecordBatch.from_arrays([pa.array(us, pa.int64()), pa.array(vs, pa.int64())], names=["u", "v"])
        release_memory()

    ordered = _dealt(dealt.select("position", "key", "part", "node", "signature", "fp"), "position", "key", "part")
    return ordered.mapInArrow(tally, "u long, v long").where("u <> v").distinct()


def shingle_sets(docs: DataFrame, nodes: DataFrame, wanted: DataFrame) -> DataFrame:
    """(node, shingles): the sorted shingle set of every node of ``wanted``, as bytes. One text of a node is read."""
    asked = materialize(wanted.select("node").distinct().join(nodes.select("node", "least"), "node"), "nodes-asked")
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").alias("t"))
    # rows without an id, or that share one, are told apart by the node of their text
    found = rows.join(small_side(asked.where("least is not null").select(F.col("least").alias("doc_id")).distinct(), BROADCAST_ROWS), "doc_id", "left_semi")
    if not asked.where("least is null").isEmpty():
        found = found.unionByName(rows.where("doc_id is null"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            read = [_read(t.as_py() or b"") for t in batch.column(0).cast(pa.binary())]
            yield pa.RecordBatch.from_arrays([pa.array([x[2] for x in read], pa.int64()), pa.array([x[0].tobytes() for x in read], pa.binary())], names=["node", "shingles"])
        release_memory()

    sets = found.select("t").mapInArrow(cut, "node long, shingles binary")
    return materialize(sets.join(small_side(asked.select("node"), BROADCAST_ROWS), "node", "left_semi").dropDuplicates(["node"]), "shingle-sets")


def verified(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The pairs (u, v) whose shingle sets reach the similarity."""
    both = pairs.join(sets.select(F.col("node").alias("u"), F.col("shingles").alias("a")), "u").join(sets.select(F.col("node").alias("v"), F.col("shingles").alias("b")), "v")

    def check(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            keep = []
            for a, b in zip(batch.column(2), batch.column(3)):
                a, b = np.frombuffer(a.as_buffer(), np.uint64), np.frombuffer(b.as_buffer(), np.uint64)
                keep.append(_similar(len(np.intersect1d(a, b, assume_unique=True)), len(a) + len(b), similarity))
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(mask), batch.column(1).filter(mask)], names=["u", "v"])
        release_memory()

    return both.select("u", "v", "a", "b").mapInArrow(check, "u long, v long")


def _similar(shared, both, similarity: float):
    """Whether sets of ``both`` elements together that share ``shared`` reach the similarity."""
    return shared >= similarity * (both - shared) - 1e-9


def open_blocks(nodes: DataFrame, members: DataFrame, labels: DataFrame) -> DataFrame:
    """The lists whose members are in several components, in blocks: position, key, part, block, node, label,
    outside (the list's largest component), row (or column), signature, fp, simhash_group.

    Of two components one is not the list's largest, so all members, in parts (the rows), meet the members
    outside the largest, in blocks (the columns): a list that is one component costs nothing.
    """
    labelled = members.join(small_side(labels.withColumnRenamed("component", "label"), BROADCAST_ROWS), "node", "left").withColumn("label", F.coalesce("label", "node"))
    sizes = labelled.groupBy("position", "key", "label").agg(F.count("*").alias("c"))
    lists = sizes.groupBy("position", "key").agg(F.max(F.struct("c", "label")).alias("top"), F.sum("c").alias("n")).where("n > top.c")
    lists = lists.select("position", "key", F.col("top.label").alias("top"), F.ceil(F.col("n") / BLOCK_ROWS).alias("parts"), F.ceil((F.col("n") - F.col("top.c")) / BLOCK_ROWS).alias("blocks"))
    lists = materialize(lists, "open-lists")
    labelled = labelled.join(small_side(lists, BROADCAST_ROWS), ["position", "key"]).withColumn("outside", F.col("label") != F.col("top"))
    all_of = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    one_of = lambda n: F.pmod(F.xxhash64("node"), F.col(n))
    kept = ["node", "label", "outside"]
    rows = labelled.select("position", "key", one_of("parts").alias("part"), all_of("blocks").alias("block"), *kept, F.lit(True).alias("row"))
    columns = labelled.where("outside").select("position", "key", all_of("parts").alias("part"), one_of("blocks").alias("block"), *kept, F.lit(False).alias("row"))
    return rows.unionByName(columns).join(nodes.select("node", "signature", "fp", "simhash_group"), "node").select("position", "key", "part", "block", *kept, "row", "signature", "fp", "simhash_group")


def _block(group: pa.Table) -> tuple[_Members, _Members, np.ndarray]:
    """Rows, columns, and which of their pairs are to be verified in this block."""
    position = group["position"][0].as_py()
    row = group["row"].to_numpy(zero_copy_only=False).astype(bool)
    down, across = _Members(group.filter(pa.array(row))), _Members(group.filter(pa.array(~row)))
    label, outside, group_of = (down.rows[c].to_numpy(zero_copy_only=False) for c in ("label", "outside", "simhash_group"))
    other_group = across.rows["simhash_group"].to_numpy()
    asked = np.zeros((len(row[row]), len(row[~row])), bool)
    for j, other in enumerate(across.rows["label"].to_pylist()):
        worth = (tallies(down.signature, down.fp, across.signature[j], across.fp[j]) >= 0) & (label != other)
        # two members outside the largest component meet in either order
        worth &= ~(outside.astype(bool) & (down.node >= across.node[j]))
        at = np.flatnonzero(worth)
        if len(at):
            asked[at, j] = _first_meeting(down.signature[at], group_of[at], across.signature[j], other_group[j]) == position
    return down, across, asked


def _first_meeting(signatures: np.ndarray, groups: np.ndarray, signature: np.ndarray, group: int) -> np.ndarray:
    """The first position at which each text meets another one: a band, or op7's component."""
    bands = (signatures == signature).reshape(-1, BANDS, ROWS).all(2)
    return np.concatenate([bands, (groups == group)[:, None]], 1).argmax(1)


def nodes_to_verify(blocks: DataFrame) -> DataFrame:
    """position, key, part, block, node, row: who takes part in a pair to be verified."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in grouped(batches, 4):
            down, across, asked = _block(group)
            for side, used in ((down, asked.any(1)), (across, asked.any(0))):
                if used.any():
                    rows = side.rows.filter(pa.array(used)).select(["position", "key", "part", "block", "node", "row"])
                    yield rows.combine_chunks().to_batches()[0]
        release_memory()

    return _dealt(blocks, "position", "key", "part", "block").mapInArrow(scan, "position int, key long, part long, block long, node long, row boolean")


def verified_blocks(blocks: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Links (u, v) that join all components whose members are similar, from every pair of each block."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in grouped(batches, 4):
            down, across, asked = _block(group)
            us, vs, root = [], [], {}

            def find(x):
                while x in root:  # noqa: B023
                    x = root[x]  # noqa: B023
                return x

            labels = down.rows["label"].to_pylist(), across.rows["label"].to_pylist()
            for i, j in _similar_pairs(down, across, asked, similarity):
                a, b = find(labels[0][i]), find(labels[1][j])
                if a != b:
                    root[max(a, b)] = min(a, b)
                    us.append(down.node[i])
                    vs.append(across.node[j])
            yield pa.RecordBatch.from_arrays([pa.array(us, pa.int64()), pa.array(vs, pa.int64())], names=["u", "v"])
        release_memory()

    return _dealt(blocks.join(sets, "node").select("position", "key", "part", "block", *[c for c in blocks.columns if c not in ("position", "key", "part", "block")], "shingles"), "position", "key", "part", "block").mapInArrow(check, "u long, v long")


def _similar_pairs(down: _Members, across: _Members, asked: np.ndarray, similarity: float) -> Iterator[tuple[int, int]]:
    """The asked pairs (row, column) that reach the similarity: a row's shingles are marked, and the marks that
    each column's shingles find are added up."""
    rows = [np.frombuffer(x.as_buffer(), np.uint64) for x in down.rows["shingles"].combine_chunks()]
    columns = [np.frombuffer(x.as_buffer(), np.uint64) for x in across.rows["shingles"].combine_chunks()]
    filled = np.array([j for j, x in enumerate(columns) if len(x)], int)
    if not len(filled):
        return  # a text without words is like no other node
    known, place = np.unique(np.concatenate([columns[j] for j in filled]), return_inverse=True)
    size = np.array([len(columns[j]) for j in filled])
    starts = np.cumsum(size) - size
    for i in np.flatnonzero(asked.any(1)):
        at = np.searchsorted(known, rows[i])
        at = at[known[np.minimum(at, len(known) - 1)] == rows[i]]
        mark = np.zeros(len(known), np.uint8)
        mark[at] = 1
        shared = np.add.reduceat(mark[place], starts, dtype=np.int64)
        for j in filled[_similar(shared, len(rows[i]) + size, similarity) & asked[i, filled]]:
            yield int(i), int(j)


def similar_components(docs: DataFrame, nodes: DataFrame, similarity: float) -> DataFrame:
    """(node, component) of the nodes that have a similar one."""
    members = list_members(nodes)
    pairs = materialize(candidates(nodes, members), "candidate-pairs")
    sets = shingle_sets(docs, nodes, pairs.select(F.explode(F.array("u", "v")).alias("node")))
    labels = materialize(connected_components(verified(pairs, sets, similarity)), "verified-components")
    blocks = materialize(open_blocks(nodes, members, labels), "open-blocks")
    asked = materialize(nodes_to_verify(blocks), "nodes-to-verify")
    if asked.isEmpty():
        return labels
    # members that had no partner in their part of a long list have no set yet
    new = asked.select("node").distinct().join(sets.select("node"), "node", "left_anti")
    if not new.isEmpty():
        sets = sets.unionByName(shingle_sets(docs, nodes, new))
    same = ["position", "key", "part", "block", "node", "row"]
    links = verified_blocks(blocks.join(asked, same, "left_semi"), sets, similarity)
    stars = labels.where("node <> component").select(F.col("node").alias("u"), F.col("component").alias("v"))
    return materialize(connected_components(stars.unionByName(links)), "components")


def groups(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """(doc_id, node, label, group_id): group_id is the smallest doc_id of the group, null if it has none."""
    rows = materialize(sketches(docs), "sketches")
    nodes = materialize(rows.groupBy("node").agg(F.min("doc_id").alias("least"), F.count("*").alias("copies"), F.min("fp").alias("fp"), F.min("signature").alias("signature"), F.min("bands").alias("bands")), "texts")
    nodes = materialize(with_simhash_groups(nodes), "nodes")
    labels = similar_components(docs, nodes, similarity)
    linked = nodes.select("node", "least").join(small_side(labels, BROADCAST_ROWS), "node").select("node", "least", F.col("component").alias("label"))
    linked = materialize(linked, "linked-nodes")
    names = linked.groupBy("label").agg(F.min("least").alias("group_id"))
    copies = nodes.where("copies > 1").join(small_side(linked.select("node"), BROADCAST_ROWS), "node", "left_anti")
    resolved = hot_join(linked.select("node", "label"), materialize(names, "group-names"), "label", BROADCAST_ROWS).select("node", "label", "group_id")
    resolved = materialize(resolved.unionByName(copies.select("node", F.col("node").alias("label"), F.col("least").alias("group_id"))), "text-groups")
    # a row whose text has neither copies nor links is its own group
    found = hot_join(rows.select("doc_id", "node"), resolved.withColumn("__named", F.lit(True)), "node", BROADCAST_ROWS, "left")
    return found.select("doc_id", "node", F.coalesce("label", "node").alias("label"), F.when(F.col("__named"), F.col("group_id")).otherwise(F.col("doc_id")).alias("group_id"))


def keep_one(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """One document of each group: the row with the smallest doc_id, of such rows that with the smallest node."""
    found = groups(docs, similarity)
    # the ids that go are fewer than those that stay, and so is the side that is moved or broadcast
    heads = F.col("doc_id") == F.col("group_id")
    each = found.where("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("n"), F.sum(heads.cast("int")).alias("stay"))
    each = materialize(each, "rows-kept")
    other = each.where("n > 1 or stay = 0").select("doc_id")
    out = docs.where("doc_id is not null").join(small_side(other, BROADCAST_ROWS), "doc_id", "left_anti").select(*docs.columns)
    again = each.where("n > 1 and stay > 0").select("doc_id")
    if not again.isEmpty():
        kept = found.join(again, "doc_id", "left_semi").where(heads).groupBy(F.col("doc_id").alias("__id"), "label").agg(F.min("node").alias("__node"))
        repeated = docs.join(again, "doc_id", "left_semi").withColumn("__id", F.col("doc_id").cast("bigint")).withColumn("__node", node_of("text"))
        out = out.unionByName(repeated.join(kept, ["__id", "__node"], "left_semi").dropDuplicates(["__id", "__node"]).select(*docs.columns))
    nameless = docs.where("doc_id is null")
    if not nameless.isEmpty():
        out = out.unionByName(_nameless(nameless, found))
    return out


def _nameless(rows: DataFrame, found: DataFrame) -> DataFrame:
    """Rows without an id, one for each group that has no id at all."""
    labels = found.where("group_id is null").select(F.col("node").alias("__node"), F.col("label").alias("__label")).distinct()
    return rows.withColumn("__node", node_of("text")).join(labels, "__node").dropDuplicates(["__label"]).select(*rows.columns)
