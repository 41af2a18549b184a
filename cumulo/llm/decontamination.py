"""Benchmark decontamination by SimHash windows, in DataFrame operations only.

Texts are lower-cased and cut into words of letters and digits; a shingle is ``SHINGLE`` words (all
words of a shorter item). An item of m shingles is compared with the windows of m shingles of a
document, that is, windows as long as the item (the whole document, if that is shorter). Their
similarity is the weighted Jaccard index of the two bags of shingles; ``SIMILARITY`` or more is a leak.

Which windows are fingerprinted: moving the start of a window to its first shingle that any item holds,
or to the document's last window, loses no shared shingle; and two bags that similar share at least
s (m + m') / (1 + s) shingles, s being the threshold. So a window starts so and holds at least so many
shingles of the benchmark, of whatever items: no other can qualify for any item of that size.

Every such window and every item gets a 64-bit SimHash of its shingles. The bit counts of windows are
differences of running sums over the document: several counters share a long, and window edges are
rows between the shingles, so all windows of a text, of all sizes, come from one ordered pass. A
multi-index finds the items for a window: of ``BLOCKS`` blocks of a fingerprint, at least one differs in
RADIUS // BLOCKS bits or fewer if the whole differs in ``RADIUS`` or fewer, so each item is posted under
every block value that near to its own. Pairs that meet are checked for the radius, and verified by the
exact similarity. ``RADIUS`` is wide, since bags that share 80 % differ in about 9 of 64 bits.

Equal texts are one text until the end. Defined cases: null or empty text, and items without a word ->
no match; equal items -> a match each; ties -> the first of the best windows; rows that repeat an id ->
one match with the best similarity; null doc_id -> matched under null; very long texts -> windows are
verified in stretches of ``STRETCH`` starts; empty tables -> no rows; extra columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, small_side

SHINGLE, SIMILARITY, RADIUS, BLOCKS = 5, 0.8, 19, 5
#: Rows up to which a side of a join is broadcast, after counting them: the shingles, and the index.
BROADCAST_ROWS, INDEX_ROWS = 200_000, 600_000
#: Starts of one text whose windows are verified as one row.
STRETCH = 1_000
#: Bits of a counter that shares a long with others, and the largest item it can count.
LANE = 16
LANE_MOST = (1 << LANE) - 1


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), "")


def shingles(tokens: Column, k: int) -> Column:
    """Hashes of the runs of k words; null if there are fewer words."""
    return F.when(F.size(tokens) >= k, F.transform(F.sequence(F.lit(0), F.size(tokens) - k), lambda i: F.xxhash64(*[F.get(tokens, i + j) for j in range(k)])))


def _shingles_of(tokens: Column, k: Column) -> Column:
    return reduce(lambda found, n: found.when(k == n, shingles(tokens, n)), range(1, SHINGLE), F.when(k == SHINGLE, shingles(tokens, SHINGLE)))


# --- bit counts, several counters to a long -------------------------------------------------


class Counters:
    """The 64 bit counts of a bag of hashes, in longs of ``lanes`` counters of ``width`` bits each."""

    def __init__(self, largest: int):
        self.lanes, self.width = (3, LANE) if largest <= LANE_MOST else (1, 62)
        self.longs = -(-64 // self.lanes)
        self.names = [f"__n{i}" for i in range(self.longs)]
        self.ones = sum(1 << (self.width * lane) for lane in range(self.lanes))

    def of(self, h: Column) -> list[Column]:
        """What a hash adds: long i counts the bits i, i + longs, i + 2 longs."""
        out = []
        for i in range(self.longs):
            parts = []
            for lane in range(self.lanes):
                bit, place = i + lane * self.longs, lane * self.width
                if bit < 64:
                    moved = F.shiftrightunsigned(h, bit - place) if bit >= place else F.shiftleft(h, place - bit)
                    parts.append(moved.bitwiseAND(F.lit(1 << place).cast("long")))
            out.append(reduce(Column.bitwiseOR, parts))
        return out

    def fingerprint(self, size: Column) -> Column:
        """The bits set in over half of ``size`` hashes, from the counts."""
        top = self.width - 1
        bias = ((F.lit((1 << top) - 1) - F.floor(size / 2)).cast("long") * F.lit(self.ones).cast("long")).cast("long")
        bits = []
        for i, name in enumerate(self.names):
            over = F.shiftrightunsigned(F.col(name) + bias, top)
            for lane in range(self.lanes):
                bit = i + lane * self.longs
                if bit < 64:
                    bits.append(F.shiftleft(F.shiftrightunsigned(over, lane * self.width).bitwiseAND(F.lit(1).cast("long")), bit))
        while len(bits) > 1:  # a balanced tree of ors
            bits = [reduce(Column.bitwiseOR, bits[i : i + 2]) for i in range(0, len(bits), 2)]
        return bits[0]


# --- the multi-index ------------------------------------------------------------------------


def _bounds(blocks: int) -> list[int]:
    return [64 * k // blocks for k in range(blocks + 1)]


def index_blocks(fingerprint: Column, blocks: int = BLOCKS) -> Column:
    """The (block, bits) pairs of a fingerprint."""
    at = _bounds(blocks)
    one = lambda k: F.struct(F.lit(k).alias("block"), F.shiftrightunsigned(fingerprint, at[k]).bitwiseAND(F.lit((1 << (at[k + 1] - at[k])) - 1).cast("long")).alias("bits"))
    return F.array(*[one(k) for k in range(blocks)])


def index_postings(fingerprint: Column, radius: int, blocks: int = BLOCKS) -> Column:
    """The (block, bits) pairs under which an item is posted: every fingerprint within the radius has one."""
    at = _bounds(blocks)
    near = lambda k: F.filter(F.sequence(F.lit(0), F.lit((1 << (at[k + 1] - at[k])) - 1)), lambda x: F.bit_count(x) <= radius // blocks)
    own = index_blocks(fingerprint, blocks)
    return F.concat(*[F.transform(near(k), lambda x: F.struct(F.lit(k).alias("block"), own[k]["bits"].bitwiseXOR(x.cast("long")).alias("bits"))) for k in range(blocks)])  # noqa: B023


# --- the stages -----------------------------------------------------------------------------


def _items(benchmark: DataFrame) -> DataFrame:
    """item, k (words of a shingle), m (shingles), sh (their hashes); items without words go."""
    rows = benchmark.select(F.col("item_id").cast("bigint").alias("item"), words(F.col("text")).alias("w")).where(F.size("w") > 0)
    rows = rows.withColumn("k", F.least(F.size("w"), F.lit(SHINGLE)))
    return rows.select("item", "k", _shingles_of(F.col("w"), F.col("k")).alias("sh")).withColumn("m", F.size("sh"))


def _need(m, total, similarity: float) -> Column:
    """Shingles that a window must share with an item of m."""
    return F.ceil((m + F.least(m, total)) * F.lit(similarity / (1 + similarity)) - F.lit(1e-9)).cast("int")


def _hits(docs: DataFrame, known: DataFrame, least: dict[int, int], similarity: float) -> DataFrame:
    """doc, body, k, total, hits (pos, h): the benchmark's shingles in every document that has enough of them."""
    tokens = docs.where(F.col("text").isNotNull()).select(F.col("doc_id").cast("bigint").alias("doc"), body_of(F.col("text")).alias("body"), words(F.col("text")).alias("w"))
    known = small_side(known, BROADCAST_ROWS)
    found = []
    for k, m in least.items():  # one pass, but for items of fewer words than a shingle
        # only places are generated, beside the words: shingles are hashed in generated code, not in a function of arrays
        places = F.when(F.size("w") >= k, F.sequence(F.lit(0), F.size("w") - k))
        rows = tokens.select("doc", "body", "w", (F.size("w") - k + 1).alias("total"), F.explode(places).alias("pos"))
        rows = rows.select("doc", "body", "total", "pos", F.xxhash64(*[F.get("w", F.col("pos") + j) for j in range(k)]).alias("h"))
        rows = rows.join(known.where(F.col("k") == k).drop("k"), "h").groupBy("doc", "body", "total").agg(F.array_sort(F.collect_set(F.struct("pos", "h"))).alias("hits"))
        found.append(rows.where(F.size("hits") >= _need(F.lit(m), F.col("total"), similarity)).select("doc", "body", F.lit(k).alias("k"), "total", "hits"))
    return reduce(DataFrame.unionByName, found)


def body_of(text: Column) -> Column:
    """What tells texts apart."""
    return F.struct(F.xxhash64(text).alias("hash"), F.length(text).alias("length"))


def _windows(texts: DataFrame, sizes: DataFrame, similarity: float) -> DataFrame:
    """body, k, m, size, start, at: windows with enough hits; ``at`` is the (one-based) place of their first hit."""
    rows = texts.join(small_side(sizes, BROADCAST_ROWS), "k").withColumn("need", _need(F.col("m"), F.col("total"), similarity)).where(F.size("hits") >= F.col("need"))
    rows = rows.withColumn("size", F.least("m", "total")).withColumn("p", F.col("hits.pos"))
    rows = rows.withColumn("last", F.col("total") - F.col("size"))
    place = lambda i: F.get("p", i)
    enough = lambda x, i: (x <= F.col("last")) & F.coalesce(place(i + F.col("need") - 1) < x + F.col("size"), F.lit(False))
    moving = F.filter(F.transform("p", lambda x, i: F.when(enough(x, i), F.struct(x.alias("start"), (i + 1).alias("at")))), lambda x: x.isNotNull())
    # the last window of the document, for hits beyond the last start
    tail = F.struct(F.col("last").alias("start"), F.greatest(F.size("p") - F.col("size") + 1, F.lit(1)).alias("at"))
    at_end = F.when((place(F.size("p") - F.col("need")) >= F.col("last")) & ~F.array_contains("p", F.col("last")), F.array(tail)).otherwise(F.array().cast("array<struct<start:int,at:int>>"))
    return rows.select("body", "k", "m", "size", F.inline(F.concat(moving, at_end)))


def _fingerprints(bodies: DataFrame, windows: DataFrame, counters: Counters) -> DataFrame:
    """Windows with their fingerprint: bit counts are differences of running sums at the windows' edges."""
    edge = lambda sign, pos: windows.select("body", "k", pos.alias("pos"), F.lit(0).alias("kind"), F.lit(None).cast("long").alias("h"), F.lit(sign).alias("sign"), "m", "size", "start", "at")
    none = [F.lit(None).cast("int").alias(c) for c in ("sign", "m", "size", "start", "at")]
    own = windows.select("body", "k").distinct()
    rows = bodies.join(own, "body").select("body", "k", F.posexplode(_shingles_of(F.col("w"), F.col("k"))).alias("pos", "h")).select("body", "k", "pos", F.lit(1).alias("kind"), "h", *none)
    rows = rows.unionByName(edge(-1, F.col("start"))).unionByName(edge(1, F.col("start") + F.col("size")))
    # dealt and sorted while narrow; an edge comes before the shingle at its place
    rows = rows.repartition("body", "k").sortWithinPartitions("body", "k", "pos", "kind")
    running = Window.partitionBy("body", "k").orderBy("pos", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    added = rows.select("body", "k", "pos", "kind", "sign", "m", "size", "start", "at", *[F.coalesce(x, F.lit(0).cast("long")).alias(n) for n, x in zip(counters.names, counters.of(F.col("h")))])
    summed = added.select("body", "k", "kind", "sign", "m", "size", "start", "at", *[F.sum(n).over(running).alias(n) for n in counters.names]).where("kind = 0")
    counts = summed.groupBy("body", "k", "m", "size", "start", "at").agg(*[F.sum(F.col(n) * F.col("sign")).alias(n) for n in counters.names])
    return counts.select("body", "k", "m", "size", "start", "at", counters.fingerprint(F.col("size")).alias("fp"))


def _close(found: DataFrame, items: DataFrame, radius: int) -> DataFrame:
    """The pairs of a window and an item of its size within the radius, by the multi-index."""
    posted = items.select("k", "m", "item", "item_fp", F.inline(index_postings(F.col("item_fp"), radius)))
    posted = small_side(materialize(posted, "fingerprint-index"), INDEX_ROWS)
    asked = found.select("*", F.inline(index_blocks(F.col("fp"))))
    near = asked.join(posted, ["k", "m", "block", "bits"]).withColumn("distance", F.bit_count(F.col("fp").bitwiseXOR(F.col("item_fp")))).where(F.col("distance") <= radius)
    return near.select("body", "k", "m", "size", "start", "at", "item", "distance").distinct()


def _verified(close: DataFrame, texts: DataFrame, wanted: DataFrame, similarity: float) -> DataFrame:
    """body, item, similarity, start, distance of the best window, where it reaches the similarity."""
    asked = close.groupBy("body", "k", F.floor(F.col("start") / STRETCH).alias("stretch")).agg(F.collect_list(F.struct("m", "size", "start", "at", "item", "distance")).alias("asked"))
    joined = asked.join(texts.select("body", "k", "hits"), ["body", "k"])
    inside = lambda x: F.filter(F.slice("hits", x["at"], x["size"]), lambda y: (y["pos"] >= x["start"]) & (y["pos"] < x["start"] + x["size"]))["h"]
    rows = joined.select("body", "k", F.inline(F.transform("asked", lambda x: F.struct(*[x[c].alias(c) for c in ("m", "size", "start", "item", "distance")], inside(x).alias("own")))))
    rows = rows.select("body", "k", "m", "size", "start", "item", "distance", F.explode("own").alias("h")).join(small_side(wanted, BROADCAST_ROWS), ["h", "k", "item"])
    pair = ["body", "k", "m", "size", "start", "item", "distance"]
    shared = rows.groupBy(*pair, "h").agg(F.least(F.count("*"), F.first("c")).alias("n")).groupBy(*pair).agg(F.sum("n").alias("n"))
    scored = shared.select("body", "item", "start", "distance", (F.col("n") / (F.col("m") + F.col("size") - F.col("n"))).alias("similarity")).where(F.col("similarity") >= F.lit(similarity) - 1e-12)
    best = scored.groupBy("body", "item").agg(F.max(F.struct("similarity", (-F.col("start")).alias("start"), (-F.col("distance")).alias("distance"))).alias("best"))
    return best.select("body", "item", F.col("best.similarity").alias("similarity"), (-F.col("best.start")).alias("start"), (-F.col("best.distance")).alias("distance"))


def matches(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY, radius: int = RADIUS) -> DataFrame:
    """doc_id, item_id, start (first shingle of the best window), similarity, distance (bits)."""
    empty = docs.sparkSession.createDataFrame([], "doc_id long, item_id long, start int, similarity double, distance int")
    items = materialize(_items(benchmark), "benchmark-items")
    # one row for each length of a shingle (SHINGLE at most): the smallest and the largest item
    spans = {r["k"]: (r["least"], r["most"]) for r in items.groupBy("k").agg(F.min("m").alias("least"), F.max("m").alias("most")).collect()}
    if not spans:
        return empty
    counters = Counters(max(most for _, most in spans.values()))
    single = items.select("item", "k", "m", F.explode("sh").alias("h"))
    counted = single.select("item", "k", "m", *[x.alias(n) for n, x in zip(counters.names, counters.of(F.col("h")))]).groupBy("item", "k", "m").agg(*[F.sum(n).alias(n) for n in counters.names])
    prints = materialize(counted.select("item", "k", "m", counters.fingerprint(F.col("m")).alias("item_fp")), "benchmark-fingerprints")
    wanted = materialize(single.groupBy("h", "k", "item").agg(F.count("*").alias("c")), "benchmark-shingles")
    known = materialize(wanted.select("h", "k").distinct(), "benchmark-hashes")

    flagged = materialize(_hits(docs, known, {k: least for k, (least, _) in sorted(spans.items())}, similarity), "benchmark-hits")
    texts = materialize(flagged.groupBy("body", "k", "total").agg(F.min("hits").alias("hits")), "texts-with-hits")
    windows = materialize(_windows(texts, items.select("k", "m").distinct(), similarity), "item-sized-windows")
    # fingerprints need all shingles of a window: back to the few texts that have one
    own = small_side(windows.select("body").distinct(), BROADCAST_ROWS)
    bodies = docs.where(F.col("text").isNotNull()).select(body_of(F.col("text")).alias("body"), "text").join(own, "body", "left_semi").groupBy("body").agg(F.min("text").alias("text"))
    found = materialize(_fingerprints(bodies.select("body", words(F.col("text")).alias("w")), windows, counters), "window-fingerprints")
    best = _verified(materialize(_close(found, prints, radius), "windows-in-radius"), texts, wanted, similarity)
    best = materialize(best, "leaks")
    leaks = flagged.select("doc", "body").distinct().join(small_side(best, BROADCAST_ROWS), "body")
    top = leaks.groupBy("doc", "item").agg(F.max(F.struct("similarity", (-F.col("start")).alias("start"), (-F.col("distance")).alias("distance"))).alias("best"))
    return top.select(F.col("doc").alias("doc_id"), F.col("item").alias("item_id"), (-F.col("best.start")).alias("start"), F.col("best.similarity").alias("similarity"), (-F.col("best.distance")).alias("distance"))


def clean(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY, radius: int = RADIUS) -> DataFrame:
    """The documents without a leak. Of rows that repeat an id, all go if one of them leaks."""
    leaked = materialize(matches(docs, benchmark, similarity, radius).select("doc_id").distinct(), "leaked-ids")
    return docs.join(small_side(leaked, BROADCAST_ROWS), docs["doc_id"].eqNullSafe(leaked["doc_id"]), "left_anti").select(*docs.columns)
