"""Main text of web pages: page structure, and a suffix array over each host's token streams.

A page is parsed into blocks. What lies in menus, headers, footers, sidebars, notices, adverts, forms,
scripts, styles or comments is set aside: by element, by role, or by a class or id that names such a part
(``share-box``, not ``share-price``). If the page marks its article (article, main, or their roles), the
rest of that element is the main text, and nothing of it is dropped, however often it repeats elsewhere: an
article may be syndicated.

The host's suffix array decides what structure leaves open: all text of pages that mark no article, and,
inside an article, elements whose class or id holds such a word beside others (``share-price``). The token
streams of a host's pages, but for protected article text, are concatenated, and substrings of at least
``RUN`` tokens that occur on distinct pages are boilerplate: open text that they cover is removed, and
unique runs are kept. Blocks that keep a token stay with it.

The array is sorted by prefix doubling to the depth of RUN tokens, at which neighbours in it either agree in
so many or not; a repeated run is a rank that occurs on two pages. A host's pages are dealt to blocks of
about ``BLOCK_PAGES`` or ``BLOCK_CHARS``, and each block has its own array, whose ranks, as hashes of their RUN tokens, are merged by two
aggregates, so a run on a third of all pages, or a host with a third of them, is no single task.

Pages whose streams are equal count as one page, so a mirrored page does not erase itself. Nor do two near
copies: runs that just two pages share are kept where they cover ``COPY`` or more of a page's open text.

Defined cases: null or empty html -> empty text; malformed or cut off html -> what was read so far;
null url -> host ''; repeated rows -> one result each; very long or deeply nested html -> parsed in linear
time; empty table -> no rows; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bound_batches, grouped, materialize, small_side

#: Least length in tokens of a repeated run; pages of a host, and their characters, whose suffixes are sorted
#: together, about.
RUN, BLOCK_PAGES, BLOCK_CHARS = 8, 500, 2_000_000
#: Share of a page's open text that marks it as a copy of one other page.
COPY = 0.8
#: Rows up to which a side of a join is broadcast, after counting them.
BROADCAST_ROWS = 200_000
#: Tags that fail to end, quotes considered, before quotes are no longer considered.
BROKEN_TAGS = 64

# Names of HTML elements and words of class, id and role values.
RAW = {"script", "style", "noscript", "template", "textarea", "title", "iframe", "svg", "canvas", "object", "select"}
NOISE = {"nav", "header", "footer", "aside", "form", "menu", "dialog", "button", "head"}
NOISE_WORDS = {
    "ad", "ads", "adv", "advert", "adverts", "advertisement", "advertising", "banner", "breadcrumb", "breadcrumbs", "comment", "comments", "consent", "cookie", "cookies", "disqus", "footer", "gdpr", "header",
    "masthead", "menu", "modal", "nav", "navbar", "navigation", "newsletter", "notice", "pagination", "popup", "promo", "promotion", "related", "share", "sharing", "sidebar", "social", "sponsor", "sponsored",
    "subscribe", "subscription", "toolbar", "widget",
}
# words that say where or what such a part is, not what it is about
PART_WORDS = {
    "area", "articles", "bar", "block", "body", "bottom", "box", "btn", "button", "buttons", "col", "column", "container", "content", "desktop", "entry", "form", "global", "icon", "icons", "inner", "item", "items", "left",
    "link", "links", "list", "main", "message", "mobile", "outer", "overlay", "page", "panel", "post", "posts", "primary", "reader", "right", "row", "secondary", "section", "signup", "site", "slot", "stories", "thread",
    "top", "unit", "user", "wrap", "wrapper",
}
NOISE_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "menu", "menubar", "dialog", "alert", "alertdialog", "toolbar"}
BLOCKS = {
    "address", "article", "aside", "blockquote", "body", "caption", "dd", "details", "dialog", "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6",
    "head", "header", "hr", "html", "li", "main", "menu", "nav", "ol", "p", "pre", "section", "summary", "table", "tbody", "tfoot", "thead", "tr", "ul",
}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
SPACED = {"br", "td", "th", "option"}
LISTS = {"ul", "ol", "menu"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<[!?][^>]*>", re.S)
_PLAIN_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>|<[!?][^>]*>", re.S)
_CUT_OFF = re.compile(r"<[!/?a-zA-Z][^<>]*\Z")
_ATTRIBUTE = re.compile(r"([^\s=\"'/]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))|([^\s=\"'/]+)")
_RAW_END = {name: re.compile(rf"</{name}\b[^>]*>?", re.I) for name in RAW}
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")
_INTERESTING = re.compile(r"class|id\s*=|role|hidden|style|itemprop", re.I)


def _attributes(text: str) -> dict[str, str]:
    return {(a or e).lower(): b or c or d for a, b, c, d, e in _ATTRIBUTE.findall(text)}


def _named(names: str) -> str:
    """'noise' if one of the classes or ids names such a part, 'open' if one only holds such a word."""
    found = ""
    for name in names.split():
        parts = [w.lower() for w in _WORDS.findall(name)]
        if any(w in NOISE_WORDS for w in parts):
            if all(w in NOISE_WORDS or w in PART_WORDS or w.isdigit() for w in parts):
                return "noise"
            found = "open"
    return found


def _kind(name: str, text: str) -> str:
    """'noise', 'main', 'open' or '' for a start tag."""
    if name in NOISE:
        return "noise"
    main, other = name in ("article", "main"), ""
    if text and _INTERESTING.search(text):
        a = _attributes(text)
        role = a.get("role", "").lower()
        style = a.get("style", "").lower().replace(" ", "")
        if "hidden" in a or a.get("aria-hidden", "").lower() == "true" or "display:none" in style or role in NOISE_ROLES:
            return "noise"
        if role in ("article", "main") or a.get("itemprop") == "articleBody":
            main = True
        elif name not in ("html", "body"):
            other = _named(f"{a.get('class', '')} {a.get('id', '')}")
            # an article may be about what its class names; only a class that is nothing else makes it noise
    return "noise" if other == "noise" else "main" if main else other


class _Open:
    """The stack of open elements that matter, with what is known of them all."""

    def __init__(self):
        self.names: list[str] = []
        self.kinds: list[str] = []
        self.places: dict[str, list[int]] = {}  # of each name, in order
        self.lists: list[int] = []  # places of lists and their items
        self.count = {"noise": 0, "main": 0, "open": 0, "header": 0, "heading": 0}

    def _add(self, name: str, kind: str, n: int) -> None:
        if kind:
            self.count[kind] += n
        self.count["header"] += n * (name == "header" and kind == "noise")
        self.count["heading"] += n * (name in HEADINGS)

    def push(self, name: str, kind: str) -> None:
        self.places.setdefault(name, []).append(len(self.names))
        if name in LISTS or name == "li":
            self.lists.append(len(self.names))
        self.names.append(name)
        self.kinds.append(kind)
        self._add(name, kind, 1)

    def close(self, k: int) -> None:
        """Close the elements from place k on."""
        while len(self.names) > k:
            name, kind = self.names.pop(), self.kinds.pop()
            self.places[name].pop()
            self._add(name, kind, -1)
        while self.lists and self.lists[-1] >= k:
            self.lists.pop()

    def end(self, name: str) -> None:
        if places := self.places.get(name):
            self.close(places[-1])


def _tags(html: str) -> Iterator[tuple[int, int, bool, str, str]]:
    """(start, end, is an end tag, name or '', attributes) of every tag. The caller may send a place to go on from."""
    at, tag, broken, last = 0, _TAG, 0, html.rfind(">")
    while (start := html.find("<", at)) >= 0:
        found = tag.match(html, start) if start < last or html.startswith("<!--", start) else None
        if found:
            skip = yield start, found.end(), bool(found[1]), (found[2] or "").lower(), found[3] or ""
            at = skip or found.end()
            continue
        if start > last:
            if _CUT_OFF.match(html, start):  # a tag that the page's end cuts off
                yield start, len(html), False, "", ""
                return
        elif html[start + 1 : start + 2].isalpha() or html.startswith("</", start):
            broken += 1
            tag = _PLAIN_TAG if broken >= BROKEN_TAGS else _TAG
        at = start + 1


def parse(html: str) -> list[tuple[str, bool, bool, bool]]:
    """Blocks in page order: (text, inside a marked article, set aside as noise, left open by its class)."""
    out: list[tuple[str, bool, bool, bool]] = []
    open_ = _Open()
    count = open_.count
    parts: list[str] = []

    def close_block() -> None:
        if parts:
            text = " ".join("".join(parts).split())
            parts.clear()
            if text:
                # a header inside an article is not the page's: its headings are the article's own
                aside = count["noise"] > (1 if count["heading"] and count["main"] and count["noise"] == count["header"] else 0)
                out.append((text, count["main"] > 0, aside, count["open"] > 0))

    def text_between(start: int, stop: int) -> None:
        if stop > start:
            piece = html[start:stop]
            parts.append(unescape(piece) if "&" in piece else piece)

    at, tags, go_on = 0, _tags(html), None
    while True:
        try:
            start, end, closes, name, attributes = tags.send(go_on)
        except StopIteration:
            break
        go_on = None
        text_between(at, start)
        at = end
        if not name:
            continue
        if closes:
            if name in BLOCKS:
                close_block()
            open_.end(name)
            continue
        if name in RAW:
            if not attributes.endswith("/"):
                found = _RAW_END[name].search(html, at)
                at = go_on = found.end() if found else len(html)
            continue
        if name in SPACED:
            parts.append(" ")
        if name in VOID:
            if name == "hr":
                close_block()
            continue
        kind = _kind(name, attributes)
        if name in BLOCKS:
            close_block()
            if open_.names and open_.names[-1] == "p":  # a block ends an open paragraph
                open_.close(len(open_.names) - 1)
            if name == "li" and open_.lists and open_.names[open_.lists[-1]] == "li":  # and an item the item before it
                open_.close(open_.lists[-1])
        elif not kind:
            continue
        open_.push(name, kind)
    text_between(at, len(html))
    close_block()
    return out


def split_page(html: str | None) -> tuple[list[str], list[bool], list[str]]:
    """(blocks to keep, which of them are left open, blocks that serve as evidence only)."""
    blocks = parse(html or "")
    # an article set aside as a whole (a reader's comment, say) marks nothing
    marked = any(m and not aside for _, m, aside, _ in blocks)
    kept = [(t, free or not marked) for t, m, aside, free in blocks if not aside and (m or not marked)]
    return [t for t, _ in kept], [free for _, free in kept], [t for t, m, aside, _ in blocks if aside or (marked and not m)]


def _parsed(pages: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [split_page(h.as_py()) for h in batch.column(2)]
            columns = [pa.array([f[i] for f in found], t) for i, t in enumerate((pa.list_(pa.string()), pa.list_(pa.bool_()), pa.list_(pa.string())))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], names=["page_id", "url", "kept", "free", "aside"])

    rows = bound_batches(pages).select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").alias("url"), F.col("html").alias("html"))
    return rows.mapInArrow(run, "page_id long, url string, kept array<string>, free array<boolean>, aside array<string>")


def _host():
    return F.lower(F.coalesce(F.regexp_extract("url", r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1), F.lit("")))


def sorted_ranks(tokens: np.ndarray, depth: int) -> np.ndarray:
    """Ranks of all suffixes of a sequence by their first ``depth`` tokens, by prefix doubling."""
    rank, done = np.unique(tokens, return_inverse=True)[1].astype(np.int64), 1
    while done < depth:
        step = min(done, depth - done)  # the last step may overlap: it is no longer than what is known
        later = np.full(len(rank), -1, np.int64)
        later[: len(rank) - step] = rank[step:]
        rank, done = np.unique(rank * (len(rank) + 2) + later + 1, return_inverse=True)[1].astype(np.int64), done + step
    return rank


def suffix_runs(pages: list[tuple[int, list[tuple[str, bool]]]], run: int) -> list[tuple[str, int, int, int, list[tuple[int, int]]]]:
    """The runs of ``run`` tokens of some pages, from their suffix array: (the run, least page, greatest page,
    pages, the places (row, token) of open text where it starts).

    A page is (row, blocks with a mark whether they are open). Pages of equal streams are one page.
    """
    tokens, owner, place, free, names = [], [], [], [], {}
    words: dict[str, int] = {}
    for k, (_, blocks) in enumerate(pages):
        at = 0
        for text, is_free in blocks:
            cut = text.split(" ")
            tokens += [words.setdefault(w, len(words)) for w in cut]
            free += [is_free] * len(cut)
            at += len(cut)
        tokens.append(-k - 1)  # ends every page's stream, and no run crosses it
        free.append(False)
        owner += [k] * (at + 1)
        place += range(at + 1)
        names[k] = _hash(" ".join(t for t, _ in blocks))
    stream, owner, free = np.array(tokens, np.int64), np.array(owner), np.array(free)
    rank = sorted_ranks(stream, run)
    # suffixes with fewer tokens than a run before the end of their page start no run
    ends = np.flatnonzero(stream < 0)
    whole = np.flatnonzero(ends[np.searchsorted(ends, np.arange(len(stream)))] - np.arange(len(stream)) >= run)
    order = whole[np.argsort(rank[whole], kind="stable")]
    name = np.array([names[k] for k in range(len(pages))], np.int64)
    spelled, out = list(words), []
    cuts = np.flatnonzero(np.r_[True, rank[order][1:] != rank[order][:-1]]) if len(order) else []
    for group in np.split(order, cuts[1:]):
        own = np.unique(name[owner[group]])
        starts = [(pages[owner[i]][0], place[i]) for i in group[free[group]].tolist()]
        out.append((" ".join(spelled[t] for t in stream[group[0] : group[0] + run]), int(own[0]), int(own[-1]), len(own), starts))
    return out if len(order) else []


def _hash(text: str, seed: int = 0) -> int:
    import xxhash

    x = xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass"), seed)
    return x - (1 << 64) if x >= 1 << 63 else x


_RUNS = pa.schema([("host", pa.int64()), ("a", pa.int64()), ("b", pa.int64()), ("least", pa.int64()), ("most", pa.int64()), ("pages", pa.int64()), ("starts", pa.list_(pa.struct([("row", pa.int64()), ("place", pa.int32())])))])


def _runs(parsed: DataFrame, run: int) -> DataFrame:
    """Per host and block of its pages, the runs of the suffix array: host, a, b (hashes of the run), least, most,
    pages, starts. Text protected by structure is not in it."""
    open_text = F.filter(F.transform("kept", lambda t, i: F.struct(t.alias("text"), F.get("free", i).alias("free"))), lambda x: x["free"])
    evidence = F.transform("aside", lambda t: F.struct(t.alias("text"), F.lit(False).alias("free")))
    streams = parsed.select(F.xxhash64("host").alias("host"), "row", F.concat(open_text, evidence).alias("blocks")).where(F.size("blocks") > 0)
    chars = F.char_length(F.array_join("blocks.text", " ")).cast("long")
    parts = small_side(streams.groupBy("host").agg((F.floor(F.sum(chars) / BLOCK_CHARS + F.count("*") / BLOCK_PAGES) + 1).alias("parts")), BROADCAST_ROWS)
    dealt = streams.join(parts, "host").select("host", F.pmod(F.xxhash64("row"), F.col("parts")).alias("part"), "row", "blocks")
    ordered = dealt.repartition("host", "part").sortWithinPartitions("host", "part", "row")

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in grouped(batches, 2):
            host = group["host"][0].as_py()
            pages = [(row, [(b["text"], b["free"]) for b in blocks]) for row, blocks in zip(group["row"].to_pylist(), group["blocks"].to_pylist())]
            found = suffix_runs(pages, run)
            for at in range(0, len(found), 20_000):
                columns = list(zip(*((host, _hash(text, 1), _hash(text, 2), least, most, n, [{"row": r, "place": p} for r, p in starts]) for text, least, most, n, starts in found[at : at + 20_000])))
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _RUNS)], schema=_RUNS)

    return ordered.mapInArrow(sort, "host long, a long, b long, least long, most long, pages long, starts array<struct<row:long,place:int>>")


def extract(pages: DataFrame, run: int = RUN) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    parsed = materialize(_parsed(pages).withColumn("host", _host()).withColumn("row", F.monotonically_increasing_id()), "parsed-pages")
    runs = materialize(_runs(parsed, run), "suffix-runs")
    repeated = runs.groupBy("host", "a", "b").agg(F.min("least").alias("least"), F.max("most").alias("most"), F.sum("pages").alias("pages")).where("least <> most").select("host", "a", "b", "pages")
    starts = runs.where(F.size("starts") > 0).select("host", "a", "b", F.inline("starts")).join(repeated, ["host", "a", "b"])
    covered = materialize(starts.groupBy("row").agg(F.collect_set(F.struct("place", "pages")).alias("runs")), "covered-runs")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [without(kept, free, [(r["place"], r["pages"]) for r in found or []], run) for kept, free, found in zip(*(batch.column(i).to_pylist() for i in (2, 3, 4)))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], names=["page_id", "url", "text"])

    # pages that the array takes nothing from are joined by Spark alone
    joined = parsed.join(small_side(covered, BROADCAST_ROWS), "row", "left").select("page_id", "url", "kept", "free", "runs")
    whole = joined.where("runs is null").select("page_id", "url", F.array_join("kept", "\n\n").alias("text"))
    cut_down = joined.where("runs is not null").mapInArrow(cut, "page_id long, url string, text string")
    return whole.unionByName(cut_down).withColumn("n_chars", F.char_length("text").cast("long"))


def without(blocks: list[str], free: list[bool], runs: list[tuple[int, int]], run: int) -> str:
    """Blocks without the open tokens that a repeated run covers. A run is (place, pages); places count open tokens."""
    size = sum(len(b.split(" ")) for b, f in zip(blocks, free) if f)
    cover = lambda found: {k for p in found for k in range(p, p + run)}
    many, two = cover(p for p, n in runs if n > 2), cover(p for p, n in runs if n <= 2)
    drop = many if len(two | many) >= COPY * size and two - many else two | many
    kept, at = [], 0
    for block, is_free in zip(blocks, free):
        if is_free:
            words = block.split(" ")
            left = " ".join(w for k, w in enumerate(words) if at + k not in drop)
            at += len(words)
            if left:
                kept.append(left)
        else:
            kept.append(block)
    return "\n\n".join(kept)
