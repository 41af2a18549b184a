"""Each operator against a brute-force version, and on nulls, empty tables, ties, repeats, odd columns."""

import hashlib
import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from cumulo.llm import bitpack, decontamination, graph, html_extraction, language, packing, permutation_index, quality, similar_texts, simhash_dedup, tokenize, toxicity, warc
from cumulo.llm.queries import QUERIES, tokenizer_path

BYTE, WORD = "byte_bpe_50k.json", "word_bpe_49k.json"
DOCS = "doc_id long, text string, fp string, score string, node string"  # extra columns with clashing names
RNG = random.Random(5)
WORDS = ["alpha", "beta", "gamma", "delta", "café", "naïve", "don't", "x1", "the", "of"]


def prose(n, rng=RNG):
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", ".", ","]) for _ in range(n))


def docs_of(spark, texts):
    return spark.createDataFrame([(i, t, "a", "b", "c") for i, t in texts], DOCS)


def test_tokens_equal_the_library():
    from tokenizers import Tokenizer

    alphabet = [" ", "a", "'", "s", "\n", "t", "!", ".", "1", "é", "Σ", "é", "B", "\t", " "]
    alphabet += ["è", "ß", "İ", "ǆ", "ª", "字", "ا", "\u0301", "_", "$$$", "'re", "RE", "\u00ad", "½", "Ⅷ", "ﬁ", "😀", "<|", " the", " The"]
    texts = ["", None, "<|endoftext|> hi", *("".join(RNG.choices(alphabet, k=RNG.randint(1, 14))) for _ in range(6000))]
    for name in (BYTE, WORD):
        t = Tokenizer.from_file(tokenizer_path(name))
        codec = tokenize.PieceEncoder(tokenizer_path(name))
        for x in texts:
            assert codec.encode(x) == np.array(t.encode(x or "", add_special_tokens=False).ids, "<u4").tobytes(), x


@pytest.mark.parametrize("bits", [1, 3, 8, 13, 16, 17, 20])
def test_bit_packing_round_trip(bits):
    ids = np.random.default_rng(bits).integers(0, 1 << bits, 1003).astype("<u4")
    assert (bitpack.unpack(bitpack.pack(ids, bits), bits, len(ids)) == ids).all()


def test_token_files(spark, tmp_path):
    rows = [(5, prose(60_000)), (1, None), (3, ""), (2, prose(9)), (2, prose(9)), (None, "x")]
    folder = f"file://{tmp_path}/ids"
    manifest = bitpack.write(docs_of(spark, rows), folder, tokenizer_path(BYTE), 2, 50257)
    got = bitpack.read_index(spark, manifest).orderBy("start").collect()
    assert [r.doc_id for r in got] == [None, 1, 2, 2, 3, 5]
    assert [r.start for r in got] == list(np.cumsum([0, *[r.n_tokens for r in got[:-1]]]))
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokenizer_path(BYTE))
    ids = [np.array([*library.encode(t or "", add_special_tokens=False).ids, 2], "<u4").tobytes() for _, t in sorted(rows, key=lambda r: (r[0] or 0, r[1] or ""))]
    assert [(r.n_tokens, r.ids_crc32) for r in got] == [(len(x) // 4, zlib.crc32(x)) for x in ids]
    want = ids[-1]
    reader = bitpack.ShardReader(got[-1].path)
    assert reader.document(len(reader.ends) - 1).tobytes() == want
    assert bitpack.encode_and_read_back(docs_of(spark, []), tokenizer_path(BYTE), 2, 50257).count() == 0


def best_fit_decreasing(lengths, capacity=2048):
    """Bins of plain best fit, piece by piece."""
    free = []
    for n in sorted(lengths, reverse=True):
        fits = [f for f in free if f >= n]
        if fits:
            free.remove(min(fits))
            free.append(min(fits) - n)
        else:
            free.append(capacity - n)
    return len(free)


def test_packing(spark):
    from tokenizers import Tokenizer

    rng = random.Random(5)
    rows = [(i, prose(rng.randint(0, 900), rng)) for i in range(150)] + [(7, "same"), (7, "same"), (None, None), (900, prose(40_000, rng))]
    got = packing.pack_documents(docs_of(spark, rows), tokenizer_path(WORD)).toPandas()
    for _, s in got.sort_values("offset").groupby("sequence_id"):
        assert list(s.offset) == list(np.cumsum([0, *s.length[:-1]])) and s.length.sum() <= 2048
    assert got.sequence_id.nunique() <= best_fit_decreasing(got.length)
    # every piece against the library
    library, want = Tokenizer.from_file(tokenizer_path(WORD)), []
    for i, t in rows:
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 0]
        for k, at in enumerate(range(0, len(ids), 2048)):
            part = ids[at : at + 2048]
            want.append((-1 if i is None else i, k, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    columns = got.assign(doc_id=got.doc_id.fillna(-1).astype(int))[["doc_id", "piece", "start", "length", "ids_crc32"]]
    assert sorted(map(tuple, columns.values.tolist())) == sorted(want)
    assert packing.pack_documents(docs_of(spark, []), tokenizer_path(WORD)).count() == 0


def test_packing_ranks_pieces_over_many_buckets(spark, monkeypatch):
    monkeypatch.setattr(packing, "BUCKETS_PER_GROUP", 5)
    pieces = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit(0).alias("piece"), F.lit(1).alias("ids_crc32"), F.when(F.col("id") % 3 == 0, 900).otherwise(500).cast("long").alias("length"))
    got = packing.assign(pieces, packing.Limits()).toPandas()
    assert len(got) == 3000 and not got.duplicated(["sequence_id", "offset"]).any()
    for _, s in got.sort_values("offset").groupby("sequence_id"):
        assert list(s.offset) == list(np.cumsum([0, *s.length[:-1]])) and s.length.sum() <= 2048


def test_packing_keeps_every_limit():
    limits = packing.Limits(tokens=100, documents=3, attention=5000)
    histogram = {50: 7, 40: 3, 10: 20, 1: 11}
    for rule in packing.RULES:
        bins = {}
        for length, first, last, first_bin, each, _ in packing.solve(histogram, limits, rule):
            for r in range(last - first):
                bins.setdefault(first_bin + r // each, []).append(length)
        assert sorted(x for b in bins.values() for x in b) == sorted(k for k, n in histogram.items() for _ in range(n))
        assert all(sum(b) <= 100 and len(b) <= 3 and sum(x * x for x in b) <= 5000 for b in bins.values())


def components_of(ids, linked):
    label = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for a in ids:
            for b in ids:
                if linked(a, b) and label[a] != label[b]:
                    label[a] = label[b] = min(label[a], label[b])
                    changed = True
    return label


def test_simhash_links_equal_brute_force(spark):
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 63, 6, dtype=np.uint64)
    values = {int(b) ^ sum(1 << int(k) for k in rng.choice(64, rng.integers(0, 6), replace=False)) for b in base for _ in range(25)}
    values |= {int(base[0]) ^ (m << 8) for m in range(300)}  # a list longer than SMALL_LIST
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    edges = simhash_dedup.links(spark.createDataFrame([(v,) for v in signed], "fp long"))
    got = {r.node: r.component for r in graph.connected_components(edges).collect()}
    array, label = np.array(signed, np.int64), np.array(signed, np.int64)
    bits = array.view(np.uint64)
    near = np.bitwise_count(bits[:, None] ^ bits[None, :]) <= 2
    while True:
        new = np.array([label[n].min() for n in near])
        if (new == label).all():
            break
        label = new
    assert all(got.get(int(v), int(v)) == int(x) for v, x in zip(array, label))


def test_simhash_contract(spark):
    rows = [(4, "A b\tc"), (3, "a B c"), (9, None), (8, ""), (7, " \n"), (3, "a b c"), (None, "a b c")]
    got = sorted((r.doc_id or -1, r.fingerprint, r.component_id) for r in simhash_dedup.near_duplicates(docs_of(spark, rows)).collect())
    assert {x[2] for x in got if x[0] in (3, 4, -1)} == {3} and {(x[1], x[2]) for x in got if x[0] >= 7} == {("0" * 16, 7)} and len(got) == 7
    assert simhash_dedup.near_duplicates(docs_of(spark, [])).count() == 0


def test_similar_texts(spark):
    base = [" ".join(f"w{RNG.randint(0, 999)}" for _ in range(120)) for _ in range(6)]
    rows = []
    for k, t in enumerate(base):
        w = t.split()
        edit = lambda n: " ".join("edited" if i == n else x for i, x in enumerate(w))  # noqa: B023, E731
        rows += [(10 * k, t), (10 * k + 1, edit(50)), (10 * k + 2, edit(0)), (10 * k + 3, " ".join(w[:60]))]
    rows += [(100, None), (101, ""), (100, None), (None, base[0]), (None, "only here"), (None, "only here")]
    kept = sorted(r.doc_id if r.doc_id is not None else -1 for r in similar_texts.keep_one(docs_of(spark, rows)).collect())
    assert kept == sorted([-1, 100, *[10 * k for k in range(6)], *[10 * k + 3 for k in range(6)]])
    assert similar_texts.keep_one(docs_of(spark, [])).count() == 0


def test_similar_texts_tell_rows_of_one_id_apart(spark):
    rng = random.Random(8)
    text = lambda: " ".join(f"v{rng.randint(0, 9999)}" for _ in range(80))
    near = lambda t: t.rsplit(" ", 1)[0] + " changed"
    a, b, c, d, e, f = (text() for _ in range(6))
    rows = [(1, a), (1, b), (2, near(a)), (3, near(b))]  # two distinct documents share an id; each has a near copy
    rows += [(5, c), (6, d), (6, near(c)), (6, d)]  # one of the rows of 6 is a near copy of 5
    rows += [(None, near(d)), (None, e), (None, near(e)), (7, f), (7, near(f))]
    kept = sorted(((r.doc_id or -1, r.text) for r in similar_texts.keep_one(docs_of(spark, rows)).collect()), key=str)
    nameless = [t for i, t in kept if i == -1]
    assert [x for x in kept if x[0] in (1, 2, 3, 5, 6)] == sorted([(1, a), (1, b), (5, c), (6, d)], key=str)
    assert len(nameless) == 1 and nameless[0] in (e, near(e))
    assert len([i for i, _ in kept if i == 7]) == 1


def brute_groups(texts, similarity=0.8):
    """Components of the links between distinct texts: the smallest index of each."""
    sets = [{tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} for w in (t.split() for t in texts)]
    names = {s: k for k, s in enumerate({x for s in sets for x in s})}
    has = np.zeros((len(sets), len(names)), np.float32)
    for k, s in enumerate(sets):
        has[k, [names[x] for x in s]] = 1
    shared, size = has @ has.T, has.sum(1)
    linked = shared >= similarity * (size[:, None] + size[None, :] - shared) - 1e-4
    label = np.arange(len(sets))
    while True:
        new = np.where(linked, label[None, :], len(sets)).min(1)
        if (new == label).all():
            return label
        label = new


def test_similar_texts_near_the_threshold_equal_brute_force(spark):
    rng = random.Random(17)
    base = [f"w{k}" for k in range(200)]
    texts = []
    for k in range(1100):
        w = list(base)
        # two edits each: 0.815; two and three: 0.773 unless close; six stand alone
        for at in rng.sample(range(5, 195), 6 if k % 40 == 39 else 2 if k % 3 else 3):
            w[at] = f"e{k}x{at}"
        texts.append(" ".join(w))
    got = {r.doc_id: r.group_id for r in similar_texts.groups(docs_of(spark, [*enumerate(texts)])).select("doc_id", "group_id").collect()}
    want = brute_groups(texts)
    assert [got[k] for k in range(len(texts))] == want.tolist() and 1 < len(set(want)) < len(texts)


def test_similar_texts_pairs_across_the_parts_of_a_list(spark, monkeypatch):
    monkeypatch.setattr(similar_texts, "LIST_ROWS", 7)
    monkeypatch.setattr(similar_texts, "BLOCK_ROWS", 9)
    monkeypatch.setattr(similar_texts, "BROADCAST_ROWS", 20)  # and by the joins of larger tables
    rng = random.Random(3)
    texts = []
    for k in range(150):
        w = [f"w{i}" for i in range(200)]
        for at in rng.sample(range(5, 195), 3):
            w[at] = f"e{k}x{at}"
        texts.append(" ".join(w))
    got = {r.doc_id: r.group_id for r in similar_texts.groups(docs_of(spark, [*enumerate(texts)])).select("doc_id", "group_id").collect()}
    assert [got[k] for k in range(len(texts))] == brute_groups(texts).tolist()


def test_similar_texts_take_the_links_of_the_simhash_operator(spark):
    # this pair shares no band of min-hashes; two of five three-word shingles are "a a a", so op7's fingerprints are equal
    at = set(random.Random(3430).sample(range(1, 45), 5))
    pair = [" ".join(f"a a a a {'e3430y' if k in edited else 'x'}{k}" for k in range(46)) for edited in ((), at)]
    bands = [similar_texts._signature(np.unique(similar_texts.shingle_hashes(t.encode()))).astype(np.uint16).reshape(similar_texts.BANDS, -1) for t in pair]
    assert not (bands[0] == bands[1]).all(1).any() and brute_groups(pair).tolist() == [0, 0]
    other = " ".join(f"a a a a z{k}" for k in range(46))  # the same fingerprint, but not similar
    got = {r.doc_id: r.group_id for r in similar_texts.groups(docs_of(spark, [*enumerate([*pair, other])])).select("doc_id", "group_id").collect()}
    assert got == {0: 0, 1: 0, 2: 2}


def test_similar_texts_hold_a_large_group_of_near_copies(spark):
    rng = random.Random(29)
    texts = []
    for k in range(3000):
        w = [f"w{i}" for i in range(120)]
        for at in rng.sample(range(5, 115), 1 if k % 2 else 2):
            w[at] = f"e{k}x{at}"
        texts.append(" ".join(w))
    got = {r.doc_id: r.group_id for r in similar_texts.groups(docs_of(spark, [*enumerate(texts)])).select("doc_id", "group_id").collect()}
    assert [got[k] for k in range(len(texts))] == brute_groups(texts).tolist()


def brute_similarity(text, item, k=5):
    import re

    cut = lambda t: [w for w in re.split(r"[\W_]+", t.lower()) if w]
    a, b = cut(text), cut(item)
    k = min(k, len(b))
    bag = lambda w: [tuple(w[i : i + k]) for i in range(len(w) - k + 1)]
    a, b = bag(a), bag(b)
    best, size = 0.0, min(len(a), len(b))
    for s in range(max(0, len(a) - size) + 1 if a and b else 0):
        w = a[s : s + size]
        shared = sum(min(w.count(x), b.count(x)) for x in set(b))
        best = max(best, shared / (len(w) + len(b) - shared))
    return best


def test_decontamination_equals_brute_force(spark):
    rng = random.Random(11)
    word = lambda: f"t{rng.randint(0, 5000)}"
    items = [" ".join(word() for _ in range(n)) for n in (15, 40, 59, 3, 59)] + [" ".join(["la"] * 20), ""]
    texts = []
    for k in range(40):
        item = rng.choice(items[:5]).split()
        for _ in range(rng.choice([0, 0, 1, 2])):
            item[rng.randrange(len(item))] = word()
        if k % 5 == 0 and len(item) > 10:
            del item[5]
        texts.append(" ".join([word() for _ in range(rng.choice([0, 30, 80]))] + item + [word() for _ in range(rng.choice([0, 25]))]))
    texts += [" ".join(["la"] * 300), items[1].upper().replace(" ", ",  "), "", None]
    bench = spark.createDataFrame([*enumerate(items), (99, None)], "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.similarity for r in decontamination.matches(docs_of(spark, [*enumerate(texts)]), bench).collect()}
    want = {(i, k): s for i, t in enumerate(texts) for k, b in enumerate(items) if b and (s := brute_similarity(t or "", b)) >= 0.8 - 1e-12}
    assert got.keys() == want.keys() and all(got[x] == pytest.approx(want[x]) for x in want) and len(want) > 15
    clean = decontamination.clean(docs_of(spark, [*enumerate(texts)]), bench)
    assert {r.doc_id for r in clean.collect()} == set(range(len(texts))) - {d for d, _ in want}
    assert decontamination.matches(docs_of(spark, []), bench).count() == 0
    assert decontamination.matches(docs_of(spark, [(1, "a b")]), bench.limit(0)).count() == 0


def test_warc(spark):
    big = "<p>" + "é" * 700 + "</p>"
    pages = spark.createDataFrame([(1, "http://a/x?q=1", big, "z"), (9, None, big, "z"), (4, "http://b", big, "z"), (5, "u", "small", "z"), (6, "u", "small", "z"), (7, "u", None, "z"), (None, "u", big, "z"), (7, "u", None, "z")], "page_id long, url string, html string, digest string")
    got = sorted([tuple(r) for r in warc.round_trip(pages).collect()], key=str)
    sha, n = hashlib.sha1(big.encode()).hexdigest(), len(big.encode())
    small = hashlib.sha1(b"small").hexdigest()
    none = hashlib.sha1(b"").hexdigest()
    want = [(1, n, sha, "revisit", 9), (9, n, sha, "response", None), (4, n, sha, "revisit", 9), (None, n, sha, "revisit", 9), (5, 5, small, "response", None), (6, 5, small, "response", None), (7, 0, none, "response", None), (7, 0, none, "response", None)]
    assert got == sorted(want, key=str)
    assert warc.round_trip(pages.limit(0)).count() == 0


def test_warc_joins_without_broadcast(spark, monkeypatch):
    monkeypatch.setattr(warc, "BROADCAST_ROWS", 0)
    texts = ["a" * 1200, "b" * 1200, "c" * 3_000_000]
    pages = spark.createDataFrame([(k, "u", texts[k % 3] if k < 40 else f"tiny {k}") for k in range(60)], "page_id long, url string, html string")
    got = {r.page_id: (r.record_type, r.refers_to, r.payload_bytes) for r in warc.round_trip(pages).collect()}
    last = {k: max(i for i in range(40) if i % 3 == k) for k in range(3)}
    assert got == {k: ("response" if k >= 40 or k == last[k % 3] else "revisit", None if k >= 40 or k == last[k % 3] else last[k % 3], len(texts[k % 3]) if k < 40 else len(f"tiny {k}")) for k in range(60)}


def test_warc_links_in_either_direction(spark):
    rec = lambda kind, i, *c: (i, kind, list(c), "u", "d", None, None, None, {}, None)
    found = spark.createDataFrame([rec("response", "r", "q"), rec("request", "q"), rec("metadata", "m", "r")], "record_id string, type string, concurrent_to array<string>, target_uri string, date string, refers_to string, payload_digest string, payload_bytes long, fields map<string,string>, payload binary")
    row = warc.assemble(found).first()
    assert row.request.record_id == "q" and row.metadata.record_id == "m"


def test_html_structure():
    page = """<html><head><title>T</title></head><body><nav><ul><li>Menu<li>More</ul></nav><div class="cookie-notice">We use cookies</div>
    <article><header class="x"><h1>Head &amp; line</h1><span>By me</span></header><p>One <b>two</b>
     three<br>four<p>Five<div class="ad">Buy</div><script>var a="</p>";</script><form>Mail</form><section id="comments"><p>First!</p></section></article><aside>Side</aside><footer>&copy; me"""
    kept, free, aside = html_extraction.split_page(page)
    assert kept == ["Head & line", "One two three four", "Five"] and not any(free) and "More" in aside
    for broken in (None, "", "<", "<p", "<article><p>a <b", "text only", '<p class="a>b'):
        html_extraction.split_page(broken)
    assert html_extraction.split_page("text &lt;only&gt;") == (["text <only>"], [True], [])


def test_html_suffixes_drop_what_repeats(spark):
    boiler = "this site is made by the many friends of long templates"
    unique = ["our first page tells of rivers and of boats that sail", "the second one has hills and sheep and a lonely tree"]
    pages = spark.createDataFrame([(k, "http://h.example/x", f"<div>{boiler}</div><div>{u}</div>", 0) for k, u in enumerate(unique)] + [(5, "http://h.example/m", f"<div>{boiler}</div><div>{unique[1]}</div>", 0), (6, None, None, 0), (7, "http://other/", f"<div>{boiler}</div>", 0)], "page_id long, url string, html string, text int")
    got = {r.page_id: (r.text, r.n_chars) for r in html_extraction.extract(pages).collect()}
    assert got == {0: (unique[0], len(unique[0])), 1: (unique[1], len(unique[1])), 5: (unique[1], len(unique[1])), 6: ("", 0), 7: (boiler, len(boiler))}


def test_html_keeps_what_an_article_is_about(spark):
    body = lambda n: f"""<article><p>Page {n} has a story of its own, which goes on.</p><section class="related-work"><p>Others {n} studied this {n} before us {n} and found {n} little</p></section>
    <p id="share-price">The share price of {n} fell by {n} while {n} rose by {n}</p><math><mi>x{n}</mi></math><div class="site-footer">gone {n}</div><ul class="adSlot3"><li>gone</ul>
    <div class="newsletter-joys">join the many readers who get our letter each day</div></article>"""  # noqa: E731
    pages = spark.createDataFrame([(n, "https://h/x", body(n)) for n in range(4)] + [(9, "https://other/", body(9))], "page_id long, url string, html string")
    got = {r.page_id: r.text.split("\n\n") for r in html_extraction.extract(pages).collect()}
    for n in (0, 1, 2, 3, 9):
        letter = ["join the many readers who get our letter each day"] if n == 9 else []  # the host repeats it
        assert got[n] == [f"Page {n} has a story of its own, which goes on.", f"Others {n} studied this {n} before us {n} and found {n} little", f"The share price of {n} fell by {n} while {n} rose by {n}", f"x{n}", *letter]


def test_html_near_copies_do_not_erase_each_other(spark):
    text = [f"word{i}" for i in range(60)]
    near = [*text[:30], "other", *text[31:]]
    pages = spark.createDataFrame([(1, "http://h/", " ".join(text)), (2, "http://h/", " ".join(near)), (3, "http://h/", " ".join(text))], "page_id long, url string, html string")
    got = {r.page_id: r.text for r in html_extraction.extract(pages).collect()}
    assert got == {1: " ".join(text), 2: " ".join(near), 3: " ".join(text)}


def brute_runs(pages, run):
    """Runs of tokens and the pages (of distinct streams) that hold them."""
    found = {}
    for _, blocks in pages:
        stream = [w for t, _ in blocks for w in t.split(" ")]
        for i in range(len(stream) - run + 1):
            found.setdefault(" ".join(stream[i : i + run]), set()).add(" ".join(stream))
    return found


@pytest.mark.parametrize("run", [1, 2, 3, 5, 8])
def test_suffix_runs_equal_brute_force(run):
    rng = random.Random(run)
    pages = [(k, [(" ".join(rng.choices("ab c d".split(), k=rng.randint(1, 9))), rng.random() < 0.5) for _ in range(rng.randint(0, 4))]) for k in range(30)]
    pages = [(k, b) for k, b in pages if b] + [(99, pages[0][1] or [("a", True)])]
    got = {text: (least != most, n, sorted(starts)) for text, least, most, n, starts in html_extraction.suffix_runs(pages, run)}
    want = brute_runs(pages, run)
    assert got.keys() == want.keys()
    for text, streams in want.items():
        marks = [(row, i) for row, blocks in pages for i in range(99) if " ".join([w for t, _ in blocks for w in t.split(" ")][i : i + run]) == text and [f for t, f in blocks for _ in t.split(" ")][i]]
        assert got[text] == (len(streams) > 1, len(streams), sorted(marks))


def test_html_runs_across_the_blocks_of_a_host(spark, monkeypatch):
    monkeypatch.setattr(html_extraction, "BLOCK_CHARS", 150)
    boiler = "every page of ours says these nine words too"
    pages = spark.createDataFrame([(n, "http://h/", f"<div>{boiler}</div><div>{n} is only here</div>") for n in range(20)], "page_id long, url string, html string")
    assert {r.page_id: r.text for r in html_extraction.extract(pages).collect()} == {n: f"{n} is only here" for n in range(20)}


@pytest.mark.parametrize("html", ["<div>" * 60_000 + "</p>" * 60_000, '<a "' * 80_000, '<a "' * 80_000 + ">", "<ul><li><ul>" + "<div>" * 40_000 + "<li></li>" * 40_000, "<p>" * 80_000 + "<", """<a '"<b """ * 40_000 + "x>y", "<" * 100_000, "<!-" * 50_000])
def test_html_is_parsed_in_linear_time(html):
    import time

    began = time.process_time()
    html_extraction.split_page(html)
    assert time.process_time() - began < 5


def brute_segments(scores):
    """All maximal segments by their definition, recursively."""
    best = None
    for i in range(len(scores)):
        for j in range(i, len(scores)):
            s = sum(scores[i : j + 1])
            if s > 1e-12 and (best is None or s > best[2] + 1e-12):
                best = (i, j, s)
    if best is None:
        return []
    i, j, s = best
    return brute_segments(scores[:i]) + [best] + [(a + j + 1, b + j + 1, x) for a, b, x in brute_segments(scores[j + 1 :])]


def test_maximal_segments():
    rng = random.Random(2)
    for _ in range(200):
        marks = [(i, rng.choice([0.3, 1.0, 2.17])) for i in range(14) if rng.random() < 0.4]
        scores = [-0.41] * 14
        for i, s in marks:
            scores[i] = s
        got = toxicity.maximal_segments([i for i, _ in marks], [s for _, s in marks], 0.41)
        assert [(a, b) for a, b, _ in got] == [(a, b) for a, b, _ in brute_segments(scores)]


def test_classifiers_on_the_tables(spark):
    for name, column in (("op1_quality_classifier", "quality"), ("op9_toxicity", "toxic")):
        got = QUERIES[name](spark, "/root/testdata/sf0.01")
        labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
        held = got.join(labels, "doc_id").where("held_out").select(F.avg((F.col("predicted") == F.col(column)).cast("double"))).first()[0]
        assert held >= 0.95 and got.count() == 1000 and got.where("score is null or score < 0 or score > 1").count() == 0


def test_models_without_labels():
    net, model = quality.fit([], []), toxicity.fit([], [])
    assert quality.probability(net, None) == 0.5 and toxicity.score_text(model, "") < 0.01
    assert quality.fit(["a"], [1]) and 0 <= quality.probability(quality.fit(["a"], [1]), "x" * 100_000) <= 1
    assert language.identify(language.fit({}), ["a", None]) == (["und", "und"], [0.0, 0.0])


def test_scores_take_nulls_and_clashing_columns(spark):
    rows = docs_of(spark, [(1, None), (2, ""), (2, "x"), (2, "x"), (None, "y" * 300_000)]).withColumn("lang_pred", F.lit("z")).withColumn("passages", F.lit("z"))
    for of, ends in ((rows, 5), (rows.limit(0), 0)):
        for found in (quality.score(of, quality.fit([], [])), toxicity.score(of, toxicity.Model()), toxicity.score(of, toxicity.Model(), with_passages=True)):
            assert found.count() == ends and dict(found.dtypes)["score"] == "double" and sorted(found.columns) == sorted(rows.columns)
        found = language.predict(of, language.fit({"a": ["some text"]}))
        assert sorted(found.columns) == sorted(rows.columns) and [r.lang_pred for r in found.where("text is null").collect()] == ["und"] * (ends > 0)


def test_network_equals_a_plain_one_and_its_gradient_the_difference():
    rng = np.random.default_rng(9)
    net = quality._new()
    net.bias += rng.normal(0, 0.2, quality.FILTERS).astype(np.float32)
    net.centre, net.spread = rng.normal(0, 0.1, 2 * quality.FILTERS).astype(np.float32), rng.uniform(0.5, 1, 2 * quality.FILTERS).astype(np.float32)

    def plain(text):
        data = list(text.encode().ljust(quality.WIDTH, b"\0"))
        response = [sum(net.embedding[b] @ net.filters[k * quality.EMBED : (k + 1) * quality.EMBED] for k, b in enumerate(data[i : i + quality.WIDTH])) for i in range(len(data) - quality.WIDTH + 1)]
        half = quality.CHUNK // 2
        halves = [np.max(response[i : i + half], axis=0) for i in range(0, len(response), half)]
        chunks = np.tanh(np.array([np.maximum(a, b) for a, b in zip(halves, halves[1:])] or halves) + net.bias)
        x = (np.concatenate([chunks.mean(0), chunks.max(0)]) - net.centre) / net.spread
        return 1 / (1 + np.exp(-(x @ net.out + net.out_bias)))

    for text in ("a", "short", "Über " * 9, "z" * 500, "".join(rng.choice(list("abc é\n"), 9_000))):
        assert quality.probability(net, text) == pytest.approx(plain(text), abs=1e-4)
    # gradients of the cross entropy against central differences
    data, y = quality._bytes("A text of more than one chunk, long enough for the overlap to matter." * 3), 1.0
    names = ("embedding", "filters", "bias", "out")
    for name in names:
        setattr(net, name, getattr(net, name).astype(np.float64))
    grads = {n: np.zeros_like(getattr(net, n)) for n in names} | {"out_bias": 0.0}
    quality._backward(net, data, y, 1.0, grads)
    loss = lambda: -math.log(quality.probability(net, bytes(data).decode()))
    for name in names:
        values = getattr(net, name).reshape(-1)
        for at in np.argsort(-np.abs(grads[name].reshape(-1)))[:4]:
            old, step = values[at], 1e-5
            values[at] = old + step
            up = loss()
            values[at] = old - step
            down = loss()
            values[at] = old
            assert grads[name].reshape(-1)[at] == pytest.approx((up - down) / (2 * step), rel=2e-2, abs=1e-5), name


def test_evidence_follows_the_extreme_value_law():
    model = toxicity.Model(scores={"bad": 2.0}, lam=1.5, k=0.1)
    p = lambda n, s: 1 - math.exp(-0.1 * n * math.exp(-1.5 * s))
    assert toxicity.evidence(model, 50, []) == 0
    assert toxicity.evidence(model, 50, [(0, 1, 3.0)]) == pytest.approx(-math.log(p(50, 3.0)))
    # a further segment counts if it is significant by itself
    assert toxicity.evidence(model, 50, [(0, 1, 6.0), (5, 9, 8.0), (20, 20, 1.0)]) == pytest.approx(-math.log(p(50, 8.0)) - math.log(p(50, 6.0)))
    assert toxicity.evidence(model, 50, [(0, 1, 200.0)]) == pytest.approx(300 - math.log(5), rel=1e-6)
    assert toxicity.score_text(model, "good words only") == toxicity.score_text(model, "")


def test_toxicity_learns_from_few_labels():
    rng = random.Random(3)
    word = lambda: "".join(rng.choices("abcdefgh", k=5))
    bad = ["idiot", "trash", "scum"]
    texts = [" ".join([word() for _ in range(60)] + (rng.sample(bad, 2) + [bad[0]] if k < 10 else [])) for k in range(60)]
    model = toxicity.fit(texts, [int(k < 10) for k in range(60)])
    scores = [toxicity.score_text(model, " ".join([word() for _ in range(60)] + tail)) for tail in ([], ["idiot", "scum"], ["idiot", "trash", "idiot"])]
    assert scores[0] < 0.5 and scores[1] >= 0.5 and scores[2] >= scores[1]


def test_language_phrases_equal_plain_parsing():
    samples = {"a": ["abra cadabra abracadabra " * 4], "b": ["simsalabim bim sala " * 4]}
    model = language.fit(samples)
    text = "Abracada; simsala ABRA xyz"
    codes = language.encode(model.letters, text)
    found = language.phrases(model, [codes])[0]
    for k, lang in enumerate(model.languages):
        known = language.encode(model.letters, samples[lang][0]).tobytes()
        data, n, at = codes.tobytes(), 1, 0
        for i in range(len(data)):
            if data[at : i + 1] not in known or data[i] == language.UNKNOWN:
                n, at = n + 1, i
                if data[i : i + 1] not in known:
                    at = i + 1
        assert found[k] == n
    assert language.identify(model, [None, " 1!", "abra cadabra", "bim sala bim"])[0] == ["und", "und", "a", "b"]


def test_permutation_index(spark):
    rng = np.random.default_rng(1)
    v = rng.normal(size=(600, 16))
    rows = [(i, x.tolist(), "q") for i, x in enumerate(v)] + [(1000 + i, v[7].tolist(), "q") for i in range(200)]
    rows += [(2000, None, "q"), (2100, [0.0] * 16, "q"), (2200, [math.nan] * 16, "q"), (2300, [None] * 16, "q"), (2400, [1.0], "q"), (None, v[0].tolist(), "q"), (2500, [math.inf] * 16, "q")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score string")
    got = permutation_index.search(df, F.col("vec_id") % 100 == 0).toPandas()
    ids, x = np.array([r[0] for r in rows[:800]]), np.array([r[1] for r in rows[:800]])
    hits = []
    for q in ids[ids % 100 == 0]:
        d = np.sqrt(((x - x[ids == q][0]) ** 2).sum(1))
        d[ids == q] = np.inf
        want = ids[np.lexsort((ids, d))[:10]]
        mine = got[got.query_id == q].sort_values("rank")
        assert list(mine["rank"]) == list(range(1, 11))
        hits.append(len(set(mine.vec_id) & set(want)) / 10)
        if q >= 1000:
            assert list(mine.vec_id) == list(want)  # ties of copies: the smallest ids
    assert np.mean(hits) >= 0.9 and not set(got.query_id) & {2000, 2100, 2200, 2300, 2400, 2500}
    assert permutation_index.search(df.limit(0), F.col("vec_id") % 100 == 0).count() == 0


def test_permutation_index_adds_up_the_footrule():
    rng = np.random.default_rng(4)
    v, pivots = rng.normal(size=(50, 8)), rng.normal(size=(300, 8))
    order = permutation_index.orders(v, pivots)
    m = permutation_index.PLACES
    by_pivot = np.argsort(order.ravel(), kind="stable")
    starts = np.searchsorted(order.ravel()[by_pivot], np.arange(301))
    got = permutation_index.shared_places(50, order[0], by_pivot // m, by_pivot % m, starts)
    place = np.full((50, 300), m)
    for i, o in enumerate(order):
        assert (o == np.lexsort((np.arange(300), ((v[i] - pivots) ** 2).sum(1)))[:m]).all()
        place[i, o] = np.arange(m)
    footrule = np.abs(place - place[0]).sum(1)
    assert (m * (m + 1) - 2 * got == footrule).all()


def test_permutation_index_keeps_dimensions_apart(spark):
    rng = np.random.default_rng(6)
    rows = [(i, rng.normal(size=3 if i % 2 else 5).tolist()) for i in range(300)]
    got = permutation_index.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id").isin(10, 11), k=4).collect()
    for q in (10, 11):
        d = sorted((float(np.linalg.norm(np.subtract(v, rows[q][1]))), i) for i, v in rows if i != q and len(v) == len(rows[q][1]))[:4]
        assert [(r.score, r.vec_id) for r in sorted(got, key=lambda r: r["rank"]) if r.query_id == q] == [(pytest.approx(x), i) for x, i in d]


def test_permutation_index_recall_on_the_tables(spark):
    embeddings = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    got = QUERIES["op10_permutation_index"](spark, "/root/testdata/sf0.1").toPandas()
    rows = permutation_index.usable(embeddings).collect()
    ids, x = np.array([r.vec_id for r in rows]), np.array([r.v for r in rows])
    hits = []
    for q in ids[ids % 100 == 0]:
        d = np.sqrt(((x - x[ids == q][0]) ** 2).sum(1))
        d[ids == q] = np.inf
        hits.append(len(set(got[got.query_id == q].vec_id) & set(ids[np.lexsort((ids, d))[:10]])) / 10)
    assert np.mean(hits) >= 0.93


def test_pipeline_stages(spark):
    import corpus_pipeline

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    before = docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf)
        assert out.columns == docs.columns and out.count() <= before, name
    assert corpus_pipeline.run(spark, sf).select("doc_id").distinct().count() > before // 2


def test_samples_are_bounded(spark):
    from cumulo.llm import sampling

    docs = spark.createDataFrame([(k, "x" * 100, "a" if k % 2 else None) for k in range(200)] + [(1, "y" * 50, "a")] * 40, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(200)], "doc_id long, good int")
    texts, y = sampling.labelled_sample(docs, labels, "good", F.lit(True), (30, 50), 1000, total_chars=4_000)
    assert sum(y) == 40 and len(y) == 70 and all(len(t) == 100 for t in texts)
    assert [len(v) for v in sampling.language_sample(docs, F.lit(True), 20, 1000).values()] == [20]


def test_intermediates_can_be_deleted(spark):
    import os

    from cumulo.llm import common

    kept = common.materialize(spark.range(3), "some")
    path = kept.inputFiles()[0].removeprefix("file://")
    assert os.path.exists(path)
    common.forget(spark)
    assert not os.path.exists(path)


def plain_fingerprint(text, k=3):
    import re

    import xxhash

    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0d]+", lower)
    if not words:
        return 0
    votes = [xxhash.xxh64(" ".join(words[i : i + k]).encode(), seed=42).intdigest() for i in range(max(1, len(words) - k + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in votes) > len(votes))


def test_fingerprints_equal_a_plain_bit_vote(spark):
    rng = random.Random(12)
    texts = ["".join(rng.choices(["a", "B", " ", "\t", "\x0b", "\x1c", " ", "É", "x y", "\n", " "], k=rng.randint(0, 40))) for _ in range(300)] + [None, "", "One", "One two", prose(30_000, rng)]
    got = {r.doc_id: r.fp for r in simhash_dedup.fingerprints(docs_of(spark, [*enumerate(texts)])).collect()}
    assert [got[i] & (1 << 64) - 1 for i in range(len(texts))] == [plain_fingerprint(t) for t in texts]


def test_languages_of_held_out_documents(spark):
    got = QUERIES["op8_language_id"](spark, "/root/testdata/sf0.01")
    truth = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("lang is not null").select("doc_id", "lang")
    right = got.join(truth, "doc_id").where("held_out").select(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0]
    assert right >= 0.98 and got.count() == 1000 and got.where("score is null or score < 0 or score > 1").count() == 0


def test_multi_index_meets_all_fingerprints_within_the_radius(spark):
    rng = np.random.default_rng(8)
    base = rng.integers(-(1 << 62), 1 << 62, 60)
    rows = [(int(i), int(b), int(b) ^ sum(1 << int(k) for k in rng.choice(63, int(rng.integers(0, decontamination.RADIUS + 1)), replace=False))) for i, b in enumerate(base)]
    df = spark.createDataFrame(rows, "i long, a long, b long")
    met = df.select("i", F.inline(decontamination.index_postings(F.col("a"), decontamination.RADIUS))).join(df.select("i", F.inline(decontamination.index_blocks(F.col("b")))), ["i", "block", "bits"])
    assert met.select("i").distinct().count() == len(rows)
    others = df.select("i", F.inline(decontamination.index_postings(F.col("a"), decontamination.RADIUS))).join(df.select(F.col("i").alias("j"), F.inline(decontamination.index_blocks(F.col("b")))), ["block", "bits"]).where("i <> j").select("i", "j").distinct().count()
    assert others < 0.35 * len(rows) * (len(rows) - 1)  # it selects: few of the others meet


def test_running_counts_give_the_fingerprints_of_windows(spark):
    for largest in (20, 100_000):
        counters = decontamination.Counters(largest)
        rng = random.Random(largest)
        bags = {k: [rng.getrandbits(64) - (1 << 63) for _ in range(rng.randint(1, 20))] for k in range(40)}
        df = spark.createDataFrame([(k, h) for k, bag in bags.items() for h in bag], "k int, h long")
        summed = df.select("k", *[x.alias(n) for n, x in zip(counters.names, counters.of(F.col("h")))]).groupBy("k").agg(F.count("*").alias("size"), *[F.sum(n).alias(n) for n in counters.names])
        got = {r.k: r.fp & (1 << 64) - 1 for r in summed.select("k", counters.fingerprint(F.col("size")).alias("fp")).collect()}
        assert got == {k: sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in bag) > len(bag)) for k, bag in bags.items()}


def test_decontamination_of_long_texts_and_many_copies(spark):
    rng = random.Random(21)
    word = lambda: f"z{rng.randint(0, 9999)}"
    items = [" ".join(word() for _ in range(n)) for n in range(15, 55)]
    filler = lambda n: [word() for _ in range(n)]
    long_text = " ".join(w for k in range(400) for w in [*filler(60), *items[k % 40].split()])
    rows = [(0, long_text), (1, " ".join(filler(40_000)))] + [(k, " ".join(["some"] + [items[3], "words"])) for k in range(2, 300)] + [(7, None), (None, items[5])]
    bench = spark.createDataFrame([*enumerate(items)], "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontamination.matches(docs_of(spark, rows), bench).where("similarity = 1").collect()}
    assert got == {(0, k) for k in range(40)} | {(k, 3) for k in range(2, 300)} | {(None, 5)}


STAGE_DOCS = "doc_id long, text string, lang string, source string, n_chars long, score string, node string, body string, doc string, y int, h long, passages string"


def test_pipeline_stages_on_odd_rows(spark):
    import corpus_pipeline

    sf = "/root/testdata/sf0.001"
    good = spark.read.parquet(f"{sf}/documents.parquet").where("length(text) > 500").orderBy("doc_id").limit(3).collect()
    texts = [(1, None), (1, None), (2, ""), (None, "one"), (None, "one"), (3, good[0].text), (3, good[0].text), (4, good[1].text), (5, "word " * 60_000), (6, "\u0000퟿ \t\n")]
    rows = spark.createDataFrame([(i, t, None, "s", None, "a", "b", "c", "d", 1, 2, "e") for i, t in texts], STAGE_DOCS)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, rows, sf)
        if name != "packing":
            assert out.columns == rows.columns and out.dtypes == rows.dtypes, name
        if name != "quality":  # none of these rows is a clean text's only
            assert out.count() > 0, name
        assert stage(spark, rows.limit(0), sf).count() == 0, name
    kept = sorted((r.doc_id or -1, r.text or "") for r in corpus_pipeline.near_duplicate_stage(spark, rows, sf).collect())
    assert [i for i, _ in kept] == [-1, 1, 3, 4, 5, 6]  # null and empty texts are one; repeated rows too


def test_pipeline_equals_plain_versions(spark):
    """Which documents come through all stages, and in how many pieces, from a plain version of every stage."""
    import re

    import corpus_pipeline
    from tokenizers import Tokenizer

    sf = "/root/testdata/sf0.001"
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    predicted = {name: {r.doc_id: r.predicted for r in QUERIES[name](spark, sf).collect()} for name in ("op1_quality_classifier", "op9_toxicity")}
    left = [i for i in sorted(docs) if predicted["op1_quality_classifier"][i] == 1 and predicted["op9_toxicity"][i] == 0]
    words = {i: docs[i].encode().lower().split() for i in left}
    sets = {i: {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set() for i, w in words.items()}
    near = lambda a, b: sets[a] == sets[b] or (sets[a] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]))
    label = components_of(left, lambda a, b: near(a, b))
    left = [i for i in left if label[i] == i]
    cut = lambda t: [w for w in re.split(r"[\W_]+", t.lower()) if w]
    items = [r.text for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    runs = [{tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} for w in map(cut, items)]
    leaks = lambda t: any(s & {tuple(w[k : k + 5]) for w in [cut(t)] for k in range(len(w))} and brute_similarity(t, b) >= 0.8 - 1e-12 for s, b in zip(runs, items))
    left = [i for i in left if not leaks(docs[i])]
    tokenizer = Tokenizer.from_file(tokenizer_path(WORD))
    want = sorted((i, k) for i in left for k in range(-(-(len(tokenizer.encode(docs[i], add_special_tokens=False).ids) + 1) // 2048)))
    assert sorted((r.doc_id, r.piece) for r in corpus_pipeline.run(spark, sf).collect()) == want and len(want) > 50
