"""Power-of-two packing and cross-tokenizer alignment against brute force, and on odd rows."""

import hashlib
import random
import zlib
from collections import Counter
from itertools import accumulate

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from cumulo.llm import common, power_packing, token_alignment
from cumulo.llm.queries import QUERIES, tokenizer_path

BYTE, WORD, PIECE = "byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"
DOCS = "doc_id long, text string, row string, pair string, n string, task string, length string"
SF = "/root/testdata/sf0.001"
RNG = random.Random(9)
ODD = [None, "", " ", "\n", "a", "one two", "one two", "x" * 5000, "two  spaces", " lead", "trail ", "a\nb", "▁", "<s> <|endoftext|> <0x0A>", "é ﬁ 字 😀"]


def docs_of(spark, texts):
    return spark.createDataFrame([(i, t, *"rpntl") for i, t in texts], DOCS)


# --- power-of-two packing -------------------------------------------------------------------


def check_sequences(rows, texts, limit, end=1):
    """Every id once and in order, binary lengths, a sequence a piece, numbers without a gap, bucket by bucket."""
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokenizer_path(WORD))
    want = Counter()
    for doc_id, text in texts:
        ids, start = np.array([*library.encode(text or "", add_special_tokens=False).ids, end], "<u4"), 0
        n = len(ids)
        for length in [limit] * (n // limit) + [2**k for k in range(20, -1, -1) if 2**k < limit and n % limit >> k & 1]:
            want[doc_id, start, length, zlib.crc32(ids[start : start + length].tobytes()), n] += 1
            start += length
        assert start == n
    assert Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in rows) == want
    ordered = sorted(rows, key=lambda r: r.sequence_id)
    assert [r.sequence_id for r in ordered] == list(range(len(rows))) and all(r.offset == 0 for r in rows)
    assert [r.length for r in ordered] == sorted(r.length for r in rows)
    seen = Counter()
    for r in ordered:
        assert r.bucket_rank == seen[r.length]
        seen[r.length] += 1


def test_power_packing_of_the_table(spark):
    rows = QUERIES["op11_power_of_two_packing"](spark, SF).collect()
    t = pq.read_table(f"{SF}/documents.parquet", columns=["doc_id", "text"]).to_pylist()
    check_sequences(rows, [(r["doc_id"], r["text"]) for r in t], 2048)


@pytest.mark.parametrize("broadcast", [0, 1_000])
def test_power_packing_of_odd_rows(spark, monkeypatch, broadcast):
    monkeypatch.setattr(power_packing, "BROADCAST_TOTALS", broadcast)
    texts = [(RNG.choice([7, 7, i, None]), t) for i, t in enumerate(ODD * 3)] + [(3, "hello world " * 3000)]
    got = power_packing.pack_documents(docs_of(spark, texts).repartition(5), tokenizer_path(WORD), max_tokens=64, keep_ids=True)
    rows = got.collect()
    check_sequences(rows, texts, 64)
    assert all(zlib.crc32(bytes(r.ids)) == r.ids_crc32 and len(r.ids) == 4 * r.length for r in rows)


def test_power_packing_batches_and_limits(spark):
    texts = [(i, "word " * (i % 50)) for i in range(300)]
    got = power_packing.pack_documents(docs_of(spark, texts), tokenizer_path(WORD), max_tokens=16)
    sizes = got.groupBy("length", power_packing.batch_number(64).alias("batch")).agg(F.sum("length").alias("tokens"), F.count("*").alias("n")).collect()
    last = {r.length: max(s.batch for s in sizes if s.length == r.length) for r in sizes}
    assert all(r.tokens == 64 or r.batch == last[r.length] and r.tokens < 64 for r in sizes)
    with pytest.raises(ValueError):
        power_packing.pack_documents(docs_of(spark, texts), tokenizer_path(WORD), max_tokens=1000)
    assert power_packing.pack_documents(docs_of(spark, []), tokenizer_path(WORD)).count() == 0
    assert power_packing.binary_lengths(1, 1) == [1] and power_packing.binary_lengths(3, 1) == [1, 1, 1]


# --- alignment ------------------------------------------------------------------------------


class Plain:
    """Alignment from the definitions: common ends cut groups, equal ends link."""

    def __init__(self):
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer
        from tokenizers.decoders import ByteLevel

        self.a, self.b = Tokenizer.from_file(tokenizer_path(BYTE)), SentencePieceProcessor(model_file=tokenizer_path(PIECE))
        self.a.encode_special_tokens = True
        letters = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
        self.byte = {chr(b): b for b in letters} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in letters)}
        assert ByteLevel().decode(["Ġ"]) == " " and self.byte["Ġ"] == 32

    def __call__(self, text):
        """(ids of A, ids of B, groups, links) of a text."""
        if not text:
            return [], [], [], []
        a, b = self.a.encode(" " + text, add_special_tokens=False), self.b.encode(text)
        bytes_a = [bytes(self.byte[c] for c in t) for t in a.tokens]
        bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(k) else p.replace("▁", " ").encode() for k, p in zip(b, map(self.b.id_to_piece, b))]
        if b"".join(bytes_a) != (" " + text).encode() or b"".join(bytes_b) != (" " + text).encode():
            return [], [], [], []
        ends_a, ends_b = list(accumulate(map(len, bytes_a))), list(accumulate(map(len, bytes_b)))
        groups, last = [], 0
        for end in sorted({*ends_a} & {*ends_b}):
            groups.append(",".join(str(i) for i, e in zip(a.ids, ends_a) if last < e <= end) + "|" + ",".join(str(i) for i, e in zip(b, ends_b) if last < e <= end))
            last = end
        at = {}
        for i, e in zip(b, ends_b):
            at.setdefault(e, []).append(i)
        return a.ids, b, groups, [(i, j) for i, e in zip(a.ids, ends_a) for j in at.get(e, [])]


def expected(texts):
    plain = Plain()
    found = [(doc_id, *plain(text)) for doc_id, text in texts]
    counts = Counter(link for *_, links in found for link in links)
    best = {}
    for (_, j), n in counts.items():
        best[j] = max(best.get(j, 0), n)
    return Counter(
        (doc_id, len(a), len(b), len(groups), len(links), sum(counts[x] == best[x[1]] for x in links), sum(counts[x] for x in links), hashlib.sha256(";".join(groups).encode()).hexdigest() if a else "")
        for doc_id, a, b, groups, links in found
    ), counts


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def test_alignment_of_the_table(spark):
    got = QUERIES["op12_token_alignment"](spark, SF)
    assert got.columns == COLUMNS
    docs = pq.read_table(f"{SF}/documents.parquet", columns=["doc_id", "text"]).to_pylist()
    assert Counter(map(tuple, got.collect())) == expected([(d["doc_id"], d["text"]) for d in docs])[0]


@pytest.mark.parametrize("broadcast", [0, 100_000])
def test_alignment_of_odd_rows(spark, monkeypatch, broadcast):
    monkeypatch.setattr(token_alignment, "BROADCAST_PAIRS", broadcast)
    alphabet = [" ", " ", "a", "'s", "\n", "\t", "!", "1", "é", "字", "́", "_", "­", "½", "ﬁ", "😀", "<|endoftext|>", " the", "<s>", "<0x0A>", "▁", "\x85", "\x1c", "᠎", "​", "\r", "ing", "Hello", "　"]
    texts = [(RNG.choice([7, i, None]), t) for i, t in enumerate(ODD * 2)] + [(i, "".join(RNG.choices(alphabet, k=RNG.randint(1, 20)))) for i in range(1500)]
    got = token_alignment.score_documents(docs_of(spark, texts), tokenizer_path(BYTE), tokenizer_path(PIECE))
    want, counts = expected(texts)
    assert Counter(map(tuple, got.collect())) == want
    aligned = common.materialize(token_alignment.align_documents(docs_of(spark, texts), tokenizer_path(BYTE), tokenizer_path(PIECE), keep_groups=True), "test-alignment")
    assert {(r.a_id, r.b_id): r.links for r in token_alignment.pair_counts(aligned).collect()} == dict(counts)
    assert all(hashlib.sha256(r.groups.encode()).hexdigest() == r.groups_sha256 for r in aligned.collect() if r.n_a)


def test_alignment_of_a_very_long_text():
    by = token_alignment.Aligner(tokenizer_path(BYTE), tokenizer_path(PIECE))
    text = "Word, wörd " * 60_000 + "end"
    (numbers,), (groups,), (pairs,), (links,) = by.align([text])
    a, b, want, linked = Plain()(text[: 11 * 20])
    assert groups.startswith(";".join(want[:-2])) and numbers[2] == groups.count(";") + 1 == numbers[3] == links.sum()
    assert set(linked[:-2]) <= {(p >> 32, p & 0xFFFFFFFF) for p in pairs.tolist()}


def test_components_are_the_minimal_groups():
    for _ in range(2000):
        n = RNG.randint(1, 30)
        ends = [np.array(sorted({*RNG.sample(range(1, n + 1), RNG.randint(0, n)), n})) for _ in "ab"]
        cuts = sorted({*ends[0].tolist()} & {*ends[1].tolist()})
        for got, side in zip(token_alignment.overlap_groups(*ends), ends):
            assert got.tolist() == np.searchsorted(cuts, side).tolist()


def test_union_find_equals_a_plain_one():
    for _ in range(500):
        nodes = RNG.randint(1, 40)
        edges = [(RNG.randrange(nodes), RNG.randrange(nodes)) for _ in range(RNG.randint(0, 40))]
        least = list(range(nodes))
        for _ in range(nodes):
            for i, j in edges:
                least[i] = least[j] = min(least[i], least[j])
        first, second = (np.array([e[k] for e in edges], int) for k in (0, 1))
        assert token_alignment.components(first, second, nodes).tolist() == least


def test_alignment_of_an_empty_table(spark):
    assert token_alignment.score_documents(docs_of(spark, []), tokenizer_path(BYTE), tokenizer_path(PIECE)).count() == 0
