"""Toxic passages by maximum-scoring segments of token log-odds.

Fit (on a bounded, documented sample of labelled rows): token counts in toxic and clean documents
give a log-odds ratio under a Dirichlet prior proportional to the tokens' overall frequency. A token
scores its log-odds where its z-score is significant, and a small penalty otherwise.
Scoring: one linear pass over a document's token scores finds every maximal scoring segment (the
all-maximal-segments algorithm of Ruzzo and Tompa). The best score of n random tokens follows an
extreme-value law, P(max > s) = 1 - exp(-K n e^(-lambda s)); lambda solves sum p_i e^(lambda s_i) = 1
over the clean token frequencies and K is fitted to clean documents. The negative logarithm of that
probability, with those of all further significant segments, makes the evidence; a one-variable
logistic curve, fitted on the same sample, turns it into a probability.

Defined cases: null or empty text, or no scored token -> the score of zero evidence; no labelled row
of one class -> every score is 0; so few rows that no token is significant at all -> one score below 0.5;
a score of just 0.5 counts as toxic; very long texts -> one linear pass; repeated rows -> one result each;
empty table -> no rows; extra columns are kept, but for those of the result's names.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bound_batches
from .sampling import labelled_sample

WORD = re.compile(r"[^\W\d_]+")
#: Bounds of the fit: clean and toxic labelled documents, characters of a document, tokens in the model.
FIT_CLEAN, FIT_TOXIC, FIT_CHARS, MODEL_TOKENS = 8_000, 4_000, 20_000, 20_000
#: Weight of the Dirichlet prior as a share of the counted tokens, least z-score of a scored token,
#: penalty of any other token.
PRIOR_SHARE, LEAST_Z, PENALTY = 0.05, 2.0, 0.25
#: Chance, over the whole vocabulary, that a token passes though it is as frequent in either class.
CHANCE = 0.01
#: So many tokens count even if less sure, from this share of the vocabulary's logarithm on (at 1, chance would
#: let one token of the vocabulary pass).
LEAST_TOKENS, LEAST_STRENGTH = 10, 0.75
#: A further segment counts if its own tail probability is at most this.
SEGMENT_P = 1e-3


@dataclass
class Model:
    scores: dict[str, float] = field(default_factory=dict)
    lam: float = 1.0
    k: float = 1.0
    slope: float = 0.0
    bias: float = -60.0  # without data every score is (nearly) 0
    penalty: float = PENALTY


def maximal_segments(positions: list[int], values: list[float], penalty: float) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first, last position, score) of a sequence in which ``positions``
    carry positive ``values`` and every other token carries -penalty. Linear in len(positions).

    Each candidate keeps the cumulative score before it (left) and at its end (right). A new one is
    joined with the nearest earlier candidate whose left is lower, if that one's right is lower too.
    """
    kept: list[list[float]] = []  # first, last, left, right
    earlier: list[int] = []  # for each kept: nearest earlier one with a lower left, or -1
    total, seen = 0.0, 0
    for at, value in zip(positions, values):
        total -= penalty * (at - seen)
        seen = at + 1
        new = [at, at, total, total + value]
        total += value
        while True:
            j = len(kept) - 1
            while j >= 0 and kept[j][2] >= new[2]:
                j = earlier[j]
            if j < 0 or kept[j][3] >= new[3]:
                kept.append(new)
                earlier.append(j)
                break
            new = [kept[j][0], new[1], kept[j][2], new[3]]
            del kept[j:], earlier[j:]
    return [(int(a), int(b), right - left) for a, b, left, right in kept]


def tokens(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


def passages(model: Model, words: list[str]) -> list[tuple[int, int, float]]:
    get = model.scores.get
    hits = [(i, s) for i, s in enumerate(map(get, words)) if s is not None]
    return maximal_segments([i for i, _ in hits], [s for _, s in hits], model.penalty) if hits else []


def evidence(model: Model, n: int, segments: list[tuple[int, int, float]]) -> float:
    """-ln of the best segment's tail probability, plus that of every further significant segment."""
    total, cut = 0.0, -math.log(SEGMENT_P)
    for rank, (_, _, score) in enumerate(sorted(segments, key=lambda s: -s[2])):
        # the expected number of segments that good, 1 - exp(-x) = P; -ln P stays exact for tiny x
        x = math.log(max(model.k * max(n, 1), 1e-300)) - model.lam * score
        strength = -x if x < -20 else -math.log(-math.expm1(-math.exp(min(x, 30.0))))
        if rank and strength < cut:
            break
        total += strength
    return total


def _sigmoid(x: float) -> float:
    return 1.0 / (1.0 + math.exp(-x)) if x >= 0 else math.exp(x) / (1.0 + math.exp(x))


def score_text(model: Model, text: str | None) -> float:
    words = tokens(text)
    return _sigmoid(model.bias + model.slope * evidence(model, len(words), passages(model, words)))


def _one_of_copies(texts: list[str], labels: list[int]) -> tuple[list[str], list[int]]:
    """Copies and near copies of a text are one observation: a text goes if an earlier one has the same
    least or greatest hash of three-word shingles (two min-hashes)."""
    seen: set[tuple[int, int]] = set()
    kept = []
    for text, y in zip(texts, labels):
        words = tokens(text)
        hashes = [zlib.crc32(" ".join(words[i : i + 3]).encode()) for i in range(max(1, len(words) - 2))]
        keys = {(0, min(hashes)), (1, max(hashes))}
        if not keys & seen:
            kept.append((text, y))
        seen |= keys
    return [t for t, _ in kept], [y for _, y in kept]


def fit(texts: list[str], labels: list[int]) -> Model:
    model = Model()
    texts, labels = _one_of_copies(texts, labels)
    if len(set(labels)) < 2:
        return model
    toxic, clean = Counter(), Counter()
    for text, y in zip(texts, labels):
        # a document counts a token once: copies of a passage inside it add no evidence
        (toxic if y else clean).update(set(tokens(text)))
    nt, nc = sum(toxic.values()), sum(clean.values())
    prior = PRIOR_SHARE * (nt + nc)
    q = sum(labels) / len(labels)
    vocabulary = len(toxic.keys() | clean.keys())
    needed = math.log(vocabulary / CHANCE)
    found = []
    for word, t in toxic.items():
        c = clean.get(word, 0)
        n = t + c
        share = t / n
        # Chernoff's bound on drawing t toxic documents of n
        strength = 0.0 if share <= q else n * (share * math.log(share / q) + ((1 - share) * math.log((1 - share) / (1 - q)) if c else 0))
        if strength < LEAST_STRENGTH * math.log(vocabulary):
            continue
        a = n * PRIOR_SHARE
        odds = math.log((t + a) / (nt + prior - t - a)) - math.log((c + a) / (nc + prior - c - a))
        z = odds / math.sqrt(1 / (t + a) + 1 / (c + a))
        if z >= LEAST_Z * min(1.0, strength / needed):
            found.append((strength, z, word, min(odds, 8.0)))
    # with few labels, the strongest tokens count though they stay below the bound: at odds shrunk by how far
    found.sort(key=lambda x: (-x[0], x[2]))
    kept = [(-z, word, odds * min(1.0, strength / needed)) for k, (strength, z, word, odds) in enumerate(found) if strength >= needed or k < LEAST_TOKENS]
    model.scores = {word: odds for _, word, odds in sorted(kept)[:MODEL_TOKENS]}
    _calibrate(model, texts, labels)
    return model


def _calibrate(model: Model, texts: list[str], labels: list[int]) -> None:
    # lambda: token frequencies of clean documents, with half a count for each scored token
    freq: Counter = Counter()
    total = 0
    found, lengths, best = [], [], []
    for text, y in zip(texts, labels):
        words = tokens(text)
        found.append((len(words), passages(model, words)))
        if not y:
            total += len(words)
            freq.update(w for w in words if w in model.scores)
            lengths.append(max(1, len(words)))
            best.append(max((x[2] for x in found[-1][1]), default=0.0))
    s = np.array([*model.scores.values(), -model.penalty])
    p = np.array([freq.get(w, 0) + 0.5 for w in model.scores] + [max(total, 1)], dtype=float)
    p /= p.sum()
    low, high = 1e-6, 1.0
    growth = lambda x: float((p * np.exp(x * s)).sum())
    while growth(high) < 1 and high < 64:
        high *= 2
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (mid, high) if growth(mid) < 1 else (low, mid)
    model.lam = max(low, 1e-3)
    # K: the mean of e^(-lambda s) over clean documents' best scores matches that of the law
    # for max ~ Gumbel, E[K n e^(-lambda S)] = 1, so K = 1 / mean(n e^(-lambda S))
    model.k = float(min(1.0, max(1e-6, 1.0 / np.mean(np.array(lengths) * np.exp(-model.lam * np.array(best))))))
    x = np.array([evidence(model, n, seg) for n, seg in found])
    y = np.array(labels, dtype=float)
    model.slope, model.bias = _logistic(x, y)
    if not model.scores or model.slope <= 0:
        # too few labels to tell any token: nothing is evidence, so nothing is called toxic
        model.slope, model.bias = 0.0, min(math.log(y.mean() / (1 - y.mean())), -1.0)


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope >= 0 and bias of a logistic curve in ln(1 + x); Newton steps with a small ridge."""
    w = np.zeros(2)
    features = np.stack([x / 10.0, np.ones_like(x)], 1)
    features[:, 0] = np.minimum(features[:, 0], 10.0)
    weight = np.where(y == 1, 0.5 / max(y.mean(), 1e-9), 0.5 / max(1 - y.mean(), 1e-9))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(features @ w, -30, 30)))
        gradient = features.T @ (weight * (p - y)) + 1e-2 * np.array([w[0], 0.0])
        hessian = (features * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ features + 1e-2 * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        w -= np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return float(max(w[0], 0.0)) / 10.0, float(w[1])


def fit_model(docs: DataFrame, labels: DataFrame, allowed, label_column: str = "toxic") -> Model:
    return fit(*labelled_sample(docs, labels, label_column, allowed, (FIT_CLEAN, FIT_TOXIC), FIT_CHARS))


def score(docs: DataFrame, model: Model, with_passages: bool = False) -> DataFrame:
    """``docs`` with a score for every row, from the whole text; passages as (first word, last word, score). Columns
    of these names give way."""
    shared = bound_batches(docs).sparkSession.sparkContext.broadcast(model)  # at most MODEL_TOKENS tokens
    kind = "score double, passages array<struct<first:int,last:int,score:double>>" if with_passages else "score double"

    @F.pandas_udf(f"struct<{kind.replace('score double,', 'score:double,', 1).replace('passages array', 'passages:array')}>" if with_passages else "double")
    def scored(texts):
        import pandas as pd

        m = shared.value
        if not with_passages:
            return pd.Series([score_text(m, t) for t in texts], dtype="float64")
        rows = []
        for t in texts:
            words = tokens(t)
            segments = passages(m, words)
            rows.append((_sigmoid(m.bias + m.slope * evidence(m, len(words), segments)), [{"first": a, "last": b, "score": s} for a, b, s in segments]))
        return pd.DataFrame(rows, columns=["score", "passages"])

    names = ["score", "passages"] if with_passages else ["score"]
    kept = docs.select("*", scored(F.col("text")).alias("__scored")).select(*[F.col(f"`{c}`") for c in docs.columns if c not in names], "__scored")
    if with_passages:
        return kept.select("*", "__scored.score", "__scored.passages").drop("__scored")
    return kept.withColumnRenamed("__scored", "score")
