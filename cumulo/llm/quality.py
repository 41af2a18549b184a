"""Quality classifier: a byte-level convolutional network in numpy.

A text is its UTF-8 bytes. Every byte has a learned embedding; learned filters of ``WIDTH`` bytes run
over the whole text. The text is covered by chunks of ``CHUNK`` bytes that overlap by half; a
filter's response is max-pooled over each chunk, the chunks' maxima are averaged and the greatest
taken, and a logistic unit combines both into one probability. Fitting is plain gradient descent
(Adam) with hand-written gradients, on a bounded, documented sample of labelled rows.

Defined cases: null or empty text -> the probability of a text without bytes (zero features); texts
shorter than a filter are padded; no labelled row of one class -> every score is the share of label 1
(0.5 without any label); a probability of just 0.5 counts as label 1; very long texts -> convolved a block
at a time; repeated rows -> one result each; empty table -> no rows; extra columns are kept, but for ``score``.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bound_batches
from .sampling import labelled_sample

EMBED, WIDTH, FILTERS = 4, 8, 16
CHUNK = 64
#: Bounds of the fit: labelled documents per class, characters of a document, passes.
FIT_PER_CLASS, FIT_CHARS, EPOCHS = 1_200, 20_000, 8
SEED = 7
#: Positions convolved at a time: a block and its windows stay in the processor's cache.
BLOCK = 8_192


@dataclass
class Network:
    embedding: np.ndarray  # 256 x EMBED
    filters: np.ndarray  # WIDTH * EMBED x FILTERS
    bias: np.ndarray  # FILTERS
    out: np.ndarray  # 2 * FILTERS
    out_bias: float
    centre: np.ndarray  # mean and spread of the pooled features, fixed before the fit
    spread: np.ndarray


def _new() -> Network:
    rng = np.random.default_rng(SEED)
    f = lambda *shape, s: rng.normal(0, s, shape).astype(np.float32)
    return Network(f(256, EMBED, s=0.7), f(WIDTH * EMBED, FILTERS, s=0.35), np.zeros(FILTERS, np.float32), f(2 * FILTERS, s=0.05), 0.0, np.zeros(2 * FILTERS, np.float32), np.ones(2 * FILTERS, np.float32))


def _bytes(text: str | None) -> np.ndarray:
    data = (text or "").encode("utf-8", "surrogatepass")
    return np.frombuffer(data.ljust(WIDTH, b"\0") if data else b"", np.uint8)


def _maxima(net: Network, data: np.ndarray, positions: bool = False):
    """Maxima (and where) of every filter over half chunks of positions; chunk = two neighbours."""
    half, n = CHUNK // 2, len(data) - WIDTH + 1
    pad = -n % half
    maxima, where = [], []
    for start in range(0, n, BLOCK):
        stop = min(n, start + BLOCK)
        x = net.embedding[data[start : stop + WIDTH - 1]]
        view = np.lib.stride_tricks.as_strided(x, (stop - start, WIDTH * EMBED), (x.strides[0], x.strides[1]))
        r = view @ net.filters
        if stop == n and pad:
            r = np.vstack([r, np.full((pad, FILTERS), -np.inf, np.float32)])
        r = r.reshape(-1, half, FILTERS)
        maxima.append(r.max(1))
        if positions:
            where.append(r.argmax(1) + np.arange(start, start + len(r) * half, half)[:, None])
    m = np.concatenate(maxima)
    return (m, np.concatenate(where)) if positions else m


def _chunks(half: np.ndarray) -> np.ndarray:
    return np.maximum(half[:-1], half[1:]) if len(half) > 1 else half


def features(net: Network, text: str | None) -> np.ndarray:
    data = _bytes(text)
    if not len(data):
        return np.zeros(2 * FILTERS, np.float32)
    pooled = np.tanh(_chunks(_maxima(net, data)) + net.bias)
    return np.concatenate([pooled.mean(0), pooled.max(0)])


def probability(net: Network, text: str | None) -> float:
    z = float(((features(net, text) - net.centre) / net.spread) @ net.out) + net.out_bias
    return float(1.0 / (1.0 + np.exp(-np.clip(z, -30.0, 30.0))))


def fit(texts: list[str], labels: list[int]) -> Network:
    net = _new()
    if len(set(labels)) < 2:
        share = float(np.mean(labels)) if labels else 0.5
        net.out[:] = 0
        net.out_bias = float(np.log(max(share, 1e-6) / max(1 - share, 1e-6)))
        return net
    pairs = list(dict(zip(texts, labels)).items())
    data, y = [_bytes(t) for t, _ in pairs], np.array([v for _, v in pairs], np.float32)
    keep = [i for i, d in enumerate(data) if len(d)]
    data, y = [data[i] for i in keep], y[keep]
    # short texts are rare in a sample: each document also lends one short window, at a lower weight
    rng = np.random.default_rng(SEED)
    windows = [d[(a := int(rng.integers(0, len(d) - 30))) : a + int(rng.integers(24, 240))] for d in data if len(d) > 64]
    y = np.concatenate([y, [v for d, v in zip(data, y) if len(d) > 64]]).astype(np.float32)
    share = np.repeat([1.0, 0.5], [len(data), len(windows)])
    data += windows
    first = np.array([features(net, t) for t, _ in pairs[:300]])
    net.centre, net.spread = first.mean(0), first.std(0) + 0.05
    weight = share * np.where(y == 1, 0.5 / max(y.mean(), 1e-6), 0.5 / max(1 - y.mean(), 1e-6))
    params = {"embedding": net.embedding, "filters": net.filters, "bias": net.bias, "out": net.out}
    m1 = {k: np.zeros_like(v) for k, v in params.items()} | {"out_bias": 0.0}
    m2 = {k: np.zeros_like(v) for k, v in params.items()} | {"out_bias": 0.0}
    step, batch = 0, 32
    for epoch in range(EPOCHS):
        order = rng.permutation(len(data))
        rate = 0.02 * (0.5 if epoch >= EPOCHS // 2 else 1.0) * (0.4 if epoch >= EPOCHS - 3 else 1.0)
        for at in range(0, len(order), batch):
            grads = {k: np.zeros_like(v) for k, v in params.items()} | {"out_bias": 0.0}
            part = order[at : at + batch]
            for i in part:
                _backward(net, data[i], float(y[i]), float(weight[i]) / len(part), grads)
            step += 1
            for k, g in grads.items():
                if k == "out":
                    g = g + 1e-4 * net.out
                m1[k] = 0.9 * m1[k] + 0.1 * g
                m2[k] = 0.99 * m2[k] + 0.01 * g * g
                delta = rate * (m1[k] / (1 - 0.9**step)) / (np.sqrt(m2[k] / (1 - 0.99**step)) + 1e-8)
                if k == "out_bias":
                    net.out_bias -= float(delta)
                else:
                    params[k] -= delta.astype(np.float32)
    return net


def _backward(net: Network, data: np.ndarray, y: float, weight: float, grads: dict) -> None:
    half, where = _maxima(net, data, positions=True)
    if len(half) > 1:
        later = half[1:] > half[:-1]
        m, w = np.where(later, half[1:], half[:-1]), np.where(later, where[1:], where[:-1])
    else:
        m, w = half, where
    pooled = np.tanh(m + net.bias)
    top = pooled.argmax(0)
    x = (np.concatenate([pooled.mean(0), pooled[top, np.arange(FILTERS)]]) - net.centre) / net.spread
    p = 1.0 / (1.0 + np.exp(-np.clip(float(x @ net.out) + net.out_bias, -30, 30)))
    d = weight * (p - y)
    grads["out"] += d * x
    grads["out_bias"] += d
    dx = d * net.out / net.spread
    g = np.repeat(dx[None, :FILTERS] / len(pooled), len(pooled), 0)
    g[top, np.arange(FILTERS)] += dx[FILTERS:]
    g = (g * (1 - pooled**2)).astype(np.float32)  # chunk x filter
    grads["bias"] += g.sum(0)
    windows = data[w[..., None] + np.arange(WIDTH)]  # chunk x filter x width
    x = net.embedding[windows].reshape(len(g), FILTERS, WIDTH * EMBED)
    grads["filters"] += np.einsum("cf,cfk->kf", g, x)
    back = g[..., None] * net.filters.T[None]  # chunk x filter x width*embed
    np.add.at(grads["embedding"], windows.reshape(-1), back.reshape(-1, EMBED))


def fit_network(docs: DataFrame, labels: DataFrame, allowed, label_column: str = "quality") -> Network:
    return fit(*labelled_sample(docs, labels, label_column, allowed, (FIT_PER_CLASS, FIT_PER_CLASS), FIT_CHARS))


def score(docs: DataFrame, net: Network) -> DataFrame:
    """``docs`` with a column ``score``: the probability of label 1, from the whole text alone. A column of this
    name gives way."""
    shared = bound_batches(docs).sparkSession.sparkContext.broadcast(net)  # a few thousand numbers

    @F.pandas_udf("double")
    def probabilities(texts):
        import pandas as pd

        return pd.Series([probability(shared.value, t) for t in texts], dtype="float64")

    kept = [F.col(f"`{c}`") for c in docs.columns if c != "score"]
    return docs.select("*", probabilities(F.col("text")).alias("__score")).select(*kept, F.col("__score").alias("score"))
