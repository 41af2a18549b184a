"""Language identification by cross-parsing entropy over suffix automata.

For each language a suffix automaton is built from labelled text (a bounded, documented sample). A
document is parsed greedily against it: from where a phrase begins, the longest match in the
language's text is followed, and the phrase ends with the first character that does not extend it.
The fewer phrases a language needs per character, the closer it is; phrases times the logarithm of
the language's sample length, over the document's length, estimates the cross entropy.

The automaton's transitions become one dense table per language, in which a missing transition holds
the restart at the root and a mark that a phrase ended. Many stretches of text are then parsed side by
side, one character of each per numpy step. Stretches of ``STRETCH`` characters cover the whole text.

Defined cases: null text, or no letter -> ``und`` and score 0; no labelled text -> ``und`` and score 0
for all; ties go to the language that sorts first; very long texts -> parsed in stretches, as all are;
repeated rows -> one result each; empty table -> no rows; extra columns are kept, but for those of the
result's names.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bound_batches
from .sampling import language_sample

#: Bounds of the fit: documents and characters per language, characters of a document, letters kept.
FIT_DOCS, FIT_LANGUAGE_CHARS, FIT_CHARS, ALPHABET = 200, 30_000, 20_000, 90
STRETCH = 512
#: Characters parsed together.
LANE_CHARS = 4 << 20
UNKNOWN, SPACE, PAD = 0, 1, 2
UNDETERMINED = "und"


@dataclass
class Model:
    languages: list[str] = field(default_factory=list)
    letters: str = ""
    tables: list[np.ndarray] = field(default_factory=list)
    lengths: list[int] = field(default_factory=list)

    @property
    def width(self) -> int:
        return len(self.letters) + 3


_LUT: dict[str, np.ndarray] = {}


def _codes_of(letters: str) -> np.ndarray:
    """Code of every code point: its lower-case letter's code, UNKNOWN for other letters, else SPACE."""
    if letters not in _LUT:
        lut = np.full(0x110000, SPACE, np.uint8)
        index = {c: k + 3 for k, c in enumerate(letters)}
        for i in range(0x110000):
            c = chr(i)
            if c.isalpha():
                lut[i] = index.get(c.lower()[0], UNKNOWN)
        _LUT.clear()
        _LUT[letters] = lut
    return _LUT[letters]


def encode(letters: str, text: str) -> np.ndarray:
    """Letter codes of a text; every run of other characters is one SPACE, none at either end."""
    codes = _codes_of(letters)[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")]
    gap = codes == SPACE
    keep = ~gap
    keep[1:] |= gap[1:] & ~gap[:-1]
    out = codes[keep]
    if len(out) and out[0] == SPACE:
        out = out[1:]
    return out[:-1] if len(out) and out[-1] == SPACE else out


def automaton(codes: list[int]) -> list[dict[int, int]]:
    """Transitions of the suffix automaton of a sequence; state 0 is the root."""
    step: list[dict[int, int]] = [{}]
    link, size, last = [-1], [0], 0
    for c in codes:
        new = len(step)
        step.append({})
        size.append(size[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in step[p]:
            step[p][c] = new
            p = link[p]
        if p >= 0:
            q = step[p][c]
            if size[p] + 1 == size[q]:
                link[new] = q
            else:
                twin = len(step)
                step.append(dict(step[q]))
                size.append(size[p] + 1)
                link.append(link[q])
                while p >= 0 and step[p].get(c) == q:
                    step[p][c] = twin
                    p = link[p]
                link[q] = link[new] = twin
        last = new
    return step


def dense(step: list[dict[int, int]], width: int) -> np.ndarray:
    """Table of (next state * width * 2 + 1 if a phrase ends here), by state * width + code."""
    out = np.zeros((len(step), width), np.int32)
    root = np.array([step[0].get(c, 0) for c in range(width)], np.int64)
    out[:] = root * width * 2 + 1
    for s, row in enumerate(step):
        for c, t in row.items():
            out[s, c] = t * width * 2
    out[:, PAD] = np.arange(len(step)) * width * 2
    return out.reshape(-1)


def fit(samples: dict[str, list[str]]) -> Model:
    texts = {}
    for language in sorted(samples):
        parts, n = [], 0
        for t in samples[language]:
            if n < FIT_LANGUAGE_CHARS and any(map(str.isalpha, t)):
                parts.append(t)
                n += len(t)
        if parts:
            texts[language] = "\n".join(parts)
    seen = Counter(c for t in texts.values() for c in t.lower() if c.isalpha())
    letters = "".join(sorted(c for c, _ in sorted(seen.items(), key=lambda x: (-x[1], x[0]))[:ALPHABET]))
    model = Model(languages=list(texts), letters=letters)
    for t in texts.values():
        codes = encode(letters, t)
        model.tables.append(dense(automaton(codes.tolist()), model.width))
        model.lengths.append(len(codes))
    return model


def phrases(model: Model, documents: list[np.ndarray]) -> np.ndarray:
    """Phrases that each document (row) needs in each language (column)."""
    out = np.zeros((len(documents), len(model.languages)))
    owner = np.repeat(np.arange(len(documents)), [-(-len(d) // STRETCH) for d in documents])
    lanes = np.full((len(owner), STRETCH), PAD, np.uint8)
    at = 0
    for d in documents:
        n = -(-len(d) // STRETCH)
        lanes[at : at + n].reshape(-1)[: len(d)] = d
        at += n
    columns = np.ascontiguousarray(lanes.T)
    used = int((columns != PAD).any(1).sum())
    for k, table in enumerate(model.tables):
        state, count = np.zeros(len(owner), np.int32), np.ones(len(owner), np.int32)
        for column in columns[:used]:
            found = table[state + column]
            count += found & 1
            state = found >> 1
        out[:, k] = np.bincount(owner, weights=count, minlength=len(documents))
    return out


def identify(model: Model, texts: list[str | None]) -> tuple[list[str], list[float]]:
    found, scores = [UNDETERMINED] * len(texts), [0.0] * len(texts)
    if not model.languages:
        return found, scores
    cost = np.log(np.array(model.lengths, dtype=float) + 2)

    def settle(rows: list[int], codes: list[np.ndarray]) -> None:
        total = phrases(model, codes) * cost  # nats to describe the document in each language
        best = total.argmin(1)
        share = 1.0 / np.exp(np.clip(0.25 * (total.min(1, keepdims=True) - total), -60, 0)).sum(1)
        for i, b, s in zip(rows, best, share):
            found[i], scores[i] = model.languages[int(b)], float(s)

    rows, codes, n = [], [], 0
    for i, text in enumerate(texts):
        if not text or len(c := encode(model.letters, text)) == 0:
            continue
        rows.append(i)
        codes.append(c)
        n += len(c) + STRETCH
        if n >= LANE_CHARS:
            settle(rows, codes)
            rows, codes, n = [], [], 0
    if rows:
        settle(rows, codes)
    return found, scores


def fit_model(docs: DataFrame, allowed) -> Model:
    return fit(language_sample(docs, allowed, FIT_DOCS, FIT_CHARS))


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with lang_pred and score, from the whole text alone; columns of these names give way."""
    shared = bound_batches(docs).sparkSession.sparkContext.broadcast(model)  # bounded by the fit's bounds

    @F.pandas_udf("lang_pred string, score double")
    def identified(texts):
        import pandas as pd

        languages, scores = identify(shared.value, texts.tolist())
        return pd.DataFrame({"lang_pred": languages, "score": scores})

    kept = [F.col(f"`{c}`") for c in docs.columns if c not in ("lang_pred", "score")]
    return docs.withColumn("__language", identified(F.col("text"))).select(*kept, "__language.lang_pred", "__language.score")
