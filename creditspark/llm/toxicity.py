"""Operator 6: toxicity by non-negative positive-unlabelled learning.

A linear classifier over hashed words and word beginnings, each by whether a text holds it once, twice or
``LEVELS`` times and more, is trained in numpy from confirmed toxic
examples (P) and unlabelled text (U). With class prior pi its risk is
``pi * E_P[l(f, +1)] + max(0, E_U[l(f, -1)] - pi * E_P[l(f, -1)])``: the negative part is corrected for
the toxic share of U and kept from going below zero. The prior is the toxic share among the labels that
may be learned from. The cut of the score is set where the same corrected estimate of the error is
least, and put at ``CUT``.

The classifier is fitted on at most ``MAX_POSITIVE`` and ``MAX_UNLABELLED`` rows, chosen by the hash of
their doc_id among rows that are not held out; its ``MAX_FEATURES`` features are those that tell P from
U best. Only these weights are broadcast. Every whole text is scored in the tasks.

Defined results: null or empty text: the score without any feature. Null doc_id: scored, not held out.
Repeated rows: each scored. No positive examples: score 0 for all. Empty table: no rows. Labels, lang,
source and doc_id are no input of a score; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import BASES, BYTE, U, Words, chunks, mix, span_hash

MAX_POSITIVE, MAX_UNLABELLED, MAX_FEATURES, MAX_CANDIDATES = 3_000, 9_000, 4_096, 65_536
CUT = 0.7
PREFIXES = (5, 6, 7)
LEVELS = 3
#: ASCII other than letters separates words.
_LETTERS_ONLY = bytes(c if chr(c).isalpha() and c < 128 or c >= 128 else 32 for c in range(256))


def features(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(text number, feature) of every word and word beginning of up to a chunk of texts."""
    raw = [t.lower().encode().translate(_LETTERS_ONLY) if isinstance(t, str) else b"" for t in texts]
    w = Words(raw)
    bytes_ = BYTE[w.buf]
    size = w.end - w.start
    got, of = [span_hash(bytes_, w.start, w.end, BASES[0])], [w.text_of]
    for k in PREFIXES:
        long = np.flatnonzero(size >= k)
        start = w.start[long]
        got.append(mix(span_hash(bytes_, start, start + k, BASES[1]) + U(k)))
        of.append(w.text_of[long])
    return np.concatenate(of), np.concatenate(got)


def _levels(of: np.ndarray, feature: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, feature, level): the first ``LEVELS`` occurrences of each feature in each text."""
    order = np.lexsort((feature, of))
    of, feature = of[order], feature[order]
    new = np.ones(len(of), bool)
    new[1:] = (of[1:] != of[:-1]) | (feature[1:] != feature[:-1])
    first = np.flatnonzero(new)
    level = np.arange(len(of)) - np.repeat(first, np.diff(np.append(first, len(of))))
    some = level < LEVELS
    return of[some], feature[some], level[some]


class Vocabulary:
    """Finds known features among many, by a bit table and then binary search."""

    def __init__(self, known: np.ndarray):
        self.known = np.sort(known)
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[(self.known & U((1 << 20) - 1)).astype(np.int64)] = True

    def find(self, of: np.ndarray, feature: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(text number, LEVELS * index of the feature + level), each pair once."""
        some = np.flatnonzero(self.maybe[(feature & U((1 << 20) - 1)).astype(np.int64)])
        of, feature = of[some], feature[some]
        at = np.minimum(np.searchsorted(self.known, feature), max(len(self.known) - 1, 0))
        hit = self.known[at] == feature if len(self.known) else np.zeros(0, bool)
        of, at, level = _levels(of[hit], at[hit].astype(np.int64))
        return of, at * LEVELS + level


def _of_batches(frames: Iterator[pd.DataFrame]) -> Iterator[tuple[pd.DataFrame, np.ndarray, np.ndarray]]:
    for frame in frames:
        texts = [t if isinstance(t, str) else "" for t in frame["text"]]
        for i, j in chunks(texts):
            yield frame.iloc[i:j], *features(texts[i:j])


def _listed(frames: Iterator[pd.DataFrame], known: np.ndarray | None) -> Iterator[pd.DataFrame]:
    vocabulary = None if known is None else Vocabulary(known)
    for frame, of, feature in _of_batches(frames):
        of, got = _levels(of, feature)[:2] if vocabulary is None else vocabulary.find(of, feature)
        got = got.view(np.int64) if vocabulary is None else got
        parts = np.split(got.astype("<i8"), np.cumsum(np.bincount(of, minlength=len(frame)))[:-1])
        yield pd.DataFrame({"doc_id": frame["doc_id"].to_numpy(), "features": [x.tobytes() for x in parts]})


def held_out() -> Column:
    """crc32 of the doc_id as text, modulo 3, is 1."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _sample(ids: DataFrame, most: int) -> DataFrame:
    return ids.select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)


@dataclass
class Model:
    known: np.ndarray
    weights: np.ndarray
    bias: float

    def score(self, of: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
        return self.bias + np.bincount(of, self.weights[at], n) if len(of) else np.full(n, self.bias)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(z / 2))


def fit_nnpu(p: list[np.ndarray], u: list[np.ndarray], n_features: int, prior: float, steps: int = 400, rate: float = 0.05, decay: float = 1e-3) -> tuple[np.ndarray, float]:
    """Weights and bias; p and u list each example's features. Full-batch Adam on the logistic risk."""

    def flat(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        return np.repeat(np.arange(len(rows)), [len(r) for r in rows]), np.concatenate([np.zeros(0, np.int64), *rows]).astype(np.int64)

    (pi, pf), (ui, uf) = flat(p), flat(u)
    w, m, v = np.zeros(n_features + 1), np.zeros(n_features + 1), np.zeros(n_features + 1)

    def back(of: np.ndarray, feature: np.ndarray, g: np.ndarray) -> np.ndarray:
        return np.append(np.bincount(feature, g[of], n_features), g.sum())

    for t in range(1, steps + 1):
        fp = w[-1] + np.bincount(pi, w[pf], len(p))
        fu = w[-1] + np.bincount(ui, w[uf], len(u))
        negative = np.logaddexp(0, fu).mean() - prior * np.logaddexp(0, fp).mean()
        g_neg = back(ui, uf, _sigmoid(fu) / len(u)) - prior * back(pi, pf, _sigmoid(fp) / len(p))
        g = -g_neg if negative < 0 else g_neg + prior * back(pi, pf, (_sigmoid(fp) - 1) / len(p))
        g[:-1] += decay * w[:-1]
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return w[:-1], float(w[-1])


def _cut_at(fp: np.ndarray, fu: np.ndarray, prior: float) -> float:
    """The threshold of least corrected error, in the middle of the widest gap that has it."""
    values = np.unique(np.concatenate([fp, fu]))
    if len(values) < 2:
        return float(values[0]) + 1 if len(values) else 0.0
    missed = np.searchsorted(np.sort(fp), values[1:]) / len(fp)
    called = 1 - np.searchsorted(np.sort(fu), values[1:]) / len(fu)
    error = prior * missed + np.maximum(0, called - prior * (1 - missed))
    good = np.flatnonzero(error <= error.min() + 1e-12)
    k = good[np.argmax(values[1:][good] - values[:-1][good])]
    return float((values[k] + values[k + 1]) / 2)


def train(docs: DataFrame, labels: DataFrame) -> Model | None:
    """The classifier, or None if there is no confirmed toxic document to learn from."""
    texts = docs.select(F.col("doc_id").cast("long"), "text").where("doc_id is not null")
    may = labels.select(F.col("doc_id").cast("long"), "toxic").where("doc_id is not null").where(~held_out())
    share = may.where("toxic in (0, 1)").agg(F.avg("toxic")).first()[0]
    if not share:
        return None
    prior = float(min(share, 0.9))

    def listed(ids: DataFrame, known: np.ndarray | None) -> list[np.ndarray]:
        rows = texts.join(F.broadcast(ids), "doc_id").mapInPandas(
            lambda frames: _listed(frames, known), "doc_id long, features binary"
        )
        got = sorted(rows.collect(), key=lambda r: (r.doc_id, len(r.features)))  # as many as sampled
        return [np.frombuffer(r.features, "<i8") for r in got]

    p = listed(_sample(may.where("toxic = 1"), MAX_POSITIVE), None)
    if not p:
        return None
    seen, times = np.unique(np.concatenate([np.unique(x) for x in p]), return_counts=True)
    often = np.flatnonzero(times >= max(3, len(p) // 500))
    often = often[np.argsort(-times[often], kind="stable")][:MAX_CANDIDATES]
    known = np.sort(seen[often].view(U))
    u = listed(_sample(texts.select("doc_id").where(~held_out()), MAX_UNLABELLED), known)
    place = Vocabulary(known)
    p = [place.find(np.zeros(len(x), np.int64), x.view(U))[1] for x in p]
    in_p = np.bincount(np.concatenate(p), minlength=LEVELS * len(known)) / len(p)
    in_u = np.bincount(np.concatenate([np.zeros(0, np.int64), *u]), minlength=LEVELS * len(known)) / max(len(u), 1)
    in_n = np.maximum(in_u - prior * in_p, 0) / (1 - prior)  # what U says of text that is not toxic
    spread = np.sqrt((in_p * (1 - in_p) + 1e-4) / len(p) + (in_n + 1e-4) / max(len(u), 1))
    apart = (in_p - in_n) / spread
    best = np.sort(np.argsort(-apart, kind="stable")[: min(MAX_FEATURES, int((apart > 4).sum()))])
    index = np.full(LEVELS * len(known), -1)
    index[best] = np.arange(len(best))
    chosen = lambda rows: [index[x][index[x] >= 0] for x in rows]
    p, u = chosen(p), chosen(u)
    weights, bias = fit_nnpu(p, u, len(best), prior)
    score = lambda rows: np.array([bias + weights[x].sum() for x in rows])
    bias += float(np.log(CUT / (1 - CUT))) - _cut_at(score(p), score(u), prior)
    bases = np.unique(best // LEVELS)
    table = np.zeros((len(known), LEVELS))
    table.ravel()[best] = weights
    return Model(known[bases], table[bases].ravel(), bias)


def _scored(frames: Iterator[pd.DataFrame], model: Model | None) -> Iterator[pd.DataFrame]:
    vocabulary = Vocabulary(model.known) if model else None
    for frame, of, feature in _of_batches(frames):
        z = model.score(*vocabulary.find(of, feature), len(frame)) if model else np.full(len(frame), -np.inf)
        yield pd.DataFrame({"doc_id": frame["doc_id"].astype("Int64").to_numpy(), "score": _sigmoid(z)})


def scores(docs: DataFrame, model: Model | None) -> DataFrame:
    """(doc_id, score) for each row of ``docs(doc_id, text)``."""
    rows = docs.select(F.col("doc_id").cast("long"), "text")
    return rows.mapInPandas(lambda frames: _scored(frames, model), "doc_id long, score double")
