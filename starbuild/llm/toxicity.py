"""Toxicity: linear classifier over character n-grams scaled by naive Bayes
log-count ratios.

Every whole text becomes the set of its character n-grams (orders 3 to 6 of
the lower-cased text with white space folded), hashed to ``2**bits`` buckets.
A bucket's value is its naive Bayes log-count ratio, from document counts of
the two classes smoothed in the proportion of the classes, so that a bucket
never seen has ratio 0; ratios within ``NOISE`` standard errors of 0 are set
to 0.  The vector is scaled to unit length, and a logistic regression on it
gives the score.

The fit uses at most ``max_fit_docs`` labelled documents (default 4,000),
chosen by a hash of the id among all labelled rows outside the held-out fold;
scoring covers every whole text of every document.

Edge cases: a null text counts as empty; a text without any n-gram (empty,
only white space gives the n-grams of one blank) scores the intercept alone;
repeated rows are each scored; an empty label table or one with a single
class gives the smoothed class share for every row; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from starbuild.llm.common import label_sample, text_or_empty

ORDERS = (3, 4, 5, 6)
#: Characters hashed at a time, so that one text's arrays stay small.
PIECE = 1 << 20
#: Ratios of fewer standard errors than this count as chance.
NOISE = 3.0
#: Documents' worth of smoothing, shared between the classes by their size.
SMOOTHING = 10.0


@dataclass(frozen=True)
class ToxicityModel:
    ratio: np.ndarray       # log-count ratio of each bucket
    weight: np.ndarray
    intercept: float
    bits: int


def _mark(codes: np.ndarray, seen: np.ndarray, bits: int) -> None:
    """Set the buckets of all n-grams of one piece."""
    h = codes.copy()
    for n in range(2, max(ORDERS) + 1):
        h = h[:-1] * np.uint32(0x01000193) + codes[n - 1:]
        if len(h) == 0:
            return
        if n in ORDERS:
            x = h ^ np.uint32(n * 0x5BD1E995 & 0xFFFFFFFF)
            x = (x ^ (x >> np.uint32(15))) * np.uint32(0x85EBCA6B)
            x ^= x >> np.uint32(13)
            x *= np.uint32(0x9E3779B1)
            seen[x >> np.uint32(32 - bits)] = True


def ngram_buckets(text: str, bits: int, seen: np.ndarray | None = None) -> np.ndarray:
    """Sorted buckets of the character n-grams of a whole text."""
    if seen is None:
        seen = np.zeros(1 << bits, bool)
    flat = " " + " ".join(text.lower().split()) + " "
    for at in range(0, max(1, len(flat)), PIECE):
        piece = flat[at:at + PIECE + max(ORDERS) - 1]
        _mark(np.frombuffer(piece.encode("utf-32-le", "replace"), np.uint32), seen, bits)
    out = np.flatnonzero(seen).astype(np.uint32)
    seen[out] = False
    return out


def _sigmoid(z):
    return 1.0 / (1.0 + np.exp(-np.clip(z, -30, 30)))


def fit_arrays(rows: list[np.ndarray], y: np.ndarray, bits: int, steps: int = 60,
               rate: float = 0.3) -> ToxicityModel:
    """Fit on bucket sets; ``y`` is 0 or 1."""
    size, n = 1 << bits, len(rows)
    share = (float(y.sum()) + 0.5) / (n + 1.0)
    bias = float(np.log(share / (1 - share)))
    if n == 0 or y.min() == y.max():
        return ToxicityModel(np.zeros(size), np.zeros(size), bias, bits)
    counts = np.zeros((2, size))
    for r, label in zip(rows, y):                      # a row has each bucket once
        counts[int(label), r] += 1
    extra = np.array([1 - share, share]) * SMOOTHING
    q, p = counts + extra[:, None]
    ratio = np.log(p / (y.sum() + extra[1])) - np.log(q / ((1 - y).sum() + extra[0]))
    ratio[np.abs(ratio) < NOISE * np.sqrt(1 / np.maximum(p, 0.5) + 1 / np.maximum(q, 0.5))] = 0.0
    told = [r[ratio[r] != 0] for r in rows]            # few buckets say anything
    idx, own = np.concatenate(told), np.repeat(np.arange(n), [len(r) for r in told])
    v = ratio[idx]
    v = v / (np.sqrt(np.bincount(own, weights=v * v, minlength=n)) + 1e-9)[own]
    w, m, s = np.zeros(size), np.zeros(size + 1), np.zeros(size + 1)
    for t in range(1, steps + 1):                      # Adam on the logistic loss
        g = (_sigmoid(np.bincount(own, weights=v * w[idx], minlength=n) + bias) - y) / n
        grad = np.append(np.bincount(idx, weights=v * g[own], minlength=size), g.sum())
        m = 0.9 * m + 0.1 * grad
        s = 0.99 * s + 0.01 * grad * grad
        step = rate * (m / (1 - 0.9 ** t)) / (np.sqrt(s / (1 - 0.99 ** t)) + 1e-8)
        w -= step[:-1]
        bias -= float(step[-1])
    return ToxicityModel(ratio, w, bias, bits)


def score_buckets(model: ToxicityModel, buckets: np.ndarray) -> float:
    v = model.ratio[buckets]
    norm = float(np.sqrt((v * v).sum())) + 1e-9
    return float(_sigmoid(float((v * model.weight[buckets]).sum()) / norm + model.intercept))


def fit(documents: DataFrame, labels: DataFrame, label: str = "toxic", folds: int = 3,
        held: int = 1, max_fit_docs: int = 4000, bits: int = 18,
        id_col: str = "doc_id", text_col: str = "text") -> ToxicityModel:
    """Learn from at most ``max_fit_docs`` labelled texts outside fold ``held``."""
    chosen = label_sample(labels, label, folds, held, max_fit_docs, id_col)

    @pandas_udf("binary")
    def buckets(texts: pd.Series) -> pd.Series:
        seen = np.zeros(1 << bits, bool)
        return texts.map(lambda t: ngram_buckets(t, bits, seen).tobytes())

    # the sample is at most max_fit_docs rows of (id, y)
    rows = (documents.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
            .join(F.broadcast(chosen), "id")
            .select("id", "y", buckets("text").alias("b")).toLocalIterator())
    got = sorted(((r.id, r.y, bytes(r.b)) for r in rows))   # order does not depend on tasks
    return fit_arrays([np.frombuffer(b, np.uint32) for _, _, b in got],
                      np.array([y for _, y, _ in got], float), bits)


def score_column(documents: DataFrame, model: ToxicityModel, text_col: str = "text") -> Column:
    """Score (0 to 1) of the whole text; the model has ``2**bits`` entries."""
    shared = documents.sparkSession.sparkContext.broadcast(model)

    @pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        m = shared.value
        seen = np.zeros(1 << m.bits, bool)
        for texts in batches:
            yield texts.map(lambda t: score_buckets(m, ngram_buckets(t, m.bits, seen))).astype("float64")

    return score(text_or_empty(text_col))
