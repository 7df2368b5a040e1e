"""Quality classifier: attention-based multiple-instance learning.

A document is a bag of passages (runs of ``PASSAGE_WORDS`` words).  Every
passage is encoded from its bytes: hashed byte trigrams and a few shares
(capitals, digits, symbols, non-ASCII bytes, word length, repeated words) go
through one learned tanh layer.  A gated attention network, learned from the
document labels alone, weighs the passages of a document (softmax of
``w . (tanh(V e) * sigmoid(U e))``); the weighted passage representation is
scored by a logistic output.

The fit uses at most ``max_fit_docs`` labelled documents (default 4,000), each
with all its passages, and at most ``max_fit_passages`` passages in all (default
200,000: 105 MB in the driver): documents are taken in the order of a hash of id
and text while their passages fit, others are left out whole.  Passages are
encoded once, into the shared folder; the driver adds up the gradients of runs of
at most ``FIT_PASSAGES`` passages, a longer document in several runs.  Scoring encodes every passage of every whole text, piece by
piece with a running softmax.  So both need bounded memory for any length of
text.  For a third of the documents of either class the fit also takes a run of
1 to 15 of their words as a document of its own with the same label (few
labelled texts are that short, and length alone must not tell the classes
apart; a run of a bad text may miss what made it bad).

Edge cases: a null text counts as empty; a text without a word is one empty
passage and gets a score like any other; repeated rows are each scored; a
label table that is empty or has one class gives the smoothed class share
for every row; in the fit, rows equal in id and text count once; extra columns
are ignored.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from starbuild.llm.common import label_sample, text_or_empty, written

PASSAGE_WORDS = 64
#: Words encoded at a time (a whole number of passages).
PIECE_WORDS = PASSAGE_WORDS * 256
#: Passages whose gradients are computed at a time in the fit.
FIT_PASSAGES = 8192
#: A longer run without white space is cut into words of this many bytes.
WORD_BYTES = 4096
BUCKETS = 256
STATS = 6
INPUTS = BUCKETS + STATS

_CLASS = np.zeros(256, np.int64)                       # 1 capital, 2 digit, 3 symbol, 4 non-ASCII
_CLASS[65:91] = 1
_CLASS[48:58] = 2
_CLASS[[c for c in range(33, 127) if not chr(c).isalnum()]] = 3
_CLASS[128:] = 4


@dataclass(frozen=True)
class QualityModel:
    encode: np.ndarray      # INPUTS x hidden
    encode_bias: np.ndarray
    attend_v: np.ndarray    # hidden x gate
    attend_u: np.ndarray
    attend_w: np.ndarray    # gate
    out: np.ndarray         # hidden
    out_bias: float


def _pieces(text: str) -> Iterator[list[bytes]]:
    words: list[bytes] = []
    for m in re.finditer(rb"[^\x20\x09-\x0D]+", text.encode("utf-8", "replace")):
        w = m.group()
        for at in range(0, len(w), WORD_BYTES):
            words.append(w[at:at + WORD_BYTES])
            if len(words) == PIECE_WORDS:
                yield words
                words = []
    if words:
        yield words


def passage_inputs(words: list[bytes]) -> np.ndarray:
    """One input row per passage of these words."""
    n = -(-len(words) // PASSAGE_WORDS)
    a = np.frombuffer(b" ".join(words) + b" ", np.uint8)
    blank = a == 32
    # a word of the list holds no blank, so blanks count words
    own = (np.cumsum(blank) - blank) // PASSAGE_WORDS
    x = np.zeros((n, INPUTS), np.float32)
    b = a.astype(np.uint32)
    if len(b) > 2:
        h = ((b[:-2] << np.uint32(16)) | (b[1:-1] << np.uint32(8)) | b[2:]) * np.uint32(0x9E3779B1)
        slot = own[:-2] * BUCKETS + (h >> np.uint32(24))
        grams = np.bincount(slot[own[:-2] == own[2:]], minlength=n * BUCKETS)   # inside one passage
        grams = np.sqrt(grams.reshape(n, BUCKETS).astype(np.float32))
        x[:, :BUCKETS] = grams / np.maximum(np.linalg.norm(grams, axis=1, keepdims=True), 1e-6)
    size = np.maximum(np.bincount(own, minlength=n), 1)
    kinds = np.bincount(own * 5 + _CLASS[a], minlength=n * 5).reshape(n, 5)
    x[:, BUCKETS:BUCKETS + 4] = kinds[:, 1:] / size[:, None]
    for i in range(n):
        run = words[i * PASSAGE_WORDS:(i + 1) * PASSAGE_WORDS]
        x[i, BUCKETS + 4] = min(size[i] / len(run) / 16.0, 4.0)
        x[i, BUCKETS + 5] = 1.0 - len(set(run)) / len(run)
    return x


def _sigmoid(z):
    return 1.0 / (1.0 + np.exp(-np.clip(z, -30, 30)))


def score_text(m: QualityModel, text: str) -> float:
    """Score of a whole text; pieces are merged with a running softmax."""
    top, total, sums = -np.inf, 0.0, np.zeros(m.out.shape[0])
    seen = False
    for words in _pieces(text):
        top, total, sums = _pool(m, passage_inputs(words), top, total, sums)
        seen = True
    if not seen:
        top, total, sums = _pool(m, np.zeros((1, INPUTS), np.float32), top, total, sums)
    return float(_sigmoid(float(sums / total @ m.out) + m.out_bias))


def _pool(m: QualityModel, x: np.ndarray, top: float, total: float, sums: np.ndarray):
    e = np.tanh(x @ m.encode + m.encode_bias)
    a = (np.tanh(e @ m.attend_v) * _sigmoid(e @ m.attend_u)) @ m.attend_w
    new = max(top, float(a.max()))
    scale = np.exp(top - new) if total else 0.0
    part = np.exp(a - new)
    return new, total * scale + float(part.sum()), sums * scale + part @ e


def fit_bags(bags: list[np.ndarray], y: np.ndarray, hidden: int = 32, gate: int = 16,
             epochs: int = 30, batch: int = 256, rate: float = 0.01, seed: int = 5) -> QualityModel:
    """Fit encoder, gated attention and output together by Adam on the
    logistic loss of the document labels."""
    rng = np.random.default_rng(seed)
    n = len(bags)
    share = (float(y.sum()) + 0.5) / (n + 1.0)
    p = [rng.normal(0, 1 / np.sqrt(INPUTS) * 3, (INPUTS, hidden)), np.zeros(hidden),
         rng.normal(0, 1 / np.sqrt(hidden), (hidden, gate)), rng.normal(0, 1 / np.sqrt(hidden), (hidden, gate)),
         rng.normal(0, 1 / np.sqrt(gate), gate), rng.normal(0, 1 / np.sqrt(hidden), hidden),
         np.array(np.log(share / (1 - share)))]
    if n == 0 or y.min() == y.max():
        p[5] = np.zeros(hidden)
        return QualityModel(*p[:6], float(p[6]))
    m, s, t = [np.zeros_like(a) for a in p], [np.zeros_like(a) for a in p], 0
    for epoch in range(epochs):
        step_rate = rate * (1 - epoch / epochs) + rate * 0.05
        order = rng.permutation(n)
        for at in range(0, n, batch):
            pick = order[at:at + batch]
            grads = _gradients(p, [bags[i] for i in pick], y[pick])
            t += 1
            for i, g in enumerate(grads):
                m[i] = 0.9 * m[i] + 0.1 * g
                s[i] = 0.999 * s[i] + 0.001 * g * g
                p[i] = p[i] - step_rate * (m[i] / (1 - 0.9 ** t)) / (np.sqrt(s[i] / (1 - 0.999 ** t)) + 1e-8)
    return QualityModel(*p[:6], float(p[6]))


def _gradients(p: list[np.ndarray], bags: list[np.ndarray], y: np.ndarray) -> list[np.ndarray]:
    """Gradients of the mean loss of these bags, summed over runs of passages."""
    sums = [np.zeros_like(a) for a in p]
    sums[0] += 1e-5 * p[0]
    sizes, at = [len(b) for b in bags], 0
    while at < len(bags):
        end, n = at + 1, sizes[at]
        while end < len(bags) and n + sizes[end] <= FIT_PASSAGES:
            n, end = n + sizes[end], end + 1
        part = _run_gradients if n <= FIT_PASSAGES else _long_gradients
        for total, g in zip(sums, part(p, bags[at:end], y[at:end], len(bags)), strict=True):
            total += g
        at = end
    return sums


def _attention(p: list[np.ndarray], x: np.ndarray):
    e = np.tanh(x @ p[0] + p[1])
    tv, su = np.tanh(e @ p[2]), _sigmoid(e @ p[3])
    return e, tv, su, (tv * su) @ p[4]


def _run_gradients(p: list[np.ndarray], bags: list[np.ndarray], y: np.ndarray, n: int) -> list[np.ndarray]:
    """Share of whole bags in the gradients of a batch of ``n``."""
    x = np.concatenate(bags).astype(np.float32)
    lens = np.array([len(b) for b in bags])
    start, own = np.cumsum(lens) - lens, np.repeat(np.arange(len(bags)), lens)
    e, tv, su, a = _attention(p, x)
    a = np.exp(a - np.maximum.reduceat(a, start)[own])
    a /= np.add.reduceat(a, start)[own]
    z = np.add.reduceat(a[:, None] * e, start)
    err = (_sigmoid(z @ p[5] + p[6]) - y) / n
    return [*_passage_gradients(p, x, e, tv, su, a, z[own], (err[:, None] * p[5])[own]), z.T @ err, err.sum()]


def _long_gradients(p: list[np.ndarray], bags: list[np.ndarray], y: np.ndarray, n: int) -> list[np.ndarray]:
    """The same for one bag of any length: once through its passages for the
    pooled representation, once for the gradients."""
    (bag,), (label,) = bags, y
    model = QualityModel(*p)
    runs = range(0, len(bag), FIT_PASSAGES)
    top, total, sums = -np.inf, 0.0, np.zeros(len(p[5]))
    for at in runs:
        top, total, sums = _pool(model, bag[at:at + FIT_PASSAGES].astype(np.float32), top, total, sums)
    z = sums / total
    err = (_sigmoid(z @ p[5] + p[6]) - label) / n
    out = [np.zeros_like(a) for a in p[:5]]
    for at in runs:
        x = bag[at:at + FIT_PASSAGES].astype(np.float32)
        e, tv, su, a = _attention(p, x)
        for into, g in zip(out, _passage_gradients(p, x, e, tv, su, np.exp(a - top) / total, z, err * p[5]), strict=True):
            into += g
    return [*out, z * err, err]


def _passage_gradients(p: list[np.ndarray], x, e, tv, su, a, z, dz) -> list[np.ndarray]:
    """Back from the pooled representation ``z`` (gradient ``dz``) to encoder
    and attention, for passages ``x`` with attention weights ``a``."""
    da = a * ((e - z) * dz).sum(1)
    dt = da[:, None] * p[4] * su * (1 - tv * tv)
    ds = da[:, None] * p[4] * tv * su * (1 - su)
    de = (a[:, None] * dz + dt @ p[2].T + ds @ p[3].T) * (1 - e * e)
    return [x.T @ de, de.sum(0), e.T @ dt, e.T @ ds, (tv * su).T @ da]


def fit(documents: DataFrame, labels: DataFrame, label: str = "quality", folds: int = 5,
        held: int = 0, max_fit_docs: int = 4000, max_fit_passages: int = 200_000,
        id_col: str = "doc_id", text_col: str = "text") -> QualityModel:
    """Learn from at most ``max_fit_docs`` labelled texts outside fold ``held``
    with at most ``max_fit_passages`` passages."""
    chosen = label_sample(labels, label, folds, held, max_fit_docs, id_col)

    @pandas_udf("n long, bag binary, part binary")
    def encode(texts: pd.Series) -> pd.DataFrame:
        def one(text: str) -> tuple[int, bytes | None, bytes | None]:
            n, bag, part, rng = 0, [], None, np.random.default_rng(zlib.crc32(text.encode("utf-8", "replace")))
            for words in _pieces(text):
                n += -(-len(words) // PASSAGE_WORDS)
                if n > max_fit_passages:
                    return n, None, None
                bag.append(passage_inputs(words))
                if part is None and rng.random() < 0.35:
                    size = int(rng.integers(1, 16))
                    at = int(rng.integers(0, max(1, len(words) - size + 1)))
                    part = passage_inputs(words[at:at + size]).astype(np.float16).tobytes()
            bag = np.concatenate(bag or [np.zeros((1, INPUTS), np.float32)])
            return max(n, 1), bag.astype(np.float16).tobytes(), part
        return pd.DataFrame([one(t) for t in texts], columns=["n", "bag", "part"])

    # the sample is at most max_fit_docs rows of (id, y)
    bags = (documents.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
            .join(F.broadcast(chosen), "id").dropDuplicates(["id", "text"])
            .select("id", "y", F.xxhash64("id", "text").alias("h"), encode("text").alias("b")).select("id", "y", "h", "b.*"))
    bags = written(bags, "bags")
    taken, left = [], max_fit_passages
    for r in bags.where("bag is not null").select("h", "id", "n").orderBy("h", "id", "n").limit(max_fit_docs).collect():
        if r.n <= left:
            taken.append(r.h)
            left -= r.n
    index = []
    for r in bags.where(F.col("h").isin(taken)).toLocalIterator() if taken else ():
        for is_part, bag in enumerate((r.bag, r.part)):
            if bag is not None:
                index.append((is_part, r.id, r.y, hashlib.sha256(bag).digest(), bytes(bag)))
    index.sort()                                        # in any order of tasks
    return fit_bags([np.frombuffer(bag, np.float16).reshape(-1, INPUTS) for *_, bag in index],
                    np.array([y for _, _, y, *_ in index], float))


def score_column(documents: DataFrame, model: QualityModel, text_col: str = "text") -> Column:
    """Score (0 to 1) of the whole text; the model is a few thousand numbers."""
    shared = documents.sparkSession.sparkContext.broadcast(model)

    @pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield texts.map(lambda t: score_text(shared.value, t)).astype("float64")

    return score(text_or_empty(text_col))
