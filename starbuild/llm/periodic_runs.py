"""Periodic runs of words, found with string synchronising sets.

A run is a stretch of consecutive words with smallest period q that no
neighbouring word extends keeping q, of at least ``max(least, 2 * q)`` words.
The runs of many documents are searched at once: words become numbers, texts
are laid end to end with a number of its own between any two (no stretch with
a period crosses one).

* **Small periods** (up to ``3 * BASE - 1``) are read off directly: for each
  period p the maximal stretches whose words equal those p later.  They are
  also the highly periodic regions that the larger scales leave out.
* **Dyadic scales** t = BASE, 2 * BASE, ... propose the periods from 3t to
  below 6t.  Every t-word window has a pseudorandom number that depends on its
  words alone (built by doubling).  Windows inside a known run of a period of
  at most t / 3 are highly periodic and left out.  A position i is selected if
  the least number among the windows that start in [i, i + t] is that of i or
  i + t: whether i is selected depends on the words [i, i + 2t) only, and every
  stretch of 3t - 1 words that is not highly periodic has a selected position
  in its first t.  Two selected positions with the same next 2t words, 3t to
  below 6t apart, propose their distance.
* **Junctions**: what a run of period q can hide from equal contexts is a root
  that is itself highly periodic, with one break in the middle of the run.
  There two runs of one smaller period overlap or touch, and all distances
  that bring their phases together are proposed.

Every proposed pair of positions is extended to both sides word by word, so a
run is exact whatever the numbers collide; positions inside a stretch that was
already extended for the same period are not extended again.  Of the periods
found for one stretch the least is kept.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starbuild.llm.common import text_or_empty

#: Shortest window; periods below 3 * BASE are read off directly.
BASE = 4
#: Shortest run in words.
LEAST = 12
#: Words that are searched together (a longer text is searched alone).
BATCH_WORDS = 200_000
_ODD = np.uint64(0x9E3779B97F4A7C15)
_TOP = np.uint64(0xFFFFFFFFFFFFFFFF)


def _mixed(x: np.ndarray) -> np.ndarray:
    """A pseudorandom permutation of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def _window_min(x: np.ndarray, width: int) -> np.ndarray:
    """Least value of every ``width`` neighbours, by blocks of that width."""
    n = len(x)
    full = np.full(-(-n // width) * width, _TOP)
    full[:n] = x
    blocks = full.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n - width + 1], ahead[width - 1:n])


def _stretches(same: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal stretches of true values."""
    edge = np.flatnonzero(np.diff(np.concatenate(([0], same.view(np.int8), [0]))))
    return edge[::2], edge[1::2]


def _equal_ahead(w: np.ndarray, i: int, j: int) -> int:
    """Number of equal words from i and j (i < j) on."""
    n, got, step = len(w), 0, 64
    while j + got < n:
        size = min(step, n - j - got)
        differ = w[i + got:i + got + size] != w[j + got:j + got + size]
        at = int(differ.argmax())
        if differ[at]:
            return got + at
        got, step = got + size, min(step * 2, 1 << 16)
    return got


def _equal_behind(w: np.ndarray, i: int, j: int) -> int:
    """Number of equal words before i and j (i < j)."""
    got, step = 0, 64
    while i - got > 0:
        size = min(step, i - got)
        differ = (w[i - got - size:i - got] != w[j - got - size:j - got])[::-1]
        at = int(differ.argmax())
        if differ[at]:
            return got + at
        got, step = got + size, min(step * 2, 1 << 16)
    return got


class _Found:
    """Runs by stretch, each with its least period; proposals go in by
    ascending period."""

    def __init__(self, words: np.ndarray):
        self.words = words
        self.period: dict[tuple[int, int], int] = {}

    def add(self, start: int, end: int, period: int) -> None:
        self.period.setdefault((start, end), period)

    def extend(self, i: int, period: int) -> tuple[int, int]:
        """The maximal stretch around words i and i + period; kept if it is a run."""
        start = i - _equal_behind(self.words, i, i + period)
        end = i + period + _equal_ahead(self.words, i, i + period)
        if end - start >= 2 * period:
            self.add(start, end, period)
        return start, end

    def propose(self, at: np.ndarray, gap: np.ndarray, covered: int) -> None:
        """Pairs (at, at + gap) of equal contexts of ``covered`` words."""
        order = np.lexsort((at, gap))
        at, gap = at[order], gap[order]
        # contexts that overlap or touch lie in one stretch: extend the first of each chain
        head = np.ones(len(at), bool)
        head[1:] = (gap[1:] != gap[:-1]) | (at[1:] - at[:-1] > covered)
        firsts = np.flatnonzero(head)
        ends = np.array([self.extend(int(at[k]), int(gap[k]))[1] for k in firsts], np.int64)
        # windows of equal numbers but different words may have broken a chain
        left = np.flatnonzero(at + gap >= ends[np.cumsum(head) - 1]) if len(at) else []
        for k in left:
            self.extend(int(at[k]), int(gap[k]))


def _small_periods(words: np.ndarray, found: _Found) -> None:
    """Adds the stretches that repeat a period below 3 * BASE at least twice;
    those too short for a run serve the first scales only."""
    for p in range(1, min(3 * BASE, len(words))):
        start, end = _stretches(words[p:] == words[:-p])
        keep = end + p - start >= max(2 * p, BASE)
        for s, e in zip(start[keep].tolist(), (end[keep] + p).tolist(), strict=True):
            found.add(s, e, p)


def _covered(n: int, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Positions inside at least one of the (non-empty) stretches."""
    step = np.zeros(n + 1, np.int32)
    np.add.at(step, start, 1)
    np.add.at(step, end, -1)
    return np.cumsum(step[:n]) > 0


def _scale(t: int, ids: np.ndarray, contexts: np.ndarray, found: _Found) -> None:
    """Proposes the periods from 3t to below 6t; ``ids`` number the t-word
    windows, ``contexts`` the 2t-word ones."""
    n = len(ids)
    bounds = [(s, e) for (s, e), q in found.period.items() if 3 * q <= t and e - s >= t]
    usable = ids.copy()
    if bounds:
        start, end = np.array(bounds, np.int64).T
        usable[_covered(n, start, end - t + 1)] = _TOP
    if n <= t:
        return
    least = _window_min(usable, t + 1)
    first, last = usable[:n - t], usable[t:]
    chosen = np.flatnonzero((least != _TOP) & ((least == first) | (least == last)))
    order = np.lexsort((chosen, contexts[chosen]))
    at, context = chosen[order], contexts[chosen][order]
    starts, gaps = [], []
    for apart in range(1, len(at)):
        gap = at[apart:] - at[:-apart]
        near = (context[apart:] == context[:-apart]) & (gap < 6 * t)
        if not near.any():
            break
        near &= gap >= 3 * t
        starts.append(at[:-apart][near])
        gaps.append(gap[near])
    if starts:
        found.propose(np.concatenate(starts), np.concatenate(gaps), 2 * t)


def _junctions(found: _Found) -> None:
    """Periods of runs whose root repeats a smaller period p: two runs of p
    overlap or touch, and q brings the phase of the first to the second."""
    words, by_period = found.words, {}
    for (s, e), p in found.period.items():
        by_period.setdefault(p, []).append((s, e))
    hits = set()
    for p, runs in by_period.items():
        for (s1, e1), (s2, e2) in pairwise(sorted(runs)):
            if s2 > e1:
                continue
            tail = words[e1 - p:e1]
            shift = next((y for y in range(s2, s2 + p) if y + p <= e2 and np.array_equal(words[y:y + p], tail)), None)
            if shift is None:
                continue
            most = min(e1 - s1, e2 - s2, (e2 - s1) // 2)
            first = (shift - (e1 - p)) % p
            hits.update((q, max(s1, s2 - q)) for q in range(first or p, most + 1, p) if q >= 3 * BASE)
    for q, i in sorted(hits):
        found.extend(i, q)


def runs_of(words: np.ndarray, longest: int | None = None, least: int = LEAST) -> np.ndarray:
    """``(start, length, period)`` of every run, by start and period.

    ``words`` are non-negative numbers; ``longest`` is the longest text among
    them (default: all are one text)."""
    n = len(words)
    longest = n if longest is None else longest
    found = _Found(words)
    if n:
        _small_periods(words, found)
        t = BASE
        ids = _mixed(words.astype(np.uint64) * _ODD + np.uint64(1))
        width = 1
        while width < t and len(ids) > width:
            ids = _mixed(ids[:-width] * _ODD + ids[width:])
            width *= 2
        while 6 * t <= longest and len(ids) > t:
            contexts = _mixed(ids[:-t] * _ODD + ids[t:])
            _scale(t, ids, contexts, found)
            ids, t = contexts, 2 * t
        _junctions(found)
    out = sorted((s, e - s, q) for (s, e), q in found.period.items() if e - s >= max(least, 2 * q))
    return np.array(out, np.int64).reshape(-1, 3)


def runs_of_texts(texts: list[np.ndarray], least: int = LEAST) -> list[np.ndarray]:
    """``runs_of`` for each text (word numbers), searched together."""
    if not texts:
        return []
    top = max((int(t.max()) for t in texts if len(t)), default=0) + 1
    parts, offset, at = [], [], 0
    for k, t in enumerate(texts):
        parts += [t, np.array([top + k], np.int64)]
        offset.append(at)
        at += len(t) + 1
    all_runs = runs_of(np.concatenate(parts), max(map(len, texts)), least)
    cut = np.searchsorted(all_runs[:, 0], [*offset, at])
    return [all_runs[a:b] - [o, 0, 0] for a, b, o in zip(cut[:-1], cut[1:], offset, strict=True)]


def _row(words: list[bytes], runs: np.ndarray) -> tuple:
    """The result columns of one text."""
    drop = np.zeros(len(words) + 1, np.int32)
    np.add.at(drop, runs[:, 0] + runs[:, 2], 1)
    np.add.at(drop, runs[:, 0] + runs[:, 1], -1)
    gone = np.cumsum(drop[:len(words)]) > 0
    collapsed = b" ".join([w for w, g in zip(words, gone.tolist(), strict=True) if not g] if gone.any() else words)
    lines = "".join(f"{s},{m},{q}\n" for s, m, q in runs.tolist())
    top = min(runs.tolist(), key=lambda r: (-r[1], r[0], r[2])) if len(runs) else (None, None, None)
    return (len(runs), *top, None if top[0] is None else 1000 * top[1] // top[2], int(gone.sum()),
            hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(collapsed).hexdigest())


def repeat_tail(words: list, number: int | None) -> list:
    """The texts that op13's contract changes: of a tenth of them (by ``number``,
    the checksum of the id) the words from a on repeat with a period."""
    n = len(words)
    if number is None or number % 10 or not n:
        return words
    g = number // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return (words[:a] + words[a:a + p] * ((n - a) // p + 1))[:n]


RESULT = ("n_runs long, start long, length long, period long, exponent_milli long, n_dropped long, "
          "runs_sha256 string, collapsed_sha256 string")


def periodic_runs(docs: DataFrame, change: str | None = None, id_col: str = "doc_id", text_col: str = "text",
                  least: int = LEAST) -> DataFrame:
    """``(id, n_runs, start, length, period, exponent_milli, n_dropped,
    runs_sha256, collapsed_sha256)`` of every row: the number of runs, the
    longest one (ties: smallest start, then period), words that repeat a
    run's first period, and digests of all runs and of the text without them.

    Words are parts between ASCII white space.  ``change`` is an SQL expression
    of a whole number that goes to ``repeat_tail`` (default: texts as they are).
    Texts are searched in groups of ``BATCH_WORDS`` words inside the tasks that
    read them; nothing is shuffled.  Memory grows with the longest text.

    Edge cases: null, empty and blank texts have no words, no runs (four nulls)
    and the digests of empty texts; repeated rows are judged each; an empty
    table gives an empty result; extra columns are ignored."""
    rows = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"),
                       (F.expr(change) if change else F.lit(None)).cast("long").alias("number"))

    def judge(held: list) -> pd.DataFrame:
        numbers: dict[bytes, int] = {}
        coded = [np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))
                 for _, words in held]
        found = [_row(words, runs) for (_, words), runs in zip(held, runs_of_texts(coded, least), strict=True)]
        out = pd.DataFrame(found, columns=[c.split()[0] for c in RESULT.split(", ")])
        for c in ("start", "length", "period", "exponent_milli"):
            out[c] = out[c].astype("Int64")
        out = out.astype({"runs_sha256": object, "collapsed_sha256": object})
        out.insert(0, "id", pd.array([i for i, _ in held], dtype=object))
        return out

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size = [], 0
        for batch in batches:
            ids = batch["id"].astype(object).where(batch["id"].notna(), None)
            numbers = batch["number"].astype(object).where(batch["number"].notna(), None)
            for i, text, number in zip(ids, batch["text"], numbers, strict=True):
                words = repeat_tail(text.encode().split(), None if number is None else int(number))
                if held and size + len(words) > BATCH_WORDS:
                    yield judge(held)
                    held, size = [], 0
                held.append((i, words))
                size += len(words) + 1
        if held:
            yield judge(held)

    id_type = rows.schema["id"].dataType.simpleString()
    return rows.mapInPandas(search, f"id {id_type}, {RESULT}")
