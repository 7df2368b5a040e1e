"""Quality rules with risk-controlled thresholds.

Every rule compares one measure of a document (a whole number per thousand)
with a cutoff and rejects what lies above it.  Cutoffs are not set by hand:
labelled holdout documents that pass the base rules and are marked good show
how many of them a cutoff would reject, and a cutoff may be used in a stratum
only if an exact binomial bound says that it rejects at most its share of the
risk there.

* Risk: at most ``risk`` of a stratum's good documents may be rejected by all
  rules together; each of the R rules gets ``risk / R``.
* Bound: with k of n good documents above the cutoff, the cutoff is certified
  if P(Bin(n, risk / R) <= k) is at most its level, that is if the exact
  (Clopper-Pearson) upper bound of the rejection rate is within the share.
* Multiple testing: the error ``delta`` is split evenly over all (stratum,
  rule) pairs (Bonferroni); inside a pair the cutoffs are tested from the
  loosest to the strictest and testing stops at the first that fails (fixed
  sequence), which keeps the pair's level.

The strictest certified cutoff is used; a pair without one has no cutoff and
rejects nothing, so a stratum with too few labels keeps its documents.

Edge cases: a null text has no words and fails the base rules; a null stratum
is a stratum of its own; labels that are null or contradict each other are
left out; repeated rows are judged each (and count once per row in the
holdout); without labels nothing but the base rules rejects; an empty table
gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from starbuild.llm.common import checkpointed, heavy_keys, spread_join, text_or_empty, written

#: The symbols that are counted, and the ASCII white space between words.
SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\x0b\x0c\r"
WINDOW = 5
_NOT_CAPITAL = bytes(b for b in range(256) if not 65 <= b <= 90)

#: Cutoffs per thousand, strictest first, tried for every rule.
CUTOFFS = (5, 10, 20, 30, 50, 75, 100, 150, 200, 250, 300, 400, 500, 600, 700, 800, 900, 1000)


def _pairs(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Equal numbers for equal pairs."""
    return np.unique(a.astype(np.int64) << 32 | b, return_inverse=True)[1]


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a WINDOW-word run found twice or more."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    known: dict[bytes, int] = {}
    ids = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words))
    two = _pairs(ids[:-1], ids[1:])
    four = _pairs(two[:-2], two[2:])
    runs = _pairs(four[:n], ids[WINDOW - 1:])
    again = np.bincount(runs)[runs] > 1
    edges = np.zeros(len(words) + 1, np.int64)
    edges[:n] += again
    edges[WINDOW:] -= again
    return int((np.cumsum(edges)[:-1] > 0).sum())


def measures(text: str) -> tuple[int, ...]:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines,
    n_capitals) of a whole text."""
    raw = text.encode("utf-8", "replace")
    words = raw.split()                                # bytes: the six ASCII blanks only
    lines = [x for x in text.split("\n") if x.strip(BLANKS)]
    return (len(words), len(text) - sum(map(text.count, BLANKS)), sum(map(text.count, SYMBOLS)),
            len(lines) - len(set(lines)), repeated_words(words), len(lines),
            len(raw.translate(None, _NOT_CAPITAL)))


COLUMNS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_capitals")


def measured(documents: DataFrame, stratum: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, stratum, measures..., base_failed)`` of every row."""
    @pandas_udf(", ".join(f"{c} long" for c in COLUMNS))
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield pd.DataFrame([measures(t) for t in texts], columns=COLUMNS, dtype="int64")

    return (documents.select(F.col(id_col).alias("id"), F.coalesce(F.concat(F.lit("s"), stratum.cast("string")),
                                                                   F.lit("n")).alias("stratum"),
                             of(text_or_empty(text_col)).alias("m")).select("id", "stratum", "m.*")
            .withColumn("base_failed", (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))))


def _share(part: str, whole: str) -> Column:
    return F.when(F.col(whole) > 0, F.floor(F.col(part) * 1000 / F.col(whole))).otherwise(0).cast("long")


def rules() -> dict[str, Column]:
    """Measures per thousand; more is worse."""
    return {"symbols": _share("n_symbols", "n_words"), "capitals": _share("n_capitals", "word_chars"),
            "dup_lines": _share("n_dup_lines", "n_lines"), "repeats": _share("n_repeat_words", "n_words")}


def tail(k: int, n: int, p: float) -> float:
    """P(Bin(n, p) <= k), summed from the largest term down."""
    if k >= n:
        return 1.0
    if k > n * p:
        return 1.0 - tail_above(k, n, p)
    term = math.exp(math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1)
                    + k * math.log(p) + (n - k) * math.log1p(-p))
    total = 0.0
    while k >= 0 and term > total * 1e-17:
        total += term
        term *= k * (1 - p) / ((n - k + 1) * p)
        k -= 1
    return min(1.0, total)


def tail_above(k: int, n: int, p: float) -> float:
    """P(Bin(n, p) > k) for k above the mean."""
    k += 1
    term = math.exp(math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1)
                    + k * math.log(p) + (n - k) * math.log1p(-p))
    total = 0.0
    while k <= n and term > total * 1e-17:
        total += term
        term *= (n - k) * p / ((k + 1) * (1 - p))
        k += 1
    return min(1.0, total)


def certified(above: list[int], n: int, share: float, level: float) -> int | None:
    """Index of the strictest certified cutoff; ``above[i]`` good documents lie
    above cutoff i (strictest first)."""
    best = None
    for i in range(len(above) - 1, -1, -1):            # loosest first
        if n == 0 or tail(above[i], n, share) > level:
            break
        best = i
    return best


def cutoffs(rows: DataFrame, labels: DataFrame, label: str = "quality", risk: float = 0.02,
            delta: float = 0.05, id_col: str = "doc_id") -> DataFrame:
    """``(stratum, n_good, cut_<rule>...)`` from ``measured`` rows; a null
    cutoff is an unused rule.  One row per stratum."""
    good = (labels.where(F.col(id_col).isNotNull() & F.col(label).isNotNull()).groupBy(F.col(id_col).alias("id"))
            .agg(F.min(label).alias("least")).where("least = 1").select("id"))
    names, checks = list(rules()), rules()
    counts = (rows.where("not base_failed").join(good, "id", "left_semi").groupBy("stratum")
              .agg(F.count("*").alias("n_good"),
                   *[F.array(*[F.count_if(checks[r] > c) for c in CUTOFFS]).alias(r) for r in names]))
    strata = rows.select("stratum").distinct().count()
    share, level = risk / len(names), delta / max(1, strata * len(names))

    def choose(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = batch[["stratum", "n_good"]].copy()
            for r in names:
                found = [certified([int(x) for x in above], int(n), share, level)
                         for above, n in zip(batch[r], batch["n_good"])]
                out[f"cut_{r}"] = pd.array([None if i is None else CUTOFFS[i] for i in found], dtype="Int64")
            yield out

    return counts.mapInPandas(choose, "stratum string, n_good long, " + ", ".join(f"cut_{r} long" for r in names))


def judged(documents: DataFrame, labels: DataFrame, stratum: Column, label: str = "quality", risk: float = 0.02,
           delta: float = 0.05, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``measured`` rows with their stratum's cutoffs and ``kept``."""
    rows = written(measured(documents, stratum, id_col, text_col), "rules")
    cuts = checkpointed(cutoffs(rows, labels, label, risk, delta, id_col))
    sizes = rows.groupBy("stratum").agg(F.count("*").alias("n"))
    out = spread_join(rows, cuts, "stratum", heavy_keys(sizes, "stratum", "n", rows.count()))
    rejected = F.lit(False)
    for name, value in rules().items():
        rejected = rejected | F.coalesce(value > F.col(f"cut_{name}"), F.lit(False))
    return out.withColumn("kept", ~F.col("base_failed") & ~rejected)
