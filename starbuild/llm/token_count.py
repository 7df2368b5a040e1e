"""Token counts: byte-pair merging with a heap and a linked list.

A word starts as a linked list of its bytes; a heap holds every adjacent pair
that has a merge, lowest rank first (ties: leftmost).  The lowest pair is
popped again and again and merged, its neighbours' new pairs are pushed, and
entries whose symbols have changed meanwhile are skipped.  The number of
tokens is the number of initial symbols minus the number of merges; no token
identifiers are emitted.  A word of n bytes takes O(n log n) steps, so one
text without any blank is no problem.

Counts of short words are remembered per Python worker in a table of at most
``CACHE_WORDS`` entries (emptied when full).

Edge cases: a null text counts as empty (0 bytes, 0 tokens); the strings of
added tokens count one token each; repeated rows are each counted; an empty
table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from starbuild.llm.byte_bpe import Splitter, Vocabulary, read_vocabulary
from starbuild.llm.common import text_or_empty

CACHE_WORDS = 300_000
CACHE_WORD_CHARS = 48


class TokenCounter(dict):
    """Maps a word to its number of tokens (itself the table of short words)."""

    def __init__(self, byte_ids: list[int], ranks: dict[tuple[int, int], tuple[int, int]], added: dict[str, int]):
        super().__init__()
        self.byte_ids, self.ranks, self.added, self._split = byte_ids, ranks, added, None

    def __reduce__(self):
        return TokenCounter, (self.byte_ids, self.ranks, self.added)

    @classmethod
    def from_vocabulary(cls, v: Vocabulary) -> TokenCounter:
        return cls(v.byte_ids, {(a, b): (rank, c) for rank, (a, b, c) in enumerate(v.merges)}, v.added)

    def __missing__(self, word: str) -> int:
        n = self.merge(word.encode("utf-8", "replace"))
        if len(word) <= CACHE_WORD_CHARS:
            if len(self) >= CACHE_WORDS:
                self.clear()
            self[word] = n
        return n

    def merge(self, word: bytes) -> int:
        """Initial symbols minus merges."""
        n, ranks = len(word), self.ranks
        symbol = [self.byte_ids[b] for b in word]
        after = [*range(1, n), -1]
        before = [*range(-1, n - 1)]
        heap = [(*ranks[p], i, p) for i in range(n - 1) if (p := (symbol[i], symbol[i + 1])) in ranks]
        heap = [(rank, i, new, p) for rank, new, i, p in heap]
        heapify(heap)
        merges = 0
        while heap:
            _, i, new, pair = heappop(heap)
            j = after[i]
            if j < 0 or symbol[i] != pair[0] or symbol[j] != pair[1]:
                continue                               # one of the two has merged meanwhile
            merges += 1
            symbol[i], symbol[j] = new, -1
            k = after[i] = after[j]
            if k >= 0:
                before[k] = i
                if (p := (new, symbol[k])) in ranks:
                    rank, c = ranks[p]
                    heappush(heap, (rank, i, c, p))
            h = before[i]
            if h >= 0 and (p := (symbol[h], new)) in ranks:
                rank, c = ranks[p]
                heappush(heap, (rank, h, c, p))
        return n - merges

    def count(self, text: str) -> int:
        if self._split is None:
            self._split = Splitter(self.added)
        total = 0
        for i, part in enumerate(self._split.parts(text)):
            total += 1 if i % 2 else sum(map(self.__getitem__, self._split.find(part)))
        return total


def token_counts(documents: DataFrame, vocabulary_path: str, limit: int = 512,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, n_bytes, n_tokens, over_limit)`` of every whole text.

    The merge table (one vocabulary) is read on the driver and broadcast."""
    spark = documents.sparkSession
    shared = spark.sparkContext.broadcast(TokenCounter.from_vocabulary(read_vocabulary(vocabulary_path)))

    @pandas_udf("long")
    def tokens(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield texts.map(shared.value.count).astype("int64")

    return (documents.select(F.col(id_col), text_or_empty(text_col).alias("_text"))
            .select(F.col(id_col), F.octet_length("_text").cast("long").alias("n_bytes"),
                    tokens("_text").alias("n_tokens"))
            .withColumn("over_limit", F.col("n_tokens") > limit))
