"""Token ids of a whole corpus by merge replay.

Byte-level BPE is applied to the distinct words of a block of texts at once: an inverted index leads from
each pair of neighbouring tokens to the positions where it stands, and the merges present are replayed in
rank order, touching nothing but the neighbours of each merged pair. A word is merged once however often it
occurs; a bounded memo carries words from block to block inside a worker. Blocks are independent, so the
texts are never shuffled: a word that occurs in two blocks is replayed twice, which costs less than moving
every word position of the corpus through an exchange.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lavra.functions.text import TOKEN_PATTERN

def read_ranks(path: str) -> bytes:
    """The bytes of a rank file: one base64 token and its id per line. Below 1 MB for 50,000 tokens."""
    with open(path, "rb") as f:
        return f.read()


class Replay:
    """Merge replay over blocks of words, for one vocabulary."""

    def __init__(self, ranks: bytes, pattern: str = TOKEN_PATTERN, memo_words: int = 500_000):
        rows = [line.split() for line in ranks.splitlines() if line.strip()]
        self.id_of = {base64.b64decode(a): int(b) for a, b in rows}
        self.token_of = {b: a for a, b in self.id_of.items()}
        self.byte_ids = [self.id_of[bytes([k])] for k in range(256)]
        self.split = regex.compile(pattern).findall
        self.pairs: dict[tuple[int, int], int] = {}
        self.memo: dict[str, list[int]] = {}
        self.memo_words = memo_words

    def merged(self, a: int, b: int) -> int:
        """Id (which is the rank) of the merge of two tokens, -1 if there is none."""
        got = self.pairs.get((a, b))
        if got is None:
            got = self.pairs[a, b] = self.id_of.get(self.token_of[a] + self.token_of[b], -1)
        return got

    def words(self, words: list[str]) -> list[list[int]]:
        """Ids of each of some distinct words."""
        sym: list[int] = []
        starts = []
        for w in words:
            starts.append(len(sym))
            sym.extend(self.byte_ids[x] for x in w.encode("utf-8", "surrogatepass"))
            sym.append(-1)  # no pair crosses the end of a word
        n = len(sym)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        index: dict[int, list[int]] = {}
        heap: list[int] = []

        def enter(p: int, q: int) -> None:
            rank = self.merged(sym[p], sym[q])
            if rank >= 0:
                at = index.get(rank)
                if at is None:
                    index[rank] = [p]
                    heapq.heappush(heap, rank)
                else:
                    at.append(p)

        for p in range(n - 1):
            if sym[p] >= 0 and sym[p + 1] >= 0:
                enter(p, p + 1)
        while heap:
            rank = heapq.heappop(heap)
            for p in sorted(index.pop(rank)):
                if sym[p] < 0:
                    continue
                q = after[p]
                if q >= n or sym[q] < 0 or self.merged(sym[p], sym[q]) != rank:
                    continue  # a neighbour was merged away since the pair was entered
                sym[p], sym[q] = rank, -2
                after[p] = r = after[q]
                if r < n:
                    before[r] = p
                    if sym[r] >= 0:
                        enter(p, r)
                left = before[p]
                if left >= 0 and sym[left] >= 0:
                    enter(left, p)
        bounds = [*starts, n][1:]
        return [[s for s in sym[a:b] if s >= 0] for a, b in zip(starts, bounds, strict=True)]

    def encode(self, texts: list[str | None]) -> list[list[int]]:
        """Ids of every text of a block; null and empty texts have none."""
        split = [self.split(t) if t else [] for t in texts]
        memo = self.memo
        fresh = list({w for ws in split for w in ws if w not in memo})
        if len(memo) + len(fresh) > self.memo_words:
            memo.clear()
            fresh = list({w for ws in split for w in ws})
        memo.update(zip(fresh, self.words(fresh), strict=True))
        return [[i for w in ws for i in memo[w]] for ws in split]


@lru_cache(maxsize=2)
def _replay(ranks: bytes, pattern: str) -> Replay:
    return Replay(ranks, pattern)


def encode(df: DataFrame, text: str, ranks_path: str, pattern: str = TOKEN_PATTERN) -> DataFrame:
    """``df`` with the text replaced by ``ids array<int>``, without special tokens.

    Null and empty texts both have the empty list; text that looks like a special token is plain text. A
    column of ``df`` named ids is replaced. The vocabulary travels to the executors as a broadcast of the
    rank file (its size is fixed by the public vocabulary), so they need not see ``ranks_path``.
    """
    ranks = df.sparkSession.sparkContext.broadcast(read_ranks(ranks_path))

    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def ids(blocks: Iterator[pd.Series]) -> Iterator[pd.Series]:
        replay = _replay(ranks.value, pattern)
        for s in blocks:
            yield pd.Series(replay.encode(s.tolist()), dtype=object)

    rest = [c for c in df.columns if c not in (text, "ids")]
    return df.select(*rest, ids(F.col(text)).alias("ids"))


def decode(ids: str, ranks_path: str):
    """The text of a column of ids, for round trips; malformed bytes are replaced."""
    ranks = SparkSession.active().sparkContext.broadcast(read_ranks(ranks_path))

    @F.pandas_udf(T.StringType())
    def text(blocks: Iterator[pd.Series]) -> Iterator[pd.Series]:
        token_of = _replay(ranks.value, TOKEN_PATTERN).token_of
        for s in blocks:
            yield pd.Series([None if x is None else b"".join(token_of[i] for i in x).decode("utf-8", "replace") for x in s], dtype=object)

    return text(ids)
