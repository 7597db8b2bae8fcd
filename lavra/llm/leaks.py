"""Evaluation texts leaking into a training corpus.

The held-out items are indexed for BM25; every training text is cut into overlapping passages, each passage
queries the index by block-max WAND, and every item scoring at least its threshold is retrieved (there is no
top-k). The threshold of an item is the smallest score that a passage holding a leak of it can have, so the
retrieval loses none. Retrieved items are verified against the whole text: the longest stretch of the item's
words that stands consecutively in the text, tolerating single replaced words, and the overlap of the
question and of the right answer.

A stretch with few replaced words holds a run of equal words: of 20 words with three replaced, at least five
in a row are the item's. Passages without such a run of any item can't score as leaks; they are passed over, all
texts of a batch at a time, before the index is asked.

The index is broadcast only while the items are few (``max_items``). Beyond that the same runs are joined: the
runs of the corpus, thinned by a bitmap of fixed size, meet the runs of the items, and what they retrieve is
verified alike. The corpus is read once for its runs however many items there are.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lavra.llm.lookalike import normal_form
from lavra.session import cut

_WORD = re.compile(r"[^\W_]+")
HIT = T.StructType(
    [T.StructField("item_id", T.LongType()), T.StructField("matched_words", T.IntegerType()), T.StructField("item_words", T.IntegerType()), T.StructField("has_answer", T.BooleanType())]
)


@dataclass(frozen=True)
class LeakRule:
    """``least`` consecutive item words make a leak, of which at most the share ``replaced`` may differ."""

    least: int = 20
    replaced: float = 0.15
    k1: float = 1.2
    b: float = 0.75
    block: int = 16

    def allowed(self, n: int) -> int:
        """Replaced words that a stretch of n words may hold."""
        return int(n * self.replaced)

    def size(self, n: int) -> int:
        """Words of the shortest stretch that leaks an item of n words."""
        return min(self.least, n)

    @lru_cache(maxsize=100_000)  # noqa: B019 - rules are few
    def run(self, n: int) -> int:
        """Equal words in a row that any leak of an item of n words holds."""
        return min((-(-(m - self.allowed(m)) // (self.allowed(m) + 1)) for m in range(self.size(n), n + 1)), default=0)


def runs(codes: np.ndarray, length: int) -> np.ndarray:
    """A hash of the ``length`` codes from each position on; negative codes are unknown words, their runs have hash 0."""
    n = len(codes) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out, unknown = np.full(n, length, np.uint64), np.zeros(n, bool)
    with np.errstate(over="ignore"):
        for k in range(length):
            part = codes[k : k + n]
            out = (out ^ (out >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15) + part.astype(np.uint64)
            unknown |= part < 0
    out[unknown] = 0
    return out


class _Comparable(dict):
    """The comparable form of each character, filled as characters occur. Combining marks are dropped, so composed
    and decomposed letters come out alike without normalising the text."""

    def __missing__(self, ch: str) -> str:
        plain = unicodedata.normalize("NFKD", normal_form(f"a{ch}a")[1:-1])
        self[ch] = "".join(c for c in plain if not unicodedata.combining(c))
        return self[ch]

    def one(self, m: re.Match) -> str:
        return self[m[0]]


_COMPARABLE = _Comparable()
_NOT_PLAIN = re.compile(r"[^\n -~]")


def comparable_words(text: str) -> list[str]:
    """Words without regard to case, accents, punctuation, spacing and look-alike characters."""
    return _WORD.findall(_NOT_PLAIN.sub(_COMPARABLE.one, text).lower())


def _maxima(blocks: np.ndarray, scores: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The blocks of a posting list, which are in order, and the largest score in each."""
    first = np.flatnonzero(np.concatenate(([True], blocks[1:] != blocks[:-1])))
    return blocks[first], np.maximum.reduceat(scores, first)


class Index:
    """BM25 inverted index of the items; every weight is divided by its item's threshold, so that 1 is a hit."""

    def __init__(self, items: list[tuple[int, str, str | None]], rule: LeakRule):
        self.rule = rule
        self.ids = [i for i, _, _ in items]
        self.words = [comparable_words(t) for _, t, _ in items]
        self.answers = [_answer_words(t, a) for _, t, a in items]
        n, mean = len(items), max(1.0, sum(map(len, self.words)) / max(1, len(items)))
        seen = Counter(w for ws in self.words for w in set(ws))
        idf = {w: float(np.log(1 + (n - c + 0.5) / (c + 0.5))) for w, c in seen.items()}
        lists: dict[str, list[tuple[int, float]]] = {}
        for k, ws in enumerate(self.words):
            norm = rule.k1 * (1 - rule.b + rule.b * len(ws) / mean)
            weight = {w: idf[w] * c * (rule.k1 + 1) / (c + norm) for w, c in Counter(ws).items()}
            least = self._threshold(ws, weight)
            for w, x in weight.items():
                lists.setdefault(w, []).append((k, x / least))
        self.posts = {w: (np.array([k for k, _ in p]), np.array([x for _, x in p])) for w, p in lists.items()}
        self.most = {w: float(xs.max()) for w, (_, xs) in self.posts.items()}
        self.blocks = {w: _maxima(ks // rule.block, xs) for w, (ks, xs) in self.posts.items()}
        self.codes = {w: c for c, w in enumerate(self.posts)}
        self.item_codes = [np.array([self.codes[w] for w in ws], np.int64) for ws in self.words]
        marks: dict[int, dict[int, set[int]]] = {}
        for k, ws in enumerate(self.item_codes):
            if len(ws):
                owners = marks.setdefault(rule.run(len(ws)), {})
                for h in runs(ws, rule.run(len(ws))).tolist():
                    owners.setdefault(h, set()).add(k)
        # By length: the hashes of the items' runs in order, and the items of each.
        self.marks = {length: (np.array(sorted(owners), np.uint64), [owners[h] for h in sorted(owners)]) for length, owners in marks.items()}

    def _threshold(self, words: list[str], weight: dict[str, float]) -> float:
        """The least score of any stretch that verification accepts: its terms without the heaviest replaced ones."""
        size = min(self.rule.least, len(words))
        if not size:
            return 1.0
        drop, least = self.rule.allowed(size), float("inf")
        for a in range(len(words) - size + 1):
            xs = sorted(weight[w] for w in set(words[a : a + size]))
            least = min(least, sum(xs[: max(1, len(xs) - drop)]))
        return max(least, 1e-9) * (1 - 1e-9)

    def search(self, words: set[str]) -> list[int]:
        """All items whose score for the words is at least 1, by block-max WAND.

        The bound of a block of items is the sum of its terms' maxima in it; all blocks are bounded at once, and
        only the items of blocks that can reach 1 are scored.
        """
        terms = [w for w in words if w in self.most]
        if sum(self.most[w] for w in terms) < 1:
            return []
        blocks, most = (np.concatenate(x) for x in zip(*(self.blocks[w] for w in terms), strict=True))
        live = np.bincount(blocks, most) >= 1
        if not live.any():
            return []
        items, scores = (np.concatenate(x) for x in zip(*(self.posts[w] for w in terms), strict=True))
        kept = live[items // self.rule.block]
        return np.flatnonzero(np.bincount(items[kept], scores[kept]) >= 1).tolist()

    def passages(self, codes: np.ndarray) -> dict[int, set[int]]:
        """First words of the passages that share a run of words with an item, and those items. Passages are twice as
        long as a leak and overlap by half, so each leak lies in one of them."""
        size, out = self.rule.least, {}
        last = max(0, (len(codes) - size - 1) // size) * size
        for length, (marks, owners) in self.marks.items():
            found = runs(codes, length)
            at = np.searchsorted(marks, found)
            at[at == len(marks)] = 0
            for p in np.flatnonzero((marks[at] == found) & (found > 0)).tolist():
                start = p // size * size
                items = owners[at[p]]
                out.setdefault(min(start, last), set()).update(items)
                if start and p + length <= start + size:
                    out.setdefault(min(start - size, last), set()).update(items)
        return out

    def candidates(self, words: list[str], codes: np.ndarray) -> list[int]:
        """Items retrieved by any passage that shares a run of words with them."""
        out: set[int] = set()
        for a, items in self.passages(codes).items():
            out.update(items.intersection(self.search(set(words[a : a + 2 * self.rule.least]))))
        return sorted(out)

    def verify(self, words: list[str], item: int, codes: np.ndarray) -> int:
        """Words of the longest accepted stretch of the item in the text, 0 if none is long enough."""
        want = self.item_codes[item]
        n, m = len(want), len(codes)
        size = min(self.rule.least, n)
        if not size or m < size:
            return 0
        i, j = np.nonzero(want[:, None] == codes[None, :])
        if len(i) < size - self.rule.allowed(size):
            return 0
        order = np.lexsort((i, j - i))
        i, off = i[order], (j - i)[order]
        best, bounds = 0, np.concatenate(([0], np.flatnonzero(np.diff(off)) + 1, [len(i)]))
        for k in np.flatnonzero(np.diff(bounds) >= size - self.rule.allowed(size)).tolist():
            best = max(best, self._stretch(i[bounds[k] : bounds[k + 1]], n))
        return best

    def _stretch(self, at: np.ndarray, n: int) -> int:
        """Longest stretch between matched words of one alignment with no more replaced words than allowed."""
        size, best, k = min(self.rule.least, n), 0, len(at)
        for a in range(k):
            if k - a <= best * (1 - self.rule.replaced):
                break
            lengths = at[a:] - at[a] + 1
            missing = lengths - np.arange(1, k - a + 1)
            ok = np.flatnonzero((lengths >= size) & (missing <= lengths * self.rule.replaced))
            if len(ok):
                best = max(best, int(lengths[ok[-1]]))
        return best

    def leaks(self, text: str) -> list[dict]:
        words = comparable_words(text)
        code = self.codes.get
        codes = np.fromiter((code(w, -1) for w in words), np.int64, len(words))
        found = self.candidates(words, codes) if len(words) else []
        return [hit for k in found if (hit := self.hit(words, codes, k))]

    def hit(self, words: list[str], codes: np.ndarray, item: int) -> dict | None:
        """A verified leak of one item."""
        matched = self.verify(words, item, codes)
        if not matched:
            return None
        answer = self.answers[item]
        whole = f" {' '.join(words)} " if answer else ""
        return {"item_id": self.ids[item], "matched_words": matched, "item_words": len(self.words[item]), "has_answer": bool(answer) and f" {' '.join(answer)} " in whole}


def _answer_words(text: str, answer: str | None) -> list[str]:
    """Words of the right option, or of the answer itself where the item has no such option."""
    if not answer:
        return []
    option = re.search(rf"(?:^|\s){re.escape(answer)}\)\s*([^;.]+)", text)
    return comparable_words(option[1] if option else answer)


_BUILT: list = [None, None]  # the items last indexed by this worker, and their index


def _index(items: list, rule: LeakRule) -> Index:
    if _BUILT[0] is not items:
        _BUILT[:] = [items, Index(items, rule)]
    return _BUILT[1]


def _hits(shared, rule: LeakRule):
    @F.pandas_udf(T.ArrayType(HIT))
    def hits(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        index = _index(shared.value, rule)
        for s in batches:
            yield pd.Series([index.leaks(t) if t else [] for t in s], dtype=object)

    return hits


def find_leaks(corpus: DataFrame, key: str, text: str, items: DataFrame, rule: LeakRule = LeakRule(), max_items: int = 5_000) -> DataFrame:
    """(key, item_id, matched_words, item_words, has_answer): every item that leaked into a text.

    ``items`` has item_id, text and answer; items without words and texts that are null or blank have no
    leaks, repeated rows of the corpus are reported once. No items give no rows.
    """
    live = items.where("item_id is not null and text is not null").select("item_id", "text", "answer").distinct()
    texts = corpus.where(F.col(key).isNotNull() & F.col(text).isNotNull()).select(F.col(key), F.col(text).alias("_t"))
    if live.count() > max_items:
        return _by_joins(texts, key, live, rule)
    rows = [(r.item_id, r.text, r.answer) for r in live.collect()]  # at most max_items rows
    shared = corpus.sparkSession.sparkContext.broadcast(rows)
    return texts.select(key, F.explode(_hits(shared, rule)("_t")).alias("_h")).select(key, "_h.*").distinct()


#: Bits of the bitmap that thins the runs of the corpus: 8 MB, whatever the number of items.
BITS = 26


def _code(words: list[str]) -> np.ndarray:
    """Codes of words that are the same in every task: 62 bits of a digest each."""
    memo = {w: int.from_bytes(hashlib.blake2b(w.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big") >> 2 for w in set(words)}
    return np.fromiter((memo[w] for w in words), np.int64, len(words))


def _by_joins(texts: DataFrame, key: str, items: DataFrame, rule: LeakRule) -> DataFrame:
    """Leaks of any number of items: texts and items that share a run of words, verified."""

    @F.pandas_udf("array<bigint>")
    def item_runs(s: pd.Series) -> pd.Series:
        coded = [_code(comparable_words(t)) for t in s]
        return pd.Series([np.unique(runs(c, rule.run(len(c)))).view(np.int64) if len(c) else np.zeros(0, np.int64) for c in coded], dtype=object)

    @F.pandas_udf("array<int>")
    def run_length(s: pd.Series) -> pd.Series:
        return pd.Series([[rule.run(n)] if (n := len(comparable_words(t))) else [] for t in s], dtype=object)

    spark = texts.sparkSession
    marks = cut(items.select("item_id", F.explode(item_runs("text")).alias("run")))
    lengths = sorted(r[0] for r in items.select(F.explode(run_length("text"))).distinct().collect())  # at most as many as rule.least
    bit = F.col("run").bitwiseAND(F.lit((1 << BITS) - 1))
    words = marks.select(F.shiftright(bit, 6).alias("w"), F.expr("shiftleft(1L, cast(run & 63 as int))").alias("b")).groupBy("w").agg(F.bit_or("b").alias("b"))
    filled = words.toPandas()  # at most 2^20 rows
    bitmap = np.zeros(1 << (BITS - 6), np.int64)
    bitmap[filled["w"].to_numpy(np.int64)] = filled["b"].to_numpy(np.int64)
    shared = spark.sparkContext.broadcast(bitmap)

    @F.pandas_udf("array<bigint>")
    def text_runs(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        bits = shared.value
        for s in batches:
            out = []
            for t in s:
                c = _code(comparable_words(t))
                found = np.unique(np.concatenate([runs(c, n) for n in lengths])) if lengths else np.zeros(0, np.uint64)
                low = found & np.uint64((1 << BITS) - 1)
                held = (bits[(low >> np.uint64(6)).astype(np.int64)].view(np.uint64) >> (low & np.uint64(63))) & np.uint64(1)
                out.append(found[held.astype(bool)].view(np.int64))
            yield pd.Series(out, dtype=object)

    found = cut(texts.select(key, F.explode(text_runs("_t")).alias("run")).join(marks, "run").select(key, "item_id").distinct())
    held = texts.join(found.select(key).distinct(), key, "left_semi").distinct()  # texts without a run are left out first
    pairs = found.join(held, key).join(items, "item_id")

    @F.pandas_udf(HIT)
    def verify(ids: pd.Series, wanted: pd.Series, answers: pd.Series, given: pd.Series) -> pd.DataFrame:
        out = []
        for i, w, a, t in zip(ids, wanted, answers, given, strict=True):
            index, words = Index([(i, w, a)], rule), comparable_words(t)
            codes = np.fromiter((index.codes.get(x, -1) for x in words), np.int64, len(words))
            out.append(index.hit(words, codes, 0) or dict.fromkeys(HIT.names))
        return pd.DataFrame(out, columns=HIT.names).astype({"item_id": "Int64", "matched_words": "Int32", "item_words": "Int32", "has_answer": "boolean"})

    checked = pairs.select(key, verify("item_id", "text", "answer", "_t").alias("_h"))
    return checked.where("_h.item_id is not null").select(key, "_h.*").distinct()
