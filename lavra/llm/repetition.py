"""Repetition inside a single document.

Words are compared by letters and digits alone. Every run of ``run`` words is hashed; a run whose hash stood
earlier in the same text marks its words as repeated, first occurrences stay unmarked and runs may overlap.
The work is vectorised over whole Arrow batches: word hashes of all texts lie in one array, each mixed with
the number of its text, so that one sort finds the earlier occurrences of every text at once.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_WORD = re.compile(r"[^\W_]+")
_MIX = np.uint64(0x9E3779B97F4A7C15)
RESULT = T.StructType([T.StructField("n_words", T.LongType()), T.StructField("n_repeated", T.LongType())])


def repeated_words(batch: list[str | None], run: int) -> tuple[np.ndarray, np.ndarray]:
    """Words, and words inside runs that stood earlier, of every text."""
    words = [_WORD.findall(t.lower()) if t else [] for t in batch]
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    total = int(sizes.sum())
    if total == 0:
        return sizes, np.zeros(len(batch), np.int64)
    codes = np.fromiter((hash(w) for ws in words for w in ws), np.int64, total).view(np.uint64)
    del words
    ends = np.cumsum(sizes)
    starts = ends - sizes
    room = np.maximum(sizes - run + 1, 0)
    doc = np.repeat(np.arange(len(batch)), room)
    first = np.arange(int(room.sum())) - np.repeat(np.cumsum(room) - room, room) + np.repeat(starts, room)
    with np.errstate(over="ignore"):
        grams = doc.astype(np.uint64) * _MIX
        for k in range(run):
            grams = (grams ^ (grams >> np.uint64(29))) * _MIX + codes[first + k]
    order = np.argsort(grams, kind="stable")
    ranked = grams[order]
    seen = np.zeros(len(grams), bool)
    seen[order[1:]] = ranked[1:] == ranked[:-1]
    edge = np.zeros(total + 1, np.int64)
    np.add.at(edge, first[seen], 1)
    np.add.at(edge, first[seen] + run, -1)
    covered = np.concatenate(([0], np.cumsum(np.cumsum(edge[:-1]) > 0)))
    return sizes, covered[ends] - covered[starts]


def measure(df: DataFrame, text: str, run: int = 8) -> DataFrame:
    """``df`` without the text, with n_words, n_repeated and repeated_share.

    Letter case, punctuation and spacing don't matter. Null, empty and wordless texts have no words and a
    share of 0. Columns of ``df`` that have the names of new columns are replaced.
    """

    @F.pandas_udf(RESULT)
    def count(s: pd.Series) -> pd.DataFrame:
        n, r = repeated_words(s.tolist(), run)
        return pd.DataFrame({"n_words": n, "n_repeated": r})

    rest = [c for c in df.columns if c not in (text, "n_words", "n_repeated", "repeated_share")]
    out = df.select(*rest, count(text).alias("_r")).select(*rest, "_r.*")
    return out.withColumn("repeated_share", F.when(F.col("n_words") > 0, F.col("n_repeated") / F.col("n_words")).otherwise(0.0))
