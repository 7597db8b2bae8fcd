"""Splitting oversized texts at natural boundaries.

The text is tokenised once; prefix sums of the token lengths give sorted arrays of boundary offsets, one
per kind of boundary (paragraph, line, sentence, word). Every cut is a binary search for the last boundary
below the limit, the strongest kind first; the next piece starts ``overlap`` characters before the cut.
Where no boundary lies in reach the piece is cut hard at the limit.

Texts within the limit never leave the JVM.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_TOKEN = re.compile(r"\S+|\s+")
_SENTENCE_END = re.compile(r"[.!?…。！？]+[\"'”’»)\]]*$")
SPAN = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))


def boundaries(text: str) -> list[np.ndarray]:
    """Sorted boundary offsets by kind: paragraphs, lines, sentences, words. A boundary ends the white space."""
    tokens = _TOKEN.findall(text)
    ends = np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens)))
    para, line, sentence, word = [], [], [], []
    for k, token in enumerate(tokens):
        if token[0].isspace():
            breaks = token.count("\n") + token.count("\f") + token.count("\u2029")
            word.append(ends[k])
            if k and _SENTENCE_END.search(tokens[k - 1]):
                sentence.append(ends[k])
            if breaks:
                line.append(ends[k])
            if breaks > 1 or "\f" in token or "\u2029" in token:
                para.append(ends[k])
    return [np.asarray(x, np.int64) for x in (para, line, sentence, word)]


def spans(text: str, limit: int, overlap: int, fill: float = 0.5) -> list[tuple[int, int]]:
    """Offsets of the pieces of one text.

    A boundary is taken if the piece then holds at least ``fill`` of the limit, so that strong but early
    boundaries don't make tiny pieces; words are taken anywhere beyond the overlap, else the cut is hard.
    """
    n = len(text)
    if n <= limit:
        return [(0, n)] if n else []
    kinds, out, start = boundaries(text), [], 0
    while n - start > limit:
        reach = start + limit
        cut = reach
        for strength, offsets in enumerate(kinds):
            k = np.searchsorted(offsets, reach, side="right") - 1
            least = start + (overlap + 1 if strength == len(kinds) - 1 else max(overlap + 1, int(limit * fill)))
            if k >= 0 and offsets[k] >= least:
                cut = int(offsets[k])
                break
        out.append((start, cut))
        start = cut - overlap
    return [*out, (start, n)]


def split(df: DataFrame, text: str, limit: int = 4000, overlap: int = 200) -> DataFrame:
    """One row per piece: the columns of ``df`` but the text, and piece_no, n_pieces, piece_start, piece_end, piece.

    Pieces have at most ``limit`` characters (Unicode code points) and consecutive ones share exactly
    ``overlap`` of them, so the text is the pieces without their first ``overlap`` characters but for the
    first piece. A null or empty text gives no piece, a text within the limit one. Columns of ``df`` that
    have the names of new columns are replaced.
    """
    if not 0 <= overlap < limit:
        raise ValueError("overlap must be at least 0 and below the limit")

    @F.pandas_udf(SPAN)
    def cuts(s: pd.Series) -> pd.Series:
        return s.map(lambda t: None if t is None else [{"start": a, "end": b} for a, b in spans(t, limit, overlap)])

    @F.pandas_udf(T.ArrayType(T.StringType()))
    def take(s: pd.Series, at: pd.Series) -> pd.Series:
        return pd.Series([None if t is None else [t[x["start"] : x["end"]] for x in a] for t, a in zip(s, at, strict=True)])

    size = F.char_length(text)
    long_text = F.when(size > limit, F.col(text))
    new = ("piece_no", "n_pieces", "piece_start", "piece_end", "piece")
    rest = [c for c in df.columns if c != text and c not in new]
    marked = df.where(size > 0).select(*rest, F.col(text).alias("_text"), cuts(long_text).alias("_cuts"))
    cut_texts = marked.select("*", take(F.when(F.col("_cuts").isNotNull(), F.col("_text")), F.col("_cuts")).alias("_pieces"))
    at = F.coalesce(F.col("_cuts"), whole_of("_text"))
    rows = cut_texts.select(*rest, at.alias("_at"), F.posexplode(F.coalesce("_pieces", F.array("_text"))).alias("piece_no", "piece"))
    here = F.get("_at", F.col("piece_no"))
    return rows.select(*rest, "piece_no", F.size("_at").alias("n_pieces"), here["start"].alias("piece_start"), here["end"].alias("piece_end"), "piece")


def whole_of(text: str):
    return F.array(F.struct(F.lit(0).alias("start"), F.char_length(text).alias("end")))
