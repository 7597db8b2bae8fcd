"""Shared pieces of the text operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def has_text(c: Column) -> Column:
    """True for texts with at least one character that is not white space; null counts as false."""
    return F.coalesce(c.rlike(r"(?U)\S"), F.lit(False))


def texts(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, text) of the rows with a key and a text; the scan reads these two columns only."""
    return df.select(F.col(key), F.col(text)).where(F.col(key).isNotNull() & has_text(F.col(text)))
