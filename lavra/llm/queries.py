"""Queries of the training-data operators."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lavra.llm import bpe, common, encoding, leaks, lookalike, markup, markup_clean, oracles, repetition, scan_noise, split
from lavra.session import read_table


def _record_texts(spark: SparkSession, base: str) -> DataFrame:
    return common.texts(read_table(spark, base, "extraction_records"), "id", "text_content")


def _one_per_id(df: DataFrame) -> DataFrame:
    """All rows of an id hold the same text, so any of them stands for it."""
    return df.dropDuplicates(["id"])


def p1_found(spark: SparkSession, base: str) -> DataFrame:
    pieces = split.split(_record_texts(spark, base), "text_content", limit=4000, overlap=200)
    return pieces.where("n_pieces > 1 and piece_no = 0").select("id").distinct()


def p1_pieces(spark: SparkSession, base: str) -> DataFrame:
    long_texts = _one_per_id(_record_texts(spark, base).where(F.char_length("text_content") > 4000))
    return split.split(long_texts, "text_content", limit=4000, overlap=200)


def p1_rebuilt(spark: SparkSession, base: str) -> DataFrame:
    """Each long text put together from its pieces again, and the bounds of its pieces."""
    pieces = p1_pieces(spark, base)
    # The pieces of one text, which are no larger than the text.
    whole = pieces.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("piece_no", "piece"))).alias("_p"), F.max(F.char_length("piece")).alias("longest"))
    own = F.transform("_p", lambda x: F.when(x["piece_no"] == 0, x["piece"]).otherwise(F.substr(x["piece"], F.lit(201))))
    return whole.select("id", F.md5(F.array_join(own, "")).alias("digest"), (F.col("longest") <= 4000).alias("within_limit"))


def p3_found(spark: SparkSession, base: str) -> DataFrame:
    return repetition.measure(_record_texts(spark, base), "text_content").where("n_words > 0 and n_repeated >= 0.35 * n_words").select("id").distinct()


def p3_share(spark: SparkSession, base: str) -> DataFrame:
    out = repetition.measure(_record_texts(spark, base), "text_content")
    return out.select("id", "n_words", "n_repeated", "repeated_share").distinct()


def p4_repaired(spark: SparkSession, base: str) -> DataFrame:
    # The source of a value is the tree that its file comes from: one town, one member of the staff.
    folder = F.regexp_extract("filepath", "^/?[^/]*", 0)
    values = encoding.fields_long(read_table(spark, base, "extraction_records"), "id", ["text_content", "filepath"], folder)
    model = encoding.learn(values, "value", source="source")
    return encoding.repair(values, "value", model, "source", encoding.learn_sources(values, "value", "source", model), F.col("field_name") != "filepath")


def p4_found(spark: SparkSession, base: str) -> DataFrame:
    return p4_repaired(spark, base).where("damaged").select("id", "field_name").distinct()


def p4_restored(spark: SparkSession, base: str) -> DataFrame:
    return p4_repaired(spark, base).where("damaged").dropDuplicates(["id", "field_name"]).select("id", "field_name", "cipher", "restored", "unresolved")


def p5_found(spark: SparkSession, base: str) -> DataFrame:
    return scan_noise.Noise(_record_texts(spark, base), "id", "text_content").found()


def p5_repaired(spark: SparkSession, base: str) -> DataFrame:
    return scan_noise.repair(_record_texts(spark, base), "id", "text_content")


def p6_found(spark: SparkSession, base: str) -> DataFrame:
    return markup.find(_record_texts(spark, base), "text_content").select("id", F.explode("markup").alias("markup")).distinct()


def p6_clean(spark: SparkSession, base: str) -> DataFrame:
    signed = _one_per_id(_record_texts(spark, base).where(F.col("text_content").rlike(markup.SIGNS)))  # others hold no markup
    return markup_clean.convert(signed, "text_content").where(F.size("markup") > 0)


#: Folder of the public vocabulary files.
TOKENIZERS = os.environ.get("LAVRA_TOKENIZERS", "/opt/tokenizers")


def p7_ids(spark: SparkSession, base: str) -> DataFrame:
    return bpe.encode(read_table(spark, base, "documents").select("doc_id", "text"), "text", f"{TOKENIZERS}/byte_bpe_50k.tiktoken")


def p7_rebuilt(spark: SparkSession, base: str) -> DataFrame:
    """The texts that the ids stand for."""
    path = f"{TOKENIZERS}/byte_bpe_50k.tiktoken"
    ids = bpe.encode(read_table(spark, base, "documents").select("doc_id", "text"), "text", path)
    return ids.select("doc_id", F.md5(bpe.decode("ids", path)).alias("digest"), (F.size("ids") == 0).alias("empty"))


def p8_found(spark: SparkSession, base: str) -> DataFrame:
    return p8_leaks(spark, base).select("doc_id", "item_id")


def p8_leaks(spark: SparkSession, base: str) -> DataFrame:
    return leaks.find_leaks(read_table(spark, base, "documents"), "doc_id", "text", read_table(spark, base, "eval_items"))


def p9_found(spark: SparkSession, base: str) -> DataFrame:
    return lookalike.pairs(read_table(spark, base, "documents"), "doc_id", "text")


def p9_groups(spark: SparkSession, base: str) -> DataFrame:
    return lookalike.membership(read_table(spark, base, "documents"), "doc_id", "text")


def p9_normalised(spark: SparkSession, base: str) -> DataFrame:
    return read_table(spark, base, "documents").select("doc_id", lookalike.normalise(F.col("text")).alias("normal_text"))


QUERIES = {"p1_found": p1_found, "p1_pieces": p1_pieces, "p1_rebuilt": p1_rebuilt, "p3_found": p3_found, "p3_share": p3_share, "p4_found": p4_found, "p4_restored": p4_restored, "p5_found": p5_found, "p5_repaired": p5_repaired, "p6_found": p6_found, "p6_clean": p6_clean, "p7_ids": p7_ids, "p7_rebuilt": p7_rebuilt, "p8_found": p8_found, "p8_leaks": p8_leaks, "p9_found": p9_found, "p9_groups": p9_groups, "p9_normalised": p9_normalised}
SQL = oracles.SQL
