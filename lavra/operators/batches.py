"""Fixed-size batches of published records."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lavra.session import cut, shuffle_partitions
from lavra.sources import objects, store

BATCH_SIZE = 200
#: Fields that are not published.
EXCLUDED = ("text_file_s3_uri", "extraction_started", "extraction_finished", "extraction_duration_in_seconds", "status", "filepath")


def numbered(df: DataFrame, *order: str) -> DataFrame:
    """``df`` with ``row_no`` from 0 in the global order, without one task seeing all rows.

    Rows are range-partitioned on the order, numbered inside their partition, and shifted by the sizes of the
    partitions before it. Ties get numbers in no particular order.
    """
    ranged = cut(df.repartitionByRange(shuffle_partitions(df.sparkSession), *order).withColumn("_part", F.spark_partition_id()))
    sizes = ranged.groupBy("_part").agg(F.count("*").alias("_n"))  # one row per partition
    starts = sizes.select("_part", F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_start"))
    local = F.row_number().over(Window.partitionBy("_part").orderBy(*order)) - 1
    return ranged.join(starts, "_part").withColumn("row_no", local + F.col("_start")).drop("_part", "_start")


def batched(df: DataFrame, *order: str, size: int = BATCH_SIZE, first: int = 0) -> DataFrame:
    """``df`` with ``batch``: consecutive runs of ``size`` rows in the given order, from batch ``first``."""
    return numbered(df, *order).withColumn("batch", (F.floor(F.col("row_no") / size) + first).cast("bigint")).drop("row_no")


def batch_name(batch: Column) -> Column:
    return F.concat(F.lit("batch_"), F.format_string("%04d", batch), F.lit(".jsonl"))


def final_records(records: DataFrame, texts: DataFrame, key: str = "id") -> DataFrame:
    """Published rows: the records without the excluded fields, with ``text_content`` by key (null where missing)."""
    return records.drop(*EXCLUDED, "text_content").join(texts.select(key, "text_content"), key, "left")


def written(spark: SparkSession, folder: str) -> DataFrame:
    """(batch): numbers of the batch files in a folder, which has to exist: a run must not begin a second sequence."""
    if not store.exists(folder):
        raise FileNotFoundError(folder)
    return objects.list_keys(spark, folder).select(F.regexp_extract("key", r"(?:^|/)batch_(\d+)\.jsonl$", 1).alias("_n")).where("_n <> ''").select(F.col("_n").cast("bigint").alias("batch"))


def next_batch(existing: DataFrame) -> int:
    """Number after the last batch written, 0 for none."""
    last = existing.agg(F.max("batch")).first()[0]
    return 0 if last is None else int(last) + 1


def write_jsonl(batches: DataFrame, folder: str, *order: str) -> int:
    """Write each batch as ``batch_%04d.jsonl``, null fields written and non-ASCII kept; returns the rows written.

    A batch lies in one task, so its file is written once and as a whole; a task that is run again writes the same
    file. Lines follow ``order`` inside a batch.
    """
    fields = [c for c in batches.columns if c != "batch"]
    lines = batches.select(batch_name(F.col("batch")).alias("_name"), "batch", *order, F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}).alias("_line"))
    placed = lines.repartition("batch").sortWithinPartitions("batch", *order).select("_name", "_line")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lines = ((n, x) for pdf in frames for n, x in pdf.itertuples(index=False))
        for name, group in groupby(lines, lambda row: row[0]):
            text = [x for _, x in group]  # one batch
            store.write(store.join(folder, name), ("".join(f"{x}\n" for x in text).encode("utf-8"),))
            yield pd.DataFrame({"rows": [len(text)]})

    return placed.mapInPandas(run, "rows bigint").agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]


def write_texts(records: DataFrame, folder: str, key: str = "id", text: str = "text_content") -> DataFrame:
    """(name, size, sha256, error) of the text files ``<key>.txt`` written by the tasks, one per record with a text."""
    named = records.select(F.concat(F.col(key), F.lit(".txt")).alias("_name"), F.col(text).alias("_text"))
    return cut(store.write_texts(named, "_name", "_text", folder))
