"""JSON lines as logs hold them: blank lines, stray quotes and broken lines are tolerated, or refused."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lavra.functions.text import strip


def _schema(spec: str | T.StructType) -> T.StructType:
    return T.StructType.fromDDL(spec) if isinstance(spec, str) else spec


def parse(lines: DataFrame, value: str, schema: str | T.StructType, keep_broken: bool = False) -> DataFrame:
    """Parsed lines: the other columns of ``lines`` and the fields of ``schema``.

    Lines are stripped, stray single quotes around them removed, blank and null ones dropped. Broken lines are
    dropped too, or kept with their text in ``broken`` and null fields.
    """
    spec = _schema(schema).add("_broken", T.StringType())
    text = strip(F.regexp_replace(strip(F.col(value)), "^'+|'+$", ""))
    rest = [c for c in lines.columns if c != value]
    parsed = lines.select(*rest, text.alias("_t")).where("_t <> ''").select(*rest, F.from_json("_t", spec, {"columnNameOfCorruptRecord": "_broken"}).alias("_j"))
    fields = [F.col(f"_j.{f.name}") for f in spec if f.name != "_broken"]
    if keep_broken:
        return parsed.select(*rest, *fields, F.col("_j._broken").alias("broken"))
    return parsed.where("_j._broken is null and _j is not null").select(*rest, *fields)


def read(spark: SparkSession, path: str, schema: str | T.StructType, strict: bool = False) -> DataFrame:
    """JSON lines of a file or folder; ``strict`` fails on the first broken line instead of dropping it."""
    if strict:
        return spark.read.schema(_schema(schema)).option("mode", "FAILFAST").json(path)
    return parse(spark.read.text(path), "value", schema)


def broken_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, line, text): lines that are no JSON, with their numbers from 1. A file is read as a whole for its numbers."""
    whole = spark.read.text(path, wholetext=True).select("value", F.col("_metadata.file_path").alias("file"))
    lines = whole.select("file", F.posexplode(F.split("value", "\n")).alias("_n", "text")).select("file", (F.col("_n") + 1).alias("line"), "text")
    marked = parse(lines.withColumn("_raw", F.col("text")), "text", "id STRING", keep_broken=True)
    return marked.where("broken is not null").select("file", "line", F.col("_raw").alias("text"))


def processed_ids(spark: SparkSession, path: str) -> DataFrame:
    """(id): distinct ids of an output log, to be skipped by a later run."""
    return read(spark, path, "id STRING").where(F.col("id").isNotNull()).distinct()
