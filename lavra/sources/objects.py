"""Object stores and metadata exports through the Hadoop file system API, so that any scheme Spark knows works."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lavra.sources import store


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def list_keys(spark: SparkSession, root: str) -> DataFrame:
    """(key, size): all objects below a root, keys relative to it; read by Spark's own listing, no content."""
    meta = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).select("path", F.col("length").alias("size"))
    fs, p = _fs(spark, root)
    base = fs.makeQualified(p).toString().replace("file:/", "file:///").replace("file://///", "file:///").rstrip("/")
    return meta.select(F.replace(F.regexp_replace("path", "^file:/+", "file:///"), F.lit(base + "/"), F.lit("")).alias("key"), "size")


def get_object(spark: SparkSession, path: str) -> bytes | None:
    """Bytes of one object, None where it is missing."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return None
    row = spark.read.format("binaryFile").load(path).select("content").first()
    return bytes(row.content) if row else None


def delete_prefix(spark: SparkSession, path: str) -> bool:
    """Remove everything below a path; false where there is nothing."""
    fs, p = _fs(spark, path)
    return bool(fs.delete(p, True)) if fs.exists(p) else False


def read_export(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A metadata export: one JSON array or document per file, with an explicit schema."""
    return spark.read.schema(schema).option("multiLine", "true").json(path)


def copy_files(status: DataFrame, source: str, target: str, source_root: str, target_root: str, delete_after: bool = False, in_flight: int | None = None) -> DataFrame:
    """(source, target, status, error): files of status 'copied' are copied by the tasks; a failure becomes 'error'.

    The roots are folders that all executors share, or places in object stores. ``delete_after`` and ``in_flight``
    as in ``store.transfer``: with both this is an upload of local results.
    """
    plan = status.select(source, target, "status")
    moved = store.transfer(plan.where("status = 'copied'"), source, target, source_root, target_root, delete_after, in_flight)
    moved = moved.select(source, target, F.when(F.col("error").isNull(), F.col("status")).otherwise("error").alias("status"), "error")
    return moved.unionByName(plan.where("status <> 'copied' or status is null").withColumn("error", F.lit(None).cast("string")))


def first_files(status: DataFrame, limit: int | None, *order: str) -> DataFrame:
    """The first ``limit`` files of a copy run in the given order, all without a limit."""
    return status if limit is None else status.orderBy(*order).limit(limit)


def write_missing(status: DataFrame, source: str, root: str, folder: str) -> None:
    """The error list of a copy run: one line of text for each source that was not found."""
    lines = status.where("status = 'not_found'").select(F.concat(F.lit("[NÃO ENCONTRADO] "), F.lit(root.rstrip("/") + "/"), F.col(source)).alias("value"))
    lines.write.mode("overwrite").text(folder)


def counted(df: DataFrame, name: str = "run"):
    """``df`` and an Observation that holds the run's counters once an action has been done."""
    from pyspark.sql import Observation

    seen = Observation(name)
    failed = F.count_if(F.col("status") == "FAILED") if "status" in df.columns else F.lit(0)
    return df.observe(seen, F.count(F.lit(1)).alias("records"), failed.alias("failed")), seen
