"""Incremental ingest: output logs as a stream, new records upserted per micro-batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from lavra.operators import status
from lavra.plans.pipelines import _exists
from lavra.session import cut
from lavra.sources import jsonl


def upsert_stream(spark: SparkSession, folder: str, schema: str, target: str, checkpoint: str, keys: list[str], order: list[str]) -> StreamingQuery:
    """Read the JSON lines that are new in ``folder``, upsert them into the Parquet table ``target``, then stop.

    What was read is remembered in ``checkpoint``; a micro-batch that is repeated after a failure changes
    nothing, as an upsert of the same rows gives the same table. Versions are written beside the target and the
    newest is named in the file of the current version, so readers never see a half-written table.
    """
    lines = spark.readStream.text(folder)

    def apply(batch: DataFrame, number: int) -> None:
        new = jsonl.parse(batch, "value", schema)
        old = current(spark, target)
        if old is None:
            old = new.limit(0)
        merged = cut(status.upsert(old, new, keys, order, created=order[0], updated=order[-1]))
        merged.write.mode("overwrite").parquet(f"{target}/version={number}")
        spark.createDataFrame([(number,)], "version int").coalesce(1).write.mode("overwrite").json(f"{target}/_current")

    return lines.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def current(spark: SparkSession, target: str) -> DataFrame | None:
    """The newest complete version of the table, None before the first."""
    if not _exists(spark, f"{target}/_current"):
        return None
    version = spark.read.schema("version int").json(f"{target}/_current").first()[0]
    return spark.read.parquet(f"{target}/version={version}")
