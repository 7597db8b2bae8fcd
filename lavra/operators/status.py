"""The status table: what is still to do, and keyed upserts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def not_done(files: DataFrame, done: DataFrame, key: str = "id") -> DataFrame:
    """Files whose id was not written before, whatever the status of that row."""
    return files.join(done.select(key).where(F.col(key).isNotNull()).distinct(), key, "left_anti")


def to_process(files: DataFrame, table: DataFrame, keys: Sequence[str] = ("id", "pipeline"), retry_failed: bool = False) -> DataFrame:
    """Files without a row in the status table, or with IN_PROGRESS as their status.

    Any other status is final, null and FAILED included; ``retry_failed`` takes FAILED up again.
    """
    open_states = ["IN_PROGRESS", *(["FAILED"] if retry_failed else [])]
    settled = table.where(~F.coalesce(F.col("status").isin(open_states), F.lit(False))).select(*keys).distinct()
    return files.join(settled, list(keys), "left_anti")


def upsert(table: DataFrame, events: DataFrame, keys: Sequence[str], order: Sequence[str], created: str = "created_at", updated: str = "updated_at") -> DataFrame:
    """Whole-row replacement by key: the last event wins, ``created`` stays the first one's.

    Columns that an event lacks become null in its row, as a whole-row replacement has it. Ties of ``order``
    are settled by the remaining columns, so the result does not depend on the order of the rows.
    """
    both = table.unionByName(events, allowMissingColumns=True)
    rest = [c for c in both.columns if c not in keys]
    rank = F.struct(*[F.col(c) for c in (*order, *[c for c in rest if c not in order])])
    last = both.groupBy(*keys).agg(F.max_by(F.struct(*rest), rank).alias("_r"), F.min(created).alias("_c"))
    return last.select(*keys, *[F.col("_c").alias(c) if c == created else F.col(f"_r.{c}").alias(c) for c in rest])


def two_phase(records: DataFrame, started: str, finished: str) -> DataFrame:
    """Two events per record: IN_PROGRESS with its result columns empty, then the record as it is."""
    keep = {"id", "pipeline", "filepath", "file_format", started}
    begun = records.select(*[F.col(c) if c in keep else F.lit("IN_PROGRESS").alias(c) if c == "status" else F.lit(None).cast(records.schema[c].dataType).alias(c) for c in records.columns])
    return begun.withColumn("phase", F.lit(0)).unionByName(records.withColumn("phase", F.lit(1)))
