"""Session helpers: table access, checkpoint folder and size checks shared by all operators."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, base: str, name: str) -> DataFrame:
    """Table ``name`` of the folder ``base``; columns are pruned by the caller's plan."""
    return spark.read.parquet(f"{base}/{name}.parquet")


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder of ``spark.checkpoint.dir``; make a folder only where none is set (tests)."""
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isDefined():
        return
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured and not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if not configured:  # a local master alone: one machine holds everything, and the folder goes with the process
        configured = tempfile.mkdtemp(prefix="lavra-checkpoint-")
        atexit.register(shutil.rmtree, configured, ignore_errors=True)
    sc.setCheckpointDir(configured)


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage through reliable storage, so that a lost executor costs no recomputation."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors once per context, so that their Python need not have it installed."""
    sc = spark.sparkContext
    if getattr(sc, "_lavra_shipped", False):
        return
    root = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="lavra-package-"), "lavra_package.zip")  # read by the driver's file server
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, Path("lavra", p.relative_to(root)).as_posix())
    sc.addPyFile(str(target))
    sc._lavra_shipped = True
