"""Versioned releases of the final batches in a shared folder or object store, with a card and a manifest."""

from __future__ import annotations

import json

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lavra.sources import objects, store

#: What each pipeline is published as.
TARGETS = {"docling": ("docling-1", "docling"), "deepseek": ("deepseek-ocr-2", None)}


#: Tags of every release.
TAGS = ("ocr", "pdf", "text-extraction")


def _table(left: str, right: str, rows) -> list[str]:
    return [f"| {left} | {right} |", "|---|---|", *[f"| {a} | {b} |" for a, b in rows]]


def tag(version: str, branch: str | None) -> str:
    return f"v{version}" + (f"-{branch}" if branch else "")


def card(name: str, pipeline: str, version: str, schema: DataFrame | None = None, history: list[str] = ()) -> str:
    """Markdown card with a YAML header; with the columns and earlier versions if given."""
    model, _ = TARGETS[pipeline]
    header = {"license": "other", "tags": [*TAGS, model], "version": version, "configs": [{"config_name": "default", "data_files": [{"split": "train", "path": "data/*.jsonl"}]}]}
    facts = {"Extraction model": model, "Dataset version": version, "Pipeline": pipeline.capitalize()}
    # JSON is YAML, so the header needs no writer of its own.
    body = ["---", *[f"{k}: {json.dumps(v, ensure_ascii=False)}" for k, v in header.items()], "---", "", f"# {name}", "", *_table("Field", "Value", facts.items())]
    if schema is not None:
        body += ["", "## Columns", "", *_table("Column", "Type", ((f.name, f.dataType.simpleString()) for f in schema.schema))]
    if history:
        body += ["", "## Versions", "", *[f"- {v}" for v in history]]
    return "\n".join([*body, ""])


def publish(source: str, target: str, name: str, pipeline: str, version: str, replace: bool = False) -> dict:
    """Copy the files of a batch folder into ``target/data`` and write card, manifest and tag.

    The tasks copy the files and take their digests in the same pass; names and digests are written as JSON lines
    in ``target/manifests/<tag>``, and only their number comes to the driver. ``replace`` removes the data of
    earlier versions first; otherwise files are added. A version is published once: its tag must not exist.
    """
    spark = SparkSession.builder.getOrCreate()
    label = tag(version, TARGETS[pipeline][1])
    data, manifest, mark = (store.join(target, x) for x in ("data", f"manifests/{label}", f"tags/{label}"))
    if store.exists(mark):
        raise FileExistsError(label)
    if replace:
        store.delete(data)
    listed = objects.list_keys(spark, source).select("key", F.col("key").alias("to"))
    store.transfer(listed, "key", "to", source, data).select(F.concat(F.lit("data/"), "key").alias("file"), "size", "sha256", "error").write.mode("overwrite").json(manifest)
    files = spark.read.schema("file string, size bigint, sha256 string, error string").json(manifest)
    counts = files.agg(F.count("*").alias("n"), F.coalesce(F.sum("size"), F.lit(0)).alias("bytes"), F.count("error").alias("failed")).first()
    if counts.failed:
        raise OSError(f"{counts.failed} files could not be copied; see {manifest}")
    system, p = store.at(store.join(target, "tags"))
    earlier = sorted(f.base_name for f in system.get_file_info(fs.FileSelector(p, allow_not_found=True)))  # one per version
    store.write(store.join(target, "README.md"), [card(name, pipeline, version, history=earlier).encode("utf-8")])
    out = {"name": name, "pipeline": pipeline, "version": version, "tag": label, "replaced": replace, "files": counts.n, "bytes": counts.bytes}
    store.write(mark, [json.dumps(out, ensure_ascii=False, indent=2).encode("utf-8")])
    return out
