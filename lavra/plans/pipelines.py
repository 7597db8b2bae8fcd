"""Whole extraction runs: scan, expand, route, skip what is done, extract, assemble, store."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lavra.functions import paths, text
from lavra.operators import metadata, route, seams, status
from lavra.session import cut
from lavra.sources import archives, files, jsonl

RECORD = "id string, pipeline string, filepath string, file_format string, status string, tokens_count int, page_count int, text_file_s3_uri string, images_s3_uri string, extraction_started string, extraction_finished string, extraction_duration_in_seconds double, class_metadata string, error_log string, text_content string, lossy_decode boolean"


def utc_now() -> Column:
    return _iso(F.current_timestamp())


def _iso(c: Column) -> Column:
    """A moment as ISO 8601 in UTC, whatever the session's time zone."""
    return F.date_format(F.to_utc_timestamp(c, F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")


def extracted(df: DataFrame, extractors: seams.Extractors, count_tokens) -> DataFrame:
    """``df`` (route, content, name) with text, page_count, error, tokens_count, and the times of each file.

    Columns derived from the content come after every filter and anti-join of the caller.
    """
    out = df.withColumn("_out", seams.extract(extractors, F.col("route"), F.col("content"), F.col("name")))
    out = out.withColumns({"text": F.col("_out.content"), "page_count": F.col("_out.page_count"), "error": F.col("_out.error"), "started": _iso(F.col("_out.started")), "finished": _iso(F.col("_out.finished")), "seconds": F.col("_out.seconds")})
    return out.withColumn("tokens_count", count_tokens(F.col("text"))).drop("_out", "content")


def _main_files(spark: SparkSession, folder: str, base: str) -> DataFrame:
    """Files a main keeps with their ids. The scan skips other extensions before it reads any content."""
    keep = [*route.NATIVE_DOCUMENTS, *route.HTML, *route.XML]
    found = files.scan(spark, folder, extensions=keep)
    relative = F.substring(F.col("path"), F.lit(len(base.rstrip("/")) + 2), F.length("path"))
    return found.withColumn("relative_path", relative).withColumn("id", text.record_id(F.col("content"), F.col("relative_path"))).withColumn("route", route.route(F.col("ext"), "main"))


def gazette_main(spark: SparkSession, folder: str, done: DataFrame | None, extractors: seams.Extractors, count_tokens) -> DataFrame:
    """Rows of a gazette run, new files only: success rows, and error rows that hold id, names, status and error."""
    found = _main_files(spark, files.input_root(folder), folder)
    todo = status.not_done(found, done) if done is not None else found
    rows = extracted(todo, extractors, count_tokens)
    ok, name = F.col("error").isNull(), folder.rstrip("/").rsplit("/", 1)[-1]
    good = lambda c: F.when(ok, F.col(c)).alias(c)
    return rows.select(
        "id", paths.municipality(F.lit(name)).alias("municipio"), F.lit(name).alias("pasta_origem"), F.col("name").alias("nome_arquivo"), F.col("relative_path").alias("caminho_relativo"),
        F.when(ok, F.col("ext")).alias("file_format"), F.when(ok, F.col("text")).alias("text_content"), good("tokens_count"), good("page_count"),
        F.when(ok, "EXTRACTED").otherwise("FAILED").alias("status"), utc_now().alias("extraction_timestamp"), F.col("error"),
    )


def staff_main(spark: SparkSession, folder: str, done: DataFrame | None, extractors: seams.Extractors, count_tokens) -> DataFrame:
    """Rows of a staff run, new files only; files that fail give no row."""
    found = _main_files(spark, folder, folder)
    todo = status.not_done(found, done) if done is not None else found
    rows = extracted(todo, extractors, count_tokens).where("error is null")
    fields = [c.alias(k) for k, c in paths.staff_fields(F.col("relative_path")).items()]
    return rows.select("id", *fields, F.col("name").alias("nome_arquivo"), F.col("relative_path").alias("caminho_relativo"), F.col("ext").alias("file_format"), F.col("text").alias("text_content"), "tokens_count", "page_count", F.lit("EXTRACTED").alias("status"), utc_now().alias("extraction_timestamp"))


def run_main(spark: SparkSession, folder: str, output: str, kind: str, extractors: seams.Extractors, count_tokens, overwrite: bool = False) -> DataFrame:
    """One run of a main: new rows are appended to the JSON log, and the whole log is written as Parquet.

    A second run over the same tree adds nothing. Old rows are kept, and both the skipping of done files and the
    export read the log in the same tolerant way. With ``overwrite`` log and export hold the new rows only, and a
    run without new rows leaves both as they are.
    """
    log = f"{output}.jsonl"
    schema = "id string, " + ("municipio string, pasta_origem string" if kind == "gazette" else "docente string, ano string, mes string, dia string")
    schema += ", nome_arquivo string, caminho_relativo string, file_format string, text_content string, tokens_count int, page_count int, status string, extraction_timestamp string"
    schema += ", error string" if kind == "gazette" else ""
    done = cut(jsonl.processed_ids(spark, log)) if _exists(spark, log) else None
    main = gazette_main if kind == "gazette" else staff_main
    rows = main(spark, folder, done, extractors, count_tokens)
    if overwrite:
        rows = cut(rows)  # extracted once, for the test and for the log
        if rows.isEmpty():
            return spark.read.parquet(f"{output}.parquet") if _exists(spark, f"{output}.parquet") else spark.createDataFrame([], schema)
    rows.write.mode("overwrite" if overwrite else "append").json(log)
    everything = jsonl.read(spark, log, schema)
    everything.write.mode("overwrite").parquet(f"{output}.parquet")
    return spark.read.parquet(f"{output}.parquet")


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def work(spark: SparkSession, folder: str, pipeline: str, table: DataFrame | None) -> tuple[DataFrame, DataFrame]:
    """Logical files a run has to extract, with id, name, ext and route, and the archives that could not be read."""
    logical = archives.logical_files(files.scan(spark, folder))
    broken = logical.where("error is not null").select("relative_path", "error")
    named = logical.where("error is null").select("relative_path", "content").withColumn("name", paths.basename(F.col("relative_path"))).withColumn("ext", paths.suffix(F.col("name")))
    keyed = named.withColumns({"id": text.record_id(F.col("content"), F.col("relative_path")), "pipeline": F.lit(pipeline), "route": route.route(F.col("ext"), pipeline)})
    return status.to_process(keyed, table) if table is not None else keyed, broken


def extraction_run(spark: SparkSession, folder: str, pipeline: str, table: DataFrame | None, lookup: DataFrame | None, extractors: seams.Extractors, count_tokens) -> tuple[DataFrame, DataFrame]:
    """Records of a library pipeline over a tree with archives, and the archives that could not be read.

    Files with a final status in ``table`` are skipped before extraction. Failed files are records too. Start, end
    and duration are measured for each file.
    """
    todo, broken = work(spark, folder, pipeline, table)
    rows = extracted(todo, extractors, count_tokens)
    if lookup is not None:
        rows = metadata.attach(rows, "relative_path", lookup, F.to_json(F.struct(*[c for c in lookup.columns if c != "key"])))
    else:
        rows = rows.withColumn("class_metadata", F.lit(None).cast("string"))
    uris = paths.output_uris(F.col("id"), pipeline)
    out = rows.select(
        "id", "pipeline", F.col("relative_path").alias("filepath"), F.col("ext").alias("file_format"), F.when(F.col("error").isNull(), "EXTRACTED").otherwise("FAILED").alias("status"),
        "tokens_count", "page_count", uris["text_file_s3_uri"].alias("text_file_s3_uri"), uris["images_s3_uri"].alias("images_s3_uri"), F.col("started").alias("extraction_started"), F.col("finished").alias("extraction_finished"),
        F.col("seconds").alias("extraction_duration_in_seconds"), "class_metadata", F.col("error").alias("error_log"), F.col("text").alias("text_content"), route.lossy(F.col("ext"), pipeline).alias("lossy_decode"),
    )
    return out, broken


def run_library(spark: SparkSession, folder: str, pipeline: str, tables: str, lookup: DataFrame | None, extractors: seams.Extractors, count_tokens) -> DataFrame:
    """A whole run against a status table in two phases; returns the table.

    ``tables`` is a folder of versions of the table. First every file to be extracted is written as IN_PROGRESS,
    then its record replaces that row. A run that dies in between leaves the IN_PROGRESS rows, and the next run takes
    those files up again.
    """
    known = newest(spark, tables)
    todo, _ = work(spark, folder, pipeline, known)
    begun = todo.select("id", "pipeline", F.col("relative_path").alias("filepath"), F.col("ext").alias("file_format"), F.lit("IN_PROGRESS").alias("status"), utc_now().alias("extraction_started"))
    empty = spark.createDataFrame([], RECORD).drop("lossy_decode")
    started = save_records(empty.unionByName(begun, allowMissingColumns=True), next_version(spark, tables), known)
    records, _ = extraction_run(spark, folder, pipeline, started, lookup, extractors, count_tokens)
    return save_records(records, next_version(spark, tables), started)


def _versions(spark: SparkSession, tables: str) -> list[int]:
    """Numbers of the finished versions in a folder; one entry per run."""
    if not _exists(spark, tables):
        return []
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(tables)
    found = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(p)
    names = [f.getPath().getName() for f in found]
    return sorted(int(n.removeprefix("v")) for n in names if n.startswith("v") and n[1:].isdigit() and _exists(spark, f"{tables}/{n}/_SUCCESS"))


def newest(spark: SparkSession, tables: str) -> DataFrame | None:
    done = _versions(spark, tables)
    return spark.read.parquet(f"{tables}/v{done[-1]}") if done else None


def next_version(spark: SparkSession, tables: str) -> str:
    return f"{tables}/v{max(_versions(spark, tables), default=0) + 1}"


def profile(spark: SparkSession, folder: str) -> DataFrame:
    """Extension profile of a tree; no content is read."""
    from lavra.operators import corpus

    return corpus.extension_profile(files.scan(spark, folder, content=False), "path")


def save_records(records: DataFrame, target: str, table: DataFrame | None) -> DataFrame:
    """Upsert a run's records into the status table and write it as a new Parquet version; returns that version."""
    stamped = records.drop("lossy_decode").withColumns({"created_at": F.current_timestamp(), "updated_at": F.current_timestamp()})
    merged = status.upsert(table if table is not None else stamped.limit(0), stamped, ["id", "pipeline"], ["updated_at"])
    cut(merged).write.mode("overwrite").parquet(target)
    return records.sparkSession.read.parquet(target)
