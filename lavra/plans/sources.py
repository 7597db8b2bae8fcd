"""Queries that exercise sources and Arrow functions over whole test tables."""

from __future__ import annotations

import io
import os
import uuid
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lavra.functions import text
from lavra.session import ensure_checkpoint_dir, read_table
from lavra.sources import archives, files, store

#: Folder of the public vocabulary files.
TOKENIZERS = os.environ.get("LAVRA_TOKENIZERS", "/opt/tokenizers")


def _zipped(rows: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in rows:
        out = []
        for doc, pages in pdf.itertuples(index=False):
            buffer = io.BytesIO()
            with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as z:
                for page in pages:
                    z.writestr(f"pagina_{page['page_num']:04d}.txt", page["text"] or "")
            out.append((f"{doc}.zip", buffer.getvalue()))
        yield pd.DataFrame(out, columns=["relative", "content"])


def archive_expand(spark: SparkSession, base: str) -> DataFrame:
    """The distinct pages of every document, packed into one archive per document and expanded again."""
    p = read_table(spark, base, "page_results").where("page_num is not null").groupBy("doc_id", "page_num").agg(F.max("text").alias("text"))
    docs = p.groupBy("doc_id").agg(F.collect_list(F.struct("page_num", "text")).alias("pages"))
    packed = docs.mapInPandas(_zipped, "relative string, content binary")
    return archives.expand(packed, "relative", "content").select("relative", text.utf8(F.col("data")).alias("text"), "error")


def xml_to_json(spark: SparkSession, base: str) -> DataFrame:
    s = read_table(spark, base, "staff_record")
    esc = lambda c: F.replace(F.replace(F.replace(F.coalesce(c, F.lit("")), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit('"'), F.lit("&quot;"))
    doc = F.concat(F.lit('<r xmlns="u" formato="'), esc(F.col("file_format")), F.lit('"><i>'), esc(F.col("docente")), F.lit('</i><i k="v">'), esc(F.col("ano")), F.lit("</i><e/> cauda </r>"))
    return s.select("id", "caminho_relativo", text.xml_to_json(doc).alias("_x")).select("id", "caminho_relativo", F.col("_x.content").alias("json"), F.col("_x.error").alias("error"))


def file_scan(spark: SparkSession, base: str) -> DataFrame:
    """A tree with one file per page of every document, written by the tasks and scanned again with its content."""
    ensure_checkpoint_dir(spark)
    shared = spark.sparkContext._jsc.sc().getCheckpointDir().get().removeprefix("file:")  # a folder all executors see
    folder = f"{shared}/scanned-{uuid.uuid4().hex}"
    p = read_table(spark, base, "page_results").where("doc_id is not null and page_num is not null").groupBy("doc_id", "page_num").agg(F.max("text").alias("text"))
    named = p.select(F.concat("doc_id", F.lit("/."), F.col("page_num").cast("string"), F.lit(".TXT")).alias("name"), F.coalesce("text", F.lit("")).alias("text"))
    store.write_texts(named, "name", "text", folder).agg(F.count("error")).collect()
    found = files.scan(spark, folder, content=True)
    return found.select("relative_path", "name", "ext", "length", F.md5("content").alias("digest"))


def token_count(spark: SparkSession, base: str) -> DataFrame:
    count = text.token_counter(f"{TOKENIZERS}/byte_bpe_50k.tiktoken", text.TOKEN_PATTERN)
    return read_table(spark, base, "documents").select("doc_id", count(F.col("text")).alias("tokens_byte_bpe_50k"))


QUERIES = {f.__name__: f for f in (archive_expand, xml_to_json, file_scan, token_count)}
SQL = {
    "file_scan": "WITH p AS (SELECT doc_id, page_num, coalesce(max(text), '') AS text FROM page_results WHERE doc_id IS NOT NULL AND page_num IS NOT NULL GROUP BY doc_id, page_num) SELECT doc_id || '/.' || page_num || '.TXT' AS relative_path, '.' || page_num || '.TXT' AS name, '.txt' AS ext, strlen(text) AS length, md5(text) AS digest FROM p",
    "archive_expand": "SELECT doc_id || '.zip/' || printf('pagina_%04d.txt', page_num) AS relative, coalesce(max(text), '') AS text, CAST(NULL AS VARCHAR) AS error FROM page_results WHERE page_num IS NOT NULL GROUP BY doc_id, page_num",
    # The formatted JSON is spelled out; only quotes, backslashes and control characters would need escapes.
    "xml_to_json": """SELECT id, caminho_relativo, '{' || chr(10) || '  "r": {' || chr(10) || '    "@attributes": {' || chr(10) || '      "formato": "' || coalesce(file_format, '') || '"' || chr(10) || '    },' || chr(10)
  || '    "i": [' || chr(10) || '      ' || CASE WHEN trim(coalesce(docente, '')) = '' THEN '{}' ELSE '"' || trim(docente) || '"' END || ',' || chr(10) || '      {' || chr(10) || '        "@attributes": {' || chr(10) || '          "k": "v"' || chr(10) || '        }'
  || CASE WHEN trim(coalesce(ano, '')) = '' THEN '' ELSE ',' || chr(10) || '        "#text": "' || trim(ano) || '"' END || chr(10) || '      }' || chr(10) || '    ],' || chr(10) || '    "e": {}' || chr(10) || '  }' || chr(10) || '}' AS json, CAST(NULL AS VARCHAR) AS error FROM staff_record""",
}
