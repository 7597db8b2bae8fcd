"""Queries of the extraction operators over the test tables, with the SQL each must equal."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lavra.functions import paths, text
from lavra.operators import batches, corpus, images, metadata, pages, route, status
from lavra.session import read_table

_NAME = "regexp_extract(filepath, '([^/]*)$', 1)"
_SUFFIX = f"lower(regexp_extract({_NAME}, '(?s)^\\.*[^.].*(\\.[^.]+)$', 1))"
_SPLITEXT = f"lower(regexp_extract({_NAME}, '(?s)^\\.*[^.].*?(\\.[^.]*)$', 1))"
_WS = "[\\s\\x0b\\x1c-\\x1f\\x85\\p{Z}]"


def _in(exts: tuple[str, ...]) -> str:
    return "(" + ", ".join(f"'{e}'" for e in exts) + ")"


def _strip(x: str) -> str:
    return f"regexp_replace({x}, '^{_WS}+|{_WS}+$', '', 'g')"


def record_id(spark: SparkSession, base: str) -> DataFrame:
    d = read_table(spark, base, "documents")
    rel = F.concat_ws("/", "source", F.concat(F.col("doc_id").cast("string"), F.coalesce("file_format", F.lit(""))))
    return d.select("doc_id", text.record_id(F.encode(F.coalesce("text", F.lit("")), "UTF-8"), rel).alias("id"))


def html_to_text(spark: SparkSession, base: str) -> DataFrame:
    return read_table(spark, base, "extraction_records").select("id", "pipeline", text.html_to_text(F.col("text_content")).alias("plain"))


# Fixed values of the comparison, spelled out so that it doesn't share the operators' tables: entities, extensions.
_ENTITIES = (("&copy;", '©'), ("&middot;", '·'), ("&ordm;", 'º'), ("&ccedil;", 'ç'), ("&atilde;", 'ã'), ("&lt;", '<'), ("&gt;", '>'), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", '\xa0'), ("&amp;", '&'))
_SQL_VIDEO = (".mp4", ".mkv", ".avi", ".mov", ".webm", ".flv", ".wmv", ".m4v", ".ts", ".mts")
_SQL_AUDIO = (".mp3", ".wav", ".ogg", ".flac", ".aac", ".m4a", ".opus", ".wma", ".aiff")
_SQL_OFFICE = (".doc", ".docx", ".ppt", ".pptx", ".pps", ".ppsx", ".xls", ".xlsx", ".odt", ".ods", ".odp", ".rtf")
_SQL_IMAGE = (".png", ".jpg", ".jpeg", ".jp", ".webp", ".pgm")
_SQL_MARKUP = (("html", (".html", ".htm")), ("xml", (".xml",)))
_SQL_NATIVE = (".pdf", ".docx", ".doc", ".pptx", ".xlsx", ".xls", ".ppt")
_SQL_BRANCHES = {
    "docling": ((*_SQL_MARKUP, ("document", _SQL_NATIVE), ("audio", _SQL_AUDIO), ("video", _SQL_VIDEO)), "raw_text"),
    "deepseek": ((*_SQL_MARKUP, ("image", _SQL_IMAGE), ("document", (*_SQL_OFFICE, ".pdf")), ("audio", _SQL_AUDIO), ("video", _SQL_VIDEO)), "raw_text"),
    "main": ((("document", _SQL_NATIVE), *_SQL_MARKUP), None),
    "notebook": ((("image", _SQL_IMAGE), ("document", (*_SQL_OFFICE, ".pdf"))), "raw_text"),
}


def html_to_text_parsed(spark: SparkSession, base: str) -> DataFrame:
    """The parser form that whole runs use, over pages made of the pages' texts."""
    p = read_table(spark, base, "page_results")
    body = F.replace(F.replace(F.coalesce("text", F.lit("")), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    page = F.concat(F.lit("<html><head><title>P "), F.col("page_num").cast("string"), F.lit("</title><script>var a = '<p>';</script><!-- x --></head><body><h1>&#x41;t&#111;</h1><p>"), body, F.lit("<br/>fim</p></body></html>"))
    return p.select("doc_id", "page_num", text.html_to_text_any(page).alias("plain"))


def _html_sql() -> str:
    x = "text_content"
    for pattern, flags in (("<script\\b[^>]*>.*?</script\\s*>", "gis"), ("<style\\b[^>]*>.*?</style\\s*>", "gis"), ("<!--.*?-->", "gs"), ("<[!/?a-zA-Z][^>]*>", "gs")):
        x = f"regexp_replace({x}, '{pattern}', chr(1), '{flags}')"
    for entity, char in _ENTITIES:
        x = f"replace({x}, '{entity}', '{char.replace(chr(39), chr(39) * 2)}')"
    return f"SELECT id, pipeline, array_to_string(list_filter(list_transform(string_split({x}, chr(1)), lambda p: {_strip('p')}), lambda p: p <> ''), chr(10)) AS plain FROM extraction_records"


def word_count(spark: SparkSession, base: str) -> DataFrame:
    return read_table(spark, base, "documents").select("doc_id", text.word_count(F.col("text")).alias("n_words"))


def _with_refs(p: DataFrame) -> DataFrame:
    """Pages as a model returns them: each text between two image references, the second with an unreadable box."""
    one = F.concat(F.lit("<|ref|>image<|/ref|><|det|>[["), F.concat_ws(",", *[(F.pmod(F.char_length("text") * F.lit(k), F.lit(1000))).cast("string") for k in (3, 5, 7, 11)]), F.lit("]]<|/det|>"))
    bad = F.lit("<|ref|>image<|/ref|><|det|>[[none]]<|/det|>")
    return p.select("doc_id", "page_num", F.concat(F.lit("<center>"), one, F.lit("\n# Página 7  \n"), "text", F.lit("</CENTER>\n\n\n\n"), bad).alias("raw"))


_RAW_SQL = """SELECT doc_id, page_num, '<center><|ref|>image<|/ref|><|det|>[[' || (length(text)*3)%1000 || ',' || (length(text)*5)%1000 || ',' || (length(text)*7)%1000 || ',' || (length(text)*11)%1000
  || ']]<|/det|>' || chr(10) || '# Página 7  ' || chr(10) || text || '</CENTER>' || repeat(chr(10), 4) || '<|ref|>image<|/ref|><|det|>[[none]]<|/det|>' AS raw, length(text) AS n FROM page_results"""


def _clean_sql(x: str) -> str:
    for pattern, to, flags in (("</?center>", "''", "gi"), ("<\\|ref\\|>.*?<\\|/ref\\|>", "''", "gs"), ("<\\|det\\|>.*?<\\|/det\\|>", "''", "gs"), ("\\n{3,}", "repeat(chr(10), 2)", "g")):
        x = f"regexp_replace({x}, '{pattern}', {to}, '{flags}')"
    lines = f"string_split(regexp_replace({x}, '\\r\\n|[\\n\\r\\x0b\\x0c\\x1c-\\x1e\\x85\\x{{2028}}\\x{{2029}}]', chr(10), 'g'), chr(10))"
    kept = f"list_filter({lines}, lambda l: NOT regexp_matches(l, '^{_WS}*#{_WS}*Página{_WS}+\\p{{Nd}}+{_WS}*$', 'i'))"
    return _strip(f"array_to_string(list_transform({kept}, lambda l: regexp_replace(l, '{_WS}+$', '')), chr(10))")


def ocr_markdown_clean(spark: SparkSession, base: str) -> DataFrame:
    return _with_refs(read_table(spark, base, "page_results")).select("doc_id", "page_num", text.clean_ocr(F.col("raw")).alias("markdown"))


def bbox_scale(spark: SparkSession, base: str) -> DataFrame:
    p = _with_refs(read_table(spark, base, "page_results")).select("*", F.lit(1000).alias("width"), F.lit(2000).alias("height"))
    return images.image_refs(p, "raw", "page_num", "width", "height").select("doc_id", "page_num", "img_no", "crop", "x0", "y0", "x1", "y1")


def image_ref_replace(spark: SparkSession, base: str) -> DataFrame:
    p = _with_refs(read_table(spark, base, "page_results"))
    return p.select("doc_id", "page_num", images.replace_refs(F.col("raw"), F.col("page_num"), F.concat(F.lit("images/"), "doc_id")).alias("markdown"))


_REF_MARK = "'![Image](images/' || doc_id || '/' || printf('page_%04d_img_%02d.png', page_num, 2) || ')' || chr(10) || '<ImageContent image_path=\"images/' || doc_id || '/' || printf('page_%04d_img_%02d.png', page_num, 2) || '\"></ImageContent>'"


def page_assemble(spark: SparkSession, base: str) -> DataFrame:
    return pages.assemble(read_table(spark, base, "page_results"), "doc_id", "page_num", "text")


def page_concat_raw(spark: SparkSession, base: str) -> DataFrame:
    return pages.concatenate(read_table(spark, base, "page_results"), "doc_id", "page_num", "text")


def page_chunks(spark: SparkSession, base: str) -> DataFrame:
    p = read_table(spark, base, "page_results")
    return p.groupBy("doc_id", pages.chunk(F.col("page_num"), 5).alias("chunk")).agg(F.count("*").alias("n_pages"), F.min("page_num").alias("first_page"), F.max("page_num").alias("last_page"))


def page_subset(spark: SparkSession, base: str) -> DataFrame:
    return pages.select_pages(read_table(spark, base, "page_results"), "doc_id", "page_num", [2, 0]).select("doc_id", "page_num", "position", "text")


def section_assemble(spark: SparkSession, base: str) -> DataFrame:
    p = read_table(spark, base, "page_results")
    speech = pages.transcript(p, "doc_id", "page_num", "text").withColumnRenamed("text", "_speech")
    frames = p.groupBy("doc_id").agg(F.collect_set(F.struct(F.col("page_num").alias("frame"), F.col("text").alias("text"))).alias("_frames"))
    both = speech.join(frames, "doc_id")
    name, none = F.concat("doc_id", F.lit(".mp4")), F.lit(None).cast("string")
    return both.select("doc_id", pages.audio_text(name, F.col("_speech"), none).alias("audio"), pages.video_text(name, none, F.lit("sem áudio"), F.col("_frames")).alias("video"))


def extension_profile(spark: SparkSession, base: str) -> DataFrame:
    return corpus.extension_profile(read_table(spark, base, "extraction_records"), "filepath")


def extension_groups(spark: SparkSession, base: str) -> DataFrame:
    return corpus.extension_groups(read_table(spark, base, "extraction_records"), "filepath")


def distinct_extensions(spark: SparkSession, base: str) -> DataFrame:
    return corpus.distinct_extensions(read_table(spark, base, "extraction_records"), "filepath")


def prefix_listing(spark: SparkSession, base: str) -> DataFrame:
    keys = read_table(spark, base, "extraction_records").select("filepath")
    root = corpus.first_segments(keys, "filepath").select(F.lit("root").alias("level"), "prefix")
    return root.union(corpus.sub_folders(keys, "filepath", "data/input/").select(F.lit("sub"), "prefix"))


def prefix_count(spark: SparkSession, base: str) -> DataFrame:
    keys = read_table(spark, base, "extraction_records").select("filepath")
    return corpus.under(keys, "filepath", "data/input/").agg(F.count("*").alias("n_keys"))


def batch_bucket(spark: SparkSession, base: str) -> DataFrame:
    out = batches.batched(read_table(spark, base, "documents").select("doc_id"), "doc_id")
    return out.groupBy("batch").agg(F.count("*").alias("n_rows"), F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id")).withColumn("file_name", batches.batch_name(F.col("batch")))


def batch_final_records(spark: SparkSession, base: str) -> DataFrame:
    e = read_table(spark, base, "extraction_records")
    texts = e.where(F.col("text_content").isNotNull()).select("id", "text_content").dropDuplicates(["id"])
    return batches.final_records(e.drop("created_at", "updated_at"), texts)


_UPSERT = ("id", "pipeline", "status", "tokens_count", "page_count", "error_log", "created_at", "updated_at")


def status_upsert(spark: SparkSession, base: str) -> DataFrame:
    e = read_table(spark, base, "extraction_records").select(*_UPSERT)
    begun = F.col("status") == "IN_PROGRESS"
    return status.upsert(e.where(begun), e.where(~F.coalesce(begun, F.lit(False))), ["id", "pipeline"], ["updated_at"])


def resume_filter(spark: SparkSession, base: str) -> DataFrame:
    files = read_table(spark, base, "extraction_records").select("id", "pipeline", "filepath", "status")
    return status.not_done(files, read_table(spark, base, "gazette_record"))


def status_resume(spark: SparkSession, base: str) -> DataFrame:
    e = read_table(spark, base, "extraction_records").select("id", "pipeline", "status")
    return status.to_process(e.select("id", "pipeline").distinct(), e)


def route_dispatch(spark: SparkSession, base: str) -> DataFrame:
    f = read_table(spark, base, "extraction_records").select("id", "pipeline", "filepath")
    ext = paths.suffix(paths.basename(F.col("filepath")))
    out = route.routed(f, "filepath").withColumns({"file_class": route.file_class(ext), "pdf_filter": route.pdf_filter(ext), "kept_by_main": route.allowed(paths.splitext(paths.basename(F.col("filepath"))))})
    return out.withColumn("lossy_docling", route.lossy(ext, "docling")).drop("filepath")


def _route_sql() -> str:
    cols = []
    for p, (branches, rest) in _SQL_BRANCHES.items():
        ext = "sx" if p == "main" else "ext"
        whens = " ".join(f"WHEN {ext} IN {_in(exts)} THEN '{kind}'" for kind, exts in branches)
        cols.append(f"CASE WHEN filepath IS NULL THEN NULL {whens} ELSE {repr(rest) if rest else 'NULL'} END AS route_{p}")
    kinds = (("video", _SQL_VIDEO), ("audio", _SQL_AUDIO), ("office", _SQL_OFFICE), ("pdf", (".pdf",)), ("image", _SQL_IMAGE))
    cls = "CASE " + " ".join(f"WHEN ext IN {_in(e)} THEN '{k}'" for k, e in kinds) + " ELSE 'other' END"
    return f"""WITH f AS (SELECT id, pipeline, filepath, {_SUFFIX} AS ext, {_SPLITEXT} AS sx FROM extraction_records), g AS (SELECT *, {', '.join(cols)}, {cls} AS file_class FROM f)
SELECT id, pipeline, {', '.join(f'route_{p}' for p in _SQL_BRANCHES)}, file_class,
  CASE WHEN ext IN {_in((".ppt", ".pptx", ".odp"))} THEN 'pdf:impress_pdf_Export' WHEN ext IN {_in((".xls", ".xlsx", ".ods", ".csv"))} THEN 'pdf:calc_pdf_Export' ELSE 'pdf:writer_pdf_Export' END AS pdf_filter,
  sx IN {_in((*_SQL_NATIVE, ".html", ".htm", ".xml"))} AS kept_by_main, route_docling = 'raw_text' AND file_class <> 'other' AS lossy_docling FROM g"""


def path_metadata_staff(spark: SparkSession, base: str) -> DataFrame:
    p = F.col("caminho_relativo")
    return read_table(spark, base, "staff_record").select("id", *[c.alias(k) for k, c in paths.staff_fields(p).items()], paths.basename(p).alias("nome_arquivo"), paths.stem(paths.basename(p)).alias("stem"))


def path_metadata_gazette(spark: SparkSession, base: str) -> DataFrame:
    p = F.col("caminho_relativo")
    return read_table(spark, base, "gazette_record").select("id", paths.municipality(F.col("pasta_origem")).alias("municipio"), paths.basename(p).alias("nome_arquivo"), paths.parent(p).alias("pasta"))


def _course_documents(spark: SparkSession, base: str) -> DataFrame:
    """Professor documents as the metadata export has them, put together from the staff rows."""
    s = read_table(spark, base, "staff_record").select("docente", F.coalesce("ano", F.lit("")).alias("ano"), F.concat_ws("/", "mes", "dia").alias("titulo"), "caminho_relativo", "nome_arquivo").where("docente is not null")
    local = F.concat(F.lit("files/"), F.regexp_replace("caminho_relativo", r"^[^/]*/", ""))
    files = s.groupBy("docente", "ano", "titulo").agg(F.sort_array(F.collect_set(F.struct(local.alias("path_local"), "nome_arquivo"))).alias("arquivos"))
    plans = files.groupBy("docente", "ano").agg(F.sort_array(F.collect_list(F.struct("titulo", "arquivos"))).alias("planos_aula"))
    return plans.groupBy("docente").agg(F.sort_array(F.collect_list(F.struct("ano", F.col("docente").alias("professor"), "planos_aula"))).alias("turmas"))


def class_metadata_lookup(spark: SparkSession, base: str) -> DataFrame:
    table = metadata.lookup(_course_documents(spark, base), "docente")
    value = F.concat_ws("|", "turma.professor", "turma.ano", "plano_aula.titulo", "arquivo.path_local")
    files = read_table(spark, base, "extraction_records").select("id", "pipeline", "filepath")
    return metadata.attach(files, "filepath", table, value, "found")


def json_field(spark: SparkSession, base: str) -> DataFrame:
    meta = F.col("class_metadata")
    return read_table(spark, base, "extraction_records").select("id", "pipeline", *[F.get_json_object(meta, f"$.{p}").alias(p.replace(".", "_")) for p in ("turma.codigo", "plano_aula.titulo", "arquivo.nome_arquivo")])


def jsonl_clean(spark: SparkSession, base: str) -> DataFrame:
    from lavra.sources import jsonl

    lines = read_table(spark, base, "events").select(F.concat(F.when(F.col("event_id") % 3 == 0, "'").otherwise(" "), F.when(F.col("event_id") % 5 == 0, F.substring("props", 1, 5)).otherwise(F.col("props")), F.when(F.col("event_id") % 7 == 0, "''\n").otherwise("")).alias("value"), "event_id")
    return jsonl.parse(lines, "value", "k INT").select("event_id", "k")


def log_suppress(spark: SparkSession, base: str) -> DataFrame:
    return corpus.suppress(read_table(spark, base, "log_lines"), read_table(spark, base, "log_rules"))


def copy_status_summary(spark: SparkSession, base: str) -> DataFrame:
    g = read_table(spark, base, "gazette_record").select(F.concat_ws("/", "pasta_origem", F.lit("pdfs"), "caminho_relativo").alias("src"), F.concat_ws("/", F.lit("data"), "caminho_relativo").alias("dst"))
    have = read_table(spark, base, "extraction_records").select("filepath")
    return corpus.summary(corpus.copy_status(g, "src", "dst", have, "filepath"))


def published_uris(spark: SparkSession, base: str) -> DataFrame:
    e = read_table(spark, base, "extraction_records")
    uris = {p: paths.output_uris(F.col("id"), p) for p in ("docling", "deepseek")}
    cols = [F.coalesce(*[F.when(F.col("pipeline") == p, u[name]) for p, u in uris.items()]).alias(name) for name in ("text_file_s3_uri", "images_s3_uri")]
    seconds = F.to_timestamp("extraction_finished").cast("double") - F.to_timestamp("extraction_started").cast("double")
    return e.select("id", "pipeline", *cols, F.round(seconds, 3).alias("seconds"))


QUERIES = {
    f.__name__: f
    for f in (
        record_id, html_to_text, html_to_text_parsed, word_count, ocr_markdown_clean, bbox_scale, image_ref_replace, page_assemble, page_concat_raw, page_chunks, page_subset, section_assemble,
        extension_profile, extension_groups, distinct_extensions, prefix_listing, prefix_count, batch_bucket, batch_final_records, status_upsert, resume_filter, status_resume, route_dispatch,
        path_metadata_staff, path_metadata_gazette, class_metadata_lookup, json_field, jsonl_clean, log_suppress, copy_status_summary, published_uris,
    )
}

SQL = {
    "record_id": "SELECT doc_id, sha256(coalesce(text, '') || concat_ws('/', source, doc_id || coalesce(file_format, ''))) AS id FROM documents",
    "html_to_text_parsed": f"SELECT doc_id, page_num, 'P ' || page_num || chr(10) || 'Ato' || chr(10) || CASE WHEN {_strip("coalesce(text, '')")} = '' THEN '' ELSE {_strip('text')} || chr(10) END || 'fim' AS plain FROM page_results",
    "html_to_text": _html_sql(),
    "word_count": f"SELECT doc_id, CAST(len(list_filter(regexp_split_to_array(text, '{_WS}+'), lambda w: w <> '')) AS INTEGER) AS n_words FROM documents",
    "ocr_markdown_clean": f"SELECT doc_id, page_num, {_clean_sql('raw')} AS markdown FROM ({_RAW_SQL})",
    "bbox_scale": f"""SELECT doc_id, page_num, 2 AS img_no, printf('page_%04d_img_%02d.png', page_num, 2) AS crop,
  (n*3)%1000 / 1000.0 * 1000 AS x0, (n*5)%1000 / 1000.0 * 2000 AS y0, (n*7)%1000 / 1000.0 * 1000 AS x1, (n*11)%1000 / 1000.0 * 2000 AS y1 FROM ({_RAW_SQL}) WHERE raw IS NOT NULL
UNION ALL SELECT doc_id, page_num, 1, printf('page_%04d_img_%02d.png', page_num, 1), NULL, NULL, NULL, NULL FROM ({_RAW_SQL}) WHERE raw IS NOT NULL""",
    "image_ref_replace": f"""SELECT doc_id, page_num, {_clean_sql(f"regexp_replace(raw, '<\\|ref\\|>image<\\|/ref\\|><\\|det\\|>\\[\\[[0-9,]+\\]\\]<\\|/det\\|>', {_REF_MARK})")} AS markdown FROM ({_RAW_SQL})""",
    "page_assemble": f"""WITH p AS (SELECT doc_id, page_num, text AS raw, {_strip("coalesce(text, '')")} AS t FROM page_results)
SELECT doc_id, count(*) AS page_count, coalesce(string_agg(t, chr(10) || chr(10) ORDER BY page_num NULLS FIRST, raw NULLS FIRST) FILTER (t <> ''), '') AS text FROM p GROUP BY doc_id""",
    "page_concat_raw": "SELECT doc_id, count(*) AS page_count, string_agg(coalesce(text, '') || chr(10) || chr(10), '' ORDER BY page_num NULLS FIRST, text NULLS FIRST) AS text FROM page_results GROUP BY doc_id",
    "page_chunks": "SELECT doc_id, CAST(floor((page_num - 1) / 5) AS INTEGER) AS chunk, count(*) AS n_pages, min(page_num) AS first_page, max(page_num) AS last_page FROM page_results GROUP BY 1, 2",
    "page_subset": "SELECT doc_id, page_num, CASE page_num WHEN 3 THEN 0 ELSE 1 END AS position, text FROM page_results WHERE page_num IN (1, 3)",
    "section_assemble": f"""WITH p AS (SELECT DISTINCT doc_id, page_num, text, {_strip("coalesce(text, '')")} AS t FROM page_results),
a AS (SELECT doc_id, {_strip("string_agg(t, chr(10) || chr(10) ORDER BY page_num NULLS FIRST, raw NULLS FIRST)")} AS speech FROM (SELECT doc_id, page_num, text AS raw, {_strip("coalesce(text, '')")} AS t FROM page_results) GROUP BY doc_id),
r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY page_num NULLS FIRST, text NULLS FIRST) AS rn FROM p),
v AS (SELECT doc_id, string_agg('### Frame ' || page_num || repeat(chr(10), 3) || t, repeat(chr(10), 2) ORDER BY page_num, text) FILTER (t <> '' AND rn <= 50) AS frames FROM r GROUP BY doc_id)
SELECT a.doc_id, '# Transcrição de Áudio: ' || a.doc_id || '.mp4' || repeat(chr(10), 3) || CASE WHEN speech = '' THEN '_Nenhuma fala detectada._' ELSE speech END AS audio,
 '# Conteúdo do Vídeo: ' || a.doc_id || '.mp4' || repeat(chr(10), 3) || '## Transcrição de Áudio' || repeat(chr(10), 3) || '_Erro na transcrição: sem áudio_'
 || coalesce(repeat(chr(10), 3) || '## Conteúdo Visual (Frames de Cena)' || repeat(chr(10), 3) || frames, '') AS video FROM a JOIN v ON a.doc_id = v.doc_id""",
    "extension_groups": f"SELECT count(DISTINCT coalesce({_SUFFIX}, '')) AS groups FROM extraction_records",
    "extension_profile": f"""SELECT CASE WHEN coalesce({_SUFFIX}, '') = '' THEN '(Without extension)' ELSE {_SUFFIX} END AS format, count(*) AS quantity,
  round_even(count(*) * 100.0::DOUBLE / sum(count(*)) OVER (), 2) AS percentual FROM extraction_records GROUP BY 1""",
    "distinct_extensions": f"SELECT DISTINCT {_SUFFIX} AS format FROM extraction_records WHERE {_SUFFIX} <> ''",
    "prefix_listing": """SELECT DISTINCT 'root' AS level, regexp_extract(filepath, '^([^/]*/)', 1) AS prefix FROM extraction_records WHERE contains(filepath, '/')
UNION ALL SELECT DISTINCT 'sub', regexp_extract(filepath, '^(data/input/[^/]*/)', 1) FROM extraction_records WHERE regexp_matches(filepath, '^data/input/[^/]*/')""",
    "prefix_count": "SELECT count(*) AS n_keys FROM extraction_records WHERE starts_with(filepath, 'data/input/')",
    "batch_bucket": """WITH n AS (SELECT doc_id, (row_number() OVER (ORDER BY doc_id) - 1) // 200 AS batch FROM documents)
SELECT batch, count(*) AS n_rows, min(doc_id) AS first_id, max(doc_id) AS last_id, printf('batch_%04d.jsonl', batch) AS file_name FROM n GROUP BY batch""",
    "batch_final_records": """SELECT e.id, e.pipeline, e.file_format, e.tokens_count, e.page_count, e.images_s3_uri, e.class_metadata, e.error_log, t.text_content
FROM extraction_records e LEFT JOIN (SELECT id, any_value(text_content) AS text_content FROM extraction_records WHERE text_content IS NOT NULL GROUP BY id) t ON t.id = e.id""",
    "status_upsert": """WITH r AS (SELECT *, min(created_at) OVER (PARTITION BY id, pipeline) AS first_created, row_number() OVER (PARTITION BY id, pipeline ORDER BY updated_at DESC NULLS LAST, status DESC NULLS LAST,
  tokens_count DESC NULLS LAST, page_count DESC NULLS LAST, error_log DESC NULLS LAST, created_at DESC NULLS LAST) AS rn FROM extraction_records)
SELECT id, pipeline, status, tokens_count, page_count, error_log, first_created AS created_at, updated_at FROM r WHERE rn = 1""",
    "resume_filter": "SELECT id, pipeline, filepath, status FROM extraction_records e WHERE NOT EXISTS (SELECT 1 FROM gazette_record g WHERE g.id = e.id)",
    "status_resume": """SELECT DISTINCT id, pipeline FROM extraction_records e
WHERE NOT EXISTS (SELECT 1 FROM extraction_records s WHERE s.id = e.id AND s.pipeline = e.pipeline AND s.status IS DISTINCT FROM 'IN_PROGRESS')""",
    "route_dispatch": _route_sql(),
    "path_metadata_staff": f"""SELECT id, string_split(caminho_relativo, '/')[1] AS docente, string_split(caminho_relativo, '/')[2] AS ano, string_split(caminho_relativo, '/')[3] AS mes, string_split(caminho_relativo, '/')[4] AS dia,
  regexp_extract(caminho_relativo, '([^/]*)$', 1) AS nome_arquivo, regexp_replace(regexp_extract(caminho_relativo, '([^/]*)$', 1), '(?s)^(\\.*[^.].*)\\.[^.]+$', '\\1') AS stem FROM staff_record""",
    "path_metadata_gazette": "SELECT id, trim(regexp_replace(replace(pasta_origem, 'Dados-', ''), '-[0-9]+$', '')) AS municipio, regexp_extract(caminho_relativo, '([^/]*)$', 1) AS nome_arquivo, regexp_replace(caminho_relativo, '(^|/)[^/]*$', '') AS pasta FROM gazette_record",
    "class_metadata_lookup": """WITH s AS (SELECT docente, coalesce(ano, '') AS ano, concat_ws('/', mes, dia) AS titulo, 'files/' || regexp_replace(caminho_relativo, '^[^/]*/', '') AS path_local, nome_arquivo FROM staff_record WHERE docente IS NOT NULL),
k AS (SELECT regexp_replace(replace(path_local, 'files/', ''), '(^|/)[^/]*$', '') || '/' || nome_arquivo AS key, concat_ws('|', docente, ano, titulo, path_local) AS v,
  row_number() OVER (PARTITION BY regexp_replace(replace(path_local, 'files/', ''), '(^|/)[^/]*$', '') || '/' || nome_arquivo ORDER BY docente DESC, ano DESC, titulo DESC, path_local DESC) AS rn FROM s WHERE coalesce(path_local, '') <> '' AND coalesce(nome_arquivo, '') <> ''),
f AS (SELECT DISTINCT filepath, regexp_extract(filepath, '(?:^|/)([0-9]{4}/[0-9]+/[0-9]+)/(.*)$', 1) AS day, string_split(regexp_extract(filepath, '(?:^|/)([0-9]{4}/[0-9]+/[0-9]+)/(.*)$', 2), '/') AS seg FROM extraction_records),
c AS (SELECT filepath, day || '/' || seg[i] AS key, i FROM (SELECT filepath, day, seg, unnest(range(1, len(seg) + 1)) AS i FROM f WHERE day <> '')),
h AS (SELECT filepath, arg_min(v, i) AS found FROM c JOIN k ON k.key = c.key AND k.rn = 1 GROUP BY filepath)
SELECT e.id, e.pipeline, e.filepath, h.found FROM extraction_records e LEFT JOIN h ON h.filepath = e.filepath""",
    "json_field": """SELECT id, pipeline, j ->> '$.turma.codigo' AS turma_codigo, j ->> '$.plano_aula.titulo' AS plano_aula_titulo, j ->> '$.arquivo.nome_arquivo' AS arquivo_nome_arquivo
FROM (SELECT id, pipeline, CASE WHEN json_valid(class_metadata) THEN class_metadata::JSON END AS j FROM extraction_records)""",
    "jsonl_clean": "SELECT event_id, CAST(props::JSON ->> '$.k' AS INTEGER) AS k FROM events WHERE event_id % 5 <> 0",
    "log_suppress": "SELECT logger_name, message FROM log_lines l WHERE NOT EXISTS (SELECT 1 FROM log_rules r WHERE contains(l.logger_name, r.logger_name) AND contains(l.message, r.message_pattern))",
    "copy_status_summary": """WITH g AS (SELECT concat_ws('/', pasta_origem, 'pdfs', caminho_relativo) AS src, concat_ws('/', 'data', caminho_relativo) AS dst FROM gazette_record),
s AS (SELECT src IN (SELECT filepath FROM extraction_records WHERE filepath IS NOT NULL) AS has_src, dst IN (SELECT filepath FROM extraction_records WHERE filepath IS NOT NULL) AS has_dst FROM g)
SELECT count(*) AS processed, count(*) FILTER (has_src AND NOT has_dst) AS copied, count(*) FILTER (NOT has_src) AS not_found FROM s""",
    "published_uris": """SELECT id, pipeline, CASE pipeline WHEN 'docling' THEN 'output/docling' WHEN 'deepseek' THEN 'output/deep_seek_2' END || '/text_file/' || id || '.txt' AS text_file_s3_uri,
  CASE pipeline WHEN 'docling' THEN 'output/docling' WHEN 'deepseek' THEN 'output/deep_seek_2' END || '/images/' || id || '/' AS images_s3_uri,
  round(epoch_us(extraction_finished::TIMESTAMPTZ) / 1e6 - epoch_us(extraction_started::TIMESTAMPTZ) / 1e6, 3) AS seconds FROM extraction_records""",
}
