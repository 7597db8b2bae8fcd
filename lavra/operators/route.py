"""Which extractor a file goes to."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lavra.functions import paths

# Extensions by kind. '.ts' counts as video here, so TypeScript sources are routed to it too.
VIDEO = (".mp4", ".mkv", ".avi", ".mov", ".webm", ".flv", ".wmv", ".m4v", ".ts", ".mts")
AUDIO = (".mp3", ".wav", ".ogg", ".flac", ".aac", ".m4a", ".opus", ".wma", ".aiff")
OFFICE = (".doc", ".docx", ".ppt", ".pptx", ".pps", ".ppsx", ".xls", ".xlsx", ".odt", ".ods", ".odp", ".rtf")
PDF = (".pdf",)
IMAGE = (".png", ".jpg", ".jpeg", ".jp", ".webp", ".pgm")
HTML = (".html", ".htm")
XML = (".xml",)
NATIVE_DOCUMENTS = (".pdf", ".docx", ".doc", ".pptx", ".xlsx", ".xls", ".ppt")
PRESENTATION = (".ppt", ".pptx", ".odp")
SPREADSHEET = (".xls", ".xlsx", ".ods", ".csv")

#: The branches of each entry point in the order they are tried; the last resort is raw text or nothing.
BRANCHES = {
    "docling": ((("html", HTML), ("xml", XML), ("document", NATIVE_DOCUMENTS), ("audio", AUDIO), ("video", VIDEO)), "raw_text"),
    "deepseek": ((("html", HTML), ("xml", XML), ("image", IMAGE), ("document", OFFICE + PDF), ("audio", AUDIO), ("video", VIDEO)), "raw_text"),
    "main": ((("document", NATIVE_DOCUMENTS), ("html", HTML), ("xml", XML)), None),
    "notebook": ((("image", IMAGE), ("document", OFFICE + PDF)), "raw_text"),
}


def extension(path: Column, pipeline: str) -> Column:
    """The mains split at the last dot, the pipelines take the path suffix."""
    name = paths.basename(path)
    return paths.splitext(name) if pipeline == "main" else paths.suffix(name)


def route(ext: Column, pipeline: str) -> Column:
    """Extractor of an extension; null where the entry point drops such files silently."""
    branches, rest = BRANCHES[pipeline]
    return F.coalesce(*[F.when(ext.isin(*exts), F.lit(kind)) for kind, exts in branches], F.lit(rest).cast("string"))


def allowed(ext: Column) -> Column:
    """Files the mains keep. Derived from the path alone, so it is decided before any content is read."""
    return ext.isin(*NATIVE_DOCUMENTS, *HTML, *XML)


def file_class(ext: Column) -> Column:
    kinds = (("video", VIDEO), ("audio", AUDIO), ("office", OFFICE), ("pdf", PDF), ("image", IMAGE))
    return F.coalesce(*[F.when(ext.isin(*exts), F.lit(kind)) for kind, exts in kinds], F.lit("other"))


def lossy(ext: Column, pipeline: str) -> Column:
    """Binary formats an entry point has no branch for, whose bytes it decodes as text."""
    return (route(ext, pipeline) == "raw_text") & (file_class(ext) != "other")


def pdf_filter(ext: Column) -> Column:
    """Export filter for the conversion of office files."""
    return F.when(ext.isin(*PRESENTATION), "pdf:impress_pdf_Export").when(ext.isin(*SPREADSHEET), "pdf:calc_pdf_Export").otherwise("pdf:writer_pdf_Export")


def routed(df: DataFrame, path: str, pipelines: tuple[str, ...] = tuple(BRANCHES)) -> DataFrame:
    """``df`` with one column ``route_<pipeline>`` each. A null path has no route."""
    cols = {f"route_{p}": F.when(F.col(path).isNotNull(), route(extension(F.col(path), p), p)) for p in pipelines}
    return reduce(lambda d, kv: d.withColumn(*kv), cols.items(), df)
