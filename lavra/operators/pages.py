"""Page-level and section-level text assembly. All aggregates are per document and order by explicit keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lavra.functions.text import strip


def _ordered(order: str, text: str) -> Column:
    return F.sort_array(F.collect_list(F.struct(F.col(order).alias("o"), F.col(text).alias("t"))))


def assemble(pages: DataFrame, doc: str, number: str, text: str) -> DataFrame:
    """(doc, page_count, text): stripped pages in page order, blank and null ones dropped, joined by a blank line.

    Pages with equal numbers are ordered by text; repeated rows are counted as they come.
    """
    texts = F.filter(F.transform(_ordered(number, text), lambda p: strip(F.coalesce(p["t"], F.lit("")))), lambda t: t != "")
    return pages.groupBy(doc).agg(F.count("*").alias("page_count"), F.array_join(texts, "\n\n").alias("text"))


def concatenate(pages: DataFrame, doc: str, number: str, text: str) -> DataFrame:
    """(doc, page_count, text): every page followed by a blank line, blank pages kept."""
    texts = F.transform(_ordered(number, text), lambda p: F.concat(F.coalesce(p["t"], F.lit("")), F.lit("\n\n")))
    return pages.groupBy(doc).agg(F.count("*").alias("page_count"), F.array_join(texts, "").alias("text"))


def transcript(chunks: DataFrame, doc: str, number: str, text: str) -> DataFrame:
    """(doc, text): stripped chunks in order joined by a blank line, blank ones kept."""
    texts = F.transform(_ordered(number, text), lambda p: strip(F.coalesce(p["t"], F.lit(""))))
    return chunks.groupBy(doc).agg(F.array_join(texts, "\n\n").alias("text"))


def chunk(number: Column, size: int) -> Column:
    """Which chunk of ``size`` pages a page (from 1) belongs to."""
    return F.floor((number - 1) / size).cast("int")


def select_pages(pages: DataFrame, doc: str, number: str, wanted: list[int]) -> DataFrame:
    """The pages with the given 0-based positions, in the order of the list: adds ``position``, from 0."""
    order = F.array(*[F.lit(w + 1) for w in wanted])
    return pages.withColumn("position", (F.array_position(order, F.col(number)) - 1).cast("int")).where("position >= 0")


# Headings and notices of audio and video documents.
AUDIO_HEAD, VIDEO_HEAD, SPEECH_HEAD, FRAMES_HEAD, FRAME_HEAD = "# Transcrição de Áudio: ", "# Conteúdo do Vídeo: ", "## Transcrição de Áudio", "## Conteúdo Visual (Frames de Cena)", "### Frame "
_SPEECH_ERROR = "_Erro na transcrição: "
_NO_SPEECH = "_Nenhuma fala detectada._"
_NO_SPEECH_VIDEO = "_Nenhuma fala detectada no vídeo._"


def _speech(text: Column, error: Column, none: str) -> Column:
    said = strip(F.coalesce(text, F.lit("")))
    return F.when(error.isNotNull(), F.concat(F.lit(_SPEECH_ERROR), error, F.lit("_"))).when(said == "", none).otherwise(said)


def audio_text(file_name: Column, text: Column, error: Column) -> Column:
    """Document of an audio file; a failed transcription becomes text, the record stays extracted."""
    return F.concat_ws("\n\n", F.concat(F.lit(AUDIO_HEAD), file_name, F.lit("\n")), _speech(text, error, _NO_SPEECH))


def video_text(file_name: Column, text: Column, error: Column, frames: Column) -> Column:
    """Document of a video: transcript, then the non-blank frames (array of frame, text) by number, at most 50."""
    live = F.filter(F.slice(F.sort_array(F.coalesce(frames, F.array().cast("array<struct<frame:int,text:string>>"))), 1, 50), lambda f: strip(F.coalesce(f["text"], F.lit(""))) != "")
    sections = F.transform(live, lambda f: F.concat(F.lit(FRAME_HEAD), f["frame"].cast("string"), F.lit("\n\n\n"), strip(f["text"])))
    visual = F.when(F.size(live) > 0, F.concat(F.lit(f"\n{FRAMES_HEAD}\n\n\n"), F.array_join(sections, "\n\n")))
    head = F.concat(F.lit(VIDEO_HEAD), file_name, F.lit("\n"))
    return F.concat_ws("\n\n", head, F.lit(f"{SPEECH_HEAD}\n"), _speech(text, error, _NO_SPEECH_VIDEO), visual)
