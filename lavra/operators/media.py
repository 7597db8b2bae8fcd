"""Pages, pictures and speech: what surrounds the model calls of scanned documents, audio and video.

Rendering, recognition and transcription are functions to be plugged in; everything between them (page rows,
chunks, numbering, assembly, limits) is done here with DataFrame operations.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lavra.operators import images, pages

# Limits of the services and of scene detection.
MAX_AUDIO_BYTES = 24 * 1024 * 1024
AUDIO_SEGMENT_SECONDS = 600
SCENE_THRESHOLD, FRAME_WIDTH, MAX_FRAMES = 0.35, 960, 50
PAGE_DPI = 200

Render = Callable[[bytes, int, int], list[tuple[bytes, int, int]]]


def page_images(documents: DataFrame, key: str, content: str, count: Callable[[bytes], int], render: Render, chunk: int = 5) -> DataFrame:
    """(key, page_num, image, width, height, error): the pages of every document as images, numbered from 1.

    ``render(bytes, start, end)`` renders the pages [start, end); a document is rendered ``chunk`` pages at a time
    so that memory is bounded by a chunk. A document that can't be opened gives one row with its error.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cols = [key, "page_num", "image", "width", "height", "error"]
        for pdf in batches:
            for doc, data in pdf.itertuples(index=False):
                try:
                    total = count(data)
                    for start in range(0, total, chunk):
                        part = render(data, start, min(total, start + chunk))
                        yield pd.DataFrame([(doc, start + k + 1, image, w, h, None) for k, (image, w, h) in enumerate(part)], columns=cols)
                except Exception as e:  # noqa: BLE001 - a broken file is that file's error
                    yield pd.DataFrame([(doc, None, None, None, None, f"{type(e).__name__}: {e}")], columns=cols).astype({"page_num": "Int32", "width": "Int32", "height": "Int32"})

    kind = documents.schema[key].dataType.simpleString()
    return documents.select(key, content).mapInPandas(run, f"{key} {kind}, page_num int, image binary, width int, height int, error string")


def read_pages(page_rows: DataFrame, key: str, read: Callable[[bytes], str]) -> DataFrame:
    """(key, page_num, raw_text, failed, width, height): recognised pages; a failed page is empty, not fatal."""

    @F.pandas_udf("text string, failed boolean")
    def recognise(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for s in batches:
            out = []
            for image in s:
                try:
                    out.append((read(image), False))
                except Exception:  # noqa: BLE001 - one page must not fail its document
                    out.append(("", True))
            yield pd.DataFrame(out, columns=["text", "failed"])

    live = page_rows.where("error is null and image is not null")
    return live.select(key, "page_num", "width", "height", recognise("image").alias("_o")).select(key, "page_num", F.col("_o.text").alias("raw_text"), F.col("_o.failed").alias("failed"), "width", "height")


def document_text(recognised: DataFrame, key: str, folder: Column) -> DataFrame:
    """(key, page_count, text, failed_pages): pages cleaned, image references replaced, joined in page order."""
    clean = recognised.select(key, "page_num", "failed", images.replace_refs(F.col("raw_text"), F.col("page_num"), folder).alias("text"))
    failed = clean.groupBy(key).agg(F.count_if("failed").alias("failed_pages"))
    return pages.assemble(clean, key, "page_num", "text").join(failed, key)


def pictures(elements: DataFrame, key: str, order: str, page: str, image: str) -> DataFrame:
    """(key, n, page, name, image): pictures of a document numbered in order from 0; elements without an image don't count."""
    from pyspark.sql import Window

    w = Window.partitionBy(key).orderBy(page, order)  # a document's pictures
    rows = elements.where(F.col(image).isNotNull()).withColumn("n", F.row_number().over(w) - 1)
    return rows.select(key, "n", page, F.format_string("picture-%d-pg_%d.png", "n", page).alias("name"), image)


def full_pages(page_rows: DataFrame, key: str) -> DataFrame:
    """(key, page_num, name, image): whole pages as pictures, named after their document."""
    return page_rows.where("image is not null").select(key, "page_num", F.format_string("%s-%d_complete.png", F.col(key).cast("string"), "page_num").alias("name"), "image")


def crops(refs: DataFrame, page_rows: DataFrame, key: str, crop: Callable[[bytes, tuple[float, float, float, float]], bytes]) -> DataFrame:
    """(key, page_num, img_no, name, image, error): the pictures that image references point to, cut from their pages.

    ``refs`` as from ``images.image_refs``, ``crop(page image, box)`` is an imaging function to be plugged in. A
    reference without a box or page gives no row; a crop that fails has its error and no image.
    """
    boxes = refs.where("x0 is not null and y0 is not null and x1 is not null and y1 is not null")
    both = boxes.join(page_rows.where("image is not null").select(key, "page_num", "image"), [key, "page_num"])

    @F.pandas_udf("image binary, error string")
    def cut_out(image: pd.Series, x0: pd.Series, y0: pd.Series, x1: pd.Series, y1: pd.Series) -> pd.DataFrame:
        out = []
        for data, *box in zip(image, x0, y0, x1, y1, strict=True):
            try:
                out.append((crop(data, tuple(box)), None))
            except Exception as e:  # noqa: BLE001 - one crop must not fail its page
                out.append((None, f"{type(e).__name__}: {e}"))
        return pd.DataFrame(out, columns=["image", "error"])

    return both.select(key, "page_num", "img_no", F.col("crop").alias("name"), cut_out("image", "x0", "y0", "x1", "y1").alias("_c")).select(key, "page_num", "img_no", "name", "_c.*")


def as_png(files: DataFrame, image: str, encode: Callable[[bytes], bytes]) -> DataFrame:
    """``files`` with ``png`` and ``png_error``: pictures re-encoded as RGB PNG by the function plugged in."""

    @F.pandas_udf("png binary, png_error string")
    def run(s: pd.Series) -> pd.DataFrame:
        out = []
        for data in s:
            try:
                out.append((None if data is None else encode(data), None))
            except Exception as e:  # noqa: BLE001
                out.append((None, f"{type(e).__name__}: {e}"))
        return pd.DataFrame(out, columns=["png", "png_error"])

    rest = [c for c in files.columns if c not in ("png", "png_error")]
    return files.select(*rest, run(image).alias("_p")).select(*rest, "_p.*")


def ffmpeg_plan(source: str, folder: str) -> dict[str, list[str]]:
    """Command lines for a video: its sound as mono 16 kHz MP3, that sound in segments, and frames at scene changes."""
    # The options each step needs.
    start, sound = ["ffmpeg", "-hide_banner", "-loglevel", "error"], f"{folder}/audio.mp3"
    return {
        "audio": [*start, "-i", source, "-vn", "-ac", "1", "-ar", "16000", "-q:a", "4", sound, "-y"],
        "segments": [*start, "-i", sound, "-f", "segment", "-segment_time", str(AUDIO_SEGMENT_SECONDS), "-c", "copy", f"{folder}/chunk_%04d.mp3", "-y"],
        "frames": [*start, "-i", source, "-vf", f"select='gt(scene,{SCENE_THRESHOLD})',scale={FRAME_WIDTH}:-1", "-vsync", "vfr", "-frames:v", str(MAX_FRAMES), f"{folder}/frame_%04d.png", "-y"],
    }


def audio_segments(files: DataFrame, key: str, size: str, seconds: str) -> DataFrame:
    """(key, segment, start_second): one segment for files within the upload limit, ten-minute ones beyond it."""
    whole = F.col(size) <= MAX_AUDIO_BYTES
    last = F.when(whole, 0).otherwise(F.greatest(F.ceil(F.col(seconds) / AUDIO_SEGMENT_SECONDS).cast("int") - 1, F.lit(0)))
    return files.select(key, F.explode(F.sequence(F.lit(0), last)).alias("segment")).withColumn("start_second", F.col("segment") * AUDIO_SEGMENT_SECONDS)


def megabytes(size: Column) -> Column:
    return F.format_string("%.1f", size / 1024 / 1024)
