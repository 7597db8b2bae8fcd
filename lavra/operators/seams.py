"""Extractors that need programs or services from outside, as functions to be plugged in.

An extractor takes the bytes and the name of a file and returns its text and page count, or raises. They are
called one file at a time inside an iterator UDF; a factory is called once per worker, so that converters and
clients are built once. The stand-ins give labelled text and serve tests; no service is called without being
plugged in.
"""

from __future__ import annotations

import base64
import gc
import traceback
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from datetime import datetime, timezone

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lavra.functions import text as texts

Extractor = Callable[[bytes, str], tuple[str | None, int | None]]
Factory = Callable[[], Extractor]
RESULT = T.StructType(
    [T.StructField("content", T.StringType()), T.StructField("page_count", T.IntegerType()), T.StructField("error", T.StringType())]
    + [T.StructField("started", T.TimestampType()), T.StructField("finished", T.TimestampType()), T.StructField("seconds", T.DoubleType())]
)


def _stand_in(kind: str) -> Factory:
    def make() -> Extractor:
        return lambda data, name: (f"[{kind} stand-in] {name} ({len(data)} bytes)", 1)

    return make


def raw_text(data: bytes, name: str) -> tuple[str, None]:
    return data.decode("utf-8", errors="replace"), None


def html(data: bytes, name: str) -> tuple[str, None]:
    return texts.parse_html(data.decode("utf-8", errors="replace")), None


def xml(data: bytes, name: str) -> tuple[str, None]:
    return texts.parse_xml(data.decode("utf-8", errors="replace")), None


def out_of_memory(e: Exception) -> bool:
    """Whether an engine has run out of memory, its own or that of its device."""
    return isinstance(e, MemoryError) or "out of memory" in str(e).lower()


def with_retry(first: Factory, second: Factory, when: Callable[[Exception], bool] = out_of_memory) -> Factory:
    """An extractor that hands a file to a second engine (one without a graphics card, say) where the first one fails
    in the way ``when`` tells; the second engine is built when it is first needed."""

    def make() -> Extractor:
        main, spare = first(), []

        def run(data: bytes, name: str):
            try:
                return main(data, name)
            except Exception as e:  # noqa: BLE001 - other failures are passed on
                if not when(e):
                    raise
            gc.collect()
            if not spare:
                spare.append(second())
            return spare[0](data, name)

        return run

    return make


def by_page(pages: Callable[[bytes, str], Iterator[str]]) -> Factory:
    """An extractor from an engine that gives the Markdown of one page after the other: each page is followed by a
    blank line, and the pages are counted."""

    def make() -> Extractor:
        def run(data: bytes, name: str) -> tuple[str, int]:
            got = [f"{page}\n\n" for page in pages(data, name)]
            return "".join(got), len(got)

        return run

    return make


@dataclass
class Extractors:
    """Factories by route. ``document`` gets office files converted to PDF if ``to_pdf`` is given."""

    document: Factory = field(default_factory=lambda: _stand_in("document"))
    image: Factory = field(default_factory=lambda: _stand_in("image"))
    audio: Factory = field(default_factory=lambda: _stand_in("audio"))
    video: Factory = field(default_factory=lambda: _stand_in("video"))
    raw_text: Factory = field(default=lambda: raw_text)
    html: Factory = field(default=lambda: html)
    xml: Factory = field(default=lambda: xml)
    to_pdf: Callable[[bytes, str], bytes] | None = None

    def named(self) -> dict[str, Factory]:
        return {"document": self._document, "image": self.image, "audio": self.audio, "video": self.video, "raw_text": self.raw_text, "html": self.html, "xml": self.xml}

    def _document(self) -> Extractor:
        inner, to_pdf = self.document(), self.to_pdf
        if to_pdf is None:
            return inner
        return lambda data, name: inner(data if name.lower().endswith(".pdf") else to_pdf(data, name), name)


def extract(extractors: Extractors, route: Column, content: Column, name: Column) -> Column:
    """(content, page_count, error, started, finished, seconds) of each file by its route; null for routes without an
    extractor. The times are those of this file alone.

    Any failure becomes the row's error with its traceback; an extractor that returns no text has failed.
    """
    factories = extractors.named()

    @F.pandas_udf(RESULT)
    def run(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        built: dict[str, Extractor] = {}
        for routes, contents, names in batches:
            rows = []
            for r, data, n in zip(routes, contents, names, strict=True):
                if r not in factories:
                    rows.append((None,) * 6)
                    continue
                began = datetime.now(timezone.utc)
                try:
                    if r not in built:
                        built[r] = factories[r]()
                    text, pages = built[r](data or b"", n)
                    if text is None:
                        raise ValueError("the extractor returned no text")
                    got = (text, pages, None)
                except Exception:  # noqa: BLE001 - whatever goes wrong belongs to this file
                    got = (None, None, traceback.format_exc())
                ended = datetime.now(timezone.utc)
                rows.append((*got, began, ended, (ended - began).total_seconds()))
            yield pd.DataFrame(rows, columns=RESULT.names).astype({"page_count": "Int32", "started": "datetime64[us, UTC]", "finished": "datetime64[us, UTC]", "seconds": "float64"})

    return run(route, content, name)


# What a vision model is asked for a page, and the sampling settings that keep it from looping.
PAGE_PROMPT = "\n<|grounding|>Convert the document to markdown."
SAMPLING = {"temperature": 0.0, "repetition_penalty": 1.05, "ngram_size": 30, "window_size": 90, "whitelist_token_ids": [128821, 128822], "skip_special_tokens": False}
MAX_TOKENS = {"page": 4096, "image": 4096, "frame": 1024, "description": 512}


def ocr_request(image: bytes, kind: str = "page", prompt: str = PAGE_PROMPT) -> dict:
    """What to send to a vision model for one image, without naming a service."""
    url = "data:image/png;base64," + base64.b64encode(image).decode("ascii")
    return {"image_url": url, "prompt": prompt, "max_tokens": MAX_TOKENS[kind], **SAMPLING}


def ocr_by_model(model: str, engines: dict[str, Callable[[bytes], str]], is_pdf: bool) -> Callable[[bytes], str]:
    """The OCR engine of a model; PDF files are read by the vision model alone."""
    if is_pdf and model != "deepseek":
        raise ValueError(f"PDF files are not read by {model}")
    if model not in engines:
        raise ValueError(f"no such OCR model: {model}")
    return engines[model]


def page_or_empty(read: Callable[[bytes], str]) -> Callable[[bytes], tuple[str, bool]]:
    """A page reader whose failures give an empty page and say so, instead of failing the document."""

    def safe(image: bytes) -> tuple[str, bool]:
        try:
            return read(image), False
        except Exception:  # noqa: BLE001 - one page must not fail its document
            return "", True

    return safe
