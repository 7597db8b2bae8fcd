"""Path functions as native column expressions. Paths use '/'; null gives null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def basename(path: Column) -> Column:
    """What follows the last '/', the whole path if there is none."""
    return F.substring_index(path, "/", -1)


def parent(path: Column) -> Column:
    """What precedes the last '/', empty if there is none."""
    return F.regexp_replace(path, r"(?s)(^|/)[^/]*$", "")


def suffix(name: Column) -> Column:
    """Last extension in lower case as a path library sees it: '.gitignore', 'a.' and 'noext' have none."""
    return F.lower(F.regexp_extract(name, r"(?s)^\.*[^.].*(\.[^.]+)$", 1))


def splitext(name: Column) -> Column:
    """Extension in lower case as split by the last dot: unlike ``suffix``, 'a.' has the extension '.'."""
    return F.lower(F.regexp_extract(name, r"(?s)^\.*[^.].*?(\.[^.]*)$", 1))


def stem(name: Column) -> Column:
    """The name without its ``suffix``."""
    return F.substring(name, F.lit(1), F.char_length(name) - F.char_length(suffix(name)))


def parts(path: Column) -> Column:
    """Segments without empty ones and '.'."""
    return F.filter(F.split(path, "/"), lambda p: (p != "") & (p != "."))


def staff_fields(relative: Column) -> dict[str, Column]:
    """Segments 0 to 3 as docente, ano, mes, dia; blind to what they hold, null where the path is shorter."""
    p = F.split(relative, "/")
    return {name: F.get(p, F.lit(k)) for k, name in enumerate(("docente", "ano", "mes", "dia"))}


def municipality(folder: Column) -> Column:
    """Gazette folder without 'Dados-' and a numeric tail: 'Dados-Serra Azul-002' is 'Serra Azul'."""
    return F.trim(F.regexp_replace(F.replace(folder, F.lit("Dados-"), F.lit("")), r"-[0-9]+$", ""))


def without_first_files(path: Column) -> Column:
    """The path without the first 'files/' anywhere in it."""
    return F.regexp_replace(path, r"(?s)^((?:(?!files/).)*)files/", "$1")


def date_index(segments: Column) -> Column:
    """Position of the leftmost year/number/number triple, null if there is none."""

    def dated(i: Column) -> Column:
        at = lambda k, pattern: F.get(segments, (i + k).cast("int")).rlike(pattern)
        return at(0, r"^[0-9]{4}$") & at(1, r"^[0-9]+$") & at(2, r"^[0-9]+$")

    return F.get(F.filter(F.sequence(F.lit(0), F.greatest(F.size(segments) - 3, F.lit(0))), dated), F.lit(0))


def output_uris(record_id: Column, pipeline: str) -> dict[str, Column]:
    """Where a pipeline puts the text and the images of a record."""
    root = {"docling": "output/docling", "deepseek": "output/deep_seek_2"}[pipeline]
    return {"text_file_s3_uri": F.concat(F.lit(f"{root}/text_file/"), record_id, F.lit(".txt")), "images_s3_uri": F.concat(F.lit(f"{root}/images/"), record_id, F.lit("/"))}
