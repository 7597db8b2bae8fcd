"""Image references in model output: extraction, scaling and replacement."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lavra.functions.text import clean_ocr

#: Fixed value: an image reference with its boxes on a grid of 1000 by 1000.
IMAGE_REF = r"(?s)<\|ref\|>image<\|/ref\|><\|det\|>(\[\[[^\]]+\]\])<\|/det\|>"
_CUT = "\x02"


def _boxes(match: Column) -> Column:
    return F.get(F.from_json(match, "array<array<double>>"), F.lit(0))


def crop_name(page: Column, number: Column) -> Column:
    return F.format_string("page_%04d_img_%02d.png", page, number)


def image_refs(df: DataFrame, text: str, page: str, width: str, height: str) -> DataFrame:
    """One row per image reference: the columns of ``df`` but the text, img_no, crop, and the box in pixels.

    Numbers run from the last reference of a page to the first, references with unreadable boxes included;
    their boxes are null.
    """
    rest = [c for c in df.columns if c != text]
    found = df.select(*rest, F.regexp_extract_all(F.col(text), F.lit(IMAGE_REF), F.lit(1)).alias("_m"))
    rows = found.select(*rest, F.size("_m").alias("_n"), F.posexplode("_m").alias("_pos", "_json"))
    rows = rows.select(*rest, (F.col("_n") - F.col("_pos")).alias("img_no"), _boxes(F.col("_json")).alias("_box"))
    scaled = [(F.get("_box", F.lit(k)) / 1000 * F.col(side)).alias(name) for k, (name, side) in enumerate((("x0", width), ("y0", height), ("x1", width), ("y1", height)))]
    return rows.select(*rest, "img_no", crop_name(F.col(page), F.col("img_no")).alias("crop"), *scaled)


def replace_refs(text: Column, page: Column, folder: Column, description: Column | None = None) -> Column:
    """Model output with each image reference replaced by an image line and its description wrapper, then cleaned.

    References with unreadable boxes are left for the cleaning to remove.
    """
    refs = F.regexp_extract_all(text, F.lit(IMAGE_REF), F.lit(1))
    pieces = F.split(F.regexp_replace(text, IMAGE_REF, _CUT), _CUT)

    def one(match: Column, pos: Column) -> Column:
        path = F.concat(folder, F.lit("/"), crop_name(page, F.size(refs) - pos))
        told = F.coalesce(description, F.lit("")) if description is not None else F.lit("")
        return F.when(F.size(_boxes(match)) == 4, F.concat(F.lit("![Image]("), path, F.lit(')\n<ImageContent image_path="'), path, F.lit('">'), told, F.lit("</ImageContent>"))).otherwise("")

    marks = F.concat(F.transform(refs, one), F.array(F.lit("")))
    joined = F.array_join(F.zip_with(pieces, marks, lambda p, m: F.concat(p, F.coalesce(m, F.lit("")))), "")
    return F.when(text.isNotNull(), clean_ocr(joined))


def annotate(text: Column, images: Column) -> Column:
    """Markdown with an image's text (array of path, ocr) put behind its ``![Image](path)``."""

    def step(acc: Column, image: Column) -> Column:
        mark = F.concat(F.lit("![Image]("), image["path"], F.lit(")"))
        return F.replace(acc, mark, F.concat(mark, F.lit('\n<ImageContent image_path="'), image["path"], F.lit('">'), image["ocr"], F.lit("</ImageContent>")))

    return F.aggregate(images, text, step)
