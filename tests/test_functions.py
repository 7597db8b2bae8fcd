import json

import pytest
from pyspark.sql import functions as F

from lavra.functions import paths, text
from lavra.operators import images, pages, route


def one(spark, column, **values):
    schema = ", ".join(f"{k} {'binary' if isinstance(v, bytes) else 'int' if isinstance(v, int) else 'string'}" for k, v in values.items())
    return spark.createDataFrame([tuple(values.values())], schema).select(column.alias("x")).first().x


@pytest.mark.parametrize(("name", "suffix", "split"), [("a.PDF", ".pdf", ".pdf"), (".gitignore", "", ""), ("x.tar.gz", ".gz", ".gz"), ("noext", "", ""), ("dot.", "", "."), ("..a.txt", ".txt", ".txt"), (".a.b", ".b", ".b"), ("a.b.", "", ".")])
def test_extensions(spark, name, suffix, split):
    assert one(spark, paths.suffix(F.col("n")), n=name) == suffix
    assert one(spark, paths.splitext(F.col("n")), n=name) == split


@pytest.mark.parametrize(("folder", "want"), [("Dados-Tabuleiros do Alto Parnaíba-002", "Tabuleiros do Alto Parnaíba"), ("Dados-A-B", "A-B"), ("X-12", "X"), ("12", "12")])
def test_municipality(spark, folder, want):
    assert one(spark, paths.municipality(F.col("f")), f=folder) == want


def test_staff_fields_of_a_short_path(spark):
    row = spark.createDataFrame([("X/file.pdf",)], "p string").select(*[c.alias(k) for k, c in paths.staff_fields(F.col("p")).items()]).first()
    assert (row.docente, row.ano, row.mes, row.dia) == ("X", "file.pdf", None, None)


@pytest.mark.parametrize(("path", "want"), [("files/a/b", "a/b"), ("x/files/y/files/z", "x/y/files/z"), ("none", "none")])
def test_first_files_is_removed(spark, path, want):
    assert one(spark, paths.without_first_files(F.col("p")), p=path) == want


def test_html(spark):
    page = "<p>a<b>b</b>&amp;c</p><script>x</script><!-- z -->"
    assert one(spark, text.html_to_text(F.col("h")), h=page) == "a\nb\n&c"
    assert one(spark, text.html_to_text_any(F.col("h")), h=page) == "a\nb\n&c"
    assert one(spark, text.html_to_text_any(F.col("h")), h="<p>caf&eacute;<br>d<div>e") == "café\nd\ne"


def test_xml(spark):
    doc = '<r xmlns="u" a="1"><i>x</i><i k="v">y</i><e/> t </r>'
    got = one(spark, text.xml_to_json(F.col("d")), d=doc)
    assert json.loads(got.content) == {"r": {"@attributes": {"a": "1"}, "i": ["x", {"@attributes": {"k": "v"}, "#text": "y"}], "e": {}}}
    assert one(spark, text.xml_to_json(F.col("d")), d="<r>").error


def test_nulls_stay_null(spark):
    df = spark.createDataFrame([(None,)], "t string")
    for f in (text.html_to_text, text.html_to_text_any, text.clean_ocr, text.strip, text.word_count):
        assert df.select(f(F.col("t")).alias("x")).first().x in (None, -1)
    row = df.select(text.xml_to_json(F.col("t")).alias("x")).first().x
    assert row.content is None and row.error is None


@pytest.mark.parametrize(("raw", "want"), [("a\n# Página 1\n\n\n\n b ", "a\n\n b"), ("<CENTER>x</center>\r\n# PÁGINA 12 \r\ny", "x\ny"), ("<|ref|>t<|/ref|><|det|>[[1]]<|/det|>z", "z"), ("", "")])
def test_clean_ocr(spark, raw, want):
    assert one(spark, text.clean_ocr(F.col("t")), t=raw) == want


def test_image_references(spark):
    ref = "<|ref|>image<|/ref|><|det|>[[100,200,300,400]]<|/det|>"
    df = spark.createDataFrame([(1, f"A {ref} B {ref}", 1000, 2000)], "page int, t string, w int, h int")
    rows = {r.img_no: r for r in images.image_refs(df, "t", "page", "w", "h").collect()}
    assert (rows[1].x0, rows[1].y0, rows[1].x1, rows[1].y1) == (100, 400, 300, 800)
    assert rows[2].crop == "page_0001_img_02.png"
    out = df.select(images.replace_refs(F.col("t"), F.col("page"), F.lit("d"), F.lit("uma casa")).alias("x")).first().x
    assert out.startswith('A ![Image](d/page_0001_img_02.png)\n<ImageContent image_path="d/page_0001_img_02.png">uma casa</ImageContent> B')
    assert out.endswith("page_0001_img_01.png\">uma casa</ImageContent>")


def test_image_annotation(spark):
    df = spark.createDataFrame([("x ![Image](a.png) y", [("a.png", "texto")])], "t string, i array<struct<path:string,ocr:string>>")
    assert df.select(images.annotate(F.col("t"), F.col("i")).alias("x")).first().x == 'x ![Image](a.png)\n<ImageContent image_path="a.png">texto</ImageContent> y'


def test_audio_text(spark):
    none = F.lit(None).cast("string")
    assert one(spark, pages.audio_text(F.col("f"), F.lit(" "), none), f="f") == "# Transcrição de Áudio: f\n\n\n_Nenhuma fala detectada._"
    assert one(spark, pages.audio_text(F.col("f"), none, F.lit("E")), f="f") == "# Transcrição de Áudio: f\n\n\n_Erro na transcrição: E_"


def test_video_text_keeps_frames_in_order(spark):
    df = spark.createDataFrame([("v", [(2, " b "), (1, "a"), (3, " ")])], "f string, s array<struct<frame:int,text:string>>")
    got = df.select(pages.video_text(F.col("f"), F.lit("oi"), F.lit(None).cast("string"), F.col("s")).alias("x")).first().x
    assert got == "# Conteúdo do Vídeo: v\n\n\n## Transcrição de Áudio\n\n\noi\n\n\n## Conteúdo Visual (Frames de Cena)\n\n\n### Frame 1\n\n\na\n\n### Frame 2\n\n\nb"


@pytest.mark.parametrize(("ext", "want"), [(".html", ("html", "html", "html", "raw_text")), (".pdf", ("document", "document", "document", "document")), (".odt", ("raw_text", "document", None, "document")), (".png", ("raw_text", "image", None, "image")), (".ts", ("video", "video", None, "raw_text")), ("", ("raw_text", "raw_text", None, "raw_text"))])
def test_routes(spark, ext, want):
    assert tuple(one(spark, route.route(F.col("e"), p), e=ext) for p in ("docling", "deepseek", "main", "notebook")) == want


def test_record_id_depends_on_path(spark):
    import hashlib

    got = one(spark, text.record_id(F.col("c"), F.lit("á/b")), c=b"\x00\xff")
    assert got == hashlib.sha256(b"\x00\xff" + "á/b".encode()).hexdigest()


def test_replacement_of_malformed_utf8(spark):
    raw = b"ab\xffc\xc3("
    assert one(spark, text.utf8(F.col("c")), c=raw) == raw.decode("utf-8", errors="replace")


def test_parts_are_flattened(spark):
    df = spark.createDataFrame([([("a",), (None,), ("b",)],)], "p array<struct<text:string>>")
    assert df.select(text.flatten_parts(F.col("p")).alias("x")).first().x == "ab"
