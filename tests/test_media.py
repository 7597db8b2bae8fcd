from pyspark.sql import functions as F

from lavra.operators import corpus, images, media
from lavra.sources import objects


def test_scanned_document(spark):
    def render(data, start, end):
        return [(f"{data.decode()}-{k}".encode(), 1000, 2000) for k in range(start, end)]

    def count(data):
        return int(data.decode())

    def read(image):
        if image.endswith(b"-2"):
            raise RuntimeError("modelo")
        return f"texto de {image.decode()} <|ref|>image<|/ref|><|det|>[[0,0,10,10]]<|/det|>"

    docs = spark.createDataFrame([("a", b"7"), ("b", b"x"), ("c", b"0")], "id string, content binary")
    rows = media.page_images(docs, "id", "content", count, render, chunk=3)
    got = rows.collect()
    assert sorted(r.page_num for r in got if r.id == "a") == list(range(1, 8)) and [r.error is not None for r in got if r.id == "b"] == [True]
    text = media.document_text(media.read_pages(rows, "id", read), "id", F.concat(F.lit("im/"), "id")).collect()
    assert [(r.id, r.page_count, r.failed_pages) for r in text] == [("a", 7, 1)]
    assert text[0].text.startswith("texto de 7-0 ![Image](im/a/page_0001_img_01.png)") and len(text[0].text.split("\n\n")) == 6
    assert {r.name for r in media.full_pages(rows, "id").collect()} == {f"a-{k}_complete.png" for k in range(1, 8)}


def test_pictures_without_image_are_not_counted(spark):
    df = spark.createDataFrame([("a", 1, 1, b"x"), ("a", 2, 1, None), ("a", 3, 2, b"y")], "id string, pos int, page int, image binary")
    assert [(r.n, r.name) for r in media.pictures(df, "id", "pos", "page", "image").orderBy("n").collect()] == [(0, "picture-0-pg_1.png"), (1, "picture-1-pg_2.png")]


def test_audio_segments(spark):
    df = spark.createDataFrame([("s", 1000, 5000.0), ("l", 30 * 1024 * 1024, 1300.0)], "f string, size long, secs double")
    got = sorted((r.f, r.start_second) for r in media.audio_segments(df, "f", "size", "secs").collect())
    assert got == [("l", 0), ("l", 600), ("l", 1200), ("s", 0)]
    assert df.select(media.megabytes(F.col("size")).alias("m")).collect()[1].m == "30.0"


def test_objects(spark, tmp_path):
    (tmp_path / "a/b").mkdir(parents=True)
    (tmp_path / "a/b/x.txt").write_bytes(b"1")
    (tmp_path / "a/y.txt").write_bytes(b"22")
    keys = objects.list_keys(spark, str(tmp_path))
    assert sorted((r.key, r["size"]) for r in keys.collect()) == [("a/b/x.txt", 1), ("a/y.txt", 2)]
    assert objects.get_object(spark, str(tmp_path / "a/y.txt")) == b"22" and objects.get_object(spark, str(tmp_path / "no")) is None
    plan = spark.createDataFrame([("a/y.txt", "n/z.txt"), ("a/none", "n/w.txt")], "src string, dst string")
    status = corpus.copy_status(plan, "src", "dst", keys, "key")
    assert {r.src: r.status for r in objects.copy_files(status, "src", "dst", str(tmp_path), str(tmp_path / "out")).collect()} == {"a/y.txt": "copied", "a/none": "not_found"}
    assert (tmp_path / "out/n/z.txt").read_bytes() == b"22"
    assert objects.delete_prefix(spark, str(tmp_path / "a")) and not objects.delete_prefix(spark, str(tmp_path / "a"))


def test_export_and_counters(spark, tmp_path):
    (tmp_path / "e.json").write_text('[{"a": 1, "t": [{"b": "x"}]}, {"a": 2}]')
    df = objects.read_export(spark, str(tmp_path / "e.json"), "a int, t array<struct<b:string>>")
    assert sorted(r.a for r in df.collect()) == [1, 2]
    watched, seen = objects.counted(df.withColumn("status", F.when(F.col("a") == 1, "FAILED").otherwise("EXTRACTED")))
    watched.collect()
    assert seen.get == {"records": 2, "failed": 1}


def test_copy_run_with_a_limit_an_error_list_and_deletion(spark, tmp_path):
    for n in ("a", "b", "c"):
        (tmp_path / "in").mkdir(exist_ok=True)
        (tmp_path / f"in/{n}.txt").write_text(n)
    keys = objects.list_keys(spark, str(tmp_path / "in"))
    plan = spark.createDataFrame([(f"{n}.txt", f"x/{n}.md") for n in ("a", "b", "c", "d", "e")], "src string, dst string")
    status = corpus.copy_status(plan, "src", "dst", keys, "key")
    assert [r.src for r in objects.first_files(status, 2, "src").collect()] == ["a.txt", "b.txt"] and objects.first_files(status, None).count() == 5
    objects.write_missing(status, "src", "/raiz/", str(tmp_path / "erros.txt"))
    assert sorted(r.value for r in spark.read.text(str(tmp_path / "erros.txt")).collect()) == ["[NÃO ENCONTRADO] /raiz/d.txt", "[NÃO ENCONTRADO] /raiz/e.txt"]
    done = {r.src: r.status for r in objects.copy_files(status, "src", "dst", str(tmp_path / "in"), "file://" + str(tmp_path / "out"), delete_after=True, in_flight=2).collect()}
    assert done == {"a.txt": "copied", "b.txt": "copied", "c.txt": "copied", "d.txt": "not_found", "e.txt": "not_found"}
    assert (tmp_path / "out/x/c.md").read_text() == "c" and not list((tmp_path / "in").iterdir())


def test_crops_and_pictures_as_png(spark):
    text = "<|ref|>image<|/ref|><|det|>[[0,0,500,500]]<|/det|> <|ref|>image<|/ref|><|det|>[[1]]<|/det|><|ref|>image<|/ref|><|det|>[[500,500,1000,1000]]<|/det|>"
    refs = images.image_refs(spark.createDataFrame([("a", 1, 100, 200, text)], "id string, page_num int, width int, height int, t string"), "t", "page_num", "width", "height")
    pages = spark.createDataFrame([("a", 1, b"P"), ("a", 2, None)], "id string, page_num int, image binary")

    def crop(data, box):
        if box[0] > 10:
            raise RuntimeError("fora")
        return data + repr(box).encode()

    got = {r.img_no: r for r in media.crops(refs, pages, "id", crop).collect()}
    assert set(got) == {1, 3} and bytes(got[3].image) == b"P(0.0, 0.0, 50.0, 100.0)" and got[3].name == "page_0001_img_03.png" and "fora" in got[1].error
    png = {r.page_num: r for r in media.as_png(pages, "image", lambda b: b + b"NG").collect()}
    assert bytes(png[1].png) == b"PNG" and png[2].png is None and png[2].png_error is None


def test_ffmpeg_plan():
    plan = media.ffmpeg_plan("v.mp4", "/t")
    assert plan["audio"][-2] == "/t/audio.mp3" and "16000" in plan["audio"] and "600" in plan["segments"] and "select='gt(scene,0.35)',scale=960:-1" in plan["frames"] and "50" in plan["frames"]


def test_number_of_extensions(spark):
    df = spark.createDataFrame([("a.pdf",), ("b.PDF",), ("c",), ("d.x",)], "p string")
    assert corpus.extension_groups(df, "p").first().groups == 3
