import hashlib
import io
import json
import os
import re
import tarfile
import time
import zipfile
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from lavra.config import Settings, create_logger
from lavra.operators import batches, publish, seams
from lavra.plans import pipelines
from lavra.sources import archives, files, jsonl
from lavra.streaming import ingest


def make_zip(**members):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name, data in members.items():
            z.writestr(name, data)
    return out.getvalue()


def make_tar(**members):
    out = io.BytesIO()
    with tarfile.open(fileobj=out, mode="w:gz") as t:
        for name, data in members.items():
            info = tarfile.TarInfo(name)
            info.size = len(data)
            t.addfile(info, io.BytesIO(data))
    return out.getvalue()


@pytest.fixture
def tree(tmp_path):
    root = tmp_path / "Dados-Vila Nova-001"
    for name, data in {"a/b/.oculto": b"x", "a/_c.TXT": b"yy", "a b%.pdf": b"%PDF", "d/e/f/p.html": b"<p>oi</p>", "d/x.xml": b"<r><a>1</a></r>", "d/bad.xml": b"<r>", "m.zip": make_zip(**{"z.txt": b"1", "y/in.zip": make_zip(q=b"2")})}.items():
        p = root / name
        p.parent.mkdir(parents=True, exist_ok=True)
        p.write_bytes(data)
    return root


def count_words():
    return lambda c: F.coalesce(F.size(F.split(c, " ")), F.lit(0))


def test_scan_sees_hidden_files(spark, tree):
    rows = {r.relative_path: r for r in files.scan(spark, str(tree), shares=3).collect()}
    assert set(rows) == {"a/b/.oculto", "a/_c.TXT", "a b%.pdf", "d/e/f/p.html", "d/x.xml", "d/bad.xml", "m.zip"}
    assert (rows["a/_c.TXT"].ext, rows["a/_c.TXT"].length, bytes(rows["a/_c.TXT"].content)) == (".txt", 2, b"yy") and rows["a/b/.oculto"].ext == ""
    assert files.scan(spark, str(tree)).where(F.col("ext").isin(".xml", ".html")).count() == 3
    assert files.scan(spark, str(tree), max_bytes=3).where("content is null").count() > 0


def test_empty_folder(spark, tmp_path):
    assert files.scan(spark, str(tmp_path)).count() == 0


def test_input_root(tmp_path):
    assert files.input_root(str(tmp_path)) == str(tmp_path)
    (tmp_path / "pdfs").mkdir()
    assert files.input_root(str(tmp_path)) == str(tmp_path / "pdfs")
    with pytest.raises(FileNotFoundError):
        files.input_root(None)


def test_archives_are_known_by_content():
    assert archives.is_archive(make_zip(a=b"1"), ".bin") and archives.is_archive(make_tar(a=b"1"), ".gz") and archives.is_archive(b"Rar!\x1a\x07\x00", ".x")
    assert not archives.is_archive(make_zip(a=b"1"), ".docx") and not archives.is_archive(b"", ".zip") and not archives.is_archive(None, None)


def test_expansion_is_one_level_deep(spark, tree):
    rows = archives.logical_files(files.scan(spark, str(tree))).collect()
    assert {"m.zip/y/in.zip", "m.zip/z.txt"} < {r.relative_path for r in rows} and "m.zip" not in {r.relative_path for r in rows}
    assert not [r for r in rows if r.error]


def test_broken_archives_are_errors(spark):
    whole = make_tar(a=b"1" * 5000)
    df = spark.createDataFrame([("r.rar", b"Rar!\x1a\x07\x00"), ("t.tgz", whole), ("n", None)], "relative string, content binary")
    got = {r.relative: (r.data is not None, r.error) for r in archives.expand(df, "relative", "content").collect()}
    assert got["t.tgz/a"][0] and got["r.rar"][1] and "ValueError" in got["n"][1]


def test_rar_members_by_a_stand_in_program(tmp_path, monkeypatch):
    program = tmp_path / "7z"
    program.write_text("#!/bin/sh\nif [ $1 = l ]; then printf 'Path = d\\nFolder = +\\n\\nPath = d/b.txt\\nFolder = -\\n\\nPath = a.txt\\nFolder = -\\n\\n'; else printf \"$4:\"; cat \"$3\"; fi\n")
    program.chmod(0o755)
    monkeypatch.setenv("PATH", f"{tmp_path}:{os.environ['PATH']}")
    assert list(archives.members(b"Rar!\x1a\x07\x00")) == [("a.txt", b"a.txt:Rar!\x1a\x07\x00"), ("d/b.txt", b"d/b.txt:Rar!\x1a\x07\x00")]


def test_a_damaged_archive_gives_no_member(spark, tmp_path):
    whole = bytearray(make_zip(**{"a.txt": b"um" * 50, "b.txt": b"dois" * 50}))
    whole[whole.index(b"b.txt") + 5 + 20] ^= 0xFF  # the second member's data no longer has its check sum
    cut_off = make_tar(a=os.urandom(5000), b=os.urandom(90_000))[:-40_000]
    df = spark.createDataFrame([("z.zip", bytes(whole)), ("t.tgz", cut_off)], "relative string, content binary")
    got = archives.expand(df, "relative", "content").collect()
    assert sorted((r.relative, r.data) for r in got) == [("t.tgz", None), ("z.zip", None)] and all(r.error for r in got)
    (tmp_path / "z.zip").write_bytes(bytes(whole))
    (tmp_path / "p.txt").write_text("x")
    records, broken = pipelines.extraction_run(spark, str(tmp_path), "docling", None, None, seams.Extractors(), count_words())
    assert [r.filepath for r in records.collect()] == ["p.txt"] and [r.relative_path for r in broken.collect()] == ["z.zip"]


def test_wide_folders_are_shared_out_by_name(spark, tmp_path, monkeypatch):
    for k in range(40):
        (tmp_path / f"{k}.txt").write_text(str(k))
    (tmp_path / "sub/deep").mkdir(parents=True)
    (tmp_path / "sub/deep/x.txt").write_text("x")
    monkeypatch.setattr(files, "WIDE", 10)
    reader = files.TreeReader(str(tmp_path), False, 7, None, None)
    shares = reader.partitions()
    assert len(shares) == 7 and not any(s.files for s in shares)
    got = [row[1] for s in shares for row in reader.read(s)]
    assert sorted(got) == sorted([*[f"{k}.txt" for k in range(40)], "sub/deep/x.txt"])


def test_jsonl_cleanup(spark):
    lines = ["'{\"id\":\"a\"}'", '{"id":"b"}', "bad{", " ", "''{\"id\":\"c\"}", None]
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    assert [r.id for r in jsonl.parse(df, "value", "id string").collect()] == ["a", "b", "c"]
    assert [r.broken for r in jsonl.parse(df, "value", "id string", keep_broken=True).collect()] == [None, None, "bad{", None]


def test_broken_lines_have_numbers(spark, tmp_path):
    (tmp_path / "l.jsonl").write_text('{"id":"a"}\n\nquebrada{\n{"id":"b"}\n[\n')
    got = jsonl.broken_lines(spark, str(tmp_path / "l.jsonl")).collect()
    assert sorted((r.line, r.text) for r in got) == [(3, "quebrada{"), (5, "[")]


def test_overwriting_run(spark, tmp_path):
    root, out = tmp_path / "in", str(tmp_path / "staff")
    (root / "Ana").mkdir(parents=True)
    (root / "Ana/a.html").write_text("<p>um</p>")
    run = lambda: pipelines.run_main(spark, str(root), out, "staff", seams.Extractors(), count_words(), overwrite=True)
    assert [r.nome_arquivo for r in run().collect()] == ["a.html"] == [r.nome_arquivo for r in run().collect()]  # no new rows: left as it is
    (root / "Ana/b.html").write_text("<p>dois</p>")
    assert [r.nome_arquivo for r in run().collect()] == ["b.html"]


def test_staff_run_twice_adds_nothing(spark, tmp_path):
    root = tmp_path / "in"
    (root / "Ana/2020/01/02").mkdir(parents=True)
    (root / "Ana/2020/01/02/a.html").write_text("<p>um dois</p>")
    (root / "Ana/2020/01/02/b.pdf").write_bytes(b"%PDF")
    (root / "Ana/c.txt").write_text("não entra")
    out = str(tmp_path / "staff")
    first = pipelines.run_main(spark, str(root), out, "staff", seams.Extractors(), count_words()).count()
    (root / "Ana/2020/01/02/c.xml").write_text("<r>1</r>")
    second = pipelines.run_main(spark, str(root), out, "staff", seams.Extractors(), count_words())
    rows = {r.nome_arquivo: r for r in second.collect()}
    assert first == 2 and set(rows) == {"a.html", "b.pdf", "c.xml"}
    assert (rows["a.html"].docente, rows["a.html"].dia, rows["a.html"].text_content, rows["a.html"].tokens_count) == ("Ana", "02", "um dois", 2)


def test_gazette_run_keeps_errors(spark, tree, tmp_path):
    rows = {r.nome_arquivo: r for r in pipelines.run_main(spark, str(tree), str(tmp_path / "g"), "gazette", seams.Extractors(), count_words()).collect()}
    assert set(rows) == {"a b%.pdf", "p.html", "x.xml", "bad.xml"}
    assert rows["bad.xml"].status == "FAILED" and rows["bad.xml"].error and rows["bad.xml"].file_format is None
    assert rows["x.xml"].municipio == "Vila Nova" and json.loads(rows["x.xml"].text_content) == {"r": {"a": "1"}}


def test_extraction_run_and_status_table(spark, tree, tmp_path):
    def failing():
        def run(data, name):
            raise RuntimeError("sem conversor")

        return run

    records, _ = pipelines.extraction_run(spark, str(tree), "docling", None, None, seams.Extractors(document=failing), count_words())
    table = pipelines.save_records(records, str(tmp_path / "t"), None)
    got = {r.filepath: r for r in table.collect()}
    assert len(got) == 8 and got["a b%.pdf"].status == "FAILED" and "sem conversor" in got["a b%.pdf"].error_log
    assert got["m.zip/z.txt"].text_content == "1" and got["m.zip/y/in.zip"].status == "EXTRACTED"
    again, _ = pipelines.extraction_run(spark, str(tree), "docling", table, None, seams.Extractors(), count_words())
    assert again.count() == 0
    assert {r.format: r.quantity for r in pipelines.profile(spark, str(tree)).collect()}[".xml"] == 2


def test_every_file_has_its_own_times(spark, tmp_path):
    def slow():
        def run(data, name):
            time.sleep(0.3 if name == "a.pdf" else 0)
            return name, 1

        return run

    (tmp_path / "a.pdf").write_bytes(b"%PDF")
    (tmp_path / "b.pdf").write_bytes(b"%PDF2")
    (tmp_path / "c.html").write_text("<p>x</p>")
    rows = {r.filepath: r for r in pipelines.extraction_run(spark, str(tmp_path), "docling", None, None, seams.Extractors(document=slow), count_words())[0].collect()}
    assert 0.3 <= rows["a.pdf"].extraction_duration_in_seconds < 5 and rows["b.pdf"].extraction_duration_in_seconds < 0.3
    for r in rows.values():
        began, ended = (datetime.fromisoformat(x) for x in (r.extraction_started, r.extraction_finished))
        assert abs((ended - began).total_seconds() - r.extraction_duration_in_seconds) < 1e-5
    assert rows["c.html"].text_content == "x"


def test_a_run_that_dies_leaves_its_files_to_the_next(spark, tmp_path):
    tables, root = str(tmp_path / "t"), tmp_path / "in"
    root.mkdir()
    (root / "a.html").write_text("<p>x</p>")

    def dies(c):
        raise RuntimeError("morreu")

    with pytest.raises(RuntimeError):
        pipelines.run_library(spark, str(root), "docling", tables, None, seams.Extractors(), dies)
    assert [(r.filepath, r.status, r.text_content) for r in pipelines.newest(spark, tables).collect()] == [("a.html", "IN_PROGRESS", None)]
    done = pipelines.run_library(spark, str(root), "docling", tables, None, seams.Extractors(), count_words())
    assert [(r.filepath, r.status, r.text_content) for r in done.collect()] == [("a.html", "EXTRACTED", "x")]


def test_second_engine_and_pages():
    def full():
        def run(data, name):
            raise RuntimeError("CUDA out of memory" if name == "big" else "outro")

        return run

    engine = seams.with_retry(full, lambda: lambda data, name: ("cpu", 1))()
    assert engine(b"", "big") == ("cpu", 1)
    with pytest.raises(RuntimeError):
        engine(b"", "x")
    assert seams.by_page(lambda data, name: iter(["um", "dois"]))()(b"", "n") == ("um\n\ndois\n\n", 2)


def test_ocr_routing():
    engines = {"tesseract": lambda b: "t", "deepseek": lambda b: "d"}
    assert seams.ocr_by_model("tesseract", engines, is_pdf=False)(b"") == "t"
    with pytest.raises(ValueError):
        seams.ocr_by_model("tesseract", engines, is_pdf=True)
    assert seams.page_or_empty(lambda b: 1 / 0)(b"") == ("", True)
    asked = seams.ocr_request(b"x", "frame")
    assert asked["image_url"] == "data:image/png;base64,eA==" and asked["max_tokens"] == 1024 and asked["temperature"] == 0


def test_publishing(spark, tmp_path):
    src = tmp_path / "src"
    src.mkdir()
    (src / "batch_0000.jsonl").write_text("{}")
    m = publish.publish(str(src), str(tmp_path / "hub"), "Acervo", "docling", "1.0")
    assert m["tag"] == "v1.0-docling" and m["files"] == 1
    assert [(r.file, r.sha256) for r in spark.read.json(str(tmp_path / "hub/manifests/v1.0-docling")).collect()] == [("data/batch_0000.jsonl", hashlib.sha256(b"{}").hexdigest())]
    with pytest.raises(FileExistsError):
        publish.publish(str(src), str(tmp_path / "hub"), "Acervo", "docling", "1.0")
    (src / "batch_0000.jsonl").rename(src / "batch_0001.jsonl")
    publish.publish(str(src), str(tmp_path / "hub"), "Acervo", "docling", "1.1", replace=True)
    assert [p.name for p in (tmp_path / "hub/data").iterdir()] == ["batch_0001.jsonl"]
    assert 'version: "1.1"' in (tmp_path / "hub/README.md").read_text()


def test_batches_are_found_by_the_card(spark, tmp_path):
    rows = spark.createDataFrame([(f"{k:04d}", "é" if k % 2 else None) for k in range(450)], "id string, text_content string")
    assert batches.write_jsonl(batches.batched(rows, "id"), str(tmp_path / "out"), "id") == 450
    assert sorted(p.name for p in (tmp_path / "out").iterdir()) == ["batch_0000.jsonl", "batch_0001.jsonl", "batch_0002.jsonl"]
    assert (tmp_path / "out/batch_0000.jsonl").read_text().split("\n")[:2] == ['{"id":"0000","text_content":null}', '{"id":"0001","text_content":"é"}']
    publish.publish(str(tmp_path / "out"), str(tmp_path / "hub"), "Acervo", "docling", "1.0")
    glob = re.search(r'"path": "([^"]+)"', (tmp_path / "hub/README.md").read_text())[1]
    back = jsonl.read(spark, f"{tmp_path}/hub/{glob}", "id string, text_content string")
    assert sorted(map(tuple, back.collect()), key=repr) == sorted(map(tuple, rows.collect()), key=repr)
    assert batches.write_texts(rows, str(tmp_path / "texts")).count() == 225 and (tmp_path / "texts/0001.txt").read_text() == "é"


def test_settings_and_log(tmp_path):
    (tmp_path / ".env").write_text("OUTPUT_FILENAME='x'\n# c\nBATCH_SIZE=7\n")
    s = Settings.load(str(tmp_path / ".env"), {"BATCH_SIZE": "9"})
    assert (s.output_filename, s.batch_size) == ("x", 9)
    log, errors = create_logger("lavra.test", str(tmp_path), rules=[("lavra", "calar")])
    log.info("calar isto")
    log.info("dizer isto")
    errors.error("falha")
    assert "calar" not in (tmp_path / "lavra.test.log").read_text() and "dizer" in (tmp_path / "lavra.test.log").read_text()
    assert "falha" in (tmp_path / "lavra.test_error.log").read_text()


def test_stream_upserts_once(spark, tmp_path):
    folder, target, ck = tmp_path / "in", str(tmp_path / "table"), str(tmp_path / "ck")
    folder.mkdir()
    schema = "id string, v int, created_at int, updated_at int"
    (folder / "1.jsonl").write_text('{"id":"a","v":1,"created_at":1,"updated_at":1}\n\'{"id":"b","v":1,"created_at":1,"updated_at":1}\'\n')
    ingest.upsert_stream(spark, str(folder), schema, target, ck, ["id"], ["created_at", "updated_at"]).awaitTermination()
    (folder / "2.jsonl").write_text('bad\n{"id":"a","v":2,"created_at":2,"updated_at":2}\n')
    ingest.upsert_stream(spark, str(folder), schema, target, ck, ["id"], ["created_at", "updated_at"]).awaitTermination()
    assert {r.id: (r.v, r.created_at, r.updated_at) for r in ingest.current(spark, target).collect()} == {"a": (2, 1, 2), "b": (1, 1, 1)}
