import pytest
from pyspark.sql import functions as F

from lavra.operators import batches, corpus, metadata, pages, status


def test_page_assembly(spark):
    df = spark.createDataFrame([("d", 2, " y "), ("d", 1, "x"), ("d", 3, " \n"), ("e", 1, None)], "d string, n int, t string")
    got = {r.d: (r.page_count, r.text) for r in pages.assemble(df, "d", "n", "t").collect()}
    assert got == {"d": (3, "x\n\ny"), "e": (1, "")}
    raw = {r.d: r.text for r in pages.concatenate(df, "d", "n", "t").collect()}
    assert raw["d"] == "x\n\n y \n\n \n\n\n"


def test_page_subset_follows_the_list(spark):
    df = spark.createDataFrame([("d", k, str(k)) for k in range(1, 5)], "d string, n int, t string")
    assert [r.t for r in pages.select_pages(df, "d", "n", [3, 0]).orderBy("position").collect()] == ["4", "1"]


def test_batches_of_200(spark):
    df = spark.range(450).select(F.format_string("%05d", "id").alias("id"))
    got = {r.batch: r["count"] for r in batches.batched(df, "id", first=7).groupBy("batch").count().collect()}
    assert got == {7: 200, 8: 200, 9: 50}
    assert batches.batched(df.limit(0), "id").count() == 0


def test_numbering_is_the_global_order(spark):
    df = spark.range(1000).select(((F.col("id") * 37) % 1000).alias("k"))
    assert all(r.k == r.row_no for r in batches.numbered(df, "k").collect())


def test_written_batches_keep_nulls(spark, tmp_path):
    df = spark.createDataFrame([("a", None, 0), ("ç", 1, 1)], "id string, n int, batch int")
    batches.write_jsonl(df, str(tmp_path / "out"))
    lines = sorted(r.value for r in spark.read.text(str(tmp_path / "out")).select("value").collect())
    assert lines == ['{"id":"a","n":null}', '{"id":"ç","n":1}']
    assert batches.next_batch(batches.written(spark, str(tmp_path / "out"))) == 2
    (tmp_path / "empty").mkdir()
    assert batches.next_batch(batches.written(spark, str(tmp_path / "empty"))) == 0
    with pytest.raises(FileNotFoundError):
        batches.written(spark, str(tmp_path / "none"))


def test_status_gate(spark):
    files = spark.createDataFrame([(k, "p") for k in "abcde"], "id string, pipeline string")
    table = spark.createDataFrame([("b", "p", "IN_PROGRESS"), ("c", "p", "EXTRACTED"), ("d", "p", "FAILED"), ("e", "p", None)], "id string, pipeline string, status string")
    assert {r.id for r in status.to_process(files, table).collect()} == {"a", "b"}
    assert {r.id for r in status.to_process(files, table, retry_failed=True).collect()} == {"a", "b", "d"}
    assert {r.id for r in status.not_done(files, table).collect()} == {"a"}


def test_upsert_replaces_rows_and_keeps_creation(spark):
    old = spark.createDataFrame([("a", "x", 1, 1)], "id string, v string, created_at int, updated_at int")
    new = spark.createDataFrame([("a", 5, 5), ("b", 6, 6), ("b", 6, 6)], "id string, created_at int, updated_at int")
    got = {r.id: (r.v, r.created_at, r.updated_at) for r in status.upsert(old, new, ["id"], ["updated_at"]).collect()}
    assert got == {"a": (None, 1, 5), "b": (None, 6, 6)}
    again = status.upsert(status.upsert(old, new, ["id"], ["updated_at"]), new, ["id"], ["updated_at"])
    assert {r.id for r in again.collect()} == {"a", "b"}


def test_two_phases(spark):
    df = spark.createDataFrame([("a", "p", "f", ".x", "EXTRACTED", 3, "t0")], "id string, pipeline string, filepath string, file_format string, status string, tokens_count int, extraction_started string")
    rows = {r.phase: r for r in status.two_phase(df, "extraction_started", "extraction_finished").collect()}
    assert rows[0].status == "IN_PROGRESS" and rows[0].tokens_count is None and rows[1].tokens_count == 3


def test_metadata_lookup_by_path(spark):
    schema = "p string, turmas array<struct<codigo:string,planos_aula:array<struct<titulo:string,arquivos:array<struct<path_local:string,nome_arquivo:string>>>>>>"
    docs = spark.createDataFrame(
        [
            ("1", [("T", [("P", [("files/2022/06/28/q", "x.zip"), ("a/files/2022/06/28/q", None), ("files/2022/06/28/q", "y.txt")])])]),
            ("2", [("U", [("Q", [("files/2022/06/28/q", "y.txt")])])]),
        ],
        schema,
    )
    table = metadata.lookup(docs, "p")
    assert {r.key: r.turma.codigo for r in table.collect()} == {"2022/06/28/x.zip": "T", "2022/06/28/y.txt": "U"}
    paths = ["data/input/2022/06/28/x.zip/sub/y.txt", "data/2022/06/28/y.txt", "data/2022/06/29/y.txt", "nodate/y.txt", "a/2021/xx/2022/06/28/y.txt", "1999/1/2/2022/06/28/y.txt", None]
    files = spark.createDataFrame([(p,) for p in paths], "path string")
    got = {r.path: r.v for r in metadata.attach(files, "path", table, F.col("turma.codigo"), "v").collect()}
    assert got == dict(zip(paths, ["T", "U", None, None, "U", None, None], strict=True))


def test_extension_profile(spark):
    df = spark.createDataFrame([("b/x.pdf",), ("a/y.PDF",), ("c/z",), ("d.txt",)], "path string")
    rows = [(r.format, r.quantity, r.percentual) for r in corpus.extension_profile(df, "path").collect()]
    assert rows == [(".pdf", 2, 50.0), ("(Without extension)", 1, 25.0), (".txt", 1, 25.0)]
    assert corpus.extension_profile(df.limit(0), "path").count() == 0


def test_log_suppression_with_and_without_broadcast(spark):
    lines = spark.createDataFrame([("a.b", "foo bar"), ("a.b", "other"), (None, "foo"), ("c", None), ("a.b", "foo bar")], "logger_name string, message string")
    rules = spark.createDataFrame([("a", "foo")], "logger_name string, message_pattern string")
    for limit in (10, 0):
        got = corpus.suppress(lines, rules, max_rules=limit).collect()
        assert sorted((str(r.logger_name), str(r.message)) for r in got) == [("None", "foo"), ("a.b", "other"), ("c", "None")]


def test_copy_status(spark):
    wanted = spark.createDataFrame([("s1", "t1"), ("s2", "t2"), ("s3", "t3")], "src string, dst string")
    have = spark.createDataFrame([("s1",), ("s2",), ("t2",), ("s1",)], "k string")
    df = corpus.copy_status(wanted, "src", "dst", have, "k")
    assert {r.src: r.status for r in df.collect()} == {"s1": "copied", "s2": "skipped", "s3": "not_found"}
    assert corpus.summary(df).first().asDict() == {"processed": 3, "copied": 1, "not_found": 1}


def test_listings(spark):
    keys = spark.createDataFrame([("a/x/1",), ("a/x/2",), ("a/y",), ("b",)], "k string")
    assert [r.prefix for r in corpus.first_segments(keys, "k").collect()] == ["a/"]
    assert [r.prefix for r in corpus.sub_folders(keys, "k", "a/").collect()] == ["a/x/"]
    assert [r.k for r in corpus.under(keys, "k", "a/", page=2).collect()] == ["a/x/1", "a/x/2"]
