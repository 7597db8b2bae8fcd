import random

import pytest

from lavra.llm import encoding

R = random.Random(3)
WORDS = "ação município não é três décimo serviço órgão públicas você está português às região lição exercício início também último coração número câmara água índice ônibus avô pão mães".split()


def text(n=40):
    return " ".join(R.choice(WORDS) if R.random() < 0.6 else R.choice(["de", "a", "o", "para", "casa", "texto", "livro", "nº 7"]) for _ in range(n)) + "."


SWAPS = [("utf-8", "cp1252"), ("utf-8", "latin-1"), ("utf-8", "cp850"), ("utf-8", "mac_roman"), ("utf-8", "cp1250"), ("cp850", "cp1252"), ("cp1252", "cp850")]


def spoil(s, written, read):
    return "".join(encoding.PAGES[read].get(b, chr(b)) for b in s.encode(written))


@pytest.fixture(scope="module")
def sample(spark):
    clean = [text() for _ in range(1500)] + ["Straße e façade, 20 °C ± 2; § 6º. " + text(5) for _ in range(30)] + ["«AMANHû. " + text(5) for _ in range(30)]
    bad = []
    for k in range(140):
        t = text()
        w, r = SWAPS[k % len(SWAPS)]
        words = t.split()
        part = spoil(" ".join(words[5:25]), w, r)
        bad.append((t, " ".join([*words[:5], part, *words[25:]])))
    rows = [(f"c{k}", t) for k, t in enumerate(clean)] + [(f"b{k}", t) for k, (_, t) in enumerate(bad)] + [("n", None), ("e", ""), ("x", "Di\ufffdrio n\ufffd 7"), ("b0", bad[0][1])]
    return clean, bad, spark.createDataFrame([(i, t, "k") for i, t in rows], "id string, t string, damaged string")


def test_detection_and_restoration(spark, sample):
    clean, bad, df = sample
    model = encoding.learn(df, "t")
    out = {r.id: r for r in encoding.repair(df, "t", model).collect()}
    found = {i for i, r in out.items() if r.damaged}
    assert {f"b{k}" for k in range(len(bad))} <= found
    assert not [i for i in found if i.startswith("c")]
    right = sum(out[f"b{k}"].restored == t for k, (t, _) in enumerate(bad))
    assert right >= 0.95 * len(bad)
    assert out["x"].damaged and "\ufffd" not in out["x"].restored
    assert out["n"].restored is None and not out["n"].damaged and out["e"].restored == ""


def test_letters_whose_second_half_was_dropped(spark, sample):
    model = encoding.learn(sample[2], "t")
    bad = spoil("avaliação do município e do exercício", "utf-8", "cp1252").replace("\xad", "")
    damaged, _, _, restored, _ = encoding.diagnose(model, bad)
    assert damaged and restored == "avaliação do município e do exercício"
    assert encoding.diagnose(model, "SÃO MANHÃ, avaliação do município")[0] is False


def test_empty_corpus(spark, sample):
    df = sample[2].limit(0)
    model = encoding.learn(df, "t")
    assert encoding.repair(df, "t", model).count() == 0


def test_ciphers_invert_themselves():
    for w, r in SWAPS:
        s = "çãéíóúâêôõàÇÃ"
        assert encoding.Cipher(w, r).decipher(spoil(s, w, r)) == s


def test_fields(spark):
    df = spark.createDataFrame([("a", "x", None), (None, "y", "z")], "id string, p string, q string")
    assert [tuple(r) for r in encoding.fields_long(df, "id", ["p", "q"]).collect()] == [("a", "p", "x")]


@pytest.mark.parametrize("share", [3, 10])
def test_one_source_with_a_large_share_of_the_rows(spark, share):
    clean = [text() for _ in range(900)]
    rows = [(k, t, spoil(t, "cp850", "cp1252") if k % share == 0 else t) for k, t in enumerate(clean)]
    df = spark.createDataFrame(rows, "id int, plain string, t string")
    out = encoding.repair(df, "t", encoding.learn(df, "t")).collect()
    assert [r.id for r in out if r.damaged != (r.t != r.plain)] == []
    assert sum(r.restored == r.plain for r in out) >= 0.95 * len(out)


UNKNOWN = [("utf-8", "cp1251"), ("cp1252", "cp1251"), ("utf-8", "cp866"), ("cp1252", "cp866"), ("cp1252", "cp1257"), ("cp1252", "koi8_r"), ("utf-8", "iso8859_5")]


def test_unknown_swaps_are_learnt_per_source(spark, sample):
    """Swaps of pages that are not listed, in one source each: the mapping is learnt from its texts."""
    assert not {r for _, r in UNKNOWN} & set(encoding.READ)
    rows = [(f"ok{k % 9}", t, t) for k, t in enumerate(sample[0][:1200])]
    for w, r in UNKNOWN:
        rows += [(f"{w} {r}", t := text(), t.encode(w).decode(r, errors="replace")) for _ in range(40)]
        rows += [(f"{w} {r}", t := text(), t) for _ in range(10)]
    names = "Łódź Świętosława Grażyna Ястребов Ёлкин Δημήτρης Öztürk Şahin".split()
    rows += [("names", t := f"Autor: {names[k % 8]} {names[k % 7]}. " + text(6), t) for k in range(60)]
    df = spark.createDataFrame([(k, *x) for k, x in enumerate(rows)], "id int, folder string, plain string, t string")
    model = encoding.learn(df, "t", source="folder")
    tables = encoding.learn_sources(df, "t", "folder", model)
    got = encoding.repair(df, "t", model, "folder", tables).collect()
    assert {r.source for r in tables.collect()} == {f"{w} {r}" for w, r in UNKNOWN}
    assert not [r.t for r in got if r.damaged and r.t == r.plain]
    for w, r in UNKNOWN:
        mine = [x for x in got if x.folder == f"{w} {r}" and x.t != x.plain]
        assert sum(x.damaged for x in mine) >= 0.98 * len(mine), (w, r)
        whole = [(a, b) for x in mine for a, b in zip(x.restored.split(), x.plain.split()) if not b.isascii()]
        assert sum(a == b for a, b in whole) >= 0.9 * len(whole), (w, r, [x for x in whole if x[0] != x[1]][:20])
    joined = encoding.repair(df, "t", model, "folder", tables, few_tables=0).select("id", "restored").collect()
    assert sorted(map(tuple, joined)) == sorted((r.id, r.restored) for r in got)


def test_a_guess_is_not_resolved_and_line_ends_do_not_matter(sample, spark):
    model = encoding.learn(sample[2], "t")
    assert encoding.diagnose(model, "Di\ufffdrio n\ufffd 7")[4] == 2
    for t in ("prefeitura munic!pal, educaçäo e gestäo", "exercício e acórdäo"):
        assert encoding.diagnose(model, t)[0] == encoding.diagnose(model, t.replace(" ", "\n"))[0]


def test_signs_that_nobody_writes_beside_a_letter():
    assert encoding._unwritten("^", "╔", "r") and encoding._unwritten("^", "\x90", "r") and not encoding._unwritten(" ", "│", " ") and not encoding._unwritten("a", "ç", "o")
