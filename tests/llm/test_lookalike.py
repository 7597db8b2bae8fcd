import unicodedata

from hypothesis import given, settings
from hypothesis import strategies as st

from lavra.llm import lookalike


def test_forms():
    assert lookalike.normal_form("Ｃａｆé\u200b\xa0 ﬁm") == "café fim"
    assert lookalike.normal_form("Straße x²") == "strasse x2"
    assert lookalike.normal_form("\u0440\u0430\u0440a") == "papa"
    assert lookalike.visible_form("n\xba 5") != lookalike.visible_form("no 5")
    assert lookalike.visible_form("ｎ\xba 5") == lookalike.visible_form("nº\u20075")
    assert lookalike.visible_form("x²") != lookalike.visible_form("x2")
    assert lookalike.visible_form(unicodedata.normalize("NFD", "ação")) == lookalike.visible_form("ação") != lookalike.visible_form("acao")
    assert lookalike.visible_form("Caso") != lookalike.visible_form("caso")
    assert lookalike.visible_form("\u200b\ufeff \xad") == ""
    assert lookalike.normal_form(lookalike.normal_form("ＡΒ ﬃ İ")) == lookalike.normal_form("ＡΒ ﬃ İ")


def test_pairs(spark):
    texts = ["ação", unicodedata.normalize("NFD", "ação"), "ação", "a\u200bção", "Ação", None, "", " ", "\u200b", "outro", "outro"]
    df = spark.createDataFrame([(k, t, 1) for k, t in enumerate(texts)], "doc_id bigint, text string, look int")
    got = sorted((r.doc_id_a, r.doc_id_b) for r in lookalike.pairs(df, "doc_id", "text").collect())
    want = [(a, b) for a in range(4) for b in range(a + 1, 4) if texts[a] != texts[b]]
    assert got == want
    assert lookalike.pairs(df.limit(0), "doc_id", "text").count() == 0


def test_hot_group(spark):
    rows = [(k, "igual") for k in range(3000)] + [(5000, "igu\u200bal")]
    out = lookalike.pairs(spark.createDataFrame(rows, "doc_id bigint, text string"), "doc_id", "text")
    assert out.count() == 3000


def test_normalise_keeps_nulls(spark):
    df = spark.createDataFrame([(None,), ("É",), ("É",)], "t string")
    assert [r.x for r in df.select(lookalike.normalise(df.t).alias("x")).collect()] == [None, "é", "é"]


def test_one_path_for_ascii_and_other_texts():
    for form in (lookalike.visible_form, lookalike.normal_form):
        assert form("abc\x07d") == form("abcd") == "abcd" and form("ábc\x07d") == form("ábcd")
        assert form("a\x1cb\tc\x0bd") == "a b c d"


def test_letters_of_other_scripts():
    for a, b in (("ɑtɑ", "ata"), ("Ꭺtɑ", "Ata"), ("ꓮto", "Ato"), ("nօtɑ", "nota"), ("հօra", "hora"), ("ⲟra", "ora"), ("Ⅳ", "IV"), ("ⅸ", "ix"), ("𝖺𝗍𝗈", "ato"), ("𝚊𝚝𝚘", "ato")):
        assert lookalike.visible_form(a) == b
    for a, b in (("𝐀to", "Ato"), ("𝑎to", "ato"), ("ªto", "ato"), ("½", "1/2"), ("á", "a")):
        assert lookalike.visible_form(a) != lookalike.visible_form(b)


@settings(max_examples=2000, deadline=None)
@given(st.text(alphabet=st.one_of(st.characters(exclude_categories=("Cs",)), st.sampled_from("aeçãºªÇÉ\u0301\u0327\u200b\xa0Аοﬁ２ß İ\n\x07"))))
def test_forms_by_whole_translation(text):
    """The forms touch special characters only; translating every character gives the same."""
    for form, table in ((lookalike.visible_form, lookalike._VISIBLE), (lookalike.normal_form, lookalike._NORMAL)):
        mapped = "".join(table[c] for c in text)
        if form is lookalike.visible_form:
            want = unicodedata.normalize("NFC", mapped)
        else:
            want = unicodedata.normalize("NFKC", unicodedata.normalize("NFKC", mapped).casefold())
        assert form(text) == " ".join(want.split())


def test_membership(spark):
    df = spark.createDataFrame([(1, "ação", 0), (2, "ac\u0327a\u0303o", 0), (3, "outro", 0), (4, "outro", 0), (5, "ação\u200b", 0), (6, None, 0)], "doc_id int, text string, representative int")
    assert sorted(map(tuple, lookalike.membership(df, "doc_id", "text").collect())) == [(1, 1), (2, 1), (5, 1)]
