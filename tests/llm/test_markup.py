import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lavra.llm import markup, markup_clean, markup_training

CASES = [
    ("Por **força** da lei.", {"markdown"}), ("Ver [ato](https://a.invalid/1) agora.", {"markdown"}), ("Texto \n\n### Anexo V\n\ne mais.", {"markdown"}), ("Título\n======\n\nTexto.", {"markdown"}),
    ("O <b>prefeito</b> assina.", {"html"}), ("Um&nbsp;&nbsp;dois", {"html"}), ("acórd&atilde;o", {"html"}), ("linha<br />outra", {"html"}), ("A '''lei''' vale.", {"wiki"}), ("O [[Ato 3|ato]] vale.", {"wiki"}),
    ("== Ato ==\n\n# Um item da lista longa.\n# Outro item da lista longa.", {"wiki"}), ("O \\emph{ato} vale.", {"latex"}), ("Valor $\\alpha_{4}$ dado.", {"latex"}), ("exposi\\c{c}\\~{a}o", {"latex"}),
    ("Área de 3 * 4 * 2 metros, aceitos *.", set()), ("Conjunto {1, 2} e nota [3] [sic].", set()), ("De R$ 5,00 a R$ 9,00.", set()), ("C:\\dados\\editais\\lote_5_final.pdf, item #31", set()), ("Contato <setor@casa.invalid>", set()),
    ("a '' b '' c ~ d", set()), ("- 45 -", set()), ("X & Y; a < b > c", set()), ("", set()), (None, set()), ("  ", set()),
]


def test_kinds(spark):
    df = spark.createDataFrame([(k, t, "x") for k, (t, _) in enumerate(CASES)], "id int, t string, markup string")
    got = {r.id: set(r.markup) for r in markup.find(df, "t").collect()}
    assert got == {k: want for k, (_, want) in enumerate(CASES)}
    assert markup.find(df.limit(0), "t").count() == 0


_PIECES = ["<b>", "</p", "<!--", "&nbsp;", "&frac12;", "&#9;", "**", "__", "*", "_", "[", "](", ")", "#", "# ", "###### ", "=", "==", "===", "---", "-", "`", "```", "~~", ">", "|", "||", "{|", "|-", "|}", "'", "''", "[[", "]]", "{{", "}}", "\\", "\\emph{", "}", "{", "\\(", "\\'e", "\\=a", "$", "x_1", "^2", " ", "\n", "a", "Palavra", ":", "<nowiki"]


@settings(max_examples=1500, deadline=None)
@given(st.lists(st.sampled_from(_PIECES), max_size=9).map("".join))
def test_the_filter_passes_whatever_a_pattern_knows(text):
    lines = text.split("\n")
    if any(markup.hint(kind, lines, k) for kind in markup.KINDS for k in range(len(lines))):
        assert re.search(markup.SIGNS, text)


def test_very_long_text(spark):
    t = "Uma linha comum de texto.\n" * 45_000 + "com **marca** no fim"
    df = spark.createDataFrame([(t,)], "t string")
    assert markup.find(df, "t").first().markup == ["markdown"]
    assert markup_clean.convert(df, "t").first().clean_text == t.replace("**", "")


def test_a_long_text_is_labelled_as_in_one_piece():
    lab = markup.Labeller.load(str(markup.WEIGHTS))
    text = "\n".join(["<ul>", "\\begin{itemize}", *["Uma linha comum <li>x"] * 40, "== T ==", "# um", "# dois", "```", "x = 1 * 2", "```", "\\item y"] * 3)
    whole, parts = lab.scores([markup.leaves(text)])[0], lab.scores_long(text.split("\n"), 7)
    assert np.allclose(whole[0], parts[0], atol=1e-4) and np.allclose(whole[1], parts[1], atol=1e-3)
    texts = ["# T\n\nx", "a * b\n" * 300, "", "b **c**"]
    got = list(markup.labelled(texts, lab, leaves_at_once=100, long=250))
    assert [len(r) for _, r in got] == [t.count("\n") + 1 for t in texts] and [k for k, _ in got] == [{"markdown"}, set(), set(), {"markdown"}]


def _weights():
    with np.load(markup.WEIGHTS) as z:
        return {k: z[k].astype(np.float32) for k in z.files}


def test_labeller_on_unseen_documents():
    recall, precision, roles = markup_training.accuracy(_weights(), 500, seed=99)
    assert recall >= 0.99 and precision >= 0.99 and roles > 0.99


def test_the_labeller_decides():
    """Other weights give another result, and what lies around a line counts."""
    texts, w = [t for t, _ in CASES if t], _weights()
    usual = [k for k, _ in markup.labelled(texts, markup.Labeller(w))]
    other = markup_training._start(3) | {"least": w["least"]}
    assert usual != [k for k, _ in markup.labelled(texts, markup.Labeller(other))]
    hintless = lambda x: np.concatenate([x[:, : -markup.N_HINTS], np.zeros((len(x), markup.N_HINTS), np.float32)], axis=1)
    recall, precision, _ = markup_training.accuracy(w, 300, seed=98, change=hintless)
    assert recall > 0.9 and precision > 0.7  # most marks are known without any pattern


def test_batches_do_not_change_scores():
    lab = markup.Labeller.load(str(markup.WEIGHTS))
    docs = [markup.leaves(t) for t, _ in CASES if t]
    together = lab.scores(docs)
    for d, (p, r) in zip(docs, together, strict=True):
        q, s = lab.scores([d])[0]
        assert np.allclose(p, q, atol=1e-4) and np.allclose(r, s, atol=1e-3)


def test_training_learns():
    w = markup_training.train(n_documents=5000, epochs=3)
    recall, precision, _ = markup_training.accuracy(w | {"least": markup_training.calibrate(w, 400)}, 200)
    assert recall > 0.8 and precision > 0.8


@pytest.mark.parametrize(
    ("source", "want"),
    [
        ("<h1>T</h1><ul><li>a</li><li>b</li></ul><table><tr><td>1</td><td>2</td></tr></table><pre>x\n y</pre>", "T\n\n- a\n- b\n\n1 | 2\n\n    x\n     y"),
        ("\\section{T}\n\n\\begin{itemize}\n\\item a\n\\end{itemize}\nvalor $x_{1}$ de R\\$ 5", "T\n\n\n- a\n\nvalor x_{1} de R$ 5"),
        ("# T\n\n| a | b |\n| --- | --- |\n| 1 | 2 |\n\n```\nx = 1\n```\n\n* **i**", "T\n\na | b\n1 | 2\n\n    x = 1\n\n- i"),
        ("== T ==\n\n# a\n# b\n\n{|\n|-\n| 1 || 2\n|}\n\n''d'' [[x|y]]", "T\n\n1. a\n2. b\n\n1 | 2\n\nd y"),
    ],
)
def test_clean(source, want):
    lines = source.split("\n")
    kinds = {k for k in markup.KINDS if any(markup.hint(k, lines, n) for n in range(len(lines)))}
    roles = ["list" if x.startswith("# ") and "==" in source else "heading" if x.startswith("# ") else "paragraph" for x in lines]
    squeeze = lambda t: [x for x in t.split("\n") if x.strip()]
    assert squeeze(markup_clean.clean(source, kinds, roles)) == squeeze(want)


def test_convert_edges(spark):
    df = spark.createDataFrame([(1, None), (2, "simples"), (3, "a **b** c"), (3, "a **b** c")], "id int, t string").withColumn("clean_text", F.lit(0))
    got = sorted((r.id, r.clean_text) for r in markup_clean.convert(df, "t").collect())
    assert got == [(1, None), (2, "simples"), (3, "a b c"), (3, "a b c")]


def test_tables_without_end_tags_and_percent_signs():
    assert markup_clean.from_html("<table><tr><td>a<td>b<tr><td>c</td><td>d</table>fim").split("\n") == ["a | b", "c | d", "", "fim"]
    nested = markup_clean.from_html("<table><tr><td>x</td><td>y<table><tr><td>1</td><td>2</td></tr></table></td></tr></table>")
    assert "1 | 2" in nested and "x | y" in nested
    assert markup_clean.from_html("<tr><td>a</td><td>b") == "a | b"
    assert markup_clean.from_latex("cresceu 50 % no \\emph{ano}") == "cresceu 50 % no ano"
    assert "nota" not in markup_clean.from_latex("\\documentclass{article}\nx % nota")
