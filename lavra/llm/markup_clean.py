"""Clean text from marked-up text: headings, lists, tables, code and formulas stay recognisable.

The output has one notation for all kinds: a heading is a line of its own between blank lines, list items start
with '- ' or '1. ', table cells are divided by ' | ', code is indented by four spaces, formulas stand without
their delimiters. What '#' and '*' mean at the start of a line is decided by the labeller's role of that leaf.
"""

from __future__ import annotations

import html
import re
import unicodedata
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lavra.llm.markup import ROLES, SIGNS, WEIGHTS, Labeller, labelled

#: LaTeX accents and the combining characters they stand for.
ACCENTS = {"`": "̀", "'": "́", "^": "̂", "~": "̃", '"': "̈", "=": "̄", ".": "̇", "c": "̧"}
_BLOCK = {"p", "div", "section", "article", "blockquote", "header", "footer", "nav", "main", "form", "figure", "center", "dl", "dt", "dd", "title"}


class _Page(HTMLParser):
    """Lines of clean text from HTML; white space is collapsed but in pre."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.lines: list[str] = []
        self.now = ""
        self.skip = self.pre = 0
        self.lists: list[list] = []
        self.rows: list[list[str]] = []  # open rows, the innermost table's last
        self.tables: list[int] = []  # rows that were open when a table began

    def _end(self, blank: bool = False) -> None:
        if self.now.strip():
            self.lines.append(self.now.strip())
        self.now = ""
        if blank and self.lines and self.lines[-1]:
            self.lines.append("")

    def _end_cell(self) -> None:
        """A cell or text that the next cell ends."""
        if self.now.strip():
            self.rows[-1].append(self.now.strip())
            self.now = ""

    def _end_row(self) -> None:
        """The open row of the innermost table, with its last cell; end tags of cells and rows may be missing."""
        if len(self.rows) > (self.tables[-1] if self.tables else 0):
            self._end_cell()
            self.lines.append(" | ".join(self.rows.pop()))

    def end(self) -> None:
        while self.rows:
            self.tables.clear()
            self._end_row()
        self._end()

    def handle_starttag(self, tag, attrs):
        if tag in ("script", "style"):
            self.skip += 1
        elif tag == "br":
            self._end()
        elif tag in ("ul", "ol"):
            self._end()
            self.lists.append([tag, 0])
        elif tag == "li":
            self._end()
            if self.lists:
                self.lists[-1][1] += 1
            self.now = f"{self.lists[-1][1]}. " if self.lists and self.lists[-1][0] == "ol" else "- "
        elif tag == "table":
            if self.rows:
                self._end_cell()
            self._end()
            self.tables.append(len(self.rows))
        elif tag == "tr":
            self._end_row()
            self._end()
            self.rows.append([])
        elif tag in ("td", "th") and self.rows:
            self._end_cell()
        elif tag == "pre":
            self._end(True)
            self.pre += 1
        elif tag == "sup":
            self.now += "^"
        elif tag == "sub":
            self.now += "_"
        elif tag in _BLOCK or re.fullmatch("h[1-6]", tag):
            self._end(True)

    def handle_endtag(self, tag):
        if tag in ("script", "style"):
            self.skip = max(0, self.skip - 1)
        elif tag in ("td", "th") and self.rows:
            self.rows[-1].append(self.now.strip())
            self.now = ""
        elif tag == "tr":
            self._end_row()
        elif tag == "table":
            self._end_row()
            if self.tables:
                self.tables.pop()
            self._end(True)
        elif tag in ("ul", "ol"):
            self._end(len(self.lists) == 1)
            if self.lists:
                self.lists.pop()
        elif tag == "pre":
            self.pre = max(0, self.pre - 1)
            self._end(True)
        elif tag == "li":
            self._end()
        elif tag in _BLOCK or tag == "table" or re.fullmatch("h[1-6]", tag):
            self._end(True)

    def handle_data(self, data):
        if self.skip:
            return
        if self.pre:
            self.lines += ["    " + x for x in data.strip("\n").split("\n")]
            return
        # Outside elements that lay text out, line ends of the source are kept: a page with a single mark has its own lines.
        parts = data.split("\n")
        for k, part in enumerate(parts):
            if k:
                if part.strip() or self.now.strip():
                    self._end()
                elif k < len(parts) - 1:
                    self._end(True)
            self.now += re.sub(r"[ \t\xa0]+", " ", part)


def from_html(text: str) -> str:
    page = _Page()
    page.feed(text)
    page.close()
    page.end()
    return "\n".join(page.lines)


def _accent(m: re.Match) -> str:
    letter = (m[2] or m[3] or "").replace("\\", "")
    return unicodedata.normalize("NFC", letter[:1] + ACCENTS[m[1]] + letter[1:]) if letter else ""


def from_latex(text: str) -> str:
    """LaTeX to clean text: accents composed, commands unwrapped, environments as lists, tables, code and formulas."""
    if re.search(r"\\documentclass|\\begin\{document\}", text):  # in prose with single marks a percent sign is one
        text = re.sub(r"(?<!\\)%[^\n]*", "", text)
    out, stack, number = [], [], 0
    for line in text.split("\n"):
        here = stack[-1] if stack else ""
        if here == "verbatim" and "\\end{verbatim}" not in line:
            out.append("    " + line)
            continue
        for m in re.finditer(r"\\(begin|end)\{([a-zA-Z]+)\*?\}(?:\{[^}]*\})?(?:\[[^\]]*\])?", line):
            if m[1] == "begin":
                stack.append(m[2])
                number = 0
            elif m[2] in stack:
                del stack[len(stack) - 1 - stack[::-1].index(m[2]) :]
            here = stack[-1] if stack else ""
        line = re.sub(r"\\(?:begin|end)\{[a-zA-Z]+\*?\}(?:\{[^}]*\})?(?:\[[^\]]*\])?", "", line)
        line = re.sub(r"\\(?:documentclass|usepackage|maketitle|label|pagestyle|newpage|noindent|centering)(?:\[[^\]]*\])?(?:\{[^}]*\})?", "", line)
        if re.search(r"\\item\b", line):
            number += 1
            line = re.sub(r"\s*\\item(?:\[[^\]]*\])?\s*", f"{number}. " if here == "enumerate" else "- ", line, count=1)
        if here == "tabular":
            line = re.sub(r"(?<!\\)&", "|", re.sub(r"\\hline", "", line)).removesuffix("\\\\").rstrip()
        kept: list[str] = []

        def keep(m: re.Match, kept=kept) -> str:
            kept.append(next(g for g in m.groups() if g is not None).strip())
            return f"\x00{len(kept) - 1}\x00"

        line = re.sub(r"\\\((.+?)\\\)|\\\[(.+?)\\\]|(?<![\\\w])\$([^\s$](?:[^$\n]*[^\s$])?)\$(?!\d)", keep, line) if here not in ("equation", "align", "displaymath") else f"\x00{kept.append(line.strip()) or 0}\x00"
        line = re.sub(r"\\([`'^~\"=.c])(?:\{\\?([a-zA-Z]*)\}|\\?([a-zA-Z]))", lambda m: _accent(m) if m[1] != "c" or m[2] is not None else m[0], line)
        line = re.sub(r"~?\\(?:cite|ref|footnotemark)\{[^}]*\}", "", line)
        heading = re.match(r"\s*\\(?:part|chapter|(?:sub)*section|paragraph|title)\*?\{", line)
        for _ in range(4):
            line = re.sub(r"\\[a-zA-Z]+\*?(?:\[[^\]]*\])?\{([^{}]*)\}", r"\1", line)
        line = re.sub(r"\\([$%&#_{}])", r"\1", line).replace("~", " ").replace("\\\\", "")
        line = re.sub("\x00(\\d+)\x00", lambda m, kept=kept: kept[int(m[1])], line)
        out += ["", line.strip(), ""] if heading else [line]
    return "\n".join(out)


def _inline(line: str, kinds: set[str]) -> str:
    if "markdown" in kinds:
        line = re.sub(r"!\[([^\]]*)\]\(([^)\s]+)\)", r"\1: \2", line)
        line = re.sub(r"(?<!\[)\[([^\[\]]*)\]\([^()\s]+\)", r"\1", line)
        line = re.sub(r"\*\*(\S(?:[^*]*\S)?)\*\*|(?<![\w_])__(\S(?:.*?\S)?)__(?![\w_])|~~(\S[^~]*)~~", lambda m: m[1] or m[2] or m[3], line)
        line = re.sub(r"(?<![\w*])\*([^\s*](?:[^*]*[^\s*])?)\*(?![\w*])", r"\1", line)
        line = re.sub(r"(?<!`)`([^`]+)`(?!`)", r"\1", line)
    if "wiki" in kinds:
        line = re.sub(r"\{\{([^{}]*)\}\}", lambda m: "; ".join(x.replace("=", ": ") for x in m[1].split("|")), line)
        line = re.sub(r"\[\[(?:[^\[\]|]*\|)?([^\[\]]+)\]\]", r"\1", line)
        line = re.sub(r"'{2,5}([^\s'](?:.*?[^\s'])?)'{2,5}", r"\1", line)
        line = re.sub(r"\[https?://\S+ ([^\]]+)\]", r"\1", line)
    return line


def from_lines(text: str, kinds: set[str], roles: list[str]) -> str:
    """Markdown and wiki marks of a text, line by line; ``roles`` tells headings from lists."""
    lines, out, fenced, number, front = text.split("\n"), [], False, 0, text.startswith("---\n")
    for k, line in enumerate(lines):
        role, s = roles[k], line.strip()
        if "markdown" in kinds and s.startswith("```"):
            fenced = not fenced
            continue
        if fenced:
            out.append("    " + line)
            continue
        if "wiki" in kinds and line.startswith(" ") and role == "code":
            out.append("    " + line[1:])
            continue
        numbered = False
        if "markdown" in kinds:
            if front and s == "---":
                front = k == 0
                continue
            if re.fullmatch(r"={3,}|-{3,}", s) and out and out[-1].strip():
                out.append("")
                continue
            if re.fullmatch(r"\|?(?:\s*:?-{3,}:?\s*\|)+\s*:?-*:?\s*", s):
                continue
            if re.match(r"#{1,6} ", line) and role != "list":
                out += ["", _inline(line.lstrip("#").strip(" #"), kinds), ""]
                continue
            line = re.sub(r"^>\s?", "", line)
            if s.startswith("|") and s.endswith("|"):
                line = " | ".join(c.strip() for c in s.strip("|").split("|"))
        if "wiki" in kinds:
            if m := re.match(r"(={2,6})\s*(.+?)\s*\1\s*$", line):
                out += ["", _inline(m[2], kinds), ""]
                continue
            if re.match(r"\{\||\|\}|\|-", s):
                continue
            if s.startswith(("| ", "! ")) and re.search(r"\|\||!!", s):
                line = " | ".join(c.strip() for c in re.split(r"\|\||!!", s[1:]))
            elif m := re.match(r"#+ ", line):
                number, numbered = number + 1, True
                line = f"{number}. {line[m.end() :]}"
        if m := re.match(r"(\s*)[*+-]+ (?=\S)", line):
            line = f"{m[1]}- {line[m.end() :]}"
        number = number if numbered else 0
        out.append(_inline(line, kinds))
    return "\n".join(out)


def clean(text: str, kinds: set[str], roles: list[str]) -> str:
    """Clean text of one document, by the kinds of markup it holds and the roles of its lines."""
    if kinds & {"markdown", "wiki"}:
        text = from_lines(text, kinds, roles)
    if "html" in kinds:
        text = from_html(text) if re.search(r"<[!/a-zA-Z]", text) else html.unescape(text)
    if "latex" in kinds:
        text = from_latex(text)
    text = re.sub(r"(?<=\S)[ \t\xa0]{2,}(?=\S)", " ", re.sub(r"[ \t]+$", "", text, flags=re.M))
    return re.sub(r"\n{3,}", "\n\n", text).strip("\n")


def convert(df: DataFrame, text: str, weights: str = str(WEIGHTS)) -> DataFrame:
    """``df`` with ``markup array<string>`` and ``clean_text``.

    Texts without markup come out as they are, null as null. Columns of ``df`` that have the names of new
    columns are replaced.
    """
    with np.load(weights) as z:  # some 100 kB
        shared = df.sparkSession.sparkContext.broadcast({k: z[k] for k in z.files})

    @F.pandas_udf(T.StructType([T.StructField("markup", T.ArrayType(T.StringType())), T.StructField("clean_text", T.StringType())]))
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        labeller = Labeller(shared.value)
        for s in batches:
            values = s.tolist()
            out: list[tuple] = [([], None) for _ in values]
            live = [k for k, t in enumerate(values) if t]
            for k, (kinds, roles) in zip(live, labelled([values[k] for k in live], labeller), strict=True):
                if kinds:
                    out[k] = (sorted(kinds), clean(values[k], kinds, [ROLES[x] for x in roles]))
            yield pd.DataFrame(out, columns=["markup", "clean_text"])

    rest = [c for c in df.columns if c not in (text, "markup", "clean_text")]
    rows = df.select(*rest, F.col(text).alias("_t"), run(F.when(F.col(text).rlike(SIGNS), F.col(text))).alias("_r"))
    return rows.select(*rest, F.col("_r.markup").alias("markup"), F.coalesce("_r.clean_text", "_t").alias("clean_text"))

