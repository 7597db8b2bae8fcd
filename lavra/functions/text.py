"""Text functions as native column expressions, with Arrow UDFs where Spark has no equivalent. Null gives null."""

from __future__ import annotations

import json
import xml.etree.ElementTree as ET
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: White space as Python strips it.
WS = r"[\p{IsWhite_Space}\x1c-\x1f]"
_LINE_BREAK = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85\u2028\u2029]"
#: Entities decoded by the native form, '&amp;' last so that nothing is decoded twice.
ENTITIES = {"&copy;": "©", "&middot;": "·", "&ordm;": "º", "&ccedil;": "ç", "&atilde;": "ã", "&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&nbsp;": "\xa0", "&amp;": "&"}
#: Fixed value: how the public byte_bpe vocabularies split a text before their merges.
TOKEN_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_MARK = "\x01"


def strip(c: Column) -> Column:
    return F.regexp_replace(c, rf"(?s)^{WS}+|{WS}+$", "")


def utf8(content: Column) -> Column:
    """Bytes as text, malformed sequences replaced by U+FFFD."""
    return F.make_valid_utf8(content.cast("string"))


def word_count(c: Column) -> Column:
    """Number of maximal runs without white space."""
    return F.size(F.filter(F.split(c, f"{WS}+"), lambda w: w != ""))


def record_id(content: Column, relative_path: Column) -> Column:
    """SHA-256 of the bytes followed by the UTF-8 path: equal bytes at two paths are two records."""
    return F.sha2(F.concat(content, F.encode(relative_path, "UTF-8")), 256)


def one_line_base64(content: Column) -> Column:
    return F.regexp_replace(F.base64(content), r"[\r\n]", "")


def html_to_text(c: Column) -> Column:
    """Text of well-formed HTML without leaving the JVM: scripts, styles, comments and tags bound text nodes;
    every node is stripped, blank ones are dropped, the rest is joined by line feeds."""
    for pattern in (r"(?is)<script\b[^>]*>.*?</script\s*>", r"(?is)<style\b[^>]*>.*?</style\s*>", r"(?s)<!--.*?-->", r"(?s)<[!/?a-zA-Z][^>]*>"):
        c = F.regexp_replace(c, pattern, _MARK)
    for entity, char in ENTITIES.items():
        c = F.replace(c, F.lit(entity), F.lit(char))
    return F.array_join(F.filter(F.transform(F.split(c, _MARK), strip), lambda p: p != ""), "\n")


class _Text(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.nodes, self.skip, self.open = [], 0, []

    def handle_starttag(self, tag, attrs):
        if tag in ("script", "style"):
            self.skip += 1
        self._flush()

    def handle_endtag(self, tag):
        if tag in ("script", "style") and self.skip:
            self.skip -= 1
        self._flush()

    def handle_comment(self, data):
        self._flush()

    handle_decl = handle_pi = unknown_decl = handle_comment

    def handle_data(self, data):
        if not self.skip:
            self.open.append(data)

    def _flush(self):
        if text := "".join(self.open).strip():
            self.nodes.append(text)
        self.open = []


def parse_html(page: str) -> str:
    parser = _Text()
    parser.feed(page)
    parser.close()
    parser._flush()
    return "\n".join(parser.nodes)


@F.pandas_udf(T.StringType())
def html_to_text_any(s: pd.Series) -> pd.Series:
    """As ``html_to_text``, by a real parser, for malformed HTML and all entities."""
    return s.map(parse_html, na_action="ignore")


def _local(tag: str) -> str:
    return tag.rpartition("}")[2]


def _node(e: ET.Element):
    """Attributes, then children by local name (repeated names become a list), then text; a bare text stays a string."""
    out: dict = {"@attributes": dict(e.attrib)} if e.attrib else {}
    children: dict[str, list] = {}
    for child in e:
        children.setdefault(_local(child.tag), []).append(_node(child))
    out |= {name: nodes if len(nodes) > 1 else nodes[0] for name, nodes in children.items()}
    if text := (e.text or "").strip():
        if not out:
            return text
        out["#text"] = text
    return out


def parse_xml(document: str) -> str:
    root = ET.fromstring(document)
    return json.dumps({_local(root.tag): _node(root)}, ensure_ascii=False, indent=2)


@F.pandas_udf(T.StructType([T.StructField("content", T.StringType()), T.StructField("error", T.StringType())]))
def xml_to_json(s: pd.Series) -> pd.DataFrame:
    """JSON text of each XML document, or the parser's error; null for both where the document is null."""
    rows = []
    for document in s:
        try:
            rows.append((parse_xml(document) if document is not None else None, None))
        except ET.ParseError as e:
            rows.append((None, str(e)))
    return pd.DataFrame(rows, columns=["content", "error"])


def clean_ocr(c: Column) -> Column:
    """Model output as Markdown: no centre tags and grounding spans, no page headings, at most one blank line in
    a row, no white space at line ends and at both ends of the text."""
    for pattern, to in ((r"(?iu)</?center>", ""), (r"(?s)<\|ref\|>.*?<\|/ref\|>", ""), (r"(?s)<\|det\|>.*?<\|/det\|>", ""), (r"\n{3,}", "\n\n")):
        c = F.regexp_replace(c, pattern, to)
    lines = F.filter(F.split(c, _LINE_BREAK), lambda x: ~x.rlike(rf"(?iu)^{WS}*#{WS}*Página{WS}+\p{{Nd}}+{WS}*$"))
    return strip(F.array_join(F.transform(lines, lambda x: F.regexp_replace(x, rf"{WS}+$", "")), "\n"))


def flatten_parts(parts: Column) -> Column:
    """Joined texts of an array of content parts; parts without text count as empty."""
    return F.array_join(F.transform(parts, lambda p: F.coalesce(p["text"], F.lit(""))), "")


def token_counter(ranks_path: str, pattern: str):
    """Arrow UDF counting tokens by a rank file; the encoder is built once per worker. Null and empty count 0.

    The file is a setting, as counts differ by encoding. It is broadcast, so the executors need not see its path.
    """
    with open(ranks_path, "rb") as f:
        shared = SparkSession.active().sparkContext.broadcast(f.read())  # fixed by the public vocabulary, below 2 MB

    @F.pandas_udf(T.IntegerType())
    def count(blocks: Iterator[pd.Series]) -> Iterator[pd.Series]:
        import base64

        import tiktoken

        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, shared.value.splitlines())}
        encoding = tiktoken.Encoding("counter", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        for s in blocks:
            yield pd.Series([len(encoding.encode_ordinary(t)) if t else 0 for t in s], dtype="int32")

    return count

