"""One consistent form for visually identical text, and the groups of texts that look the same.

``normal`` is the form for comparisons: compatibility normalisation (composed), look-alike letters mapped to
the letters they look like, default-ignorable characters removed, white space mapped, full case folding.
``visible`` keeps everything a reader can see: letter case, accents, superscripts, ordinals and fractions
stay, only the characters that cannot be told apart by eye are mapped. Texts with one visible form look the
same. Forms are computed once per distinct value of a batch.
"""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lavra.session import cut

#: Letters of other scripts drawn like Latin ones, by script and in code point order.
LOOKALIKES = {
    # Latin
    "ı": "i", "ɑ": "a", "ɡ": "g", "ɩ": "i", "ʋ": "u", "ᴄ": "c", "ᴏ": "o", "ᴜ": "u", "ᴠ": "v", "ᴡ": "w", "ᴢ": "z", "ꜱ": "s",
    # Greek
    "Ϳ": "J", "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X",
    "α": "a", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "υ": "u", "ϲ": "c", "ϳ": "j", "Ϲ": "C",
    # Cyrillic
    "Ѕ": "S", "І": "I", "Ј": "J", "А": "A", "В": "B", "Е": "E", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T", "У": "Y", "Х": "X",
    "а": "a", "е": "e", "к": "k", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "ѕ": "s", "і": "i", "ј": "j",
    "ѵ": "v", "Ү": "Y", "һ": "h", "Ӏ": "I", "ӏ": "l", "ԁ": "d", "Ԛ": "Q", "ԛ": "q", "Ԝ": "W", "ԝ": "w",
    # Armenian
    "Լ": "L", "Ս": "U", "Տ": "S", "Օ": "O", "զ": "q", "հ": "h", "յ": "j", "ո": "n", "ս": "u", "ց": "g", "օ": "o",
    # Cherokee
    "Ꭰ": "D", "Ꭱ": "R", "Ꭲ": "T", "Ꭵ": "i", "Ꭺ": "A", "Ꭻ": "J", "Ꭼ": "E", "Ꮃ": "W", "Ꮇ": "M", "Ꮋ": "H", "Ꮐ": "G", "Ꮓ": "Z", "Ꮩ": "V", "Ꮪ": "S", "Ꮮ": "L", "Ꮯ": "C", "Ꮲ": "P", "Ꮶ": "K", "Ᏼ": "B",
    # Coptic
    "Ⲏ": "H", "Ⲓ": "I", "Ⲕ": "K", "Ⲙ": "M", "Ⲛ": "N", "Ⲟ": "O", "ⲟ": "o", "Ⲣ": "P", "ⲣ": "p", "Ⲥ": "C", "ⲥ": "c", "Ⲧ": "T", "Ⲭ": "X",
    # Lisu
    "ꓐ": "B", "ꓑ": "P", "ꓓ": "D", "ꓔ": "T", "ꓖ": "G", "ꓗ": "K", "ꓙ": "J", "ꓚ": "C", "ꓜ": "Z", "ꓝ": "F", "ꓟ": "M", "ꓠ": "N", "ꓡ": "L", "ꓢ": "S", "ꓣ": "R", "ꓦ": "V", "ꓧ": "H", "ꓪ": "W", "ꓫ": "X", "ꓬ": "Y", "ꓮ": "A", "ꓰ": "E", "ꓲ": "I", "ꓳ": "O", "ꓴ": "U",
}
#: White space of every width (no-break, figure, ideographic and so on).
SPACES = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x20\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
#: Punctuation drawn alike (hyphens, one-dot leader, Greek question mark and ano teleia).
MARKS = {"\u2010": "-", "\u2011": "-", "\u2024": ".", "\u037e": ";", "\u0387": "\u00b7"}
#: Ranges of default-ignorable code points (Unicode property Default_Ignorable_Code_Point).
IGNORABLE = (
    (0x00AD, 0x00AD), (0x034F, 0x034F), (0x061C, 0x061C), (0x115F, 0x1160), (0x17B4, 0x17B5), (0x180B, 0x180F), (0x200B, 0x200F), (0x202A, 0x202E),
    (0x2060, 0x206F), (0x3164, 0x3164), (0xFE00, 0xFE0F), (0xFEFF, 0xFEFF), (0xFFA0, 0xFFA0), (0xFFF0, 0xFFF8), (0x1BCA0, 0x1BCA3), (0x1D173, 0x1D17A), (0xE0000, 0xE0FFF),
)
#: Compatibility decompositions a reader cannot see: widths, ligatures and presentation forms.
INVISIBLE_KINDS = ("<wide>", "<narrow>", "<noBreak>", "<initial>", "<medial>", "<final>", "<isolated>")


def _plain_letter(ch: str, kind: str) -> bool:
    """Roman numerals, and mathematical letters and digits without weight or slant: they look like the letters they
    are made of. Bold, italic, script and double-struck letters are visibly different."""
    name = unicodedata.name(ch, "") if kind in ("<compat>", "<font>") else ""
    return name.startswith(("ROMAN NUMERAL", "SMALL ROMAN NUMERAL", "MATHEMATICAL MONOSPACE")) or name.startswith("MATHEMATICAL SANS-SERIF") and not ("BOLD" in name or "ITALIC" in name)


#: Characters that both forms leave as they are but for case: printable ASCII and the composed letters of Latin-1.
_SPECIAL = re.compile("[^ -~À-ÖØ-öø-ÿ]")


class _Table(dict):
    """Per-character mapping, filled as characters occur; at most one entry per code point."""

    def __init__(self, visible_only: bool):
        super().__init__()
        self.visible_only = visible_only

    def __missing__(self, ch: str) -> str:
        code = ord(ch)
        kind = unicodedata.decomposition(ch).partition(" ")[0]
        if any(a <= code <= b for a, b in IGNORABLE) or (unicodedata.category(ch) == "Cc" and ch not in SPACES):
            out = ""
        elif ch in SPACES:
            out = " "
        elif self.visible_only and not (kind in INVISIBLE_KINDS or 0xFB00 <= code <= 0xFB06 or kind and not kind.startswith("<") or _plain_letter(ch, kind)):
            out = ch
        else:
            out = unicodedata.normalize("NFKD", ch)
        out = "".join(LOOKALIKES.get(c, MARKS.get(c, c)) for c in out)
        self[ch] = out
        return out

    def apply(self, text: str) -> str:
        return _SPECIAL.sub(self._one, text)

    def _one(self, m: re.Match) -> str:
        return self[m[0]]


_VISIBLE, _NORMAL = _Table(True), _Table(False)


def visible_form(text: str) -> str:
    """What a reader sees; runs of white space count as one space, white space at the ends as none."""
    return " ".join(unicodedata.normalize("NFC", _VISIBLE.apply(text)).split())


def normal_form(text: str) -> str:
    """The form for comparisons: compatibility-composed, case-folded, without marks of encoding variants."""
    folded = unicodedata.normalize("NFKC", unicodedata.normalize("NFKC", _NORMAL.apply(text)).casefold())
    return " ".join(folded.split())


def _per_distinct(form):
    @F.pandas_udf(T.StringType())
    def apply(s: pd.Series) -> pd.Series:
        codes, values = pd.factorize(s)
        forms = [form(v) for v in values]
        return pd.Series([forms[k] if k >= 0 else None for k in codes], dtype=object)

    return apply


def normalise(c: Column) -> Column:
    """The normal form of a text column; null stays null, a text without visible characters becomes empty."""
    return _per_distinct(normal_form)(c)


def visible(c: Column) -> Column:
    """The visible form of a text column; null stays null, a text without visible characters becomes empty."""
    return _per_distinct(visible_form)(c)


def forms(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, same, look, raw): digests of the normal form, the visible form and the text itself.

    Rows with a null key or text, or without visible characters, are left out.
    """

    @F.pandas_udf("normal string, visible string")
    def both(s: pd.Series) -> pd.DataFrame:
        codes, values = pd.factorize(s)
        normal, seen = [normal_form(v) for v in values], [visible_form(v) for v in values]
        return pd.DataFrame({"normal": [normal[k] for k in codes], "visible": [seen[k] for k in codes]})

    rows = df.select(F.col(key), F.col(text).alias("_t")).where(F.col(key).isNotNull() & F.col("_t").isNotNull())
    rows = rows.select(key, both("_t").alias("_f"), F.md5("_t").alias("raw")).where(F.col("_f.visible") != "")
    return rows.select(key, F.md5("_f.normal").alias("same"), F.md5("_f.visible").alias("look"), "raw")


def groups(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, same, look, raw) of the texts that look like at least one different text.

    Candidates share the normal form; the exact check is the visible form. The count of different texts per
    group is partially aggregated before the shuffle, and only digests are shuffled.
    """
    rows = cut(forms(df, key, text))  # digests alone, read three times; the texts are normalised once
    several = rows.groupBy("same", "look").agg(F.min("raw").alias("lo"), F.max("raw").alias("hi")).where("lo <> hi").select("same", "look")
    return rows.join(several, ["same", "look"], "left_semi")


def membership(df: DataFrame, key: str, text: str) -> DataFrame:
    """(<key>, representative): every text that looks like a different one, with the smallest key of its group."""
    live = groups(df, key, text)
    first = live.groupBy("same", "look").agg(F.min(key).alias("representative"))
    return live.join(first, ["same", "look"]).select(key, "representative")


def pairs(df: DataFrame, key: str, text: str) -> DataFrame:
    """(<key>_a, <key>_b), a < b: all pairs of unequal texts that look the same.

    The result itself holds every unequal pair of a group, as its definition asks; exact copies are not paired
    with each other. The pairs are formed by an equi-join on the group's digest, whose skew Spark splits.
    """
    live = groups(df, key, text)
    a = live.select(F.col(key).alias(f"{key}_a"), "same", "look", F.col("raw").alias("raw_a"))
    b = live.select(F.col(key).alias(f"{key}_b"), "same", "look", F.col("raw").alias("raw_b"))
    return a.join(b, ["same", "look"]).where((F.col("raw_a") != F.col("raw_b")) & (F.col(f"{key}_a") < F.col(f"{key}_b"))).select(f"{key}_a", f"{key}_b")
