"""SQL for the queries of this subpackage that SQL can express over whole tables."""

from __future__ import annotations

# Fixed values, spelled out here so that the comparison doesn't share the operator's tables: letters and what they look like.
_LETTERS = (
    "ıɑɡɩʋᴄᴏᴜᴠᴡᴢꜱͿΑΒΕΖΗΙΚΜΝΟΡΤΥΧαικνορυϲϳϹЅІЈАВЕКМНОРСТУХаекорсух"
    "ѕіјѵҮһӀӏԁԚԛԜԝԼՍՏՕզհյոսցօᎠᎡᎢᎥᎪᎫᎬᎳᎷᎻᏀᏃᏙᏚᏞᏟᏢᏦᏴⲎⲒⲔⲘⲚⲞⲟⲢⲣⲤⲥⲦⲬꓐꓑꓓꓔ"
    "ꓖꓗꓙꓚꓜꓝꓟꓠꓡꓢꓣꓦꓧꓪꓫꓬꓮꓰꓲꓳꓴ"
)
_LATIN = (
    "iagiucouvwzsJABEZHIKMNOPTYXaikvopucjCSIJABEKMHOPCTYXaekopcyx"
    "sijvYhIldQqWwLUSOqhjnugoDRTiAJEWMHGZVSLCPKBHIKMNOoPpCcTXBPDT"
    "GKJCZFMNLSRVHWXYAEIOU"
)
# Marks drawn alike, code points of white space, and ranges of characters that show nothing.
_MARKS = ("\u2010\u2011\u2024\u037e\u0387", "--.;\u00b7")
_SPACE_POINTS = (0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x1C, 0x1D, 0x1E, 0x1F, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
_NOTHING = "00-08 0E-1B 7F-84 86-9F AD-AD 34F-34F 61C-61C 115F-1160 17B4-17B5 180B-180F 200B-200F 202A-202E 2060-206F 3164-3164 FE00-FE0F FEFF-FEFF FFA0-FFA0 FFF0-FFF8 1BCA0-1BCA3 1D173-1D17A E0000-E0FFF"

_BLANK = r"[^\s\p{Z}]"
_WIDE = "".join(chr(c + 0xFEE0) for c in range(0x21, 0x7F)), "".join(chr(c) for c in range(0x21, 0x7F))


def _quoted(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _looks(text: str) -> str:
    """The visible form: ignorable characters removed, widths, look-alikes and spaces mapped, then composed."""
    gone = "[" + "".join("-".join(f"\\x{{{x}}}" for x in r.split("-")) for r in _NOTHING.split()) + "]"
    spaces = "".join(map(chr, _SPACE_POINTS))
    left, right = _WIDE[0] + _LETTERS + _MARKS[0] + spaces, _WIDE[1] + _LATIN + _MARKS[1] + " " * len(spaces)
    mapped = f"translate(regexp_replace({text}, '{gone}', '', 'g'), {_quoted(left)}, {_quoted(right)})"
    for ligature, letters in (("ﬀ", "ff"), ("ﬁ", "fi"), ("ﬂ", "fl"), ("ﬃ", "ffi"), ("ﬄ", "ffl"), ("ﬅ", "st"), ("ﬆ", "st")):
        mapped = f"replace({mapped}, '{ligature}', '{letters}')"
    return f"trim(regexp_replace(nfc_normalize({mapped}), ' +', ' ', 'g'))"


def _words(table: str, key: str, text: str) -> str:
    return f"SELECT {key}, unnest(ws) AS w, unnest(range(len(ws))) AS pos FROM (SELECT {key}, regexp_extract_all(translate(strip_accents(lower({_looks(text)})), 'ªº¹²³', 'ao123'), '[\\p{{L}}\\p{{N}}]+') AS ws FROM {table} WHERE {key} IS NOT NULL AND {text} IS NOT NULL)"


_REPEATED = f"""
t AS (SELECT id, any_value(text_content) AS x FROM extraction_records WHERE id IS NOT NULL AND regexp_matches(text_content, '{_BLANK}') GROUP BY id),
w AS (SELECT id, unnest(ws) AS w, unnest(range(len(ws))) AS pos FROM (SELECT id, regexp_extract_all(lower(x), '[\\p{{L}}\\p{{N}}]+') AS ws FROM t)),
g AS (SELECT id, pos, {" || ' ' || ".join(["w", *[f"lead(w, {k}) OVER o" for k in range(1, 8)]])} AS gram FROM w WINDOW o AS (PARTITION BY id ORDER BY pos)),
r AS (SELECT id, pos FROM (SELECT id, pos, row_number() OVER (PARTITION BY id, gram ORDER BY pos) AS rn FROM g WHERE gram IS NOT NULL) WHERE rn > 1),
c AS (SELECT id, count(DISTINCT p) AS m FROM (SELECT id, unnest(range(pos, pos + 8)) AS p FROM r) GROUP BY id),
n AS (SELECT t.id, count(w.pos) AS n FROM t LEFT JOIN w ON w.id = t.id GROUP BY t.id)
"""

_LEAKS = f"""d AS ({_words("documents", "doc_id", "text")}), i AS ({_words("eval_items", "item_id", "text")}),
size AS (SELECT item_id, least(20, count(*)) AS least, count(*) AS item_words FROM i GROUP BY item_id),
m AS (SELECT doc_id, item_id, d.pos - i.pos AS off, i.pos AS pos FROM d JOIN i ON i.w = d.w),
k AS (SELECT *, row_number() OVER (PARTITION BY doc_id, item_id, off ORDER BY pos) AS rn, count(*) OVER (PARTITION BY doc_id, item_id, off) AS hits FROM m),
live AS (SELECT k.*, least, item_words FROM k JOIN size s ON s.item_id = k.item_id WHERE hits >= 0.85 * least),
found AS (SELECT a.doc_id, a.item_id, max(b.pos - a.pos + 1) AS matched_words, any_value(a.item_words) AS item_words FROM live a JOIN live b ON a.doc_id = b.doc_id AND a.item_id = b.item_id AND a.off = b.off AND b.rn >= a.rn
  WHERE b.pos - a.pos + 1 >= a.least AND (b.pos - a.pos + 1) - (b.rn - a.rn + 1) <= 0.15 * (b.pos - a.pos + 1) GROUP BY a.doc_id, a.item_id),
whole AS (SELECT doc_id, ' ' || string_agg(w, ' ' ORDER BY pos) || ' ' AS words FROM d WHERE doc_id IN (SELECT doc_id FROM found) GROUP BY doc_id),
picked AS (SELECT item_id, coalesce(nullif(regexp_extract(text, '(^|\\s)' || regexp_escape(answer) || '\\)\\s*([^;.]+)', 2), ''), answer) AS answer FROM eval_items WHERE item_id IS NOT NULL AND answer <> ''),
right_words AS (SELECT item_id, ' ' || string_agg(w, ' ' ORDER BY pos) || ' ' AS words FROM ({_words("picked", "item_id", "answer")}) GROUP BY item_id)"""

SQL = {
    "p1_rebuilt": f"SELECT id, md5(any_value(text_content)) AS digest, true AS within_limit FROM extraction_records WHERE id IS NOT NULL AND length(text_content) > 4000 AND regexp_matches(text_content, '{_BLANK}') GROUP BY id",
    "p7_rebuilt": "SELECT doc_id, md5(coalesce(text, '')) AS digest, coalesce(text, '') = '' AS empty FROM documents",
    "p8_leaks": f"WITH {_LEAKS} SELECT f.doc_id, f.item_id, matched_words, item_words, coalesce(contains(w.words, r.words), false) AS has_answer FROM found f JOIN whole w ON w.doc_id = f.doc_id LEFT JOIN right_words r ON r.item_id = f.item_id",
    "p1_found": f"SELECT DISTINCT id FROM extraction_records WHERE id IS NOT NULL AND length(text_content) > 4000 AND regexp_matches(text_content, '{_BLANK}')",
    "p3_found": f"WITH {_REPEATED} SELECT n.id FROM n JOIN c ON c.id = n.id WHERE m >= 0.35 * n",
    "p3_share": f"WITH {_REPEATED} SELECT n.id, n AS n_words, coalesce(m, 0) AS n_repeated, CASE WHEN n > 0 THEN coalesce(m, 0) / n ELSE 0 END AS repeated_share FROM n LEFT JOIN c ON c.id = n.id",
    "p8_found": f"WITH {_LEAKS} SELECT doc_id, item_id FROM found",
    "p9_groups": f"""WITH f AS (SELECT doc_id, text, {_looks("text")} AS look FROM documents WHERE doc_id IS NOT NULL AND text IS NOT NULL),
g AS (SELECT look, min(doc_id) AS representative FROM f WHERE look <> '' GROUP BY look HAVING count(DISTINCT text) > 1)
SELECT doc_id, representative FROM f JOIN g ON g.look = f.look""",
    "p9_found": f"""WITH f AS (SELECT doc_id, text, {_looks("text")} AS look FROM documents WHERE doc_id IS NOT NULL AND text IS NOT NULL)
SELECT a.doc_id AS doc_id_a, b.doc_id AS doc_id_b FROM f a JOIN f b ON a.look = b.look AND a.doc_id < b.doc_id AND a.text <> b.text WHERE a.look <> ''""",
}
