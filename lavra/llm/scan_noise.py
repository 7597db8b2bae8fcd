"""Noise in text from scanned pages: misread words, hyphens at line ends, running headers, page numbers.

Words. A lexicon counts every word of the corpus. Each word has an anagram hash, the sum of one hash per
character, so that a confusion of characters ('rn' for 'm') changes it by a constant. Adding the constants of
the confusions that a word can have and joining on the hash finds, in SQL, the far more frequent words it may
be a misreading of; equal confusion classes confirm them and the most frequent one is the correction.

Hyphens. A word cut at a line end is joined if the joined form is at least as common as the hyphenated one.

Lines. Page numbers, lines with a page number behind a gap, and lines that recur inside a text at page edges
are edge lines; their openings, learnt from the whole corpus, betray headers that stand only once.

Texts are not shuffled: each one gives its evidence as short rows, which meet the lexicon in joins.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lavra.session import cut

_MARKS = "!|€@$+¢"
WORD = re.compile(rf"[\w{re.escape(_MARKS)}]+(?:-[\w{re.escape(_MARKS)}]+)*")
#: Words that touch no odd sign: pieces of text in a wrong encoding are no misread words.
#: Nor are keys in braces, and a '!' that ends a word is punctuation.
_APART = re.compile(rf"(?<![^\x00-\x7f])(?<![\w{re.escape(_MARKS)}{{-])(?>{WORD.pattern})(?<!!)(?![^\x00-\x7f])")
#: What optical recognition reads, and what was printed.
CONFUSIONS = (
    ("!", "i"), ("|", "l"), ("€", "e"), ("@", "a"), ("$", "s"), ("+", "t"), ("¢", "ç"), ("0", "o"), ("1", "l"), ("9", "g"), ("5", "s"), ("6", "b"), ("8", "b"),
    ("ä", "ã"), ("ë", "é"), ("ö", "õ"), ("c", "e"), ("c", "ç"), ("a", "ã"), ("i", "í"), ("l", "t"), ("rn", "m"), ("ii", "u"), ("li", "h"), ("vv", "w"), ("cl", "d"),
)
#: Characters that no word of the language holds inside; the other confusions are between letters.
CERTAIN = frozenset("!|€@$+¢015689äëö")
#: Such a sign or digit between letters, where only misreading puts it. The letters ä, ë and ö stand in names.
INSIDE = r"\p{L}[!|€@$+¢015689]+\p{L}"
HYPHENS = "-‐¬­"
CUT = re.compile(rf"([{HYPHENS}])(?<=[^\W\d_].)[ \t]*\n(?=[^\WA-ZÀ-Þ_{re.escape(_MARKS)}]|[{re.escape(_MARKS)}]\w)")
_HEAD, _INNER = re.compile(rf"[\w{re.escape(_MARKS)}]+"), re.compile(rf"[\w{re.escape(_MARKS)}]")
_P = r"[pP](?:[^\W\d_]|@|[^\x00-\x7f]{1,5})[gG9](?:[iI!1|l][nN][aA@]|\.)?"
#: Numbers marked as page numbers may have any length, numbers that stand alone at most four digits.
PAGE_NUMBER = re.compile(rf"[ \t]*(?:[-–—] ?\d+ ?[-–—]|{_P} *\d+(?: *(?:d[e€c]|/) *\d+)?|[fF][lL1|][sS]?\. *\d+|\[\d+/\d+\])[ \t]*")
BARE_NUMBER = re.compile(r"[ \t]*\d{1,4}[ \t]*")
NUMBERED_LINE = re.compile(r"(\S.*\S)[ \t]{3,}\d{1,4}[ \t]*")
_SENTENCE = re.compile(r"[.!?:;,][\"'”’»)]*\s*$")
_NOT_HEADER = re.compile(r"^\s*(?:[-*+#>|={}\\<&\[:!;`]|\d+[.;)])|[|;{}<>\\=]{2}|\\|</?\w|;\d|\bdef \b|\breturn\b|\bfrom \b", re.I)
EVIDENCE = T.ArrayType(T.StructType([T.StructField(n, T.StringType()) for n in ("kind", "item", "other")]))


def canonical(c: Column) -> Column:
    """Confusion class of a word: single signs that may be read for each other are one, then letters that may be
    read as two are written as those two."""
    c = F.translate(c, "!í1|+l€çc¢éë@ãä0õö$5968", "iitttteeeeeeaaaooossgbb")
    for one, two in (("m", "rn"), ("u", "ii"), ("h", "ti"), ("w", "vv"), ("d", "et")):
        c = F.replace(c, F.lit(one), F.lit(two))
    return c


def anagram_hash(c: Column) -> Column:
    """Sum of a 44-bit hash per character: the same for all orders of the same characters."""
    return F.aggregate(F.transform(F.split(c, ""), lambda ch: F.shiftright(F.xxhash64(ch), 20)), F.lit(0).cast("bigint"), lambda a, h: a + h)


def lexicon(df: DataFrame, text: str) -> DataFrame:
    """(word, n, d): lower-case words with a letter, counted over all rows (n) and over distinct texts (d), so a
    misread word is no more frequent for the copies of its page; counted per batch before the second shuffle."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            once, more = Counter(), Counter()
            for t, copies in zip(pdf["t"], pdf["copies"]):
                words = WORD.findall(t.lower())
                once.update(words)
                for w in words if copies > 1 else ():
                    more[w] += copies - 1
            yield pd.DataFrame([(w, d + more[w], d) for w, d in once.items() if not w.isdigit()], columns=["word", "n", "d"])

    texts = df.select(F.col(text).alias("t")).where("t <> ''").groupBy("t").agg(F.count("*").alias("copies"))
    counted = texts.mapInPandas(count, "word string, n bigint, d bigint").groupBy("word").agg(F.sum("n").alias("n"), F.sum("d").alias("d"))
    return counted.where(F.col("word").rlike(r"\p{L}"))


def corrections(words: DataFrame, ratio: int = 20, least_letters: int = 4, spread: float = 8.0, few: int = 4) -> DataFrame:
    """(word, target): misread words and the most frequent word they can be a misreading of.

    A target is at least ``ratio`` times as frequent as the word is in distinct texts. A word with a sign or digit
    between letters may have any frequency: its target only has to be known, that is, found ``ratio`` times.
    Words shorter than ``least_letters`` need a character that words don't hold. Up to two confusions per word are
    undone at a time.

    A form that stands far more often than misreading explains is a word of its own ('familias' in a Spanish
    text). How often a target is misread is learnt per confusion from the corpus (``misread_rates``); a form may
    be ``spread`` times as frequent as that, and ``few`` occurrences are always possible.
    """
    hits = cut(_candidates(words, ratio, least_letters))
    rates = misread_rates(hits.where("two = -1 and not inside"), ratio)
    likely = hits.join(F.broadcast(rates), "one", "left").where(F.col("inside") | (F.col("d") <= few + spread * F.col("m") * F.coalesce("rate", F.lit(1.0 / ratio))))
    return likely.groupBy("word").agg(F.max_by("target", F.struct("m", "target")).alias("target"))


def misread_rates(hits: DataFrame, ratio: int, least_pairs: int = 10) -> DataFrame:
    """(one, rate): the share of a word's occurrences that a confusion misreads, one row per confusion.

    It is the median of d / m over the confusion's pairs, weighted by the frequency m of the targets: a word of the
    language that looks like a misreading of another one is a single pair and moves a median little. Confusions
    with fewer than ``least_pairs`` pairs get the median of all. Shares are counted in steps of a fourth of a
    power of two, so the table is bounded by the number of confusions, whatever the size of the corpus.
    """
    step = F.floor(4 * F.log2(F.col("d") / F.col("m"))).alias("step")
    table = hits.groupBy("one", step).agg(F.sum("m").alias("mass"), F.count("*").alias("pairs"))
    both = table.select("one", "step", "mass", "pairs").unionByName(table.groupBy("step").agg(F.sum("mass").alias("mass"), F.sum("pairs").alias("pairs")).withColumn("one", F.lit(-1)))
    w = Window.partitionBy("one")
    summed = both.select("one", "step", F.sum("mass").over(w.orderBy("step")).alias("upto"), F.sum("mass").over(w).alias("mass"), F.sum("pairs").over(w).alias("pairs"))
    middle = summed.where(F.col("upto") >= 0.5 * F.col("mass")).groupBy("one").agg(F.min("step").alias("step"), F.max("pairs").alias("pairs"))
    rate = F.pow(F.lit(2.0), (F.col("step") + 1) / 4)
    pooled = middle.where("one = -1").select(rate.alias("pooled"))
    known = middle.where("one >= 0").select("one", "pairs", rate.alias("rate")).crossJoin(F.broadcast(pooled))  # one row
    return known.select("one", F.when(F.col("pairs") >= least_pairs, F.col("rate")).otherwise(F.col("pooled")).alias("rate"))


def _candidates(words: DataFrame, ratio: int, least_letters: int, few_targets: int = 300_000) -> DataFrame:
    """(word, d, target, m, one, two, inside): frequent words that one or two confusions (their numbers in
    ``CONFUSIONS``) turn into the word; ``inside`` if a sign or digit stands between its letters."""
    keyed = words.select("word", "n", "d", F.col("h") if "h" in words.columns else anagram_hash(F.col("word")).alias("h"))
    word = F.col("word")
    could = [
        F.when(
            word.contains(noisy),
            F.struct(
                F.lit(k).alias("k"),
                (anagram_hash(F.lit(true)) - anagram_hash(F.lit(noisy))).alias("delta"),
                F.lit(bool(CERTAIN & set(noisy))).alias("certain"),
                ((F.char_length("word") - F.char_length(F.replace(word, F.lit(noisy), F.lit("")))) >= 2 * len(noisy)).alias("twice"),
            ),
        )
        for k, (noisy, true) in enumerate(CONFUSIONS)
    ]
    first = keyed.select("word", "d", "h", F.array_compact(F.array(*could)).alias("_all")).select("*", F.explode("_all").alias("_a"))
    # One confusion, or two of which one is certain or which are the same.
    none = F.struct(F.lit(-1).alias("k"), F.lit(0).cast("bigint").alias("delta"), F.lit(False).alias("certain"), F.lit(False).alias("twice"))
    partners = F.filter("_all", lambda b: (b["k"] > F.col("_a.k")) & (b["certain"] | F.col("_a.certain")) | (b["k"] == F.col("_a.k")) & b["twice"])
    both = first.select("word", "d", "h", "_a", F.explode(F.concat(F.array(none), partners)).alias("_b"))
    enough = (F.char_length("word") >= F.when(F.col("_a.certain") | F.col("_b.certain"), 2).otherwise(least_letters))
    guesses = both.where(enough).select("word", "d", F.col("_a.k").alias("one"), F.col("_b.k").alias("two"), (F.col("h") + F.col("_a.delta") + F.col("_b.delta")).alias("h"))
    good = keyed.where((F.col("n") >= ratio) & ~F.col("word").rlike(r"[0-9!|€@$+¢]")).select(F.col("word").alias("target"), F.col("n").alias("m"), "h")
    inside = word.rlike(INSIDE)
    # Each word has many guesses; while the targets are few they go to the guesses, beyond that both are shuffled.
    good = F.broadcast(good) if good.count() <= few_targets else good
    hits = guesses.join(good, "h").where(((F.col("m") >= ratio * F.col("d")) | inside) & (F.col("word") != F.col("target")) & (canonical(F.col("word")) == canonical(F.col("target"))))
    return hits.select("word", "d", "target", "m", "one", "two", inside.alias("inside"))


def plain_line(line: str) -> str:
    """A line as headers are compared: lower case, digits and gaps as one sign each, confusable signs merged."""
    line = re.sub(r"[ \t]{3,}\d{1,4}[ \t]*$", "", line.strip().lower())
    line = re.sub(r"\d+(?:[/.]\d+)*", "#", re.sub(r"(?<=[^\W\d_])[01](?=[^\W\d_])|(?<=[^\W\d_])0\b", "o", line))
    return " ".join(line.split())


def opening(line: str) -> str:
    """The first two words of a header, which don't change with the place or person it names."""
    return " ".join(plain_line(line).split()[:2])


def edge_lines(text: str) -> tuple[set[int], set[int], list[int]]:
    """Line numbers of page numbers, of certain headers, and of lines that are headers if their opening is one.

    A header is certain if a page number follows it behind a gap, or if it recurs and stands beside a page
    number or page break. Other recurring lines that interrupt a paragraph, and lines at page edges, may be.
    """
    lines = text.split("\n")
    numbers, headers, maybe, seen = set(), set(), [], {}
    bare = [bool(BARE_NUMBER.fullmatch(x.strip("\f\r"))) for x in lines]
    for k, raw in enumerate(lines):
        line = raw.strip("\f\r")
        if not line.strip():
            continue
        if PAGE_NUMBER.fullmatch(line):
            numbers.add(k)
        elif bare[k]:
            if not (k and bare[k - 1]) and not (k + 1 < len(lines) and bare[k + 1]):
                numbers.add(k)
        elif not _SENTENCE.search(line) and not _NOT_HEADER.search(line) and any(c.isalpha() for c in line):
            if NUMBERED_LINE.fullmatch(line):
                headers.add(k)
            if len(line) >= 10 and len(line.split()) > 1:
                seen.setdefault(plain_line(line), []).append(k)
    beside = {k + d for k in numbers for d in (-1, 1)} | {k + d for k, x in enumerate(lines) if "\f" in x for d in (0, 1)}
    filled = [bool(x.strip()) for x in lines] + [False]
    for same in seen.values():
        recurs = len(same) > 1 and all(b - a > 2 for a, b in zip(same, same[1:]))
        if recurs and any(k in beside or k in headers for k in same):
            headers.update(same)
        else:
            maybe += [k for k in same if k not in headers and (k == 0 or k in beside or recurs and (filled[k - 1] or filled[k + 1]))]
    return numbers, headers, maybe


def cut_places(text: str) -> list[tuple[int, int, str, str, str]]:
    """(start, end, sign, before, after) of the line ends that cut a word; before and after are its halves."""
    out = []
    for m in CUT.finditer(text):
        start, after = m.start(), _HEAD.match(text, m.end())
        while start and _INNER.match(text, start - 1):
            start -= 1
        if start < m.start() and after and any(c.isalpha() for c in after[0]):
            out.append((m.start(), m.end(), m[1], text[start : m.start()], after[0]))
    return out


def evidence(text: str, known: frozenset[str]) -> list[tuple[str, str, str | None]]:
    """What in a text may be noise: (kind, item, other).

    line: an edge line (its opening, its line); maybe: a line at a page edge (its opening, its line); hyphen: a
    word cut by a sign that only marks cuts; cut: a word cut by a plain hyphen (joined, hyphenated); word: a
    word outside ``known``.
    """
    out = []
    if "\n" in text:
        lines = text.split("\n")
        numbers, headers, maybe = edge_lines(text)
        if numbers:
            out.append(("number", "", None))
        out += {("line", opening(lines[k]), None) for k in headers}
        out += {("maybe", opening(lines[k]), None) for k in maybe}
        for _, _, sign, a, b in cut_places(text):
            out.append(("hyphen", "", None) if sign != "-" else ("cut", (a + b).lower(), f"{a}-{b}".lower()))
    out += [("word", w, None) for w in set(_APART.findall(text.lower())) if w not in known and not w.isdigit()]
    return out


def _evidence(shared):
    @F.pandas_udf(EVIDENCE)
    def gather(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        known = shared.value
        for s in batches:
            yield pd.Series([[{"kind": k, "item": i, "other": o} for k, i, o in evidence(t, known)] if t else [] for t in s], dtype=object)

    return gather


class Noise:
    """Evidence of a corpus: ``rows`` (key, kind, item, other), ``fixes`` (word, target), ``words`` (word, n)."""

    def __init__(self, df: DataFrame, key: str, text: str, ratio: int = 20, known_share: float = 5e-6):
        spark = df.sparkSession
        self.key = key
        self.words = cut(lexicon(df, text).withColumn("h", anagram_hash(F.col("word"))))
        self.fixes = cut(corrections(self.words, ratio))
        # Common words without a correction are skipped where they stand. This only saves rows: a word without a
        # correction is no evidence, so the share changes no result. There are at most 1 / known_share of them.
        total = self.words.agg(F.sum("n")).first()[0] or 0
        common = self.words.where(F.col("n") >= max(1.0, total * known_share)).join(self.fixes, "word", "left_anti").select("word")
        shared = spark.sparkContext.broadcast(frozenset(r.word for r in common.collect()))
        self.rows = cut(df.select(key, F.explode(_evidence(shared)(F.col(text))).alias("_e")).select(key, "_e.*").distinct())

    def misread(self) -> DataFrame:
        """(key, word, target): misread words of the texts."""
        w = self.rows.where("kind = 'word'").select(self.key, F.col("item").alias("word"))
        return w.join(self.fixes, "word").select(self.key, "word", "target")

    def cut_words(self) -> DataFrame:
        """(key, joined): words cut by a plain hyphen, where the joined form is no rarer than the hyphenated one."""
        c = self.rows.where("kind = 'cut'").select(self.key, F.col("item").alias("joined"), "other")
        j = self.words.select(F.col("word").alias("joined"), F.col("n").alias("n_joined"))
        h = self.words.select(F.col("word").alias("other"), F.col("n").alias("n_other"))
        found = c.join(j, "joined", "left").join(h, "other", "left")
        return found.where(F.coalesce("n_joined", F.lit(0)) >= F.coalesce("n_other", F.lit(0))).select(self.key, "joined")

    def header_openings(self, least: int = 3) -> DataFrame:
        """(item): openings of the edge lines of at least ``least`` texts."""
        return self.rows.where("kind = 'line' and item <> ''").groupBy("item").agg(F.count("*").alias("n")).where(F.col("n") >= least).select("item")

    def lone_headers(self) -> DataFrame:
        """(key, item): headers that stand once in a text, known by their opening."""
        return self.rows.where("kind = 'maybe'").select(self.key, "item").join(self.header_openings(), "item", "left_semi")

    def found(self) -> DataFrame:
        """(key): texts with noise of any kind, each once."""
        plain = self.rows.where("kind in ('number', 'line', 'hyphen')").select(self.key)
        return plain.union(self.misread().select(self.key)).union(self.cut_words().select(self.key)).union(self.lone_headers().select(self.key)).distinct()


def paragraphs(text: str, fixes: dict[str, str], joined: set[str], openings: set[str]) -> str:
    """One text repaired: edge lines removed, cut words joined, misread words corrected, lines filled up."""
    numbers, headers, maybe = edge_lines(text)
    lines = text.split("\n")
    drop = numbers | headers | {k for k in maybe if opening(lines[k]) in openings}
    kept, broken_page = [], False
    for k, line in enumerate(lines):
        if k in drop or not line.strip("\f\r "):
            broken_page = broken_page or k in drop or "\f" in line
            if not broken_page:
                kept.append("")
        else:
            if broken_page and kept and _SENTENCE.search(kept[-1] or "."):
                kept.append("")  # a paragraph ended with the page
            kept.append(line.strip("\f\r"))
            broken_page = False

    body, at, out = "\n".join(kept), 0, []
    for start, end, sign, before, after in cut_places(body):
        whole = (before + after).lower()
        out.append(body[at:start] + ("" if sign != "-" or whole in joined or whole in fixes else sign))
        at = end
    body = "".join([*out, body[at:]])
    body = re.sub(r"(?<=[^\n])\n(?=[^\n])", " ", re.sub(r"\n{2,}", "\n\n", body)).strip()

    def correct(m: re.Match) -> str:
        target = fixes.get(m[0].lower())
        return m[0] if target is None else target.upper() if m[0].isupper() and len(m[0]) > 1 else target.capitalize() if m[0][0].isupper() else target

    return WORD.sub(correct, body)


def repair(df: DataFrame, key: str, text: str, ratio: int = 20) -> DataFrame:
    """(key, repaired): the texts with noise, one per key, as continuous paragraphs.

    Null and blank texts and texts without noise give no row. The evidence of a text is gathered per key, so a
    group is no larger than the text it comes from.
    """
    noise = Noise(df, key, text, ratio)
    fixes = noise.misread().groupBy(key).agg(F.map_from_entries(F.collect_set(F.struct("word", "target"))).alias("fixes"))
    joined = noise.cut_words().groupBy(key).agg(F.collect_set("joined").alias("joined"))
    heads = noise.lone_headers().groupBy(key).agg(F.collect_set("item").alias("heads"))
    noisy = df.select(key, text).join(noise.found(), key, "left_semi").dropDuplicates([key])
    rows = noisy.join(fixes, key, "left").join(joined, key, "left").join(heads, key, "left")

    @F.pandas_udf(T.StringType())
    def apply(t: pd.Series, f: pd.Series, j: pd.Series, h: pd.Series) -> pd.Series:
        as_set = lambda x: set() if x is None else set(x)
        return pd.Series([paragraphs(a, dict(b) if b is not None else {}, as_set(c), as_set(d)) for a, b, c, d in zip(t, f, j, h, strict=True)], dtype=object)

    return rows.select(key, apply(F.col(text), F.col("fixes"), F.col("joined"), F.col("heads")).alias("repaired"))
