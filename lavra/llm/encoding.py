"""Text decoded with the wrong character encoding: detection and restoration.

Every swap of two code pages is a substitution cipher: each letter of the language is written as a fixed
string of odd characters. The observed data are the runs of non-ASCII characters with their neighbours, as
corpus-wide counts. Two things are learnt from them, both by expectation-maximisation against the bigrams of
the language:

*The language and the swaps whose code pages are known.* The cipher behind a run is hidden. E: how likely each
cipher (or none) wrote a run, from the letter bigrams around the deciphered letters and from how common the
ciphers are. M: the bigrams of undamaged text, the share of damaged runs, and the share of each cipher. The
bigrams start from the runs made of the commonest letters only, less those that a cipher deciphers into letters
commoner between the same neighbours: a source damaged in one way may hold any share of the rows below one half.
After that no run is certain, each is weighed again.

*The mapping of unknown swaps, per source.* Runs with characters that stand in few sources (folders, say) and
that no known page explains are pooled by source. Their signs, or pairs of signs where a letter is written in two bytes, are
units whose letters are hidden. E: the letters of each run, by forward and backward sums over the bigrams. M:
the table from unit to letter. Known code pages are starting points of the table only. A table is used if what it
deciphers reads about as well as undamaged text; it is applied with ``str.translate``.

A value (one text or path) decides how its own passages are deciphered: the ciphers' shares are estimated again
within it, so passages that are damaged in one way support each other.

All statistics are counts over all values. The driver holds the bigram table alone, whose size is bounded by
the square of the fixed alphabet of the code pages; the tables of the sources stay distributed.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lavra.session import cut

RUN = re.compile(r"(?s)(.?)([^\x00-\x7f]+)(?=(.?))")
LOST = "�"
#: Code pages that texts of Western offices were written in, and that they were read in by mistake.
WRITTEN = ("cp1252", "cp850", "cp437", "mac_roman")
READ = ("cp1252", "latin-1", "cp850", "cp437", "mac_roman", "cp1250", "iso8859-2")
#: Signs that scanning reads for letters; in text they are weaker evidence of a wrong encoding.
MISREAD = str.maketrans({"ä": "ã", "ë": "é", "ö": "õ", "¢": "ç"})
SMOOTH, SYMBOLS = 0.05, 300
#: Share of damage among signs that nobody writes beside a letter, ten times that of other signs.
UNLIKELY = 0.1
RESULT = T.StructType(
    [T.StructField("damaged", T.BooleanType()), T.StructField("cipher", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("restored", T.StringType()), T.StructField("unresolved", T.IntegerType())]
)


def _page(codec: str) -> dict[int, str]:
    """Characters of the upper half; undefined bytes stand for themselves."""
    out = {}
    for b in range(128, 256):
        try:
            out[b] = bytes([b]).decode(codec)
        except UnicodeDecodeError:
            out[b] = chr(b)
    return out


PAGES = {c: _page(c) for c in sorted({*WRITTEN, *READ})}
BYTES = {c: {ch: b for b, ch in page.items()} for c, page in PAGES.items()}
ALPHABET = {ch for page in PAGES.values() for ch in page.values()} | {chr(k) for k in range(32, 127)} | {LOST, "^"}


def _with_invisible_half(read: str) -> list[str]:
    """Letters of two bytes in UTF-8, first C3, whose second byte shows as nothing or as a space in a code page."""
    return [bytes([0xC3, b]).decode("utf-8") for b in range(0x80, 0xC0) if unicodedata.category(PAGES[read][b]) in ("Cf", "Cc", "Zs")]


@dataclass(frozen=True)
class Cipher:
    """Text of the encoding ``written`` read in the code page ``read``, ``times`` times over."""

    written: str
    read: str
    times: int = 1

    @property
    def name(self) -> str:
        return f"{self.written} read as {self.read}" + (f", {self.times} times" if self.times > 1 else "")

    def decipher(self, run: str) -> str | None:
        """The run as it was written, None if the cipher cannot have produced it."""
        s = run
        for _ in range(self.times):
            codes = BYTES[self.read]
            try:
                raw = bytes(codes[ch] for ch in s)
            except KeyError:
                return None
            s = _from_utf8(raw, s) if self.written == "utf-8" else "".join(PAGES[self.written][b] for b in raw)
            if s is None:
                return None
        return s if s != run else None


def _from_utf8(raw: bytes, as_read: str) -> str | None:
    """Decoded bytes; stray bytes stay as they were read, None if no sequence is valid."""
    try:
        return raw.decode("utf-8")
    except UnicodeDecodeError:
        pass
    out, k, valid = [], 0, False
    while k < len(raw):
        for n in (2, 3, 4):
            try:
                out.append(raw[k : k + n].decode("utf-8"))
            except UnicodeDecodeError:
                continue
            k, valid = k + n, True
            break
        else:
            out.append(as_read[k])
            k += 1
    return "".join(out) if valid else None


CIPHERS = tuple(
    [Cipher("utf-8", r) for r in READ]
    + [Cipher("utf-8", r, 2) for r in ("cp1252", "latin-1")]
    + [Cipher(w, r) for w in WRITTEN for r in READ if w != r and r != "iso8859-2" and {w, r} != {"cp1252", "latin-1"}]
)


def fold(ch: str) -> str:
    """Neighbour classes: no neighbour, digits and white space are one symbol each."""
    if ch == "":
        return "^"
    if ch <= "\x7f":
        return "0" if ch.isdigit() else " " if ch.isspace() else ch
    return ch


def _unwritten(left: str, run: str, right: str) -> bool:
    """A control character or a piece of a box beside a letter."""
    return (left.isalpha() or right.isalpha()) and any("\x80" <= ch <= "\x9f" or "\u2500" <= ch <= "\u259f" for ch in run)


def _known(ch: str) -> str:
    """Characters outside the code pages share one symbol in the bigram table."""
    return ch if ch in ALPHABET else "￿"


@dataclass
class Model:
    """Bigrams of undamaged text around non-ASCII runs, letters, the shares of the ciphers, and how well a sign of
    undamaged text usually fits (``usual``, mean log-likelihood); ``foreign`` are the characters that stand in few sources."""

    bigrams: dict[str, float]
    letters: tuple[str, ...]
    shares: tuple[float, ...] = tuple(1 / len(CIPHERS) for _ in CIPHERS)
    damaged: float = 0.01
    usual: float = 0.0
    foreign: frozenset[str] = frozenset()
    _single: dict[str, float] = field(default_factory=dict, repr=False)
    _memo: dict = field(default_factory=dict, repr=False)
    _weighed: dict = field(default_factory=dict, repr=False)

    def __post_init__(self):
        single: Counter = Counter()
        for pair, n in self.bigrams.items():
            single[pair[0]] += n
        self._single = dict(single)

    def fit(self, left: str, run: str, right: str) -> float:
        """Log-likelihood of the run between its neighbours, up to a term of the left neighbour."""
        seq = "".join(map(_known, left + run + right))
        big, single = self.bigrams, self._single
        out = math.log(big.get(seq[:2], 0.0) + SMOOTH)
        for k in range(1, len(seq) - 1):
            out += math.log((big.get(seq[k : k + 2], 0.0) + SMOOTH) / (single.get(seq[k], 0.0) + SMOOTH * SYMBOLS))
        return out

    def lost(self, left: str, run: str, right: str) -> str:
        """The run with each U+FFFD replaced by the letter that its neighbours make likeliest."""
        out = list(run)
        for k, ch in enumerate(run):
            if ch == LOST:
                before = out[k - 1] if k else left
                after = (run[k + 1] if k + 1 < len(run) else right).replace(LOST, "")
                out[k] = max(self.letters, key=lambda x: (self.fit(before, x, after) if after else math.log(self.bigrams.get(before + x, 0.0) + SMOOTH), x))
        return "".join(out)

    def halved(self, cipher: Cipher, left: str, run: str, right: str) -> str:
        """The run with each first half of a two-byte letter, whose invisible second half was dropped, replaced by the
        letter that its neighbours make likeliest; what fits as it is stays."""
        if cipher.written != "utf-8":
            return run
        out, lead, letters = list(run), PAGES[cipher.read][0xC3], _with_invisible_half(cipher.read)
        for k, ch in enumerate(run):
            if ch == lead and letters:
                before, after = out[k - 1] if k else left, run[k + 1] if k + 1 < len(run) else right
                best = max(letters, key=lambda x: (self.fit(before, x, after), x))
                if self.fit(before, best, after) > self.fit(before, ch, after) + 3:
                    out[k] = best
        return "".join(out)

    def gains(self, left: str, run: str, right: str) -> dict[int, tuple[float, str]]:
        """For each cipher that may have written the run: log-likelihood gained over the run as it is, and the letters."""
        got = self._memo.get((left, run, right))
        if got is None:
            base = self.fit(left, run, right)
            got = {}
            for k, c in enumerate(CIPHERS):
                plain = _deciphered(k, run)
                if plain is not None:
                    got[k] = (self.fit(left, plain, right) - base, plain)
            self._memo[left, run, right] = got
        return got

    def weigh(self, left: str, run: str, right: str, scanned: bool = True) -> tuple[float, int | None, list[tuple[int, float]]]:
        """Log-odds of the likeliest cipher behind a run, that cipher, and what the run gains by each. In
        scanned text a sign that is read for a letter counts only as far as that reading explains it worse."""
        key = (left, run, right, scanned)
        got = self._weighed.get(key)
        if got is None:
            misread = run.translate(MISREAD) if scanned else run
            slip = max(0.0, self.fit(left, misread, right) - self.fit(left, run, right)) if misread != run else 0.0
            each = [(k, gain - slip) for k, (gain, _) in self.gains(left, run, right).items()]
            damaged = UNLIKELY if _unwritten(left, run, right) else Model.damaged
            top, best = max(((gain + self.prior(k, damaged), k) for k, gain in each), default=(-math.inf, None))
            got = self._weighed[key] = (top, best, each)
        return got

    def odd(self, left: str, run: str, right: str) -> bool:
        """With a character that stands in few sources, and not explained by a known cipher."""
        return not self.foreign.isdisjoint(run) and LOST not in run and self.weigh(left, run, right)[0] <= 0

    def prior(self, k: int, damaged: float = 0.01) -> float:
        """Of a single run; a value is judged by the default, as most values of a much damaged corpus may be clean."""
        return math.log(damaged * self.shares[k] + 1e-12)


_PLAIN: dict[tuple[int, str], str | None] = {}


def _deciphered(k: int, run: str) -> str | None:
    key = (k, run)
    if key not in _PLAIN:
        if len(_PLAIN) > 200_000:
            _PLAIN.clear()
        _PLAIN[key] = CIPHERS[k].decipher(run)
    return _PLAIN[key]


def runs(value: str) -> Counter:
    return Counter((fold(a), run, fold(b)) for a, run, b in RUN.findall(value))


def contexts(values: DataFrame, value: str, source: str | None = None) -> DataFrame:
    """(l, run, r, s, n): non-ASCII runs with their neighbours, counted over all values, where s is null; and with a
    source, the non-ASCII characters of each source s (in run). Counted per batch first."""
    origin = F.lit(None).cast("string") if source is None else F.coalesce(F.col(source).cast("string"), F.lit(""))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            total: Counter = Counter()
            chars: Counter = Counter()
            for v, s in zip(pdf["v"], pdf["s"], strict=True):
                if v and not v.isascii():
                    found = [(a, run, b) for a, run, b in RUN.findall(v)]
                    total.update(found)
                    if s is not None:
                        chars.update((s, ch) for ch in "".join(run for _, run, _ in found))
            folded: Counter = Counter()
            for (a, run, b), n in total.items():
                folded[fold(a), run, fold(b), None] += n
            for (s, ch), n in chars.items():
                folded["", ch, "", s] += n
            yield pd.DataFrame([(*k, n) for k, n in folded.items()], columns=["l", "run", "r", "s", "n"])

    rows = values.select(F.col(value).alias("v"), origin.alias("s")).mapInPandas(count, "l string, run string, r string, s string, n bigint")
    return rows.groupBy("l", "run", "r", "s").agg(F.sum("n").alias("n"))


def concentrated(table: DataFrame) -> set[str]:
    """The non-ASCII characters that stand in fewer than a fourth of the sources that their frequency lets expect.

    The letters of a language stand in all its sources; what a swap makes of them stands in the damaged ones only,
    however many rows these have. If a character has the share p of all, a source of n characters holds it with
    probability 1 - exp(-n p). Sources are summed up by powers of two of their size, so what comes to the driver
    is bounded by the number of characters there are.
    """
    by_source = table.where("s is not null").select("s", "run", "n")
    sizes = by_source.groupBy("s").agg(F.sum("n").alias("size"))
    steps = sizes.groupBy(F.floor(F.log2("size")).alias("_b")).agg(F.count("*").alias("sources"), F.avg("size").alias("size"))
    total = steps.agg(F.sum(F.col("sources") * F.col("size")).alias("total"))
    chars = by_source.groupBy("run").agg(F.count("*").alias("found"), F.sum("n").alias("n"))
    wide = chars.crossJoin(F.broadcast(total)).crossJoin(F.broadcast(steps))  # one row, and one row per power of two
    expected = wide.groupBy("run", "found").agg(F.sum(F.col("sources") * (1 - F.exp(-F.col("size") * F.col("n") / F.col("total")))).alias("expected"))
    return {r.run for r in expected.where("expected >= 3 and 4 * found < expected").select("run").collect()}


def _pairs(left: str, run: str, right: str) -> list[str]:
    seq = "".join(map(_known, left + run + right))
    return [seq[k : k + 2] for k in range(len(seq) - 1)]


def _seed(run: str, common: set[str]) -> bool:
    """Runs of the commonest letters that no multi-byte cipher explains."""
    return all(ch in common for ch in run) and not any(CIPHERS[k].written == "utf-8" and (p := _deciphered(k, run)) is not None and len(p) < len(run) for k in range(len(CIPHERS)))


def learn(values: DataFrame, value: str, iterations: int = 3, common_share: float = 0.005, source: str | None = None) -> Model:
    """The model of a corpus, by expectation-maximisation over its context counts. With a ``source`` column,
    characters that stand in few sources are no letters of the language.

    What comes to the driver are sums over an alphabet fixed by the code pages: character totals, bigram
    weights and cipher weights. An empty corpus gives a model without bigrams, which changes nothing.
    """
    counted = cut(contexts(values, value, source))
    table = counted.where("s is null").select("l", "run", "r", "n")
    chars = table.select(F.explode(F.split("run", "")).alias("ch"), "n").where(F.col("ch").isin(sorted(ALPHABET)))
    totals = {r.ch: r.n for r in chars.groupBy("ch").agg(F.sum("n").alias("n")).collect()}
    size = sum(totals.values())
    common = {ch for ch, n in totals.items() if n >= common_share * size and ch != LOST}
    foreign = frozenset(concentrated(counted) if source is not None else ())
    common -= foreign
    letters = tuple(sorted(common))
    model = None
    for step in range(-4, iterations):  # four passes of the start, as what a pass leaves out no longer vouches for the rest
        rows = table.mapInPandas(_expect(model, common, step < 0), "kind string, item string, weight double").groupBy("kind", "item").agg(F.sum("weight").alias("weight")).collect()
        bigrams = {r.item: r.weight for r in rows if r.kind == "bigram"}
        counts = {int(r.item): r.weight for r in rows if r.kind == "cipher"}
        total = sum(counts.values()) + 0.5 * len(CIPHERS)
        damaged = sum(counts.values()) / max(1.0, sum(r.weight for r in rows if r.kind == "runs"))
        fits = {r.kind: r.weight for r in rows if r.kind in ("fit", "kept")}
        usual = fits.get("fit", 0.0) / max(1e-9, fits.get("kept", 0.0))
        model = Model(bigrams, letters, tuple((counts.get(k, 0.0) + 0.5) / total for k in range(len(CIPHERS))), max(Model.damaged, damaged), usual, foreign)
    return model


def _expect(model: Model | None, common: set[str], start: bool):
    """E-step over a partition of the contexts. At the start only runs of common letters count: all of them without
    a model, then those that no cipher deciphers into letters commoner between the same neighbours."""

    def step(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            weights: Counter = Counter()
            for left, run, right, n in pdf.itertuples(index=False):
                if LOST in run:
                    continue
                weights["runs", ""] += n
                if start:
                    keep = float(_seed(run, common) and (model is None or all(g <= 0 for g, _ in model.gains(left, run, right).values())))
                else:
                    # Rare signs are weighed by the default: the share of the common letters would absorb them.
                    damaged = model.damaged if all(ch in common for ch in run) else Model.damaged
                    odds = {k: math.exp(min(50.0, g + model.prior(k, damaged))) for k, (g, _) in model.gains(left, run, right).items()}
                    z = 1.0 + sum(odds.values())
                    keep = 1.0 / z
                    for k, o in odds.items():
                        weights["cipher", str(k)] += n * o / z
                if model is not None:
                    weights["fit", ""] += n * keep * model.fit(left, run, right) / len(run)
                    weights["kept", ""] += n * keep
                if keep > 0.01:
                    for pair in _pairs(left, run, right):
                        weights["bigram", pair] += n * keep
            yield pd.DataFrame([(*k, w) for k, w in weights.items()], columns=["kind", "item", "weight"])

    return step


@dataclass(frozen=True)
class Learnt:
    """A substitution learnt for a source: the letter of each unit of ``width`` signs."""

    width: int
    letters: dict[str, str]

    def decipher(self, run: str) -> str | None:
        """The run with its known units as letters, None if it holds none."""
        if self.width == 1:
            out = run.translate({ord(u): x for u, x in self.letters.items()})
        else:
            out, k = "", 0
            while k < len(run):
                unit = run[k : k + self.width]
                out, k = (out + self.letters[unit], k + self.width) if unit in self.letters else (out + run[k], k + 1)
        return out if out != run else None


def learn_table(model: Model, rows: list[tuple[str, str, str, int]], width: int, rounds: int = 20) -> tuple[dict[str, str], float, int]:
    """(table, mean log-likelihood of a deciphered sign, signs deciphered) of the odd runs of one source.

    Expectation-maximisation over a table from units of ``width`` signs to letters of the language. A unit enters
    the result if one letter holds 0.7 of its weight and it was seen three times.
    """
    single = model._single
    size = sum(n for x, n in single.items() if x > "\x7f") or 1.0
    cut_up = [(left, [run[k : k + width] for k in range(0, len(run), width)], right, n) for left, run, right, n in rows if len(run) % width == 0]
    units = sorted({u for _, us, _, _ in cut_up for u in us})
    # Letters of the language; rarer ones only if they are not among the odd signs themselves.
    alphabet = sorted(x for x, n in single.items() if x > "\x7f" and x in ALPHABET and x != LOST and n >= 2e-4 * size and (x in model.letters or x not in units))
    if not alphabet or not units:
        return {}, -math.inf, 0
    at, big = {u: k for k, u in enumerate(units)}, model.bigrams
    share = np.array([single[x] for x in alphabet]) / size
    step = np.array([[(big.get(a + b, 0.0) + SMOOTH) / (single[a] + SMOOTH * SYMBOLS) for b in alphabet] for a in alphabet])
    known = np.ones((len(units), len(alphabet)))
    for k in range(len(CIPHERS)):
        for u in units:
            plain = _deciphered(k, u)
            if plain in alphabet:
                known[at[u], alphabet.index(plain)] += 1
    table = known * share
    table /= table.sum(axis=1, keepdims=True)
    enter = {c: np.array([big.get(c + x, 0.0) + SMOOTH for x in alphabet]) for c in {_known(left) for left, _, _, _ in cut_up}}
    leave = {c: np.array([(big.get(x + c, 0.0) + SMOOTH) / (single[x] + SMOOTH * SYMBOLS) for x in alphabet]) for c in {_known(r) for _, _, r, _ in cut_up}}
    for _ in range(rounds):
        counts = np.outer(np.ones(len(units)), share)
        for left, us, right, n in cut_up:
            rows_of = [at[u] for u in us]
            forward = [enter[_known(left)] * table[rows_of[0]]]
            for k in rows_of[1:]:
                forward.append((forward[-1] @ step) * table[k])
                forward[-1] /= forward[-1].sum()
            backward = leave[_known(right)]
            for pos in range(len(us) - 1, -1, -1):
                post = forward[pos] * backward
                counts[rows_of[pos]] += n * post / post.sum()
                backward = step @ (backward * table[rows_of[pos]])
                backward = backward / backward.sum()
        table = counts / counts.sum(axis=1, keepdims=True)
    seen = Counter()
    for _, us, _, n in cut_up:
        for u in us:
            seen[u] += n
    sure = {u: alphabet[int(table[at[u]].argmax())] for u in units if table[at[u]].max() >= 0.7 and seen[u] >= 3}
    fit = signs = 0
    for left, us, right, n in cut_up:
        if all(u in sure for u in us):
            fit += n * model.fit(left, "".join(sure[u] for u in us), right)
            signs += n * len(us)
    return sure, fit / signs if signs else -math.inf, signs


def learn_source(model: Model, rows: list[tuple[str, str, str, int]], least_units: int = 4, least_signs: int = 15, worse: float = 1.5) -> Learnt | None:
    """The substitution behind the odd runs of one source, None if there is no convincing one.

    It must turn at least ``least_units`` units into different letters, ``least_signs`` signs in all and half of
    the odd signs, and a deciphered sign may fit at most ``worse`` (log-likelihood) less than signs of undamaged text do.
    """
    best, covered = None, 0
    total = sum(n * len(run) for _, run, _, n in rows)
    for width in (1, 2):
        table, fit, signs = learn_table(model, rows, width)
        if len(set(table.values())) >= least_units and signs >= least_signs and 2 * signs * width >= total and fit >= model.usual - worse and signs * width > covered:
            best, covered = Learnt(width, table), signs * width
    return best


def learn_sources(values: DataFrame, value: str, source: str, model: Model) -> DataFrame:
    """(source, width, letters): learnt substitutions, for the sources that have one.

    Odd runs are counted per source before they are shuffled; what a task gets of a source are its different
    contexts, which the alphabet bounds, not its rows. Null sources are one source.
    """
    spark = values.sparkSession
    if not model.foreign:
        return spark.createDataFrame([], "source string, width int, letters map<string,string>")
    shared = spark.sparkContext.broadcast(_parts(model))  # bounded by the alphabet
    signs = "[" + "".join(f"\\x{{{ord(ch):X}}}" for ch in sorted(model.foreign)) + "]"

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        local = Model(*shared.value)
        for pdf in batches:
            total: Counter = Counter()
            for s, v in zip(pdf["s"], pdf["v"], strict=True):
                if v and not v.isascii():
                    total.update((s, *key) for key in runs(v).elements() if local.odd(*key))
            yield pd.DataFrame([(*k, n) for k, n in total.items()], columns=["s", "l", "run", "r", "n"])

    rows = values.select(F.col(source).alias("s"), F.col(value).alias("v")).where(F.col("v").rlike(signs))
    odd = rows.mapInPandas(count, "s string, l string, run string, r string, n bigint").groupBy("s", "l", "run", "r").agg(F.sum("n").alias("n"))

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        got = learn_source(Model(*shared.value), list(pdf[["l", "run", "r", "n"]].itertuples(index=False, name=None)))
        out = [] if got is None else [(pdf["s"].iloc[0], got.width, got.letters)]
        return pd.DataFrame(out, columns=["source", "width", "letters"])

    return cut(odd.groupBy("s").applyInPandas(solve, "source string, width int, letters map<string,string>"))


def diagnose(model: Model, value: str, learnt: Learnt | None = None, scanned: bool = True) -> tuple[bool, str | None, float, str, int]:
    """damaged, cipher, score (log-odds of the clearest passage), restored text, lost characters (guessed or left)."""
    seen = runs(value)
    has_lost = any(LOST in run for _, run, _ in seen)
    best, clearest = -math.inf, None
    for key in seen:
        top, k, _ = model.weigh(*key, scanned)
        if top > best:
            best, clearest = top, k
    solved = learnt is not None and any(_by_table(model, learnt, *key) for key in seen)
    if best <= 0 and not has_lost and not solved:
        return False, None, best if clearest is not None else 0.0, value, 0
    # Within the value: ciphers that its passages support become likely for its other passages too.
    evidence: Counter = Counter()
    for key, n in seen.items():
        for k, gain in model.weigh(*key, scanned)[2]:
            evidence[k] += (1 + math.log(n)) * max(gain, -3.0)  # repeats of a run are weaker evidence than new ones
    share = {}
    for k, e in evidence.items():
        share[k] = model.prior(k)
        if e + share[k] > 5:
            able = [(n, g[k][0]) for (left, run, right), n in seen.items() if k in (g := model.gains(left, run, right))]
            wrote = sum(n for n, gain in able if gain > math.log(2))
            share[k] = math.log(max(0.5, (wrote + 0.5) / (sum(n for n, _ in able) - wrote + 0.5)))
    unresolved = 0
    main = CIPHERS[max(share, key=share.get)] if share else None

    def one(m: re.Match) -> str:
        nonlocal unresolved
        left, run, right = fold(m[1]), m[2], fold(m[3])
        plain, top = run, 0.0
        likelier = math.log(UNLIKELY / Model.damaged) if _unwritten(left, run, right) else 0.0
        for k, (gain, letters) in model.gains(left, run, right).items():
            if gain + likelier + share[k] > top:
                plain, top = letters, gain + likelier + share[k]
        if plain == run and solved:
            plain = _by_table(model, learnt, left, run, right) or run
        if main is not None:
            plain = model.halved(main, left, plain, right)
        if LOST in plain:
            unresolved += plain.count(LOST)
            plain = model.lost(left, plain, right) if model.letters else plain
        return m[1] + plain

    cipher = CIPHERS[clearest].name if best > 0 else "learnt substitution" if solved else "characters lost in decoding"
    return True, cipher, best if best > 0 else 0.0, RUN.sub(one, value), unresolved


def _by_table(model: Model, learnt: Learnt, left: str, run: str, right: str) -> str | None:
    """The run by the table of its source, if it is odd and reads like undamaged text so."""
    if not model.odd(left, run, right):
        return None
    plain = learnt.decipher(run)
    return plain if plain is not None and model.fit(left, plain, right) / len(plain) > model.usual - 5 else None


def _parts(model: Model) -> tuple:
    return model.bigrams, model.letters, model.shares, model.damaged, model.usual, model.foreign


def repair(df: DataFrame, value: str, model: Model, source: str | None = None, tables: DataFrame | None = None, scanned: Column | None = None, few_tables: int = 20_000) -> DataFrame:
    """``df`` with damaged, cipher, score, restored and unresolved for the text column ``value``.

    ``restored`` is the value itself where it is not damaged, and null for null; lost characters (U+FFFD) are
    replaced by the letters their neighbours make likeliest, ``unresolved`` counts them, as a guess may be wrong.
    Columns of ``df`` that have the names of new columns are replaced. ``tables`` are the substitutions of
    ``learn_sources`` for the column ``source``. They are broadcast while they are at most ``few_tables``; beyond
    that the values with odd signs meet them in a join. ``scanned`` tells which values may come from scanned pages
    (all unless given): there 'ä' may be a misread 'ã'.
    """
    shared = df.sparkSession.sparkContext.broadcast(_parts(model))  # bounded by the alphabet

    @F.pandas_udf(RESULT)
    def check(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
        local = Model(*shared.value)
        for s, widths, letters, pages in batches:
            if len(local._memo) > 500_000:
                local._memo.clear()
                local._weighed.clear()
            rows = []
            for v, w, x, page in zip(s, widths, letters, pages, strict=True):
                rows.append((False, None, 0.0, v, 0) if not v or v.isascii() else diagnose(local, v, Learnt(int(w), dict(x)) if x is not None else None, bool(page)))
            yield pd.DataFrame(rows, columns=[f.name for f in RESULT])

    rest = [c for c in df.columns if c not in RESULT.names]
    rows = df.select(*rest, F.col(value).alias("_value"), F.coalesce(F.lit(True) if scanned is None else scanned, F.lit(True)).alias("_scanned"))
    n_tables = 0 if tables is None or source is None else tables.count()
    if n_tables:
        known = tables.select(F.col("source").alias("_source"), F.col("width").alias("_width"), F.col("letters").alias("_letters"))
        known = F.broadcast(known) if n_tables <= few_tables else known
        rows = rows.join(known, F.col(source).eqNullSafe(F.col("_source")), "left")
    else:
        rows = rows.select("*", F.lit(0).alias("_width"), F.lit(None).cast("map<string,string>").alias("_letters"))
    return rows.select(*rest, check("_value", "_width", "_letters", "_scanned").alias("_r")).select(*rest, "_r.*")


def fields_long(df: DataFrame, key: str, fields: list[str], source: Column | None = None) -> DataFrame:
    """(key, field_name, value): the non-null values of several text columns, one per row; with ``source`` if given."""
    parts = [F.struct(F.lit(f).alias("field_name"), F.col(f).alias("value")) for f in fields]
    extra = [] if source is None else [source.alias("source")]
    return df.where(F.col(key).isNotNull()).select(key, *extra, F.explode(F.array(*parts)).alias("_v")).select(key, "_v.*", *(["source"] if extra else [])).where("value is not null")
