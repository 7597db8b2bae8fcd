"""Markup residue in text: which kinds a text holds, and its conversion to clean text.

A text is a sequence of leaves (its lines). Each leaf becomes a vector of its tag path (the elements and
environments open around it), its hashed signs with their surroundings, its hashed words, its shape, and hints:
which kinds have a pattern that occurs in it (and that hints are given). A bidirectional LSTM in numpy reads the whole sequence and gives
every leaf the kinds of markup it holds (HTML, Markdown, wiki, LaTeX) and its role; what a sign means thus
depends on the rest of the document. The labeller alone decides: a text holds a kind if some leaf reaches the
kind's threshold, which is calibrated on documents apart from the training. No pattern confirms or vetoes.

Texts without any sign that all markup is made of (tested in the JVM) are not sent to Python. The weights are
trained by ``lavra.llm.markup_training``, on the marks that its generator has set.
"""

from __future__ import annotations

import html
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

KINDS = ("html", "markdown", "wiki", "latex")
ROLES = ("paragraph", "heading", "list", "table", "code", "formula", "skip")
N_SIGNS, N_WORDS, N_PATH, N_SHAPE, N_HINTS = 480, 32, 16, 14, len(KINDS) + 1
WIDTH = N_SIGNS + N_WORDS + N_PATH + N_SHAPE + N_HINTS
HIDDEN = 24
WEIGHTS = Path(__file__).with_name("markup_weights.npz")

#: The signs markup is made of. A text without any of them, but for the dollar of an amount, holds none.
SIGNS = r"[<>&*_\[`~#=\\{|]|''|(?<!R)\$|---"

_TAGS = "html|head|body|title|style|script|meta|link|p|div|span|h[1-6]|b|i|u|s|em|strong|small|big|font|center|a|ul|ol|li|dl|dt|dd|table|thead|tbody|tfoot|tr|td|th|caption|br|hr|img|code|pre|kbd|samp|blockquote|sup|sub|form|input|button|nav|header|footer|section|article|main|figure|figcaption|iframe|label|option|select"
_ELEMENT = re.compile(rf"<(/?)({_TAGS})(?:\s[^<>]*)?/?>", re.I)
_ENV = re.compile(r"\\(begin|end)\{([a-zA-Z]+\*?)\}")
_TOKEN = re.compile(r"\\[a-zA-Z]+\*?|[^\W\d_]+|\d+|_+|[^\w\s]")
_SIGN = re.compile(r"[<>&*_\[\]`~#=\\{}|$^]|''|---|^[ \t+-]")
_END = re.compile(r"[.!?;:][\"'”’)\]]*$")

# Patterns of single marks, one input of the labeller among others.
HINTS: dict[str, tuple[re.Pattern, ...]] = {
    "html": (re.compile(rf"</?(?:{_TAGS})(?:\s[^<>]*)?/?>", re.I), re.compile(r"<!DOCTYPE\b|<!--", re.I), re.compile(r"&(?:#\d{1,7}|#[xX][0-9a-fA-F]{1,6});")),
    "markdown": (
        re.compile(r"\*\*[^\s*](?:[^*\n]*[^\s*])?\*\*"),
        re.compile(r"(?<![\w_])__[^\s_](?:[^\n]*?[^\s_])?__(?![\w_])"),
        re.compile(r"(?<![\w*])\*[^\s*](?:[^*\n]*[^\s*])?\*(?![\w*])"),
        re.compile(r"(?<!\[)\[[^\[\]\n]*\]\((?:[^()\s]+)\)"),
        re.compile(r"^(?:```|~~~)|(?<!`)`[^`\n]+`(?!`)"),
        re.compile(r"^>\s?\S"),
        re.compile(r"^\|?(?:\s*:?-{3,}:?\s*\|)+\s*:?-*:?\s*$"),
        re.compile(r"~~\S[^~\n]*~~"),
    ),
    "wiki": (
        re.compile(r"^(={2,6})(?!=)[^=\n].*?(?<!=)\1\s*$"),
        re.compile(r"'''[^\s'](?:[^\n]*?[^\s'])?'''"),
        re.compile(r"(?<!')''[^\s'](?:[^'\n]*[^\s'])?''(?!')"),
        re.compile(r"\[\[[^\[\]\n]+\]\]"),
        re.compile(r"\{\{[^\s{}][^{}\n]*\}\}"),
        re.compile(r"^\{\|(?:\s|$)|^\|-\s*$|^\|\}"),
        re.compile(r"<(?:nowiki|ref|gallery|syntaxhighlight)\b", re.I),
    ),
    "latex": (
        re.compile(r"\\[a-zA-Z]+\*?(?:\[[^\]\n]*\])?\{"),
        re.compile(r"\\[~'^`\"=.](?:\{?\\?[a-zA-Z]\}?)"),
        re.compile(r"\\[(\[](?=[^\n]*\\|\s*$|[^\n]*[\^_=])"),
        re.compile(r"(?<![\\\w$])\$(?=[^$\n]*[\\^_{])[^\s$](?:[^$\n]*[^\s$])?\$(?!\d)"),
        re.compile(r"\\(?:item|hline|maketitle|alpha|beta|gamma|delta|Delta|sigma|mu|pi|leq|geq|times|cdot|infty|LaTeX|TeX|noindent|par|newline|centering)(?![a-zA-Z])"),
    ),
}
_NAMED = re.compile(r"&([a-zA-Z][a-zA-Z0-9]{1,8});")
_ATX = re.compile(r"^#{1,6} \S")
_RULE = re.compile(r"^(?:={3,}|-{3,})\s*$")


def _crc(s: str) -> int:
    return zlib.crc32(s.encode("utf-8", "surrogatepass"))


def _side(ch: str) -> str:
    return "^" if not ch else "s" if ch.isspace() else "0" if ch.isdigit() else "w" if ch.isalnum() else ch


@lru_cache(maxsize=200_000)
def _sign_slot(left: str, sign: str, right: str) -> tuple[int, int]:
    return _crc(f"{left}{sign}{right}") % N_SIGNS, _crc(sign) % N_SIGNS


@lru_cache(maxsize=200_000)
def _word_slot(word: str) -> int:
    return _crc(word) % N_WORDS


def leaves(text: str) -> np.ndarray:
    """Vectors of the lines of a text."""
    lines = text.split("\n")
    return leaves_of(lines, 0, len(lines), ((), False))[0]


def leaves_of(lines: list[str], start: int, stop: int, state: tuple[tuple[str, ...], bool]) -> tuple[np.ndarray, tuple[tuple[str, ...], bool]]:
    """Vectors of the lines from ``start`` to ``stop``, and what is open behind them; ``state`` is open before them.

    Lines without a sign of markup have their path and shape only.
    """
    out = np.zeros((stop - start, WIDTH), np.float32)
    path, fenced = list(state[0]), state[1]
    shape = N_SIGNS + N_WORDS + N_PATH
    for k in range(start, stop):
        line, row = lines[k], out[k - start]
        stripped = line.strip()
        if _SIGN.search(line):
            if stripped.startswith("```"):
                fenced = not fenced
            for m in _TOKEN.finditer(line):
                token = m[0]
                if token[0].isalpha():
                    row[N_SIGNS + _word_slot(token.lower())] += 0.2
                elif not token[0].isdigit():
                    a, b = m.start(), m.end()
                    full, bare = _sign_slot(_side(line[a - 1] if a else ""), token[:12], _side(line[b] if b < len(line) else ""))
                    row[full] += 1.0
                    row[bare] += 0.3
            for m in _ELEMENT.finditer(line) if "<" in line else ():
                name = m[2].lower()
                if not m[1] and not m[0].endswith("/>") and name not in ("br", "hr", "img", "meta", "link", "input"):
                    path.append(name)
                elif name in path:
                    del path[len(path) - 1 - path[::-1].index(name) :]
            for m in _ENV.finditer(line) if "\\" in line else ():
                if m[1] == "begin":
                    path.append("\\" + m[2])
                elif "\\" + m[2] in path:
                    del path[len(path) - 1 - path[::-1].index("\\" + m[2]) :]
            row[shape + N_SHAPE :] = [*(hint(kind, lines, k) for kind in KINDS), True]
        for name in path[-8:]:
            row[N_SIGNS + N_WORDS + _crc(name) % (N_PATH - 1)] += 0.5
        row[shape - 1] = fenced
        before, after = (lines[k - 1].strip() if k else ""), (lines[k + 1].strip() if k + 1 < len(lines) else "")
        head = stripped[:1]
        row[shape : shape + N_SHAPE] = (
            not stripped, not before, not after, k == 0, bool(_END.search(stripped)), len(stripped) < 60, len(stripped) > 120, head == "#", head in "*+-" and bool(head),
            bool(head) and before[:1] == head and not head.isalnum(), bool(head) and after[:1] == head and not head.isalnum(), line[:1] == " ", head.isupper(), head.isdigit(),
        )
    counts = out[:, : N_SIGNS + N_WORDS]  # a long line must not drown its single mark
    np.log1p(counts, out=counts)
    return out, (tuple(path), fenced)


class Labeller:
    """Bidirectional LSTM over the leaves of many texts at once; float32 numpy throughout."""

    def __init__(self, weights: dict[str, np.ndarray]):
        self.w = {k: np.asarray(v, np.float32) for k, v in weights.items()}

    @staticmethod
    @lru_cache(maxsize=1)
    def load(path: str) -> Labeller:
        with np.load(path) as z:
            return Labeller({k: z[k] for k in z.files})

    def _direction(self, pre: np.ndarray, recur: np.ndarray, alive: np.ndarray, state: tuple | None = None) -> tuple[np.ndarray, tuple]:
        """Outputs of one direction and its last state; ``state`` is the one it begins with."""
        n, steps, _ = pre.shape
        h, c = state or (np.zeros((n, HIDDEN), np.float32), np.zeros((n, HIDDEN), np.float32))
        out = np.zeros((n, steps, HIDDEN), np.float32)
        for t in range(steps):
            z = pre[:, t] + h @ recur
            gates = 1 / (1 + np.exp(-np.clip(z[:, : 3 * HIDDEN], -30, 30)))
            i, f, o = gates[:, :HIDDEN], gates[:, HIDDEN : 2 * HIDDEN], gates[:, 2 * HIDDEN :]
            c = (f * c + i * np.tanh(z[:, 3 * HIDDEN :])) * alive[:, t, None]
            h = o * np.tanh(c) * alive[:, t, None]
            out[:, t] = h
        return out, (h, c)

    def scores(self, docs: list[np.ndarray], cells: int = 40_000) -> list[tuple[np.ndarray, np.ndarray]]:
        """Per text: kind probabilities (leaves x kinds) and role scores (leaves x roles).

        Texts of similar length run together, at most about ``cells`` padded leaves at a time.
        """
        out: list = [None] * len(docs)
        order = sorted(range(len(docs)), key=lambda k: len(docs[k]))
        start = 0
        while start < len(order):
            stop = start + 1
            while stop < len(order) and (stop + 1 - start) * len(docs[order[stop]]) <= cells:
                stop += 1
            part = order[start:stop]
            steps = max(1, len(docs[part[-1]]))
            x, alive = np.zeros((len(part), steps, WIDTH), np.float32), np.zeros((len(part), steps), np.float32)
            for r, k in enumerate(part):
                x[r, : len(docs[k])], alive[r, : len(docs[k])] = docs[k], 1
            kinds, roles = self._forward(x, alive)
            for r, k in enumerate(part):
                out[k] = (kinds[r, : len(docs[k])], roles[r, : len(docs[k])])
            start = stop
        return out

    def _forward(self, x: np.ndarray, alive: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        w = self.w
        n, steps, _ = x.shape
        flat = x.reshape(-1, WIDTH)
        fw = self._direction((flat @ w["xf"] + w["bf"]).reshape(n, steps, -1), w["hf"], alive)[0]
        # Padding lies behind the text, so the backward run passes it with a zero state.
        bw = self._direction((flat @ w["xb"] + w["bb"]).reshape(n, steps, -1)[:, ::-1], w["hb"], alive[:, ::-1])[0][:, ::-1]
        return self._labels(np.concatenate([fw, bw], axis=2), x)

    def _labels(self, both: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        w = self.w
        y = both.reshape(-1, 2 * HIDDEN) @ w["ho"] + x.reshape(-1, WIDTH) @ w["xo"] + w["bo"]
        y = y.reshape(*x.shape[:2], -1)
        return 1 / (1 + np.exp(-np.clip(y[:, :, : len(KINDS)], -30, 30))), y[:, :, len(KINDS) :]

    def scores_long(self, lines: list[str], size: int = 20_000) -> tuple[np.ndarray, np.ndarray]:
        """Scores of one text of any length in parts of ``size`` lines, exactly as in one piece.

        The state of either direction and the open elements are carried from part to part, so only the vectors
        of one part are in memory; they are computed once per direction.
        """
        w, starts = self.w, range(0, len(lines), size)
        opened: list = [((), False)]
        forward, state = [], None
        for a in starts:
            x, after = leaves_of(lines, a, min(a + size, len(lines)), opened[-1])
            opened.append(after)
            out, state = self._direction((x @ w["xf"] + w["bf"])[None], w["hf"], np.ones((1, len(x)), np.float32), state)
            forward.append(out[0])
        parts, state = [], None
        for k, a in reversed(list(enumerate(starts))):
            x, _ = leaves_of(lines, a, min(a + size, len(lines)), opened[k])
            out, state = self._direction((x @ w["xb"] + w["bb"])[None, ::-1], w["hb"], np.ones((1, len(x)), np.float32), state)
            kinds, roles = self._labels(np.concatenate([forward[k][None], out[:, ::-1]], axis=2), x[None])
            parts.append((kinds[0], roles[0]))
        return np.concatenate([p for p, _ in reversed(parts)]), np.concatenate([r for _, r in reversed(parts)])


def hint(kind: str, lines: list[str], k: int) -> bool:
    """Whether a pattern of the kind occurs on line ``k``."""
    line = lines[k]
    if any(p.search(line) for p in HINTS[kind]):
        return True
    if kind == "html":
        return any(m[1] in html.entities.name2codepoint for m in _NAMED.finditer(line))
    if kind == "markdown":
        before, after = (lines[k - 1].strip() if k else ""), (lines[k + 1].strip() if k + 1 < len(lines) else "")
        if _ATX.match(line):  # a heading stands alone; numbered wiki lists are sentences, one below the other
            return not _ATX.match(before) and not _ATX.match(after) and not before.startswith("#") and not after.startswith("#") and not _END.search(line.strip())
        if _RULE.match(line) and k:
            front = lines[0].strip() == "---" and line.strip() == "---"
            return front or bool(before) and any(c.isalnum() for c in before) and not before.startswith(("|", "{"))
    return False


def labelled(texts: list[str], labeller: Labeller, leaves_at_once: int = 40_000, long: int = 20_000) -> Iterator[tuple[set[str], np.ndarray]]:
    """(kinds, role of every line) of each text; the vectors of some ten thousand leaves are in memory at a time."""
    a = 0
    while a < len(texts):
        n_lines = texts[a].count("\n") + 1
        if n_lines > long:
            scores, b = [labeller.scores_long(texts[a].split("\n"), long)], a + 1
        else:
            b, n = a, 0
            while b < len(texts) and (b == a or n + n_lines <= leaves_at_once) and n_lines <= long:
                n, b = n + n_lines, b + 1
                n_lines = texts[b].count("\n") + 1 if b < len(texts) else 0
            scores = labeller.scores([leaves(t) for t in texts[a:b]])
        for p, r in scores:
            yield {kind for kind, reached in zip(KINDS, (p >= labeller.w["least"]).any(axis=0), strict=True) if reached}, r.argmax(axis=1)
        a = b


def find(df: DataFrame, text: str, weights: str = str(WEIGHTS)) -> DataFrame:
    """``df`` without the text, with ``markup array<string>``: the kinds of markup each text holds, sorted.

    Null, blank and ordinary texts have the empty list. A column of ``df`` named markup is replaced.
    """
    with np.load(weights) as z:  # some 170 kB
        shared = df.sparkSession.sparkContext.broadcast({k: z[k] for k in z.files})

    @F.pandas_udf(T.ArrayType(T.StringType()))
    def label(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        labeller = Labeller(shared.value)
        for s in batches:
            values = s.tolist()
            live = [k for k, t in enumerate(values) if t]
            out: list[list[str]] = [[] for _ in values]
            for k, (kinds, _) in zip(live, labelled([values[k] for k in live], labeller), strict=True):
                out[k] = sorted(kinds)
            yield pd.Series(out, dtype=object)

    rest = [c for c in df.columns if c not in (text, "markup")]
    return df.select(*rest, label(F.when(F.col(text).rlike(SIGNS), F.col(text))).alias("markup"))
