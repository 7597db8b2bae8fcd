"""Training of the block labeller on documents made by rule: ``python -m lavra.llm.markup_training``.

Documents are made of random words, set in one or two kinds of markup or in none, with ordinary uses of the
same signs in between. The generator knows what it has marked: every line carries the kinds of its marks and its
role. The number of documents is a parameter, the seed is fixed, and nothing of the test tables is used.

A part of the documents is seen without hints, so the labeller learns the marks themselves too. The thresholds
are set on documents of another seed.
"""

from __future__ import annotations

import random
import sys

import numpy as np

from lavra.llm.markup import HIDDEN, KINDS, N_HINTS, ROLES, WEIGHTS, WIDTH, Labeller, leaves

_SYLLABLES = "ba ca da fa ga la ma na pa ra sa ta va be de fe le me ne pe re se te bi di fi li mi ni pi ri si ti bo co do fo lo mo no po ro so to bu cu du fu lu mu nu ção ções dade mente gem".split()
#: Signs that scanning puts between words, and code pages that texts are read in by mistake.
STRAY = ("~", "^", "''", "''", "¦", "·", "''", "'", "|", "—.", "`", "*", "_", "\\", "=", "<", '"', "°", "«", "“", "$", "&")
PAGES = ("latin-1", "cp1252", "cp850", "cp437", "cp1250", "cp1251", "mac_roman", "ascii")
Line = tuple[str, frozenset, str]


class Maker:
    def __init__(self, seed: int):
        self.r = random.Random(seed)
        self.scanned, self.damage, self.second = False, "", None

    def word(self) -> str:
        w = "".join(self.r.choice(_SYLLABLES) for _ in range(self.r.randint(1, 4)))
        return w.capitalize() if self.r.random() < 0.15 else w

    def words(self, a: int, b: int) -> list[str]:
        return [self.word() if self.r.random() < 0.9 else str(self.r.randint(1, 9999)) for _ in range(self.r.randint(a, b))]

    def sentence(self) -> str:
        ws = self.words(5, 18)
        if self.r.random() < 0.3:
            ws.insert(self.r.randrange(len(ws)), self.r.choice(["R$ 1.234,56", "12/03/2011,", "nº 77/2012", "(item 3)", "d'Água", "–", "on-line", "A & B", "50 %"]))
        if self.scanned:
            ws = [self.misread(w) if self.r.random() < 0.1 else w for w in ws]
            ws = [x for w in ws for x in ([self.r.choice(STRAY)] if self.r.random() < 0.04 else []) + [w]]
        s = " ".join(ws).capitalize() + self.r.choice([".", ".", ".", ";", ""])
        if self.damage or self.r.random() < 0.05:  # text in a wrong encoding holds many odd signs
            for _ in range(self.r.choice([1, 1, 1, 2])):
                s = s.encode("utf-8", "ignore").decode(self.damage or self.r.choice(PAGES), errors="replace")
        return s

    def misread(self, word: str) -> str:
        k = self.r.randrange(len(word))
        return word[:k] + self.r.choice("!|€@$+¢015") + word[k + 1 :]

    def wrapped(self, text: str) -> list[Line]:
        """A paragraph set in lines, some of which end in a cut word."""
        out, line = [], ""
        for w in text.split(" "):
            if len(line) + len(w) > self.r.randint(45, 70):
                cut = len(w) // 2
                if cut > 2 and self.r.random() < 0.3:
                    line, w = f"{line} {w[:cut]}" + self.r.choice("-‐¬"), w[cut:]
                out.append(line)
                line = w
            else:
                line = f"{line} {w}" if line else w
        return [(x, frozenset(), "paragraph") for x in [*out, line]]

    def decoy(self) -> str:
        """A line with signs in their ordinary use."""
        r = self.r
        n, m, u, v, w = r.randint(1, 99), r.randint(2, 9), self.word(), self.word(), self.word().lower()
        return r.choice([
            f"Área de {n} * {n} * 2 metros, valores com * aceitos *.", f"Ver nota [{n}] e conjunto {{1, {n}}}.", f"Contato <setor{n}@casa.invalid> [sic].", f"Em C:\\pasta\\sub\\arq_{n}_v2.pdf, item #{n}.",
            f"De R$ {n},00 a R$ {n + 5},00 foram aceitos *.", f"- {n} -", f"{n};{n * 7};{u};{n},10", f"Se a < b e c > {n}, então a_{n} = x_{n}.", f"{u} '' {v} ~ · {u} | {v}",
            f"{u[:-1]}!{v} c0m {u}@{v} +e$te", f"{u} & {v}, {n}% + {n}", f"Página {n} de {n + 3}", f"{n}. {u} {v}.", f"* {n} = nota; ** = outra nota *", f"1 == 1, {n} != 2", f"{u} #tema{n} @casa", f"#{n}",
            f"({n} < {n + m}) && ({u} || {v})", f"{u} com {v} < {m} e {w} > {n} {u}.", f"{u} entre <{n} e >{m} {w}.", f"{u} '' {v} {w} '' {u} '' {n}.", f"{u} -> {v} => {w}", f"<<{u}>> e >> {v}", f"{{{u}, {v}}} e {{{n}}}", f"[{u}] ({v}) [{n}/{n + m}]", f"{w}_{n} e {w}__{m}__x, {u}_{v}", f"__{n}__/__{m}__/____", f"_______________ {u} _______________",
            f"{u}\t{n}\t{v}", f"{n}'' e {m}' de arco, d'{u} e d''{w}", f"https://casa.invalid/?a={n}&b={m}&c={w}", f"\\\\servidor\\{w}\\{u}.doc", f"C:\\{w}\\novo\\{n}", f"US$ {n},00 ou $ {m}.", f"R${n},50 e US${m},20 em {u}$", f"-----", f"{'-' * r.randint(3, 40)}", f"{'=' * r.randint(3, 40)}", f"{'*' * r.randint(3, 9)}",
            f"{u} | {v} | {n}", f"| {u} {n}", f"item # {n} e * {m} *", f"#{n} {u} {v}", f"* {u} {v}", f"*{n} vide nota", f"{n}* {u} {m}**", f"~{n} km, ~{m} h; {u} ~ {v}", f"` {u} ´ {v}", f"d`{u} e {v}`s", f"A&B, P&D, {u} & Cia.; {n}", f"{u}&{v}; {n}", f"{n}^{m} = x^2 + {n}", f"{u} = {v}", f"== {n}", f"= {u} {n}", f"[{u}]: {v}", f"<{n}% e >{m}%", f"a<{w}>b" if r.random() < 0.2 else f"< {w} >", f"if (a[{n}] < {m}) {{ x = {n}; }}", f"{w} = {{'{u}': {n}}}", f"%{n} \\ {m}", f"{u}\\{v}/{w}",
        ])

    def within(self, text: str, left: str, right: str) -> str:
        ws = text.split()
        a = self.r.randrange(len(ws))
        b = min(len(ws), a + self.r.randint(1, 4))
        return " ".join([*ws[:a], left + " ".join(ws[a:b]) + right, *ws[b:]])

    def formula(self) -> str:
        n = self.r.randint(1, 9)
        return self.r.choice([f"x_{{{n}}} = \\frac{{-b + \\sqrt{{\\Delta}}}}{{2a}}", f"\\alpha_{{{n}}}", f"\\sum_{{i={n}}}^{{n}} a_{{i}}", "E = mc^2", "\\bar{x} \\leq \\sigma", f"y^{{{n}}} \\cdot \\pi"])

    def marked(self, kind: str) -> tuple[str, bool]:
        """A sentence with a mark of the kind, and whether one was set: there may be nothing to replace."""
        s, n = self.sentence(), self.r.randint(1, 99)
        pick = self.r.choice
        if kind == "html":
            t = pick(["b", "i", "em", "strong", "u", "B", "I", "sup", "code", "span"])
            out = pick([self.within(s, f"<{t}>", f"</{t}>"), self.within(s, f'<a href="https://x.invalid/{n}">', "</a>"), self.within(s, "", pick(["<br>", "<br/>", "<br />", "&nbsp;", "&nbsp;&nbsp;", "&mdash;"])), s.replace("ç", "&ccedil;").replace("a", "&atilde;", 1), s.replace("e", pick(["&#233;", "&eacute;", "&amp;", "&lt;"]), 1), s + " <!-- x -->", f"<p>{s}</p>", f"<P align=center>{s}</P>", f"<font size={n}>{s}</font>"])
        elif kind == "markdown":
            out = pick([self.within(s, "**", "**"), self.within(s, "__", "__"), self.within(s, "[", f"](https://x.invalid/{n})"), f"![Image](images/p_{n}.png)", self.within(s, "`", "`"), f"> {s}", self.within(s, "*", "*"), self.within(s, "~~", "~~")])
        elif kind == "wiki":
            out = pick([self.within(s, "'''", "'''"), self.within(s, "''", "''"), self.within(s, "[[", "]]"), self.within(s, f"[[Ato {n}|", "]]"), f"[[Categoria:{self.word()}]]", f"{{{{Caixa ato|número={n}|ano=2010}}}}", self.within(s, "<nowiki>", "</nowiki>"), s + f"<ref>{self.word()}</ref>"])
        else:
            out = pick([self.within(s, pick(["\\emph{", "\\textbf{", "\\textit{"]), "}"), s + f"~\\cite{{ato{n}}}", self.within(s, f"${self.formula()}$ ", ""), s.replace("a", "\\~{a}", 1), s.replace("e", "\\'{e}", 1), s.replace("c", "\\c{c}", 1), s.replace("o", pick(["\\'o", "\\^o", "\\~o"]), 1), f"\\( {self.formula()} \\)", f"\\[ {self.formula()} \\]"])
        return out, out != s

    def paragraph(self, kind: str | None, n_marked: int) -> Line:
        """One to nine sentences on a line, some of them marked, with ordinary signs among them; marks of the
        document's second kind may stand beside those of the first."""
        out = [(self.sentence() if self.r.random() < (0.9 if kind else 0.75) else self.decoy(), False) for _ in range(self.r.choice([0, 0, 1, 2, 3, 4, 6, 8]))]
        out = [(t, None) for t, _ in out]
        for _ in range(n_marked if kind else 0):
            k = self.second if self.second and self.r.random() < 0.4 else kind
            t, done = self.marked(k)
            out.append((t, k if done else None))
        self.r.shuffle(out)
        out = out or [(self.sentence(), None)]
        glue = "<br/>" if kind and "html" in (kind, self.second) and self.r.random() < 0.3 else " "
        held = {k for _, k in out if k} | ({"html"} if glue != " " and len(out) > 1 else set())
        return glue.join(t for t, _ in out), frozenset(held), "paragraph"

    def part(self, kind: str) -> list[Line]:
        r, k, none = self.r, frozenset([kind]), frozenset()
        title, n = " ".join(self.words(2, 5)), r.randint(2, 4)
        shape = r.choice(["heading", "heading", "list", "table", "code", "formula", "text", "text"])
        rows = [(" ".join(self.words(1, 4)), r.randint(1, 999)) for _ in range(n)]
        code = r.choice([["SELECT a, COUNT(1)", "FROM b", "GROUP BY a"], ["for i in range(7):", "    print(i * 3)"], ["def media(notas):", "    return sum(notas) / len(notas)"]])
        if shape == "text":
            return [self.paragraph(kind, r.randint(0, 3))]
        if kind == "html":
            if shape == "heading":
                h = r.choice(["h1", "h2", "h3", "H1", "H2"])
                return [(f"<{h}>{title}</{h}>", k, "heading")]
            if shape == "list":
                return [("<ul>", k, "list"), *[(f"<li>{self.sentence()}</li>", k, "list") for _ in rows], ("</ul>", k, "list")] if r.random() < 0.5 else [("<UL>" + "".join(f"<LI>{self.sentence()}</LI>" for _ in rows) + "</UL>", k, "list")]
            if shape == "table":
                return [("<table border=1>" + "".join(f"<tr><td>{a}</td><td>{b}</td></tr>" for a, b in rows) + "</table>", k, "table")]
            if shape == "code":
                return [("<pre><code>" + code[0], k, "code"), *[(x, none, "code") for x in code[1:-1]], (code[-1] + "</code></pre>", k, "code")] if len(code) > 1 else []
            return [(f"<p>{r.choice(['<i>d</i> = <i>m</i> / <i>v</i><sup>2</sup>', 'x<sub>1</sub> + 3'])}</p>", k, "formula")] if r.random() < 0.6 else [(f"<p>\\( {self.formula()} \\)</p>", frozenset(["html", "latex"]), "formula")]
        if kind == "markdown":
            if shape == "heading":
                return [("#" * r.randint(1, 5) + " " + title, k, "heading")] if r.random() < 0.7 else [(title, none, "heading"), (r.choice("=-") * max(3, len(title)), k, "skip")]
            if shape == "list":
                s = r.choice("*-+")
                return [(f"{s} {self.sentence()}", none, "list") for _ in rows]
            if shape == "table":
                return [("| Item | Valor |", none, "table"), ("| --- | ---: |", k, "table"), *[(f"| {a} | {b} |", none, "table") for a, b in rows]]
            if shape == "code":
                return [("```" + r.choice(["", "python", "sql"]), k, "skip"), *[(x, none, "code") for x in code], ("```", k, "skip")]
            return [(f"> Fórmula: `d = {r.choice('mnp')} / v`", k, "formula")] if r.random() < 0.7 else [("---", none, "skip"), (f"titulo: ato {n}", none, "skip"), ("---", k, "skip")]
        if kind == "wiki":
            if shape == "heading":
                e = "=" * r.randint(2, 4)
                return [(f"{e} {title} {e}", k, "heading")]
            if shape == "list":
                s = r.choice(["*", "#", "**", "#"])
                return [(f"{s} {self.sentence()}", none, "list") for _ in rows]
            if shape == "table":
                return [('{| class="wikitable"', k, "table"), ("! Item !! Valor", none, "table"), *[x for a, b in rows for x in (("|-", k, "table"), (f"| {a} || {b}", none, "table"))], ("|}", k, "table")]
            if shape == "code":
                return [(" " + x, none, "code") for x in code]
            return [("''d'' = ''m'' : ''v''", k, "formula")]
        if shape == "heading":
            return [(r.choice(["\\section*{", "\\section{", "\\subsection{"]) + title + "}", k, "heading")]
        if shape == "list":
            e = r.choice(["itemize", "enumerate"])
            return [(f"\\begin{{{e}}}", k, "list"), *[(f"\\item {self.sentence()}", k, "list") for _ in rows], (f"\\end{{{e}}}", k, "list")]
        if shape == "table":
            return [("\\begin{tabular}{rlr}", k, "table"), *[(f"{b} & {a} & {b} \\\\", none, "table") for a, b in rows], ("\\end{tabular}", k, "table")]
        if shape == "code":
            return [("\\begin{verbatim}", k, "skip"), *[(x, none, "code") for x in code], ("\\end{verbatim}", k, "skip")]
        return [("\\begin{equation}", k, "formula"), (self.formula(), frozenset(["latex"]), "formula"), ("\\end{equation}", k, "formula")] if r.random() < 0.5 else [(f"\\( {self.formula()} \\)", k, "formula")]

    def document(self) -> list[Line]:
        r, none = self.r, frozenset()
        kind = r.choice([None, *KINDS])
        style = r.random()
        self.scanned, self.damage = r.random() < 0.3, r.choice(PAGES) if r.random() < 0.15 else ""
        self.second = r.choice(KINDS) if kind and r.random() < 0.3 else None
        lines: list[Line] = []
        if kind == "html" and style < 0.3:
            lines += [("<!DOCTYPE html>", frozenset(["html"]), "skip"), ("<html><head><title>Ato</title>", frozenset(["html"]), "skip"), ("<style>p { margin: 0 }</style></head><body>", frozenset(["html"]), "skip")]
        if kind == "latex" and style < 0.3:
            lines += [("\\documentclass[12pt]{article}", frozenset(["latex"]), "skip"), ("\\begin{document}", frozenset(["latex"]), "skip")]
        single = kind is not None and style > 0.6
        parts = r.randint(1, 7)
        at = r.randrange(parts)
        for p in range(parts):
            if r.random() < (0.15 if kind else 0.5):
                block: list[Line] = [(self.decoy(), none, "paragraph") for _ in range(r.randint(1, 3))]
                # A line of hyphens below a line of text would make it a heading.
                block = [x for t, k, role in block for x in ([("", none, "skip")] if set(t) <= set("-=") else []) + [(t, k, role)]]
            elif kind and (not single or p == at):
                block = self.part(self.second if self.second and r.random() < 0.3 else kind) if not single else [self.paragraph(kind, 1)] if r.random() < 0.8 else self.part(kind)
            elif r.random() < 0.25:
                block = [(self.sentence(), none, "paragraph") for _ in range(r.randint(2, 8))]
            else:
                block = [self.paragraph(None, 0)]
                if r.random() < (0.6 if self.scanned else 0.15):
                    block = self.wrapped(block[0][0])
            if kind and r.random() < 0.04:
                block.append((self.sentence() + " <u>Visto</u>.", frozenset(["html"]), "paragraph"))
            lines += block
            if r.random() < 0.9:
                lines.append(("", none, "skip"))
        out = lines
        if kind == "html" and not single and r.random() < 0.3:  # a whole page without line ends
            return [("".join(t for t, _, _ in out), frozenset().union(*[k for _, k, _ in out]), "paragraph")]
        return out


def examples(n: int, seed: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    make, out = Maker(seed), []
    for _ in range(n):
        doc = make.document()
        kinds = np.array([[k in ks for k in KINDS] for _, ks, _ in doc], np.float32)
        out.append((leaves("\n".join(t.replace("\n", " ") for t, _, _ in doc)), kinds, np.array([ROLES.index(role) for _, _, role in doc])))
    return out


def _start(seed: int) -> dict[str, np.ndarray]:
    g = np.random.default_rng(seed)
    init = lambda *s: (g.standard_normal(s) / np.sqrt(s[0])).astype(np.float32)
    bias = np.zeros(4 * HIDDEN, np.float32)
    bias[HIDDEN : 2 * HIDDEN] = 1
    out = len(KINDS) + len(ROLES)
    return {"xf": init(WIDTH, 4 * HIDDEN), "hf": init(HIDDEN, 4 * HIDDEN), "bf": bias, "xb": init(WIDTH, 4 * HIDDEN), "hb": init(HIDDEN, 4 * HIDDEN), "bb": bias.copy(), "ho": init(2 * HIDDEN, out), "xo": init(WIDTH, out) * 0.1, "bo": np.zeros(out, np.float32)}


def _run(pre, recur, alive):
    """Forward pass of one direction that keeps what the backward pass needs."""
    n, steps, _ = pre.shape
    h, c, kept, out = np.zeros((n, HIDDEN), np.float32), np.zeros((n, HIDDEN), np.float32), [], np.zeros((n, steps, HIDDEN), np.float32)
    for t in range(steps):
        z = pre[:, t] + h @ recur
        s = 1 / (1 + np.exp(-np.clip(z[:, : 3 * HIDDEN], -30, 30)))
        i, f, o, g = s[:, :HIDDEN], s[:, HIDDEN : 2 * HIDDEN], s[:, 2 * HIDDEN :], np.tanh(z[:, 3 * HIDDEN :])
        fresh, m = f * c + i * g, alive[:, t, None]
        kept.append((h, c, i, f, o, g, np.tanh(fresh), m))
        h, c = o * kept[-1][6] * m, fresh * m
        out[:, t] = h
    return out, kept


def _back(grad, kept, recur):
    """Gradients of the gate inputs and of the recurrent weights of one direction."""
    n, steps, _ = grad.shape
    dh, dc, dpre, drec = np.zeros((n, HIDDEN), np.float32), np.zeros((n, HIDDEN), np.float32), np.zeros((n, steps, 4 * HIDDEN), np.float32), np.zeros_like(recur)
    for t in range(steps - 1, -1, -1):
        h0, c0, i, f, o, g, tc, m = kept[t]
        gh = (grad[:, t] + dh) * m
        gc = dc * m + gh * o * (1 - tc * tc)
        dz = np.concatenate([gc * g * i * (1 - i), gc * c0 * f * (1 - f), gh * tc * o * (1 - o), gc * i * (1 - g * g)], axis=1)
        dpre[:, t], drec = dz, drec + h0.T @ dz
        dh, dc = dz @ recur.T, gc * f
    return dpre, drec


def train(n_documents: int = 50_000, epochs: int = 8, batch: int = 48, rate: float = 4e-3, hintless: float = 0.2, seed: int = 7, tell=lambda *_: None) -> dict[str, np.ndarray]:
    data, w = examples(n_documents, seed), _start(seed)
    first, second, step = {k: np.zeros_like(v) for k, v in w.items()}, {k: np.zeros_like(v) for k, v in w.items()}, 0
    g = np.random.default_rng(seed)
    for epoch in range(epochs):
        order = sorted(range(len(data)), key=lambda k: (len(data[k][0]) // 3, g.random()))
        batches = [order[a : a + batch] for a in range(0, len(order), batch)]
        g.shuffle(batches)
        total = 0.0
        for part in batches:
            steps = max(len(data[k][0]) for k in part)
            x, y = np.zeros((len(part), steps, WIDTH), np.float32), np.zeros((len(part), steps, len(KINDS)), np.float32)
            roles, alive = np.zeros((len(part), steps), int), np.zeros((len(part), steps), np.float32)
            for r, k in enumerate(part):
                m = len(data[k][0])
                x[r, :m], y[r, :m], roles[r, :m], alive[r, :m] = *data[k], 1
            x[g.random(len(part)) < hintless, :, -N_HINTS:] = 0
            flat = x.reshape(-1, WIDTH)
            fw, kf = _run((flat @ w["xf"] + w["bf"]).reshape(len(part), steps, -1), w["hf"], alive)
            bw, kb = _run((flat @ w["xb"] + w["bb"]).reshape(len(part), steps, -1)[:, ::-1], w["hb"], alive[:, ::-1])
            both = np.concatenate([fw, bw[:, ::-1]], axis=2).reshape(-1, 2 * HIDDEN)
            out = both @ w["ho"] + flat @ w["xo"] + w["bo"]
            p = 1 / (1 + np.exp(-np.clip(out[:, : len(KINDS)], -30, 30)))
            e = np.exp(out[:, len(KINDS) :] - out[:, len(KINDS) :].max(axis=1, keepdims=True))
            q = e / e.sum(axis=1, keepdims=True)
            live = alive.reshape(-1, 1) / alive.sum()
            truth = y.reshape(-1, len(KINDS))
            total += float((-(truth * np.log(p + 1e-7) + (1 - truth) * np.log(1 - p + 1e-7)) * live).sum())
            q[np.arange(len(q)), roles.reshape(-1)] -= 1
            d = np.concatenate([p - truth, q * 0.3], axis=1).astype(np.float32) * live
            grads = {"ho": both.T @ d, "xo": flat.T @ d, "bo": d.sum(axis=0)}
            dboth = (d @ w["ho"].T).reshape(len(part), steps, -1)
            df, grads["hf"] = _back(dboth[:, :, :HIDDEN], kf, w["hf"])
            db, grads["hb"] = _back(dboth[:, ::-1, HIDDEN:], kb, w["hb"])
            df, db = df.reshape(-1, 4 * HIDDEN), db[:, ::-1].reshape(-1, 4 * HIDDEN)
            grads |= {"xf": flat.T @ df, "bf": df.sum(axis=0), "xb": flat.T @ db, "bb": db.sum(axis=0)}
            step += 1
            pace = rate * (0.02 + 0.49 * (1 + np.cos(np.pi * step / (epochs * len(batches)))))
            norm = min(1.0, 5.0 / (1e-6 + np.sqrt(sum(float((v * v).sum()) for v in grads.values()))))
            for k, v in grads.items():
                first[k] = 0.9 * first[k] + 0.1 * v * norm
                second[k] = 0.999 * second[k] + 0.001 * (v * norm) ** 2
                w[k] -= pace * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
        tell(epoch, total / len(batches))
    return w


def _highest(w: dict[str, np.ndarray], n_documents: int, seed: int, change=None):
    """Per document: highest probability of each kind, the kinds it holds; and the share of leaves with the right role."""
    data, right, total, top, held = examples(n_documents, seed), 0, 0, [], []
    docs = [x if change is None else change(x) for x, _, _ in data]
    for (p, roles), (_, kinds, want) in zip(Labeller(w).scores(docs), data, strict=True):
        top.append(p.max(axis=0))
        held.append(kinds.max(axis=0) > 0)
        right += int((roles.argmax(axis=1) == want).sum())
        total += len(want)
    return np.array(top), np.array(held), right / max(1, total)


def calibrate(w: dict[str, np.ndarray], n_documents: int = 3000, seed: int = 4321) -> np.ndarray:
    """The threshold of each kind with the fewest wrong documents, in the middle of the best range."""
    top, held, _ = _highest(w, n_documents, seed)
    grid = np.linspace(0.02, 0.98, 97)
    out = []
    for q in range(len(KINDS)):
        wrong = np.array([((top[:, q] >= t) != held[:, q]).sum() for t in grid])
        best = np.flatnonzero(wrong == wrong.min())
        out.append(grid[best[len(best) // 2]])
    return np.array(out, np.float32)


def accuracy(w: dict[str, np.ndarray], n_documents: int = 600, seed: int = 1234, change=None) -> tuple[float, float, float]:
    """On unseen documents: recall and precision of (document, kind), and the share of leaves with the right role.

    ``change`` alters the vectors of a document first, to see what the labeller makes of them.
    """
    top, held, roles = _highest(w, n_documents, seed, change)
    got = top >= w["least"]
    return float((got & held).sum() / max(1, held.sum())), float((got & held).sum() / max(1, got.sum())), roles


if __name__ == "__main__":
    weights = train(tell=print)
    weights["least"] = calibrate(weights)
    print(weights["least"], accuracy(weights))
    np.savez_compressed(sys.argv[1] if len(sys.argv) > 1 else WEIGHTS, **{k: v.astype(np.float16) for k, v in weights.items()})
