"""Marked-up documents (HTML, Markdown, wiki text, LaTeX) to clean text that keeps its structure.

A text is read line by line into blocks (heading, list item, quotation, table row, code, formula, paragraph); within a
block the inline markup is resolved. Every piece of markup that is taken away is counted, so ``n_markup`` says whether
the text held residue at all. Signs that linguists use in plain text stay and count for nothing: *forms and **forms, <
and >, ~, single braces and brackets, [sic], $5, C#, a_b.

Blocks are then classed in two passes. The first decides by length, stop-word density and link density: a block of
links is ``link``, a long block with stop words ``text``, and short ones stay open unless they are headings, code or
formulas. In the second, open blocks take the label of the nearest decided neighbour, the earlier one on a tie, ``text``
where there is none. The labels decide the main text: blocks of links are left out of it, and headings that nothing but
such blocks follow. Whether a text holds residue doesn't depend on them, as residue counts in a block of any label.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame

from lexweave.llm.readability import FUNCTION_WORDS

#: Names of HTML and wiki elements.
TAGS = """a abbr article aside b big blockquote body br button caption center cite code col colgroup dd del details dfn div dl dt em
figcaption figure font footer form gallery h1 h2 h3 h4 h5 h6 head header hr html i iframe img input ins kbd label li link main
math meta nav noinclude nowiki object ol onlyinclude includeonly option p pre q ref references s samp script section select
small source span strike strong style sub summary sup svg syntaxhighlight table tbody td textarea tfoot th thead title tr tt u ul var video wbr""".split()
#: The density of stop words is that of the language which has most of them in the block.
STOP: dict[str, tuple[str, ...]] = {}
for _lang, _words in FUNCTION_WORDS.items():
    for _w in _words:
        STOP[_w] = (*STOP.get(_w, ()), _lang)
LONG, DENSE, LINKS = 60, 0.2, 0.5

_T = "|".join(TAGS)
#: The rest of a tag: attributes, whose quoted values may hold any character, or whatever stands before the next >.
_REST = r"""(?:(?:\s(?:[^<>"']++|"[^"\n]*"|'[^'\n]*')*+)?/?>|\s[^<>]*>)"""
_CODE = ("\x02", "\x03")  # around code, so that nothing in it is taken for markup
_rx = lambda p, f=0: re.compile(p, f)
_KEPT, _TABS, _SPACES = _rx(r"\x02(\d+)\x03"), _rx(r"[ \t]*\t[ \t]*"), _rx(r"[ \t]+")
#: What any markup needs; a text without it is passed through.
_HINT = _rx(r"<[/!A-Za-z]|[\[\]{}]{2}|''|__|~~|`|\\|\*\S|&#?\w+;|\]\(|https?://|\$|ftp://|(?m:^[ \t]*(?:[#>|=*+;:-]|\d+[.)] ))|(?<!\w)_\w|#REDIRECT|\{\||\|\}")
_COMMENT = _rx(r"<!--.*?(?:-->|\Z)", re.S)
_DROPPED = _rx(r"<(script|style|head)\b[^<>]*>.*?</\1\s*>", re.S | re.I)
_PRE = _rx(r"<pre\b[^<>]*>\s*(?:<code\b[^<>]*>)?(.*?)(?:</code>)?\s*</pre\s*>|<(syntaxhighlight|code|nowiki)\b[^<>/]*>(.*?)</\2\s*>", re.S | re.I)
_MATH_TAG = _rx(r"<math\b[^<>]*>(.*?)</math\s*>", re.S | re.I)
_FENCE = _rx(r"^[ \t]*(`{3,}|~{3,})[^\n`]*\n(.*?)(?:^[ \t]*\1[ \t]*$|\Z)", re.S | re.M)
_REF = _rx(r"<ref\b[^<>]*?/>|<ref\b[^<>]*>.*?(?:</ref\s*>|\Z)", re.S | re.I)
_HEAD_TAG = _rx(r"<h([1-6])\b[^<>]*>(.*?)</h\1\s*>", re.S | re.I)
_BREAK = _rx(r"<(?:br|hr)\s*/?>", re.I)
_ITEM_TAG = _rx(r"<li\b[^<>]*>", re.I)
_CELL = _rx(r"</t[dh]\s*>\s*(?=<t[dh]\b)", re.I)
_BLOCK_TAG = _rx(r"</?(?:p|div|ul|ol|dl|dt|dd|table|tbody|thead|tfoot|tr|section|article|blockquote|li|figure|header|footer|nav|pre)" + _REST, re.I)
_TAG = _rx(rf"</?(?:{_T}){_REST}", re.I)
_CLOSED = _rx(r"</([A-Za-z][\w:.-]*)\s*>")
_ESC_TAG = _rx(rf"&lt;/?(?:{_T})(?:\s[^<>]*?)?/?&gt;", re.I)
_ENTITY = _rx(r"&(?:[A-Za-z][A-Za-z0-9]{1,30}|#\d{1,7}|#[xX][0-9A-Fa-f]{1,6});")
_REDIRECT = _rx(r"^\s*#REDIRECT:?\s*", re.I)
_PARAM = _rx(r"\{\{\{([^{}|]*)(?:\|([^{}]*))?\}\}\}")
_TEMPLATE = _rx(r"\{\{([^{}]*)\}\}")
_OPEN_TEMPLATE = _rx(r"\{\{([^{}|]*\|[^{}\n]*)$")
_FILE = _rx(r"\[\[\s*(?:File|Image|Category)\s*:[^\[\]]*\]\]", re.I)
_WIKILINK = _rx(r"\[\[([^\[\]|]*)(?:\|([^\[\]]*))?\]\]")
_EXTLINK = _rx(r"\[(?:https?|ftp)://[^\s\]]+(?:[ \t]+([^\]\n]*))?\]")
_MD_LINK = _rx(r"!?\[([^\[\]\n]*)\]\((?:<[^<>\n]*>|[^()\s]*[./#:][^()\s]*)(?:[ \t]+\"[^\"\n]*\")?\)")
_LOOSE = _rx(r"\{\{|\}\}|\[\[|\]\]")
_MAGIC = _rx(r"__[A-Z]{3,}__")
_WIKI_EM = _rx(r"'{5}|'''|''")
_BOLD = _rx(r"(?<![\w*])\*\*(?=[^\s*])([^*\n]*?[^\s*])\*\*(?![\w*])|(?<!\w)__(?=[^\s_])([^\n]*?[^\s_])__(?!\w)")
_ITALIC = _rx(r"(?<![\w*])\*(?=[^\s*])([^*\n]*?[^\s*])\*(?![\w*])|(?<!\w)_(?=[^\s_])([^_\n]*?[^\s_])_(?!\w)")
_STRIKE = _rx(r"~~(?=\S)([^~\n]*?\S)~~")
_TICK = _rx(r"(`+)([^`\n]+)\1(?!`)")
_TEX_QUOTE = _rx(r"``([^`'\n]*)''")
_TEX_DISPLAY = _rx(r"\\\[(.*?)\\\]|\$\$(.+?)\$\$|\\begin\{(equation|align|displaymath|math)\*?\}(.*?)\\end\{\3\*?\}", re.S)
_TEX_INLINE = _rx(r"\\\((.*?)\\\)|\$(?=[^$\n]*[\\^_=]|[A-Za-z]\$)(?! )([^$\n]+?)(?<! )\$(?!\d)")
_TEX_HEAD = _rx(r"\\(?:chapter|(sub)*section|paragraph)\*?\{([^{}]*)\}")
_TEX_ACCENT = _rx(r"\\(['`^\"~=.])(?:\{\\?([A-Za-z])\}|\\?([A-Za-z]))|\\([cvuHkrdb])\{([A-Za-z])\}")
_TEX_ENV = _rx(r"\\(?:begin|end)\{[^{}]*\}(?:\[[^\]\n]*\])?")
_TEX_ITEM = _rx(r"\\item\b(?:\[[^\]\n]*\])?[ \t]*")
_TEX_GROUP = _rx(r"\\(?!frac|sqrt)[A-Za-z]+\*?(?:\[[^\]\n]*\])?\{([^{}]*)\}")
_TEX_CMD = _rx(r"\\[A-Za-z]+\*?(?:\{[^{}\n]*\})*")
_TEX_ESC = _rx(r"\\([#$%&_{}\\*`~\[\]()>+.!|-])")
#: Combining marks of the accent commands.
_MARKS = {"'": "\u0301", "`": "\u0300", "^": "\u0302", '"': "\u0308", "~": "\u0303", "=": "\u0304", ".": "\u0307", "c": "\u0327", "v": "\u030c", "u": "\u0306", "H": "\u030b", "k": "\u0328", "r": "\u030a", "d": "\u0323", "b": "\u0331"}
_WIKI_HEAD = _rx(r"^[ \t]*(={1,6})[ \t]*([^=\n].*?)[ \t]*\1[ \t]*$")
_MD_HEAD = _rx(r"^(#{1,6})[ \t]+(\S.*?)[ \t]*#*$")
_RULE = _rx(r"^[ \t]*(?:-{3,}|={3,}|\*{3,}|_{3,})[ \t]*$")
_MD_SEP = _rx(r"^[ \t]*\|?[ \t]*:?-{3,}:?[ \t]*(?:\|[ \t]*:?-{3,}:?[ \t]*)*\|?[ \t]*$")
_BULLET = _rx(r"^[ \t]*([*#:;]+|[-+•])[ \t]+(?=\S)")
_NUMBER = _rx(r"^[ \t]*\d{1,3}[.)][ \t]+(?=\S)")
_QUOTE = _rx(r"^[ \t]*>[ \t]?")


_KNOWN = frozenset(TAGS)
#: What must be in a text for a pattern to match at all.
_NEEDS = {
    _COMMENT: "<!--", _DROPPED: "<", _PRE: "<", _MATH_TAG: "<", _REF: "<", _HEAD_TAG: "<", _BREAK: "<", _ITEM_TAG: "<", _CELL: "<", _BLOCK_TAG: "<", _TAG: "<",
    _ESC_TAG: "&lt;", _ENTITY: "&", _REDIRECT: "#", _PARAM: "{{{", _TEMPLATE: "{{", _OPEN_TEMPLATE: "{{", _FILE: "[[", _WIKILINK: "[[", _EXTLINK: "[", _MD_LINK: "](",
    _MAGIC: "__", _WIKI_EM: "''", _STRIKE: "~~", _TICK: "`", _TEX_QUOTE: "``", _TEX_HEAD: "\\", _TEX_ITEM: "\\item", _TEX_ENV: "\\", _TEX_ACCENT: "\\",
}
#: What a line needs for any inline markup.
_INLINE = _rx(r"[\[\]{}<*_~`&]|''")


class _Doc:
    """The state of one conversion: the number of markup pieces met, links and their length."""

    def __init__(self) -> None:
        self.n = 0

    def sub(self, rx: re.Pattern, to, s: str) -> str:
        if rx in _NEEDS and _NEEDS[rx] not in s:
            return s
        s, k = rx.subn(to, s)
        self.n += k
        return s

    def template(self, m: re.Match) -> str:
        """A template becomes its last positional argument: the word it shows, or its gloss in quotes after it."""
        parts = m[1].split("|")
        named = {k.strip(): v.strip() for p in parts[1:] if "=" in p for k, v in [p.split("=", 1)]}
        pos = [p.strip() for p in parts[1:] if "=" not in p]
        if not pos:
            return ""
        words = [p for p in pos[1:] if p] or pos
        gloss = next((named[k] for k in ("t", "gloss") if named.get(k)), "")
        return words[0 if len(pos) > 4 else min(1, len(words) - 1) if len(pos) == 3 else 0] + (f" “{gloss}”" if gloss else "")

    def inline(self, s: str) -> str:
        if not _INLINE.search(s):
            return s
        while True:  # templates and links nest; each round resolves the innermost
            before = self.n
            s = self.sub(_PARAM, lambda m: m[2] if m[2] is not None else "", s)
            s = self.sub(_TEMPLATE, self.template, s)
            s = self.sub(_FILE, "", s)
            s = self.sub(_WIKILINK, lambda m: m[2] or m[1].rsplit(":", 1)[-1].split("#")[0], s)
            if self.n == before:
                break
        s = self.sub(_EXTLINK, lambda m: m[1] or "", s)
        s = self.sub(_MD_LINK, r"\1", s)
        s = self.sub(_TAG, "", s)
        s = self.sub(_OPEN_TEMPLATE, self.template, s)
        s = self.sub(_LOOSE, "", s)
        s = self.sub(_MAGIC, "", s)
        s = self.sub(_TEX_QUOTE, r"“\1”", s)
        s = self.sub(_WIKI_EM, "", s)
        s = self.sub(_BOLD, lambda m: m[1] or m[2], s)
        s = self.sub(_ITALIC, lambda m: m[1] or m[2], s)
        return self.sub(_STRIKE, r"\1", s)

    def tex(self, s: str) -> str:
        s = self.sub(_TEX_ACCENT, lambda m: (m[2] or m[3] or m[5]) + _MARKS[m[1] or m[4]], s)
        s = self.sub(_TEX_ENV, "", s)
        while True:
            before = self.n
            s = self.sub(_TEX_GROUP, r"\1", s)
            if self.n == before:
                break
        return s


def _formula(s: str) -> str:
    """A formula without its dollars: commands lose the backslash, groups stay in parentheses."""
    s = re.sub(r"\\frac\s*\{([^{}]*)\}\s*\{([^{}]*)\}", r"(\1)/(\2)", s)
    s = re.sub(r"\\([A-Za-z]+)", r"\1", s).replace("\\", "")
    return re.sub(r"[ \t]+", " ", re.sub(r"\{([^{}]*)\}", r"(\1)", s)).strip()


def convert(text: str) -> tuple[list[tuple[str, int, str, float]], int]:
    """([(kind, level, text, share of linked characters)], number of markup pieces)."""
    if not _HINT.search(text):
        return [("paragraph", 0, line, 0.0) for p in text.split("\n") if (line := p.strip())], 0
    d, kept = _Doc(), []

    def keep(kind: str, body: str) -> str:
        kept.append((kind, body))
        return f"\n{_CODE[0]}{len(kept) - 1}{_CODE[1]}\n" if kind != "inline" else f"{_CODE[0]}{len(kept) - 1}{_CODE[1]}"

    s = text.replace("\r\n", "\n").replace(_CODE[0], "").replace(_CODE[1], "")
    s = d.sub(_FENCE, lambda m: keep("code", m[2].strip("\n")), s)
    s = d.sub(_COMMENT, "", s)
    s = d.sub(_DROPPED, "", s)
    s = d.sub(_PRE, lambda m: keep("code" if m[1] is not None or m[2].lower() == "syntaxhighlight" else "inline", html.unescape((m[1] if m[1] is not None else m[3]).strip("\n"))), s)
    s = d.sub(_MATH_TAG, lambda m: keep("inline", _formula(m[1])), s)
    s = d.sub(_REF, "", s)
    s = d.sub(_TEX_DISPLAY, lambda m: keep("formula", _formula(next(g for g in (m[1], m[2], m[4]) if g is not None))), s)
    s = d.sub(_TEX_INLINE, lambda m: keep("inline", _formula(m[1] or m[2])), s)
    s = d.sub(_TICK, lambda m: keep("inline", m[2].strip()), s) if "``" not in s or "''" not in s else s
    s = d.sub(_ESC_TAG, "", s)
    s = d.sub(_HEAD_TAG, lambda m: f"\n\x04{m[1]}{m[2].strip()}\n", s)
    s = d.sub(_TEX_HEAD, lambda m: f"\n\x04{2 if m[1] else 1}{m[2].strip()}\n", s)
    s = d.sub(_ITEM_TAG, "\n\x05", s)
    s = d.sub(_TEX_ITEM, "\n\x05", s)
    s = d.sub(_CELL, "\t", s)
    s = d.sub(_BREAK, "\n", s)
    s = d.sub(_BLOCK_TAG, "\n", s)
    if "</" in s:  # elements that no list has, where they are closed
        for name in {m[1].lower() for m in _CLOSED.finditer(s)} - _KNOWN:
            s = d.sub(re.compile(rf"</?{re.escape(name)}{_REST}", re.I), "", s)
    s = d.sub(_REDIRECT, "", s)
    s = d.tex(s) if "\\" in s else s
    s = d.sub(re.compile(r"\\frac\s*\{[^{}]*\}\s*\{[^{}]*\}|\\sqrt\s*\{[^{}]*\}"), lambda m: keep("inline", _formula(m[0])), s) if "\\" in s else s

    blocks: list[list] = []
    lines = s.split("\n")
    bullets = [bool(_BULLET.match(x)) for x in lines]
    in_table = False
    for i, line in enumerate(lines):
        if not line.strip():
            continue
        if kept and (m := _KEPT.fullmatch(line.strip())):
            kind, body = kept[int(m[1])]
            blocks.append(["paragraph" if kind == "inline" else kind, 0, body, 0.0])
            continue
        kind, level = "paragraph", 0
        if line[0] == "\x04":
            kind, level, line = "heading", int(line[1]), line[2:]
        elif line.lstrip()[:1] == "\x05":
            kind, level, line = "item", 1, line.lstrip()[1:]
        elif line.lstrip().startswith("{|"):
            in_table, d.n = True, d.n + 1
            continue
        elif in_table and (t := line.strip())[:1] in "|!":
            d.n += 1
            if t.startswith("|}"):
                in_table = False
                continue
            if t.startswith("|-"):
                continue
            kind, line = "row", "\t".join(c.split("|")[-1].strip() for c in re.split(r"\|\||!!", t[1:].lstrip("+")))
        elif m := _WIKI_HEAD.match(line):
            kind, level, line, d.n = "heading", len(m[1]), m[2], d.n + 1
        elif _RULE.match(line) or "|" in line and _MD_SEP.match(line):
            d.n += 1
            if blocks and blocks[-1][0] == "paragraph" and i and lines[i - 1].strip() and line.strip()[0] in "-=":
                blocks[-1][0], blocks[-1][1] = "heading", 1 if "=" in line else 2
            continue
        elif "|" in line and line.strip()[0] == "|" and line.count("|") > 1:
            d.n += 1
            kind, line = "row", "\t".join(c.strip() for c in line.strip().strip("|").split("|"))
        elif (m := _MD_HEAD.match(line)) and not (bullets[i] and (i and bullets[i - 1] or i + 1 < len(lines) and bullets[i + 1])):
            kind, level, line, d.n = "heading", len(m[1]), m[2], d.n + 1
        elif m := _BULLET.match(line):
            near = i and bullets[i - 1] or i + 1 < len(lines) and bullets[i + 1]
            if near or m[1][0] in "*#" or blocks and blocks[-1][0] in ("heading", "item"):
                d.n += m[1] != "•"  # the bullet of clean text
                kind, level, line = "item", len(m[1]), line[m.end() :]
        elif _QUOTE.match(line) and len(line.strip()) > 1:
            kind, line, d.n = "quote", _QUOTE.sub("", line), d.n + 1
        elif (m := _NUMBER.match(line)) and (i and _NUMBER.match(lines[i - 1]) or i + 1 < len(lines) and _NUMBER.match(lines[i + 1])):
            kind, level = "item", 1
        linked = 0
        if "[" in line:
            linked = sum(len(m[2] or m[1]) for m in _WIKILINK.finditer(line)) + sum(len(m[1] or "") for m in _EXTLINK.finditer(line)) + sum(len(m[1]) for m in _MD_LINK.finditer(line))
        line = d.inline(line)
        if "\\" in line:
            line = d.sub(_TEX_ESC, r"\1", d.sub(_TEX_CMD, lambda m: _formula(m[0]), line))
        line = d.sub(_ENTITY, lambda m: html.unescape(m[0]).replace("\xa0", " "), line)
        if kept and _CODE[0] in line:
            line = _KEPT.sub(lambda m: kept[int(m[1])][1], line)
        line = (_TABS.sub("\t", line) if kind == "row" else _SPACES.sub(" ", line)).strip()
        if line:
            blocks.append([kind, level, line, min(1.0, linked / len(line))])
    return [tuple(b) for b in blocks], d.n


def _stops(words: list[str]) -> int:
    n: dict[str, int] = {}
    for w in words:
        for lang in STOP.get(w, ()):
            n[lang] = n.get(lang, 0) + 1
    return max(n.values(), default=0)


def classify(blocks: list[tuple[str, int, str, float]]) -> list[str]:
    """A label per block: heading, code, formula, link or text."""
    labels: list[str | None] = []
    for kind, _, text, links in blocks:
        if kind in ("heading", "code", "formula"):
            labels.append(kind)
            continue
        words = text.lower().split()
        if links >= LINKS:
            labels.append("link")
        elif len(text) >= LONG and _stops(words) >= DENSE * len(words):
            labels.append("text")
        else:
            labels.append(None)
    decided = [(i, x) for i, x in enumerate(labels) if x in ("link", "text")]
    out, j = [], 0
    for i, x in enumerate(labels):
        if x is None:
            while j + 1 < len(decided) and abs(decided[j + 1][0] - i) < abs(decided[j][0] - i):
                j += 1
            x = decided[j][1] if decided else "text"
        out.append(x)
    return out


def render(blocks: list[tuple[str, int, str, float]]) -> str:
    """Clean text: a block a line, headings between empty lines and in brackets, items after a bullet, code indented."""
    out = []
    for kind, level, text, _ in blocks:
        if kind == "heading":
            out.append(f"\n【{text}】\n")
        elif kind == "item":
            out.append("  " * (level - 1) + "• " + text)
        elif kind in ("code", "formula"):
            out.append("\n".join("    " + x for x in text.split("\n")))
        else:
            out.append(text)
    return "\n".join(out).strip("\n")


def main_blocks(blocks: list[tuple[str, int, str, float]], labels: list[str]) -> list[tuple[str, int, str, float]]:
    """The blocks that aren't links, and the headings that lead to such a block before one of their level or above."""
    out: list[tuple[str, int, str, float]] = []
    open_: list[tuple[str, int, str, float]] = []
    for block, label in zip(blocks, labels):
        if label == "heading":
            open_ = [h for h in open_ if h[1] < block[1]] + [block]
        elif label != "link":
            out += [*open_, block]
            open_ = []
    return out


def clean_documents(df: DataFrame, key: Column, text: Column) -> DataFrame:
    """(rec_key, n_markup, clean, main, kinds, labels): each text converted whole, with a kind and a label per block.

    clean has all blocks, main those that the labels keep. A null text gives n_markup 0 and null texts, an empty one
    empty texts without blocks. Repeated rows come out repeated; rows are independent of each other, so ties don't arise
    and the plan has no shuffle.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ns, cleans, mains, kinds, labels = [], [], [], [], []
            for t in b.column(1).to_pylist():
                blocks, n = convert(t) if t else ([], 0)
                label = classify(blocks)
                ns.append(n)
                cleans.append(None if t is None else render(blocks))
                mains.append(None if t is None else render(main_blocks(blocks, label)))
                kinds.append([x[0] for x in blocks])
                labels.append(label)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(ns, pa.int32()), pa.array(cleans, pa.string()), pa.array(mains, pa.string()), pa.array(kinds, pa.list_(pa.string())), pa.array(labels, pa.list_(pa.string()))], ["rec_key", "n_markup", "clean", "main", "kinds", "labels"])

    return df.select(key.cast("bigint").alias("rec_key"), text.alias("t")).mapInArrow(run, "rec_key bigint, n_markup int, clean string, main string, kinds array<string>, labels array<string>")


def markup_counts(df: DataFrame, key: Column, text: Column) -> DataFrame:
    """(rec_key, n_markup) alone, for the same rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n = [convert(t)[1] if t else 0 for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int32())], ["rec_key", "n_markup"])

    return df.select(key.cast("bigint").alias("rec_key"), text.alias("t")).mapInArrow(run, "rec_key bigint, n_markup int")
