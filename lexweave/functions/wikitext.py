"""Wiki text: templates, links, section trees, and the relations that templates state."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame

_HEADING = re.compile(r"^(={1,6})[ \t]*(.+?)[ \t]*\1[ \t]*$", re.M)
_LINK = re.compile(r"\[\[([^\[\]|]*)(?:\|([^\[\]]*))?\]\]")
_BRACE = re.compile(r"[{}]")

#: Template names by the relation they state, the first being the full name; names are parted by commas.
RELATIONS = """
derivation: derived, der, der+
inheritance: inherited, inh, inh+
borrowing: borrowed, bor, bor+
learned borrowing: learned borrowing, lbor, lbor+
orthographic borrowing: orthographic borrowing, obor, obor+
semi-learned borrowing: semi-learned borrowing, slbor, slb, slb+
unadapted borrowing: unadapted borrowing, ubor, ubor+
root: root, ar-root
calque: calque, cal, clq, calq
partial calque: partial calque, pclq
semantic loan: semantic loan, sl, sml
phono-semantic matching: phono-semantic matching, psm
related: mention, m, m+, langname-mention, m-self, link, l, l-self, ll, ja-r, rel2, rel3, rel4, col2, col3, col4, der2, der3, der4
clipping: clipping, clipping of
back-formation: back-formation, back-form, backform, bf
onomatopoeic: onomatopoeic, onom
unknown: unknown, unk
shortening: short for
abbreviation: abbrev
alternative form: alternative form of, alt form
cognate: cognate, cog
noncognate: noncognate, noncog, ncog
morphological: affix, af
prefix: prefix, pre
confix: confix, con
infix: infix
circumfix: circumfix
suffix: suffix, suf
compound: compound, com
univerbation: univerbation, univ
blending: blending, blend
doublet: doublet, dbt
eponym: named-after
inheritance*: desc, desctree, descendant
"""
#: What flags of a descendant template make of its relation.
FLAGS = {"bor": "borrowing", "lbor": "learned borrowing", "slb": "semi-learned borrowing", "cal": "calque", "calq": "calque", "clq": "calque", "pclq": "partial calque", "sml": "semantic loan", "der": "derivation"}
NAMES = {n.strip(): t.strip() for line in RELATIONS.strip().split("\n") for t, ns in [line.split(":")] for n in ns.split(",")}
#: Templates with a source language before the target's; several targets of one language; one language and one target.
_FROM = {"derivation", "inheritance", "borrowing", "learned borrowing", "orthographic borrowing", "semi-learned borrowing", "unadapted borrowing", "calque", "partial calque", "semantic loan", "phono-semantic matching"}
_MANY = {"morphological", "prefix", "confix", "infix", "circumfix", "suffix", "compound", "univerbation", "blending", "doublet"}
_MANY_NAMES = {"rel2", "rel3", "rel4", "col2", "col3", "col4", "der2", "der3", "der4"}
#: What a target may say besides its language and term, by the parameters that say it.
FIELDS = {"t": ("t", "gloss"), "alt": ("alt",), "id": ("id",), "tr": ("tr",), "lit": ("lit",), "pos": ("pos",)}


def outermost(spans: list[tuple[int, int]]) -> list[tuple[int, int, bool]]:
    """Spans that no other contains, in order, and whether they contain others; of equal spans one."""
    out: list[tuple[int, int, bool]] = []
    for start, end in sorted(set(spans), key=lambda x: (x[0], -x[1])):
        if out and start < out[-1][1]:
            out[-1] = (*out[-1][:2], True)
        else:
            out.append((start, end, False))
    return out


def templates(text: str) -> list[tuple[int, int, str]]:
    """Outermost templates as (start, end, inside), found by matching braces; unclosed ones are left out."""
    spans, stack, i = [], [], 0
    while i < len(text) - 1:
        two = text[i : i + 2]
        if two == "{{":
            stack.append(i)
            i += 2
        elif two == "}}" and stack:
            i += 2
            spans.append((stack.pop(), i))
        else:
            jump = _BRACE.search(text, i + 1)
            i = jump.start() if jump else len(text)
    return [(a, b, text[a + 2 : b - 2]) for a, b, _ in outermost(spans)]


def arguments(inside: str) -> tuple[str, list[str], dict[str, str]]:
    """(name, positional, named) of a template; bars within links and inner templates don't separate."""
    parts, depth, at, i = [], 0, 0, 0
    while i < len(inside):
        two = inside[i : i + 2]
        if two in ("{{", "[["):
            depth, i = depth + 1, i + 2
        elif two in ("}}", "]]"):
            depth, i = depth - 1, i + 2
        else:
            if inside[i] == "|" and depth == 0:
                parts.append(inside[at:i])
                at = i + 1
            i += 1
    parts.append(inside[at:])
    pos, named = [], {}
    for p in parts[1:]:
        k, eq, v = p.partition("=")
        if eq and re.fullmatch(r"[\w -]+", k.strip()) and k.strip():
            named[k.strip()] = plain(v.strip())
        else:
            pos.append(plain(p.strip()))
    return parts[0].strip(), pos, named


def plain(text: str) -> str:
    """Links by what they show; files and categories by nothing."""
    return _LINK.sub(lambda m: "" if re.match(r"(?i)(file|image|category):", m[1]) else m[2] if m[2] is not None else m[1].split("#")[0], text)


def link_target(target: str) -> tuple[str, str | None, str | None]:
    """(text, anchor, prefix): one # parts the anchor, a known prefix the name space."""
    prefix = None
    t = target.removeprefix(":")
    head, colon, rest = t.partition(":")
    if colon and head.lower() in ("w", "wikipedia"):
        prefix, t = "wikipedia", rest
    elif colon and head in ("Image", "File", "Category", "Reconstruction", "s", "Appendix", "Thesaurus", "q"):
        prefix, t = head, rest
    if t.count("#") == 1:
        t, anchor = t.split("#")
        return t, anchor, prefix
    return t, None, prefix


@dataclass
class Stated:
    """What a template states: targets are dicts of language, term, t, alt, id, tr, lit, pos, or of an entity's name, born,
    died, nat, occ, wplink; ``targets`` None means that the origin isn't a word."""

    type: str
    uncertain: bool = False
    source: dict[str, str] = field(default_factory=dict)
    targets: list[dict[str, str]] | None = None
    text: str | None = None


def _extras(named: dict[str, str], n: int | None = None) -> dict[str, str]:
    """The fields of FIELDS, or those numbered ``n``; an empty value is none."""
    tail = "" if n is None else str(n)
    return {f: v for f, names in FIELDS.items() if (v := next((named[k + tail] for k in names if named.get(k + tail)), None))}


def _target(pos: list[str], named: dict[str, str]) -> dict[str, str]:
    """Language, term, alt and gloss by position, the rest by name; an empty alt is kept, as it means the term."""
    out = dict(zip(("language", "term", "alt", "t"), pos))
    if not out.get("t"):
        out.pop("t", None)
    return out | _extras(named)


def relation(name: str, pos: list[str], named: dict[str, str]) -> Stated | None:
    """What the template states, or None. A template of one source and targets takes its first argument as the source's
    language; flags of descendant templates name the relation."""
    kind = NAMES.get(name) or ("related" if name.endswith(("-of", " of")) else None)
    if kind is None:
        return None
    out = Stated(kind, bool(named.get("unc")))
    at = lambda i: pos[i] if len(pos) > i else None
    if kind in ("onomatopoeic", "unknown"):
        return out
    if kind.endswith("*"):
        out.type = next((t for f, t in FLAGS.items() if named.get(f)), kind[:-1])
        out.targets = [_target(pos, named)]
    elif name == "ar-root":
        out.targets = [{"language": "ar", "term": " ".join(pos)} | _extras(named)]
    elif name == "ja-r":
        term = {"term": named["linkto"], "alt": at(0) or ""} if named.get("linkto") else {"term": at(0) or ""}
        out.targets = [{"language": "ja"} | term | ({"tr": pos[1]} if at(1) else {}) | _extras(named)]
    elif kind == "eponym":
        out.source = {"language": at(0)} if at(0) else {}
        out.targets = [{"name": at(1)} | {k: named[k] for k in ("born", "died", "nat", "occ", "wplink") if named.get(k)}] if at(1) else []
    elif kind == "root":
        out.source = {"language": at(0)} if at(0) else {}
        out.targets = [{"language": at(1), "term": t} | _extras(named, i) for i, t in enumerate(pos[2:], 1) if t]
    elif kind in _MANY or name in _MANY_NAMES:
        lang = named.get("lang") or at(0)
        out.targets = [{"language": named.get(f"lang{i}", lang), "term": t} | _extras(named, i) for i, t in enumerate(pos if named.get("lang") else pos[1:], 1) if t]
    elif kind in _FROM:
        out.source = {"language": at(0)} if at(0) else {}
        out.targets = [_target(pos[1:], named)]
    else:
        out.targets = [_target(pos, named)]
    return out


def sections(text: str) -> list[tuple[list[str], str]]:
    """(heading path, text) in order; levels without holes; text before the first heading under ``<no-heading>``."""
    out, path, at, head = [], [], 0, ["<no-heading>"]
    for m in _HEADING.finditer(text):
        if text[at : m.start()].strip() or at:
            out.append((head, text[at : m.start()].strip()))
        level = min(max(0, len(m[1]) - 2), len(path))
        path = [*path[:level], plain(m[2])]
        head, at = path, m.end()
    if at or text.strip():
        out.append((head, text[at:].strip()))
    return out


_FIELDS = ("language", "term", *FIELDS, "name")
_SCHEMA = "rec_key bigint, sec_pos int, path array<string>, tpl_pos int, type string, uncertain boolean, source_language string, target boolean, " + ", ".join(f"{f} string" for f in _FIELDS)
_NAMES = ["rec_key", "sec_pos", "path", "tpl_pos", "type", "uncertain", "source_language", "target", *_FIELDS]
_TYPES = [pa.int64(), pa.int32(), pa.list_(pa.string()), pa.int32(), pa.string(), pa.bool_(), pa.string(), pa.bool_(), *(pa.string() for _ in _FIELDS)]


def extract_relations(df: DataFrame, key: Column, text: Column) -> DataFrame:
    """One row per target of each relation template of each section.

    Null and empty texts give no rows, templates without a word as target one row with ``target`` false (a phantom node).
    Repeated rows come out repeated.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for k, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                for i, (path, body) in enumerate(sections(t or ""), 1):
                    for j, (_, _, inside) in enumerate(templates(body), 1):
                        if r := relation(*arguments(inside)):
                            rows += [(k, i, path, j, r.type, r.uncertain, r.source.get("language"), bool(x), *(x.get(f) for f in _FIELDS)) for x in r.targets or [{}]]
            cols = list(zip(*rows)) if rows else [[] for _ in _NAMES]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, _TYPES)], _NAMES)

    return df.select(key.cast("bigint").alias("k"), text.alias("t")).mapInArrow(run, _SCHEMA)
