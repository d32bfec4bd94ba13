"""Relations of a page, section by section: which extractor reads a section, and which word its links belong to.

In etymology sections the linked word is the source and the entry's word the target; elsewhere it is the other way round.
Other ways to read sections are added with ``register``.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

from lexweave.functions.entries import sense_index
from lexweave.functions.prose import Vocabulary, chain, tokens
from lexweave.functions.wikitext import Stated, arguments, link_target, relation, templates
from lexweave.operators.ontology import is_a


@dataclass(frozen=True)
class Word:
    """One end of a relation: a lexeme, an entity or a phantom (an origin that isn't a word)."""

    kind: str = "lexeme"
    term: str | None = None
    language: str | None = None
    sense_idx: int | None = None
    extra: tuple[tuple[str, str], ...] = ()


@dataclass(frozen=True)
class Edge:
    src: Word
    tgt: Word
    type: str
    uncertain: bool = False
    text: str | None = None
    mechanism: str = ""


@dataclass
class Extractor:
    name: str
    headings: re.Pattern
    read: Callable[[str, Word, Vocabulary, Counter], Iterator[Edge]]


REGISTRY: dict[str, Extractor] = {}


def register(name: str, headings: str):
    """A function (text, word of the entry, vocabulary, counts) -> edges becomes the extractor of sections so headed."""

    def add(read):
        REGISTRY[name] = Extractor(name, re.compile(headings), read)
        return read

    return add


def extractor_of(heading: str, names: tuple[str, ...] | None = None, registry: dict[str, Extractor] | None = None) -> Extractor | None:
    return next((x for n, x in (REGISTRY if registry is None else registry).items() if (names is None or n in names) and x.headings.fullmatch(heading)), None)


def word_of(target: dict[str, str], near: Word) -> Word:
    """A target as a word; what it leaves open, term or language, it takes from the word it is related to."""
    extra = tuple(sorted((k, v) for k, v in target.items() if v and k not in ("term", "language", "name")))
    if "name" in target:
        return Word("entity", target["name"], None, None, extra)
    return Word("lexeme", target.get("term") or near.term, target.get("language") or near.language, None, extra)


def relate(stated: Stated, near: Word, near_is_source: bool, mechanism: str) -> list[Edge]:
    """The edges between ``near`` and the targets of a statement; a statement without target has a phantom."""
    others = [Word("phantom")] if stated.targets is None else [word_of(t, near) for t in stated.targets]
    return [Edge(*((near, o) if near_is_source else (o, near)), stated.type, stated.uncertain, stated.text, mechanism) for o in others]


def _stated(inside: str) -> Stated | None:
    return relation(*arguments(inside))


def _linked(title: str) -> Stated | None:
    """A plain link: a related word, its language that of the anchor if there is one; files and the like are none."""
    term, anchor, prefix = link_target(title.split("|")[0])
    if prefix is not None or not term:
        return None
    return Stated("related", targets=[{"term": term} | ({"language": anchor} if anchor else {})])


def baseline(text: str, near: Word, near_is_source: bool) -> Iterator[Edge]:
    """Every outermost template that states a relation."""
    for _, _, inside in templates(text):
        if s := _stated(inside):
            yield from relate(s, near, near_is_source, "template")


@register("links", r"(?:Related|Derived) terms|See also")
def links(text: str, near: Word, vocabulary: Vocabulary, count: Counter) -> Iterator[Edge]:
    """Templates and links, neither within the other."""
    for t in tokens(text):
        s = _stated(t.text) if t.kind == "t" else _linked(t.text) if t.kind == "k" else None
        if s:
            yield from relate(s, near, True, "template" if t.kind == "t" else "link")


_ITEM = re.compile(r"^([*#:;]+)[ \t]*(.*)$")


def list_items(text: str) -> Iterator[tuple[int, str]]:
    """(depth, text) of every line: depth 0 is no list item, else the number of its marks."""
    for line in text.split("\n"):
        m = _ITEM.match(line)
        yield (len(m[1]), m[2]) if m else (0, line)


@register("descendants", r"Descendants")
def descendants(text: str, near: Word, vocabulary: Vocabulary, count: Counter) -> Iterator[Edge]:
    """Lists of descendants: the one word an item names is what its sublist descends from; an item without template
    leaves its sublist to the word above it. Templates outside lists belong to the entry's word."""
    above: list[tuple[int, Word]] = []
    for depth, line in list_items(text):
        if not depth:
            if line.strip():
                above = []
                yield from baseline(line, near, True)
            continue
        while above and above[-1][0] >= depth:
            above.pop()
        from_ = above[-1][1] if above else near
        sub = from_
        for _, _, inside in templates(line):
            if s := _stated(inside):
                edges = relate(s, from_, True, "list")
                yield from edges
                if len(edges) == 1 and edges[0].tgt.kind == "lexeme":
                    sub = edges[0].tgt
        above.append((depth, sub))


@register("etymology", r"Etym\D*\d*")
def etymology(text: str, near: Word, vocabulary: Vocabulary, count: Counter, first_sentence: bool = True, after_from: bool = True) -> Iterator[Edge]:
    """Prose: in the first sentence, what follows a further "from" is the origin of the origin before it, not of the entry's
    word; roots and compounds aren't links of such a chain."""
    last, sentence = None, 1
    ready = not after_from
    for t in chain(text, vocabulary, count):
        if t.kind == "T":
            chained = last is not None and ready and (sentence == 1 or not first_sentence)
            edges = relate(t.stated, last if chained else near, False, "chain" if chained else "prose")
            count["chained" if chained else "direct"] += len(edges)
            yield from edges
            if len(edges) == 1 and edges[0].src.kind == "lexeme" and is_a(edges[0].type, "origin") and not is_a(edges[0].type, "root"):
                last, ready = edges[0].src, not after_from
        elif t.kind == "." and t.text == ".":
            last, sentence, ready = None, sentence + 1, not after_from
        elif t.kind == "F":
            ready = True


def collect(title: str, parts: list[tuple[list[str], str]], codes: dict[str, str], vocabulary: Vocabulary, names: tuple[str, ...] | None = None, registry: dict[str, Extractor] | None = None) -> Iterator[tuple[int, int, Edge]]:
    """(section, place, edge) of all sections of a page that some extractor reads, in order.

    The entry's word is the page's title in the language of the top heading (its code where ``codes`` has one), the sense
    that of the etymology heading above the section, or of the last one before it, or 0.
    """
    sense, lang = 0, None
    count: Counter = Counter()
    for i, (path, body) in enumerate(parts, 1):
        if path[0] != lang:
            lang, sense = path[0], 0
        here = sense_index(path)
        sense = sense if here is None else here
        if (x := extractor_of(path[-1], names, registry)) is None:
            continue
        near = Word("lexeme", title, codes.get(lang, lang), sense)
        language = lambda w: Word(w.kind, w.term, codes.get(w.language, w.language), w.sense_idx, w.extra)
        for k, e in enumerate(x.read(body, near, vocabulary, count), 1):
            yield i, k, Edge(language(e.src), language(e.tgt), e.type, e.uncertain, e.text, f"{x.name}:{e.mechanism}")
