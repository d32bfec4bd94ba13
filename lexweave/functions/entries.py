"""Entries of a page: language sections, lexemes with glosses and pronunciations, sense numbers, parts of speech."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from lexweave.functions.wikitext import arguments, link_target, plain, relation, sections, templates

#: Headings that are parts of speech, morphemes or phrases.
POS = "Adjective, Adverb, Article, Conjunction, Contraction, Determiner, Interjection, Noun, Numeral, Number, Participle, Particle, Postposition, Preposition, Pronoun, Proper noun, Verb, Romanization, Letter, Symbol, Circumfix, Combining form, Infix, Interfix, Prefix, Root, Suffix, Affix, Idiom, Phrase, Proverb, Prepositional phrase".split(", ")
_POS = re.compile("(?i)^(?:" + "|".join(POS) + ")")
#: Short names of parts of speech in templates, tried in order.
_SHORT = [
    (r"adj(?:ective)?", "Adjective"), (r"adv(?:erb)?", "Adverb"), (r"n(?:oun)?|.* noun", "Noun"), (r"v(?:erb)?i?t?|.* verb", "Verb"), (r"pron(?:oun)?", "Pronoun"), (r"prep(?:osition)?", "Preposition"), (r"conj(?:unction)?", "Conjunction"), (r"int(?:erj(?:ection)?)?", "Interjection"), (r"pn|prop(?:er)?(?: noun)?|name", "Proper noun"), (r"num(?:eral)?", "Numeral"), (r"suf(?:fix)?", "Suffix"), (r"pre(?:fix)?", "Prefix"), (r"part(?:iciple)?", "Participle"),
]
_ETYMOLOGY = re.compile(r"Etym\D*(\d*)")
#: Templates of labels and of sense ids.
_LABELS, _SENSE = {"lb", "lbl", "label", "term-label", "tlb"}, {"senseid"}
_FORMATTING = re.compile(r"(''+)(.+?)\1")
_TAG = re.compile(r"<!--.*?-->|<ref\b[^<>]*/>|<ref\b.*?</ref>|</?(?!su[bp]\b)[a-z][^<>]*>", re.S)
_EXTERNAL = re.compile(r"\[https?://\S+ ([^\]]*)\]|\[https?://[^\]\s]*\]")


def clean_title(title: str, ns: int) -> str:
    """A title of the name space of reconstructions is the starred term after its language."""
    return "*" + title.split("/", 1)[1] if ns == 118 and title.startswith("Reconstruction:") and "/" in title else title


def strip_formatting(text: str) -> str:
    while (new := _FORMATTING.sub(r"\2", text)) != text:
        text = new
    return text


def without_templates(text: str) -> str:
    out, at = [], 0
    for start, end, _ in templates(text):
        out.append(text[at:start])
        at = end
    return "".join([*out, text[at:]])


def strip_etymology_header(text: str) -> str:
    return re.sub(r"\A\s*={2,6}\s*Etym[^=\n]*={2,6}[ \t]*\n?", "", text)


def template_text(inside: str) -> str:
    """What a template shows: alt or term with its annotations; several targets joined; its last argument where it states
    no relation but shows text; nothing for labels and the like."""
    name, pos, named = arguments(inside)
    if s := relation(name, pos, named):
        if s.targets is None:
            return s.type

        def one(x: dict[str, str]) -> str:
            notes = [f"{x['tr']}" if x.get("tr") else "", f"“{x['t']}”" if x.get("t") else "", f"literally “{x['lit']}”" if x.get("lit") else "", x.get("pos") or ""]
            notes = [n for n in notes if n]
            return (x.get("alt") or x.get("term") or x.get("name") or "") + (f" ({', '.join(notes)})" if notes else "")

        return (" + " if s.type in ("morphological", "compound", "prefix", "suffix", "confix", "circumfix", "infix", "univerbation", "blending") else " and ").join(one(x) for x in s.targets)
    if name in ("gloss", "gl", "non-gloss definition", "n-g", "ngd", "w", "wikipedia", "vern", "taxlink"):
        return pos[0] if pos else ""
    if name in ("qual", "qualifier", "q", "i", "sense", "s", "a", "accent"):
        return f"({', '.join(pos)})" if pos else ""
    return ""


def plain_text(text: str) -> str:
    """Wiki text as plain text: templates by what they show, links by theirs, formatting and tags (but sub and sup) gone."""
    out, at = [], 0
    text = _TAG.sub("", text)
    for start, end, inside in templates(text):
        out += [text[at:start], template_text(inside)]
        at = end
    text = _EXTERNAL.sub(lambda m: m[1] or "", "".join([*out, text[at:]]))
    return re.sub(r"[ \t]+", " ", strip_formatting(plain(text))).strip()


def any_pos(heading: str) -> bool:
    return bool(_POS.match(heading))


def canonical_pos(name: str | None) -> str | None:
    n = (name or "").strip().lower()
    return next((full for rx, full in _SHORT if re.fullmatch(rx, n)), None) or next((p for p in POS if p.lower() == n), None)


def gloss_pos(gloss: str | None) -> str | None:
    g = gloss or ""
    return "Verb" if g.startswith("to ") else "Noun" if re.match(r"(?:an?|the) ", g) else "Adverb" if g.endswith("ly") else None


def determine_pos(name: str | None, gloss: str | None) -> str | None:
    """From the template's part of speech, else from how the gloss begins or ends."""
    return canonical_pos(name) or gloss_pos(gloss)


def count_etymologies(paths: list[list[str]]) -> int:
    """Numbered or plain etymology headings right below a language or one level further."""
    return sum(2 <= len(p) <= 3 and bool(_ETYMOLOGY.fullmatch(p[-1].strip())) for p in paths)


def sense_index(path: list[str]) -> int | None:
    """The number of the first etymology heading on the path less one, 0 where it has none; None without such heading."""
    for h in path:
        if m := _ETYMOLOGY.fullmatch(h.strip()):
            return max(0, int(m[1] or 1) - 1)
    return None


@dataclass
class Gloss:
    pos: str
    text: str
    id: str | None = None
    labels: list[str] = field(default_factory=list)
    links: list[str] = field(default_factory=list)


@dataclass
class Lexeme:
    sense_idx: int
    glosses: list[Gloss] = field(default_factory=list)
    pronunciations: list[tuple[str, str | None, str]] = field(default_factory=list)
    etymid: str | None = None
    etymology: str | None = None


def make_gloss(line: str, pos: str) -> Gloss:
    """A definition line without its leading marks: labels, sense id, links and text."""
    labels, sense = [], None
    for _, _, inside in templates(line):
        name, args, _ = arguments(inside)
        if name in _LABELS:
            labels += [a for a in args[1:] if a and a != "_"]
        elif name in _SENSE and len(args) > 1:
            sense = args[1]
    links = [link_target(m.split("|")[0])[0] for m in re.findall(r"\[\[([^\[\]]*)\]\]", line)]
    return Gloss(pos, plain_text(line), sense, labels, links)


def pronunciations(body: str) -> list[tuple[str, str | None, str]]:
    """(ipa, accent, kind): kind phonemic between slashes, phonetic in brackets, else plain."""
    out = []
    for line in body.split("\n"):
        accent, found = None, []
        for start, end, inside in templates(line):
            name, args, named = arguments(inside)
            if name in ("a", "accent") and args:
                accent = ", ".join(args)
            elif name == "IPA":
                found += args if named.get("lang") else args[1:]
        rest = without_templates(line)
        found += re.findall(r"(?<!\S)(/[^/\s]+/|\[[^\[\]\s]+\])(?!\S)", rest) if accent else []
        out += [(x, accent, "phonemic" if x[:1] == "/" else "phonetic" if x[:1] == "[" else "plain") for x in found if x]
    return out


def language_entries(text: str) -> list[tuple[str, list[list[str]], list[str]]]:
    """(language, heading paths, texts) of each language of a page, in order: what stands under one top heading. A
    repeated path keeps its place and takes the later text; text before the first heading belongs to no language."""
    out: list[tuple[str, dict[tuple[str, ...], str]]] = []
    for path, body in sections(text):
        if path[0] == "<no-heading>":
            continue
        if not out or out[-1][0] != path[0]:
            out.append((path[0], {}))
        out[-1][1][tuple(path[1:])] = body
    return [(lang, [list(p) for p in d], list(d.values())) for lang, d in out]


def lexemes(paths: list[list[str]], texts: list[str]) -> list[Lexeme]:
    """The lexemes of a language entry: one per etymology heading, or one alone.

    Pronunciations hold until others are given; one before the first etymology holds for all. Definition lines are those
    that begin with one #. Several lexemes of one number are renumbered after the largest.
    """
    out: list[Lexeme] = []
    sounds: list[tuple[str, str | None, str]] = []
    for path, body in zip(paths, texts):
        head = path[-1] if path else ""
        if m := _ETYMOLOGY.fullmatch(head.strip()):
            out.append(Lexeme(max(0, int(m[1] or 1) - 1), pronunciations=sounds, etymology=body or None))
            for _, _, inside in templates(body)[:5]:
                name, args, _ = arguments(inside)
                if name == "etymid" and len(args) > 1:
                    out[-1].etymid = args[1]
        elif head.startswith("Pronunciation"):
            if found := pronunciations(body):
                sounds = found
                if out:
                    out[-1].pronunciations = found
        elif any_pos(head):
            if not out:
                out.append(Lexeme(0, pronunciations=sounds))
            out[-1].glosses += [make_gloss(x.lstrip("# "), head) for x in body.split("\n") if re.match(r"#(?![:*#])", x)]
    if not out:
        out.append(Lexeme(0, pronunciations=sounds))
    seen: set[int] = set()
    top = max(x.sense_idx for x in out)
    for x in out:
        if x.sense_idx in seen:
            top += 1
            x.sense_idx = top
        seen.add(x.sense_idx)
    return out
