"""Relations out of prose: etymologies as sequences of typed tokens, and rules over the sequence of their types.

A text is read into tokens in order. Every token has a one-letter type, so the types of a text are a string, and a rule
is a regular expression over that string with a function that makes one token of those it matched: a language, a word in
italics and a gloss in brackets become a mention, mentions joined by + a compound, "from" with a mention an origin. What a
rule is made for stands in its expression: how far it looks, and what ends the look.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

from lexweave.functions.wikitext import NAMES, Stated, arguments, link_target, plain, relation, templates

#: Types: w word, I and B the ends of italics and bold, k link, t other template, L language, F from, P plus, . punctuation,
#: ( and ) brackets, q quotation mark, l "literally", U uncertain, R relation word, X "... of" phrase, N name, K encyclopedia
#: link, E language template, m and g what may be a mention or a gloss, M mention, T relation with targets.
TYPES = "wIBktLFP.()qlURXNKEmgMT"


@dataclass
class Token:
    kind: str
    text: str = ""
    data: dict[str, str] = field(default_factory=dict)
    stated: Stated | None = None


@dataclass
class Vocabulary:
    """What the rules know beside themselves: names of languages (longest first) and which to pass over."""

    languages: tuple[str, ...] = ()
    #: Names that are rather words.
    skip: frozenset[str] = frozenset(["Are", "sign", "isolate", "mixed", "not a family", "constructed", "substrate"])

    def __post_init__(self) -> None:
        names = sorted({n for n in self.languages if len(n) > 2 and n not in self.skip}, key=lambda n: (-len(n), n))
        self.pattern = re.compile(r"\b(?:" + "|".join(map(re.escape, names)) + r")\b") if names else None


_MARKUP = re.compile(r"<!--.*?(?:-->|\Z)|<ref\b[^<>]*/>|<ref\b[^<>]*>.*?</ref\s*>|</?[A-Za-z][^<>]*>|\{\{|\[\[[^\[\]]*\]\]|'{5}|'''|''", re.S)


def tokens(text: str) -> list[Token]:
    """Strings, links, templates and the ends of italics and bold, in order; comments, notes and tags are dropped."""
    out, at, i = [], 0, 0
    opened = {"I": False, "B": False}

    def words(s: str) -> None:
        if s.strip():
            out.append(Token("w", " ".join(s.split())))

    closed = {start: end for start, end, _ in templates(text)}
    while m := _MARKUP.search(text, i):
        mark, end = m[0], m.end()
        if mark == "{{":
            if m.start() not in closed:  # two braces
                i = end
                continue
            end = closed[m.start()]
        words(text[at : m.start()])
        if mark == "{{":
            out.append(Token("t", text[m.start() + 2 : end - 2]))
        elif mark[0] == "[":
            out.append(Token("k", mark[2:-2]))
        elif mark[0] == "'":
            for kind in {"''": "I", "'''": "B", "'''''": "IB"}[mark]:
                opened[kind] = not opened[kind]
                out.append(Token(kind, "start" if opened[kind] else "end"))
        at = i = end
    words(text[at:])
    return out


def shown(t: Token) -> str:
    """The text of a token as a reader sees it."""
    if t.kind == "k":
        return plain(f"[[{t.text}]]")
    if t.kind == "t":
        s = relation(*arguments(t.text))
        return " and ".join(x.get("alt") or x.get("term") or x.get("name") or "" for x in s.targets or []) if s else ""
    return "" if t.kind in "IB" else t.text


def as_text(seq: Iterable[Token]) -> str:
    """A sequence as plain text."""
    return re.sub(r" ([.,;!?)])", r"\1", " ".join(x for t in seq if (x := shown(t))))


# annotators: parts of strings, and links that show just such a part, become tokens of a type


def annotate(seq: list[Token], pattern: re.Pattern | None, kind: str, group: int = 0, **data: str) -> list[Token]:
    out = []
    for t in seq:
        if pattern is None or t.kind not in "wk":
            out.append(t)
        elif t.kind == "k":
            m = pattern.fullmatch(shown(t))
            out.append(Token(kind, m[group], dict(data)) if m else t)
        else:
            at = 0
            for m in pattern.finditer(t.text):
                if m.start(group) < at:
                    continue
                if before := t.text[at : m.start(group)].strip():
                    out.append(Token("w", before))
                out.append(Token(kind, m[group], dict(data)))
                at = m.end() if group == 0 or m.end() > m.end(group) and kind == "X" else m.end(group)
            if rest := t.text[at:].strip():
                out.append(Token("w", rest))
    return out


#: The words, marks and forms of names that types are told by.
_UNCERTAIN, _FROM = re.compile(r"\b(?:maybe|possibly|probably|perhaps)\b", re.I), re.compile(r"\bfrom\b", re.I)
_PLUS, _PUNCT = re.compile(r"\+"), re.compile(r"[.,;!?]+")
_LITERALLY, _QUOTES = re.compile(r"\bliterally\b", re.I), re.compile("[\"“”‘`]+|(?<!\\w)'+|'+(?!\\w)")
_NAME = re.compile(r"(?<=.)[A-Z]\w*\.?(?: (?:van|of|de|von))?(?: [A-Z](?:\w+|\.)(?:\.(?= [A-Z]))?)+")
#: Words for a relation beside the names of templates; the weaker "origin" stands for derivation, which prose can't tell.
_WORDS = [
    ("shortening", r"shorten(?:ed|ing)\b"), ("eponym", r"\bnamed (?:after|for)\b"), ("unknown", r"\b(?:(?:of|origin) )?(?:uncertain|unknown|unclear)(?: (?:origin|descent))?"),
    ("onomatopoeic", r"\b(?:onomato|imitat)[a-z]+\b"), ("abbreviation", r"abbreviation"), ("related", r"\b(?:related to|see|compare)\b"),
]
_BY_TYPE: dict[str, list[str]] = {}
for _n, _t in NAMES.items():
    if len(_n) > 3 and not _n[-1].isdigit() and "-r" not in _n:
        _BY_TYPE.setdefault("origin" if _t == "derivation" else _t.rstrip("*"), []).append(_n)
_RELATIONS = [(t, re.compile(p, re.I)) for t, p in _WORDS]
_RELATIONS += [(t, re.compile(r"\b(?:" + "|".join(sorted(map(re.escape, {*ns, t}), key=lambda x: (-len(x), x))) + r")\b", re.I)) for t, ns in _BY_TYPE.items() if t not in ("related", "root", "unknown")]
#: Phrases like "feminine plural of" are built by this rule: any number of qualities before a form.
_QUALITIES = "active alternative archaic augmentative common comparative dative deliberate dialectal diminutive euphemistic feminine first-person future genitive accusative nominative vocative imperative imperfect indicative inflected irregular masculine medieval neuter nonstandard obsolete old past passive perfect plural present rare second-person short singular strong subjunctive superlative third-person verbal vulgar weak".split()
_FORMS = "abbreviation alteration clipping comparative compound contraction corruption dative derivative diminutive duplication ellipsis feminine form genitive gerund infinitive initialism inflection misspelling nominalization participle plural pronunciation reduplication respelling shortening singular spelling superlative supine synonym translation transliteration variant".split()
_OF = re.compile(r"\b((?:(?:" + "|".join(_QUALITIES) + r") )*(?:" + "|".join(_FORMS) + r")s?) of\b", re.I)


def encyclopedia(seq: list[Token]) -> list[Token]:
    """Links and templates that lead to an encyclopedia, with the language of it."""
    out = []
    for t in seq:
        if t.kind == "t":
            name, pos, named = arguments(t.text)
            if name in ("w", "wikipedia") and pos:
                t = Token("K", pos[0], {"lang": named.get("lang", "en")})
        elif t.kind == "k":
            parts = t.text.split("|")[0].split(":")
            if parts[0] == "w" and 1 < len(parts) < 4:
                t = Token("K", parts[-1], {"lang": parts[1] if len(parts) == 3 else "en"})
        out.append(t)
    return out


def quotes(seq: list[Token]) -> list[Token]:
    """Quotation marks, opening and closing in turn."""
    out = annotate(seq, _QUOTES, "q")
    n = 0
    for t in out:
        if t.kind == "q":
            t.data["end"], n = ("start", "end")[n % 2], n + 1
    return out


def statements(seq: list[Token]) -> list[Token]:
    """Templates as the relations they state; a language template by its language. Others stay."""
    out = []
    for t in seq:
        if t.kind == "t":
            name, pos, named = arguments(t.text)
            if name == "etyl":
                t = Token("E", pos[0] if pos else "", {"language": pos[0]} if pos else {})
            elif s := relation(name, pos, named):
                t = Token("T", as_text([t]), stated=s)
        out.append(t)
    return out


def split_words(seq: list[Token]) -> list[Token]:
    return [x for t in seq for x in ([Token("w", w) for w in t.text.split()] if t.kind == "w" else [t])]


# rules over the string of types


@dataclass
class Rule:
    """``make`` turns the tokens of each match of ``pattern``, with the match, into tokens; None leaves them."""

    name: str
    pattern: re.Pattern
    make: Callable[[list[Token], re.Match], list[Token] | None]

    def __call__(self, seq: list[Token], count: Counter) -> list[Token]:
        kinds = "".join("m" if t.kind == "T" and self.name == "mention" and _plain_link(t) else t.kind for t in seq)
        out, at = [], 0
        for m in self.pattern.finditer(kinds):
            if m.end() == m.start():
                continue
            made = self.make(seq[m.start() : m.end()], m)
            if made is not None:
                out += seq[at : m.start()] + made
                at = m.end()
                count[self.name] += 1
        return out + seq[at:]


def _plain_link(t: Token) -> bool:
    """A relation that is no more than a mention: one related word."""
    return t.stated is not None and t.stated.type == "related" and len(t.stated.targets or []) == 1


def _maybe_mention(ts: list[Token], m: re.Match) -> list[Token]:
    links = [t for t in ts if t.kind == "k"]
    anchor = link_target(links[0].text.split("|")[0])[1] if len(links) == 1 else None
    return [Token("m", as_text(ts), {"anchor": anchor} if anchor else {})]


def _maybe_gloss(ts: list[Token], m: re.Match) -> list[Token] | None:
    inner = [t for t in ts if t.kind not in "q()"]
    said = as_text(t for t in inner if t.kind != "l")
    if not said:
        return None
    literally = [t for t in inner if t.kind == "l"]
    return [*literally, Token("g", said)]


def _mention(ts: list[Token], m: re.Match) -> list[Token]:
    main = ts[m.start("m") - m.start()]
    about = dict(main.stated.targets[0]) if main.stated else {"term": main.text} | main.data
    if m["lang"] and "language" not in about:
        about["language"] = ts[0].text
    if m["gloss"]:
        about["lit" if "l" in m["right"] else "t"] = ts[-1].text
    return [Token("M", main.text, about)]


def _made(kind: str, targets: list[dict[str, str]], ts: list[Token], text: str | None = None) -> list[Token]:
    return [Token("T", as_text(ts), stated=Stated(kind, targets=targets, text=text))]


def _relation(ts: list[Token], m: re.Match) -> list[Token]:
    head, last = ts[0], ts[-1]
    kind = "origin" if head.kind == "X" else head.data["type"]
    if last.kind == "M":
        return _made(kind, [last.data], ts, head.text if head.kind == "X" else None)
    return [Token("T", last.text, stated=Stated(kind, last.stated.uncertain, last.stated.source, last.stated.targets, head.text if head.kind == "X" else None))]


def _named_after(ts: list[Token], m: re.Match) -> list[Token] | None:
    if ts[0].data.get("type") != "eponym":
        return None
    who = next((t for k in "KN" for t in ts if t.kind == k), None)
    at = next(i for i, t in enumerate(ts) if t is who)
    entity = {"name": who.text} | ({"wplink": who.text} if who.kind == "K" else {})
    return [*_made("eponym", [entity], ts[: at + 1]), *ts[at + 1 :]]


def _etyl(ts: list[Token], m: re.Match) -> list[Token]:
    last = ts[-1]
    about = last.data if last.kind == "M" else {"term": shown(last)}
    return _made("origin", [ts[0].data | {k: v for k, v in about.items() if k != "language" or not ts[0].data}], ts)


def _uncertain(ts: list[Token], m: re.Match) -> list[Token]:
    ts[-1].stated.uncertain = True
    return ts[1:]


def _fallback(ts: list[Token], m: re.Match) -> list[Token]:
    return _made("related", [ts[0].data], ts)


_r = re.compile
#: In this order.
RULES = [
    Rule("maybe mention", _r(r"[IB]+(?:[kwLN]|(?:[wk]+))[IB]+|k"), _maybe_mention),
    Rule("maybe gloss", _r(r"\((?:q?[^()qMmT]+q?)\)|q[^q]+q"), _maybe_gloss),
    Rule("mention", _r(r"(?P<lang>L[^LP.mgMT]?)?(?P<m>m)(?P<right>(?:[^mPgMT]{0,2})(?P<gloss>g))?"), _mention),
    Rule("compound", _r(r"M(?:[^MTP.]{0,3}P[^MTP.]{0,3}M)+"), lambda ts, m: _made("morphological", [t.data for t in ts if t.kind == "M"], ts)),
    Rule("language template", _r(r"E[^EMk.]{0,3}[Mk]"), _etyl),
    Rule("from", _r(r"F[^FMTP.RX]?M"), lambda ts, m: _made("origin", [ts[-1].data], ts)),
    Rule("relation", _r(r"[RX][^RXPMT.]{0,2}M"), _relation),
    Rule("named after", _r(r"R[^R.KN]{0,7}[KN](?:[^R.K]{0,7}K)?"), _named_after),
    Rule("uncertain", _r(r"U[^UT.]{0,2}T"), _uncertain),
    Rule("fallback", _r(r"M"), _fallback),
]
#: A gloss starts inside its bracket, so quotation marks at its ends go with it.
REQUIRES = {"mention": {"maybe mention", "maybe gloss"}, "compound": {"mention"}, "from": {"mention"}, "relation": {"mention"}, "uncertain": {"from", "relation", "compound"}, "fallback": {"mention"}}


def check_order(rules: Iterable[Rule]) -> None:
    """An error if a rule comes before one it needs."""
    seen: set[str] = set()
    for r in rules:
        if missing := REQUIRES.get(r.name, set()) - seen:
            raise ValueError(f"{r.name} needs {', '.join(sorted(missing))} before it")
        seen.add(r.name)


def annotated(text: str, vocabulary: Vocabulary) -> list[Token]:
    """The tokens of a text with all types that stand by themselves, before any rule."""
    seq = encyclopedia(tokens(text))
    seq = annotate(seq, vocabulary.pattern, "L")
    seq = quotes(seq)
    seq = annotate(annotate(seq, re.compile(r"\("), "("), re.compile(r"\)"), ")")
    for pattern, kind in ((_LITERALLY, "l"), (_UNCERTAIN, "U"), (_FROM, "F"), (_PLUS, "P")):
        seq = annotate(seq, pattern, kind)
    seq = annotate(seq, _OF, "X", 1)
    for kind, pattern in _RELATIONS:
        seq = annotate(seq, pattern, "R", type=kind)
    seq = annotate(seq, _NAME, "N")
    seq = annotate(seq, _PUNCT, ".")
    return split_words(statements(seq))


def chain(text: str, vocabulary: Vocabulary, count: Counter | None = None, rules: Iterable[Rule] = RULES) -> list[Token]:
    """The tokens of a text after all rules; ``count`` gets how often each rule was used."""
    count = Counter() if count is None else count
    seq = annotated(text, vocabulary)
    for rule in rules:
        seq = rule(seq, count)
    return seq
