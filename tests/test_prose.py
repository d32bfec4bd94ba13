"""Sequences of typed tokens and the rules over them."""

from collections import Counter

import pytest

from lexweave.functions import prose as P

V = P.Vocabulary(("Danish", "West Danish", "Old Saxon", "Latin", "sign", "Ka"))


def kinds(text):
    return "".join(t.kind for t in P.annotated(text, V))


def made(text):
    """(type, uncertain, targets) of the relations a text states."""
    return [(t.stated.type, t.stated.uncertain, t.stated.targets) for t in P.chain(text, V) if t.kind == "T"]


def test_tokens():
    assert [(t.kind, t.text) for t in P.tokens("see ''stone'', '''or''' <!-- no -->[[wall|walls]]<ref>x</ref> {{m|en|x}} {{open")] == [
        ("w", "see"), ("I", "start"), ("w", "stone"), ("I", "end"), ("w", ","), ("B", "start"), ("w", "or"), ("B", "end"), ("k", "wall|walls"), ("t", "m|en|x"), ("w", "{{open")]
    assert [t.kind for t in P.tokens("''[[a]]''")] == ["I", "k", "I"]
    assert P.tokens("") == [] and len(P.tokens("{{" * 100_000 + "''x''")) > 0


@pytest.mark.parametrize("text, want", [
    ("Danish word for ''hus''", "LwwIwI"), ("In [[Danish]] West Danish signs", "wLLw"), ("a sign of Ka", "wwww"), ("Perhaps old, possibly new", "Uw.Uw"), ("From a, thence from b", "Fw.wFw"),
    ("''a''+''b''", "IwIPIwI"), ("Stop, go!? so.", "w.w.w."), ("the feminine plural of ''x'', an old genitive singular of y", "wXIwI.wXw"), ("by {{w|Place|lang=sv}} and [[w:no:Hill]]", "wKwK"),
    ('say "one" and ``two`` and "three', "wqwqwqwqwqw"), ("literally (x)", "l(w)"), ("built by Anna van Berg.", "wwN."), ("built by J. R. Berg", "wwN"), ("borrowed from it", "RFw"), ("of unknown origin", "R"), ("imitative", "R"), ("named for him", "Rw"),
])
def test_annotated(text, want):
    assert kinds(text) == want


def test_encyclopedia_languages():
    assert [t.data["lang"] for t in P.encyclopedia(P.tokens("{{w|Place|lang=sv}} [[w:no:Hill]] [[w:Hill]] [[x:y]]")) if t.kind == "K"] == ["sv", "no", "en"]


@pytest.mark.parametrize("text, want", [
    ("''wagi'' (\"a way\")", [("related", False, [{"term": "wagi", "t": "a way"}])]),
    ("'''[[wega#Old Saxon|wēga]]''' \"road\" + '''[[bord]]'''", [("morphological", False, [{"term": "wēga", "anchor": "Old Saxon", "t": "road"}, {"term": "bord"}])]),
    ("Compare West Danish ''[[vej]]'', Latin ''[[via]]'', Old Saxon ''weg''.", [("related", False, [{"term": w, "language": x}]) for w, x in (("vej", "West Danish"), ("via", "Latin"), ("weg", "Old Saxon"))]),
    ("From ''stolm''", [("origin", False, [{"term": "stolm"}])]), ("from Latin ''stella'', literally \"small light\"", [("origin", False, [{"term": "stella", "language": "Latin", "lit": "small light"}])]),
    ("a dative plural of ''skip''", [("origin", False, [{"term": "skip"}])]), ("borrowed Latin ''vinum''", [("borrowing", False, [{"term": "vinum", "language": "Latin"}])]),
    ("Perhaps from ''grund''", [("origin", True, [{"term": "grund"}])]), ("Maybe {{cog|da|vind}}", [("cognate", True, [{"language": "da", "term": "vind"}])]),
    ("Named after the miller Jan de Wit.", [("eponym", False, [{"name": "Jan de Wit"}])]), ("named after Mr Some Body of [[w:sv:Lake]]", [("eponym", False, [{"name": "Lake", "wplink": "Lake"}])]),
    ("{{etyl|la|da}} ''pons''", [("origin", False, [{"language": "la", "term": "pons"}])]), ("{{m|da|kat}}", [("related", False, [{"language": "da", "term": "kat"}])]), ("{{col2|da|a|b}}", [("related", False, [{"language": "da", "term": "a"}, {"language": "da", "term": "b"}])]),
    ("nothing here", []), ("", []),
])
def test_rules(text, want):
    assert made(text) == want


def test_compound_of_templates_within_words():
    text = "Literally “to [[hold]] a [[line]] together”, from {{m|da|holde||to [[hold]]}} + {{m|da|fast||firm}} + plural of {{m|da|line||rope}} + dative of {{m|da|hånd||hand}}."
    seq = P.chain(text, V)
    assert [(t.kind, t.text) for t in seq[:4]] == [("l", "Literally"), ("g", "to hold a line together"), (".", ","), ("F", "from")]
    assert seq[4].stated.type == "morphological" and [x["t"] for x in seq[4].stated.targets] == ["to hold", "firm", "rope", "hand"]
    assert len(seq) == 6 and seq[5].text == "."


def test_counts_order_and_text():
    count = Counter()
    P.chain("From ''a'', maybe from ''b'' + ''c''", V, count)
    assert count["from"] == 1 and count["compound"] == 1 and count["mention"] == 3
    P.check_order(P.RULES)
    with pytest.raises(ValueError):
        P.check_order([r for r in P.RULES if r.name != "mention"])
    assert P.as_text(P.annotated("From [[oak|oaks]] , ''in'' {{m|en|x|alt}}.", V)) == "From oaks, in alt."
