import pytest

from lexweave.functions import wikitext as W
from lexweave.sources import graph_files


def stated(text):
    ((_, _, inside),) = W.templates(text)
    return W.relation(*W.arguments(inside))


def target(**fields):
    return fields


@pytest.mark.parametrize("text, kind, targets", [
    ("{{der|nl|la|murus}}", "derivation", [target(language="la", term="murus")]),
    ("{{bor|fi|sv|torg|t=market square}}", "borrowing", [target(language="sv", term="torg", t="market square")]),
    ("{{lbor|pt|grc|βίος|gloss=life, way of living|nocat=1}}", "learned borrowing", [target(language="grc", term="βίος", t="life, way of living")]),
    ("{{inh|cs|zlw-ocs|voda||water}}", "inheritance", [target(language="zlw-ocs", term="voda", alt="", t="water")]),
    ("{{desc|lv|māls|lbor=1}}", "learned borrowing", [target(language="lv", term="māls")]),
    ("{{desc|da|glas}}", "inheritance", [target(language="da", term="glas")]),
    ("{{desc|et|aken|cal=1|unc=1}}", "calque", [target(language="et", term="aken")]),
    ("{{bf|af|wintel|t=to roll|id=roll|nocap=1}}", "back-formation", [target(language="af", term="wintel", t="to roll", id="roll")]),
    ("{{cog|sl|hiša|tr=hisha|lit=roofed|pos=noun}}", "cognate", [target(language="sl", term="hiša", tr="hisha", lit="roofed", pos="noun")]),
    ("{{onom|hu|nocap=1}}", "onomatopoeic", None), ("{{unk|eu}}", "unknown", None),
    ("{{short for|ko|대학교|tr=daehakgyo}}", "shortening", [target(language="ko", term="대학교", tr="daehakgyo")]),
    ("{{short for|ca|bicicleta||[[two wheels]]}}", "shortening", [target(language="ca", term="bicicleta", alt="", t="two wheels")]),
    ("{{af|sv|o-|t1=un-|klar|gloss2=clear|id2=bright}}", "morphological", [target(language="sv", term="o-", t="un-"), target(language="sv", term="klar", t="clear", id="bright")]),
    ("{{compound|de|lang2=en|Haus|boat}}", "compound", [target(language="de", term="Haus"), target(language="en", term="boat")]),
    ("{{named-after|it|nat=Scottish|occ=engineer|James Watt|wplink=1|born=1736|died=1819}}", "eponym", [target(name="James Watt", born="1736", died="1819", nat="Scottish", occ="engineer", wplink="1")]),
    ("{{root|no|gem|*drink|*fall|id2=drop}}", "root", [target(language="gem", term="*drink"), target(language="gem", term="*fall", id="drop")]),
    ("{{ar-root|ك|ت|ب}}", "root", [target(language="ar", term="ك ت ب")]),
    ("{{ja-r|明るい|あかるい|t=bright}}", "related", [target(language="ja", term="明るい", tr="あかるい", t="bright")]),
    ("{{ja-r|旅する|linkto=旅}}", "related", [target(language="ja", term="旅", alt="旅する")]),
    ("{{col3|mt|dar|bieb|saqaf}}", "related", [target(language="mt", term=t) for t in ("dar", "bieb", "saqaf")]),
    ("{{plural of|en|ox}}", "related", [target(language="en", term="ox")]),
])
def test_templates(text, kind, targets):
    got = stated(text)
    assert (got.type, got.targets) == (kind, targets)


def test_source_and_uncertainty():
    s = stated("{{bor|fi|sv|torg|unc=1}}")
    assert s.source == {"language": "fi"} and s.uncertain and stated("{{nothing|like|it}}") is None


def test_structure():
    assert W.link_target("wikipedia:de:Haus") == ("de:Haus", None, "wikipedia") and W.link_target(":Appendix:x") == ("x", None, "Appendix")
    assert W.link_target("ship#Dutch") == ("ship", "Dutch", None) and W.link_target("ship#a#b")[1] is None and W.link_target("odd:thing")[0] == "odd:thing"
    assert W.plain("[[tree]] [[tree#Noun]] [[tree|trees]] [[File:x.png|thumb]]") == "tree tree trees "
    assert [p for p, _ in W.sections("lead\n==Top==\n=====Deep=====\ny\n===Next===\n")] == [["<no-heading>"], ["Top"], ["Top", "Deep"], ["Top", "Next"]]
    assert [t for _, _, t in W.templates("{{p|{{q|r}}}} {{open {{s}}")] == ["p|{{q|r}}", "s"]
    assert len(W.templates("{{" * 200_000)) == 0


def test_outermost():
    assert W.outermost([(5, 9), (0, 10), (12, 14), (12, 14), (2, 3)]) == [(0, 10, True), (12, 14, False)]
    assert W.outermost([]) == []


def test_read_pages_and_triples(spark, tmp_path):
    (tmp_path / "d.xml").write_text("<mediawiki><page><title>oak</title><ns>0</ns><id>7</id><revision><id>5</id><timestamp>2020-01-01T00:00:00Z</timestamp><contributor><ip>1.2.3.4</ip></contributor><minor /><text></text></revision><revision><id>6</id><text>x</text></revision></page></mediawiki>")
    (p,) = graph_files.read_pages(spark, str(tmp_path / "d.xml")).collect()
    assert (p.title, [r.minor for r in p.revision], [r.text for r in p.revision]) == ("oak", [True, False], ["", "x"])
    e = spark.createDataFrame([("a b#en#0", "c#fr#0", "borrowing")], "src string, tgt string, type string")
    assert graph_files.triples(e).count() == 3
