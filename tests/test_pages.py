"""Entries, lexemes, sections and the relations of a page."""

import pytest
from pyspark.sql import functions as F

from lexweave.functions import entries as N
from lexweave.functions import extractors as X
from lexweave.functions.prose import Vocabulary
from lexweave.functions.wikitext import sections
from lexweave.operators import pages as P

PAGE = """{{also|x}}
==Danish==

===Pronunciation===
* {{IPA|da|/hus/|[huːs]}}
* {{a|Jutland}} [hus]

===Etymology 1===
{{etymid|da|house}}From {{inh|da|gmq-oda|hus}}, from {{der|da|non|hús||house}}, from {{der|da|gem|*husan}}. Later from {{m|nds|Hus}}.

====Noun====
{{head|da|noun}}

# {{lb|da|dated|_|law}} A [[dwelling]] or ''hall''. {{senseid|da|hall}}
#: an example
# {{gloss|rare}} Shelter

=====Derived terms=====
* [[husmand]], {{l|da|husly}} [[File:x.png]]

=====Descendants=====
* {{desc|sv|hus}}
** {{desc|fi|huusi|bor=1}}
*** {{desc|et|huus}} {{desc|lv|hūs}}
**** {{desc|lt|x}}
* plain
** {{desc|is|hús}}
See {{desc|fo|hús}}

===Etymology 2===
{{unk|da}}

====Verb====
# to [[house]]

==Dutch==
===Verb===
# to dwell
"""


def test_relations_of_a_page():
    got = [(x.name, e.src.term, e.src.language, e.tgt.term, e.tgt.language, e.type, e.mechanism) for _, _, e in X.collect("hus", sections(PAGE), {"Danish": "da"}, Vocabulary(("Danish",))) for x in [X.REGISTRY[e.mechanism.split(":")[0]]]]
    ety = [g[1:] for g in got if g[0] == "etymology"]
    assert ety == [
        ("hus", "gmq-oda", "hus", "da", "inheritance", "etymology:prose"), ("hús", "non", "hus", "gmq-oda", "derivation", "etymology:chain"), ("*husan", "gem", "hús", "non", "derivation", "etymology:chain"),
        ("Hus", "nds", "hus", "da", "origin", "etymology:prose"), (None, None, "hus", "da", "unknown", "etymology:prose"),
    ]
    assert [g[1:6] for g in got if g[0] == "links"] == [("hus", "da", "husmand", "da", "related"), ("hus", "da", "husly", "da", "related")]
    assert [g[1:6] for g in got if g[0] == "descendants"] == [
        ("hus", "da", "hus", "sv", "inheritance"), ("hus", "sv", "huusi", "fi", "borrowing"), ("huusi", "fi", "huus", "et", "inheritance"), ("huusi", "fi", "hūs", "lv", "inheritance"),
        ("hūs", "lv", "x", "lt", "inheritance"), ("hus", "da", "hús", "is", "inheritance"), ("hus", "da", "hús", "fo", "inheritance"),
    ]
    senses = {e.mechanism.split(":")[0]: (e.tgt if e.mechanism[0] == "e" else e.src).sense_idx for _, _, e in X.collect("hus", sections(PAGE), {"Danish": "da"}, Vocabulary())}
    assert senses["etymology"] == 1 and senses["links"] == 0


def test_extractors_can_be_added(spark, rows):
    @X.register("notes", "Usage notes")
    def notes(text, near, vocabulary, count):
        for word in text.split():
            yield X.Edge(near, X.Word("lexeme", word, near.language), "related", mechanism="word")

    try:
        df = spark.createDataFrame([(1, "a", "==Danish==\n===Usage notes===\nb c")], "id long, title string, t string")
        got = P.collect_relations(df, F.col("id"), F.col("title"), F.col("t"), {}, ("notes",))
        assert rows(got.select("src_term", "src_language", "tgt_term", "mechanism")) == [("a", "Danish", "b", "notes:word"), ("a", "Danish", "c", "notes:word")]
    finally:
        del X.REGISTRY["notes"]


def test_lexemes():
    (da, paths, texts), (nl, *rest) = N.language_entries(PAGE)
    assert (da, nl) == ("Danish", "Dutch") and paths[2] == ["Etymology 1"]
    one, two = N.lexemes(paths, texts)
    assert (one.sense_idx, one.etymid, two.sense_idx, two.etymid) == (0, "house", 1, None)
    assert one.pronunciations == two.pronunciations == [("/hus/", None, "phonemic"), ("[huːs]", None, "phonetic"), ("[hus]", "Jutland", "phonetic")]
    g = one.glosses[0]
    assert (g.pos, g.text, g.id, g.labels, g.links) == ("Noun", "A dwelling or hall.", "hall", ["dated", "law"], ["dwelling"]) and one.glosses[1].text == "rare Shelter"
    assert [x.text for x in two.glosses] == ["to house"] and [x.sense_idx for x in N.lexemes(*rest)] == [0]
    double = N.lexemes([["Etymology"], ["Etymology"], ["Etymology 3"], ["Etymology"]], ["a", "b", "c", "d"])
    assert [x.sense_idx for x in double] == [0, 3, 2, 4]
    assert [x.sense_idx for x in N.lexemes([], [])] == [0]


@pytest.mark.parametrize("got, want", [
    (N.clean_title("Reconstruction:Old Danish/husa", 118), "*husa"), (N.clean_title("Reconstruction:x", 0), "Reconstruction:x"), (N.strip_formatting("''a'' '''b''' '''''c'''''"), "a b c"),
    (N.without_templates("a {{b|{{c}}}} d"), "a  d"), (N.strip_etymology_header("===Etymology 2===\nFrom x"), "From x"), (N.strip_etymology_header("From x"), "From x"),
    (N.count_etymologies([["Danish"], ["Danish", "Etymology 1"], ["Danish", "Etymology 2", "Noun"], ["Danish", "A", "Etymology"], ["Etymology"]]), 2),
    (N.sense_index(["Danish", "Etymology 3", "Noun"]), 2), (N.sense_index(["Danish", "Etymology"]), 0), (N.sense_index(["Danish", "Noun"]), None),
    (N.any_pos("proper noun 2"), True), (N.any_pos("History"), False), (N.canonical_pos("adj"), "Adjective"), (N.canonical_pos("strong verb"), "Verb"), (N.canonical_pos("zzz"), None),
    (N.determine_pos(None, "to go"), "Verb"), (N.determine_pos("adv", "the end"), "Adverb"), (N.determine_pos("", "the end"), "Noun"), (N.determine_pos(None, "slowly"), "Adverb"), (N.determine_pos(None, None), None),
    (N.plain_text("''a'' {{m|da|hus||house}} <b>c</b><sup>2</sup> [https://x.y z] {{lb|da|x}}"), "a hus (“house”) c<sup>2</sup> z"), (N.plain_text("{{af|da|u-|fin|t2=nice}}"), "u- + fin (“nice”)"), (N.plain_text(""), ""),
])
def test_functions(got, want):
    assert got == want


def test_tables(spark, rows):
    data = [(1, "hus", PAGE), (1, "hus", PAGE), (2, "x", None), (3, "y", ""), (None, "z", PAGE), (4, None, "==Danish==\n===Etymology===\n{{inh|da|non|t}}"), (5, "w", "no heading [[a]] " * 30_000)]
    df = spark.createDataFrame(data, "id long, title string, t string").withColumn("rec_key", F.lit("clash")).withColumn("kind", F.lit("clash"))
    k, ti, te = F.col("id"), F.col("title"), F.col("t")
    e = P.language_entries(df, k, ti, te)
    assert rows(e.select("rec_key", "entry_pos", "language", "etym_count")) == [(1, 1, "Danish", 2)] * 2 + [(1, 2, "Dutch", 0)] * 2 + [(4, 1, "Danish", 1)]
    assert P.collect_relations(df.where("id = 1"), k, ti, te, {"Danish": "da"}).count() == 2 * 14
    assert P.collect_relations(df.where("id = 1").limit(1), k, ti, te, {"Danish": "da"}, ("links",)).count() == 2
    assert rows(P.collect_relations(df.where("id = 4"), k, ti, te, {}).select("src_term", "tgt_term", "tgt_language")) == [("t", "", "Danish")]
    assert P.lexemes(df, k, ti, te).where("rec_key = 1").count() == 6 and P.glosses(df, k, ti, te).where("rec_key = 1").count() == 8 and P.pronunciations(df, k, ti, te).where("rec_key = 1").count() == 12
    t = P.section_templates(df.where("id = 1").limit(1), k, te, frozenset({"lb"}), 3)
    assert [(r.section, r.context) for r in t.collect()] == [("Noun", "\n# {{lb|da|dated|_|law}} A ")]
    assert P.section_templates(df.where("id = 5"), k, te).where("name = 'WIKILINK'").count() == 30_000
    assert rows(P.section_texts(df.where("id = 1").limit(1), k, te, "Etym", subsections=True).select("sec_pos")) == [(k,) for k in range(4, 10)]
    assert rows(P.section_texts(df.where("id = 1").limit(1), k, te, "Etym").select("sec_pos")) == [(4,), (8,)]
    assert rows(P.section_texts(df.where("id = 1").limit(1), k, te, "Du", whole_path=True).select("sec_pos")) == [(10,), (11,)]
    for f in (P.language_entries, P.lexemes, P.glosses, P.pronunciations):
        assert f(df.limit(0), k, ti, te).count() == 0
