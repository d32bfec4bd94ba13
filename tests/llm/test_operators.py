"""Each operator on nulls, empty and long texts, ties, repeated rows, empty tables and clashing column names."""

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lexweave.llm import distinct, frequency, leakage, lookalike, markup, packing, readability

COMBOS = {"a": (1, "any"), "b": (2, "any"), "all": (3, "any"), "both": (3, "all")}


def test_distinct_counts_exactly_and_in_pieces(spark, rows):
    rnd = random.Random(1)
    data = [(rnd.choice("xy"), "hot" if rnd.random() < 0.4 else str(rnd.randrange(80)), rnd.random() < 0.5) for _ in range(900)] + [("x", None, True), ("y", "1", None), ("y", "1", None)]
    df = spark.createDataFrame(data, "k string, who string, m boolean").withColumn("bucket", F.lit("clash")).withColumn("mask", F.lit(9))
    part = lambda d: distinct.partial(d, F.col("who"), {"k": F.col("k")}, {"a": ~F.col("m"), "b": F.col("m")}, 16)
    want = []
    for k in "xy":
        a, b = ({w for q, w, m in data if q == k and w is not None and m is f} for f in (False, True))
        want.append((k, len(a), len(b), len(a | b), len(a & b), 0.0))
    assert rows(distinct.totals(part(df), COMBOS)) == want
    pieces = [part(df.where(F.col("who").isNull() | (F.length("who") == n))) for n in (1, 2, 3)]
    assert rows(distinct.totals(distinct.merge(*pieces, part(df)), COMBOS)) == want
    assert distinct.totals(part(df.limit(0)), COMBOS).count() == 0


def test_distinct_estimate_is_near(spark):
    df = spark.range(20000).select(F.lit("x").alias("k"), F.col("id").cast("string").alias("who"))
    p = distinct.partial(df, F.col("who"), {"k": F.col("k")}, {"a": F.lit(True)}, 64)
    (r,) = distinct.totals(p, {"a": (1, "any")}, 64, estimate_from=16).collect()
    assert abs(r.a - 20000) < 5 * r.rel_error * 20000 and 0 < r.rel_error < 0.05


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.tuples(st.integers(0, 65535), st.integers(1, 9)), min_size=1, max_size=30), min_size=1, max_size=4))
def test_containers_unite(parts):
    packed, want = [], {}
    for p in parts:
        d = {}
        for pos, occ in p:
            d[pos] = max(d.get(pos, 0), occ)
            want[pos] = max(want.get(pos, 0), occ)
        k = np.array(sorted(d))
        packed.append(frequency.pack(k, np.array([d[x] for x in k])))
    pos, occ = frequency.unpack(*frequency.union(packed))
    assert dict(zip(pos.tolist(), occ.tolist())) == want


def test_dense_container():
    pos = np.arange(0, 65536, 3)
    p, o = frequency.unpack(*frequency.pack(pos, np.full(len(pos), 2)))
    assert (p == pos).all() and (o == 2).all()


def test_frequencies(spark, monkeypatch):
    data = [("m", i, 2) for i in range(70000, 70050)] * 2 + [("rare", 1, 1), ("rare", 2, 5), ("mid", 3, 1), ("mid", 4, 1), ("mid", 5, 1), ("", 6, 1), (None, 7, 1), ("m", None, 1)]
    df = spark.createDataFrame(data, "v string, rec long, n long").withColumn("hi", F.lit("clash")).withColumn("body", F.lit(1)).repartition(5)
    got = {r.val: (r.n_occurrences, r.n_records, r.band) for r in frequency.frequencies(df, F.col("v"), F.col("rec"), F.col("n"), 100, 2, 0.1).collect()}
    assert got == {"m": (100, 50, "common"), "rare": (6, 2, "rare"), "mid": (3, 3, None), "": (1, 1, "rare")}
    # record 1 comes twice, once with an unnamed value first: its counts are added up within a delivery, not across
    again = spark.createDataFrame([("a", 1, 1, True), ("a", 1, 2, False), (None, 1, 1, True), ("a", 1, 2, False), ("a", 2, 1, True)], "v string, rec long, n long, s boolean").coalesce(1)
    (r,) = frequency.frequencies(again, F.col("v"), F.col("rec"), F.col("n"), 2, 0, 0.1, F.col("s")).collect()
    assert (r.n_occurrences, r.n_records) == (4, 2)
    assert frequency.frequencies(df.limit(0), F.col("v"), F.col("rec"), F.col("n"), 0, 2, 0.1).count() == 0


@pytest.mark.parametrize("a, b", [("саре", "cape"), ("ｆｕｌｌ ｗｉｄｅ", "full wide"), ("été", "été"), ("zero​width﻿", "zerowidth"), ("no break", "no break"), ("бyc", "бус"), ("ﬁn", "fin"), ("re‑do", "re-do"), ("̀", "̀"), ("νο", "vo")])
def test_alike(a, b):
    assert lookalike.canonical(a) == lookalike.canonical(b) and a != b


@pytest.mark.parametrize("a, b", [("résumé", "resume"), ("Polish", "polish"), ("re-do", "redo"), ("a b", "ab"), ("x²", "x2"), ("й", "и"), ("kit", "кіт")])
def test_not_alike(a, b):
    assert lookalike.canonical(a) != lookalike.canonical(b)


@pytest.mark.parametrize("text, verdict", [("cape", "plain"), ("саре", "whole"), ("cаpe", "mixed"), (" cape", "variant"), ("ｆit", "variant"), ("ꓮꓔ", "whole"), ("год", "plain"), ("l\u0435gal год", "mixed"), ("ΑΤ now", "whole")])
def test_verdict(text, verdict):
    assert lookalike.inspect(text)[1] == verdict


@pytest.mark.parametrize("a, b", [("օ", "o"), ("Ꭺ", "A"), ("ꓮ", "A"), ("ρ", "p"), ("υ", "u"), ("ϲ", "c"), ("ɑ", "a"), ("ɡ", "g"), ("Ӏ", "I"), ("ӏ", "l"), ("Ⅰ", "I"), ("re−do", "re-do"), ("Ⲣ", "P"), ("µ", "μ"), ("əl", "әl"), ("l’ʼa", "lʼ’a")])
def test_letters_of_one_shape(a, b):
    assert lookalike.canonical(a) == lookalike.canonical(b)


def test_hot_spelling_is_paired_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(lookalike, "PIECE", 5)
    data = [(i, "en", "cape" if i % 3 else "саре") for i in range(60)] + [(60, "en", "ｃape"), (61, "de", "cape")]
    df = spark.createDataFrame(data, "id long, lang string, term string")
    got = {(r.key_a, r.key_b) for r in lookalike.alike_pairs(df, F.col("id"), F.col("lang"), F.col("term"), F.col("id")).collect()}
    assert got == {(a, b) for a, g, t in data for b, h, u in data if a < b and g == h and t != u}


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=20))
def test_canonical_is_stable(t):
    once = lookalike.canonical(t)
    assert lookalike.canonical(once) == once


def test_alike_pairs(spark, rows):
    data = [(2, "en", "cape"), (10, "en", "саре"), (10, "en", "саре"), (3, "en", "cape"), (4, "de", "саре"), (5, None, "cape"), (6, "en", None), (None, "en", "cаpe"), (7, "en", ""), (8, "en", "​" * 5000), (9, "en", "Cape")]
    df = spark.createDataFrame(data, "id long, lang string, term string").withColumn("k", F.lit("clash")).withColumn("c", F.lit("clash"))
    assert rows(lookalike.alike_pairs(df, F.col("id").cast("string"), F.col("lang"), F.col("term"), F.col("id"))) == [("en", "2", "10"), ("en", "3", "10"), ("en", "7", "8")]
    assert lookalike.alike_pairs(df.limit(0), F.col("id").cast("string"), F.col("lang"), F.col("term"), F.col("id")).count() == 0
    assert {r.n_spellings for r in lookalike.alike_classes(df, F.col("id"), F.col("lang"), F.col("term")).where("key = 2").collect()} == {2}


PLAIN = ["older *kesep- became **mozup only in grammars", "A < B < *c", "sense 2 > sense 3, 'x'; see a_b", "the set {i, e} alternates", "spelled x [sic] (p. 3)", "C# would be 3 * 4 = 12", "a ~ b & c / d", "sold for $5 or $6 a vessel", "if a < b then c", ""]
MARKED = {
    "see [[a|b c]]": "see b c", "'''x''' and ''y''": "x and y", "from <i>k</i>, a&nbsp;b": "from k, a b", "{{der|en|fr|mot}} x": "mot x", "== H ==\nx": "【H】\n\nx", "from **k**, a": "from k, a", "~~x~~ y": "x y", "the `x-` root": "the x- root",
    "\\emph{a} $\\alpha_2$": "a alpha_2", "[a](./b.md) c": "a c", "x<ref>note</ref>": "x", "<!-- y -->x": "x", "* [[a]]\n** b": "• a\n  • b", "T\n---\nx": "【T】\n\nx", "d\\'{a}b": "dáb", "&lt;b&gt;x&lt;/b&gt;": "x", "```\na <b>\n```": "    a <b>", "__NOTOC__\nx": "x", "{|\n! a !! b\n|-\n| c || d\n|}": "a\tb\nc\td",
}


@pytest.mark.parametrize("text", PLAIN)
def test_plain_text_stays(text):
    blocks, n = markup.convert(text)
    assert n == 0 and markup.render(blocks) == text


@pytest.mark.parametrize("text", MARKED)
def test_markup_goes(text):
    blocks, n = markup.convert(text)
    clean = markup.render(blocks)
    assert n > 0 and clean == MARKED[text]


NESTED = [
    ("{{a|" * 9 + "core" + "}}" * 9, "core"), ("{{a|" * 40 + "core" + "}}" * 40, "core"), ("\\emph{" * 12 + "core" + "}" * 12, "core"), ('<span title="a > b">core</span>', "core"),
    ("<custombox kind='x > y'>core</custombox>", "core"), ("; term", "term"), (": said", "said"), ("[ftp://a.b core]", "core"),
]


@pytest.mark.parametrize("text, clean", NESTED)
def test_nothing_is_left(text, clean):
    blocks, n = markup.convert(text if text[0] not in ";:" else f"{text}\n{text}")
    assert n > 0 and markup.render(blocks[:1]).lstrip("• ") == clean


def test_main_text_leaves_link_blocks_out():
    long = "the root of the word is said to be from the old form and it was borrowed in the north"
    text = f"== A ==\n{long}\n== B ==\n[[x one]] [[y two]]\n[[z three]]\n=== C ===\n[[v]]\n== D ==\n```\ncode\n```"
    blocks, _ = markup.convert(text)
    labels = markup.classify(blocks)
    assert labels == ["heading", "text", "heading", "link", "link", "heading", "link", "heading", "code"]
    assert [b[2] for b in markup.main_blocks(blocks, labels)] == ["A", long, "D", "code"]


def test_block_labels():
    long = "the root of the word is said to be from the old form and it was borrowed in the north"
    blocks = [("paragraph", 0, "short", 0.0), ("paragraph", 0, long, 0.0), ("item", 1, "nav a b", 0.9), ("item", 1, "also", 0.0), ("heading", 1, "H", 0.0)]
    assert markup.classify(blocks) == ["text", "text", "link", "link", "heading"]


def test_clean_documents(spark, rows):
    data = [(1, None), (2, ""), (3, "see [[a]]"), (3, "see [[a]]"), (4, "plain"), (5, "[[x]] " * 20000)]
    df = spark.createDataFrame(data, "id long, t string").withColumn("clean", F.lit("clash"))
    got = [(r.rec_key, r.n_markup > 0, r.clean) for r in markup.clean_documents(df, F.col("id"), F.col("t")).orderBy("rec_key").collect()]
    assert got[:5] == [(1, False, None), (2, False, ""), (3, True, "see a"), (3, True, "see a"), (4, False, "plain")] and "[[" not in got[5][2]


def test_packing(spark):
    rnd = random.Random(2)
    data = [(i, rnd.choice([0, 5, 40, 300, 900, 1700, 2048, 2049, 7000])) for i in range(400)]
    df = spark.createDataFrame(data, "doc_id long, n_tokens long").withColumn("g", F.lit("clash"))
    got = packing.pack(df, 2048, 16, group=150).collect()
    assert {r.doc_id for r in got} == {i for i, n in data if n}
    by, docs = {}, {}
    for r in got:
        by.setdefault(r.container, []).append(r.n_tokens)
        docs[r.doc_id] = docs.get(r.doc_id, 0) + r.n_tokens
        assert r.n_pieces == -(-dict(data)[r.doc_id] // 2048)
    assert docs == {i: n for i, n in data if n}
    cost = packing.COST * 2048**2
    assert all(sum(x) <= 2048 and len(x) <= 16 and (len(x) == 1 or sum(y * y for y in x) <= cost) for x in by.values())
    assert packing.pack(df.limit(0)).count() == 0


def test_each_capacity_binds():
    sizes = np.sort(np.random.default_rng(3).integers(10, 1500, 2000))[::-1]
    free, cost, docs = (packing.best_fit(sizes, 2048, d, c * 2048**2) for d, c in ((64, 1), (64, packing.COST), (3, 1)))
    spent = lambda to: np.bincount(to, sizes.astype(float) ** 2)[np.bincount(to) > 1].max() / 2048**2
    assert spent(cost) <= packing.COST < spent(free)
    assert np.bincount(docs).max() == 3 < np.bincount(free).max()
    assert sizes.sum() / ((free.max() + 1) * 2048) > 0.98


@pytest.mark.parametrize("rule", ["norm", "dot"])
def test_best_fit_fills(rule):
    sizes = np.sort(np.random.default_rng(1).integers(20, 900, 3000))[::-1]
    to = packing.best_fit(sizes, 2048, 64, 2048 * 2048, rule=rule)
    assert sizes.sum() / ((to.max() + 1) * 2048) > 0.97


def test_token_counts(spark, rows):
    text = "word " * 60000
    df = spark.createDataFrame([(1, None), (2, ""), (3, "a b"), (4, text)], "id long, t string").withColumn("n_tokens", F.lit("clash"))
    got = rows(packing.token_counts(df, F.col("id"), F.col("t")))
    assert got[0] == (2, 0) and got[1][0] == 3 and abs(got[2][1] - 60000) <= 1
    assert "".join(packing.slices(text)) == text and len(list(packing.slices(text))) == 3


ITEM = "The adverb togas came into Mibasari for big cattle work, which Swedish noted. Nobody copied favov along a distant custom beside korid, which Old English carried. The ending -ra was replaced beside kuzot until some harvest carried the bird."


@pytest.mark.parametrize("chars", [10**6, 0])
def test_leakage(spark, monkeypatch, chars):
    """By broadcast and, with no room for that, by shuffle."""
    monkeypatch.setattr(leakage, "BLOCK_CHARS", chars)
    words = ITEM.split()
    cut_ = " ".join(words[5:20])
    docs = [
        (1, "Before. " + ITEM.upper()), (2, " ".join(words[:14]) + " something else entirely stands here now and goes on " + " ".join(words[14:28])), (3, "Nothing to see"), (4, None), (5, ""), (6, cut_.replace("cattle", "sheep").replace("e", "е")),
        (7, "x " * 30000 + ITEM), (1, "Before. " + ITEM.upper()), (8, " ".join(words[:6])), (9, ITEM.lower()),
    ]
    d = spark.createDataFrame(docs, "id long, t string").withColumn("item_id", F.lit("clash"))
    i = spark.createDataFrame([(10, ITEM), (10, ITEM), (11, None), (12, ""), (13, "one two")], "i long, t string")
    got = sorted((r.doc_id, r.item_id) for r in leakage.leaked(d, F.col("id"), F.col("t"), i, F.col("i"), F.col("t")).collect())
    assert got == [(1, 10), (2, 10), (6, 10), (7, 10), (9, 10)]
    assert leakage.leaked(d, F.col("id"), F.col("t"), i.limit(0), F.col("i"), F.col("t")).count() == 0
    assert leakage.leaked(d.limit(0), F.col("id"), F.col("t"), i, F.col("i"), F.col("t")).count() == 0


def test_hot_window_by_shuffle(spark, monkeypatch):
    """The same rows by both joins where one window is in every document and its rows are dealt out."""
    from lexweave.plans import runtime

    rnd = random.Random(4)
    words = [f"w{k}" for k in range(300)]
    items = [(k, " ".join(rnd.choices(words, k=24)) + " the same few words end here") for k in range(12)]
    docs = [(k, " ".join(rnd.choices(words, k=30)) + " the same few words end here " + (items[k % 12][1][: 40 + k] if k % 3 else "")) for k in range(60)]
    d, i = spark.createDataFrame(docs, "id long, t string"), spark.createDataFrame(items, "i long, t string")
    find = lambda: sorted(tuple(r) for r in leakage.leaked(d, F.col("id"), F.col("t"), i, F.col("i"), F.col("t")).collect())
    want = find()
    monkeypatch.setattr(leakage, "BLOCK_CHARS", 0)
    monkeypatch.setattr(runtime, "SKEW_ROWS", 0)
    assert len(want) > 20 and find() == want


TURIN = "A train left Turin at 81 km per hour while Ada walked 12 miles from Milan to Como with 3 bags and 40 dollars"


def test_items_asked_again_with_other_values():
    items = leakage.Items([(1, "When the Latin word was taken into Dutch it had 12 forms and the Latin people kept 7 of the forms in use"), (2, TURIN)])
    same = "When the Spanish word was taken into Dutch it had 15 forms and the Spanish people kept 7 of the forms in use"
    ((_, share, template),) = leakage.matches(items, same)
    assert share < template
    other = "A train left Lyon at 90 km per hour while Bob walked 15 miles from Brest to Nantes with 5 bags and 70 dollars"
    ((item, share, template),) = leakage.matches(items, other)
    assert item == 2 and share < 0.7 and template == 1
    slots = leakage.Items([(3, "then Turin 81 km Milan 12 miles Como 3 kg Rome 5 days Pisa 9 lb")])
    ((_, share, template),) = leakage.matches(slots, "then Lyon 90 mi Brest 15 feet Nantes 8 oz Tours 6 weeks Caen 2 kg")
    assert share < 1 / 3 and template == 1
    mixed = "A train left Lyon at 90 km per hour while Bob walked 15 miles from Brest to Nantes. So far the story of the train."
    assert not leakage.matches(leakage.Items([(4, mixed)]), "Lyon and 90 others went by train for one hour to see Bob in Brest")


@pytest.mark.parametrize("n, k, found", [(15, 5, True), (15, 6, True), (15, 4, False), (12, 4, True), (9, 3, True), (6, 3, True), (30, 10, True), (30, 11, True), (30, 9, False)])
def test_a_verbatim_third_is_found(n, k, found):
    words = [f"word{chr(97 + j)}" for j in range(26)] + ["more", "of", "them", "here"]
    items = leakage.Items([(1, " ".join(words[:n]))])
    text = "quite another text begins " + " ".join(words[2 : 2 + k]) + " and goes on in its own way"
    assert bool(leakage.matches(items, text)) is found


def test_reading_levels(spark):
    hard = "The lexicographical reinterpretation of intermediate manuscripts inconclusively recapitulates a typological heterogeneity whose derivational documentation remains indeterminate. " * 5
    data = [(1, None), (2, ""), (3, "!!! 123"), (4, "The cat sat on the mat. It was a red cat."), (5, hard), (6, "Der Hund und die Katze sind nicht in dem Haus."), (4, "The cat sat on the mat. It was a red cat."), (7, hard * 300)]
    df = spark.createDataFrame(data, "id long, t string").withColumn("grade", F.lit("clash"))
    got = {r.doc_id: r for r in readability.reading_levels(df, F.col("id"), F.col("t")).collect()}
    assert got[1].grade is None and got[2].grade is None and got[3].n_words == 0
    assert got[4].grade < 4 and got[5].grade > 12.5 and got[4].language == got[5].language == "en" and got[6].language == "de"
    assert abs(got[7].grade - got[5].grade) < 0.5


#: Syllables of words the patterns were written with.
KNOWN = {
    1: """
        cat the make made walked jumped house year time through strength friend field piece guess guest league tongue bread great cream heart fruit build suit
        blue true loved moved likes books played stayed dreamed quite white one two three four eye bridge edge judge changed real""",
    2: """
        create useful something people table little wanted needed science poem quiet lion giant being going playing dying lying person movement statement
        careful safety lovely homework somewhere therefore language ocean fuel cruel fluid ruin poet diet client riot trial dial seeing skiing chaos
        rhythm prism middle simple settled handled hundred sacred naked basic watches boxes buses houses changes pages pieces centre acre fibre lawyer
        canyon beyond player royal mayor studied carried married cities ladies nation station action vision region special social ancient patient
        precious conscious million union onion surgeon pigeon leopard marriage carriage cashier frontier soldier equal quickly question unique
        technique basement brilliant persuade vineyard hopeless endless wireless nowhere sometimes lifetime""",
    3: """
        area usual actual idea beautiful important remember several imagine however another together family radio video studio period violent violet idiot
        champion piano serious various curious obvious previous glorious hideous studying copying easier happier earliest serial diagram dialect
        alliance defiant audience convenient efficient influence continue genuine manual annual virtual national religious courageous theory museum
        creation reaction linear nuclear element government settlement agreement implement excitement entirely completely borrowing linguistic
        dialogue archaic heroic coincide tourism sarcasm familiar behavior opinion companion radium premium stadium guarantee employee committee
        referee recipe simile aerial poetry poetic deviate theatre sincerely loneliness carefully everything everyone somebody horsepower moreover
        whatever""",
    4: """
        education material memorial variable reliable society variety anxiety experience obedient ingredient continuous january february associate appreciate
        negotiate initiate traditional spontaneous reality definitely separately literature dictionary derivation historical ability community
        temperature particular necessary interesting comfortable vegetable cooperate coordinate zoology organism criticism realism mechanism superior
        criterion aquarium apostrophe catastrophe medieval appropriate immediate ceremony""",
    5: """
        simultaneous vocabulary etymology university possibility opportunity""",
}
#: And of words they were not.
OTHER = {
    1: "breathe clothes height youth weird thought queue strange worlds ground", 2: "justice kitchen mountain neighbor orange purple river silence window yellow although because describe enough garage island journey knowledge leisure measure naive pleasure receive schedule iron chapter absent thousand weather beneath",
    3: "animal banana computer elephant hospital internet library umbrella favorite occasion vehicle camera different tomorrow eleven vanilla musical potato delicate attention exercise horizon decided",
    4: "usually information application independent alternative mythology identical astronomy caterpillar competition", 5: "abbreviation refrigerator communication organization pronunciation biological",
}


@pytest.mark.parametrize("words, share", [(KNOWN, 0.98), (OTHER, 0.93)])
def test_syllables(words, share):
    all_ = [(w, n) for n, text in words.items() for w in text.split()]
    wrong = [(w, readability.syllables(w), n) for w, n in all_ if readability.syllables(w) != n]
    assert len(wrong) <= (1 - share) * len(all_), wrong
    assert readability.syllables("well-known") == 2 and readability.syllables("Haus") == 1 and readability.syllables("x") == 1
