from pyspark.sql import functions as F

from lexweave.operators import glosses as G
from lexweave.operators import resolve as R
from tests.test_languages import tables

LEXEMES = "node_id long, term string, language string, sense_idx int, etymid string, pos string, gloss string"


def test_index_and_sections(spark, rows):
    x = spark.createDataFrame([("a", "da", 0), ("a", "da", 0), ("a", "da", None), ("a", "sv", 0), ("a", "sv", 1), (None, "sv", 1), ("b", None, 2)], "term string, language string, sense_idx int").withColumn("single", F.lit("clash"))
    assert rows(R.lexicon_index(x).where("language is not null")) == [("a", "da", 1, True), ("a", "sv", 2, False)]
    s = spark.createDataFrame([(1, 1, ["Da", "Noun"]), (1, 2, ["Da", "Etymology 2"]), (1, 3, ["Da", "Etymology 2", "Noun"]), (1, 4, ["Da", "Verb"]), (1, 5, ["Sv", "Verb"]), (1, 6, ["Sv", "Etymology"]), (2, 1, [])], "rec_key long, sec_pos int, path array<string>")
    assert rows(R.resolve_sections(s)) == [(1, 1, 0), (1, 2, 1), (1, 3, 1), (1, 4, 1), (1, 5, 0), (1, 6, 0), (2, 1, 0)]


def test_defaults(spark):
    langs, _ = tables(spark)
    data = [(1, None, None, None, "æ", "da"), (2, "bog", "oda", None, "x", "so"), (3, "bog", "so", "Danish", "x", "so"), (4, "bog", "-", None, "x", "so"), (5, "File:x.png", "so", None, "x", "so"), (6, "", "", "nothing", "y", "so"), (7, None, None, None, None, None)]
    m = spark.createDataFrame(data, "mention int, term string, language string, anchor string, near_term string, near_language string")
    assert {r.mention: (r.term, r.language) for r in R.with_defaults(m, langs).collect()} == {1: ("ae", "da"), 2: ("bog", "da"), 3: ("bog", "da"), 6: ("y", "so")}


def test_homonyms(spark):
    x = [(1, "one", "da", 0, None, "Noun", "a unit"), (2, "bank", "da", 0, "money", "Noun", "a house for money"), (3, "bank", "da", 1, "shore", "Noun", "the edge of a river"), (4, "bank", "da", 2, None, "Verb", "to lean"), (4, "bank", "da", 2, None, "Verb", "to lean"), (5, "nul", None, 0, None, None, None), (6, "nul", None, 1, None, None, None)]
    m = [(1, "one", "da", "zz", None, None), (2, "bank", "da", "shore", None, None), (3, "bank", "da", "missing", None, None), (4, "bank", "da", None, "Verb", None), (5, "bank", "da", None, None, "edge of water"), (6, "bank", "da", "", "Noun", "river edge"), (7, "bank", "da", None, None, "zzz"), (8, "bank", "sv", None, None, None), (9, "nul", None, None, None, None), (10, None, "da", None, None, None), (11, "bank", "da", None, "Noun", "zzz")]
    lex = spark.createDataFrame(x, LEXEMES).withColumn("score", F.lit("clash"))
    men = spark.createDataFrame(m, "mention int, term string, language string, id string, pos string, t string").withColumn("n", F.lit("clash"))
    got = {r.mention: (r.node_id, r.how) for r in R.choose_homonyms(men, lex).collect()}
    assert got == {1: (1, "single"), 2: (3, "id"), 3: (None, "id fails"), 4: (4, "pos"), 5: (3, "gloss"), 6: (3, "gloss"), 7: (2, "first"), 8: (None, "unknown"), 9: (5, "first"), 10: (None, "unknown"), 11: (2, "first")}
    assert R.choose_homonyms(men.limit(0), lex).count() == 0


def test_entities(spark, rows):
    data = [(1, "Ada Moor", "1801", None, None, "writer", None), (2, "Ada Moor", "1801", "1870", "Dutch", "poet", None), (3, "Ada Moor", "1902", None, None, "singer", ""), (4, "Ada Moor", None, None, "Dutch", "writer", "Ada"), (5, None, "1", None, None, None, None), (6, "Bo", None, None, None, None, None), (4, "Ada Moor", None, None, "Dutch", "writer", "Ada")]
    m = spark.createDataFrame(data, "ord long, name string, born string, died string, nat string, occ string, wplink string").withColumn("entity", F.lit("clash"))
    got = rows(R.merge_entities(m).select("name", "entity", "born", "died", "nat", "wplink", "occ"))
    assert got == [("Ada Moor", 0, "1801", "1870", "Dutch", "Ada", "writer; poet"), ("Ada Moor", 1, "1902", None, None, None, "singer"), ("Bo", 0, None, None, None, None, None)]
    assert R.merge_entities(m.limit(0)).count() == 0


def test_features(spark):
    df = spark.createDataFrame([("to walk", "to walk slowly"), (None, ""), ("a b", "c d"), ("x" * 60, "x" * 60), ("walk", "walks")], "a string, b string").withColumn("p", F.lit("clash"))
    one, none, other, long, near = (r.asDict() for r in G.features(df).collect())
    assert (one["lev"], one["equal"], one["a_in_b"], one["words_in"]) == (7, 0, 1, 1) and abs(one["tversky"] - 2 / 2.32) < 1e-9 and one["longest"] == 1
    assert (none["lev"], none["equal"], none["tversky"], none["fuzzy"], none["ratio"]) == (0, 1, 0, 0, 0)
    assert other["tversky"] == 0 and 0 < other["fuzzy"] < 0.6 and (long["lev"], long["equal"], long["ratio"]) == (-1, 1, 1)
    assert near["tversky"] == 0 and abs(near["fuzzy"] - 0.5 / (0.5 + 0.5)) < 1e-9 and near["word_ratio"] == 0


def test_matcher(spark):
    senses = ["a large grey stone", "the edge of a river", "to move quickly on foot", "a vessel for water", "a tool that cuts wood", "the sound of a bell"]
    lex = [(k * 10 + s, f"w{k}", "da", f"id{s}", senses[(k + s) % 6]) for k in range(40) for s in range(3)] + [(999, "w1", "da", None, None)]
    men = [(k, f"w{k}", "da", f"id{k % 3}", " ".join(senses[(k + k % 3) % 6].split()[-2:])) for k in range(40)] + [(900, "w1", "da", "none", "x"), (901, "w1", "da", None, "x")]
    pairs = G.gold_pairs(spark.createDataFrame(men, "mention long, term string, language string, id string, t string"), spark.createDataFrame(lex, "node_id long, term string, language string, etymid string, gloss string"))
    assert pairs.count() == 120 and pairs.where("match = 1").count() == 40
    fit, test = G.split_by(G.features(pairs), ["term", "language"], 0.3)
    assert fit.count() + test.count() == 120 and fit.join(test, ["term", "language"], "left_semi").count() == 0
    for name in G.MODELS:
        scored = G.predict(G.train(fit, name), test)
        chosen = G.best_match(G.sense_level(scored), ["term", "language", "mention"], 0.01)
        (q,) = G.quality(chosen, F.col("chosen") == 1, F.col("match") == 1).collect()
        assert q.f1 > 0.8, (name, q)
    assert G.quality(test.limit(0), F.col("match") == 1, F.col("match") == 1).first()[:] == (0, 0.0, 0.0, 0.0)
