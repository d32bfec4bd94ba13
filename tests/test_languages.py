from pyspark.sql import functions as F

from lexweave.operators import languages as L

RULES = "struct<replace_from: array<string>, replace_to: array<string>, remove_diacritics: string>"


def tables(spark):
    rule = (["æ", "x", ""], ["ae"], "́")
    data = [("da", "Danish", "Dansk; Rigsdansk", None, "gmq", "regular", rule), ("da", "Danish", "Dansk; Rigsdansk", None, "gmq", "regular", rule), ("oda", "Old Danish", None, "Danish", "gmq", "etym-only", None), ("so", "Som", "Twin", None, None, "regular", None), ("to", "Tom", "Twin", "Nowhere", "gmq", "regular", None), ("zz", "Twin", " ", None, None, None, None), ("aa", "Twin", "", None, "none", None, None), (None, "x", None, None, None, None, None)]
    langs = spark.createDataFrame(data, f"code string, canonical_name string, other_names string, parent string, family string, type string, normalization {RULES}").withColumn("rank", F.lit("clash"))
    fams = spark.createDataFrame([("gmq", "North Germanic", None), ("gmq", "North Germanic", None), ("twi", "Twin", "Twins")], "code string, canonical_name string, other_names string")
    return L.languages(langs), fams


def test_names_and_parents(spark, rows):
    langs, fams = tables(spark)
    known = L.names(langs, fams)
    wanted = spark.createDataFrame([("Danish",), ("Rigsdansk",), ("Twin",), ("Twins",), ("North Germanic",), ("nobody",), (None,)], "name string")
    got = {r.name: (r.code, r.options) for r in L.code_of(wanted, known).collect()}
    assert got == {"Danish": ("da", ["da"]), "Rigsdansk": ("da", ["da"]), "Twin": ("aa", ["aa", "so", "to", "twi", "zz"]), "Twins": ("twi", ["twi"]), "North Germanic": ("gmq", ["gmq"]), "nobody": (None, []), None: (None, [])}
    assert {r.code: (r.parent_code, r.family_code) for r in L.parent_code(langs, fams).collect()} == {"da": (None, "gmq"), "oda": ("da", "gmq"), "so": (None, None), "to": (None, "gmq"), "zz": (None, None), "aa": (None, None)}
    shown = langs.select("code", L.display(F.col("code"), F.col("name")).alias("s"))
    assert all(r.b == r.code for r in shown.select("code", L.display_code(F.col("s")).alias("b")).collect())
    assert spark.range(1).select(L.display_code(F.lit("Danish (da)*")), L.display_code(F.lit("da"))).first()[:] == ("da", "da")


def test_normalized(spark, rows):
    langs, _ = tables(spark)
    terms = spark.createDataFrame([("æble", "da"), ("æble", "oda"), ("xés#Etymology æ", "da"), ("æble", "so"), ("æble", "unknown"), ("æble", None), (None, "da"), ("", "da")], "term string, language string").withColumn("normalized_by", F.lit("clash"))
    got = {(r.term, r.language): r.normalized for r in L.normalized(terms, langs).collect()}
    assert got == {("æble", "da"): "aeble", ("æble", "oda"): "aeble", ("xés#Etymology æ", "da"): "es#Etymology æ", ("æble", "so"): "æble", ("æble", "unknown"): "æble", ("æble", None): "æble", (None, "da"): None, ("", "da"): ""}
    assert L.normalized(terms.limit(0), langs).count() == 0
