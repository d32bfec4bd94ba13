"""The inferred language tree and its union with the families, on tables with known results."""

import pytest

from lexweave.plans.catalogue import queries

LEXEME = "struct<term:string,language:string,sense_idx:int>"
COUNTS = [
    ("a", "b", "inheritance", 10), ("b", "c", "root", 10), ("a", "c", "inheritance", 8),  # implied
    ("x", "y", "inheritance", 9), ("y", "z", "inheritance", 9), ("z", "x", "root", 9),  # a cycle
    ("d", "e", "inheritance", 8), ("e", "d", "inheritance", 2),  # 0.8 isn't more than 0.8
    ("f", "g", "inheritance", 7), ("h", "i", "inheritance", 7), ("i", "h", "root", 1),  # 7 and 8 links
    ("j", "k", "borrowing", 20),
]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("tree"))
    pairs = [(a, b, t) for a, b, t, n in COUNTS for _ in range(n)]
    spark.createDataFrame([(k, (f"w{k}", a, None), (f"v{k}", b, None), t, None, None) for k, (a, b, t) in enumerate(pairs)], f"ord long, src {LEXEME}, tgt {LEXEME}, type string, text string, uncertain boolean").write.parquet(f"{d}/relation.parquet")
    languages = [("a", "A", None, "f2"), ("b", "B", "A", "f2"), ("c", "C", "A", "f1"), ("h", "H", "", "f2"), ("i", "I", None, "f2"), ("j", "J", "nobody", "f1"), ("f1", "Same code", None, "f1"), ("k", "K", None, None), ("o", "O", None, "o1")]
    spark.createDataFrame(languages * 2, "code string, canonical_name string, parent string, family string").write.parquet(f"{d}/language_data.parquet")
    families = [("f1", "Fam", None), ("f2", "Fam two", " FAM "), ("f3", "No language", "f1"), ("o1", "Loop", "o2"), ("o2", "Ring", "o1"), ("s", "Own", "s")]
    spark.createDataFrame(families * 2, "code string, canonical_name string, parent_family string").write.parquet(f"{d}/language_families.parquet")
    return d


def test_tree_by_odds_is_reduced(spark, rows, folder):
    assert rows(queries()["g14_tree_inference"](spark, folder)) == [("a", "b", 1.0), ("b", "c", 1.0), ("h", "i", 0.875)]


def test_families_above_languages(spark, rows, folder):
    # A-C is implied by A-B-C, and the family of I by that of H; the loop O1-O2 is set aside
    want = [("f1", "f2"), ("f2", "a"), ("a", "b"), ("b", "c"), ("f2", "h"), ("h", "i"), ("f1", "j"), ("f1", "f1"), ("o1", "o")]
    assert rows(queries()["g15_language_tree"](spark, folder)) == sorted(want)
