"""The languages of a lexicon: names to codes with ambiguity, parents, families, and the spelling a term is looked up by."""

from __future__ import annotations

import unicodedata
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexweave.plans.runtime import cut, skew_join


def languages(language_data: DataFrame) -> DataFrame:
    """(code, name, other_names, parent, family, type, normalization): each code once, the smallest values of repeated rows;
    empty texts are null and the other names an array."""
    text = lambda c: F.nullif(F.trim(c), F.lit(""))
    cols = [text(c) for c in ("canonical_name", "parent", "family", "type")]
    one = language_data.where("code is not null").groupBy("code").agg(
        *(F.min(c).alias(n) for c, n in zip(cols, ("name", "parent", "family", "type"))), F.min(text("other_names")).alias("other_names"), F.any_value("normalization", True).alias("normalization"),
    )
    return one.withColumn("other_names", other_names(F.col("other_names")))


def other_names(c: Column) -> Column:
    """Packed names as an array; null gives none."""
    parts = F.transform(F.split(F.coalesce(c, F.lit("")), r"[,;|/\n\t]+"), lambda x: F.regexp_replace(x, r'^[\s"“]+|[\s"”]+$', ""))
    return F.filter(parts, lambda x: x != "")


def names(langs: DataFrame, families: DataFrame) -> DataFrame:
    """(name, code, rank): every name of a language or family; rank 0 canonical name of a language with a family, 1 of one
    without, 2 other name, 3 and 4 a family's. Families come from (code, canonical_name, other_names)."""
    text = lambda c: F.nullif(F.trim(c), F.lit(""))
    main = langs.select("name", "code", F.when(F.col("family").isNotNull(), 0).otherwise(1).alias("rank"))
    other = langs.select(F.explode("other_names").alias("name"), "code", F.lit(2).alias("rank"))
    fam = families.select(text("canonical_name").alias("name"), "code", F.lit(3).alias("rank"))
    fam2 = families.select(F.explode(other_names(F.col("other_names"))).alias("name"), "code", F.lit(4).alias("rank"))
    return main.union(other).union(fam).union(fam2).where("name is not null and code is not null").distinct()


def code_of(wanted: DataFrame, known: DataFrame) -> DataFrame:
    """(name, code, options): the code of each ``name``, and all codes that bear it.

    Of several the lowest rank wins, the smallest code on a tie; an unknown name has a null code and no options.
    """
    best = known.groupBy("name").agg(F.min(F.struct("rank", "code"))["code"].alias("code"), F.sort_array(F.collect_set("code")).alias("options"))
    w = wanted.select("name").distinct()
    return w.join(best, "name", "left").select("name", "code", F.coalesce("options", F.array().cast("array<string>")).alias("options"))


def parent_code(langs: DataFrame, families: DataFrame) -> DataFrame:
    """(code, parent_code, family_code): the code of the parent's name, and of the family if there is such a family."""
    by = langs.groupBy(F.col("name").alias("parent")).agg(F.min("code").alias("parent_code"))
    fam = families.select(F.col("code").alias("family")).where("family is not null").distinct().withColumn("family_code", F.col("family"))
    return langs.select("code", "parent", "family").join(by, "parent", "left").join(fam, "family", "left").select("code", F.when(F.col("parent_code") != F.col("code"), F.col("parent_code")).alias("parent_code"), "family_code")


def display(code: Column, name: Column) -> Column:
    return F.concat(name, F.lit(" ("), code, F.lit(")"))


def display_code(shown: Column) -> Column:
    """The code out of ``display``; a text without one is a code itself."""
    return F.coalesce(F.nullif(F.regexp_extract(shown, r"\(([^()]*)\)\*?$", 1), F.lit("")), shown)


_RULE = T.StructType([T.StructField("replace_from", T.ArrayType(T.StringType())), T.StructField("replace_to", T.ArrayType(T.StringType())), T.StructField("remove_diacritics", T.StringType())])


@lru_cache(20_000)
def _spelling(term: str, old: tuple[str, ...], new: tuple[str, ...], marks: str) -> str:
    for k, o in enumerate(old):
        if o:
            term = term.replace(o, new[k] if k < len(new) else "")
    if marks:
        gone = set(unicodedata.normalize("NFD", marks))
        term = "".join(c for c in unicodedata.normalize("NFD", term) if c not in gone)
    return unicodedata.normalize("NFC", term)


@F.arrow_udf(T.StringType())
def _normalize(term: pa.Array, rule: pa.Array) -> pa.Array:
    out = []
    for t, r in zip(term.to_pylist(), rule.to_pylist()):
        head, mark, anchor = (t or "").partition("#")
        out.append(t if t is None or r is None else _spelling(head, tuple(x or "" for x in r["replace_from"] or ()), tuple(x or "" for x in r["replace_to"] or ()), r["remove_diacritics"] or "") + mark + anchor)
    return pa.array(out, pa.string())


def normalized(terms: DataFrame, langs: DataFrame, term: str = "term", language: str = "language") -> DataFrame:
    """``terms`` with ``normalized``: the spelling by which its language looks a term up.

    The rules are the parent's where the language has a parent with rules, else its own: characters are replaced one after
    the other (those without a replacement go), then the marks named are removed. A language without rules or unknown
    leaves the term as it is, as does what stands after #. Only distinct pairs of language and term are worked on.
    """
    own = langs.select("code", "name", "parent", "normalization")
    up = own.select(F.col("name").alias("parent"), F.col("normalization").alias("theirs")).where("theirs is not null").groupBy("parent").agg(F.any_value("theirs").alias("theirs"))
    rules = own.join(up, "parent", "left").select(F.col("code").alias("_code"), F.coalesce("theirs", "normalization").alias("_rule"))
    pairs = cut(terms.select(F.col(language).alias("_code"), F.col(term).alias("_term")).distinct())
    done = cut(skew_join(pairs, rules, "_code", pairs.count()).select("_code", "_term", F.when(F.col("_rule").isNull(), F.col("_term")).otherwise(_normalize("_term", F.col("_rule").cast(_RULE))).alias("normalized")))
    return terms.join(done, F.col(language).eqNullSafe(F.col("_code")) & F.col(term).eqNullSafe(F.col("_term")), "left").drop("_code", "_term")
