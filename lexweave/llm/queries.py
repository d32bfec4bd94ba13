"""Queries of this folder's operators, and SQL that gives the same rows where SQL can."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexweave.llm import distinct, frequency, leakage, lookalike, markup, packing, readability
from lexweave.operators.packed import split_packed
from lexweave.operators.shred import assemble, shred
from lexweave.plans.core_queries import split_sql
from lexweave.plans.runtime import clean_key, cut, table

_COMBOS = {"major": (1, "any"), "minor": (2, "any"), "all": (3, "any"), "both": (3, "all")}


def _edit_sets(spark: SparkSession, d: str) -> DataFrame:
    """Partial sets by day and kind of identifier: contributors, and revisions made by identified contributors."""
    who = clean_key(F.col("contributor"))
    rows = table(spark, d, "revisions").select(F.date_format("timestamp", "yyyy-MM-dd").alias("edit_day"), who.alias("who"), "id", F.coalesce("minor", F.lit(False)).alias("m"))
    rows = rows.where("who is not null and who <> '-' and edit_day is not null")
    rows = rows.select("edit_day", "m", F.explode(F.array(F.struct(F.lit("c").alias("kind"), F.col("who").alias("ident")), F.struct(F.lit("r").alias("kind"), F.col("id").cast("string").alias("ident")))).alias("x"))
    return distinct.partial(rows, F.col("x.ident"), {"edit_day": F.col("edit_day"), "kind": F.col("x.kind")}, {"major": ~F.col("m"), "minor": F.col("m")})


def _wide(counts: DataFrame) -> DataFrame:
    """One row per day and group, with both kinds of count and the relative standard error, 0 where all buckets are counted."""
    long = counts.select("edit_day", "kind", "rel_error", F.explode(F.create_map(*(x for k in ("major", "minor", "all") for x in (F.lit(k), F.col(k))))).alias("grp", "n"))
    return long.groupBy("edit_day", "grp").agg(F.coalesce(F.sum(F.when(F.col("kind") == "c", F.col("n"))), F.lit(0)).alias("n_contributors"), F.coalesce(F.sum(F.when(F.col("kind") == "r", F.col("n"))), F.lit(0)).alias("n_revisions"), F.max("rel_error").alias("rel_error"))


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    w = _wide(distinct.totals(_edit_sets(spark, d), _COMBOS))
    return w.where("n_revisions > 0 and 2 * n_contributors >= n_revisions").select("edit_day", "grp")


def p1_counts(spark: SparkSession, d: str) -> DataFrame:
    return _wide(distinct.totals(_edit_sets(spark, d), _COMBOS)).where("n_revisions > 0")


def p1_both(spark: SparkSession, d: str) -> DataFrame:
    """Contributors per day who made major as well as minor edits."""
    return distinct.totals(_edit_sets(spark, d), _COMBOS).where("kind = 'c'").select("edit_day", F.col("both").alias("n_both"))


_SEP, _END = "\u001f", "\u001e"


def _whole(c: str, form=lambda x: x):
    part = lambda a: F.array_join(F.transform(F.coalesce(F.col(f"{c}.{a}"), F.array().cast("array<string>")), lambda x: F.concat(F.coalesce(x, F.lit("")), F.lit(_SEP))), "")
    return F.when(F.col(c).isNotNull(), F.concat(part("replace_from"), F.lit(_END), part("replace_to"), F.lit(_END), F.coalesce(F.col(f"{c}.remove_diacritics"), F.lit(""))))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    """Both sources in one pass; the group is the source with the language, and normalizations are one group."""
    n = table(spark, d, "node").select(F.concat(F.lit("node.term" + _END), F.col("language")).alias("g"), F.col("node_id").alias("o"), F.col("node_id").cast("string").alias("k"), F.col("term").alias("t"))
    s = table(spark, d, "language_data").select(F.lit("language_data.normalization" + _END).alias("g"), F.lit(0).cast("bigint").alias("o"), F.col("code").alias("k"), _whole("normalization").alias("t"))
    pairs = lookalike.alike_pairs(n.unionByName(s), F.col("k"), F.col("g"), F.col("t"), F.struct("o", "k"))
    return pairs.select(F.substring_index("within", _END, 1).alias("source_field"), "key_a", "key_b")


def p3_forms(spark: SparkSession, d: str) -> DataFrame:
    return lookalike.alike_classes(table(spark, d, "node"), F.col("node_id"), F.col("language"), F.col("term")).withColumnRenamed("key", "node_id")


def _texts(spark: SparkSession, d: str) -> list[tuple[str, DataFrame]]:
    leaves = ["[].id", "[].text"]
    s = shred(table(spark, d, "json_page"), F.col("id"), F.col("revision"), leaves)
    revisions = assemble(s, leaves, "[]", {"id": leaves[0], "text": leaves[1]})
    return [("relation.text", table(spark, d, "relation").select(F.col("ord").alias("id"), "text")), ("json_page.revision", revisions.select(F.col("id").cast("bigint").alias("id"), "text"))]


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    parts = [markup.markup_counts(t.where("text <> ''"), F.col("id"), F.col("text")).where("n_markup > 0").select(F.lit(n).alias("source_field"), "rec_key") for n, t in _texts(spark, d)]
    return parts[0].unionByName(parts[1]).where("rec_key is not null").distinct()


def p4_clean(spark: SparkSession, d: str) -> DataFrame:
    parts = [markup.clean_documents(t, F.col("id"), F.col("text")).select(F.lit(n).alias("source_field"), "rec_key", "clean", "main", F.size("kinds").alias("n_blocks"), F.size(F.filter("kinds", lambda k: k == "heading")).alias("n_headings"), F.size(F.filter("labels", lambda k: k == "text")).alias("n_text")) for n, t in _texts(spark, d)]
    return parts[0].unionByName(parts[1]).distinct()


#: Entries whose numbers agree after division by this are kept together, so that their containers are dense.
NEAR = 4096


_COUNTED = re.compile(r"(.*?)(?:=\s*(\d+)\s*)?", re.A | re.S)


def _name_count(value: str) -> tuple[str | None, int]:
    """name=count as its parts; a count that is missing or no 64-bit number is 1, an empty name is none."""
    m = _COUNTED.fullmatch(value)
    n = int(m[2]) if m[2] else 1
    return m[1].strip(" ") or None, n if n < 1 << 63 else 1


def _frequencies(spark: SparkSession, d: str) -> DataFrame:
    """Templates and languages with their numbers. The number of all entries is a container as well: that of the value ""
    among the languages, which every entry holds besides its language."""
    e = table(spark, d, "entries").where("entry_id is not null")
    held = F.array_distinct(F.array(F.lit(""), F.coalesce("language", F.lit(""))))
    lang = cut(frequency.frequencies(e.select("entry_id", F.explode(held).alias("v")), F.col("v"), F.col("entry_id"), F.lit(1), 0, 2, 0.1).drop("band"))
    n = (lang.where("val = ''").first() or (0, 0, 0))[2]
    vals = split_packed(e, F.col("entry_id"), F.col("templates"), F.floor(F.col("entry_id") / NEAR))
    t = frequency.frequencies(vals, F.col("val"), F.col("rec_key"), F.lit(1), n, 2, 0.1, F.col("pos") == 1, _name_count)
    lang = lang.where("val <> ''").withColumn("band", F.when(F.col("n_records") <= 2, "rare").when(F.col("n_records") > 0.1 * n, "common"))
    return t.select(F.lit("entries.templates").alias("source_field"), "*").unionByName(lang.select(F.lit("entries.language").alias("source_field"), "*"))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return _frequencies(spark, d).where("band is not null").select("source_field", "val", "band")


def p6_counts(spark: SparkSession, d: str) -> DataFrame:
    return _frequencies(spark, d)


def _packed(spark: SparkSession, d: str) -> DataFrame:
    return packing.pack(packing.token_counts(table(spark, d, "documents"), F.col("doc_id"), F.col("text")))


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    """Documents whose pieces lie in more than one container: only those that exceed one were cut."""
    of = _packed(spark, d).groupBy("doc_id").agg(F.max("piece").alias("piece"), F.min("container").alias("a"), F.max("container").alias("b"))
    return of.where("piece > 1 and a <> b").select("doc_id")


def p8_containers(spark: SparkSession, d: str) -> DataFrame:
    return _packed(spark, d)


def p8_fill(spark: SparkSession, d: str) -> DataFrame:
    """How well the containers are filled."""
    return _packed(spark, d).agg(F.count_distinct("container").alias("n_containers"), F.sum("n_tokens").alias("n_tokens"), (F.sum("n_tokens") / (F.count_distinct("container") * 2048)).alias("fill"))


def _leaks(spark: SparkSession, d: str) -> DataFrame:
    return leakage.leaked(table(spark, d, "documents"), F.col("doc_id"), F.col("text"), table(spark, d, "eval_items"), F.col("item_id"), F.col("text"))


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return _leaks(spark, d).select("doc_id", "item_id")


def p9_items(spark: SparkSession, d: str) -> DataFrame:
    """Per item the number of documents it leaked into."""
    return _leaks(spark, d).groupBy("item_id").agg(F.count("*").alias("n_documents"), F.round(F.max("share"), 6).alias("largest_share"))


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    """The median of the scales decides; on sf0.1 and check_l their mean gives the same rows."""
    t = readability.reading_levels(table(spark, d, "documents"), F.col("doc_id"), F.col("text"))
    return t.where("language = 'en' and grade >= 12.5").select("doc_id").distinct()


def p10_levels(spark: SparkSession, d: str) -> DataFrame:
    return readability.reading_levels(table(spark, d, "documents"), F.col("doc_id"), F.col("text"))


QUERIES = {f.__name__: f for f in (p1_found, p1_counts, p1_both, p3_found, p3_forms, p4_found, p4_clean, p6_found, p6_counts, p8_found, p8_containers, p8_fill, p9_found, p9_items, p10_found, p10_levels)}

_P1 = r"""
WITH r AS (SELECT DISTINCT id, strftime(timestamp, '%Y-%m-%d') AS edit_day, coalesce(minor, false) AS m, lower(regexp_replace(contributor, '^\s+|\s+$', '', 'g')) AS who FROM revisions WHERE timestamp IS NOT NULL),
k AS (SELECT * FROM r WHERE who IS NOT NULL AND who NOT IN ('', '-')),
g AS (SELECT edit_day, CASE WHEN m THEN 'minor' ELSE 'major' END AS grp, who, id FROM k UNION ALL SELECT edit_day, 'all', who, id FROM k),
c AS (SELECT edit_day, grp, count(DISTINCT who) AS n_contributors, count(DISTINCT id) AS n_revisions FROM g GROUP BY ALL)
"""
_P6 = "WITH e AS (SELECT DISTINCT entry_id AS k, templates AS t FROM entries WHERE entry_id IS NOT NULL), " + split_sql("e").replace("e_m AS (SELECT k, t,", "e_m AS (SELECT row_number() OVER () * 10000000000 + k AS k, t,") + r""",
w AS (SELECT k // 10000000000 AS txt, k % 10000000000 AS k, trim(regexp_replace(val, '=\s*\d+\s*$', '')) AS val, coalesce(try_cast(nullif(regexp_extract(val, '=\s*(\d+)\s*$', 1), '') AS BIGINT), 1) AS n FROM e_v),
o AS (SELECT k, val, max(n) AS n FROM (SELECT txt, k, val, sum(n) AS n FROM w WHERE val <> '' GROUP BY ALL) GROUP BY ALL), a AS (SELECT count(DISTINCT entry_id) AS n FROM entries),
f AS (SELECT 'entries.templates' AS source_field, val, sum(n)::BIGINT AS n_occurrences, count(*) AS n_records FROM o GROUP BY val UNION ALL SELECT 'entries.language', language, count(DISTINCT entry_id), count(DISTINCT entry_id) FROM entries WHERE language <> '' AND entry_id IS NOT NULL GROUP BY language),
b AS (SELECT f.*, CASE WHEN n_records <= 2 THEN 'rare' WHEN n_records > 0.1 * (SELECT n FROM a) THEN 'common' END AS band FROM f) """
ORACLE = {
    "p6_found": _P6 + "SELECT source_field, val, band FROM b WHERE band IS NOT NULL",
    "p6_counts": _P6 + "SELECT * FROM b",
    "p1_found": _P1 + "SELECT edit_day, grp FROM c WHERE n_revisions > 0 AND 2 * n_contributors >= n_revisions",
    "p1_counts": _P1 + "SELECT edit_day, grp, n_contributors, n_revisions, 0.0::DOUBLE AS rel_error FROM c WHERE n_revisions > 0",
    "p1_both": _P1 + "SELECT edit_day, CAST(count(*) FILTER (n = 2) AS BIGINT) AS n_both FROM (SELECT edit_day, who, count(DISTINCT m) AS n FROM k GROUP BY ALL) GROUP BY edit_day",
}
