"""Queries on the wiki text of page revisions, on languages, and on the words that links mean."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexweave.functions import wikitext
from lexweave.operators import languages as L
from lexweave.operators import pages as P
from lexweave.operators.shred import assemble, shred
from lexweave.plans import graph_queries
from lexweave.plans.runtime import cut, table
from lexweave.sources import graph_files

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


def texts(spark: SparkSession, d: str) -> DataFrame:
    """(id, title, ns, text) of every revision with a text, once."""
    leaves = ["[].id", "[].text"]
    j = table(spark, d, "json_page")
    s = assemble(shred(j, F.col("id"), F.col("revision"), leaves), leaves, "[]", {"id": leaves[0], "text": leaves[1]})
    titles = j.groupBy(F.col("id").alias("rec_key")).agg(F.min("title").alias("title"), F.min("ns").alias("ns"))
    return s.where("text is not null and id is not null").join(titles, "rec_key").select(F.col("id").cast("bigint").alias("id"), "title", "ns", "text").distinct()


def langs(spark: SparkSession, d: str) -> DataFrame:
    return L.languages(table(spark, d, "language_data"))


def _codes(spark: SparkSession, d: str) -> dict[str, str]:
    return P.language_names(L.names(langs(spark, d), table(spark, d, "language_families")).where("rank < 2"))


def _collected(spark: SparkSession, d: str, *extractors: str) -> DataFrame:
    return P.collect_relations(texts(spark, d), F.col("id"), F.col("title"), F.col("text"), _codes(spark, d), extractors or None)


@query()
def e1_collect_relations(spark, d):
    """Relations of all sections that some extractor reads."""
    return _collected(spark, d)


@query()
def e2_template_relations(spark: SparkSession, d: str) -> DataFrame:
    """Relations stated by the templates of every section."""
    return wikitext.extract_relations(texts(spark, d), F.col("id"), F.col("text")).select("rec_key", "sec_pos", "tpl_pos", F.array_join("path", " > ").alias("path"), "type", "uncertain", "source_language", "language", "term", "t", "alt", "id", "name").distinct()


@query()
def e3_link_sections(spark, d):
    return _collected(spark, d, "links")


@query()
def e4_descendants(spark, d):
    return _collected(spark, d, "descendants")


@query()
def e5_etymologies(spark, d):
    return _collected(spark, d, "etymology")


@query()
def r2_rule_counts(spark, d):
    """How often each rule was used on etymologies."""
    s = P.section_texts(texts(spark, d), F.col("id"), F.col("text"), r"Etym\D*\d*$")
    n = P.rule_counts(s.select((F.col("rec_key") * 1000 + F.col("sec_pos")).alias("k"), "text"), F.col("k"), F.col("text"), _codes(spark, d))
    return n.groupBy("rule").agg(F.sum("n").alias("n"))


@query()
def s6_language_entries(spark, d):
    """Entries of a page, one per language."""
    e = P.language_entries(texts(spark, d), F.col("id"), F.col("title"), F.col("text"))
    return e.select("rec_key", "entry_pos", "language", F.size("sections").alias("n_sections"), F.array_join(F.transform("sections", lambda p: F.array_join(p, " > ")), "|").alias("sections"), "etym_count")


@query()
def f9_section_texts(spark, d):
    """Etymology and descendants sections of main pages with all below them."""
    s = P.section_texts(texts(spark, d).where("ns = 0"), F.col("id"), F.col("text"), "(?:Etym|Descend)", subsections=True)
    return s.select("rec_key", "sec_pos", F.array_join("path", " > ").alias("path"), "text")


@query()
def f10_templates_in_context(spark, d):
    """Templates of two names with the text around."""
    t = P.section_templates(texts(spark, d), F.col("id"), F.col("text"), frozenset({"affix", "desc"}), 20)
    return t.select("rec_key", "sec_pos", "place", "name", "context")


@query()
def a5_templates_by_section(spark, d):
    """Names of templates per kind of section, plain links among them (A5)."""
    return P.section_templates(texts(spark, d), F.col("id"), F.col("text")).groupBy("section", "name").agg(F.count("*").alias("n"))


@query()
def a8_template_share(spark, d):
    """The share of each template among the templates of its kind of section, links not counted."""
    n = a5_templates_by_section(spark, d)
    total = n.groupBy("section").agg(F.sum(F.when(F.col("name") != "WIKILINK", F.col("n"))).alias("total"))
    return n.join(total, "section").where("total > 0").select("section", "name", "n", F.round(F.col("n") / F.col("total"), 6).alias("share"))


@query()
def a9_section_classes(spark, d):
    """Each section by the first class that one of its templates has: origin, sibling, related, unhandled; else
    no_templates or empty (A9)."""
    from lexweave.functions.wikitext import NAMES, sections
    from lexweave.operators.ontology import is_a

    def rank(name: str) -> int:
        kind = (NAMES.get(name) or ("related" if name.endswith(("-of", " of")) else "")).rstrip("*")
        return 3 if not kind else 0 if is_a(kind, "origin") else 1 if is_a(kind, "sibling") else 2

    def rows(_, text):
        for i, (path, body) in enumerate(sections(text), 1):
            names = [wikitext.arguments(inside)[0] for _, _, inside in wikitext.templates(body)]
            kind = ("origin", "sibling", "related", "unhandled")[min(map(rank, names))] if names else "no_templates" if body.strip() else "empty"
            yield i, path[-1].rstrip("0123456789 "), kind

    s = P.flat_map(texts(spark, d), F.col("id"), F.lit(""), F.col("text"), "rec_key bigint, sec_pos int, section string, class string", rows)
    return s.groupBy("section", "class").agg(F.count("*").alias("n"))


@query()
def t4_plain_texts(spark, d):
    return P.plain_texts(texts(spark, d), F.col("id"), F.col("text"))


@query()
def t16_glosses(spark, d):
    g = P.glosses(texts(spark, d), F.col("id"), F.col("title"), F.col("text"))
    return g.withColumn("labels", F.array_join("labels", ", ")).withColumn("links", F.array_join("links", ", "))


@query()
def t17_pronunciations(spark, d):
    return P.pronunciations(texts(spark, d), F.col("id"), F.col("title"), F.col("text"))


@query()
def t18_lexemes(spark, d):
    return P.lexemes(texts(spark, d), F.col("id"), F.col("title"), F.col("text"))


_IRI = "'<urn:lexweave:' || replace(replace(url_encode(regexp_replace({0}, '\\s+', '_', 'g')), '%2A', '*'), '~', '%7E') || '>'"


@query(f"WITH {graph_queries._E}, l AS (SELECT *, '<urn:lexweave:link/' || sha1(concat_ws('|', src, tgt, type)) || '>' AS link FROM e) SELECT DISTINCT unnest([link || ' <urn:lexweave:source> ' || {_IRI.format('src')} || ' .', link || ' <urn:lexweave:target> ' || {_IRI.format('tgt')} || ' .', link || ' <urn:lexweave:type> \"' || type || '\" .']) AS value FROM l")
def s18_triples(spark: SparkSession, d: str) -> DataFrame:
    return graph_files.triples(graph_queries.edges(spark, d)).distinct()


_TR = "(SELECT code, min(nullif(trim(canonical_name), '')) AS name, min(nullif(trim(parent), '')) AS parent, min(nullif(trim(family), '')) AS family, min(nullif(trim(other_names), '')) AS other_names FROM language_data WHERE code IS NOT NULL GROUP BY code)"
_SPLIT = r"""list_filter(list_transform(regexp_split_to_array(coalesce({0}, ''), '[,;|/\n\t]+'), lambda x: regexp_replace(x, '^[\s"“]+|[\s"”]+$', '', 'g')), lambda x: x <> '')"""
_NAMES = f"""la AS {_TR}, nm AS (SELECT name, code, CASE WHEN family IS NOT NULL THEN 0 ELSE 1 END AS rank FROM la UNION SELECT unnest({_SPLIT.format('other_names')}), code, 2 FROM la
 UNION SELECT nullif(trim(canonical_name), ''), code, 3 FROM language_families UNION SELECT unnest({_SPLIT.format('other_names')}), code, 4 FROM language_families), kn AS (SELECT * FROM nm WHERE name IS NOT NULL AND code IS NOT NULL)"""


@query(f"WITH {_NAMES} SELECT name, arg_min(code, rank::VARCHAR || code) AS code, count(DISTINCT code) AS n_options FROM kn GROUP BY name")
def x18_name_to_code(spark, d):
    known = cut(L.names(langs(spark, d), table(spark, d, "language_families")))
    return L.code_of(known, known).select("name", "code", F.size("options").cast("bigint").alias("n_options"))


@query(f"WITH la AS {_TR}, fa AS (SELECT DISTINCT code FROM language_families), p AS (SELECT name, min(code) AS code FROM la GROUP BY name) SELECT la.code, CASE WHEN p.code <> la.code THEN p.code END AS parent_code, fa.code AS family_code FROM la LEFT JOIN p ON la.parent = p.name LEFT JOIN fa ON la.family = fa.code")
def x19_parents(spark, d):
    """Parent and family of each language."""
    return L.parent_code(langs(spark, d), table(spark, d, "language_families"))


@query(f"WITH la AS {_TR} SELECT code, name || ' (' || code || ')' AS shown, code AS back FROM la")
def x21_display(spark, d):
    shown = L.display(F.col("code"), F.col("name"))
    return langs(spark, d).select("code", shown.alias("shown"), F.when(shown.isNotNull(), L.display_code(shown)).otherwise(F.col("code")).alias("back"))


@query()
def x17_normalized_terms(spark, d):
    """Every term in the spelling its language looks it up by."""
    n = table(spark, d, "node").select("node_id", "term", "language").where("term is not null").distinct()
    return L.normalized(n, langs(spark, d)).select("node_id", "normalized")


@query("SELECT language, count(DISTINCT entry_id) AS n FROM entries WHERE language IS NOT NULL AND language <> '' AND language NOT IN (SELECT code FROM language_data WHERE code IS NOT NULL) GROUP BY 1")
def a28_unknown_codes(spark, d):
    """Languages of entries that no table of languages has."""
    e = table(spark, d, "entries").select("entry_id", "language").where("language <> ''").distinct()
    known = table(spark, d, "language_data").select(F.col("code").alias("language")).distinct()
    return e.groupBy("language").agg(F.count_distinct("entry_id").alias("n")).join(known, "language", "left_anti")
