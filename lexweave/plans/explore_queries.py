"""Selections of nodes and paths, labels, attribute predicates: the query layer over the relation graph."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexweave.operators import explore as X
from lexweave.operators import graph as G
from lexweave.operators import ontology as O
from lexweave.plans.graph_queries import _E as _EDGES
from lexweave.operators import languages as L
from lexweave.operators import resolve as R
from lexweave.plans.graph_queries import edges
from lexweave.plans.relational_queries import _S as _SECTIONS
from lexweave.plans.relational_queries import section_rows
from lexweave.plans.runtime import table
from lexweave.plans.text_queries import langs

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


def nodes(spark: SparkSession, d: str) -> DataFrame:
    """(node, kind, term, language, gloss, labels): each lexeme once, with the labels that follow from its attributes."""
    key = F.concat_ws("#", "term", "language", F.coalesce("sense_idx", F.lit(0)).cast("string"))
    n = table(spark, d, "node").where("term is not null").groupBy(key.alias("node")).agg(F.min("kind").alias("kind"), F.min("term").alias("term"), F.min("language").alias("language"), F.min(F.nullif("gloss", F.lit(""))).alias("gloss"))
    labels = F.array_compact(F.array(F.lit("Word"), F.when(F.contains("term", F.lit(" ")), "Multiword"), F.when(F.startswith("term", F.lit("*")), "Reconstructed"), F.when(F.col("kind") == "no_entry", "NAE")))
    return n.withColumn("labels", labels)


_NODES = "nd AS (SELECT concat_ws('#', term, language, coalesce(sense_idx, 0)::VARCHAR) AS node, min(kind) AS kind, min(term) AS term, min(language) AS language, min(nullif(gloss, '')) AS gloss FROM node WHERE term IS NOT NULL GROUP BY 1)"
_ORIGIN = "('" + "','".join(O.DIRECTED) + "')"


_HUB = "hu AS (SELECT src AS hub FROM e GROUP BY src ORDER BY count(*) DESC, src LIMIT 1), ht AS (SELECT term FROM nd WHERE node = (SELECT hub FROM hu))"


def _hub_term(spark: SparkSession, d: str) -> str:
    """The term whose lexeme has most links."""
    return edges(spark, d).groupBy("src").count().orderBy(F.desc("count"), "src").limit(1).select(F.element_at(F.split("src", "#"), 1)).first()[0]


_BOTH = f"WITH RECURSIVE {_EDGES}, {_NODES}, {_HUB}, so AS (SELECT node FROM nd WHERE term = (SELECT term FROM ht)), bo AS (SELECT src AS a, tgt AS b, ord || '|' || type AS eid FROM e UNION ALL SELECT tgt, src, ord || '|' || type FROM e WHERE src <> tgt)"


@query(f"{_BOTH} SELECT so.node AS start, bo.b AS node, 1 AS length, bo.eid AS links FROM so JOIN bo ON bo.a = so.node WHERE bo.b IN (SELECT node FROM nd) ORDER BY start, node, links LIMIT 10")
def q1_simple_query(spark, d):
    """The words of one term with what is one link away: ten paths."""
    q = X.PathQuery(X.NodeFilter(terms=(_hub_term(spark, d),)), every=X.NodeFilter(), types=("related",), depth=1)
    return X.find_paths(edges(spark, d), nodes(spark, d), q).withColumn("links", F.array_join("links", ","))


@query(f"WITH RECURSIVE {_EDGES}, {_NODES}, ok AS (SELECT node, language FROM nd WHERE NOT contains(term, ' ')), f AS (SELECT src AS a, tgt AS b, ord || '|' || type AS eid FROM e WHERE type IN {_ORIGIN} AND src IN (SELECT node FROM ok) AND tgt IN (SELECT node FROM ok)), p AS (SELECT node AS start, node, 0 AS length, []::VARCHAR[] AS l FROM ok WHERE language IN ('la', 'ang', 'enm') UNION ALL SELECT p.start, f.b, p.length + 1, list_append(l, f.eid) FROM p JOIN f ON p.node = f.a WHERE p.length < 3 AND NOT list_contains(l, f.eid)) SELECT start, node, length, array_to_string(l, ',') AS links FROM p WHERE length > 0")
def q2_pattern_query(spark, d):
    """Paths of up to three origin links from words of three languages, all nodes on them of one word."""
    q = X.PathQuery(X.NodeFilter(languages=("la", "ang", "enm")), depth=3, direction="out", limit=None)
    return X.find_paths(edges(spark, d), nodes(spark, d), q).withColumn("links", F.array_join("links", ","))


@query(f"WITH {_EDGES}, {_NODES} SELECT nd.node, count(DISTINCT gl.gloss) AS n_glosses FROM nd LEFT JOIN (SELECT concat_ws('#', term, language, coalesce(sense_idx, 0)::VARCHAR) AS node, gloss FROM node WHERE gloss <> '') gl ON nd.node = gl.node GROUP BY 1")
def q3_node_details(spark, d):
    """Every node with its attributes, an empty list where it has none."""
    key = F.concat_ws("#", "term", "language", F.coalesce("sense_idx", F.lit(0)).cast("string"))
    g = table(spark, d, "node").where("gloss <> ''").select(key.alias("node"), F.lit("gloss").alias("kind"), F.col("gloss").alias("value"))
    return X.details(nodes(spark, d).select("node"), g).select("node", F.size("values").cast("bigint").alias("n_glosses"))


@query(f"WITH {_NODES} SELECT node, array_to_string(list_sort(['Word'] || CASE WHEN term LIKE '% %' THEN ['Multiword'] ELSE [] END || CASE WHEN term LIKE '*%' THEN ['Reconstructed'] ELSE [] END || CASE WHEN kind = 'no_entry' THEN ['NAE'] ELSE [] END || CASE WHEN language = 'en' AND coalesce(gloss, '') = '' THEN ['NoGloss'] ELSE [] END), ',') AS labels FROM nd")
def q4_labels(spark, d):
    """A label put on the nodes without gloss and taken from those of other languages; the rest keep theirs."""
    n = X.add_label(nodes(spark, d), "NoGloss", F.col("gloss").isNull())
    n = X.drop_label(n, "NoGloss", F.coalesce(F.col("language") != "en", F.lit(True)))
    return n.select("node", F.array_join(F.array_sort("labels"), ",").alias("labels"))


@query(f"{_BOTH}, nb AS (SELECT DISTINCT e.* FROM e WHERE src = (SELECT hub FROM hu) OR tgt = (SELECT hub FROM hu)) SELECT node AS id FROM nd WHERE node IN (SELECT src FROM nb UNION SELECT tgt FROM nb) AND node <> (SELECT min(tgt) FROM nb WHERE tgt <> (SELECT hub FROM hu)) UNION SELECT src || '|' || tgt || '|' || type FROM nb WHERE (SELECT min(tgt) FROM nb WHERE tgt <> (SELECT hub FROM hu)) NOT IN (src, tgt)")
def q6_expand_and_prune(spark, d):
    """What is shown after a click on the node with most links, and one of its neighbours taken away (Q6, Q8, U4)."""
    e, n = edges(spark, d), nodes(spark, d)
    hub = e.groupBy("src").count().orderBy(F.desc("count"), "src").limit(1).select(F.col("src").alias("node"))
    shown = X.expand(X.node_elements(n.limit(0)), e, n, hub)
    h = hub.first()[0]
    gone = e.where(((F.col("src") == h) | (F.col("tgt") == h)) & (F.col("tgt") != h)).agg(F.min("tgt").alias("node"))
    return X.take(shown, gone).select("id")


@query(f"WITH {_NODES} SELECT node, gloss FROM nd WHERE regexp_matches(gloss, '(wagon|river)$') AND kind <> 'stub'")
def f18_attribute_predicates(spark, d):
    return nodes(spark, d).where(F.col("gloss").rlike("(wagon|river)$") & (F.col("kind") != "stub")).select("node", "gloss")


@query("WITH e AS (SELECT DISTINCT ord, type FROM relation WHERE type IS NOT NULL) SELECT ord, type FROM e WHERE type IN ('" + "','".join(O.below("borrowing", "affix")) + "')")
def f19_hierarchy_expand(spark, d):
    """Types selected with everything below them."""
    return table(spark, d, "relation").select("ord", "type").distinct().where(F.col("type").isin(*O.below("borrowing", "affix")))


@query("WITH x AS (SELECT DISTINCT node_id, term, language, sense_idx, kind, gloss FROM node WHERE term IS NOT NULL), m AS (SELECT DISTINCT ord, tgt.term AS term, tgt.language AS language, tgt.sense_idx AS sense FROM relation WHERE tgt.term IS NOT NULL) SELECT m.ord, x.node_id FROM m JOIN x ON m.term = x.term AND m.language IS NOT DISTINCT FROM x.language QUALIFY row_number() OVER (PARTITION BY m.ord, m.term, m.language, m.sense ORDER BY CASE WHEN kind = 'stub' THEN 0 WHEN x.sense_idx = m.sense THEN 1 WHEN gloss <> '' THEN 2 ELSE 3 END, coalesce(x.sense_idx, 0), x.node_id) = 1")
def n6_homonym_choice(spark, d):
    """The lexeme meant by each mention: a stub, else the sense named, else one with a gloss, else the first."""
    x = table(spark, d, "node").where("term is not null").select("node_id", "term", "language", F.col("sense_idx").alias("s"), "kind", "gloss").distinct()
    m = table(spark, d, "relation").where("tgt.term is not null").select("ord", F.col("tgt.term").alias("mt"), F.col("tgt.language").alias("ml"), F.col("tgt.sense_idx").alias("sense")).distinct()
    rank = F.when(F.col("kind") == "stub", 0).when(F.col("s") == F.col("sense"), 1).when(F.col("gloss") != "", 2).otherwise(3)
    j = m.join(x, (F.col("mt") == F.col("term")) & F.col("ml").eqNullSafe(F.col("language")))
    best = F.min(F.struct(rank, F.coalesce("s", F.lit(0)), "node_id"))["node_id"]
    return j.groupBy("ord", "mt", "ml", "sense").agg(best.alias("node_id")).select("ord", "node_id")


@query("SELECT term, language, count(DISTINCT coalesce(sense_idx, 0)) AS n_senses, count(DISTINCT coalesce(sense_idx, 0)) = 1 AS single FROM node WHERE term IS NOT NULL GROUP BY ALL")
def n1_lexicon_split(spark, d):
    """Words with one sense and with several."""
    return R.lexicon_index(table(spark, d, "node"))


@query(f"WITH {_SECTIONS}, l AS (SELECT *, CASE WHEN path[1] IS NOT DISTINCT FROM lag(path[1]) OVER w AND row_number() OVER w > 1 THEN 0 ELSE 1 END AS s FROM sc WINDOW w AS (PARTITION BY page_id, rev_id ORDER BY sec_pos)), g AS (SELECT page_id, rev_id, path[1] AS head, sum(s) OVER (PARTITION BY page_id, rev_id ORDER BY sec_pos) AS run FROM l) SELECT page_id, rev_id, run::BIGINT AS run, any_value(head) AS head, count(*) AS n FROM g GROUP BY page_id, rev_id, run")
def w15_run_grouping(spark, d):
    """Consecutive sections of a page under one top heading."""
    s = section_rows(spark, d).withColumn("head", F.try_element_at("path", F.lit(1)))
    w = Window.partitionBy("page_id", "rev_id").orderBy("sec_pos")  # the sections of one page
    new = F.when(F.col("head").eqNullSafe(F.lag("head").over(w)) & (F.row_number().over(w) > 1), 0).otherwise(1)
    run = F.sum("s").over(w.rowsBetween(Window.unboundedPreceding, 0))
    return s.withColumn("s", new).withColumn("run", run).groupBy("page_id", "rev_id", "run").agg(F.any_value("head").alias("head"), F.count("*").alias("n"))


@query(f"WITH RECURSIVE la AS (SELECT code, min(canonical_name) AS name, min(nullif(parent, '')) AS parent FROM language_data GROUP BY code), pa AS (SELECT l.code, min(p.code) AS parent FROM la l JOIN la p ON l.parent = p.name WHERE p.code <> l.code GROUP BY 1), top AS (SELECT parent FROM pa GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 3), b AS (SELECT parent AS top, parent AS code FROM top UNION SELECT b.top, pa.code FROM b JOIN pa ON pa.parent = b.code) SELECT top, code FROM b")
def f19_language_expand(spark, d):
    """Three languages with all that descend from them."""
    p = L.parent_code(langs(spark, d), table(spark, d, "language_families")).where("parent_code is not null").select(F.col("parent_code").alias("src"), F.col("code").alias("tgt"))
    top = p.groupBy(F.col("src").alias("node")).count().orderBy(F.desc("count"), "node").limit(3).select("node")
    return G.bfs(p, top, 1_000_000).select(F.col("source").alias("top"), F.col("node").alias("code"))
