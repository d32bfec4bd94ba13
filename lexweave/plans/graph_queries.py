"""Graph queries (reduction, algorithms, neighbourhoods) and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexweave.operators import graph as G
from lexweave.operators import hierarchy as H
from lexweave.operators import ontology as O
from lexweave.plans.core_queries import _FAM
from lexweave.plans.runtime import cut, salted_join, table

Q: dict = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        Q[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


def edges(spark: SparkSession, d: str) -> DataFrame:
    return G.edges_of(table(spark, d, "relation"))


def simple(spark: SparkSession, d: str) -> DataFrame:
    """(src, tgt): the whole relation graph without loops and parallel edges."""
    return G.no_self_loops(edges(spark, d)).select("src", "tgt").distinct()


#: So low that communities part only where hardly any links join them.
RESOLUTION = 1e-4


def largest_component(e: DataFrame) -> DataFrame:
    """(src, tgt) of the component with most nodes, the smallest name on a tie."""
    e = cut(G.no_self_loops(e).select("src", "tgt").distinct())
    label = G.weak_components(e)
    top = label.groupBy("component").count().orderBy(F.desc("count"), "component").limit(1)
    return e.join(label.join(F.broadcast(top), "component").select(F.col("node").alias("src")), "src", "left_semi")


def acyclic(e: DataFrame) -> DataFrame:
    """``e`` without the edges that lie on a cycle."""
    e = cut(e)
    return cut(e.join(G.on_cycles(e, G.strong_components(e)).select("src", "tgt"), ["src", "tgt"], "left_anti"))


def language_tree(e: DataFrame, min_count: int = 8, min_odds: float = 0.8) -> DataFrame:
    """(src, tgt, odds): the older and the younger language, by the inheritance and root edges.

    A pair needs so many links both ways together and a greater share than ``min_odds`` one way; edges on cycles go, then
    those that longer paths imply.
    """
    lang = lambda c: F.element_at(F.split(c, "#"), -2)
    c = cut(e.where("type in ('inheritance', 'root')").select(lang("src").alias("src"), lang("tgt").alias("tgt")).where("src <> tgt").groupBy("src", "tgt").agg(F.count("*").alias("n")))
    r = c.select(F.col("tgt").alias("src"), F.col("src").alias("tgt"), F.col("n").alias("m"))
    both = F.col("n") + F.coalesce("m", F.lit(0))
    tree = cut(c.join(r, ["src", "tgt"], "left").withColumn("odds", F.col("n") / both).where((both >= min_count) & (F.col("odds") > min_odds)).select("src", "tgt", "odds"))
    dag = acyclic(tree.select("src", "tgt"))
    kept = dag.join(G.implied_edges(dag), ["src", "tgt"], "left_anti")
    return tree.join(kept, ["src", "tgt"], "left_semi")


_IN = "('" + "','".join(O.PARENT) + "')"
_E = f"""e AS (SELECT DISTINCT concat_ws('#', src.term, src.language, coalesce(src.sense_idx, 0)::VARCHAR) AS src, concat_ws('#', tgt.term, tgt.language, coalesce(tgt.sense_idx, 0)::VARCHAR) AS tgt,
 CASE WHEN lower(trim(type)) IN {_IN} THEN lower(trim(type)) ELSE 'related' END AS type, nullif(text, '') AS text, coalesce(uncertain, false) AS uncertain, ord FROM relation WHERE src.term IS NOT NULL AND tgt.term IS NOT NULL)"""
_UP = "up(type, ancestor) AS (VALUES " + ", ".join(f"('{t}','{a}')" for t in O.PARENT for a in O.ancestors(t)[1:]) + ")"
_DIR = "('" + "','".join(O.DIRECTED) + "')"
_SIB = "('" + "','".join(O.SIBLING) + "')"


def _reduced(e: str) -> str:
    """CTEs for the edges of ``e`` that lie on no cycle and that no longer path implies, as ``{e}_kept``."""
    return f"""{e}_re AS (SELECT src AS a, tgt AS b FROM {e} UNION SELECT r.a, x.tgt FROM {e}_re r JOIN {e} x ON r.b = x.src), {e}_dg AS (SELECT src, tgt FROM {e} WHERE (tgt, src) NOT IN (SELECT (a, b) FROM {e}_re)),
 {e}_rd AS (SELECT src AS a, tgt AS b FROM {e}_dg UNION SELECT r.a, x.tgt FROM {e}_rd r JOIN {e}_dg x ON r.b = x.src), {e}_kept AS (SELECT src, tgt FROM {e}_dg g WHERE NOT EXISTS (SELECT 1 FROM {e}_dg w JOIN {e}_rd r ON r.a = w.tgt WHERE w.src = g.src AND r.b = g.tgt))"""


_LANGS = """lx AS (SELECT string_split(src, '#')[-2] AS a, string_split(tgt, '#')[-2] AS b FROM e WHERE type IN ('inheritance', 'root')), ln AS (SELECT a, b, count(*) AS n FROM lx WHERE a <> b GROUP BY ALL),
 lt AS (SELECT c.a AS src, c.b AS tgt, c.n / (c.n + coalesce(r.n, 0)) AS odds FROM ln c LEFT JOIN ln r ON c.a = r.b AND c.b = r.a WHERE c.n + coalesce(r.n, 0) >= 8 AND c.n / (c.n + coalesce(r.n, 0)) > 0.8)"""


@query(f"WITH {_E} SELECT src, type, ord FROM e WHERE src = tgt")
def g1_self_loops(spark, d):
    return edges(spark, d).where("src = tgt").select("src", "type", "ord")


@query(f"WITH {_E}, {_UP}, p AS (SELECT src, tgt, type, bool_or(uncertain) u, min(ord) o FROM e WHERE src <> tgt AND type IN {_DIR} GROUP BY ALL) SELECT p.src, p.tgt, p.type, bool_or(q.u) AS uncertain, min(q.o) AS ord FROM p JOIN p q ON p.src = q.src AND p.tgt = q.tgt AND (q.type = p.type OR (p.type, q.type) IN (SELECT (type, ancestor) FROM up)) WHERE NOT EXISTS (SELECT 1 FROM p r JOIN up ON up.type = r.type WHERE r.src = p.src AND r.tgt = p.tgt AND up.ancestor = p.type) GROUP BY ALL")
def g2_lattice_merge(spark, d):
    e = edges(spark, d)
    return G.merge_types(G.no_self_loops(e).where(F.col("type").isin(*O.DIRECTED))).select("src", "tgt", "type", "uncertain", "ord")


@query(f"WITH {_E} SELECT least(src, tgt) AS src, greatest(src, tgt) AS tgt, type, bool_or(uncertain) AS uncertain FROM e WHERE src <> tgt AND type IN {_SIB} GROUP BY 1, 2, 3")
def g3_sibling_pairs(spark, d):
    e = G.no_self_loops(edges(spark, d)).where(F.col("type").isin(*O.SIBLING))
    return G.merge_types(G.undirected(e)).select("src", "tgt", "type", "uncertain")


@query(f"WITH {_E}, r AS (SELECT DISTINCT least(src, tgt) AS src, greatest(src, tgt) AS tgt FROM e WHERE src <> tgt AND type = 'related'), c AS (SELECT DISTINCT least(src, tgt) AS src, greatest(src, tgt) AS tgt FROM e WHERE src <> tgt AND type <> 'related') SELECT * FROM r WHERE (src, tgt) NOT IN (SELECT (src, tgt) FROM c)")
def g4_related_absorb(spark, d):
    return G.absorb_related(edges(spark, d)).where("type = 'related'").select("src", "tgt")


@query(f"WITH {_E} SELECT least(src, tgt) AS a, greatest(src, tgt) AS b, count(*) AS n, bool_or(uncertain) AS uncertain, string_agg(text, '; ' ORDER BY ord) AS text FROM e WHERE src <> tgt GROUP BY 1, 2")
def g5_attribute_merge(spark, d):
    """Per pair of nodes the merged text and uncertainty of all its edges, as if they were of one type."""
    e = cut(G.undirected(G.no_self_loops(edges(spark, d))))
    n = e.groupBy(F.col("src").alias("a"), F.col("tgt").alias("b")).agg(F.count("*").alias("n"))
    m = G.merge_types(e.withColumn("type", F.lit("related"))).select(F.col("src").alias("a"), F.col("tgt").alias("b"), "uncertain", "text")
    return n.join(m, ["a", "b"])


_LANGTREE = """la AS (SELECT code, min(canonical_name) AS name, min(nullif(parent, '')) AS parent FROM language_data GROUP BY code), lp AS (SELECT p.code AS old, l.code AS young FROM la l JOIN la p ON l.parent = p.name WHERE l.code <> p.code),
lc AS (SELECT old, young FROM lp UNION SELECT lp.old, lc.young FROM lp JOIN lc ON lp.young = lc.old)"""


def older_languages(spark: SparkSession, d: str) -> DataFrame:
    """(old, young): the strict closure of the parents in language_data, by doubling."""
    la = table(spark, d, "language_data").groupBy("code").agg(F.min("canonical_name").alias("name"), F.min(F.nullif("parent", F.lit(""))).alias("parent"))
    names = la.select(F.col("name").alias("parent"), F.col("code").alias("old"))
    pairs = cut(la.join(names, "parent").select("old", F.col("code").alias("young")).where("old <> young").distinct())
    n = pairs.count()
    while True:
        step = pairs.join(pairs.select(F.col("old").alias("young"), F.col("young").alias("y2")), "young").select("old", F.col("y2").alias("young"))
        pairs = cut(pairs.union(step).distinct())
        if (m := pairs.count()) == n:
            return pairs
        n = m


@query(f"WITH RECURSIVE {_E}, {_LANGTREE}, x AS (SELECT *, string_split(src, '#')[-2] AS ls, string_split(tgt, '#')[-2] AS lt FROM e), y AS (SELECT x.*, type IN ('historical','inheritance','derivation','root') AND EXISTS (SELECT 1 FROM lc WHERE old = lt AND young = ls) AS t FROM x) SELECT CASE WHEN t THEN tgt ELSE src END AS src, CASE WHEN t THEN src ELSE tgt END AS tgt, type, ord FROM y")
def g6_direction_swap(spark, d):
    return G.swap_historical(edges(spark, d), older_languages(spark, d)).select("src", "tgt", "type", "ord")


#: The whole graph without loops, and all that is reached along it.
_SP = "sp AS (SELECT DISTINCT src, tgt FROM e WHERE src <> tgt)"
_REACH = "re AS (SELECT src AS a, tgt AS b FROM sp UNION SELECT re.a, sp.tgt FROM re JOIN sp ON re.b = sp.src)"


@query(f"WITH RECURSIVE {_E}, {_SP}, {_REACH} SELECT src, tgt FROM sp WHERE (tgt, src) IN (SELECT (a, b) FROM re)")
def g7_cycle_edges(spark, d):
    e = cut(simple(spark, d))
    return G.on_cycles(e, G.strong_components(e)).select("src", "tgt")


@query(f"WITH RECURSIVE {_E}, {_SP}, {_REACH}, m AS (SELECT x.a, x.b FROM re x JOIN re y ON x.a = y.b AND x.b = y.a) SELECT a AS node, min(b) AS scc FROM m GROUP BY a HAVING count(*) > 1")
def g9_scc(spark, d):
    return G.strong_components(simple(spark, d))


@query(f"WITH RECURSIVE {_E}, {_SP}, {_REACH}, dg AS (SELECT src, tgt FROM sp WHERE (tgt, src) NOT IN (SELECT (a, b) FROM re)), rd AS (SELECT src AS a, tgt AS b FROM dg UNION SELECT rd.a, dg.tgt FROM rd JOIN dg ON rd.b = dg.src) SELECT src, tgt FROM dg WHERE NOT EXISTS (SELECT 1 FROM dg w JOIN rd ON rd.a = w.tgt WHERE w.src = dg.src AND rd.b = dg.tgt)")
def g10_transitive_reduction(spark, d):
    """The whole relation graph, its cycle edges set aside, without what longer paths imply."""
    e = acyclic(simple(spark, d))
    return e.join(G.implied_edges(e), ["src", "tgt"], "left_anti")


_WEAK = "bo AS (SELECT src, tgt FROM e WHERE src <> tgt UNION SELECT tgt, src FROM e WHERE src <> tgt), wc AS (SELECT src AS a, tgt AS b FROM bo UNION SELECT wc.a, bo.tgt FROM wc JOIN bo ON wc.b = bo.src)"



@query(f"WITH RECURSIVE {_E}, {_WEAK} SELECT a AS node, least(a, min(b)) AS component FROM wc GROUP BY a")
def g11_weak_components(spark, d):
    return G.weak_components(simple(spark, d))


@query(f"WITH RECURSIVE {_E}, bo AS (SELECT src, tgt FROM e WHERE src <> tgt AND type IN {_DIR} UNION SELECT tgt, src FROM e WHERE src <> tgt AND type IN {_DIR}), wc AS (SELECT src AS a, tgt AS b FROM bo UNION SELECT wc.a, bo.tgt FROM wc JOIN bo ON wc.b = bo.src), r AS (SELECT DISTINCT least(src, tgt) AS src, greatest(src, tgt) AS tgt FROM e WHERE src <> tgt AND type = 'related') SELECT src, tgt FROM r WHERE (src, tgt) NOT IN (SELECT (a, b) FROM wc)")
def g12_intra_component_prune(spark, d):
    e = G.no_self_loops(edges(spark, d))
    related = G.undirected(e.where("type = 'related'").select("src", "tgt")).distinct()
    return G.prune_related(related, G.weak_components(e.where(F.col("type").isin(*O.DIRECTED)))).select("src", "tgt")


_SWAPPED = "x AS (SELECT *, string_split(src, '#')[-2] AS ls, string_split(tgt, '#')[-2] AS lt FROM e), y AS (SELECT x.*, type IN ('historical','inheritance','derivation','root') AND EXISTS (SELECT 1 FROM lc WHERE old = lt AND young = ls) AS t FROM x)"
_CONNECTED = "{0}_bo AS (SELECT src, tgt FROM {0} UNION SELECT tgt, src FROM {0}), {0}_wc AS (SELECT src AS a, tgt AS b FROM {0}_bo UNION SELECT w.a, o.tgt FROM {0}_wc w JOIN {0}_bo o ON w.b = o.src)"


_REDUCED = f"""WITH RECURSIVE {_E}, {_LANGTREE}, {_SWAPPED}, {_UP},
nl AS (SELECT CASE WHEN t THEN tgt ELSE src END AS src, CASE WHEN t THEN src ELSE tgt END AS tgt, type, text, uncertain, ord FROM y WHERE src <> tgt),
m0 AS (SELECT 'o' AS k, * FROM nl WHERE type IN {_DIR} UNION ALL SELECT CASE WHEN type = 'related' THEN 'r' ELSE 's' END, least(src, tgt), greatest(src, tgt), type, text, uncertain, ord FROM nl WHERE type = 'related' OR type IN {_SIB}),
st AS (SELECT DISTINCT k, src, tgt, type FROM m0 a WHERE NOT EXISTS (SELECT 1 FROM m0 b JOIN up ON up.type = b.type WHERE b.k = a.k AND b.src = a.src AND b.tgt = a.tgt AND up.ancestor = a.type)),
g AS (SELECT st.k, st.src, st.tgt, st.type, string_agg(m.text, '; ' ORDER BY m.ord, m.text) AS text, bool_or(m.uncertain) AS uncertain, min(m.ord) AS ord FROM st JOIN m0 m ON m.k = st.k AND m.src = st.src AND m.tgt = st.tgt AND (m.type = st.type OR (st.type, m.type) IN (SELECT (type, ancestor) FROM up)) GROUP BY ALL),
fi AS (SELECT k, src, tgt, type FROM g WHERE k <> 'r' QUALIFY row_number() OVER (PARTITION BY least(src, tgt), greatest(src, tgt) ORDER BY k, ord, type, src) = 1),
cl AS (SELECT g.k, g.src, g.tgt, g.type, nullif(concat_ws('; ', g.text, r.text), '') AS text, g.uncertain OR coalesce(r.uncertain, false) AS uncertain, g.ord FROM g LEFT JOIN fi USING (k, src, tgt, type) LEFT JOIN (SELECT src AS a, tgt AS b, text, uncertain FROM g WHERE k = 'r') r ON fi.k IS NOT NULL AND r.a = least(g.src, g.tgt) AND r.b = greatest(g.src, g.tgt) AND (g.k, g.src, g.tgt, g.type) IN (SELECT (k, src, tgt, type) FROM fi) WHERE g.k <> 'r'),
rl AS (SELECT * FROM g WHERE k = 'r' AND (src, tgt) NOT IN (SELECT (least(src, tgt), greatest(src, tgt)) FROM fi)),
rk AS (SELECT *, row_number() OVER (PARTITION BY least(src, tgt), greatest(src, tgt) ORDER BY ord, type, src) AS nth FROM cl WHERE k = 'o'),
gm AS (SELECT src, tgt FROM rk WHERE nth = 1), {_reduced('gm')}, sb AS (SELECT src, tgt FROM cl WHERE k = 's'), {_CONNECTED.format('gm_kept')}, {_CONNECTED.format('sb')}"""


@query(f"""{_REDUCED}
SELECT src, tgt, type, text, uncertain, CASE WHEN (src, tgt) IN (SELECT (src, tgt) FROM gm_kept) AND nth = 1 THEN 'origin' ELSE 'aside' END AS store FROM rk WHERE nth > 1 OR (src, tgt) IN (SELECT (src, tgt) FROM gm_kept) OR (src, tgt) NOT IN (SELECT (src, tgt) FROM gm_dg)
UNION ALL SELECT src, tgt, type, text, uncertain, 'sibling' FROM cl WHERE k = 's' UNION ALL SELECT src, tgt, type, text, uncertain, 'related' FROM rl WHERE (src, tgt) NOT IN (SELECT (a, b) FROM gm_kept_wc) AND (src, tgt) NOT IN (SELECT (a, b) FROM sb_wc)""")
def g13_full_reduction(spark, d):
    """The whole graph reduced: the flagship."""
    return G.reduce_graph(edges(spark, d), older_languages(spark, d)).select("src", "tgt", "type", "text", "uncertain", "store")


@query(f"""{_REDUCED}, t AS (SELECT count(*) AS rows, count(*) FILTER ((k, src, tgt, type) IN (SELECT (k, src, tgt, type) FROM g)) AS kept FROM m0), c AS (SELECT (SELECT count(*) FROM g) AS g, (SELECT count(*) FROM g WHERE k = 'o') AS o, (SELECT count(*) FROM g WHERE k = 'r') AS r,
 (SELECT count(*) FROM rk WHERE nth > 1 OR (src, tgt) NOT IN (SELECT (src, tgt) FROM gm_dg)) AS aside, (SELECT count(*) FROM rk WHERE nth = 1 AND (src, tgt) IN (SELECT (src, tgt) FROM gm_kept)) AS origin, (SELECT count(*) FROM rl) AS rl, (SELECT count(*) FROM rl WHERE (src, tgt) NOT IN (SELECT (a, b) FROM gm_kept_wc) AND (src, tgt) NOT IN (SELECT (a, b) FROM sb_wc)) AS rest)
SELECT 'language swap' AS event, (SELECT count(*) FROM y WHERE t AND (tgt, src, type, ord) NOT IN (SELECT (src, tgt, type, ord) FROM e)) AS n UNION ALL SELECT 'self loop', (SELECT count(*) FROM y WHERE src = tgt) UNION ALL SELECT 'merge equal', kept - g FROM t, c UNION ALL SELECT 'merge more specific', rows - kept FROM t UNION ALL SELECT 'incompatible', o - (SELECT count(DISTINCT (src, tgt)) FROM g WHERE k = 'o') FROM c
UNION ALL SELECT 'shelved', aside FROM c UNION ALL SELECT 'transitive', o - origin - aside FROM c UNION ALL SELECT 'absorbed', r - rl FROM c UNION ALL SELECT 'within components', rl - rest FROM c""")
def a15_reduction_events(spark, d):
    """What each step of the reduction did."""
    return G.reduction_events(G.edge_rows(table(spark, d, "relation")), older_languages(spark, d))


@query(f"WITH RECURSIVE {_E}, {_LANGS}, {_reduced('lt')} SELECT lt.src, lt.tgt, round(odds, 6) AS odds FROM lt JOIN lt_kept k ON lt.src = k.src AND lt.tgt = k.tgt")
def g14_tree_inference(spark, d):
    """The tree of languages by how often inherited words went one way rather than the other (A27, J6), without cycles
    and without what longer paths imply."""
    return language_tree(edges(spark, d)).select("src", "tgt", F.round("odds", 6).alias("odds"))


@query(f"""{_FAM.rstrip().rstrip(",")}, {_E}, {_LANGS}, {_reduced('lt')},
la AS (SELECT code, min(canonical_name) AS name, min(nullif(parent, '')) AS parent, min(nullif(family, '')) AS family FROM language_data GROUP BY code), fa AS (SELECT DISTINCT code FROM language_families),
kn AS (SELECT coalesce('L' || p.code, 'F' || f.code) AS src, 'L' || l.code AS tgt FROM la l LEFT JOIN (SELECT name, min(code) AS code FROM la GROUP BY name) p ON l.parent = p.name LEFT JOIN fa f ON l.family = f.code UNION SELECT 'F' || parent, 'F' || code FROM lnk),
kk AS (SELECT 'L' || code AS node FROM la UNION SELECT kn.src FROM kn JOIN kk ON kn.tgt = kk.node WHERE kn.src IS NOT NULL),
gt AS (SELECT src, tgt FROM kn WHERE src <> tgt AND tgt IN (SELECT node FROM kk) UNION SELECT 'L' || src, 'L' || tgt FROM lt_kept WHERE src IN (SELECT code FROM la) AND tgt IN (SELECT code FROM la)), {_reduced('gt')}
SELECT substr(src, 2) AS parent, substr(tgt, 2) AS child FROM gt_kept""")
def g15_language_tree(spark, d):
    """The families and languages above every language, reduced.

    Edges are those from a language's parent, or its family where no parent is known, from a family's parent family and
    of the inferred tree. Families without a language below are left out, and edges on cycles are set aside.
    """
    la = cut(table(spark, d, "language_data").groupBy("code").agg(F.min("canonical_name").alias("name"), F.min(F.nullif("parent", F.lit(""))).alias("parent"), F.min(F.nullif("family", F.lit(""))).alias("family")))
    p = la.groupBy(F.col("name").alias("parent")).agg(F.min("code").alias("p"))
    fa = table(spark, d, "language_families")
    f = fa.select(F.col("code").alias("family"), F.col("code").alias("f")).distinct()
    # a language and a family may have one code
    kind = lambda k, c: F.concat(F.lit(k), F.col(c))
    own = la.join(p, "parent", "left").join(f, "family", "left").select(F.coalesce(kind("L", "p"), kind("F", "f")).alias("src"), kind("L", "code").alias("tgt"))
    links = H.resolve_parents(fa, F.col("code"), F.col("canonical_name"), F.col("parent_family")).select(kind("F", "parent").alias("src"), kind("F", "code").alias("tgt"))
    known = cut(own.union(links).where("src <> tgt").distinct())
    keep = G.above(known, la.select(kind("L", "code").alias("node")))
    known = known.join(keep.withColumnRenamed("node", "tgt"), "tgt", "left_semi").select("src", "tgt")
    codes = la.select("code")
    tree = language_tree(edges(spark, d)).join(codes.withColumnRenamed("code", "src"), "src", "left_semi").join(codes.withColumnRenamed("code", "tgt"), "tgt", "left_semi")
    e = acyclic(known.union(tree.select(kind("L", "src"), kind("L", "tgt"))).distinct())
    return e.join(G.implied_edges(e), ["src", "tgt"], "left_anti").select(F.substr("src", F.lit(2)).alias("parent"), F.substr("tgt", F.lit(2)).alias("child"))


@query("SELECT * FROM (VALUES " + ", ".join(f"('{p}','{t}')" for t, p in O.PARENT.items() if p) + ") v(parent, type)")
def g16_ontology_edges(spark, d):
    return O.types_table(spark).where("parent is not null").select("parent", "type")


@query(f"""WITH RECURSIVE {_E}, so AS (SELECT src AS node FROM e GROUP BY src ORDER BY count(*) DESC, src LIMIT 20), b AS (SELECT node AS source, node, 0 AS dist FROM so UNION SELECT b.source, e.tgt, b.dist + 1 FROM b JOIN e ON b.node = e.src WHERE b.dist < 4)
SELECT source, node, min(dist) AS dist FROM b GROUP BY ALL""")
def g17_bfs_lengths(spark, d):
    e = edges(spark, d)
    top = e.groupBy(F.col("src").alias("node")).count().orderBy(F.desc("count"), "node").limit(20)
    return G.bfs(e, top, 4)


@query(f"WITH {_E}, dd AS (SELECT node, sum(i) AS n_in, sum(o) AS n_out FROM (SELECT src AS node, 0 AS i, 1 AS o FROM e UNION ALL SELECT tgt, 1, 0 FROM e) GROUP BY node) SELECT n_in::BIGINT AS n_in, n_out::BIGINT AS n_out, count(*) AS n FROM dd GROUP BY ALL")
def g18_degree_grid(spark, d):
    return G.degrees(edges(spark, d)).groupBy("n_in", "n_out").agg(F.count("*").alias("n"))


@query()
def g19_pagerank(spark, d):
    """Within the largest component."""
    return G.pagerank(largest_component(edges(spark, d))).select("node", F.round("rank", 9).alias("rank"))


@query()
def g20_communities(spark, d):
    return G.communities(largest_component(edges(spark, d)), RESOLUTION)


@query()
def g21_connectors(spark, d):
    """Per node the number of its edges into other of the largest communities."""
    e = edges(spark, d).where("src <> tgt").select("src", "tgt").distinct()
    c = cut(G.communities(e, RESOLUTION))
    top = c.groupBy("community").count().orderBy(F.desc("count"), "community").limit(50).select("community")
    c = cut(c.join(top, "community", "left_semi"))
    x = e.join(c.select(F.col("node").alias("src"), F.col("community").alias("c1")), "src").join(c.select(F.col("node").alias("tgt"), F.col("community").alias("c2")), "tgt").where("c1 <> c2")
    return x.select(F.explode(F.array("src", "tgt")).alias("node")).groupBy("node").agg(F.count("*").alias("n"))


@query(f"""WITH {_E}, a AS (SELECT DISTINCT src, tgt FROM e WHERE NOT uncertain), b AS (SELECT DISTINCT src, tgt FROM e WHERE type IN {_DIR})
SELECT 'edges' AS what, count(*) FILTER (b.src IS NOT NULL AND a.src IS NOT NULL) AS n_both, count(*) FILTER (b.src IS NULL) AS n_left, count(*) FILTER (a.src IS NULL) AS n_right FROM a FULL JOIN b ON a.src = b.src AND a.tgt = b.tgt""")
def g22_overlap(spark, d):
    """What two graphs have in common (A19): the certain edges and the directed ones."""
    e = edges(spark, d)
    a = e.where("not uncertain").select("src", "tgt", F.lit(1).alias("l"), F.lit(0).alias("r"))
    b = e.where(F.col("type").isin(*O.DIRECTED)).select("src", "tgt", F.lit(0), F.lit(1))
    m = a.union(b).groupBy("src", "tgt").agg(F.max("l").alias("l"), F.max("r").alias("r"))
    return m.agg(F.count_if(F.expr("l = 1 and r = 1")).alias("n_both"), F.count_if(F.expr("r = 0")).alias("n_left"), F.count_if(F.expr("l = 0")).alias("n_right")).select(F.lit("edges").alias("what"), "*")


@query(f"""WITH {_E}, n AS (SELECT DISTINCT kind, concat_ws('#', term, language, coalesce(sense_idx, 0)::VARCHAR) AS node FROM node), u AS (SELECT src AS node FROM e UNION SELECT tgt FROM e)
SELECT kind, count(DISTINCT n.node) AS n, count(DISTINCT u.node) AS n_in_graph FROM n LEFT JOIN u ON n.node = u.node GROUP BY kind""")
def g23_coverage(spark, d):
    """Nodes by kind and how many of them the graph has."""
    n = table(spark, d, "node").select("kind", F.concat_ws("#", "term", "language", F.coalesce("sense_idx", F.lit(0)).cast("string")).alias("node")).distinct()
    e = edges(spark, d)
    u = e.select(F.col("src").alias("node")).union(e.select("tgt")).distinct().withColumn("u", F.lit(True))
    return n.join(u, "node", "left").groupBy("kind").agg(F.count_distinct("node").alias("n"), F.count_distinct(F.when(F.col("u"), F.col("node"))).alias("n_in_graph"))


@query(f"WITH RECURSIVE {_E}, {_WEAK}, l AS (SELECT a AS node, least(a, min(b)) AS c FROM wc GROUP BY a), s AS (SELECT c, count(*) AS k FROM l GROUP BY c) SELECT sum(k)::BIGINT AS n_nodes, count(*) AS n_components, max(k) AS largest, min(k) AS smallest, round(avg(k), 6) AS mean_size, mode(k) AS modal, round(sum(k * k) / sum(k), 6) AS expected_size FROM s")
def a17_component_summary(spark, d):
    s = G.weak_components(simple(spark, d)).groupBy("component").agg(F.count("*").alias("k"))
    return s.agg(F.sum("k").alias("n_nodes"), F.count("*").alias("n_components"), F.max("k").alias("largest"), F.min("k").alias("smallest"), F.round(F.avg("k"), 6).alias("mean_size"), F.mode("k").alias("modal"), F.round(F.sum(F.col("k") * F.col("k")) / F.sum("k"), 6).alias("expected_size"))


@query(f"""WITH {_E}, {_UP}, p AS (SELECT src, tgt, type, count(*) AS k FROM e WHERE src <> tgt AND type IN {_DIR} GROUP BY ALL), q AS (SELECT p.*, EXISTS (SELECT 1 FROM p r JOIN up ON up.type = r.type WHERE r.src = p.src AND r.tgt = p.tgt AND up.ancestor = p.type) AS gone FROM p)
SELECT (SELECT count(*) FROM e WHERE src = tgt) AS selfloop, CAST(sum(CASE WHEN gone THEN 0 ELSE k - 1 END) AS BIGINT) AS merge_equal, CAST(sum(CASE WHEN gone THEN k ELSE 0 END) AS BIGINT) AS merge_more_specific, CAST(count(*) FILTER (NOT gone) AS BIGINT) AS n_edges,
round(sum(CASE WHEN gone THEN k ELSE k - 1 END) / sum(k), 6) AS redundancy FROM q""")
def a15_event_counts(spark, d):
    """What merging did to the directed edges, and their redundancy."""
    e = edges(spark, d)
    directed = cut(G.no_self_loops(e).where(F.col("type").isin(*O.DIRECTED)))
    p = directed.groupBy("src", "tgt", "type").agg(F.count("*").alias("k"))
    stay = G.merge_types(directed).select("src", "tgt", "type", F.lit(True).alias("stay"))
    q = p.join(stay, ["src", "tgt", "type"], "left")
    loops = e.where("src = tgt").agg(F.count("*").alias("selfloop"))
    s = q.agg(F.sum(F.when(F.col("stay"), F.col("k") - 1).otherwise(0)).alias("merge_equal"), F.sum(F.when(F.col("stay"), 0).otherwise(F.col("k"))).alias("merge_more_specific"), F.count_if("stay").alias("n_edges"), F.sum("k").alias("all"))
    return loops.join(F.broadcast(s)).select("selfloop", "merge_equal", "merge_more_specific", "n_edges", F.round((F.col("merge_equal") + F.col("merge_more_specific")) / F.col("all"), 6).alias("redundancy"))


@query(f"""WITH {_E}, de AS (SELECT node, count(*) AS k FROM (SELECT src AS node FROM e UNION ALL SELECT tgt FROM e) GROUP BY node HAVING count(*) >= 5), bo AS (SELECT src, tgt FROM e UNION SELECT tgt, src FROM e), h AS (SELECT de.node, b1.tgt AS m FROM de JOIN bo b1 ON de.node = b1.src UNION SELECT de.node, b2.tgt FROM de JOIN bo b1 ON de.node = b1.src JOIN bo b2 ON b1.tgt = b2.src)
SELECT node, count(DISTINCT string_split(m, '#')[-2]) AS n_languages FROM h GROUP BY node HAVING count(DISTINCT string_split(m, '#')[-2]) > 3""")
def a29_radius2_groups(spark, d):
    """Languages within two links of the nodes of degree 5 and more: the languages next to each node first, then those of
    its neighbours, so a hub counts as the languages around it and not as its links."""
    e = edges(spark, d)
    both = cut(e.select("src", "tgt").union(e.select("tgt", "src")).distinct())
    hub = e.select(F.explode(F.array("src", "tgt")).alias("node")).groupBy("node").count().where("count >= 5").select("node")
    one = cut(both.withColumnRenamed("src", "node").join(hub, "node", "left_semi").select("node", F.col("tgt").alias("m")))
    lang = lambda c: F.element_at(F.split(c, "#"), -2).alias("l")
    around = both.select(F.col("src").alias("m"), lang("tgt")).distinct()
    two = salted_join(one, around, "m", one.count()).select("node", "l")
    return one.select("node", lang("m")).union(two).distinct().groupBy("node").agg(F.count("*").alias("n_languages")).where("n_languages > 3")


@query(f"WITH {_E}, bo AS (SELECT DISTINCT src, tgt FROM e UNION SELECT DISTINCT tgt, src FROM e) SELECT bo.src AS node, bo.tgt AS neighbour, kind FROM bo JOIN (SELECT DISTINCT concat_ws('#', term, language, coalesce(sense_idx, 0)::VARCHAR) AS node, min(kind) AS kind FROM node GROUP BY 1) n ON bo.tgt = n.node")
def j10_neighbours(spark, d):
    """Every node's neighbours with their kind, direction ignored."""
    e = edges(spark, d)
    both = e.select(F.col("src").alias("node"), F.col("tgt").alias("neighbour")).union(e.select("tgt", "src")).distinct()
    n = table(spark, d, "node").groupBy(F.concat_ws("#", "term", "language", F.coalesce("sense_idx", F.lit(0)).cast("string")).alias("neighbour")).agg(F.min("kind").alias("kind"))
    return both.join(n, "neighbour").select("node", "neighbour", "kind")


def _with_ids(e: DataFrame) -> DataFrame:
    return e.withColumn("eid", F.concat_ws("|", F.col("ord").cast("string"), "type"))


@query(f"""WITH RECURSIVE {_E}, so AS (SELECT src AS node FROM e GROUP BY src ORDER BY count(*) DESC, src LIMIT 10), p AS (SELECT node AS start, node, 0 AS length, []::VARCHAR[] AS l FROM so UNION ALL SELECT p.start, e.tgt, p.length + 1, list_append(l, ord || '|' || type) FROM p JOIN e ON p.node = e.src WHERE p.length < 3 AND NOT list_contains(l, ord || '|' || type))
SELECT start, node, length, array_to_string(l, ',') AS links FROM p""")
def j11_var_length_paths(spark, d):
    e = _with_ids(edges(spark, d))
    top = e.groupBy(F.col("src").alias("node")).count().orderBy(F.desc("count"), "node").limit(10)
    return G.paths(e, top, 3).select("start", "node", "length", F.array_join("links", ",").alias("links"))


QUERIES = Q
