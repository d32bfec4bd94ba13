"""Small graphs with known reductions."""

import random

import pytest

from lexweave.operators import graph as G
from lexweave.operators import ontology as O

SCHEMA = "src string, tgt string, type string, text string, uncertain boolean, ord long"
WORDS = "amber birch cedar delta ember fjord grove heath inlet jetty".split()


def n(word):
    return f"{word}#{word[:2]}#0"


@pytest.fixture(scope="module")
def graph(spark):
    """Edges given as "amber birch type", numbered in order."""
    return lambda *es: spark.createDataFrame([(n(a), n(b), t, None, False, k) for k, (a, b, t) in enumerate(e.split(" ", 2) for e in es)], SCHEMA)


def kept(df, *stores):
    return sorted((r.src, r.tgt, r.type) for r in df.collect() if not stores or r.store in stores)


@pytest.fixture(params=[G.LOCAL_EDGES, 0], ids=["in memory", "by rounds"])
def ways(request, monkeypatch):
    monkeypatch.setattr(G, "LOCAL_EDGES", request.param)


def test_most_specific_type_stays(graph):
    e = graph("amber birch origin", "amber birch borrowing", "amber birch semantic loan", "amber birch related", "birch amber related")
    assert kept(G.absorb_related(e)) == [(n("amber"), n("birch"), "semantic loan")]


def test_undirected_and_loops(graph):
    e = graph("cedar delta related", "delta cedar related", "ember fjord doublet", "fjord ember doublet", "grove grove compound", "heath inlet calque", "heath inlet prefix")
    assert kept(G.absorb_related(e)) == [(n("cedar"), n("delta"), "related"), (n("ember"), n("fjord"), "doublet"), (n("heath"), n("inlet"), "calque"), (n("heath"), n("inlet"), "prefix")]


def test_texts_merge_in_order(spark):
    e = spark.createDataFrame([("a", "b", "origin", "second", False, 2), ("a", "b", "borrowing", "first", True, 1), ("a", "b", "borrowing", None, None, 3)], SCHEMA)
    (r,) = G.merge_types(e).collect()
    assert (r.type, r.text, r.uncertain) == ("borrowing", "first; second", True)


def test_text_of_an_absorbed_edge_is_kept(spark):
    e = spark.createDataFrame([("b", "a", "related", "loose", True, 0), ("a", "b", "cognate", "sib", False, 1), ("b", "a", "calque", "close", False, 2), ("b", "a", "prefix", None, False, 3), ("c", "d", "related", "alone", False, 4), ("e", "f", "doublet", None, None, 5), ("f", "e", "related", "late", False, 6)], SCHEMA)
    got = sorted((r.src, r.tgt, r.type, r.text, r.uncertain) for r in G.absorb_related(e.na.fill(False, ["uncertain"])).collect())
    assert got == [("a", "b", "cognate", "sib", False), ("b", "a", "calque", "close; loose", True), ("b", "a", "prefix", None, False), ("c", "d", "related", "alone", False), ("e", "f", "doublet", "late", False)]


def test_cycle_goes_aside_and_the_rest_stays(graph, ways):
    r = G.reduce_graph(graph("amber birch suffix", "birch cedar suffix", "cedar delta suffix", "delta amber suffix", "delta ember suffix", "fjord amber suffix"))
    assert kept(r, "origin") == [(n("delta"), n("ember"), "suffix"), (n("fjord"), n("amber"), "suffix")]
    assert len(kept(r, "aside")) == 4


def test_transitive_reduction(graph, ways):
    r = G.reduce_graph(graph("amber birch root", "birch cedar root", "cedar delta root", "delta ember root", "amber ember root", "birch delta root", "ember amber related"))
    assert kept(r, "origin") == [(n(a), n(b), "root") for a, b in zip(WORDS, WORDS[1:5])] and kept(r, "related") == []


def test_older_language_first(spark):
    e = spark.createDataFrame([("new#xn#0", "mid#xm#0", "inheritance", None, False, 0), ("old#xo#0", "new#xn#0", "historical", None, False, 1), ("p#xn#0", "q#xn#0", "root", None, False, 2), ("new#xn#0", "old#xo#0", "calque", None, False, 3)], SCHEMA)
    older = spark.createDataFrame([("xo", "xm"), ("xm", "xn"), ("xo", "xn")], "old string, young string")
    assert [r[:2] for r in kept(G.swap_historical(e, older))] == [("mid#xm#0", "new#xn#0"), ("new#xn#0", "old#xo#0"), ("old#xo#0", "new#xn#0"), ("p#xn#0", "q#xn#0")]


def test_random_graphs_both_ways(spark, rows, ways):
    rnd = random.Random(8)
    pairs = {tuple(rnd.sample(range(45), 2)) for _ in range(75)}
    name = lambda i: f"x{i:02d}"
    e = spark.createDataFrame([(name(a), name(b)) for a, b in pairs] + [("x01", "x01")], "src string, tgt string")
    reach = {i: {b for a, b in pairs if a == i} for i in range(45)}
    for _ in range(45):
        reach = {i: r.union(*(reach[j] for j in r)) for i, r in reach.items()}
    assert rows(G.strong_components(e)) == sorted((name(i), name(min(j for j in r if i in reach[j]))) for i, r in reach.items() if i in r)
    dag = [(a, b) for a, b in pairs if a not in reach[b]]
    out = {i: {b for a, b in dag if a == i} for i in range(45)}
    below = dict(out)
    for _ in range(45):
        below = {i: r.union(*(below[j] for j in r)) for i, r in below.items()}
    want = sorted((name(a), name(b)) for a, b in dag if any(b in below[w] for w in out[a]))
    d = spark.createDataFrame([(name(a), name(b)) for a, b in dag], "src string, tgt string")
    assert want and rows(G.implied_edges(d)) == want
    assert G.strong_components(e.limit(0)).count() == G.implied_edges(e.limit(0)).count() == 0


def test_joins_of_hot_nodes(spark, rows, monkeypatch):
    from lexweave.plans import runtime

    e = spark.createDataFrame([("hub", f"t{i}") for i in range(40)] + [(f"t{i}", f"u{i % 3}") for i in range(40)] + [("u0", "hub")], "src string, tgt string")
    found = lambda: (rows(G.bfs(e, e.selectExpr("'u0' as node").distinct(), 3)), rows(G.strong_components(e)), rows(G.above(e, e.selectExpr("'u1' as node"))))
    want = found()
    monkeypatch.setattr(runtime, "SKEW_ROWS", 0)
    monkeypatch.setattr(runtime, "HOT_SHARE", 0.05)
    monkeypatch.setattr(G, "LOCAL_EDGES", 0)
    assert found() == want and len(want[0]) == 44


def test_components_and_search(graph, rows):
    g = graph("amber birch origin", "cedar birch origin", "ember fjord origin")
    assert rows(G.weak_components(g)) == [(n("amber"), n("amber")), (n("birch"), n("amber")), (n("cedar"), n("amber")), (n("ember"), n("ember")), (n("fjord"), n("ember"))]
    assert rows(G.bfs(g, g.select(g.src.alias("node")).where("node like 'amber%'"), 3)) == [(n("amber"), n("amber"), 0), (n("amber"), n("birch"), 1)]


def test_communities_both_ways(spark, rows, monkeypatch):
    rnd = random.Random(5)
    e = spark.createDataFrame([(f"x{a:02d}", f"x{b:02d}") for a, b in {tuple(rnd.sample(range(30), 2)) for _ in range(60)}], "src string, tgt string")
    want = rows(G.communities(e)), [(n, round(r, 9)) for n, r in rows(G.pagerank(e))]
    monkeypatch.setattr(G, "LOCAL_EDGES", 0)
    assert (rows(G.communities(e)), [(n, round(r, 9)) for n, r in rows(G.pagerank(e))]) == want


def test_rank_and_communities(spark, rows):
    clique = lambda x: [(f"{x}{i}", f"{x}{j}") for i in range(5) for j in range(i)]
    e = spark.createDataFrame([*clique("a"), *clique("b"), ("a0", "b0")], "src string, tgt string")
    rank = dict(rows(G.pagerank(e, 1e-9)))
    assert abs(sum(rank.values()) - 1) < 1e-6 and rank["a0"] == max(rank.values()) and abs(rank["a1"] - rank["b2"]) < 1e-6
    of = dict(rows(G.communities(e)))
    assert {v: {k[0] for k in of if of[k] == v} for v in of.values()} == {"a0": {"a"}, "b0": {"b"}}
    assert len(set(dict(rows(G.communities(e, 1e-4))).values())) == 1
    assert rows(G.pagerank(e.limit(0))) == rows(G.communities(e.limit(0))) == []


def test_ontology():
    assert O.is_a("prefix", "morphological") and not O.is_a("cognate", "origin")
    assert len(O.PARENT) == 38 and set(O.DIRECTED) == set(O.below("origin"))
