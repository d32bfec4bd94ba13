import pytest
from pyspark.sql import functions as F

from lexweave.operators import explore as X
from lexweave.operators import graph as G


@pytest.fixture
def world(spark):
    nodes = [("a#da#0", "a", "da", ["Word"]), ("b#sv#0", "b", "sv", ["Word", "Rare"]), ("c d#sv#0", "c d", "sv", ["Word", "Multiword"]), ("e#en#0", "e", "en", ["Word"]), ("f", "Ada", None, ["Entity"])]
    edges = [("a#da#0", "b#sv#0", "calque", 1), ("b#sv#0", "e#en#0", "root", 2), ("a#da#0", "c d#sv#0", "root", 3), ("c d#sv#0", "e#en#0", "root", 4), ("a#da#0", "e#en#0", "cognate", 5), ("f", "a#da#0", "eponym", 6)]
    n = spark.createDataFrame(nodes, "node string, term string, language string, labels array<string>")
    return spark.createDataFrame([(*e[:3], None, e[3]) for e in edges], "src string, tgt string, type string, text string, ord long"), n


def found(edges, nodes, **q):
    return sorted((r.start, r.node, r.length, tuple(r.links)) for r in X.find_paths(edges, nodes, X.PathQuery(**q)).collect())


def test_paths(world):
    e, n = world
    da, en = X.NodeFilter(languages=("da",)), X.NodeFilter(terms=("e",))
    assert found(e, n, source=da, target=en, depth=2, direction="out") == [("a#da#0", "e#en#0", 2, ("1|calque", "2|root"))]
    assert len(found(e, n, source=da, target=en, depth=2, direction="out", every=X.NodeFilter())) == 2
    assert found(e, n, source=en, target=da, depth=1, types=("cognate",), direction="in") == [("e#en#0", "a#da#0", 1, ("5|cognate",))]
    assert found(e, n, source=da, depth=1, direction="both", limit=1) == [("a#da#0", "b#sv#0", 1, ("1|calque",))]
    assert found(e, n, source=X.NodeFilter(labels=("Rare",)), depth=0) == [("b#sv#0", "b#sv#0", 0, ())]
    assert found(e, n, source=X.NodeFilter(pattern="^[ab]$"), target=X.NodeFilter(not_languages=("sv",)), depth=1, direction="out", types=("root",)) == [("b#sv#0", "e#en#0", 1, ("2|root",))]
    p = X.find_paths(e, n, X.PathQuery(source=da, target=en, depth=2, direction="out"))
    assert sorted(r.ord for r in X.subgraph(p, e).collect()) == [1, 2]


@pytest.mark.parametrize("q", [X.PathQuery(), X.PathQuery(source=X.NodeFilter(not_languages=("en",))), X.PathQuery(source=X.NodeFilter(terms=("a",)), types=("nonsense",)), X.PathQuery(source=X.NodeFilter(terms=("a",)), direction="up"), X.PathQuery(source=X.NodeFilter(terms=("a",)), depth=-1)])
def test_questions_that_are_refused(world, q):
    with pytest.raises(ValueError):
        X.find_paths(*world, q)


def test_labels_and_details(spark, rows, world):
    _, n = world
    seen = X.add_label(n, "Seen", F.col("language") == "sv")
    assert rows(X.all_labels(seen)) == [("Entity",), ("Multiword",), ("Rare",), ("Seen",), ("Word",)]
    assert rows(X.all_labels(X.drop_label(seen, "Seen"))) == rows(X.all_labels(n))
    assert X.drop_label(seen, "Seen", F.col("term") == "b").where("array_contains(labels, 'Seen')").count() == 1
    for f in (lambda: X.add_label(n, "Word", F.lit(True)), lambda: X.drop_label(n, "Entity")):
        with pytest.raises(ValueError):
            f()
    a = spark.createDataFrame([("a#da#0", "pos", "Noun"), ("a#da#0", "gloss", "x"), ("a#da#0", "gloss", "x")], "node string, kind string, value string")
    assert {r.node: r["values"] for r in X.details(n.select("node"), a).collect()}["a#da#0"] == ["gloss: x", "pos: Noun"]


def test_elements_and_history(spark, rows, world, tmp_path):
    e, n = world
    ids = lambda df: sorted(r.id for r in df.select("id").collect())
    one = lambda w: n.where(F.col("node") == w).select("node")
    shown = X.expand(X.node_elements(n.limit(0)), e, n, one("b#sv#0"))
    assert ids(shown) == ["a#da#0", "a#da#0|b#sv#0|calque", "b#sv#0", "b#sv#0|e#en#0|root", "e#en#0"]
    assert ids(X.take(shown, one("e#en#0"))) == ["a#da#0", "a#da#0|b#sv#0|calque", "b#sv#0"]
    again = X.put(shown, X.node_elements(n.where("node = 'a#da#0'").withColumn("term", F.lit("new"))))
    assert ids(again) == ids(shown) and "new" in again.where("id = 'a#da#0'").first().data
    q = X.PathQuery(source=X.NodeFilter(terms=("a",)))
    X.log_query(f"{tmp_path}/log", q, 3, spark), X.log_query(f"{tmp_path}/log", q, 4, spark)
    assert [r.n for r in X.history(spark, f"{tmp_path}/log").collect()] == [4, 3]


def test_events(spark):
    rows = [("a", "b", "calque", 0), ("a", "b", "calque", 1), ("a", "b", "borrowing", 2), ("a", "b", "prefix", 3), ("a", "a", "root", 4), ("b", "a", "related", 5), ("b", "c", "root", 6), ("a", "c", "root", 7), ("c", "a", "related", 8), ("d", "e", "root", 9), ("e", "d", "root", 10), ("b", "f", "root", 11), ("f", "c", "related", 12)]
    e = spark.createDataFrame([(*r[:3], None, False, r[3]) for r in rows], "src string, tgt string, type string, text string, uncertain boolean, ord long")
    got = {r.event: r.n for r in G.reduction_events(e).collect()}
    # shelved: the second type of a-b and the second of d-e; transitive: a-c
    assert got == {"language swap": 0, "self loop": 1, "merge equal": 1, "merge more specific": 1, "incompatible": 1, "shelved": 2, "transitive": 1, "absorbed": 2, "within components": 1}


def test_tables_are_deleted(spark):
    import os

    from lexweave.plans import runtime

    t = runtime.cut(spark.range(3))
    t = runtime.grow(t, spark.range(3, 5))
    path = t._cut_path
    assert t.count() == 5 and os.path.isdir(path)
    runtime.release(t, spark.range(1), None)
    assert not os.path.isdir(path) and path not in runtime._CUTS


def test_shared_folder_is_needed_on_a_cluster():
    from types import SimpleNamespace

    from lexweave.plans import runtime

    conf = lambda d: SimpleNamespace(conf=SimpleNamespace(get=lambda k, default=None: d.get(k, default)))
    assert runtime.shared_folder(conf({"spark.checkpoint.dir": "hdfs://x/y/", "spark.master": "yarn"})) == "hdfs://x/y"
    for master in ("yarn", "local-cluster[2,1,1024]", "spark://h:1"):
        with pytest.raises(RuntimeError):
            runtime.shared_folder(conf({"spark.master": master}))
