import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from lexweave.operators import store as S
from lexweave.sources import graph_files as W
from lexweave.streaming.edits import window_counts


def test_store(spark, rows, tmp_path):
    data = [("oak", 0, "da", 2), ("oak", 0, "sv", 1), ("*ek", 118, "gem", 1), ("Talk", 1, "da", 1), ("oak", 1, "da", 9), (None, 0, None, 1)]
    s = S.EntryStore(spark, f"{tmp_path}/store", 3)
    s.load(spark.createDataFrame(data, "title string, ns int, language string, _i int"))
    assert len(s) == 6 and [r.language for r in s["oak"]] == ["sv", "da"] and [r._i for r in s["oak", "da"]] == [2] and [r._i for r in s["oak", "da", 1]] == [9]
    assert "oak" in s and ("oak", "sv") in s and ("oak", "sv", 1) not in s and "elm" not in s
    with pytest.raises(KeyError):
        s["elm"]
    assert rows(s.entries(language="da", where=F.col("_i") > 0, fields=("title", "_i"))) == [("oak", 2)] and s.entries().count() == 4
    s.remove(F.col("language") == "da")
    assert len(s) == 3 and ("oak", "da") not in s
    s.clear()
    assert len(s) == 0
    assert S.target_name("/x/dawords-20240101-pages.xml.bz2") == ("dawords", "20240101")
    with pytest.raises(ValueError):
        S.target_name("pages.xml")


def test_samples_and_chunks(spark, rows):
    df = spark.range(1000).withColumn("g", F.col("id") % 50)
    a, b = rows(S.sample(df, 20, ["id"])), rows(S.sample(df.repartition(7), 20, ["id"]))
    assert a == b and len(a) == 20 and a != rows(S.sample(df, 20, ["id"], seed=5))
    g = S.sample_groups(df, 3, ["g"])
    assert g.count() == 60 and g.select("g").distinct().count() == 3
    c = rows(S.chunks(spark.range(30_000).withColumn("n", F.lit(10)), F.col("n"), 1000, ["id"], "id").groupBy("chunk").count())
    assert len(c) == 300 and {n for _, n in c} == {100}
    assert S.chunks(df.limit(0), F.lit(1), 5, ["id"], "id").count() == 0


def test_json_paths(spark, rows):
    data = [(json.dumps({"a": 1, "b": [{"c": 2}, {"d": []}]}),), (json.dumps([{"a": 3}]),), ("{broken",), (None,)]
    assert rows(S.json_paths(spark.createDataFrame(data, "t string"), F.col("t"))) == [("(unreadable)", 1), ("[*]", 1), ("[*].a", 1), ("a", 1), ("b", 1), ("b[*]", 1), ("b[*].c", 1), ("b[*].d", 1), ("b[*].d[*]", 1)]


@pytest.fixture
def graph(spark):
    nodes = spark.createDataFrame([("a b#da#0", "entry", "a b", "da", 0, ["Noun"], ["big\nhouse", ""], ["/a/"]), ("*c#gem#0", "no_entry", "*c", "gem", 0, None, None, None), ("s#sv#0", "stub", "s", "sv", 0, None, None, None), ("e", "entity", "Ada", None, None, None, None, None)], "node string, kind string, term string, language string, sense_idx int, pos array<string>, glosses array<string>, pronunciations array<string>")
    edges = spark.createDataFrame([("*c#gem#0", "a b#da#0", "learned borrowing", 'say "so"\nand', True, 1), ("e", "s#sv#0", "eponym", None, False, 0)], "src string, tgt string, type string, text string, uncertain boolean, ord long")
    return edges, nodes


def test_writers(spark, rows, graph, tmp_path):
    edges, nodes = graph
    for form in W.WRITERS:
        W.write_graph(form, edges, nodes, f"{tmp_path}/{form}")
    csv = lambda p: rows(spark.read.option("header", True).option("escape", '"').csv(f"{tmp_path}/{p}"))
    assert csv("simple/etymology") == [("eponym", "e", "s#sv#0"), ("learned borrowing", "*c#gem#0", "a b#da#0")] and csv("simple/entity") == [("e", "Ada")] and len(csv("simple/etymology_entry")) == 3
    assert [r[-1] for r in csv("property/words")] == ["Word@NAE@Reconstructed", "Word@EtymologyEntry@Multiword", "Word@EtymologyEntry"] and [r[2] for r in csv("property/has_gloss")] == ["HAS_GLOSS"] and len(csv("property/pos")) == 1
    lines = [json.loads(r.value) for r in spark.read.text(f"{tmp_path}/json/nodes").collect()]
    assert {"node": "e", "kind": "entity", "term": "Ada"} in lines and "<br/>" in spark.read.text(f"{tmp_path}/json/relations").where("value like '%say%'").first().value
    e, n = W.load_graph(spark, f"{tmp_path}/graph")
    assert rows(e) == rows(edges) and n.count() == 4
    t = {r.value for r in spark.read.text(f"{tmp_path}/triples").collect()}
    assert '<urn:lexweave:a_b%23da%230> <urn:lexweave:sense/definition> "big\\nhouse" .' in t and '<urn:lexweave:e> <urn:lexweave:isA> <urn:lexweave:Entity> .' in t
    assert [r[1] for r in csv("selection/lexemes")] == ["gem", "da", "sv"] and csv("selection/relationships")[0][3] == 'say "so"<br/>and'
    with pytest.raises(ValueError):
        W.write_graph("xlsx", edges, nodes, "x")
    with pytest.raises(ValueError):
        W.write_csv(edges, nodes.unionByName(nodes.limit(1).withColumn("kind", F.lit("phantom"))), f"{tmp_path}/no")


def test_head_and_stubs(spark, rows, graph, tmp_path):
    edges, nodes = graph
    e, n = W.head(edges, nodes, 1)
    assert rows(e.select("src")) == [("e",)] and rows(n.select("node")) == [("e",), ("s#sv#0",)]
    lex = spark.createDataFrame([("s", "sv", ["leaf"], "x1"), ("a b", "da", ["other"], "x2")], "term string, language string, glosses array<string>, etymid string")
    got = {r.node: (r.glosses, r.etymid) for r in W.expand_stubs(nodes, lex).collect()}
    assert got["s#sv#0"] == (["leaf"], "x1") and got["a b#da#0"] == (["big\nhouse", ""], None) and got["e"] == (None, None)
    made = []
    make = lambda: made.append(1) or spark.range(3)
    assert [W.cached(spark, f"{tmp_path}/c", make).count() for _ in range(2)] == [3, 3] and len(made) == 1
    W.cached(spark, f"{tmp_path}/c", make, refresh=True)
    assert len(made) == 2


def test_gold_standard(spark, rows, tmp_path):
    pairs = spark.createDataFrame([("w", "da", 1, "a house", 10, "a large house", 1), ("w", "da", 1, "a house", 10, "a hall", 1), ("w", "da", 1, "a house", 11, "to go", 0)], "term string, language string, mention long, a string, node_id long, b string, match int")
    chosen = spark.createDataFrame([(1, 10, "gloss")], "mention long, node_id long, how string")
    W.write_gold_standard(pairs, chosen, str(tmp_path), 2)
    n = {t: spark.read.option("header", True).csv(f"{tmp_path}/{t}").count() for t in ("gold_standard_sense", "gold_standard_etym", "disambiguation", "annotate")}
    assert n == {"gold_standard_sense": 3, "gold_standard_etym": 2, "disambiguation": 1, "annotate": 2}


def test_statistics(spark, rows, tmp_path):
    t = dt.datetime(2024, 5, 1, 12)
    tables = {
        "pages": spark.createDataFrame([(1, 'a "b", c', 0, "x")], "id long, title string, namespace int, more string"), "contributors": spark.createDataFrame([(1, "u", None), (1, "u", None), (None, None, "1.2.3.4")], "id long, username string, ip string"),
        "revisions": spark.createDataFrame([(1, 2, t, "u", True)], W.STATISTICS["revisions"]), "entries": spark.createDataFrame([(2, "da", 5, 1, None, "m=1|cog=2")], W.STATISTICS["entries"]),
    }
    W.write_statistics(tables, str(tmp_path))
    assert rows(W.read_statistics(spark, str(tmp_path), "pages")) == [(1, 'a "b", c', 0)] and W.read_statistics(spark, str(tmp_path), "contributors").count() == 2
    assert rows(W.read_statistics(spark, str(tmp_path), "revisions", ["id", "timestamp"])) == [(2, t)]
    one = spark.createDataFrame([("b=2|a=1|bad|a=3|=4|c=x",), (None,), ("",)], "t string").select(W.unpack_counts(F.col("t")).alias("m"))
    assert [r.m for r in one.collect()] == [{"a": 3, "b": 2}, {}, {}]
    assert one.select(W.pack_counts(F.col("m"))).first()[0] == "a=3|b=2"


def test_split_pages(spark):
    df = spark.createDataFrame([(1, list(range(7))), (2, None), (3, [])], "id long, revision array<int>")
    got = sorted((r.id, r.partial, r.revision) for r in W.split_pages(df, 3).collect())
    assert got == [(1, False, [0, 1, 2]), (1, True, [3, 4, 5]), (1, True, [6]), (2, False, None), (3, False, [])]


def test_windows_of_a_stream(spark, tmp_path):
    t = lambda d, h=0: dt.datetime(2024, 1, d, h)
    schema = "id long, timestamp timestamp_ntz, minor boolean"
    batches = [[(1, t(1), True), (2, t(2), None), (1, t(1), True), (None, t(1), True)], [(2, t(2), None), (3, t(9), False)], [(4, t(20), True)], [(5, t(1, 5), True), (6, t(19), True)], [(7, t(30), True)]]
    for b in batches:
        spark.createDataFrame(b, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        q = window_counts(spark.readStream.schema(schema).parquet(f"{tmp_path}/in"), "7 days", "2 days")
        w = q.writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/state").outputMode("append").trigger(availableNow=True).start()
        w.awaitTermination(120)
    out = {r.bin.day: (r.n, r.n_minor) for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    assert sum(n for n, _ in out.values()) == 5 and (2, 1) in out.values()  # 7 is in an open window, 5 came too late
