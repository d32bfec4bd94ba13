"""What the reduction did, against its SQL and on a component that is large."""

import random

import numpy as np
import pytest

from lexweave.operators import graph as G
from lexweave.plans.catalogue import oracle_sql, queries

LEXEME = "struct<term:string,language:string,sense_idx:int>"
TYPES = ["inheritance", "root", "historical", "borrowing", "learned borrowing", "affix", "prefix", "origin", "cognate", "sibling", "related", " Root ", "no type"]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """A relation table with loops, repeated rows, parallel and opposed edges, types above each other and equal ords."""
    rnd = random.Random(5)
    lexeme = lambda i: (None if i == 59 else f"w{i:02d}", f"l{i % 4}", None if i % 3 else 1)
    pairs = [rnd.sample(range(60), 2) for _ in range(45)] + [sorted(rnd.sample(range(60), 2)) for _ in range(30)] + [(7, 7), (9, 9)]
    ends = [p[::-1] if rnd.random() < 0.3 else p for p in (rnd.choice(pairs) for _ in range(260))]
    rows = [(rnd.randrange(120), lexeme(a), lexeme(b), rnd.choice(TYPES), rnd.choice([None, "", "x", "y"]), rnd.choice([None, True, False])) for a, b in ends]
    apart = [*((a, a + 1, "affix") for a in range(70, 80)), (70, 75, "prefix"), (73, 80, "affix"), (71, 78, "related"), (81, 82, "doublet"), (82, 83, "cognate"), (83, 81, "related"), (84, 85, "related")]
    rows += [(k, lexeme(a), lexeme(b), t, "z", False) for k, (a, b, t) in enumerate(apart)]
    rows += [(r[0], r[2], r[1], *r[3:]) for r in rnd.sample(rows, 30)] + rnd.sample(rows, 30)
    d = str(tmp_path_factory.mktemp("events"))
    spark.createDataFrame(rows, f"ord long, src {LEXEME}, tgt {LEXEME}, type string, text string, uncertain boolean").write.parquet(f"{d}/relation.parquet")
    languages = [("l0", "N0", None), ("l1", "N1", "N0"), ("l2", "N2", "N1"), ("l3", "N3", "")]
    spark.createDataFrame(languages, "code string, canonical_name string, parent string").write.parquet(f"{d}/language_data.parquet")
    return d


@pytest.mark.parametrize("limit", [G.LOCAL_PAIRS, 0], ids=["one task", "operators"])
def test_events_are_those_of_the_sql(spark, rows, folder, monkeypatch, limit):
    duckdb = pytest.importorskip("duckdb")
    monkeypatch.setattr(G, "LOCAL_PAIRS", limit)
    con = duckdb.connect()
    for t in ("relation", "language_data"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet/*.parquet'")
    want = con.execute(oracle_sql()["a15_reduction_events"]).fetchall()
    assert all(n > 0 for _, n in want), want
    assert rows(queries()["a15_reduction_events"](spark, folder)) == sorted(want)


def test_large_component_without_rounds(spark, folder, monkeypatch):
    """At 1 GB one component has more than LOCAL_EDGES edges, for which rounds over the whole graph took too long."""

    def rounds(*_):
        raise AssertionError("a loop over the whole graph")

    monkeypatch.setattr(G, "LOCAL_EDGES", 10)
    for f in ("_strong_by_rounds", "_implied_by_rounds", "skew_join", "salted_join"):
        monkeypatch.setattr(G, f, rounds)
    spark.sparkContext.setJobGroup("events", "events")
    assert queries()["a15_reduction_events"](spark, folder).count() == 9
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("events")
    spark.sparkContext.setJobGroup("other", "other")
    assert len(jobs) < 50


def test_no_edges(spark):
    none = spark.createDataFrame([], "src string, tgt string, type string, text string, uncertain boolean, ord long")
    assert {r.n for r in G.reduction_events(none).collect()} == {0}


@pytest.mark.parametrize("walked, chunk", [(G.WALKED, G.CHUNK), (60, 3), (0, 2)])
def test_implied_edges_walked_and_by_bits(monkeypatch, walked, chunk):
    monkeypatch.setattr(G, "WALKED", walked)
    monkeypatch.setattr(G, "CHUNK", chunk)
    rnd = random.Random(3)
    for n, m in ((12, 25), (40, 60), (40, 200), (5, 0)):
        names = rnd.sample(range(n), n)
        e = sorted({tuple(sorted(rnd.sample(range(n), 2))) for _ in range(m)})
        reach = {x: {x} for x in range(n)}
        for a, b in sorted(e, reverse=True):
            reach[a] |= reach[b]
        want = {(a, b) for a, b in e if any(b in reach[w] for v, w in e if v == a and w != b)}
        src, tgt = (np.array([names[x[k]] for x in e], np.int64) for k in (0, 1))
        hit = G._implied(n, src, tgt)
        assert {x for x, h in zip(e, hit) if h} == want


def test_cyclic_edges_in_memory():
    rnd = random.Random(8)
    for n, m in ((10, 14), (30, 45), (30, 90), (3, 0)):
        e = sorted({tuple(rnd.sample(range(n), 2)) for _ in range(m)})
        reach = {x: {b for a, b in e if a == x} for x in range(n)}
        for _ in range(n):
            for x in reach:
                reach[x] = reach[x].union(*(reach[y] for y in reach[x]))
        src, tgt = (np.array([x[k] for x in e], np.int64) for k in (0, 1))
        assert G._cyclic(n, src, tgt).tolist() == [a in reach[b] for a, b in e]
