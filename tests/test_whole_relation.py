"""Graph queries take every row of the relation table: brute force on a small random table."""

import random

import pytest

from lexweave.operators import ontology as O
from lexweave.plans.catalogue import queries

LEXEME = "struct<term:string,language:string,sense_idx:int>"
TYPES = ["inheritance", "borrowing", "learned borrowing", "cognate", "doublet", "related", "origin", "compound"]


def name(i):
    return f"w{i:02d}#l{i % 7}#0"


@pytest.fixture(scope="module")
def relation(spark, tmp_path_factory):
    """The folder of the table and its edges (src, tgt, type, uncertain, ord)."""
    rnd = random.Random(11)
    pairs = [(a, b) for a, b in (sorted(rnd.sample(range(70), 2)) for _ in range(110))] + [(3, 3), (20, 21), (21, 22), (22, 20), (40, 41), (41, 40)]
    edges = [(a, b, rnd.choice(TYPES), rnd.random() < 0.3) for a, b in pairs + rnd.sample(pairs, 25)]
    lexeme = lambda i: (f"w{i:02d}", f"l{i % 7}", None)
    rows = [(k, lexeme(a), lexeme(b), t, None, u) for k, (a, b, t, u) in enumerate(edges)]
    d = str(tmp_path_factory.mktemp("relation"))
    spark.createDataFrame(rows + rows[:9], f"ord long, src {LEXEME}, tgt {LEXEME}, type string, text string, uncertain boolean").write.parquet(f"{d}/relation.parquet")
    return d, [(name(a), name(b), t, u, k) for k, (a, b, t, u) in enumerate(edges)]


def simple(edges):
    return {(a, b) for a, b, *_ in edges if a != b}


def reach(pairs):
    out = {x: {b for a, b in pairs if a == x} for e in pairs for x in e}
    for _ in out:
        for x in out:
            out[x] = out[x].union(*(out[y] for y in out[x]))
    return out



def test_components(spark, rows, relation):
    d, edges = relation
    e, r = simple(edges), reach(simple(edges))
    assert rows(queries()["g9_scc"](spark, d)) == sorted((x, min(y for y in r[x] if x in r[y])) for x in r if x in r[x])
    w = reach(e | {(b, a) for a, b in e})
    weak = {x: min(w[x]) for x in w}
    assert rows(queries()["g11_weak_components"](spark, d)) == sorted(weak.items())
    k = [len({y for y in weak if weak[y] == c}) for c in set(weak.values())]
    (s,) = queries()["a17_component_summary"](spark, d).collect()
    assert (s.n_nodes, s.n_components, s.largest, s.smallest) == (len(weak), len(k), max(k), min(k))


def test_transitive_reduction(spark, rows, relation):
    d, edges = relation
    e, r = simple(edges), reach(simple(edges))
    dag = {(a, b) for a, b in e if a not in r[b]}
    r = reach(dag)
    want = sorted((a, b) for a, b in dag if not any(b in r[w] for v, w in dag if v == a))
    assert len(want) < len(dag) < len(e)
    assert rows(queries()["g10_transitive_reduction"](spark, d)) == want


def merged(edges):
    """{(src, tgt, type): [uncertain, ord, rows]} and the keys that a type below theirs covers."""
    per = {}
    for a, b, t, u, k in edges:
        if a != b:
            x = per.setdefault((a, b, t), [False, k, 0])
            x[:] = x[0] or u, min(x[1], k), x[2] + 1
    return per, {(a, b, t) for a, b, t in per if any((a, b) == (c, e) and t in O.ancestors(s)[1:] for c, e, s in per)}


def test_merged_types(spark, rows, relation):
    d, edges = relation
    per, gone = merged([e for e in edges if e[2] in O.DIRECTED])
    assert gone
    group = {(a, b, t): [x for (c, e, s), x in per.items() if (a, b) == (c, e) and s in O.ancestors(t)] for a, b, t in per}
    assert rows(queries()["g2_lattice_merge"](spark, d)) == sorted((*k, any(x[0] for x in g), min(x[1] for x in g)) for k, g in group.items() if k not in gone)
    pairs, _ = merged([(min(a, b), max(a, b), t, u, k) for a, b, t, u, k in edges if t in O.SIBLING])
    assert rows(queries()["g3_sibling_pairs"](spark, d)) == sorted((*k, x[0]) for k, x in pairs.items())
    (s,) = queries()["a15_event_counts"](spark, d).collect()
    n = sum(x[2] for x in per.values())
    assert (s.selfloop, s.n_edges) == (sum(a == b for a, b, *_ in edges), len(per) - len(gone))
    assert (s.merge_equal, s.merge_more_specific) == (sum(x[2] - 1 for k, x in per.items() if k not in gone), sum(per[k][2] for k in gone))
    assert s.redundancy == round((n - s.n_edges) / n, 6)


def test_cycle_edges(spark, rows, relation):
    d, edges = relation
    e, r = simple(edges), reach(simple(edges))
    assert rows(queries()["g7_cycle_edges"](spark, d)) == sorted((a, b) for a, b in e if a in r[b])
