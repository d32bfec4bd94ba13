import random

import pytest
from pyspark.sql import functions as F

from lexweave.operators import hierarchy as H


def brute(parent):
    out = {}
    for x in parent:
        seen, y = [], x
        while y is not None and y not in seen:
            seen.append(y)
            y = parent.get(y) if parent.get(y) in parent else None
        out[x] = (min(seen[seen.index(y) :]), -1) if y is not None else (seen[-1], len(seen) - 1)
    return out


@pytest.mark.parametrize("block, radix, part, local", [(H.BLOCK, H.RADIX, H.PART, H.LOCAL_NODES), (8, 2, 3, 0), (1, 3, 50, 0)])
def test_random_forest_with_loops(spark, monkeypatch, block, radix, part, local):
    monkeypatch.setattr(H, "LOCAL_NODES", local)
    monkeypatch.setattr(H, "BLOCK", block), monkeypatch.setattr(H, "RADIX", radix), monkeypatch.setattr(H, "PART", part)
    rnd = random.Random(3)
    codes = [f"c{i:03d}" for i in range(220)]
    parent = {c: (rnd.choice(codes[:i]) if i and rnd.random() < 0.93 else None) for i, c in enumerate(codes)}
    for i in range(100, 160):  # a chain
        parent[codes[i]] = codes[i - 1]
    parent["c010"], parent["c011"], parent["c012"], parent["c020"], parent["c030"] = "c011", "c012", "c010", "c020", "missing"
    t = H.hierarchy(spark.createDataFrame(list(parent.items()), "code string, parent string").withColumn("depth", F.lit("clash")))
    got = {r.code: r for r in t.collect()}
    want = brute(parent)
    assert {c: (r.root, r.depth) for c, r in got.items()} == want
    trees = [r for r in got.values() if r.depth >= 0]
    for r in trees:
        below = {x.code for x in trees if r.code in x.path}
        assert r.size == len(below)
        assert below == {x.code for x in trees if x.root == r.root and r.lo <= x.lo <= r.hi}
        assert len(r.path) == r.depth + 1 and r.path[-1] == r.code and r.path[0] == r.root
    assert sorted(r.lo for r in trees) == list(range(len(trees)))
    assert {c for c, r in got.items() if r.on_loop} == {"c010", "c011", "c012", "c020"}


def test_resolution(spark, rows):
    data = [("a", "Alpha", None), ("a", "Alpha", None), ("b", "Beta", " ALPHA "), ("c", "Gamma", "B"), ("d", "Delta", "-"), ("e", "Eps", "Not a family"), ("f", "Phi", ""), ("g", "Ge", "nowhere"), ("h", None, "h"), (None, "x", "a")]
    p = H.resolve_parents(spark.createDataFrame(data, "code string, name string, par string"), F.col("code"), F.col("name"), F.col("par"))
    assert {r.code: r.parent for r in p.collect()} == {"a": None, "b": "a", "c": "b", "d": None, "e": None, "f": None, "g": None, "h": "h"}


def test_empty_and_descendants(spark, rows):
    empty = spark.createDataFrame([], "code string, parent string")
    assert H.hierarchy(empty).count() == 0
    t = H.hierarchy(spark.createDataFrame([("r", None), ("x", "r"), ("y", "x"), ("z", "r")], "code string, parent string"))
    assert rows(H.descendants(t, t.where("code in ('r', 'x')"))) == [("r", "x"), ("r", "y"), ("r", "z"), ("x", "y")]


def test_hot_keys_apart(spark, rows, monkeypatch):
    from lexweave.plans import runtime

    left = spark.createDataFrame([("hot" if i % 3 else f"k{i}", i) for i in range(90)] + [(None, 999)], "k string, v int")
    right = spark.createDataFrame([("hot", 1), ("k3", 2)], "k string, w int")
    want = sorted(map(str, rows(left.join(right, "k", "left").na.fill(-1).na.fill("-"))))
    monkeypatch.setattr(runtime, "SKEW_ROWS", 10)
    monkeypatch.setattr(runtime, "HOT_SHARE", 0.1)
    assert sorted(map(str, rows(runtime.skew_join(left, right, "k", 91).na.fill(-1).na.fill("-")))) == want


def test_descendants_of_every_family(spark, rows, tmp_path):
    from lexweave.plans.core_queries import p2_descendants

    rnd = random.Random(5)
    parent = {f"f{i:02d}": (f"f{rnd.randrange(i):02d}" if i % 9 else None) for i in range(80)} | {"x": "y", "y": "x", "z": "y"}
    spark.createDataFrame([(c, f"Name {c}", None, p) for c, p in parent.items()] * 2, "code string, canonical_name string, other_names string, parent_family string").write.parquet(f"{tmp_path}/language_families.parquet")
    want = []
    for c in parent:
        p = parent[c]
        while p and c < "x":
            want.append((p, c))
            p = parent[p]
    assert {a for a, _ in want if parent[a] is None} and {a for a, _ in want if parent.get(parent[a])}
    assert rows(p2_descendants(spark, str(tmp_path))) == sorted(want)
