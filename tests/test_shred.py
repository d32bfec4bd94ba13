import json

from pyspark.sql import functions as F

from lexweave.operators.shred import assemble, shred

LEAVES = ["[].id", "[].c.ip", "[].s[].t[].n"]


def brute(key, text):
    try:
        x = json.loads(text) if text else None
    except ValueError:
        x = None
    out = []
    for i, r in enumerate(x if isinstance(x, list) else [x] if isinstance(x, dict) else [], 1):
        r = r if isinstance(r, dict) else {}
        c = r.get("c") if isinstance(r.get("c"), dict) else {}
        s = r.get("s") if isinstance(r.get("s"), list) else []
        rid, ip = r.get("id"), c.get("ip")
        head = (key, i, None if rid is None else str(rid), ip)
        if not s:
            out.append((*head, 0, 0, None))
        for j, sec in enumerate(s, 1):
            t = sec.get("t") if isinstance(sec, dict) and isinstance(sec.get("t"), list) else []
            if not t:
                out.append((*head, j, 0, None))
            out += [(*head, j, k, (u or {}).get("n")) for k, u in enumerate(t, 1)]
    return out


TEXTS = [
    None, "", "[]", "{}", "no json", "[{}]", '{"id":1,"c":{"ip":"x"},"s":[{"t":[{"n":"a"},{"n":"b"}]},{"t":[]},{}]}', '[{"id":"7","c":"deleted","s":[{"t":null},{"t":[{"n":"q"},{}]}]},{"id":8,"c":null,"s":null},{"s":[]},{"id":9,"s":[{"t":[{"n":"z"}]}]}]',
    json.dumps([{"id": i, "s": [{"t": [{"n": f"{i}.{j}.{k}"} for k in range(j)]} for j in range(i % 4)]} for i in range(500)]),
]


def test_tables_are_the_records(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS * 2)), "k long, t string").withColumn("rec_key", F.lit("clash")).withColumn("c0", F.lit(1))
    t = assemble(shred(df, F.col("k"), F.col("t"), LEAVES), LEAVES, "[].s[].t[]", {"id": LEAVES[0], "ip": LEAVES[1], "n": LEAVES[2]}, outer=True)
    got = [tuple(r) for r in t.select("rec_key", "pos1", "id", "ip", "pos2", "pos3", "n").collect()]
    want = [r for k, x in enumerate(TEXTS * 2) for r in brute(k, x)]
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(got, key=key) == sorted(want, key=key)


def test_levels(spark):
    s = shred(spark.createDataFrame([(1, '[{"s":[{"t":[{"n":"a"},{"n":"b"}]},{}]},{}]')], "k long, t string"), F.col("k"), F.col("t"), ["[].s[].t[].n"]).first()
    assert (list(s.c0.rep), list(s.c0.dfn), list(s.c0.val)) == ([0, 3, 2, 1], [4, 4, 2, 1], ["a", "b", None, None])


def test_inner_table_and_empty(spark):
    df = spark.createDataFrame([(1, TEXTS[6]), (2, "[]")], "k long, t string")
    t = assemble(shred(df, F.col("k"), F.col("t"), LEAVES), LEAVES, "[].s[]", {"id": "[].id"})
    assert sorted((r.rec_key, r.pos1, r.pos2, r.id) for r in t.collect()) == [(1, 1, 1, "1"), (1, 1, 2, "1"), (1, 1, 3, "1")]
    assert assemble(shred(df.limit(0), F.col("k"), F.col("t"), LEAVES), LEAVES, "[].s[]", {"id": "[].id"}).count() == 0
