"""Parent-child links of unknown depth: nested-set ranges, and by them root, depth, path, ancestors and descendants.

* upward: subtree sizes, in doubling steps along the links, so a tree of depth d takes about log2(d) rounds: after round
  k a node knows its 2^k-th ancestor and the size of its subtree down to 2^k levels;
* nodes that still have a 2^k-th ancestor when a round leaves their number unchanged are unprocessed: their links run
  into a loop;
* siblings, and the roots as siblings of each other, get preorder offsets by prefix sums of the sizes, in two levels so
  that a parent with a third of all rows isn't one task's work;
* downward: the offsets along the path to the root are added up, again by doubling, which gives each node its range
  lo..hi in the preorder of the whole forest.

Up to LOCAL_NODES nodes make both passes, and the search of loops, in the memory of one task, by the same sums.

The rest comes from the ranges. ``b`` is a descendant of ``a`` if a.lo < b.lo <= a.hi. The depth of a node is the number
of ranges open at its lo less one, a running sum over the preorder; its root is the last root before it. Ancestors and
descendants are joined without comparing the nodes of a tree with each other: a range is cut into aligned blocks of
powers of RADIX, in one of which each of its nodes lies.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexweave.plans.runtime import clean_key, cut, release, skew_join

#: Siblings are numbered within parts of their parent's children: at least PARTS, and enough for about PART rows each.
PARTS, PART = 64, 50_000
#: Running sums over the preorder are taken within blocks of so many nodes and carried from block to block.
BLOCK = 1 << 16
RADIX = 16
#: Nodes whose sizes and offsets one task may work out.
LOCAL_NODES = 500_000


def resolve_parents(df: DataFrame, code: Column, name: Column, parent: Column, none: tuple[str, ...] = ("-", "not a family")) -> DataFrame:
    """(code, parent): one row per code; the parent's text is matched with codes first, then with names.

    Space around it and letter case don't count. Null, empty and the ``none`` values mean no parent, as does a parent
    that isn't in the table. Rows without a code are left out. Repeated rows count once; where rows of one code name
    several parents, the smallest text wins, and where several codes bear one name, the smallest code.
    """
    ck = clean_key(parent)
    rows = df.select(code.alias("code"), clean_key(code).alias("ck"), clean_key(name).alias("nk"), F.when(~ck.isin(*none), ck).alias("pk")).where("code is not null")
    rows = rows.groupBy("code").agg(F.min("ck").alias("ck"), F.min("nk").alias("nk"), F.min("pk").alias("pk"))
    rows = cut(rows)
    n = rows.count()
    keys = rows.select(F.col("ck").alias("pk"), F.lit(0).alias("rank"), "code").unionByName(rows.select(F.col("nk").alias("pk"), F.lit(1).alias("rank"), "code")).where("pk is not null")
    lookup = keys.groupBy("pk").agg(F.min(F.struct("rank", "code"))["code"].alias("parent"))
    return cut(skew_join(rows.select("code", "pk"), lookup, "pk", n).select("code", "parent"))


def hierarchy(links: DataFrame, with_path: bool = True) -> DataFrame:
    """Per code: parent, root, depth, size, lo, hi, on_loop and (``with_path``) the path from the root.

    ``links`` has (code, parent), code unique; other columns are ignored. A parent that isn't among the codes makes a
    root. depth is -1 for nodes whose links run into a loop; their root is the smallest code on it, on_loop says whether
    they lie on it themselves, and they have no size, range or path. size counts the node itself; lo runs from 0 in
    preorder through all trees and hi = lo + size - 1. Null codes are left out; an empty table gives an empty result.
    """
    nodes = links.select("code", "parent").where("code is not null")
    known = nodes.select(F.col("code").alias("parent"), F.lit(True).alias("known"))
    n = nodes.count()
    nodes = cut(skew_join(nodes, known, "parent", n).select("code", F.when(F.col("known"), F.col("parent")).alias("parent")))
    if n <= LOCAL_NODES:
        both = cut(nodes.repartition(1).mapInArrow(_in_memory, "code string, parent string, size bigint, lo bigint, low string, on_loop boolean"))
        state, live = both.where("lo is not null").select("code", "parent", "size", "lo"), both.where("lo is null").limit(1).count()
        looped = both.where("lo is null").select("code", "parent", F.col("low").alias("root"), F.lit(-1).alias("depth"), "on_loop")
    else:
        state, live, looped = _by_doubling(nodes, n)

    done = _scan(state).withColumn("on_loop", F.lit(False))
    release(state)
    if with_path:
        up = ancestors(cut(done.select("code", "lo", "size", (F.col("lo") + F.col("size") - 1).alias("hi"))))
        path = up.groupBy("code").agg(F.array_sort(F.collect_list(F.struct("lo", "ancestor"))).alias("up"))
        done = done.join(path, "code", "left").withColumn("path", F.concat(F.coalesce(F.transform("up", lambda x: x["ancestor"]), F.array().cast("array<string>")), F.array("code"))).drop("up")
    return done.unionByName(looped, allowMissingColumns=True) if live else done


def _in_memory(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Both passes over all nodes, siblings in the order of their codes; nodes that no root leads to run into loops."""
    rows = sorted(r for b in batches for r in zip(b.column(0).to_pylist(), b.column(1).to_pylist()))
    at = {c: i for i, (c, _) in enumerate(rows)}
    n = len(rows)
    up = [-1 if p is None else at[p] for _, p in rows]
    below: list[list[int]] = [[] for _ in range(n)]
    order = []
    for i, p in enumerate(up):
        (order if p < 0 else below[p]).append(i)
    for i in order:  # grows: the nodes from the roots down
        order.extend(below[i])
    size, lo = [1] * n, [None] * n
    for i in reversed(order):
        if up[i] >= 0:
            size[up[i]] += size[i]
    free = 0
    for i in order:
        if up[i] < 0:
            lo[i], free = free, free + size[i]
        place = lo[i] + 1
        for k in below[i]:
            lo[k], place = place, place + size[k]
    low: list[int | None] = [None] * n
    ring = [False] * n
    for i in range(n):
        path, seen, x = [], {}, i
        while lo[x] is None and low[x] is None and x not in seen:
            seen[x] = len(path)
            path.append(x)
            x = up[x]
        if path:
            least = low[x] if low[x] is not None else min(path[seen[x] :])
            for k in path[seen[x] :] if x in seen else []:
                ring[k] = True
            for k in path:
                low[k] = least
    cols = ([c for c, _ in rows], [p for _, p in rows], [s if v is not None else None for s, v in zip(size, lo)], lo, [None if v is None else rows[v][0] for v in low], ring)
    types = (pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.bool_())
    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], ["code", "parent", "size", "lo", "low", "on_loop"])


def _by_doubling(nodes: DataFrame, n: int) -> tuple[DataFrame, int, DataFrame | None]:
    """(nodes with size and lo, whether there are loops, the nodes that run into them) of any number of nodes."""
    # upward: sizes
    state = nodes.select("code", F.col("parent").alias("up"), F.lit(1).cast("bigint").alias("size"))
    live, jumps = state.where("up is not null").count(), []
    while True:
        jumps.append(state)
        if not live:
            break
        far = state.select(F.col("code").alias("up"), F.col("up").alias("up2"))
        below = state.where("up is not null").groupBy("up").agg(F.sum("size").alias("more")).withColumnRenamed("up", "code")
        moved = skew_join(state, far, "up", n).select("code", F.col("up2").alias("up"), "size")
        state = cut(moved.join(below, "code", "left").select("code", "up", (F.col("size") + F.coalesce("more", F.lit(0))).alias("size")))
        now = state.where("up is not null").count()
        if now == live:
            break
        live = now
    trees = state.where("up is null").select("code", "size").join(nodes, "code")

    # prefix sums over the siblings; roots are siblings, under no code
    parts = max(PARTS, -(-n // PART))
    kids = trees.select("code", "parent", "size", F.pmod(F.xxhash64("code"), F.lit(parts)).cast("int").alias("part"))
    sums = kids.groupBy("parent", "part").agg(F.sum("size").alias("all"))
    before = Window.partitionBy("parent").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(F.col("parent").alias("p2"), F.col("part").alias("part2"), F.coalesce(F.sum("all").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("parent", "part").orderBy("code").rowsBetween(Window.unboundedPreceding, -1)
    kids = kids.withColumn("own", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    kids = kids.join(sums, F.col("parent").eqNullSafe(F.col("p2")) & (F.col("part") == F.col("part2")))
    off = F.col("base") + F.col("own") + F.when(F.col("parent").isNotNull(), 1).otherwise(0)
    state = cut(kids.select("code", "parent", "size", off.cast("bigint").alias("lo")))

    # downward: add up along the path to the root
    for jump in jumps[:-1] if live == 0 else jumps:
        far = state.select(F.col("code").alias("up"), F.col("lo").alias("lo2"))
        pulled = skew_join(state.join(jump.select("code", "up"), "code", "left"), far, "up", n)
        old, state = state, cut(pulled.select("code", "parent", "size", (F.col("lo") + F.coalesce("lo2", F.lit(0))).alias("lo")))
        release(old)

    release(*jumps[:-1])
    return state, live, _loops(nodes, jumps[-1].select("code", "up"), n) if live else None


def _scan(ranges: DataFrame) -> DataFrame:
    """Root and depth of nodes (code, parent, size, lo) by running sums in the order of lo.

    One task sees the totals of all blocks, a row for BLOCK nodes.
    """
    ends = ranges.groupBy((F.col("lo") + F.col("size")).alias("lo")).agg(F.count("*").alias("closed"))
    at = ranges.join(ends, "lo", "left").select("code", "parent", "size", "lo", (1 - F.coalesce("closed", F.lit(0))).alias("net"), F.floor(F.col("lo") / BLOCK).alias("block"))
    at = cut(at)
    top = F.when(F.col("parent").isNull(), F.col("code"))
    sums = at.groupBy("block").agg(F.sum("net").alias("net"), F.max_by(top, F.when(F.col("parent").isNull(), F.col("lo"))).alias("top"))
    earlier = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = sums.select("block", F.coalesce(F.sum("net").over(earlier), F.lit(0)).alias("open"), F.last("top", True).over(earlier).alias("top"))
    here = Window.partitionBy("block").orderBy("lo").rowsBetween(Window.unboundedPreceding, 0)
    run = at.withColumn("sum", F.sum("net").over(here)).withColumn("near", F.last(top, True).over(here)).join(carried, "block")
    return run.select("code", "parent", F.coalesce("near", "top").alias("root"), (F.col("open") + F.col("sum") - 1).cast("int").alias("depth"), "size", "lo", (F.col("lo") + F.col("size") - 1).alias("hi"))


def _blocks(levels: int) -> Column:
    """The aligned blocks (level, number) that the places lo + 1 to hi consist of."""

    def span(a: Column, b: Column, k: int) -> Column:
        return F.when(a < b, F.transform(F.sequence(a, b - 1), lambda x: F.struct(F.lit(k).alias("k"), x.alias("i")))).otherwise(F.array().cast("array<struct<k:int,i:bigint>>"))

    out = []
    for k in range(levels):
        w = RADIX**k
        a, b = F.ceil((F.col("lo") + 1) / w).cast("bigint"), F.floor((F.col("hi") + 1) / w).cast("bigint")
        up, down = F.ceil(a / RADIX).cast("bigint") * RADIX, F.floor(b / RADIX).cast("bigint") * RADIX
        out.append(F.when(up <= down, F.concat(span(a, up, k), span(down, b, k))).otherwise(span(a, b, k)))
    return F.concat(*out)


def ancestors(tree: DataFrame, of: DataFrame | None = None) -> DataFrame:
    """(code, ancestor, lo): the proper ancestors of every node (of the codes in ``of`` only as ancestors, if given), with
    the ancestor's lo. ``tree`` has (code, lo, hi, size) and is read three times.

    Work and shuffle are the result and a row per node and level; the number of levels is the logarithm of the largest
    size. Nodes without a range have no ancestors.
    """
    tree = tree.where("lo is not null").select("code", "lo", "hi", "size")
    largest, levels = tree.agg(F.coalesce(F.max("size"), F.lit(1))).first()[0], 1
    while RADIX**levels <= largest:
        levels += 1
    above = tree.where("size > 1")
    if of is not None:
        above = above.join(of.select("code").distinct(), "code", "left_semi")
    above = above.select(F.col("code").alias("ancestor"), "lo", F.explode(_blocks(levels)).alias("b")).select("ancestor", F.col("lo").alias("alo"), "b.k", "b.i")
    below = tree.select("code", F.explode(F.array(*(F.struct(F.lit(k).alias("k"), F.floor(F.col("lo") / RADIX**k).cast("bigint").alias("i")) for k in range(levels)))).alias("b")).select("code", "b.k", "b.i")
    return below.join(above, ["k", "i"]).select("code", "ancestor", F.col("alo").alias("lo"))


def _loops(nodes: DataFrame, jump: DataFrame, n: int) -> DataFrame:
    """The nodes that run into loops. ``jump`` has each node's ancestor many steps up; only theirs are not null."""
    state = cut(jump.where("up is not null"))
    seen = state.select("up").distinct().count()
    while True:  # until every path has ended in its loop: then one more jump reaches just as many nodes
        far = state.select(F.col("code").alias("up"), F.col("up").alias("up2"))
        state = cut(skew_join(state, far, "up", n).select("code", F.col("up2").alias("up")))
        now = state.select("up").distinct().count()
        if now == seen:
            break
        seen = now
    ring = state.select(F.col("up").alias("code")).distinct()
    rings = cut(ring.join(nodes, "code").select("code", F.col("parent").alias("up"), F.col("code").alias("low")))
    while True:
        far = rings.select(F.col("code").alias("up"), F.col("up").alias("up2"), F.col("low").alias("low2"))
        new = cut(rings.join(far, "up").select("code", F.col("up2").alias("up"), F.least("low", "low2").alias("low"), (F.col("low2") < F.col("low")).alias("changed")))
        if not new.where("changed").limit(1).count():
            break
        rings = new.drop("changed")
    low = rings.select(F.col("code").alias("up"), "low")
    looped = skew_join(state, low, "up", n).join(ring.select("code", F.lit(True).alias("on_loop")), "code", "left").join(nodes, "code")
    return looped.select("code", "parent", F.col("low").alias("root"), F.lit(-1).alias("depth"), F.coalesce("on_loop", F.lit(False)).alias("on_loop"))


def descendants(tree: DataFrame, codes: DataFrame | None = None) -> DataFrame:
    """(code, descendant) for each of ``codes`` (all without), by the nested-set ranges. Repeated and unknown codes and
    those on or before a loop add nothing."""
    return ancestors(tree, codes).select(F.col("ancestor").alias("code"), F.col("code").alias("descendant"))
