"""Reduction and analysis of typed relation graphs.

Edges are (src, tgt, type, text, uncertain, ord) with string node ids. Loops keep only what changes, cut their lineage in
the shared checkpoint folder and end when an aggregate says that nothing moved. No step collects nodes or edges to the
driver, and joins on nodes, of which a few may be very hot, go through ``skew_join`` and ``salted_join`` or are
pre-aggregated.

Cycles and implied edges are matters of one weak component. Components of up to LOCAL_EDGES edges are dealt to bins of
about that size, each of which is one task's work in memory; larger ones go through loops that take a round per link.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexweave.operators import ontology as O
from lexweave.plans.runtime import cut, grow, release, salted_join, skew_join

#: Steps of a loop between two cuts of the lineage.
UNROLL = 3
#: Edges of a weak component that one task may hold; a bin has no more than some three times as many.
LOCAL_EDGES = 1_000_000
#: Pairs of nodes that one task may hold whose pairs are all joined up already, at some 150 bytes each.
LOCAL_PAIRS = 6_000_000
#: Targets whose reach is followed at once, a bit each, within a task.
CHUNK = 4096
#: Steps of the walks back from a group of targets that are held at once; a group that takes more is followed by bits.
WALKED = 8_000_000


def node_id(c: str) -> Column:
    """term#language#sense of a lexeme struct."""
    return F.concat_ws("#", F.col(f"{c}.term"), F.col(f"{c}.language"), F.coalesce(F.col(f"{c}.sense_idx"), F.lit(0)).cast("string"))


def edge_rows(relations: DataFrame) -> DataFrame:
    """Edges of a relation table, repeated rows each. Rows without a term at either end are left out, unknown types are
    ``related`` and a null ``uncertain`` is false; an empty text is none."""
    return relations.where("src.term is not null and tgt.term is not null").select(
        node_id("src").alias("src"), node_id("tgt").alias("tgt"), O.type_case(F.col("type")).alias("type"), F.nullif(F.col("text"), F.lit("")).alias("text"),
        F.coalesce("uncertain", F.lit(False)).alias("uncertain"), F.col("ord").cast("bigint").alias("ord"),
    )


def edges_of(relations: DataFrame) -> DataFrame:
    """``edge_rows``, repeated rows once."""
    return edge_rows(relations).distinct()


def no_self_loops(edges: DataFrame) -> DataFrame:
    return edges.where("src <> tgt")


def _with_turn(edges: DataFrame, older: DataFrame) -> DataFrame:
    """``edges`` with ``turn``: whether ``swap_historical`` turns them, or null."""
    lang = lambda c: F.substring_index(F.substring_index(c, "#", -2), "#", 1)
    pairs = older.select(F.col("old").alias("lt"), F.col("young").alias("ls"), F.lit(True).alias("turn")).distinct()
    e = edges.withColumn("ls", lang("src")).withColumn("lt", lang("tgt")).join(pairs, ["ls", "lt"], "left")
    return e.select(*edges.columns, (F.col("turn") & F.col("type").isin(*O.HISTORICAL)).alias("turn"))


def swap_historical(edges: DataFrame, older: DataFrame) -> DataFrame:
    """Turn inherited edges round that run from the younger to the older language.

    ``older`` has (old, young), the strict closure of a language tree; the language is the part of the id after its term.
    """
    e, turn = _with_turn(edges, older), F.col("turn")
    return e.select(F.when(turn, F.col("tgt")).otherwise(F.col("src")).alias("src"), F.when(turn, F.col("src")).otherwise(F.col("tgt")).alias("tgt"), *(c for c in edges.columns if c not in ("src", "tgt")))


def merge_types(edges: DataFrame) -> DataFrame:
    """Per pair the most specific types; merged texts in order of arrival, uncertain if any was.

    A type gives way where a type below it holds between the same nodes, and its text goes to each type that stays and is
    below it. Equal texts are kept once each time they arrive; null texts add nothing. The result doesn't depend on the
    order of the rows but for the text, which follows ``ord``.
    """
    spark = edges.sparkSession
    up = O.closure_table(spark)
    per = edges.groupBy("src", "tgt", "type").agg(F.array_sort(F.collect_list(F.when(F.col("text").isNotNull(), F.struct("ord", "text")))).alias("texts"), F.bool_or("uncertain").alias("uncertain"), F.min("ord").alias("ord"))
    types = per.groupBy("src", "tgt").agg(F.collect_set("type").alias("types")).where(F.size("types") > 1)
    many = per.join(types.select("src", "tgt"), ["src", "tgt"], "left_semi")
    single = per.join(types.select("src", "tgt"), ["src", "tgt"], "left_anti")
    covered = many.select("src", "tgt", "type").join(F.broadcast(up), "type").select("src", "tgt", F.col("ancestor").alias("type")).distinct()
    stay = many.join(covered, ["src", "tgt", "type"], "left_anti").select("src", "tgt", "type")
    # every row, at its own type and at those above it that it may stand for
    giver = many.select("src", "tgt", F.col("type").alias("from"), "texts", "uncertain", "ord")
    same = O.closure_table(spark).union(spark.createDataFrame([(t, t) for t in O.PARENT], "type string, ancestor string"))
    taken = stay.join(F.broadcast(same), "type").select("src", "tgt", "type", F.col("ancestor").alias("from")).join(giver, ["src", "tgt", "from"])
    taken = taken.groupBy("src", "tgt", "type").agg(F.array_sort(F.flatten(F.collect_list("texts"))).alias("texts"), F.bool_or("uncertain").alias("uncertain"), F.min("ord").alias("ord"))
    return single.unionByName(taken).select("src", "tgt", "type", F.nullif(F.array_join(F.transform("texts", lambda t: t["text"]), "; "), F.lit("")).alias("text"), "uncertain", "ord")


def undirected(edges: DataFrame) -> DataFrame:
    """The smaller node first."""
    return edges.select(F.least("src", "tgt").alias("src"), F.greatest("src", "tgt").alias("tgt"), *(c for c in edges.columns if c not in ("src", "tgt")))


def absorb_related(edges: DataFrame) -> DataFrame:
    """Merge everything: siblings and ``related`` by undirected pair, ``related`` absorbed where a pair has a closer edge.

    The text of an absorbed edge is added to that of one closer edge of its pair, which becomes uncertain if it was: a
    directed one before a sibling, then the one that came first. So it doesn't depend on which of them came before.
    """
    e = no_self_loops(edges)
    origin = merge_types(e.where(F.col("type").isin(*O.DIRECTED)))
    sibling = merge_types(undirected(e.where(F.col("type").isin(*O.SIBLING))))
    related = cut(merge_types(undirected(e.where("type = 'related'"))))
    closer = cut(origin.withColumn("far", F.lit(0)).unionByName(sibling.withColumn("far", F.lit(1))))
    pair = [F.least("src", "tgt").alias("a"), F.greatest("src", "tgt").alias("b")]
    first = closer.groupBy(*pair).agg(F.min(F.struct("far", "ord", "type", "src"))["type"].alias("type"), F.min(F.struct("far", "ord", "type", "src"))["src"].alias("src"))
    given = related.select(F.col("src").alias("a"), F.col("tgt").alias("b"), F.col("text").alias("rtext"), F.col("uncertain").alias("runcertain"))
    given = given.join(first, ["a", "b"]).select("src", F.when(F.col("src") == F.col("a"), F.col("b")).otherwise(F.col("a")).alias("tgt"), "type", "rtext", "runcertain")
    text = F.nullif(F.concat_ws("; ", "text", "rtext"), F.lit(""))
    closer = closer.join(given, ["src", "tgt", "type"], "left").select("src", "tgt", "type", text.alias("text"), (F.col("uncertain") | F.coalesce("runcertain", F.lit(False))).alias("uncertain"), "ord")
    left = related.join(first.select(F.col("a").alias("src"), F.col("b").alias("tgt")), ["src", "tgt"], "left_anti")
    return closer.unionByName(left)


class _Sets:
    """Disjoint sets of ids; the smallest id of a set stands for it."""

    def __init__(self) -> None:
        self.up: dict[str, str] = {}

    def top(self, x: str) -> str:
        up = self.up
        y = up.setdefault(x, x)
        while y != x:
            up[x] = z = up[y]
            x, y = y, z
        return x

    def join(self, xs: list[str], ys: list[str]) -> None:
        for x, y in zip(xs, ys):
            x, y = self.top(x), self.top(y)
            if x != y:
                self.up[max(x, y)] = min(x, y)


def _forests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges as links to the smallest node that they connect each node to, for each 300 000 edges of a task."""
    sets, held = _Sets(), 0

    def out() -> pa.RecordBatch:
        pairs = [(x, t) for x in list(sets.up) if (t := sets.top(x)) != x]
        return pa.RecordBatch.from_arrays([pa.array([p[k] for p in pairs], pa.string()) for k in (0, 1)], ["src", "tgt"])

    for b in batches:
        sets.join(b.column(0).to_pylist(), b.column(1).to_pylist())
        held += b.num_rows
        if held >= 300_000:
            yield out()
            sets, held = _Sets(), 0
    if held:
        yield out()


def _labelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sets = _Sets()
    for b in batches:
        sets.join(b.column(0).to_pylist(), b.column(1).to_pylist())
    nodes = list(sets.up)
    yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.string()), pa.array([sets.top(x) for x in nodes], pa.string())], ["node", "component"])


def weak_components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node id that can be reached ignoring direction, for nodes with an edge to another.

    Every task first links what its edges connect, which leaves no more links than nodes. Up to LOCAL_EDGES of these are
    joined up in one task; more in rounds: each takes the smallest label among neighbours, then the label's label, so
    long chains shrink by halves. A hot node's neighbours are pre-aggregated before the shuffle.
    """
    links = cut(edges.select("src", "tgt").where("src <> tgt").mapInArrow(_forests, "src string, tgt string").distinct())
    n = links.count()
    if n <= LOCAL_EDGES:
        return cut(links.repartition(1).mapInArrow(_labelled, "node string, component string"))
    both = cut(links.union(links.select("tgt", "src")).distinct())
    labels = cut(both.groupBy(F.col("src").alias("node")).agg(F.least(F.min("tgt"), F.first("src")).alias("component")))
    n = both.count()
    while True:
        # the smallest label next to each node
        near = skew_join(both.withColumnRenamed("tgt", "node"), labels, "node", n, "inner").groupBy(F.col("src").alias("node")).agg(F.min("component").alias("near"))
        step = labels.join(near, "node").select("node", F.least("component", "near").alias("to"), F.col("component").alias("was"))
        jump = labels.select(F.col("node").alias("to"), F.col("component").alias("then"))
        new = cut(skew_join(step, jump, "to", n).select("node", F.least("to", F.coalesce("then", "to")).alias("component"), (F.least("to", F.coalesce("then", "to")) != F.col("was")).alias("moved")))
        labels = new.select("node", "component")
        if not new.where("moved").limit(1).count():
            return labels


def _core(edges: DataFrame, rounds: int) -> tuple[DataFrame, int]:
    """Edges left when nodes without predecessor or successor are taken away, round by round; their number."""
    n = edges.count()
    for _ in range(0, rounds, UNROLL):
        for _ in range(UNROLL):
            ends = edges.select(F.col("tgt").alias("src"))
            starts = edges.select(F.col("src").alias("tgt"))
            edges = edges.join(ends, "src", "left_semi").join(starts, "tgt", "left_semi").select("src", "tgt")
        edges = cut(edges)
        m = edges.count()
        if m == n or not m:
            return edges, m
        n = m
    return edges, n


def _strong_by_rounds(edges: DataFrame, trim: int) -> DataFrame:
    """``strong_components`` of graphs of any size, in a round per link of the longest way.

    Trimming leaves the cycles and what lies between them. Then each node takes the largest id that reaches it (its
    colour), and from each node that bears its own colour the edges are walked back within the colour: what is met is one
    component. It is set aside and the rest treated alike.
    """
    left, n = _core(edges.select("src", "tgt").where("src <> tgt").distinct(), trim)
    parts = []
    while n:
        color = cut(left.select(F.col("src").alias("node")).union(left.select("tgt")).distinct().withColumn("color", F.col("node")))
        while True:
            new = color.select("node", "color", F.col("color").alias("was"))
            for _ in range(UNROLL):
                into = skew_join(left, new.select(F.col("node").alias("src"), "color"), "src", n, "inner").groupBy(F.col("tgt").alias("node")).agg(F.max("color").alias("seen"))
                new = new.join(into, "node", "left").select("node", F.greatest("color", "seen").alias("color"), "was")
            new = cut(new)
            color = new.select("node", "color")
            if not new.where("color <> was").limit(1).count():
                break
        inside = skew_join(left, color.select(F.col("node").alias("src"), F.col("color").alias("c1")), "src", n, "inner")
        inside = skew_join(inside, color.select(F.col("node").alias("tgt"), F.col("color").alias("c2")), "tgt", n, "inner").where("c1 = c2").select("src", "tgt", F.col("c1").alias("color"))
        inside = cut(inside)
        front = cut(color.where("node = color"))
        found = cut(front)
        while True:
            back = inside.join(front.select(F.col("node").alias("tgt"), "color"), ["tgt", "color"]).select(F.col("src").alias("node"), "color").distinct()
            front = cut(back.join(found, ["node", "color"], "left_anti"))
            if not front.limit(1).count():
                break
            found = grow(found, front)
        part = found.groupBy("color").agg(F.min("node").alias("scc"), F.count("*").alias("k")).where("k > 1")
        parts.append(cut(found.join(part, "color").select("node", "scc")))
        gone = found.select("node")
        rest = left.join(gone.withColumnRenamed("node", "src"), "src", "left_anti").join(gone.withColumnRenamed("node", "tgt"), "tgt", "left_anti")
        left, n = _core(cut(rest.select("src", "tgt")), trim)
    spark: SparkSession = edges.sparkSession
    out = spark.createDataFrame([], "node string, scc string")
    for p in parts:
        out = out.unionByName(p)
    return out


def _split(edges: DataFrame) -> tuple[DataFrame, DataFrame, int]:
    """(edges of small weak components with their ``bin``, edges of large ones, number of these)."""
    e = cut(edges.select("src", "tgt").where("src <> tgt").distinct())
    label = weak_components(e)
    n = e.count()
    e = cut(skew_join(e, label.select(F.col("node").alias("src"), "component"), "src", n, "inner"))
    size = e.groupBy("component").count().where(F.col("count") > LOCAL_EDGES).select("component")
    large = F.broadcast(size)  # there are no more than edges / LOCAL_EDGES
    rest = e.join(large, "component", "left_semi").select("src", "tgt")
    many = rest.count()
    bins = max(8, -(-(n - many) // max(1, LOCAL_EDGES)))
    small = e.join(large, "component", "left_anti").select("src", "tgt", F.pmod(F.xxhash64("component"), F.lit(bins)).cast("int").alias("bin"))
    return small.repartition(bins, "bin"), rest, many


def _in_bins(small: DataFrame, run: Callable[[np.ndarray, np.ndarray, pa.Array], pa.Table], schema: str) -> DataFrame:
    """``run`` on each bin's edges, as numbers of its nodes in the order of their ids, and these ids."""

    def one(t: pa.Table) -> pa.Table:
        both = pa.chunked_array([*t.column("src").chunks, *t.column("tgt").chunks]).combine_chunks()
        both = both.combine_chunks() if isinstance(both, pa.ChunkedArray) else both
        ids = both.unique().sort()
        at = pa.compute.index_in(both, ids).to_numpy(zero_copy_only=False).astype(np.int64)
        return run(at[: t.num_rows], at[t.num_rows :], ids)

    return small.groupBy("bin").applyInArrow(one, schema)


def _tarjan(n: int, src: np.ndarray, tgt: np.ndarray) -> np.ndarray:
    """The number of each node's strong component, numbered in reverse topological order."""
    order = np.argsort(src, kind="stable")
    to = tgt[order].tolist()
    start = np.searchsorted(src[order], np.arange(n + 1)).tolist()
    index, low, comp = [-1] * n, [0] * n, [-1] * n
    stack: list[int] = []
    count = made = 0
    for root in range(n):
        if index[root] >= 0:
            continue
        work = [(root, start[root])]
        index[root] = low[root] = count
        count += 1
        stack.append(root)
        while work:
            v, k = work.pop()
            if k < start[v + 1]:
                work.append((v, k + 1))
                w = to[k]
                if index[w] < 0:
                    index[w] = low[w] = count
                    count += 1
                    stack.append(w)
                    work.append((w, start[w]))
                elif comp[w] < 0:
                    low[v] = min(low[v], index[w])
                continue
            if low[v] == index[v]:
                while True:
                    w = stack.pop()
                    comp[w] = made
                    if w == v:
                        break
                made += 1
            if work:
                low[work[-1][0]] = min(low[work[-1][0]], low[v])
    return np.array(comp, np.int64)


def _strong_in_memory(src: np.ndarray, tgt: np.ndarray, ids: pa.Array) -> pa.Table:
    comp = _tarjan(len(ids), src, tgt)
    first = np.full(len(ids), len(ids))
    np.minimum.at(first, comp, np.arange(len(ids)))  # ids are sorted, so the smallest number is the smallest id
    on = np.flatnonzero(np.bincount(comp, minlength=len(ids))[comp] > 1)
    return pa.table({"node": ids.take(pa.array(on)), "scc": ids.take(pa.array(first[comp[on]]))})


def strong_components(edges: DataFrame, trim: int = 64) -> DataFrame:
    """(node, scc) for nodes on a cycle of two nodes or more; scc is the component's smallest node."""
    small, large, many = _split(edges)
    found = _in_bins(small, _strong_in_memory, "node string, scc string")
    return found.unionByName(_strong_by_rounds(large, trim)) if many else found


def on_cycles(edges: DataFrame, scc: DataFrame) -> DataFrame:
    """Edges with both ends in one strong component, with ``scc``."""
    scc = cut(scc)
    return edges.join(scc.select(F.col("node").alias("src"), "scc"), "src").join(scc.select(F.col("node").alias("tgt"), F.col("scc").alias("scc2")), "tgt").where("scc = scc2").drop("scc2")


def _implied_by_rounds(edges: DataFrame) -> DataFrame:
    """``implied_edges`` of graphs of any size, in a round per link of the longest way.

    Only edges that leave a node with several successors and enter a node with several predecessors can be. From the
    other successors of each one's source the walk goes on until the target is met, without visiting a node twice.
    """
    e = cut(edges.select("src", "tgt").distinct())
    n = e.count()
    forks = e.groupBy("src").count().where("count > 1").select("src")
    joins = e.groupBy("tgt").count().where("count > 1").select("tgt")
    asked = cut(e.join(forks, "src", "left_semi").join(joins, "tgt", "left_semi").select(F.col("src").alias("a"), F.col("tgt").alias("b")))
    front = cut(salted_join(asked, e.withColumnRenamed("src", "a"), "a", n).where("tgt <> b").select("a", "b", F.col("tgt").alias("at")))
    seen, hits = cut(front), None
    while front.limit(1).count():
        step = salted_join(front, e.withColumnRenamed("src", "at"), "at", front.count()).select("a", "b", F.col("tgt").alias("at")).distinct()
        step = cut(step.join(seen, ["a", "b", "at"], "left_anti"))
        met = step.where("at = b").select("a", "b")
        hits = met if hits is None else hits.union(met)
        # a question that is answered needs no further walk
        front = cut(step.where("at <> b").join(met, ["a", "b"], "left_anti"))
        seen = grow(seen, step)
    if hits is None:
        return asked.limit(0).select(F.col("a").alias("src"), F.col("b").alias("tgt"))
    return hits.distinct().select(F.col("a").alias("src"), F.col("b").alias("tgt"))


def _implied_by_bits(n: int, src: np.ndarray, tgt: np.ndarray, targets: np.ndarray) -> np.ndarray:
    """Along the reverse topological order each node gets the bits of the ``targets`` it reaches, CHUNK at a time; whether
    each edge into one of them is implied."""
    place = _tarjan(n, src, tgt)  # of a DAG: every node by itself, its successors before it
    order = np.argsort(place[src], kind="stable")
    src, tgt = src[order], tgt[order]
    start = np.flatnonzero(np.r_[True, src[1:] != src[:-1], True]).tolist() if len(src) else [0]
    heads, to = src.tolist(), tgt.tolist()
    hit = np.zeros(len(src), bool)
    for c in range(0, len(targets), CHUNK):
        bit = {int(t): 1 << k for k, t in enumerate(targets[c : c + CHUNK])}
        reach: dict[int, int] = {}
        for a, b in zip(start[:-1], start[1:]):
            far = near = 0
            for w in to[a:b]:
                far |= reach.get(w, 0)
                near |= bit.get(w, 0)
            if far & near:  # a successor that another one reaches
                for k in range(a, b):
                    if bit.get(to[k], 0) & far:
                        hit[order[k]] = True
            if far or near:
                reach[heads[a]] = far | near
    return hit


def _runs(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of each run, ``count`` of them."""
    ends = np.cumsum(count)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(start - ends + count, count)


def _implied(n: int, src: np.ndarray, tgt: np.ndarray) -> np.ndarray:
    """Which edges of a DAG longer paths imply: those from a node that is met on the way back from another predecessor.

    The ways back from many targets are walked at once, no node twice for a target. Where they grow beyond WALKED steps
    the targets are taken in smaller groups, and a group of CHUNK by bits, which cost the same however much is reached.
    """
    order = np.argsort(tgt, kind="stable")
    into, degree = src[order], np.bincount(tgt, minlength=n)
    start = np.cumsum(degree) - degree
    asked = np.flatnonzero((np.bincount(src, minlength=n)[src] > 1) & (degree[tgt] > 1))
    key = tgt[asked] * n + src[asked]
    hits, heavy = [key[:0]], []
    todo = np.unique(tgt[asked])
    work = [todo[k : k + 64 * CHUNK] for k in range(0, len(todo), 64 * CHUNK)]
    while work:
        group = work.pop()
        front = np.repeat(group, degree[group]) * n + into[_runs(start[group], degree[group])]
        front.sort()
        seen, met = front, []
        while len(front):
            node = front % n
            count = degree[node]
            if count.sum() + len(seen) > WALKED:
                break
            step = np.unique(np.repeat(front // n, count) * n + into[_runs(start[node], count)])
            old = np.isin(step, seen, assume_unique=True)
            met.append(step[old])  # a predecessor of the target is among what was seen first
            front = step[~old]
            seen = np.sort(np.concatenate([seen, front]), kind="stable")
        if not len(front):
            hits += met
        elif len(group) > CHUNK:
            work += [group[: len(group) // 2], group[len(group) // 2 :]]
        else:
            heavy.append(group)
    hit = np.zeros(len(src), bool)
    hit[asked[np.isin(key, np.concatenate(hits))]] = True
    return hit | _implied_by_bits(n, src, tgt, np.concatenate(heavy)) if heavy else hit


def _implied_in_memory(src: np.ndarray, tgt: np.ndarray, ids: pa.Array) -> pa.Table:
    k = np.flatnonzero(_implied(len(ids), src, tgt))
    return pa.table({"src": ids.take(pa.array(src[k])), "tgt": ids.take(pa.array(tgt[k]))})


def implied_edges(edges: DataFrame) -> DataFrame:
    """(src, tgt) of the edges of a DAG that a longer path makes redundant."""
    small, large, many = _split(edges)
    found = _in_bins(small, _implied_in_memory, "src string, tgt string")
    return found.unionByName(_implied_by_rounds(large)) if many else found


def prune_related(related: DataFrame, labels: DataFrame) -> DataFrame:
    """``related`` edges whose ends aren't in one component of ``labels``."""
    related = cut(related)
    n = related.count()
    a = skew_join(related, labels.select(F.col("node").alias("src"), F.col("component").alias("ca")), "src", n)
    b = skew_join(cut(a), labels.select(F.col("node").alias("tgt"), F.col("component").alias("cb")), "tgt", n)
    return b.where("ca is null or cb is null or ca <> cb").select(related.columns)


def reduce_graph(edges: DataFrame, older: DataFrame | None = None, transitive: bool = True, prune: bool = True) -> DataFrame:
    """The reduced graph: (src, tgt, type, text, uncertain, ord, store).

    Turn inherited edges, drop loops, merge parallel edges, set edges on cycles and parallel or opposed ones aside (store
    ``aside``; they are kept), remove what paths imply, and drop ``related`` edges inside a component of the origin or of
    the sibling edges. ``transitive=False`` skips the last three steps, ``prune=False`` the last.
    """
    e = swap_historical(edges, older) if older is not None else edges
    e = cut(absorb_related(e))
    origin, sibling, related = e.where(F.col("type").isin(*O.DIRECTED)), e.where(F.col("type").isin(*O.SIBLING)), e.where("type = 'related'")
    tag = lambda df, s: df.withColumn("store", F.lit(s))
    if not transitive:
        return tag(origin, "origin").unionByName(tag(sibling, "sibling")).unionByName(tag(related, "related"))
    pair = Window.partitionBy(F.least("src", "tgt"), F.greatest("src", "tgt")).orderBy("ord", "type", "src")
    ranked = cut(origin.withColumn("nth", F.row_number().over(pair)))
    main, aside = ranked.where("nth = 1").drop("nth"), ranked.where("nth > 1").drop("nth")
    scc = strong_components(main)
    cyclic = cut(on_cycles(main, scc).drop("scc"))
    dag = cut(main.join(cyclic.select("src", "tgt"), ["src", "tgt"], "left_anti"))
    kept = dag.join(implied_edges(dag), ["src", "tgt"], "left_anti")
    if prune:
        related = prune_related(prune_related(related, weak_components(kept)), weak_components(sibling))
    aside = aside.unionByName(cyclic)
    return tag(kept, "origin").unionByName(tag(aside, "aside")).unionByName(tag(sibling, "sibling")).unionByName(tag(related, "related"))


def _pair_outcomes(edges: DataFrame, older: DataFrame | None) -> DataFrame:
    """Per pair of nodes (a, b), a the smaller or the same, what turning and merging make of its edges, repeated rows once.

    rows: edges; swapped: edges turned onto none that was there; kept: rows of types that stay; forth, back, near, far:
    types that stay, of directed edges from a to b and from b to a, of sibling and of ``related`` ones; main: 1 or 2 for
    the directed edge forth or back that comes first, 0 for none. All is grouped where one shuffle by pair puts it.
    """
    names = sorted(O.PARENT)  # so that types compare as their numbers
    kind = [0 if t in O.DIRECTED else 1 if t in O.SIBLING else 2 for t in names]
    above = [sum(1 << names.index(u) for u in O.ancestors(t)[1:] if kind[names.index(u)] == kind[k]) for k, t in enumerate(names)]
    number = F.create_map(*(F.lit(x) for k, t in enumerate(names) for x in (t, k)))
    at = lambda values, as_: F.array(*(F.lit(v).cast(as_) for v in values))[F.col("t")]
    e = _with_turn(edges, older) if older is not None else edges.withColumn("turn", F.lit(False))
    pair = ["a", "b"]
    e = e.select(F.least("src", "tgt").alias("a"), F.greatest("src", "tgt").alias("b"), (F.col("src") <= F.col("tgt")).alias("forth"), F.coalesce("turn", F.lit(False)).alias("turn"), number[F.col("type")].alias("t"), "text", "uncertain", "ord")
    e = e.repartition(*pair).distinct()
    e = e.groupBy(*pair, "t", "ord").agg(F.count_if("forth").alias("f"), F.count_if(~F.col("forth")).alias("g"), F.bool_or(F.col("forth") & F.col("turn")).alias("tf"), F.bool_or(~F.col("forth") & F.col("turn")).alias("tg"))
    e = e.select(*pair, "t", "ord", F.expr("if(tf, 0, f) + if(tg, g, 0)").alias("kf"), F.expr("if(tg, 0, g) + if(tf, f, 0)").alias("kg"), F.expr("if(a <> b, if(tf and g = 0, f, 0) + if(tg and f = 0, g, 0), 0)").alias("swapped"))
    e = e.groupBy(*pair, "t").agg(F.sum("kf").alias("kf"), F.sum("kg").alias("kg"), F.min(F.expr("if(kf > 0, ord, null)")).alias("of"), F.min(F.expr("if(kg > 0, ord, null)")).alias("og"), F.sum("swapped").alias("swapped"))
    e = e.withColumn("kind", at(kind, "int"))
    both = F.expr("if(kind = 0, kf, kf + kg)").alias("kf"), F.expr("if(kind = 0, kg, 0)").alias("kg")
    e = e.groupBy(*pair).agg(F.collect_list(F.struct("t", at(above, "bigint").alias("up"), "kind", *both, "of", "og")).alias("l"), F.sum(F.col("kf") + F.col("kg")).alias("rows"), F.sum("swapped").alias("swapped"))
    stay = "if(size(l) = 1, filter(l, x -> x.{0} > 0), filter(l, x -> x.{0} > 0 and not exists(l, y -> y.{0} > 0 and shiftright(y.up, x.t) & 1 = 1)))"
    e = e.withColumns({"sf": F.expr(stay.format("kf")), "sg": F.expr(stay.format("kg"))})
    first = "array_min(transform(filter(s{0}, x -> x.kind = 0), x -> struct(coalesce(array_min(transform(filter(l, y -> y.k{0} > 0 and (y.t = x.t or shiftright(x.up, y.t) & 1 = 1)), y -> y.o{0})), 9223372036854775807L), x.t)))"
    n = "size(filter(sf, x -> x.kind = {0}))"
    e = e.select(
        *pair, "rows", "swapped", F.expr("aggregate(sf, 0L, (s, x) -> s + x.kf) + aggregate(sg, 0L, (s, x) -> s + x.kg)").alias("kept"),
        F.expr(n.format(0)).alias("forth"), F.expr("size(sg)").alias("back"), F.expr(n.format(1)).alias("near"), F.expr(n.format(2)).alias("far"), "l", "sf", "sg",
    )
    main = f"case when a = b then 0 when back = 0 then if(forth > 0, 1, 0) when forth = 0 then 2 when {first.format('f')} <= {first.format('g')} then 1 else 2 end"
    return e.withColumn("main", F.expr(main)).drop("l", "sf", "sg")


def _connected(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest number of each node's weak component."""
    low = np.arange(n)
    while len(a):
        np.minimum.at(low, np.maximum(a, b), np.minimum(a, b))
        while not np.array_equal(low, down := low[low]):
            low = down
        a, b = low[a], low[b]
        a, b = a[a != b], b[a != b]
    return low


def _cyclic(n: int, src: np.ndarray, tgt: np.ndarray) -> np.ndarray:
    """Which edges lie on a cycle. Edges from nodes without predecessor and into ones without successor go first."""
    left = np.arange(len(src))
    for _ in range(64):
        a, b = src[left], tgt[left]
        stay = (np.bincount(b, minlength=n)[a] > 0) & (np.bincount(a, minlength=n)[b] > 0)
        if stay.all():
            break
        left = left[stay]
    on = np.zeros(len(src), bool)
    nodes, at = np.unique(np.concatenate([src[left], tgt[left]]), return_inverse=True)
    a, b = at[: len(left)], at[len(left) :]
    comp = _tarjan(len(nodes), a, b)
    on[left] = comp[a] == comp[b]
    return on


def _graph_outcomes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many main edges of all pairs (a, b, main, near, rest) lie on cycles, how many of the others paths imply, and how
    many of the ``rest`` lie within a component of those or of the ``near`` pairs."""
    held = [b for b in batches if b.num_rows]
    columns = [pa.chunked_array([b.column(k) for b in held], held[0].schema.field(k).type) if held else None for k in range(5)]
    if not held:
        return
    main, near, rest = (c.to_numpy() for c in columns[2:])
    ends = pa.chunked_array([*columns[0].chunks, *columns[1].chunks])
    del held, columns
    code = np.concatenate([c.indices.to_numpy() for c in ends.dictionary_encode().chunks]).astype(np.int64)
    del ends
    a, b = code[: len(main)], code[len(main) :]
    n = int(code.max()) + 1
    on = main > 0
    src, tgt = np.where(main == 1, a, b)[on], np.where(main == 1, b, a)[on]
    cyclic = _cyclic(n, src, tgt)
    src, tgt = src[~cyclic], tgt[~cyclic]
    x, y = a[rest], b[rest]
    origin, sibling = _connected(n, src, tgt), _connected(n, a[near], b[near])
    within = (origin[x] == origin[y]) | (sibling[x] == sibling[y])
    counts = [int(cyclic.sum()), int(_implied(n, src, tgt).sum()), int(within.sum())]
    yield pa.RecordBatch.from_arrays([pa.array([c], pa.int64()) for c in counts], ["cyclic", "implied", "within"])


def reduction_events(edges: DataFrame, older: DataFrame | None = None) -> DataFrame:
    """(event, n): what each step of the reduction did, counted in edges, repeated rows once.

    language swap: turned round; self loop: dropped; merge equal: rows that met an edge of their type; merge more
    specific: rows whose type gave way to one below it; incompatible: further types that stay between the same nodes in
    one direction; absorbed: ``related`` edges merged into closer ones; shelved: edges set aside on cycles and beside
    others; transitive: implied by paths; within components: ``related`` edges inside one.

    What becomes of a pair's edges is decided pair by pair. Cycles and paths are a matter of the whole graph: up to
    LOCAL_PAIRS pairs are one task's work, more go through the operators. Implied edges connect nothing that paths don't
    connect, so components are those from before their removal.
    """
    p = cut(_pair_outcomes(edges, older))
    s = p.agg(*(F.coalesce(F.sum(F.expr(c)), F.lit(0)).alias(a) for a, c in {
        "swapped": "swapped", "loops": "if(a = b, rows, 0)", "rows": "if(a = b, 0, rows)", "kept": "if(a = b, 0, kept)", "types": "if(a = b, 0, forth + back + near + far)",
        "directed": "if(a = b, 0, forth + back)", "ways": "if(a = b, 0, least(forth, 1) + least(back, 1))", "main": "if(main > 0, 1, 0)", "absorbed": "if(a <> b and forth + back + near > 0, far, 0)", "pairs": "if(a = b, 0, 1)",
    }.items())).first()
    rest = (F.col("forth") + F.col("back") + F.col("near") == 0) & (F.col("far") > 0)
    p = p.where("a <> b").select("a", "b", "main", (F.col("near") > 0).alias("near"), rest.alias("rest"))
    if s.pairs <= LOCAL_PAIRS:
        cyclic, implied, within = p.coalesce(1).mapInArrow(_graph_outcomes, "cyclic bigint, implied bigint, within bigint").first() or (0, 0, 0)
    else:
        main = p.where("main > 0").select(F.expr("if(main = 1, a, b)").alias("src"), F.expr("if(main = 1, b, a)").alias("tgt"))
        around = cut(on_cycles(main, strong_components(main)).select("src", "tgt"))
        dag = cut(main.join(around, ["src", "tgt"], "left_anti"))
        cyclic, implied = around.count(), implied_edges(dag).count()
        named = lambda c: p.where(c).select(F.col("a").alias("src"), F.col("b").alias("tgt"))
        within = p.where("rest").count() - prune_related(prune_related(named("rest"), weak_components(dag)), weak_components(named("near"))).count()
    n = {
        "language swap": s.swapped, "self loop": s.loops, "merge equal": s.kept - s.types, "merge more specific": s.rows - s.kept, "incompatible": s.directed - s.ways,
        "shelved": s.directed - s.main + cyclic, "transitive": implied, "absorbed": s.absorbed, "within components": within,
    }
    return edges.sparkSession.createDataFrame(list(n.items()), "event string, n bigint")


def degrees(edges: DataFrame) -> DataFrame:
    """(node, n_in, n_out); parallel edges count each."""
    ends = edges.select(F.col("src").alias("node"), F.lit(0).alias("i"), F.lit(1).alias("o")).union(edges.select("tgt", F.lit(1), F.lit(0)))
    return ends.groupBy("node").agg(F.sum("i").alias("n_in"), F.sum("o").alias("n_out"))


def bfs(edges: DataFrame, sources: DataFrame, cutoff: int) -> DataFrame:
    """(source, node, dist) for nodes within ``cutoff`` links along the edges, the source itself at 0."""
    e = cut(edges.select(F.col("src").alias("node"), "tgt").distinct())
    front = cut(sources.select(F.col("node").alias("source"), "node", F.lit(0).alias("dist")).distinct())
    seen = cut(front)
    for d in range(1, cutoff + 1):
        step = salted_join(front, e, "node", front.count()).select("source", F.col("tgt").alias("node"), F.lit(d).alias("dist")).distinct()
        front = cut(step.join(seen, ["source", "node"], "left_anti"))
        if not front.limit(1).count():
            break
        seen = grow(seen, front)
    return seen


def above(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node): ``nodes`` and all from which edges lead to them, the newly met only in each round."""
    e = cut(edges.select("src", F.col("tgt").alias("node")).distinct())
    front = cut(nodes.select("node").distinct())
    seen = cut(front)
    while n := front.count():
        step = salted_join(front, e, "node", n).select(F.col("src").alias("node")).distinct()
        front = cut(step.join(seen, "node", "left_anti"))
        seen = grow(seen, front)
    return seen


def paths(edges: DataFrame, sources: DataFrame, depth: int, direction: str = "out") -> DataFrame:
    """(start, node, length, links): every path of at most ``depth`` edges that uses no edge twice.

    Edges need an ``eid``. direction is out, in or both.
    """
    out = edges.select("eid", F.col("src").alias("node"), F.col("tgt").alias("to"))
    back = edges.select("eid", F.col("tgt").alias("node"), F.col("src").alias("to"))
    e = {"out": out, "in": back, "both": out.union(back.where("node <> to"))}[direction]
    front = sources.select(F.col("node").alias("start"), "node", F.lit(0).alias("length"), F.array().cast("array<string>").alias("links"))
    all_ = front
    for d in range(1, depth + 1):
        front = cut(front)
        front = salted_join(front, e, "node", front.count()).where(~F.array_contains("links", F.col("eid"))).select("start", F.col("to").alias("node"), F.lit(d).alias("length"), F.array_append("links", F.col("eid")).alias("links"))
        all_ = all_.union(front)
    return all_


def _in_one(run: Callable[[np.ndarray, np.ndarray, pa.Array], pa.Table]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run`` on all edges (src, tgt) of a task, as numbers of its nodes in the order of their ids, and these ids."""

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if held:
            both = pa.concat_arrays([b.column(k) for k in (0, 1) for b in held])
            ids = both.unique().sort()
            at = pa.compute.index_in(both, ids).to_numpy(zero_copy_only=False).astype(np.int64)
            yield from run(at[: len(at) // 2], at[len(at) // 2 :], ids).to_batches()

    return whole


def _ranked(tolerance: float, damping: float) -> Callable:
    def run(a: np.ndarray, b: np.ndarray, ids: pa.Array) -> pa.Table:
        n = len(ids)
        deg, rank = np.bincount(a, minlength=n), np.full(n, 1.0 / n)
        while True:
            new = (1 - damping) / n + damping * np.bincount(b, rank[a] / deg[a], n)
            moved, rank = np.abs(new - rank).sum(), new
            if moved < tolerance * n:
                return pa.table({"node": ids, "rank": rank})

    return run


def _merged_by_gain(resolution: float) -> Callable:
    def run(a: np.ndarray, b: np.ndarray, ids: pa.Array) -> pa.Table:
        n, m = len(ids), len(a) / 2
        w, deg, of = np.ones(len(a), np.int64), np.bincount(a, minlength=n), np.arange(n)
        while True:
            gain = w - resolution * (deg[a] * deg[b]) / (2 * m)
            up = gain > 0
            if not up.any():
                low = np.full(n, n)
                np.minimum.at(low, of, np.arange(n))
                return pa.table({"node": ids, "community": ids.take(pa.array(low[of]))})
            x, y, g = a[up], b[up], gain[up]
            order = np.lexsort((y, -g, x))
            first = order[np.r_[True, x[order][1:] != x[order][:-1]]]
            best = np.full(n, -1)
            best[x[first]] = y[first]
            who = np.flatnonzero(best >= 0)
            mutual = best[best[who]] == who
            head = np.zeros(n, bool)
            head[who[mutual & (who < best[who])]] = True
            to = np.arange(n)
            moves = who[(mutual & (who > best[who])) | (~mutual & head[best[who]])]
            to[moves] = best[moves]
            of, deg = to[of], np.bincount(to, deg, n).astype(np.int64)
            pair = to[a] * n + to[b]
            pair, back = np.unique(pair[to[a] != to[b]], return_inverse=True)
            w = np.bincount(back, w[to[a] != to[b]], len(pair)).astype(np.int64)
            a, b = pair // n, pair % n

    return run


def pagerank(edges: DataFrame, tolerance: float = 1e-6, damping: float = 0.85) -> DataFrame:
    """(node, rank) on the undirected simple graph; the ranks add up to 1.

    Rounds go on until all ranks together change by less than ``tolerance`` times the number of nodes. Up to LOCAL_EDGES
    links are one task's work.
    """
    both = cut(edges.select("src", "tgt").union(edges.select("tgt", "src")).where("src <> tgt").distinct())
    deg = both.groupBy("src").agg(F.count("*").alias("deg"))
    n = deg.count()
    if not n:
        return both.select(F.col("src").alias("node"), F.lit(0.0).alias("rank"))
    many = both.count()
    if many <= LOCAL_EDGES:
        return cut(both.repartition(1).mapInArrow(_in_one(_ranked(tolerance, damping)), "node string, rank double"))
    links = cut(skew_join(both, deg, "src", many, "inner"))
    ranks = cut(deg.select(F.col("src").alias("node"), F.lit(1.0 / n).alias("rank")))
    while True:
        got = skew_join(links, ranks.withColumnRenamed("node", "src"), "src", many, "inner").groupBy(F.col("tgt").alias("node")).agg(F.sum(F.col("rank") / F.col("deg")).alias("in"))
        new = got.join(ranks, "node").select("node", (F.lit((1 - damping) / n) + damping * F.col("in")).alias("new"), "rank")
        new = cut(new)
        moved = new.agg(F.sum(F.abs(F.col("new") - F.col("rank")))).first()[0]
        release(ranks)
        ranks = cut(new.select("node", F.col("new").alias("rank")))
        release(new)
        if moved < tolerance * n:
            return ranks


def communities(edges: DataFrame, resolution: float = 1.0) -> DataFrame:
    """(node, community) by greedy modularity: communities are merged as long as a merge gains.

    On the undirected simple graph, merging i and j gains links(i, j) - resolution * degree(i) * degree(j) / (2 * all
    links). In each round every community names the neighbour with the largest gain, the smallest name on a tie. Two that
    name each other merge, and others that named the smaller of them join. The best pair of all always names each other,
    so every round merges some, until no merge gains. A community is named after its smallest member.
    """
    both = cut(edges.select(F.least("src", "tgt").alias("a"), F.greatest("src", "tgt").alias("b")).where("a <> b").distinct())
    m = both.count()
    if m <= LOCAL_EDGES:
        ways = both.select("a", "b").union(both.select("b", "a"))
        return cut(ways.repartition(1).mapInArrow(_in_one(_merged_by_gain(resolution)), "node string, community string"))
    labels = cut(both.select(F.explode(F.array("a", "b")).alias("node")).distinct().withColumn("community", F.col("node")))
    links = cut(both.select("a", "b", F.lit(1).cast("bigint").alias("w")).union(both.select("b", "a", F.lit(1).cast("bigint"))))
    deg = cut(links.groupBy("a").agg(F.sum("w").alias("d")))
    while True:
        n = links.count()
        near = skew_join(links, deg.select("a", F.col("d").alias("da")), "a", n, "inner")
        near = skew_join(cut(near), deg.select(F.col("a").alias("b"), F.col("d").alias("db")), "b", n, "inner")
        gain = F.col("w") - F.lit(resolution) * (F.col("da") * F.col("db")) / (2 * m)
        best = cut(near.withColumn("gain", gain).where("gain > 0").groupBy("a").agg(F.min(F.struct((-F.col("gain")).alias("g"), "b"))["b"].alias("b")))
        if not best.limit(1).count():
            name = labels.groupBy("community").agg(F.min("node").alias("name"))
            return skew_join(labels, name, "community", labels.count(), "inner").select("node", F.col("name").alias("community"))
        # i follows its favourite j: where they name each other, the larger name follows; else only if j follows nobody
        back = best.select(F.col("a").alias("b"), F.col("b").alias("c"))
        step = skew_join(best, back, "b", best.count()).select("a", "b", (F.col("a") == F.col("c")).alias("mutual"))
        move = cut(step.where("mutual and a > b").select("a", F.col("b").alias("to")))
        heads = step.where("mutual and a < b").select(F.col("a").alias("b"))
        tails = step.where("not coalesce(mutual, false)").join(heads, "b", "left_semi").select("a", F.col("b").alias("to"))
        move = cut(move.unionByName(tails))
        to = lambda df, c: skew_join(df, move.select(F.col("a").alias(c), "to"), c, n).withColumn(c, F.coalesce("to", c)).drop("to")
        labels = cut(to(labels, "community"))
        links = cut(to(cut(to(links, "a")), "b").where("a <> b").groupBy("a", "b").agg(F.sum("w").alias("w")))
        deg = cut(to(deg, "a").groupBy("a").agg(F.sum("d").alias("d")))
