"""Questions about the graph: words and paths by what is asked of them, labels, details, and the part on display."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexweave.operators import graph as G
from lexweave.operators import ontology as O

#: Labels that follow from a node itself and can't be taken away.
PROTECTED = ("Word", "Entity", "NAE", "Multiword", "EtymologyEntry", "Reconstructed")


@dataclass
class NodeFilter:
    """What is asked of a node (columns node, term, language, labels): values to have, and not to have; all must hold."""

    terms: tuple[str, ...] = ()
    languages: tuple[str, ...] = ()
    labels: tuple[str, ...] = ()
    not_languages: tuple[str, ...] = ()
    not_labels: tuple[str, ...] = ()
    pattern: str | None = None

    def empty(self) -> bool:
        return not (self.terms or self.languages or self.labels or self.pattern)

    def condition(self) -> Column:
        c = F.lit(True)
        for column, values in (("term", self.terms), ("language", self.languages)):
            c = c & F.col(column).isin(*values) if values else c
        c = c & ~F.coalesce(F.col("language").isin(*self.not_languages), F.lit(False)) if self.not_languages else c
        c = c & F.arrays_overlap("labels", F.array(*map(F.lit, self.labels))) if self.labels else c
        c = c & ~F.arrays_overlap("labels", F.array(*map(F.lit, self.not_labels))) if self.not_labels else c
        return c & F.col("term").rlike(self.pattern) if self.pattern else c


@dataclass
class PathQuery:
    """Paths from ``source`` to ``target`` of 1 to ``depth`` links of ``types`` (with those below), all nodes of which pass
    ``every``; direction out, in or both; at most ``limit`` paths, the shortest first. Depth 0 asks for nodes alone."""

    source: NodeFilter = field(default_factory=NodeFilter)
    target: NodeFilter = field(default_factory=NodeFilter)
    every: NodeFilter = field(default_factory=lambda: NodeFilter(not_labels=("Multiword",)))
    types: tuple[str, ...] = ("origin",)
    depth: int = 1
    direction: str = "both"
    limit: int | None = 10

    def check(self) -> None:
        """An error for a question about everything, or with an unknown type or direction."""
        if self.source.empty() and self.target.empty():
            raise ValueError("too broad: say something of the source or the target")
        if unknown := [t for t in self.types if t not in O.PARENT]:
            raise ValueError(f"no such type: {', '.join(unknown)}")
        if self.direction not in ("out", "in", "both") or self.depth < 0:
            raise ValueError("direction is out, in or both, and depth 0 or more")


def find_paths(edges: DataFrame, nodes: DataFrame, q: PathQuery) -> DataFrame:
    """(start, node, length, links) of the paths that ``q`` asks for. Edges need ord; a node filter on the whole path is put
    to the nodes before the walk, so what it excludes is never walked through."""
    q.check()
    ok = nodes.where(q.every.condition())
    starts = ok.where(q.source.condition()).select("node")
    ends = ok.where(q.target.condition()).select("node")
    if not q.depth:
        n = starts.join(ends, "node", "left_semi").select(F.col("node").alias("start"), "node", F.lit(0).alias("length"), F.array().cast("array<string>").alias("links"))
        return n.orderBy("start").limit(q.limit) if q.limit is not None else n
    keep = ok.select("node")
    e = edges.where(F.col("type").isin(*O.below(*q.types)))
    e = e.join(keep.withColumnRenamed("node", "src"), "src", "left_semi").join(keep.withColumnRenamed("node", "tgt"), "tgt", "left_semi")
    e = e.withColumn("eid", F.concat_ws("|", F.col("ord").cast("string"), "type"))
    found = G.paths(e, starts, q.depth, q.direction).where("length > 0").join(ends, "node", "left_semi").select("start", "node", "length", "links")
    return found.orderBy("length", "start", "node", F.array_join("links", ",")).limit(q.limit) if q.limit is not None else found


def subgraph(paths: DataFrame, edges: DataFrame) -> DataFrame:
    """The edges on the paths."""
    eid = F.concat_ws("|", F.col("ord").cast("string"), "type")
    return edges.withColumn("_e", eid).join(paths.select(F.explode("links").alias("_e")).distinct(), "_e", "left_semi").drop("_e")


def details(nodes: DataFrame, attributes: DataFrame) -> DataFrame:
    """(node, ..., values): every node with its attributes (node, kind, value) as sorted "kind: value"; none is an empty list."""
    per = attributes.groupBy("node").agg(F.sort_array(F.collect_set(F.concat("kind", F.lit(": "), "value"))).alias("values"))
    return nodes.join(per, "node", "left").withColumn("values", F.coalesce("values", F.array().cast("array<string>")))


def add_label(nodes: DataFrame, label: str, where: Column) -> DataFrame:
    """``label`` on the nodes for which ``where`` holds; a protected one can't be given."""
    if label in PROTECTED:
        raise ValueError(f"{label} follows from the node itself")
    return nodes.withColumn("labels", F.when(where, F.array_union("labels", F.array(F.lit(label)))).otherwise(F.col("labels")))


def drop_label(nodes: DataFrame, label: str, where: Column | None = None) -> DataFrame:
    if label in PROTECTED:
        raise ValueError(f"{label} follows from the node itself")
    gone = F.array_remove("labels", label)
    return nodes.withColumn("labels", gone if where is None else F.when(where, gone).otherwise(F.col("labels")))


def all_labels(nodes: DataFrame) -> DataFrame:
    return nodes.select(F.explode("labels").alias("label")).distinct()


# what is on display: elements are (id, src, tgt, data), src and tgt null for a node


def node_elements(nodes: DataFrame) -> DataFrame:
    """Nodes as elements, classed by what they are."""
    kind = F.when(F.array_contains("labels", "Entity"), "entity").when(F.array_contains("labels", "NAE"), "no-entry").otherwise("word")
    none = F.lit(None).cast("string")
    return nodes.select(F.col("node").alias("id"), none.alias("src"), none.alias("tgt"), F.to_json(F.struct("term", "language", kind.alias("class"))).alias("data"))


def edge_elements(edges: DataFrame) -> DataFrame:
    directed = F.when(F.col("type").isin(*O.DIRECTED), "directed").otherwise("undirected")
    return edges.select(F.concat_ws("|", "src", "tgt", "type").alias("id"), "src", "tgt", F.to_json(F.struct("type", "text", directed.alias("class"))).alias("data"))


def put(shown: DataFrame, new: DataFrame) -> DataFrame:
    """Elements added; one of an id that is there takes its place."""
    return shown.join(new.select("id").distinct(), "id", "left_anti").unionByName(new.dropDuplicates(["id"]))


def take(shown: DataFrame, nodes: DataFrame) -> DataFrame:
    """Elements without the ``nodes`` and the edges at them."""
    gone = nodes.select("node").distinct()
    for c in ("id", "src", "tgt"):
        shown = shown.join(gone.withColumnRenamed("node", c), c, "left_anti")
    return shown.select("id", "src", "tgt", "data")


def expand(shown: DataFrame, edges: DataFrame, nodes: DataFrame, clicked: DataFrame) -> DataFrame:
    """Elements with the neighbours of the ``clicked`` nodes and the edges to them."""
    c = clicked.select("node").distinct()
    near = edges.join(c.withColumnRenamed("node", "src"), "src", "left_semi").unionByName(edges.join(c.withColumnRenamed("node", "tgt"), "tgt", "left_semi")).distinct()
    at = near.select(F.explode(F.array("src", "tgt")).alias("node")).distinct()
    return put(put(shown, node_elements(nodes.join(at, "node", "left_semi"))), edge_elements(near))


def log_query(path: str, q: PathQuery, n: int, spark) -> None:
    """One more row (at, query, n) in the history kept at ``path``."""
    spark.createDataFrame([(dt.datetime.now(), repr(q), n)], "at timestamp, query string, n bigint").coalesce(1).write.mode("append").parquet(path)


def history(spark, path: str) -> DataFrame:
    return spark.read.parquet(path).orderBy(F.desc("at"))
