"""Page dumps in, graphs and statistics out: XML pages, CSV tables, JSON lines, N-Triples, parquet.

A graph is written from its edges (src, tgt, type, text, uncertain) and nodes (node, kind, term, language, sense_idx and,
where known, etymid, name, pos array, glosses array, pronunciations array). Writers are found by name in WRITERS; others
are added with ``writer``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PAGE = "title string, ns int, id bigint, revision array<struct<id:bigint,parentid:bigint,timestamp:string,contributor:struct<id:bigint,username:string,ip:string>,minor:string,text:string>>"
#: Revisions of a page that stand in one row; a page of more is several rows, all but the first ``partial``.
REVISIONS = 10_000


def read_pages(spark: SparkSession, path: str, head: int | None = None) -> DataFrame:
    """Pages of an XML dump, a row each; ``minor`` is true where the element is there, an empty text is "". With ``head``
    only so many pages."""
    raw = spark.read.format("xml").option("rowTag", "page").schema(PAGE).load(path)
    raw = raw.limit(head) if head is not None else raw
    revision = F.transform("revision", lambda r: r.withField("minor", r["minor"].isNotNull()).withField("text", F.coalesce(r["text"], F.lit(""))).withField("timestamp", F.try_to_timestamp(r["timestamp"]).cast("timestamp_ntz")))
    return raw.withColumn("revision", revision)


def split_pages(pages: DataFrame, most: int = REVISIONS) -> DataFrame:
    """Pages with more than ``most`` revisions as several rows, with ``partial`` on all but the first."""
    n = F.greatest(F.ceil(F.size(F.coalesce("revision", F.array())) / most).cast("int"), F.lit(1))
    cut = pages.withColumn("_k", F.explode(F.sequence(F.lit(0), n - 1)))
    part = F.when(F.col("revision").isNotNull(), F.slice("revision", F.col("_k") * most + 1, F.lit(most)))
    return cut.withColumn("revision", part).withColumn("partial", F.col("_k") > 0).drop("_k")


# statistics

STATISTICS = {
    "pages": "id bigint, title string, namespace int",
    "revisions": "page_id bigint, id bigint, timestamp timestamp_ntz, contributor string, minor boolean",
    "contributors": "id bigint, username string, ip string",
    "entries": "revision_id bigint, language string, size int, n_sections int, has_etymology boolean, templates string",
}


def pack_counts(c: Column) -> Column:
    """A map of counts as name=count parted by bars, in the order of names."""
    return F.array_join(F.transform(F.array_sort(F.map_entries(c)), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), "|")


def unpack_counts(c: Column) -> Column:
    """The map again; parts that aren't name=count are left out, of a repeated name the largest count is kept."""
    parts = F.filter(F.split(F.coalesce(c, F.lit("")), r"\|"), lambda p: p.rlike(r"^[^=]+=\d+$"))
    pairs = F.array_sort(F.transform(parts, lambda p: F.struct(F.substring_index(p, "=", 1).alias("k"), F.substring_index(p, "=", -1).cast("int").alias("v"))))
    last = F.filter(pairs, lambda p, i: F.coalesce(F.try_element_at(pairs, i + 2)["k"], F.lit("")) != p["k"])
    return F.map_from_entries(last)


def write_statistics(tables: dict[str, DataFrame], path: str) -> None:
    """CSV of the tables of STATISTICS, all values quoted, contributors once each."""
    for name, df in tables.items():
        df = df.select(*(c.split(" ")[0] for c in STATISTICS[name].split(", ")))
        (df.distinct() if name == "contributors" else df).write.option("header", True).option("quoteAll", True).option("emptyValue", "").csv(f"{path}/{name}")


def read_statistics(spark: SparkSession, path: str, name: str, columns: list[str] | None = None) -> DataFrame:
    df = spark.read.schema(STATISTICS[name]).option("header", True).option("multiLine", False).csv(f"{path}/{name}")
    return df.select(*columns) if columns else df


# graphs

WRITERS: dict[str, Callable[[DataFrame, DataFrame, str], None]] = {}


def writer(name: str):
    def add(f):
        WRITERS[name] = f
        return f

    return add


def write_graph(form: str, edges: DataFrame, nodes: DataFrame, path: str) -> None:
    """``form`` is a name in WRITERS; an error names those there are."""
    if form not in WRITERS:
        raise ValueError(f"no writer {form}: there are {', '.join(sorted(WRITERS))}")
    WRITERS[form](edges, nodes, path)


def head(edges: DataFrame, nodes: DataFrame, n: int) -> tuple[DataFrame, DataFrame]:
    """The first ``n`` edges, by their order and ends, and the nodes at these."""
    first = edges.orderBy("ord", "src", "tgt", "type").limit(n)
    at = first.select(F.explode(F.array("src", "tgt")).alias("node")).distinct()
    return first, nodes.join(at, "node", "left_semi")


def expand_stubs(nodes: DataFrame, lexemes: DataFrame) -> DataFrame:
    """Nodes of kind ``stub`` with the attributes of their word's only lexeme, by term and language, in one join; others,
    and stubs without one, stay as they are. ``lexemes`` has term, language and the attributes, which replace null ones."""
    extra = [c for c in lexemes.columns if c not in ("term", "language")]
    one = lexemes.groupBy("term", "language").agg(*(F.any_value(c, True).alias("_" + c) for c in extra))
    found = nodes.join(one, ["term", "language"], "left")
    have = [F.coalesce(c, F.when(F.col("kind") == "stub", F.col("_" + c))).alias(c) if c in extra else F.col(c) for c in nodes.columns]
    return found.select(*have, *(F.when(F.col("kind") == "stub", F.col("_" + c)).alias(c) for c in extra if c not in nodes.columns))


def _csv(df: DataFrame, path: str) -> None:
    """All values quoted, quotation marks doubled, newlines as breaks, so that a row is a line."""
    one = df.select(*(F.regexp_replace(F.col(f"`{c}`"), r"\n+", "<br/>").alias(c) if t == "string" else F.col(f"`{c}`") for c, t in df.dtypes))
    one.write.option("header", True).option("quoteAll", True).option("emptyValue", "").option("escape", '"').csv(path)


def _no_phantoms(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    if not nodes.where("kind = 'phantom'").isEmpty():
        raise ValueError("a phantom has no row to be written")
    return edges


@writer("simple")
def write_csv(edges: DataFrame, nodes: DataFrame, path: str) -> None:
    """Three tables: lexemes, entities and the typed links between their ids; an error if there are phantoms."""
    _csv(_no_phantoms(edges, nodes).select("type", "src", "tgt"), f"{path}/etymology")
    _csv(nodes.where("kind <> 'entity'").select(F.col("node").alias("id"), "term", "language", "sense_idx"), f"{path}/etymology_entry")
    _csv(nodes.where("kind = 'entity'").select(F.col("node").alias("id"), F.col("term").alias("name")), f"{path}/entity")


def property_tables(edges: DataFrame, nodes: DataFrame) -> dict[str, DataFrame]:
    """The tables of a property graph's bulk import: nodes with labels, a dictionary of parts of speech, glosses and
    pronunciations as nodes of their own with the links to them, arrays parted by @."""
    have = set(nodes.columns)
    empty = F.array().cast("array<string>")
    col = lambda c: F.col(c) if c in have else empty
    n = nodes.select("node", "kind", "term", "language", "sense_idx", col("pos").alias("pos"), col("glosses").alias("glosses"), col("pronunciations").alias("pronunciations"))
    labels = F.array_compact(F.array(F.lit("Word"), F.when(F.col("kind") == "no_entry", "NAE").otherwise("EtymologyEntry"), F.when(F.contains("term", F.lit(" ")), "Multiword"), F.when(F.startswith("term", F.lit("*")), "Reconstructed")))
    words = n.where("kind <> 'entity' and kind <> 'phantom'")
    ident = lambda kind, c: F.concat(F.lit(kind + ":"), F.xxhash64(c).cast("string"))
    out = {
        "words": words.select(F.col("node").alias("id:ID"), "term", "language", F.col("sense_idx").alias("sense_idx:int"), F.array_join(labels, "@").alias(":LABEL")),
        "entities": n.where("kind = 'entity'").select(F.col("node").alias("id:ID"), F.col("term").alias("name"), F.lit("Entity").alias(":LABEL")),
        "phantoms": n.where("kind = 'phantom'").select(F.col("node").alias("id:ID"), F.lit("Phantom").alias(":LABEL")),
        "etymology": edges.select(F.col("src").alias(":START_ID"), F.col("tgt").alias(":END_ID"), F.upper(F.regexp_replace("type", "[ -]", "_")).alias(":TYPE"), "text", F.col("uncertain").alias("uncertain:boolean")),
    }
    for attr, kind, rel in (("pos", "POS", "HAS_POS"), ("glosses", "Gloss", "HAS_GLOSS"), ("pronunciations", "Pronunc", "HAS_PRONUNC")):
        one = words.select("node", F.explode(attr).alias("v")).where("v <> ''").distinct()
        out[attr] = one.select("v").distinct().select(ident(kind, "v").alias("id:ID"), F.col("v").alias("text"), F.lit(f"Attr@{kind}").alias(":LABEL"))
        out[rel.lower()] = one.select(F.col("node").alias(":START_ID"), ident(kind, "v").alias(":END_ID"), F.lit(rel).alias(":TYPE"))
    return out


@writer("property")
def write_property_graph(edges: DataFrame, nodes: DataFrame, path: str) -> None:
    for name, df in property_tables(edges, nodes).items():
        _csv(df, f"{path}/{name}")


@writer("json")
def write_json_lines(edges: DataFrame, nodes: DataFrame, path: str) -> None:
    """Null fields are left out, newlines become breaks."""
    one = lambda df: df.select(*(F.regexp_replace(c, r"\n+", "<br/>").alias(c) if t == "string" else F.col(c) for c, t in df.dtypes))
    one(edges).write.option("ignoreNullFields", True).json(f"{path}/relations")
    one(nodes).write.option("ignoreNullFields", True).json(f"{path}/nodes")


@writer("graph")
def save_graph(edges: DataFrame, nodes: DataFrame, path: str) -> None:
    """Kept to be read again with ``load_graph``."""
    edges.write.parquet(f"{path}/edges")
    nodes.write.parquet(f"{path}/nodes")


def load_graph(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    return spark.read.parquet(f"{path}/edges"), spark.read.parquet(f"{path}/nodes")


def iri(c: Column, base: str) -> Column:
    """White space becomes underscores, the rest is percent-encoded."""
    return F.concat(F.lit(f"<{base}"), F.replace(F.url_encode(F.regexp_replace(c, r"\s+", "_")), F.lit("+"), F.lit("%20")), F.lit(">"))


def _literal(c: Column) -> Column:
    return F.concat(F.lit('"'), F.replace(F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"')), F.lit("\n"), F.lit("\\n")), F.lit('"'))


def triples(edges: DataFrame, base: str = "urn:lexweave:") -> DataFrame:
    """(value): N-Triples lines, one per statement about an edge."""
    link = F.concat(F.lit(f"<{base}link/"), F.sha1(F.concat_ws("|", "src", "tgt", "type")), F.lit(">"))
    facts = F.array(*(F.concat_ws(" ", link, F.lit(f"<{base}{p}>"), v, F.lit(".")) for p, v in (("source", iri(F.col("src"), base)), ("target", iri(F.col("tgt"), base)), ("type", _literal(F.col("type"))))))
    return edges.select(F.explode(facts).alias("value"))


def lexicon_triples(nodes: DataFrame, base: str = "urn:lexweave:") -> DataFrame:
    """(value): N-Triples lines about lexemes: what they are, their language, form, senses, parts of speech and sounds."""
    have = set(nodes.columns)
    me = iri(F.col("node"), base)
    fact = lambda p, v: F.when(v.isNotNull(), F.concat_ws(" ", me, F.lit(f"<{base}{p}>"), v, F.lit(".")))
    one = [fact("isA", F.when(F.col("kind") == "entity", F.lit(f"<{base}Entity>")).otherwise(F.lit(f"<{base}Etymon>"))), fact("language", _literal(F.col("language"))), fact("canonicalForm/writtenRep", _literal(F.col("term")))]

    def each(c: str, p: str) -> Column:
        return F.transform(F.coalesce(c, F.array().cast("array<string>")), lambda v: F.concat_ws(" ", me, F.lit(f"<{base}{p}>"), _literal(v), F.lit(".")))

    many = [each(c, p) for c, p in (("glosses", "sense/definition"), ("pos", "partOfSpeech"), ("pronunciations", "phoneticRep")) if c in have]
    return nodes.where("kind <> 'phantom'").select(F.explode(F.array_compact(F.concat(F.array(*one), *many))).alias("value"))


@writer("triples")
def write_triples(edges: DataFrame, nodes: DataFrame, path: str) -> None:
    triples(edges).unionByName(lexicon_triples(nodes)).write.text(path)


@writer("selection")
def write_selection(edges: DataFrame, nodes: DataFrame, path: str) -> None:
    """Sheets of a selection: lexemes in order of language, term and sense, relationships, glosses, sounds, entities."""
    have = set(nodes.columns)
    words = nodes.where("kind not in ('entity', 'phantom')")
    order = ["language", "term", "sense_idx"]
    _csv(words.select("node", *order).orderBy(*order).coalesce(1), f"{path}/lexemes")
    _csv(edges.select("src", "tgt", "type", "text", "uncertain").orderBy("src", "tgt", "type").coalesce(1), f"{path}/relationships")
    for c in ("glosses", "pronunciations"):
        if c in have:
            _csv(words.select("node", *order, F.explode(c).alias("text")).orderBy(*order, "text").drop(*order).coalesce(1), f"{path}/{c}")
    _csv(nodes.where("kind = 'entity'").select("node", "term").orderBy("term", "node").coalesce(1), f"{path}/entities")


def write_gold_standard(pairs: DataFrame, chosen: DataFrame, path: str, sample: int = 200) -> None:
    """Four tables: pairs of glosses with their answer, the same by sense, what was chosen where, and a sample drawn by a
    hash to be judged by people. ``pairs``: term, language, mention, a, node_id, b, match; ``chosen``: mention, node_id, how."""
    _csv(pairs.select("match", "a", "b", "term", "language", "node_id"), f"{path}/gold_standard_sense")
    _csv(pairs.groupBy("term", "language", "mention", "node_id").agg(F.max("match").alias("match")), f"{path}/gold_standard_etym")
    _csv(chosen.select("mention", "node_id", "how"), f"{path}/disambiguation")
    drawn = pairs.orderBy(F.xxhash64("mention", "node_id", "b"), "mention", "node_id").limit(sample)
    _csv(drawn.select("term", "language", "a", "b", F.lit("").alias("answer")), f"{path}/annotate")


def cached(spark: SparkSession, path: str, make: Callable[[], DataFrame], refresh: bool = False) -> DataFrame:
    """The table kept at ``path``, made and written where there is none yet or a new one is asked for."""
    at = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/_SUCCESS")
    if refresh or not at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at):
        make().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
