"""Small analyses of graphs, glosses, entries and pages, scalar functions, samples and statistics tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexweave.operators import glosses as G
from lexweave.operators import graph as GR
from lexweave.operators import ontology as O
from lexweave.operators import pages as P
from lexweave.operators import relational as R2
from lexweave.operators import resolve as R
from lexweave.operators import store as S
from lexweave.plans.graph_queries import _DIR, _E, edges
from lexweave.plans.relational_queries import _E as _EN
from lexweave.plans.relational_queries import _P as _PAGES
from lexweave.plans.relational_queries import _R as _REVS
from lexweave.plans.relational_queries import _S as _SECTIONS
from lexweave.plans.relational_queries import entries, homonym_pairs, pages, revs, section_rows
from lexweave.plans.runtime import cut, table
from lexweave.plans.text_queries import _codes, langs, texts
from lexweave.sources import graph_files as W

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


# degrees before and after, in the directed graph

_DEG = "{0} AS (SELECT node, count(*) AS k FROM (SELECT src AS node FROM e{1} UNION ALL SELECT tgt FROM e{1}) GROUP BY 1)"


def _degree(e: DataFrame) -> DataFrame:
    return GR.degrees(e).select("node", (F.col("n_in") + F.col("n_out")).alias("k"))


@query(f"WITH {_E}, {_DEG.format('a', '')}, {_DEG.format('b', f' WHERE type IN {_DIR}')} SELECT a.k AS old, b.k AS new, count(*) AS n FROM a JOIN b USING (node) WHERE a.k <> b.k GROUP BY 1, 2 ORDER BY n DESC, old, new LIMIT 20")
def a20_degree_transitions(spark, d):
    """The twenty commonest changes of a node's degree from all edges to the directed ones."""
    e = edges(spark, d)
    new = _degree(e.where(F.col("type").isin(*O.DIRECTED))).withColumnRenamed("k", "new")
    t = _degree(e).withColumnRenamed("k", "old").join(new, "node").where("old <> new")
    return t.groupBy("old", "new").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "old", "new").limit(20)


@query(f"WITH {_E}, {_DEG.format('a', '')}, {_DEG.format('b', f' WHERE type IN {_DIR}')} SELECT node, a.k - b.k AS lost FROM a JOIN b USING (node)")
def j14_degree_difference(spark, d):
    """What each node of both graphs loses."""
    e = edges(spark, d)
    new = _degree(e.where(F.col("type").isin(*O.DIRECTED))).withColumnRenamed("k", "new")
    return _degree(e).join(new, "node").select("node", (F.col("k") - F.col("new")).alias("lost"))


@query("SELECT DISTINCT language, kind FROM node")
def a22_distinct(spark, d):
    return table(spark, d, "node").select("language", "kind").distinct()


_Q = "c AS (SELECT count(*) AS n, count(*) FILTER (s AND t) AS tp, count(*) FILTER (s AND NOT t) AS fp, count(*) FILTER (NOT s AND t) AS fn FROM x) SELECT n, round(CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END, 6) AS precision, round(CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END, 6) AS recall, round(CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0 END, 6) AS f1 FROM c"


@query(f"WITH {_EN}, x AS (SELECT n_sections > 3 AS s, has_etymology AS t FROM en WHERE n_sections IS NOT NULL AND has_etymology IS NOT NULL), {_Q}")
def a25_quality(spark, d):
    """How well the number of sections tells whether an entry has an etymology."""
    x = entries(spark, d).where("n_sections is not null and has_etymology is not null")
    return G.quality(x, F.col("n_sections") > 3, F.col("has_etymology"))


@query(f"WITH {_EN} SELECT entry_id, max(size) OVER (PARTITION BY revision_id) AS largest FROM en")
def a26_group_max(spark, d):
    """Every entry with the largest size of its revision."""
    e = entries(spark, d)
    top = e.groupBy(F.col("revision_id").alias("r")).agg(F.max("size").alias("largest"))
    return e.join(top, F.col("revision_id").eqNullSafe(F.col("r"))).select("entry_id", "largest")


@query(f"WITH {_EN} SELECT language, round(count(*) FILTER (has_etymology) / count(*), 6) AS with_etymology, round(count(*) / sum(count(*)) OVER (), 6) AS share FROM en WHERE language <> '' AND language NOT LIKE '?%' GROUP BY 1")
def a8_share_without_unknown(spark, d):
    """Each known language's share of the entries of known languages."""
    e = entries(spark, d).where("language <> '' and language not like '?%'")
    total = e.agg(F.count("*").alias("t"))
    per = e.groupBy("language").agg(F.round(F.count_if("has_etymology") / F.count("*"), 6).alias("with_etymology"), F.count("*").alias("n"))
    return per.join(F.broadcast(total)).select("language", "with_etymology", F.round(F.col("n") / F.col("t"), 6).alias("share"))


@query(r"WITH {0}, x AS (SELECT *, CASE WHEN has_etymology AND templates <> '' THEN 'both' WHEN has_etymology THEN 'etymology' WHEN templates <> '' THEN 'templates' WHEN n_sections > 0 THEN 'sections' ELSE 'empty' END AS class FROM en) SELECT revision_id, arg_min(class, CASE class WHEN 'both' THEN 0 WHEN 'etymology' THEN 1 WHEN 'templates' THEN 2 WHEN 'sections' THEN 3 ELSE 4 END) AS class FROM x GROUP BY 1".format(_EN))
def a9_priority_class(spark, d):
    """Each revision by the first of these classes that one of its entries has."""
    names = ["both", "etymology", "templates", "sections", "empty"]
    ety, tpl = F.coalesce("has_etymology", F.lit(False)), F.coalesce(F.col("templates") != "", F.lit(False))
    rank = F.when(ety & tpl, 0).when(ety, 1).when(tpl, 2).when(F.col("n_sections") > 0, 3).otherwise(4)
    r = entries(spark, d).groupBy("revision_id").agg(F.min(rank).alias("r"))
    return r.select("revision_id", F.element_at(F.array(*map(F.lit, names)), F.col("r") + 1).alias("class"))


# glosses

_WORDS = r"regexp_extract_all(lower({0}), '\w+')"


@query(f"WITH g AS (SELECT DISTINCT node_id, gloss FROM node WHERE gloss <> ''), w AS (SELECT node_id, unnest(list_distinct({_WORDS.format('gloss')})) AS word FROM g) SELECT word, count(DISTINCT node_id) AS n FROM w GROUP BY 1")
def x27_gloss_words(spark, d):
    """Word tokens of glosses with the number of lexemes that have them."""
    g = table(spark, d, "node").where("gloss <> ''").select("node_id", "gloss").distinct()
    return g.select("node_id", F.explode(F.array_distinct(G.words(F.col("gloss")))).alias("word")).groupBy("word").agg(F.count_distinct("node_id").alias("n"))


@query("WITH g AS (SELECT term, language, node_id, min(gloss) AS gloss FROM node WHERE gloss <> '' AND term IS NOT NULL AND language IS NOT NULL GROUP BY ALL), f AS (SELECT term, language, min(node_id) AS a FROM g GROUP BY ALL), p AS (SELECT f.a, g.node_id AS b, x.gloss AS x, g2.gloss AS y FROM f JOIN g USING (term, language) JOIN (SELECT node_id, term, language, gloss FROM g) x ON x.node_id = f.a AND x.term = f.term AND x.language = f.language JOIN (SELECT DISTINCT node_id, gloss FROM node WHERE gloss <> '') g2 ON g2.node_id = g.node_id WHERE g.node_id <> f.a), t AS (SELECT a, b, unnest(" + _WORDS.format("x") + ") AS wx, y FROM p), u AS (SELECT a, b, wx, unnest(" + _WORDS.format("y") + ") AS wy FROM t) SELECT a, b, wx, wy, count(*) AS n FROM u GROUP BY ALL")
def j8_token_pairs(spark, d):
    """Every word of one gloss with every word of the other (J8): pairs within a pair of glosses, never across."""
    p = homonym_pairs(spark, d).select("a", "b", F.explode(G.words(F.col("x"))).alias("wx"), G.words(F.col("y")).alias("ys"))
    return p.select("a", "b", "wx", F.explode("ys").alias("wy")).groupBy("a", "b", "wx", "wy").agg(F.count("*").alias("n"))


def mentions(spark: SparkSession, d: str) -> DataFrame:
    """(mention, term, language, id, pos, t): the words that the templates and links of texts mean, each way of it once."""
    r = P.collect_relations(texts(spark, d), F.col("id"), F.col("title"), F.col("text"), _codes(spark, d))
    ety = F.startswith("mechanism", F.lit("etymology"))
    w = lambda c: F.when(ety, F.col(f"src_{c}")).otherwise(F.col(f"tgt_{c}"))
    m = r.where(w("kind") == "lexeme").select(w("term").alias("term"), w("language").alias("language"), "id", "pos", "t").distinct()
    return m.select(F.xxhash64("term", "language", "id", "pos", "t").alias("mention"), "*")


def lexemes(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "node").select("node_id", "term", "language", "sense_idx", "etymid", F.lit(None).cast("string").alias("pos"), "gloss")


@query()
def n4_resolved_mentions(spark, d):
    """Mentions brought to the language and spelling of lookup."""
    m = mentions(spark, d).withColumn("anchor", F.lit(None).cast("string")).withColumn("near_term", F.lit(None).cast("string")).withColumn("near_language", F.lit(None).cast("string"))
    return R.with_defaults(m, langs(spark, d)).select("mention", "term", "language", "id", "pos", "t")


@query()
def n6_chosen_lexemes(spark, d):
    """The lexeme each mention means, and how that was told."""
    return R.choose_homonyms(cut(n4_resolved_mentions(spark, d)), lexemes(spark, d))


@query()
def s14_json_paths(spark, d):
    """Paths of keys in the revisions of pages."""
    return S.json_paths(table(spark, d, "json_page").select("id", "revision").distinct(), F.col("revision"))


@query()
def n7_entities(spark, d):
    """Contributors of one name whose facts agree, merged (N7): the address is a fact, the id another."""
    c = table(spark, d, "contributors").where("username is not null").distinct()
    none = F.lit(None).cast("string")
    m = c.select(F.coalesce("id", F.lit(0).cast("bigint")).alias("ord"), F.lower(F.substring_index("username", " ", 1)).alias("name"), F.col("id").cast("string").alias("born"), none.alias("died"), none.alias("nat"), F.col("username").alias("occ"), F.col("ip").alias("wplink"))
    return R.merge_entities(m)


def _gold(spark: SparkSession, d: str) -> DataFrame:
    """Pairs with features: what a template might say of each word's first lexeme, with the glosses of all its lexemes."""
    n = table(spark, d, "node").where("gloss <> '' and term is not null and language is not null").select("node_id", "term", "language", "gloss").distinct()
    n = n.withColumn("etymid", F.col("node_id").cast("string"))
    # a mention says the last two words of a definition
    said = F.array_join(F.slice(F.split("gloss", " "), -2, 2), " ")
    first = R2.first_per(n, ["term", "language"], ["node_id", "gloss"])
    m = first.where(F.size(F.split("gloss", " ")) > 1).select(F.col("node_id").alias("mention"), "term", "language", F.col("etymid").alias("id"), said.alias("t"))
    return cut(G.features(G.gold_pairs(m, n)))


@query()
def n10_matcher(spark, d):
    """Train on homonyms' glosses told apart by sense, choose for the held-out words, and measure."""
    fit, test = G.split_by(_gold(spark, d), ["term", "language"], 0.3)
    scored = G.sense_level(G.predict(G.train(fit), test))
    return G.quality(G.best_match(scored, ["term", "language", "mention"]), F.col("chosen") == 1, F.col("match") == 1)


@query()
def n11_models(spark, d):
    """The matcher's models beside each other on the same held-out words, and the logistic one on three features."""
    fit, test = (cut(x) for x in G.split_by(_gold(spark, d), ["term", "language"], 0.3))
    out = None
    for name, model, using in [(m, m, G.FEATURES) for m in G.MODELS] + [("logistic of three", "logistic", ["lev", "tversky", "fuzzy"])]:
        scored = G.sense_level(G.predict(G.train(fit, model, using), test))
        q = G.quality(G.best_match(scored, ["term", "language", "mention"]), F.col("chosen") == 1, F.col("match") == 1).select(F.lit(name).alias("model"), "*")
        out = q if out is None else out.unionByName(q)
    return out


@query(f"WITH {_SECTIONS}, o AS (SELECT *, list_filter(path, lambda h: regexp_full_match(h, '\\s*Etym\\D*\\d*\\s*'))[1] AS own FROM sc), k AS (SELECT *, coalesce(try_cast(nullif(regexp_extract(own, '(\\d+)\\s*$', 1), '') AS INT), CASE WHEN own IS NOT NULL THEN 1 END) - 1 AS number FROM o) SELECT page_id || '/' || rev_id AS rec_key, sec_pos, greatest(coalesce(last_value(number IGNORE NULLS) OVER (PARTITION BY page_id, rev_id, path[1] ORDER BY sec_pos ROWS UNBOUNDED PRECEDING), 0), 0)::INT AS sense_idx FROM k WHERE rev_id IS NOT NULL")
def n3_section_senses(spark, d):
    """The sense every section belongs to."""
    s = section_rows(spark, d).where("rev_id is not null")
    return R.resolve_sections(s.select(F.concat_ws("/", F.col("page_id").cast("string"), F.col("rev_id").cast("string")).alias("rec_key"), "sec_pos", "path"))


# sets, order, samples


@query(f"WITH {_E} SELECT src AS node, 'source' AS what FROM e UNION ALL SELECT tgt, 'target' FROM e")
def u1_concat(spark, d):
    e = edges(spark, d)
    return e.select(F.col("src").alias("node"), F.lit("source").alias("what")).unionByName(e.select(F.col("tgt").alias("node"), F.lit("target").alias("what")))


@query(f"WITH {_E} SELECT src AS node FROM e UNION SELECT tgt FROM e")
def u3_node_set(spark, d):
    e = edges(spark, d)
    return e.select(F.col("src").alias("node")).union(e.select("tgt")).distinct()


@query(f"WITH {_REVS} SELECT page_id, id, row_number() OVER (ORDER BY page_id NULLS FIRST, timestamp NULLS FIRST, id) AS place FROM r ORDER BY place LIMIT 1000")
def w1_sorted_head(spark, d):
    """The first thousand revisions in order of page and time."""
    from pyspark.sql import Window

    top = revs(spark, d).select("page_id", "id", "timestamp").orderBy("page_id", "timestamp", "id").limit(1000)
    return top.select("page_id", "id", F.row_number().over(Window.orderBy("page_id", "timestamp", "id")).cast("bigint").alias("place"))


@query(f"WITH {_PAGES} SELECT id, title, ns FROM p WHERE ns IN (0, 118) AND title = (SELECT min(title) FROM p WHERE ns IN (0, 118))")
def f7_lookup(spark, d):
    """The pages of one title in the name spaces of entries (F7, F8): the first title in order."""
    p = pages(spark, d).where(F.col("ns").isin(*S.DEFAULT_NS))
    return p.where(F.col("title") == p.agg(F.min("title")).first()[0]).select("id", "title", "ns")


@query()
def s28_sample(spark, d):
    """A hundred entries drawn by a hash."""
    return S.sample(table(spark, d, "entries").select("entry_id", "language").distinct(), 100, ["entry_id", "language"])


@query()
def s29_group_sample(spark, d):
    """All entries of five languages drawn by a hash."""
    return S.sample_groups(table(spark, d, "entries").where("language <> ''").select("entry_id", "language").distinct(), 5, ["language"])


@query("WITH x AS (SELECT doc_id, min(n_chars) AS n FROM documents WHERE doc_id IS NOT NULL GROUP BY 1), c AS (SELECT doc_id, n, coalesce(sum(n) OVER (ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM x) SELECT doc_id, floor(before / 100000)::BIGINT AS chunk FROM c")
def s3_chunks(spark, d):
    """Documents in order, in chunks of about 100 000 characters."""
    x = table(spark, d, "documents").where("doc_id is not null").groupBy("doc_id").agg(F.min("n_chars").alias("n"))
    return S.chunks(x, F.col("n"), 100_000, ["doc_id"], "doc_id").select("doc_id", "chunk")


# scalar functions


@query("WITH p AS (SELECT DISTINCT id, title, ns FROM json_page) SELECT id, title, CASE WHEN ns = 118 AND starts_with(title, 'Reconstruction:') AND contains(title, '/') THEN '*' || regexp_replace(title, '^[^/]*/', '') ELSE title END AS clean, length(title) AS n FROM p")
def x5_clean_titles(spark, d):
    p = table(spark, d, "json_page").select("id", "title", "ns").distinct()
    clean = F.when((F.col("ns") == 118) & F.startswith("title", F.lit("Reconstruction:")) & F.contains("title", F.lit("/")), F.concat(F.lit("*"), F.regexp_replace("title", "^[^/]*/", ""))).otherwise(F.col("title"))
    return p.select("id", "title", clean.alias("clean"), F.length("title").cast("bigint").alias("n"))


@query(r"WITH x AS (SELECT DISTINCT ord, text FROM relation WHERE text IS NOT NULL) SELECT ord, regexp_replace(regexp_replace(text, '\{\{[^{}]*\}\}', '', 'g'), '''''+', '', 'g') AS bare FROM x")
def x2_without_markup(spark, d):
    """Texts without innermost templates and quotation marks of emphasis."""
    x = table(spark, d, "relation").where("text is not null").select("ord", "text").distinct()
    return x.select("ord", F.regexp_replace(F.regexp_replace("text", r"\{\{[^{}]*\}\}", ""), "''+", "").alias("bare"))


@query("SELECT DISTINCT node_id, url_encode(regexp_replace(term, '\\s+', '_', 'g')) AS uri FROM node WHERE term IS NOT NULL")
def x9_uris(spark, d):
    """Terms as parts of addresses (X9); the star, which need not be encoded, is."""
    u = F.replace(F.replace(F.url_encode(F.regexp_replace("term", r"\s+", "_")), F.lit("+"), F.lit("%20")), F.lit("*"), F.lit("%2A"))
    return table(spark, d, "node").where("term is not null").select("node_id", F.replace(u, F.lit("%7E"), F.lit("~")).alias("uri")).distinct()


@query(f"WITH {_REVS}, c AS (SELECT page_id, count(*) AS n FROM r GROUP BY 1) SELECT page_id, CASE WHEN n >= 1000000 THEN round(n / 1000000, 1) || 'M' WHEN n >= 1000 THEN floor(n / 1000)::BIGINT || 'k' ELSE n::VARCHAR END AS shown, round(100 * log10(9 + n), 4) AS size, ('0x' || right(sha1(page_id::VARCHAR), 6)) AS colour FROM c WHERE page_id IS NOT NULL")
def x30_presentation(spark, d):
    """Numbers as people write them, sizes that grow with the logarithm, and colours by hash."""
    c = revs(spark, d).where("page_id is not null").groupBy("page_id").agg(F.count("*").alias("n"))
    n = F.col("n")
    shown = F.when(n >= 1_000_000, F.concat(F.round(n / 1_000_000, 1).cast("string"), F.lit("M"))).when(n >= 1000, F.concat(F.floor(n / 1000).cast("string"), F.lit("k"))).otherwise(n.cast("string"))
    colour = F.concat(F.lit("0x"), F.substring(F.sha1(F.col("page_id").cast("string")), -6, 6))
    return c.select("page_id", shown.alias("shown"), F.round(100 * F.log10(9 + n), 4).alias("size"), colour.alias("colour"))


@query("SELECT DISTINCT node_id, CASE WHEN term IS NULL AND gloss IS NULL THEN '{}' WHEN term IS NULL THEN json_object('gloss', gloss)::VARCHAR WHEN gloss IS NULL THEN json_object('term', term)::VARCHAR ELSE json_object('term', term, 'gloss', gloss)::VARCHAR END AS record FROM node")
def x34_records(spark, d):
    """Lexemes as JSON without nulls."""
    return table(spark, d, "node").select("node_id", F.to_json(F.struct("term", "gloss")).alias("record")).distinct()


@query(f"WITH {_EN}, x AS (SELECT entry_id, templates, list_filter(string_split(templates, '|'), lambda p: regexp_full_match(p, '[^=]+=[0-9]+')) AS l FROM en WHERE templates <> ''), u AS (SELECT entry_id, templates, unnest(l) AS p FROM x), m AS (SELECT entry_id, templates, split_part(p, '=', 1) AS k, max(try_cast(split_part(p, '=', 2) AS INT)) AS v FROM u GROUP BY ALL) SELECT entry_id, string_agg(k || '=' || v, '|' ORDER BY k) AS packed FROM m GROUP BY entry_id, templates")
def x29_template_counts(spark, d):
    """Packed counts parted by bars, read and packed again: malformed parts go, of repeated names the largest stays."""
    x = entries(spark, d).where("templates <> ''").select("entry_id", "templates").distinct()
    return x.select("entry_id", W.pack_counts(W.unpack_counts(F.col("templates"))).alias("packed")).where("packed <> ''")


@query(f"WITH {_REVS} SELECT id, strftime(timestamp, '%Y-%m-%dT%H:%M:%SZ') AS written, timestamp AS read FROM r WHERE timestamp IS NOT NULL")
def x36_dates(spark, d):
    """Times as text and read back, to the second."""
    r = revs(spark, d).where("timestamp is not null")
    written = F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    return r.select("id", written.alias("written"), F.col("timestamp").alias("read"))


@query("WITH x AS (SELECT DISTINCT code, normalization.replace_from AS f, normalization.replace_to AS t FROM language_data WHERE normalization IS NOT NULL), u AS (SELECT code, unnest(range(1, len(f) + 1)) AS i, f, t FROM x) SELECT DISTINCT code, i::INT AS place, f[i] AS old, t[i] AS new FROM u")
def x37_zipped_rules(spark, d):
    """Spelling rules as rows: two arrays side by side, the shorter filled with nulls."""
    x = table(spark, d, "language_data").where("normalization is not null").select("code", "normalization.*").distinct()
    z = x.select("code", F.posexplode(F.arrays_zip("replace_from", "replace_to")))
    return z.select("code", (F.col("pos") + 1).cast("int").alias("place"), F.col("col.replace_from").alias("old"), F.col("col.replace_to").alias("new")).where("old is not null").distinct()


# statistics from texts


@query()
def a30_section_statistics(spark, d):
    """Per revision and language: size, sections, whether there is an etymology, and the templates of etymologies."""
    from lexweave.functions import entries as N
    from lexweave.functions.wikitext import arguments, templates

    def rows(_, text):
        for lang, paths, bodies in N.language_entries(text):
            count: dict[str, int] = {}
            eta = [b for p, b in zip(paths, bodies) if p and p[-1].startswith("Etym")]
            for b in eta:
                for _, _, inside in templates(b):
                    name = arguments(inside)[0]
                    count[name] = count.get(name, 0) + 1
            yield lang, sum(map(len, bodies)), len(paths), bool(eta), "|".join(f"{k}={v}" for k, v in sorted(count.items()))

    return P.flat_map(texts(spark, d), F.col("id"), F.lit(""), F.col("text"), "rec_key bigint, language string, size int, n_sections int, has_etymology boolean, templates string", rows).distinct()


@query(f"WITH {_EN}, x AS (SELECT DISTINCT revision_id, id FROM (SELECT revision_id FROM en) a JOIN (SELECT DISTINCT id FROM revisions) b ON a.revision_id = b.id) SELECT count(*) AS n_known, (SELECT count(DISTINCT revision_id) FROM en) AS n_all FROM x")
def f8_contains(spark, d):
    """How many of the revisions that entries name are there."""
    e = entries(spark, d).select(F.col("revision_id").alias("id")).where("id is not null").distinct()
    known = e.join(table(spark, d, "revisions").select("id").distinct(), "id", "left_semi").agg(F.count("*").alias("n_known"))
    return known.join(F.broadcast(e.agg(F.count("*").alias("n_all"))))


@query()
def s15_property_tables(spark, d):
    """The sizes of the tables that a property graph is imported from."""
    n = table(spark, d, "node").where("term is not null").groupBy(F.concat_ws("#", "term", "language", F.coalesce("sense_idx", F.lit(0)).cast("string")).alias("node")).agg(F.min("kind").alias("kind"), F.min("term").alias("term"), F.min("language").alias("language"), F.min("sense_idx").alias("sense_idx"), F.array_compact(F.collect_set(F.nullif("gloss", F.lit("")))).alias("glosses"))
    tables = W.property_tables(edges(spark, d), n)
    out = None
    for name, df in sorted(tables.items()):
        one = df.agg(F.count("*").alias("n")).select(F.lit(name).alias("name"), "n")
        out = one if out is None else out.unionByName(one)
    return out
