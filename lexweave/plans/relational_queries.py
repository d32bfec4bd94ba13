"""Queries on revisions, contributors, entries, nodes and languages, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexweave.operators import glosses as G
from lexweave.operators import relational as R
from lexweave.operators.shred import assemble, shred
from lexweave.plans.runtime import table

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


def revs(spark: SparkSession, d: str) -> DataFrame:
    return R.clean_revisions(table(spark, d, "revisions"))


def pages(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "json_page").groupBy("id").agg(F.min("title").alias("title"), F.min("ns").alias("ns"))


def names(spark: SparkSession, d: str) -> DataFrame:
    """(contributor, username): registered contributors, the smallest of several names."""
    c = table(spark, d, "contributors").where("id is not null")
    return c.groupBy(F.col("id").cast("string").alias("contributor")).agg(F.min("username").alias("username"))


def entries(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "entries").distinct()


_R = r"r AS (SELECT DISTINCT page_id, id, timestamp, coalesce(nullif(lower(regexp_replace(contributor, '^\s+|\s+$', '', 'g')), ''), '-') AS contributor, coalesce(minor, false) AS minor FROM revisions WHERE id IS NOT NULL)"
_P = "p AS (SELECT id, min(title) AS title, min(ns) AS ns FROM json_page GROUP BY id)"
_N = "n AS (SELECT id::VARCHAR AS contributor, min(username) AS username FROM contributors WHERE id IS NOT NULL GROUP BY 1)"
_E = "en AS (SELECT DISTINCT * FROM entries)"


@query(f"WITH {_E} SELECT entry_id, language, size FROM en WHERE language IN ('en','fr') AND size > 100")
def f1_query_builder(spark, d):
    return R.EntryQuery(entries(spark, d)).where_in("language", "en", "fr").where_in("n_sections").filter(F.col("size") > 100).selector("entry_id", "language", "size").build()


@query(f"WITH {_P} SELECT id, title, 'pattern' AS how FROM p WHERE regexp_matches(title, '^(User|Template):') UNION ALL SELECT id, title, 'exact' FROM p WHERE title = (SELECT max(title) FROM p)")
def f2_title(spark, d):
    """Titles by pattern, and pages of one title: the last in order."""
    p = pages(spark, d)
    some = R.EntryQuery(p).matching("title", "^(User|Template):").selector("id", "title").build().withColumn("how", F.lit("pattern"))
    last = p.agg(F.max("title")).first()[0]
    return some.unionByName(R.EntryQuery(p).equal("title", last).selector("id", "title").build().withColumn("how", F.lit("exact")))


@query(f"WITH {_P} SELECT id, ns FROM p WHERE ns IN (0, 118)")
def f3_namespaces(spark, d):
    return R.EntryQuery(pages(spark, d)).where_in("ns", 0, 118).selector("id", "ns").build()


def section_rows(spark: SparkSession, d: str) -> DataFrame:
    """(page_id, rev_id, sec_pos, path) of every section."""
    leaves = ["[].id", "[].sections[].path"]
    s = shred(table(spark, d, "json_page"), F.col("id"), F.col("revision"), leaves)
    t = assemble(s, leaves, "[].sections[]", {"rev": leaves[0], "path": leaves[1]})
    return t.select(F.col("rec_key").alias("page_id"), F.col("rev").cast("bigint").alias("rev_id"), F.col("pos2").alias("sec_pos"), F.from_json("path", "array<string>").alias("path")).distinct()


_S = r"""pg AS (SELECT DISTINCT id, revision FROM json_page WHERE revision IS NOT NULL AND revision <> ''),
rv AS (SELECT id AS page_id, unnest(CASE WHEN json_type(revision) = 'ARRAY' THEN CAST(revision AS JSON[]) ELSE [CAST(revision AS JSON)] END) AS v FROM pg),
s0 AS (SELECT page_id, CAST(v->>'$.id' AS BIGINT) AS rev_id, CAST(v->'$.sections' AS JSON[]) AS l FROM rv WHERE json_type(v->'$.sections') = 'ARRAY'),
sc AS (SELECT DISTINCT page_id, rev_id, CAST(i AS INT) AS sec_pos, CAST(l[i]->'$.path' AS VARCHAR[]) AS path FROM (SELECT page_id, rev_id, l, unnest(range(1, CAST(len(l) + 1 AS BIGINT))) AS i FROM s0))"""


@query(f"WITH {_S} SELECT rev_id FROM sc GROUP BY rev_id HAVING bool_or(len(list_filter(path, lambda h: regexp_matches(h, '^Old'))) > 0 AND len(list_filter(path, lambda h: regexp_matches(h, 'Etym'))) > 0)")
def f4_nested_exists_all(spark, d):
    per = section_rows(spark, d).groupBy("rev_id").agg(F.collect_list("path").alias("paths"))
    return R.EntryQuery(per).sections("paths", "^Old", "Etym").selector("rev_id").build()


@query(f"WITH {_S} SELECT rev_id, sec_pos, path[-1] AS heading FROM sc WHERE regexp_matches(path[-1], '^(Etym|Descend)')")
def f9_section_flatmap(spark, d):
    last = F.try_element_at("path", F.lit(-1))
    return section_rows(spark, d).where(last.rlike("^(Etym|Descend)")).select("rev_id", "sec_pos", last.alias("heading"))


_BOT = "regexp_matches(lower(username), 'bot$')"


@query(f"WITH {_R}, {_P}, {_N}, l AS (SELECT r.*, row_number() OVER (PARTITION BY page_id ORDER BY timestamp DESC, id DESC) AS k FROM r) SELECT l.id, l.page_id FROM l WHERE page_id IN (SELECT id FROM p WHERE ns = 0) AND contributor NOT IN (SELECT contributor FROM n WHERE {_BOT}) AND (NOT minor OR k = 1)")
def f11_revision_filters(spark, d):
    """Main-namespace revisions by others than bots, minor ones only if the page's last."""
    main = pages(spark, d).where("ns = 0").select(F.col("id").alias("page_id"))
    bots = names(spark, d).where(F.lower("username").rlike("bot$")).select("contributor")
    r = revs(spark, d)
    last = r.groupBy("page_id").agg(F.max(F.struct("timestamp", "id"))["id"].alias("id")).select("page_id", "id", F.lit(True).alias("last"))
    r = r.join(main, "page_id", "left_semi").join(bots, "contributor", "left_anti").join(last, ["page_id", "id"], "left")
    return r.where("not minor or last").select("id", "page_id").distinct()


@query(f"WITH {_E} SELECT entry_id, language FROM en WHERE language IS NOT NULL AND NOT starts_with(language, '?')")
def f14_known_language(spark, d):
    return entries(spark, d).where(F.col("language").isNotNull() & ~F.startswith("language", F.lit("?"))).select("entry_id", "language")


@query("SELECT DISTINCT node_id, term FROM node WHERE regexp_full_match(term, '[*].*|.* .*') AND (language IS NULL OR language NOT IN ('en','de')) AND kind IN ('entry','stub')")
def f15_node_predicate(spark, d):
    n = table(spark, d, "node").select("node_id", "term", "language", "kind").distinct()
    return n.where(F.col("term").rlike("^(?:[*].*|.* .*)$") & (F.col("language").isNull() | ~F.col("language").isin("en", "de")) & F.col("kind").isin("entry", "stub")).select("node_id", "term")


@query(f"WITH {_R}, {_E} SELECT r.id, entry_id, language FROM r LEFT JOIN en ON r.id = en.revision_id")
def j1_left_merge(spark, d):
    return revs(spark, d).join(entries(spark, d), F.col("id") == F.col("revision_id"), "left").select("id", "entry_id", "language")


@query(f"WITH {_R}, {_N} SELECT r.id, coalesce(username, r.contributor) AS who FROM r LEFT JOIN n ON r.contributor = n.contributor")
def j2_dim_lookup(spark, d):
    return revs(spark, d).join(names(spark, d), "contributor", "left").select("id", F.coalesce("username", "contributor").alias("who"))


@query("""WITH m AS (SELECT DISTINCT tgt.term AS term, tgt.language AS language FROM relation WHERE tgt.term IS NOT NULL), x AS (SELECT DISTINCT node_id, term, language, CASE kind WHEN 'stub' THEN 0 WHEN 'entry' THEN 1 ELSE 2 END AS rk, coalesce(sense_idx, 0) AS sense FROM node)
SELECT m.term, m.language, node_id FROM m LEFT JOIN x ON x.term = m.term AND x.language = m.language QUALIFY row_number() OVER (PARTITION BY m.term, m.language ORDER BY rk, sense, node_id) = 1""")
def j5_lexicon_cascade(spark, d):
    """Each mentioned word's lexeme: single-meaning before multi-meaning before no entry."""
    m = table(spark, d, "relation").select("tgt.term", "tgt.language").where("term is not null").distinct()
    rank = F.when(F.col("kind") == "stub", 0).when(F.col("kind") == "entry", 1).otherwise(2)
    x = table(spark, d, "node").groupBy("term", "language").agg(F.min(F.struct(rank, F.coalesce("sense_idx", F.lit(0)), "node_id"))["node_id"].alias("node_id"))
    return m.join(x, ["term", "language"], "left").select("term", "language", "node_id")


@query(f"WITH {_R}, c AS (SELECT contributor, count(*) AS n FROM r GROUP BY 1) SELECT contributor, n, round(100 * n / sum(n) OVER (), 6) AS pct FROM c")
def a1_value_counts(spark, d):
    c = revs(spark, d).groupBy("contributor").agg(F.count("*").alias("n"))
    total = c.agg(F.sum("n").alias("t"))
    return c.join(F.broadcast(total)).select("contributor", "n", F.round(100 * F.col("n") / F.col("t"), 6).alias("pct"))


@query(f"WITH {_R} SELECT page_id, min(timestamp) AS created, max(timestamp) AS last_edited, count(*) AS n_revisions FROM r GROUP BY 1")
def a2_page_stats(spark, d):
    return revs(spark, d).groupBy("page_id").agg(F.min("timestamp").alias("created"), F.max("timestamp").alias("last_edited"), F.count("*").alias("n_revisions"))


@query(f"WITH {_R} SELECT contributor, count(*) AS n, count(DISTINCT page_id) AS n_pages, count(*) FILTER (NOT minor) AS n_major FROM r GROUP BY 1")
def a3_contributor_stats(spark, d):
    return revs(spark, d).groupBy("contributor").agg(F.count("*").alias("n"), F.count_distinct("page_id").alias("n_pages"), F.count_if(~F.col("minor")).alias("n_major"))


@query(f"WITH {_R}, {_N}, b AS (SELECT page_id, bool_and(contributor IN (SELECT contributor FROM n WHERE {_BOT})) AS only_bots FROM r GROUP BY 1) SELECT count(*) AS n_pages, count(*) FILTER (only_bots) AS n_bot_only, round(count(*) FILTER (only_bots) / count(*), 6) AS ratio FROM b")
def a4_bot_only_ratio(spark, d):
    bots = names(spark, d).where(F.lower("username").rlike("bot$")).select("contributor", F.lit(True).alias("bot"))
    b = revs(spark, d).join(bots, "contributor", "left").groupBy("page_id").agg(F.every(F.coalesce("bot", F.lit(False))).alias("only"))
    return b.agg(F.count("*").alias("n_pages"), F.count_if("only").alias("n_bot_only"), F.round(F.count_if("only") / F.count("*"), 6).alias("ratio"))


@query(f"WITH {_E} SELECT language, count(*) AS n, sum(size)::BIGINT AS size, max(n_sections) AS most_sections, bool_or(has_etymology) AS has_etymology FROM en GROUP BY 1")
def a30_entry_statistics(spark, d):
    return entries(spark, d).groupBy("language").agg(F.count("*").alias("n"), F.sum("size").alias("size"), F.max("n_sections").alias("most_sections"), F.bool_or("has_etymology").alias("has_etymology"))


@query(f"SELECT * FROM (PIVOT (WITH {_R}, {_E} SELECT language, strftime(date_trunc('week', timestamp), 'w%Y%m%d') AS wk FROM r JOIN en ON r.id = en.revision_id WHERE language <> '') ON wk USING count(*) GROUP BY language)")
def a6_pivot_fill0(spark, d):
    """Every language's entries by week, a column a week, 0 where there are none."""
    week = F.date_format(F.date_trunc("week", "timestamp"), "'w'yyyyMMdd").alias("wk")
    j = revs(spark, d).select("id", week).join(entries(spark, d).where("language <> ''"), F.col("id") == F.col("revision_id"))
    weeks = [r.wk for r in j.select("wk").distinct().orderBy("wk").collect()]  # as many as the data has weeks
    return j.groupBy("language").pivot("wk", weeks).agg(F.count(F.lit(1))).fillna(0)


@query(f"WITH {_E} SELECT CASE WHEN size IS NULL THEN 'none' WHEN size < 200 THEN 'small' WHEN size < 1000 THEN 'medium' ELSE 'large' END AS bucket, count(*) AS n FROM en GROUP BY 1")
def a7_case_bucket(spark, d):
    b = F.when(F.col("size").isNull(), "none").when(F.col("size") < 200, "small").when(F.col("size") < 1000, "medium").otherwise("large")
    return entries(spark, d).groupBy(b.alias("bucket")).agg(F.count("*").alias("n"))


@query(f"WITH {_R}, c AS (SELECT contributor, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, contributor) AS k FROM r GROUP BY 1), t(top) AS (VALUES (10), (100), (1000), (100000)) SELECT top, round(sum(n) FILTER (k <= top) / sum(n), 6) AS share FROM c, t GROUP BY top")
def a10_topk_share(spark, d):
    c = revs(spark, d).groupBy("contributor").agg(F.count("*").alias("n"))
    best = c.orderBy(F.desc("n"), "contributor").limit(100_000).withColumn("k", F.row_number().over(Window.orderBy(F.desc("n"), "contributor")))
    total = c.agg(F.sum("n").alias("t"))
    s = best.agg(*(F.sum(F.when(F.col("k") <= k, F.col("n"))).alias(str(k)) for k in (10, 100, 1000, 100_000))).join(total)
    return s.select(F.explode(F.array(*(F.struct(F.lit(k).alias("top"), F.round(F.col(str(k)) / F.col("t"), 6).alias("share")) for k in (10, 100, 1000, 100_000))))).select("col.*")


@query(f"WITH {_R}, {_N}, x AS (SELECT CASE WHEN username IS NULL THEN -2 WHEN {_BOT} THEN 0 ELSE -1 END AS is_bot FROM r LEFT JOIN n ON r.contributor = n.contributor) SELECT is_bot, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 6) AS share FROM x GROUP BY 1")
def a11_group_share(spark, d):
    kind = F.when(F.col("username").isNull(), -2).when(F.lower("username").rlike("bot$"), 0).otherwise(-1)
    g = revs(spark, d).join(names(spark, d), "contributor", "left").groupBy(kind.alias("is_bot")).agg(F.count("*").alias("n"))
    return g.select("is_bot", "n", F.round(F.col("n") / F.sum("n").over(Window.partitionBy(F.lit(1))), 6).alias("share"))


@query("WITH u AS (SELECT DISTINCT node_id, gloss FROM node WHERE gloss <> ''), w AS (SELECT unnest(string_split(gloss, ' ')) AS word FROM u) SELECT word, count(*) AS n FROM w GROUP BY 1 HAVING count(*) >= 10")
def a21_having_cutoff(spark, d):
    n = table(spark, d, "node").where("gloss <> ''").select("node_id", "gloss").distinct()
    return n.select(F.explode(F.split("gloss", " ")).alias("word")).groupBy("word").agg(F.count("*").alias("n")).where("n >= 10")


@query("WITH x AS (SELECT DISTINCT node_id, term, language, gloss FROM node WHERE gloss <> '') SELECT term, language, string_agg(gloss, '; ' ORDER BY gloss, node_id) AS glosses FROM x GROUP BY ALL")
def a24_gloss_group(spark, d):
    n = table(spark, d, "node").where("gloss <> ''").select("node_id", "term", "language", "gloss").distinct()
    g = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("gloss", "node_id"))), lambda x: x["gloss"]), "; ")
    return n.groupBy("term", "language").agg(g.alias("glosses"))


@query("WITH n1 AS (SELECT DISTINCT node_id, concat_ws('#', term, language, coalesce(sense_idx, 0)::VARCHAR) AS k, language FROM node), l AS (SELECT k, min(language) AS g FROM n1 GROUP BY k), e AS (SELECT DISTINCT concat_ws('#', src.term, src.language, coalesce(src.sense_idx, 0)::VARCHAR) AS s, concat_ws('#', tgt.term, tgt.language, coalesce(tgt.sense_idx, 0)::VARCHAR) AS t, type FROM relation) SELECT a.g AS src_group, type, b.g AS tgt_group, count(*) AS n FROM e JOIN l a ON a.k = s JOIN l b ON b.k = t GROUP BY ALL")
def a23_graph_group(spark, d):
    """Super-edges between languages."""
    key = lambda c: F.concat_ws("#", f"{c}term", f"{c}language", F.coalesce(f"{c}sense_idx", F.lit(0)).cast("string"))
    lang = table(spark, d, "node").groupBy(key("").alias("k")).agg(F.min("language").alias("g"))
    e = table(spark, d, "relation").select(key("src.").alias("s"), key("tgt.").alias("t"), "type").distinct()
    a = e.join(lang.select(F.col("k").alias("s"), F.col("g").alias("src_group")), "s").join(lang.select(F.col("k").alias("t"), F.col("g").alias("tgt_group")), "t")
    return a.groupBy("src_group", "type", "tgt_group").agg(F.count("*").alias("n"))


@query(f"WITH {_R} SELECT page_id, id FROM r QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY timestamp DESC, id DESC) = 1")
def w2_last_per_group(spark, d):
    return R.last_per(revs(spark, d), ["page_id"], ["timestamp", "id"]).select("page_id", "id")


_BIN = "date_trunc('{}', timestamp - INTERVAL 1 MICROSECOND)::TIMESTAMP AS bin"


@query(f"WITH {_R}, b AS (SELECT *, {_BIN.format('week')} FROM r) SELECT page_id, bin, id FROM b QUALIFY row_number() OVER (PARTITION BY page_id, bin ORDER BY timestamp DESC, id DESC) = 1")
def w3_last_per_bin(spark, d):
    b = revs(spark, d).withColumn("bin", R.right_closed_bin(F.col("timestamp"), "week"))
    return R.last_per(b, ["page_id", "bin"], ["timestamp", "id"]).select("page_id", "bin", "id")


@query(f"WITH {_R}, b AS (SELECT *, {_BIN.format('week')} FROM r), l AS (SELECT page_id, bin, minor FROM b QUALIFY row_number() OVER (PARTITION BY page_id, bin ORDER BY timestamp DESC, id DESC) = 1), s AS (SELECT DISTINCT bin FROM b), f AS (SELECT page_id, min(bin) AS f FROM l GROUP BY 1) SELECT f.page_id, s.bin, last_value(l.minor IGNORE NULLS) OVER (PARTITION BY f.page_id ORDER BY s.bin ROWS UNBOUNDED PRECEDING) AS minor FROM f JOIN s ON s.bin >= f.f LEFT JOIN l ON l.page_id = f.page_id AND l.bin = s.bin")
def w4_forward_fill(spark, d):
    b = revs(spark, d).withColumn("bin", R.right_closed_bin(F.col("timestamp"), "week"))
    last = R.last_per(b, ["page_id", "bin"], ["timestamp", "id"])
    return R.forward_fill(last, "page_id", "bin", "minor", "7 days")


@query(f"WITH {_R}, b AS (SELECT *, {_BIN.format('day')} FROM r) SELECT bin, count(*) AS n FROM b GROUP BY 1")
def w5_right_closed_bins(spark, d):
    return revs(spark, d).groupBy(R.right_closed_bin(F.col("timestamp"), "day").alias("bin")).agg(F.count("*").alias("n"))


@query(f"WITH {_R}, c AS (SELECT strftime(f, '%Y-%m-%d') AS day, count(*) AS n FROM (SELECT page_id, min(timestamp) AS f FROM r GROUP BY 1) GROUP BY 1) SELECT day, n, sum(n) OVER (ORDER BY day)::BIGINT AS so_far, round(sum(n) OVER (ORDER BY day) / sum(n) OVER (), 6) AS share FROM c")
def w6_cumulative_share(spark, d):
    c = revs(spark, d).groupBy("page_id").agg(F.min("timestamp").alias("f")).groupBy(F.date_format("f", "yyyy-MM-dd").alias("day")).agg(F.count("*").alias("n"))
    one = Window.partitionBy(F.lit(1))  # a row per day: few
    run = one.orderBy("day").rowsBetween(Window.unboundedPreceding, 0)
    return c.select("day", "n", F.sum("n").over(run).alias("so_far"), F.round(F.sum("n").over(run) / F.sum("n").over(one), 6).alias("share"))


@query(f"WITH {_R}, c AS (SELECT page_id, count(*) AS n FROM r GROUP BY 1) SELECT floor(log10(n) * 4)::INT AS bin, count(*) AS n FROM c GROUP BY 1")
def w7_histogram(spark, d):
    c = revs(spark, d).groupBy("page_id").agg(F.count("*").alias("k"))
    return c.groupBy(F.floor(F.log10("k") * 4).cast("int").alias("bin")).agg(F.count("*").alias("n"))


@query(f"WITH {_R} SELECT page_id, count(*) AS n FROM r GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 25")
def w8_topk(spark, d):
    return revs(spark, d).groupBy("page_id").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "page_id").limit(25)


@query(f"WITH {_R}, c AS (SELECT date_trunc('week', timestamp)::TIMESTAMP AS week, contributor, count(*) AS n FROM r WHERE contributor <> '-' GROUP BY 1, 2) SELECT week, contributor, n, round(n / sum(n) OVER (PARTITION BY week), 6) AS share FROM c QUALIFY row_number() OVER (PARTITION BY week ORDER BY n DESC, contributor) = 1")
def w9_top_user_per_bin(spark, d):
    c = revs(spark, d).where("contributor <> '-'").groupBy(F.date_trunc("week", "timestamp").cast("timestamp_ntz").alias("week"), "contributor").agg(F.count("*").alias("n"))
    t = c.groupBy("week").agg(F.sum("n").alias("t"), F.min(F.struct((-F.col("n")).alias("m"), "contributor", "n")).alias("x"))
    return t.select("week", "x.contributor", "x.n", F.round(F.col("x.n") / F.col("t"), 6).alias("share"))


@query(f"WITH {_E} SELECT revision_id, entry_id FROM en WHERE size IS NOT NULL AND revision_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY revision_id ORDER BY size DESC, entry_id) = 1")
def w10_argmax(spark, d):
    e = entries(spark, d).where("size is not null and revision_id is not null")
    return e.groupBy("revision_id").agg(F.min(F.struct((-F.col("size")).alias("s"), "entry_id"))["entry_id"].alias("entry_id"))


@query("SELECT term, language, min(node_id) AS node_id FROM node WHERE term IS NOT NULL GROUP BY ALL")
def w11_keep_first(spark, d):
    n = table(spark, d, "node").where("term is not null").select("term", "language", "node_id")
    return R.first_per(n, ["term", "language"], ["node_id"])


@query(f"WITH {_R}, a AS (SELECT id FROM r WHERE minor), b AS (SELECT id FROM r WHERE contributor = '-') SELECT (SELECT count(*) FROM (SELECT id FROM a INTERSECT SELECT id FROM b)) AS n_both, (SELECT count(*) FROM (SELECT id FROM a EXCEPT SELECT id FROM b)) AS n_left")
def u2_difference_intersection(spark, d):
    r = revs(spark, d)
    a, b = r.where("minor").select("id"), r.where("contributor = '-'").select("id")
    return a.intersect(b).agg(F.count("*").alias("n_both")).join(a.subtract(b).agg(F.count("*").alias("n_left")))


@query(f"WITH {_R}, a AS (SELECT strftime(timestamp, '%Y-%m-%d') AS day, count(*) AS n FROM r WHERE minor GROUP BY 1), b AS (SELECT strftime(timestamp, '%Y-%m-%d') AS day, count(*) AS n FROM r WHERE contributor = '-' GROUP BY 1) SELECT day, sum(n)::BIGINT AS n FROM (FROM a UNION ALL FROM b) GROUP BY 1")
def j13_outer_align_add(spark, d):
    day = F.date_format("timestamp", "yyyy-MM-dd").alias("day")
    r = revs(spark, d)
    return R.add_aligned(r.where("minor").groupBy(day).agg(F.count("*").alias("n")), r.where("contributor = '-'").groupBy(day).agg(F.count("*").alias("n")), ["day"], "n")


@query("WITH x AS (SELECT DISTINCT ord, text FROM relation WHERE text IS NOT NULL) SELECT ord, regexp_replace(regexp_replace(text, '\\[\\[(?:[^\\[\\]|]*\\|)?([^\\[\\]]*)\\]\\]', '\\1', 'g'), '\\n+', '<br/>', 'g') AS plain FROM x")
def x1_strip_links(spark, d):
    """Links to their text and newlines to breaks."""
    x = table(spark, d, "relation").where("text is not null").select("ord", "text").distinct()
    return x.select("ord", F.regexp_replace(F.regexp_replace("text", r"\[\[(?:[^\[\]|]*\|)?([^\[\]]*)\]\]", "$1"), r"\n+", "<br/>").alias("plain"))


@query("WITH x AS (SELECT DISTINCT node_id, term, gloss FROM node WHERE term IS NOT NULL) SELECT node_id, contains(term, ' ') AS multiword, CASE WHEN regexp_matches(gloss, '^to ') THEN 'Verb' WHEN regexp_matches(gloss, '^(a|an|the) ') THEN 'Noun' WHEN regexp_matches(gloss, 'ly$') THEN 'Adverb' END AS pos FROM x")
def x15_heuristic_pos(spark, d):
    """Part of speech from the gloss, and whether the term has several words."""
    x = table(spark, d, "node").where("term is not null").select("node_id", "term", "gloss").distinct()
    pos = F.when(F.col("gloss").rlike("^to "), "Verb").when(F.col("gloss").rlike("^(a|an|the) "), "Noun").when(F.col("gloss").rlike("ly$"), "Adverb")
    return x.select("node_id", F.contains("term", F.lit(" ")).alias("multiword"), pos.alias("pos"))


_FIRST = "g AS (SELECT DISTINCT node_id, term, language, gloss FROM node WHERE gloss <> '' AND term IS NOT NULL AND language IS NOT NULL), f AS (SELECT term, language, min(node_id) AS a, arg_min(gloss, node_id::VARCHAR) AS x0 FROM g GROUP BY ALL), p AS (SELECT f.a, g.node_id AS b, (SELECT min(gloss) FROM g h WHERE h.node_id = f.a) AS x, g.gloss AS y FROM f JOIN g ON f.term = g.term AND f.language = g.language WHERE g.node_id <> f.a), t AS (SELECT *, list_distinct(regexp_extract_all(lower(x), '\\w+')) AS wx, list_distinct(regexp_extract_all(lower(y), '\\w+')) AS wy FROM p), c AS (SELECT *, len(list_intersect(wx, wy)) AS n FROM t)"


def homonym_pairs(spark: SparkSession, d: str) -> DataFrame:
    """(a, b, x, y): the word's first lexeme with each other of the word, so a word has as many pairs as other lexemes."""
    g = table(spark, d, "node").where("gloss <> '' and term is not null and language is not null").groupBy("term", "language", "node_id").agg(F.min("gloss").alias("gloss"), F.collect_set("gloss").alias("glosses"))
    first = R.first_per(g.select("term", "language", "node_id", "gloss"), ["term", "language"], ["node_id"]).select("term", "language", F.col("node_id").alias("a"), F.col("gloss").alias("x"))
    p = g.join(first, ["term", "language"]).where("node_id <> a")
    return p.select("a", F.col("node_id").alias("b"), "x", F.explode("glosses").alias("y"))


@query(f"WITH {_FIRST} SELECT a, b, CASE WHEN len(x) >= 50 OR len(y) >= 50 THEN -1 WHEN levenshtein(x, y) <= 8 THEN levenshtein(x, y) ELSE -1 END::INT AS lev, (x = y) AS equal, contains(y, x) AS a_in_b, contains(x, y) AS b_in_a, round(CASE WHEN n = 0 THEN 0 ELSE n / (n + 0.32 * (len(wy) - n) + 0.68 * (len(wx) - n)) END, 6) AS tversky FROM c")
def x22_gloss_features(spark, d):
    """Similarity of the glosses of homonyms."""
    p = homonym_pairs(spark, d)
    return p.select("a", "b", G.cutoff_levenshtein(F.col("x"), F.col("y"), 8).alias("lev"), (F.col("x") == F.col("y")).alias("equal"), F.contains("y", "x").alias("a_in_b"), F.contains("x", "y").alias("b_in_a"), F.round(G.tversky(G.words(F.col("x")), G.words(F.col("y"))), 6).alias("tversky"))


@query()
def x23_gloss_blocks(spark, d):
    """Fuzzy overlap and matching blocks of the same pairs."""
    return G.features(homonym_pairs(spark, d), "x", "y").select("a", "b", *(F.round(c, 6).alias(c) for c in ("fuzzy", "ratio", "longest", "word_ratio", "word_longest")))


@query("WITH m AS (SELECT DISTINCT tgt.term AS term, tgt.language AS language FROM relation WHERE tgt.term IS NOT NULL) SELECT m.term, m.language FROM m WHERE NOT EXISTS (SELECT 1 FROM node WHERE node.term = m.term AND node.language = m.language)")
def n2_no_entry(spark, d):
    m = table(spark, d, "relation").select("tgt.term", "tgt.language").where("term is not null").distinct()
    return m.join(table(spark, d, "node").select("term", "language"), ["term", "language"], "left_anti")


@query("WITH c AS (SELECT language, count(*) AS n FROM (SELECT DISTINCT node_id, language FROM node) GROUP BY 1), k AS (SELECT *, row_number() OVER (ORDER BY n DESC, language NULLS FIRST) AS rank FROM c) SELECT rank, language, n FROM k WHERE rank IN (1, 10, 50, 100, 200)")
def w12_value_at_rank(spark, d):
    """The languages at five ranks by size; the window sees a row a language."""
    c = table(spark, d, "node").select("node_id", "language").distinct().groupBy("language").agg(F.count("*").alias("n"))
    k = c.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("n"), F.asc_nulls_first("language"))))
    return k.where(F.col("rank").isin(1, 10, 50, 100, 200)).select("rank", "language", "n")
