"""Queries of the general operators on packed, nested and hierarchical data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexweave.operators import hierarchy as H
from lexweave.operators.packed import split_packed
from lexweave.operators.shred import assemble, shred
from lexweave.plans.runtime import cut, table


def _families(spark: SparkSession, d: str, with_path: bool) -> DataFrame:
    t = table(spark, d, "language_families")
    return H.hierarchy(H.resolve_parents(t, F.col("code"), F.col("canonical_name"), F.col("parent_family")), with_path)


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return _families(spark, d, False).select("code", F.col("root").alias("root_code"), "depth")


def p2_paths(spark: SparkSession, d: str) -> DataFrame:
    t = _families(spark, d, True).where("depth >= 0")
    return t.select("code", F.array_join("path", ">").alias("path"), F.col("size").alias("n_subtree"))


def p2_descendants(spark: SparkSession, d: str) -> DataFrame:
    """All descendants of every family outside loops, by their ranges."""
    return H.descendants(cut(_families(spark, d, False)))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    e = split_packed(table(spark, d, "entries"), F.col("entry_id").cast("string"), F.col("templates"))
    o = split_packed(table(spark, d, "language_data"), F.col("code"), F.col("other_names"))
    return e.select(F.lit("entries.templates").alias("source_field"), "*").unionByName(o.select(F.lit("language_data.other_names").alias("source_field"), "*"))


P7_LEAVES = ["[].id", "[].contributor.id", "[].contributor.ip", "[].sections[].templates[].name"]


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    s = shred(table(spark, d, "json_page"), F.col("id"), F.col("revision"), P7_LEAVES)
    t = assemble(s, P7_LEAVES, "[].sections[].templates[]", {"rev": P7_LEAVES[0], "cid": P7_LEAVES[1], "cip": P7_LEAVES[2], "name": P7_LEAVES[3]}, outer=True)
    text = lambda c: F.nullif(F.trim(c), F.lit(""))
    return t.select(
        F.col("rec_key").alias("page_id"), F.col("rev").cast("bigint").alias("rev_id"), F.coalesce(text("cid"), text("cip"), F.lit("-")).alias("contributor"),
        F.col("pos2").alias("sec_pos"), F.col("pos3").alias("tpl_pos"), F.when(F.col("pos3") > 0, F.coalesce("name", F.lit(""))).otherwise("").alias("tpl_name"),
    ).distinct()


P7_REVISION = ["[].id", "[].parentid", "[].timestamp", "[].minor", "[].comment", "[].contributor.id", "[].contributor.username", "[].contributor.ip"]


def p7_revisions(spark: SparkSession, d: str) -> DataFrame:
    """The table of revisions, each with its page."""
    s = shred(table(spark, d, "json_page"), F.col("id"), F.col("revision"), P7_REVISION)
    t = assemble(s, P7_REVISION, "[]", {p[3:].replace(".", "_"): p for p in P7_REVISION})
    return t.select(F.col("rec_key").alias("page_id"), F.col("id").cast("bigint").alias("rev_id"), F.col("parentid").cast("bigint").alias("parent_id"), "timestamp", (F.coalesce("minor", F.lit("false")) != "false").alias("minor"), "comment", F.coalesce("contributor_id", "contributor_ip", F.lit("-")).alias("contributor")).distinct()


def p7_sections(spark: SparkSession, d: str) -> DataFrame:
    """The table of sections, each with its revision; the heading path as text."""
    leaves = ["[].id", "[].sections[].path", "[].sections[].note"]
    s = shred(table(spark, d, "json_page"), F.col("id"), F.col("revision"), leaves)
    t = assemble(s, leaves, "[].sections[]", {"rev": leaves[0], "path": leaves[1], "note": leaves[2]})
    return t.select(F.col("rev").cast("bigint").alias("rev_id"), F.col("pos2").alias("sec_pos"), F.array_join(F.from_json("path", "array<string>"), " > ").alias("path"), F.col("note").isNotNull().alias("has_note")).distinct()


def p7_pages(spark: SparkSession, d: str) -> DataFrame:
    """The table of pages, those without revisions included; partial if any of a page's rows is."""
    return table(spark, d, "json_page").groupBy(F.col("id").alias("page_id"), "title", "ns").agg(F.bool_or(F.coalesce("partial", F.lit(False))).alias("partial"))


P7_CONTRIBUTOR = ["[].id", "[].contributor.id", "[].contributor.username", "[].contributor.ip"]


def p7_contributors(spark: SparkSession, d: str) -> DataFrame:
    """The table of contributors, each with its revision; revisions that name none give nothing."""
    s = shred(table(spark, d, "json_page"), F.col("id"), F.col("revision"), P7_CONTRIBUTOR)
    t = assemble(s, P7_CONTRIBUTOR, "[]", dict(zip(("rev", "id", "username", "ip"), P7_CONTRIBUTOR)))
    return t.where("coalesce(id, username, ip) is not null").select(F.col("rec_key").alias("page_id"), F.col("rev").cast("bigint").alias("rev_id"), "id", "username", "ip").distinct()


def p7_templates(spark: SparkSession, d: str) -> DataFrame:
    """The table of templates with their counts, each with its revision and section."""
    leaves = ["[].id", "[].sections[].templates[].name", "[].sections[].templates[].count"]
    s = shred(table(spark, d, "json_page"), F.col("id"), F.col("revision"), leaves)
    t = assemble(s, leaves, "[].sections[].templates[]", {"rev": leaves[0], "name": leaves[1], "count": leaves[2]})
    return t.select(F.col("rec_key").alias("page_id"), F.col("rev").cast("bigint").alias("rev_id"), F.col("pos2").alias("sec_pos"), F.col("pos3").alias("tpl_pos"), "name", F.col("count").try_cast("bigint").alias("count")).distinct()


def p7_texts(spark: SparkSession, d: str) -> DataFrame:
    """The text of every revision that has one."""
    leaves = ["[].id", "[].text"]
    s = shred(table(spark, d, "json_page"), F.col("id"), F.col("revision"), leaves)
    t = assemble(s, leaves, "[]", {"rev": leaves[0], "text": leaves[1]})
    return t.where("text is not null").select(F.col("rec_key").alias("page_id"), F.col("rev").cast("bigint").alias("rev_id"), "text").distinct()


QUERIES = {f.__name__: f for f in (p2_found, p2_paths, p2_descendants, p5_found, p7_found, p7_revisions, p7_sections, p7_pages, p7_contributors, p7_templates, p7_texts)}

_FAM = """
WITH RECURSIVE raw AS (SELECT code, min(nullif(lower(trim(code)), '')) ck, min(nullif(lower(trim(canonical_name)), '')) nk,
  min(CASE WHEN lower(trim(parent_family)) NOT IN ('', '-', 'not a family') THEN lower(trim(parent_family)) END) pk FROM language_families WHERE code IS NOT NULL GROUP BY code),
keys AS (SELECT ck AS k, 0 AS rk, code FROM raw UNION ALL SELECT nk, 1, code FROM raw),
look AS (SELECT k, arg_min(code, rk::VARCHAR || code) AS parent FROM keys WHERE k IS NOT NULL GROUP BY k),
lnk AS (SELECT raw.code, look.parent FROM raw LEFT JOIN look ON raw.pk = look.k),
tree AS (SELECT code, code AS root_code, 0 AS depth, code AS path FROM lnk WHERE parent IS NULL
  UNION ALL SELECT l.code, t.root_code, t.depth + 1, t.path || '>' || l.code FROM lnk l JOIN tree t ON l.parent = t.code),
"""
#: A value with the delimiter after it: quoted, or up to the first delimiter.
_VALUE = r"""[  ]*(?:"(?:[^"]|"")*"|“(?:[^”]|””)*”|„(?:[^“]|““)*“|«(?:[^»]|»»)*»)[  ]*(?:[|,;\n\t\r]|[  ]/[  ])|[^|,;\n\t\r]*?(?:[|,;\n\t\r]|[  ]/[  ])"""
_QUOTED = r"""[  ]*(?:"(?:[^"]|"")*"|“(?:[^”]|””)*”|„(?:[^“]|““)*“|«(?:[^»]|»»)*»)[  ]*"""
#: CTEs for the values packed in field ``t`` of {0} (k, t), as {0}_v (k, pos, val).
_SPLIT = r"""{0}_m AS (SELECT k, t, list_transform(regexp_extract_all(t || '|', '{1}'), lambda x: regexp_replace(x, '(?:[|,;\n\t\r]|[  ]/[  ])$', '')) AS l FROM {0} WHERE k IS NOT NULL AND t <> ''),
{0}_l AS (SELECT k, list_filter(list_transform(l, lambda x: trim(CASE WHEN regexp_full_match(x, '{2}') THEN replace(replace(replace(replace(regexp_replace(x, '^[  ]*.|.[  ]*$', '', 'g'), '""', '"'), '””', '”'), '““', '“'), '»»', '»') ELSE x END, ' ' || chr(9) || chr(10) || chr(13) || chr(160))), lambda x: x <> '') AS l FROM {0}_m),
{0}_v AS (SELECT k, unnest(range(1, len(l) + 1))::INT AS pos, unnest(l) AS val FROM {0}_l)"""


def split_sql(name: str) -> str:
    return _SPLIT.format(name, _VALUE, _QUOTED)


_REV = r"""pages AS (SELECT DISTINCT id, revision FROM json_page WHERE revision IS NOT NULL AND revision <> ''),
r AS (SELECT id AS page_id, unnest(CASE WHEN json_type(revision) = 'ARRAY' THEN CAST(revision AS JSON[]) ELSE [CAST(revision AS JSON)] END) AS v FROM pages),
s0 AS (SELECT page_id, CAST(v->>'$.id' AS BIGINT) AS rev_id, CAST(v->'$.sections' AS JSON[]) AS l FROM r WHERE json_type(v->'$.sections') = 'ARRAY'),
sc AS (SELECT page_id, rev_id, CAST(i AS INT) AS sec_pos, l[i] AS s FROM (SELECT page_id, rev_id, l, unnest(range(1, CAST(len(l) + 1 AS BIGINT))) AS i FROM s0)),
t0 AS (SELECT page_id, rev_id, sec_pos, CAST(s->'$.templates' AS JSON[]) AS l FROM sc WHERE json_type(s->'$.templates') = 'ARRAY')"""
ORACLE = {
    "p5_found": "WITH e AS (SELECT DISTINCT entry_id::VARCHAR AS k, templates AS t FROM entries), o AS (SELECT DISTINCT code AS k, other_names AS t FROM language_data), " + split_sql("e") + ", " + split_sql("o") + " SELECT 'entries.templates' AS source_field, k AS rec_key, pos, val FROM e_v UNION ALL SELECT 'language_data.other_names', k, pos, val FROM o_v",
    "p7_pages": "SELECT id AS page_id, title, ns, bool_or(coalesce(partial, false)) AS partial FROM json_page GROUP BY id, title, ns",
    "p7_sections": f"WITH {_REV} SELECT DISTINCT rev_id, sec_pos, array_to_string(CAST(s->'$.path' AS VARCHAR[]), ' > ') AS path, coalesce(json_type(s->'$.note'), 'NULL') <> 'NULL' AS has_note FROM sc",
    "p7_contributors": f"WITH {_REV}, c AS (SELECT DISTINCT page_id, CAST(v->>'$.id' AS BIGINT) AS rev_id, v->>'$.contributor.id' AS id, v->>'$.contributor.username' AS username, v->>'$.contributor.ip' AS ip FROM r WHERE json_type(v->'$.contributor') = 'OBJECT') SELECT * FROM c WHERE coalesce(id, username, ip) IS NOT NULL",
    "p7_templates": f"WITH {_REV} SELECT DISTINCT page_id, rev_id, sec_pos, CAST(i AS INT) AS tpl_pos, l[i]->>'$.name' AS name, try_cast(l[i]->>'$.count' AS BIGINT) AS count FROM (SELECT page_id, rev_id, sec_pos, l, unnest(range(1, CAST(len(l) + 1 AS BIGINT))) AS i FROM t0)",
    "p7_texts": f"WITH {_REV} SELECT DISTINCT page_id, CAST(v->>'$.id' AS BIGINT) AS rev_id, v->>'$.text' AS text FROM r WHERE v->>'$.text' IS NOT NULL",
    "p2_found": _FAM + """
bad AS (SELECT code, parent FROM lnk WHERE code NOT IN (SELECT code FROM tree)),
reach AS (SELECT code AS a, parent AS b FROM bad UNION SELECT r.a, bad.parent FROM reach r JOIN bad ON r.b = bad.code),
ring AS (SELECT a FROM reach WHERE a = b)
SELECT code, root_code, depth FROM tree UNION ALL SELECT a, min(b), -1 FROM reach WHERE b IN (SELECT a FROM ring) GROUP BY a""",
    "p2_paths": _FAM + "sz AS (SELECT unnest(string_split(path, '>')) AS code, 1 AS one FROM tree) SELECT tree.code, any_value(path) AS path, count(*) AS n_subtree FROM tree JOIN sz ON sz.code = tree.code GROUP BY tree.code",
    "p2_descendants": _FAM + "x AS (SELECT code, string_split(path, '>') AS p FROM tree) SELECT unnest(p[:-2]) AS code, code AS descendant FROM x",
    "p7_found": r"""
WITH pages AS (SELECT DISTINCT id, revision FROM json_page WHERE revision IS NOT NULL AND revision <> ''),
r AS (SELECT id AS page_id, unnest(CASE WHEN json_type(revision) = 'ARRAY' THEN CAST(revision AS JSON[]) ELSE [CAST(revision AS JSON)] END) AS v FROM pages),
c AS (SELECT page_id, CAST(v->>'$.id' AS BIGINT) AS rev_id, CASE WHEN json_type(v->'$.contributor') = 'OBJECT' THEN coalesce(nullif(trim(v->>'$.contributor.id'), ''), nullif(trim(v->>'$.contributor.ip'), ''), '-') ELSE '-' END AS contributor, v->'$.sections' AS s FROM r),
s AS (SELECT page_id, rev_id, contributor, unnest(CASE WHEN json_type(s) = 'ARRAY' AND json_array_length(s) > 0 THEN CAST(s AS JSON[]) ELSE [NULL::JSON] END) AS sec, unnest(CASE WHEN json_type(s) = 'ARRAY' AND json_array_length(s) > 0 THEN range(1, CAST(json_array_length(s) + 1 AS BIGINT)) ELSE [0] END) AS sec_pos FROM c),
t AS (SELECT page_id, rev_id, contributor, sec_pos, sec->'$.templates' AS ts FROM s),
u AS (SELECT page_id, rev_id, contributor, sec_pos, unnest(CASE WHEN json_type(ts) = 'ARRAY' AND json_array_length(ts) > 0 THEN CAST(ts AS JSON[]) ELSE [NULL::JSON] END) AS tpl, unnest(CASE WHEN json_type(ts) = 'ARRAY' AND json_array_length(ts) > 0 THEN range(1, CAST(json_array_length(ts) + 1 AS BIGINT)) ELSE [0] END) AS tpl_pos FROM t)
SELECT DISTINCT page_id, rev_id, contributor, CAST(sec_pos AS INT) AS sec_pos, CAST(tpl_pos AS INT) AS tpl_pos, coalesce(tpl->>'$.name', '') AS tpl_name FROM u""",
    "p7_revisions": r"""
WITH pages AS (SELECT DISTINCT id, revision FROM json_page WHERE revision IS NOT NULL AND revision <> ''),
r AS (SELECT id AS page_id, unnest(CASE WHEN json_type(revision) = 'ARRAY' THEN CAST(revision AS JSON[]) ELSE [CAST(revision AS JSON)] END) AS v FROM pages)
SELECT DISTINCT page_id, CAST(v->>'$.id' AS BIGINT) AS rev_id, CAST(v->>'$.parentid' AS BIGINT) AS parent_id, v->>'$.timestamp' AS timestamp, coalesce(v->>'$.minor', 'false') <> 'false' AS minor, v->>'$.comment' AS comment,
CASE WHEN json_type(v->'$.contributor') = 'OBJECT' THEN coalesce(v->>'$.contributor.id', v->>'$.contributor.ip', '-') ELSE '-' END AS contributor FROM r""",
}
