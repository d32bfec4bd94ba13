"""The lexeme or entity a link means: defaults, languages, spelling, and the choice among homonyms by id, part of speech
and gloss."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexweave.operators import languages as L
from lexweave.operators.glosses import tversky, words
from lexweave.plans.runtime import cut, salted_join, skew_join

#: Values a mention that names a language by its code, or none on purpose, has as the language.
NO_LANGUAGE = "-"


def lexicon_index(lexemes: DataFrame) -> DataFrame:
    """(term, language, n_senses, single): how many senses a word has in its language; ``single`` where one alone, so that a
    stub of it can stand for the entry. Repeated rows count once, null terms are left out; a null sense is sense 0."""
    n = lexemes.where("term is not null").groupBy("term", "language").agg(F.count_distinct(F.coalesce("sense_idx", F.lit(0))).alias("n_senses"))
    return n.withColumn("single", F.col("n_senses") == 1)


def resolve_sections(sections: DataFrame) -> DataFrame:
    """(rec_key, sec_pos, sense_idx): the sense a section belongs to.

    ``sections`` has rec_key, sec_pos, path. The number of the etymology heading on the path less one; else that of the last
    etymology heading before it in its language; else 0. Sections of a page are looked through in order within the page.
    """
    from pyspark.sql import Window

    own = F.try_element_at(F.filter("path", lambda h: h.rlike(r"^\s*Etym\D*\d*\s*$")), F.lit(1))
    number = F.coalesce(F.nullif(F.regexp_extract(own, r"(\d+)\s*$", 1), F.lit("")).cast("int"), F.when(own.isNotNull(), 1)) - 1
    w = Window.partitionBy("rec_key", F.try_element_at("path", F.lit(1))).orderBy("sec_pos").rowsBetween(Window.unboundedPreceding, 0)
    return sections.select("rec_key", "sec_pos", F.greatest(F.coalesce(F.last(number, True).over(w), F.lit(0)), F.lit(0)).alias("sense_idx"))


def with_defaults(mentions: DataFrame, langs: DataFrame, near_term: str = "near_term", near_language: str = "near_language") -> DataFrame:
    """Mentions with ``term`` and ``language`` filled in and brought to the spelling of lookup.

    A missing term or language is that of the word the mention is related to. An anchor that is the canonical name of a
    language names the language. Languages that only occur in etymologies stand for their parent. Mentions of language
    "-", and terms in other name spaces (a prefix before a colon), mean no lexeme and are left out.
    """
    m = mentions.withColumn("term", F.coalesce(F.nullif("term", F.lit("")), near_term))
    m = m.where("term is not null and term not rlike '^:?(?:Image|File|Category|Appendix|Thesaurus|Wikipedia|w|q|s):'")
    named = langs.groupBy(F.col("name").alias("anchor")).agg(F.min("code").alias("_named"))
    m = cut(m)
    n = m.count()
    m = skew_join(m, named, "anchor", n).withColumn("language", F.coalesce("_named", F.nullif("language", F.lit("")), near_language)).drop("_named")
    parent = L.parent_code(langs, langs.select(F.col("family").alias("code")).limit(0)).select("code", "parent_code")
    parent = parent.join(langs.where("type = 'etym-only'").select("code"), "code", "left_semi").select(F.col("code").alias("language"), "parent_code")
    m = skew_join(cut(m.where(F.col("language").isNull() | (F.col("language") != NO_LANGUAGE))), parent, "language", n)
    m = m.withColumn("language", F.coalesce("parent_code", "language")).drop("parent_code")
    return L.normalized(m, langs).withColumn("term", F.col("normalized")).drop("normalized")


def choose_homonyms(mentions: DataFrame, lexemes: DataFrame) -> DataFrame:
    """(mention, node_id, how): the lexeme each mention means.

    ``mentions`` has mention (unique), term, language and may say id, pos, t; ``lexemes`` has node_id, term, language,
    sense_idx, etymid, pos, gloss. The word's only lexeme; else the one whose id is said (none if that fails: the mention
    then means no lexeme here); else the only one of the part of speech; else the best gloss by overlap of words, above 0,
    of those of the part of speech or all; else the first sense. A word that the lexicon lacks has a null node_id.
    """
    x = lexemes.where("term is not null").select("node_id", "term", F.coalesce("language", F.lit("")).alias("language"), F.coalesce("sense_idx", F.lit(0)).alias("sense_idx"), "etymid", F.col("pos").alias("xpos"), F.col("gloss").alias("xgloss")).distinct()
    m = cut(mentions.select("mention", "term", F.coalesce("language", F.lit("")).alias("language"), F.nullif("id", F.lit("")).alias("id"), F.nullif("pos", F.lit("")).alias("pos"), F.nullif("t", F.lit("")).alias("t")))
    key = F.struct("term", "language")
    j = cut(salted_join(m.withColumn("_k", key), x.withColumn("_k", key).drop("term", "language"), "_k", m.count(), "left").drop("_k"))
    same_pos = F.col("pos").isNotNull() & (F.col("pos") == F.col("xpos"))
    score = F.when(F.col("t").isNotNull() & F.col("xgloss").isNotNull(), tversky(words(F.col("t")), words(F.col("xgloss")))).otherwise(0.0)
    j = j.withColumn("same", F.coalesce(same_pos, F.lit(False))).withColumn("hit", F.coalesce(F.col("id") == F.col("etymid"), F.lit(False))).withColumn("score", score)
    first = lambda c: F.min(F.when(c, F.struct("sense_idx", "node_id")))["node_id"]
    best = lambda c: F.min(F.when(c & (F.col("score") > 0), F.struct((-F.col("score")).alias("s"), "sense_idx", "node_id")))["node_id"]
    any_ = F.col("node_id").isNotNull()
    a = j.groupBy("mention").agg(
        F.count_if(any_).alias("n"), F.first("id").alias("id"), first(any_).alias("first"), first(F.col("hit")).alias("by_id"),
        F.count_if("same").alias("n_same"), first(F.col("same")).alias("by_pos"), best(any_).alias("by_gloss"), best(F.col("same")).alias("by_gloss_of_pos"),
    )
    how = F.when(F.col("n") == 0, "unknown").when(F.col("n") == 1, "single").when(F.col("id").isNotNull(), F.when(F.col("by_id").isNotNull(), "id").otherwise("id fails")).when(F.col("n_same") == 1, "pos")
    how = how.when(F.coalesce("by_gloss_of_pos", F.when(F.col("n_same") == 0, F.col("by_gloss"))).isNotNull(), "gloss").otherwise("first")
    node = F.when(how.isin("single", "first"), F.coalesce(F.when(how == "first", F.col("by_pos")), F.col("first"))).when(how == "id", F.col("by_id")).when(how == "pos", F.col("by_pos")).when(how == "gloss", F.coalesce("by_gloss_of_pos", "by_gloss"))
    return a.select("mention", node.alias("node_id"), how.alias("how"))


_FACTS = ("born", "died", "nat", "wplink")
_ENTITY = "name string, born string, died string, nat string, wplink string, occ string, entity int"


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Entities of each name, whose mentions come one after the other in order."""
    name, known = None, []

    def done() -> list[dict]:
        return [{"name": name, **{f: e[f] for f in _FACTS}, "occ": "; ".join(e["occ"]) or None, "entity": k} for k, e in enumerate(known)]

    schema = pa.schema([("name", pa.string()), *((f, pa.string()) for f in _FACTS), ("occ", pa.string()), ("entity", pa.int32())])
    for b in batches:
        out = []
        for r in b.to_pylist():
            if r["name"] != name:
                out += done()
                name, known = r["name"], []
            e = next((e for e in known if all(not r[f] or not e[f] or r[f] == e[f] for f in _FACTS)), None)
            if e is None:
                e = dict.fromkeys(_FACTS) | {"occ": []}
                known.append(e)
            e.update({f: e[f] or r[f] for f in _FACTS})
            e["occ"] += [o for o in r["occ"] if o not in e["occ"]]
        if out:
            yield pa.RecordBatch.from_pylist(out, schema)
    if known:
        yield pa.RecordBatch.from_pylist(done(), schema)


def merge_entities(mentions: DataFrame) -> DataFrame:
    """(name, born, died, nat, wplink, occ, entity): the entities that mentions of persons and the like mean.

    ``mentions`` has ord, name, born, died, nat, occ, wplink. In the order of ord, a mention joins the first entity of its
    name with which no stated fact conflicts, and adds its facts; occupations are strung together. Mentions that agree in
    all facts are one before that, so a frequent name is as many rows as it has different facts. Empty values state
    nothing; mentions without a name are left out.
    """
    say = lambda c: F.nullif(F.trim(c), F.lit("")).alias(c)
    m = mentions.select("ord", *(say(c) for c in ("name", "born", "died", "nat", "wplink", "occ"))).where("name is not null")
    m = m.groupBy("name", "born", "died", "nat", "wplink", "occ").agg(F.min("ord").alias("ord"))
    m = m.groupBy("name", "born", "died", "nat", "wplink").agg(F.min("ord").alias("ord"), F.transform(F.array_sort(F.collect_list(F.when(F.col("occ").isNotNull(), F.struct("ord", "occ")))), lambda x: x["occ"]).alias("occ"))
    order = ["name", "ord", *_FACTS]
    return m.repartition("name").sortWithinPartitions(*order).mapInArrow(_merged, _ENTITY)
