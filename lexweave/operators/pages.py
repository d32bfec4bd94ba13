"""Pages of wiki text as tables: language entries, lexemes with glosses and sounds, relations, templates by section."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexweave.functions import entries as N
from lexweave.functions import extractors as X
from lexweave.functions import prose
from lexweave.functions.wikitext import arguments, sections, templates

#: As many names of languages are sent to the executors; a table of more isn't one of languages.
MOST_NAMES = 200_000
_ARROW = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string(), "boolean": pa.bool_(), "array<string>": pa.list_(pa.string()), "array<array<string>>": pa.list_(pa.list_(pa.string()))}


def flat_map(df: DataFrame, key: Column, title: Column, text: Column, schema: str, rows: Callable[[str, str], Iterator[tuple]]) -> DataFrame:
    """``rows`` (title, text) of every row with a key and a text, after its key; ``schema`` has (rec_key, ...)."""
    cols = [c.rsplit(" ", 1) for c in schema.split(", ")]
    names, types = [c[0] for c in cols], [_ARROW[c[1]] for c in cols]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = [(k, *r) for k, ti, te in zip(*(b.column(i).to_pylist() for i in range(3))) for r in rows(ti or "", te)]
            cols = list(zip(*out)) if out else [[] for _ in names]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names)

    return df.select(key.cast("bigint").alias("k"), title.alias("ti"), text.alias("te")).where("k is not null and te is not null").mapInArrow(run, schema)


def language_names(names: DataFrame) -> dict[str, str]:
    """Name to code of (name, code), to be sent to the executors; the smallest code where several bear a name."""
    found = names.where("name is not null and code is not null").groupBy("name").agg(F.min("code").alias("code")).limit(MOST_NAMES + 1).collect()
    if len(found) > MOST_NAMES:
        raise ValueError(f"more than {MOST_NAMES} names of languages")
    return {r.name: r.code for r in found}


EDGES = "rec_key bigint, sec_pos int, place int, src_kind string, src_term string, src_language string, src_sense int, tgt_kind string, tgt_term string, tgt_language string, tgt_sense int, type string, uncertain boolean, text string, mechanism string, id string, pos string, t string"


def collect_relations(df: DataFrame, key: Column, title: Column, text: Column, codes: dict[str, str], extractors: tuple[str, ...] | None = None) -> DataFrame:
    """The relations of all sections of each page, in order (sec_pos, place), by the extractors named or all.

    id, pos and t are what the template says of the linked word. Null and empty texts give no rows; repeated rows come
    out repeated.
    """
    vocabulary, registry = prose.Vocabulary(tuple(sorted(codes))), dict(X.REGISTRY)  # as it is now, with what was added here

    def rows(title: str, text: str) -> Iterator[tuple]:
        for i, k, e in X.collect(title, sections(text), codes, vocabulary, extractors, registry):
            linked = dict(e.src.extra or e.tgt.extra)
            yield (i, k, *(getattr(w, a) for w in (e.src, e.tgt) for a in ("kind", "term", "language", "sense_idx")), e.type, e.uncertain, e.text, e.mechanism, *(linked.get(a) for a in ("id", "pos", "t")))

    return flat_map(df, key, title, text, EDGES, rows)


def rule_counts(df: DataFrame, key: Column, text: Column, codes: dict[str, str]) -> DataFrame:
    """(rec_key, rule, n): how often each rule was used on a text of prose."""
    vocabulary = prose.Vocabulary(tuple(sorted(codes)))

    def rows(_: str, text: str) -> Iterator[tuple]:
        count: Counter = Counter()
        prose.chain(text, vocabulary, count)
        yield from count.items()

    return flat_map(df, key, F.lit(""), text, "rec_key bigint, rule string, n int", rows)


def language_entries(df: DataFrame, key: Column, title: Column, text: Column) -> DataFrame:
    """(rec_key, entry_pos, language, sections, texts, etym_count): one row per language of a page."""

    def rows(_: str, text: str) -> Iterator[tuple]:
        for i, (lang, paths, texts) in enumerate(N.language_entries(text), 1):
            yield i, lang, paths, texts, N.count_etymologies([[lang, *p] for p in paths])

    return flat_map(df, key, title, text, "rec_key bigint, entry_pos int, language string, sections array<array<string>>, texts array<string>, etym_count int", rows)


def _lexemes(text: str) -> Iterator[tuple[str, N.Lexeme]]:
    for lang, paths, texts in N.language_entries(text):
        for x in N.lexemes(paths, texts):
            yield lang, x


def lexemes(df: DataFrame, key: Column, title: Column, text: Column) -> DataFrame:
    """(rec_key, term, language, sense_idx, etymid, n_glosses, n_pronunciations, etymology)."""

    def rows(title: str, text: str) -> Iterator[tuple]:
        for lang, x in _lexemes(text):
            yield title, lang, x.sense_idx, x.etymid, len(x.glosses), len(x.pronunciations), x.etymology

    return flat_map(df, key, title, text, "rec_key bigint, term string, language string, sense_idx int, etymid string, n_glosses int, n_pronunciations int, etymology string", rows)


def glosses(df: DataFrame, key: Column, title: Column, text: Column) -> DataFrame:
    """(rec_key, term, language, sense_idx, place, pos, text, id, labels, links)."""

    def rows(title: str, text: str) -> Iterator[tuple]:
        for lang, x in _lexemes(text):
            for k, g in enumerate(x.glosses, 1):
                yield title, lang, x.sense_idx, k, g.pos, g.text, g.id, g.labels, g.links

    return flat_map(df, key, title, text, "rec_key bigint, term string, language string, sense_idx int, place int, pos string, text string, id string, labels array<string>, links array<string>", rows)


def pronunciations(df: DataFrame, key: Column, title: Column, text: Column) -> DataFrame:
    """(rec_key, term, language, sense_idx, ipa, accent, kind)."""

    def rows(title: str, text: str) -> Iterator[tuple]:
        for lang, x in _lexemes(text):
            for ipa, accent, kind in x.pronunciations:
                yield title, lang, x.sense_idx, ipa, accent, kind

    return flat_map(df, key, title, text, "rec_key bigint, term string, language string, sense_idx int, ipa string, accent string, kind string", rows)


def section_templates(df: DataFrame, key: Column, text: Column, names: frozenset[str] = frozenset(), context: int = 0) -> DataFrame:
    """(rec_key, sec_pos, path, section, place, name, context): the outermost templates of all sections (of ``names`` only,
    if given), with ``context`` characters around, and the plain links outside them under the name WIKILINK.

    ``section`` is the last heading without its number.
    """

    def rows(_: str, text: str) -> Iterator[tuple]:
        for i, (path, body) in enumerate(sections(text), 1):
            head = path[-1].rstrip("0123456789 ")
            for k, (a, b, inside) in enumerate(templates(body), 1):
                name = arguments(inside)[0]
                if not names or name in names:
                    yield i, path, head, k, name, body[max(0, a - context) : b + context] if context else None
            if not names or "WIKILINK" in names:
                for _ in range(N.without_templates(body).count("[[")):
                    yield i, path, head, 0, "WIKILINK", None

    return flat_map(df, key, F.lit(""), text, "rec_key bigint, sec_pos int, path array<string>, section string, place int, name string, context string", rows)


def section_texts(df: DataFrame, key: Column, text: Column, headings: str = ".*", subsections: bool = False, whole_path: bool = False) -> DataFrame:
    """(rec_key, sec_pos, path, text): sections whose last heading begins with ``headings`` (some heading, with
    ``whole_path``), and with ``subsections`` all below such a heading. The text is as written."""
    import re

    rx = re.compile(headings)

    def rows(_: str, text: str) -> Iterator[tuple]:
        for i, (path, body) in enumerate(sections(text), 1):
            if any(rx.match(h) for h in (path if subsections or whole_path else path[-1:])):
                yield i, path, body

    return flat_map(df, key, F.lit(""), text, "rec_key bigint, sec_pos int, path array<string>, text string", rows)


def plain_texts(df: DataFrame, key: Column, text: Column) -> DataFrame:
    """(rec_key, sec_pos, plain): each section as plain text."""

    def rows(_: str, text: str) -> Iterator[tuple]:
        for i, (_, body) in enumerate(sections(text), 1):
            yield i, N.plain_text(body)

    return flat_map(df, key, F.lit(""), text, "rec_key bigint, sec_pos int, plain string", rows)
