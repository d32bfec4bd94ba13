"""Text that looks alike brought to one form, with a verdict on the scripts it mixes.

Each letter has the set of scripts in which a letter of its shape exists. The sets of a token's letters are
intersected: if a script is left, the token can be written wholly in it and is (the first of SCRIPTS if several are
left); if none is left the token mixes scripts for good and each letter takes its first script's form. A token whose
letters come from more than one script is a mixed-script confusable; one of a single script that is spelled in another
is a whole-script confusable. Before that, characters without a mark of their own are removed, spaces of all kinds
become one, and width and typographic variants their plain forms; after it, marks are composed. What a reader sees
stays: case, accents, hyphens and spaces.
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexweave.plans.runtime import HOT_SHARE, cut, skew_join

#: Letters of one shape; the script of each is the first word of its Unicode name.
SHAPES = """
aаɑα bᏏ cсϲⲥ dԁᏧꓒ eе gɡց hһհᏂ iіᎥ jјϳ lӏ nո oоοօⲟ pрρⲣ qԛ sѕ uυս vνѵ wԝ xх yу þϸ əәǝ ɛεԑ ĸкκⲕ æӕ ıι ʒӡ ɵө ʙв ʜн ᴍм ᴛт
AАΑᎪꓮ BВΒᏴꓐⲂ CСϹᏟꓚⲤ DᎠꓓ EЕΕᎬꓰ FϜꓝ GԌᏀꓖ HНΗᎻꓧⲎ IІΙӀꓲⲒ JЈͿᎫꓙ KКΚᏦꓗⲔ LᏞꓡ MМΜᎷꓟⲘ NΝꓠⲚ OОΟՕꓳⲞ PРΡᏢꓑⲢ QԚ RᏒꓣ SЅՏᏚꓢ
TТΤᎢꓔⲦ UՍꓴ VѴᏙꓦ WԜᎳꓪ XХΧꓫⲬ YҮΥꓬⲨ ZΖᏃꓜ ГΓⲄ ПΠⲠ ФΦ ÞϷ ƏӘƎ ÆӔ ƷӠ ƟӨ ɅΛ ƐԐ ƩΣ ĐÐƉ
"""
#: The scripts of these letters; a token that several are left for is written in the first of them.
SCRIPTS = ("latin", "cyrillic", "greek", "armenian", "coptic", "cherokee", "lisu")
#: Dashes that print as a hyphen, and the mark that prints as the closing quotation mark.
HYPHENS, APOSTROPHE = "‐‑﹣－−˗", "ʼ"
#: Compatibility variants that look like their plain form, by the tag in the Unicode data, and ranges of them that have
#: no tag of their own: ligatures, Roman numerals, digraphs, the micro sign.
_PLAIN = ("<wide>", "<narrow>", "<noBreak>", "<font>", "<initial>", "<medial>", "<final>", "<isolated>", "<small>")
_COMPAT = (range(0xFB00, 0xFB07), range(0x2160, 0x2180), range(0x132, 0x134), range(0x1C4, 0x1CD), range(0x1F1, 0x1F4), range(0xB5, 0xB6))


def _script(c: str) -> str:
    return unicodedata.name(c, "").split(" ")[0].lower()


#: Letter to {script: letter of the same shape}, and the scripts of letters met outside the table.
_SHAPE: dict[str, dict[str, str]] = {}
for _letters in SHAPES.split():
    _forms: dict[str, str] = {}
    for _c in _letters:
        _forms.setdefault(_script(_c), _c)
        _SHAPE[_c] = _forms


def _plain(c: str) -> str:
    kind = unicodedata.category(c)
    if kind in ("Cf", "Cc") and c not in "\t\n\r" or "\ufe00" <= c <= "\ufe0f" or c in "\u034f\u115f\u1160\u17b4\u17b5\u3164\uffa0":
        return ""
    if kind in ("Zs", "Zl", "Zp") or c in "\t\n\r":
        return " "
    if c in HYPHENS:
        return "-"
    if c == APOSTROPHE:
        return "’"
    tag = unicodedata.decomposition(c).split(" ")[0]
    if tag in _PLAIN or any(ord(c) in r for r in _COMPAT):
        return unicodedata.normalize("NFKC", c)
    return c


class _Plain(dict):
    def __missing__(self, n: int) -> str:
        self[n] = _plain(chr(n))
        return self[n]


class _Letters(dict):
    """Letter to (its own script, the scripts its shape exists in); None for what isn't a letter."""

    def __missing__(self, c: str) -> tuple[str, frozenset[str]] | None:
        self[c] = None
        if c in _SHAPE or unicodedata.category(c) in ("Ll", "Lu", "Lt", "Lo"):
            own = _script(c)
            self[c] = own, frozenset(_SHAPE.get(c, (own,)))
        return self[c]


_PLAIN_MAP = _Plain()
_LETTER = _Letters()
_ALL = frozenset(SCRIPTS)


def _token(t: str) -> tuple[str, str]:
    """``t``, decomposed, with every letter in the script the whole token can be written in; mixed, whole or ""."""
    if t.isascii():
        return t, ""
    left, own = _ALL, set()
    for c in t:
        if known := _LETTER[c]:
            own.add(known[0])
            left = left & known[1]
    to = next((s for s in SCRIPTS if s in left), None)
    out = "".join((f.get(to) or next(iter(f.values()))) if (f := _SHAPE.get(c)) else c for c in t)
    return out, "mixed" if len(own) > 1 else "whole" if out != t and to not in own else ""


def inspect(text: str) -> tuple[str, str]:
    """(form, verdict): one form for all spellings that look like ``text``, and how it differed from it.

    The verdict is ``mixed`` if a token's letters are of several scripts, else ``whole`` if a token of one script is
    spelled in another, else ``variant`` if something else is not as in the form, else ``plain``.
    """
    if text.isascii() and text.isprintable():
        form = text.strip(" ")
        return form, "plain" if form == text else "variant"
    t = unicodedata.normalize("NFD", text.translate(_PLAIN_MAP))
    said, words = set(), []
    for w in t.split(" "):
        parts = [_token(p) for p in w.split("-")] if "-" in w else [_token(w)]
        words.append("-".join(p for p, _ in parts))
        said.update(v for _, v in parts)
    form = unicodedata.normalize("NFC", " ".join(words)).strip(" ")
    return form, "mixed" if "mixed" in said else "whole" if "whole" in said else "plain" if form == text else "variant"


def canonical(text: str) -> str:
    """The form alone. The function is idempotent."""
    return inspect(text)[0]


@lru_cache(100_000)
def _remembered(text: str) -> tuple[str, str]:
    return inspect(text)


_FORM = T.StructType([T.StructField("form", T.StringType()), T.StructField("verdict", T.StringType())])


@F.arrow_udf(_FORM)
def _inspect(text: pa.Array) -> pa.Array:
    rows = [(None, None) if t is None else inspect(t) if len(t) > 100 else _remembered(t) for t in text.to_pylist()]
    return pa.StructArray.from_arrays([pa.array([r[k] for r in rows], pa.string()) for k in (0, 1)], ["form", "verdict"])


def with_form(df: DataFrame, text: str) -> DataFrame:
    """``df`` with ``form`` and ``verdict`` of a column. Printable ASCII is settled in the JVM and not sent to Python."""
    bare = F.trim(text)
    ascii_ = F.col(text).rlike(r"^[ -~]*$")
    made = df.withColumn("_made", _inspect(F.when(~ascii_, F.col(text))))
    form = F.when(ascii_, bare).otherwise(F.col("_made.form"))
    verdict = F.when(ascii_, F.when(bare == F.col(text), "plain").otherwise("variant")).otherwise(F.col("_made.verdict"))
    return made.withColumn("form", form).withColumn("verdict", verdict).drop("_made")


#: Rows of one spelling that are paired in one piece, at least; a spelling with more than HOT_SHARE of all is cut.
PIECE = 10_000


def alike_pairs(df: DataFrame, key: Column, within: Column, text: Column, order: Column) -> DataFrame:
    """(within, key_a, key_b): rows of one ``within`` whose texts differ but look alike; key_a is first by ``order``.

    Null keys, groups and texts make no pair, nor do equal texts. Repeated rows count once. Spellings are paired first
    and rows after, so that copies of one spelling never meet; the rows of a spelling are cut into pieces, so that a hot
    one is many tasks' work. Each pair of rows of different spellings is one row.
    """
    rows = df.select(key.alias("k"), order.alias("o"), within.alias("g"), text.alias("t")).where("k is not null and g is not null and t is not null").distinct()
    rows = cut(with_form(rows, "t").select("k", "o", "g", "t", F.col("form").alias("c")))
    classes = rows.groupBy("g", "c").agg(F.min("t").alias("t0"), F.max("t").alias("t1")).where("t0 <> t1").select("g", "c")
    some = cut(skew_join(rows, classes, ["g", "c"], rows.count(), "left_semi"))
    size = max(PIECE, int(some.count() * HOT_SHARE))
    spelled = some.groupBy("g", "c", "t").agg(F.ceil(F.count("*") / size).cast("int").alias("n"))
    hot = F.broadcast(spelled.where("n > 1").select("g", "t", "n"))
    rows = some.join(hot, ["g", "t"], "left").select("g", "t", "k", "o", F.pmod(F.xxhash64("k"), F.coalesce("n", F.lit(1))).cast("int").alias("piece"))
    side = lambda df, x: df.select(*(F.col(c) if c in "gc" else F.col(c).alias(c + x) for c in df.columns))
    pairs = side(spelled, "a").join(side(spelled, "b"), ["g", "c"]).where("ta < tb")
    parts = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    pairs = cut(pairs.withColumn("piecea", parts("na")).withColumn("pieceb", parts("nb")).select("g", "ta", "piecea", "tb", "pieceb"))
    a = pairs.join(side(rows, "a"), ["g", "ta", "piecea"])
    b = pairs.join(side(rows, "b"), ["g", "tb", "pieceb"])
    both = a.join(b, ["g", "ta", "piecea", "tb", "pieceb"])
    first = F.col("oa") < F.col("ob")
    return both.where("ka <> kb").select(F.col("g").alias("within"), F.when(first, F.col("ka")).otherwise(F.col("kb")).alias("key_a"), F.when(first, F.col("kb")).otherwise(F.col("ka")).alias("key_b")).distinct()


def alike_classes(df: DataFrame, key: Column, within: Column, text: Column) -> DataFrame:
    """(key, form, verdict, n_spellings): every row with its form, how it differs from it, and the number of spellings of
    that form in the group. Null keys and texts are left out; rows without a group are a group of their own."""
    rows = df.select(key.alias("key"), within.alias("g"), text.alias("t")).where("key is not null and t is not null").distinct()
    rows = cut(with_form(rows, "t"))
    n = rows.groupBy(F.col("g").alias("g2"), F.col("form").alias("form2")).agg(F.count_distinct("t").alias("n_spellings"))
    return rows.join(n, F.col("g").eqNullSafe(F.col("g2")) & (F.col("form") == F.col("form2"))).select("key", "form", "verdict", "n_spellings")
