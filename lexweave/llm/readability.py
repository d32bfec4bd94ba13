"""Reading level of a document: the median of five grade scales.

Sentences end at . ! or ? before white space, as in the published scales. Syllables are counted by hyphenation-style rules: groups of vowels, with
patterns that join or part them. The scales are for English; whether a document is English is told from its function
words, whatever it is labelled.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from statistics import fmean, median

import pyarrow as pa
from pyspark.sql import Column, DataFrame

#: Function words of which no other of these languages has one.
FUNCTION_WORDS = {
    "en": "the of and to is was that it for with as by from this but not be are were which their its have has had they you we his her".split(),
    "de": "der die das und ist von zu den dem mit nicht ein eine auch auf für im sich wird wurde aus bei als".split(),
    "fr": "le la les des et un une du est dans que qui pour sur au pas ne se plus mais ou il elle sont par vient".split(),
    "es": "el los las y del en que se por con una su para al lo como más pero fue ya es sus era".split(),
    "la": "et in est ad non cum ex quod qui ut sed ab per sunt enim quae hoc autem nec vel atque apud".split(),
    "it": "il di che e la un una per non sono della con del gli nel alla dei".split(),
    "nl": "de het een en van is dat niet op te zijn voor met aan er ook door uit".split(),
}
_OF: dict[str, tuple[str, ...]] = {}
for _lang, _words in FUNCTION_WORDS.items():
    for _w in _words:
        _OF[_w] = (*_OF.get(_w, ()), _lang)
#: At least this share of a document's words must be English function words, and more than of any other language.
ENGLISH = 0.06

_WORD = re.compile(r"[^\W\d_]+(?:['’\-][^\W\d_]+)*")
_END = re.compile(r"[.!?…]+[\"'”’)\]]*(?=\s|$)")
_VOWELS = re.compile(r"[aeiouyà-æè-ïò-öù-ýœ]+")
_V, _C = "[aeiouy]", "[^aeiouy]"
#: Spellings, as in hyphenation patterns, in which vowels belong to two syllables (parted by "-") or an e is
#: silent (left out), as (pattern, replacement), applied in order; what no pattern parts is one syllable.
_PATTERNS = [(re.compile(p), r) for p, r in (
    # y before a vowel is a consonant, but not in -ying and after a leading consonant
    (rf"({_C})yi", r"\1y-i"), (rf"^({_C}+)y(?=[aeou])", r"\1y-"), (r"(?<=[aeiou])y(?=[aeiou])", "j"), (r"^y(?=[aeiou])", "j"), (rf"(?<={_C})y(?=[aeou])", "j"),
    # silent u
    (r"qu", "q"), (r"gu(?=[aei][^\W])", "g"), (r"g?ues?$", lambda m: "g" if m[0][0] == "g" else m[0]), (r"suad|suav", "swad"), (r"qes?$", "q"),
    # an e that only closes the part before it
    (r"^(some|there|where|here|fore|home|make|take|like|more|care|fire|life|wide|ware|side|name|note|time|line|base|house|horse|drive|trade|state|safe|grave|white|bride|stone|score|store|fare|vine)(?=[^aeiouyrsdl\W]|s[^\W]|l[aeiouy])", lambda m: m[1][:-1]),
    (rf"(?<={_V}{_C})(?<!^el)e(?=(?:ful|less|ness|ments?|ly|li(?=ness|hood)|thing|where|times?|work|fore|hood|ship|side|land|ways?|man|men|room)(?:ly|ness|s|es|ally)?$)", ""), (r"(?<=[aeiouy][^aeiouylrw][^aeiouylrw])e(?=(?:ful|less|ness|ments?|ly)(?:ly|ness)?$)", ""),
    (r"(?<=[^aeiouyt])e(?=ty$)", ""), (r"(?<=[fn])e(?=ty$)", ""),
    (r"(?<=troph|recip|simil|pitom|yncop|pocop|cdoch|erbol|astol)e(?=s?$)", "i"), (r"(?<=med)ie(?=v)", "i-e"),
    # endings: -ed, -es and -e; a consonant with l or r keeps its e
    (rf"(?<={_C}[lr])ed$", "id"), (r"(?<=[^aeiouytd])ed$", "d"), (r"(?<=[aeiouy])ed$", "d"), (r"(?<=[aeiou][lr])es$", "s"), (rf"(?<=[^aeiouylr\W])les?$", "il"), (rf"(?<={_C})res?$", "ir"),
    (r"(?<=[scgxz])es$", "is"), (r"(?<=[sc]h)es$", "is"), (rf"(?<={_V})es$", "s"), (rf"(?<={_C})es$", "s"), (rf"(?<={_C})e$", ""),
    # i before a vowel: one syllable after c, t, s, g and in -lli-, -ni-; two elsewhere
    (r"([ct])i(?=a(?:t|bl|s)|o[ln]?log)", r"\1i-"), (r"(?<!s)([ct])i(?=en|a|ou)|(n)i(?=en)", r"\1\2"), (r"([ctsxg])i(?=on|ous)", r"\1"), (r"s(s?)i(?=an\b|ans\b|a\b)", r"s\1"), (r"(ll|n)i(?=ons?\b|ona|ar|ant|or)", r"\1"), (r"(?<=[rv])iag", "ig"), (r"li(?=ament|ars?$|arit)", "l"),
    (r"vior", "vjor"), (r"i(?=[aou])(?!ou?$)", "i-"), (r"i(?=o$|os$|ou)", "i-"), (r"i(?=e(?:t|nc|nt|r$|rs$|st$|ty))(?<!fi)(?<!^pi)(?<!^ti)(?<!shi)(?<!fri)(?<!nti)(?<!ldi)", "i-"), (r"(?<=f)i(?=er$|est$)", "i-"), (r"(?<=[fl]i)(?=e(?:nc|nt|ty))", "-"), (r"ii", "i-i"),
    # e before a vowel
    (r"([gc])eou", r"\1ou"), (r"(?<=[gch])eo(?=ns?$)", "o"), (r"(?<=p)eo(?=p[li])|(?<=[lj])eo(?=pard)", "e"), (r"e(?=ou|o)", "e-"), (r"(?<=cr)ea(?=t(?!u))|(?<=r)ea(?=ct|lit|lis|liz|ll?oc|dj)|(?<=ar)ea|(?<=id)ea|(?<=lin)ea(?=r)|(?<=nucl)ea(?=r)|(?<=th)ea(?=t|tr)|(?<=pan[ac])ea", "e-a"),
    (r"(?<=c)ea(?=n(?:s|ic)?$)", "a"), (r"e(?=ing|um|us$)", "e-"), (r"ee(?=[aiou])", "e-"), (r"(?<=^r)e(?=e[nmstlv]|i[nmt])|(?<=pr)e(?=e[mx]|i)", "e-"),
    # other pairs
    (r"a(?=ic|o|ist|ism)", "a-"), (r"o(?=ing|ic|ist|ism|ed?ie|em|et$|ets|et[ri])(?!ing?t)", "o-"), (r"(?<=^c)o(?=op|ord|in[c]|ex|au)|(?<=z)o(?=olog)", "o-"), (r"u(?=a|ou|o|el|en[ct]|ity|itou|ition|itive|um)", "u-"), (r"(?<=[fr]l)u(?=i)|(?<=r)u(?=in)|(?<=s)u(?=ici)|(?<=en)u(?=i)|(?<=tr)u(?=is)", "u-"),
    # a nasal or liquid as a syllable
    (r"([st]h?)ms?$", r"\1im"),
)]


def syllables(word: str) -> int:
    """At least 1 for any word; the parts of a hyphenated word are counted apart."""
    if "-" in word:
        return sum(syllables(p) for p in word.split("-") if p)
    w = word.lower().replace("’", "'").split("'")[0] or word.lower()
    if len(w) > 2:
        for rx, to in _PATTERNS:
            w = rx.sub(to, w)
    return max(1, len(_VOWELS.findall(w)))


class _Syllables(dict):
    """Counts by word; emptied before it grows large."""

    def __missing__(self, w: str) -> int:
        if len(self) > 200_000:
            self.clear()
        self[w] = n = syllables(w)
        return n


_COUNT = _Syllables()


def grades(text: str) -> tuple[dict[str, float], int, int, str | None]:
    """(grade by scale, words, sentences, language or None)."""
    words = _WORD.findall(text)
    n = len(words)
    if not n:
        return {}, 0, 0, None
    s = max(1, len(_END.findall(text.strip())))
    syl = [_COUNT[w] for w in words]
    total, hard = sum(syl), sum(k >= 3 for k in syl)
    letters = sum(map(len, words))
    hits = dict.fromkeys(FUNCTION_WORDS, 0)
    for w in words:
        for lang in _OF.get(w if w.islower() else w.lower(), ()):
            hits[lang] += 1
    best = max(hits, key=hits.get)
    per = n / s
    return {
        "flesch_kincaid": 0.39 * per + 11.8 * total / n - 15.59,
        "fog": 0.4 * (per + 100 * hard / n),
        "smog": 1.043 * (30 * hard / s) ** 0.5 + 3.1291,
        "automated": 4.71 * letters / n + 0.5 * per - 21.43,
        "coleman_liau": 5.88 * letters / n - 29.6 / per - 15.8,
    }, n, s, best if hits[best] >= ENGLISH * n else None


def reading_levels(df: DataFrame, key: Column, text: Column) -> DataFrame:
    """(doc_id, language, n_words, n_sentences, grade, mean_grade): grade is the median of the scales, over the whole text.

    Both grades are null for a text that is null or has no words, as are the language and, without a text, the counts; the language is
    null too where no function words tell it. Repeated rows come out repeated; each row stands alone, so the plan has no
    shuffle.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for t in b.column(1):
                t = t.as_py()
                if t is None:
                    rows.append((None, None, None, None, None))
                    continue
                g, n, s, lang = grades(t)
                rows.append((lang, n, s, median(g.values()) if g else None, fmean(g.values()) if g else None))
            cols = list(zip(*rows)) or [[], [], [], [], []]
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, k) for c, k in zip(cols, (pa.string(), pa.int64(), pa.int64(), pa.float64(), pa.float64())))], ["doc_id", "language", "n_words", "n_sentences", "grade", "mean_grade"])

    return df.select(key.cast("bigint").alias("doc_id"), text.alias("t")).mapInArrow(run, "doc_id bigint, language string, n_words bigint, n_sentences bigint, grade double, mean_grade double")
