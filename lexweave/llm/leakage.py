"""Evaluation passages inside a corpus, by template windows.

Both sides are folded (case, punctuation, spacing, marks and character forms) by the same rules, and numbers, names (a
capital inside a sentence) and units after numbers become typed placeholders, which turns a text into a template. Every
run of a few template words is a hashed window; where it holds a placeholder, the run of the very words is one more, so
that a copy in other letter case is met too. Windows of items and documents are hash-joined. The hits of one item and
document are lined up: hits on nearby diagonals (document position minus item position) form a run, along which words
are compared. A slot filled in two different ways isn't the item's slot. The passage is the best run, or the best two
runs in order, as a copied passage may be interrupted once.

Items of up to BLOCK_CHARS characters are broadcast as a hash table that every document probes where it is read, so the
corpus isn't shuffled. Beyond, the windows are joined by a shuffle: a bitmap of fixed size keeps the windows that no item
has at home, hot windows are dealt to several tasks, and the texts of the pairs found are joined to them for comparison.
"""

from __future__ import annotations

import re
import unicodedata
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexweave.llm.lookalike import SCRIPTS, _SHAPE, _plain
from lexweave.plans.runtime import cut, salted_join, skew_join

#: Words in a window, and windows of an item that a document must hold before they are compared. Items so short that a
#: third of their words has fewer windows get shorter windows and need fewer hits (``window`` and ``hits``).
WINDOW, LEAST_HITS = 5, 3
#: Items of fewer words hold nothing that could be told from chance.
SHORTEST = 3
#: Diagonals that lie so close belong to one run: a word put in or left out shifts what follows.
DRIFT = 3
#: A place counts only where at least DENSE of the SPAN places around it agree as templates.
SPAN, DENSE = 7, 4
#: Up to so many characters of items are broadcast.
BLOCK_CHARS = 4_000_000
#: Bits of the map that tells which windows some item may have.
BITS = 1 << 24
#: Units of measure.
UNITS = frozenset("mm cm m km in ft yd mi mg g kg t lb oz ml l s sec min h hr hrs day days week weeks month months year years century centuries percent miles metres meters feet inches pounds dollars euros".split())

_TOKEN = re.compile(r"[^\W_]+|[.!?]+")


def window(n_words: int) -> int:
    """Words in a window of an item of so many words: no more than a third of them."""
    return min(WINDOW, max(SHORTEST, -(-n_words // 3)))


def hits(n_words: int) -> int:
    """Windows that a third of an item's words has, LEAST_HITS at most."""
    return min(LEAST_HITS, max(1, -(-n_words // 3) - window(n_words) + 1))


class _Fold(dict):
    def __missing__(self, n: int) -> str:
        c = _plain(chr(n))
        out = []
        for x in unicodedata.normalize("NFKD", c):
            x = next((_SHAPE[x][s] for s in SCRIPTS if s in _SHAPE[x]), x) if x in _SHAPE else x
            if not unicodedata.combining(x):
                out.append(x)
        self[n] = "".join(out)
        return self[n]


_FOLD = _Fold()


def fold(text: str) -> str:
    """Plain characters without marks; letter case is kept."""
    return text if text.isascii() else text.translate(_FOLD)


def _number(word: str) -> int:
    return xxhash.xxh3_64_intdigest(word.lower()) >> 6


class _Codes(dict):
    """Token to the number of its lower-case form, three bits up; below, 1 is a capital, 2 a number, 3 the end of a sentence,
    and 4 is added for a unit."""

    def __missing__(self, w: str) -> int:
        if len(self) > 300_000:
            self.clear()
        flag = 3 if w[0] in ".!?" else 2 if w.isdigit() else 1 if w[0].isupper() else 0
        self[w] = code = _number(w) << 3 | (w.lower() in UNITS) << 2 | flag
        return code


_CODES = _Codes()
#: Template numbers below this are placeholders: 1 number, 2 name, 3 unit.
_SLOTS = 16


def read(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(word numbers, template numbers) of a text; items and documents are read alike."""
    code = np.array([_CODES[w] for w in _TOKEN.findall(fold(text))], np.int64)
    flag, values = code & 3, code >> 3
    mark = flag == 3
    inside = np.r_[False, ~mark[:-1]]
    templates = np.where(flag == 2, 1, np.where((flag == 1) & inside, 2, values + _SLOTS))
    keep = ~mark
    values, templates, unit = values[keep], templates[keep], code[keep] & 4 > 0
    templates[1:][(templates[:-1] == 1) & unit[1:]] = 3
    return values, templates


def _hash(words: np.ndarray, size: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = np.full(len(words) - size + 1, size, np.uint64)
        for k in range(size):
            h = h * np.uint64(0x9E3779B97F4A7C15) + words[k : k + len(h)].astype(np.uint64) + np.uint64(0x7F4A7C15)
            h ^= h >> np.uint64(29)
    return (h >> np.uint64(1)).astype(np.int64)


def windows(values: np.ndarray, templates: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, places): each window as a template, and by its very words where those differ."""
    if len(values) < size:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    h = _hash(templates, size)
    places = np.arange(len(h))
    slots = np.concatenate([[0], np.cumsum(templates < _SLOTS)])
    typed = np.flatnonzero(slots[size:] > slots[:-size])
    if not len(typed):
        return h, places
    return np.concatenate([h, _hash(values + _SLOTS, size)[typed]]), np.concatenate([places, typed])


class Items:
    """A block of items with a hash table of their windows."""

    def __init__(self, items: list[tuple[int, str]]) -> None:
        self.ids = np.array([i for i, _ in items], np.int64)
        self.words = [read(t) for _, t in items]
        rows = [np.empty((3, 0), np.int64)]
        self.sizes = set()
        for k, (v, tp) in enumerate(self.words):
            if len(v) >= SHORTEST:
                self.sizes.add(size := window(len(v)))
                h, at = windows(v, tp, size)
                rows.append(np.stack([h, np.full(len(h), k), at]))
        post = np.concatenate(rows, axis=1)
        post = post[:, np.argsort(post[0], kind="stable")]
        self.hash, self.first = np.unique(post[0], return_index=True)
        self.first = np.append(self.first, post.shape[1])
        self.item, self.at = post[1], post[2]
        self.may = np.zeros(1 << 20, bool)
        self.may[self.hash & 0xFFFFF] = True


def _run(values, templates, v, tp, low: int, high: int):
    """Along the diagonals low..high: per item place whether the template agrees, and whether the very word does."""
    n = len(v)
    lines = []
    for x in range(low - 1, high + 2):
        a, b = max(0, -x), min(n, len(values) - x)
        if b > a:
            w = values[a + x : b + x] == v[a:b]
            eq = (templates[a + x : b + x] == tp[a:b]) | w
            lines.append((-int(eq.sum()), x, a, eq, w))
    same, word = np.zeros(n, bool), np.zeros(n, bool)
    fills: dict[int, set[int]] = defaultdict(set)
    for _, x, a, eq, w in sorted(lines, key=lambda r: r[:2]):  # a place belongs to the diagonal that agrees most
        b = a + len(eq)
        for p in np.flatnonzero(eq & ~w & ~same[a:b]):
            fills[int(v[a + p])].add(int(values[a + p + x]))
        same[a:b] |= eq
        word[a:b] |= w
    for p in np.flatnonzero(same & ~word):  # one slot filled in two ways is not the item's slot
        if len(fills[int(v[p])]) > 1:
            same[p] = False
    span = min(SPAN, n)
    dense = np.convolve(same, np.ones(span, int), "same") >= min(DENSE, window(n))
    return word & dense, same & dense


def passage(values, templates, v, tp, places: np.ndarray, diagonals: np.ndarray) -> tuple[float, float]:
    """(share of the item's words held, share held as a template) by the best run or the best two in order."""
    ds = np.unique(diagonals).tolist()
    runs, low, high = [], ds[0], ds[0]
    for x in ds[1:]:
        if x - high > DRIFT:
            runs.append((low, high))
            low = x
        high = x
    runs.append((low, high))
    seen = [_run(values, templates, v, tp, a, b) for a, b in runs]
    out = []
    for kind in (0, 1):
        sums = [np.concatenate([[0], np.cumsum(r[kind])]) for r in seen]
        best, front = max(int(c[-1]) for c in sums), sums[0]
        for c in sums[1:]:  # the front of the passage from an earlier run, the rest from a later one
            best = max(best, int((front + c[-1] - c).max()))
            front = np.maximum(front, c)
        out.append(best / len(v))
    return out[0], out[1]


def matches(items: Items, text: str, least: float = 1 / 3, least_template: float = 1 / 2) -> list[tuple[int, float, float]]:
    """(item, share of its words held, share held as a template) where one of them is at least as stated."""
    values, templates = read(text)
    if not items.sizes:
        return []
    found = [windows(values, templates, size) for size in items.sizes]
    h, places = found[0] if len(found) == 1 else (np.concatenate([f[k] for f in found]) for k in (0, 1))
    may = items.may[h & 0xFFFFF]
    h, places = h[may], places[may]
    at = np.searchsorted(items.hash, h)
    at[at == len(items.hash)] = 0
    hit = np.flatnonzero(items.hash[at] == h)
    if not len(hit):
        return []
    # every posting of every hit window, in the order of items
    start, many = items.first[at[hit]], items.first[at[hit] + 1] - items.first[at[hit]]
    post = np.repeat(start - np.cumsum(many) + many, many) + np.arange(many.sum())
    item, place = items.item[post], items.at[post]
    diagonal = np.repeat(places[hit], many) - place
    order = np.argsort(item, kind="stable")
    item, place, diagonal = item[order], place[order], diagonal[order]
    bounds = np.flatnonzero(np.r_[True, item[1:] != item[:-1], True])
    out = []
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        v, tp = items.words[item[a]]
        need = hits(len(v))
        if b - a < need or len(np.unique(place[a:b])) < need:
            continue
        share, template = passage(values, templates, v, tp, place[a:b], diagonal[a:b])
        if share >= least or template >= least_template:
            out.append((int(items.ids[item[a]]), share, template))
    return out


_OUT = "doc_id bigint, item_id bigint, share double, template_share double"


def _found(rows: list[tuple]) -> pa.RecordBatch:
    d, i, s, p = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array(d, pa.int64()), pa.array(i, pa.int64()), pa.array(s, pa.float64()), pa.array(p, pa.float64())], ["doc_id", "item_id", "share", "template_share"])


def _probe(docs: DataFrame, items: DataFrame, least: float, least_template: float) -> DataFrame:
    """The broadcast join: every document probes the hash table of the items."""
    block = [(r.i, r.t) for r in items.collect()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = Items(block)
        for b in batches:
            rows = []
            for i, t in zip(b.column(0).to_pylist(), b.column(1)):
                rows.extend((i, *m) for m in matches(made, t.as_py(), least, least_template))
            if rows:
                yield _found(rows)

    return docs.mapInArrow(run, _OUT)


def _windows_of(df: DataFrame, sizes: list[int], held: np.ndarray | None = None) -> DataFrame:
    """(h, id, at) of the rows (i, t): windows of each of ``sizes``, or of an item's own where ``sizes`` is empty.

    With ``held`` only windows whose bit is set there.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            hs, ids, ats = [], [], []
            for i, t in zip(b.column(0).to_pylist(), b.column(1)):
                v, tp = read(t.as_py())
                for size in sizes or ([window(len(v))] if len(v) >= SHORTEST else []):
                    h, at = windows(v, tp, size)
                    if held is not None:
                        ok = held[h % BITS >> 3] >> (h % BITS & 7).astype(np.uint8) & 1 > 0
                        h, at = h[ok], at[ok]
                    hs.append(h), ats.append(at), ids.append(np.full(len(h), i))
            if hs:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x).astype(np.int64)) for x in (hs, ids, ats)], ["h", "id", "at"])

    return df.mapInArrow(run, "h bigint, id bigint, at bigint")


def _shuffle(docs: DataFrame, items: DataFrame, least: float, least_template: float) -> DataFrame:
    """The shuffle join: windows with windows, then the texts of the pairs that have enough of them in common."""
    parts = cut(_windows_of(items, []).distinct())
    sizes = [r.w for r in cut(items.mapInArrow(_sizes, "w int").distinct()).collect()]
    bit = F.pmod("h", F.lit(BITS))
    one = parts.select(F.floor(bit / 8).cast("int").alias("byte"), F.pow(F.lit(2), F.pmod(bit, F.lit(8))).cast("int").alias("v")).groupBy("byte").agg(F.bit_or("v").alias("v"))
    held = np.zeros(BITS // 8, np.uint8)
    for t in one.coalesce(8).toLocalIterator():  # no more than BITS / 8 bytes however many items there are
        held[t.byte] = t.v
    seen = cut(_windows_of(docs, sizes, held).distinct().select("h", F.col("id").alias("doc_id"), F.col("at").alias("pos")))
    pairs = salted_join(seen, parts.select("h", F.col("id").alias("item_id"), "at"), "h", seen.count())
    pairs = pairs.groupBy("doc_id", "item_id").agg(F.collect_list("at").alias("places"), F.collect_list(F.col("pos") - F.col("at")).alias("diagonals"), F.count_distinct("at").alias("n"))
    pairs = cut(pairs)
    texts = skew_join(pairs, items.select(F.col("i").alias("item_id"), F.col("t").alias("item")), "item_id", pairs.count(), "inner")
    texts = texts.join(docs.select(F.col("i").alias("doc_id"), F.col("t").alias("doc")), "doc_id")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for d, i, n, places, diagonals, item, doc in zip(*(b.column(c).to_pylist() for c in ("doc_id", "item_id", "n", "places", "diagonals", "item", "doc"))):
                v, tp = read(item)
                if n >= hits(len(v)):
                    share, template = passage(*read(doc), v, tp, np.array(places), np.array(diagonals))
                    if share >= least or template >= least_template:
                        rows.append((d, i, share, template))
            if rows:
                yield _found(rows)

    return texts.select("doc_id", "item_id", "n", "places", "diagonals", "item", "doc").mapInArrow(compare, _OUT)


def _sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        n = [len(read(t.as_py())[0]) for t in b.column(1)]
        yield pa.RecordBatch.from_arrays([pa.array(sorted({window(k) for k in n if k >= SHORTEST}), pa.int32())], ["w"])


def leaked(docs: DataFrame, doc_key: Column, doc_text: Column, items: DataFrame, item_key: Column, item_text: Column, least: float = 1 / 3, least_template: float = 1 / 2) -> DataFrame:
    """(doc_id, item_id, share, template_share): documents that hold at least ``least`` of an item's words as a passage.

    A word is held where its surroundings agree as a template too: words, or slots filled consistently. share counts the
    very words, template_share also slots filled with other values: an item asked again with other numbers and names is
    found by ``least_template`` of it, whatever is left of its words. Null texts on either side match nothing, nor do
    items of fewer than SHORTEST words. Repeated items and documents count once (of an item given with several texts the
    smallest is taken). Empty tables give an empty result. Documents are read whole and once.
    """
    flat = docs.select(doc_key.cast("bigint").alias("i"), doc_text.alias("t")).where("i is not null and t is not null")
    rows = cut(items.select(item_key.cast("bigint").alias("i"), item_text.alias("t")).where("i is not null and t is not null").groupBy("i").agg(F.min("t").alias("t")))
    chars = rows.agg(F.coalesce(F.sum(F.length("t")), F.lit(0))).first()[0]
    out = _probe(flat, rows, least, least_template) if chars <= BLOCK_CHARS else _shuffle(flat, rows, least, least_template)
    return out.groupBy("doc_id", "item_id").agg(F.max("share").alias("share"), F.max("template_share").alias("template_share"))
