"""Deeply nested records into flat related tables, by repetition and definition levels.

``shred`` turns the JSON of each row into one column per requested leaf path: the leaf's values and, beside each, its
repetition level (at which repeated ancestor the entry starts anew) and definition level (how many of the path's steps
are there). ``assemble`` rebuilds the table of any repeated ancestor from the level sequences alone, vectorised over a
whole Arrow batch; all leaves of a record lie in one row, so no shuffle is needed.

A path is a sequence of steps joined by dots; a step ending in ``[]`` is repeated. The record itself is repeated when the
path starts with ``[]``: ``[].sections[].templates[].name``.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame

_LEVELS = pa.struct([("rep", pa.list_(pa.int8())), ("dfn", pa.list_(pa.int8())), ("val", pa.list_(pa.string()))])
_LEVELS_SQL = "struct<rep:array<tinyint>,dfn:array<tinyint>,val:array<string>>"


def parse_path(path: str) -> list[tuple[str, bool]]:
    """(key, repeated) per step; the key is empty for a repeated record."""
    return [(s.removesuffix("[]"), s.endswith("[]")) for s in path.split(".")]


def max_levels(path: str) -> tuple[int, int]:
    steps = parse_path(path)
    return sum(r for _, r in steps), len(steps)


def _walk(x, steps, i, rep, depth, out) -> None:
    """Append (rep, dfn, value) for the part of the path from step i on; depth is the number of repeated steps passed."""
    while i < len(steps):
        key, repeated = steps[i]
        if key:
            x = x.get(key) if isinstance(x, dict) else None
        if repeated:
            items = x if isinstance(x, list) else [x] if isinstance(x, dict) else []
            if not items:
                out.append((rep, i, None))
                return
            for k, item in enumerate(items):
                _walk(item, steps, i + 1, rep if k == 0 else depth + 1, depth + 1, out)
            return
        if x is None:
            out.append((rep, i, None))
            return
        i += 1
    if isinstance(x, bool):
        x = "true" if x else "false"
    elif isinstance(x, (dict, list)):
        x = json.dumps(x, ensure_ascii=False, separators=(",", ":"))
    # ending on a repeated step, the entry stands for the item itself
    out.append((rep, len(steps), None if x is None else str(x)))


def shred(df: DataFrame, key: Column, text: Column, leaves: Sequence[str]) -> DataFrame:
    """(rec_key bigint, c0, c1, ...): level sequences of ``leaves`` for the JSON in ``text``.

    A null, empty or unreadable text is a record without anything: one entry of definition level 0 per leaf. A single
    object where the path has an array counts as an array of one. Missing keys, nulls and values of another type (a
    text where an object should be) end the entry at that level. Repeated rows are kept; deduplicate what is assembled.
    """
    steps = [parse_path(p) for p in leaves]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cols = [[] for _ in steps]
            for t in b.column(1).to_pylist():
                try:
                    x = json.loads(t) if t else None
                except ValueError:
                    x = None
                for c, st in zip(cols, steps):
                    out: list = []
                    _walk(x, st, 0, 0, 0, out)
                    c.append({"rep": [o[0] for o in out], "dfn": [o[1] for o in out], "val": [o[2] for o in out]})
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, _LEVELS) for c in cols)], ["rec_key", *(f"c{i}" for i in range(len(steps)))])

    flat = df.select(key.cast("bigint").alias("rec_key"), text.alias("t"))
    return flat.mapInArrow(run, "rec_key bigint, " + ", ".join(f"c{i} {_LEVELS_SQL}" for i in range(len(steps))))


def _ordinals(rep: np.ndarray, upto: int) -> np.ndarray:
    """For each entry and each repeated level 1..upto its position, from 1, within the parent."""
    n = len(rep)
    out = np.empty((upto, n), np.int32)
    at = np.arange(n)
    for level in range(1, upto + 1):
        # an entry opens a new item of this level when it repeats at this level or above
        opens = np.cumsum(rep <= level)
        parent = np.maximum.accumulate(np.where(rep < level, at, 0))
        out[level - 1] = opens - opens[parent] + 1
    return out


def assemble(shredded: DataFrame, leaves: Sequence[str], ancestor: str, columns: dict[str, str], outer: bool = False) -> DataFrame:
    """The table of the repeated ``ancestor``: rec_key, pos1..posK, one column for each leaf of ``columns`` (name: path).

    Leaves may lie below the ancestor (as single values), at it, or on any repeated level above, in which case the value
    of the parent item is repeated. Without ``outer``, a row per item that is there. With it, a parent that has none at
    some level gives one row with position 0 from that level on; records without any item of the first level never do.
    """
    levels = sum(r for _, r in parse_path(ancestor))
    need_def = [i + 1 for i, (_, r) in enumerate(parse_path(ancestor)) if r]
    where = {p: i for i, p in enumerate(leaves)}
    names = list(columns)
    base = next(p for p in leaves if p.startswith(ancestor))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys = b.column(0)

            def levels_of(path: str):
                c = b.column(1 + where[path])
                rep = c.field(0)
                lens = np.diff(rep.offsets.to_numpy())
                rows = np.repeat(np.arange(len(lens)), lens)
                return rows, rep.flatten().to_numpy(), c.field(1).flatten().to_numpy(), c.field(2).flatten()

            rows, rep, dfn, _ = levels_of(base)
            pos = _ordinals(rep, levels)
            for k in range(levels):
                pos[k][dfn < need_def[k]] = 0
            starts = rep <= levels  # entries that open an item of the ancestor
            keep = starts & (pos[0] > 0 if outer else pos[-1] > 0)
            picked = np.flatnonzero(keep)
            arrays = [keys.take(pa.array(rows[picked])), *(pa.array(pos[k][picked]) for k in range(levels))]
            for name in names:
                path = columns[name]
                depth = sum(r for _, r in parse_path(path))
                shared = min(depth, levels)
                lrows, lrep, _, lval = levels_of(path)
                first = np.flatnonzero(lrep <= shared) if depth > shared else np.arange(len(lrep))
                lpos = _ordinals(lrep, shared)[:, first]
                # both sides are in record order, then by position: number the items of the shared level alike
                width = [int(max(lpos[k].max(initial=0), pos[k].max(initial=0))) + 2 for k in range(shared)]
                code_l, code = lrows[first].astype(np.int64), rows[picked].astype(np.int64)
                for k in range(shared):
                    code_l = code_l * width[k] + lpos[k]
                    code = code * width[k] + np.maximum(pos[k][picked], 1)
                at = np.searchsorted(code_l, code)
                arrays.append(lval.take(pa.array(first[at] if len(first) else at)))
            yield pa.RecordBatch.from_arrays(arrays, ["rec_key", *(f"pos{k + 1}" for k in range(levels)), *names])

    return shredded.mapInArrow(run, "rec_key bigint, " + "".join(f"pos{k + 1} int, " for k in range(levels)) + ", ".join(f"{n} string" for n in names))
