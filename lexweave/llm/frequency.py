"""Frequency of every distinct value, in a vertical layout.

Records are numbered; the numbers of the records that hold a value are kept per value and range of RANGE numbers as a
container: the sorted positions within the range, as two-byte numbers or as a bitmap, whichever is shorter, and beside
them, in the same order, how often the value occurs in each record. Containers are built straight from the rows, without
grouping them before, so what is shuffled is compressed; they merge by union, where a record delivered twice counts once. Document frequency is
the cardinality of the union, and a value that a third of all records hold is still only a container per range.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

RANGE = 1 << 16
#: Pairs that a task holds before it writes its containers out.
HELD = 1_000_000


def pack(pos: np.ndarray, occ: np.ndarray) -> tuple[bytes, bytes]:
    """Sorted distinct positions and their counts as bytes; an empty second part says that all counts are 1."""
    if len(pos) > RANGE // 16:
        bits = np.zeros(RANGE, np.uint8)
        bits[pos] = 1
        body = b"b" + np.packbits(bits).tobytes()
    else:
        body = b"a" + pos.astype("<u2").tobytes()
    return body, b"" if (occ == 1).all() else occ.astype("<i8").tobytes()


def unpack(body: bytes, counts: bytes) -> tuple[np.ndarray, np.ndarray]:
    raw = np.frombuffer(body, np.uint8, offset=1)
    pos = np.flatnonzero(np.unpackbits(raw)) if body[:1] == b"b" else raw.view("<u2").astype(np.int64)
    return pos, np.frombuffer(counts, "<i8") if counts else np.ones(len(pos), np.int64)


def union(containers: list[tuple[bytes, bytes]]) -> tuple[bytes, bytes]:
    """All positions; where a record is in several containers, its count is the largest."""
    parts = [unpack(*c) for c in containers]
    occ = np.zeros(RANGE, np.int64)
    for p, o in parts:
        occ[p] = np.maximum(occ[p], o)
    pos = np.flatnonzero(occ)
    return pack(pos, occ[pos])


_CONTAINER = "val string, hi bigint, body binary, counts binary"


def containers(df: DataFrame, val: Column, record: Column, count: Column, starts: Column | None = None, parse: Callable[[str], tuple[str | None, int]] | None = None) -> DataFrame:
    """(val, hi, body, counts): partial containers of each task, mergeable by ``union``.

    Rows need no grouping before: within a task the counts of a value's rows are added up as long as they belong to one
    delivery of a record, which begins where ``starts`` is true (every row, where it isn't given); of several deliveries
    of a record the largest count is taken. ``parse`` turns a value as it stands into the value meant (None for none) and
    a number that its count is multiplied by; it is called once for each distinct value of a batch of containers.
    """

    def build(vals: list, recs: list, occs: list, runs: list) -> pa.RecordBatch:
        enc = pa.chunked_array(vals).combine_chunks().dictionary_encode()
        code, rec, occ, run, names = enc.indices.to_numpy(), np.concatenate(recs), np.concatenate(occs), np.concatenate(runs), enc.dictionary
        if parse:
            meant = [parse(v) for v in names.to_pylist()]
            occ = occ * np.array([k for _, k in meant], np.int64)[code]
            again = pa.array([v for v, _ in meant], pa.string()).dictionary_encode()
            names = again.dictionary
            code = again.indices.fill_null(-1).to_numpy()[code]
            some = code >= 0
            code, rec, occ, run = code[some], rec[some], occ[some], run[some]
        if not len(code):
            return pa.RecordBatch.from_arrays([pa.array([], t) for t in (pa.string(), pa.int64(), pa.binary(), pa.binary())], ["val", "hi", "body", "counts"])
        order = np.lexsort((run, rec, code))
        code, rec, occ, run = code[order], rec[order], occ[order], run[order]
        new = np.r_[True, (code[1:] != code[:-1]) | (rec[1:] != rec[:-1])]
        first = np.flatnonzero(new | np.r_[True, run[1:] != run[:-1]])
        occ, code, rec = np.add.reduceat(occ, first), code[first], rec[first]
        first = np.flatnonzero(new[first])
        occ, code, rec = np.maximum.reduceat(occ, first), code[first], rec[first]
        hi = rec // RANGE
        at = np.flatnonzero(np.r_[True, (code[1:] != code[:-1]) | (hi[1:] != hi[:-1])])
        ends = np.r_[at[1:], len(code)]
        low = (rec - hi * RANGE).astype("<u2")
        packed = [pack(low[a:b], occ[a:b]) for a, b in zip(at.tolist(), ends.tolist())]
        bodies, counts = zip(*packed)
        return pa.RecordBatch.from_arrays([names.take(pa.array(code[at])), pa.array(hi[at]), pa.array(bodies, pa.binary()), pa.array(counts, pa.binary())], ["val", "hi", "body", "counts"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vals, recs, occs, runs, held, at = [], [], [], [], 0, 0
        for b in batches:
            if not b.num_rows:
                continue
            new = b.column(3).to_numpy(zero_copy_only=False)
            if held >= HELD and new[0]:  # the last delivery is complete
                yield build(vals, recs, occs, runs)
                vals, recs, occs, runs, held = [], [], [], [], 0
            of = at + np.cumsum(new)
            at = int(of[-1])
            if b.column(0).null_count:  # rows that only begin a delivery
                ok = np.asarray(b.column(0).is_valid())
                b, of = b.filter(pa.array(ok)), of[ok]
            if b.num_rows:
                vals.append(b.column(0)), recs.append(b.column(1).to_numpy()), occs.append(b.column(2).to_numpy()), runs.append(of)
            held += b.num_rows
        if held:
            yield build(vals, recs, occs, runs)

    rows = df.select(val.alias("val"), record.cast("bigint").alias("rec"), count.cast("bigint").alias("occ"), (F.lit(True) if starts is None else starts).alias("new"))
    return rows.where("(val is not null or new) and rec is not null and occ is not null").mapInArrow(run, _CONTAINER)


def merged(parts: DataFrame) -> DataFrame:
    """(val, hi, body, counts): one container per value and range."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []

        def rows(done: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist(done, pa.schema([("val", pa.string()), ("hi", pa.int64()), ("body", pa.binary()), ("counts", pa.binary())]))

        def close(key, held) -> dict:
            body, counts = held[0] if len(held) == 1 else union(held)
            return {"val": key[0], "hi": key[1], "body": body, "counts": counts}

        for b in batches:
            done = []
            for v, h, body, counts in zip(*(b.column(i).to_pylist() for i in range(4))):
                if (v, h) != key:
                    if held:
                        done.append(close(key, held))
                    key, held = (v, h), []
                held.append((body, counts))
                if len(held) == 64:  # so that a run of any length is held in little
                    held = [union(held)]
            if done:
                yield rows(done)
        if held:
            yield rows([close(key, held)])

    return parts.repartition("val", "hi").sortWithinPartitions("val", "hi").mapInArrow(run, _CONTAINER)


@F.arrow_udf(T.StructType([T.StructField("df", T.LongType()), T.StructField("occ", T.LongType())]))
def _cardinality(body: pa.Array, counts: pa.Array) -> pa.Array:
    out = []
    for b, c in zip(body.to_pylist(), counts.to_pylist()):
        pos, occ = unpack(b, c)
        out.append((len(pos), int(occ.sum())))
    return pa.StructArray.from_arrays([pa.array([x for x, _ in out], pa.int64()), pa.array([y for _, y in out], pa.int64())], ["df", "occ"])


def frequencies(df: DataFrame, val: Column, record: Column, count: Column, n_records: int, rare_at_most: int, common_above: float, starts: Column | None = None, parse: Callable[[str], tuple[str | None, int]] | None = None) -> DataFrame:
    """(val, n_occurrences, n_records, band) of every value; band is rare, common or null between.

    A record counts once however often its row is repeated; its count is that of ``containers``. Null values and rows
    without a record number aren't counted; a value is taken as it stands, so the empty one is a value unless left out
    before. A value within the rare limit is rare even if so few records make it common too. ``n_records`` is the number
    of all records, those without a value included. An empty table gives an empty result.
    """
    c = merged(containers(df, val, record, count, starts, parse)).withColumn("n", _cardinality("body", "counts"))
    f = c.groupBy("val").agg(F.sum("n.occ").alias("n_occurrences"), F.sum("n.df").alias("n_records"))
    return f.withColumn("band", F.when(F.col("n_records") <= rare_at_most, "rare").when(F.col("n_records") > common_above * n_records, "common"))
