"""A store of entries: bulk load, lookups by title, language and name space, samples, and what a reader may ask of it."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexweave.operators.relational import EntryQuery

#: Name spaces of entries and of reconstructed ones.
DEFAULT_NS = (0, 118)
#: Files of a store are sorted by these, so that a lookup reads few row groups.
KEYS = ("title", "language")


def target_name(path: str) -> tuple[str, str]:
    """(database, collection) of a dump's file name: enword-20230101-pages.xml.bz2 gives enword, 20230101."""
    m = re.match(r"(?:.*/)?([a-z_]+?)-(\d{8}|latest)\b", path)
    if not m:
        raise ValueError(f"not the name of a dump: {path}")
    return m[1], m[2]


class EntryStore:
    """Entries (title, ns, language, ...) kept as a table in a folder; other columns are kept as they are.

    Rows are hashed by title into ``parts`` files and sorted by title and language within, with a filter of titles, so
    that looking up a title reads a part of one file.
    """

    def __init__(self, spark: SparkSession, path: str, parts: int = 64) -> None:
        self.spark, self.path, self.parts = spark, path.rstrip("/"), parts

    def load(self, entries: DataFrame) -> None:
        """Replace what is stored."""
        rows = entries.repartition(self.parts, "title").sortWithinPartitions(*KEYS)
        rows.write.mode("overwrite").option("parquet.bloom.filter.enabled#title", "true").option("parquet.bloom.filter.expected.ndv#title", "100000").parquet(self.path)

    def scan(self) -> DataFrame:
        return self.spark.read.parquet(self.path)

    def __len__(self) -> int:
        return self.scan().count()

    def query(self) -> EntryQuery:
        return EntryQuery(self.scan())

    def entries(self, title: str | None = None, language: str | None = None, ns: tuple[int, ...] = DEFAULT_NS, where: Column | None = None, fields: tuple[str, ...] = ()) -> DataFrame:
        """The entries of a title, a language, both or neither; of a title in the order in which they stand on the page."""
        q = self.query().where_in("ns", *ns)
        q = q.where_in("title", *([title] if title is not None else [])).where_in("language", *([language] if language is not None else []))
        q = q.filter(where) if where is not None else q
        df = q.build()
        df = df.orderBy("_i") if title is not None and "_i" in df.columns else df
        return df.select(*fields) if fields else df

    def __getitem__(self, key: str | tuple) -> list:
        """store[title], store[title, language] or store[title, language, ns]; an error where there is none."""
        title, language, ns = (*key, None, None)[:3] if isinstance(key, tuple) else (key, None, None)
        found = self.entries(title, language, (ns,) if ns is not None else DEFAULT_NS).collect()
        if not found:
            raise KeyError(key)
        return found

    def __contains__(self, key: str | tuple) -> bool:
        title, language, ns = (*key, None, None)[:3] if isinstance(key, tuple) else (key, None, None)
        return not self.entries(title, language, (ns,) if ns is not None else ()).isEmpty()

    def remove(self, where: Column) -> None:
        """Take out the entries for which ``where`` is true; the rest is written beside and put in place."""
        kept = self.scan().where(~F.coalesce(where, F.lit(False)))
        new = EntryStore(self.spark, self.path + ".new", self.parts)
        new.load(kept)
        fs = self.spark._jvm.org.apache.hadoop.fs
        at, old = fs.Path(new.path), fs.Path(self.path)
        system = old.getFileSystem(self.spark._jsc.hadoopConfiguration())
        system.delete(old, True)
        system.rename(at, old)

    def clear(self) -> None:
        self.load(self.scan().limit(0))


def sample(df: DataFrame, n: int, keys: list[str], seed: int = 117) -> DataFrame:
    """``n`` rows drawn without replacement by a hash of ``keys`` and the seed; the same rows every time."""
    return df.orderBy(F.xxhash64(*keys, F.lit(seed)), *keys).limit(n)


def sample_groups(df: DataFrame, n: int, keys: list[str], seed: int = 117) -> DataFrame:
    """All rows of ``n`` groups drawn by a hash."""
    groups = sample(df.select(*keys).distinct(), n, keys, seed)
    return df.join(F.broadcast(groups), keys, "left_semi")


def chunks(df: DataFrame, size: Column, limit: int, order: list[str], key: str) -> DataFrame:
    """``df`` with ``chunk``: consecutive rows (in ``order``) whose sizes add up to about ``limit``; a larger row has its own.

    Running sums are taken within ranges of ``key``, a number, and carried over their totals, so no task sees all rows.
    """
    part = F.floor(F.col(key) / 10_000)
    rows = df.withColumn("_part", part).withColumn("_size", size)
    sums = rows.groupBy("_part").agg(F.sum("_size").alias("_all"))
    carried = sums.select("_part", F.coalesce(F.sum("_all").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_base"))
    inside = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("_in", F.coalesce(F.sum("_size").over(inside), F.lit(0))).join(carried, "_part")
    return rows.withColumn("chunk", F.floor((F.col("_base") + F.col("_in")) / limit)).select(*df.columns, "chunk")


def json_paths(df: DataFrame, text: Column) -> DataFrame:
    """(path, n): the paths of keys in JSON texts, arrays as [*], with the number of rows that have each."""
    import json

    import pyarrow as pa

    def walk(v, at: str, out: set[str]) -> None:
        if isinstance(v, dict):
            for k, x in v.items():
                out.add(f"{at}.{k}" if at else k)
                walk(x, f"{at}.{k}" if at else k, out)
        elif isinstance(v, list):
            out.add(at + "[*]")
            for x in v:
                walk(x, at + "[*]", out)

    def run(batches):
        for b in batches:
            n: dict[str, int] = {}
            for t in b.column(0).to_pylist():
                found: set[str] = set()
                try:
                    walk(json.loads(t), "", found)
                except ValueError:
                    found.add("(unreadable)")
                for p in found:
                    n[p] = n.get(p, 0) + 1
            yield pa.RecordBatch.from_arrays([pa.array(list(n), pa.string()), pa.array(list(n.values()), pa.int64())], ["path", "n"])

    return df.select(text.alias("t")).where("t is not null").mapInArrow(run, "path string, n bigint").groupBy("path").agg(F.sum("n").alias("n"))
