"""Operators on revision and entry tables: filters, windows on a time spine, dimension lookups, shares."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexweave.plans.runtime import clean_key


class EntryQuery:
    """A fluent selection over a table: each method adds a criterion, ``build`` applies all. Empty lists restrict nothing."""

    def __init__(self, df: DataFrame) -> None:
        self._df, self._criteria, self._fields = df, [], None

    def where_in(self, column: str, *values) -> EntryQuery:
        if values:
            self._criteria.append(F.col(column).isin(*values))
        return self

    def equal(self, column: str, value) -> EntryQuery:
        self._criteria.append(F.col(column) == value)
        return self

    def matching(self, column: str, pattern: str) -> EntryQuery:
        """A regular expression found anywhere in the column."""
        self._criteria.append(F.col(column).rlike(pattern))
        return self

    def sections(self, column: str, *patterns: str) -> EntryQuery:
        """Some heading path of which, for every pattern, some heading matches it."""

        def some(path: Column, pattern: str) -> Column:
            return F.exists(path, lambda h: h.rlike(pattern))

        self._criteria.append(F.exists(column, lambda path: reduce(lambda a, b: a & b, (some(path, p) for p in patterns))))
        return self

    def filter(self, condition: Column) -> EntryQuery:
        self._criteria.append(condition)
        return self

    def selector(self, *fields: str) -> EntryQuery:
        if self._fields:
            raise ValueError("the fields are selected already")
        self._fields = fields
        return self

    def build(self) -> DataFrame:
        df = reduce(DataFrame.where, self._criteria, self._df)
        return df.select(*self._fields) if self._fields else df


def clean_revisions(revisions: DataFrame) -> DataFrame:
    """Each revision once, with the contributor in one spelling ("-" if unidentified) and ``minor`` never null."""
    who = F.coalesce(clean_key(F.col("contributor")), F.lit("-"))
    return revisions.select("page_id", "id", "timestamp", who.alias("contributor"), F.coalesce("minor", F.lit(False)).alias("minor")).where("id is not null").distinct()


def last_per(df: DataFrame, by: list[str], order: list[str]) -> DataFrame:
    """The row of each group with the largest values of ``order``, which must tell rows apart for a defined result.

    It is a maximum, not a window: a group of any size is reduced where its rows lie before anything is shuffled.
    """
    rest = [c for c in df.columns if c not in by and c not in order]
    top = df.groupBy(*by).agg(F.max(F.struct(*order, *rest)).alias("_top"))
    return top.select(*by, "_top.*").select(*df.columns)


def first_per(df: DataFrame, by: list[str], order: list[str]) -> DataFrame:
    """The row with the smallest values."""
    rest = [c for c in df.columns if c not in by and c not in order]
    return df.groupBy(*by).agg(F.min(F.struct(*order, *rest)).alias("_top")).select(*by, "_top.*").select(*df.columns)


def right_closed_bin(ts: Column, unit: str) -> Column:
    """The start of the bin (start, next start] a time falls into: a time on a border belongs to the bin before it."""
    return F.date_trunc(unit, ts - F.expr("interval 1 microsecond")).cast("timestamp_ntz")


def forward_fill(df: DataFrame, key: str, at: str, value: str, step: str) -> DataFrame:
    """Every key on every bin, ``step`` apart, from its first row to the last bin of all, with the last value known.

    A null value is a value: only bins without a row inherit. A key's bins are made from its own first one; the last bin
    of all is one row.
    """
    end = df.agg(F.max(at).alias("_end"))
    first = df.groupBy(key).agg(F.min(at).alias("_first"))
    full = first.join(F.broadcast(end)).select(key, F.explode(F.sequence("_first", "_end", F.expr(f"interval {step}"))).alias(at))
    rows = full.join(df.select(key, at, F.struct(value).alias("_v")), [key, at], "left")
    w = Window.partitionBy(key).orderBy(at).rowsBetween(Window.unboundedPreceding, 0)
    return rows.select(key, at, F.last("_v", ignorenulls=True).over(w)[value].alias(value))


def add_aligned(a: DataFrame, b: DataFrame, keys: list[str], value: str) -> DataFrame:
    """The sum of two tables of counts, a missing row counting 0."""
    return a.select(*keys, value).unionByName(b.select(*keys, value)).groupBy(*keys).agg(F.sum(value).alias(value))
