"""Distinct counts over identifier sets too large to hold, by disjoint hash ranges.

An identifier falls into one of ``buckets`` hash ranges. Within a bucket the pairs of identifier and group are
deduplicated, keeping with each identifier the set of groups it was seen in as bits; every combination of groups can
then be counted exactly per bucket, and as the buckets are disjoint, their counts add up. The deduplicated pairs are the
mergeable partial result: pieces may be reduced apart and merged later by or-ing the bits.

The error is 0 when all buckets are counted. ``estimate_from`` counts only so many of the buckets, scaled up, with the
relative standard error sqrt((buckets / used - 1) / counted), for data of which a rough figure is enough.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 512


def partial(df: DataFrame, identifier: Column, keys: dict[str, Column], groups: dict[str, Column], buckets: int = BUCKETS) -> DataFrame:
    """(keys, bucket, ident, mask): one row per key and identifier, with the groups as bits in the order given.

    Null identifiers, and rows in none of the groups (a null condition is false), aren't counted; null keys form a key of
    their own. Repeated rows change nothing. One hot identifier or key is combined before the shuffle and spread over
    the buckets after it. Only the given expressions are read.
    """
    if len(groups) > 63:
        raise ValueError("no more than 63 groups")
    bits = [F.when(cond, F.lit(1 << i)).otherwise(F.lit(0)) for i, cond in enumerate(groups.values())]
    mask = reduce(lambda a, b: a.bitwiseOR(b), bits)
    rows = df.select(*(c.alias(k) for k, c in keys.items()), identifier.cast("string").alias("ident"), mask.alias("mask")).where("ident is not null and mask <> 0")
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("ident"), F.lit(buckets)).cast("int"))
    return rows.groupBy(*keys, "bucket", "ident").agg(F.bit_or("mask").alias("mask"))


def merge(*parts: DataFrame) -> DataFrame:
    """One partial result from several with the same keys, groups and number of buckets."""
    rows = reduce(DataFrame.unionByName, parts)
    keys = [c for c in parts[0].columns if c != "mask"]
    return rows.groupBy(*keys).agg(F.bit_or("mask").alias("mask"))


def per_bucket(part: DataFrame, combos: dict[str, tuple[int, str]]) -> DataFrame:
    """(keys, bucket, one count per combination). A combination is (bits, "any") or (bits, "all")."""
    keys = [c for c in part.columns if c not in ("mask", "ident", "bucket")]

    def hit(bits: int, how: str) -> Column:
        both = F.col("mask").bitwiseAND(F.lit(bits))
        return both == bits if how == "all" else both != 0

    return part.groupBy(*keys, "bucket").agg(*(F.count_if(hit(b, how)).alias(k) for k, (b, how) in combos.items()))


def totals(part: DataFrame, combos: dict[str, tuple[int, str]], buckets: int = BUCKETS, estimate_from: int | None = None) -> DataFrame:
    """(keys, one count per combination, rel_error): the sums over the buckets; an empty table gives no rows."""
    counts = per_bucket(part, combos)
    keys = [c for c in counts.columns if c not in combos and c != "bucket"]
    if estimate_from is None:
        return counts.groupBy(*keys).agg(*(F.sum(k).cast("bigint").alias(k) for k in combos)).withColumn("rel_error", F.lit(0.0))
    f = buckets / estimate_from
    counts = counts.where(F.col("bucket") < estimate_from).groupBy(*keys).agg(*(F.sum(k).alias(k) for k in combos))
    least = F.least(*(F.greatest(F.col(k), F.lit(1)) for k in combos)) if len(combos) > 1 else F.greatest(F.col(next(iter(combos))), F.lit(1))
    return counts.withColumn("rel_error", F.sqrt((f - 1) / least)).select(*keys, *(F.round(F.col(k) * f).cast("bigint").alias(k) for k in combos), "rel_error")
