"""Edits as they arrive: counts per window of time, each edit once, late ones up to a stated delay."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def window_counts(revisions: DataFrame, window: str = "7 days", late: str = "2 days") -> DataFrame:
    """(bin, n, n_minor) of a stream of revisions (id, timestamp, minor).

    A revision delivered again within ``late`` counts once; one that comes later than that is dropped by the watermark, as
    its window is closed. Null ids and times are left out, a null ``minor`` is major. State is a row per open window and
    per id within the delay.
    """
    rows = revisions.where("id is not null and timestamp is not null").select("id", F.col("timestamp").cast("timestamp").alias("timestamp"), F.coalesce("minor", F.lit(False)).alias("minor"))
    once = rows.withWatermark("timestamp", late).dropDuplicatesWithinWatermark(["id"])
    return once.groupBy(F.window("timestamp", window)).agg(F.count("*").alias("n"), F.count_if("minor").alias("n_minor")).select(F.col("window.start").alias("bin"), "n", "n_minor")
