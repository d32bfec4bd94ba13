"""What every plan needs: table access, checkpoints on shared storage, joins that survive hot keys."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A left side with fewer rows than this is joined plainly: all its rows under one key still fit one task.
SKEW_ROWS = 2_000_000
#: Keys holding more than this share of the left rows are hot; there can be no more than 1 / HOT_SHARE of them.
HOT_SHARE = 0.002


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The parquet table ``name`` of the data folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_LOCAL: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """The session's spark.checkpoint.dir, which all executors share. Where that is unset, a temporary folder of this
    process in local mode, as in tests, and an error on a cluster, whose executors would each write to their own disk."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    master = spark.conf.get("spark.master", "")
    if master != "local" and not master.startswith("local["):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    if not _LOCAL:
        _LOCAL.append(tempfile.mkdtemp(prefix="lexweave-"))
        atexit.register(shutil.rmtree, _LOCAL[0], ignore_errors=True)
    return _LOCAL[0]


#: Cut tables of this process that are still there.
_CUTS: set[str] = set()


def _delete(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jvm.org.apache.hadoop.conf.Configuration() if spark.sparkContext._jsc is None else spark._jsc.hadoopConfiguration()).delete(where, True)
    _CUTS.discard(path)


def clear(spark: SparkSession) -> None:
    """Delete all cut tables of this process, once no DataFrame made with them is needed; done when the process ends, as far
    as the session's file system can still be reached."""
    for path in list(_CUTS):
        try:
            _delete(spark, path)
        except Exception:  # the JVM is gone
            return


def cut(df: DataFrame) -> DataFrame:
    """``df`` written as a table in the shared folder and read again.

    That ends its lineage, survives the loss of executors, and, unlike a checkpointed RDD, tells the optimizer the size.
    """
    path = f"{shared_folder(df.sparkSession)}/lexweave-{uuid.uuid4().hex}"
    df.write.parquet(path)
    atexit.unregister(clear)  # once, for the session in use
    atexit.register(clear, df.sparkSession)
    _CUTS.add(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._cut_path = path
    return out


def grow(whole: DataFrame, more: DataFrame) -> DataFrame:
    """The cut table ``whole`` with the rows of ``more`` added to its files, so that a loop writes only what is new."""
    more.select(*whole.columns).write.mode("append").parquet(whole._cut_path)
    out = whole.sparkSession.read.schema(whole.schema).parquet(whole._cut_path)
    out._cut_path = whole._cut_path
    return out


def release(*tables: DataFrame | None) -> None:
    """Delete the files of cut tables that no plan will read again; other DataFrames are passed over."""
    for t in tables:
        if (path := getattr(t, "_cut_path", None)) is not None:
            _delete(t.sparkSession, path)
            t._cut_path = None


def _hot(left: DataFrame, keys: list[str], rows: int) -> DataFrame:
    """The keys with over HOT_SHARE of the rows, at most 1 / HOT_SHARE of them, marked for broadcast."""
    hot = left.dropna(subset=keys).groupBy(*keys).count().where(F.col("count") > rows * HOT_SHARE)
    return F.broadcast(hot.select(*keys))


def skew_join(left: DataFrame, right: DataFrame, key: str | list[str], rows: int, how: str = "left") -> DataFrame:
    """Join many ``left`` rows to a ``right`` side that is unique on ``key``.

    With at most SKEW_ROWS left rows this is an ordinary join. Beyond, keys that hold over HOT_SHARE of the left rows
    are taken apart: at most 1 / HOT_SHARE right rows belong to them, so these are broadcast, and their left rows stay
    where they are; the others are shuffled. ``left`` is read twice and should be cut. Null keys match nothing.
    """
    if rows <= SKEW_ROWS:
        return left.join(right, key, how)
    hot = _hot(left, [key] if isinstance(key, str) else key, rows)
    cold = left.join(hot, key, "left_anti")
    return cold.join(right, key, how).unionByName(
        left.join(hot, key, "left_semi").join(F.broadcast(right.join(hot, key, "left_semi")), key, how)
    )


def salted_join(left: DataFrame, right: DataFrame, key: str, rows: int, how: str = "inner", salts: int = 32) -> DataFrame:
    """Join ``left`` to a ``right`` side that may hold many rows of a key as well.

    With at most SKEW_ROWS left rows this is an ordinary join. Beyond, the left rows of keys with over HOT_SHARE of them
    are dealt to ``salts`` groups, and the right rows of just these keys are there once in each group; no row is
    broadcast but the list of hot keys. ``left`` is read twice and should be cut.
    """
    if rows <= SKEW_ROWS:
        return left.join(right, key, how)
    hot = _hot(left, [key], rows)
    cold = left.join(hot, key, "left_anti").join(right, key, how)
    dealt = left.join(hot, key, "left_semi").withColumn("_salt", F.pmod(F.xxhash64(*left.columns), F.lit(salts)).cast("int"))
    copies = right.join(hot, key, "left_semi").withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return cold.unionByName(dealt.join(copies, [key, "_salt"], how).drop("_salt"))


def clean_key(c):
    """Trimmed (any white space) lower-case text, null when nothing is left."""
    return F.nullif(F.lower(F.regexp_replace(c, r"(?U)^\s+|\s+$", "")), F.lit(""))
