"""Several values packed in one field: split by delimiter skeletons.

A text is cut into runs: every delimiter, quotation mark or white space character is a run by itself, everything
between is one ordinary run. Writing ``a`` for each ordinary run gives the skeleton, whose character i stands for run
i. How to split depends on the skeleton alone, so the rules are worked out once per distinct skeleton, sent to all
executors (after a check of their size) and applied by position, within the JVM.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexweave.plans.runtime import cut

#: Characters that end a value wherever they stand outside quotes.
HARD = "|,;\n\t\r"
#: Opening quotation marks and the mark that closes each.
QUOTES = {'"': '"', "“": "”", "„": "“", "«": "»"}
_MASKED = HARD + "/  " + "".join(QUOTES) + "".join(QUOTES.values())
_CLASS = "".join("\\" + c if c in "|\\^-[]" else c for c in dict.fromkeys(_MASKED))
_ORDINARY = f"[^{_CLASS}]+"
#: White space at the ends of a value, as Unicode has it.
SPACE = "".join(c for c in map(chr, range(0x3001)) if c.isspace() and c not in "\x1c\x1d\x1e\x1f")
#: Rules are broadcast up to this many characters of skeletons, joined by a salted shuffle beyond.
BROADCAST_CHARS = 16_000_000
SALTS = 32

RULE = T.ArrayType(T.StructType([T.StructField("first", T.IntegerType()), T.StructField("n", T.IntegerType()), T.StructField("mark", T.StringType())]))


def skeleton(text: Column) -> Column:
    return F.regexp_replace(text, _ORDINARY, "a")


def split_rule(s: str) -> list[tuple[int, int, str]]:
    """Values of a skeleton as (first run, number of runs, closing mark or "").

    A value ends at a hard delimiter or at a slash between spaces. A quotation mark opens a quoted value only at the
    value's start, and only if a closing mark (a doubled one doesn't close) is followed by a delimiter or the end;
    otherwise it is an ordinary character. Values of nothing but spaces are left out.
    """
    out, i, n = [], 0, len(s)

    def slash(j: int) -> bool:
        return s[j] == "/" and 0 < j < n - 1 and s[j - 1] in "  " and s[j + 1] in "  "

    def ends(j: int) -> int:
        """The index at which the next value starts if a value may end at j, else -1."""
        while j < n and s[j] in "  ":
            j += 1
        if j >= n:
            return n + 1
        return j + 1 if s[j] in HARD or slash(j) else -1

    while i <= n:
        while i < n and s[i] in "  ":
            i += 1
        if i >= n:
            break
        close = QUOTES.get(s[i])
        if close:
            j, after = i + 1, -1
            while j < n:
                if s[j] == close:
                    if j + 1 < n and s[j + 1] == close:
                        j += 2
                        continue
                    if (after := ends(j + 1)) >= 0:
                        break
                j += 1
            if after >= 0:
                if any(c not in "  " for c in s[i + 1 : j]):
                    out.append((i + 1, j - i - 1, close))
                i = after
                continue
        j = i
        while j < n and not (s[j] in HARD or slash(j)):
            j += 1
        if j > i:
            out.append((i, j - i, ""))
        i = j + 1
    return out


@F.arrow_udf(RULE)
def _rules(skeletons: pa.Array) -> pa.Array:
    rows = [[{"first": a, "n": b, "mark": c} for a, b, c in split_rule(s)] for s in skeletons.to_pylist()]
    return pa.array(rows, pa.list_(pa.struct([("first", pa.int32()), ("n", pa.int32()), ("mark", pa.string())])))


def split_packed(df: DataFrame, key: Column, text: Column, near: Column | None = None) -> DataFrame:
    """One row per value of ``text``: (rec_key, pos, val), pos from 1 without the empty ones.

    Rows with a null key or text, or with nothing but delimiters, give no rows. Repeated rows are split once: rows that
    agree in key and text are the same record. Ties don't arise, as position is unique in a record. Only the given
    expressions are read, so other columns may have any names. An empty table gives an empty result. With ``near``, a
    function of the key, records that agree in it lie in one file of the table the texts are kept in meanwhile.
    """
    by = [near.alias("near")] if near is not None else []
    base = df.select(*by, key.alias("rec_key"), text.alias("t")).where("rec_key is not null and t is not null and t <> ''")
    base = (base.repartition("near") if by else base).distinct().drop("near")
    base = cut(base.withColumn("s", skeleton("t")))
    distinct = base.select("s").distinct()
    size = distinct.agg(F.coalesce(F.sum(F.length("s")), F.lit(0))).first()[0]
    rules = distinct.withColumn("rule", _rules("s"))
    if size <= BROADCAST_CHARS:
        ruled = base.join(F.broadcast(rules), "s")
    else:
        salted = rules.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        ruled = base.withColumn("salt", F.pmod(F.xxhash64("rec_key"), F.lit(SALTS)).cast("int")).join(salted, ["s", "salt"])
    runs = F.regexp_extract_all("t", F.lit(f"({_ORDINARY}|[{_CLASS}])"), F.lit(1))

    def value(r: Column) -> Column:
        raw = F.array_join(F.slice(F.col("runs"), r["first"] + 1, r["n"]), "")
        return F.btrim(F.when(r["mark"] != "", F.replace(raw, F.concat(r["mark"], r["mark"]), r["mark"])).otherwise(raw), F.lit(SPACE))

    vals = F.filter(F.transform("rule", value), lambda v: v != "")
    return ruled.select("rec_key", "rule", runs.alias("runs")).select("rec_key", F.posexplode(vals)).select("rec_key", (F.col("pos") + 1).cast("int").alias("pos"), F.col("col").alias("val"))
