"""The types of relations as a tree, with its closure as a small table of fixed size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The relation types, indented below their parent.
TREE = """
related
  sibling
    cognate
    noncognate
    doublet
    alternative form
  origin
    historical
      inheritance
      derivation
      root
    borrowing
      learned borrowing
      semi-learned borrowing
      orthographic borrowing
      unadapted borrowing
      calque
      partial calque
      semantic loan
      phono-semantic matching
    morphological
      affix
        prefix
        infix
        suffix
        confix
        circumfix
      compound
      univerbation
      blending
      clipping
      back-formation
      abbreviation
      shortening
    other
      unknown
      eponym
      onomatopoeic
"""


def _parents() -> dict[str, str | None]:
    out: dict[str, str | None] = {}
    trail: list[str] = []
    for line in TREE.strip("\n").split("\n"):
        name = line.strip()
        level = (len(line) - len(line.lstrip())) // 2
        trail[level:] = [name]
        out[name] = trail[level - 1] if level else None
    return out


PARENT = _parents()


def ancestors(name: str) -> list[str]:
    """The type itself and everything above it, the nearest first."""
    out = [name]
    while PARENT.get(out[-1]):
        out.append(PARENT[out[-1]])
    return out


def below(*names: str) -> list[str]:
    """The types and all their descendants."""
    return [t for t in PARENT if set(names) & set(ancestors(t))]


def is_a(name: str, other: str) -> bool:
    return other in ancestors(name)


DIRECTED = tuple(below("origin"))
SIBLING = tuple(below("sibling"))
HISTORICAL = tuple(below("historical"))


def types_table(spark: SparkSession) -> DataFrame:
    """(type, parent, depth, directed)."""
    return spark.createDataFrame([(t, p, len(ancestors(t)) - 1, t in DIRECTED) for t, p in PARENT.items()], "type string, parent string, depth int, directed boolean")


def closure_table(spark: SparkSession) -> DataFrame:
    """(type, ancestor) for every type and everything above it, itself left out."""
    return spark.createDataFrame([(t, a) for t in PARENT for a in ancestors(t)[1:]], "type string, ancestor string")


def type_case(c: Column) -> Column:
    """Lower-case type name, ``related`` where null or unknown."""
    t = F.lower(F.trim(c))
    return F.when(t.isin(*PARENT), t).otherwise("related")
