"""Glosses compared: features of pairs, a matcher trained on pairs with known answers, and how well it does."""

from __future__ import annotations

from difflib import SequenceMatcher

import pyarrow as pa
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import DecisionTreeClassifier, LinearSVC, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Longer texts than this have no distance, as it would say nothing.
LONGEST = 50


def words(text: Column) -> Column:
    """Lower-case word tokens."""
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(r"(?U)(\w+)"), F.lit(1))


def cutoff_levenshtein(a: Column, b: Column, cutoff: int) -> Column:
    """The edit distance, -1 beyond the cutoff or if a text has LONGEST characters and more."""
    return F.when((F.length(a) >= LONGEST) | (F.length(b) >= LONGEST), -1).otherwise(F.levenshtein(a, b, cutoff))


def tversky(a: Column, b: Column, alpha: float = 0.32) -> Column:
    """Common words over common ones, alpha of what b has more and 1 - alpha of what a has more; 0 without common words."""
    a, b = F.array_distinct(a), F.array_distinct(b)
    n = F.size(F.array_intersect(a, b))
    return F.when(n == 0, 0.0).otherwise(n / (n + alpha * F.size(F.array_except(b, a)) + (1 - alpha) * F.size(F.array_except(a, b))))


def fuzzy_tversky(a: Column, b: Column, alpha: float = 0.06, cutoff: int = 8) -> Column:
    """The same with each word as common as its nearest word on the other side is near: 1 / (1 + distance), 0 beyond the
    cutoff. Of two empty sides 0."""

    def near(x: Column, other: Column) -> Column:
        d = lambda y: cutoff_levenshtein(x, y, cutoff)
        return F.array_max(F.transform(other, lambda y: F.when(d(y) < 0, 0.0).otherwise(1.0 / (1.0 + d(y)))))

    total = lambda xs, ys: F.aggregate(F.transform(xs, lambda x: F.coalesce(near(x, ys), F.lit(0.0))), F.lit(0.0), lambda s, v: s + v)
    a, b = F.array_distinct(a), F.array_distinct(b)
    common = (total(a, b) + total(b, a)) / 2
    only_a, only_b = F.size(a) - total(a, b), F.size(b) - total(b, a)
    return F.when((F.size(a) == 0) | (F.size(b) == 0) | (common <= 0), 0.0).otherwise(common / (common + alpha * only_b + (1 - alpha) * only_a))


_RATIO = T.StructType([T.StructField(n, T.DoubleType()) for n in ("ratio", "longest", "word_ratio", "word_longest")])


@F.arrow_udf(_RATIO)
def block_similarity(a: pa.Array, b: pa.Array) -> pa.Array:
    """Matching blocks, of characters and of words: twice what matches over both lengths, and the longest block over the
    shorter length; nothing of nothing is 0."""
    rows = []
    for x, y in zip(a.to_pylist(), b.to_pylist()):
        row = []
        for p, q in ((x or "", y or ""), ((x or "").split(), (y or "").split())):
            m = SequenceMatcher(None, p, q, autojunk=False)
            short = min(len(p), len(q))
            row += [m.ratio() if short else 0.0, m.find_longest_match().size / short if short else 0.0]
        rows.append(row)
    return pa.StructArray.from_arrays([pa.array([r[k] for r in rows], pa.float64()) for k in range(4)], [f.name for f in _RATIO])


#: The numeric features, in the order of the vector.
FEATURES = ["lev", "equal", "a_in_b", "b_in_a", "words_equal", "words_in", "tversky", "fuzzy", "ratio", "longest", "word_ratio", "word_longest"]


def features(pairs: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``pairs`` with the columns of FEATURES for the texts in ``a`` (the shorter, as a template gives it) and ``b`` (the
    definition). Null texts count as empty."""
    x, y = F.coalesce(F.col(a), F.lit("")), F.coalesce(F.col(b), F.lit(""))
    wx, wy = words(F.col(a)), words(F.col(b))
    num = lambda c: c.cast("double")
    out = pairs.withColumn("_block", block_similarity(x, y))
    return out.select(
        *pairs.columns, num(cutoff_levenshtein(x, y, 8)).alias("lev"), num(x == y).alias("equal"), num(F.contains(y, x)).alias("a_in_b"), num(F.contains(x, y)).alias("b_in_a"),
        num(wx == wy).alias("words_equal"), num(F.size(F.array_except(wx, wy)) == 0).alias("words_in"), num(tversky(wx, wy)).alias("tversky"), num(fuzzy_tversky(wx, wy)).alias("fuzzy"), "_block.*",
    )


def gold_pairs(mentions: DataFrame, lexemes: DataFrame) -> DataFrame:
    """(term, language, mention, a, node_id, b, match): the gloss of each mention that names a sense by id, with the glosses of
    that sense (match 1) and of the word's other senses (match 0). ``mentions``: mention, term, language, id, t;
    ``lexemes``: node_id, term, language, etymid, gloss. Null or empty glosses and ids give no pair."""
    m = mentions.where("id <> '' and t <> ''").select("mention", "term", "language", "id", F.col("t").alias("a")).distinct()
    x = lexemes.where("gloss <> ''").select("node_id", "term", "language", "etymid", F.col("gloss").alias("b")).distinct()
    p = m.join(x, ["term", "language"]).withColumn("match", F.coalesce(F.col("id") == F.col("etymid"), F.lit(False)).cast("int"))
    known = p.where("match = 1").select("mention").distinct()
    return p.join(known, "mention", "left_semi").select("term", "language", "mention", "a", "node_id", "b", "match")


def split_by(df: DataFrame, keys: list[str], test_share: float = 0.2, seed: int = 1) -> tuple[DataFrame, DataFrame]:
    """(training, test): all rows of a key are on one side, told by a hash."""
    h = F.pmod(F.xxhash64(*keys, F.lit(seed)), F.lit(1_000_000))
    return df.where(h >= int(test_share * 1_000_000)), df.where(h < int(test_share * 1_000_000))


MODELS = {
    "logistic": lambda: LogisticRegression(featuresCol="scaled", labelCol="match", weightCol="weight"),
    "tree": lambda: DecisionTreeClassifier(featuresCol="scaled", labelCol="match", weightCol="weight", maxDepth=5, seed=1),
    "forest": lambda: RandomForestClassifier(featuresCol="scaled", labelCol="match", weightCol="weight", numTrees=20, seed=1),
    "svm": lambda: LinearSVC(featuresCol="scaled", labelCol="match", weightCol="weight"),
}


def train(pairs: DataFrame, model: str = "logistic", using: list[str] = FEATURES) -> PipelineModel:
    """A matcher fitted to pairs with FEATURES and ``match``; both answers weigh the same."""
    n = pairs.agg(F.count_if(F.col("match") == 1).alias("p"), F.count_if(F.col("match") == 0).alias("q")).first()
    weight = F.when(F.col("match") == 1, 0.5 / max(1, n.p)).otherwise(0.5 / max(1, n.q)) * (n.p + n.q)
    stages = [VectorAssembler(inputCols=list(using), outputCol="raw"), StandardScaler(inputCol="raw", outputCol="scaled", withMean=True), MODELS[model]()]
    return Pipeline(stages=stages).fit(pairs.withColumn("weight", weight))


def predict(model: PipelineModel, pairs: DataFrame) -> DataFrame:
    """``pairs`` with ``p``, the probability of a match (of a model without one, its answer)."""
    out = model.transform(pairs.withColumn("weight", F.lit(1.0)))
    p = vector_to_array("probability")[1] if "probability" in out.columns else F.col("prediction")
    return out.withColumn("p", p).select(*pairs.columns, "p")


def best_match(scored: DataFrame, keys: list[str], threshold: float = 0.0) -> DataFrame:
    """``scored`` with ``chosen``: 1 on the row of the largest p of each of ``keys`` (the smallest node_id on a tie) if it
    reaches the threshold, else 0."""
    top = scored.groupBy(*keys).agg(F.min(F.struct((-F.col("p")).alias("q"), "node_id"))["node_id"].alias("_top"))
    return scored.join(top, keys).withColumn("chosen", ((F.col("node_id") == F.col("_top")) & (F.col("p") >= threshold)).cast("int")).drop("_top")


def quality(scored: DataFrame, said: Column, truth: Column) -> DataFrame:
    """(n, precision, recall, f1) of yes-no answers; a share of nothing is 0."""
    c = scored.agg(F.count("*").alias("n"), F.count_if(said & truth).alias("tp"), F.count_if(said & ~truth).alias("fp"), F.count_if(~said & truth).alias("fn"))
    share = lambda a, b: F.when(b > 0, a / b).otherwise(0.0)
    p, r = share(F.col("tp"), F.col("tp") + F.col("fp")), share(F.col("tp"), F.col("tp") + F.col("fn"))
    return c.select("n", F.round(p, 6).alias("precision"), F.round(r, 6).alias("recall"), F.round(share(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn")), 6).alias("f1"))


def sense_level(scored: DataFrame) -> DataFrame:
    """(term, language, mention, node_id, match, p): of the several glosses of a sense the best (the maximum of a group)."""
    return scored.groupBy("term", "language", "mention", "node_id").agg(F.max("match").alias("match"), F.max("p").alias("p"))
