"""Quality classifier as a sparse rule ensemble (operator 9).

Statistics of whole texts come from built-in functions.  Gradient-boosted trees
over a bounded sample of labelled rows give candidate rules: every path from a
root to a node is a conjunction of comparisons.  A lasso logistic regression
weighs the rules and drops most; the rest become one Spark column expression,
so scoring runs no Python and no model object.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featurejudge.llm.common import LEARN_ROWS, cut_lineage, labelled_ids, lower_ascii, words

TREES, DEPTH = 20, 3
LASSO = 0.001
SEED = 17
_SPACES = " \t\n\x0b\x0c\r"


def statistics(text: Column) -> dict[str, Column]:
    """Statistics of a text's word array ``w`` and the text itself; all are
    finite for null, empty and wordless texts."""
    text = F.coalesce(text, F.lit(""))
    chars = F.greatest(F.length(F.translate(text, _SPACES, "")), F.lit(1))

    def share(dropped: Column) -> Column:
        return (F.length(text) - F.length(dropped)) / chars
    n = F.greatest(F.size("w"), F.lit(1))
    lines = F.filter(F.split(text, "\n"), lambda x: F.length(F.translate(x, _SPACES, "")) > 0)
    return {
        "words": F.log1p(F.size("w")),
        "word_length": F.when(F.size("w") > 0, chars / n).otherwise(0.0),
        "distinct_words": F.size(F.array_distinct("w")) / n,
        "upper": share(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "")),
        "digits": share(F.translate(text, "0123456789", "")),
        "symbols": share(F.translate(text, "#*$%&|<>", "")),
        "stops": share(F.translate(text, ".,;:", "")),
        "shouts": share(F.translate(text, "!?", "")),
        "brackets": share(F.translate(text, "()[]{}=_/\\", "")),
        "lines": F.log1p(F.size(lines)),
        "distinct_lines": F.size(F.array_distinct(lines)) / F.greatest(F.size(lines), F.lit(1)),
        "words_a_line": F.log1p(n / F.greatest(F.size(lines), F.lit(1))),
    }


FEATURES = ("words", "word_length", "distinct_words", "upper", "digits", "symbols", "stops", "shouts", "brackets", "lines",
            "distinct_lines", "words_a_line")


def with_statistics(docs: DataFrame) -> DataFrame:
    """(doc_id, one column a feature) a row of ``docs`` (doc_id, text)."""
    split = docs.select("doc_id", "text", words(lower_ascii(F.col("text"))).alias("w"))
    found = statistics(F.col("text"))
    return split.select("doc_id", *[F.round(found[f].cast("double"), 9).alias(f) for f in FEATURES])


@dataclass(frozen=True)
class Rule:
    """A conjunction of (feature, "<=" or ">", threshold)."""
    terms: tuple
    weight: float = 0.0

    def condition(self) -> Column:
        out = F.lit(True)
        for feature, sign, value in self.terms:
            out = out & (F.col(feature) <= value if sign == "<=" else F.col(feature) > value)
        return out


def paths(node, terms: tuple = ()) -> list[tuple]:
    """Conditions of every node below the root of a fitted tree, with terms of
    one feature and sign merged to the strictest."""
    out = []
    if terms:
        strict: dict = {}
        for f, sign, value in terms:
            kept = strict.get((f, sign))
            strict[f, sign] = value if kept is None else min(kept, value) if sign == "<=" else max(kept, value)
        out.append(tuple(sorted((f, sign, v) for (f, sign), v in strict.items())))
    if node.subtreeDepth() > 0:
        split = node.split()
        f, value = FEATURES[split.featureIndex()], split.threshold()
        out += paths(node.leftChild(), (*terms, (f, "<=", value)))
        out += paths(node.rightChild(), (*terms, (f, ">", value)))
    return out


@dataclass(frozen=True)
class Ensemble:
    rules: tuple
    intercept: float

    def score(self) -> Column:
        """1 / (1 + exp(-(intercept + sum of the weights of the rules that hold)))."""
        total = F.lit(self.intercept)
        for rule in self.rules:
            total = total + F.when(rule.condition(), rule.weight).otherwise(0.0)
        return 1 / (1 + F.exp(-total))


def fit(learning: DataFrame) -> Ensemble:
    """Learn from a bounded table of features, a 0/1 ``label`` and the ``weight``
    of a row.  No row gives the score 0.5, a single label (smoothed) its share."""
    counts = {r["label"]: r["count"] for r in learning.groupBy("label").agg(F.sum("weight").alias("count")).collect()}
    n, good = sum(counts.values()), counts.get(1, 0)
    if len(counts) < 2:
        share = (good + 0.5) / (n + 1)
        return Ensemble((), math.log(share / (1 - share)))
    trees = GBTClassifier(featuresCol="x", labelCol="label", weightCol="weight", maxIter=TREES, maxDepth=DEPTH, seed=SEED,
                          minInstancesPerNode=3, maxMemoryInMB=64)
    data = learning.select(F.col("label").cast("double").alias("label"), "weight", *FEATURES,
                           array_to_vector(F.array(*FEATURES)).alias("x"))
    model = trees.fit(data)
    rules = sorted({p for tree in model._java_obj.trees() for p in paths(tree.rootNode())})
    if not rules:
        share = good / n
        return Ensemble((), math.log(share / (1 - share)))
    held = data.select("label", "weight", array_to_vector(F.array(*[Rule(r).condition().cast("double") for r in rules])).alias("x"))
    lasso = LogisticRegression(featuresCol="x", labelCol="label", weightCol="weight", elasticNetParam=1.0, regParam=LASSO,
                               maxIter=200, standardization=False).fit(cut_lineage(held))
    weights = lasso.coefficients.toArray()
    return Ensemble(tuple(Rule(r, float(w)) for r, w in zip(rules, weights) if w), float(lasso.intercept))


def score(docs: DataFrame, labels: DataFrame, learn: Column, threshold: float = 0.7, learn_rows: int = LEARN_ROWS) -> DataFrame:
    """(doc_id, score, predicted), one row a row of ``docs`` (doc_id, text),
    learned from ``labels`` (doc_id, quality) of documents for which ``learn``
    holds, at most ``learn_rows`` of each label (a sample by hash of the id, weighted
    to the label shares of all of them).

    Null and empty texts have statistics of their own and are scored like any
    other; null ids are kept and not learned from; repeated rows score alike; a
    document with both labels counts under both; other columns are ignored."""
    table = cut_lineage(with_statistics(docs))
    ids = labelled_ids(labels, "quality", learn, learn_rows)
    learning = table.join(F.broadcast(ids), table["doc_id"] == ids["__id"]).select(ids["label"], ids["weight"], *FEATURES)
    ensemble = fit(cut_lineage(learning))
    return (table.select("doc_id", ensemble.score().alias("score"))
            .withColumn("predicted", (F.col("score") >= threshold).cast("int")))

