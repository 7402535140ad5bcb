"""MLlib fits and scoring, importance tables and permutation importance.

Fits run distributed in MLlib; every output is a DataFrame.  Feature names
travel as the ordered list given to the VectorAssembler and are joined back
by position, so importance tables always carry names.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (GBTClassifier, LogisticRegression, MultilayerPerceptronClassifier,
                                       OneVsRest, OneVsRestModel, RandomForestClassifier)
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featurejudge.operators.cumulative import exact_rank
from featurejudge.operators.evaluate import accuracy
from featurejudge.operators.oversample import replicate_balance, smote  # noqa: F401
from featurejudge.session import cut_lineage

WORDS = 16      # words of 64 bits in a row of marked ranks
MAX_DEPTH = 30  # MLlib's limit; "unlimited depth" is capped here


def sized_for_training(df: DataFrame, n_rows: int, rows_per_partition: int = 100_000) -> DataFrame:
    """Partition a training frame for iterative MLlib fits: about
    ``rows_per_partition`` rows per task, without an upper limit on tasks.  Every optimizer iteration is a Spark job, so a few hundred rows
    spread over many tasks pay the scheduling cost hundreds of times, while
    a large frame keeps every core busy."""
    try:
        current = df.rdd.getNumPartitions()
    except Exception:  # no RDD view (e.g. a Spark Connect session): leave as is
        return df
    target = max(1, math.ceil(n_rows / rows_per_partition))
    if target < current:
        return df.coalesce(target)
    return df.repartition(target) if target > current else df


def spread_for_trees(df: DataFrame, n_rows: int, least_rows: int = 500, most_rows: int = 100_000) -> DataFrame:
    """Partition the training frame of a forest: every row is met by every tree
    at every level, so a few thousand rows are work for all cores.  A task for
    each core, as long as it gets ``least_rows``.  Beyond ``most_rows`` a task
    every core gets one more, dealt evenly: a level ends with its last task, so
    13 tasks on 12 cores would take it twice as long as 12."""
    try:
        cores = df.sparkSession.sparkContext.defaultParallelism
        current = df.rdd.getNumPartitions()
    except Exception:  # no RDD view: leave as is
        return df
    if n_rows // least_rows < cores:
        target = n_rows // least_rows
        return df.repartition(target) if target > current else df
    target = cores * math.ceil(n_rows / (cores * most_rows))
    return df.repartition(target) if target != current else df


def assembler(features: Sequence[str], out: str = "features") -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol=out, handleInvalid="keep")


def logistic_pipeline(features, label="target", weight: str | None = None, reg: float = 0.0,
                      ovr: bool = False, max_iter: int = 1000) -> Pipeline:
    lr = LogisticRegression(featuresCol="features", labelCol=label, regParam=reg, maxIter=max_iter,
                            elasticNetParam=0.0)
    if weight:
        lr.setWeightCol(weight)
    est = OneVsRest(classifier=lr, featuresCol="features", labelCol=label) if ovr else lr
    if ovr and weight:
        est.setWeightCol(weight)
    return Pipeline(stages=[assembler(features), est])


def c_to_reg(c: float, total_weight: float) -> float:
    """scikit-learn's inverse strength C -> MLlib regParam (L2): the data
    term is a weighted sum there and a weighted mean here."""
    return 1.0 / (c * total_weight)


def logistic_cv(train: DataFrame, features, label="target", weight: str | None = None,
                n_strengths: int = 50, folds: int = 5, parallelism: int = 8, seed: int = 42,
                fold_col: str | None = None, max_iter: int = 1000):
    """Cross-validated L2 strength over a log grid (1e-4..1e4 as C), accuracy
    as the metric, refit on all training rows."""
    n = train.count() if weight is None else train.agg(F.sum(weight)).first()[0]
    grid_c = np.logspace(-4, 4, n_strengths)
    pipe = logistic_pipeline(features, label, weight, max_iter=max_iter)
    lr = pipe.getStages()[-1]
    grid = ParamGridBuilder().addGrid(lr.regParam, [c_to_reg(float(c), float(n)) for c in grid_c]).build()
    ev = MulticlassClassificationEvaluator(labelCol=label, predictionCol="prediction", metricName="accuracy")
    cv = CrossValidator(estimator=pipe, estimatorParamMaps=grid, evaluator=ev, numFolds=folds,
                        parallelism=parallelism, seed=seed)
    if fold_col:
        cv.setFoldCol(fold_col)
    return cv.fit(train)


def forest_pipeline(features, label="target", weight: str | None = None, trees: int = 1200,
                    depth: int = MAX_DEPTH, seed: int = 42) -> Pipeline:
    rf = RandomForestClassifier(featuresCol="features", labelCol=label, numTrees=trees,
                                maxDepth=min(depth, MAX_DEPTH), featureSubsetStrategy="sqrt", seed=seed,
                                minInstancesPerNode=1,
                                # deep trees: a row keeps its node in each tree, instead of each job
                                # getting all trees and walking every row down from the root
                                cacheNodeIds=True)
    if weight:
        rf.setWeightCol(weight)
    return Pipeline(stages=[assembler(features), rf])


def boosted_pipeline(features, label="target", rounds: int = 1000, depth: int = 7, rate: float = 0.05,
                     row_sample: float = 0.9, col_sample: float = 0.8, seed: int = 42,
                     n_classes: int = 2) -> Pipeline:
    """Gradient-boosted trees; MLlib's GBT is binary, so more classes go
    through one-vs-rest."""
    gbt = GBTClassifier(featuresCol="features", labelCol=label, maxIter=rounds, maxDepth=depth,
                        stepSize=rate, subsamplingRate=row_sample,
                        featureSubsetStrategy=str(col_sample), seed=seed)
    est = gbt if n_classes <= 2 else OneVsRest(classifier=gbt, featuresCol="features", labelCol=label)
    return Pipeline(stages=[assembler(features), est])


def perceptron_pipeline(features, n_classes: int, label="target", hidden=(128, 64, 32),
                        max_iter: int = 200, seed: int = 42) -> Pipeline:
    mlp = MultilayerPerceptronClassifier(featuresCol="features", labelCol=label,
                                         layers=[len(features), *hidden, n_classes], maxIter=max_iter,
                                         seed=seed)
    return Pipeline(stages=[assembler(features), mlp])


def predictions(model: PipelineModel, df: DataFrame, keep: Sequence[str]) -> DataFrame:
    """(keep..., prediction, probability array).  One-vs-rest models are
    scored by their parts, in the JVM: the class of the greatest raw score (the
    first of equal ones), and every part's positive probability, normalised to
    the sum 1."""
    last = _last_stage(model)
    if not isinstance(last, OneVsRestModel):
        out = model.transform(df)
        prob = vector_to_array("probability") if "probability" in out.columns else F.lit(None).cast("array<double>")
        return out.select(*keep, F.col("prediction").cast("int").alias("prediction"), prob.alias("probability"))
    out = df
    for stage in getattr(model, "bestModel", model).stages[:-1]:
        out = stage.transform(out)
    each = range(len(last.models))
    for i, one in enumerate(last.models):
        out = one.copy({one.probabilityCol: f"_prob{i}", one.predictionCol: f"_pred{i}", one.rawPredictionCol: f"_raw{i}"}).transform(out)
    raw = F.array(*[vector_to_array(f"_raw{i}")[1] for i in each])
    probs = [vector_to_array(f"_prob{i}")[1] for i in each]
    total = sum(probs[1:], probs[0])
    prob = F.array(*[F.when(total > 0, p / total).otherwise(1.0 / len(probs)) for p in probs])
    return out.select(*keep, (F.array_position(raw, F.array_max(raw)) - 1).cast("int").alias("prediction"), prob.alias("probability"))


def _last_stage(model):
    m = model.bestModel if hasattr(model, "bestModel") else model
    return m.stages[-1] if isinstance(m, PipelineModel) else m


def importance_table(model, features: Sequence[str], model_name: str) -> DataFrame:
    """(model, feature, importance) from tree impurity importances."""
    stage = _last_stage(model)
    imp = stage.featureImportances.toArray().tolist()
    spark = _spark()
    return spark.createDataFrame([(model_name, f, float(v)) for f, v in zip(features, imp)],
                                 "model string, feature string, importance double")


def coefficient_table(model, features: Sequence[str], model_name: str) -> DataFrame:
    """(model, class, feature, coef) from a logistic model."""
    stage = _last_stage(model)
    cm = stage.coefficientMatrix.toArray()
    rows = [(model_name, int(k), f, float(cm[k, j])) for k in range(cm.shape[0]) for j, f in enumerate(features)]
    return _spark().createDataFrame(rows, "model string, class int, feature string, coef double")


def _spark():
    from pyspark.sql import SparkSession
    return SparkSession.getActiveSession()


def _steps(n: int, combos: int, seed: int) -> list[tuple[int, int]]:
    """For each shuffle a multiplier without a common factor with n, and a shift."""
    rng, out = np.random.default_rng(seed), []
    while len(out) < combos:
        a = int(rng.integers(1, 1 << 20)) | 1
        if math.gcd(a, n) == 1:
            out.append((a, int(rng.integers(0, max(n, 1)))))
    return out


def permuted_pairs(rows: DataFrame, features: Sequence[str], key: str, repeats: int, seed: int = 42) -> DataFrame:
    """(target_rank, feature, repeat, slot, donor, value): who gives its value
    of a feature to whom, in each of ``repeats`` shuffles a feature.

    The rows are ranked once, 0 to n - 1, in a random order (by a seeded
    hash).  In a shuffle the row of rank j gives to rank (a * j + b) mod n; as
    ``a`` and n have no common factor, that is a bijection, so no shuffle needs
    a sort of its own.  ``key`` must be unique."""
    ranked = _ranked(rows.select(key, *features), key, seed)
    return _pairs(ranked, features, repeats, seed, ranked.count())


def _ranked(rows: DataFrame, key: str, seed: int) -> DataFrame:
    hashed = rows.withColumn("_h", F.xxhash64(F.lit(seed), F.col(key)))
    return cut_lineage(exact_rank(hashed, ["_h", key]).drop("_h").withColumn("_rank", F.col("_rank").cast("long") - 1))


def _pairs(ranked: DataFrame, features: Sequence[str], repeats: int, seed: int, n: int) -> DataFrame:
    steps = _steps(n, len(features) * repeats, seed)
    gifts = F.array(*[F.struct(F.lit(f).alias("feature"), F.lit(r).alias("repeat"), F.lit(i * repeats + r).alias("slot"),
                               F.pmod(F.col("_rank") * F.lit(steps[i * repeats + r][0]) + F.lit(steps[i * repeats + r][1]), F.lit(max(n, 1)))
                               .alias("target_rank"), F.col(f"`{f}`").cast("double").alias("value"))
                      for i, f in enumerate(features) for r in range(repeats)])
    return ranked.select(F.col("_rank").alias("donor"), F.explode(gifts).alias("g")).select(
        "g.target_rank", "g.feature", "g.repeat", "g.slot", "donor", "g.value")


def distinct_ranks(rows: DataFrame, by: Sequence[str], number: str, ranks: dict[str, str]) -> DataFrame:
    """(by..., ``number`` of rows, distinct values of each column of ``ranks``
    under its new name).  Ranks are numbers from 0 on, close together, so they
    are marked in words of 64 bits, ``WORDS`` a row, instead of being kept one
    by one: memory of 1/64 of the distinct values, exact."""
    cols = list(ranks)
    each = F.explode(F.array(*[F.struct(F.lit(i).alias("c"), F.col(c).cast("long").alias("v")) for i, c in enumerate(cols)]))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.col("v"), F.lit(64)).cast("int"))
    word = F.pmod(F.floor(F.col("v") / 64), F.lit(WORDS))
    span = F.floor(F.col("v") / (64 * WORDS))
    marked = rows.select(*by, each.alias("_e")).select(*by, "_e.c", "_e.v").groupBy(*by, "c", span.alias("_span")).agg(
        F.count(F.lit(1)).alias("_n"), *[F.bit_or(F.when(word == i, bit)).alias(f"_w{i}") for i in range(WORDS)])
    bits = sum((F.coalesce(F.bit_count(f"_w{i}"), F.lit(0)).cast("long") for i in range(WORDS)), F.lit(0).cast("long"))
    return marked.select(*by, "c", "_n", bits.alias("_bits")).groupBy(*by).agg(
        F.sum(F.when(F.col("c") == 0, F.col("_n"))).alias(number),
        *[F.sum(F.when(F.col("c") == i, F.col("_bits"))).alias(ranks[c]) for i, c in enumerate(cols)])


def permutation_importance(model: PipelineModel, test: DataFrame, features: Sequence[str], key: str,
                           label: str = "target", repeats: int = 10, seed: int = 42) -> DataFrame:
    """Mean accuracy drop when one feature's values are shuffled among the
    test rows, ``repeats`` times per feature -- all features and repeats in
    one scored job.

    The donated values of a row, one a shuffle, travel as one array keyed by
    its rank (``permuted_pairs``); a row meets its array once and is scored
    with each of the values in turn, inside its task.  A donated value equal
    to the row's own leaves the row, so its prediction, as it was: only the
    other rows are scored again, and a shuffle's accuracy is the base one plus
    what they gain or lose."""
    ranked = _ranked(test, key, seed)
    ranked = cut_lineage(model.transform(ranked.select("_rank", label, *features)).select(
        "_rank", label, *features, F.col("prediction").alias("_own")))
    first = accuracy(ranked, label, "_own").first()
    n, hits = first["n"], first["n_correct"] or 0
    # bounded: features x repeats values a row
    donors = (_pairs(ranked, features, repeats, seed, ranked.count()).groupBy("target_rank")
              .agg(F.array_sort(F.collect_list(F.struct("slot", "value"))).alias("_gifts")))
    # the arrays are many times the table whose size Spark guesses them by: never sent to the driver
    met = ranked.join(donors.hint("merge"), F.col("_rank") == F.col("target_rank"))
    shuffled = met.select(label, "_own", *features, F.explode("_gifts").alias("_g")).select(label, "_own", *features, "_g.slot", "_g.value")
    at = F.floor(F.col("slot") / repeats)
    held = F.get(F.array(*[F.col(f"`{f}`").cast("double") for f in features]), at.cast("int"))
    shuffled = shuffled.where(~F.col("value").eqNullSafe(held))
    replaced = shuffled.withColumns({f: F.when(at == i, F.col("value")).otherwise(F.col(f"`{f}`").cast("double")) for i, f in enumerate(features)})
    scored = model.transform(replaced)
    gained = scored.groupBy("slot").agg(F.sum((F.col("prediction") == F.col(label)).cast("long") - (F.col("_own") == F.col(label)).cast("long")).alias("_more"))
    # bounded: a row a shuffle
    slots = test.sparkSession.range(len(features) * repeats if n else 0).withColumnRenamed("id", "slot")
    acc = slots.join(gained, "slot", "left").select("slot", ((F.lit(hits) + F.coalesce("_more", F.lit(0))) / F.lit(n)).alias("acc"))
    lost = F.lit(hits) / F.lit(n) - F.col("acc")
    names = F.element_at(F.array(*[F.lit(f) for f in features]), (at + 1).cast("int"))
    return acc.groupBy(names.alias("feature")).agg(F.avg(lost).alias("importance_mean"), F.stddev_pop(lost).alias("importance_std"))
