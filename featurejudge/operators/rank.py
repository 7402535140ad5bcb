"""Flag impact, importance ranking, rank consensus, model comparison,
coefficient summaries, rule scorecards and feature profiles.

Inputs here are either row-sized (flag impact, scorecard: one aggregation
pass each) or already bounded by the number of features / models
(importance and run tables), where small windows are fine.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from featurejudge.functions.text import display_label, percent_text


def flag_impact(df: DataFrame, flags: Sequence[str], label: str) -> DataFrame:
    """One row per flag: rows, flagged count, prevalence, outcome rate among
    flagged rows (null labels ignored) and the prevalence as percent text.
    One aggregation pass for all flags."""
    aggs = [F.count(F.lit(1)).alias("_n")]
    for i, f in enumerate(flags):
        aggs += [F.sum(F.col(f)).alias(f"_s{i}"),
                 F.avg(F.when(F.col(f) == 1, F.col(label))).alias(f"_r{i}")]
    one = df.agg(*aggs)
    rows = one.select(F.explode(F.array(*[
        F.struct(F.lit(f).alias("flag"), F.col("_n").cast("long").alias("n_rows"),
                 F.coalesce(F.col(f"_s{i}"), F.lit(0)).cast("long").alias("n_flagged"),
                 F.try_divide(F.col(f"_s{i}"), F.col("_n")).cast("double").alias("prevalence"),
                 F.col(f"_r{i}").cast("double").alias("outcome_rate"))
        for i, f in enumerate(flags)])).alias("r")).select("r.*")
    return rows.withColumn("prevalence_pct", percent_text("prevalence"))


def conditional_rates(df: DataFrame, flag: str, labels: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Mean of each label where ``flag`` is 1 and where it is 0, per group."""
    aggs = [F.count(F.lit(1)).alias("n_rows"), F.sum(F.col(flag)).cast("long").alias("n_flagged")]
    for y in labels:
        aggs += [F.count(F.col(y)).alias(f"n_{y}"),
                 F.avg(F.when(F.col(flag) == 1, F.col(y))).cast("double").alias(f"{y}_rate_flag1"),
                 F.avg(F.when(F.col(flag) == 0, F.col(y))).cast("double").alias(f"{y}_rate_flag0")]
    return df.groupBy(*by).agg(*aggs)


def importance_rank(imp: DataFrame, model: str = "model", feature: str = "feature",
                    value: str = "importance") -> DataFrame:
    """Rank 1 = most important within each model; ties by feature name.
    Importance tables hold one row per (model, feature)."""
    w = Window.partitionBy(model).orderBy(F.desc(value), F.asc(feature))
    return imp.withColumn("rank", F.row_number().over(w))


def top_features(imp: DataFrame, k: int, model: str = "model", feature: str = "feature",
                 value: str = "importance") -> DataFrame:
    """The k most important features of each model (ties by name), e.g. the
    top-15 / top-20 / first-3 listings of the surveyed reports."""
    return importance_rank(imp, model, feature, value).where(F.col("rank") <= k)


def rank_consensus(ranked: DataFrame, features: Sequence[str], models: Sequence[str],
                   sentinel: int | None = None, model: str = "model", feature: str = "feature",
                   theory_terms: Sequence[str] = ("supply", "naval")) -> DataFrame:
    """Rank of each listed feature in each model, the mean rank, the position
    by mean rank (ties by name) and a display label.

    A feature missing from a model has rank null (mean over the present
    ranks); with ``sentinel`` it gets that rank instead (the surveyed
    workflow used 99).  ``is_theory`` marks names containing a theory term;
    ``rank_among_all`` is the mean-rank position among *all* ranked
    features, so the verdict is not decided by the short list alone."""
    spark = ranked.sparkSession
    wanted = spark.createDataFrame([(f,) for f in features], f"{feature} string")
    grid = wanted.select(feature, F.explode(F.array(*[F.lit(m) for m in models])).alias(model))
    r = grid.join(ranked.select(model, feature, "rank"), [model, feature], "left")
    if sentinel is not None:
        r = r.withColumn("rank", F.coalesce(F.col("rank"), F.lit(sentinel)))
    wide = r.groupBy(feature).agg(
        *[F.max(F.when(F.col(model) == m, F.col("rank"))).alias(f"rank_{m}") for m in models],
        F.avg("rank").alias("avg_rank"))
    pos = Window.orderBy(F.asc_nulls_last("avg_rank"), F.asc(feature))  # bounded: one row per listed feature
    all_avg = ranked.groupBy(feature).agg(F.avg("rank").alias("_avg_all"))
    all_pos = all_avg.withColumn("rank_among_all", F.row_number().over(
        Window.orderBy(F.asc("_avg_all"), F.asc(feature)))).select(feature, "rank_among_all")
    theory = F.lit(False)
    for t in theory_terms:
        theory = theory | F.lower(F.col(feature)).contains(t)
    out = (wide.withColumn("position", F.row_number().over(pos))
               .withColumn("display_name", display_label(feature))
               .withColumn("is_theory", theory.cast("int"))
               .join(all_pos, feature, "left"))
    # verdict: does a theory feature rank first among ALL ranked features?
    best = F.min(F.when(F.col("is_theory") == 1, F.col("rank_among_all"))).over(Window.partitionBy())
    return out.withColumn("verdict", F.when(best == 1, F.lit("YES")).otherwise(F.lit("NO")))


def compare_models(runs: DataFrame, model: str = "model", metric: str = "accuracy",
                   places: int = 4) -> DataFrame:
    """Models sorted by the metric (desc), rounded, with their position."""
    w = Window.orderBy(F.desc(metric), F.asc(model))  # run tables: one row per model
    return runs.select(model, F.round(F.col(metric), places).alias(metric)) \
               .withColumn("position", F.row_number().over(w))


def coef_summary(coefs: DataFrame, feature: str = "feature", coef: str = "coef",
                 top: int | None = 15, places: int | None = None) -> DataFrame:
    """Mean and sum of |coef| over classes per feature, ranked by the mean.
    With ``places`` the sum is rounded first and the mean is that sum over
    the class count, so equal inputs give bit-equal means (no rounding tie
    decides the order)."""
    s = coefs.groupBy(feature).agg(F.sum(F.abs(coef)).alias("sum_abs_coef"), F.count(F.lit(1)).alias("_k"))
    if places is not None:
        s = s.withColumn("sum_abs_coef", F.round("sum_abs_coef", places))
    s = s.select(feature, (F.col("sum_abs_coef") / F.col("_k")).alias("mean_abs_coef"), "sum_abs_coef")
    if top is not None:
        s = s.orderBy(F.desc("mean_abs_coef"), F.asc(feature)).limit(top)
    return s.withColumn("position", F.row_number().over(
        Window.orderBy(F.desc("mean_abs_coef"), F.asc(feature))))


def top_coefficient_rows(coefs: DataFrame, k: int = 10, feature: str = "feature", coef: str = "coef",
                         places: int | None = None) -> DataFrame:
    """The coefficient rows of the ``k`` features with the greatest sum of
    absolute coefficients (ties by name), with that sum and the position.
    The k best are found from one row a feature and looked up by a join."""
    total = F.sum(F.abs(coef))
    best = (coefs.groupBy(feature).agg((total if places is None else F.round(total, places)).alias("sum_abs_coef"))
            .orderBy(F.desc("sum_abs_coef"), F.asc(feature)).limit(k))
    best = best.withColumn("position", F.row_number().over(Window.orderBy(F.desc("sum_abs_coef"), F.asc(feature))))   # k rows
    return coefs.join(F.broadcast(best), feature)


def first_features_line(imp: DataFrame, k: int = 3, model: str = "model", feature: str = "feature", value: str = "importance") -> DataFrame:
    """(model, line, n): the first ``k`` features of each model as a line of a
    text report, "1. a, 2. b, 3. c"."""
    top = top_features(imp, k, model, feature, value)
    entry = F.struct("rank", F.concat(F.col("rank").cast("string"), F.lit(". "), F.col(feature)).alias("t"))
    return top.groupBy(model).agg(F.array_sort(F.collect_list(entry)).alias("e")).select(
        model, F.array_join(F.transform("e", lambda e: e["t"]), ", ").alias("line"), F.size("e").cast("long").alias("n"))


def scorecard(df: DataFrame, key: str, label: str, rules: Sequence[tuple[Column, str, str]],
              sep: str = " | ") -> DataFrame:
    """Per row: the verdict text of each rule joined by ``sep`` and the count
    of rules that hold.  ``rules`` = [(condition, yes_text, no_text)]."""
    texts = [F.when(F.coalesce(c, F.lit(False)), F.lit(y)).otherwise(F.lit(n)) for c, y, n in rules]
    upheld = None
    for c, _, _ in rules:
        term = F.coalesce(c, F.lit(False)).cast("int")
        upheld = term if upheld is None else upheld + term
    return df.select(F.col(key), F.col(label).alias("true_outcome"),
                     upheld.alias("principles_upheld"), F.concat_ws(sep, *texts).alias("details"))


def crosstab_counts(df: DataFrame, a: str, b: str) -> DataFrame:
    return df.groupBy(a, b).agg(F.count(F.lit(1)).alias("n"))


def feature_profile(df: DataFrame, exclude: Sequence[str]) -> DataFrame:
    """Sorted feature listing with the table shape (rows, features)."""
    feats = sorted(c for c in df.columns if c not in set(exclude))
    listing = F.array(*[F.struct(F.lit(f).alias("feature"), F.lit(i + 1).alias("position"))
                        for i, f in enumerate(feats)])
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(
        F.explode(listing).alias("f"), "n_rows").select(
        "f.feature", "f.position", "n_rows", F.lit(len(feats)).alias("n_features"))
