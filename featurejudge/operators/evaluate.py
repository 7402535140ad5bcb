"""Evaluation tables from a prediction frame (label, prediction[, score]).

Everything is reduced to (true, predicted) counts or per-score counts first;
the class list is bounded and checked.  ROC and AUC use the bucketed
running total, so no window orders the whole prediction table in one task.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from featurejudge.operators.cumulative import exact_quantiles, running_total
from featurejudge.session import cut_lineage

MAX_CLASSES = 300             # more classes than this are refused: tables hold classes x classes cells
MAX_CELLS = 1_000_000         # of the confusion tables of all models that are evaluated at once


def class_values(df: DataFrame, *cols: str, max_classes: int = MAX_CLASSES) -> list:
    """Sorted distinct non-null values over the given columns (bounded)."""
    vals = None
    for c in cols:
        v = df.select(F.col(c).alias("_c")).where(F.col("_c").isNotNull())
        vals = v if vals is None else vals.union(v)
    rows = vals.distinct().limit(max_classes + 1).collect()
    if len(rows) > max_classes:
        raise ValueError(f"more than {max_classes} classes")
    return sorted(r[0] for r in rows)


def judged(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """The one rule for nulls in every evaluation table: a row without a label
    or without a prediction (score) is not judged."""
    return df.where(F.col(label).isNotNull() & F.col(prediction).isNotNull())


def confusion_counts(pred: DataFrame, label: str, prediction: str, classes: Sequence | None = None) -> DataFrame:
    """Dense (true_class, pred_class, n) over classes x classes; empty cells 0.

    The predictions are reduced to their counts in one pass.  The class list
    (given, or the labels and predictions that occur) is checked against
    ``MAX_CLASSES``, so the dense table is bounded and built as a local one."""
    kind = pred.schema[label].dataType
    rows = (judged(pred, label, prediction)
            .groupBy(F.col(label).alias("true_class"), F.col(prediction).cast(kind).alias("pred_class"))
            .agg(F.count(F.lit(1)).alias("n")).limit(MAX_CLASSES ** 2 + 1).collect())
    cells = {(r["true_class"], r["pred_class"]): r["n"] for r in rows}
    if classes is None:
        classes = sorted({c for cell in cells for c in cell if c is not None})
    if len(rows) > MAX_CLASSES ** 2 or len(classes) > MAX_CLASSES:
        raise ValueError(f"more than {MAX_CLASSES} classes")
    schema = T.StructType([T.StructField("true_class", kind), T.StructField("pred_class", kind), T.StructField("n", T.LongType())])
    return pred.sparkSession.createDataFrame([(a, b, cells.get((a, b), 0)) for a in classes for b in classes], schema)


def accuracy(pred: DataFrame, label: str, prediction: str) -> DataFrame:
    return judged(pred, label, prediction).agg(
                    F.count(F.lit(1)).alias("n"),
                    F.sum((F.col(label) == F.col(prediction)).cast("long")).alias("n_correct"),
                    F.avg((F.col(label) == F.col(prediction)).cast("double")).alias("accuracy"))


def per_class_stats(cm: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(by..., cls, support, tp, predicted, precision, recall, f1_score) from
    dense counts in one aggregation: each cell counts toward its true class's
    support and its predicted class's column total.  0/0 -> 0 as in the
    surveyed reports.  ``by``: columns that keep tables apart (models)."""
    cell = F.explode(F.array(
        F.struct(F.col("true_class").alias("cls"), F.col("n").alias("support"),
                 F.when(F.col("true_class") == F.col("pred_class"), F.col("n")).otherwise(0).alias("tp"),
                 F.lit(0).cast("long").alias("predicted")),
        F.struct(F.col("pred_class").alias("cls"), F.lit(0).cast("long").alias("support"),
                 F.lit(0).cast("long").alias("tp"), F.col("n").alias("predicted"))))
    s = cm.select(*by, cell.alias("c")).select(*by, "c.*").groupBy(*by, "cls").agg(
        F.sum("support").alias("support"), F.sum("tp").alias("tp"), F.sum("predicted").alias("predicted"))
    precision = F.when(F.col("predicted") > 0, F.col("tp") / F.col("predicted")).otherwise(0.0)
    recall = F.when(F.col("support") > 0, F.col("tp") / F.col("support")).otherwise(0.0)
    s = s.withColumn("precision", precision).withColumn("recall", recall)
    f1 = F.when(F.col("precision") + F.col("recall") > 0,
                2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall"))).otherwise(0.0)
    return s.withColumn("f1_score", f1)


def classification_report(pred: DataFrame, label: str, prediction: str,
                          classes: Sequence | None = None) -> DataFrame:
    """Rows per class plus ``accuracy`` (value repeated in every column, as in
    the published reports), ``macro avg`` and ``weighted avg``."""
    return report_from_counts(confusion_counts(pred, label, prediction, classes))


def report_from_counts(cm: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The report from a dense (by..., true_class, pred_class, n) table.  The
    summary rows come from windows over the per-class table (one row per
    class and ``by``), so the counts are read once."""
    st = per_class_stats(cm, by)
    allc = Window.partitionBy(*by)  # one row per class
    st = st.withColumns({
        "_n": F.sum("support").over(allc), "_tp": F.sum("tp").over(allc),
        "_mp": F.avg("precision").over(allc), "_mr": F.avg("recall").over(allc), "_mf": F.avg("f1_score").over(allc),
        "_wp": F.sum(F.col("precision") * F.col("support")).over(allc),
        "_wr": F.sum(F.col("recall") * F.col("support")).over(allc),
        "_wf": F.sum(F.col("f1_score") * F.col("support")).over(allc),
        "_first": F.row_number().over(Window.partitionBy(*by).orderBy("cls")) == 1})
    n = F.col("_n").cast("double")
    acc = F.col("_tp") / n

    def row(name, p, r, f, sup):
        return F.struct(name.alias("class"), p.alias("precision"), r.alias("recall"), f.alias("f1_score"),
                        sup.alias("support"))
    own = row(F.col("cls").cast("string"), F.col("precision"), F.col("recall"), F.col("f1_score"),
              F.col("support").cast("double"))
    summary = [row(F.lit("accuracy"), acc, acc, acc, acc),
               row(F.lit("macro avg"), F.col("_mp"), F.col("_mr"), F.col("_mf"), n),
               row(F.lit("weighted avg"), F.col("_wp") / n, F.col("_wr") / n, F.col("_wf") / n, n)]
    rows = F.when(F.col("_first"), F.array(own, *summary)).otherwise(F.array(own))
    return st.select(*by, F.explode(rows).alias("r")).select(*by, "r.*")


def per_class_recall(pred: DataFrame, label: str, prediction: str, classes: Sequence | None = None) -> DataFrame:
    cm = confusion_counts(pred, label, prediction, classes)
    return per_class_stats(cm).select(F.col("cls").alias("class"), F.col("support").cast("long"),
                                      F.col("tp").cast("long"), "recall")


def predicted_distribution(pred: DataFrame, label: str, prediction: str,
                           classes: Sequence | None = None) -> DataFrame:
    cm = confusion_counts(pred, label, prediction, classes)
    return cm.groupBy(F.col("pred_class").alias("class")).agg(F.sum("n").cast("long").alias("n_pred"))


def _score_table(df: DataFrame, label: str, score: str, classes: Sequence) -> DataFrame:
    df = judged(df, label, score)
    aggs = [F.count(F.lit(1)).alias("n_all"), F.lit(1).alias("n_pt")]
    aggs += [F.sum(F.when(F.col(label) == F.lit(c), 1).otherwise(0)).alias(f"n_{i}") for i, c in enumerate(classes)]
    per_score = df.where(F.col(score).isNotNull()).groupBy(score).agg(*aggs)
    return running_total(per_score, score, ["n_all", "n_pt"] + [f"n_{i}" for i in range(len(classes))],
                         descending=True)


def roc_points(df: DataFrame, label: str, score: str, classes: Sequence | None = None,
               drop_intermediate: bool = False) -> DataFrame:
    """One-vs-rest ROC: per class and distinct score (threshold, descending),
    cumulative true/false positives and their rates.  The origin point is
    implied (tp = fp = 0).

    ``drop_intermediate`` keeps, like scikit-learn, the first and last point
    and every point where the second difference of fp or tp is not zero; the
    neighbours come from equi-joins on the exact point index (the running
    count of distinct thresholds), not from an ordered window."""
    df = judged(df, label, score)
    classes = classes if classes is not None else class_values(df, label)
    cum = _score_table(df, label, score, classes)
    tot = df.where(F.col(score).isNotNull()).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.sum(F.when(F.col(label) == F.lit(c), 1).otherwise(0)).alias(f"p_{i}") for i, c in enumerate(classes)]
    ).first()
    n = tot["n"]
    structs = []
    for i, c in enumerate(classes):
        p = tot[f"p_{i}"]
        tp = F.col(f"cum_n_{i}")
        fp = F.col("cum_n_all") - F.col(f"cum_n_{i}")
        structs.append(F.struct(
            F.lit(c).alias("class"), F.col(score).cast("double").alias("threshold"),
            tp.cast("long").alias("tp"), fp.cast("long").alias("fp"),
            (tp / F.lit(p) if p else F.lit(None).cast("double")).alias("tpr"),
            (fp / F.lit(n - p) if n - p else F.lit(None).cast("double")).alias("fpr")))
    pts = cum.select(F.col("cum_n_pt").alias("_i"), F.explode(F.array(*structs)).alias("r")).select("_i", "r.*")
    if drop_intermediate:
        nb = pts.select("class", "_i", "tp", "fp")
        prev = nb.select("class", (F.col("_i") + 1).alias("_i"), F.col("tp").alias("_tp0"), F.col("fp").alias("_fp0"))
        nxt = nb.select("class", (F.col("_i") - 1).alias("_i"), F.col("tp").alias("_tp2"), F.col("fp").alias("_fp2"))
        j = pts.join(prev, ["class", "_i"], "left").join(nxt, ["class", "_i"], "left")
        bend = ((F.col("_fp2") - 2 * F.col("fp") + F.col("_fp0")) != 0) | \
               ((F.col("_tp2") - 2 * F.col("tp") + F.col("_tp0")) != 0)
        pts = j.where(F.col("_tp0").isNull() | F.col("_tp2").isNull() | bend) \
               .drop("_tp0", "_fp0", "_tp2", "_fp2")
    return pts.drop("_i")


def auc(df: DataFrame, label: str, score: str, classes: Sequence | None = None) -> DataFrame:
    """One-vs-rest area under the ROC curve by the trapezoid rule, computed
    per distinct score: each score step adds n_neg * (tp_before + tp_after) / 2."""
    df = judged(df, label, score)
    classes = classes if classes is not None else class_values(df, label)
    cum = _score_table(df, label, score, classes)
    aggs = []
    for i, _ in enumerate(classes):
        n_pos = F.col(f"n_{i}")
        n_neg = F.col("n_all") - n_pos
        area = n_neg * (2 * F.col(f"cum_n_{i}") - n_pos) / 2.0
        aggs += [F.sum(area).alias(f"a_{i}"), F.sum(n_pos).alias(f"p_{i}"), F.sum(n_neg).alias(f"q_{i}")]
    sums = cum.agg(*aggs)
    structs = []
    for i, c in enumerate(classes):
        p, q = F.col(f"p_{i}"), F.col(f"q_{i}")
        structs.append(F.struct(F.lit(c).alias("class"),
                                F.when((p > 0) & (q > 0), F.col(f"a_{i}") / (p * q)).alias("auc"),
                                p.cast("long").alias("n_pos"), q.cast("long").alias("n_neg")))
    return sums.select(F.explode(F.array(*structs)).alias("r")).select("r.*")


def probability_long(df: DataFrame, true_col: str, prob_col: str, class_names: Sequence[str],
                     keep: Sequence[str] = ()) -> DataFrame:
    """Wide probability array -> (true, predicted class name, probability)."""
    names = F.array(*[F.lit(str(c)) for c in class_names])
    return df.select(*keep, F.col(true_col).alias("true_class"),
                     F.posexplode(F.col(prob_col)).alias("_pos", "probability")) \
             .withColumn("pred_class", F.element_at(names, F.col("_pos") + 1)).drop("_pos")


def box_stats(long: DataFrame, group_cols: Sequence[str], value_col: str, weight_col: str | None = None) -> DataFrame:
    """Five numbers, IQR and 1.5*IQR whiskers per group (exact quantiles).
    ``weight_col``: a row stands for so many."""
    groups = list(group_cols)
    q = exact_quantiles(long, value_col, [0.25, 0.5, 0.75], groups, weight_col)
    qw = q.groupBy(*groups).agg(
        F.max(F.when(F.col("prob") == 0.25, F.col("quantile"))).alias("q1"),
        F.max(F.when(F.col("prob") == 0.5, F.col("quantile"))).alias("median"),
        F.max(F.when(F.col("prob") == 0.75, F.col("quantile"))).alias("q3"))
    qw = qw.withColumn("iqr", F.col("q3") - F.col("q1"))
    # one row per group; AQE broadcasts it at run time when small
    v = F.col(value_col)
    number = F.count(v) if weight_col is None else F.sum(F.when(v.isNotNull(), F.col(weight_col)))
    return long.join(qw, groups, "inner").groupBy(*groups, "q1", "median", "q3", "iqr").agg(
        number.alias("n"), F.min(v).alias("min"), F.max(v).alias("max"),
        F.min(F.when(v >= F.col("q1") - 1.5 * F.col("iqr"), v)).alias("lower_whisker"),
        F.max(F.when(v <= F.col("q3") + 1.5 * F.col("iqr"), v)).alias("upper_whisker"))


# --------------------------------------------------------------------------
# many models at once
# --------------------------------------------------------------------------

@dataclass(frozen=True)
class Evaluation:
    """Tables of ``evaluate``; every one starts with the column ``model``."""
    accuracy: DataFrame       # n, n_correct, accuracy
    confusion: DataFrame      # true_class, pred_class, n (dense)
    report: DataFrame         # class, precision, recall, f1_score, support
    recall: DataFrame         # class, support, tp, recall
    predicted: DataFrame      # class, n_pred
    roc: DataFrame            # class, threshold, tp, fp, tpr, fpr
    auc: DataFrame            # class, auc, n_pos, n_neg
    boxes: DataFrame          # true_class, class, n, min, q1, median, q3, iqr, max, whiskers

    def metrics(self) -> DataFrame:
        """(model, metric, value): accuracy, macro and weighted F1, AUC a class."""
        f1 = self.report.where(F.col("class").isin("macro avg", "weighted avg")).select(
            "model", F.concat(F.split("class", " ")[0], F.lit("_f1")).alias("metric"), F.col("f1_score").alias("value"))
        area = self.auc.where(F.col("auc").isNotNull()).select(
            "model", F.concat(F.lit("auc_"), F.col("class").cast("string")).alias("metric"), F.col("auc").alias("value"))
        return self.accuracy.select("model", F.lit("accuracy").alias("metric"), F.col("accuracy").alias("value")).unionByName(f1).unionByName(area)


def evaluate(predictions: DataFrame, label: str = "target", model: str = "model", prediction: str = "prediction",
             probability: str = "probability") -> Evaluation:
    """Every evaluation table of any number of models from one scan of
    ``predictions``: a row a model and judged row, with class numbers as label
    and prediction and the class probabilities by position.

    The scan is reduced, in one partial aggregation, to counts by (model, true
    class, predicted class) and by (model, class, true class, score); all
    tables read only those counts, which are written once.  A row without
    label or prediction is not judged; one without probabilities counts in
    the tables of predictions alone.  The ROC lists all distinct scores."""
    cell = F.array(F.struct(F.lit(-1).alias("c"), F.col(prediction).cast("int").alias("p"), F.lit(None).cast("double").alias("s")))
    scores = F.transform(F.coalesce(F.col(probability).cast("array<double>"), F.array().cast("array<double>")),
                         lambda s, i: F.struct(i.alias("c"), F.lit(None).cast("int").alias("p"), s.alias("s")))
    counts = cut_lineage(judged(predictions, label, prediction)
                         .select(F.col(model).alias("model"), F.col(label).cast("int").alias("y"), F.explode(F.concat(cell, scores)).alias("e"))
                         .groupBy("model", "y", "e.c", "e.p", "e.s").agg(F.count(F.lit(1)).alias("n")))
    cells = counts.where("c = -1").select("model", "y", "p", "n").limit(MAX_CELLS + 1).collect()
    classes = sorted({v for r in cells for v in (r["y"], r["p"])} | {r["c"] for r in counts.where("c >= 0").select("c").distinct()
                                                                     .limit(MAX_CLASSES + 1).collect()})
    models = sorted({r["model"] for r in cells})
    if len(classes) > MAX_CLASSES or len(cells) > MAX_CELLS or len(models) * len(classes) ** 2 > MAX_CELLS:
        raise ValueError(f"more than {MAX_CLASSES} classes or {MAX_CELLS} cells")
    held = {(r["model"], r["y"], r["p"]): r["n"] for r in cells}
    confusion = predictions.sparkSession.createDataFrame(
        [(m, a, b, held.get((m, a, b), 0)) for m in models for a in classes for b in classes],
        "model string, true_class int, pred_class int, n long")
    hits = F.sum(F.when(F.col("true_class") == F.col("pred_class"), F.col("n")).otherwise(0))
    accuracy = confusion.groupBy("model").agg(F.sum("n").alias("n"), hits.alias("n_correct")).withColumn("accuracy", F.col("n_correct") / F.col("n"))
    stats = per_class_stats(confusion, ["model"])
    recall = stats.select("model", F.col("cls").alias("class"), F.col("support").cast("long").alias("support"), F.col("tp").cast("long").alias("tp"), "recall")
    predicted = confusion.groupBy("model", F.col("pred_class").alias("class")).agg(F.sum("n").alias("n_pred"))

    scored = counts.where("c >= 0 AND s IS NOT NULL").select("model", F.col("c").alias("class"), "y", F.col("s").alias("threshold"), "n")
    points = scored.groupBy("model", "class", "threshold").agg(
        F.sum("n").alias("n_all"), F.sum(F.when(F.col("y") == F.col("class"), F.col("n")).otherwise(0)).alias("n_pos"))
    cum = cut_lineage(running_total(points, "threshold", ["n_all", "n_pos"], ["model", "class"], descending=True))
    totals = points.groupBy("model", "class").agg(F.sum("n_pos").alias("pos"), F.sum(F.col("n_all") - F.col("n_pos")).alias("neg"))
    fp = F.col("cum_n_all") - F.col("cum_n_pos")
    roc = cum.join(totals, ["model", "class"]).select(
        "model", "class", "threshold", F.col("cum_n_pos").cast("long").alias("tp"), fp.cast("long").alias("fp"),
        F.try_divide(F.col("cum_n_pos"), F.col("pos")).alias("tpr"), F.try_divide(fp, F.col("neg")).alias("fpr"))
    area = (F.col("n_all") - F.col("n_pos")) * (2 * F.col("cum_n_pos") - F.col("n_pos")) / 2.0
    auc_ = (cum.groupBy("model", "class").agg(F.sum(area).alias("a"), F.sum("n_pos").alias("n_pos"), F.sum(F.col("n_all") - F.col("n_pos")).alias("n_neg"))
            .select("model", "class", F.when((F.col("n_pos") > 0) & (F.col("n_neg") > 0), F.col("a") / (F.col("n_pos") * F.col("n_neg"))).alias("auc"),
                    F.col("n_pos").cast("long").alias("n_pos"), F.col("n_neg").cast("long").alias("n_neg")))
    boxes = box_stats(scored.withColumnsRenamed({"y": "true_class", "threshold": "probability"}), ["model", "true_class", "class"], "probability", "n")
    return Evaluation(accuracy, confusion, report_from_counts(confusion, ["model"]), recall, predicted, roc, auc_, boxes)


def checked_probabilities(scored: DataFrame, keep: Sequence[str], prediction: str = "prediction", probability: str = "probability") -> DataFrame:
    """(keep..., n_classes, total, in_range, is_greatest): per row what must
    hold for any classifier: one probability a class, all in [0, 1] and with
    the sum 1, and a prediction of the greatest one."""
    p = F.col(probability)
    return scored.select(*keep, F.size(p).alias("n_classes"), F.round(F.aggregate(p, F.lit(0.0), lambda a, x: a + x), 6).alias("total"),
                         F.forall(p, lambda x: (x >= 0) & (x <= 1)).cast("int").alias("in_range"),
                         (F.array_max(p) - F.get(p, F.col(prediction)) < 1e-9).cast("int").alias("is_greatest"))
