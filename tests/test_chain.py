"""Column groups, resampling chains, folds, the evaluation of many models, the
run registry and permutations."""
import hashlib

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.sql import functions as F

from featurejudge.operators import chain, evaluate, fit, models, oversample
from featurejudge.sources import tables as tb


def odd_frame(spark):
    rows = [(1, 1.0, "a", 1, None, "x", 0.5), (2, None, "b", None, None, None, 0.5), (3, 3.0, "a", 0, None, "y", 0.5), (4, 10.0, None, 0, None, "x", None)]
    return spark.createDataFrame(rows, "id long, num double, `a code` string, flag int, empty double, other string, const double")


GROUPS = [("numeric", ["num", "empty", "const"], ["median", "scale"]), ("flags", ["flag"], ["most_frequent"]), ("codes", ["a code"], ["most_frequent", "onehot"])]


def test_column_groups_by_hand(spark, tmp_path):
    df = odd_frame(spark)
    model = chain.ColumnGroups(groups=GROUPS, keep=["id"]).fit(df)
    assert model.features == ["num", "empty", "const", "flag", "a_code_a", "a_code_b"]
    model.write().overwrite().save(str(tmp_path / "m"))
    back = chain.ColumnGroupsModel.load(str(tmp_path / "m"))
    new = df.unionByName(spark.createDataFrame([(9, 2.0, "never seen", None, 5.0, "z", 1.0)], df.schema))
    got = {r["id"]: r for r in back.transform(new).collect()}
    filled = np.array([1.0, 3.0, 3.0, 10.0])
    z = (filled - filled.mean()) / filled.std()
    assert [got[i]["num"] for i in (1, 2, 3, 4)] == pytest.approx(z.tolist())
    assert [got[i]["flag"] for i in (1, 2, 3, 4, 9)] == [1, 0, 0, 0, 0]
    assert [(got[i]["a_code_a"], got[i]["a_code_b"]) for i in (1, 2, 4, 9)] == [(1, 0), (0, 1), (1, 0), (0, 0)]
    assert got[1]["empty"] == 0.0 and got[4]["const"] == 0.0 and got[1]["other"] == "x"
    assert "other" not in chain.ColumnGroups(groups=GROUPS, remainder="drop", keep=["id"]).fit(df).transform(df).columns
    assert chain.ColumnGroups(groups=GROUPS).fit(df.where("false")).transform(df).count() == 4


@pytest.mark.parametrize("groups", [[("a", ["num"], ["median", "zero"])], [("a", ["num"], ["scale", "onehot"])], [("a", ["num"], ["log"])],
                                    [("a", ["num"], ["zero"]), ("b", ["num"], ["scale"])]])
def test_groups_that_do_not_go_together(groups):
    with pytest.raises(ValueError):
        chain.ColumnGroups(groups=groups)


def classes(spark, n=240):
    rng = np.random.default_rng(2)
    rows = [(i, int(y), float(rng.normal() + 2 * y), None if i % 11 == 0 else float(rng.normal())) for i in range(n) for y in [0 if i % 6 else 1 + i % 2]]
    return spark.createDataFrame(rows, "id long, target int, a double, b double")


def test_chain_resamples_only_while_it_is_fitted(spark, tmp_path):
    df = classes(spark)
    train, test = df.where("id % 4 > 0"), df.where("id % 4 = 0")
    stages = [chain.ColumnGroups(groups=[("all", ["a", "b"], ["median", "scale"])], keep=["id", "target"]), models.assembler(["a", "b"]),
              chain.Oversample(key="id", k=3), LogisticRegression(featuresCol="features", labelCol="target")]
    seen = chain.resampled(chain.Chain(stages=stages), train)
    sizes = {r["target"]: r["count"] for r in seen.groupBy("target").count().collect()}
    assert len(set(sizes.values())) == 1
    assert {r["id"] for r in seen.collect()} - {None} == {r["id"] for r in train.collect()}
    fitted = chain.Chain(stages=stages).fit(train)
    scored = models.predictions(fitted, test, ["id", "target"]).collect()
    assert sorted(r["id"] for r in scored) == sorted(r["id"] for r in test.collect())
    tb.save_model(fitted, str(tmp_path / "m"))
    back = tb.load_pipeline_model(str(tmp_path / "m"))
    assert isinstance(back, PipelineModel) and isinstance(back.stages[2], chain.Oversample) and back.stages[2].getOrDefault("k") == 3
    again = {r["id"]: (r["prediction"], list(r["probability"])) for r in models.predictions(back, test, ["id"]).collect()}
    assert again == {r["id"]: (r["prediction"], list(r["probability"])) for r in scored}
    # the classifier saw the resampled rows: a plain pipeline on the same rows has the same coefficients
    plain = LogisticRegression(featuresCol="features", labelCol="target").fit(seen)
    assert np.allclose(plain.coefficientMatrix.toArray(), fitted.stages[-1].coefficientMatrix.toArray(), atol=1e-6)


def test_neighbours_are_the_nearest_where_all_are_candidates(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(30, 4))
    label = [i % 2 for i in range(30)]
    base = spark.createDataFrame([(i, label[i], x[i].tolist()) for i in range(30)], "id long, label int, _x array<double>")
    got = {r["id"]: [n["j"] for n in r["_nbrs"]] for r in oversample.neighbours(base, "id", "label", 4, 1, 2, 15, 7).collect()}
    for i in range(30):
        same = sorted((float(((x[i] - x[j]) ** 2).sum()), j) for j in range(30) if j != i and label[j] == label[i])
        assert got[i] == [j for _, j in same[:4]]


def test_smote_of_odd_classes(spark):
    rows = [(i, 0, [float(i), 0.0]) for i in range(6)] + [(10, 1, [5.0, 5.0])] + [(20 + i, None, [0.0, 0.0]) for i in range(3)]
    df = spark.createDataFrame(rows, "id long, label int, v array<double>")
    out = oversample.smote(df, "id", "label", "v", k=2).collect()
    assert sum(r["label"] == 1 for r in out) == 6 and all(r["v"] == [5.0, 5.0] for r in out if r["label"] == 1)
    assert sum(r["label"] == 0 for r in out) == 6 and len(out) == 12
    assert oversample.smote(df.where("false"), "id", "label", "v").count() == 0


@pytest.mark.parametrize("folds,prefix", [(2, 5), (5, 5), (5, 1), (7, 0)])
def test_folds_by_hand(spark, folds, prefix):
    rows = [(i, "ab"[i % 2] if i < 40 else "c") for i in range(43)] + [(99, None)]
    df = spark.createDataFrame(rows, "id long, label string")
    got = {r["id"]: r["fold"] for r in fit.stratified_folds(df, "id", "label", folds, 7, prefix_len=max(prefix, 1)).collect()}
    want = {}
    for c in "abc":
        ids = sorted((i for i, y in rows if y == c), key=lambda i: (hashlib.md5(f"7:{i}".encode()).hexdigest(), i))
        for r, i in enumerate(ids, 1):
            want[i] = sum(r > len(ids) * j // folds for j in range(1, folds))
    assert got == want


def test_folds_shuffle_no_row(spark):
    df = spark.range(1000).withColumn("label", F.col("id") % 3)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = fit.stratified_folds(df, "id", "label", 5)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" not in plan and "hashpartitioning" not in plan


def test_evaluate_agrees_with_the_tables_of_one_model(spark):
    rng = np.random.default_rng(8)
    rows = []
    for i in range(300):
        y, p = int(rng.integers(0, 3)), rng.dirichlet([1, 1, 1]).round(2).tolist()
        rows.append(("m1", i, y, int(np.argmax(p)), p))
        rows.append(("m2", i, y if i % 50 else None, int(rng.integers(0, 3)) if i % 40 else None, p if i % 3 else None))
    df = spark.createDataFrame(rows, "model string, id long, target int, prediction int, probability array<double>")
    e = evaluate.evaluate(df)
    for m in ("m1", "m2"):
        one = df.where(F.col("model") == m)

        def same(a, b):
            def text(v):
                return "null" if v is None else f"{v:.9g}" if isinstance(v, float) else str(v)
            assert sorted([text(v) for v in r] for r in a.where(F.col("model") == m).drop("model").collect()) == sorted([text(v) for v in r] for r in b.collect())
        same(e.accuracy, evaluate.accuracy(one, "target", "prediction"))
        same(e.confusion, evaluate.confusion_counts(one, "target", "prediction", [0, 1, 2]))
        same(e.report, evaluate.classification_report(one, "target", "prediction", [0, 1, 2]))
        same(e.recall, evaluate.per_class_recall(one, "target", "prediction", [0, 1, 2]))
        same(e.predicted, evaluate.predicted_distribution(one, "target", "prediction", [0, 1, 2]))
        judged = evaluate.judged(one, "target", "prediction")
        for c in range(3):
            scored = judged.where("probability IS NOT NULL").withColumn("s", F.col("probability")[c])
            area = evaluate.auc(scored, "target", "s", [c])
            same(e.auc.where(F.col("class") == c), area)
            same(e.roc.where(F.col("class") == c), evaluate.roc_points(scored, "target", "s", [c]))
        long = evaluate.probability_long(judged.where("probability IS NOT NULL"), "target", "probability", ["0", "1", "2"])
        boxes = evaluate.box_stats(long, ["true_class", "pred_class"], "probability")
        same(e.boxes.select("model", "true_class", F.col("class").cast("string"), "q1", "median", "q3", "iqr", "n", "min", "max", "lower_whisker", "upper_whisker"), boxes)
    assert evaluate.evaluate(df.where("false")).accuracy.count() == 0


def test_registry_keeps_one_copy_of_a_run(spark, tmp_path):
    path = str(tmp_path / "runs")
    one = spark.createDataFrame([("a", "accuracy", 0.5), ("b", "accuracy", 0.25)], "model string, metric string, value double")
    for run in ("007", "007", "2024"):
        tb.write_run(one, path, run)
    tb.write_run(one.where("model = 'a'").withColumn("value", F.lit(0.75)), path, "007")
    got = sorted((r["run_id"], r["model"], r["value"]) for r in tb.read_run_metrics(spark, path).collect())
    assert got == [("007", "a", 0.75), ("007", "b", 0.25), ("2024", "a", 0.5), ("2024", "b", 0.25)]
    assert tb.read_run_metrics(spark, path, "2024").count() == 2


@pytest.mark.parametrize("n", [1, 2, 12, 97])
def test_shuffles_are_bijections(spark, n):
    rows = spark.range(n).select((F.col("id") * 3).alias("id"), F.col("id").cast("double").alias("a"), (F.col("id") * 10).alias("b"))
    pairs = models.permuted_pairs(rows, ["a", "b"], "id", 4).collect()
    by = {}
    for r in pairs:
        by.setdefault((r["feature"], r["repeat"]), []).append(r)
    assert len(by) == 8
    for (feature, _), got in by.items():
        assert sorted(r["donor"] for r in got) == sorted(r["target_rank"] for r in got) == list(range(n))
        assert sorted(r["value"] for r in got) == [float(i) * (10 if feature == "b" else 1) for i in range(n)]


def test_permutation_importance_of_a_known_model(spark):
    df = spark.range(400).select("id", (F.col("id") % 2).cast("int").alias("target"), (F.col("id") % 2).cast("double").alias("a"),
                                 (F.hash("id") % 100).cast("double").alias("noise"))
    model = models.logistic_pipeline(["a", "noise"]).fit(df)
    got = {r["feature"]: r for r in models.permutation_importance(model, df, ["a", "noise"], "id", repeats=5).collect()}
    assert 0.3 < got["a"]["importance_mean"] < 0.7 and abs(got["noise"]["importance_mean"]) < 0.02 and got["noise"]["importance_std"] < 0.02


def test_checked_load_of_json_lines(spark, tmp_path):
    lines = ['{"k": 1, "s": "a"}', '{"k": "x", "s": "b"}', '{"k": 3', '{"s": "d"}', '{"k": 5, "s": null}']
    (tmp_path / "x.json").write_text("\n".join(lines) + "\n")
    good, bad = tb.load_checked(spark, str(tmp_path / "x.json"), "k long, s string", "json", not_null=("k",))
    assert sorted(r["k"] for r in good.collect()) == [1, 5]
    assert sorted((r["line"], r["reason"]) for r in bad.collect()) == sorted([(lines[1], "malformed"), (lines[2], "malformed"), ('{"s":"d"}', "missing k")])
