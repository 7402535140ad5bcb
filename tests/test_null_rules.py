"""Nulls in evaluation, and names that the encoder has sanitised."""
from pyspark.sql import functions as F

from featurejudge.functions.columns import THEORY_FEATURES, col_or_default, select_available
from featurejudge.operators import encode, evaluate


def test_unjudged_rows_do_not_count(spark):
    df = spark.createDataFrame([("a", "a", 0.9), ("b", "a", 0.8), (None, "a", 0.7), ("a", None, None)], "y string, p string, s double")
    got = evaluate.accuracy(df, "y", "p").first()
    assert (got["n"], got["n_correct"], got["accuracy"]) == (2, 1, 0.5)
    dist = {r["class"]: r["n_pred"] for r in evaluate.predicted_distribution(df, "y", "p").collect()}
    assert dist == {"a": 2, "b": 0}
    report = {r["cls"] if "cls" in r else r[0]: r for r in evaluate.classification_report(df, "y", "p").collect()}
    assert set(report) >= {"a", "b"}
    points = evaluate.roc_points(df, "y", "s", ["a"]).orderBy(F.desc("threshold")).collect()
    assert [(r["tp"], r["fp"]) for r in points] == [(1, 0), (1, 1)] and points[-1]["fpr"] == 1.0


def test_encoded_theory_features_are_found(spark):
    raw = [n for n in THEORY_FEATURES if n.startswith("surprise_level_")]
    value = raw[0].removeprefix("surprise_level_")
    df = encode.one_hot(spark.createDataFrame([(1, value), (2, None)], "id long, v string"), "v", [value], prefix="surprise_level")
    found = select_available(df, THEORY_FEATURES)
    assert len(found) == 1 and found[0] in df.columns
    got = df.select("id", col_or_default(df, raw[0], 9).alias("x")).orderBy("id").collect()
    assert [r["x"] for r in got] == [1, 0]
