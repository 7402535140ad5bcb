import numpy as np
import pytest
from pyspark.sql import functions as F

from featurejudge.operators import fit


def test_modes_tie_smallest_in_column_order(spark):
    df = spark.createDataFrame([(10, "b", 1), (9, "a", 1), (10, "a", 1), (9, "b", 1), (None, None, 0)],
                               "n long, s string, keep int")
    assert fit.fit_modes(df, ["n", "s"]) == {"n": 9, "s": "a"}      # 9 < 10 numerically, not as text
    assert fit.fit_modes(df, ["n"], where=F.col("keep") == 0) == {"n": None}


def test_medians_moments_impute_standardize(spark):
    df = spark.createDataFrame([(1.0, 5.0, "train"), (4.0, 5.0, "train"), (10.0, None, "train"),
                                (20.0, 5.0, "train"), (None, 1.0, "test")], "x double, c double, split string")
    med = fit.fit_medians(df, ["x", "c"], where=F.col("split") == "train")
    assert med == {"x": 7.0, "c": 5.0}
    filled = fit.impute(df, med).where("split = 'test'").first()
    assert filled["x"] == 7.0                                        # test row filled with the train median
    mom = fit.fit_moments(df, ["x", "c"], where=F.col("split") == "train")
    z = fit.standardize(df, mom, prefix="z_").where("split = 'train'").select("z_c").collect()
    assert all(r["z_c"] == 0.0 for r in z if r["z_c"] is not None)   # zero deviation -> 0
    m, s = mom["x"]
    assert m == pytest.approx(8.75) and s == pytest.approx(7.258616, rel=1e-6)   # population std (numpy std, ddof=0)


def test_class_weights_and_label_index(spark):
    df = spark.createDataFrame([(-1,), (-1,), (-1,), (1,), (0,)], "y int")
    w = {r["y"]: r["weight"] for r in fit.class_weights(df, "y").collect()}
    assert w[-1] == pytest.approx(5 / 9) and w[1] == pytest.approx(5 / 3)
    idx, labels = fit.label_index(df, "y")
    assert {r["label_text"]: r["target"] for r in labels.collect()} == {"-1": 0, "0": 1, "1": 2}


def test_approx_medians_close_to_exact_and_row_weights(spark):
    df = spark.range(0, 2001).select((F.col("id") * 0.5).alias("x"), (F.col("id") % 3).alias("y"))
    exact = fit.fit_medians(df, ["x"])["x"]
    approx = fit.fit_medians(df, ["x"], approx=True)["x"]
    assert exact == 500.0 and abs(approx - exact) <= 0.01 * 1000
    w = fit.with_class_weights(df, "y").groupBy("y").agg(F.first("weight").alias("w")).collect()
    assert sum(r["w"] for r in w) == pytest.approx(3 * 2001 / (3 * 667))


def test_modes_keep_their_type(spark):
    df = spark.sql("SELECT CAST(9007199254740993 AS BIGINT) n, DATE'2020-01-02' d, true b, CAST('12345678901234567890.25' AS DECIMAL(38,2)) x")
    row = df.first()
    assert fit.fit_modes(df, ["n", "d", "b", "x"]) == {"n": row["n"], "d": row["d"], "b": row["b"], "x": row["x"]}
    assert fit.fit_modes(df, ["n"])["n"] == 2 ** 53 + 1


@pytest.mark.parametrize("accuracy,max_values", [(10_000, 50_000), (50, 5)])
def test_medians_by_brackets_match_numpy(spark, accuracy, max_values):
    rng = np.random.default_rng(3)
    cols = {"normal": rng.normal(size=2001), "ties": rng.integers(0, 3, 2001).astype(float),
            "two": np.repeat([0.0, 1.0], [1000, 1001]), "one": np.full(2001, 4.0), "even": rng.normal(size=2001)}
    rows = [[float(cols[c][i]) for c in cols] for i in range(2001)]
    rows[0][-1] = None
    df = spark.createDataFrame(rows, [*cols]).withColumn("none", F.lit(None).cast("double"))
    got = fit.fit_medians(df, [*cols, "none"], accuracy=accuracy, max_values=max_values)
    assert got.pop("none") is None
    assert got == pytest.approx({c: float(np.median(v[1:] if c == "even" else v)) for c, v in cols.items()})


def test_split_and_label_index_do_not_shuffle_rows(spark, monkeypatch):
    df = spark.read.parquet("/root/testdata/sf0.01/orders.parquet").select("o_orderkey", "o_orderstatus")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = fit.stratified_split(df, "o_orderkey", "o_orderstatus")
        out, _ = fit.label_index(out, "o_orderstatus")
        plan = fit.with_class_weights(out, "target")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    main = plan.split("BroadcastExchange")[0]
    assert "Exchange hashpartitioning" not in main and plan.count("o_orderkey") and "SortMergeJoin" not in plan
