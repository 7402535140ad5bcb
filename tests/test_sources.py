import os
import tempfile

import pytest
from pyspark.sql import functions as F

from featurejudge.sources import tables as tb


def test_load_tables_optional_and_required(spark):
    base = "/root/testdata/sf0.001"
    specs = [tb.TableSpec("region", f"{base}/region.parquet", "r_regionkey int, r_name string", required=True),
             tb.TableSpec("missing", f"{base}/nope.parquet")]
    t = tb.load_tables(spark, specs)
    assert set(t) == {"region"} and t["region"].count() == 5
    with pytest.raises(FileNotFoundError):
        tb.load_tables(spark, [tb.TableSpec("gone", f"{base}/gone.parquet", required=True)])
    with pytest.raises(ValueError):
        tb.require(t, "battles")


def test_split_table_feature_list_and_runs(spark):
    d = tempfile.mkdtemp(prefix="fj-test-")
    df = spark.createDataFrame([(1, "train", 0.5), (2, "test", 1.5)], "k long, split string, x double")
    tb.write_split(df, f"{d}/split")
    test = tb.read_split(spark, f"{d}/split", "test")
    assert [r["k"] for r in test.collect()] == [2]
    assert "PartitionFilters: [isnotnull(split" in test._jdf.queryExecution().executedPlan().toString() or \
        "split" in str(test.inputFiles())
    feats = ["duration_days", "surprise_level_Neither side achieved surprise, or it did not affect the outcome"]
    tb.write_feature_list(spark, feats, f"{d}/features")
    assert tb.read_feature_list(spark, f"{d}/features") == feats       # header is not a feature
    tb.append_run_metrics(spark, f"{d}/runs", "r1", "rf", {"accuracy": 0.72})
    tb.append_run_metrics(spark, f"{d}/runs", "r2", "gbt", {"accuracy": 0.70})
    assert tb.read_run_metrics(spark, f"{d}/runs", "r2").first()["model"] == "gbt"
    tb.write_csv(spark.createDataFrame([(0.123456,)], "x double"), f"{d}/csv", decimals=3)
    assert spark.read.option("header", True).csv(f"{d}/csv").first()[0] == "0.123"


def test_model_save_load_roundtrip(spark):
    from featurejudge.operators import models
    df = spark.createDataFrame([(float(i % 2), float(i), float(i % 3)) for i in range(40)], "target double, a double, b double")
    m = models.logistic_pipeline(["a", "b"], label="target").fit(df)
    d = tempfile.mkdtemp(prefix="fj-model-")
    tb.save_model(m, f"{d}/m")
    back = tb.load_pipeline_model(f"{d}/m")
    p1 = [r["prediction"] for r in m.transform(df).select("prediction").collect()]
    p2 = [r["prediction"] for r in back.transform(df).select("prediction").collect()]
    assert p1 == p2


def test_scratch_tables_leave_no_folder_and_no_cache(spark):
    import os
    from featurejudge.plans import catalog
    from featurejudge.session import ensure_checkpoint_dir, scratch_tables
    root = ensure_checkpoint_dir(spark).removeprefix("file:") + "/tables"
    persisted = spark.sparkContext._jsc.getPersistentRDDs().size()
    before = set(os.listdir(root)) if os.path.isdir(root) else set()
    with scratch_tables(spark):
        rows = catalog.all_queries()["impute_median"](spark, "/root/testdata/sf0.001").collect()
        assert set(os.listdir(root)) - before
    assert rows and set(os.listdir(root)) == before
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == persisted
