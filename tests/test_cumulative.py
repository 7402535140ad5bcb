"""The scale paths (range buckets, distributed rank selection) are forced on
small data and checked against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from featurejudge.operators.cumulative import exact_quantiles, exact_rank, running_total


@pytest.fixture(scope="module")
def values(spark):
    rng = np.random.default_rng(7)
    rows = [(int(i), ["a", "b", "b", "c"][i % 4], float(np.round(rng.normal(), 2)), int(rng.integers(1, 5)))
            for i in range(3000)]
    return spark.createDataFrame(rows, "id long, g string, v double, w long")


@pytest.mark.parametrize("rows_per_bucket", [10**9, 97])
@pytest.mark.parametrize("descending", [False, True])
def test_running_total_matches_cumsum(spark, values, rows_per_bucket, descending):
    per = values.groupBy("g", "v").agg(F.sum("w").alias("w"))
    out = running_total(per, "v", ["w"], ["g"], descending=descending, rows_per_bucket=rows_per_bucket)
    pdf = per.toPandas()
    got = {(r["g"], r["v"]): r["cum_w"] for r in out.collect()}
    for g, part in pdf.groupby("g"):
        part = part.sort_values("v", ascending=not descending)
        for v, c in zip(part["v"], part["w"].cumsum()):
            assert got[(g, v)] == c


def test_running_total_ties_and_no_partition(spark, values):
    out = running_total(values.select("v", "w"), "v", ["w"], rows_per_bucket=50)
    pdf = values.select("v", "w").toPandas()
    expect = {v: pdf.loc[pdf.v <= v, "w"].sum() for v in pdf.v.unique()}
    for r in out.collect():
        assert r["cum_w"] == expect[r["v"]]


def test_exact_quantiles_match_numpy(spark, values):
    probs = [0.0, 0.25, 0.5, 0.75, 1.0]
    q = exact_quantiles(values, "v", probs, ["g"]).collect()
    pdf = values.toPandas()
    for r in q:
        vals = pdf.loc[pdf.g == r["g"], "v"].to_numpy()
        assert r["quantile"] == pytest.approx(np.quantile(vals, r["prob"]), abs=1e-12)
        assert r["n"] == len(vals)


def test_exact_quantiles_no_groups_distributed(spark, values):
    med = exact_quantiles(values, "v", [0.5]).first()
    assert med["quantile"] == pytest.approx(float(np.median(values.toPandas().v)))


def test_median_interpolates_even_count(spark):
    df = spark.createDataFrame([(1.0,), (4.0,), (10.0,), (20.0,), (None,)], "x double")
    assert exact_quantiles(df, "x", [0.5]).first()["quantile"] == 7.0


@pytest.mark.parametrize("rows_per_bucket", [10**9, 53])
def test_exact_rank_is_a_bijection_with_ties(spark, values, rows_per_bucket):
    got = {r["id"]: r["_rank"] for r in exact_rank(values, ["v", "id"], ["g"], rows_per_bucket=rows_per_bucket).collect()}
    for _, part in values.toPandas().groupby("g"):
        assert [got[i] for i in part.sort_values(["v", "id"])["id"]] == list(range(1, len(part) + 1))
