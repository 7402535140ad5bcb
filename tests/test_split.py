import hashlib

import pytest
from pyspark.sql import functions as F

from featurejudge.operators import fit


def test_allocation_exact_rational():
    # ceil(0.2 * 35) is 7; float arithmetic would give 8
    alloc = fit.split_allocation([(0, 20), (1, 15)], 0.2)
    assert sum(alloc.values()) == 7 and alloc == {0: 4, 1: 3}
    alloc = fit.split_allocation([(0, 58), (1, 341)], 0.2)
    assert alloc == {0: 12, 1: 68}


def brute_force(rows, test_fraction=0.2, seed=42):
    by = {}
    for k, y in rows:
        by.setdefault(y, []).append(k)
    alloc = fit.split_allocation(sorted((y, len(v)) for y, v in by.items()), test_fraction)
    test = set()
    for y, keys in by.items():
        keys = sorted(keys, key=lambda k: (hashlib.md5(f"{seed}:{k}".encode()).hexdigest(), k))
        test.update(keys[:alloc[y]])
    return test


@pytest.mark.parametrize("prefix_len", [1, 5])
def test_split_equals_brute_force(spark, prefix_len):
    rows = [(i, i % 3 if i % 7 else 1) for i in range(2000)] + [(5000, None)]
    df = spark.createDataFrame(rows, "k long, y int")
    out = fit.stratified_split(df, "k", "y", 0.2, 42, prefix_len=prefix_len)
    got = out.collect()
    assert len(got) == 2000                      # null label left out
    assert len({r["k"] for r in got}) == 2000    # disjoint and exhaustive
    assert {r["k"] for r in got if r["split"] == "test"} == brute_force([r for r in rows if r[1] is not None])


def test_split_on_driver_labels(spark):
    lab = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    out = fit.stratified_split(lab, "doc_id", "quality")
    counts = {(r["quality"], r["split"]): r["count"] for r in out.groupBy("quality", "split").count().collect()}
    assert counts[(0, "test")] == 12 and counts[(1, "test")] == 68
    assert out.where("split = 'train'").join(out.where("split = 'test'"), "doc_id").count() == 0


def test_buckets_of_the_split_are_few_and_change_no_row(spark):
    df = spark.range(3000).selectExpr("id AS k", "CAST(id % 3 AS INT) AS y")
    assert 16 ** fit.SPLIT_PREFIX <= 4096           # rows of a class are summed by bucket before the shuffle
    want = {r["k"]: r["split"] for r in fit.stratified_split(df, "k", "y", 0.2, 42, prefix_len=5).collect()}
    assert {r["k"]: r["split"] for r in fit.stratified_split(df, "k", "y", 0.2, 42).collect()} == want
