from pyspark.sql import functions as F

from featurejudge.operators import models
from featurejudge.plans import ml

SF = "/root/testdata/sf0.001"


def test_smote_balances_every_class(spark):
    e = spark.read.parquet(f"{SF}/embeddings.parquet")
    out = models.smote(e, "vec_id", "label", "embedding", k=3, rows_per_bucket=20)
    counts = {r["label"]: r["count"] for r in out.groupBy("label").count().collect()}
    assert len(set(counts.values())) == 1
    assert out.where("synthetic = 0").count() == e.count()
    dims = {r[0] for r in out.select(F.size("embedding")).distinct().collect()}
    assert dims == {64}


def test_smote_rows_do_not_depend_on_bucket_size(spark):
    e = spark.read.parquet(f"{SF}/embeddings.parquet")

    def rows(size):
        out = models.smote(e, "vec_id", "label", "embedding", k=3, rows_per_bucket=size).where("synthetic = 1")
        return sorted((r["label"], tuple(round(x, 9) for x in r["embedding"])) for r in out.collect())
    assert rows(11) == rows(50_000)


def test_replicate_balance(spark):
    e = spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "label")
    out = models.replicate_balance(e, "vec_id", "label")
    counts = {r["label"]: r["count"] for r in out.groupBy("label").count().collect()}
    assert len(set(counts.values())) == 1


def test_fit_score_and_importances(spark):
    p = ml.prepared_documents(spark, "/root/testdata/sf0.01")
    m = models.forest_pipeline(p.features, weight="weight", trees=20).fit(p.train)
    pred = models.predictions(m, p.test, ["doc_id", "target"])
    assert pred.count() == p.test.count()
    imp = models.importance_table(m, p.features, "rf")
    assert imp.count() == len(p.features)
    assert abs(sum(r["importance"] for r in imp.collect()) - 1.0) < 1e-9
    perm = models.permutation_importance(m, p.test, p.features, "doc_id", "target", repeats=2)
    assert sorted(r["feature"] for r in perm.collect()) == sorted(p.features)
    lr = models.logistic_pipeline(p.features, weight="weight").fit(p.train)
    assert models.coefficient_table(lr, p.features, "lr").count() == len(p.features)


def test_one_vs_rest_probabilities(spark):
    rows = spark.range(300).select((F.col("id") % 3).alias("target"), F.col("id").alias("k"),
                                   ((F.col("id") % 3) * 2 + (F.col("id") % 7) / 10).cast("double").alias("x"))
    m = models.logistic_pipeline(["x"], reg=0.01, ovr=True).fit(rows)
    got = models.predictions(m, rows, ["k", "target"]).collect()
    assert len(got) == 300
    for r in got:
        assert len(r["probability"]) == 3 and abs(sum(r["probability"]) - 1) < 1e-9
        assert r["prediction"] == max(range(3), key=lambda i: r["probability"][i])


def test_forest_rows_keep_their_nodes_and_use_all_cores(spark):
    rows = spark.range(2000, numPartitions=1).select(F.col("id").alias("k"), (F.xxhash64("id") % 100).cast("double").alias("x"),
                                                     F.when(F.xxhash64("id") % 100 > 10, 1.0).otherwise(0.0).alias("target"))
    pipe = models.forest_pipeline(["x"], trees=3)
    forest = pipe.getStages()[-1]
    assert forest.getCacheNodeIds()
    want = pipe.copy({forest.cacheNodeIds: False}).fit(rows).stages[-1].toDebugString
    assert pipe.fit(rows).stages[-1].toDebugString.split("\n")[1:] == want.split("\n")[1:]
    cores = spark.sparkContext.defaultParallelism
    assert models.spread_for_trees(rows, 2000).rdd.getNumPartitions() == max(1, min(cores, 4))
    assert models.spread_for_trees(rows, 100).rdd.getNumPartitions() == 1


def test_forest_of_many_rows_has_as_many_even_tasks_on_every_core(spark):
    cores = spark.sparkContext.defaultParallelism
    rows = spark.range(1000, numPartitions=cores + 1)
    for n_rows, tasks in ((cores * 100_000, cores), (cores * 100_000 + 1, 2 * cores)):
        got = models.spread_for_trees(rows, n_rows)
        sizes = [len(x) for x in got.rdd.glom().collect()]
        assert len(sizes) == tasks and sum(sizes) == 1000 and max(sizes) - min(sizes) <= cores + 1


def test_prepared_documents_read_every_text_once(spark, monkeypatch):
    seen, plain = spark.sparkContext.accumulator(0), ml.table

    @F.udf("string")
    def read(text):
        seen.add(1)
        return text
    docs = spark.range(60).select(F.col("id").alias("doc_id"), F.concat(F.lit("the supply line "), "id").alias("text"),
                                  F.when(F.col("id") % 3 > 0, "en").otherwise("de").alias("lang"), (F.col("id") % 11).alias("n_chars"))
    made = {"documents": docs.withColumn("text", read("text")), "labels": docs.select("doc_id", (F.col("doc_id") % 2).alias("quality"))}
    monkeypatch.setattr(ml, "table", lambda spark, sf, name: made[name])
    p = ml.prepared_documents(spark, "")
    assert p.train.count() + p.test.count() == 60 and p.n_classes == 2
    assert seen.value == 60


def test_permutation_scores_only_changed_rows_and_counts_all(spark):
    rows = spark.createDataFrame([(i, float(i % 2), 1.0, None if i == 7 else i % 2) for i in range(60)], "k long, a double, b double, target int")
    rows = rows.withColumn("a", F.when(F.col("k") != 9, F.col("a")))                # a null value
    model = models.forest_pipeline(["a", "b"], trees=3).fit(rows.where("target IS NOT NULL AND a IS NOT NULL"))
    seen, transform = [], type(model).transform

    def counted(self, df):
        seen.append(df.count())
        return transform(self, df)
    type(model).transform = counted
    try:
        got = {r["feature"]: r for r in models.permutation_importance(model, rows, ["a", "b"], "k", repeats=4).collect()}
    finally:
        type(model).transform = transform
    plain = rows.withColumn("_own", F.lit(0))
    pairs = models.permuted_pairs(plain, ["a", "b"], "k", 4)
    donors = models._ranked(plain, "k", 42).select("_rank", "target", "b", F.col("a").alias("old"))
    met = pairs.where("feature = 'a'").join(donors, F.col("target_rank") == F.col("_rank")).select("repeat", "target", "b", F.col("value").alias("a"))
    accs = [r[1] for r in transform(model, met).groupBy("repeat").agg(F.avg((F.col("prediction") == F.col("target")).cast("double"))).collect()]
    base = transform(model, rows).agg(F.avg((F.col("prediction") == F.col("target")).cast("double"))).first()[0]
    assert abs(got["a"]["importance_mean"] - (base - sum(accs) / 4)) < 1e-12
    assert got["b"]["importance_mean"] == 0 and got["b"]["importance_std"] == 0      # a constant column: nothing to score
    assert seen[0] == 60 and seen[1] < 60 * 4


def test_distinct_ranks_are_counted_exactly(spark):
    rows = spark.range(5000).select((F.col("id") % 3).alias("g"), (F.col("id") % 777).alias("x"), (F.col("id") * 7 % 2500).alias("y"))
    got = models.distinct_ranks(rows, ["g"], "n", {"x": "nx", "y": "ny"})
    want = rows.groupBy("g").agg(F.count(F.lit(1)), F.count_distinct("x"), F.count_distinct("y"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert "distinct" not in got._jdf.queryExecution().optimizedPlan().toString().lower()


def test_neighbours_are_sought_for_short_classes_alone(spark, monkeypatch):
    from featurejudge.operators import oversample
    rows = spark.createDataFrame([(i, "few" if i % 5 == 0 else "many", [float(i % 7), float(i % 11)]) for i in range(100)], "k long, c string, v array<double>")
    seen, plain = [], oversample.neighbours

    def neighbours(base, key, label, *rest):
        seen.append({r[0] for r in base.select(label).distinct().collect()})
        out = plain(base, key, label, *rest)
        seen.append({r[0]: r[1] for r in out.collect()})
        return out
    monkeypatch.setattr(oversample, "neighbours", neighbours)
    out = oversample.smote(rows, "k", "c", "v")
    assert seen[0] == {"few"} and {r["c"]: r["count"] for r in out.groupBy("c").count().collect()} == {"few": 80, "many": 80}
    assert all(n == sorted(set(n)) and len(n) == 5 for n in seen[1].values()) and len(seen[1]) == 20
    one = oversample.smote(rows.withColumn("c", F.lit("same")), "k", "c", "v")
    assert one.count() == 100 and one.columns == ["k", "c", "v", "synthetic"]


def test_values_given_away_are_not_sent_to_the_driver(spark):
    import re
    rows = spark.createDataFrame([(i, float(i % 7), i % 2) for i in range(60)], "k long, a double, target int")
    model = models.forest_pipeline(["a"], trees=2).fit(rows)
    plan = models.permutation_importance(model, rows, ["a"], "k", repeats=3)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"SortMergeJoin \[_rank#\d+L\], \[target_rank#\d+L\]", plan)
    assert not re.search(r"BroadcastHashJoin \[_rank#", plan)


def test_written_out_sums_have_the_last_digits_of_the_loops(spark):
    from featurejudge.operators import oversample
    import numpy as np
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=5).tolist(), rng.normal(size=5).tolist()) for i in range(50)]
    rows += [(50, [1.0, None, 3.0, 4.0, 5.0], [1.0] * 5), (51, [1.0] * 4, [2.0] * 5), (52, [1.0] * 6, [3.0] * 6), (53, None, [1.0] * 5),
             (54, [-0.0] * 5, [0.0] * 5), (55, [float("nan")] * 5, [1.0] * 5)]
    w = rng.normal(size=5).tolist()
    df = spark.createDataFrame(rows, "k int, x array<double>, y array<double>")
    got = {r["k"]: (r["d"], r["p"]) for r in df.select("k", oversample._sqdist(F.col("x"), F.col("y"), 5).alias("d"), oversample._dot(F.col("x"), w).alias("p")).collect()}

    def looped(x, y, each):
        if x is None or len(x) != len(y) or None in x:
            return None
        total = 0.0
        for a, b in zip(x, y):
            total += each(a, b)
        return total
    for k, x, y in rows:
        want = looped(x, y, lambda a, b: (a - b) * (a - b)), looped(x, w, lambda a, b: a * b)
        assert repr(got[k]) == repr(want), k


def test_distances_of_neighbours_are_computed_once_and_compiled(spark):
    import re

    from featurejudge.operators import oversample
    import numpy as np
    rng = np.random.default_rng(5)
    base = spark.createDataFrame([(i, i % 2, rng.normal(size=3).tolist()) for i in range(40)], "k long, c int, _x array<double>")
    out = oversample.neighbours(base, "k", "c", 5, 42, 2, 3, 10)
    plan = out._jdf.queryExecution().optimizedPlan().toString().split("\n")
    assert len([line for line in plan if re.search(r"zip_with\(_x#\d+, _\w+#\d+", line)]) == 1
    assert not any("filter(array(" in line for line in plan)         # below a lambda nothing is compiled
