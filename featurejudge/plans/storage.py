"""Sources and sinks as queries: each writes what its name says below the
checkpoint folder, reads it back and returns what it has read."""

from __future__ import annotations

from pyspark.sql import functions as F

from featurejudge.functions.columns import rounded
from featurejudge.operators import evaluate as ev
from featurejudge.plans import evaluation
from featurejudge.plans.catalog import ORACLE, PRIORITIES_SQL, QUERIES, query
from featurejudge.plans.fitted import SEED, TEST_FRACTION, split_sql
from featurejudge.operators import encode, fit
from featurejudge.session import scratch_folder
from featurejudge.sources import tables
from featurejudge.sources.tables import TableSpec, table


@query("loaded_tables",
       "SELECT 'region' AS name, count(*) AS n, 1 AS missing_skipped, 1 AS guard_raises FROM region UNION ALL "
       "SELECT 'nation', count(*), 1, 1 FROM nation UNION ALL SELECT 'customer', count(*), 1, 1 FROM customer")
def loaded_tables(spark, sf):
    """Several tables by name with declared schemas; an optional one
    that is not there is skipped, a required one is not."""
    found = tables.load_tables(spark, [
        TableSpec("region", f"{sf}/region.parquet", "r_regionkey int, r_name string", required=True),
        TableSpec("nation", f"{sf}/nation.parquet", "n_nationkey int, n_name string, n_regionkey int"),
        TableSpec("weather", f"{sf}/weather.parquet", "day date, sky string"),
        TableSpec("customer", f"{sf}/customer.parquet")])
    try:
        tables.require(found, "region", "weather")
        raises = 0
    except ValueError:
        raises = 1
    counts = [t.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("name"), "n") for name, t in found.items()]
    out = counts[0]
    for c in counts[1:]:
        out = out.unionByName(c)
    return out.withColumns({"missing_skipped": F.lit(int("weather" not in found)), "guard_raises": F.lit(raises)})


def damaged_lines(spark, sf):
    """Orders as comma-separated lines, of which every tenth is damaged in one of five ways."""
    k, price = F.col("o_orderkey"), F.col("o_totalprice").cast("string")
    way = F.when(k % 10 == 0, F.floor(k / 10) % 5)
    fields = [k.cast("string"), F.col("o_orderstatus"), price]
    line = (F.when(way == 0, F.concat_ws(",", fields[0], fields[1], F.lit("n/a"))).when(way == 1, F.concat_ws(",", *fields[:2]))
            .when(way == 2, F.concat_ws(",", *fields, F.lit("x"))).when(way == 3, F.concat_ws(",", fields[0], fields[1], F.lit("")))
            .when(way == 4, F.concat_ws(",", F.concat(F.lit("no "), fields[0]), *fields[1:])).otherwise(F.concat_ws(",", *fields)))
    return table(spark, sf, "orders").select(line.alias("value"))


@query("checked_load",
       "WITH o AS (SELECT *, CASE WHEN o_orderkey % 10 = 0 THEN (o_orderkey // 10) % 5 END AS way FROM orders) "
       "SELECT CASE WHEN way = 3 THEN 'missing o_totalprice' WHEN way IS NOT NULL THEN 'malformed' ELSE 'good' END AS kind, count(*) AS n, "
       "round(coalesce(sum(CASE WHEN way IS NULL THEN CAST(round(o_totalprice * 100) AS BIGINT) END), 0) / 100.0, 2) AS total FROM o GROUP BY 1")
def checked_load(spark, sf):
    """S3: a text table under a declared schema; bad lines go to a table of
    their own with the reason, and every line is in one of the two."""
    path = scratch_folder(spark, "csv")
    damaged_lines(spark, sf).write.text(path)
    good, bad = tables.load_checked(spark, path, "o_orderkey long, o_orderstatus string, o_totalprice double", not_null=("o_orderkey", "o_totalprice"))
    cents = F.round(F.col("o_totalprice") * 100).cast("long")
    kept = good.agg(F.lit("good").alias("kind"), F.count(F.lit(1)).alias("n"), F.round(F.coalesce(F.sum(cents), F.lit(0)) / 100.0, 2).alias("total"))
    gone = bad.groupBy(F.col("reason").alias("kind")).agg(F.count(F.lit(1)).alias("n"), F.lit(0.0).alias("total"))
    return kept.unionByName(gone)


@query("split_bundle",
       f"WITH {split_sql('labels', 'doc_id', 'quality')} SELECT doc_id, quality, split, CAST(split = 'test' AS INTEGER) AS from_test FROM split")
def split_bundle(spark, sf):
    """The split table written by split; a split is read from its own files."""
    path = scratch_folder(spark, "split")
    rows = fit.stratified_split(table(spark, sf, "labels").select("doc_id", "quality"), "doc_id", "quality", TEST_FRACTION, SEED)
    tables.write_split(rows, path)
    test, train = tables.read_split(spark, path, "test"), tables.read_split(spark, path, "train")
    return test.withColumn("from_test", F.lit(1)).unionByName(train.withColumn("from_test", F.lit(0))).select("doc_id", "quality", "split", "from_test")


@query("feature_list",
       "SELECT CAST(p AS INTEGER) AS position, f AS feature FROM (VALUES "
       + ", ".join(f"({i}, 'priority, {v}')" for i, v in enumerate(PRIORITIES_SQL)) + ") AS t(p, f)")
def feature_list(spark, sf):
    """The feature list as a file with a header (names with commas), read back in order."""
    path = scratch_folder(spark, "features")
    found = encode.fitted_vocabulary(table(spark, sf, "orders"), "o_orderpriority")
    tables.write_feature_list(spark, [f"priority, {v}" for v in found], path)
    names = tables.read_feature_list(spark, path)
    return spark.createDataFrame(list(enumerate(names)), "position int, feature string")


@query("table_csv",
       "SELECT c_custkey, c_name, c_mktsegment, c_acctbal, CASE WHEN c_custkey % 3 = 0 THEN 'a, \"b\"' WHEN c_custkey % 3 = 1 THEN c_name END AS note FROM customer")
def table_csv(spark, sf):
    """A whole table as CSV and back: quotes, commas and nulls survive."""
    path = scratch_folder(spark, "csv")
    k = F.col("c_custkey")
    rows = table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment", "c_acctbal",
                                               F.when(k % 3 == 0, F.lit('a, "b"')).when(k % 3 == 1, F.col("c_name")).alias("note"))
    tables.write_csv(rows, path)
    return spark.read.option("header", True).option("escape", '"').schema(rows.schema).csv(path)


@query("report_csv", "SELECT class, " + ", ".join(f"round({c}, 3) AS {c}" for c in ["precision", "recall", "f1_score", "support"])
       + f" FROM ({ORACLE['classification_report']})")
def report_csv(spark, sf):
    """A report rounded to three places."""
    path = scratch_folder(spark, "csv")
    rep = ev.classification_report(evaluation.doc_predictions(spark, sf), "quality", "predicted")
    tables.write_csv(rep, path, decimals=3)
    return spark.read.option("header", True).schema(rep.schema).csv(path)


@query("comparison_csv", "SELECT 'comparison' AS kind, model AS name, accuracy AS value, position FROM (" + ORACLE["model_comparison"] + ") "
       "UNION ALL SELECT 'ranking', feature, avg_rank, position FROM (" + ORACLE["rank_consensus"] + ")")
def comparison_csv(spark, sf):
    """Comparison and ranking as CSV files, read back."""
    compared = QUERIES["model_comparison"](spark, sf).select(F.lit("comparison").alias("kind"), F.col("model").alias("name"), F.col("accuracy").alias("value"), "position")
    ranking = QUERIES["rank_consensus"](spark, sf).select(F.lit("ranking").alias("kind"), F.col("feature").alias("name"), F.col("avg_rank").alias("value"), "position")
    out = None
    for t in (compared, ranking):
        path = scratch_folder(spark, "csv")
        tables.write_csv(t, path)
        back = spark.read.option("header", True).schema(t.schema).csv(path)
        out = back if out is None else out.unionByName(back)
    return out.withColumn("value", rounded("value"))
