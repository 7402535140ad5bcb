"""Queries for fitted statistics, the split, scaling, weights and labels."""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featurejudge.functions.columns import col_or_default, columns_like, numeric_columns, rounded
from featurejudge.functions import text as tx
from featurejudge.operators import encode, fit
from featurejudge.plans.catalog import query, sql_flag
from featurejudge.session import cut_lineage
from featurejudge.sources.tables import table

SEED = 42
TEST_FRACTION = 0.2


def split_sql(src: str, key: str, label: str, test_fraction: float = TEST_FRACTION, seed: int = SEED) -> str:
    """CTEs ending in ``split``: ``src`` rows with a non-null label plus the
    split column, by the same rule as ``fit.stratified_split`` written with
    a per-class window (fine for the oracle)."""
    p = Fraction(str(test_fraction)).limit_denominator(10**9)
    num, den = p.numerator, p.denominator
    return (
        f"h AS (SELECT *, md5('{seed}:' || CAST({key} AS VARCHAR)) AS _h FROM {src} WHERE {label} IS NOT NULL), "
        f"cc AS (SELECT {label} AS _c, count(*) AS _n FROM h GROUP BY {label}), "
        f"al AS (SELECT _c, _n, (_n * {num}) // {den} AS _base, (_n * {num}) % {den} AS _rem FROM cc), "
        f"al2 AS (SELECT al.*, row_number() OVER (ORDER BY _rem DESC, _c ASC) AS _ord FROM al), "
        f"extra AS (SELECT (sum(_n) * {num} + {den} - 1) // {den} - sum(_base) AS _x FROM al), "
        f"alloc AS (SELECT _c, _base + CASE WHEN _ord <= (SELECT _x FROM extra) THEN 1 ELSE 0 END AS _q FROM al2), "
        f"ranked AS (SELECT h.*, row_number() OVER (PARTITION BY {label} ORDER BY _h, {key}) AS _r FROM h), "
        f"split AS (SELECT ranked.* EXCLUDE (_h, _r), CASE WHEN _r <= alloc._q THEN 'test' ELSE 'train' END AS split "
        f"FROM ranked JOIN alloc ON ranked.{label} = alloc._c)"
    )


# ---------------------------------------------------------------------------

def order_line_stats(spark, sf) -> DataFrame:
    """orders LEFT JOIN per-order line aggregates (null for orders without
    lines); lineitem is reduced to one row per order before the join."""
    a = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.avg("l_discount").alias("avg_discount"), F.count(F.lit(1)).cast("double").alias("n_lines"))
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    return o.join(a, "o_orderkey", "left")


ORDER_STATS_SQL = ("base AS (SELECT o.o_orderkey, o.o_orderstatus, o.o_totalprice, a.avg_discount, "
                   "CAST(a.n_lines AS DOUBLE) AS n_lines FROM orders o LEFT JOIN (SELECT l_orderkey, "
                   "avg(l_discount) AS avg_discount, count(*) AS n_lines FROM lineitem GROUP BY l_orderkey) a "
                   "ON o.o_orderkey = a.l_orderkey)")


@query("impute_median",
       f"WITH {ORDER_STATS_SQL}, {split_sql('base', 'o_orderkey', 'o_orderstatus')}, "
       "med AS (SELECT median(avg_discount) AS m1, median(n_lines) AS m2, median(o_totalprice) AS m3 "
       "FROM split WHERE split = 'train') "
       "SELECT o_orderkey, split, round(coalesce(avg_discount, m1, 0), 6) AS avg_discount, "
       "round(coalesce(n_lines, m2, 0), 6) AS n_lines, round(coalesce(o_totalprice, m3, 0), 6) AS o_totalprice "
       "FROM split, med")
def impute_median(spark, sf):
    # joins once; the split is a projection of the written rows
    base = fit.stratified_split(cut_lineage(order_line_stats(spark, sf)), "o_orderkey", "o_orderstatus", TEST_FRACTION, SEED)
    cols = ["avg_discount", "n_lines", "o_totalprice"]
    med = fit.fit_medians(base, cols, where=F.col("split") == "train")
    out = fit.impute(base, med, fallback=0)
    return out.select("o_orderkey", "split", *[rounded(c).alias(c) for c in cols])


@query("impute_mode",
       "WITH base AS (SELECT o.o_orderkey, o.o_orderstatus, p.direction, a.n_lines FROM orders o "
       "LEFT JOIN (SELECT l_orderkey, min(l_returnflag) AS direction FROM lineitem WHERE l_linenumber = 1 "
       "GROUP BY l_orderkey) p ON o.o_orderkey = p.l_orderkey "
       "LEFT JOIN (SELECT l_orderkey, count(*) AS n_lines FROM lineitem GROUP BY l_orderkey) a "
       f"ON o.o_orderkey = a.l_orderkey), {split_sql('base', 'o_orderkey', 'o_orderstatus')}, "
       "md AS (SELECT (SELECT direction FROM split WHERE split = 'train' AND direction IS NOT NULL "
       "GROUP BY direction ORDER BY count(*) DESC, direction ASC LIMIT 1) AS m1, "
       "(SELECT n_lines FROM split WHERE split = 'train' AND n_lines IS NOT NULL "
       "GROUP BY n_lines ORDER BY count(*) DESC, n_lines ASC LIMIT 1) AS m2) "
       "SELECT o_orderkey, split, coalesce(direction, m1) AS direction, "
       "CAST(coalesce(n_lines, m2, 0) AS BIGINT) AS n_lines FROM split, md")
def impute_mode(spark, sf):
    li = table(spark, sf, "lineitem")
    lines = li.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.min(F.when(F.col("l_linenumber") == 1, F.col("l_returnflag"))).alias("direction"), F.count(F.lit(1)).alias("n_lines"))
    base = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus").join(lines, "o_orderkey", "left")
    base = fit.stratified_split(cut_lineage(base), "o_orderkey", "o_orderstatus", TEST_FRACTION, SEED)
    modes = fit.fit_modes(base, ["direction", "n_lines"], where=F.col("split") == "train")
    out = fit.impute(base, {"direction": modes["direction"]}, fallback=None)
    out = fit.impute(out, {"n_lines": modes["n_lines"]}, fallback=0)
    return out.select("o_orderkey", "split", "direction", F.col("n_lines").cast("long"))


@query("standardize",
       "WITH s AS (SELECT avg(o_custkey) AS m1, stddev_pop(o_custkey) AS s1, avg(o_totalprice) AS m2, "
       "stddev_pop(o_totalprice) AS s2 FROM orders) "
       "SELECT o_orderkey, round((o_custkey - m1) / s1, 6) AS z_o_custkey, "
       "round((o_totalprice - m2) / s2, 6) AS z_o_totalprice, CAST(0.0 AS DOUBLE) AS z_force_ratio "
       "FROM orders, s")
def standardize(spark, sf):
    o = table(spark, sf, "orders").withColumn("force_ratio", F.lit(1.0))
    cols = numeric_columns(o, exclude=["o_orderkey"])
    z = fit.standardize(o, fit.fit_moments(o, cols), prefix="z_")
    return z.select("o_orderkey", *[rounded(f"z_{c}").alias(f"z_{c}") for c in cols])


AIR_VALUE = "Attacker had air superiority in the theater"
AIR_COLUMN = f"air_superiority_{AIR_VALUE}"


@query("interaction_terms",
       f"WITH d AS (SELECT doc_id, CASE WHEN lang = 'en' THEN 1 ELSE 0 END AS air, {sql_flag('text', tx.SUPPLY_V2)} AS supply_cut, "
       f"{sql_flag('text', tx.NAVAL_THEORY)} AS naval_power FROM documents), "
       "j AS (SELECT d.*, l.quality, l.toxic, CASE WHEN l.toxic = 0 THEN 1 ELSE 0 END AS s0, "
       "CASE WHEN l.toxic = 1 THEN 1 ELSE 0 END AS s1 FROM d LEFT JOIN labels l ON d.doc_id = l.doc_id) "
       "SELECT doc_id, quality, s0 + s1 AS surprise_sum, supply_cut * (s0 + s1) AS supply_surprise, "
       "naval_power * (s0 + s1) AS naval_surprise, supply_cut * air AS supply_air FROM j")
def interaction_terms(spark, sf):
    d = tx.with_keyword_flags(table(spark, sf, "documents").select("doc_id", "lang", "text"), "text",
                              {"supply_cut": tx.SUPPLY_V2, "naval_power": tx.NAVAL_THEORY}).drop("text")
    j = d.join(table(spark, sf, "labels").select("doc_id", "quality", "toxic"), "doc_id", "left")
    j = encode.one_hot(j, "toxic", [0, 1], prefix="surprise_level")
    j = j.withColumn("surprise_sum", encode.row_sum(columns_like(j, "surprise_level")))
    # the description goes through the encoder, so its column has a sanitised name
    j = j.withColumn("air", F.when(F.col("lang") == "en", AIR_VALUE).otherwise("Neither side had air superiority"))
    j = encode.one_hot(j, "air", [AIR_VALUE], prefix="air_superiority")
    air = col_or_default(j, AIR_COLUMN, 0)
    return j.select("doc_id", "quality", "surprise_sum",
                    (F.col("supply_cut") * F.col("surprise_sum")).alias("supply_surprise"),
                    (F.col("naval_power") * F.col("surprise_sum")).alias("naval_surprise"),
                    (F.col("supply_cut") * air).alias("supply_air"))


@query("label_index",
       "WITH l AS (SELECT lt, CAST(row_number() OVER (ORDER BY lt) - 1 AS INTEGER) AS target FROM "
       "(SELECT DISTINCT CAST(o_orderstatus AS VARCHAR) AS lt FROM orders WHERE o_orderstatus IS NOT NULL)) "
       "SELECT o.o_orderkey, o.o_orderstatus, l.target, l.lt AS label_back FROM orders o "
       "LEFT JOIN l ON CAST(o.o_orderstatus AS VARCHAR) = l.lt")
def label_index(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    indexed, labels = fit.label_index(o, "o_orderstatus", "target")
    return fit.index_to_label(indexed, "target", labels, "label_back")


@query("class_weights",
       "WITH c AS (SELECT o_orderstatus, count(*) AS n_class FROM orders WHERE o_orderstatus IS NOT NULL "
       "GROUP BY o_orderstatus), t AS (SELECT sum(n_class) AS n, count(*) AS k FROM c) "
       "SELECT o_orderstatus, n_class, round(CAST(n AS DOUBLE) / (k * n_class), 6) AS weight FROM c, t")
def class_weights(spark, sf):
    w = fit.class_weights(table(spark, sf, "orders"), "o_orderstatus")
    return w.select("o_orderstatus", "n_class", rounded("weight").alias("weight"))


@query("stratified_split",
       f"WITH {split_sql('labels', 'doc_id', 'quality')} SELECT doc_id, quality, split FROM split")
def stratified_split(spark, sf):
    lab = table(spark, sf, "labels").select("doc_id", "quality")
    return fit.stratified_split(lab, "doc_id", "quality", TEST_FRACTION, SEED)


@query("split_reunion",
       f"WITH {split_sql('labels', 'doc_id', 'quality')} "
       "SELECT doc_id, split, quality, quality + toxic AS toxic_plus FROM split")
def split_reunion(spark, sf):
    s = fit.stratified_split(table(spark, sf, "labels"), "doc_id", "quality", TEST_FRACTION, SEED)
    train, test = s.where(F.col("split") == "train"), s.where(F.col("split") == "test")
    both = train.unionByName(test)
    return both.select("doc_id", "split", "quality", (F.col("quality") + F.col("toxic")).alias("toxic_plus"))
