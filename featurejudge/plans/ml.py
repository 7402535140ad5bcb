"""MLlib queries.  Fitted values are no SQL, so the queries of models are
rows-only; ``scored_members`` and ``importance_rows`` state what holds for any fit.

Training data: labelled documents with keyword flags, text length and a
language one-hot; label = quality; exact stratified split; prepared by column
group and weighted by class, both fitted on train.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from featurejudge.functions import text as tx
from featurejudge.operators import evaluate, fit, models, rank
from featurejudge.operators.chain import ColumnGroups
from featurejudge.plans.catalog import DOC_FLAGS, query
from featurejudge.plans.fitted import SEED, TEST_FRACTION, split_sql
from featurejudge.session import cut_lineage
from featurejudge.sources.tables import table

NUMERIC = ["n_chars", "log_chars"]


@dataclass
class Prepared:
    train: DataFrame
    test: DataFrame
    features: list[str]
    n_classes: int


def prepared_documents(spark, sf) -> Prepared:
    d = table(spark, sf, "documents").select("doc_id", "lang", F.col("n_chars").cast("double"), "text")
    d = tx.with_keyword_flags(d, "text", DOC_FLAGS).drop("text").withColumn("log_chars", F.log1p("n_chars"))
    d = d.join(table(spark, sf, "labels").select("doc_id", "quality"), "doc_id", "inner")
    d = cut_lineage(d)  # texts are read once; the split and all that is fitted read flags and lengths
    d, _ = fit.label_index(fit.stratified_split(d, "doc_id", "quality", TEST_FRACTION, SEED), "quality", "target")
    train_rows = F.col("split") == "train"
    groups = [("numeric", NUMERIC, ["median", "scale"]), ("flags", list(DOC_FLAGS), ["most_frequent"]), ("lang", ["lang"], ["onehot"])]
    prep = ColumnGroups(groups=groups, remainder="drop", keep=["doc_id", "target", "split"]).fit(d.where(train_rows))
    weights = fit.class_weights(d.where(train_rows), "target")
    d = fit.with_class_weights(prep.transform(d), "target", fitted=weights)
    d = cut_lineage(d)  # the fits iterate over it many times
    d = models.sized_for_training(d, d.count()).cache()
    n_classes = d.select("target").distinct().count()
    return Prepared(d.where(train_rows), d.where(~train_rows), prep.features, n_classes)


def _fitted_forest(p: Prepared, trees: int):
    train = models.spread_for_trees(p.train, p.train.count())
    return models.forest_pipeline(p.features, weight="weight", trees=trees).fit(train)


def _scored(model, p: Prepared) -> DataFrame:
    return models.predictions(model, p.test, ["doc_id", "target"])


def _unit_reg(p: Prepared) -> float:
    """L2 strength of C = 1."""
    return models.c_to_reg(1.0, p.train.agg(F.sum("weight").alias("w")).first()["w"] or 1.0)


@query("logreg_ovr")
def logreg_ovr(spark, sf):
    p = prepared_documents(spark, sf)
    m = models.logistic_pipeline(p.features, weight="weight", reg=_unit_reg(p), ovr=True).fit(p.train)
    return _scored(m, p)


@query("logreg_cv")
def logreg_cv(spark, sf):
    p = prepared_documents(spark, sf)
    train = fit.stratified_folds(p.train, "doc_id", "target", 5, SEED).cache()      # read by every fold and strength
    m = models.logistic_cv(train, p.features, weight="weight", n_strengths=50, folds=5, max_iter=5000, fold_col="fold")
    return models.predictions(m.bestModel, p.test, ["doc_id", "target"])


@query("random_forest")
def random_forest(spark, sf):
    p = prepared_documents(spark, sf)
    m = _fitted_forest(p, 1200)
    return _scored(m, p)


@query("gbt")
def gbt(spark, sf):
    p = prepared_documents(spark, sf)
    # 100 rounds instead of 1000: MLlib runs several jobs per round, so the
    # surveyed round count is minutes of scheduling on a few hundred rows
    m = models.boosted_pipeline(p.features, rounds=100, depth=7, rate=0.05, n_classes=p.n_classes).fit(p.train)
    return _scored(m, p)


@query("mlp")
def mlp(spark, sf):
    p = prepared_documents(spark, sf)
    m = models.perceptron_pipeline(p.features, p.n_classes, hidden=(128, 64, 32)).fit(p.train)
    return _scored(m, p)


@query("impurity_importance")
def impurity_importance(spark, sf):
    p = prepared_documents(spark, sf)
    m = _fitted_forest(p, 500)
    return rank.top_features(models.importance_table(m, p.features, "random_forest"), k=20)


@query("coefficients")
def coefficients(spark, sf):
    p = prepared_documents(spark, sf)
    m = models.logistic_pipeline(p.features, weight="weight", reg=_unit_reg(p)).fit(p.train)
    coefs = models.coefficient_table(m, p.features, "logistic")
    return coefs.join(rank.coef_summary(coefs, top=None), "feature")


@query("permutation_importance")
def permutation_importance(spark, sf):
    p = prepared_documents(spark, sf)
    m = _fitted_forest(p, 500)
    return models.permutation_importance(m, p.test, p.features, "doc_id", "target", repeats=10)


@query("smote_balance")
def smote_balance(spark, sf):
    e = table(spark, sf, "embeddings").select("vec_id", "label", "embedding")
    return models.smote(e, "vec_id", "label", "embedding", k=5, seed=SEED)


# ---------------------------------------------------------------------------
# what holds for any fit
# ---------------------------------------------------------------------------

LANGS_SQL = ["de", "en", "es", "fr"]
FEATURES_SQL = NUMERIC + list(DOC_FLAGS) + [f"lang_{v}" for v in LANGS_SQL]
_SPLIT = (f"WITH base AS (SELECT l.doc_id, l.quality FROM labels l JOIN documents d USING (doc_id)), {split_sql('base', 'doc_id', 'quality')}, "
          "lx AS (SELECT q, CAST(row_number() OVER (ORDER BY q) - 1 AS INTEGER) AS target FROM (SELECT DISTINCT quality AS q FROM split)), "
          "t AS (SELECT doc_id, lx.target FROM split JOIN lx ON split.quality = lx.q WHERE split = 'test')")


@query("scored_members",
       f"{_SPLIT} SELECT model, doc_id, target, 2 AS n_classes, CAST(1.0 AS DOUBLE) AS total, 1 AS in_range, 1 AS is_greatest "
       "FROM t, (VALUES ('logreg'), ('forest'), ('boosted'), ('mlp')) AS m(model)")
def scored_members(spark, sf):
    """Each model scores every test document once, with
    probabilities that sum to 1 and a prediction of the greatest one."""
    p = prepared_documents(spark, sf)
    fits = {"logreg": models.logistic_pipeline(p.features, weight="weight", reg=_unit_reg(p), ovr=True),
            "forest": models.forest_pipeline(p.features, weight="weight", trees=50),
            "boosted": models.boosted_pipeline(p.features, rounds=10, n_classes=p.n_classes),
            "mlp": models.perceptron_pipeline(p.features, p.n_classes, max_iter=50)}
    each = [_scored(pipe.fit(p.train), p).withColumn("model", F.lit(name)) for name, pipe in fits.items()]
    out = each[0]
    for d in each[1:]:
        out = out.unionByName(d)
    return evaluate.checked_probabilities(out, ["model", "doc_id", "target"])


@query("importance_rows",
       "SELECT k AS kind, f AS feature, CAST(n AS BIGINT) AS n, 1 AS in_range FROM (SELECT unnest(['" + "', '".join(FEATURES_SQL) + "']) AS f), "
       "(VALUES ('impurity', 1), ('coefficient', 1), ('permutation', 1)) AS m(k, n)")
def importance_rows(spark, sf):
    """Every table of importances has one row a feature; impurity
    importances sum to 1 and no permutation changes accuracy by more than 1."""
    p = prepared_documents(spark, sf)
    forest = models.forest_pipeline(p.features, weight="weight", trees=50).fit(p.train)
    linear = models.logistic_pipeline(p.features, weight="weight", reg=_unit_reg(p)).fit(p.train)
    impurity = models.importance_table(forest, p.features, "forest")
    total = F.abs(F.sum("importance").over(Window.partitionBy("model")) - 1) < 1e-6          # one row a feature
    shuffled = models.permutation_importance(forest, p.test, p.features, "doc_id", "target", repeats=3)
    tables = [impurity.select(F.lit("impurity").alias("kind"), "feature", total.cast("int").alias("ok")),
              models.coefficient_table(linear, p.features, "logistic").select(F.lit("coefficient").alias("kind"), "feature", F.col("coef").isNotNull().cast("int").alias("ok")),
              shuffled.select(F.lit("permutation").alias("kind"), "feature", F.col("importance_mean").between(-1, 1).cast("int").alias("ok"))]
    out = tables[0].unionByName(tables[1]).unionByName(tables[2])
    return out.groupBy("kind", "feature").agg(F.count(F.lit(1)).alias("n"), F.min("ok").alias("in_range"))
