"""One chain from raw columns to a verdict: preparation by column group,
oversampling, three classifiers, one evaluation, the run registry, comparison
and rank consensus.

Fitted values are no SQL; each query that depends on a fit therefore returns
what must hold for any fit (members, sums, order), and SQL states it.
Statistics, folds, class sizes and the evaluation of rules are checked by value.

Table: orders with their lines' totals and their customer's events.  Label:
the return flag of the primary line (3 classes; orders without one are left
out).  Most customers have no events, so three columns hold nulls."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression, OneVsRest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featurejudge.functions.columns import rounded
from featurejudge.operators import boosting, chain, encode, evaluate, fit, models, rank
from featurejudge.plans.catalog import EVENT_TYPES_SQL, PRIORITIES_SQL, query, r6
from featurejudge.plans.fitted import SEED, TEST_FRACTION, split_sql
from featurejudge.session import cut_lineage, scratch_folder
from featurejudge.sources import tables
from featurejudge.sources.tables import table

KEY, LABEL = "o_orderkey", "direction"
NUMERIC = ["o_totalprice", "duration_days", "avg_discount", "event_value"]
BINARY = ["multi_phase", "many_events"]
CODES = ["o_orderpriority", "last_event"]
GROUPS = [("numeric", NUMERIC, ["median", "scale"]), ("binary", BINARY, ["most_frequent"]), ("codes", CODES, ["most_frequent", "onehot"])]
CLASSES = 3
ROUNDS, TREES = 12, 100         # of the models that other queries look into
BOOSTED_ROUNDS = 40             # of the query of the boosted model itself (the operator's default is 1000)


def order_table(spark, sf) -> DataFrame:
    """The raw table with its split; each detail table is reduced to its key first."""
    lines = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias(KEY)).agg(
        F.min(F.when(F.col("l_linenumber") == 1, F.col("l_returnflag"))).alias(LABEL), F.sum("l_quantity").alias("duration_days"),
        (F.sum(F.round(F.col("l_discount") * 100).cast("long")) / F.count(F.lit(1))).alias("avg_discount"),
        (F.count_if(F.col("l_linestatus") == "F") > 1).cast("int").alias("multi_phase"))
    events = table(spark, sf, "events").groupBy(F.col("user_id").alias("o_custkey")).agg(
        (F.sum(F.round(F.col("value") * 100).cast("long")) / F.count("value")).alias("event_value"),
        F.max(F.struct("event_id", "event_type"))["event_type"].alias("last_event"), (F.count(F.lit(1)) > 60).cast("int").alias("many_events"))
    rows = (table(spark, sf, "orders").select(KEY, "o_custkey", "o_totalprice", "o_orderpriority")
            .join(lines, KEY, "left").join(events, "o_custkey", "left").drop("o_custkey"))
    return fit.stratified_split(cut_lineage(rows), KEY, LABEL, TEST_FRACTION, SEED)


ORDER_TABLE_SQL = (
    "lines AS (SELECT l_orderkey, min(CASE WHEN l_linenumber = 1 THEN l_returnflag END) AS direction, sum(l_quantity) AS duration_days, "
    "sum(CAST(round(l_discount * 100) AS BIGINT)) / count(*) AS avg_discount, "
    "CAST(count(*) FILTER (l_linestatus = 'F') > 1 AS INTEGER) AS multi_phase FROM lineitem GROUP BY l_orderkey), "
    "ev AS (SELECT user_id, sum(CAST(round(value * 100) AS BIGINT)) / count(value) AS event_value, arg_max(event_type, event_id) AS last_event, "
    "CAST(count(*) > 60 AS INTEGER) AS many_events FROM events GROUP BY user_id), "
    "base AS (SELECT o.o_orderkey, o.o_totalprice, o.o_orderpriority, lines.* EXCLUDE (l_orderkey), ev.* EXCLUDE (user_id) FROM orders o "
    "LEFT JOIN lines ON o.o_orderkey = lines.l_orderkey LEFT JOIN ev ON o.o_custkey = ev.user_id), "
    + split_sql("base", KEY, LABEL))
LABELS_SQL = f"lx AS (SELECT lt, CAST(row_number() OVER (ORDER BY lt) - 1 AS INTEGER) AS target FROM (SELECT DISTINCT {LABEL} AS lt FROM split))"
TEST_SQL = f"t AS (SELECT {KEY}, lx.target FROM split JOIN lx ON split.{LABEL} = lx.lt WHERE split = 'test')"
TRAIN, TEST = "split = 'train'", "split = 'test'"


def preparation() -> chain.ColumnGroups:
    return chain.ColumnGroups(groups=GROUPS, remainder="drop", keep=[KEY, "target", "split"])


def _codes(c: str) -> list[str]:
    return PRIORITIES_SQL if c == "o_orderpriority" else EVENT_TYPES_SQL


def _name(c: str, v: str) -> str:
    return f"{c}_{v}".replace("-", "_").replace(" ", "_")


PREPARED = [*NUMERIC, *BINARY, *[_name(c, v) for c in CODES for v in _codes(c)]]


@dataclass
class Prepared:
    rows: DataFrame               # key, target, split, features
    train: DataFrame
    test: DataFrame
    features: list[str]
    raw: DataFrame = field(repr=False, default=None)


def prepared_orders(spark, sf) -> Prepared:
    raw, _ = fit.label_index(order_table(spark, sf), LABEL, "target")
    prep = preparation().fit(raw.where(TRAIN))
    rows = cut_lineage(prep.transform(raw))
    return Prepared(rows, rows.where(TRAIN), rows.where(TEST), prep.features, raw)


def _prepared_sql() -> str:
    med = ", ".join(f"median(CAST({c} AS DOUBLE)) AS d_{c}" for c in NUMERIC)
    modes = ", ".join(f"(SELECT {c} FROM split WHERE split = 'train' AND {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1) AS d_{c}"
                      for c in BINARY + CODES)
    fill = ", ".join([f"coalesce(CAST({c} AS DOUBLE), d_{c}) AS {c}" for c in NUMERIC] + [f"coalesce({c}, d_{c}) AS {c}" for c in BINARY + CODES])
    mom = ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in NUMERIC)
    out = ", ".join([f"round(({c} - m_{c}) / s_{c}, 6) AS {c}" for c in NUMERIC] + [f"CAST({c} AS INTEGER) AS {c}" for c in BINARY]
                    + [f"CAST({c} = '{v}' AS INTEGER) AS {_name(c, v)}" for c in CODES for v in _codes(c)])
    return (f"WITH {ORDER_TABLE_SQL}, {LABELS_SQL}, med AS (SELECT {med} FROM split WHERE split = 'train'), modes AS (SELECT {modes}), "
            f"filled AS (SELECT {KEY}, lx.target, split, {fill} FROM split JOIN lx ON split.{LABEL} = lx.lt, med, modes), "
            f"mom AS (SELECT {mom} FROM filled WHERE split = 'train') SELECT {KEY}, target, split, {out} FROM filled, mom")


@query("prepared_columns", _prepared_sql())
def prepared_columns(spark, sf):
    """M3: the transformed table, after the fitted preparation was saved and loaded."""
    raw, _ = fit.label_index(order_table(spark, sf), LABEL, "target")
    path = scratch_folder(spark, "models")
    preparation().fit(raw.where(TRAIN)).write().save(path)
    out = chain.ColumnGroupsModel.load(path).transform(raw)
    return out.withColumns({c: rounded(c) for c in NUMERIC})


# ---------------------------------------------------------------------------
# oversampling in a chain
# ---------------------------------------------------------------------------

def oversampling_chain(n_classes: int, majority: int) -> chain.Chain:
    """Preparation, SMOTE and one-vs-rest logistic regression with C = 1 on the
    resampled rows (all of weight 1: the classes are equal)."""
    lr = LogisticRegression(featuresCol="features", labelCol="target", maxIter=1000, regParam=models.c_to_reg(1.0, n_classes * majority))
    return chain.Chain(stages=[preparation(), models.assembler(PREPARED), chain.Oversample(key=KEY, seed=SEED),
                               OneVsRest(classifier=lr, featuresCol="features", labelCol="target")])


def _majority(rows: DataFrame) -> int:
    return max(n for _, n in fit.class_counts(rows, "target"))


@query("oversampled_classes",
       f"WITH {ORDER_TABLE_SQL}, {LABELS_SQL}, c AS (SELECT lx.target, count(*) AS n FROM split JOIN lx ON split.{LABEL} = lx.lt "
       "WHERE split = 'train' GROUP BY lx.target) SELECT target, n AS n_original, (SELECT max(n) FROM c) - n AS n_synthetic, "
       "CAST(0 AS BIGINT) AS n_test_rows FROM c")
def oversampled_classes(spark, sf):
    """M5 in a chain: class sizes of what the classifier is fitted on; no test
    row is among them, and none is made when the chain only scores."""
    raw, _ = fit.label_index(order_table(spark, sf), LABEL, "target")
    seen = cut_lineage(chain.resampled(oversampling_chain(CLASSES, 1), raw.where(TRAIN)).select(KEY, "target"))
    test = raw.where(TEST).select(F.col(KEY).alias("_test"))
    return (seen.join(test, F.col(KEY) == F.col("_test"), "left").groupBy("target").agg(
        F.count(KEY).alias("n_original"), F.count_if(F.col(KEY).isNull()).alias("n_synthetic"), F.count("_test").alias("n_test_rows")))


def checked_scores(scored: DataFrame) -> DataFrame:
    return evaluate.checked_probabilities(scored, [KEY, "target"])


SCORES_SQL = (f"WITH {ORDER_TABLE_SQL}, {LABELS_SQL}, {TEST_SQL} SELECT {KEY}, target, {CLASSES} AS n_classes, "
              "CAST(1.0 AS DOUBLE) AS total, 1 AS in_range, 1 AS is_greatest FROM t")


def _chained(spark, sf) -> tuple[PipelineModel, DataFrame]:
    raw, _ = fit.label_index(order_table(spark, sf), LABEL, "target")
    train = raw.where(TRAIN)
    return oversampling_chain(CLASSES, _majority(train)).fit(train), raw.where(TEST)


@query("chained_logreg", SCORES_SQL)
def chained_logreg(spark, sf):
    """M4: fit the whole chain, save it, load it, score the test rows."""
    model, test = _chained(spark, sf)
    path = scratch_folder(spark, "models")
    tables.save_model(model, path)
    return checked_scores(models.predictions(tables.load_pipeline_model(path), test, [KEY, "target"]))


# ---------------------------------------------------------------------------
# folds and boosting
# ---------------------------------------------------------------------------

FOLDS = 5


@query("stratified_folds",
       "WITH l AS (SELECT doc_id, quality, md5('42:' || CAST(doc_id AS VARCHAR)) AS h FROM labels), "
       "r AS (SELECT *, row_number() OVER (PARTITION BY quality ORDER BY h, doc_id) AS r, count(*) OVER (PARTITION BY quality) AS n FROM l) "
       "SELECT doc_id, quality, CAST(" + " + ".join(f"CAST(r > n * {j} // {FOLDS} AS INTEGER)" for j in range(1, FOLDS)) + " AS INTEGER) AS fold FROM r")
def stratified_folds(spark, sf):
    return fit.stratified_folds(table(spark, sf, "labels").select("doc_id", "quality"), "doc_id", "quality", FOLDS, SEED)


def boosted(p: Prepared, rounds: int = ROUNDS) -> boosting.SoftmaxBoostedModel:
    return boosting.SoftmaxBoosting(features=p.features, rounds=rounds, seed=SEED).fit(p.train)


@query("softmax_boosting", SCORES_SQL)
def softmax_boosting(spark, sf):
    """M9: three classes under softmax loss; saved and loaded before it scores."""
    p = prepared_orders(spark, sf)
    path = scratch_folder(spark, "models")
    boosted(p, BOOSTED_ROUNDS).write().save(path)
    return checked_scores(boosting.SoftmaxBoostedModel.load(path).transform(p.test))


@query("boosted_gain_top15")
def boosted_gain_top15(spark, sf):
    """The 15 features of the greatest mean gain, from the node table."""
    p = prepared_orders(spark, sf)
    gains = boosting.gain_table(boosted(p).nodes(spark)).withColumn("model", F.lit("boosted"))
    return rank.top_features(gains, 15).select("feature", "importance", "total_gain", "splits", "rows", "rank")


@query("boosted_nodes",
       f"WITH {ORDER_TABLE_SQL}, {LABELS_SQL}, n AS (SELECT count(*) AS n FROM split WHERE split = 'train') "
       f"SELECT r AS round, c AS class, CAST(1 AS BIGINT) AS children_add_up, CAST(1 AS BIGINT) AS gains_positive, CAST(1 AS BIGINT) AS root_is_sampled "
       f"FROM n, (SELECT unnest(range({ROUNDS}))::INTEGER AS r), (SELECT unnest(range({CLASSES}))::INTEGER AS c)")
def boosted_nodes(spark, sf):
    """M9: in every tree the rows of a split are those of its two sides, no gain
    is negative, and the root holds about the sampled share of the rows."""
    p = prepared_orders(spark, sf)
    nodes = cut_lineage(boosted(p).nodes(spark))
    n_train = p.train.count()
    child = nodes.select("round", "class", F.floor((F.col("node") - 1) / 2).cast("int").alias("node"), F.col("n").alias("n_child")).where("node >= 0")
    sides = child.groupBy("round", "class", "node").agg(F.sum("n_child").alias("sides"))
    share = F.col("n") / F.lit(float(n_train))
    return nodes.join(sides, ["round", "class", "node"], "left").groupBy("round", "class").agg(
        F.min((F.col("feature").isNull() == F.col("sides").isNull()).cast("long") * F.when(F.col("sides").isNull() | (F.col("sides") == F.col("n")), 1)
              .otherwise(0)).alias("children_add_up"),
        F.min(F.when(F.col("feature").isNull() | (F.col("gain") > 0), 1).otherwise(0)).cast("long").alias("gains_positive"),
        F.max(F.when(F.col("node") == 0, ((share > 0.8) & (share < 0.98)).cast("long"))).alias("root_is_sampled"))


# ---------------------------------------------------------------------------
# evaluation of many models, run registry, comparison, verdict
# ---------------------------------------------------------------------------

def rule_predictions(spark, sf) -> DataFrame:
    """Three rules as models over all labelled orders: (model, target,
    prediction, probability).  ``price`` gives scores with many ties."""
    rows, _ = fit.label_index(order_table(spark, sf), LABEL, "target")
    price = F.least(F.floor(F.col("o_totalprice") / 1000) / 500.0, F.lit(1.0))
    rules = [("always", F.lit(1), F.array(F.lit(0.0), F.lit(1.0), F.lit(0.0))),
             ("price", F.when(price < 0.25, 0).when(price < 0.5, 1).otherwise(2), F.array(1 - price, F.abs(price - 0.5), price)),
             ("phases", F.when(F.col("multi_phase") == 1, 0).otherwise(1), F.lit(None).cast("array<double>"))]
    each = F.explode(F.array(*[F.struct(F.lit(n).alias("model"), p.cast("int").alias("prediction"), s.alias("probability")) for n, p, s in rules]))
    return rows.select("target", each.alias("m")).select("target", "m.*")


RULES_SQL = (
    f"WITH {ORDER_TABLE_SQL}, {LABELS_SQL}, o AS (SELECT lx.target, least(floor(o_totalprice / 1000) / 500.0, 1.0) AS price, multi_phase "
    f"FROM split JOIN lx ON split.{LABEL} = lx.lt), "
    "p AS (SELECT 'always' AS model, target, 1 AS prediction, [0.0, 1.0, 0.0]::DOUBLE[] AS probability FROM o UNION ALL "
    "SELECT 'price', target, CASE WHEN price < 0.25 THEN 0 WHEN price < 0.5 THEN 1 ELSE 2 END, [1 - price, abs(price - 0.5), price]::DOUBLE[] FROM o UNION ALL "
    "SELECT 'phases', target, CASE WHEN multi_phase = 1 THEN 0 ELSE 1 END, NULL FROM o), "
    "cls AS (SELECT unnest(range(3))::INTEGER AS c), ms AS (SELECT DISTINCT model FROM p), "
    "acc AS (SELECT model, avg(CAST(target = prediction AS INTEGER)) AS accuracy FROM p GROUP BY model), "
    "st AS (SELECT ms.model, c, count(*) FILTER (target = c) AS sup, count(*) FILTER (prediction = c) AS k, "
    "count(*) FILTER (target = c AND prediction = c) AS tp FROM p JOIN ms USING (model), cls GROUP BY ms.model, c), "
    "f1 AS (SELECT *, CASE WHEN sup + k > 0 THEN 2.0 * tp / (sup + k) ELSE 0 END AS f FROM st), "
    "agg AS (SELECT model, avg(f) AS macro, sum(f * sup) / sum(sup) AS weighted FROM f1 GROUP BY model), "
    "s AS (SELECT model, c, CAST(target = c AS INTEGER) AS y, probability[c + 1] AS s FROM p, cls WHERE probability IS NOT NULL), "
    "rk AS (SELECT *, rank() OVER (PARTITION BY model, c ORDER BY s) + (count(*) OVER (PARTITION BY model, c, s) - 1) / 2.0 AS r FROM s), "
    "area AS (SELECT model, c, (sum(r * y) - sum(y) * (sum(y) + 1) / 2.0) / (sum(y) * sum(1 - y)) AS a FROM rk GROUP BY model, c), "
    "metrics AS (SELECT model, 'accuracy' AS metric, accuracy AS value FROM acc UNION ALL SELECT model, 'macro_f1', macro FROM agg UNION ALL "
    "SELECT model, 'weighted_f1', weighted FROM agg UNION ALL SELECT model, 'auc_' || c, a FROM area)")


@query("evaluated_rules", RULES_SQL + f" SELECT model, metric, {r6('value')} AS value FROM metrics")
def evaluated_rules(spark, sf):
    """C4 by value: accuracy, F1 and AUC of three models from one ``evaluate``."""
    return evaluate.evaluate(rule_predictions(spark, sf)).metrics().withColumn("value", rounded("value"))


@query("evaluated_boxes", RULES_SQL + ", q AS (SELECT model, target AS true_class, c AS class, probability[c + 1] AS v FROM p, cls WHERE probability IS NOT NULL) "
       "SELECT model, true_class, class, count(*) AS n, round(min(v), 6) AS min, round(quantile_cont(v, 0.25), 6) AS q1, round(median(v), 6) AS median, "
       "round(quantile_cont(v, 0.75), 6) AS q3, round(max(v), 6) AS max FROM q GROUP BY ALL")
def evaluated_boxes(spark, sf):
    """Probability boxes of several models by true class, from counts of scores."""
    boxes = evaluate.evaluate(rule_predictions(spark, sf)).boxes
    return boxes.select("model", "true_class", "class", "n", *[rounded(c).alias(c) for c in ["min", "q1", "median", "q3", "max"]])


def _registry(spark, sf) -> str:
    """A fresh registry with the rules' metrics: run r1 written twice, r2 once."""
    path = scratch_folder(spark, "runs")
    metrics = cut_lineage(evaluate.evaluate(rule_predictions(spark, sf)).metrics())
    for run in ("r1", "r1", "r2"):
        tables.write_run(metrics, path, run)
    return path


@query("run_registry", RULES_SQL + f" SELECT run_id, model, metric, {r6('value')} AS value FROM metrics, (VALUES ('r1'), ('r2')) AS r(run_id)")
def run_registry(spark, sf):
    """The registry after a run was written twice."""
    return tables.read_run_metrics(spark, _registry(spark, sf)).select("run_id", "model", "metric", rounded("value").alias("value"))


@query("run_comparison", RULES_SQL + ", a AS (SELECT model, round(value, 4) AS accuracy FROM metrics WHERE metric = 'accuracy') "
       "SELECT model, CAST(accuracy AS DOUBLE) AS accuracy, CAST(row_number() OVER (ORDER BY accuracy DESC, model) AS INTEGER) AS position FROM a")
def run_comparison(spark, sf):
    """C5 fed by the run table: only the files of one run are read."""
    runs = tables.read_run_metrics(spark, _registry(spark, sf), "r1").where("metric = 'accuracy'")
    return rank.compare_models(runs.select("model", F.col("value").alias("accuracy")), places=4)


@dataclass
class Fitted:
    predictions: DataFrame        # model, key, target, prediction, probability
    importances: DataFrame        # model, feature, importance


def fitted_models(spark, sf) -> Fitted:
    """Three classifiers on the prepared table: oversampled logistic
    regression, random forest with class weights, softmax boosting."""
    p = prepared_orders(spark, sf)
    steps = oversampling_chain(CLASSES, _majority(p.train)).getStages()[1:]
    logistic = chain.Chain(stages=steps).fit(p.train)
    weights = fit.class_weights(p.train, "target")
    forest = models.forest_pipeline(p.features, weight="weight", trees=TREES, depth=8).fit(fit.with_class_weights(p.train, "target", fitted=weights))
    trees = boosted(p)
    scored = {"logistic": models.predictions(logistic, p.test, [KEY, "target"]), "forest": models.predictions(forest, p.test, [KEY, "target"]),
              "boosted": trees.transform(p.test).select(KEY, "target", "prediction", "probability")}
    each = [d.withColumn("model", F.lit(n)) for n, d in scored.items()]
    gains = boosting.gain_table(trees.nodes(spark)).select(F.lit("boosted").alias("model"), "feature", "importance")
    # one model a class: the mean of the absolute coefficients
    coefs = {f: 0.0 for f in p.features}
    for one in logistic.stages[-1].models:
        for f, c in zip(p.features, one.coefficients.toArray()):
            coefs[f] += abs(float(c)) / CLASSES
    linear = spark.createDataFrame([("logistic", f, c) for f, c in coefs.items()], "model string, feature string, importance double")
    importances = gains.unionByName(models.importance_table(forest, p.features, "forest")).unionByName(linear)
    return Fitted(cut_lineage(each[0].unionByName(each[1]).unionByName(each[2])), importances)


MODELS = ["boosted", "forest", "logistic"]
_MODELS_SQL = "(VALUES ('boosted'), ('forest'), ('logistic')) AS m(model)"


@query("evaluated_models",
       f"WITH {ORDER_TABLE_SQL}, {LABELS_SQL}, {TEST_SQL} SELECT model, count(*) AS n, count(*) AS n_cells, CAST(count(*) AS DOUBLE) AS support, "
       f"{CLASSES} * count(*) AS n_scores, 1 AS accuracy_is_trace, 1 AS auc_in_range, 1 AS roc_ends_at_one, {CLASSES} AS n_classes "
       f"FROM t, {_MODELS_SQL} GROUP BY model")
def evaluated_models(spark, sf):
    """C4 on three fitted models: what must hold between the tables."""
    e = evaluate.evaluate(fitted_models(spark, sf).predictions)
    cells = e.confusion.groupBy("model").agg(F.sum("n").alias("n_cells"), F.sum(F.when(F.col("true_class") == F.col("pred_class"), F.col("n"))).alias("trace"))
    support = e.report.where("class = 'macro avg'").select("model", "support")
    auc = e.auc.groupBy("model").agg(F.min(F.col("auc").between(0, 1).cast("int")).alias("auc_in_range"), F.count(F.lit(1)).cast("int").alias("n_classes"))
    ends = e.roc.groupBy("model", "class").agg(F.max("tpr").alias("t"), F.max("fpr").alias("f")).groupBy("model").agg(
        F.min(((F.col("t") == 1) & (F.col("f") == 1)).cast("int")).alias("roc_ends_at_one"))
    boxes = e.boxes.groupBy("model").agg(F.sum("n").alias("n_scores"))
    out = e.accuracy
    for t in (cells, support, auc, ends, boxes):
        out = out.join(t, "model")
    return out.select("model", "n", "n_cells", "support", "n_scores", (F.abs(F.col("accuracy") - F.col("trace") / F.col("n_cells")) < 1e-12).cast("int")
                      .alias("accuracy_is_trace"), "auc_in_range", "roc_ends_at_one", "n_classes")


@query("fitted_verdict",
       "WITH f AS (SELECT unnest(['" + "', '".join(PREPARED) + "']) AS feature) SELECT feature, CAST(3 AS BIGINT) AS n_models, 1 AS ranks_in_range, "
       "1 AS positions_are_a_permutation, 1 AS compared_in_order, 1 AS mean_of_ranks FROM f")
def fitted_verdict(spark, sf):
    """C5, C6, C8 on three fitted models: metrics and importances go into the
    registry, comparison and consensus read it.  Features that a model never
    uses have the importance 0."""
    fitted = fitted_models(spark, sf)
    path = scratch_folder(spark, "runs")
    names = spark.createDataFrame([(m, f) for m in MODELS for f in PREPARED], "model string, feature string")
    dense = names.join(fitted.importances, ["model", "feature"], "left").fillna(0.0, ["importance"])
    tables.write_run(evaluate.evaluate(fitted.predictions).metrics(), f"{path}/metrics", "r1")
    tables.write_run(dense, f"{path}/importances", "r1")
    compared = rank.compare_models(tables.read_run_metrics(spark, f"{path}/metrics", "r1").where("metric = 'accuracy'")
                                   .select("model", F.col("value").alias("accuracy")))
    compared_in_order = [r["position"] for r in compared.orderBy(F.desc("accuracy"), "model").collect()] == [1, 2, 3]     # one row a model
    ranked = rank.importance_rank(tables.read_run_metrics(spark, f"{path}/importances", "r1").select("model", "feature", "importance"))
    out = cut_lineage(rank.rank_consensus(ranked, PREPARED, MODELS, theory_terms=("duration", "event")))
    each = F.array(*[F.col(f"rank_{m}") for m in MODELS])
    n = len(PREPARED)
    in_order = sorted(r["position"] for r in out.select("position").collect()) == list(range(1, n + 1))       # bounded: one row a feature
    return out.select("feature", F.size(F.filter(each, lambda r: r.isNotNull())).cast("long").alias("n_models"),
                      F.forall(each, lambda r: r.between(1, n)).cast("int").alias("ranks_in_range"), F.lit(int(in_order)).alias("positions_are_a_permutation"),
                      F.lit(int(compared_in_order)).alias("compared_in_order"),
                      (F.abs(F.col("avg_rank") - F.aggregate(each, F.lit(0.0), lambda a, r: a + r) / len(MODELS)) < 1e-9).cast("int").alias("mean_of_ranks"))


# ---------------------------------------------------------------------------
# permutation importance, coefficient tables, text report
# ---------------------------------------------------------------------------

REPEATS = 10


@query("permuted_ranks",
       f"WITH {ORDER_TABLE_SQL}, n AS (SELECT count(*) AS n FROM split WHERE split = 'test') SELECT f AS feature, r AS repeat, n AS n_rows, "
       "n AS n_donors, n AS n_targets FROM n, (SELECT unnest(['" + "', '".join(NUMERIC) + f"']) AS f), (SELECT unnest(range({REPEATS}))::INTEGER AS r)")
def permuted_ranks(spark, sf):
    """Every shuffle of a feature's values is a bijection of the test rows."""
    test = order_table(spark, sf).where(TEST).select(KEY, *NUMERIC)
    pairs = models.permuted_pairs(test, NUMERIC, KEY, REPEATS, SEED)
    return models.distinct_ranks(pairs, ["feature", "repeat"], "n_rows", {"donor": "n_donors", "target_rank": "n_targets"})


COEFS_SQL = ("g AS (SELECT avg(p_size) AS m FROM part), cf AS (SELECT p_type AS class, p_brand AS feature, round(avg(p_size) - (SELECT m FROM g), 6) AS coef "
             "FROM part GROUP BY p_type, p_brand), s AS (SELECT feature, round(sum(abs(coef)), 6) AS total FROM cf GROUP BY feature)")


def part_coefficients(spark, sf) -> DataFrame:
    p = table(spark, sf, "part")
    m = p.agg(F.avg("p_size")).first()[0]
    return p.groupBy(F.col("p_type").alias("class"), F.col("p_brand").alias("feature")).agg(rounded(F.avg("p_size") - F.lit(m)).alias("coef"))


@query("top_coefficient_rows",
       f"WITH {COEFS_SQL}, t AS (SELECT *, CAST(row_number() OVER (ORDER BY total DESC, feature) AS INTEGER) AS position FROM s) "
       "SELECT cf.feature, cf.class, cf.coef, t.total AS sum_abs_coef, t.position FROM cf JOIN t USING (feature) WHERE position <= 10")
def top_coefficient_rows(spark, sf):
    """T4: the ten features with the greatest sum of absolute coefficients,
    then their rows of the coefficient table."""
    return rank.top_coefficient_rows(part_coefficients(spark, sf), 10, places=6)


PART_TYPES_SQL = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]


@query("top_coefficients_wide",
       f"WITH {COEFS_SQL}, t AS (SELECT *, CAST(row_number() OVER (ORDER BY total DESC, feature) AS INTEGER) AS position FROM s) "
       "SELECT cf.feature, t.position, " + ", ".join(f"max(CASE WHEN cf.class = '{v}' THEN cf.coef END) AS vs_{v}" for v in PART_TYPES_SQL)
       + " FROM cf JOIN t USING (feature) WHERE position <= 10 GROUP BY cf.feature, t.position")
def top_coefficients_wide(spark, sf):
    """The same rows with a column a class, as the surveyed report has them."""
    coefs = part_coefficients(spark, sf)
    classes = encode.fitted_vocabulary(table(spark, sf, "part"), "p_type")
    return encode.long_to_wide(rank.top_coefficient_rows(coefs, 10, places=6), ["feature", "position"], "class", "coef", classes, prefix="vs")


@query("first_three_features",
       "WITH a AS (SELECT p_brand AS feature, round(avg(p_retailprice), 6) AS importance FROM part GROUP BY p_brand), "
       "r AS (SELECT *, CAST(row_number() OVER (ORDER BY importance DESC, feature) AS INTEGER) AS rank FROM a) "
       "SELECT string_agg(rank || '. ' || feature, ', ' ORDER BY rank) AS line, count(*) AS n FROM r WHERE rank <= 3")
def first_three_features(spark, sf):
    """The first three features as the line of a text report."""
    imp = table(spark, sf, "part").groupBy(F.col("p_brand").alias("feature")).agg(rounded(F.avg("p_retailprice")).alias("importance"))
    return rank.first_features_line(imp.withColumn("model", F.lit("price")), 3).select("line", "n")
