"""Fitted statistics (on training rows only), imputation, scaling, label
indexing, class weights and the exact stratified split.

Fitted values are bounded (one number per column or per class) and come back
to the driver as literals, so applying them is a projection that Catalyst
constant-folds; the label itself is never imputed.
"""

from __future__ import annotations

from collections.abc import Sequence
from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

MAX_CLASSES = 1_000           # more classes than this are refused
MEDIAN_ACCURACY = 10_000      # of the sketch that brackets a median
MEDIAN_VALUES = 50_000        # distinct values inside all brackets that are fetched
SPLIT_PREFIX = 3              # hex digits of a row's hash that the split's buckets go by: 4,096 a class


def _rows(df: DataFrame, where: Column | str | None) -> DataFrame:
    return df if where is None else df.where(where)


def fit_medians(df: DataFrame, cols: Sequence[str], where: Column | str | None = None,
                approx: bool = False, accuracy: int = MEDIAN_ACCURACY, max_values: int = MEDIAN_VALUES) -> dict:
    """Interpolated median per column over the selected rows (None when a
    column has no values).  ``approx=True`` uses ``percentile_approx`` only.

    Exact without shuffling rows: a sketch gives a bracket around each median,
    one aggregate counts the values below and inside all brackets, and only
    the distinct values inside come back.  While they are too many the sketch
    runs again inside the brackets, which shrinks them about ``accuracy`` / 4
    times a pass."""
    rows = _rows(df, where)
    if approx:
        r = rows.agg(*[F.percentile_approx(c, 0.5).alias(c) for c in cols]).first()
        return {c: r[c] for c in cols}
    if not cols:
        return {}
    rows = rows.select(*[F.col(f"`{c}`").cast("double").alias(f"v{i}") for i, c in enumerate(cols)])
    every, max_values = range(len(cols)), max(max_values, 8 * len(cols))   # a bracket may hold some values beside the two
    # sizes and the first sketch in one pass: without the sizes the middle is a little wider
    wide = [0.5 - 4.0 / accuracy, 0.5 + 4.0 / accuracy]
    sizes = rows.agg(*[x for i in every for x in (F.count(f"v{i}").alias(f"n{i}"), F.percentile_approx(f"v{i}", wide, accuracy).alias(f"b{i}"))]).first()
    n = {i: sizes[f"n{i}"] for i in every if sizes[f"n{i}"]}
    found = sizes
    # 0-based ranks of the two middle values; below[i]: values under the bracket
    low, high = {i: (n[i] - 1) // 2 for i in n}, {i: n[i] // 2 for i in n}
    bracket, below, inside = {}, dict.fromkeys(n, 0), dict(n)

    def within(i):
        v = F.col(f"v{i}")
        return v.isNotNull() if i not in bracket else (v >= F.lit(bracket[i][0])) & (v <= F.lit(bracket[i][1]))
    while n:
        if found is None:
            aggs = []
            for i in n:
                slack = 2.0 / accuracy
                probs = [max(0.0, (low[i] + 1 - below[i]) / inside[i] - slack), min(1.0, (high[i] + 1 - below[i]) / inside[i] + slack)]
                aggs.append(F.percentile_approx(F.when(within(i), F.col(f"v{i}")), probs, accuracy).alias(f"b{i}"))
            found = rows.agg(*aggs).first()
        narrowed, found = {i: tuple(found[f"b{i}"]) for i in n}, None
        counted = rows.agg(*[x for i, (lo, hi) in narrowed.items() for x in (
            F.count_if(F.col(f"v{i}") < F.lit(lo)).alias(f"u{i}"),
            F.count_if((F.col(f"v{i}") >= F.lit(lo)) & (F.col(f"v{i}") <= F.lit(hi))).alias(f"w{i}"))]).first()
        stuck = True
        for i, b in narrowed.items():
            under, held = counted[f"u{i}"], counted[f"w{i}"]
            # the sketch is approximate: a bracket counts only if both ranks lie in it
            if under <= low[i] and high[i] < under + held and held < inside[i]:
                bracket[i], below[i], inside[i], stuck = b, under, held, False
        pairs = F.filter(F.array(*[F.struct(F.lit(i).alias("i"), F.when(within(i), F.col(f"v{i}")).alias("v")) for i in n]),
                         lambda p: p["v"].isNotNull())
        values = (rows.select(F.explode(pairs).alias("p")).groupBy("p.i", "p.v").agg(F.count(F.lit(1)).alias("k")))
        got = values.limit(max_values + 1).collect()
        if len(got) <= max_values:
            break
        if stuck:      # repeats fill the slack on both sides
            accuracy = min(10 * accuracy, 2 ** 31 - 1)
    out = dict.fromkeys(cols)
    for i in n:
        at, middle = below[i], []
        for v, k in sorted(((r["v"], r["k"]) for r in got if r["i"] == i), key=lambda x: (x[0] != x[0], x[0])):
            middle += [v] * sum(at <= rank < at + k for rank in (low[i], high[i]))
            at += k
        out[cols[i]] = middle[0] + (middle[1] - middle[0]) / 2
    return out


def fit_modes(df: DataFrame, cols: Sequence[str], where: Column | str | None = None) -> dict:
    """Most frequent non-null value per column, in the column's own type;
    ties -> smallest value by the column's own order.  All columns in one job:
    values are stacked with one typed field a column and counted, and the best
    per column is a min over a struct (count descending, value ascending)."""
    rows = _rows(df, where)
    types = {f.name: f.dataType for f in rows.schema.fields}
    fields = [f"v{i}" for i in range(len(cols))]
    stacked = F.explode(F.array(*[
        F.struct(F.lit(i).alias("c"), *[(F.col(f"`{c}`") if i == j else F.lit(None).cast(types[d])).alias(fields[j])
                                        for j, d in enumerate(cols)])
        for i, c in enumerate(cols)]))
    counts = (rows.select(stacked.alias("s")).select("s.*").where(" OR ".join(f"{v} IS NOT NULL" for v in fields))
                  .groupBy("c", *fields).agg(F.count(F.lit(1)).alias("n")))
    best = counts.groupBy("c").agg(F.min(F.struct((-F.col("n")).alias("nn"), *fields)).alias("m")).collect()
    out = dict.fromkeys(cols)
    for r in best:
        out[cols[r["c"]]] = r["m"][fields[r["c"]]]
    return out


def fit_moments(df: DataFrame, cols: Sequence[str], where: Column | str | None = None) -> dict:
    """(mean, population standard deviation) per column, one pass."""
    rows = _rows(df, where)
    aggs = []
    for c in cols:
        aggs += [F.avg(F.col(c)).alias(f"m_{c}"), F.stddev_pop(F.col(c)).alias(f"s_{c}")]
    r = rows.agg(*aggs).first()
    return {c: (r[f"m_{c}"], r[f"s_{c}"]) for c in cols}


def impute(df: DataFrame, fills: dict, fallback=0) -> DataFrame:
    """Fill nulls with the fitted value, then with ``fallback``."""
    cols = {}
    for c, v in fills.items():
        exprs = [F.col(c)]
        if v is not None:
            exprs.append(F.lit(v))
        if fallback is not None:
            exprs.append(F.lit(fallback))
        cols[c] = F.coalesce(*exprs) if len(exprs) > 1 else F.col(c)
    return df.withColumns(cols)


def standardize(df: DataFrame, moments: dict, prefix: str = "", replace: bool = True) -> DataFrame:
    """(x - mean) / std with population std; std 0 or null -> 0."""
    cols = {}
    for c, (m, s) in moments.items():
        name = c if replace and not prefix else f"{prefix}{c}"
        if m is None or s is None or s == 0:
            cols[name] = F.when(F.col(c).isNull(), F.lit(None).cast("double")).otherwise(F.lit(0.0))
        else:
            cols[name] = (F.col(c) - F.lit(m)) / F.lit(s)
    return df.withColumns(cols)


def class_counts(df: DataFrame, label: str, max_classes: int = MAX_CLASSES) -> list[tuple]:
    rows = (df.where(F.col(label).isNotNull()).groupBy(label).count()
              .limit(max_classes + 1).collect())
    if len(rows) > max_classes:
        raise ValueError(f"more than {max_classes} classes in {label}")
    return sorted((r[0], r[1]) for r in rows)


def class_weights(df: DataFrame, label: str, weight_col: str = "weight") -> DataFrame:
    """Balanced weights n / (k * n_c), one row per class."""
    counts = df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("n_class"))
    tot = counts.agg(F.sum("n_class").alias("n"), F.count(F.lit(1)).alias("k")).first()
    if tot["k"] > MAX_CLASSES:
        raise ValueError(f"more than {MAX_CLASSES} classes in {label}")
    return counts.withColumn(weight_col, F.lit(float(tot["n"])) / (F.lit(float(tot["k"])) * F.col("n_class")))


def with_class_weights(df: DataFrame, label: str, weight_col: str = "weight", fitted: DataFrame | None = None) -> DataFrame:
    """``df`` with the balanced weight of its label (``fitted``: weights of
    other rows, say the training rows).  The weights are one row per class of
    a checked number, so they are broadcast and no row is shuffled."""
    weights = (class_weights(df, label, weight_col) if fitted is None else fitted).select(
        F.col(label).alias("_class"), weight_col)
    return df.join(F.broadcast(weights), F.col(label) == F.col("_class"), "left").drop("_class")


def label_index(df: DataFrame, label: str, index_col: str = "target",
                as_text: bool = True) -> tuple[DataFrame, DataFrame]:
    """Index = position of the label's text form among the sorted distinct
    texts (so -1 < 0 < 1 sort as text).  Returns (indexed rows, label table).
    The label table has a checked number of rows and is broadcast, so no row
    is shuffled on its label."""
    text = F.col(label).cast("string") if as_text else F.col(label)
    kind = T.StringType() if as_text else df.schema[label].dataType
    found = sorted(c for c, _ in class_counts(df.select(text.alias("label_text")), "label_text"))
    labels = df.sparkSession.createDataFrame(list(zip(found, range(len(found)))), T.StructType([
        T.StructField("label_text", kind), T.StructField(index_col, T.IntegerType())]))
    lookup = F.broadcast(labels.withColumnRenamed("label_text", "_label_text"))
    return df.join(lookup, text == F.col("_label_text"), "left").drop("_label_text"), labels


def index_to_label(df: DataFrame, index_col: str, labels: DataFrame, out_col: str = "label_text") -> DataFrame:
    """``labels``: the label table of ``label_index`` (of a checked size)."""
    lab = labels.select(F.col(labels.columns[1]).alias(index_col), F.col("label_text").alias(out_col))
    return df.join(F.broadcast(lab), index_col, "left")


# --------------------------------------------------------------------------
# exact stratified split
# --------------------------------------------------------------------------

def split_allocation(counts: Sequence[tuple], test_fraction: float) -> dict:
    """Test rows per class: floor of each quota plus one for the classes with
    the largest remainders until the total is ceil(test_fraction * n).
    Ties in the remainder go to the smaller class value.  Exact rational
    arithmetic (0.2 is 1/5, not 0.2000000000000000111)."""
    p = Fraction(str(test_fraction)).limit_denominator(10**9)
    n = sum(c for _, c in counts)
    total = -((-n * p.numerator) // p.denominator)
    base = {k: (c * p.numerator) // p.denominator for k, c in counts}
    rem = sorted(counts, key=lambda kc: (-((kc[1] * p.numerator) % p.denominator), kc[0]))
    extra = total - sum(base.values())
    for k, _ in rem[:extra]:
        base[k] += 1
    return base


def split_hash(key: str, seed: int) -> Column:
    """md5 hex of "<seed>:<key>" (DuckDB computes the same string)."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit(""))))


def split_quotas(class_counts_df: DataFrame, label: str, test_fraction: float) -> DataFrame:
    """(label, _quota): test rows per class, computed in Spark on the
    class-count table (one row per class): floor of each quota plus one for
    the classes with the largest remainders until the total is
    ceil(test_fraction * n); remainder ties go to the smaller class value.
    Exact integer arithmetic (0.2 is 1/5)."""
    p = Fraction(str(test_fraction)).limit_denominator(10**9)
    num, den = p.numerator, p.denominator
    cc = class_counts_df  # (label, _n): one row per class
    everything = Window.partitionBy()  # the class-count table: one row per class
    cc = (cc.withColumn("_base", F.expr(f"(_n * {num}) div {den}"))
            .withColumn("_rem", F.expr(f"(_n * {num}) % {den}"))
            .withColumn("_total", F.expr(f"(sum(_n) OVER () * {num} + {den} - 1) div {den}"))
            .withColumn("_extra", F.col("_total") - F.sum("_base").over(everything))
            .withColumn("_ord", F.row_number().over(Window.orderBy(F.desc("_rem"), F.asc(label)))))
    return cc.select(label, (F.col("_base") + F.when(F.col("_ord") <= F.col("_extra"), 1).otherwise(0))
                     .cast("long").alias("_quota"))


def split_thresholds(df: DataFrame, key: str, label: str, test_fraction: float = 0.2, seed: int = 42,
                     prefix_len: int = SPLIT_PREFIX) -> DataFrame:
    """(_class, _last_hash, _last_key): the last test row of every class that
    has one, by (md5(seed:key), key); at most ``MAX_CLASSES`` rows.

    No window spans a class: rows are histogrammed into 16**prefix_len hash
    buckets per class, and only the rows of each class's cut bucket are
    ranked.  The buckets are few enough to be summed before the shuffle.  Both
    passes read the key and the label alone."""
    spark, kinds = df.sparkSession, df.schema
    hashed = (df.where(F.col(label).isNotNull())
                .select(F.col(label).alias("_class"), F.col(key).alias("_key"), split_hash(key, seed).alias("_h"))
                .withColumn("_b", F.substring("_h", 1, prefix_len)))
    hist = hashed.groupBy("_class", "_b").agg(F.count(F.lit(1)).alias("_cnt"))
    # class sizes come from the histogram: no second pass over the rows
    quota = split_quotas(hist.groupBy("_class").agg(F.sum("_cnt").alias("_n")), "_class", test_fraction)
    w = Window.partitionBy("_class").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    cuts = (hist.join(quota, "_class")
                .withColumn("_before", F.coalesce(F.sum("_cnt").over(w), F.lit(0)))
                .where((F.col("_before") < F.col("_quota")) & (F.col("_before") + F.col("_cnt") >= F.col("_quota")))
                .select(F.col("_class").alias("_c"), F.col("_b").alias("_cut"), (F.col("_quota") - F.col("_before")).alias("_need")))
    found = cuts.limit(MAX_CLASSES + 1).collect()
    if len(found) > MAX_CLASSES:
        raise ValueError(f"more than {MAX_CLASSES} classes in {label}")
    cuts = F.broadcast(spark.createDataFrame(found, cuts.schema))
    last = (hashed.join(cuts, (F.col("_class") == F.col("_c")) & (F.col("_b") == F.col("_cut")))
                  .withColumn("_r", F.row_number().over(Window.partitionBy("_class").orderBy("_h", "_key")))
                  .where(F.col("_r") == F.col("_need")).select("_class", "_h", "_key").collect())
    return spark.createDataFrame(last, T.StructType([
        T.StructField("_class", kinds[label].dataType), T.StructField("_last_hash", T.StringType()),
        T.StructField("_last_key", kinds[key].dataType)]))


def stratified_split(df: DataFrame, key: str, label: str, test_fraction: float = 0.2,
                     seed: int = 42, split_col: str = "split", prefix_len: int = SPLIT_PREFIX) -> DataFrame:
    """Exact stratified split: in each class the rows with the smallest
    (md5(seed:key), key) go to test, as many as ``split_quotas`` gives.

    The thresholds (one row per class, a checked number) are computed at once
    and broadcast; the split itself is a projection of ``df``, so no row is
    shuffled and ``df`` is read once.  Rows with a null label are left out.
    ``key`` should be unique: rows that repeat a key stay together."""
    cuts = F.broadcast(split_thresholds(df, key, label, test_fraction, seed, prefix_len))
    h = split_hash(key, seed)
    same = (h == F.col("_last_hash")) & (F.col(key).isNull() | F.coalesce(F.col(key) <= F.col("_last_key"), F.lit(False)))
    test = F.coalesce((h < F.col("_last_hash")) | same, F.lit(False))
    return (df.where(F.col(label).isNotNull()).join(cuts, F.col(label) == F.col("_class"), "left")
              .withColumn(split_col, F.when(test, F.lit("test")).otherwise(F.lit("train")))
              .drop("_class", "_last_hash", "_last_key"))


# --------------------------------------------------------------------------
# exact stratified folds
# --------------------------------------------------------------------------

def fold_thresholds(df: DataFrame, key: str, label: str, folds: int, seed: int = 42, prefix_len: int = 5) -> DataFrame:
    """(_class, _none, _cuts): for every class the last rows, as (hash, key),
    of the first 1 .. folds - 1 folds, and how many of those folds together
    hold no row (classes with fewer rows than folds).  At most ``MAX_CLASSES``
    rows.

    One histogram of hash prefixes a class finds all cuts; only the rows of
    the cut buckets are ranked.  Both passes read key and label alone."""
    spark, kinds = df.sparkSession, df.schema
    hashed = (df.where(F.col(label).isNotNull())
                .select(F.col(label).alias("_class"), F.col(key).alias("_key"), split_hash(key, seed).alias("_h"))
                .withColumn("_b", F.substring("_h", 1, prefix_len)))
    hist = hashed.groupBy("_class", "_b").agg(F.count(F.lit(1)).alias("_cnt"))
    buckets = Window.partitionBy("_class").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    spread = hist.select("_class", "_b", "_cnt", F.coalesce(F.sum("_cnt").over(buckets), F.lit(0)).alias("_before"),
                         F.sum("_cnt").over(Window.partitionBy("_class")).alias("_n"))
    # rows of the first j folds
    upto = F.transform(F.sequence(F.lit(1), F.lit(folds - 1)), lambda j: F.call_function("div", F.col("_n") * j, F.lit(folds)))
    here = F.filter(upto, lambda r: (F.col("_before") < r) & (r <= F.col("_before") + F.col("_cnt")))
    none = F.size(F.filter(upto, lambda r: r == 0))
    found = (spread.withColumn("_none", none).withColumn("_needs", F.transform(here, lambda r: r - F.col("_before")))
             .where((F.size("_needs") > 0) | (F.col("_before") == 0)).select("_class", "_b", "_none", "_needs")
             .limit(MAX_CLASSES * folds + 1).collect())
    classes = sorted({r["_class"] for r in found})
    if len(classes) > MAX_CLASSES:
        raise ValueError(f"more than {MAX_CLASSES} classes in {label}")
    cut = T.StructType([T.StructField("_c", kinds[label].dataType), T.StructField("_cut", T.StringType()), T.StructField("_need", T.LongType())])
    needs = F.broadcast(spark.createDataFrame([(r["_class"], r["_b"], n) for r in found for n in r["_needs"]], cut))
    in_bucket = Window.partitionBy("_class", "_b").orderBy("_h", "_key")
    # a bucket of several cuts is ranked once
    last = (hashed.join(needs.select("_c", "_cut").distinct(), (F.col("_class") == F.col("_c")) & (F.col("_b") == F.col("_cut")), "left_semi")
                  .withColumn("_r", F.row_number().over(in_bucket).cast("long"))
                  .join(needs, (F.col("_class") == F.col("_c")) & (F.col("_b") == F.col("_cut")) & (F.col("_r") == F.col("_need")))
                  .select("_class", "_h", "_key").collect())
    none_of = {r["_class"]: r["_none"] for r in found}
    ends = {c: sorted((r["_h"], r["_key"]) for r in last if r["_class"] == c) for c in classes}
    end = T.StructType([T.StructField("h", T.StringType()), T.StructField("k", kinds[key].dataType)])
    return spark.createDataFrame([(c, none_of[c], ends[c]) for c in classes], T.StructType([
        T.StructField("_class", kinds[label].dataType), T.StructField("_none", T.IntegerType()), T.StructField("_cuts", T.ArrayType(end))]))


def stratified_folds(df: DataFrame, key: str, label: str, folds: int = 5, seed: int = 42, fold_col: str = "fold",
                     prefix_len: int = 5) -> DataFrame:
    """Exact stratified folds: the rows of a class, by (md5(seed:key), key),
    are cut into ``folds`` runs whose sizes differ by one at most; fold
    ``j`` (from 0) holds the ranks above ``n * j // folds``.

    The thresholds (one row per class, a checked number) are computed at once
    and broadcast; the folds are a projection of ``df``, so no row is shuffled.
    Rows with a null label are left out.  ``key`` must be unique and not null."""
    if folds < 2:
        raise ValueError("folds must be 2 or more")
    cuts = F.broadcast(fold_thresholds(df, key, label, folds, seed, prefix_len))
    h = split_hash(key, seed)
    before = F.size(F.filter("_cuts", lambda t: (h > t["h"]) | ((h == t["h"]) & F.coalesce(F.col(key) > t["k"], F.lit(False)))))
    return (df.where(F.col(label).isNotNull()).join(cuts, F.col(label) == F.col("_class"))
              .withColumn(fold_col, (before + F.col("_none")).cast("int")).drop("_class", "_none", "_cuts"))
