"""Ordered running totals and exact quantiles without a single-task window.

A window ordered over a whole table (or over one of a handful of classes)
sorts everything in one task.  ``running_total`` instead

1. cuts the order axis into range buckets at approximate quantile split
   points (a bounded list: at most ``max_buckets`` values on the driver),
2. sums each bucket (a small table, one row per partition-key x bucket),
3. turns those sums into per-bucket offsets (window over the small table),
4. runs the ordered window inside each bucket only and adds the offset.

The result is exact: bucket boundaries only decide where work is split, not
the order.  ``exact_quantiles`` builds on it: value counts -> running count
-> the value at each interpolation rank, so no aggregation buffer ever holds
all values of a group.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from featurejudge.session import cut_lineage

ROWS_PER_BUCKET = 250_000
MAX_BUCKETS = 20_000


def range_bucket(df: DataFrame, order_col: str, n_rows: int, rows_per_bucket: int = ROWS_PER_BUCKET,
                 max_buckets: int = MAX_BUCKETS) -> DataFrame:
    """Add ``_bkt``: range bucket of ``order_col`` at approximate quantile
    split points, about ``rows_per_bucket`` rows each."""
    n_buckets = min(max_buckets, max(1, math.ceil(n_rows / rows_per_bucket)))
    if n_buckets <= 1:
        return df.withColumn("_bkt", F.lit(0.0))
    # -0.0 and 0.0 are equal to the ordered window but not to the bucket
    # search; map both to 0.0 so equal keys always share a bucket
    d = F.col(order_col).cast("double")
    with_d = df.withColumn("_ord_d", F.when(d == 0.0, F.lit(0.0)).otherwise(d))
    probs = [i / n_buckets for i in range(1, n_buckets)]
    splits = with_d.approxQuantile("_ord_d", probs, 1.0 / (4 * n_buckets))
    inner = sorted({s for s in splits if s is not None and not math.isnan(s) and not math.isinf(s)})
    if not inner:
        return df.withColumn("_bkt", F.lit(0.0))
    bucketizer = Bucketizer(splits=[-math.inf, *inner, math.inf], inputCol="_ord_d",
                            outputCol="_bkt", handleInvalid="keep")
    return bucketizer.transform(with_d).drop("_ord_d")


def running_total(df: DataFrame, order_col: str, value_cols: Sequence[str],
                  partition_cols: Sequence[str] = (), descending: bool = False,
                  prefix: str = "cum_", rows_per_bucket: int | None = None,
                  max_buckets: int | None = None) -> DataFrame:
    """Add ``<prefix><v>`` = sum of ``v`` over all rows of the same partition
    whose ``order_col`` is at or before this row's (ties included), in
    ascending or descending order.  ``order_col`` must be non-null and
    numeric or timestamp-like (cast to double only to pick bucket bounds).

    There is one plan for every size: a small input has one bucket."""
    parts = list(partition_cols)
    # the input is read by the count (of the files' footers), the split-point
    # sketch and the final plan; written once, so its lineage runs once
    df = cut_lineage(df)
    bucketed = range_bucket(df, order_col, df.count(), rows_per_bucket or ROWS_PER_BUCKET, max_buckets or MAX_BUCKETS)
    joined = _with_offsets(bucketed, {f"_o_{v}": F.sum(v) for v in value_cols}, parts, descending)
    order = F.desc(order_col) if descending else F.asc(order_col)
    within = (Window.partitionBy(*parts, "_bkt").orderBy(order)
              .rangeBetween(Window.unboundedPreceding, Window.currentRow))
    return joined.withColumns({f"{prefix}{v}": F.sum(v).over(within) + F.col(f"_o_{v}")
                               for v in value_cols}) \
                 .drop("_bkt", *[f"_o_{v}" for v in value_cols])


def _with_offsets(bucketed: DataFrame, sums: dict, parts: Sequence[str], descending: bool = False) -> DataFrame:
    """Add, per row, each of ``sums`` (name -> aggregate) over all earlier
    buckets of its partition.  The offsets hold one row per (partition,
    bucket); AQE broadcasts them when small."""
    totals = bucketed.groupBy(*parts, "_bkt").agg(*[agg.alias(f"_t{name}") for name, agg in sums.items()])
    before = (Window.partitionBy(*parts).orderBy(F.desc("_bkt") if descending else F.asc("_bkt"))
              .rowsBetween(Window.unboundedPreceding, -1))
    offsets = totals.select(*parts, "_bkt", *[
        F.coalesce(F.sum(f"_t{name}").over(before), F.lit(0)).alias(name) for name in sums])
    return bucketed.join(offsets, [*parts, "_bkt"], "inner")


def exact_rank(df: DataFrame, order_cols: Sequence[str], partition_cols: Sequence[str] = (), rank_col: str = "_rank",
               rows_per_bucket: int | None = None) -> DataFrame:
    """Add ``rank_col``: 1, 2, 3 ... within each partition by ``order_cols``
    (ascending, a total order; the first one numeric and non-null).  Ties of
    the first column are told apart by the others, so no rank repeats and none
    depends on where the buckets are cut."""
    parts = list(partition_cols)
    df = cut_lineage(df)
    bucketed = range_bucket(df, order_cols[0], df.count(), rows_per_bucket or ROWS_PER_BUCKET)
    joined = _with_offsets(bucketed, {"_o": F.count(F.lit(1))}, parts)
    within = Window.partitionBy(*parts, "_bkt").orderBy(*order_cols)
    return joined.withColumn(rank_col, F.row_number().over(within) + F.col("_o")).drop("_bkt", "_o")


def exact_quantiles(df: DataFrame, value_col: str, probs: Sequence[float],
                    group_cols: Sequence[str] = (), weight_col: str | None = None) -> DataFrame:
    """Exact linearly interpolated quantiles (same definition as
    ``percentile`` / ``quantile_cont``) of non-null ``value_col`` per group.
    ``weight_col``: a row stands for so many (a positive integer).

    Returns (group..., prob, quantile, n).  Groups without values are absent.
    """
    groups = list(group_cols)
    number = F.count(F.lit(1)) if weight_col is None else F.sum(weight_col)
    counts = cut_lineage(df.where(F.col(value_col).isNotNull()).groupBy(*groups, value_col).agg(number.alias("_n")))
    ranked = running_total(counts, value_col, ["_n"], groups, prefix="_cum")
    sizes = counts.groupBy(*groups).agg(F.sum("_n").alias("_size"))
    targets = (sizes
               .withColumn("prob", F.explode(F.array(*[F.lit(float(p)) for p in probs])))
               .withColumn("_pos", (F.col("_size") - 1) * F.col("prob"))
               .withColumn("_lo", F.floor("_pos"))
               .withColumn("_hi", F.ceil("_pos"))
               .withColumn("_frac", F.col("_pos") - F.col("_lo")))
    # per group, the (prob, lo/hi, rank) targets as one array; an equi-join
    # on the group (a constant key when there is none) attaches it to the
    # value rows, which keep only the rows whose rank range holds a target
    target = F.struct("prob", "_frac", "_size", F.col("_lo").alias("_r_lo"), F.col("_hi").alias("_r_hi"))
    gkeys = groups or ["_all"]
    if not groups:
        targets = targets.withColumn("_all", F.lit(0))
        ranked = ranked.withColumn("_all", F.lit(0))
    per_group = targets.groupBy(*gkeys).agg(F.collect_list(target).alias("_targets"))
    lo, hi = F.col("_cum_n") - F.col("_n"), F.col("_cum_n")
    hits = (ranked.join(per_group, gkeys, "inner")
                  .select(*groups, F.col(value_col).cast("double").alias("_v"),
                          F.explode(F.filter("_targets", lambda t: ((lo <= t["_r_lo"]) & (t["_r_lo"] < hi)) |
                                                               ((lo <= t["_r_hi"]) & (t["_r_hi"] < hi)))).alias("t"),
                          lo.alias("_clo"), hi.alias("_chi"))
                  .select(*groups, "_v", "t.prob", "t._frac", "t._size",
                          ((F.col("_clo") <= F.col("t._r_lo")) & (F.col("t._r_lo") < F.col("_chi"))).alias("_is_lo"),
                          ((F.col("_clo") <= F.col("t._r_hi")) & (F.col("t._r_hi") < F.col("_chi"))).alias("_is_hi")))
    out = hits.groupBy(*groups, "prob").agg(
        F.max(F.when(F.col("_is_lo"), F.col("_v"))).alias("_vlo"),
        F.max(F.when(F.col("_is_hi"), F.col("_v"))).alias("_vhi"),
        F.first("_frac").alias("_frac"), F.first("_size").alias("n"))
    return out.select(*groups, "prob",
                      (F.col("_vlo") + F.col("_frac") * (F.col("_vhi") - F.col("_vlo"))).alias("quantile"),
                      F.col("n").cast("long").alias("n"))
