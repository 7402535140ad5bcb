"""Reshape and encoding: unpivot, presence / count matrices, one-hot,
distinct-count flags, top-k vocabularies, interactions.

Vocabularies are fitted once, checked against a size cap and passed to the
aggregation, so the output schema is fixed at plan time and each matrix is a
single partial+final hash aggregation keyed by the entity key.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from featurejudge.functions.columns import sanitize_name
from featurejudge.session import cut_lineage

MAX_VOCABULARY = 1000


def unpivot_codes(df: DataFrame, key: str, code_cols: Sequence[str], value_name: str = "code",
                  var_name: str = "slot", trim: bool = True) -> DataFrame:
    """Wide repeated code columns -> (key, slot, code); null codes dropped,
    codes trimmed.  Only the code is kept downstream (no slot feature)."""
    cols = [c for c in code_cols if c in df.columns]
    long = df.select(key, *[F.col(c).cast("string").alias(c) for c in cols]) \
             .unpivot([key], cols, var_name, value_name) \
             .where(F.col(value_name).isNotNull())
    if trim:
        long = long.withColumn(value_name, F.trim(F.col(value_name)))
    return long


def fitted_vocabulary(df: DataFrame, col: str, max_size: int = MAX_VOCABULARY) -> list:
    """Sorted distinct non-null values of ``col``; refuses vocabularies above
    ``max_size`` (a one-hot of an unbounded column is a modelling error)."""
    vals = (df.select(col).where(F.col(col).isNotNull()).distinct()
              .limit(max_size + 1).collect())
    if len(vals) > max_size:
        raise ValueError(f"vocabulary of {col} exceeds {max_size} values")
    return sorted(r[0] for r in vals)


def fitted_vocabularies(df: DataFrame, cols: Sequence[str], max_size: int = MAX_VOCABULARY) -> dict:
    """``fitted_vocabulary`` for several columns in one job (values are
    carried as text and cast back to each column's type)."""
    if not cols:
        return {}
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).cast("string").alias("v")) for c in cols]))
    rows = (df.select(pairs.alias("p")).select("p.c", "p.v").where(F.col("v").isNotNull()).distinct()
              .limit(max_size * len(cols) + 1).collect())
    out = {c: [] for c in cols}
    for r in rows:
        out[r["c"]].append(r["v"])
    types = {f.name: f.dataType for f in df.schema.fields}
    for c, vals in out.items():
        if len(vals) > max_size:
            raise ValueError(f"vocabulary of {c} exceeds {max_size} values")
        if type(types[c]).__name__ != "StringType":
            vals = [r[0] for r in df.sparkSession.createDataFrame([(v,) for v in vals], "v string")
                    .select(F.col("v").cast(types[c])).collect()]
        out[c] = sorted(vals)
    return out


def multi_value_flag(col: str, alias: str) -> Column:
    """1 when a group holds more than one distinct non-null value of ``col``
    (same as ``count_distinct > 1``, but a plain min/max hash aggregate)."""
    return F.when(F.max(col) > F.min(col), 1).when(F.max(col).isNotNull(), 0).alias(alias)


def matrix_name(prefix: str | None, col: str, value, multi: bool) -> str:
    parts = [p for p in (prefix, col if multi or not prefix else None, str(value)) if p]
    return sanitize_name("_".join(parts))


def presence_aggs(code_cols: Sequence[str], vocab: Iterable, prefix: str, trim: bool = True) -> list[Column]:
    """Aggregates giving, per group, 1 when any of the repeated code columns
    holds the value (trimmed), else 0.  Same result as unpivot + presence
    matrix, but fusable with other aggregates of the same detail table."""
    def code(c):
        return F.trim(F.col(c)) if trim else F.col(c)
    out = []
    for v in vocab:
        hit = None
        for c in code_cols:
            h = code(c) == F.lit(v)
            hit = h if hit is None else (hit | h)
        out.append(F.max(F.when(hit, 1).otherwise(0)).alias(matrix_name(prefix, "", v, False)))
    return out


def count_aggs(vocabs: dict[str, Iterable], prefix: str | None = None) -> list[Column]:
    """Aggregates counting each (column, value); see ``count_matrix``."""
    multi = len(vocabs) > 1
    return [F.sum(F.when(F.col(col) == F.lit(v), 1).otherwise(0)).cast("long")
            .alias(matrix_name(prefix, col, v, multi))
            for col, vocab in vocabs.items() for v in vocab]


def first_by_agg(order_by: Sequence[str], col: str, where: Column | None = None, alias: str | None = None) -> Column:
    """``col`` of the first row by a total order (optionally among rows
    matching ``where``), as a partial-aggregation-friendly min of a struct."""
    packed = F.struct(*[F.col(c) for c in order_by], F.col(col).alias("_value"))
    if where is not None:
        packed = F.when(where, packed)
    return F.min(packed)["_value"].alias(alias or col)


def presence_matrix(long: DataFrame, key: str, code_col: str, vocab: Iterable, prefix: str) -> DataFrame:
    """(key, code) rows -> one row per key with ``<prefix>_<code>`` = 1 when
    present, else 0."""
    aggs = [F.max(F.when(F.col(code_col) == F.lit(v), 1).otherwise(0)).alias(matrix_name(prefix, code_col, v, False))
            for v in vocab]
    return long.groupBy(key).agg(*aggs)


def count_matrix(df: DataFrame, key: str, vocabs: dict[str, Iterable], prefix: str | None = None) -> DataFrame:
    """Count of each (column, value) per key.  Names are ``<prefix>_<value>``
    for one column and ``<prefix>_<column>_<value>`` for several (no two
    columns can collide)."""
    return df.groupBy(key).agg(*count_aggs(vocabs, prefix))


def long_to_wide(long: DataFrame, keys: Sequence[str], name_col: str, value_col: str, names: Sequence,
                 prefix: str | None = None, default=None) -> DataFrame:
    """One row per ``keys`` with a column for each of ``names`` (the value
    under that name; repeated names add up; ``default`` where there is none).
    The names are given, so no pass is needed to find them."""
    def column(v):
        value = F.sum(F.when(F.col(name_col) == F.lit(v), F.col(value_col)))
        out = value if default is None else F.coalesce(value, F.lit(default))
        return out.alias(sanitize_name(f"{prefix}_{v}" if prefix else v))
    return long.groupBy(*keys).agg(*[column(v) for v in names])


def distinct_count_flag(df: DataFrame, key: str, col: str, threshold: int = 1,
                        count_name: str = "n_distinct", flag_name: str = "flag") -> DataFrame:
    """Distinct non-null values of ``col`` per key and the flag
    ``n_distinct > threshold``."""
    return (df.groupBy(key).agg(F.count_distinct(col).alias(count_name))
              .withColumn(flag_name, (F.col(count_name) > threshold).cast("int")))


def one_hot(df: DataFrame, col: str, vocab: Iterable, prefix: str | None = None,
            drop: bool = True) -> DataFrame:
    """Single-categorical one-hot; null or unseen values give all zeros."""
    p = prefix if prefix is not None else col
    cols = {sanitize_name(f"{p}_{v}"): F.when(F.col(col) == F.lit(v), 1).otherwise(0) for v in vocab}
    out = df.withColumns(cols)
    return out.drop(col) if drop else out


def value_counts(df: DataFrame, col: str) -> DataFrame:
    return df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n"))


def top_k_values(df: DataFrame, col: str, k: int = 10, prefix_chars: int = 64) -> DataFrame:
    """The k most frequent non-null values (ties: value ascending) with their
    count and 1-based rank.

    Text values are counted on a 128-bit hash plus their first
    ``prefix_chars`` characters, so the counting shuffle carries a bounded
    key per distinct value however long the values are.  Ordering by the
    prefix agrees with ordering by the full text unless two prefixes are
    equal, so the only values whose order needs the full text are those tied
    with the k-th on both count and prefix; their full text is fetched in a
    second pass and the final top-k is exact.  Other types are counted
    directly."""
    vals = df.where(F.col(col).isNotNull())
    if not isinstance(df.schema[col].dataType, T.StringType):
        top = value_counts(vals, col).orderBy(F.desc("n"), F.asc(col)).limit(k)
        return top.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("n"), F.asc(col))))
    keyed = vals.select(F.md5(F.col(col)).alias("_h"), F.substring(col, 1, prefix_chars).alias("_p"))
    counts = keyed.groupBy("_h").agg(F.count(F.lit(1)).alias("n"), F.min("_p").alias("_p"))
    head = counts.orderBy(F.desc("n"), F.asc("_p"), F.asc("_h")).limit(k).collect()  # k rows
    if len(head) < k:
        cand = counts
    else:
        kth = head[-1]
        cand = counts.where((F.col("n") > kth["n"]) | ((F.col("n") == kth["n"]) & (F.col("_p") <= kth["_p"])))
    cand = cand.select("_h", "n")
    full = vals.select(F.col(col), F.md5(F.col(col)).alias("_h")).join(cand, "_h", "inner") \
               .groupBy(col, "n").agg(F.count(F.lit(1)).alias("_m")).select(col, "n")
    top = full.orderBy(F.desc("n"), F.asc(col)).limit(k)
    # k rows at most: the rank window runs on the k-row result only.
    return top.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("n"), F.asc(col))))


def top_k_texts(df: DataFrame, key: str, col: str, k: int = 10, prefix_chars: int = 64) -> tuple[DataFrame, DataFrame]:
    """(rows, top): the k most frequent texts (ties: text ascending) with their
    hash, count and 1-based rank, and (key, hash) of every row with a text.

    The text is read once to write (key, 128-bit hash, prefix) of each row,
    from which everything is counted, and once more, for one row of each value
    that may be among the k: those above the k-th count, and those that tie
    with it on count and prefix.  ``key`` must be unique and not null."""
    rows = cut_lineage(df.where(F.col(col).isNotNull()).select(key, F.md5(F.col(col)).alias("_h"), F.substring(col, 1, prefix_chars).alias("_p")))
    counts = cut_lineage(rows.groupBy("_h").agg(F.count(F.lit(1)).alias("n"), F.min("_p").alias("_p"), F.min(key).alias("_one")))
    head = counts.orderBy(F.desc("n"), F.asc("_p"), F.asc("_h")).limit(k).collect()  # k rows
    if len(head) == k:
        kth = head[-1]
        counts = counts.where((F.col("n") > kth["n"]) | ((F.col("n") == kth["n"]) & (F.col("_p") <= kth["_p"])))
    texts = df.select(F.col(key).alias("_one"), F.col(col)).join(counts.select("_one", "_h", "n"), "_one")
    top = cut_lineage(texts.orderBy(F.desc("n"), F.asc(col)).limit(k).select("_h", col, "n"))
    ranked = top.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("n"), F.asc(col))))       # k rows
    return rows.select(key, "_h"), ranked


def row_sum(cols: Iterable[Column | str]) -> Column:
    """Row-wise sum with nulls skipped (0 for an empty set)."""
    total = F.lit(0)
    for c in cols:
        cc = F.col(f"`{c}`") if isinstance(c, str) else c
        total = total + F.coalesce(cc, F.lit(0))
    return total


def abs_threshold_flag(col: Column | str, threshold=1) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.coalesce((F.abs(c) > threshold).cast("int"), F.lit(0))
