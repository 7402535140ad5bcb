"""Joins around an entity key.

Every join states its cardinality.  Detail tables are reduced to one row per
key *before* they meet the fact table, so all feature joins share the key and
no join fans out by accident.  Broadcasts are left to adaptive execution,
which decides by measured bytes; beyond its threshold joins shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

def first_per_key(df: DataFrame, key: str | Sequence[str], order_by: Sequence[str],
                  columns: Sequence[str], last: bool = False) -> DataFrame:
    """One row per key: the first (or last) row by a total order.

    Written as ``min``/``max`` of a struct so Spark aggregates partially on
    the map side: a key holding a third of all rows is reduced before the
    shuffle instead of being sorted in one task.
    """
    keys = [key] if isinstance(key, str) else list(key)
    fields = list(order_by) + [c for c in columns if c not in order_by]
    agg = F.max if last else F.min
    packed = agg(F.struct(*[F.col(c) for c in fields])).alias("_row")
    return df.groupBy(*keys).agg(packed).select(*keys, *[F.col(f"_row.{c}").alias(c) for c in columns])


def assert_unique(df: DataFrame, key: str | Sequence[str]) -> None:
    keys = [key] if isinstance(key, str) else list(key)
    dup = df.groupBy(*keys).count().where(F.col("count") > 1).limit(1).count()
    if dup:
        raise ValueError(f"key {keys} is not unique")


def attach_detail(fact: DataFrame, detail: DataFrame, key: str, columns: Sequence[str],
                  rename: dict | None = None, dedupe: str = "fanout",
                  order_by: Sequence[str] | None = None, detail_key: str | None = None) -> DataFrame:
    """``fact`` LEFT JOIN ``detail`` on the key.

    dedupe = "fanout": duplicate detail keys multiply fact rows (documented);
             "first":  keep the first detail row per key by ``order_by``;
             "error":  raise when the detail key is not unique.
    """
    dkey = detail_key or key
    order = list(order_by or columns)
    extra = [c for c in order if c not in columns] if dedupe == "first" else []
    sel = detail.select(F.col(dkey).alias(key), *columns, *extra)
    if dedupe == "first":
        sel = first_per_key(sel, key, order, list(columns))
    elif dedupe == "error":
        assert_unique(sel, key)
    elif dedupe != "fanout":
        raise ValueError(f"unknown dedupe mode {dedupe!r}")
    for old, new in (rename or {}).items():
        sel = sel.withColumnRenamed(old, new)
    return fact.join(sel, key, "left")


def enum_lookup(df: DataFrame, code_col: str, enum: DataFrame, out_col: str | None = None,
                default="Unknown", value_col: str = "value", desc_col: str = "description",
                seq_col: str | None = None) -> DataFrame:
    """Map codes to descriptions with a default for unmatched and null codes.

    Duplicate codes: the row with the highest ``seq_col`` wins ("last row
    wins" in file order).  Without ``seq_col`` the greatest description wins,
    which is deterministic but not file order.  A null description counts as
    unmatched.  Adaptive execution broadcasts the lookup by its measured bytes.
    """
    out_col = out_col or f"{code_col}_desc"
    order = [seq_col, desc_col] if seq_col else [desc_col]
    lookup = (first_per_key(enum.select(F.col(value_col).alias("_code"), *order), "_code",
                            order, [desc_col], last=True)
              .withColumnRenamed(desc_col, "_desc"))
    joined = df.join(lookup, df[code_col] == lookup["_code"], "left")
    return joined.withColumn(out_col, F.coalesce(F.col("_desc").cast("string"), F.lit(default))) \
                 .drop("_code", "_desc")


def fetch_optional_column(df: DataFrame, column: str, default) -> DataFrame:
    """Keep ``column`` when the frame has it, else add it as a constant.

    The surveyed workflow re-fetched such columns with a self-join on the
    key; on one frame that is a plain projection."""
    return df if column in df.columns else df.withColumn(column, F.lit(default))


def self_join_fetch(df: DataFrame, source: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Literal left self-join form (kept for frames that differ)."""
    return df.join(source.select(key, *columns), key, "left")


def semi_join_values(df: DataFrame, col: str, values: DataFrame, values_col: str | None = None) -> DataFrame:
    """Rows of ``df`` whose ``col`` is one of ``values`` (membership filter)."""
    vcol = values_col or col
    v = values.select(F.col(vcol).alias("_v")).distinct()  # AQE broadcasts small value sets
    return df.join(v, df[col] == v["_v"], "left_semi")


def reindex_counts(classes: DataFrame, counts: DataFrame, class_col: str, count_col: str) -> DataFrame:
    """Counts over a full class list; classes without rows get 0."""
    return classes.join(counts, class_col, "left").withColumn(
        count_col, F.coalesce(F.col(count_col), F.lit(0)).cast("long"))
