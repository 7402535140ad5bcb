"""Feature assembly around an entity key (the whole assemble step as one
Spark plan).

Plan shape, chosen for scale:

* every detail table is reduced to one row per key in ONE aggregation that
  holds all features drawn from it (label, durations, presence, counts,
  distinct counts) -- one scan and one partially aggregated shuffle per
  detail table, however many features it feeds;
* the aggregated sides join on the fact key; dimension sides keyed by another
  fact column (e.g. the customer) need one more exchange of the fact;
* code lookups are broadcast by adaptive execution, by measured bytes;
* statistics (medians) and one-hot vocabularies are fitted on training rows
  only (code lists of the details are the caller's); rows with a null label are dropped, never imputed.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featurejudge.functions.columns import numeric_columns, sanitize_name
from featurejudge.operators import encode, fit, joins
from featurejudge.session import cut_lineage


@dataclass
class DetailSpec:
    """Features from one detail table.  ``aggregates`` None means the table
    is already one row per key (a dimension) and is joined as is."""
    df: DataFrame
    key: str
    aggregates: list[Column] | None = None
    derived: dict[str, Column] = field(default_factory=dict)
    on: str | None = None
    columns: list[str] | None = None


@dataclass
class LookupSpec:
    code_col: str
    enum: DataFrame
    out_col: str
    default: str = "Unknown"
    seq_col: str | None = None
    value_col: str = "value"
    desc_col: str = "description"


@dataclass
class Assembled:
    frame: DataFrame          # key, label, target, split, features...
    features: list[str]
    labels: DataFrame         # label_text -> target
    dropped: DataFrame        # fact rows whose label is null


def assemble_features(fact: DataFrame, key: str, label: str, details: list[DetailSpec] = (),
                      lookups: list[LookupSpec] = (), categorical: dict[str, str] | None = None,
                      drop: list[str] = (), constants: dict | None = None,
                      test_fraction: float = 0.2, seed: int = 42, impute: str = "median") -> Assembled:
    frame = fact
    for d in details:
        join_col = d.on or key
        if d.aggregates is None:
            side = d.df.select(F.col(d.key).alias(join_col), *(d.columns or []))
        else:
            side = d.df.groupBy(F.col(d.key).alias(join_col)).agg(*d.aggregates)
        if d.derived:
            side = side.withColumns(d.derived)
        frame = frame.join(side, join_col, "left")
    for lk in lookups:
        frame = joins.enum_lookup(frame, lk.code_col, lk.enum, lk.out_col, lk.default, lk.value_col,
                                  lk.desc_col, lk.seq_col)

    # the joins run once: the split thresholds, the fits and the final select
    # read the written rows, each only the columns it needs
    frame = cut_lineage(frame)
    dropped = frame.where(F.col(label).isNull())
    split = fit.stratified_split(frame, key, label, test_fraction, seed)
    train = F.col("split") == "train"

    categorical = categorical or {}
    skip = {key, label, "split", *categorical, *drop}
    numeric = numeric_columns(split, exclude=skip)
    split = split.withColumns({c: F.col(c).cast("double") for c in numeric})
    if impute == "median":
        split = fit.impute(split, fit.fit_medians(split, numeric, where=train), fallback=0)

    onehot_cols = []
    vocabs = encode.fitted_vocabularies(split.where(train), list(categorical))
    for col, prefix in categorical.items():
        vocab = vocabs[col]
        split = encode.one_hot(split, col, vocab, prefix=prefix, drop=True)
        onehot_cols += [sanitize_name(f"{prefix}_{v}") for v in vocab]
    split = split.drop(*drop)
    consts = constants or {}
    if consts:
        split = split.withColumns({k: F.lit(v) for k, v in consts.items()})

    indexed, labels = fit.label_index(split, label, "target")
    features = numeric + onehot_cols + list(consts)
    frame = indexed.select(key, label, "target", "split", *features)
    return Assembled(frame, features, labels, dropped)
