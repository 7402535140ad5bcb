"""Sources and sinks: table loading with declared schemas, the split table,
the feature list, CSV reports, the run-metrics table and model storage."""

from __future__ import annotations

import logging
import os
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

log = logging.getLogger(__name__)

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
                 "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


@dataclass(frozen=True)
class TableSpec:
    """One input table.  ``schema`` is a StructType or DDL string; when given,
    the read uses it (no inference).  Optional tables that are missing are
    skipped with a warning; a missing required table raises."""
    name: str
    path: str
    schema: T.StructType | str | None = None
    required: bool = False
    fmt: str = "parquet"
    options: dict = field(default_factory=dict)


def _exists(spark: SparkSession, path: str) -> bool:
    if "://" not in path:
        return os.path.exists(path)
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def load_tables(spark: SparkSession, specs: list[TableSpec]) -> dict[str, DataFrame]:
    tables = {}
    for s in specs:
        if not _exists(spark, s.path):
            if s.required:
                raise FileNotFoundError(f"required table {s.name} not found at {s.path}")
            log.warning("table %s not found at %s - skipped", s.name, s.path)
            continue
        reader = spark.read.format(s.fmt).options(**s.options)
        if s.schema is not None:
            reader = reader.schema(s.schema)
        tables[s.name] = reader.load(s.path)
    return tables


CORRUPT = "_corrupt"


def load_checked(spark: SparkSession, path: str, schema: T.StructType | str, fmt: str = "csv", not_null: tuple[str, ...] = (),
                 **options) -> tuple[DataFrame, DataFrame]:
    """(good, bad) rows of a text table under a declared schema.  ``bad`` has
    the raw line and a reason: ``malformed`` (a value that is not of its type,
    too few or too many fields, broken JSON) or ``missing <column>`` for the
    first column of ``not_null`` without a value.  Nothing is dropped: every
    line of the input is in exactly one of the two."""
    declared = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    # nullable while reading: a missing value is judged below, not by the parser
    read = T.StructType([T.StructField(f.name, f.dataType) for f in declared] + [T.StructField(CORRUPT, T.StringType())])
    # a reader that prunes columns does not look at the others, so a line's verdict would depend on the query
    raw = (spark.read.format(fmt).schema(read).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
           .option("columnPruning", False).options(**options).load(path))
    if fmt == "csv":
        line = F.to_csv(F.struct(*[F.col(f"`{f.name}`") for f in declared]))
    else:
        line = F.to_json(F.struct(*[F.col(f"`{f.name}`") for f in declared]))
    reason = F.when(F.col(CORRUPT).isNotNull(), F.lit("malformed"))
    for c in not_null:
        reason = reason.when(F.col(f"`{c}`").isNull(), F.lit(f"missing {c}"))
    judged = raw.withColumn("_reason", reason)
    good = judged.where(F.col("_reason").isNull()).drop(CORRUPT, "_reason")
    bad = judged.where(F.col("_reason").isNotNull()).select(F.coalesce(CORRUPT, line).alias("line"), F.col("_reason").alias("reason"))
    return good, bad


def require(tables: dict, *names: str) -> None:
    missing = [n for n in names if n not in tables]
    if missing:
        raise ValueError(f"required tables missing: {missing}")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def write_split(df: DataFrame, path: str, split_col: str = "split", mode: str = "overwrite") -> None:
    """The prepared feature table, partitioned by split so a reader of one
    split touches only its files."""
    df.write.mode(mode).partitionBy(split_col).parquet(path)


def read_split(spark: SparkSession, path: str, split: str | None = None, split_col: str = "split") -> DataFrame:
    df = spark.read.parquet(path)
    return df if split is None else df.where(F.col(split_col) == split)


def write_feature_list(spark: SparkSession, features: list[str], path: str) -> None:
    spark.createDataFrame([(i, f) for i, f in enumerate(features)], "position int, feature string") \
         .coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def read_feature_list(spark: SparkSession, path: str) -> list[str]:
    rows = spark.read.option("header", True).schema("position int, feature string").csv(path) \
                .orderBy("position").collect()
    return [r["feature"] for r in rows]


def write_csv(df: DataFrame, path: str, decimals: int | None = None, mode: str = "overwrite") -> None:
    if decimals is not None:
        df = df.select(*[F.round(F.col(f.name), decimals).alias(f.name)
                         if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(f.name)
                         for f in df.schema.fields])
    # quotes inside a field are doubled, as spreadsheets and other readers expect
    df.write.mode(mode).option("header", True).option("escape", '"').csv(path)


def run_id_now() -> str:
    return f"{datetime.now():%Y%m%d_%H%M%S}"


def write_run(df: DataFrame, path: str, run_id: str) -> None:
    """Rows of a run (with a column ``model``) into the registry at ``path``,
    partitioned by run and model.  Writing a run's model again replaces its
    rows and no others', so a repeated or retried job leaves one copy."""
    (df.withColumn("run_id", F.lit(run_id)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy("run_id", "model").parquet(path))


def append_run_metrics(spark: SparkSession, path: str, run_id: str, model: str, metrics: dict) -> None:
    """One row per (run_id, model, metric) in the run table."""
    rows = [(model, k, float(v)) for k, v in metrics.items()]
    write_run(spark.createDataFrame(rows, "model string, metric string, value double"), path, run_id)


def read_run_metrics(spark: SparkSession, path: str, run_id: str | None = None) -> DataFrame:
    """The run table, or one run of it (only that run's files are read)."""
    # names of runs and models are texts, also where they look like numbers
    names = ("run_id", "model")
    schema = T.StructType([T.StructField(f.name, T.StringType()) if f.name in names else f for f in spark.read.parquet(path).schema])
    df = spark.read.schema(schema).parquet(path)
    return df if run_id is None else df.where(F.col("run_id") == run_id)


def save_model(model, path: str) -> None:
    model.write().overwrite().save(path)


def load_pipeline_model(path: str):
    from pyspark.ml import PipelineModel
    return PipelineModel.load(path)
