"""Session helpers.

`build_session` is for tests, benches and local runs.  On a cluster the
caller owns the session; library code only *reads* settings from it.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# Settings every local session gets.  AQE stays on so joins on sides whose
# runtime size is small become broadcast joins, skewed partitions are split
# and small shuffle partitions are coalesced.
LOCAL_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # for RDD checkpoints; tables of cut_lineage are removed by scratch_tables
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str | None = None, shuffle_partitions: int = 8,
                  app_name: str = "featurejudge", extra: dict | None = None) -> SparkSession:
    master = master or f"local[{os.environ.get('BENCH_CPUS', '*')}]"
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(LOCAL_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", "8g")
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names in
    ``spark.checkpoint.dir``; only when it is unset (local tests) a scratch
    folder is created and registered."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    if configured:
        sc.setCheckpointDir(configured)
        return configured
    if not sc.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    local = tempfile.mkdtemp(prefix="featurejudge-ckpt-")
    sc.setCheckpointDir(local)
    return local


#: Folders of the innermost ``scratch_tables`` block of this thread or task; None outside any block.
_scratch: ContextVar[list[str] | None] = ContextVar("scratch", default=None)


@contextmanager
def scratch_tables(spark: SparkSession) -> Iterator[None]:
    """Folders that ``scratch_folder`` and ``cut_lineage`` hand out inside the
    block are removed at its end, so write or collect a query's result inside it::

        with scratch_tables(spark):
            query(spark, sf_dir).write.parquet(target)

    The folders may be in any store that Spark writes.  Blocks of other threads
    have folders of their own."""
    mine: list[str] = []
    token = _scratch.set(mine)
    try:
        yield
    finally:
        _scratch.reset(token)
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        for path in mine:
            folder = spark._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(conf).delete(folder, True)


def scratch_folder(spark: SparkSession, kind: str = "tables") -> str:
    """Name of a fresh folder under the session's (shared) checkpoint folder;
    it stays until a ``scratch_tables`` block around the call ends."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{kind}/{uuid.uuid4().hex}"
    if (mine := _scratch.get()) is not None:
        mine.append(path)
    return path


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialize ``df`` once as a parquet table in a fresh folder under the
    session's (shared) checkpoint folder and return a DataFrame reading it.

    Used where one intermediate table feeds several actions (fits,
    vocabularies, the final write): the upstream joins run once, an executor
    loss re-reads files instead of re-running the lineage, and the reader
    gets column pruning and filter pushdown.  Never a local checkpoint.  The
    folder stays until a ``scratch_tables`` block around the call ends."""
    spark = df.sparkSession
    path = scratch_folder(spark)
    df.write.mode("error").parquet(path)
    return spark.read.parquet(path)
